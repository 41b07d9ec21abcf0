"""The stages in order over a store: directory, crawl, extract, enrich, embed, cluster.

Network and models come in only through what the caller plugs in: a fetcher, a page reader, an
enricher, an encoder, a namer. Each stage reads its tables, writes its own, and returns its report.
"""

from __future__ import annotations

import functools
import json
import uuid
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageatlas.config import Tuning
from pageatlas.functions.url import authority, base_url
from pageatlas.operators import directory, enrich, fetchlog, hdbscan, layout, topics, versions
from pageatlas.schemas import SCHEMAS
from pageatlas.session import durable, numbered, temporary
from pageatlas.sources.polite import PoliteFetcher
from pageatlas.sources.store import Store


def now_iso() -> str:
    return datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%S.%fZ")


def new_run_id() -> str:
    """Sortable to the second, unique beyond it."""
    return datetime.now(UTC).strftime("%Y%m%dT%H%M%SZ") + "-" + uuid.uuid4().hex[:6]


#: The headers that are kept beside a body.
STORED_HEADERS = ("content-type", "etag", "last-modified", "x-robots-tag", "date")
RAW = "raw_object_key string, body binary, final_url string, status bigint, headers map<string,string>"


def decoded(body: bytes, content_type: str | None) -> str:
    """A body as text, by the charset its type names, else UTF-8; what cannot be read becomes a mark."""
    _, _, charset = (content_type or "").lower().partition("charset=")
    try:
        return body.decode(charset.split(";")[0].strip(" \"'") or "utf-8", "replace")
    except LookupError:
        return body.decode("utf-8", "replace")


def _stage(f):
    """A stage that leaves tables of the store only; what it wrote on the way is deleted."""

    @functools.wraps(f)
    def run(self, *args, **kwargs):
        with temporary(self.spark):
            return f(self, *args, **kwargs)

    return run


class Engine:
    def __init__(self, spark: SparkSession, root: str, tuning: Tuning | None = None):
        self.spark, self.store, self.tuning = spark, Store(spark, root), tuning or Tuning()

    def _table(self, name: str) -> DataFrame:
        """A table with the parts appended to it. A part of ``focuses`` counts once its part of ``extractions``, which is
        written after it, is there: what an interrupted run left half is not seen, and is done again."""
        whole = self.store.read_table(name, SCHEMAS[name])
        parts = self.store.parts("extractions" if name == "focuses" else name)
        return whole.unionByName(self.store.read_parts(name, SCHEMAS[name], parts)) if parts else whole

    def _people(self) -> DataFrame:
        return self.store.read_table("people", SCHEMAS["people"] + ", seq bigint")

    def fetch_directory(self, fetcher: Callable[[str, str | None, str | None], dict], url: str, day: str) -> dict:
        """Get the directory with the crawl's kind of fetcher and take it over; an answer that is no success is an error."""
        got = fetcher(url, None, None)
        if got.get("error") or not 200 <= (got.get("status") or 0) < 400:
            raise ConnectionError(f"the directory answered {got.get('error') or got.get('status')}")
        body = got.get("body") or ""
        return self.directory(decoded(body, got.get("content_type")) if isinstance(body, bytes) else body, day)

    @_stage
    def directory(self, text: str, day: str) -> dict:
        """Snapshot the directory of ``day`` and bring ``people`` up to it; refuses an empty one."""
        lines = self.spark.createDataFrame([(day, text)], "file string, t string").select("file", F.posexplode(F.split("t", r"\r\n|[\n\r]")).alias("line_no", "line"))
        rows = durable(directory.parse_directory(lines))
        if rows.isEmpty():
            raise ValueError("the directory has no valid line; nothing was written")
        self.store.append("directory_snapshots", directory.snapshot_frame(rows, day), day)
        people = self._people()
        was_open = people.where("valid_to is null").select("url")
        new = rows.join(was_open, "url", "left_anti").count()
        updated = directory.update_people(people, rows, day)
        rows_ = numbered(updated, "place", "block", "pos")
        people = durable(rows_.withColumn("seq", F.col("place") + 1).drop("block", "pos", "place"))
        self.store.write_table("people", people)
        ended = people.where(F.col("valid_to") == day).select("url").distinct()
        changed = ended.join(rows.select("url"), "url", "left_semi").count()
        return {"rows": rows.count(), "new": new, "changed": changed, "removed": ended.count() - changed}

    def polite(self, transport: Callable[[str, dict], dict], user_agent: str) -> PoliteFetcher:
        """A fetcher for ``crawl`` that keeps to the configured delay of a host."""
        return PoliteFetcher(transport, user_agent, self.tuning.crawl.host_delay)

    @_stage
    def crawl(self, fetcher: Callable[[str, str | None, str | None], dict], limit: int = 0) -> dict:
        """Fetch each base url of open rows once. ``fetcher(base, etag, last_modified)`` gives a response:
        status, content_type, body, etag, last_modified, robots_tag, final_url, or error. Hosts are not
        split over tasks, so a task is polite by being serial."""
        people = self._people()
        if people.isEmpty():
            raise RuntimeError("no people: run directory first")
        run_id, at = new_run_id(), now_iso()
        deny = self.store.read_text("denylist.txt") or ""
        denylist = self.spark.createDataFrame([(x.strip(),) for x in deny.splitlines() if x.strip()] or [("",)], "entry string")
        targets = fetchlog.targets(people, limit)
        log = self.store.read_parts("fetches", SCHEMAS["fetches"])
        known = fetchlog.priors(log)
        groups = fetchlog.deny_groups(targets, denylist)
        prior = groups.select("url", "base").join(known, "url").groupBy("base").agg(F.min(F.struct("url", "etag", "last_modified", "content_hash", "raw_object_key")).alias("p"))
        asked = groups.where("not denied").select("base").distinct().join(prior, "base", "left").select("base", "p.etag", "p.last_modified", "p.content_hash", "p.raw_object_key")
        shape = "base string, prior_hash string, prior_key string, prior_etag string, prior_modified string, status bigint, content_type string, body binary, headers map<string,string>, etag string, last_modified string, robots_tag string, final_url string, failed string"

        def fetch(batches):
            import pandas as pd

            for pdf in batches:
                out = []
                for r in pdf.itertuples(index=False):
                    try:
                        got = fetcher(r.base, r.etag, r.last_modified)
                    except Exception as e:
                        got = {"error": type(e).__name__}
                    g = got.get
                    body, heads = g("body"), {k.lower(): str(v) for k, v in (g("headers") or {}).items()}
                    heads |= {k: g(n) for k, n in (("content-type", "content_type"), ("etag", "etag"), ("last-modified", "last_modified"), ("x-robots-tag", "robots_tag")) if g(n)}
                    body = body.encode() if isinstance(body, str) else body
                    heads = {k: v for k, v in heads.items() if k in STORED_HEADERS}
                    out.append((r.base, r.content_hash, r.raw_object_key, r.etag, r.last_modified, g("status"), g("content_type"), body, heads, g("etag"), g("last_modified"), g("robots_tag"), g("final_url", r.base), g("error")))
                yield pd.DataFrame(out, columns=[c.split()[0] for c in shape.split(", ")]).astype({"status": "Int64"})

        by_host = asked.repartition(self.tuning.crawl.concurrency, authority(F.lower("base")))  # as many requests at once, a host in one task
        got = durable(by_host.mapInPandas(fetch, shape))
        error = F.coalesce("failed", fetchlog.response_error(F.col("status"), F.col("content_type"), F.octet_length("body"), F.col("robots_tag"), F.col("body").cast("string"), self.tuning.crawl.max_bytes))
        hashed = F.sha2("body", 256)
        same, ok = F.col("status") == 304, F.col("error").isNull()
        from pageatlas.functions.url import raw_object_key

        done = got.withColumn("error", error).select(
            "base", "status", "final_url", "error", "body", "headers",
            F.when(same, F.coalesce("etag", "prior_etag")).when(ok, F.col("etag")).alias("etag"),
            F.when(same, F.coalesce("last_modified", "prior_modified")).when(ok, F.col("last_modified")).alias("last_modified"),
            F.when(same, F.col("prior_hash")).when(ok, hashed).alias("content_hash"),
            F.when(ok & ~same, F.octet_length("body").cast("bigint")).alias("bytes"),
            F.when(same, F.col("prior_key")).when(ok, raw_object_key(F.col("base"), hashed)).alias("raw_object_key"),
        )
        raw = done.where("error is null and status <> 304").groupBy("raw_object_key").agg(F.max_by(F.struct("body", "final_url", "status", "headers"), "base").alias("r")).select("raw_object_key", "r.*")
        stored = self.store.read_parts("raw", RAW)
        self.store.append("raw", fetchlog.missing_raw(raw, stored), run_id)
        rows = groups.join(done.drop("body", "headers"), "base", "left").select(
            F.lit(run_id).alias("run_id"), "url", F.lit(at).alias("fetched_at"), "status", F.coalesce("final_url", "base").alias("final_url"), "etag", "last_modified",
            "content_hash", "bytes", F.when(F.col("denied"), "denylist").otherwise(F.col("error")).alias("error"), "raw_object_key",
        )
        self.store.append("fetches", rows, run_id)
        written = self.store.read_parts("fetches", SCHEMAS["fetches"]).where(F.col("run_id") == run_id)
        report = fetchlog.run_summary(written, self.tuning.crawl.failure_threshold).first()
        out = {"run_id": run_id} if report is None else report.asDict()
        out["errors"] = {r["error"]: r["n"] for r in fetchlog.error_reasons(written).collect()}
        self.store.write_json(f"runs/{run_id}-crawl.json", json.dumps({"stage": "crawl", "started_at": at, **out}))
        return out

    @_stage
    def extract(self, reader: Callable[[str, str], str] | None = None) -> dict:
        """Fold fetches into versions. ``reader(url, html)`` gives a page's text; by default the main text."""
        from pageatlas.functions.html import main_text_of
        from pageatlas.functions.page import normalize, stated_date

        read = reader or main_text_of
        fetches, table = self.store.read_parts("fetches", SCHEMAS["fetches"]), self._table("versions")
        raw = self.store.read_parts("raw", RAW).groupBy("raw_object_key").agg(F.max("body").alias("body"), F.max(F.col("headers")["content-type"]).alias("kind"))

        @F.pandas_udf("string")
        def text_of(url, body, kind):
            import pandas as pd

            def one(u, b, k):
                try:
                    return None if b is None else read(u, decoded(b, k))
                except Exception:
                    return None

            return pd.Series([one(u, b, k) for u, b, k in zip(url, body, kind)])

        pages = fetches.select("url", "raw_object_key").where("raw_object_key is not null").distinct().join(raw, "raw_object_key")
        md = pages.select("url", "raw_object_key", text_of("url", "body", "kind").alias("md"))
        texts = durable(md.select("url", "raw_object_key", normalize(F.col("md")).alias("text"), stated_date(F.col("md")).alias("stated_date")))
        folded = durable(versions.fold_versions(fetches, versions.latest_by_url(table), texts, self.tuning.extract.meaningful_ratio))
        people = self._people()
        owners = versions.owner_by_url(people)
        self.store.write_table("versions", durable(versions.merge_versions(table, folded, owners, self.tuning.extract.min_text_chars)))
        report = versions.extract_report(folded, self.tuning.extract.min_text_chars).first().asDict()
        self.store.write_json(f"runs/{new_run_id()}-extract.json", json.dumps({"stage": "extract", **report}))
        return report

    @_stage
    def enrich(self, enricher: Callable[[str], str], limit: int | None = None, model: str = "plugged") -> dict:
        """Ask ``enricher`` about each page that is still to do, ``concurrency`` pages at once, and write down what came
        back after every ``checkpoint_every`` pages of each: an interrupted run keeps what it wrote, and goes on from there."""
        cfg = self.tuning.enrich
        texts = self._table("versions")
        latest, stored = versions.latest_versions(texts), self._table("extractions")
        todo = numbered(enrich.todo_versions(latest, stored, cfg.prompt_version, limit), "place", "version_id")
        n, step, run = todo.count(), cfg.concurrency * cfg.checkpoint_every, new_run_id()
        done = {"enriched": 0, "focuses": 0}
        for lo in range(0, n, step):
            some = todo.where((F.col("place") >= lo) & (F.col("place") < lo + step)).drop("place").repartition(min(cfg.concurrency, n))
            got = durable(enrich.enrich(some, enricher, cfg, model))
            good = durable(enrich.accepted(got.where("error is null"), texts, cfg))
            checked = got.join(good.select("version_id", "o", "quotes"), "version_id").withColumn(
                "json", F.to_json(F.col("o").withField("quotes", F.col("quotes")).withField("life_transitions", enrich.known_transitions(F.col("o"), cfg)))
            ).select("version_id", "model", "prompt_version", "schema_version", "json", F.lit(now_iso()).alias("created_at"))
            focuses = enrich.explode_focuses(good)
            part = f"{run}-{lo // step:08d}"
            columns = [c.split()[0] for c in SCHEMAS["focuses"].split(", ")]
            self.store.append("focuses", focuses.select(columns), part)
            self.store.append("extractions", checked, part)
            done["enriched"] += good.count()
            done["focuses"] += focuses.count()
        return {"candidates": n or latest.count(), "enriched": done["enriched"], "failed": n - done["enriched"], "focuses": done["focuses"]}

    @_stage
    def embed(self, encoder: Callable[[list[str]], list], revision: str = "1") -> dict:
        model = self.tuning.embed.model
        candidates = enrich.candidate_focuses(self._table("focuses"), versions.latest_versions(self._table("versions")))
        stored = self._table("embeddings")
        new = durable(enrich.embed(enrich.todo_focuses(candidates, stored, model), encoder, model, revision, self.tuning.embed.max_tokens))
        self.store.write_table("embeddings", stored.unionByName(new))
        return {"candidates": candidates.count(), "embedded": new.count()}

    def cluster(self, namer: Callable[[dict[int, list[str]]], dict[int, str]] | None = None) -> tuple[dict, DataFrame]:
        """Topics over focuses, page positions, the ``layouts`` table, and the points to export."""
        cfg = self.tuning.cluster
        latest = versions.latest_versions(self._table("versions"))
        foc = durable(topics.embedded_focuses(self._table("focuses"), self._table("embeddings")).join(latest.select("version_id"), "version_id", "left_semi"))
        if foc.isEmpty():
            raise RuntimeError("no embedded focuses: run enrich and embed first")
        labels = hdbscan.cluster(foc.select(F.col("focus_id").alias("id"), "vector"), cfg.min_cluster_size)
        foc = foc.join(labels.withColumnRenamed("id", "focus_id"), "focus_id").withColumnRenamed("label", "topic")
        into = topics.merge_similar(topics.centroids(foc), cfg.merge_cosine)
        merged = self.spark.createDataFrame(sorted(into.items()) or [(-2, -2)], "topic int, into int")
        foc = foc.join(merged, "topic", "left").withColumn("topic", F.coalesce("into", "topic")).drop("into")
        foc = durable(topics.prune_small(foc, cfg.min_topic_pages))
        from pageatlas.functions.page import focus_text

        passages = foc.select(F.col("version_id").alias("page"), "topic", F.col("focus_id").alias("pos"), focus_text(F.col("summary"), F.col("tags")).alias("text")).where("text is not null")
        cents = durable(topics.centroids(foc))
        ids = [r["topic"] for r in cents.select("topic").collect()]
        names = topics.pick_labels(topics.label_scores(passages, topics.label_vocabulary(passages, cfg.label_max_page_share)), ids, cfg.label_terms)
        if namer and ids:
            try:
                s = topics.topic_samples(foc, cents, cfg.topic_sample_size).join(foc.select("focus_id", "summary"), "focus_id")
                samples: dict[int, list[str]] = {}
                for r in s.orderBy("topic", "rank").collect():  # topic_sample_size rows a topic
                    samples.setdefault(r["topic"], []).append(r["summary"])
                names |= {k: v.strip().lower() for k, v in namer(samples).items() if k in names}
            except Exception:  # keyword labels stay
                pass
        weights = durable(topics.page_topic_weights(foc))
        pages = latest.join(foc.select("version_id").distinct(), "version_id", "left_semi")
        run_id = new_run_id()
        at = layout.positions(topics.page_vectors(foc))
        labels_df = self.spark.createDataFrame([(k, v) for k, v in sorted(names.items())] or [(-2, "")], "cluster_id int, cluster_label string")
        rows = topics.primary_topics(weights, pages).join(at, "version_id").join(labels_df, "cluster_id", "left")
        self.store.write_table("layouts", rows.select(F.lit(run_id).alias("run_id"), F.col("version_id").alias("id"), "x", "y", F.col("cluster_id").cast("bigint"), "cluster_label"))
        points = topics.export_points(pages, weights, topics.snippets(foc, cents), topics.first_quotes(self._table("extractions")), self._people(), cfg.excerpt_chars).join(at.withColumnRenamed("version_id", "id"), "id")
        n = pages.count()
        counted = topics.topic_pages(weights).join(labels_df, F.col("topic") == F.col("cluster_id")).orderBy("topic")
        listed = [{"id": r["topic"], "label": r["cluster_label"], "pages": r["pages"]} for r in counted.collect()]  # a row per topic
        noise = n - weights.select("version_id").distinct().count()
        return {"run_id": run_id, "points": n, "clusters": len(ids), "noise": noise, "layout": layout.METHOD, "topics": listed}, points

    def export(self, points: DataFrame, path: str) -> None:
        """Points as JSON lines, letters as they are."""
        points.select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite").text(path)

    def export_document(self, report: dict, points: DataFrame, key: str) -> None:
        """One JSON document {run_id, topics, points} for the map, letters as they are. It is a single file by its nature:
        one task strings the points together, row by row."""
        head = json.dumps({"run_id": report["run_id"], "topics": report["topics"]}, ensure_ascii=False)[:-1] + ', "points": ['
        shaped = points.withColumn("topics", F.from_json("topics", "array<struct<id:int,weight:double,snippet:string>>"))
        rows = numbered(shaped.select("id", F.to_json(F.struct("*")).alias("point")), "place", "id")
        lines = rows.select("place", F.concat(F.when(F.col("place") > 0, ",").otherwise(""), "point").alias("value"))
        ends = self.spark.createDataFrame([(-1, head), (2**62, "]}")], "place bigint, value string")
        one = ends.unionByName(lines).coalesce(1).sortWithinPartitions("place").select("value")
        one.write.mode("overwrite").text(f"{self.store.root}/{key}")

    def read_export(self, key: str) -> tuple[list, DataFrame] | None:
        """(topics, points) of an exported document; None where there is none, it cannot be read, or has no points."""
        if not self.store.exists(key):
            return None
        points = "points array<struct<id:string,url:string,name:string,city:string,country:string,captured_at:string,excerpt:string,topics:array<struct<id:int,weight:double,snippet:string>>,x:double,y:double>>"
        doc = self.spark.read.schema(f"run_id string, topics array<struct<id:int,label:string,pages:bigint>>, {points}").json(f"{self.store.root}/{key}", multiLine=True)
        first = doc.where(F.size("points") > 0).select("topics").first()
        return None if first is None else ([r.asDict() for r in first["topics"] or []], doc.select(F.explode("points").alias("p")).select("p.*"))
