"""Versions of pages: the ordered fold of fetches into texts, and what is read off it."""

from __future__ import annotations

import difflib
import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageatlas.functions.arrow import arrow_function
from pageatlas.functions.page import text_hash, version_id
from pageatlas.functions.text import split_lines
from pageatlas.operators.fetchlog import runs, usable
from pageatlas.session import durable


def line_bound(old: Column, new: Column) -> Column:
    """An upper bound of the line similarity of two texts: twice the common lines, as bags, by all lines.

    A bound below the threshold proves a meaningful change without comparing; above it nothing is
    proved. Texts without lines have 1.
    """
    a, b = split_lines(old), split_lines(new)
    count = lambda xs, x: F.size(F.filter(xs, lambda y: y == x))
    common = F.aggregate(F.array_intersect(a, b), F.lit(0), lambda s, x: s + F.least(count(a, x), count(b, x)))
    total = F.size(a) + F.size(b)
    return F.when(total > 0, 2.0 * common / total).otherwise(1.0)


@arrow_function("double")
def line_ratio(old: pd.Series, new: pd.Series) -> pd.Series:
    """Similarity of two texts by lines; null where either is null."""
    return pd.Series(
        [None if a is None or b is None else difflib.SequenceMatcher(None, a.splitlines(), b.splitlines(), autojunk=False).ratio() for a, b in zip(old, new)]
    )


def changed_meaningfully(old: str, new: str, ratio: float) -> bool:
    if old == new:
        return False
    return difflib.SequenceMatcher(None, old.splitlines(), new.splitlines(), autojunk=False).ratio() < ratio


def fold_versions(fetches: DataFrame, latest: DataFrame, texts: DataFrame, ratio: float = 0.98) -> DataFrame:
    """Fold each url's usable fetches, in order of time, into its versions; one row per fetch looked at.

    ``latest``: each url's latest version; ``texts``: (url, raw_object_key, text, stated_date), where a
    text that is null or missing is an error of its fetch. Fetches not later than last_seen are left out.
    A 304 or an unchanged hash extends the version (``unchanged``); so does a text no less similar than
    ``ratio`` to the version's stored text, which also takes the new hash; an ``error`` changes nothing;
    all else opens a version (``new``), whose row alone has the text, its hash and date.

    Fetches first reduce to runs of one object (``fetchlog.runs``, spread over the days of a crowded url).
    Only the heads of runs meet their texts and are folded; they stream through sorted by url and time, the
    state being one version, so no url's texts are ever held together. The rest of a run follows its head.
    """
    order = ["fetched_at", "content_hash", "raw_object_key"]
    cols = ["url", "fetched_at", "status", "content_hash", "raw_object_key"]
    f = usable(fetches).select(*cols).distinct().join(latest.select("url", F.col("last_seen").alias("mark")), "url", "left")
    f = f.where(F.col("mark").isNull() | (F.col("fetched_at") > F.col("mark"))).drop("mark")
    rows = durable(runs(f, order, F.struct("content_hash", F.coalesce("raw_object_key", F.lit("")).alias("k"))))
    heads = rows.where("opens").join(texts, ["url", "raw_object_key"], "left")
    none = F.lit(None).cast("string")
    start = "struct<fetched_at:string,content_hash:string,raw_object_key:string>"
    seeds = latest.select(
        "url", F.lit(0).alias("kind"), F.col("last_seen").alias("at"), F.lit(0).cast("bigint").alias("status"), "content_hash", none.alias("key"), F.col("text_md").alias("text"), "stated_date",
        "version_id", "first_seen",
    )
    opened = heads.select("url", F.lit(1).alias("kind"), F.col("fetched_at").alias("at"), "status", "content_hash", F.col("raw_object_key").alias("key"), "text", "stated_date", none.alias("version_id"), none.alias("first_seen"))
    ordered = seeds.unionByName(opened).repartition("url").sortWithinPartitions("url", "kind", "at", "content_hash", "key")
    shape = "url string, at string, content_hash string, key string, action string, version_id string, first_seen string, text_md string, text_hash string, stated_date string"

    def fold(batches):
        cur, url = None, None
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                if r.url != url:
                    cur, url = None, r.url
                if r.kind == 0:
                    cur = {"version_id": r.version_id, "first_seen": r.first_seen, "text": r.text or "", "hash": r.content_hash}
                    continue
                action, new = "unchanged", (None, None, None)
                if cur is not None and (r.status == 304 or r.content_hash == cur["hash"]):
                    pass
                elif r.text is None or r.text != r.text:
                    action = "error"
                elif cur is not None and not changed_meaningfully(cur["text"], r.text, ratio):
                    cur["hash"] = r.content_hash
                else:
                    hashed = hashlib.sha256(r.text.encode()).hexdigest()
                    vid = hashlib.sha1(f"{r.url}\0{hashed}\0{r.at}".encode()).hexdigest()
                    cur = {"version_id": vid, "first_seen": r.at, "text": r.text, "hash": r.content_hash}
                    action, new = "new", (r.text, hashed, r.stated_date)
                at = (cur["version_id"], cur["first_seen"]) if cur else (None, None)
                out.append((r.url, r.at, r.content_hash, r.key, action, *at, *new))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in shape.split(", ")])

    folded = ordered.mapInPandas(fold, shape).select(
        "url", F.struct(F.col("at").alias("fetched_at"), "content_hash", F.col("key").alias("raw_object_key")).cast(start).alias("start"), F.col("action").alias("head"), "version_id", "first_seen", "text_md", "text_hash", "stated_date"
    )
    same = ["url", "start.fetched_at", "start.content_hash", F.coalesce("start.raw_object_key", F.lit("")).alias("k")]
    keyed = folded.select(*same, "head", "version_id", "first_seen", "text_md", "text_hash", "stated_date")
    all_ = rows.select("opens", "status", F.col("fetched_at").alias("last_seen"), F.col("content_hash").alias("hash"), *same).join(keyed, ["url", "fetched_at", "content_hash", "k"])
    # behind a head that failed, a 304 still extends the version before it, if there is one
    action = F.when(F.col("opens"), F.col("head")).when((F.col("head") == "error") & ((F.col("status") != 304) | F.col("version_id").isNull()), "error").otherwise("unchanged")
    of = lambda c: F.when(F.col("action") != "error", F.col(c)).alias(c)
    first = lambda c: F.when(F.col("action") == "new", F.col(c)).alias(c)
    return all_.withColumn("action", action).select("url", "action", of("version_id"), of("first_seen"), "last_seen", first("text_md"), F.col("hash").alias("content_hash"), first("text_hash"), first("stated_date"))


def merge_versions(versions: DataFrame, folded: DataFrame, owners: DataFrame, min_chars: int = 200) -> DataFrame:
    """The versions table after a fold: what was extended takes its last_seen and hash, new ones follow."""
    last = folded.where("action <> 'error'").groupBy("version_id").agg(F.max("last_seen").alias("seen"), F.max_by("content_hash", F.struct("last_seen", "content_hash")).alias("hash"))
    opened = folded.where("action = 'new'").select("version_id", "url", "first_seen", "text_md", "text_hash", "stated_date")
    kept = versions.join(last.select("version_id", "seen", "hash"), "version_id", "left").withColumn("last_seen", F.coalesce("seen", "last_seen")).withColumn(
        "content_hash", F.coalesce("hash", "content_hash")
    ).select(versions.columns)
    new = last.join(opened, "version_id").join(versions.select("version_id"), "version_id", "left_anti").select("version_id", "url", "first_seen", "text_md", "text_hash", "stated_date", F.col("seen").alias("last_seen"), F.col("hash").alias("content_hash")).join(owners, "url", "left")
    new = new.withColumn("source", F.lit("crawl")).withColumn("needs_js", F.length("text_md") < min_chars)
    return kept.unionByName(new, allowMissingColumns=True).select(versions.columns)


def extract_report(folded: DataFrame, min_chars: int = 200) -> DataFrame:
    """(examined, new_versions, unchanged, needs_js, errors)."""
    new = F.col("action") == "new"
    return folded.agg(
        F.count("*").alias("examined"), F.count_if(new).alias("new_versions"), F.count_if(F.col("action") == "unchanged").alias("unchanged"),
        F.count_if(new & (F.length("text_md") < min_chars)).alias("needs_js"), F.count_if(F.col("action") == "error").alias("errors"),
    )


def owner_by_url(people: DataFrame) -> DataFrame:
    """(url, person_id): the owner of the latest period, open or closed."""
    return people.where(F.col("url").isNotNull()).groupBy("url").agg(F.max(F.struct(F.coalesce("valid_from", F.lit("")), "person_id"))["person_id"].alias("person_id"))


def latest_by_url(versions: DataFrame) -> DataFrame:
    """Each url's row of the greatest last_seen, of equal ones the greatest version_id."""
    return _latest(versions)


def latest_versions(versions: DataFrame) -> DataFrame:
    """Each url's latest version that has text and does not need JavaScript."""
    return _latest(versions.where(F.col("text_md").isNotNull() & ~F.coalesce("needs_js", F.lit(False)) & (F.length("text_md") > 0)))


def _latest(versions: DataFrame) -> DataFrame:
    from pyspark.sql import Window

    w = Window.partitionBy("url").orderBy(F.desc("last_seen"), F.desc("version_id"))
    return versions.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def new_version_rows(texts: DataFrame) -> DataFrame:
    """(version_id, text_hash, needs_js) of (url, fetched_at, text)."""
    hashed = text_hash(F.col("text"))
    return texts.select("url", "fetched_at", version_id(F.col("url"), hashed, F.col("fetched_at")).alias("version_id"), hashed.alias("text_hash"), (F.length("text") < 200).alias("needs_js"))
