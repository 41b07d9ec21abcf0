"""Scalars, the fetch log, versions, vectors and the engine with plugged-in providers."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from pageatlas.config import Tuning
from pageatlas.functions import page
from pageatlas.functions.html import main_text_of
from pageatlas.operators import fetchlog, hdbscan, layout, topics, versions


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x")).alias("y")).first()["y"]


def test_text_functions(spark):
    text = "Hello\nLast updated: 3 March 2026\nmore 1,234 visitors here\n\n\n\nend  "
    assert one(spark, text, page.normalize) == "Hello\nmore  here\n\nend"
    assert one(spark, text, page.stated_date) == "2026-03-03"
    assert one(spark, "updated soon | Edited: March 2026", page.stated_date) == "2026-03-01"
    assert one(spark, None, page.normalize) is None and one(spark, "", page.normalize) == ""
    assert one(spark, "# A [b](http://x) " + "c" * 300, page.excerpt) == ("A b " + "c" * 300)[:280] + "…"
    got = spark.createDataFrame([(["writing  a novel\nabout grief", "invented", ""], "I am writing a\nnovel about  grief.")], "q array<string>, t string")
    assert got.select(page.valid_quotes(F.col("q"), F.col("t")).alias("v")).first()["v"] == ["writing a novel about grief"]


def test_texts_with_mixed_line_ends_meet_the_queries(spark, tmp_path):
    import __spark_entry__

    texts = [(0, "one\r\n12 views\rtwo\n"), (1, "plain"), (4, "a\rLast updated: 5 May 2020\r\nb"), (6, None)]
    spark.createDataFrame(texts, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    q = __spark_entry__.queries()
    assert {r["doc_id"]: r["normal"] for r in q["d4_all_texts"](spark, str(tmp_path)).collect()} == {0: "one\n\ntwo\n\nend", 1: "plain\n\n  _This page was last modified on 3 March 2026_\nend", 4: "a\nb\n\nend", 6: "since\nend"}
    assert {r["doc_id"]: r["stated"] for r in q["d3_all_texts"](spark, str(tmp_path)).collect()} == {0: "2026-03-01", 1: "2026-03-03", 4: "2020-05-05", 6: None}


def test_denylist(spark):
    urls = spark.createDataFrame([("https://a.example/x#top",), ("https://sub.bad.example/",), ("https://notbad.example/",), ("no url",)], "url string")
    deny = spark.createDataFrame([(" Bad.example ",), ("",), ("https://A.example/x",)], "entry string")
    got = {r["url"]: r["denied"] for r in fetchlog.is_denied(urls, deny).collect()}
    assert got == {"https://a.example/x#top": True, "https://sub.bad.example/": True, "https://notbad.example/": False, "no url": False}


def test_slow_drift_is_compared_with_the_stored_text(spark):
    fetches = spark.createDataFrame([("u", f"t{i}", 200, f"h{i}", f"k{i}", "r") for i in range(5)] + [("u", "t9", 304, "h4", "k4", "r"), ("u", "t8", 200, "bad", "none", "r")],
                                    "url string, fetched_at string, status bigint, content_hash string, raw_object_key string, run_id string")
    base = [f"line {i}" for i in range(100)]
    texts = []
    for i in range(5):
        texts.append(("u", f"k{i}", "\n".join(["changed"] * i + base[i:]), None))
    t = spark.createDataFrame(texts, "url string, raw_object_key string, text string, stated_date string")
    none = spark.createDataFrame([], "url string, version_id string, first_seen string, last_seen string, text_md string, content_hash string, text_hash string, stated_date string")
    got = [r["action"] for r in versions.fold_versions(fetches, none, t).orderBy("last_seen").collect()]
    # 1 and 2 changed lines of 100 are within the ratio of the first text, 3 are not
    assert got == ["new", "unchanged", "unchanged", "new", "unchanged", "error", "unchanged"]


def test_density_clusters_do_not_depend_on_order():
    rng = np.random.default_rng(3)
    centres = np.eye(6)[:3]
    x = np.vstack([c + 0.05 * rng.normal(size=(20, 6)) for c in centres] + [rng.normal(size=(5, 6))])
    labels = hdbscan.labels_of(x, 8)
    assert [len(set(labels[k * 20 : k * 20 + 20])) for k in range(3)] == [1, 1, 1] and len(set(labels[:60])) == 3
    order = rng.permutation(len(x))
    again = hdbscan.labels_of(x[order], 8)
    pairs = {(a, b) for a, b in zip(labels[order], again)}
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})
    assert (hdbscan.labels_of(x[:7], 8) == -1).all() and (hdbscan.labels_of(x[:0], 8) == -1).all()


def test_density_clusters_beyond_what_the_driver_holds(spark):
    rng = np.random.default_rng(5)
    x = np.vstack([c + 0.08 * rng.normal(size=(40, 8)) for c in np.eye(8)[:5]] + [rng.normal(size=(30, 8))])
    x = x[rng.permutation(len(x))]
    df = spark.createDataFrame([(f"f{i:04d}", v.tolist()) for i, v in enumerate(x)], "id string, vector array<double>").repartition(5)
    want = hdbscan.labels_of(x, 8).tolist()
    assert len(set(want)) > 4
    for block in (23, 100, 229, 500):  # 11, 3, 2 and 1 blocks, so that trees are merged in rounds, once, and not at all
        got = hdbscan.cluster(df, 8, most=100, block=block).orderBy("id").collect()
        assert [r["label"] for r in got] == want and [r["id"] for r in got] == [f"f{i:04d}" for i in range(len(x))], block


def test_stage_takes_more_focuses_than_the_driver_holds(spark, monkeypatch):
    n = hdbscan.MOST_VECTORS + 1
    taken = []
    monkeypatch.setattr(hdbscan, "_cluster_by_blocks", lambda df, size, block: taken.append(df.count()) or df)
    hdbscan.cluster(spark.range(n).select("id", F.array(F.lit(1.0)).alias("vector")))
    assert taken == [n]


def test_layout_of_few_pages(spark):
    df = spark.createDataFrame([("b", [1.0, 0.0]), ("a", [0.0, 1.0])], "version_id string, v array<double>")
    assert [tuple(r) for r in layout.positions(df).orderBy("version_id").collect()] == [("a", 0.0, 0.0), ("b", 1.0, 0.0)]
    assert layout.positions(df.limit(0)).count() == 0


def test_merge_similar(spark):
    c = spark.createDataFrame([(0, [1.0, 0.0], 2), (1, [0.99, 0.1], 1), (2, [0.0, 1.0], 5)], "topic int, c array<double>, n bigint")
    assert topics.merge_similar(c, 0.85) == {0: 0, 1: 0, 2: 2}


def test_merge_similar_takes_any_number_of_topics(spark):
    rng = np.random.default_rng(2)
    x, n = rng.normal(size=(60, 4)), rng.integers(1, 9, size=60)
    c = spark.createDataFrame([(2 * i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(x, n))], "topic int, c array<double>, n bigint")
    into, total = {2 * i: 2 * i for i in range(60)}, {2 * i: v * k for i, (v, k) in enumerate(zip(x, n))}
    while True:  # by all pairs
        unit = {i: v / np.linalg.norm(v) for i, v in total.items()}
        best, a, b = max((float(unit[i] @ unit[j]), i, j) for i in total for j in total if i < j)
        if best < 0.9:
            break
        total[a] = total[a] + total.pop(b)
        into = {t: a if u == b else u for t, u in into.items()}
    assert topics.merge_similar(c, 0.9) == into and 5 < len(set(into.values())) < 55
    many = spark.range(5_001).select(F.col("id").cast("int").alias("topic"), F.array(*[F.randn(k) for k in range(16)]).alias("c"), F.lit(2).alias("n"))
    assert topics.merge_similar(many, 0.99999) == {k: k for k in range(5_001)}


def test_labels_look_beyond_their_first_candidates(spark):
    rows = [(0, f"w{i:02d}", 10.0 - i) for i in range(9)] + [(1, f"w{i:02d}", 10.0 - i) for i in range(9)] + [(1, "late", 0.1), (2, "w00 w01", 5.0)]
    scores = spark.createDataFrame(rows, "topic int, term string, score double")
    want = {0: "w00, w01, w02", 1: "w03, w04, w05", 2: "theme 2"}
    assert topics.pick_labels(scores, [0, 1, 2], candidates=1) == topics.pick_labels(scores, [0, 1, 2]) == want


def test_hot_url_folds_over_its_days(spark):
    import random

    rng = random.Random(7)
    rows, state = [], {}
    for k in range(400):
        url = "hot" if k % 3 else f"u{k % 7}"
        status = rng.choice([200, 200, 304])
        h = rng.choice("abc") if status == 200 else state.get(url, "a")
        state[url] = h
        rows.append((url, f"2026-01-{1 + k // 40:02d}T{k % 40:02d}:00", status, h, None if h == "c" and rng.random() < 0.5 else f"k{h}", f"r{k:03d}"))
    rows += rows[:5]  # repeated rows count once
    fetches = spark.createDataFrame(rows, "url string, fetched_at string, status bigint, content_hash string, raw_object_key string, run_id string").repartition(4)
    body = {"ka": "x\n" * 99 + "a", "kb": "x\n" * 99 + "b", "kc": "quite other"}  # a and b differ trivially
    texts = spark.createDataFrame([(u, k, t, None) for u in {r[0] for r in rows} for k, t in body.items()], "url string, raw_object_key string, text string, stated_date string")
    none = "url string, version_id string, first_seen string, last_seen string, text_md string, content_hash string, text_hash string, stated_date string"
    latest = spark.createDataFrame([("u1", "old", "t", "2026-01-01T05:00", "quite other", "c", "h", None)], none)
    want = set()
    for url in {r[0] for r in rows}:
        cur = ("old", "t", "quite other", "c") if url == "u1" else None
        for _, at, status, h, key, _ in sorted({r for r in rows if r[0] == url and not (url == "u1" and r[1] <= "2026-01-01T05:00")}, key=lambda r: r[1]):
            text = body.get(key)
            if cur and (status == 304 or h == cur[3]):
                action = "unchanged"
            elif text is None:
                action = "error"
            elif cur and (text == cur[2] or not versions.changed_meaningfully(cur[2], text, 0.98)):
                action, cur = "unchanged", (*cur[:3], h)
            else:
                action, cur = "new", (None, at, text, h)
            want.add((url, at, action, cur[1] if cur and action != "error" else None))
    got = versions.fold_versions(fetches, latest, texts).select("url", "last_seen", "action", "first_seen").collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want and {a for _, _, a, _ in want} == {"new", "unchanged", "error"}
    empty = versions.fold_versions(fetches.limit(0), latest.limit(0), texts.limit(0))
    assert empty.count() == 0


def test_html():
    html = "<html><head><title>t</title></head><body><nav>menu</nav><h2>Now</h2><p>Some <b>bold</b> text<br>next</p><ul><li>one</li></ul><div id='x'><p>part</p></div><footer>f</footer></body></html>"
    assert main_text_of("https://a.example", html) == "## Now\n\nSome bold text\nnext\n\n- one\n\npart"
    assert main_text_of("https://a.example#x", html) == "part" and "bold" in main_text_of("https://a.example#none", html)
    assert main_text_of("https://a.example", "") == ""


def test_config_is_strict():
    assert Tuning.from_dict({"cluster": {"min_cluster_size": 4}}).cluster.min_cluster_size == 4
    for bad in ({"clusters": {}}, {"cluster": {"typo": 1}}, {"enrich": {"domains": ["work"]}}):
        with pytest.raises(ValueError):
            Tuning.from_dict(bad)


def test_store(spark, tmp_path):
    from pageatlas.sources.store import Store

    s = Store(spark, str(tmp_path))
    s.write_bytes("a/b.bin", b"\x00x")
    assert s.read_bytes("a/b.bin") == b"\x00x" and s.list("a") == ["a/b.bin"] and s.list("zz") == []
    s.delete("a/b.bin")
    s.delete("a/b.bin")
    assert not s.exists("a/b.bin") and s.read_text("none") is None
    assert s.read_table("t", "k bigint").count() == 0
    for k in range(3):
        s.write_table("t", s.read_table("t", "k bigint").unionByName(spark.createDataFrame([(k,)], "k bigint")))
    assert sorted(r["k"] for r in s.read_table("t", "k bigint").collect()) == [0, 1, 2]
    s.append("p", spark.createDataFrame([(1,)], "k int"), "one")
    s.append("p", spark.createDataFrame([(2.0, "x")], "k double, z string"), "two")
    assert sorted(map(tuple, s.read_parts("p", "k double, z string").collect()), key=str) == [(1.0, None), (2.0, "x")]


def test_engine_end_to_end(spark, tmp_path):
    from pageatlas.engine import Engine

    e = Engine(spark, str(tmp_path), Tuning.from_dict({"cluster": {"min_cluster_size": 4, "min_topic_pages": 2}}))
    lines = "\n".join(f"P{i}\tRome\t\tX\t\t\t\thttps://h{i}.example/now" for i in range(10)) + "\nQ\tUlm\t\tX\t\t\t\thttps://denied.example/"
    assert e.directory(lines, "2026-01-01") == {"rows": 11, "new": 11, "changed": 0, "removed": 0}
    with pytest.raises(ValueError):
        e.directory("nothing", "2026-01-02")
    e.store.write_text("denylist.txt", "denied.example\n")

    def fetcher(base, etag, modified):
        i = int(base[9]) if base[9].isdigit() else 0
        if etag == "e1":
            return {"status": 304}
        if i == 8:
            return {"status": 500}
        if i == 9:
            return {"status": 200, "content_type": "text/html", "body": '<meta name="robots" content="noarchive">x'}
        body = f"<p>{'apples and pears ' if i % 2 else 'rivers with boats '}{'word ' * 60}{i}</p>"
        return {"status": 200, "content_type": "text/html", "body": body, "etag": "e1"}

    r = e.crawl(fetcher)
    assert (r["attempted"], r["ok"], r["failed"], r["skipped"], r["errors"]) == (9, 8, 1, 2, {"http_500": 1, "noarchive": 1, "denylist": 1})
    assert (x := e.extract())["new_versions"] == 8 and x["errors"] == 0
    again = e.crawl(fetcher)
    assert again["not_modified"] == 8
    assert e.extract()["new_versions"] == 0

    def enricher(text):
        fruit = "apples" in text
        f = {"domain": "rest", "summary": "eating apples daily" if fruit else "sailing boats slowly", "tags": ["food" if fruit else "water"], "status": "ongoing", "sensitive": False}
        if text.rstrip().endswith("7"):
            f["domain"] = "nonsense"
        return json.dumps({"language": "en", "richness": 0.5, "stated_location": "", "focuses": [f, f], "life_transitions": ["moved", "bogus"], "values": [], "tone": "", "quotes": ["word word", "made up"]})

    assert e.enrich(enricher) == {"candidates": 8, "enriched": 7, "failed": 1, "focuses": 14}
    stored = e._table("extractions").first()["json"]
    assert json.loads(stored)["quotes"] == ["word word"] and json.loads(stored)["life_transitions"] == ["moved"]
    assert e.enrich(enricher)["candidates"] == 1

    def encoder(texts):
        return [[1.0, 0.01 * k] + [0.0] * 61 + [0.0] if "apples" in t else [0.0, 0.01 * k, 1.0] + [0.0] * 61 for k, t in enumerate(texts)]

    assert e.embed(encoder) == {"candidates": 14, "embedded": 14}
    assert e.embed(encoder)["embedded"] == 0
    report, points = e.cluster()
    assert report["points"] == 7 and report["clusters"] == 2 and report["noise"] == 0
    e.export(points, str(tmp_path / "export"))
    got = [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "export")).collect()]
    assert len(got) == 7 and got[0]["excerpt"] == "word word"
    assert e.read_export("map.json") is None
    e.export_document(report, points, "map.json")
    whole = json.loads(e.store.read_text([k for k in e.store.list("map.json") if k.endswith(".txt")][0]))
    assert whole["run_id"] == report["run_id"] and len(whole["points"]) == 7 and [t["id"] for t in whole["topics"]] == [0, 1] and all(t["label"] and t["pages"] > 1 for t in whole["topics"])
    seen_topics, seen = e.read_export("map.json")
    assert seen_topics == report["topics"] and {r["id"] for r in seen.collect()} == {p["id"] for p in whole["points"]}
    assert seen.where("size(topics) > 0 and topics[0].weight = 1.0").count() == 7
    e.export_document(report, points.limit(0), "none.json")
    assert e.read_export("none.json") is None
    assert e._table("layouts").count() == 7


def test_bodies_are_bytes_and_keep_their_headers(spark, tmp_path):
    from pageatlas.engine import Engine

    e = Engine(spark, str(tmp_path))
    listing = "A\tRome\t\tX\t\t\t\thttps://a.example/\nB\tUlm\t\tX\t\t\t\thttps://b.example/"
    with pytest.raises(ConnectionError):
        e.fetch_directory(lambda *a: {"status": 404}, "https://list.example", "2026-01-01")
    assert e.fetch_directory(lambda *a: {"status": 200, "body": listing.encode("utf-16"), "content_type": "text/plain; charset=utf-16"}, "https://list.example", "2026-01-01")["rows"] == 2
    latin = ("<p>" + "café à la crème " * 30 + "</p>").encode("latin-1")

    def fetcher(base, etag, modified):
        if "b." in base:
            return {"status": 200, "content_type": "text/html", "body": b"<meta name='robots' content='NOARCHIVE'>\xff"}
        return {"status": 200, "content_type": "text/html; charset=latin-1", "body": latin, "headers": {"Date": "today", "Set-Cookie": "no", "ETag": "t"}}

    r = e.crawl(fetcher)
    assert (r["ok"], r["errors"]) == (1, {"noarchive": 1})
    raw = e.store.read_parts("raw", "raw_object_key string, body binary, final_url string, status bigint, headers map<string,string>").collect()
    import hashlib

    assert [(bytes(x["body"]), x["status"], x["headers"]) for x in raw] == [(latin, 200, {"content-type": "text/html; charset=latin-1", "date": "today", "etag": "t"})]
    logged = e.store.read_parts("fetches", "url string, content_hash string, bytes bigint").where("content_hash is not null").first()
    assert logged["content_hash"] == hashlib.sha256(latin).hexdigest() and logged["bytes"] == len(latin)
    assert e.extract()["new_versions"] == 1 and e._table("versions").first()["text_md"].startswith("café à la crème")


def _versions(spark, n):
    rows = [(f"v{i}", f"https://h{i}.example", "t1", f"page {i} says that", False) for i in range(n)]
    v = spark.createDataFrame(rows, "version_id string, url string, last_seen string, text_md string, needs_js boolean")
    from pageatlas.schemas import SCHEMAS

    return v.select([F.col(c.split()[0]) if c.split()[0] in v.columns else F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in SCHEMAS["versions"].split(", ")])


def _answering():
    def answer(text):  # inside, so that it travels to the workers with its code
        f = {"domain": "work", "summary": text, "tags": [], "status": "ongoing", "sensitive": False}
        return json.dumps({"language": "en", "richness": 1, "stated_location": "", "focuses": [f], "life_transitions": [], "values": [], "tone": "", "quotes": []})

    return answer


def test_an_interrupted_enrichment_keeps_what_it_wrote(spark, tmp_path, monkeypatch):
    from pageatlas.engine import Engine

    answer = _answering()
    e = Engine(spark, str(tmp_path), Tuning.from_dict({"enrich": {"concurrency": 2, "checkpoint_every": 2}}))
    e.store.write_table("versions", _versions(spark, 10))
    write, calls = e.store.append, []

    def append(name, df, part):
        calls.append(name)
        if calls.count("extractions") == 2 and name == "extractions":
            raise KeyboardInterrupt
        write(name, df, part)

    monkeypatch.setattr(e.store, "append", append)
    with pytest.raises(KeyboardInterrupt):
        e.enrich(answer)
    monkeypatch.undo()
    assert e._table("extractions").count() == 4 and e._table("focuses").count() == 4  # the second batch is half written and not seen
    assert e.enrich(answer) == {"candidates": 6, "enriched": 6, "failed": 0, "focuses": 6}
    assert {r["focus_id"] for r in e._table("focuses").collect()} == {f"v{i}:0" for i in range(10)} and e._table("focuses").count() == 10
    assert e.enrich(answer) == {"candidates": 10, "enriched": 0, "failed": 0, "focuses": 0}


def test_schema_and_prompt_follow_the_configuration():
    from pageatlas.operators import enrich

    cfg = Tuning.from_dict({"enrich": {"domains": ["kites", "other"], "statuses": ["new"], "max_focuses": 3, "summary_words": 17, "sensitive_topics": ["debts"]}}).enrich
    schema = enrich.enrichment_schema(cfg)
    focus = schema["properties"]["focuses"]["items"]
    assert focus["properties"]["domain"]["enum"] == ["kites", "other"] and focus["properties"]["status"]["enum"] == ["new"]
    assert schema["properties"]["life_transitions"]["items"]["enum"] == list(cfg.life_transitions)
    assert not schema["additionalProperties"] and not focus["additionalProperties"] and set(schema["required"]) == set(schema["properties"])
    prompt = enrich.system_prompt(cfg)
    assert all(w in prompt for w in ("kites", "at most 3", "17 words", "debts", "do not do it"))
    seen = []
    assert enrich.prompted(lambda *a: seen.append(a) or "{}", cfg)("hello") == "{}"
    assert seen == [(prompt, schema, "<page>\nhello\n</page>")]


def test_version_command(capsys):
    from pageatlas import __version__
    from pageatlas.__main__ import main

    assert main(["--verbose", "version"]) == 0 and capsys.readouterr().out.strip() == __version__


def test_streaming_versions(spark, tmp_path):
    from pageatlas.streaming.versions import stream_versions

    schema = "url string, fetched_at string, status bigint, content_hash string"
    rows = [("u", "t1", 200, "a"), ("u", "t2", 304, "a"), ("u", "t3", 200, "b"), ("v", "t1", 200, "c"), ("v", "t2", 404, None)]
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    q = stream_versions(stream).writeStream.outputMode("update").format("memory").queryName("stream_versions").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {tuple(r) for r in spark.sql("select * from stream_versions").collect()}
    assert got == {("u", "b", "t3", "t3"), ("v", "c", "t1", "t1")}


def test_nothing_but_its_own_package_imports_llm():
    import pathlib

    root = pathlib.Path(__file__).parent.parent / "pageatlas"
    for p in root.rglob("*.py"):
        if "llm" not in p.relative_to(root).parts:
            assert "pageatlas.llm" not in p.read_text()
