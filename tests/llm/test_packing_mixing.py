import random
from collections import defaultdict

from pyspark.sql import functions as F

from pageatlas.llm import mixing, packing, tokens


def test_pack_keeps_every_token_and_no_container_overflows(spark):
    rng = random.Random(1)
    sizes = {i: rng.choice([0, 1, 30, 64, 65, 129, 500, rng.randint(1, 64)]) for i in range(150)}
    sized = spark.createDataFrame([*sizes.items(), (999, None)], "doc_id bigint, n_tokens bigint").withColumn("bin", F.lit("clash"))
    caps = spark.createDataFrame([("small", 64), ("small", 64), ("wide", 256), (None, 8), ("none", 0)], "container_kind string, capacity_tokens int")
    packed = packing.pack(sized, caps, items_per_part=40)
    rows = packed.collect()
    for kind, cap in (("small", 64), ("wide", 256)):
        mine = [r for r in rows if r["container_kind"] == kind]
        total, fill = defaultdict(int), defaultdict(int)
        for r in mine:
            total[r["doc_id"]] += r["n_tokens"]
            if r["container"] is not None:
                fill[r["container"]] += r["n_tokens"]
        assert dict(total) == {**sizes, 999: 0} and max(fill.values()) <= cap
        pieces = defaultdict(list)
        for r in mine:
            pieces[r["doc_id"]].append((r["start_token"], r["n_tokens"]))
        assert all(len(p) == 1 for i, p in pieces.items() if sizes.get(i, 0) <= cap)
        for p in pieces.values():  # pieces of a document follow one another
            p.sort()
            assert all(a + n == b for (a, n), (b, _) in zip(p, p[1:]))
        assert len(fill) <= -(-sum(sizes.values()) // cap) * 1.05 + 2
    assert {r["container_kind"] for r in rows} == {"small", "wide"}
    report = {r["container_kind"]: r for r in packing.pack_report(packed, caps).collect()}
    assert report["small"]["fill"] > 0.93
    assert packing.pack(sized.limit(0), caps).count() == 0


def test_pack_writes_no_table_between_rounds(spark, monkeypatch):
    # on a local disk every file starts a few programs, and each of them is for a moment a second process as large as the executor
    files, durable = [], packing.durable

    def counted(df):
        out = durable(df)
        files.append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(packing, "durable", counted)
    monkeypatch.setattr(packing, "PASSES", 1)
    sized = spark.createDataFrame([(i, 1 + i * 37 % 60) for i in range(400)], "doc_id bigint, n_tokens bigint")
    caps = spark.createDataFrame([("small", 64)], "container_kind string, capacity_tokens int")
    rows = packing.pack(sized, caps, items_per_part=5).collect()
    assert len(rows) == 400 and 0 < sum(files) < 400 // 5 * packing.ISLANDS // packing.ISLANDS_A_TASK  # fewer than one round has tasks
    again = packing.pack(sized.repartition(7), caps, items_per_part=5).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))


def test_crossover_keeps_items():
    rng = random.Random(3)
    sizes = {i: rng.randint(1, 60) for i in range(80)}
    a = packing.best_fit(sizes, list(sizes), [], 100)
    b = packing.best_fit(sizes, [i for i in sizes if i % 2], [], 100)
    b = packing.best_fit(sizes, [i for i in sizes if i % 2 == 0], b, 100)
    child = packing.crossover(sizes, a, b, 100, rng)
    assert sorted(i for g in child for i in g) == sorted(sizes) and all(sum(sizes[i] for i in g) <= 100 for g in child)


def test_mix_reaches_shares_to_the_token(spark):
    rows = [(i, "big" if i < 600 else "mid" if i < 680 else "tiny" if i < 690 else "none", 7 + i % 50) for i in range(700)] + [(700, "big", 0), (701, "mid", None)]
    sized = spark.createDataFrame(rows, "doc_id bigint, source string, n_tokens bigint").withColumn("range", F.lit("clash"))
    targets = spark.createDataFrame([("big", 0.5, 1), ("mid", 0.3, 2), ("tiny", 0.1, 4), ("absent", 0.1, 3), (None, 0.2, 1)], "source string, target_share double, max_repeats int")
    budgets = {r["source"]: r for r in mixing.source_budgets(sized, targets).collect()}
    mixed = mixing.mix_sources(sized, targets, bucket_records=50)
    got = defaultdict(int)
    copies = defaultdict(set)
    for r in mixed.collect():
        got[r["source"]] += r["take_tokens"]
        copies[(r["source"], r["doc_id"])].add(r["epoch"])
        assert 0 <= r["take_tokens"] <= r["n_tokens"]
    assert {s: got[s] for s in ("big", "mid", "tiny")} == {s: budgets[s]["budget"] for s in ("big", "mid", "tiny")} and set(got) == {"big", "mid", "tiny"}
    total = sum(got.values())
    assert abs(got["big"] / total - 0.5 / 0.9) < 1e-3 and abs(got["tiny"] / total - 0.1 / 0.9) < 1e-3
    assert max(max(e) for (s, _), e in copies.items() if s == "big") == 0 and max(max(e) for (s, _), e in copies.items() if s == "tiny") <= 3
    again = mixing.mix_sources(sized.repartition(7), targets, bucket_records=50)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, mixed.collect()))
    report = {r["source"]: r for r in mixing.mix_report(mixed, mixing.source_budgets(sized, targets)).collect()}
    assert report["absent"]["actual_share"] == 0.0 and report["big"]["tokens"] == got["big"]
    assert mixing.mix_sources(sized.limit(0), targets).count() == 0 and mixing.mix_sources(sized, targets.limit(0)).count() == 0
    capped = mixing.mix_sources(sized, targets, total_tokens=10**6).groupBy("source").agg(F.max("epoch").alias("e")).collect()
    assert {r["source"]: r["e"] for r in capped}["big"] == 0


def test_tokens(spark):
    docs = spark.createDataFrame([(1, "Open_Shelf ", "hello world <|endoftext|>"), (1, "Open_Shelf ", "hello world <|endoftext|>"), (2, None, None), (3, "open shelf", "word " * 60_000), (None, "x", "y")], "doc_id bigint, source string, text string")
    got = {r["doc_id"]: (r["source"], r["n_tokens"]) for r in tokens.sized_documents(docs).collect()}
    assert got[2] == ("", 0) and got[1][0] == got[3][0] == "open-shelf" and got[1][1] > 2
    assert abs(got[3][1] - 60_001) <= 2 and set(got) == {1, 2, 3}
