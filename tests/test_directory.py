from pyspark.sql import functions as F

from pageatlas.operators import directory as d

HEAD = "Name\tCity\tState\tCountry\tCreated\tUpdated\tChecked\tURL"


def row(name, city, url, extra=""):
    return f" {name} \t{city}\t\tX\t2020\t2021\t2022\t{url}{extra}"


def parse(spark, text):
    lines = spark.createDataFrame([("f", i, x) for i, x in enumerate(text.split("\n"))], "file string, line_no int, line string")
    return d.parse_directory(lines)


def test_parse_skips_what_is_no_record(spark):
    text = "\n".join([HEAD, row("A", "Rome", "https://a.example"), "short\tline", "", row("B", "Ulm", "https://a.example"), row("C", "Ulm", "HTTP://c.example"), row("D", "Ulm", "x", "\thttp://d.example")])
    got = {r["url"]: r["name"] for r in parse(spark, text).collect()}
    assert got == {"https://a.example": "A", "x": "D"}


def test_diff(spark):
    a = parse(spark, "\n".join([row("A", "Rome", "https://a.example"), row("B", "Ulm", "https://b.example")]))
    b = parse(spark, "\n".join([row("A", "Oslo", "https://a.example"), row("C", "Ulm", "https://c.example")]))
    assert {(r["url"][8], r["change"]) for r in d.diff_snapshots(a, b).collect()} == {("a", "changed"), ("b", "removed"), ("c", "new")}


def test_update_people_keeps_identity_and_is_idempotent(spark):
    people = spark.createDataFrame([], "person_id string, name string, url string, city string, state string, country string, valid_from string, valid_to string, seq bigint")

    def step(people, text, day):
        from pyspark.sql import Window

        out = d.update_people(people, parse(spark, text), day)
        return spark.createDataFrame(out.withColumn("seq", F.row_number().over(Window.orderBy("block", "pos")).cast("bigint")).drop("block", "pos").toArrow())

    one = step(people, row("Ann", "Rome", "https://old.example"), "2025-01-01")
    two = step(one, row("ANN", "rome", "https://new.example"), "2025-01-02")
    three = step(two, row("ANN", "rome", "https://new.example"), "2025-01-03")
    rows = {r["url"][8:11]: r for r in three.collect()}
    assert three.count() == 2
    assert rows["old"]["valid_to"] == "2025-01-02" and rows["new"]["valid_to"] is None
    assert rows["old"]["person_id"] == rows["new"]["person_id"]


def test_queries_take_every_day_and_every_url(spark, tmp_path):
    import __spark_entry__

    cols = "snapshot_date string, delivery int, line_no int, name string, city string, state string, country string, created string, updated string, checked string, url string"
    one = lambda day, delivery, no, name, city, url: (day, delivery, no, name, city, "", "X", "", "", "", f"https://{url}.example")
    # dates of another year; of the second day only the later delivery counts
    shots = [one("2031-03-01", 1, 0, "Ann", "Rome", "a"), one("2031-03-02", 1, 0, "Ann", "Ulm", "a"), one("2031-03-02", 2, 0, "Ann", "Oslo", "a"), one("2031-03-02", 2, 1, "Bo", "Ulm", "b"),
             one("2031-03-03", 1, 0, "Bo", "Ulm", "b"), one("2031-03-04", 1, 0, "Bo", "Ulm", "b"), one("2031-03-04", 1, 1, "ANN", "oslo", "c")]
    spark.createDataFrame(shots, cols).write.parquet(f"{tmp_path}/directory_snapshots.parquet")
    people = [(f"p{k}", f"N{k}", f"https://u{k:03d}.example", "C", "", "X", "2030-01-01", "" if k % 2 else None) for k in range(70)]
    spark.createDataFrame(people, "person_id string, name string, url string, city string, state string, country string, valid_from string, valid_to string").write.parquet(f"{tmp_path}/people.parquet")
    q = __spark_entry__.queries()
    got = sorted((r["snapshot_date"][-2:], r["url"][8], r["change"]) for r in q["b3_all_days"](spark, str(tmp_path)).collect())
    assert got == [("02", "a", "changed"), ("02", "b", "new"), ("03", "a", "removed"), ("04", "c", "new")]
    rows = q["b10_all_days"](spark, str(tmp_path)).where("valid_from > '2031'").orderBy("seq").collect()
    ann = d.person_id(F.lit("https://a.example"))
    ann = spark.range(1).select(ann).first()[0]
    assert [(r["url"][8], r["city"], r["valid_from"][-2:], r["valid_to"] and r["valid_to"][-2:]) for r in rows] == [("a", "Rome", "01", "02"), ("a", "Oslo", "02", "03"), ("b", "Ulm", "02", None), ("c", "oslo", "04", None)]
    assert [r["person_id"] == ann for r in rows] == [True, True, False, True]
    assert [r["url"] for r in q["c6_all_targets"](spark, str(tmp_path)).collect()] == [p[2] for p in people]
