"""The directory: parsing it, one day's difference, and one day's update of the people table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pageatlas.functions.text import casefold, strip
from pageatlas.session import durable, numbered

FIELDS = ["name", "city", "state", "country", "created", "updated", "checked", "url"]
COMPARED = ["name", "city", "state", "country"]


def parse_directory(lines: DataFrame) -> DataFrame:
    """(file, line_no, FIELDS) from (file, line_no, line): tab-separated, each field stripped.

    A line counts if it has at least eight fields and its last begins with http:// or https://; the
    url is the eighth. Of a url's lines the first stays. Anything else is skipped.
    """
    f = F.transform(F.split("line", "\t"), strip)
    rows = lines.withColumn("f", f).where((F.size("f") >= len(FIELDS)) & F.element_at("f", -1).rlike("^https?://"))
    rows = rows.select("file", "line_no", *[F.get("f", F.lit(i)).alias(n) for i, n in enumerate(FIELDS)])
    first = F.min_by(F.struct("line_no", *[n for n in FIELDS if n != "url"]), F.col("line_no"))
    return rows.groupBy("file", "url").agg(first.alias("r")).select("file", "r.line_no", *[f"r.{n}" if n != "url" else "url" for n in FIELDS])


def read_directory(spark, path: str) -> DataFrame:
    """Lines of the directory files at ``path`` with their numbers."""
    text = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), "value")
    return text.select("file", F.posexplode(F.split("value", r"\r\n|[\n\r]")).alias("line_no", "line"))


def snapshot_frame(rows: DataFrame, day: str) -> DataFrame:
    return rows.select(F.lit(day).alias("snapshot_date"), *FIELDS)


def diff_snapshots(previous: DataFrame, current: DataFrame) -> DataFrame:
    """(url, change) between two snapshots of one row per url: new, removed, changed."""
    p, c = previous.select("url", F.struct(*COMPARED).alias("p")), current.select("url", F.struct(*COMPARED).alias("c"))
    change = F.when(F.col("p").isNull(), "new").when(F.col("c").isNull(), "removed").when(~F.col("p").eqNullSafe(F.col("c")), "changed")
    return p.join(c, "url", "full_outer").select("url", change.alias("change")).where(F.col("change").isNotNull())


def diff_days(rows: DataFrame, days: DataFrame) -> DataFrame:
    """(snapshot_date, url, change) between each two consecutive days, by the later one: new, removed, changed.

    ``rows``: parsed, with their ``day``; ``days``: (day, next_day), also such without rows."""
    r = rows.select("day", "url", F.struct(*COMPARED).alias("r")).join(days.select("day", "next_day", (F.lag("day").over(Window.orderBy("day")).isNotNull()).alias("later")), "day")  # a row per day
    p = r.where("next_day is not null").select(F.col("next_day").alias("snapshot_date"), "url", F.col("r").alias("p"))
    c = r.where("later").select(F.col("day").alias("snapshot_date"), "url", F.col("r").alias("c"))
    change = F.when(F.col("p").isNull(), "new").when(F.col("c").isNull(), "removed").when(~F.col("p").eqNullSafe(F.col("c")), "changed")
    return p.join(c, ["snapshot_date", "url"], "full_outer").select("snapshot_date", "url", change.alias("change")).where(F.col("change").isNotNull())


def person_id(url: Column) -> Column:
    return F.concat(F.lit("p_"), F.substring(F.sha1(url), 1, 12))


def update_people(people: DataFrame, rows: DataFrame, today: str) -> DataFrame:
    """The people table after the directory of ``today``.

    ``people``: its columns and ``seq``, the order of its rows; ``rows``: parsed, with line_no. Open
    rows whose url is gone close; those with another value in COMPARED close and open anew with the
    same id. A url that is not open takes the id it had, else the one last given to its name and city
    (by an earlier line today, else by the last row), else a hash. The sequential rule is a running
    last value over the lines of a place; new rows follow in order: changed ones, then new ones.
    """
    open_rows = people.where(F.col("valid_to").isNull())
    cur = rows.select("line_no", "url", *[F.col(c).alias(f"n_{c}") for c in COMPARED])
    fold = lambda n, c: F.concat_ws("\x1f", casefold(n), casefold(c))
    same = F.lit(True)
    for c in COMPARED:
        same = same & F.col(c).eqNullSafe(F.col(f"n_{c}"))
    fate = open_rows.join(cur, "url", "left").select(
        "seq", "url", "person_id", "line_no", *[f"n_{c}" for c in COMPARED],
        F.when(F.col("line_no").isNull(), "removed").when(~same, "changed").alias("fate"),
    )
    ended = people.join(fate.where("fate is not null").select("seq", "fate"), "seq", "left").withColumn(
        "valid_to", F.when(F.col("fate").isNotNull(), F.lit(today)).otherwise(F.col("valid_to"))
    )
    changed = fate.where("fate = 'changed'").select("person_id", "url", *[F.col(f"n_{c}").alias(c) for c in COMPARED], F.lit(1).alias("block"), F.col("seq").alias("pos"))
    fresh = cur.join(open_rows.select("url"), "url", "left_anti").withColumn("place", fold(F.col("n_name"), F.col("n_city")))
    by_url = people.groupBy("url").agg(F.max_by("person_id", "seq").alias("by_url"))
    by_place = people.groupBy(fold(F.col("name"), F.col("city")).alias("place")).agg(F.max_by("person_id", "seq").alias("by_place"))
    known = fresh.join(by_url, "url", "left").join(by_place, "place", "left")
    upto = Window.partitionBy("place").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    new = known.select(
        F.coalesce(F.last("by_url", ignorenulls=True).over(upto), F.col("by_place"), person_id(F.first("url").over(upto))).alias("person_id"),
        "url", *[F.col(f"n_{c}").alias(c) for c in COMPARED], F.lit(2).alias("block"), F.col("line_no").alias("pos"),
    )
    columns = ["person_id", "name", "url", "city", "state", "country", "valid_from", "valid_to", "block", "pos"]
    added = changed.unionByName(new).withColumn("valid_from", F.lit(today)).withColumn("valid_to", F.lit(None).cast("string"))
    return ended.withColumn("block", F.lit(0)).withColumn("pos", F.col("seq")).select(columns).unionByName(added.select(columns))


def applied_changes(people: DataFrame, rows: DataFrame) -> DataFrame:
    """(change, url), in order, of what ``update_people`` does with the day's rows: ``new`` urls had no open row,
    ``changed`` and ``removed`` ones have theirs closed."""
    open_rows = people.where(F.col("valid_to").isNull()).select("url", F.struct(*COMPARED).alias("was"))
    now = rows.select("url", F.struct(*COMPARED).alias("is"))
    change = F.when(F.col("was").isNull(), "new").when(F.col("is").isNull(), "removed").when(~F.col("was").eqNullSafe(F.col("is")), "changed")
    return open_rows.join(now, "url", "full_outer").select(change.alias("change"), "url").where(F.col("change").isNotNull()).distinct().orderBy("change", "url")


def update_people_daily(people: DataFrame, rows: DataFrame) -> DataFrame:
    """The people table, with ``seq``, after every day of ``rows`` (parsed, with ``day``) in order. Each day needs
    the table the day before left, so days follow one another; a day without a row changes nothing, as the
    directory stage refuses an empty directory."""
    rows = durable(rows)
    for r in rows.select("day").distinct().orderBy("day").collect():  # a row per day
        out = update_people(people, rows.where(F.col("day") == r["day"]), r["day"])
        people = durable(numbered(out, "place", "block", "pos").withColumn("seq", F.col("place") + 1).drop("block", "pos", "place"), replaces=people)
    return people
