"""The full history of changing entity attributes (a type-2 table), from periodic snapshots."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pageatlas.functions.text import directory_keys, strip
from pageatlas.operators.snapshots import ATTRIBUTES, candidate_lines, snapshot_days
from pageatlas.session import durable

#: Lines of one day and place that one task scans in order; beyond it the scan is in two levels.
SCAN_LINES = 50_000


def day_records(snapshots: DataFrame, days: DataFrame | None = None) -> DataFrame:
    """(day_no, url, line_no, attrs, place): of several lines for one url and day the lowest."""
    lines = candidate_lines(snapshots, days).withColumn("k", directory_keys(*ATTRIBUTES))
    return (
        lines.groupBy("day_no", "url")
        .agg(F.min(F.struct("line_no", F.col("k.attrs").alias("attrs"), F.col("k.place").alias("place"))).alias("r"))
        .select("day_no", "url", "r.*")
    )


def fold_versions(entities: DataFrame, last_day_no) -> DataFrame:
    """Fold each entity's sorted ``obs`` into versions, appending one only upon change.

    ``obs`` holds struct(day_no, line_no, attrs, place), at most one per day, so an array is as long
    as there are days; day_no 0 is the period that was open before the first snapshot. A version
    ends on the first day that lacks the entity or shows other attributes. Adds ``versions``:
    array of struct(begin, finish (null: current), line_no, attrs, place, how), how = ``open`` for
    the carried period, ``changed`` for one that follows without a gap, else ``listed``.
    """
    version_type = (
        "array<struct<begin:int,finish:int,line_no:bigint,attrs:string,place:string,how:string,seen:int>>"
    )

    def version(o, how):
        return F.struct(
            o["day_no"].alias("begin"), F.lit(None).cast("int").alias("finish"), o["line_no"].alias("line_no"),
            o["attrs"].alias("attrs"), o["place"].alias("place"), how.alias("how"), o["day_no"].alias("seen"),
        )

    def ended(v, finish, seen):
        return F.array(v.withField("finish", finish.cast("int")).withField("seen", seen))

    def step(acc, o):
        n = F.size(acc)
        last = F.element_at(acc, -1)
        rest = F.slice(acc, 1, F.greatest(n - 1, F.lit(0)))
        gap = o["day_no"] > last["seen"] + 1
        return (
            F.when(n == 0, F.array(version(o, F.when(o["day_no"] == 0, "open").otherwise("listed"))))
            .when(gap, F.concat(rest, ended(last, last["seen"] + 1, last["seen"]), F.array(version(o, F.lit("listed")))))
            .when(
                last["attrs"] != o["attrs"],
                F.concat(rest, ended(last, o["day_no"], last["seen"]), F.array(version(o, F.lit("changed")))),
            )
            .otherwise(F.concat(rest, F.array(last.withField("seen", o["day_no"]))))
        )

    folded = F.aggregate(F.sort_array("obs"), F.array().cast(version_type), step)
    closed = F.transform(
        folded,
        lambda v: v.withField(
            "finish", F.when(v["finish"].isNull() & (v["seen"] < last_day_no), v["seen"] + 1).otherwise(v["finish"])
        ),
    )
    return entities.withColumn("versions", closed)


def _previous_in_scan(rows: DataFrame) -> DataFrame:
    """Per (place, begin), for each opened url the last *returning* url on an earlier line.

    Two levels, so that no task has to order more than SCAN_LINES lines of a crowded place: within
    chunks of lines, then over the chunks' last values.
    """
    rows = rows.withColumn("chunk", F.floor(F.col("line_no") / SCAN_LINES))
    returning = F.when(F.col("is_known"), F.col("url"))
    inner = Window.partitionBy("place", "begin", "chunk").orderBy("line_no", "url").rowsBetween(
        Window.unboundedPreceding, -1
    )
    per_chunk = rows.groupBy("place", "begin", "chunk").agg(
        F.max(F.when(F.col("is_known"), F.struct("line_no", "url")))["url"].alias("chunk_last")
    )
    outer = Window.partitionBy("place", "begin").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_chunk.select(
        "place", "begin", "chunk", F.last("chunk_last", ignorenulls=True).over(outer).alias("carried")
    )
    return (
        rows.withColumn("inner_last", F.last(returning, ignorenulls=True).over(inner))
        .join(carried, ["place", "begin", "chunk"])
        .withColumn("before", F.coalesce("inner_last", "carried"))
    )


def attribute_history(people: DataFrame, snapshots: DataFrame) -> DataFrame:
    """(person_id, url, valid_from, valid_to): the history in ``people`` carried on through all days.

    Each url's observations fold into versions (``fold_versions``). A url seen before keeps its
    person_id. Any other takes the one last given to its name and city: that of an earlier line of
    the day which opened a period, else of the latest period begun before (of periods begun on one
    day, those that opened a url come after those that changed one, then the later line); else the
    hash of its url. Each such url points at one url first listed on an earlier day, so owners
    resolve by pointer doubling in as many rounds as the logarithm of the number of days.

    Exact duplicate rows count once. If a url has several open rows the latest valid_from is
    carried on and the others end where the url's next period begins or on the first day. Null
    urls have no history. Empty snapshots return ``people``; empty people start from nothing.
    """
    spark = people.sparkSession
    # read once: the days, a row each, and the rows of people, whose keys are costly
    all_days = durable(snapshot_days(snapshots))
    days = all_days.select("day_no", "day")
    last = days.agg(F.coalesce(F.max("day_no"), F.lit(0)).alias("last_day_no"))
    known = durable(
        people.select("person_id", strip(F.col("url")).alias("url"), *ATTRIBUTES, "valid_from", "valid_to")
        .distinct()
        .where(F.col("url").isNotNull())
        .withColumn("is_open", F.coalesce(F.col("valid_to"), F.lit("")) == "")
        .withColumn("k", directory_keys(*ATTRIBUTES))
        .select("person_id", "url", "valid_from", "valid_to", "is_open", "k.attrs", "k.place")
    )
    open_row = F.max(
        F.when(F.col("is_open"), F.struct("valid_from", "person_id", "attrs", "place"))
    ).alias("open_row")
    owners = known.groupBy("url").agg(
        open_row, F.max(F.struct("valid_from", "person_id"))["person_id"].alias("known_id")
    )
    carried = owners.where(F.col("open_row").isNotNull()).select(
        "url", F.lit(0).alias("day_no"), F.lit(-1).cast("long").alias("line_no"),
        F.col("open_row.attrs").alias("attrs"), F.col("open_row.place").alias("place"),
    )
    records = day_records(snapshots, all_days)
    observed = carried.unionByName(records.select(carried.columns))
    entities = observed.groupBy("url").agg(
        F.collect_list(F.struct("day_no", "line_no", "attrs", "place")).alias("obs")
    )
    versions = fold_versions(entities.crossJoin(F.broadcast(last)), F.col("last_day_no"))
    periods = durable(
        versions.select("url", F.explode("versions").alias("v"))
        .select("url", "v.begin", "v.finish", "v.line_no", "v.place", "v.how")
        .join(owners.select("url", "known_id", F.col("open_row.valid_from").alias("open_from")), "url", "left")
    )

    # events that give a person_id to a place: periods of people (negative order keys), then new ones
    first_seen = periods.groupBy("url").agg(
        F.min_by("begin", F.struct("begin", "line_no")).alias("first_begin")
    )
    opened = periods.where(F.col("how") == "listed").join(first_seen, "url")
    is_known = F.col("known_id").isNotNull() | (F.col("begin") > F.col("first_begin"))
    opened = opened.withColumn("is_known", is_known)
    new_urls = opened.where(~F.col("is_known"))

    dated = periods.where(F.col("begin") > 0).join(days, F.col("begin") == F.col("day_no")).select(
        "place", F.col("day").alias("at"), (F.col("how") == "listed").cast("int").alias("rank"),
        "line_no", "url", F.lit(None).cast("string").alias("given"),
    )
    past = known.select(
        "place", F.coalesce("valid_from", F.lit("")).alias("at"), F.lit(0).alias("rank"),
        F.lit(-1).cast("long").alias("line_no"), "url", F.col("person_id").alias("given"),
    )
    last_of_day = (
        dated.unionByName(past)
        .groupBy("place", "at")
        .agg(F.max(F.struct("rank", "line_no", "url", "given")).alias("e"))
    )
    # one row per place and day remains: ordering a place's days is bounded by the calendar
    wanted = new_urls.join(days, F.col("begin") == F.col("day_no")).select("place", F.col("day").alias("at")).distinct()
    by_day = Window.partitionBy("place").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    before_day = (
        last_of_day.join(wanted.withColumn("is_wanted", F.lit(True)), ["place", "at"], "left")
        .withColumn("prior", F.last("e", ignorenulls=True).over(by_day))
        .where("is_wanted")
        .join(days, F.col("at") == F.col("day"))
        .select("place", F.col("day_no").alias("begin"), "prior")
    )
    first_new = new_urls.groupBy("place", "begin").agg(
        F.min_by("url", F.struct("line_no", "url")).alias("first_new")
    )
    scanned = _previous_in_scan(opened.select("place", "begin", "line_no", "url", "is_known"))
    pointed = (
        scanned.where(~F.col("is_known"))
        .join(first_new.join(before_day, ["place", "begin"], "left"), ["place", "begin"])
        .select(
            "url",
            F.when(F.col("before").isNotNull(), F.col("before"))
            .when(F.col("prior").isNotNull(), F.col("prior.url"))
            .alias("parent"),
            F.when(F.col("before").isNull(), F.col("prior.given")).alias("given"),
            F.concat(F.lit("p_"), F.substring(F.sha1("first_new"), 1, 12)).alias("own"),
        )
    )
    # a parent that people knows has its owner at once; one that is itself new is followed
    parents = owners.select(F.col("url").alias("parent"), F.col("known_id").alias("parent_id"))
    links = durable(
        pointed.join(parents, "parent", "left").select(
            "url",
            F.when(F.col("parent").isNull(), F.col("own"))
            .otherwise(F.coalesce("given", "parent_id"))
            .alias("owner"),
            "parent",
        )
    )
    most = 2 + (all_days.count()).bit_length()  # a link leads to an earlier day
    for doubled in itertools.count():
        if links.where(F.col("owner").isNull()).isEmpty():
            break
        if doubled > most:
            raise RuntimeError("owners point at each other in a circle")
        up = links.select(
            F.col("url").alias("parent"), F.col("owner").alias("up_owner"), F.col("parent").alias("up_parent")
        )
        links = durable(
            links.join(up, "parent", "left").select(
                "url", F.coalesce("owner", "up_owner").alias("owner"), F.coalesce("up_parent", "parent").alias("parent")
            ),
            replaces=links,
        )

    begin_days, end_days = (
        days.select(F.col("day_no").alias(k), F.col("day").alias(v))
        for k, v in (("begin", "begin_day"), ("finish", "finish_day"))
    )
    carried_on = (
        periods.join(links.select("url", "owner"), "url", "left")
        .join(begin_days, "begin", "left")
        .join(end_days, "finish", "left")
        .select(
            F.coalesce("known_id", "owner").alias("person_id"),
            "url",
            F.when(F.col("begin") == 0, F.col("open_from")).otherwise(F.col("begin_day")).alias("valid_from"),
            F.coalesce("finish_day", F.lit("")).alias("valid_to"),
        )
    )
    # periods of people that were closed, and open ones beside the carried one
    first_new_begin = periods.where(F.col("begin") > 0).groupBy("url").agg(F.min("begin").alias("begin"))
    first_day = days.where(F.col("day_no") == 1).select(F.col("day").alias("first_day"))
    kept = (
        known.join(owners.select("url", "open_row"), "url")
        .where(
            ~F.col("is_open")
            | (F.struct("valid_from", "person_id", "attrs", "place") < F.col("open_row"))
        )
        .join(first_new_begin.join(begin_days, "begin"), "url", "left")
        .crossJoin(F.broadcast(first_day.agg(F.max("first_day").alias("first_day"))))
        .select(
            "person_id",
            "url",
            "valid_from",
            F.when(~F.col("is_open"), F.col("valid_to"))
            .otherwise(F.coalesce("begin_day", "first_day", F.lit("")))
            .alias("valid_to"),
        )
    )
    return carried_on.unionByName(kept)
