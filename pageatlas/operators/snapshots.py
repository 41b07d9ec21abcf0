"""Full snapshots delivered periodically: their records, and what changed between them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pageatlas.functions.text import directory_keys, strip

ATTRIBUTES = ["name", "city", "state", "country"]


def snapshot_days(snapshots: DataFrame) -> DataFrame:
    """(day, delivery, day_no, next_day): one row per distinct ``snapshot_date`` with its highest
    delivery. One row per calendar day, so ordering them in one task is bounded by the calendar."""
    days = (
        snapshots.where(F.col("snapshot_date").isNotNull())
        .groupBy(F.col("snapshot_date").alias("day"))
        .agg(F.max(F.coalesce("delivery", F.lit(-1))).alias("delivery"))
    )
    w = Window.orderBy("day")
    return days.select(
        "day",
        "delivery",
        F.row_number().over(w).alias("day_no"),
        F.lead("day").over(w).alias("next_day"),
    )


def candidate_lines(snapshots: DataFrame, days: DataFrame | None = None) -> DataFrame:
    """Lines of each day's highest delivery whose url is one; several per url may remain.

    A url counts without blanks at its ends and must begin with ``http://`` or ``https://`` in
    lower case. Rows without snapshot_date belong to no day and are left out; a null delivery
    counts as lower than any other, a null line_no as after any other.
    """
    s = snapshots.select(
        F.col("snapshot_date").alias("day"),
        F.coalesce("delivery", F.lit(-1)).alias("delivery"),
        F.coalesce("line_no", F.lit(2**62)).alias("line_no"),
        strip(F.col("url")).alias("url"),
        *ATTRIBUTES,
    ).where(F.col("day").isNotNull() & F.col("url").rlike("^https?://"))
    return s.join(snapshot_days(snapshots) if days is None else days, ["day", "delivery"])


def changes_between_days(snapshots: DataFrame) -> DataFrame:
    """(snapshot_date, url, change) between each two consecutive days: added, removed, changed.

    Every line goes, tagged by side, to its own day and to the next one; one aggregation by
    (later day, url) then takes the first line of each side by line_no and compares the hashes of
    the attributes. Lines of one url reduce in the map-side half, so a url repeated without bound
    stays one row per task. Null and empty attributes are the same; the first day has no rows; an
    empty table gives none. A later delivery replaces a day's earlier ones even where it has no
    valid line. Columns beyond the named ones are ignored.
    """
    lines = candidate_lines(snapshots).withColumn(
        "attrs_hash", F.xxhash64(directory_keys(*ATTRIBUTES)["attrs"])
    )
    sides = (
        F.array(
            F.struct(F.col("day").alias("at"), F.lit(True).alias("is_later"), F.col("day_no").alias("no")),
            F.struct(F.col("next_day").alias("at"), F.lit(False).alias("is_later"), (F.col("day_no") + 1).alias("no")),
        )
    )
    tagged = (
        lines.select("url", "line_no", "attrs_hash", F.explode(sides).alias("side"))
        .select("url", "line_no", "attrs_hash", "side.*")
        .where(F.col("at").isNotNull() & (F.col("no") > 1))
    )
    first = F.struct("line_no", "attrs_hash")
    merged = tagged.groupBy(F.col("at").alias("snapshot_date"), "url").agg(
        F.min(F.when(F.col("is_later"), first)).alias("new"),
        F.min(F.when(~F.col("is_later"), first)).alias("old"),
    )
    change = (
        F.when(F.col("old").isNull(), "added")
        .when(F.col("new").isNull(), "removed")
        .when(F.col("old.attrs_hash") != F.col("new.attrs_hash"), "changed")
    )
    return merged.select("snapshot_date", "url", change.alias("change")).where(
        F.col("change").isNotNull()
    )
