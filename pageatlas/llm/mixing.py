"""Mixing sources to target weights, to the token."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pageatlas.session import durable

#: Records of a source that one task sums in order.
BUCKET_RECORDS = 4_000


def source_budgets(sized: DataFrame, targets: DataFrame, total_tokens: int | None = None) -> DataFrame:
    """(source, target_share, max_repeats, available, records, share, budget) of each target's source.

    Shares of sources that have no tokens go to the others in proportion (``share``). Without
    ``total_tokens`` the mix is as large as it can be with every present source at its share and none
    repeated beyond its cap; with it, budgets beyond a cap are cut at the cap and what is short shows
    in the report. One row per target source.
    """
    have = sized.groupBy("source").agg(F.sum("n_tokens").alias("available"), F.count("*").alias("records"))
    t = targets.groupBy("source").agg(F.max("target_share").alias("target_share"), F.max(F.greatest(F.coalesce("max_repeats", F.lit(1)), F.lit(0))).alias("max_repeats"))
    t = t.where(F.col("source").isNotNull() & (F.col("target_share") > 0))
    b = t.join(have, "source", "left").fillna(0, ["available", "records"])
    present = (F.col("available") > 0) & (F.col("max_repeats") > 0)
    whole = b.agg(F.sum(F.when(present, F.col("target_share"))).alias("whole"))
    b = b.crossJoin(F.broadcast(whole)).withColumn("share", F.when(present, F.col("target_share") / F.col("whole")).otherwise(0.0))  # one row
    most = (F.col("available") * F.col("max_repeats")).cast("double")
    if total_tokens is None:
        total = b.where(F.col("share") > 0).agg(F.floor(F.min(most / F.col("share"))).alias("total"))
    else:
        total = b.limit(1).select(F.lit(total_tokens).cast("bigint").alias("total"))
    return b.crossJoin(F.broadcast(total)).select(
        "source", "target_share", "max_repeats", "available", "records", "share",
        F.least(F.floor(F.col("share") * F.col("total")), most.cast("bigint")).cast("bigint").alias("budget"),
    )


def mix_sources(sized: DataFrame, targets: DataFrame, total_tokens: int | None = None, seed: int = 17, bucket_records: int = BUCKET_RECORDS, budgets: DataFrame | None = None) -> DataFrame:
    """(source, doc_id, epoch, n_tokens, take_tokens): the records that the mix takes, epoch by epoch.

    ``sized``: (doc_id, source, n_tokens). In each epoch a source's records stand in the order of a
    hash-random key of their own; full epochs take all of them, the last is cut at the exact budget,
    where the crossing record gives its first ``take_tokens`` tokens. Sums are distributed: keys are
    uniform, so equal ranges of them (as many as the source has thousands of records) hold equal shares
    of even the largest source; ranges are summed first, then each range in order on its own. Records
    without tokens take part with 0. Sources without a target, and targets without a source, give no
    rows. Ties of keys go by doc_id. ``budgets``: those of ``source_budgets``, if they are already known.
    """
    budgets = durable(source_budgets(sized, targets, total_tokens)) if budgets is None else budgets
    full = F.floor(F.col("budget") / F.col("available"))
    plan = budgets.where(F.col("budget") > 0).select(
        "source", full.cast("int").alias("full_epochs"), (F.col("budget") - full * F.col("available")).alias("rest"),
        F.ceil(F.col("records") / bucket_records).alias("ranges"),
    )
    docs = sized.select("doc_id", "source", F.coalesce("n_tokens", F.lit(0)).alias("n_tokens")).join(plan, "source")  # a row per target, which the planner sees
    whole = docs.where("full_epochs > 0").select("source", "doc_id", F.explode(F.sequence(F.lit(0), F.col("full_epochs") - 1)).alias("epoch"), "n_tokens", F.col("n_tokens").alias("take_tokens"))
    # of the last, partial epoch
    key = F.xxhash64(F.lit(seed), "full_epochs", "doc_id")
    partial = docs.where("rest > 0").withColumn("key", key)
    partial = partial.withColumn("range", F.floor((F.shiftrightunsigned("key", 11) / F.lit(float(1 << 53))) * F.col("ranges")))
    sums = partial.groupBy("source", "range").agg(F.sum("n_tokens").alias("s"))
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("source", "range", F.coalesce(F.sum("s").over(before), F.lit(0)).alias("offset"))
    order = [F.shiftrightunsigned("key", 11), F.col("doc_id")]
    inside = Window.partitionBy("source", "range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("offset") + F.coalesce(F.col("inner_sum"), F.lit(0))
    cut = (
        partial.withColumn("inner_sum", F.sum("n_tokens").over(inside))
        .join(offsets, ["source", "range"])
        .withColumn("start", start)
        .where(F.col("start") < F.col("rest"))
        .select("source", "doc_id", F.col("full_epochs").alias("epoch"), "n_tokens", F.least("n_tokens", F.col("rest") - F.col("start")).alias("take_tokens"))
    )
    return whole.unionByName(cut)


def mix_report(mixed: DataFrame, budgets: DataFrame) -> DataFrame:
    """(source, target_share, actual_share, tokens, records, available, max_repeats, most_copies): what
    each target's source came to, absent ones with nothing."""
    got = mixed.groupBy("source").agg(
        F.sum("take_tokens").alias("tokens"), F.count("*").alias("taken"), (F.max("epoch") + 1).alias("most_copies")
    )
    total = got.agg(F.sum("tokens").alias("total"))
    return (
        budgets.join(got, "source", "left").crossJoin(F.broadcast(total))  # one row
        .select(
            "source", "target_share", F.round(F.coalesce(F.col("tokens") / F.col("total"), F.lit(0.0)), 6).alias("actual_share"),
            F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("taken", F.lit(0)).alias("records"),
            "available", "max_repeats", F.coalesce("most_copies", F.lit(0)).alias("most_copies"),
        )
    )
