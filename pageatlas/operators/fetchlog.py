"""The fetch log: targets, policy, classification of responses, and the health of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pageatlas.functions.url import base_url, host

#: Errors that are no failures, and the mark-up that forbids keeping a page.
SKIPPED = ["robots", "noarchive", "denylist"]
NOARCHIVE = r"""(?i)<meta[^>]+name=["'](?:robots|googlebot)["'][^>]*content=["'][^"']*noarchive"""


def usable(fetches: DataFrame) -> DataFrame:
    return fetches.where(F.col("status").isin(200, 304) & F.col("content_hash").isNotNull())


def priors(fetches: DataFrame) -> DataFrame:
    """(url, etag, last_modified, content_hash, raw_object_key) of each url's latest usable fetch; of
    equal times the greatest row. The maximum combines map-side, so a url with a tenth of the log is one row a task."""
    cols = ["etag", "last_modified", "content_hash", "raw_object_key"]
    return usable(fetches).groupBy("url").agg(F.max(F.struct("fetched_at", "run_id", *cols)).alias("p")).select("url", *[f"p.{c}" for c in cols])


def targets(people: DataFrame, limit: int = 0) -> DataFrame:
    """Distinct urls of open rows in order; a limit of 0 is none."""
    urls = people.where(F.coalesce("valid_to", F.lit("")) == "").select("url").distinct().orderBy("url")
    return urls.limit(limit) if limit else urls


def is_denied(urls: DataFrame, denylist: DataFrame) -> DataFrame:
    """(url, denied): whether the url, its base, its host or a parent domain is listed.

    Instead of comparing every url with every entry, a url is exploded into what may deny it (its two
    forms and every suffix of its host), which then meets the list in an equi-join.
    """
    labels = F.split(host(F.col("url")), r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    names = F.array_distinct(F.concat(F.array(F.lower("url"), F.lower(base_url(F.col("url")))), suffixes))
    listed = denylist.select(F.lower(F.trim("entry")).alias("name")).where("name <> ''").distinct().withColumn("hit", F.lit(True))
    each = urls.select("url").distinct().select("url", F.explode(names).alias("name"))
    return each.join(listed, "name", "left").groupBy("url").agg(F.coalesce(F.bool_or("hit"), F.lit(False)).alias("denied"))


def fan_out(urls: DataFrame) -> DataFrame:
    """(base, listed): one request per base url, the urls it answers in order."""
    return urls.select(base_url(F.col("url")).alias("base"), "url").distinct().groupBy("base").agg(F.sort_array(F.collect_list("url")).alias("listed"))


def deny_groups(urls: DataFrame, denylist: DataFrame) -> DataFrame:
    """(url, base, denied): a denied url denies all urls of its base."""
    d = is_denied(urls, denylist).withColumn("base", base_url(F.col("url")))
    bases = d.groupBy("base").agg(F.bool_or("denied").alias("denied"))
    return d.select("url", "base").join(bases, "base").select("url", "base", "denied")


def chosen_priors(urls: DataFrame, known: DataFrame) -> DataFrame:
    """(base, prior_url, content_hash): of a base's urls the first, in order, that has a prior."""
    with_base = urls.select("url").distinct().join(known, "url").withColumn("base", base_url(F.col("url")))
    return with_base.groupBy("base").agg(F.min(F.struct("url", "content_hash")).alias("p")).select("base", F.col("p.url").alias("prior_url"), "p.content_hash")


def response_error(status: Column, content_type: Column, size: Column, robots_tag: Column, body: Column, max_bytes: int = 5_000_000) -> Column:
    """What keeps a response from being stored; null for one that is, and for 304."""
    kind = F.lower(F.coalesce(content_type, F.lit("")))
    return (
        F.when(status == 304, None)
        .when((status < 200) | (status >= 400), F.concat(F.lit("http_"), status.cast("string")))
        .when((kind != "") & ~(kind.contains("html") | kind.contains("text/") | kind.contains("xml")), "content_type")
        .when(size > max_bytes, "too_large")
        .when(F.lower(F.coalesce(robots_tag, F.lit(""))).contains("noarchive") | F.coalesce(F.substring(body, 1, 200_000).rlike(NOARCHIVE), F.lit(False)), "noarchive")
    )


def run_summary(fetches: DataFrame, threshold: float = 0.30) -> DataFrame:
    """One row per run: attempted, ok, not_modified, failed, skipped, failure_rate, healthy."""
    skipped = F.coalesce(F.col("error").isin(SKIPPED), F.lit(False))
    failed = F.col("error").isNotNull() & (F.col("error") != "") & ~skipped
    s = fetches.groupBy("run_id").agg(
        F.count("*").alias("rows"), F.count_if(skipped).alias("skipped"), F.count_if(failed).alias("failed"), F.count_if(F.col("status") == 304).alias("not_modified")
    )
    s = s.withColumn("attempted", F.col("rows") - F.col("skipped"))
    rate = F.when(F.col("attempted") > 0, F.col("failed") / F.col("attempted")).otherwise(0.0)
    return s.select("run_id", "attempted", (F.col("attempted") - F.col("failed") - F.col("not_modified")).alias("ok"), "not_modified", "failed", "skipped", rate.alias("failure_rate"), (rate <= threshold).alias("healthy"))


def error_reasons(fetches: DataFrame) -> DataFrame:
    """(run_id, kind, error, n): skips and failures by reason."""
    e = fetches.where(F.col("error").isNotNull() & (F.col("error") != ""))
    return e.groupBy("run_id", F.when(F.col("error").isin(SKIPPED), "skip").otherwise("fail").alias("kind"), "error").agg(F.count("*").alias("n"))


def runs(u: DataFrame, order: list[str], identity: Column) -> DataFrame:
    """``u`` with ``start``, the place in ``order`` of the fetch that opened its run, and ``opens``.

    A run opens with the url's first fetch and wherever a later one that is no 304 has another identity
    than the one before it in that series. Fetches of a url stand in chunks of a day: each chunk is looked
    at on its own, and what passes from one to the next is a row per url and day, so that a url with a
    third of the log is spread over its days.
    """
    at = F.struct(*order)
    u = u.withColumn("_id", identity).withColumn("_day", F.substring("fetched_at", 1, 10))
    inside = Window.partitionBy("url", "_day").orderBy(*order)
    days = Window.partitionBy("url").orderBy("_day")
    earlier = days.rowsBetween(Window.unboundedPreceding, -1)
    full = F.col("status") != 304
    u = u.withColumn("_rn", F.row_number().over(inside))
    chunks = u.groupBy("url", "_day").agg(F.max_by("_id", F.when(full, at)).alias("last"), F.min_by("_id", at).alias("head"))
    chunks = chunks.withColumn("_begins", F.row_number().over(days) == 1).withColumn("last", F.coalesce("last", F.when(F.col("_begins"), F.col("head"))))
    chunks = chunks.select("url", "_day", "_begins", F.last("last", ignorenulls=True).over(earlier).alias("_carried"))
    rows = u.join(chunks, ["url", "_day"])
    first = F.col("_begins") & (F.col("_rn") == 1)
    rows = rows.withColumn("_own", F.when(full | first, F.col("_id")))
    before = F.coalesce(F.last("_own", ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.col("_carried"))
    rows = rows.withColumn("opens", F.col("_own").isNotNull() & (first | (F.col("_own") != before)))
    rows = rows.withColumn("start", F.last(F.when(F.col("opens"), at), ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    ends = rows.groupBy("url", "_day").agg(F.max(F.when(F.col("opens"), at)).alias("last"))
    ends = ends.select("url", "_day", F.last("last", ignorenulls=True).over(earlier).alias("_start"))
    rows = rows.join(ends, ["url", "_day"]).withColumn("start", F.coalesce("start", "_start"))
    return rows.drop("_id", "_day", "_rn", "_begins", "_carried", "_own", "_start")


def version_islands(fetches: DataFrame) -> DataFrame:
    """(url, content_hash, first_seen, last_seen, fetches): versions if every new hash is a new text, which
    are the runs of fetches."""
    u = usable(fetches).select("url", "fetched_at", "run_id", "status", "content_hash").distinct()
    u = runs(u, ["fetched_at", "run_id"], F.col("content_hash"))
    return u.groupBy("url", "start").agg(
        F.min_by("content_hash", F.struct("fetched_at", "run_id")).alias("content_hash"), F.min("fetched_at").alias("first_seen"),
        F.max("fetched_at").alias("last_seen"), F.count("*").alias("fetches"),
    ).drop("start")


def missing_raw(wanted: DataFrame, stored: DataFrame) -> DataFrame:
    """Raw objects to write: content-addressed, so those that are stored are left out."""
    return wanted.join(stored.select("raw_object_key").distinct(), "raw_object_key", "left_anti")
