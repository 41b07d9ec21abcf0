"""Aggregates of the map view: positions, glows, colours, opacities, texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Side, margin and neutral colour of the view.
SIZE, PAD, NEUTRAL = 640, 30, (107, 114, 128)


def scaled(points: DataFrame) -> DataFrame:
    """cx, cy: positions on one scale for both axes; a span of nothing counts as 1."""
    b = points.agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))
    span = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))
    span = F.when(span == 0, 1.0).otherwise(span)
    inner = SIZE - 2 * PAD
    at = points.crossJoin(F.broadcast(b))  # one row
    return at.select(*points.columns, (PAD + (F.col("x") - F.col("x0")) / span * inner).alias("cx"), (PAD + (F.col("y") - F.col("y0")) / span * inner).alias("cy"))


def glows(members: DataFrame) -> DataFrame:
    """(topic, gx, gy, r) of (topic, weight, cx, cy): weighted mean and a radius by weighted spread."""
    m = members.where("weight > 0")
    mean = m.groupBy("topic").agg(F.sum("weight").alias("w"), (F.sum(F.col("weight") * F.col("cx")) / F.sum("weight")).alias("gx"), (F.sum(F.col("weight") * F.col("cy")) / F.sum("weight")).alias("gy"))
    d2 = F.pow(F.col("cx") - F.col("gx"), 2) + F.pow(F.col("cy") - F.col("gy"), 2)
    var = m.join(F.broadcast(mean), "topic").groupBy("topic", "gx", "gy").agg((F.sum(F.col("weight") * d2) / F.sum("weight")).alias("var"))
    return var.select("topic", "gx", "gy", F.greatest(F.lit(40.0), 1.6 * F.sqrt("var")).alias("r"))


def hue(topic: Column) -> Column:
    return F.pmod(topic * 137.5, F.lit(360.0))


def hsl_to_rgb(h: Column, s: float = 0.75, light: float = 0.65) -> list[Column]:
    """Red, green, blue in 0..255."""
    a = s * min(light, 1 - light)

    def channel(n: int) -> Column:
        k = F.pmod(n + h / 30, F.lit(12.0))
        return (light - a * F.greatest(F.lit(-1.0), F.least(k - 3, 9 - k, F.lit(1.0)))) * 255

    return [channel(0), channel(8), channel(4)]


def blend(pages: DataFrame, weights: DataFrame) -> DataFrame:
    """(version_id, red, green, blue): a page's topics mixed by weight, halves up; the neutral colour for none."""
    rgb = hsl_to_rgb(hue(F.col("topic")))
    mix = weights.groupBy("version_id").agg(F.sum("weight").alias("w"), *[F.sum(c * F.col("weight")).alias(n) for c, n in zip(rgb, ("r", "g", "b"))])
    up = lambda c, d: F.when(F.col("w") > 0, F.floor(F.col(c) / F.col("w") + 0.5)).otherwise(F.lit(d))
    return pages.select("version_id").distinct().join(mix, "version_id", "left").select(
        "version_id", *[F.coalesce(up(c, d), F.lit(d)).cast("bigint").alias(n) for c, d, n in zip(("r", "g", "b"), NEUTRAL, ("red", "green", "blue"))]
    )


def emphasis(pages: DataFrame, weights: DataFrame, active: int | None, selected: str | None = None) -> DataFrame:
    """(version_id, weight_on, opacity, radius) for the active topic, or for none."""
    if active is None:
        on = pages.select("version_id").distinct().withColumn("weight_on", F.lit(1.0))
        opacity = F.lit(0.9)
    else:
        w = weights.where(F.col("topic") == active).select("version_id", "weight")
        on = pages.select("version_id").distinct().join(w, "version_id", "left").select("version_id", F.coalesce("weight", F.lit(0.0)).alias("weight_on"))
        opacity = 0.1 + 0.9 * F.col("weight_on")
    radius = F.when(F.col("version_id") == F.lit(selected), 8.0).otherwise(4 + 2 * F.col("weight_on"))
    return on.select("version_id", "weight_on", opacity.alias("opacity"), radius.alias("radius"))


def postcards(points: DataFrame, weights: DataFrame, snips: DataFrame, active: int) -> DataFrame:
    """(version_id, text, percent): the snippet on the active topic, else the excerpt."""
    w = weights.where(F.col("topic") == active).join(snips, ["version_id", "topic"], "left").select("version_id", "weight", "snippet")
    return points.join(w, "version_id", "left").select("version_id", F.coalesce("snippet", "excerpt").alias("text"), F.concat(F.floor(F.col("weight") * 100 + 0.5).cast("string"), F.lit("%")).alias("percent"))


def topic_labels(ids: DataFrame, names: DataFrame) -> DataFrame:
    return ids.join(names, "topic", "left").select("topic", F.coalesce("label", F.concat(F.lit("topic "), F.col("topic").cast("string"))).alias("label"))
