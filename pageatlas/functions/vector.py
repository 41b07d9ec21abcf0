"""Vectors as arrays of doubles."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def doubles(v: Column) -> Column:
    return v.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x * x))


def normalized(a: Column, floor: float = 1e-9) -> Column:
    n = F.greatest(norm(a), F.lit(floor))
    return F.transform(a, lambda x: x / n)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / F.greatest(norm(a) * norm(b), F.lit(1e-18))


def mean_pool(hidden: Column, mask: Column) -> Column:
    """Mean of the token vectors that the mask keeps, L2-normalised."""
    kept = F.transform(F.filter(F.arrays_zip(hidden.alias("h"), mask.alias("m")), lambda z: z["m"] > 0), lambda z: z["h"])
    total = F.aggregate(F.slice(kept, 2, F.greatest(F.size(kept), F.lit(1))), F.get(kept, F.lit(0)), lambda s, x: F.zip_with(s, x, lambda p, q: p + q))
    return normalized(F.transform(total, lambda x: x / F.greatest(F.size(kept), F.lit(1))))
