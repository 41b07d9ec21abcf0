"""Positions of pages on the map: the plane of the two main directions of their vectors.

A projection stands in for a neighbour embedding, and reports say so: it is deterministic, its moments
are sums of a fixed size, and every page is placed by one dot product.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pageatlas.functions.vector import dot

METHOD = "principal plane"


def positions(pages: DataFrame) -> DataFrame:
    """(version_id, x, y) of (version_id, v). Fewer than four pages stand in a row."""
    first = pages.select("v").first()
    n = pages.limit(4).count()
    if first is None or n < 4:
        w = Window.orderBy("version_id")  # at most three rows
        return pages.select("version_id", (F.row_number().over(w) - 1).cast("double").alias("x"), F.lit(0.0).alias("y"))
    d = len(first["v"])

    def moments(batches):
        s = np.zeros((d + 1, d + 1))
        for b in batches:
            x = np.asarray(b.column("v").flatten(), dtype=float).reshape(-1, d)
            x = np.hstack([x, np.ones((len(x), 1))])
            s += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(range(d + 1), pa.int32()), pa.array(s.tolist())], names=["row", "s"])

    sums = pages.select("v").mapInArrow(moments, "row int, s array<double>").select("row", F.posexplode("s").alias("col", "s")).groupBy("row", "col").agg(F.sum("s").alias("s")).collect()
    m = np.zeros((d + 1, d + 1))
    for r in sums:  # (d + 1)² sums
        m[r["row"], r["col"]] = r["s"]
    mean = m[d, :d] / m[d, d]
    _, axes = np.linalg.eigh(m[:d, :d] / m[d, d] - np.outer(mean, mean))
    at = []
    for k in (1, 2):
        axis = axes[:, -k] * (1 if axes[np.abs(axes[:, -k]).argmax(), -k] > 0 else -1)
        at.append(dot(F.col("v"), F.array(*[F.lit(float(a)) for a in axis])) - float(mean @ axis))
    return pages.select("version_id", at[0].alias("x"), at[1].alias("y"))
