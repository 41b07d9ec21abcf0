"""Session helpers: reading the test tables and cutting lineage durably."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


_written: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names; only a local session gets one of its own."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    named = sc.getConf().get("spark.checkpoint.dir", None)
    if named:
        sc.setCheckpointDir(named)
    elif sc.master.startswith("local[") or sc.master == "local":
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="pageatlas-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")


def durable(df: DataFrame, replaces: DataFrame | None = None) -> DataFrame:
    """Write ``df`` as a table in the checkpoint folder and read it back.

    Lineage ends there, so that losing an executor loses nothing; and what follows is planned by the
    table's true size, while a checkpoint carries its plan's estimate on, which rounds of joins square
    each time. ``replaces``: an earlier result of this function that nothing reads any more.
    """
    spark = df.sparkSession
    path = scratch(spark)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._durable_path = path
    _written.add(path)
    if (old := getattr(replaces, "_durable_path", None)) is not None:
        _delete(spark, old)
    return out


def scratch(spark: SparkSession) -> str:
    """A new folder of its own in the checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/pageatlas-{uuid.uuid4().hex}"


def numbered(df: DataFrame, name: str, *by) -> DataFrame:
    """``df``, durable, with its rows' places 0, 1, 2, ... in the order of ``by``. Rows are sorted in ranges over
    the tasks; only a number and a count per task come to the driver. ``by`` should leave no ties."""
    at, within = F.col("_at"), F.col("_at").bitwiseAND((1 << 33) - 1)
    rows = durable(df.orderBy(*by).withColumn("_at", F.monotonically_increasing_id()))
    counts = sorted((r["p"], r["n"]) for r in rows.groupBy(F.shiftright(at, 33).alias("p")).agg(F.count("*").alias("n")).collect())
    starts, n = [], 0
    for p, k in counts:
        starts.append((p, n))
        n += k
    offsets = df.sparkSession.createDataFrame(starts, "_p bigint, _start bigint")
    out = rows.withColumn("_p", F.shiftright(at, 33)).join(F.broadcast(offsets), "_p")  # a row per task
    return out.withColumn(name, F.col("_start") + within).drop("_at", "_p", "_start")


def _delete(spark: SparkSession, path: str) -> None:
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jpath, True)
    _written.discard(path)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Durable tables made inside are deleted at the end: for work that hands on no result that reads them."""
    before = set(_written)
    try:
        yield
    finally:
        for path in _written - before:
            _delete(spark, path)


def release(spark: SparkSession) -> None:
    """Delete all durable tables of this process, once no result that reads them is needed any more."""
    for path in list(_written):
        _delete(spark, path)
