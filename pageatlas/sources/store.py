"""A store of tables and small objects under one root, local or on any Hadoop file system.

A table is a directory of generations with a pointer file, written last: a table can be replaced while
it is read, and a reader never sees half of one. The generation before stays until the next.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, key: str):
        p = self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{key}")
        return p, p.getFileSystem(self._conf)

    def exists(self, key: str) -> bool:
        p, fs = self._path(key)
        return fs.exists(p)

    def delete(self, key: str) -> None:
        p, fs = self._path(key)
        fs.delete(p, True)

    def write_bytes(self, key: str, data: bytes | str) -> None:
        p, fs = self._path(key)
        out = fs.create(p, True)
        try:
            out.write(bytearray(data.encode() if isinstance(data, str) else data))
        finally:
            out.close()

    def read_bytes(self, key: str) -> bytes:
        return bytes(self.spark.read.format("binaryFile").load(f"{self.root}/{key}").select("content").first()[0])

    def read_text(self, key: str) -> str | None:
        """The object as text; None if absent."""
        return self.read_bytes(key).decode() if self.exists(key) else None

    write_text = write_json = write_bytes

    def list(self, prefix: str = "") -> list[str]:
        """Keys under the prefix, relative to the root, in order; none if it is missing."""
        p, fs = self._path(prefix) if prefix else self._path(".")
        if not fs.exists(p):
            return []
        base = fs.makeQualified(self._jvm.org.apache.hadoop.fs.Path(self.root)).toUri().getPath()
        it, out = fs.listFiles(p, True), []
        while it.hasNext():
            key = it.next().getPath().toUri().getPath()[len(base) + 1 :]
            if not key.rpartition("/")[2].startswith("."):
                out.append(key)
        return sorted(out)

    # --- tables -----------------------------------------------------------------------------------

    def write_table(self, name: str, df: DataFrame) -> None:
        """Replace a table. The pointer moves when all of it is written."""
        before = self.read_text(f"{name}/current.txt") or ""
        gen = f"gen={uuid.uuid4().hex}"
        df.write.parquet(f"{self.root}/{name}/{gen}")
        self.write_text(f"{name}/current.txt", gen)
        for key in {k.split("/gen=")[1].split("/")[0] for k in self.list(name) if "/gen=" in k}:
            if f"gen={key}" not in (gen, before):
                self.delete(f"{name}/gen={key}")

    def read_table(self, name: str, schema: str) -> DataFrame:
        """A table with its declared schema; empty if there is none."""
        gen = self.read_text(f"{name}/current.txt")
        if gen is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.root}/{name}/{gen}")

    def append(self, name: str, df: DataFrame, part: str) -> None:
        """Add a part to an append-only table; a part of the same name is replaced."""
        df.write.mode("overwrite").parquet(f"{self.root}/{name}/part={part}")

    def parts(self, name: str) -> list[str]:
        """The parts of an append-only table that are written to the end."""
        return sorted({k.split("/part=")[1].split("/")[0] for k in self.list(name) if "/part=" in k and k.endswith("/_SUCCESS")})

    def read_parts(self, name: str, schema: str, only: list[str] | None = None) -> DataFrame:
        """All parts, or some, by column name, cast to the declared schema; what a part lacks is null."""
        empty = self.spark.createDataFrame([], schema)
        parts = [p for p in self.parts(name) if only is None or p in set(only)]
        if not parts:
            return empty
        try:  # one scan where the parts agree with the schema
            return self.spark.read.schema(schema).parquet(*[f"{self.root}/{name}/part={p}" for p in parts]) if self._agree(name, parts, empty) else self._union(name, parts, empty)
        except ValueError:
            return self._union(name, parts, empty)

    def _agree(self, name: str, parts: list[str], empty: DataFrame) -> bool:
        want = dict(empty.dtypes)
        return all(want.get(c) == t for p in parts for c, t in self.spark.read.parquet(f"{self.root}/{name}/part={p}").dtypes)

    def _union(self, name: str, parts: list[str], empty: DataFrame) -> DataFrame:
        out = empty
        for p in parts:
            df = self.spark.read.parquet(f"{self.root}/{name}/part={p}")
            out = out.unionByName(df.select([F.col(c).cast(t) for c, t in empty.dtypes if c in df.columns]), allowMissingColumns=True)
        return out.select([F.col(c).cast(t).alias(c) for c, t in empty.dtypes])
