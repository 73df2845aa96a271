"""Parquet tables with versions: every write makes a new one beside the old, then moves a pointer.

A table is a folder of data folders and a CURRENT file that lists those of the newest version.
Readers resolve the pointer once, so a plan sees one version; older ones stay readable by number
or time. One writer at a time. The pointer is written through Hadoop's file system, so a table
may live wherever Spark reads and writes.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

KEEP_SMALL = 20


class Table:
    def __init__(self, spark: SparkSession, path: str, schema: StructType | None = None) -> None:
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def _fs(self, name: str):
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _history(self) -> list[dict]:
        fs, p = self._fs("CURRENT")
        if not fs.exists(p):
            return []
        stream = fs.open(p)
        try:
            return json.loads(bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())
        finally:
            stream.close()

    def _point(self, history: list[dict]) -> None:
        fs, p = self._fs(f".CURRENT-{uuid.uuid4().hex}")
        out = fs.create(p, True)
        try:
            out.write(bytearray(json.dumps(history).encode()))
        finally:
            out.close()
        context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri() if p.toUri().getScheme() else fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        overwrite = self.spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        args = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        args[0] = overwrite
        context.rename(p, self._fs("CURRENT")[1], args)

    def exists(self) -> bool:
        return bool(self._history())

    def version(self) -> int:
        return len(self._history()) - 1

    def ensure(self) -> Table:
        """Creates the table, empty, if it is absent."""
        if not self.exists():
            self.replace(self.spark.createDataFrame([], self.schema))
        return self

    def read(self, version: int | None = None, as_of: float | None = None) -> DataFrame:
        """The newest version, or that of a number, or the newest at a time (seconds)."""
        history = self._history()
        if as_of is not None:
            version = sum(h["at"] <= as_of for h in history) - 1
        n = len(history) - 1 if version is None else version
        if not 0 <= n < len(history):
            raise ValueError(f"{self.path} has no version {version if version is not None else 'yet'}")
        reader = self.spark.read if self.schema is None else self.spark.read.schema(self.schema)
        return reader.parquet(*[f"{self.path}/{d}" for d in history[n]["dirs"]])

    def publish(self, name: str) -> DataFrame:
        """The newest version under a name: a catalog's table for a dotted one, else a view of the session."""
        df = self.read()
        if "." in name:
            df.write.mode("overwrite").saveAsTable(name)
        else:
            df.createOrReplaceTempView(name)
        return self.spark.table(name)

    def _write(self, df: DataFrame, partition_by: tuple[str, ...]) -> str:
        name = f"data-{uuid.uuid4().hex}"
        if self.schema is not None:
            df = df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.schema.fields])
        writer = df.write
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{self.path}/{name}")
        return name

    def replace(self, df: DataFrame, partition_by: tuple[str, ...] = ()) -> int:
        """df, which may read this table, becomes the whole next version."""
        history = self._history()
        self._point([*history, {"dirs": [self._write(df, partition_by)], "at": time.time()}])
        return len(history)

    def append(self, df: DataFrame) -> int:
        """The next version has df's rows too; nothing is written if there are none."""
        if df.isEmpty():
            return self.version()
        history = self._history()
        self._point([*history, {"dirs": [*(history[-1]["dirs"] if history else []), self._write(df, ())], "at": time.time()}])
        return len(history)

    def insert_new(self, staged: DataFrame, keys: list[str]) -> int:
        """Appends the staged rows whose keys the table lacks, one for each key; returns how many.
        The first write of a key wins; of rows staged together, the one that sorts first."""
        others = [c for c in staged.columns if c not in keys]
        one = staged.groupBy(*keys).agg(F.min(F.struct(*others)).alias("row")).select(*keys, "row.*")
        if self.exists():
            one = one.join(self.read().select(*keys), keys, "left_anti")
        before = len(self._history()[-1]["dirs"]) if self.exists() else 0
        self.append(one)
        added = self._history()[-1]["dirs"][before:] if self.exists() else []
        return self.spark.read.parquet(*[f"{self.path}/{d}" for d in added]).count() if added else 0

    def upsert(self, changed: DataFrame, keys: list[str]) -> int:
        """Rows of changed take the place of those with equal keys."""
        if changed.isEmpty():
            return self.version()
        kept = self.read().join(changed.select(*keys).distinct(), keys, "left_anti")
        return self.replace(kept.unionByName(changed.select(*kept.columns)))

    def delete(self, keys: DataFrame, on: list[str]) -> int:
        return self.replace(self.read().join(keys.select(*on).distinct(), on, "left_anti"))

    def drop(self) -> None:
        fs, p = self._fs("CURRENT")
        fs.delete(p.getParent(), True)
