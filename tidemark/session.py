"""The Spark session and where tables live."""

from __future__ import annotations

import hashlib
import os
from dataclasses import dataclass

from pyspark.sql import SparkSession


def get_spark(app: str = "tidemark", master: str | None = None, shuffle_partitions: int = 4) -> SparkSession:
    """The active session if there is one (a managed runtime's is adopted as it is), else a local one."""
    if (active := SparkSession.getActiveSession()) is not None:
        return active
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.ui.enabled", "false")
    if master or "SPARK_REMOTE" not in os.environ:
        builder = builder.master(master or os.environ.get("TIDEMARK_MASTER", "local[2]")).config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


@dataclass(frozen=True)
class Lake:
    """Where layers' tables are: below a root folder, or in a catalog's schemas."""

    root: str
    catalog: str | None = None

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    def name(self, layer: str, table: str) -> str:
        """A table's name that no other root shares: locally it ends in a digest of the root."""
        if self.catalog:
            return f"{self.catalog}.{layer}.{table}"
        return f"{layer}_{table}_{hashlib.md5(os.path.abspath(self.root).encode()).hexdigest()[:8]}"


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; only where that is unset and the master is local, a
    temporary one, which is set."""
    import re
    import tempfile

    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
        base = sc.getCheckpointDir()
    return base.rstrip("/")
