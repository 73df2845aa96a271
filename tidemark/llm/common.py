"""What the corpus operators share: row keys, written cuts of the lineage, graph components."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_SPACE = " \t\n\x0b\x0c\r"


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or the context's own.

    Only where neither is set and the master is local (tests, one machine) a temporary folder is
    made and set; on a cluster that raises RuntimeError.
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
        base = sc.getCheckpointDir()
    return base.rstrip("/")


def new_path(spark: SparkSession, what: str) -> str:
    """A new path in the application's own folder of the shared one."""
    return f"{shared_dir(spark)}/tidemark-{spark.sparkContext.applicationId}/{what}-{uuid.uuid4().hex}"


def clear_shared(spark: SparkSession) -> None:
    """Removes what this application has written to the shared folder. Results that still read
    from it must have been written elsewhere."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/tidemark-{spark.sparkContext.applicationId}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: The tables that this process has written, in order.
_WRITTEN: list[str] = []


def mark() -> int:
    """A point in the order of written tables, for clear_since."""
    return len(_WRITTEN)


def clear_since(spark: SparkSession, point: int, keep: int = 0) -> None:
    """Removes the tables written since a point but the last `keep`, when nothing reads them any more."""
    old = _WRITTEN[point : len(_WRITTEN) - keep]
    _WRITTEN[point : len(_WRITTEN) - keep] = []
    for name in old:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, what: str = "cut") -> DataFrame:
    """df, computed once, written to the shared folder and read back: cuts the lineage,
    survives the loss of any executor, and lets later plans see true sizes."""
    spark = df.sparkSession
    path = new_path(spark, what)
    df.write.parquet(path)
    _WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z and nothing else; pure ASCII strings take the fast way."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, ASCII_UPPER, ASCII_UPPER.lower()))


def hash128(*cols: Column) -> tuple[Column, Column]:
    """Two independently seeded 64-bit hashes; together they stand for the value."""
    return F.xxhash64(*cols), F.xxhash64(F.lit(0x5EED), *reversed(cols))


def connected_components(edges: DataFrame, most_rounds: int = 100) -> DataFrame:
    """(node, component) of every node of edges (a, b): component is the smallest node reachable.

    Alternating large-star and small-star steps: each is one grouped minimum (combined before
    the shuffle) and one join on the node, so a star of any size is never gathered in one task.
    Rounds grow with the logarithm of the longest path. Loops and repeated edges are harmless;
    edges with a null end are ignored.
    """
    e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"), (F.col("a").isNull() | F.col("b").isNull()).alias("void"))
    e = written(e.where("not void and a != b").select("a", "b").distinct(), "edges")
    seen = None
    for _ in range(most_rounds):
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
        large = both.join(least, both.a == least.k).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), "m")
        small = large.join(least, large.a == least.k).select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b")))).alias("x")).select("x.a", "x.b")
        e = written(small.where("a != b").distinct(), "edges")
        state = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).head())
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return e.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")).union(e.select("b", "b").distinct())
