"""Dated snapshots, question sets and exports as JSON lines or CSV."""

from __future__ import annotations

import json
import os
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..schemas import SNAPSHOT, TEXT

GOLD = "id string, question string, kind string, strategy string, gold_codigos array<bigint>, today string, note string"


def date_in_name(path: Column) -> Column:
    """The date that a file's name holds, null if it holds none."""
    return F.regexp_extract(path, r"(\d{4}-\d{2}-\d{2})[^/]*$", 1).try_cast("date")


def read_snapshots(spark: SparkSession, pattern: str) -> tuple[DataFrame, DataFrame]:
    """(rows with _snapshot_date and _ingested_at, rejected lines) of the snapshot files that match.

    A line that isn't the schema's JSON or has no codigo, and all lines of a file without a date
    in its name, are rejected, with the file's path.
    """
    schema = StructType([*[StructField(f.name, f.dataType, True) for f in SNAPSHOT.fields], StructField("_corrupt", TEXT, True)])
    lines = spark.read.schema(schema).option("columnNameOfCorruptRecord", "_corrupt").json(pattern)
    dated = lines.select("*", F.col("_metadata.file_path").alias("_path")).withColumn("_snapshot_date", date_in_name(F.col("_path"))).withColumn("_ingested_at", F.current_timestamp())
    good = F.col("codigo").isNotNull() & F.col("_snapshot_date").isNotNull() & F.col("_corrupt").isNull()
    return dated.where(good).drop("_corrupt", "_path"), dated.where(~good).select("_path", "_corrupt", "codigo")


def read_questions(spark: SparkSession, path: str) -> DataFrame:
    """A question set: JSON lines, with blank lines and // comments. Repeated ids are an error."""
    lines = spark.read.text(path).where(~F.trim("value").startswith("//") & (F.trim("value") != ""))
    rows = lines.select(F.from_json("value", GOLD).alias("q")).select("q.*")
    twice = [r[0] for r in rows.groupBy("id").count().where("count > 1").select("id").limit(5).collect()]
    if twice:
        raise ValueError(f"question ids occur twice: {', '.join(map(str, twice))}")
    return rows


def export_notes(notes: DataFrame, out: str, fmt: str = "jsonl", include_body: bool = True) -> None:
    """A folder of JSON lines or CSV, ordered by fecha, edicion and codigo across its files."""
    df = (notes if include_body else notes.drop("body_text")).orderBy("fecha", "edicion", "codigo")
    if fmt == "jsonl":
        df.write.mode("overwrite").option("ignoreNullFields", "false").json(out)
    elif fmt == "csv":
        df.write.mode("overwrite").option("header", "true").option("escape", '"').csv(out)
    else:
        raise ValueError(f"{fmt} is neither jsonl nor csv")


def export_snapshot(notes: DataFrame, folder: str, day: str) -> tuple[str, int]:
    """One local file notas-<day>.jsonl; a second export of a day takes the place of the first.
    Rows stream through the driver one partition at a time."""
    path, part, n = Path(folder) / f"notas-{day}.jsonl", Path(folder) / f".{uuid.uuid4().hex}", 0
    path.parent.mkdir(parents=True, exist_ok=True)
    rows = notes.select(*[f.name for f in SNAPSHOT.fields]).orderBy("codigo")
    with part.open("w", encoding="utf-8") as f:
        for row in rows.toLocalIterator():
            f.write(json.dumps(row.asDict(), ensure_ascii=False) + "\n")
            n += 1
    os.replace(part, path)
    return str(path), n


def write_report(report: dict, path: str) -> None:
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(report, ensure_ascii=False, indent=2, default=str) + "\n", encoding="utf-8")
