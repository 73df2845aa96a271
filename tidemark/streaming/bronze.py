"""Bronze as a stream: new snapshot files are picked up once each. An addition of ours."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..operators.lake import BRONZE_KEYS, bronze_table
from ..schemas import BRONZE, SNAPSHOT
from ..session import Lake
from ..sources.snapshots import date_in_name


def stream_bronze(spark: SparkSession, lake: Lake, folder: str, checkpoint: str, files_per_batch: int = 1000):
    """A query that loads all files that have come since the last one and ends. Each batch is an
    insert of what bronze lacks, so a batch that is run again after a failure adds nothing."""
    schema = StructType([StructField(f.name, f.dataType, True) for f in SNAPSHOT.fields])
    table = bronze_table(spark, lake).ensure()
    lines = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(folder)
    rows = lines.withColumn("_snapshot_date", date_in_name(F.col("_metadata.file_path"))).withColumn("_ingested_at", F.current_timestamp())
    rows = rows.where("codigo is not null and _snapshot_date is not null").select(*[f.name for f in BRONZE.fields])

    def load(batch: DataFrame, number: int) -> None:
        table.insert_new(batch, BRONZE_KEYS)

    return rows.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
