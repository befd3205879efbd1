"""Grid snapshots: one CSV file per step, the step in the file name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.schemas import CORRUPT, GRID_CSV

# File name pattern of a snapshot.
SNAPSHOT_GLOB = "*heat_diffusion*.csv"
SNAPSHOT_STEP = r"heat_diffusion(\d+)\.csv"


def read_snapshots(spark: SparkSession, folder: str, *, keep_corrupt: bool = False) -> DataFrame:
    """Rows (x, y, time_step, timestamp, temperature) of all snapshots below ``folder``.

    The schema is declared, so nothing is scanned to infer it, and lines are split freely.
    The step is taken from the scan's file metadata; one step is one second.  Lines that do
    not fit the schema are left out, or kept with their text in ``_corrupt`` on request.
    """
    rows = (
        spark.read.schema(GRID_CSV)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(f"{folder.rstrip('/')}/{SNAPSHOT_GLOB}")
    )
    step = F.regexp_extract(F.col("_metadata.file_path"), SNAPSHOT_STEP, 1).cast("int")
    placed = rows.withColumn("time_step", step).withColumn("timestamp", F.timestamp_seconds("time_step"))
    columns = ["x", "y", "time_step", "timestamp", "temperature"]
    if keep_corrupt:
        return placed.select(*columns, CORRUPT)
    return placed.filter(F.col(CORRUPT).isNull()).select(*columns)


def write_snapshots(grid: DataFrame, folder: str) -> None:
    """Write one snapshot folder per step, in the layout ``read_snapshots`` accepts.

    Rows are range-partitioned by step and cell first: a task writes few steps, a large step
    is shared by several tasks.
    """
    name = F.concat(F.lit("heat_diffusion"), F.col("time_step").cast("string"), F.lit(".csv"))
    (
        grid.repartitionByRange("time_step", "x", "y")
        .select("x", "y", "temperature", name.alias("snapshot"))
        .write.mode("overwrite")
        .option("header", True)
        .partitionBy("snapshot")
        .csv(folder)
    )


def ingest(grid: DataFrame, folder: str) -> None:
    """Columnar copy partitioned by step, so later reads prune steps instead of scanning them."""
    (
        grid.repartitionByRange("time_step", "x", "y")
        .write.mode("overwrite")
        .partitionBy("time_step")
        .parquet(folder)
    )
