"""Time sliding windows on a stream: appended once closed, or kept up to date whatever the order of arrival."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.operators.grid import CELL, panes, windows_of_panes


def sliding_window_differences(
    grid: DataFrame,
    *,
    keys: Sequence[str] = CELL,
    order: str = "time_step",
    value: str = "temperature",
    time: str = "timestamp",
    size: str = "100 seconds",
    slide: str = "10 seconds",
    delay: str = "0 seconds",
) -> DataFrame:
    """The batch window difference, appended once the watermark has passed a window's end."""
    return (
        grid.withWatermark(time, delay)
        .groupBy(*keys, F.window(time, size, slide).alias("window"))
        .agg(
            F.min(time).alias("window_start"),
            F.max(time).alias("window_end"),
            F.min(order).alias("window_start_step"),
            F.max(order).alias("window_end_step"),
            (F.max_by(value, order) - F.min_by(value, order)).alias("temp_diff"),
        )
        .drop("window")
    )


class PaneWindows:
    """``foreachBatch`` handler: folds each trigger's rows into panes; ``result`` makes the windows of all panes.

    A late row adds to its pane whenever it comes, and windows that are still open are there too.  A trigger
    writes its panes under its number, so a repeated trigger replaces its own.  A new handler on the same folder reads
    the results of the one before.
    """

    def __init__(self, folder: str, *, keys: Sequence[str] = CELL, size: str = "100 seconds", slide: str = "10 seconds", **columns: str):
        self.folder, self.keys, self.size, self.slide, self.columns = folder.rstrip("/"), keys, size, slide, columns
        self.schema = None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        folded = panes(batch, keys=self.keys, size=self.size, slide=self.slide, **self.columns)
        self.schema = folded.schema
        folded.write.mode("overwrite").parquet(f"{self.folder}/panes/trigger={batch_id}")

    def result(self, spark: SparkSession) -> DataFrame:
        written = f"{self.folder}/panes/trigger=*"
        # Also a trigger without rows leaves a file with the columns.
        folded = spark.read.schema(self.schema or spark.read.parquet(written).schema).parquet(written)
        return windows_of_panes(folded, keys=self.keys, size=self.size, slide=self.slide)
