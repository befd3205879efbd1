"""Routing reports as JSON text, one message per row (files or a message topic)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.schemas import CORRUPT, REPORT_JSON, REPORT_KEYS

# Fixed value: topic the nodes publish to.
REPORT_TOPIC = "rplstats/json"


def parse_reports(messages: DataFrame, *, text: str = "value") -> DataFrame:
    """Decode the JSON column; messages that are not a report keep their text in ``_corrupt``."""
    parsed = F.from_json(
        text, REPORT_JSON, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    )
    others = [c for c in messages.columns if c != text]
    columns: list[Column] = [
        F.col("__m").getField(key).alias(name) for key, (name, _) in REPORT_KEYS.items()
    ]
    return messages.withColumn("__m", parsed).select(*others, *columns, F.col("__m").getField(CORRUPT).alias(CORRUPT))


def well_formed(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col(CORRUPT).isNull() & F.col("node_id").isNotNull()).drop(CORRUPT)


def quarantined(parsed: DataFrame) -> DataFrame:
    """Side output: broken JSON and reports without a node id."""
    return parsed.filter(F.col(CORRUPT).isNotNull() | F.col("node_id").isNull())


def read_report_lines(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.text(folder)


def stream_report_lines(spark: SparkSession, folder: str, *, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(folder)


def to_report_json(reports: DataFrame) -> Column:
    """Report columns back to message text (names as on the wire)."""
    present = [
        F.col(name).alias(key) for key, (name, _) in REPORT_KEYS.items() if name in reports.columns
    ]
    return F.to_json(F.struct(*present))
