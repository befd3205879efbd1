"""Reader of a topic that at-least-once writers fill: every result once, whatever was delivered again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

MESSAGE = "topic string, key string, value string, id string, timestamp timestamp"


def stream_messages(spark: SparkSession, folder: str, *, files_per_trigger: int | None = None) -> DataFrame:
    """File twin of an output topic: message rows (see ``topics.message_rows``) with the time they were written."""
    reader = spark.readStream.schema(MESSAGE)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def once(messages: DataFrame, *, within: str) -> DataFrame:
    """Messages without repeats of an id that are written at most ``within`` after the first one.

    The ids seen wait in the state store until the watermark has passed them by ``within``, so the state holds that much of the
    topic and not all of it; it is kept in the checkpoint, so a restarted reader knows what it has given out.
    """
    return messages.withWatermark("timestamp", within).dropDuplicatesWithinWatermark(["id"])
