"""Keyed message topics: message-broker options and file twins of the same rows.

The broker connector is an optional jar; everything downstream works on the rows
(key, value, partition, offset, timestamp) whatever they came from.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from tidewire.schemas import RAW_READING

# Topics, their constant key and the partition count of the input topic.
INPUT_TOPIC = "sensor-data"
OUTPUT_TOPIC = "output"
OUTPUT_KEY = "output"
TOPIC_PARTITIONS = 4


def broker_options(servers: str, topic: str, *, rows_per_trigger: int | None = 1_000_000) -> dict[str, str]:
    """Reader options: from the earliest offset, committed transactions only, bounded triggers."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "kafka.isolation.level": "read_committed",
    }
    if rows_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(rows_per_trigger)
    return options


def _text_rows(source: DataFrame) -> DataFrame:
    return source.select(
        F.col("key").cast("string"), F.col("value").cast("string"), "partition", "offset", "timestamp"
    )


def stream_topic(spark: SparkSession, servers: str, topic: str = INPUT_TOPIC, **options) -> DataFrame:
    return _text_rows(spark.readStream.format("kafka").options(**broker_options(servers, topic, **options)).load())


def read_topic(spark: SparkSession, servers: str, topic: str = INPUT_TOPIC) -> DataFrame:
    options = broker_options(servers, topic, rows_per_trigger=None)
    return _text_rows(spark.read.format("kafka").options(**options).load())


def stream_topic_files(spark: SparkSession, folder: str, *, files_per_trigger: int = 100) -> DataFrame:
    """File twin of a topic: Parquet rows of the same shape, in arrival order of the files."""
    reader = spark.readStream.schema(RAW_READING).option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def message_rows(
    results: DataFrame,
    message: Column,
    *,
    identity: list[str],
    topic: Column | None = None,
    key: Column | None = None,
) -> DataFrame:
    """Rows for a topic: (topic, key, value, id).

    ``id`` names the result, not the attempt, so a consumer can drop repeats that
    at-least-once delivery may cause.
    """
    return results.select(
        (F.lit(OUTPUT_TOPIC) if topic is None else topic).alias("topic"),
        (F.lit(OUTPUT_KEY) if key is None else key).alias("key"),
        message.alias("value"),
        F.concat_ws("/", *[F.col(c).cast("string") for c in identity]).alias("id"),
    )


def route(
    results: DataFrame,
    message: Column,
    *,
    identity: list[str],
    next_topic: Callable[[DataFrame], Column],
    next_key: Callable[[DataFrame], Column],
) -> DataFrame:
    """Rows for the next stage, topic and key chosen per result by the caller's functions."""
    return message_rows(
        results, message, identity=identity, topic=next_topic(results), key=next_key(results)
    )


def _with_id_header(rows: DataFrame) -> DataFrame:
    header = F.struct(F.lit("id").alias("key"), F.col("id").cast("binary").alias("value"))
    return rows.select("topic", "key", "value", F.array(header).alias("headers"))


def write_topic(rows: DataFrame, servers: str, *, partitions: int | None = TOPIC_PARTITIONS) -> None:
    """Batch write; rows of a key leave from one task so their order is kept."""
    spread = rows if partitions is None else rows.repartition(partitions, "key")
    (
        _with_id_header(spread)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.enable.idempotence", "true")
        .option("includeHeaders", "true")
        .save()
    )


def topic_writer(rows: DataFrame, servers: str, checkpoint: str) -> DataStreamWriter:
    return (
        _with_id_header(rows)
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.enable.idempotence", "true")
        .option("includeHeaders", "true")
        .option("checkpointLocation", checkpoint)
    )


def file_topic_writer(rows: DataFrame, folder: str, checkpoint: str) -> DataStreamWriter:
    """Exactly-once twin: Parquet files, one folder per topic."""
    return (
        rows.writeStream.format("parquet")
        .partitionBy("topic")
        .option("path", folder)
        .option("checkpointLocation", checkpoint)
    )


def console_writer(rows: DataFrame) -> DataStreamWriter:
    """Print arriving rows (the output reader)."""
    return rows.writeStream.format("console").option("truncate", False)


def write_result_tables(tables: dict[str, DataFrame], folder: str) -> None:
    """Replace each named result table (topology, per node, general, ...)."""
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/{name}")


def in_order(df: DataFrame, order: Sequence[str], *, first: int | None = None) -> DataFrame:
    """The result sorted for a sink or a reader; ``first`` keeps that many rows of it."""
    rows = df.orderBy(*order)
    return rows if first is None else rows.limit(first)


# Times to the microsecond; the defaults of the format cut them.
_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def write_csv(df: DataFrame, folder: str, *, rows_per_file: int = 1_000_000) -> None:
    """CSV with header, replacing the folder; file size is bounded without counting first."""
    df.write.mode("overwrite").options(header=True, maxRecordsPerFile=rows_per_file, **_TIMES).csv(folder)


def read_csv(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """A result written by ``write_csv``."""
    return spark.read.schema(schema).options(header=True, **_TIMES).csv(folder)


def preview(df: DataFrame, rows: int = 10) -> None:
    df.printSchema()
    df.show(rows)
