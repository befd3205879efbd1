"""Count sliding windows on a stream, with reset by anomaly or command.

Two forms with the same result.  ``count_windows`` is a keyed state processor: lowest
latency, one task per key and trigger.  ``TriggerWindows`` runs the batch operator on every
trigger together with the readings still held: for backlogs and hot keys, because a long
key is cut over many tasks there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidewire import storage
from tidewire.operators import ordered, sensor

REDUCERS = {"average": np.mean, "sum": np.sum, "min": np.min, "max": np.max}

RESULT = T.StructType(
    [
        T.StructField("sensor_type", T.StringType()),
        T.StructField("epoch", T.LongType()),
        T.StructField("window_no", T.LongType()),
        T.StructField("size", T.IntegerType()),
        T.StructField("result", T.DoubleType()),
    ]
)

STATE = T.StructType(
    [
        T.StructField("held", T.ArrayType(T.DoubleType())),
        T.StructField("epoch", T.LongType()),
        T.StructField("window_no", T.LongType()),
    ]
)


class CountWindow(StatefulProcessor):
    """Holds at most ``size - 1`` readings per key between triggers."""

    def __init__(self, aggregate: str):
        if aggregate not in REDUCERS:
            raise ValueError(f"no aggregate named {aggregate!r}; known: {sorted(REDUCERS)}")
        self.reduce = REDUCERS[aggregate]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("window", STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # Rows of a trigger arrive in any order.  Their number is bounded by the source's trigger limit.
        batch = pd.concat(list(rows), ignore_index=True).sort_values(["partition", "offset"])
        known = self.state.exists()
        held, epoch, window_no = self.state.get() if known else ([], 0, 0)
        held = np.asarray(held, dtype=float)
        size = int(batch["size"].iloc[0])
        step = min(int(batch["slide"].iloc[0]), size)
        values = batch["value"].to_numpy(dtype=float)
        command = batch["is_command"].to_numpy(dtype=bool)
        ends = np.flatnonzero(batch["is_anomaly"].to_numpy(dtype=bool) | command)
        out = []
        start = 0
        for end in [*ends, len(values)]:
            last = end + 1 if end < len(values) and not command[end] else end
            held = np.concatenate([held, values[start:last]])
            if len(held) >= size:
                windows = np.lib.stride_tricks.sliding_window_view(held, size)[::step]
                out.append((epoch, window_no, self.reduce(windows, axis=1)))
                window_no += len(windows)
                held = held[len(windows) * step :]
            if end < len(values):
                held, epoch, window_no = held[:0], epoch + 1, 0
            start = end + 1
        self.state.update((held.tolist(), int(epoch), int(window_no)))
        for number, first, results in out:
            yield pd.DataFrame(
                {
                    "sensor_type": key[0],
                    "epoch": number,
                    "window_no": np.arange(first, first + len(results)),
                    "size": size,
                    "result": results,
                }
            )

    def close(self) -> None:
        pass


def _as_commands(rows: DataFrame) -> DataFrame:
    return rows.select(
        "sensor_type",
        F.lit(None).cast("double").alias("value"),
        "partition",
        "offset",
        F.lit(False).alias("is_anomaly"),
        F.lit(True).alias("is_command"),
    )


def keyed_readings(
    raw: DataFrame, config: DataFrame, commands: DataFrame | None = None, *, reset_on_malformed: bool = False
) -> DataFrame:
    """Rows for the processor: parsed, known types only, range-checked, with window sizes.

    ``raw`` holds key, value (text), partition, offset; ``commands`` holds key, partition,
    offset of manual reset commands, which share the readings' ordering.  Text that is not
    a number is left out, or on request resets its key like a command.
    """
    parsed = sensor.parse_values(raw.withColumnRenamed("key", "sensor_type"))
    good = parsed.filter(~F.col("is_malformed")).select("sensor_type", "value", "partition", "offset")
    rows = sensor.flag_out_of_range(good, config).withColumn("is_command", F.lit(False))
    if commands is not None:
        rows = rows.unionByName(_as_commands(commands.withColumnRenamed("key", "sensor_type")))
    if reset_on_malformed:
        rows = rows.unionByName(_as_commands(parsed.filter("is_malformed")))
    return rows.join(config.select("sensor_type", "size", "slide"), "sensor_type")


def count_windows(readings: DataFrame, *, aggregate: str = "average") -> DataFrame:
    """Emit each full window once, as soon as its last reading has arrived."""
    return readings.groupBy("sensor_type").transformWithStateInPandas(
        statefulProcessor=CountWindow(aggregate),
        outputStructType=RESULT,
        outputMode="Append",
        timeMode="None",
    )


class TriggerWindows:
    """``foreachBatch`` handler around the batch operator.

    Readings of a key are ordered by trigger, then by ``partition`` and ``offset``, which is unique inside a partition
    only; a batch without ``partition`` is one partition.  What an earlier trigger holds stays before what comes later.

    What outlives a trigger is written under its number: the held readings (fewer than a
    window per key) and, per key, how many resets and windows it has seen.  A repeated
    trigger reads the state before it and overwrites its own, so results stay exactly-once.
    """

    COLUMNS = ("sensor_type", "value", "partition", "offset", "is_anomaly", "is_command")
    ORDER = ("trigger", "partition", "offset")

    def __init__(self, folder: str, config: DataFrame, *, aggregate: str = "average", limit: int = ordered.ROW_LIMIT):
        sensor.aggregate(aggregate)
        self.folder, self.config, self.aggregate, self.limit = folder.rstrip("/"), config, aggregate, limit

    def _state(self, trigger: int) -> str:
        return f"{self.folder}/state/trigger={trigger}"

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        with storage.temporary(batch.sparkSession):
            self._trigger(batch, batch_id)

    def _trigger(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if "partition" not in batch.columns:
            batch = batch.withColumn("partition", F.lit(0))
        arrived = batch.select(*self.COLUMNS, F.lit(batch_id).cast("bigint").alias("trigger"))
        rows = storage.stage(arrived, "trigger")
        seen = rows.select("sensor_type").limit(0).selectExpr(
            "sensor_type", "cast(0 as bigint) as epochs", "cast(0 as bigint) as windows"
        )
        if batch_id > 0:
            rows = rows.unionByName(spark.read.schema(rows.schema).parquet(f"{self._state(batch_id - 1)}/held"))
            seen = spark.read.schema(seen.schema).parquet(f"{self._state(batch_id - 1)}/seen")
        positions = storage.stage(
            sensor.with_window_positions(
                rows.withColumn("at", F.struct(*self.ORDER)), order="at", control="is_command", limit=self.limit
            ),
            "positions",
        )
        # A command row holds no reading, so resets are counted on the rows, not on the positions.
        resets = rows.groupBy("sensor_type").agg(
            F.sum((F.col("is_anomaly") | F.col("is_command")).cast("bigint")).alias("resets")
        )
        sizes = self.config.select("sensor_type", "size", F.least("slide", "size").alias("step"))
        open_rows = positions.join(resets, "sensor_type").filter(F.col("epoch") == F.col("resets"))
        ends = open_rows.groupBy("sensor_type").agg(F.max("position").alias("last"))
        full = F.floor((F.coalesce("last", F.lit(0)) - F.col("size")) / F.col("step")) + 1
        keys = storage.stage(
            seen.join(resets.join(ends, "sensor_type", "left").join(sizes, "sensor_type"), "sensor_type", "full")
            .fillna(0, subset=["epochs", "windows", "resets"])
            .withColumn("emitted", F.greatest(F.lit(0), F.coalesce(full, F.lit(0)))),
            "keys",
        )
        windows = sensor.count_windows(positions, self.config, aggregates=[self.aggregate])
        before = keys.select("sensor_type", "epochs", F.col("windows").alias("__windows"))
        (
            windows.join(before, "sensor_type")
            .select(
                "sensor_type",
                (F.col("epoch") + F.col("epochs")).alias("epoch"),
                (F.col("window_no") + F.when(F.col("epoch") == 0, F.col("__windows")).otherwise(F.lit(0))).alias(
                    "window_no"
                ),
                "size",
                F.col(self.aggregate).alias("result"),
            )
            .write.mode("overwrite")
            .parquet(f"{self.folder}/windows/trigger={batch_id}")
        )
        held = open_rows.join(keys.select("sensor_type", "emitted", "step"), "sensor_type").filter(
            F.col("position") > F.col("emitted") * F.col("step")
        )
        held.select(*rows.columns).write.mode("overwrite").parquet(f"{self._state(batch_id)}/held")
        (
            keys.select(
                "sensor_type",
                (F.col("epochs") + F.col("resets")).alias("epochs"),
                (F.when(F.col("resets") == 0, F.col("windows")).otherwise(F.lit(0)) + F.col("emitted")).alias("windows"),
            )
            .write.mode("overwrite")
            .parquet(f"{self._state(batch_id)}/seen")
        )
        if batch_id > 1:
            storage.drop(spark, self._state(batch_id - 2))

    def result(self, spark) -> DataFrame:
        return spark.read.schema(RESULT).parquet(f"{self.folder}/windows/trigger=*")
