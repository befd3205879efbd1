"""Keyed sensor readings: parsing, validity, rejection, re-routing and count windows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import ordered

# Sensor type -> (valid low, valid high, window size, window slide).
SENSOR_TYPES = {
    "temperature": (-50.0, 100.0, 10, 5),
    "humidity": (0.0, 100.0, 15, 5),
    "wind": (0.0, 200.0, 20, 10),
    "airQuality": (0.0, 500.0, 30, 10),
}

CONFIG = T.StructType(
    [
        T.StructField("sensor_type", T.StringType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("size", T.IntegerType()),
        T.StructField("slide", T.IntegerType()),
    ]
)

# Largest configuration that is broadcast; a bigger one is joined by shuffling.
MAX_BROADCAST_TYPES = 10_000


def _smallest(column: str) -> Column:
    """Minimum that is NaN as soon as one value is, like the other aggregates."""
    return F.when(F.bool_or(F.isnan(column)), F.lit(float("nan"))).otherwise(F.min(column))


AGGREGATES: dict[str, Callable[[str], Column]] = {
    "average": F.avg,
    "sum": F.sum,
    "min": _smallest,
    "max": F.max,
}


def aggregate(name: str) -> Callable[[str], Column]:
    """Aggregate function by its name; users may add their own to ``AGGREGATES``."""
    try:
        return AGGREGATES[name]
    except KeyError:
        raise ValueError(f"no aggregate named {name!r}; known: {sorted(AGGREGATES)}") from None


def sensor_config(spark, types: Mapping[str, Sequence] | None = None) -> DataFrame:
    """One row per known sensor type; broadcast only while it is a small table."""
    types = SENSOR_TYPES if types is None else types
    for name, (_, _, size, slide) in types.items():
        if size < 1 or slide < 1:
            raise ValueError(f"window size and slide of {name} must be at least 1")
    rows = [(name, float(low), float(high), size, slide) for name, (low, high, size, slide) in types.items()]
    config = spark.createDataFrame(rows, CONFIG)
    return F.broadcast(config) if len(rows) <= MAX_BROADCAST_TYPES else config


def parse_values(raw: DataFrame, *, text: str = "value", out: str = "value") -> DataFrame:
    """Text to double; ``is_malformed`` marks rows for the quarantine."""
    number = F.col(text).try_cast("double")
    return raw.withColumn("__number", number).select(
        *[c for c in raw.columns if c not in (text, out)],
        F.col("__number").alias(out),
        (F.col("__number").isNull()).alias("is_malformed"),
    )


def flag_out_of_range(readings: DataFrame, config: DataFrame) -> DataFrame:
    """Add ``is_anomaly``; types without a configured range are never anomalous."""
    ranges = config.select("sensor_type", "low", "high")
    # A value that is not a number lies on neither side; Spark would order it above every number.
    value = F.col("value")
    outside = (value < F.col("low")) | ((value > F.col("high")) & ~F.isnan(value))
    return (
        readings.join(ranges, "sensor_type", "left")
        .withColumn("is_anomaly", F.coalesce(outside, F.lit(False)))
        .drop("low", "high")
    )


def known_types(readings: DataFrame, config: DataFrame) -> DataFrame:
    return readings.join(config.select("sensor_type"), "sensor_type", "left_semi")


def unknown_types(readings: DataFrame, config: DataFrame) -> DataFrame:
    """Readings no window configuration exists for (rejected)."""
    return readings.join(config.select("sensor_type"), "sensor_type", "left_anti")


def sample_for_rerouting(
    readings: DataFrame, *, record: Sequence[str], types: Sequence[str], per_mille: int = 100
) -> DataFrame:
    """A fixed share of records, each sent on to the topic of one of ``types``.

    Choice and target come from a digest of the record's position, so a retried task
    picks the same records again.
    """
    digest = F.md5(F.concat_ws(":", *[F.col(c).cast("string") for c in record]))
    share = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    target = F.conv(F.substring(digest, 9, 8), 16, 10).cast("bigint")
    chosen = F.element_at(
        F.array(*[F.lit(t) for t in types]), (F.pmod(target, F.lit(len(types))) + 1).cast("int")
    )
    return readings.filter(F.pmod(share, F.lit(1000)) < per_mille).withColumns(
        {"target_type": chosen, "topic": F.concat(chosen, F.lit("-data"))}
    )


def with_window_positions(
    readings: DataFrame,
    *,
    keys: Sequence[str] = ("sensor_type",),
    order: str = "seq",
    reset: str = "is_anomaly",
    control: str | None = None,
    limit: int = ordered.ROW_LIMIT,
) -> DataFrame:
    """Add ``epoch`` (resets seen before the row) and ``position`` (1-based inside the epoch).

    A row flagged ``reset`` still belongs to the epoch it closes.  Rows flagged
    ``control`` are reset commands: they close the epoch, hold no reading and are
    removed from the result.
    """
    names = [*readings.columns, "epoch", "position"]
    is_value = F.lit(True) if control is None else ~F.col(control)
    resets = F.col(reset) if control is None else (F.col(reset) | F.col(control))
    cut = ordered.chunked(readings, keys, order, limit).with_columns(
        {"__one": is_value.cast("bigint"), "__reset": resets.cast("bigint")}
    )
    local = ordered.chunk_window(keys, order)
    here = local.rowsBetween(Window.unboundedPreceding, 0)
    earlier = local.rowsBetween(Window.unboundedPreceding, -1)
    cut = cut.with_columns(
        {
            "__count": F.sum("__one").over(here),
            "__resets": F.coalesce(F.sum("__reset").over(earlier), F.lit(0)),
        }
    )
    # Readings of the chunk up to and including its last reset row before this one.
    closed = F.when(F.col("__reset") == 1, F.col("__count"))
    cut = cut.with_columns({"__mark": closed, "__closed": F.max(closed).over(earlier)})
    before, zero = ordered.before(keys), F.lit(0).cast("bigint")
    rows = cut.carry(
        {"__n": F.sum("__one"), "__r": F.sum("__reset"), "__m": F.max("__mark")},
        {
            "__resets_before": F.coalesce(F.sum("__r").over(before), zero),
            "__n_before": F.coalesce(F.sum("__n").over(before), zero),
            # Readings of the key up to the chunk's last reset; the window is open since then.
            "__at_reset": F.col("__n_before") + F.col("__m"),
            "__opened": F.coalesce(F.last("__at_reset", ignorenulls=True).over(before), zero),
        },
        {"__resets_before": zero, "__n_before": zero, "__opened": zero},
    )
    rows = rows.withColumns(
        {
            "epoch": F.col("__resets_before") + F.col("__resets"),
            "position": F.col("__count")
            - F.coalesce(F.col("__closed"), F.col("__opened") - F.col("__n_before")),
        }
    )
    return (rows if control is None else rows.filter(is_value)).select(*names)


def count_windows(
    positions: DataFrame,
    config: DataFrame,
    *,
    aggregates: Sequence[str] = ("average",),
    keys: Sequence[str] = ("sensor_type",),
    value: str = "value",
) -> DataFrame:
    """Sliding windows of ``size`` readings, moved by ``slide``, inside each epoch.

    Window m covers positions m*s+1 .. m*s+size with s = min(slide, size); only full
    windows are emitted.  A reading joins at most ceil(size / s) windows, and windows
    are combined before the shuffle, so the load does not depend on the number of keys.
    """
    columns = [aggregate(name)(value).alias(name) for name in aggregates]
    sizes = config.select("sensor_type", "size", F.least("slide", "size").alias("__step"))
    zero_based = F.col("position") - 1
    lowest = F.greatest(
        F.lit(0), F.floor((F.col("position") - F.col("size") + F.col("__step") - 1) / F.col("__step"))
    )
    highest = F.floor(zero_based / F.col("__step"))
    return (
        positions.join(sizes, "sensor_type")
        .withColumns({"__lowest": lowest, "__highest": highest})
        .filter(F.col("__lowest") <= F.col("__highest"))
        .withColumn("window_no", F.explode_outer(F.sequence("__lowest", "__highest")))
        .groupBy(*keys, "epoch", "window_no", "size")
        .agg(F.count(F.lit(1)).alias("__held"), *columns)
        .filter(F.col("__held") == F.col("size"))
        .drop("__held")
    )
