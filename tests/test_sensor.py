import random

import pytest
from pyspark.sql import functions as F

from tidewire.functions import text
from tidewire.operators import sensor
from tests_support import count_window_model


CONFIG = {"a": (3, 2), "b": (4, 4), "c": (2, 5), "d": (5, 1), "hot": (10, 3)}


def config_df(spark):
    return sensor.sensor_config(spark, {k: (0.0, 100.0, n, s) for k, (n, s) in CONFIG.items()})


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    out = []
    for seq in range(1500):
        key = "hot" if rng.random() < 0.5 else rng.choice("abcd")
        command = rng.random() < 0.02
        value = float(rng.randint(0, 100)) if rng.random() > 0.04 else 500.0
        out.append((key, seq, value, value > 100 and not command, command))
    return out


@pytest.mark.parametrize("limit", [1, 13, 200, 1 << 21])
def test_count_windows_match_model(spark, rows, limit):
    df = spark.createDataFrame(rows, "sensor_type string, seq long, value double, is_anomaly boolean, is_command boolean")
    positions = sensor.with_window_positions(df, control="is_command", limit=limit)
    got = sensor.count_windows(positions, config_df(spark), aggregates=list(sensor.AGGREGATES))
    got = {(r.sensor_type, r.epoch, r.window_no, round(r.average, 9), r.sum, r.min, r.max) for r in got.collect()}
    want = {(*w[:3], round(w[3], 9), *w[4:]) for w in count_window_model(rows, CONFIG)}
    assert got == want and len(want) > 100


def windows_of(spark, values, size, slide, resets=()):
    rows = [("a", i, float(v), i in resets, False) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "sensor_type string, seq long, value double, is_anomaly boolean, c boolean")
    config = sensor.sensor_config(spark, {"a": (0, 1, size, slide)})
    got = sensor.count_windows(sensor.with_window_positions(df), config, aggregates=["max"]).collect()
    return sorted(r.max for r in got)


def test_hand_made_windows(spark):
    assert windows_of(spark, range(10), 3, 2) == [2, 4, 6, 8]
    # Position 3 does not complete a window, position 4 does; both clear it afterwards.
    assert windows_of(spark, range(10), 3, 2, {3}) == [2, 6, 8]
    assert windows_of(spark, range(10), 3, 2, {4}) == [2, 4, 7, 9]
    # A slide beyond the size drops only what is held.
    assert windows_of(spark, range(10), 3, 7) == [2, 5, 8]
    assert windows_of(spark, range(2), 3, 1) == []


def test_names_and_sizes_are_checked(spark):
    with pytest.raises(ValueError, match="median"):
        sensor.aggregate("median")
    with pytest.raises(ValueError):
        sensor.sensor_config(spark, {"a": (0, 1, 3, 0)})


def test_parsing_ranges_and_unknown_types(spark):
    raw = spark.createDataFrame(
        [("temperature", "-50"), ("temperature", "100.5"), ("humidity", "x"), ("wind", " 7 "), ("smoke", "1e3"), ("wind", None)],
        "sensor_type string, value string",
    )
    config = sensor.sensor_config(spark)
    parsed = sensor.parse_values(raw)
    assert parsed.filter("is_malformed").count() == 2
    flagged = {(r.sensor_type, r.value): r.is_anomaly for r in sensor.flag_out_of_range(parsed.filter("not is_malformed"), config).collect()}
    assert flagged == {("temperature", -50.0): False, ("temperature", 100.5): True, ("wind", 7.0): False, ("smoke", 1000.0): False}
    assert [r.sensor_type for r in sensor.unknown_types(parsed, config).collect()] == ["smoke"]
    assert sensor.known_types(parsed, config).count() == 5


def test_rerouting_is_repeatable(spark):
    df = spark.range(20_000).select(F.lit(3).alias("partition"), F.col("id").alias("offset"))
    types = list(sensor.SENSOR_TYPES)
    once = sensor.sample_for_rerouting(df, record=["partition", "offset"], types=types)
    again = sensor.sample_for_rerouting(df.repartition(5), record=["partition", "offset"], types=types)
    assert 1800 < once.count() < 2200
    assert once.exceptAll(again).isEmpty() and again.exceptAll(once).isEmpty()
    per_type = {r.target_type: r["count"] for r in once.groupBy("target_type").count().collect()}
    assert per_type.keys() == set(types) and min(per_type.values()) > 400


def test_messages(spark):
    df = spark.createDataFrame([("wind", 9.5), ("airQuality", 20.0), ("temperature", 1.0)], "k string, v double")
    general = [r[0] for r in df.select(text.result_message(F.col("k"), "sum", F.col("v"))).collect()]
    assert general[0] == '{ "wind_sum": 9.500000}'
    typed = [r[0] for r in df.select(text.typed_result_message(F.col("k"), "average", F.col("v"))).collect()]
    assert typed == ["{ average wind speed: 9.500000}", "{ average Air quiality: 20.000000}", "{ average temperature: 1.000000}"]


def test_not_a_number_is_in_no_range_and_spreads(spark):
    nan = float("nan")
    config = sensor.sensor_config(spark)
    rows = spark.createDataFrame([("wind", nan), ("wind", 500.0), ("wind", -1.0), ("wind", 5.0), ("wind", None)], "sensor_type string, value double")
    assert [r.is_anomaly for r in sensor.flag_out_of_range(rows, config).collect()] == [False, True, True, False, False]
    values = spark.createDataFrame([(4.0,), (nan,), (6.0,)], "value double")
    found = values.agg(*[sensor.aggregate(n)("value").alias(n) for n in ("min", "max", "sum", "average")]).first()
    assert all(v != v for v in found)
    assert values.filter("value < 7").agg(sensor.aggregate("min")("value")).first()[0] == 4.0
