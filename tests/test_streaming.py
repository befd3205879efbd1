"""Streams fed file by file, stopped and started again; rows must equal the batch operators."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.operators import metrics, reports, sensor
from tidewire.schemas import RAW_READING
from tidewire.sources import topics
from tidewire.streaming import count_windows, network_state, runs, time_windows
from tests_support import count_window_model

START = datetime(2024, 1, 1)


def deliver(df, folder, number):
    df.coalesce(1).write.parquet(f"{folder}/delivery={number:03d}")


@pytest.fixture(scope="module")
def messages():
    rng = random.Random(21)
    out = []
    for offset in range(600):
        key = "temperature" if rng.random() < 0.5 else rng.choice(["humidity", "wind", "smoke"])
        value = rng.choice(["nonsense", "999"]) if rng.random() < 0.06 else str(rng.randint(0, 50))
        out.append((key, value, 0, offset, START + timedelta(seconds=offset), rng.random() < 0.03))
    return out


DELIVERIES = [(0, 7), (7, 250), (250, 251), (251, 600)]


def start_processor(spark, source, folder, config, schema):
    rows = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(source)
    readings = count_windows.keyed_readings(
        rows.filter("not flush").drop("flush"), config, rows.filter("flush").select("key", "partition", "offset")
    )
    windows = count_windows.count_windows(readings, aggregate="sum")
    runs.run_available(runs.file_writer(windows, f"{folder}/rows", f"{folder}/checkpoint"))
    return spark.read.parquet(f"{folder}/rows")


def start_trigger_windows(spark, source, folder, config, schema):
    rows = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(source)
    readings = count_windows.keyed_readings(
        rows.filter("not flush").drop("flush"), config, rows.filter("flush").select("key", "partition", "offset")
    )
    handler = count_windows.TriggerWindows(folder, config, aggregate="sum", limit=40)
    runs.run_available(
        readings.writeStream.foreachBatch(handler).option("checkpointLocation", f"{folder}/checkpoint")
    )
    return handler.result(spark)


@pytest.mark.parametrize("start", [start_processor, start_trigger_windows])
def test_count_windows_survive_restarts(spark, tmp_path, messages, start):
    runs.use_durable_state(spark)
    source, folder = str(tmp_path / "in"), str(tmp_path / "out")
    config = sensor.sensor_config(spark)
    schema = T.StructType([*RAW_READING.fields, T.StructField("flush", T.BooleanType())])
    # Uneven deliveries, each followed by a stop; the last start finds nothing new.
    for number, (low, high) in enumerate(DELIVERIES):
        df = spark.createDataFrame(messages[low:high], schema).orderBy(F.rand(1))
        deliver(df, source, number)
        start(spark, source, folder, config, schema)
    found = start(spark, source, folder, config, schema)
    got = [tuple(r) for r in found.select("sensor_type", "epoch", "window_no", "result").collect()]
    rows = []
    for key, value, _, offset, _, flush in messages:
        known = key in sensor.SENSOR_TYPES
        if flush and known:
            rows.append((key, offset, 0.0, False, True))
        elif known and value != "nonsense":
            low, high = sensor.SENSOR_TYPES[key][:2]
            rows.append((key, offset, float(value), not low <= float(value) <= high, False))
    sizes = {k: (v[2], v[3]) for k, v in sensor.SENSOR_TYPES.items()}
    want = [(k, e, n, s) for k, e, n, _, s, _, _ in count_window_model(rows, sizes)]
    assert sorted(got) == sorted(want) and len(want) > 20


def test_repeated_trigger_changes_nothing(spark, tmp_path, messages):
    config = sensor.sensor_config(spark)
    handler = count_windows.TriggerWindows(str(tmp_path), config)
    values = [("wind", float(i % 40), i, False, False) for i in range(95)]
    schema = "sensor_type string, value double, offset long, is_anomaly boolean, is_command boolean"
    first, second = (spark.createDataFrame(part, schema) for part in (values[:33], values[33:]))
    for batch, number in ((first, 0), (first, 0), (second, 1), (second, 1)):
        handler(batch, number)
    got = sorted((r.window_no, round(r.result, 9)) for r in handler.result(spark).collect())
    assert got == [(n, round(sum(v[1] for v in values[10 * n : 10 * n + 20]) / 20, 9)) for n in range(8)]


@pytest.mark.parametrize("resets,want", [(False, [0, 1, 2, 3]), (True, [0, 1])])
def test_malformed_text_resets_on_request_only(spark, resets, want):
    raw = [("wind", "x" if i == 35 else str(i), 0, i) for i in range(55)]
    df = spark.createDataFrame(raw, "key string, value string, partition int, offset long")
    config = sensor.sensor_config(spark)
    rows = count_windows.keyed_readings(df, config, reset_on_malformed=resets).drop("size", "slide")
    positions = sensor.with_window_positions(rows, order="offset", control="is_command")
    windows = sensor.count_windows(positions, config).filter("epoch = 0").collect()
    assert sorted(r.window_no for r in windows) == want


def test_unknown_aggregate():
    with pytest.raises(ValueError, match="median"):
        count_windows.CountWindow("median")


@pytest.fixture(scope="module")
def mesh():
    rng = random.Random(8)
    t, rows = START, []
    for offset in range(240):
        t += timedelta(seconds=rng.choice([1, 7, 30]), microseconds=rng.randint(1, 900))
        node = 2 if rng.random() < 0.4 else rng.randint(3, 9)
        listed = [(n, 1.0) for n in rng.sample(range(1, 10), 3) if n != node]
        rows.append(("n", offset, t, node, offset % 5, rng.choice([None, rng.randint(1, node - 1)]), "OF0", 300, 2, False, listed))
    return rows


MESH = (
    "network string, offset long, received_at timestamp, node_id long, seq long, parent_id long, objective_function string, "
    "rank int, dag_rank int, is_root boolean, neighbors array<struct<id:bigint,cost:double>>"
)


def decoded(df):
    return df.withColumns({"t": F.unix_micros("received_at"), "degree": F.size("neighbors")})


def test_network_state_equals_batch(spark, tmp_path, mesh):
    runs.use_durable_state(spark)
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    resets = {100}

    def start():
        rows = spark.readStream.schema(MESH).option("recursiveFileLookup", True).parquet(source)
        is_reset = F.col("offset").isin(*resets)
        states = network_state.snapshots(
            decoded(rows.filter(~is_reset)), every=60, stale=120, resets=rows.filter(is_reset), shards=4
        )
        runs.run_available(runs.file_writer(states, out, checkpoint))

    for number, (low, high) in enumerate([(0, 90), (90, 101), (101, 240)]):
        deliver(spark.createDataFrame(mesh[low:high], MESH), source, number)
        start()
    got = spark.read.parquet(out).select("epoch", "tick", "node_id", "offset", "parent_id", "degree", "age", "seq", F.col("rank").cast("long"))
    got = [tuple(r) for r in got.collect()]

    whole = decoded(spark.createDataFrame(mesh, MESH))
    cleared = reports.resets_as_epochs(whole, reset=F.col("offset").isin(*resets))
    history = reports.with_history(cleared, stale=120, keys=["network", "epoch", "node_id"])
    batch = reports.state_at_intervals(history, every=60, stale=120).select(
        "epoch", "tick", "node_id", "offset", "parent_id", F.col("degree").cast("long"), "age", "seq", F.col("rank").cast("long")
    )
    end = max(r[2] for r in mesh)
    reset_at = next(r[2] for r in mesh if r[1] in resets)
    # The stream stops at the newest report, and an epoch's ticks stop at its reset.
    limit = {0: reset_at.timestamp(), 1: end.timestamp()}
    offset = START.timestamp() - 1704067200
    want = [tuple(r) for r in batch.collect() if r.tick < limit[r.epoch] - offset]
    assert sorted(got, key=str) == sorted(want, key=str) and len(want) > 100


def test_tick_metrics_are_replaced_not_repeated(spark, tmp_path, mesh):
    whole = decoded(spark.createDataFrame(mesh, MESH)).withColumn("epoch", F.lit(0).cast("long"))
    history = reports.with_history(whole, stale=120, keys=["network", "epoch", "node_id"])
    states = reports.state_at_intervals(history.drop("session_start"), every=300, stale=120).drop("received_at")
    handler = network_state.TickMetrics(str(tmp_path / "m"))
    middle = states.filter("tick < 1704068400")
    handler(middle, 0)
    handler(middle, 0)
    handler(states.filter("tick >= 1704068400"), 1)
    got = handler.result(spark).select("tick", "node_count", "diameter", "depth_avg").collect()
    want = metrics.instant(
        reports.add_synthetic_root(states, keys=("network", "epoch", "tick")), keys=("network", "epoch", "tick")
    ).select("tick", "node_count", "diameter", "depth_avg")
    assert sorted(map(tuple, got)) == sorted(map(tuple, want.collect()))


def test_time_windows_on_a_stream(spark, tmp_path):
    from tidewire.operators import grid

    rows = [(x, 0, s, 1.5 * s * (x + 1)) for s in range(300) for x in range(2)]
    schema = "x int, y int, time_step int, temperature double, timestamp timestamp"
    df = spark.createDataFrame(rows, "x int, y int, time_step int, temperature double").withColumn(
        "timestamp", F.timestamp_seconds("time_step"))
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    for number in range(3):
        deliver(df.filter(F.col("time_step").between(100 * number, 100 * number + 99)), source, number)
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(source)
        runs.run_available(runs.file_writer(time_windows.sliding_window_differences(stream), out, checkpoint))
    names = ["x", "y", "window_start_step", "window_end_step", "temp_diff"]
    got = {tuple(r) for r in spark.read.parquet(out).select(*names).collect()}
    # A window is complete once the newest step has passed its end.
    whole = grid.sliding_window_differences(df).select(*names)
    want = {tuple(r) for r in whole.collect() if r.window_end_step < 290}
    assert got == want


def test_topic_options_and_rows(spark):
    options = topics.broker_options("host:1", "sensor-data")
    assert options["startingOffsets"] == "earliest" and options["kafka.isolation.level"] == "read_committed"
    assert "maxOffsetsPerTrigger" in options
    results = spark.createDataFrame([("wind", 0, 3, 61.0), ("wind", 1, 0, 5.0)], "t string, e long, n long, v double")
    rows = topics.message_rows(results, F.col("v").cast("string"), identity=["t", "e", "n"])
    assert {tuple(r) for r in rows.collect()} == {("output", "output", "61.0", "wind/0/3"), ("output", "output", "5.0", "wind/1/0")}
    routed = topics.route(
        results, F.col("v").cast("string"), identity=["t", "e", "n"],
        next_topic=lambda df: F.when(df["v"] > 50, "high").otherwise("low"), next_key=lambda df: df["t"])
    assert {(r.topic, r.key) for r in routed.collect()} == {("high", "wind"), ("low", "wind")}


def test_file_topic_and_result_tables(spark, tmp_path):
    rows = spark.createDataFrame([("a", "k", "v1", "1"), ("b", "k", "v2", "2")], "topic string, key string, value string, id string")
    deliver(rows, str(tmp_path / "in"), 0)
    stream = spark.readStream.schema(rows.schema).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    writer = topics.file_topic_writer(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
    runs.run_available(writer)
    runs.run_available(topics.file_topic_writer(stream, str(tmp_path / "out"), str(tmp_path / "cp")))
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).select("topic", "value").collect()} == {("a", "v1"), ("b", "v2")}
    for _ in range(2):
        topics.write_result_tables({"topology": rows, "general": rows.limit(1)}, str(tmp_path / "tables"))
    assert spark.read.parquet(str(tmp_path / "tables" / "topology")).count() == 2
    topics.preview(rows, 1)


def test_late_rows_and_open_windows_of_time_windows(spark, tmp_path):
    from tidewire.operators import grid

    rows = [(i % 3, i, f"2024-01-01 00:{(i * 7) % 60:02d}:00", float((i * 13) % 101)) for i in range(600)]
    table = spark.createDataFrame(rows, "cell int, time_step long, at string, temperature double").withColumn("timestamp", F.to_timestamp("at")).drop("at")
    handler = time_windows.PaneWindows(str(tmp_path), keys=["cell"], size="600 seconds", slide="60 seconds")
    for trigger, part in enumerate((2, 0, 1)):  # deliveries out of order; the last one twice
        handler(table.filter(F.col("time_step") % 3 == part), trigger)
    handler(table.filter(F.col("time_step") % 3 == 1), 2)
    whole = grid.sliding_window_differences(table, keys=["cell"], size="600 seconds", slide="60 seconds")
    assert sorted(map(tuple, handler.result(spark).collect())) == sorted(map(tuple, whole.collect()))
    restarted = time_windows.PaneWindows(str(tmp_path), keys=["cell"], size="600 seconds", slide="60 seconds")
    assert sorted(map(tuple, restarted.result(spark).collect())) == sorted(map(tuple, whole.collect()))


def test_triggers_leave_no_staged_folders(spark, tmp_path):
    from pathlib import Path

    from tidewire import storage

    staged = Path(storage.shared_folder(spark).removeprefix("file:")) / "tidewire"
    config = sensor.sensor_config(spark)
    handler = count_windows.TriggerWindows(str(tmp_path), config)
    before = set(staged.iterdir()) if staged.exists() else set()
    for trigger in range(5):
        raw = spark.createDataFrame([("wind", str(i % 7), 0, trigger * 40 + i) for i in range(40)], "key string, value string, partition int, offset long")
        handler(count_windows.keyed_readings(raw, config), trigger)
    assert set(staged.iterdir()) == before
    assert handler.result(spark).count() == (200 - 20) // 10 + 1


def test_states_equal_the_batch_whatever_the_order_of_arrival(spark, tmp_path):
    random.seed(4)
    rows = [
        ("n", i, (i * 700 + random.randint(0, 300)) * 1_000_000, random.randint(2, 9), random.choice([None, 1, 2, 3]), random.randint(0, 5))
        for i in range(240)
    ]
    schema = "network string, offset long, t long, node_id long, parent_id long, degree int"
    table = spark.createDataFrame(rows, schema)
    whole = reports.state_at_intervals(reports.with_history(table, stale=9000), every=3600, stale=9000)
    names = ["network", "tick", "node_id", "offset", "parent_id", "degree", "age"]
    want = sorted(map(str, whole.select(*names).collect()))
    for label, order in (("kept", (0, 1, 2)), ("mixed", (2, 0, 1)), ("again", (1, 0, 2))):
        handler = network_state.TriggerStates(str(tmp_path / label), every=3600, stale=9000)
        for trigger, part in enumerate(order):
            batch = table.filter((F.col("offset") >= part * 80) & (F.col("offset") < part * 80 + 80))
            handler(batch, trigger)
            if label == "again" and trigger == 1:
                handler(batch, trigger)
        assert sorted(map(str, handler.result(spark).select(*names).collect())) == want


@pytest.mark.parametrize("limit", [1 << 21, 15])
def test_offsets_of_several_partitions(spark, tmp_path, limit):
    """One key over three partitions that count their offsets alike; held readings stay before later ones."""
    config = sensor.sensor_config(spark)
    handler = count_windows.TriggerWindows(str(tmp_path), config, aggregate="sum", limit=limit)
    rows = [("wind", float(i * i % 97), 2 - i % 3, i // 3, False, False) for i in range(120)]
    schema = "sensor_type string, value double, partition int, offset long, is_anomaly boolean, is_command boolean"
    parts = [rows[:50], rows[50:57], rows[57:]]
    for number, part in enumerate(parts):
        handler(spark.createDataFrame(part, schema).orderBy(F.rand(2)), number)
    order = [r[1] for part in parts for r in sorted(part, key=lambda r: r[2:4])]
    got = sorted((r.window_no, r.result) for r in handler.result(spark).collect())
    assert got == [(n, sum(order[10 * n : 10 * n + 20])) for n in range(11)]
