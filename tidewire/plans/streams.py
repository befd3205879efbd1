"""Registered queries that run a stream over the whole table to completion, and file round trips."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire import storage
from tidewire.functions import text
from tidewire.operators import reports, sensor
from tidewire.sources import grid_csv, reports_json, topics
from tidewire.streaming import count_windows, network_state, output_reader, result_tables, runs, time_windows

from . import catalog, views
from .catalog import Query, _windows, rounded


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    runs.use_durable_state(spark)
    table = f"{sf_dir}/events.parquet"
    # A file source watches folders; as a pattern the name fits a single file and a folder of parts.
    stream = spark.readStream.schema(spark.read.parquet(table).schema).parquet(f"{sf_dir}/[e]vents.parquet")
    return stream.select(
        "event_id", "ts", "user_id", "event_type", "value", F.get_json_object("props", "$.k").cast("bigint").alias("k")
    )


def _deliveries(spark: SparkSession, sf_dir: str, parts: int = 4) -> Iterator[DataFrame]:
    """The table in several deliveries, by event: a stream over what has come so far, once per delivery.

    A stream that is run on each of them is stopped and restarted from its checkpoint in between.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    table = spark.read.parquet(f"{sf_dir}/events.parquet")
    folder = storage.new_folder(spark, "deliveries")
    cuts = table.approxQuantile("event_id", [i / parts for i in range(1, parts)], 0.01)
    share = F.lit(0)
    for cut in cuts:
        share = share + (F.col("event_id") > cut).cast("int")
    for part in range(parts):
        views.spread(table.filter(share == part)).write.parquet(f"{folder}/part={part}")
        stream = spark.readStream.schema(table.schema).parquet(f"{folder}/part=*")
        yield stream.select(
            "event_id", "ts", "user_id", "event_type", "value", F.get_json_object("props", "$.k").cast("bigint").alias("k")
        )


def _trigger_windows(spark: SparkSession, sf_dir: str, readings_of: Callable[[DataFrame], DataFrame], label: str) -> DataFrame:
    folder = storage.new_folder(spark, label)
    handler = None
    for stream in _deliveries(spark, sf_dir):
        handler = count_windows.TriggerWindows(folder, sensor.sensor_config(spark))
        writer = readings_of(stream).writeStream.foreachBatch(handler).option("checkpointLocation", f"{folder}/checkpoint")
        runs.run_available(writer)
    return rounded(handler.result(spark), "result")


def _finished(rows: DataFrame, label: str) -> DataFrame:
    """Run to completion into a fresh folder of the shared storage and read the result."""
    spark = rows.sparkSession
    folder = storage.new_folder(spark, label)
    runs.run_available(runs.file_writer(rows, f"{folder}/rows", f"{folder}/checkpoint"))
    return spark.read.schema(rows.schema).parquet(f"{folder}/rows")


def _topic_rows(stream: DataFrame) -> DataFrame:
    return stream.select(
        views.sensor_type(F.col("event_type")).alias("key"),
        F.col("value").cast("string").alias("value"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
    )


def stream_count_windows(spark, sf_dir):
    """Several deliveries with a restart in between; the open windows are kept between triggers."""
    config = sensor.sensor_config(spark)
    return _trigger_windows(spark, sf_dir, lambda s: count_windows.keyed_readings(_topic_rows(s), config), "count-windows")


def stream_trigger_windows(spark, sf_dir):
    """The batch operator per trigger, with the open windows kept between triggers."""
    config = sensor.sensor_config(spark)
    folder = storage.new_folder(spark, "trigger-windows")
    handler = count_windows.TriggerWindows(folder, config)
    readings = count_windows.keyed_readings(_topic_rows(_event_stream(spark, sf_dir)), config)
    runs.run_available(
        readings.writeStream.foreachBatch(handler).option("checkpointLocation", f"{folder}/checkpoint")
    )
    return rounded(handler.result(spark), "result")


def stream_flush_windows(spark, sf_dir):
    config, is_command = sensor.sensor_config(spark), F.col("offset") % 97 == 0

    def readings(stream: DataFrame) -> DataFrame:
        rows = _topic_rows(stream)
        return count_windows.keyed_readings(rows.filter(~is_command), config, rows.filter(is_command))

    return _trigger_windows(spark, sf_dir, readings, "flush-windows")


def stream_time_windows(spark, sf_dir):
    """Windows per sensor type in place of cells; the event number stands for the step."""
    folder = storage.new_folder(spark, "time-windows")
    handler = time_windows.PaneWindows(folder, keys=["sensor_type"], size="100 hours", slide="10 hours")
    for stream in _deliveries(spark, sf_dir):
        rows = stream.select(
            views.sensor_type(F.col("event_type")).alias("sensor_type"),
            F.col("ts").cast("timestamp").alias("timestamp"),
            F.col("event_id").alias("time_step"),
            F.col("value").alias("temperature"),
        )
        runs.run_available(rows.writeStream.foreachBatch(handler).option("checkpointLocation", f"{folder}/checkpoint"))
    done = handler.result(spark)
    return rounded(done.select("sensor_type", "window_start_step", "window_end_step", "temp_diff"), "temp_diff")


def _network_states(spark, sf_dir, label: str, *, parts: int = 4, tables: bool = False, **options):
    """The handler after the last delivery; with ``tables`` the result tables that follow each trigger."""
    # The candidate neighbors need the highest node id, a value of the whole table.
    top = views.events(spark, sf_dir).agg(F.max("user_id") + 2).first()[0]
    folder = storage.new_folder(spark, label)
    states = network_state.TriggerStates(folder, every=views.DAY, stale=views.STALE, **options)
    results = result_tables.ResultTables(f"{folder}/tables")
    handler = result_tables.TriggerTables(states, results) if tables else states
    for stream in _deliveries(spark, sf_dir, parts):
        rows = reports.decode(views.mesh_reports(stream, max_node=F.lit(top)))
        runs.run_available(rows.writeStream.foreachBatch(handler).option("checkpointLocation", f"{folder}/checkpoint"))
    return results if tables else states


def stream_network_state(spark, sf_dir):
    states = _network_states(spark, sf_dir, "network-state").result(spark)
    return states.select("network", "tick", "node_id", "offset", "parent_id", "degree", "age")


def stream_network_metrics(spark, sf_dir):
    handler = _network_states(spark, sf_dir, "network-metrics", parts=2, with_metrics=True)
    figures = ["depth_avg", "neighbor_avg", "avg_path_len"]
    return rounded(
        handler.metrics_result(spark).select(
            "network", "tick", "node_count", "undirected_edge_count", "tree_edge_count", "diameter", *figures
        ),
        *figures,
    )


def stream_network_resets(spark, sf_dir):
    """Reset messages in a stream of reports: the epoch is carried from trigger to trigger and over restarts."""
    is_reset = F.col("offset") % 997 == 996
    handler = _network_states(spark, sf_dir, "network-resets", reset=is_reset)
    return handler.history_result(spark).select("offset", "node_id", "epoch", "parent_id", "session_start")


def stream_result_tables(spark, sf_dir):
    """The three tables as a reader sees them after the last trigger, all of one version."""
    results = _network_states(spark, sf_dir, "result-tables", parts=2, with_metrics=True, tables=True)
    topology, nodes, general = results.read(spark, "topology", "nodes", "general")
    named = [t.withColumn("result_table", F.lit(n)) for n, t in (("topology", topology), ("nodes", nodes), ("general", general))]
    return named[0].unionByName(named[1], allowMissingColumns=True).unionByName(named[2], allowMissingColumns=True)


def output_reader_once(spark, sf_dir):
    """An output topic into which every delivery comes a second time with the next one, read once over restarts."""
    runs.use_durable_state(spark)
    rows = storage.stage(output_topic_rows(spark, sf_dir), "output-rows")
    folder = storage.new_folder(spark, "output-topic")
    parts, hours = 4, 3600
    for part in range(parts + 1):
        # A message is written anew with the time of the writing.
        written = rows.withColumn("timestamp", F.timestamp_seconds(F.lit(part * hours)))
        for attempt, number in enumerate((part, part - 1)):
            written.filter(F.pmod(F.xxhash64("id"), F.lit(parts)) == number).write.parquet(f"{folder}/delivery={part}/attempt={attempt}")
        messages = output_reader.stream_messages(spark, f"{folder}/delivery=*/attempt=*")
        seen = output_reader.once(messages, within="2 hours").drop("timestamp")
        runs.run_available(runs.file_writer(seen, f"{folder}-read/rows", f"{folder}-read/checkpoint"))
    return spark.read.schema(rows.schema).parquet(f"{folder}-read/rows")


# --- sorted results and sinks ---------------------------------------------------------


def _sorted_csv(rows: DataFrame, order: list[str], label: str) -> DataFrame:
    """Write the result in order as CSV with header, and read it back."""
    spark = rows.sparkSession
    folder = storage.new_folder(spark, label)
    topics.write_csv(topics.in_order(rows, order), folder)
    return topics.read_csv(spark, folder, rows.schema)


def q1_sorted_csv(spark, sf_dir):
    return _sorted_csv(catalog.q1_consecutive_diff(spark, sf_dir), ["x", "y"], "q1-csv")


def q2_sorted_csv(spark, sf_dir):
    windows = catalog.q2_time_window(spark, sf_dir)
    return _sorted_csv(windows, ["x", "y", "window_start_step", "window_end_step"], "q2-csv")


def q3_sorted_csv(spark, sf_dir):
    return _sorted_csv(catalog.q3_max_window_diff(spark, sf_dir), ["x", "y"], "q3-csv")


def q1_first_rows(spark, sf_dir):
    return topics.in_order(catalog.q1_consecutive_diff(spark, sf_dir), ["x", "y"], first=20)


# --- file round trips and topic rows ------------------------------------------------


def grid_csv_snapshots(spark, sf_dir):
    """Grid written as one CSV snapshot per step and read back through the snapshot source."""
    cells = views.grid_cells(views.events(spark, sf_dir))
    folder = storage.new_folder(spark, "snapshots")
    grid_csv.write_snapshots(cells, folder)
    back = grid_csv.read_snapshots(spark, folder)
    return back.select(
        *[F.col(c).cast("bigint").alias(c) for c in ("x", "y", "time_step")],
        F.unix_seconds("timestamp").alias("seconds"),
        "temperature",
    )


def _report_messages(ev):
    """Reports as message text; every 19th message is cut short."""
    sent = views.mesh_reports(ev).withColumn("device_time", F.col("offset"))
    message = reports_json.to_report_json(sent.drop("offset", "network", "received_at"))
    cut = F.substring(message, 1, 40)
    return sent.select(F.when(F.col("offset") % 19 == 0, cut).otherwise(message).alias("value"))


def report_json_source(spark, sf_dir):
    """Messages written as text lines, read back, decoded."""
    folder = storage.new_folder(spark, "messages")
    _report_messages(views.events(spark, sf_dir)).write.text(folder)
    parsed = reports_json.well_formed(reports_json.parse_reports(reports_json.read_report_lines(spark, folder)))
    return parsed.select(
        F.col("device_time").alias("event_id"),
        F.col("node_id").cast("bigint").alias("node_id"),
        "seq",
        "objective_function",
        F.col("rank").cast("bigint").alias("rank"),
        F.size("neighbors").cast("bigint").alias("listed"),
    )


def report_json_quarantine(spark, sf_dir):
    messages = _report_messages(views.events(spark, sf_dir))
    broken = reports_json.quarantined(reports_json.parse_reports(messages))
    return broken.agg(F.count(F.lit(1)).alias("broken"), F.max(F.length("_corrupt")).cast("bigint").alias("longest"))


def output_topic_rows(spark, sf_dir):
    windows = _windows(spark, sf_dir)
    message = text.typed_result_message(F.col("sensor_type"), "average", F.col("average"))
    return topics.message_rows(windows, message, identity=["sensor_type", "epoch", "window_no"])


def next_topic_routing(spark, sf_dir):
    """Results sent on by level, keyed by type and epoch, written per topic and counted there."""
    windows = _windows(spark, sf_dir)
    rows = topics.route(
        windows,
        text.result_message(F.col("sensor_type"), "average", F.col("average")),
        identity=["sensor_type", "epoch", "window_no"],
        next_topic=lambda df: F.concat(
            F.when(df["average"] > 50, F.lit("high-")).otherwise(F.lit("low-")), df["sensor_type"]
        ),
        next_key=lambda df: F.concat_ws(":", df["sensor_type"], df["epoch"].cast("string")),
    )
    folder = storage.new_folder(spark, "topics")
    rows.write.partitionBy("topic").parquet(folder)
    stored = spark.read.parquet(folder)
    return stored.groupBy("topic").agg(F.count(F.lit(1)).alias("messages"), F.countDistinct("key").alias("keys"))


def reset_states(spark, sf_dir):
    """Reset messages between reports: node states never reach across one."""
    decoded = reports.decode(views.mesh_reports(views.events(spark, sf_dir)))
    cleared = reports.resets_as_epochs(decoded, reset=F.col("offset") % 997 == 996)
    history = reports.with_history(cleared, stale=views.STALE, keys=["network", "epoch", "node_id"])
    return history.select("offset", "node_id", "epoch", "parent_id", "session_start")


def kept_fields(spark, sf_dir):
    """Every field a report may leave out, filled with the node's last value of the session."""
    decoded = reports.decode(views.gappy_reports(views.events(spark, sf_dir)))
    history = reports.with_history(decoded, stale=views.STALE)
    whole = [F.col(c).cast("bigint").alias(c) for c in ("dodag_version", "rank", "dag_rank")]
    return history.select("offset", "node_id", "parent_id", "ipv6", "objective_function", "dodag_id", *whole, "session_start")


STREAMS: dict[str, Query] = {
    f.__name__: f
    for f in (
        stream_count_windows, stream_trigger_windows, stream_flush_windows, stream_time_windows, stream_network_state,
        stream_network_metrics, stream_network_resets, stream_result_tables, output_reader_once, grid_csv_snapshots, report_json_source, report_json_quarantine,
        output_topic_rows, next_topic_routing, reset_states, kept_fields, q1_sorted_csv, q2_sorted_csv, q3_sorted_csv,
        q1_first_rows,
    )
}
