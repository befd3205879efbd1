"""Registered queries: each reads whole tables and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.functions import addresses, routing, text
from tidewire.operators import graph, grid, messages, metrics, reports, sensor

from . import views

Query = Callable[[SparkSession, str], DataFrame]


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Fold last-bit differences of summation order before results are compared."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- grid -------------------------------------------------------------------------


def q1_consecutive_diff(spark, sf_dir):
    cells = views.grid_cells(views.events(spark, sf_dir))
    return rounded(grid.difference_stats(cells), "min_temp_diff", "max_temp_diff", "avg_temp_diff")


def _time_windows(spark, sf_dir):
    cells = views.grid_cells(views.events(spark, sf_dir))
    return grid.sliding_window_differences(cells, size="100 hours", slide="10 hours")


def q2_time_window(spark, sf_dir):
    return rounded(_time_windows(spark, sf_dir), "temp_diff")


def q3_max_window_diff(spark, sf_dir):
    return rounded(grid.max_window_difference(_time_windows(spark, sf_dir)), "max_temperature_diff")


def step_convergence(spark, sf_dir):
    changes = grid.step_changes(views.grid_cells(views.events(spark, sf_dir)))
    first = grid.first_step_below(changes, 50.0)
    return rounded(
        changes.withColumns({"is_below": F.col("max_change") < 50, "first_step": first.scalar()}), "max_change"
    )


def stencil_residual(spark, sf_dir):
    cells = views.grid_cells(views.events(spark, sf_dir))
    return rounded(grid.stencil_residuals(cells, k=0.1), "expected", "residual")


# --- sensors ----------------------------------------------------------------------


def sensor_parse_quarantine(spark, sf_dir):
    raw = views.raw_readings(views.events(spark, sf_dir))
    return sensor.parse_values(raw).select("seq", "sensor_type", "value", "is_malformed")


def _flagged(spark, sf_dir):
    readings = views.sensor_readings(views.events(spark, sf_dir))
    return sensor.flag_out_of_range(readings, sensor.sensor_config(spark))


def sensor_range_flags(spark, sf_dir):
    return _flagged(spark, sf_dir).select("seq", "sensor_type", "value", "is_anomaly")


def unknown_sensor_reject(spark, sf_dir):
    readings = views.sensor_readings(views.events(spark, sf_dir))
    return sensor.unknown_types(readings, sensor.sensor_config(spark)).select(
        "seq", "device_id", "sensor_type", "value"
    )


def sample_reroute(spark, sf_dir):
    readings = views.sensor_readings(views.events(spark, sf_dir)).withColumn("partition", F.lit(0))
    return sensor.sample_for_rerouting(
        readings, record=["partition", "seq"], types=list(sensor.SENSOR_TYPES)
    ).select("seq", "value", "target_type", "topic")


def _positions(spark, sf_dir, control: Column | None = None, **options):
    config = sensor.sensor_config(spark)
    flagged = sensor.known_types(_flagged(spark, sf_dir), config)
    if control is None:
        return sensor.with_window_positions(flagged, **options)
    return sensor.with_window_positions(flagged.withColumn("is_command", control), control="is_command")


def _windows(spark, sf_dir, name="average", control: Column | None = None):
    positions = _positions(spark, sf_dir, control)
    return sensor.count_windows(positions, sensor.sensor_config(spark), aggregates=[name])


def count_window(name, spark, sf_dir):
    return rounded(_windows(spark, sf_dir, name).withColumnRenamed(name, "result"), "result")


def reset_epochs_cut(spark, sf_dir):
    """The same with every sensor type cut into chunks, as a key beyond the row limit is."""
    limit = max(20, views.events(spark, sf_dir).count() // 16)
    return _positions(spark, sf_dir, limit=limit).select("seq", "sensor_type", "is_anomaly", "epoch", "position")


def reset_epochs(spark, sf_dir):
    return _positions(spark, sf_dir).select("seq", "sensor_type", "is_anomaly", "epoch", "position")


def manual_flush_windows(spark, sf_dir):
    windows = _windows(spark, sf_dir, control=F.col("seq") % 97 == 0)
    return rounded(windows.withColumnRenamed("average", "result"), "result")


def window_message_format(spark, sf_dir):
    kind, result = F.col("sensor_type"), F.col("average")
    return _windows(spark, sf_dir).select(
        "sensor_type",
        "epoch",
        "window_no",
        text.result_message(kind, "average", result).alias("message"),
        text.typed_result_message(kind, "average", result).alias("typed_message"),
    )


# --- routing reports --------------------------------------------------------------


def _mesh(spark, sf_dir, **options):
    return views.mesh_reports(views.events(spark, sf_dir), **options)


def node_id_from_addr(spark, sf_dir):
    sent = _mesh(spark, sf_dir).select(views.address(F.col("node_id").cast("bigint")).alias("address"))
    return (
        sent.groupBy("address")
        .agg(F.count(F.lit(1)).alias("reports"))
        .select(addresses.node_id_from_address(F.col("address")).alias("node_id"), "address", "reports")
    )


def root_addresses(spark, sf_dir):
    """The border router's address as each report's DODAG id tells it: two forms that hold it, one that doesn't, none."""
    ev = views.events(spark, sf_dir).select("event_id", "k", views.address(F.col("user_id") + 2).alias("address"))
    dodag = (
        F.when(F.col("k") % 4 == 0, F.lit("fd00::201:1:1:1"))
        .when(F.col("k") % 4 == 1, F.concat(F.lit("FD00::"), F.upper(F.hex("k")), F.lit(":1:1:1")))
        .when(F.col("k") % 4 == 2, F.regexp_replace("address", "^fe80", "fd00"))
    )
    told = ev.select(F.col("event_id").alias("offset"), dodag.alias("dodag_id"))
    return told.withColumn("root_address", addresses.root_address(F.col("dodag_id")))


def link_local_from_lladdr(spark, sf_dir):
    node = F.col("node_id").cast("bigint")
    counted = _mesh(spark, sf_dir).groupBy(node.alias("node_id")).agg(F.count(F.lit(1)).alias("reports"))
    return counted.withColumn("lladdr", views.lladdr(F.col("node_id"))).withColumn(
        "link_local", addresses.link_local_from_lladdr(F.col("lladdr"))
    )


def link_cost(spark, sf_dir):
    decoded = reports.decode(_mesh(spark, sf_dir))
    return rounded(
        decoded.select("offset", "node_id", F.explode_outer("neighbors").alias("n"))
        .filter(F.col("n").isNotNull())
        .select(
            "offset", "node_id", F.col("n.id").alias("neighbor"), F.col("n.cost").alias("cost")
        ),
        "cost",
    )


def dag_rank(spark, sf_dir):
    rank = F.col("rank")
    return _mesh(spark, sf_dir, flagged_roots=True).select(
        "offset",
        F.col("node_id").cast("bigint").alias("node_id"),
        rank.cast("bigint").alias("rank"),
        routing.dag_rank(rank).cast("bigint").alias("dag_rank"),
        routing.is_root_rank(rank).alias("is_root"),
    )


def objective_names(spark, sf_dir):
    return _mesh(spark, sf_dir).select(
        "offset", F.col("seq").alias("code"), routing.objective_name(F.col("seq")).alias("name")
    )


def latest_report(spark, sf_dir):
    newest = reports.latest(views.node_reports(views.events(spark, sf_dir)))
    return newest.select(
        "network", "node_id", "offset", "seq", "parent_id", F.col("degree").cast("bigint").alias("degree"),
        "objective_function",
    )


def _states(spark, sf_dir, **options):
    return views.states(views.events(spark, sf_dir), **options)


def state_as_of_tick(spark, sf_dir):
    return _states(spark, sf_dir).select(
        "network", "tick", "node_id", "offset", "parent_id", F.col("degree").cast("bigint").alias("degree"), "age",
        "is_root",
    )


def state_as_of_instants(spark, sf_dir):
    """State at instants off the grid: the first message of every hour."""
    history = views.node_reports(views.events(spark, sf_dir))
    hour = F.floor(F.col("t") / F.lit(views.HOUR * 1_000_000))
    ticks = history.groupBy("network", hour.alias("hour")).agg(F.min("t").alias("tick_t"))
    seen = reports.state_at_ticks(history, ticks, stale=views.STALE)
    return seen.select("network", "tick_t", "node_id", "offset", "age")


def message_degree_means(spark, sf_dir):
    """Exact mode: visible nodes, their mean degree and its since-boot mean at every message."""
    history = views.node_reports(views.events(spark, sf_dir))
    return rounded(
        metrics.degree_at_messages(history, stale=views.STALE), "neighbor_avg", "neighbor_avg_over_time"
    )


def message_metrics(spark, sf_dir):
    """The whole metrics row at every message, with its since-boot means."""
    history = views.node_reports(views.events(spark, sf_dir))
    rows = messages.metrics_at_messages(history, stale=views.STALE).drop("position", "t")
    return rounded(rows, "depth_avg", "neighbor_avg", "avg_path_len", *metrics.RUNNING.values())


def sticky_parent(spark, sf_dir):
    return views.node_reports(views.events(spark, sf_dir)).select("offset", "node_id", "parent_id", "session_start")


def neighbor_sets(spark, sf_dir):
    decoded = reports.decode(_mesh(spark, sf_dir))
    return decoded.select(
        "offset",
        "node_id",
        F.col("degree").cast("bigint").alias("degree"),
        text.joined_ids(F.transform("neighbors", lambda n: n["id"])).alias("neighbors"),
    )


def neighbor_table_merge(spark, sf_dir):
    routed, cache = views.neighbor_tables(views.events(spark, sf_dir))
    merged = reports.merge_neighbor_tables(routed, cache, keys=["event_id", "node_id"])
    return merged.withColumns({c: F.col(c).cast("bigint") for c in ("rank", "dag_rank", "link_metric")})


# --- graph ------------------------------------------------------------------------


def wireless_edges_any(spark, sf_dir):
    return graph.wireless_edges(_states(spark, sf_dir), rule="any").drop("cost")


def wireless_edges_mutual(spark, sf_dir):
    return rounded(
        graph.wireless_edges(_states(spark, sf_dir), rule="mutual_fresh", fresh=views.FRESH), "cost"
    )


def symmetric_cost(spark, sf_dir):
    return rounded(graph.wireless_edges(_states(spark, sf_dir), rule="any"), "cost")


def edge_list_undirected(spark, sf_dir):
    return graph.edge_list(graph.wireless_edges(_states(spark, sf_dir), rule="any"))


def tree_edges(spark, sf_dir):
    return graph.tree_edges(_states(spark, sf_dir))


def node_depths(spark, sf_dir):
    return graph.depths(_states(spark, sf_dir))


def root_choice(spark, sf_dir):
    return graph.roots(_states(spark, sf_dir, flagged_roots=True))


def _mutual(spark, sf_dir, **options):
    return graph.wireless_edges(_states(spark, sf_dir, **options), rule="mutual_fresh", fresh=views.FRESH)


def hop_diameter_apl(spark, sf_dir):
    return rounded(graph.hop_metrics(_mutual(spark, sf_dir)), "avg_path_len")


def tree_diameter_apl(spark, sf_dir):
    return rounded(graph.tree_metrics(graph.tree_edges(_states(spark, sf_dir))), "avg_path_len")


def weighted_diameter_apl(spark, sf_dir):
    return rounded(
        graph.weighted_metrics(_mutual(spark, sf_dir)),
        "diameter_weighted",
        "avg_path_len_weighted",
    )


def node_table(spark, sf_dir):
    table = graph.node_table(_states(spark, sf_dir))
    return table.withColumns(
        {
            "neighbors": text.joined_ids(F.col("neighbors")),
            "rank": F.col("rank").cast("bigint"),
            "dag_rank": F.col("dag_rank").cast("bigint"),
        }
    )


# --- metrics and tables -----------------------------------------------------------


def depth_stats(spark, sf_dir):
    states = _states(spark, sf_dir)
    return rounded(metrics.depth_stats(graph.depths(states), graph.roots(states)), "depth_avg")


def degree_stats(spark, sf_dir):
    return rounded(metrics.degree_stats(views.visible(views.events(spark, sf_dir), every=views.HOUR)), "neighbor_avg")


def network_counts(spark, sf_dir):
    states = _states(spark, sf_dir)
    return metrics.network_counts(states, graph.wireless_edges(states, rule="any"))


def degree_midrange(spark, sf_dir):
    return metrics.degree_history(reports.decode(_mesh(spark, sf_dir)))


def degree_mean(spark, sf_dir):
    return rounded(metrics.degree_means(_states(spark, sf_dir)), "avg_neighbors")


def _instants(spark, sf_dir):
    return metrics.instant(_states(spark, sf_dir))


def instant_metrics(spark, sf_dir):
    return rounded(_instants(spark, sf_dir), "depth_avg", "neighbor_avg", "avg_path_len")


def running_means(spark, sf_dir):
    names = list(metrics.RUNNING.values())
    means = metrics.running_means(_instants(spark, sf_dir))
    return rounded(means.select("network", "tick", "samples", *names), *names)


def last_500(spark, sf_dir):
    hourly = metrics.degree_stats(views.visible(views.events(spark, sf_dir), every=views.HOUR))
    return rounded(metrics.recent_history(hourly), "neighbor_avg")


def metrics_by_objective(spark, sf_dir):
    compared = metrics.by_objective(_instants(spark, sf_dir))
    figures = [c for c in compared.columns if c not in ("objective_function", "samples")]
    return rounded(compared, *figures)


def metric_series_long(spark, sf_dir):
    return rounded(metrics.series_long(metrics.running_means(_instants(spark, sf_dir))), "instant", "avg")


def topology_table(spark, sf_dir):
    return metrics.topology_table(graph.node_table(_states(spark, sf_dir)))


def per_node_table(spark, sf_dir):
    ev = views.events(spark, sf_dir)
    history = metrics.degree_history(reports.decode(views.mesh_reports(ev)))
    return metrics.per_node_table(graph.node_table(views.states(ev)), history)


def general_table(spark, sf_dir):
    return metrics.general_table(metrics.running_means(_instants(spark, sf_dir)))


def network_summary(spark, sf_dir):
    return metrics.summary(_instants(spark, sf_dir))


BATCH: dict[str, Query] = {
    f.__name__: f
    for f in (
        q1_consecutive_diff, q2_time_window, q3_max_window_diff, step_convergence, stencil_residual,
        sensor_parse_quarantine, sensor_range_flags, unknown_sensor_reject, sample_reroute, reset_epochs, reset_epochs_cut,
        manual_flush_windows, window_message_format,
        node_id_from_addr, root_addresses, link_local_from_lladdr, link_cost, symmetric_cost, dag_rank, objective_names,
        latest_report, state_as_of_tick, state_as_of_instants, message_degree_means, message_metrics, sticky_parent, neighbor_sets, neighbor_table_merge,
        wireless_edges_any, wireless_edges_mutual, edge_list_undirected, tree_edges, node_depths, root_choice,
        hop_diameter_apl, tree_diameter_apl, weighted_diameter_apl, node_table,
        depth_stats, degree_stats, network_counts, degree_midrange, degree_mean, instant_metrics, running_means,
        last_500, metrics_by_objective, metric_series_long, topology_table, per_node_table, general_table,
        network_summary,
    )
}
BATCH.update(
    {
        "count_window_avg": partial(count_window, "average"),
        "count_window_sum": partial(count_window, "sum"),
        "count_window_min": partial(count_window, "min"),
        "count_window_max": partial(count_window, "max"),
    }
)
