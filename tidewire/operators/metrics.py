"""Metrics per (network, tick), since-boot means, histories and result tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.functions import addresses, text
from tidewire.storage import stage

from . import graph, ordered

GRAPH = graph.GRAPH

# Instant metric -> name of its since-boot mean.
RUNNING = {
    "diameter": "diameter_avg",
    "depth_avg": "depth_avg_over_time",
    "neighbor_avg": "neighbor_avg_over_time",
    "avg_path_len": "avg_path_len_over_time",
}

HISTORY = 500


def basic_stats(df: DataFrame, value: str | Column, prefix: str, keys: Sequence[str]) -> DataFrame:
    """Mean (0 when empty), minimum and maximum (null when empty) of the non-null values per key."""
    value = F.col(value) if isinstance(value, str) else value
    return df.groupBy(*keys).agg(
        F.coalesce(F.avg(value), F.lit(0.0)).alias(f"{prefix}_avg"),
        F.min(value).alias(f"{prefix}_min"),
        F.max(value).alias(f"{prefix}_max"),
    )


def depth_stats(
    depths: DataFrame, roots: DataFrame, *, include_root: bool = False, keys: Sequence[str] = GRAPH
) -> DataFrame:
    """Depth statistics of the reachable nodes; the root's own 0 counts only on request, and once."""
    value = F.col("depth")
    if not include_root:
        # The root is the only node at depth 0.
        value = F.when(value > 0, value)
    stats = basic_stats(depths, value, "depth", keys)
    return roots.join(stats, list(keys), "left").withColumn(
        "depth_avg", F.coalesce("depth_avg", F.lit(0.0))
    )


def degree_stats(state: DataFrame, *, keys: Sequence[str] = GRAPH) -> DataFrame:
    """Neighbor counts across the nodes of a state, border router left out."""
    degree = F.when(F.col("node_id") != addresses.ROOT_ID, F.col("degree").cast("bigint"))
    return basic_stats(state, degree, "neighbor", keys)


def network_counts(state: DataFrame, edges: DataFrame, *, keys: Sequence[str] = GRAPH) -> DataFrame:
    """Nodes, undirected links and routing-tree links."""
    has_parent = F.col("parent_id").isNotNull() & (F.col("parent_id") != F.col("node_id"))
    nodes = state.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("node_count"), F.count(F.when(has_parent, 1)).alias("tree_edge_count")
    )
    links = edges.groupBy(*keys).agg(F.count(F.lit(1)).alias("undirected_edge_count"))
    return nodes.join(links, list(keys), "left").select(
        *keys,
        "node_count",
        F.coalesce("undirected_edge_count", F.lit(0)).cast("bigint").alias("undirected_edge_count"),
        "tree_edge_count",
    )


def last_reporter(state: DataFrame, *, keys: Sequence[str] = GRAPH) -> DataFrame:
    """Objective function and sequence number of the newest report each state has seen."""
    reported = F.when(~F.col("is_synthetic"), F.col("offset"))
    return state.groupBy(*keys).agg(
        F.max_by("objective_function", reported).alias("objective_function"),
        F.max_by("seq", reported).alias("round_seq"),
    )


def instant(
    state: DataFrame, *, keys: Sequence[str] = GRAPH, weighted: bool = False, fresh: float | None = None
) -> DataFrame:
    """One row of network metrics per state.

    The diameter and path length are those of the routing tree; ``weighted`` adds the
    hop and cost metrics of the mutual, fresh wireless graph.  The state is read once per
    metric: pass a staged one when it is costly to compute.
    """
    on = list(keys)
    chosen = graph.roots(state, keys=keys)
    depths = graph.depths(state, keys=keys)
    links = graph.wireless_edges(state, rule="any", keys=keys)
    out = (
        depth_stats(depths, chosen, keys=keys)
        .join(network_counts(state, links, keys=keys), on)
        .join(degree_stats(state, keys=keys), on)
        .join(last_reporter(state, keys=keys), on)
        .join(graph.tree_metrics(graph.tree_edges(state, keys=keys), keys=keys), on, "left")
        .withColumns(
            {
                "diameter": F.coalesce("diameter", F.lit(0)).cast("bigint"),
                "avg_path_len": F.coalesce("avg_path_len", F.lit(0.0)),
            }
        )
    )
    if weighted:
        mutual = stage(graph.wireless_edges(state, rule="mutual_fresh", fresh=fresh, keys=keys), "mutual")
        hops = graph.hop_metrics(mutual, keys=keys).select(
            *keys, F.col("diameter").alias("wireless_diameter"), F.col("avg_path_len").alias("wireless_avg_path_len")
        )
        costs = graph.weighted_metrics(mutual, keys=keys)
        added = ("wireless_diameter", "wireless_avg_path_len", "diameter_weighted", "avg_path_len_weighted")
        out = out.join(hops, on, "left").join(costs, on, "left").fillna(0, subset=list(added))
    return out


def running_means(
    instants: DataFrame, *, key: str = "network", order: str = "tick", limit: int = ordered.ROW_LIMIT
) -> DataFrame:
    """Since-boot means of the headline metrics up to each tick, with the number of samples."""
    sums = {f"__sum_{m}": F.col(m).cast("double") for m in RUNNING}
    sums["samples"] = F.lit(1).cast("bigint")
    rows = ordered.running_sums(instants, keys=[key], order=order, sums=sums, limit=limit)
    return rows.withColumns({out: F.col(f"__sum_{m}") / F.col("samples") for m, out in RUNNING.items()}).drop(
        *[f"__sum_{m}" for m in RUNNING]
    )


def recent_history(instants: DataFrame, *, rows: int = HISTORY, key: str = "network", order: str = "tick") -> DataFrame:
    """The newest ``rows`` metric rows of each network; map tasks pass on no more than that."""
    w = Window.partitionBy(key).orderBy(F.col(order).desc())
    return instants.withColumn("__n", F.row_number().over(w)).filter(F.col("__n") <= rows).drop("__n")


def by_objective(instants: DataFrame) -> DataFrame:
    """Metrics compared between objective functions."""
    spread = []
    for m in RUNNING:
        spread += [F.avg(m).alias(f"{m}_mean"), F.min(m).alias(f"{m}_low"), F.max(m).alias(f"{m}_high")]
    return instants.groupBy("objective_function").agg(F.count(F.lit(1)).alias("samples"), *spread)


def series_long(with_means: DataFrame) -> DataFrame:
    """Long form for charts: one row per tick and metric, instant and since-boot value."""
    points = F.array(
        *[
            F.struct(
                F.lit("apl" if m == "avg_path_len" else m).alias("metric"),
                F.col(m).cast("double").alias("instant"),
                F.col(mean).alias("avg"),
            )
            for m, mean in RUNNING.items()
        ]
    )
    return with_means.select("network", "tick", F.explode_outer(points).alias("p")).select("network", "tick", "p.*")


def summary(instants: DataFrame) -> DataFrame:
    """Short status row per tick."""
    return instants.select(
        "network",
        "tick",
        F.col("node_count").alias("nodes"),
        "diameter",
        F.round("depth_avg", 3).alias("depth_avg"),
        F.round("neighbor_avg", 3).alias("neighbor_avg"),
        F.col("objective_function").alias("of"),
        F.col("root_id").alias("root"),
    )


def degree_history(
    reports: DataFrame, *, order: str = "offset", limit: int = ordered.ROW_LIMIT
) -> DataFrame:
    """Per node since boot: samples (one per changed sequence number), min, max and midrange degree."""
    keys = ["network", "node_id"]
    rows = ordered.adjacent_rows(
        reports.select(*keys, order, "seq", F.col("degree").cast("bigint").alias("degree")),
        keys=keys,
        order=order,
        previous={"seq": "__seq", order: "__first"},
        limit=limit,
    )
    counted = rows.filter(F.col("__first").isNull() | ~F.col("seq").eqNullSafe(F.col("__seq")))
    return counted.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("samples"),
        F.min("degree").alias("min_neighbors"),
        F.max("degree").alias("max_neighbors"),
        (F.min("degree") + (F.max("degree") - F.min("degree")) / F.lit(2)).alias("avg_neighbors"),
    )


def degree_means(state: DataFrame) -> DataFrame:
    """Per node: true mean degree over the states it is visible in, root left out."""
    chosen = graph.roots(state).select(*GRAPH, F.col("root_id").alias("node_id"))
    degree = F.col("degree").cast("bigint")
    return (
        state.join(chosen, [*GRAPH, "node_id"], "left_anti")
        .groupBy("network", "node_id")
        .agg(
            F.count(F.lit(1)).alias("samples"),
            F.avg(degree).alias("avg_neighbors"),
            F.min(degree).alias("min_neighbors"),
            F.max(degree).alias("max_neighbors"),
        )
    )


def degree_at_messages(
    reports: DataFrame, *, stale: float, order: str = "offset", limit: int = ordered.ROW_LIMIT
) -> DataFrame:
    """Exact mode: at every message the visible reporting nodes, their mean degree and its since-boot mean.

    Sums over the visible nodes change only when a report arrives or runs out, so they are
    running sums of these changes: two rows per report instead of one row per message and
    node.  The router's own messages change nothing but get their row; without visible nodes the mean is 0.  A node's new report takes the place of its last one if that is still visible; a
    report that is not replaced in time leaves after ``stale`` seconds.
    """
    stays = F.lit(int(round(stale * 1_000_000)))
    keys = ["network", "node_id"]
    slim = reports.filter(F.col("node_id") != addresses.ROOT_ID).select(
        *keys, order, "t", F.col("degree").cast("bigint").alias("degree")
    )
    rows = ordered.adjacent_rows(
        slim,
        keys=keys,
        order=order,
        previous={"t": "__pt", "degree": "__pd"},
        following={"t": "__nt"},
        limit=limit,
    )
    replaces = F.coalesce(F.col("t") - F.col("__pt") <= stays, F.lit(False))
    arrivals = rows.select(
        "network",
        F.struct("t", F.lit(0).alias("kind"), F.col(order).alias("id")).alias("__at"),
        F.when(replaces, F.lit(0)).otherwise(F.lit(1)).cast("bigint").alias("__nodes"),
        (F.col("degree") - F.when(replaces, F.col("__pd")).otherwise(F.lit(0))).alias("__degrees"),
    )
    runs_out = F.coalesce(F.col("__nt") - F.col("t") > stays, F.lit(True))
    expiries = rows.filter(runs_out).select(
        "network",
        F.struct((F.col("t") + stays).alias("t"), F.lit(1).alias("kind"), F.col(order).alias("id")).alias("__at"),
        F.lit(-1).cast("bigint").alias("__nodes"),
        (-F.col("degree")).alias("__degrees"),
    )
    routers = reports.filter(F.col("node_id") == addresses.ROOT_ID).select(
        "network",
        F.struct("t", F.lit(0).alias("kind"), F.col(order).alias("id")).alias("__at"),
        F.lit(0).cast("bigint").alias("__nodes"),
        F.lit(0).cast("bigint").alias("__degrees"),
    )
    changes = stage(arrivals.unionByName(expiries).unionByName(routers), "changes")
    sums = {"visible": F.col("__nodes"), "degrees": F.col("__degrees")}
    totals = ordered.running_sums(changes, keys=["network"], order="__at", sums=sums, limit=limit)
    messages = totals.filter(F.col("__at.kind") == 0).select(
        "network",
        F.col("__at.id").alias(order),
        "visible",
        F.coalesce(F.try_divide("degrees", "visible"), F.lit(0.0)).alias("neighbor_avg"),
    )
    means = {"__sum": F.col("neighbor_avg"), "__n": F.lit(1).cast("bigint")}
    return (
        ordered.running_sums(messages, keys=["network"], order=order, sums=means, limit=limit)
        .withColumn("neighbor_avg_over_time", F.col("__sum") / F.col("__n"))
        .drop("__sum", "__n")
    )


def topology_table(nodes: DataFrame, *, include_root: bool = False) -> DataFrame:
    """Node | Parent | Neighbors, from ``graph.node_table`` rows."""
    rows = nodes if include_root else nodes.filter(~F.col("is_root"))
    return rows.select(
        *GRAPH,
        F.col("node_id").alias("Node"),
        text.parent_text(F.col("is_root"), F.col("parent_id")).alias("Parent"),
        text.joined_ids(F.col("neighbors")).alias("Neighbors"),
    )


def per_node_table(nodes: DataFrame, history: DataFrame | None, *, include_root: bool = False) -> DataFrame:
    """Node | average, min and max number of neighbors for the visible nodes.

    Without a history the current number stands in; a node without samples shows 0.
    The border router never has a row of its own statistics.
    """
    rows = nodes if include_root else nodes.filter(~F.col("is_root"))
    if history is None:
        now = F.col("neighbor_count")
        columns = [now.cast("double"), now, now]
    else:
        rows = rows.filter(F.col("node_id") != addresses.ROOT_ID).join(
            history.select("network", "node_id", "avg_neighbors", "min_neighbors", "max_neighbors"),
            ["network", "node_id"],
            "left",
        )
        columns = [
            F.round(F.coalesce("avg_neighbors", F.lit(0.0)), 2),
            F.coalesce("min_neighbors", F.lit(0)),
            F.coalesce("max_neighbors", F.lit(0)),
        ]
    names = ("avg_neigh", "min_neigh", "max_neigh")
    return rows.select(*GRAPH, F.col("node_id").alias("Node"), *[c.alias(n) for c, n in zip(columns, names)])


def general_table(with_means: DataFrame) -> DataFrame:
    """One row per network from its newest tick: instant and since-boot figures side by side."""
    newest = recent_history(with_means, rows=1)
    return newest.select(
        "network",
        "tick",
        F.coalesce("objective_function", F.lit("N/A")).alias("objective_function"),
        "diameter",
        F.round("diameter_avg", 3).alias("diameter_avg"),
        F.round("depth_avg_over_time", 3).alias("depth_avg"),
        "depth_min",
        "depth_max",
    )
