"""Inputs of the registered queries, derived from the ``events`` table.

One event is one grid cell value, one sensor reading or one routing report, depending on
the view; all rows of the table take part in each of them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.operators import ordered, reports
from tidewire.storage import stage

HOUR = 3600
DAY = 24 * HOUR
STALE = 48 * HOUR
FRESH = 12 * HOUR

#: Events that a part of ``spread`` holds on average.
PART_ROWS = 1 << 16

TYPE_OF_EVENT = {"view": "temperature", "click": "humidity", "error": "wind", "purchase": "airQuality"}


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Times are compared as UTC throughout.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    k = F.get_json_object("props", "$.k").cast("bigint").alias("k")
    return spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id", "event_type", "value", k)


def spread(ev: DataFrame) -> DataFrame:
    """The events dealt into parts of like size, so that work on single events isn't left to a task per row group."""
    return ev.repartition(max(1, math.ceil(ev.count() / PART_ROWS)), "event_id")


def grid_cells(ev: DataFrame) -> DataFrame:
    """User -> cell, the user's event order -> step."""
    numbered = ordered.number_rows(
        ev.select("event_id", "user_id", "ts", "value"), keys=["user_id"], order="event_id", out="n"
    )
    return numbered.select(
        (F.col("user_id") % 16).alias("x"),
        F.expr("user_id div 16").alias("y"),
        (F.col("n") - 1).alias("time_step"),
        F.col("ts").alias("timestamp"),
        F.col("value").alias("temperature"),
    )


def sensor_type(event_type: Column) -> Column:
    named = F.when(F.lit(False), F.lit(""))
    for event, sensor in TYPE_OF_EVENT.items():
        named = named.when(event_type == event, F.lit(sensor))
    return named.otherwise(event_type)


def sensor_readings(ev: DataFrame) -> DataFrame:
    return ev.select(
        F.col("event_id").alias("seq"),
        "ts",
        F.col("user_id").alias("device_id"),
        sensor_type(F.col("event_type")).alias("sensor_type"),
        "value",
    )


def raw_readings(ev: DataFrame) -> DataFrame:
    """Readings as text; every 17th is not a number."""
    text = F.when(F.col("seq") % 17 == 0, F.lit("n/a")).otherwise(F.col("value").cast("string"))
    return sensor_readings(ev).withColumn("value", text)


def _hex(number: Column) -> Column:
    """As ``%x`` writes it, null included; the formatter itself takes several times as long."""
    return F.coalesce(F.lower(F.hex(number)), F.lit("null"))


def address(node: Column) -> Column:
    return F.concat(F.lit("fe80::"), _hex(node.bitwiseXOR(F.lit(512))), F.repeat(F.concat(F.lit(":"), _hex(node)), 3))


def lladdr(node: Column) -> Column:
    return F.repeat(F.lpad(F.lower(F.hex(node)), 4, "0"), 4)


def _with_candidates(ev: DataFrame, max_node: Column | None = None) -> DataFrame:
    """Each event as node ``user_id + 2`` with its six candidate neighbors."""
    if max_node is None:
        max_node = ev.select((F.max("user_id") + 2).alias("m")).scalar()
    nodes = ev.withColumn("node", F.col("user_id") + 2).withColumn("max_node", max_node)
    third = F.expr("node div 3")
    n = F.col("node")
    return nodes.withColumn(
        "candidates", F.array(F.greatest(F.lit(1), third), n * 3, n * 3 + 1, n * 3 + 2, n + 1, n - 1)
    ).withColumn(
        "parent",
        F.greatest(F.lit(1), F.when(F.col("k") % 10 == 0, F.expr("node div 2")).otherwise(third)),
    )


def mesh_reports(ev: DataFrame, *, flagged_roots: bool = False, max_node: Column | None = None) -> DataFrame:
    """Routing reports of one mesh, in message form (addresses, nested neighbors)."""
    k = F.col("k")
    null_int, null_double = F.lit(None).cast("int"), F.lit(None).cast("double")

    def neighbor(nb, j):
        metric = F.lit(128) + ((k * 7 + j * 13) % 60) * 8
        listed = F.struct(
            address(nb).alias("addr"),
            (metric.cast("int") if j not in (4, 5) else null_int).alias("rpl_link_metric"),
            (F.when(k % 3 == 0, (F.lit(160) + k).cast("double")) if j == 2 else null_double).alias("etx"),
            ((k * 2).cast("double") if j == 5 else null_double).alias("link_metric_to_neighbor"),
        )
        return F.when(nb.between(F.lit(1), F.col("max_node")) & ((k + j) % 5 != 0), listed)

    # One column per candidate: unlike a function over an array, they are compiled.
    neighbors = F.array_compact(F.array(*[neighbor(F.col("candidates")[j], j) for j in range(6)]))
    rank = F.lit(256) + k * 5
    if flagged_roots:
        rank = F.when(k < 3, F.lit(128)).otherwise(rank)
    return (
        _with_candidates(ev, max_node)
        .withColumn("rank", rank.cast("int"))
        .select(
            F.lit("mesh").alias("network"),
            F.col("event_id").alias("offset"),
            F.col("ts").alias("received_at"),
            F.col("node").cast("string").alias("node_id"),
            (k % 4).alias("seq"),
            F.when(k % 7 == 0, F.lit("null")).otherwise(address(F.col("parent"))).alias("preferred_parent"),
            F.when(F.col("user_id") % 2 == 0, F.lit("MRHOF")).otherwise(F.lit("OF0")).alias("objective_function"),
            "rank",
            F.expr("cast(floor(rank / 128) as int)").alias("dag_rank"),
            F.expr("floor(rank / 128) <= 1").alias("is_root"),
            neighbors.alias("neighbors"),
        )
    )


def gappy_reports(ev: DataFrame) -> DataFrame:
    """Reports that leave fields out now and then."""
    k, node = F.col("__k"), F.col("node_id").cast("bigint")
    known = mesh_reports(ev).join(ev.select(F.col("event_id").alias("offset"), F.col("k").alias("__k")), "offset")
    return known.withColumns(
        {
            "ipv6": F.when(k % 6 == 0, address(node)),
            "objective_function": F.when(k % 5 != 0, F.col("objective_function")),
            "dodag_id": F.when(k % 4 != 0, F.concat(F.lit("fd00::"), (k % 3).cast("string"))),
            "dodag_version": F.when(k % 2 == 0, k % 9).cast("int"),
            "rank": F.when(k % 3 != 1, F.col("rank")),
            "dag_rank": F.when(k % 3 != 2, F.col("dag_rank")),
        }
    ).drop("__k")


def node_reports(ev: DataFrame, **options) -> DataFrame:
    """Decoded reports with kept parents."""
    return reports.with_history(reports.decode(mesh_reports(spread(ev), **options)), stale=STALE)


def visible(ev: DataFrame, *, every: int = DAY, **options) -> DataFrame:
    """Reporting nodes at fixed ticks."""
    return reports.state_at_intervals(node_reports(ev, **options), every=every, stale=STALE)


def states(ev: DataFrame, **options) -> DataFrame:
    """Network state at fixed ticks, border router included."""
    # The state is read several times by every graph operator, the history behind it only once.
    return reports.add_synthetic_root(stage(visible(ev, **options), "visible"))


def neighbor_tables(ev: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Routing table and neighbor cache of each report, before they are merged."""
    k, j, nb = F.col("k"), F.col("j"), F.col("nb")
    entries = (
        _with_candidates(ev)
        .select("event_id", "node", "k", "parent", "max_node", F.posexplode("candidates").alias("j", "nb"))
        .filter(nb.between(F.lit(1), F.col("max_node")))
    )
    # A node can be candidate twice; its first place counts.
    entries = entries.filter(~((F.col("j") == 5) & (F.col("node") == 2)))
    routing = entries.filter((k + j) % 3 != 0).select(
        "event_id",
        F.col("node").alias("node_id"),
        # Every eleventh entry is known by a global address only.
        F.when(
            (k + j) % 11 == 0, F.format_string("fd00::%x:%x:%x:%x", nb.bitwiseXOR(F.lit(512)), nb, nb, nb)
        ).otherwise(address(nb)).alias("addr"),
        ((k * 7 + j * 13) % 120).alias("age"),
        (F.lit(128) + k + j).cast("int").alias("rank"),
        (F.lit(128) + (k * 3 + j) % 64).cast("int").alias("link_metric"),
        (j <= 1).alias("is_parent"),
        (nb == F.col("parent")).alias("is_preferred"),
        (j == 4).alias("is_default_route"),
    )
    cache = entries.filter((k + j) % 4 != 0).select(
        "event_id",
        F.col("node").alias("node_id"),
        address(nb).alias("addr"),
        ((k * 5 + j * 29) % 120).alias("age"),
        lladdr(nb).alias("lladdr"),
    )
    return routing, cache
