"""Routing reports: decoding, keep-last fields, latest state and state as of each tick."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.functions import addresses, routing
from tidewire.storage import stage

from . import ordered

NODE = ("network", "node_id")

# Fields a report may leave out; the node's last value of the session is kept.
KEPT = ("parent_id", "ipv6", "objective_function", "dodag_id", "dodag_version", "rank", "dag_rank")


def decoded_neighbors(neighbors: Column) -> Column:
    """Decoded neighbors as (id, cost), unknown addresses dropped."""
    decoded = F.transform(
        neighbors,
        lambda n: F.struct(
            addresses.node_id_from_address(n["addr"]).alias("id"),
            routing.link_cost(n["etx"], n["rpl_link_metric"], n["link_metric_to_neighbor"]).alias("cost"),
        ),
    )
    return F.filter(decoded, lambda n: n["id"].isNotNull())


def decode(reports: DataFrame) -> DataFrame:
    """Report rows -> node state rows: ids as numbers, neighbor set with costs, degree.

    Needs network, offset (source position, unique per network), received_at, node_id,
    seq, preferred_parent, neighbors, is_root and the optional kept fields.
    Rows without a usable node id are left out (see ``undecodable``).
    """
    empty = F.expr("cast(array() as array<struct<id:bigint,cost:double>>)")
    listed = F.col("__listed")
    distinct_ids = F.size(F.array_distinct(F.transform(listed, lambda n: n["id"])))
    last_wins = F.filter(
        listed,
        lambda n, i: ~F.exists(F.slice(listed, i + 2, F.size(listed)), lambda later: later["id"] == n["id"]),
    )
    decoded = reports.withColumns(
        {
            "node_id": F.col("node_id").try_cast("bigint"),
            "parent_id": addresses.node_id_from_address(F.col("preferred_parent")),
            "__listed": F.coalesce(decoded_neighbors(F.col("neighbors")), empty),
            "is_root": F.coalesce(F.col("is_root"), F.lit(False)),
            "t": ordered.micros("received_at"),
        }
    ).filter(F.col("node_id").isNotNull())
    # The number of different ids is found once: it is read twice here.
    counted = decoded.withColumn("degree", distinct_ids)
    neighbors = F.when(F.col("degree") == F.size(listed), listed).otherwise(last_wins)
    return counted.withColumn("neighbors", neighbors).drop("__listed", "preferred_parent")


def undecodable(reports: DataFrame) -> DataFrame:
    """Quarantine: reports without a numeric node id."""
    return reports.filter(F.col("node_id").try_cast("bigint").isNull())


def _micros(seconds: float) -> int:
    return int(round(seconds * 1_000_000))


def with_history(
    reports: DataFrame,
    *,
    stale: float,
    columns: Sequence[str] | None = None,
    keys: Sequence[str] = NODE,
    order: str = "offset",
    limit: int = ordered.ROW_LIMIT,
) -> DataFrame:
    """Fill missing fields with the node's last value and add what its neighbors in time decide.

    ``columns`` are the fields to fill; by default all of ``KEPT`` that are there.
    A node that was silent for over ``stale`` seconds starts a new session and forgets its
    values.  Adds ``session_start`` and ``next_t``, the time of the node's next report.

    One pass over chunks (whole nodes, unless a node is too long): inside a chunk a *marker* is a row that settles the field (it
    holds a value, or starts a session after a gap).  The chunk summary keeps the first and
    last time and the last marker; whether a chunk's first row starts a session, and which
    marker holds before it, follow from the summaries of the chunks before.
    """
    columns = [c for c in KEPT if c in reports.columns] if columns is None else columns
    gap = F.lit(_micros(stale))
    local = ordered.chunk_window(keys, order)
    cut = ordered.chunked(reports, keys, order, limit).with_columns(
        {"__lag": F.lag("t").over(local), "__lead": F.lead("t").over(local)}
    )
    after_gap = F.coalesce(F.col("t") - F.col("__lag") > gap, F.lit(False))
    marks = {c: F.when(after_gap | F.col(c).isNotNull(), F.col(order)) for c in columns}
    cut = cut.with_columns({f"__mark_{c}": mark for c, mark in marks.items()})

    chunks, before = ordered.key_window(keys), ordered.before(keys)
    summary = {"__first_t": F.min_by("t", order), "__last_t": F.max_by("t", order)}
    carries = {
        "__prev_t": F.lag("__last_t").over(chunks),
        "__next_t": F.lead("__first_t").over(chunks),
        "__starts": F.col("__prev_t").isNull() | (F.col("__first_t") - F.col("__prev_t") > gap),
    }
    alone = {"__next_t": ordered.nothing("bigint"), "__starts": F.lit(True)}
    for c in columns:
        summary[f"__at_{c}"] = F.max(f"__mark_{c}")
        summary[f"__value_{c}"] = F.max_by(c, f"__mark_{c}")
        settled = F.col("__starts") | F.col(f"__at_{c}").isNotNull()
        carries[f"__end_{c}"] = F.when(settled, F.struct(F.col(f"__value_{c}").alias("v")))
        carries[f"__carry_{c}"] = F.last(f"__end_{c}", ignorenulls=True).over(before)["v"]
        alone[f"__carry_{c}"] = ordered.nothing(reports.schema[c].dataType)
    rows = cut.carry(summary, carries, alone)

    frame = local.rowsBetween(Window.unboundedPreceding, 0)
    held = {
        c: F.last(F.when(F.col(f"__mark_{c}").isNotNull(), F.struct(F.col(c).alias("v"))), ignorenulls=True).over(frame)
        for c in columns
    }
    rows = rows.withColumns({f"__held_{c}": h for c, h in held.items()})
    is_first = F.col("__lag").isNull()
    filled = {
        c: F.when(F.col(f"__held_{c}").isNotNull(), F.col(f"__held_{c}.v"))
        .when(~F.col("__starts"), F.col(f"__carry_{c}"))
        .alias(c)
        for c in columns
    }
    return rows.select(
        *[filled.get(c, F.col(c)) for c in reports.columns],
        F.when(is_first, F.col("__starts")).otherwise(after_gap).alias("session_start"),
        F.coalesce("__lead", "__next_t").alias("next_t"),
    )


def latest(reports: DataFrame, *, keys: Sequence[str] = NODE, order: str = "offset") -> DataFrame:
    """Latest report per node; map tasks pass on at most one row per node."""
    w = Window.partitionBy(*keys).orderBy(F.col(order).desc())
    return reports.withColumn("__n", F.row_number().over(w)).filter(F.col("__n") == 1).drop("__n")


def state_at_intervals(
    reports: DataFrame,
    *,
    every: int,
    stale: float,
) -> DataFrame:
    """State rows at every multiple of ``every`` seconds: each node's latest report no older than ``stale``.

    Needs ``next_t`` (see ``with_history``).  A report is visible from its own time until the
    node's next one, so its ticks are a plain sequence and no join with a tick table is needed.  ``tick`` is in epoch seconds.
    """
    step = F.lit(_micros(every))
    until = F.least(F.col("next_t") - 1, F.col("t") + F.lit(_micros(stale)))
    first = F.floor((F.col("t") + step - 1) / step)
    last = F.floor(until / step)
    return (
        reports.withColumns({"__first": first, "__last": last})
        .filter(F.col("__first") <= F.col("__last"))
        .withColumn("__n", F.explode_outer(F.sequence("__first", "__last")))
        .withColumn("tick", F.col("__n") * F.lit(int(every)))
        .withColumn("age", F.col("tick") * F.lit(1_000_000) - F.col("t"))
        .drop("__first", "__last", "__n", "next_t")
    )


def state_at_ticks(
    reports: DataFrame,
    ticks: DataFrame,
    *,
    stale: float,
    span: int = 256,
    limit: int = ordered.ROW_LIMIT,
) -> DataFrame:
    """State rows at given instants (``network``, ``tick_t`` in microseconds, e.g. every message).

    A sweep over instants and visibility borders numbers a network's distinct instants and turns the time a report is
    visible into the interval of numbers it holds; the sweep is a running sum, cut into ranges of rows where a network
    has many.  Intervals are cut at multiples of ``span``, so what is open at the border of a range goes on in the
    next, and meet the range's instants as one array of at most ``span`` times.  Only rows of the result are
    made, and no range holds more of a network than ``span`` instants.
    Reports that hold no instant, and instants at which nothing is visible, give no row.
    """
    if span < 1:
        raise ValueError("a range must hold at least 1 instant")
    until = F.least(F.col("next_t") - 1, F.col("t") + F.lit(_micros(stale)))
    rows = stage(
        reports.withColumns({"__until": until, "__row": F.monotonically_increasing_id()}).filter(F.col("t") <= F.col("__until")),
        "visible",
    )
    at = stage(ticks.select("network", "tick_t").filter(F.col("tick_t").isNotNull()).distinct(), "instants")
    # At equal times a report begins before the instant and ends after it.
    borders = F.array(
        F.struct(F.col("t").alias("t"), F.lit(0).alias("kind"), F.col("__row").alias("row")),
        F.struct(F.col("__until").alias("t"), F.lit(2).alias("kind"), F.col("__row").alias("row")),
    )
    instant = F.struct(F.col("tick_t").alias("t"), F.lit(1).alias("kind"), F.lit(0).cast("bigint").alias("row"))
    swept = ordered.running_sums(
        rows.select("network", F.explode(borders).alias("__at")).unionByName(at.select("network", instant.alias("__at"))),
        keys=["network"], order="__at", sums={"__n": (F.col("__at.kind") == 1).cast("bigint")}, limit=limit,
    )
    swept = stage(swept.select("network", "__at.*", "__n"), "swept")
    places = swept.filter("kind <> 1").groupBy(F.col("row").alias("__row")).agg(
        F.max(F.when(F.col("kind") == 0, F.col("__n"))).alias("__first"), F.max(F.when(F.col("kind") == 2, F.col("__n"))).alias("__end")
    )
    # Numbers from 0: the report holds those from __first to before __end.
    size = F.lit(span).cast("bigint")
    number = F.floor((F.col("__n") - 1) / size)
    times = swept.filter("kind = 1").groupBy("network", number.alias("__range")).agg(F.sort_array(F.collect_list("t")).alias("__times"))
    held = rows.join(places.filter("__first < __end"), "__row")
    pieces = held.withColumn("__range", F.explode(F.sequence(F.floor(F.col("__first") / size), F.floor((F.col("__end") - 1) / size))))
    low = F.greatest(F.col("__first") - F.col("__range") * size, F.lit(0))
    high = F.least(F.col("__end") - F.col("__range") * size, size)
    mine = F.slice("__times", (low + 1).cast("int"), (high - low).cast("int"))
    return (
        pieces.join(times, ["network", "__range"])
        .withColumn("tick_t", F.explode(mine))
        .withColumn("age", F.col("tick_t") - F.col("t"))
        .select(*[c for c in reports.columns if c != "next_t"], "tick_t", "age")
    )


def add_synthetic_root(state: DataFrame, *, keys: Sequence[str] = ("network", "tick")) -> DataFrame:
    """Make sure every state holds the border router, flagged as root.

    A reported router keeps its fields; a missing one is added without neighbors and
    with the objective function and DODAG of the state's oldest report.
    """
    root = F.col("node_id") == addresses.ROOT_ID
    marked = state.withColumns({"is_root": F.col("is_root") | root, "is_synthetic": F.lit(False)})
    inherited = [c for c in ("objective_function", "dodag_id") if c in state.columns]
    missing = (
        state.groupBy(*keys)
        .agg(F.max(root.cast("int")).alias("__has"), *[F.min_by(c, "t").alias(c) for c in inherited])
        .filter(F.col("__has") == 0)
        .drop("__has")
    )
    columns = {
        "node_id": F.lit(addresses.ROOT_ID).cast("bigint"),
        "is_root": F.lit(True),
        "is_synthetic": F.lit(True),
        "neighbors": F.expr("cast(array() as array<struct<id:bigint,cost:double>>)"),
        "degree": F.lit(0),
        "age": F.lit(0).cast("bigint"),
    }
    if "dodag_id" in inherited:
        columns["ipv6"] = addresses.root_address(F.col("dodag_id"))
    known = {n: c for n, c in columns.items() if n in marked.columns}
    return marked.unionByName(missing.withColumns(known), allowMissingColumns=True)


def resets_as_epochs(
    reports: DataFrame, *, reset: Column, order: str = "offset", limit: int = ordered.ROW_LIMIT
) -> DataFrame:
    """Full reset by control rows: adds ``epoch`` and drops the control rows.

    Operators keyed on ``epoch`` too start empty after a reset.
    """
    marked = reports.withColumn("__reset", reset)
    numbered = ordered.running_sums(
        marked, keys=["network"], order=order, sums={"epoch": F.col("__reset").cast("bigint")}, limit=limit
    )
    return numbered.filter(~F.col("__reset")).drop("__reset")


def merge_neighbor_tables(
    routing_table: DataFrame,
    cache: DataFrame,
    *,
    keys: Sequence[str],
    max_age: float = 60.0,
) -> DataFrame:
    """Neighbors to report: routing-table entries first, then cache entries it does not know.

    Both inputs hold ``keys``, ``addr``, ``age`` (seconds since last heard, null = never);
    the routing table adds rank, link_metric, is_parent, is_preferred, is_default_route,
    the cache adds lladdr.  A routing entry needs a provable single hop (a link-local
    address or a cache entry) and must be recently heard, preferred or the default route;
    a cache-only entry must be recently heard and carries no routing metrics.
    One full outer join on (keys, addr) does both passes.
    """
    on = [*keys, "addr"]
    left = routing_table.withColumn("__routed", F.lit(True)).withColumnRenamed("age", "__age_r")
    right = cache.withColumn("__cached", F.lit(True)).withColumnRenamed("age", "__age_c")
    both = left.join(right, on, "full")
    routed = F.coalesce(F.col("__routed"), F.lit(False))
    provable = addresses.is_link_local(F.col("addr")) | F.col("lladdr").isNotNull()

    def recent(age):
        return F.coalesce(F.col(age) <= F.lit(max_age), F.lit(False))

    wanted = recent("__age_r") | F.col("is_preferred") | F.col("is_default_route")
    cached_only = recent("__age_c") & F.col("lladdr").isNotNull()
    kept = both.filter(F.when(routed, provable & wanted).otherwise(cached_only))
    return kept.select(
        *on,
        "lladdr",
        F.col("rank").alias("rank"),
        routing.dag_rank(F.col("rank")).alias("dag_rank"),
        "link_metric",
        F.coalesce("is_parent", F.lit(False)).alias("is_parent"),
        F.coalesce("is_preferred", F.lit(False)).alias("is_preferred"),
    )
