"""Network metrics at every message.

A state per message would hold messages times nodes rows.  Here a report is an interval of message positions
(from its own message to its node's next one, or to the first message after it ran out), and each figure is worked out from
the intervals in the cheapest form it allows:

* counts and means are running sums of what begins and ends at a position;
* links begin and end where the number of reports that list them leaves and returns to 0;
* extremes are looked up in a tree of aligned position ranges that the intervals are cut into;
* root, depths and routing-tree figures depend on parents and root flags alone.  Messages that change none of them share a
  *version* of the tree.  Versions are dealt into blocks; inside a block the tree is followed from change to change, so a version costs
  what changed and its ancestors, not the network.

Defined cases: a message without a node's earlier reports starts that node; a report is visible up to and including ``stale`` seconds
after its arrival; the border router is there at every message, without neighbors while it doesn't report; means without
nodes are 0 and extremes null; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions import addresses
from tidewire.storage import stage

from . import forest, graph, metrics, ordered, reports

#: Positions in the largest range of the tree; longer intervals take several of them, so no range is looked up by more positions.
LARGEST = 12
AT = ["network", "position"]


def merged(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """A join of two sides that both grow with the messages: always shuffled, never broadcast.

    Left to itself, Spark takes a side for as large as the files it is read from.  Positions and versions are stored in a few
    bytes a row, and what is exploded from them counts as one row each, so millions of rows would pass through the driver.
    """
    return left.join(right.hint("merge"), on, how)


def positions(history: DataFrame, *, stale: float, order: str = "offset", limit: int = ordered.ROW_LIMIT) -> DataFrame:
    """Reports with ``position`` (number of the message in its network, from 1) and ``until``, the first position that doesn't see it."""
    stays = F.lit(int(round(stale * 1_000_000)))
    # What arrives at the instant of expiry still sees the report.
    moments = F.array(
        F.struct("t", F.lit(0).alias("kind"), F.col(order).alias("id")),
        F.struct((F.col("t") + stays).alias("t"), F.lit(1).alias("kind"), F.col(order).alias("id")),
    )
    counted = ordered.running_sums(
        history.select("network", F.explode_outer(moments).alias("__at")),
        keys=["network"], order="__at", sums={"__n": (F.col("__at.kind") == 0).cast("bigint")}, limit=limit,
    )
    own = F.col("__at.kind") == 0
    places = counted.groupBy("network", F.col("__at.id").alias(order)).agg(
        F.max(F.when(own, F.col("__n"))).alias("position"), F.max(F.when(~own, F.col("__n") + 1)).alias("__out")
    )
    rows = ordered.adjacent_rows(
        merged(history, places, ["network", order]),
        keys=["network", "node_id"], order="position", following={"position": "__next"}, limit=limit,
    )
    return rows.withColumn("until", F.least("__out", "__next")).drop("__out", "__next")


def _begin_and_end(rows: DataFrame, keys: list[str], figures: dict[str, Column]) -> DataFrame:
    """What each interval adds at its position and takes away at its end, summed per (keys, position)."""
    begin = F.struct(F.col("position").alias("at"), *[c.cast("bigint").alias(n) for n, c in figures.items()])
    end = F.struct(F.col("until").alias("at"), *[(-c.cast("bigint")).alias(n) for n, c in figures.items()])
    changes = rows.select(*keys, F.explode_outer(F.array(begin, end)).alias("c"))
    return changes.groupBy(*keys, F.col("c.at").alias("position")).agg(*[F.sum(f"c.{n}").alias(n) for n in figures])


def link_changes(versions: DataFrame, *, limit: int = ordered.ROW_LIMIT) -> DataFrame:
    """(network, position, links): by how many the undirected links grow; one listing is enough for a link."""
    listed = (
        versions.select("network", "position", "until", "node_id", F.explode_outer("neighbors").alias("n"))
        .filter(F.col("n.id") != F.col("node_id"))
        .select("network", "position", "until", F.least("node_id", "n.id").alias("a"), F.greatest("node_id", "n.id").alias("b"))
    )
    changes = _begin_and_end(listed, ["network", "a", "b"], {"more": F.lit(1)}).filter("more <> 0")
    held = ordered.running_sums(changes, keys=["network", "a", "b"], order="position", sums={"held": F.col("more")}, limit=limit)
    grown = (F.col("held") > 0).cast("bigint") - (F.col("held") - F.col("more") > 0).cast("bigint")
    return held.groupBy(*AT).agg(F.sum(grown).alias("links"))


def ranges(low: Column, high: Column) -> Column:
    """Array of the aligned ranges (level, number) that make up the positions ``low`` to ``high`` (exclusive).

    Range ``number`` of a level holds the positions ``number * 2 ** level`` and on.  At every level below the largest at most one
    range is taken at either end.
    """

    def first(level):
        return F.shiftright(low + (F.shiftleft(F.lit(1).cast("bigint"), level) - 1), level)

    def last(level):
        return F.shiftright(high, level)

    def taken(number, level, where):
        return F.when(where, F.array(F.struct(F.lit(level).alias("level"), number.alias("number"))))

    none = F.expr("cast(array() as array<struct<level:int,number:bigint>>)")
    parts = []
    for level in range(LARGEST):
        left, right = first(level), last(level)
        parts += [taken(left, level, (left < right) & (left % 2 == 1)), taken(right - 1, level, (left < right) & (right % 2 == 1))]
    left, right = first(LARGEST), last(LARGEST)
    whole = F.transform(F.sequence(left, right - 1), lambda n: F.struct(F.lit(LARGEST).alias("level"), n.alias("number")))
    return F.concat(*[F.coalesce(p, none) for p in [*parts, F.when(left < right, whole)]])


def extremes(intervals: DataFrame, at: DataFrame, value: str) -> DataFrame:
    """(network, position, lowest, highest) of the values whose interval holds a position of ``at``; positions without one are left out."""
    cut = intervals.select("network", value, F.explode(ranges(F.col("position"), F.col("until"))).alias("r"))
    found = cut.groupBy("network", "r").agg(F.min(value).alias("lowest"), F.max(value).alias("highest"))
    above = F.transform(
        F.sequence(F.lit(0), F.lit(LARGEST)),
        lambda level: F.struct(level.alias("level"), F.call_function("shiftright", F.col("position"), level).alias("number")),
    )
    asked = at.select("network", "position", F.explode(above).alias("r"))
    return merged(asked, found, ["network", "r"]).groupBy(*AT).agg(F.min("lowest").alias("lowest"), F.max("highest").alias("highest"))


def tree_versions(versions: DataFrame, at: DataFrame, *, limit: int = ordered.ROW_LIMIT) -> tuple[DataFrame, DataFrame]:
    """``at`` with the ``version`` of the routing tree in force, and the nodes of every version with parent and root flag."""
    numbered, spans = version_spans(versions, at, limit=limit)
    return numbered, _each_version(spans)


def _each_version(spans: DataFrame) -> DataFrame:
    return spans.select("network", F.explode(F.sequence("first", "last")).alias("version"), "node_id", "parent_id", "is_root")


def version_spans(versions: DataFrame, at: DataFrame, *, limit: int = ordered.ROW_LIMIT) -> tuple[DataFrame, DataFrame]:
    """``at`` with its ``version``, and nodes with parent, root flag and the ``first`` and ``last`` version they hold for."""
    rows = ordered.adjacent_rows(
        versions.select("network", "node_id", "position", "until", F.struct("parent_id", "is_root").alias("now")),
        keys=["network", "node_id"], order="position", previous={"now": "__was", "until": "__left"}, following={"position": "__next"}, limit=limit,
    )
    stays = F.coalesce(F.col("__left") == F.col("position"), F.lit(False)) & F.col("now").eqNullSafe(F.col("__was"))
    leaves = ~F.coalesce(F.col("__next") == F.col("until"), F.lit(False))
    changed = rows.select(
        "network", F.explode(F.array_compact(F.array(F.when(~stays, F.col("position")), F.when(leaves, F.col("until"))))).alias("position")
    ).distinct()
    marked = merged(at, changed.withColumn("__new", F.lit(1).cast("bigint")), AT, "left").withColumn("__new", F.coalesce("__new", F.lit(0)))
    numbered = stage(ordered.running_sums(marked, keys=["network"], order="position", sums={"version": F.col("__new")}, limit=limit), "tree-versions")
    # A version is worked out at its first message.
    # No interval ends later than one position behind the last message, so every end is found.
    begin = numbered.select(*AT, (F.col("version") + 1 - F.col("__new")).alias("__first"))
    end = numbered.select("network", (F.col("position") + 1).alias("until"), F.col("version").alias("__last"))
    held = merged(versions.select("network", "node_id", "position", "until", "parent_id", "is_root"), begin, AT)
    nodes = (
        merged(held, end, ["network", "until"]).filter("__first <= __last")
        .select("network", "node_id", "parent_id", "is_root", F.col("__first").alias("first"), F.col("__last").alias("last"))
    )
    return numbered.drop("__new"), nodes


def tree_shapes(spans: DataFrame, *, tree_nodes: int | None = None) -> DataFrame:
    """Figures of every version: root, depths, diameter and path length of the routing tree.

    Networks of at most ``tree_nodes`` nodes (default ``forest.NODES``) are followed from version to version, in blocks; of larger ones every
    version is worked out as a graph.
    """
    most = forest.NODES if tree_nodes is None else tree_nodes
    spans = stage(spans, "tree-spans")
    large = stage(spans.groupBy("network").agg(F.count_distinct("node_id").alias("n")).filter(F.col("n") > most).select("network"), "large")
    keys = ["network", "version"]
    shapes = forest.shapes(spans.join(large, "network", "left_anti"))
    if large.isEmpty():
        return shapes
    each = _each_version(spans.join(large, "network", "left_semi"))
    trees = stage(reports.add_synthetic_root(each, keys=("network", "version")), "trees")
    paths = graph.tree_metrics(graph.tree_edges(trees, keys=keys), keys=keys)
    depths = metrics.depth_stats(graph.depths(trees, keys=keys), graph.roots(trees, keys=keys), keys=keys)
    return shapes.unionByName(merged(depths, paths, keys, "left").select(*shapes.columns))


def metrics_at_messages(
    history: DataFrame, *, stale: float, order: str = "offset", limit: int = ordered.ROW_LIMIT, tree_nodes: int | None = None
) -> DataFrame:
    """One row per message: the network as it is after that message, and the since-boot means of the headline metrics.

    ``history`` are decoded reports with kept fields (``reports.with_history``).  ``dag_id`` and ``objective_function`` are those of
    the reporting node; ``round_seq`` is the last sequence number any message gave.
    """
    versions = stage(positions(history, stale=stale, order=order, limit=limit), "message-intervals")
    own = [F.col(c) if c in versions.columns else F.lit(None).cast("string").alias(c) for c in ("dodag_id", "objective_function")]
    at = versions.select(*AT, order, "t", "seq", *own)

    router = F.col("node_id") == addresses.ROOT_ID
    has_parent = F.coalesce(F.col("parent_id") != F.col("node_id"), F.lit(False))
    figures = {
        "nodes": F.when(router, 0).otherwise(1),
        "degrees": F.when(router, 0).otherwise(F.col("degree")),
        "parents": has_parent.cast("int"),
    }
    counts = _begin_and_end(versions, ["network"], figures)
    links = link_changes(versions, limit=limit)
    # Changes at positions beyond the last message are of no message.
    moves = merged(merged(at, counts, AT, "left"), links, AT, "left")
    sums = {f"__{n}": F.coalesce(n, F.lit(0)) for n in (*figures, "links")}
    sums["__given"] = F.col("seq").isNotNull().cast("bigint")
    sums["__row"] = F.lit(1).cast("bigint")
    totals = stage(ordered.running_sums(moves, keys=["network"], order="position", sums=sums, limit=limit), "message-totals")
    seqs = totals.filter("seq is not null").select("network", "__given", F.col("seq").alias("round_seq"))

    degrees = extremes(versions.filter(~router).withColumn("degree", F.col("degree").cast("bigint")), at, "degree")
    numbered, spans = version_spans(versions, at.select(*AT), limit=limit)
    shapes = tree_shapes(spans, tree_nodes=tree_nodes)

    # A message that came twice has the rows of both at its position; they keep their order, that of the later version first.
    place = F.struct("__row", (-F.col("version")).alias("version")).alias("__place")
    figured = merged(merged(merged(totals, seqs, ["network", "__given"], "left"), degrees, AT, "left"), numbered, AT)
    instants = (
        merged(figured, stage(shapes, "tree-shapes"), ["network", "version"])
        .select(
            *AT, place, order, "t", F.col("dodag_id").alias("dag_id"), "objective_function", "root_id",
            (F.col("__nodes") + 1).alias("node_count"), F.col("__links").alias("undirected_edge_count"), F.col("__parents").alias("tree_edge_count"),
            "depth_avg", "depth_min", "depth_max",
            F.coalesce("diameter", F.lit(0)).cast("bigint").alias("diameter"), F.coalesce("avg_path_len", F.lit(0.0)).alias("avg_path_len"),
            F.coalesce(F.try_divide("__degrees", "__nodes"), F.lit(0.0)).alias("neighbor_avg"),
            F.col("lowest").alias("neighbor_min"), F.col("highest").alias("neighbor_max"), "round_seq",
        )
    )
    return metrics.running_means(stage(instants, "message-metrics"), order="__place", limit=limit).drop("__place")
