"""Wireless graphs and routing trees, for every (network, tick) at once.

State rows come from ``reports``.  All loops are set based: a round is one DataFrame plan
over all graphs, its result is staged in the shared folder, and the only value that
reaches the driver is whether another round is needed.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewire.functions import addresses
from tidewire.storage import Rounds, stage

from . import components, ordered

GRAPH = ("network", "tick")

_BITS = 64


def listings(state: DataFrame, *, keys: Sequence[str] = GRAPH) -> DataFrame:
    """One row per listed neighbor: lister, neighbor, cost and the age of the listing (microseconds)."""
    # The outer form keeps the optimizer from evaluating the array a second time as a filter.
    return state.select(
        *keys, F.col("node_id").alias("lister"), "age", F.explode_outer("neighbors").alias("__n")
    ).filter(F.col("__n").isNotNull()).select(*keys, "lister", "age", F.col("__n.id").alias("listed"), F.col("__n.cost").alias("cost"))


def wireless_edges(
    state: DataFrame, *, rule: str, fresh: float | None = None, keys: Sequence[str] = GRAPH
) -> DataFrame:
    """Undirected links (a < b) with their symmetric cost.

    ``any``: one listing is enough.  ``mutual_fresh``: both ends list each other in
    reports no older than ``fresh`` seconds (None = any age); a link to the border router
    needs only the other end's fresh listing.  The cost is the mean of the listed
    directions, whatever their age.  Both directions meet in one partially aggregated
    group per pair, so the mutual check needs no self join.
    """
    if rule not in ("any", "mutual_fresh"):
        raise ValueError(f"unknown edge rule: {rule}")
    is_fresh = F.lit(True) if fresh is None else F.col("age") <= F.lit(int(round(fresh * 1_000_000)))
    pairs = (
        listings(state, keys=keys)
        .filter(F.col("lister") != F.col("listed"))
        .withColumns(
            {
                "a": F.least("lister", "listed"),
                "b": F.greatest("lister", "listed"),
                "__up": ((F.col("lister") < F.col("listed")) & is_fresh).cast("int"),
                "__down": ((F.col("lister") > F.col("listed")) & is_fresh).cast("int"),
                "__root": ((F.col("listed") == addresses.ROOT_ID) & is_fresh).cast("int"),
            }
        )
        .groupBy(*keys, "a", "b")
        .agg(
            F.avg("cost").alias("cost"),
            F.max("__up").alias("__up"),
            F.max("__down").alias("__down"),
            F.max("__root").alias("__root"),
        )
    )
    if rule == "mutual_fresh":
        pairs = pairs.filter(((F.col("__up") == 1) & (F.col("__down") == 1)) | (F.col("__root") == 1))
    return pairs.drop("__up", "__down", "__root")


def edge_list(edges: DataFrame, *, keys: Sequence[str] = GRAPH) -> DataFrame:
    """Each link once, ends in text order."""
    a, b = F.col("a").cast("string"), F.col("b").cast("string")
    return edges.select(*keys, F.least(a, b).alias("src"), F.greatest(a, b).alias("dst"))


def tree_edges(state: DataFrame, *, keys: Sequence[str] = GRAPH) -> DataFrame:
    """Child and parent of the routing tree; a node that names itself has no parent."""
    return state.filter(F.col("parent_id").isNotNull() & (F.col("parent_id") != F.col("node_id"))).select(
        *keys, F.col("node_id").alias("child"), F.col("parent_id").alias("parent")
    )


def roots(state: DataFrame, *, keys: Sequence[str] = GRAPH) -> DataFrame:
    """Root of each state: highest flagged id, else the border router, else the lowest id
    without a parent, else the lowest id."""
    node = F.col("node_id")
    has_parent = F.coalesce(F.col("parent_id") != node, F.lit(False))
    return (
        state.groupBy(*keys)
        .agg(
            F.max(F.when(F.col("is_root"), node)).alias("__flagged"),
            F.max(F.when(node == addresses.ROOT_ID, node)).alias("__border"),
            F.min(F.when(~has_parent, node)).alias("__orphan"),
            F.min(node).alias("__lowest"),
        )
        .select(*keys, F.coalesce("__flagged", "__border", "__orphan", "__lowest").alias("root_id"))
    )


def depths(state: DataFrame, *, keys: Sequence[str] = GRAPH, max_hops: int | None = None) -> DataFrame:
    """Hops of each node below the root; nodes that never reach it (no parent, loop) are left out.

    With ``max_hops`` deeper nodes are left out too.
    Pointer doubling: every open node jumps to its pointer's pointer, so the number of
    rounds is the logarithm of the depth.  Nodes whose pointer has arrived are closed and
    take part only as targets.
    """
    spark = state.sparkSession
    chosen = roots(state, keys=keys).withColumn("node_id", F.col("root_id"))
    has_parent = F.coalesce(F.col("parent_id") != F.col("node_id"), F.lit(False))
    start = (
        state.select(*keys, "node_id", F.when(has_parent, F.col("parent_id")).alias("ptr"))
        .join(chosen, [*keys, "node_id"], "left")
        .withColumn("done", F.col("root_id").isNotNull())
        .filter(F.col("done") | F.col("ptr").isNotNull())
        .select(
            *keys,
            "node_id",
            F.when(F.col("done"), F.col("node_id")).otherwise(F.col("ptr")).alias("ptr"),
            F.when(F.col("done"), F.lit(0)).otherwise(F.lit(1)).cast("bigint").alias("depth"),
            "done",
        )
    )
    rounds = Rounds(spark, "depths")
    table = rounds.store(start)
    # After as many doublings as the largest graph's nodes allow, only loops are open.
    largest = table.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    for _ in range(math.ceil(math.log2(largest + 1)) + 1):
        if table.filter(~F.col("done")).isEmpty():
            break
        target = table.select(
            *keys,
            F.col("node_id").alias("ptr"),
            F.col("ptr").alias("__ptr"),
            F.col("depth").alias("__depth"),
            F.col("done").alias("__done"),
        )
        jumped = (
            table.filter(~F.col("done"))
            .join(target, [*keys, "ptr"])
            .select(
                *keys,
                "node_id",
                F.col("__ptr").alias("ptr"),
                (F.col("depth") + F.col("__depth")).alias("depth"),
                F.col("__done").alias("done"),
            )
        )
        table = rounds.store(table.filter("done").unionByName(jumped))
    near = F.lit(True) if max_hops is None else F.col("depth") <= max_hops
    return table.filter(F.col("done") & near).select(*keys, "node_id", "depth")


def _both_ways(edges: DataFrame, keys: Sequence[str]) -> DataFrame:
    forward = F.struct(F.col("a").alias("a"), F.col("b").alias("b"), F.col("cost").alias("cost"))
    back = F.struct(F.col("b").alias("a"), F.col("a").alias("b"), F.col("cost").alias("cost"))
    return edges.select(*keys, F.explode_outer(F.array(forward, back)).alias("e")).select(*keys, "e.*")


def _numbered_nodes(directed: DataFrame, keys: Sequence[str]) -> DataFrame:
    nodes = directed.select(*keys, F.col("a").alias("node")).distinct()
    return ordered.number_rows(nodes, keys=keys, order="node", out="number").withColumn(
        "number", F.col("number") - 1
    )


def _key_texts(keys: Sequence[str]) -> dict[str, str]:
    """Key list and join condition for the round statements; the frames' own names stay in braces."""
    return {
        "keys": ", ".join(keys),
        "t_keys": ", ".join(f"t.{k}" for k in keys),
        "same": " AND ".join(f"t.{k} = l.{k}" for k in keys),
        "table": "{table}",
        "links": "{links}",
    }


def shortcuts(directed: DataFrame, keys: Sequence[str], *, growth: int, most: int) -> tuple[DataFrame, int]:
    """The cheapest paths of at most ``reach`` links as links of their own (a, b, cost), and ``reach``.

    Joining the table with itself doubles ``reach``.  The join has as many rows as the squares of the nodes' ends sum up to;
    that is known beforehand, and no further doubling is made where it exceeds ``growth`` times the links or ``reach``
    would exceed ``most``.  Dense graphs so keep their plain links.
    """
    table, reach = directed, 1
    budget = growth * directed.count()
    while reach < most:
        ends = table.groupBy(*keys, "a").agg(F.count("*").alias("n"))
        if (ends.agg(F.sum(F.col("n") * F.col("n"))).first()[0] or budget + 1) > budget:
            break
        on = table.select(*keys, F.col("a").alias("b"), F.col("b").alias("c"), F.col("cost").alias("more"))
        joined = table.join(on, [*keys, "b"]).filter("a <> c").select(*keys, "a", F.col("c").alias("b"), (F.col("cost") + F.col("more")).alias("cost"))
        table = stage(table.unionByName(joined).groupBy(*keys, "a", "b").agg(F.min("cost").alias("cost")), "shortcuts")
        reach *= 2
    return table, reach


def _hop_round(reach: int) -> str:
    """Statement of one round: the bits a node got at exactly {distance} links travel 1 .. ``reach`` links on.

    Rounds are single statements: a loop of many rounds spends its time on data, not on building plans.
    """
    each = range(1, reach + 1)
    fresh = {j: f"n{j} & ~(seen{''.join(f' | n{i}' for i in range(1, j))})" for j in each}
    return f"""
WITH gathered AS (
  SELECT {{keys}}, node, word, seen, {', '.join(f'0L AS n{j}' for j in each)}, hops, reached, ecc FROM {{table}}
  UNION ALL
  SELECT {{t_keys}}, l.b, t.word, 0L, {', '.join(f'if(l.cost = {j}, t.fresh, 0L)' for j in each)}, 0L, 0L, 0L
  FROM {{table}} t JOIN {{links}} l ON {{same}} AND t.node = l.a WHERE t.fresh <> 0
), merged AS (
  SELECT {{keys}}, node, word, bit_or(seen) AS seen, {', '.join(f'bit_or(n{j}) AS n{j}' for j in each)},
         max(hops) AS hops, max(reached) AS reached, max(ecc) AS ecc
  FROM gathered GROUP BY {{keys}}, node, word
)
SELECT {{keys}}, node, word, seen | {' | '.join(f'n{j}' for j in each)} AS seen, {fresh[reach]} AS fresh,
       hops + {' + '.join(f'cast(bit_count({fresh[j]}) AS bigint) * ({{distance}} + {j})' for j in each)} AS hops,
       reached + {' + '.join(f'bit_count({fresh[j]})' for j in each)} AS reached,
       cast(greatest(ecc, {', '.join(f'if({fresh[j]} <> 0, {{distance}} + {j}, 0)' for j in each)}) AS bigint) AS ecc
FROM merged
"""


_RELAX_ROUND = """
WITH gathered AS (
  SELECT {keys}, src, node, dist, cast(NULL AS double) AS offer FROM {table}
  UNION ALL
  SELECT {t_keys}, t.src, l.b, cast(NULL AS double), t.dist + l.cost
  FROM {table} t JOIN {links} l ON {same} AND t.node = l.a WHERE t.better
), merged AS (
  SELECT {keys}, src, node, min(dist) AS dist, min(offer) AS offer FROM gathered GROUP BY {keys}, src, node
)
SELECT {keys}, src, node, least(dist, offer) AS dist,
       coalesce(offer < coalesce(dist, double('infinity')), false) AS better
FROM merged
"""

# Rounds between two looks for graphs that are finished.
_RETIRE_EVERY = 4
# Most links that one round passes, and most rows of the join that doubles them, in links.
_HOP_REACH, _HOP_GROWTH = 8, 160
_COST_REACH, _COST_GROWTH = 4, 32


def hop_totals(edges: DataFrame, *, keys: Sequence[str] = GRAPH, local_nodes: int | None = None) -> DataFrame:
    """Per graph: hop diameter, sum of distances and number of reachable ordered pairs.

    Distances inside components of at most ``local_nodes`` nodes (default ``components.NODES``) are found bin by bin inside tasks (see
    ``components``); larger components take the search from all nodes at once.
    """
    directed = stage(_both_ways(edges.withColumn("cost", F.lit(1.0)), keys), "links")
    small, large = components.by_size(directed, keys, nodes=local_nodes)
    near = components.distance_sums(stage(small, "small"), keys).select(
        *keys,
        F.col("ecc").cast("bigint").alias("diameter"),
        F.col("total").cast("decimal(38,0)").alias("total"),
        F.col("pairs").cast("decimal(38,0)").alias("pairs"),
    )
    if large is not None:
        near = near.unionByName(_searched_hops(stage(large, "large"), keys))
    return near.groupBy(*keys).agg(
        F.max("diameter").alias("diameter"), F.sum("total").cast("decimal(38,0)").alias("total"), F.sum("pairs").cast("decimal(38,0)").alias("pairs")
    )


def _searched_hops(directed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Hop totals by search over links both ways.

    Exact breadth-first search from all nodes at once.  A row stands for one node and 64
    sources: which of them have reached it, as bits of one long.  A round passes the bits of
    the search's outermost nodes along paths of up to ``reach`` links (see ``shortcuts``) and ORs them per
    node and length, combining before the shuffle, so pairs are never written out one by
    one and the rounds are the longest distance divided by ``reach``.
    """
    spark = directed.sparkSession
    links, reach = shortcuts(directed, keys, growth=_HOP_GROWTH, most=_HOP_REACH)
    start = _numbered_nodes(directed, keys).select(
        *keys,
        "node",
        F.floor(F.col("number") / F.lit(_BITS)).alias("word"),
        F.expr(f"shiftleft(1L, cast(number % {_BITS} as int))").alias("seen"),
    )
    zero = F.lit(0).cast("bigint")
    start = start.withColumns({"fresh": F.col("seen"), "hops": zero, "reached": zero, "ecc": zero})
    rounds = Rounds(spark, "hops")
    table = rounds.store(start)
    done = []
    distance, step = 0, _hop_round(reach)
    while not table.filter("fresh <> 0").isEmpty():
        table = rounds.store(spark.sql(step.format(**_key_texts(keys), distance=distance), table=table, links=links))
        distance += reach
        if distance // reach % _RETIRE_EVERY == 0:
            # Graphs no bit moves in any more are summed up and leave the loop.
            moving = stage(table.filter("fresh <> 0").select(*keys).distinct(), "moving")
            done.append(stage(_hop_sums(table.join(moving, list(keys), "left_anti"), keys), "done"))
            table = rounds.store(table.join(moving, list(keys), "left_semi"))
    sums = _hop_sums(table, keys)
    for part in done:
        sums = sums.unionByName(part)
    return sums


def _hop_sums(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    return table.groupBy(*keys).agg(
        F.max("ecc").alias("diameter"),
        F.sum(F.col("hops").cast("decimal(38,0)")).alias("total"),
        F.sum(F.col("reached").cast("decimal(38,0)")).alias("pairs"),
    )


def _mean_path(total, pairs):
    return F.when(pairs > 0, total.cast("double") / pairs.cast("double")).otherwise(F.lit(0.0))


def hop_metrics(edges: DataFrame, *, keys: Sequence[str] = GRAPH) -> DataFrame:
    """Hop diameter and average path length per graph (graphs with at least one link)."""
    return hop_totals(edges, keys=keys).select(
        *keys, "diameter", _mean_path(F.col("total"), F.col("pairs")).alias("avg_path_len")
    )


def weighted_metrics(
    edges: DataFrame, *, keys: Sequence[str] = GRAPH, sources_per_pass: int = 1 << 14, local_nodes: int | None = None
) -> DataFrame:
    """Cost diameter and average cost of the cheapest paths, over reachable ordered pairs.

    Distances inside components of at most ``local_nodes`` nodes (default ``components.NODES``) are found bin by bin inside tasks (see
    ``components``).  Larger components take an exact relaxation from every source until nothing improves (costs are positive), along paths of
    several links a round (see ``shortcuts``).  The
    sources of a graph are worked off in passes, so the live state is bounded by
    ``sources_per_pass`` times the nodes; each pass leaves one row per node and source
    block, never a pair.
    """
    directed = stage(_both_ways(edges, keys), "costs")
    small, large = components.by_size(directed, keys, nodes=local_nodes)
    whole = components.distance_sums(stage(small, "small"), keys)
    if large is not None:
        for part in _relaxed_passes(stage(large, "large"), keys, sources_per_pass):
            whole = whole.unionByName(part)
    return whole.groupBy(*keys).agg(
        F.max("ecc").alias("diameter_weighted"), F.sum("total").alias("__t"), F.sum("pairs").alias("__p")
    ).select(
        *keys,
        F.coalesce("diameter_weighted", F.lit(0.0)).alias("diameter_weighted"),
        _mean_path(F.col("__t"), F.col("__p")).alias("avg_path_len_weighted"),
    )


def _relaxed_passes(directed: DataFrame, keys: Sequence[str], sources_per_pass: int) -> list[DataFrame]:
    links, _ = shortcuts(directed, keys, growth=_COST_GROWTH, most=_COST_REACH)
    numbered = stage(_numbered_nodes(directed, keys), "nodes")
    most = numbered.agg(F.max("number")).first()[0]
    parts = []
    for number in range(most // sources_per_pass + 1):
        in_pass = F.floor(F.col("number") / F.lit(sources_per_pass)) == number
        parts.append(stage(_relax(numbered.filter(in_pass), links, keys), "pass"))
    return parts


def _relax(sources: DataFrame, directed: DataFrame, keys: Sequence[str]) -> DataFrame:
    rounds = Rounds(sources.sparkSession, "relax")
    table = rounds.store(
        sources.select(
            *keys, F.col("number").alias("src"), "node", F.lit(0.0).alias("dist"), F.lit(True).alias("better")
        )
    )
    step = _RELAX_ROUND.format(**_key_texts(keys))
    spark = sources.sparkSession
    while not table.filter("better").isEmpty():
        table = rounds.store(spark.sql(step, table=table, links=directed))
    # The source's own row (distance 0) is the only one that is not a pair.
    return table.groupBy(*keys).agg(
        F.max("dist").alias("ecc"),
        F.sum("dist").alias("total"),
        F.count(F.when(F.col("dist") > 0, 1)).alias("pairs"),
    )


def tree_totals(links: DataFrame, *, keys: Sequence[str] = GRAPH) -> DataFrame:
    """Like ``hop_totals`` for the undirected child-parent graph (``child``, ``parent``).

    On a tree no pair has to be visited: a link above a subtree of s of n nodes is crossed
    by s*(n-s) pairs, and the longest path bends at the node with the two tallest child
    subtrees.  Subtree sizes, heights and component tops come from pointer doubling, so
    the rounds are logarithmic in the height.  Components that hold a parent loop never
    run out of ancestors; they go through ``hop_totals``.
    """
    spark = links.sparkSession
    up = links.select(*keys, F.col("child").alias("node"), F.col("parent").alias("parent"))
    tops = links.select(*keys, F.col("parent").alias("node")).withColumn("parent", F.lit(None).cast("bigint"))
    one = F.lit(1).cast("bigint")
    start = (
        up.unionByName(tops)
        .groupBy(*keys, "node")
        .agg(F.max("parent").alias("parent"))
        .withColumns({"anc": F.col("parent"), "top": F.col("node"), "size": one, "height": one - 1})
    )
    rounds = Rounds(spark, "tree")
    table = rounds.store(start)
    limit, jump = None, 1
    while not table.filter(F.col("anc").isNotNull()).isEmpty():
        if jump >= 64 and limit is None:
            limit = table.groupBy(*keys).count().agg(F.max("count")).first()[0]
        if limit is not None and jump > limit:
            break
        below = (
            table.filter(F.col("anc").isNotNull())
            .groupBy(*keys, F.col("anc").alias("node"))
            .agg(F.sum("size").alias("__size"), F.max("height").alias("__height"))
        )
        above = table.select(
            *keys, F.col("node").alias("anc"), F.col("anc").alias("__anc"), F.col("top").alias("__top")
        )
        table = rounds.store(
            table.join(below, [*keys, "node"], "left")
            .join(above, [*keys, "anc"], "left")
            .select(
                *keys,
                "node",
                "parent",
                F.col("__anc").alias("anc"),
                F.coalesce("__top", "top").alias("top"),
                (F.col("size") + F.coalesce("__size", F.lit(0))).alias("size"),
                F.greatest(F.col("height"), F.col("__height") + jump).alias("height"),
            )
        )
        jump *= 2
    open_ended = F.col("anc").isNotNull()
    looped = table.filter(open_ended & F.col("parent").isNotNull())
    trees = table.filter(~open_ended)

    big = "decimal(38,0)"
    size = F.col("size").cast("decimal(19,0)")
    is_child = F.col("parent").isNotNull()
    crossed = (
        trees.groupBy(*keys, "top")
        .agg(
            F.max("size").alias("n"),
            F.coalesce(F.sum(F.when(is_child, size)), F.lit(0)).cast(big).alias("s1"),
            F.coalesce(F.sum(F.when(is_child, size * size)), F.lit(0)).cast(big).alias("s2"),
        )
        .groupBy(*keys)
        .agg(
            F.sum((2 * (F.col("n") * F.col("s1") - F.col("s2"))).cast(big)).cast(big).alias("total"),
            F.sum(F.col("n").cast("decimal(19,0)") * (F.col("n") - 1).cast("decimal(18,0)")).cast(big).alias("pairs"),
        )
    )
    tallest = Window.partitionBy(*keys, "parent").orderBy(F.col("height").desc())
    bends = (
        trees.filter(is_child)
        .withColumn("__place", F.row_number().over(tallest))
        .filter(F.col("__place") <= 2)
        .groupBy(*keys, "parent")
        .agg(F.sum(F.col("height") + 1).alias("bend"))
        .groupBy(*keys)
        .agg(F.max("bend").alias("diameter"))
    )
    result = crossed.join(bends, list(keys), "left").select(*keys, "diameter", "total", "pairs")
    if not looped.isEmpty():
        ends = looped.select(
            *keys, F.least("node", "parent").alias("a"), F.greatest("node", "parent").alias("b")
        ).distinct()
        result = (
            result.unionByName(hop_totals(ends, keys=keys).select(*keys, "diameter", "total", "pairs"))
            .groupBy(*keys)
            .agg(
                F.max("diameter").alias("diameter"),
                F.sum("total").cast(big).alias("total"),
                F.sum("pairs").cast(big).alias("pairs"),
            )
        )
    return result


def tree_metrics(links: DataFrame, *, keys: Sequence[str] = GRAPH) -> DataFrame:
    """Diameter and average path length of the routing tree per graph."""
    return tree_totals(links, keys=keys).select(
        *keys,
        F.coalesce("diameter", F.lit(0)).cast("bigint").alias("diameter"),
        _mean_path(F.col("total"), F.col("pairs")).alias("avg_path_len"),
    )


def node_table(state: DataFrame, *, keys: Sequence[str] = GRAPH) -> DataFrame:
    """Topology rows: node, root flag, ranks, parent, sorted neighbors and their number."""
    chosen = roots(state, keys=keys).select(*keys, F.col("root_id").alias("node_id"), F.lit(True).alias("__root"))
    ids = F.transform("neighbors", lambda n: n["id"])
    return state.join(chosen, [*keys, "node_id"], "left").select(
        *keys,
        "node_id",
        F.coalesce("__root", F.lit(False)).alias("is_root"),
        "dag_rank",
        "rank",
        "parent_id",
        F.array_sort(ids).alias("neighbors"),
        F.col("degree").cast("bigint").alias("neighbor_count"),
    )
