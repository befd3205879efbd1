"""Connected components of many graphs, and distances inside the small ones.

Spark labels the components, packs the small ones into bins of bounded size and shuffles them; a task holds the distances of
one bin from a block of its sources.  Components beyond the size limit are left to the searches in ``graph``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.storage import Rounds, stage

#: Most nodes of a component whose distances are found inside tasks, and most directed links per such node.
NODES, LINKS = 1 << 14, 16
#: Sources of a component that one group takes, and distances (nodes times sources) a group holds.
_BLOCK, _CELLS = 256, 1 << 17


def labels(directed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, node, component): the smallest node that reaches the node; ``directed`` holds links both ways (a, b).

    Alternates two steps until nothing changes: each node hands its larger neighbors to its smallest neighbor, then its
    smaller ones.  The links never grow in number and the rounds are few even for long chains.
    """
    on = [*keys, "a"]
    rounds = Rounds(directed.sparkSession, "components")
    nodes = directed.select(*keys, F.col("a").alias("node")).distinct()
    current, before = rounds.store(directed.filter("a > b").select(*keys, "a", "b").distinct()), None
    while True:
        state = current.agg(F.count("*"), F.bit_xor(F.xxhash64(*keys, "a", "b"))).first()
        if state == before or not state[0]:
            break
        before = state
        lowest = current.groupBy(*on).agg(F.min("b").alias("m"))
        # A node without a smaller neighbor is its own smallest.
        larger = current.select(*keys, F.col("b").alias("a"), F.col("a").alias("b")).join(lowest, on, "left")
        handed = larger.select(*keys, F.col("b").alias("a"), F.coalesce("m", "a").alias("b"))
        own = lowest.select(*keys, "a", F.col("m").alias("b"))
        large = stage(handed.unionByName(own).distinct(), "large-star")
        least = large.groupBy(*on).agg(F.min("b").alias("m"))
        moved = large.join(least, on)
        small = moved.select(*keys, F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        current = rounds.store(small.unionByName(moved.select(*keys, "a", F.col("m").alias("b"))).distinct())
    stars = current.select(*keys, F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.join(stars, [*keys, "node"], "left").withColumn("component", F.coalesce("component", "node"))


def by_size(directed: DataFrame, keys: Sequence[str], *, nodes: int | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Links of small components with ``component`` and its size ``nodes``, and the other links (None without any).

    ``nodes`` is the largest size called small.
    """
    nodes = NODES if nodes is None else nodes
    found = stage(labels(directed, keys), "labels")
    links = stage(directed.join(found.withColumnRenamed("node", "a"), [*keys, "a"]), "labelled")
    sizes = links.groupBy(*keys, "component").agg(F.count("*").alias("links"), F.count_distinct("a").alias("nodes"))
    is_small = (F.col("nodes") <= nodes) & (F.col("links") <= F.col("nodes") * LINKS)
    sizes = stage(sizes.withColumn("is_small", is_small).drop("links"), "component-sizes")
    on = [*keys, "component"]
    small = links.join(sizes.filter("is_small").drop("is_small"), on)
    if sizes.filter(~F.col("is_small")).isEmpty():
        return small, None
    return small, links.join(sizes.filter(~F.col("is_small")), on, "left_semi").select(*directed.columns)


def distance_sums(links: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per graph the longest distance (``ecc``), sum of distances (``total``) and number of reachable ordered pairs (``pairs``).

    ``links`` are those of small components (see ``by_size``), with positive costs; a null cost is no link.  Components of like size share
    bins of at most some ``_CELLS`` distances, and one of more than ``_BLOCK`` nodes is worked off by blocks of sources in several
    groups, so a group's memory doesn't depend on the graph.
    """
    size = F.ceil(F.log2("nodes")).cast("int")
    classes = {r["size"]: r["n"] for r in links.groupBy(size.alias("size")).agg(F.count_distinct(*keys, "a").alias("n")).collect()}
    bins = {c: math.ceil(n * min(1 << c, _BLOCK) / _CELLS) for c, n in classes.items()}
    groups = sum(b * math.ceil((1 << c) / _BLOCK) for c, b in bins.items())
    count = F.lit(1)
    for c, number in bins.items():
        count = F.when(size == c, F.lit(number)).otherwise(count)
    blocks = F.sequence(F.lit(0), (F.floor((F.col("nodes") - 1) / _BLOCK)).cast("int"))
    dealt = links.select(
        *keys, "component", "a", "b", F.col("cost").cast("double").alias("cost"), size.alias("__size"),
        F.pmod(F.xxhash64(*keys, "component"), count).alias("__bin"), F.explode(blocks).alias("__block"),
    )
    at = ["__size", "__bin", "__block"]
    schema = ", ".join([*(f"`{k}` {links.schema[k].dataType.simpleString()}" for k in keys), "ecc double", "total double", "pairs long"])

    def work(group: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return _bin_sums(group, rows, list(keys))

    parts = dealt.repartition(max(1, min(groups, 4096)), *at).groupBy(*at).applyInPandas(work, schema)
    return parts.groupBy(*keys).agg(F.max("ecc").alias("ecc"), F.sum("total").alias("total"), F.sum("pairs").alias("pairs"))


def _bin_sums(group: tuple, links: pd.DataFrame, keys: list[str]) -> pd.DataFrame:
    """Sums per component of one bin, from the sources of one block."""
    graph = links.groupby([*keys, "component"], sort=False, dropna=False).ngroup().to_numpy()
    a, b, cost = (links[c].to_numpy() for c in ("a", "b", "cost"))
    cost = np.where(np.isnan(cost), np.inf, cost)

    def ranked(node):
        order = np.lexsort((node, graph))
        new = np.r_[True, (np.diff(graph[order]) != 0) | (np.diff(node[order]) != 0)]
        row = np.empty(len(node), np.int64)
        row[order] = np.cumsum(new) - 1
        return order, np.flatnonzero(new), row

    # Links stand both ways, so both ends number the same nodes.
    by_a, starts, row_a = ranked(a)
    by_b, ends, _ = ranked(b)
    source, cost = row_a[by_b], cost[by_b]
    owner = graph[by_a][starts]
    first = np.flatnonzero(np.r_[True, np.diff(owner) != 0])
    place = np.arange(len(owner)) - np.repeat(first, np.diff(np.r_[first, len(owner)]))
    low, high = group[2] * _BLOCK, min((group[2] + 1) * _BLOCK, int(place.max()) + 1)
    step = max(16, _CELLS // len(cost))
    longest, total, pairs = (np.zeros(len(owner)) for _ in range(3))
    for begin in range(low, high, step):
        width = min(step, high - begin)
        found = np.full((len(owner), width), np.inf)
        mine = np.flatnonzero((place >= begin) & (place < begin + width))
        found[mine, place[mine] - begin] = 0.0
        while True:
            offer = np.minimum.reduceat(found[source] + cost[:, None], ends, axis=0)
            if not (offer < found).any():
                break
            np.minimum(found, offer, out=found)
        # Only a source's distance to itself is 0.
        found[np.isinf(found)] = 0.0
        longest = np.maximum(longest, found.max(axis=1))
        total += found.sum(axis=1)
        pairs += np.count_nonzero(found, axis=1)
    sums = links[keys].iloc[by_a[starts[first]]].reset_index(drop=True)
    return sums.assign(
        ecc=np.maximum.reduceat(longest, first),
        total=np.add.reduceat(total, first),
        pairs=np.add.reduceat(pairs, first).astype(np.int64),
    )
