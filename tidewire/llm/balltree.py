"""Exact inner-product search with a ball tree per shard.

Candidates are dealt into shards of bounded size and queries into blocks; a task holds one shard and one block.
A shard's vectors form a ball tree.  For a query q no vector of a ball scores above q.center + |q| * radius, so
nodes are visited by that bound, largest first, until it falls below the current k-th score.  Each block
first searches one shard; the k-th scores found there are shared with the searches of all other shards.

Components are integers (floor of a multiple), and scores are exact: sums stay below 2 ** 53.

Defined cases: vectors that are null or hold null or non-finite components, and rows without id, take no part; neither do
vectors with a component so large that scores could leave that range (``largest_component``: 46,340 for 64 dimensions);
shorter vectors count as padded with zeros; a row is never its own result, but another row with the same
id can be; repeated query rows each get their results; equal scores go by id; fewer candidates than k give fewer
rows; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import functools
import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.storage import stage

SCALE = 256
SHARD_ROWS = 8192
QUERY_BLOCK = 1024
LEAF = 48


# --- tree -----------------------------------------------------------------------------------


class BallTree:
    """Nodes in an array; the vectors of a node are contiguous."""

    def __init__(self, vectors: np.ndarray, leaf: int = LEAF):
        self.order = np.arange(len(vectors))
        self.low: list[int] = []
        self.high: list[int] = []
        self.children: list[tuple[int, int] | None] = []
        centers, radii = [], []
        waiting = [(0, len(vectors), -1, 0)]
        while waiting:
            low, high, parent, side = waiting.pop()
            own = vectors[self.order[low:high]]
            center = own.mean(axis=0)
            number = len(self.low)
            self.low.append(low)
            self.high.append(high)
            self.children.append(None)
            centers.append(center)
            radii.append(math.sqrt(((own - center) ** 2).sum(axis=1).max()))
            if parent >= 0:
                pair = self.children[parent] or (-1, -1)
                self.children[parent] = (number, pair[1]) if side == 0 else (pair[0], number)
            if high - low > leaf and radii[-1] > 0:
                far = own[((own - center) ** 2).sum(axis=1).argmax()]
                other = own[((own - far) ** 2).sum(axis=1).argmax()]
                along = own @ (other - far)
                middle = (high - low) // 2
                self.order[low:high] = self.order[low:high][np.argpartition(along, middle)]
                waiting += [(low, low + middle, number, 0), (low + middle, high, number, 1)]
        self.centers, self.radii = np.array(centers), np.array(radii)
        self.vectors = vectors[self.order]

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Upper bound of every (query, node), a little above the exact value against rounding."""
        sizes = np.sqrt((queries**2).sum(axis=1))
        return (queries @ self.centers.T + sizes[:, None] * self.radii[None, :]) * (1 + 1e-12) + sizes[:, None] * 1e-6 + 1e-6

    def search(self, query: np.ndarray, bounds: np.ndarray, ids: np.ndarray, k: int, floor: float, own: int) -> list[tuple[float, int, int]]:
        """Up to k (score, -id, place) with scores of at least ``floor``; ``own`` is the place left out."""
        found: list[tuple[float, int, int]] = []
        waiting = [(-bounds[0], 0)]
        while waiting:
            bound, node = heapq.heappop(waiting)
            if -bound < floor:
                break
            if pair := self.children[node]:
                for child in pair:
                    if bounds[child] >= floor:
                        heapq.heappush(waiting, (-bounds[child], child))
                continue
            low = self.low[node]
            scores = self.vectors[low : self.high[node]] @ query
            for at in np.flatnonzero(scores >= floor).tolist():
                place = int(self.order[low + at])
                if place == own:
                    continue
                entry = (float(scores[at]), -int(ids[place]), place)
                if len(found) < k:
                    heapq.heappush(found, entry)
                elif entry > found[0]:
                    heapq.heapreplace(found, entry)
                if len(found) == k:
                    floor = max(floor, found[0][0])
        return found


# --- Spark ------------------------------------------------------------------------------------


def largest_component(dimensions: int, scale: int) -> float:
    """Largest absolute component with which every score is a whole number below 2 ** 53, that is exact in doubles."""
    return (math.isqrt(2**53 // max(dimensions, 1)) - 1) / scale


def _vectors(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, packed = [], []
        for vec_id, vector in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if vec_id is None or not vector.is_valid or vector.values.null_count:
                continue
            values = vector.values.to_numpy(zero_copy_only=False).astype(np.float64)
            if np.isfinite(values).all() and (np.abs(values) <= largest_component(len(values), scale)).all():
                ids.append(vec_id)
                packed.append(np.floor(values * scale).astype("<f8").tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(packed, pa.binary())], ["vec_id", "vector"])


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v) // 8] = np.frombuffer(v, "<f8")
    return out


def _search(queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    names = ["query_row", "query_id", "row", "vec_id", "score"]
    if queries.empty or rows.empty:
        return pd.DataFrame({n: np.array([], np.int64) for n in names})
    width = max(max(map(len, queries["asked"])), max(map(len, rows["vector"])), 8) // 8
    asked = _matrix(queries["asked"], width)
    tree = BallTree(_matrix(rows["vector"], width))
    ids, row_of = rows["vec_id"].to_numpy(np.int64), rows["row"].to_numpy(np.int64)
    place_of = {r: i for i, r in enumerate(row_of.tolist())}
    found = []
    bounds = tree.bounds(asked)
    for i, (row, query_id, floor) in enumerate(zip(queries["query_row"].tolist(), queries["query_id"].tolist(), queries["floor"].tolist(), strict=True)):
        for score, negative, place in tree.search(asked[i], bounds[i], ids, k, floor, place_of.get(row, -1)):
            found.append((row, query_id, int(row_of[place]), -negative, int(score)))
    return pd.DataFrame(found, columns=names).astype(np.int64)


def _in_shards(queries: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """Search every (block, asked_shard) that occurs in ``queries``; rows are sent to the blocks that ask their shard."""
    pairs = queries.select(F.col("block").alias("to_block"), F.col("asked_shard").alias("shard")).distinct()
    sent = rows.join(pairs, "shard")
    return queries.groupBy("block", "asked_shard").cogroup(sent.groupBy("to_block", "shard")).applyInPandas(
        functools.partial(_search_pair, k=k), "query_row long, query_id long, row long, vec_id long, score long"
    )


def _search_pair(key, queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:  # noqa: ARG001
    return _search(queries, rows, k)


def _best(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def top_k(
    embeddings: DataFrame, is_query: Column, *, k: int = 5, scale: int = SCALE, shard_rows: int = SHARD_ROWS, query_block: int = QUERY_BLOCK
) -> DataFrame:
    """query_id, rank, vec_id and score of the k best rows for every row that ``is_query`` (over vec_id) chooses."""
    packed = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).mapInArrow(
        functools.partial(_vectors, scale=scale), "vec_id long, vector binary"
    )
    rows = stage(packed.withColumn("row", F.monotonically_increasing_id()), "search-vectors")
    counts = rows.agg(F.count("*"), F.count_if(is_query)).first()
    shards, blocks = max(1, -(-counts[0] // shard_rows)), max(1, -(-counts[1] // query_block))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int"))
    asked = rows.filter(is_query).select(
        F.col("row").alias("query_row"), F.col("vec_id").alias("query_id"), F.col("vector").alias("asked"),
        F.pmod(F.xxhash64("row", F.lit(1)), F.lit(blocks)).cast("int").alias("block"),
    )
    home = F.col("block") % shards
    first = _in_shards(asked.withColumns({"asked_shard": home, "floor": F.lit(float("-inf"))}), dealt, k)
    found = first = stage(_best(first, k), "search-home")
    if shards > 1:
        floors = first.groupBy("query_row").agg(F.when(F.count("*") == k, F.min("score").cast("double")).alias("known"))
        others = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("asked_shard")
        told = asked.join(floors, "query_row", "left").withColumn("floor", F.coalesce("known", F.lit(float("-inf")))).select("*", others)
        rest = _in_shards(told.drop("known").filter(F.col("asked_shard") != home), dealt, k)
        found = _best(first.drop("rank").unionByName(rest), k)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
