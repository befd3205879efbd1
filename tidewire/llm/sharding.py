"""Sharding into contiguous ranges whose largest one is as small as can be, in Spark expressions only.

Rows are put into one order by text digest and id, so equal texts are neighbors and form an atomic group.  The
smallest feasible capacity is searched between the mean shard and the mean plus the largest group; a capacity
is checked greedily: a shard ends at the last group that still fits.  Each pass over the group ends takes one
greedy step for many capacities at once, so the search needs a few passes per shard whatever the table's
size, and the passes read only the rows near the cuts.

Defined cases: null text is empty and has size 1; null ids come first within their group; repeated rows
take a slot each; fewer groups than shards leave the last shards empty; an empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.storage import stage

from .running import ordered

SHARDS = 8
#: Capacities tried in one pass.
TRIED_AT_ONCE = 48


def _steps(ends: DataFrame, limits: list[int], largest: int) -> list[int]:
    """For each limit the largest group end up to it (0: none)."""
    low, high = min(limits) - largest, max(limits)
    found = ends.filter((F.col("end") > low) & (F.col("end") <= high)).agg(*[F.max(F.when(F.col("end") <= x, F.col("end"))) for x in limits]).first()
    return [v or 0 for v in found]


def greedy_cuts(ends: DataFrame, capacities: list[int], shards: int, total: int, largest: int) -> list[list[int]]:
    """Ends of the shards of each capacity; a capacity is feasible if its last cut is the total."""
    cuts: list[list[int]] = [[] for _ in capacities]
    at = [0] * len(capacities)
    for _ in range(shards):
        if all(a == total for a in at):
            break
        steps = _steps(ends, [a + c for a, c in zip(at, capacities, strict=True)], largest)
        at = [max(a, s) for a, s in zip(at, steps, strict=True)]
        for own, a in zip(cuts, at, strict=True):
            own.append(a)
    return cuts


def smallest_capacity(ends: DataFrame, shards: int, total: int, largest: int) -> tuple[int, list[int]]:
    """The smallest capacity that ``shards`` contiguous shards can keep to, and its cuts."""
    low = max(-(-total // shards), largest)
    high = -(-total // shards) + largest  # each shard but the last then holds the mean at least
    best: list[int] | None = None
    while best is None or low < high:
        width = high - low
        tried = sorted({low + width * i // TRIED_AT_ONCE for i in range(TRIED_AT_ONCE)} | ({high} if best is None else set()))
        found = greedy_cuts(ends, tried, shards, total, largest)
        feasible = [k for k, cuts in enumerate(found) if cuts and cuts[-1] == total]
        if feasible:
            high, best = tried[feasible[0]], found[feasible[0]]
            low = tried[feasible[0] - 1] + 1 if feasible[0] else high
        else:
            low = tried[-1] + 1
    return high, best


def shard_documents(docs: DataFrame, *, shards: int = SHARDS) -> DataFrame:
    """doc_id, size (bytes plus 1), text_crc32, shard and slot of every document."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
    )
    placed = ordered(rows, ["digest", "doc_id"], ["size"], label="sharding-rows")
    # The group ends where the largest running sum of a digest is.
    groups = stage(
        placed.groupBy("digest").agg(F.max(F.col("size_before") + F.col("size")).alias("end"), F.sum("size").alias("bytes"), F.max("row").alias("row")), "sharding-groups"
    )
    whole = groups.agg(F.max("end"), F.max("bytes")).first()
    total, largest = whole[0] or 0, whole[1] or 0
    cuts = smallest_capacity(groups.select("end"), shards, total, largest)[1] if total else []
    inner = [c for c in cuts if c < total]
    firsts = groups.agg(*[F.max(F.when(F.col("end") <= c, F.col("row"))) for c in inner]).first() if inner else []
    shard, first_row = F.lit(0), F.lit(0)
    end = F.col("size_before") + F.col("size")
    for k, (cut, row) in enumerate(zip(inner, firsts, strict=True)):
        shard = F.when(end > cut, F.lit(k + 1)).otherwise(shard)
        first_row = F.when(end > cut, F.lit(row + 1)).otherwise(first_row)
    return placed.select("doc_id", "size", "text_crc32", shard.cast("int").alias("shard"), (F.col("row") - first_row).cast("long").alias("slot"))
