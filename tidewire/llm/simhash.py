"""Near-duplicate groups by SimHash fingerprints and multi-index hashing.

A text's fingerprint has a bit set where over half of its word shingles' hashes have it set.  Texts are
linked when their fingerprints differ in at most ``distance`` bits, and a group is everything linked
directly or through others.

Links are found among distinct fingerprints.  The 64 bits are cut into segments; if two fingerprints differ
in at most r bits, one of the m segments differs in at most r // m of them (and past the first r % m + 1
segments one bit less is enough).  Every fingerprint is stored in one table per segment and probes each with
the small Hamming ball around its own segment; matches are verified on all 64 bits.

Equal fingerprints are one entry, so copies cost nothing here.  Links between different fingerprints are
bounded for each of them: no more than 2,081 can be within 4 bits of each other, whatever the input.  Of two
fingerprints that differ in a segment only the one with the lower differing bit unset probes for the
other, so a link is fetched once per segment.  Groups are then joined up by alternating star
contraction, each round written to the shared folder.

A segment's table has 2 ** (64 / SEGMENTS) entries.  Three segments suit up to some 10 ** 8 fingerprints; with
two, entries stay short beyond that, for about ten times as many probes.  The result is the same.

Defined cases: null text is empty; texts without words have fingerprint zero and are linked like any
other; a null ``doc_id`` is no candidate for a group's smallest id (a group with null ids only has null);
repeated rows give repeated rows; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.storage import Rounds, stage

from .tables import plain_names, release

SHINGLE = 4
SEED = 42
DISTANCE = 4
SEGMENTS = 3


# --- fingerprints -------------------------------------------------------------------


def fingerprint_of(text: str, size: int = SHINGLE, seed: int = SEED) -> int:
    """Fingerprint of one text as an unsigned 64-bit number."""
    import xxhash

    words = text.encode().lower().split()  # bytes: only A-Z change, only ASCII white space splits
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    if len(words) <= size:
        hashes = np.array([xxhash.xxh64_intdigest(joined, seed)], dtype=np.uint64)
    else:
        starts = [0, *ends[: len(words) - size].tolist()]
        stops = (ends[size - 1 :] - 1).tolist()
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts, stops, strict=True)), np.uint64, len(starts))
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 65_536):
        octets = np.ascontiguousarray(hashes[at : at + 65_536]).view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch], size: int, seed: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        *kept, texts = batch.columns
        prints = np.fromiter((fingerprint_of(t.as_py() or "", size, seed) for t in texts), np.uint64, batch.num_rows)
        yield pa.RecordBatch.from_arrays([*kept, pa.array(prints.view(np.int64))], [*batch.schema.names[:-1], "fp"])
    release()


def fingerprints(docs: DataFrame, *, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """doc_id and fp (the fingerprint's bits as a signed long), one row per document."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        functools.partial(_fingerprints, size=shingle, seed=seed), "doc_id long, fp long"
    )


def hex_digits(fp: Column) -> Column:
    """The 16 lower-case hexadecimal digits of a fingerprint."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# --- links --------------------------------------------------------------------------


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def segment_masks(segments: int = SEGMENTS) -> list[int]:
    """The bits of each segment, widths as equal as can be."""
    cuts = [64 * i // segments for i in range(segments + 1)]
    return [(1 << b) - (1 << a) for a, b in itertools.pairwise(cuts)]


def probe_flips(distance: int = DISTANCE, segments: int = SEGMENTS) -> list[tuple[int, int, int]]:
    """(segment, bits to flip, lowest of them) of every probe; the ball of each segment by the pigeonhole rule."""
    whole, rest = divmod(distance, segments)
    flips = []
    for number, mask in enumerate(segment_masks(segments)):
        radius = whole if number <= rest else whole - 1
        places = [1 << k for k in range(64) if mask >> k & 1]
        for size in range(radius + 1):
            flips += [(number, sum(c), c[0] if c else 0) for c in itertools.combinations(places, size)]
    return flips


def links(prints: DataFrame, *, distance: int = DISTANCE, segments: int = SEGMENTS) -> DataFrame:
    """Pairs (a > b) of distinct fingerprints, given as the column ``fp``, that differ in at most ``distance`` bits."""
    masks = [_signed(m) for m in segment_masks(segments)]
    stored = prints.select(
        F.col("fp").alias("other"),
        F.explode(F.array(*[F.struct(F.lit(i).alias("segment"), F.col("fp").bitwiseAND(F.lit(m)).alias("value")) for i, m in enumerate(masks)])).alias("t"),
    ).select("other", "t.*")
    flips = F.array(
        *[
            F.struct(F.lit(i).alias("segment"), F.lit(masks[i]).alias("mask"), F.lit(_signed(bits)).alias("flip"), F.lit(_signed(low)).alias("low"))
            for i, bits, low in probe_flips(distance, segments)
        ]
    )
    probes = (
        prints.select("fp", F.explode(flips).alias("p"))
        .filter(F.col("fp").bitwiseAND(F.col("p.low")) == 0)
        .select("fp", F.col("p.segment").alias("segment"), F.col("fp").bitwiseXOR(F.col("p.flip")).bitwiseAND(F.col("p.mask")).alias("value"))
    )
    # Sizes after an explode are underestimated; the hint keeps a table from being broadcast.
    found = probes.join(stored.hint("merge"), ["segment", "value"]).filter(
        (F.col("fp") != F.col("other")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= distance)
    )
    return found.select(F.greatest("fp", "other").alias("a"), F.least("fp", "other").alias("b")).distinct()


def stars(edges: DataFrame) -> DataFrame:
    """Contract edges (a > b) until every a points at the smallest member of its group; returns those pairs.

    Alternates two steps: each node hands its larger neighbors to its smallest neighbor, then its smaller
    ones.  Both are a partially aggregated minimum and a join; the rounds are few even for long chains.
    """
    rounds = Rounds(edges.sparkSession, "simhash-stars")
    current, before = rounds.store(edges.select("a", "b")), None
    while True:
        state = current.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == before or not state[0]:
            return current
        before = state
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        large = stage(large, "simhash-large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        current = rounds.store(small.select("e.*").filter("a <> b").distinct())


def _grouped(rows: DataFrame, distance: int, segments: int) -> DataFrame:
    """Adds root (a fingerprint that names the group) and component_id to staged rows with doc_id and fp."""
    prints = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    roots = stars(links(prints.select("fp"), distance=distance, segments=segments))
    rooted = prints.join(roots, prints["fp"] == roots["a"], "left").select("fp", "first", F.coalesce("b", "fp").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rows.join(rooted.join(lowest, "root").select("fp", "root", "component_id"), "fp")


def groups(docs: DataFrame, *, shingle: int = SHINGLE, distance: int = DISTANCE, segments: int = SEGMENTS) -> DataFrame:
    """doc_id, fp and component_id: the smallest doc_id among all texts reachable through links."""
    rows = stage(fingerprints(docs, shingle=shingle), "simhash-prints")
    return _grouped(rows, distance, segments).select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, *, shingle: int = SHINGLE, distance: int = DISTANCE, segments: int = SEGMENTS) -> DataFrame:
    """The document with the smallest doc_id of each group (null ids last), all columns kept."""
    plain = plain_names(docs, "doc_id", "text").withColumn("row", F.monotonically_increasing_id())
    known = stage(plain, "simhash-documents")
    texts = known.select("row", F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    prints = texts.mapInArrow(functools.partial(_fingerprints, size=shingle, seed=SEED), "row long, doc_id long, fp long")
    rows = stage(prints, "simhash-prints")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    first = _grouped(rows, distance, segments).groupBy("root").agg(F.min(order).alias("first")).select("first.row")
    return known.join(first, "row", "left_semi").select(*plain.columns[:-1]).toDF(*docs.columns)
