"""Lines that many documents repeat, found with two Bloom filters.

A line's key is the line without ASCII white space at both ends, A-Z in lower case.  Keys of at least ``MIN_LENGTH`` code
points found in at least ``MIN_DOCUMENTS`` documents lose their lines everywhere but in the largest doc_id that holds them.

1. Every task folds the hashes of its documents' keys into two filters, *once* and *twice*: a hash that is in *once*
   already goes to *twice*.  Filters travel as compressed slices and are merged slice by slice, ``twice |= other.twice |
   (once & other.once)`` before ``once |= other.once``, so a key of two documents is in *twice* wherever these lie.
2. A second pass tests every key against *twice*.  Documents without a suspected key are done; of the others the
   suspected keys, and nothing else, are shuffled.
3. Suspected keys are counted as texts, which drops what the filters suspected wrongly, and the largest doc_id of each is
   chosen.  What a document loses is joined to it by a row number.

The filters hold ``BITS_PER_KEY`` bits for each possible key, from a count of the table's line ends, and at most
``MAX_BITS``: that bounds the memory of a task (two filters) and what is broadcast (*twice* alone, 64 MiB).  Beyond some 10 ** 8
lines they fill up, more keys than the repeated ones are suspected and shuffled, and the result stays the same;
a larger cluster can raise ``max_bits``.

Defined cases: null and empty texts are one empty line; every row is a document, also where rows or ids are repeated, and all
rows with the largest id keep their lines; a null id is smaller than any other; a document that repeats a line
counts once for it and keeps or loses all of them; an empty table gives no rows; further columns are kept, those named
``n_lines`` or ``n_dropped`` are replaced.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tidewire.storage import stage

from .tables import plain_names, release

MIN_LENGTH = 20
MIN_DOCUMENTS = 3
BITS_PER_KEY = 10
MAX_BITS = 1 << 29
HASHES = 4
_SLICE = 1 << 14  # bytes


# --- keys and filters ---------------------------------------------------------------


def key_of(line: bytes) -> bytes:
    """Bytes know ASCII white space and A-Z only."""
    return line.strip().lower()


def long_keys(text: str | None, min_length: int = MIN_LENGTH) -> dict[bytes, None]:
    """A text's distinct keys of at least ``min_length`` code points, in order."""
    found = dict.fromkeys(map(key_of, (text or "").encode().split(b"\n")))
    return {k: None for k in found if len(k) >= min_length and (k.isascii() or len(k.decode()) >= min_length)}


def hashes_of(keys) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))


def places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Bits of each hash, one row per hash function; ``bits`` is a power of two."""
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    return (hashes + np.arange(HASHES, dtype=np.uint64)[:, None] * step) & np.uint64(bits - 1)


def contains(bitmap: np.ndarray, at: np.ndarray) -> np.ndarray:
    return ((bitmap[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=0)


def put(bitmap: np.ndarray, at: np.ndarray) -> None:
    np.bitwise_or.at(bitmap, (at >> np.uint64(3)).astype(np.int64).ravel(), np.left_shift(np.uint8(1), (at & np.uint64(7)).astype(np.uint8)).ravel())


class Filters:
    """Bloom filters of the hashes seen once and twice."""

    def __init__(self, bits: int):
        self.bits = bits
        self.once = np.zeros(bits >> 3, dtype=np.uint8)
        self.twice = np.zeros(bits >> 3, dtype=np.uint8)

    def add(self, hashes: np.ndarray) -> None:
        """Hashes of some documents; a document gives each of its own but once."""
        values, counts = np.unique(hashes, return_counts=True)
        at = places(values, self.bits)
        put(self.twice, at[:, (counts > 1) | contains(self.once, at)])
        put(self.once, at)


def _filled(batches: Iterator[pa.RecordBatch], bits: int, min_length: int) -> Iterator[pa.RecordBatch]:
    filters = Filters(bits)
    for batch in batches:
        found = [hashes_of(long_keys(t.as_py(), min_length)) for t in batch.column(0)]
        if found:
            filters.add(np.concatenate(found))
    for at in range(0, bits >> 3, _SLICE):
        once, twice = filters.once[at : at + _SLICE], filters.twice[at : at + _SLICE]
        if once.any():
            yield pa.RecordBatch.from_pydict({"slice": pa.array([at // _SLICE], pa.int32()), "once": [zlib.compress(once, 1)], "twice": [zlib.compress(twice, 1)]})
    del filters
    release()


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices arrive in order; one pair is held at a time."""
    number, once, twice = None, None, None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"slice": pa.array([number], pa.int32()), "twice": [zlib.compress(twice, 1)]})

    for batch in batches:
        for k, a, b in zip(*(batch.column(i) for i in range(3)), strict=True):
            more = np.frombuffer(zlib.decompress(a.as_py()), np.uint8)
            again = np.frombuffer(zlib.decompress(b.as_py()), np.uint8)
            if k.as_py() != number:
                if number is not None and twice.any():
                    yield done()
                number, once, twice = k.as_py(), more.copy(), again.copy()
                continue
            twice |= again | (once & more)
            once |= more
    if number is not None and twice.any():
        yield done()


def filter_bits(texts: DataFrame, *, min_length: int = MIN_LENGTH, bits_per_key: int = BITS_PER_KEY, max_bits: int = MAX_BITS) -> int:
    """A power of two: room for every key that the line ends and lengths allow, between one slice and ``max_bits``."""
    length, lines = F.length("text") + 1, F.length("text") - F.length(F.replace("text", F.lit("\n"))) + 1
    most = texts.agg(F.sum(F.least(lines, F.floor(length / (min_length + 1))))).first()[0] or 0
    return max(8 * _SLICE, min(1 << (max_bits.bit_length() - 1), 1 << (most * bits_per_key).bit_length()))


def twice_seen(texts: DataFrame, bits: int, *, min_length: int = MIN_LENGTH) -> np.ndarray:
    """The merged filter of hashes seen in two documents or more; ``texts`` has the column text."""
    parts = texts.select("text").mapInArrow(functools.partial(_filled, bits=bits, min_length=min_length), "slice int, once binary, twice binary")
    merged = parts.repartition("slice").sortWithinPartitions("slice").mapInArrow(_merged, "slice int, twice binary")
    bitmap = np.zeros(bits >> 3, dtype=np.uint8)
    for number, data in merged.toLocalIterator():  # bounded by max_bits
        bitmap[number * _SLICE : (number + 1) * _SLICE] = np.frombuffer(zlib.decompress(data), np.uint8)
    return bitmap


# --- lines --------------------------------------------------------------------------


def _suspected(batches: Iterator[pa.RecordBatch], twice: Broadcast, text_at: int, names: list[str], min_length: int) -> Iterator[pa.RecordBatch]:
    bitmap = np.frombuffer(twice.value, np.uint8)
    bits = len(bitmap) << 3
    for batch in batches:
        lines, keys = [], []
        for value in batch.column(text_at):
            text = value.as_py() or ""
            own = list(long_keys(text, min_length))
            seen = contains(bitmap, places(hashes_of(own), bits)).tolist() if own else []
            lines.append(text.count("\n") + 1)
            keys.append([k.decode() for k, s in zip(own, seen, strict=True) if s])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lines, pa.int64()), pa.array(keys, pa.list_(pa.string()))], names)
    release()


def _cut(batches: Iterator[pa.RecordBatch], text_at: int, drops_at: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, counts = [], []
        for value, drops in zip(batch.column(text_at), batch.column(drops_at), strict=True):
            text, gone = value.as_py(), drops.as_py()
            if gone:
                gone = {k.encode() for k in gone}
                lines = text.encode().split(b"\n")
                left = [x for x in lines if key_of(x) not in gone]
                counts.append(len(lines) - len(left))
                texts.append(b"\n".join(left).decode())
            else:
                counts.append(0)
                texts.append(text)
        columns = [pa.array(texts, pa.string()) if i == text_at else c for i, c in enumerate(batch.columns) if i != drops_at]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64())], names)
    release()


def without_repeated_lines(
    docs: DataFrame, *, min_length: int = MIN_LENGTH, min_documents: int = MIN_DOCUMENTS, bits_per_key: int = BITS_PER_KEY, max_bits: int = MAX_BITS
) -> DataFrame:
    """``docs`` with repeated lines taken out of ``text``, and n_lines (before) and n_dropped of every document."""
    if min_documents < 2:
        raise ValueError("a key is repeated from two documents on")
    given = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    plain = plain_names(docs.drop("n_lines", "n_dropped"), "doc_id", "text").withColumn("text", F.col("text").cast("string"))
    columns, text_at = plain.columns, given.index("text")

    bits = filter_bits(plain, min_length=min_length, bits_per_key=bits_per_key, max_bits=max_bits)
    twice = docs.sparkSession.sparkContext.broadcast(twice_seen(plain, bits, min_length=min_length).tobytes())
    numbered = plain.withColumn("row", F.monotonically_increasing_id())
    tested = StructType([*numbered.schema.fields, StructField("n_lines", LongType()), StructField("keys", ArrayType(StringType()))])
    seen = functools.partial(_suspected, twice=twice, text_at=text_at, names=tested.names, min_length=min_length)
    known = stage(numbered.mapInArrow(seen, tested), "linededup-tested")
    twice.destroy()

    held = known.filter(F.size("keys") > 0)
    suspects = held.select("row", F.col("doc_id").alias("id"), F.explode("keys").alias("key"))
    counted = suspects.groupBy("key").agg(F.count("*").alias("n"), F.max("id").alias("keep")).filter(F.col("n") >= min_documents)
    # Staged, so that the join below has plain scans on both sides and Spark can split a frequent key.
    repeated = stage(counted.select("key", "keep"), "linededup-repeated")
    lost = suspects.join(repeated, "key").filter(~F.col("id").eqNullSafe(F.col("keep"))).groupBy("row").agg(F.collect_list("key").alias("drops"))
    joined = held.join(stage(lost, "linededup-lost"), "row", "left").select(*columns, "n_lines", "drops")
    result = StructType([*joined.schema.fields[:-1], StructField("n_dropped", LongType())])
    cut = joined.mapInArrow(functools.partial(_cut, text_at=text_at, drops_at=len(columns) + 1, names=result.names), result)
    done = known.filter(F.size("keys") == 0).select(*columns, "n_lines", F.lit(0).cast("long").alias("n_dropped"))
    return cut.union(done).toDF(*given, "n_lines", "n_dropped")
