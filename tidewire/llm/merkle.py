"""Merkle manifest of a dataset with a witness for every row, grown by appending.

Every group (``source``) has a tree over its leaves in the order of ``doc_id``: while several nodes remain, each ``ARITY``
consecutive ones become their parent.  The groups' roots, in the order of the groups, get a tree of the same kind.

Nodes are appended in order (``Appender``).  A subtree that waits for its siblings is *open* and has a partial witness; once
its run is complete, the digests of the siblings extend the witness of each member, which all leaves below share, and the
parent is appended one level up.  Each task appends one aligned block of ``ARITY ** BLOCK_LEVELS`` leaves, so a group of any
size is many tasks; the roots of the blocks are appended like leaves, in blocks again, until one is left.  A leaf's whole
witness is its own in its block followed by its block's.

Digests are lower-case hexadecimal SHA-256; a parent is the digest of its children's texts one after another.  Witnesses hold
the siblings' 32 bytes each from the lowest level up, left to right; their places follow from ``place`` and ``members``.

Defined cases: nulls in any field count as ``-``; a null group is a group of its own, the first; null ids come first; rows
with equal ids follow their leaves' digests, and repeated rows are leaves of their own; an empty table gives no rows; further
columns are kept, those with the names of the result are replaced.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from tidewire.storage import stage

from .tables import plain_names, release

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 3
BLOCK_LEVELS = 6
RESULT = ("place", "members", "group_place", "groups", "witness", "subroot", "root")


# --- leaves -------------------------------------------------------------------------


def leaf_of(fields: Sequence[Column]) -> Column:
    """Digest of a row: each field is ``-`` if null, else its length in UTF-8 bytes, ``:`` and its text."""

    def written(field: Column) -> Column:
        text = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(written, fields)), 256)


def parent_of(children: Sequence[bytes]) -> bytes:
    return hashlib.sha256(b"".join(children).hex().encode()).digest()


# --- one task -----------------------------------------------------------------------


class Appender:
    """Appends nodes in order and keeps, per level, the siblings that complete each subtree's witness."""

    def __init__(self, arity: int = ARITY):
        self.arity = arity
        self.open: list[list[bytes]] = [[]]
        self.extensions: list[list[bytes]] = [[]]

    def append(self, digest: bytes, level: int = 0) -> None:
        if level == len(self.open):
            self.open.append([])
            self.extensions.append([])
        self.open[level].append(digest)
        if len(self.open[level]) == self.arity:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run = self.open[level]
        self.extensions[level] += [b"".join(run[:k] + run[k + 1 :]) for k in range(len(run))]
        self.open[level] = []
        self.append(parent_of(run), level + 1)

    def finish(self, height: int | None = None) -> bytes:
        """Complete what is open, up to ``height`` or else until one node remains; returns that node."""
        level = 0
        while True:
            run = self.open[level]
            if level == height or (height is None and len(run) == 1 and level == len(self.open) - 1):
                return run[0]
            if run:
                self._complete(level)
            level += 1

    def witness(self, place: int) -> bytes:
        """Siblings of the ``place``-th leaf and of the subtrees around it, as far as they are known."""
        found = []
        for level in self.extensions:
            if place >= len(level):
                break
            found.append(level[place])
            place //= self.arity
        return b"".join(found)


def folded(digest: bytes, witness: bytes, places: Sequence[tuple[int, int]], arity: int = ARITY) -> bytes:
    """The root that a digest gives with its witness; (place, number of leaves) of each tree passed on the way."""
    at = 0
    for place, members in places:
        while members > 1:
            first = place - place % arity
            siblings = [witness[at + 32 * k : at + 32 * k + 32] for k in range(min(arity, members - first) - 1)]
            at += 32 * len(siblings)
            siblings.insert(place - first, digest)
            digest = parent_of(siblings)
            place, members = place // arity, -(-members // arity)
    return digest


def _appended(block: pa.Table, arity: int, levels: int) -> pa.Table:
    block = block.sort_by("place")
    appender = Appender(arity)
    for digest in block.column("digest"):
        appender.append(digest.as_py())
    whole = block.column("members")[0].as_py() <= arity**levels
    root = appender.finish(None if whole else levels)
    witnesses = [appender.witness(k) for k in range(block.num_rows)]
    return block.append_column("witness", pa.array(witnesses, pa.binary())).append_column("block_root", pa.array([root] * block.num_rows, pa.binary()))


# --- the table ----------------------------------------------------------------------


def _placed(rows: DataFrame, order: Sequence[str], label: str) -> DataFrame:
    """Adds place (from 0) and members within each ``group``; rows are dealt into ranges, so that a large group is cut."""
    keys = [F.col(c).asc_nulls_first() for c in order]
    dealt = stage(rows.repartitionByRange(F.col("group"), *keys).withColumn("range", F.spark_partition_id()), f"{label}-ranges")
    # One row per group and range that holds some of it.
    counts = dealt.groupBy("range", "group").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("group").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("range", "group", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"), F.sum("n").over(Window.partitionBy("group")).alias("members"))
    inside = dealt.withColumn("k", F.row_number().over(Window.partitionBy("range", "group").orderBy(*keys)))
    joined = inside.join(starts, ["range", "group"])
    return joined.select(*rows.columns, (F.col("start") + F.col("k") - 1).cast("long").alias("place"), F.col("members").cast("long").alias("members"))


def _forest(rows: DataFrame, arity: int, levels: int) -> tuple[DataFrame, DataFrame]:
    """Rows with block and witness inside it, and for every (group, block) its own witness and the group's root.

    ``rows`` has group, place, members and digest.  A block is a group of at most ``arity ** levels`` rows for one task.
    """
    size = arity**levels
    blocked = rows.withColumn("block", F.expr(f"place div {size}"))
    schema = StructType([*blocked.schema.fields, StructField("witness", BinaryType()), StructField("block_root", BinaryType())])
    grown = stage(blocked.groupBy("group", "block").applyInArrow(lambda block: _appended(block, arity, levels), schema), "merkle-blocks")
    tops = grown.filter(F.col("place") % size == 0).select(
        "group", F.col("block").alias("place"), F.ceil(F.col("members") / size).cast("long").alias("members"), F.col("block_root").alias("digest")
    )
    if (grown.agg(F.max("members")).first()[0] or 0) <= size:
        upper = tops.select("group", F.col("place").alias("block"), F.lit(b"").alias("above"), F.col("digest").alias("top"))
    else:
        upper = _joined(*_forest(tops, arity, levels)).select("group", F.col("place").alias("block"), F.col("witness").alias("above"), F.col("top"))
    return grown.drop("block_root"), stage(upper, "merkle-upper")


def _joined(grown: DataFrame, upper: DataFrame) -> DataFrame:
    return grown.join(upper, ["group", "block"]).withColumn("witness", F.concat("witness", "above")).drop("block", "above")


def manifest(leaves: DataFrame, *, group: str = "source", order: str = "doc_id", leaf: str = "leaf", arity: int = ARITY, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """``leaves`` with place and members of each row in its group's tree, group_place and groups in the top tree, witness, subroot and root.

    ``leaf`` names the column with the digests of the rows, see ``leaf_of``.
    """
    if arity < 2 or block_levels < 1:
        raise ValueError("a run has two members or more, a block one level or more")
    given = [c for c in leaves.columns if c not in RESULT]
    plain = plain_names(leaves.drop(*RESULT), group, order, leaf).withColumnsRenamed({group: "group_value", order: "order_value", leaf: "leaf_value"})
    columns = plain.columns
    # A null group comes before all others, and groups follow the bytes of their names.
    name = F.coalesce(F.concat(F.lit("="), F.col("group_value").cast("string")), F.lit(""))
    keyed = plain.withColumns({"group": name, "digest": F.unhex("leaf_value")})
    grown, upper = _forest(_placed(keyed, ["order_value", "leaf_value"], "merkle-leaves"), arity, block_levels)

    roots = upper.filter("block = 0").select(F.lit("").alias("group"), F.col("group").alias("name"), F.col("top").alias("digest"))
    top = _joined(*_forest(_placed(roots, ["name"], "merkle-groups"), arity, block_levels)).select(
        F.col("name").alias("group"), F.col("place").alias("group_place"), F.col("members").alias("groups"), F.col("witness").alias("over"), F.col("top").alias("root")
    )
    # Joined to the blocks first: there is one row of a group for each of its blocks only.
    upper = upper.join(top, "group").withColumn("above", F.concat("above", "over")).drop("over")
    found = grown.join(upper, ["group", "block"]).select(
        *columns, "place", "members", "group_place", "groups", F.concat("witness", "above").alias("witness"),
        F.lower(F.hex("top")).alias("subroot"), F.lower(F.hex("root")).alias("root"),
    )
    return found.toDF(*given, *RESULT)


def _checked(batches: Iterator[pa.RecordBatch], arity: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        proofs, roots = [], []
        for claim, place, members, group_place, groups, witness in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
            proofs.append(hashlib.sha256(witness.hex().encode()).hexdigest())
            roots.append(folded(bytes.fromhex(claim), witness, ((place, members), (group_place, groups)), arity).hex())
        yield pa.RecordBatch.from_arrays([*batch.columns[6:], pa.array(proofs, pa.string()), pa.array(roots, pa.string())], names)
    release()


def verified(listed: DataFrame, claim: Column, *, arity: int = ARITY) -> DataFrame:
    """A manifest with proof_sha256 (of the siblings), folded_root (from ``claim``, a row's digest as seen now) and verified."""
    added = ("proof_sha256", "folded_root", "verified")
    given = [c for c in listed.columns if c not in added]
    parts = [f"p{i}" for i in range(6)]
    rows = listed.drop(*added).select(claim, *RESULT[:5], "*").toDF(*parts, *given)
    plain = plain_names(rows, *parts)
    kept = StructType([*plain.schema.fields[6:], *StructType.fromDDL("proof string, folded string").fields])
    checked = plain.mapInArrow(functools.partial(_checked, arity=arity, names=kept.names), kept)
    return checked.toDF(*given, "proof_sha256", "folded_root").withColumn("verified", F.col("folded_root") == F.col("root"))
