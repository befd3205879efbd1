"""Ordered row computations that cut long keys into bounded chunks.

A window over ``partitionBy(key)`` sends every row of a key to one task.  That is right
while keys are small and breaks when one key holds a large share of the data.  Each
operator here first looks at the key sizes (one aggregate over the key columns):

* no key above ``limit`` rows: the plain window, one shuffle, nothing else;
* otherwise the long keys are cut into chunks along the order column.  The window runs
  inside a chunk, on rows shuffled by ``(key, chunk)``, and the chunk
  borders are repaired by a carry computed from one summary row per chunk.  Only that
  small table is ever windowed over a whole key, and the carry joins back on the
  partitioning the rows already have.

The order column must be unique inside a key; key columns must not be null.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.storage import stage

CHUNK = "__chunk"
_FIRST, _LAST = "__is_first", "__is_last"

# Rows a key may bring to one task.
ROW_LIMIT = 1 << 21


def micros(column: Column | str) -> Column:
    """Microseconds since the epoch (the session time zone must be UTC)."""
    column = F.col(column) if isinstance(column, str) else column
    return F.unix_micros(column.cast("timestamp"))


class Chunked:
    """Rows with their chunk number, and whether any key had to be cut."""

    def __init__(self, rows: DataFrame, keys: Sequence[str], is_cut: bool):
        self.rows, self.keys, self.is_cut = rows, list(keys), is_cut

    def with_columns(self, columns: Mapping[str, Column]) -> Chunked:
        return Chunked(self.rows.withColumns(dict(columns)), self.keys, self.is_cut)

    def carry(
        self,
        summary: Mapping[str, Column],
        carries: Mapping[str, Column],
        alone: Mapping[str, Column],
    ) -> DataFrame:
        """Rows with the ``carries`` of their chunk.

        ``summary`` are aggregates per (key, chunk); ``carries`` are expressions over the
        summary rows of a key (use ``key_window`` or ``before``) and may build on each
        other.  ``alone`` gives the values in force without an earlier or later chunk; its
        names are the columns that are joined.
        """
        if not self.is_cut:
            return self.rows.withColumns(dict(alone))
        on = [*self.keys, CHUNK]
        carried = self.rows.groupBy(*on).agg(*[c.alias(n) for n, c in summary.items()])
        for name, column in carries.items():
            carried = carried.withColumn(name, column)
        return self.rows.join(carried.select(*on, *alone), on, "left")


def chunked(df: DataFrame, keys: Sequence[str], order: str, limit: int = ROW_LIMIT) -> Chunked:
    """Cut keys with more than ``limit`` rows; chunks are ordered like the rows.

    The rows of long keys are dealt into ranges of (keys, whole order column) of half of ``limit`` rows each; Spark
    takes the borders from a sample of the rows, so a burst gets as many chunks as it needs, and equal
    first fields of a struct order are cut by its further ones.  The dealt rows are staged, which fixes their
    chunks for everything that reads them.
    """
    if limit < 1:
        raise ValueError("a key must be allowed at least 1 row")
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > limit)
    if sizes.isEmpty():
        return Chunked(df.withColumn(CHUNK, F.lit(0).cast("bigint")), keys, False)
    long_keys = stage(sizes, "long-keys")
    chunks = -(-long_keys.agg(F.sum("__n")).first()[0] // max(1, limit // 2))
    dealt = df.join(long_keys.drop("__n"), list(keys), "left_semi").repartitionByRange(chunks, *keys, order)
    dealt = stage(dealt.withColumn(CHUNK, F.spark_partition_id().cast("bigint")), "chunks")
    short = df.join(long_keys.drop("__n"), list(keys), "left_anti").withColumn(CHUNK, F.lit(0).cast("bigint"))
    return Chunked(dealt.unionByName(short), keys, True)


def chunk_window(keys: Sequence[str], order: str):
    return Window.partitionBy(*keys, CHUNK).orderBy(order)


def key_window(keys: Sequence[str]):
    return Window.partitionBy(*keys).orderBy(CHUNK)


def before(keys: Sequence[str]):
    """Frame of all earlier chunks of the key."""
    return key_window(keys).rowsBetween(Window.unboundedPreceding, -1)


def nothing(kind) -> Column:
    return F.lit(None).cast(kind)


def adjacent_rows(
    df: DataFrame,
    *,
    keys,
    order: str,
    previous: Mapping[str, str] | None = None,
    following: Mapping[str, str] | None = None,
    limit: int = ROW_LIMIT,
) -> DataFrame:
    """Values of the row before and after, as ``lag(1)`` and ``lead(1)``: ``{source: output}`` each."""
    previous, following = previous or {}, following or {}
    w, chunks = chunk_window(keys, order), key_window(keys)
    cut = chunked(df, keys, order, limit)
    local = {out: F.lag(src).over(w) for src, out in previous.items()}
    local.update({out: F.lead(src).over(w) for src, out in following.items()})
    if not cut.is_cut:
        return cut.rows.withColumns(local).select(*df.columns, *local)
    summary = {f"__edge_{out}": F.max_by(src, order) for src, out in previous.items()}
    summary.update({f"__edge_{out}": F.min_by(src, order) for src, out in following.items()})
    carries = {f"__carry_{out}": F.lag(f"__edge_{out}").over(chunks) for out in previous.values()}
    carries.update({f"__carry_{out}": F.lead(f"__edge_{out}").over(chunks) for out in following.values()})
    rows = cut.carry(summary, carries, carries).withColumns(
        {
            _FIRST: F.lag(F.lit(True)).over(w).isNull(),
            _LAST: F.lead(F.lit(True)).over(w).isNull(),
            **{f"__near_{out}": column for out, column in local.items()},
        }
    )
    edge = {out: _FIRST for out in previous.values()} | {out: _LAST for out in following.values()}
    return rows.select(
        *df.columns,
        *[
            F.when(F.col(flag), F.col(f"__carry_{out}")).otherwise(F.col(f"__near_{out}")).alias(out)
            for out, flag in edge.items()
        ],
    )


def running_sums(
    df: DataFrame,
    *,
    keys,
    order: str,
    sums: Mapping[str, Column],
    limit: int = ROW_LIMIT,
    include_current: bool = True,
) -> DataFrame:
    """Prefix sums of each expression along the key; 0 before the first row when exclusive."""
    zero = F.lit(0)
    cut = chunked(df, keys, order, limit).with_columns({f"__term_{out}": c for out, c in sums.items()})
    rows = cut.carry(
        {f"__sum_{out}": F.sum(f"__term_{out}") for out in sums},
        {f"__base_{out}": F.coalesce(F.sum(f"__sum_{out}").over(before(keys)), zero) for out in sums},
        {f"__base_{out}": zero for out in sums},
    )
    frame = chunk_window(keys, order).rowsBetween(Window.unboundedPreceding, 0 if include_current else -1)
    rows = rows.withColumns({f"__part_{out}": F.sum(f"__term_{out}").over(frame) for out in sums})
    return rows.select(
        *df.columns,
        *[(F.col(f"__base_{out}") + F.coalesce(f"__part_{out}", zero)).alias(out) for out in sums],
    )


def number_rows(df: DataFrame, *, keys, order: str, out: str, limit: int = ROW_LIMIT) -> DataFrame:
    """1-based position of each row inside its key."""
    return running_sums(df, keys=keys, order=order, sums={out: F.lit(1).cast("bigint")}, limit=limit)
