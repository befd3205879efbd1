"""Row numbers and running sums over a whole table in a given order, without one task seeing it all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewire.storage import stage


def ordered(rows: DataFrame, order: Sequence[str], sums: Sequence[str] = (), *, label: str = "ordered") -> DataFrame:
    """Adds ``row`` (from 0) and ``<sum>_before`` (sum of all earlier rows) for a total order by ``order``.

    Rows are dealt into ranges of the order columns; a window works inside a range and a table with one row
    per range carries the rest over.  The order columns should tell rows apart, so that a frequent first
    column is cut by the others; rows equal in all of them may come in any order.  Result is staged.
    """
    keys = [F.col(c).asc_nulls_first() for c in order]
    dealt = stage(rows.repartitionByRange(*keys).withColumn("__range", F.spark_partition_id()), f"{label}-ranges")
    totals = dealt.groupBy("__range").agg(F.count("*").alias("__n"), *[F.sum(c).alias(f"__{c}") for c in sums])
    # One row per range: bounded by the number of shuffle partitions.
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        "__range",
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__row"),
        *[F.coalesce(F.sum(f"__{c}").over(before), F.lit(0)).alias(f"__{c}") for c in sums],
    )
    inside = Window.partitionBy("__range").orderBy(*keys).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = dealt.withColumns({"__k": F.row_number().over(Window.partitionBy("__range").orderBy(*keys)), **{f"__in_{c}": F.sum(c).over(inside) for c in sums}})
    joined = numbered.join(F.broadcast(starts), "__range")
    return stage(
        joined.select(
            *rows.columns,
            (F.col("__row") + F.col("__k") - 1).cast("long").alias("row"),
            *[(F.col(f"__{c}") + F.col(f"__in_{c}") - F.col(c)).cast("long").alias(f"{c}_before") for c in sums],
        ),
        label,
    )
