"""Chunked order operators against plain per-key models, with chunks far smaller than a key."""

import random

import pytest
from pyspark.sql import functions as F

from tidewire.operators import ordered


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    out = []
    for number in range(400):
        # Key 0 holds about half of all rows.
        key = 0 if rng.random() < 0.5 else rng.randint(1, 6)
        out.append((key, number * 3 + rng.randint(0, 2), rng.choice([None, 1.0, 2.5, -4.0])))
    return out


def by_key(rows):
    groups = {}
    for row in sorted(rows, key=lambda r: r[1]):
        groups.setdefault(row[0], []).append(row)
    return groups


@pytest.mark.parametrize("limit", [1, 7, 50, 10_000])
def test_adjacent_rows(spark, rows, limit):
    df = spark.createDataFrame(rows, "k int, o long, v double")
    got = ordered.adjacent_rows(
        df, keys=["k"], order="o", previous={"v": "pv", "o": "po"}, following={"v": "nv"}, limit=limit
    ).collect()
    want = set()
    for group in by_key(rows).values():
        for i, (k, o, v) in enumerate(group):
            before = group[i - 1] if i else (k, None, None)
            after = group[i + 1] if i + 1 < len(group) else (k, None, None)
            want.add((k, o, v, before[2], before[1], after[2]))
    assert {tuple(r) for r in got} == want and len(got) == len(rows)


@pytest.mark.parametrize("limit", [1, 7, 10_000])
def test_running_sums_and_numbers(spark, rows, limit):
    df = spark.createDataFrame(rows, "k int, o long, v double")
    summed = ordered.running_sums(
        df, keys=["k"], order="o", sums={"s": F.coalesce("v", F.lit(0.0))}, limit=limit
    )
    got = ordered.number_rows(
        ordered.running_sums(
            summed, keys=["k"], order="o", sums={"e": F.lit(1)}, limit=limit, include_current=False
        ),
        keys=["k"],
        order="o",
        out="n",
        limit=limit,
    ).collect()
    want = set()
    for group in by_key(rows).values():
        total = 0.0
        for i, (k, o, v) in enumerate(group):
            total += v or 0.0
            want.add((k, o, v, total, i, i + 1))
    assert {tuple(r) for r in got} == want


def test_struct_order(spark, rows):
    df = spark.createDataFrame(rows, "k int, o long, v double").withColumn("at", F.struct("o", F.lit(0).alias("x")))
    got = ordered.number_rows(df, keys=["k"], order="at", out="n", limit=30).select("k", "o", "n").collect()
    want = {(k, o, i + 1) for g in by_key(rows).values() for i, (k, o, _) in enumerate(g)}
    assert {tuple(r) for r in got} == want


def test_only_long_keys_are_cut(spark, rows):
    df = spark.createDataFrame(rows, "k int, o long, v double")
    cut = ordered.chunked(df, ["k"], "o", limit=100)
    sizes = {(r.k, r[ordered.CHUNK]): r["count"] for r in cut.rows.groupBy("k", ordered.CHUNK).count().collect()}
    assert cut.is_cut and max(sizes.values()) <= 100
    assert {k for k, chunk in sizes if chunk > 0} == {0}
    whole = ordered.chunked(df, ["k"], "o")
    assert not whole.is_cut
    plan = ordered.adjacent_rows(df, keys=["k"], order="o", previous={"v": "pv"})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_limit_must_be_positive(spark, rows):
    df = spark.createDataFrame(rows, "k int, o long, v double")
    with pytest.raises(ValueError):
        ordered.chunked(df, ["k"], "o", 0)


def test_bursts_and_equal_first_fields_are_cut_too(spark):
    rows = spark.range(100_000).select(
        F.lit(1).alias("k"), F.when(F.col("id") < 99_000, F.col("id")).otherwise(F.col("id") * 1_000_000_000).alias("o"), F.col("id").alias("v")
    )
    cut = ordered.chunked(rows, ["k"], "o", limit=5000)
    assert cut.rows.groupBy("k", ordered.CHUNK).count().agg(F.max("count")).first()[0] <= 5000
    ties = rows.select("k", F.struct((F.col("v") % 2).alias("a"), F.col("v").alias("b")).alias("o"))
    assert ordered.chunked(ties, ["k"], "o", limit=5000).rows.groupBy("k", ordered.CHUNK).count().agg(F.max("count")).first()[0] <= 5000
    numbered = ordered.number_rows(rows, keys=["k"], order="o", out="n", limit=20_000)
    assert numbered.filter("n <> v + 1").isEmpty()
