import zlib
from collections import defaultdict

import pytest

from tidewire.llm import sharding
from tidewire.llm.queries import op7_minimax_shards, table

from . import cases


def check(rows, texts, shards):
    """``texts`` by row in any order; rows carry size and crc, so they are told apart by those."""
    sizes = sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for t in texts)
    assert sorted((r["size"], r["text_crc32"]) for r in rows) == sizes
    by = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r["shard"], r["slot"])):
        by[r["shard"]].append(r)
    assert all([r["slot"] for r in own] == list(range(len(own))) and 0 <= s < shards for s, own in by.items())
    groups, last = [], None
    for s in sorted(by):
        for r in by[s]:
            key = (r["text_crc32"], r["size"])
            if key == last:
                groups[-1] += r["size"]
            else:
                groups.append(r["size"])
            last = key
    low, high = max(groups, default=0), sum(groups)
    while low < high:
        middle, used, at = (low + high) // 2, 1, 0
        for g in groups:
            if at + g > middle:
                used, at = used + 1, 0
            at += g
        low, high = (low, middle) if used <= shards else (middle + 1, high)
    assert max((sum(r["size"] for r in own) for own in by.values()), default=0) == low
    where = defaultdict(set)
    for r in rows:
        where[r["text_crc32"], r["size"]].add(r["shard"])
    assert all(len(s) == 1 for s in where.values())


@pytest.mark.parametrize("shards", [1, 3, 8, 40])
def test_awkward_documents(spark, shards):
    rows = sharding.shard_documents(cases.documents(spark), shards=shards).collect()
    check(rows, [t for _, t, _ in cases.rows()], shards)


def test_whole_table_and_native(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    placed = op7_minimax_shards(spark, "/root/testdata/sf0.01")
    check(placed.collect(), [r["text"] for r in docs.select("text").collect()], 8)
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_group_of_a_third(spark):
    given = [(i, "copied text" if i % 3 == 0 else f"text {i} " * (i % 11), "s") for i in range(900)]
    check(sharding.shard_documents(cases.documents(spark, given)).collect(), [t for _, t, _ in given], 8)


def test_empty_table(spark):
    assert sharding.shard_documents(cases.no_documents(spark)).count() == 0
