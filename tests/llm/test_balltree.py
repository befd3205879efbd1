import math

import numpy as np
from pyspark.sql import functions as F

from tidewire.llm import balltree


def brute(rows, k, scale=256):
    """rows are (vec_id, vector); results of the queries (ids divisible by 50) as (query, rank, id, score)."""
    good = [(i, [math.floor(x * scale) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for place, (i, q) in enumerate(good):
        if i % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v, strict=False)), j) for other, (j, v) in enumerate(good) if other != place)
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def search(spark, rows, **given):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({c: F.lit("clash") for c in ("row", "block", "shard", "score", "rank", "vector")})
    return sorted(tuple(r) for r in balltree.top_k(table, F.col("vec_id") % 50 == 0, **given).collect())


def test_awkward_vectors(spark):
    rows = [(i, [float(i % 7), -0.3, i / 9]) for i in range(120)]
    rows += [(50, [1.0, 2.0, 3.0]), (50, [1.0, 2.0, 3.0]), (201, None), (202, [1.0, None, 2.0]), (203, [float("nan"), 1.0, 1.0]), (204, [float("inf"), 0.0, 0.0]), (None, [1.0, 1.0, 1.0])]
    rows += [(205, [9.0]), (206, []), (250, []), (300, [0.0, 0.0, 0.0])]
    rows += [(i, [2.0, 2.0, 2.0]) for i in range(400, 420)]
    assert search(spark, rows) == brute(rows, 5)
    assert search(spark, rows, shard_rows=20, query_block=2, k=3) == brute(rows, 3)


def test_few_rows_and_empty(spark):
    assert search(spark, [(0, [1.0]), (1, [2.0])]) == [(0, 1, 1, 256 * 512)]
    assert search(spark, [(0, [1.0])]) == []
    assert search(spark, []) == []


def test_clustered_vectors_over_shards(spark):
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(9, 16))
    rows = [(i, (centers[i % 9] + rng.normal(size=16) * 0.1).astype(np.float32).tolist()) for i in range(1500)]
    assert search(spark, rows, shard_rows=300, query_block=7) == brute(rows, 5)


def test_the_tree_prunes():
    rng = np.random.default_rng(1)
    centers = rng.normal(size=(40, 8)) * 20
    vectors = np.floor(centers[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 8)))
    tree = balltree.BallTree(vectors)
    seen = []
    tree.vectors = type("Seen", (), {"__getitem__": lambda self, s, v=tree.vectors: seen.append(s.stop - s.start) or v[s]})()
    query = vectors[0]
    found = tree.search(query, tree.bounds(query[None])[0], np.arange(4000), 5, float("-inf"), -1)
    assert sorted(s for s, _, _ in found) == sorted(vectors @ query)[-5:]
    assert sum(seen) < 1000


def test_huge_components_take_no_part(spark):
    rows = [(0, [1.0, 2.0]), (50, [1e300, 1.0]), (1, [-1e308, 0.0]), (2, [3.0, 4.0]), (100, [2.0, -1.0])]
    got = balltree.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0, k=5)
    assert sorted((r.query_id, r.vec_id, r.score // 65536) for r in got.collect()) == [(0, 2, 11), (0, 100, 0), (100, 0, 0), (100, 2, 2)]
