import random
import zlib

import pytest
from pyspark.sql import functions as F

from tidewire.llm import toxicity
from tidewire.llm.queries import table

from . import cases


def recursive(scores):
    """Maximal segments by definition: the best one, then the same left and right of it."""
    best = None
    for i in range(len(scores)):
        for j in range(i, len(scores)):
            s = sum(scores[i : j + 1])
            if s > 0 and (best is None or s > best[0] + 1e-9 or abs(s - best[0]) < 1e-9 and j - i < best[2] - best[1]):
                best = (s, i, j)
    return recursive(scores[: best[1]]) + [best[0]] + recursive(scores[best[2] + 1 :]) if best else []


def test_segments_equal_the_definition():
    random.seed(1)
    for _ in range(500):
        scores = [random.choice([-0.25] * 3 + [1.3, 2.7, -1.1]) for _ in range(random.randint(0, 13))]
        hits = [(i, s) for i, s in enumerate(scores) if s != -0.25]
        assert sorted(toxicity.segments(hits, 0.25)) == pytest.approx(sorted(recursive(scores)))


def test_scale_solves_its_equation():
    import math

    scale = toxicity._scale([(4.0, 10), (2.0, 30)], 100_000, 0.15)
    total = 100_001
    left = (10 * math.exp(4 * scale) + 30 * math.exp(2 * scale) + math.exp(toxicity.CLIP * scale) + (total - 41) * math.exp(-0.15 * scale)) / total
    assert left == pytest.approx(1, abs=1e-6)


@pytest.fixture(scope="module")
def model(spark):
    return toxicity.train(table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels"))


def test_held_out_accuracy(spark, model):
    labels = {r["doc_id"]: r["toxic"] for r in table(spark, "/root/testdata/sf0.01", "labels").collect()}
    rows = toxicity.score(table(spark, "/root/testdata/sf0.01", "documents"), model).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    held = [(labels[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert len(held) > 50 and sum(a == b for a, b in held) >= 0.93 * len(held)
    clean = [p for t, p in held if t == 0]
    assert sum(clean) <= 0.05 * len(clean)


def test_labels_of_the_held_out_fold_change_nothing(spark, model):
    docs, labels = (table(spark, "/root/testdata/sf0.01", n) for n in ("documents", "labels"))
    other = labels.withColumn("toxic", F.when(toxicity.fold() == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.train(docs, other) == model


def test_awkward_documents(spark, model):
    rows = toxicity.score(cases.documents(spark), model).collect()
    assert len(rows) == len(cases.rows()) and all(0 <= r["score"] <= 1 for r in rows)
    empty = {r["score"] for r in toxicity.score(cases.documents(spark, [(1, None, None), (2, "", "a"), (3, " \n", "a")]), model).collect()}
    assert len(empty) == 1 and empty.pop() < 0.5
    assert toxicity.score(cases.no_documents(spark), model).count() == 0
    assert toxicity.clean_documents(cases.documents(spark), model).columns == cases.documents(spark).columns


def test_without_usable_labels_nothing_is_toxic(spark):
    docs = cases.documents(spark)
    for given in ([], [(10, 0)], [(10, None), (None, 1), (20, 7)]):
        labels = spark.createDataFrame(given, "doc_id long, toxic int").withColumn("text", F.lit("clash"))
        model = toxicity.train(docs, labels)
        assert not model.usable and toxicity.score(docs, model).filter("score > 0").count() == 0
