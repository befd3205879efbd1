import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewire.llm import queries, whitening
from tidewire.llm.whitening import Spectrum

from . import cases


def close(found, wanted, scale=None):
    scale = np.abs(wanted).max() if scale is None else scale
    assert np.abs(np.asarray(found) - wanted).max() <= 1e-9 * max(scale, 1e-300)


@pytest.mark.parametrize("kind", ["random", "equal", "zero", "clustered", "sparse", "huge", "last"])
def test_rank_one_updates(kind):
    rng = np.random.default_rng(len(kind))
    for d in (1, 2, 3, 17, 40):
        values = np.sort({
            "random": rng.random(d), "equal": np.ones(d), "zero": np.zeros(d), "clustered": 1 + 1e-14 * rng.random(d) * (np.arange(d) % 3),
            "sparse": rng.random(d), "huge": 10.0 ** rng.integers(-12, 12, d), "last": np.arange(d) * 1.0,
        }[kind])
        basis, _ = np.linalg.qr(rng.normal(size=(d, d)))
        v = {"sparse": basis[:, 0] * 2, "huge": rng.normal(size=d) * 1e3, "last": basis[:, -1] * 100 + 1e-9}.get(kind, rng.normal(size=d))
        matrix = basis @ np.diag(values) @ basis.T + np.outer(v, v)
        found, vectors = whitening.rank_one(values, basis, v)
        size = np.abs(matrix).max()
        close(found, np.linalg.eigvalsh(matrix), size)
        close(vectors.T @ vectors, np.eye(d), 1)
        close(vectors @ np.diag(found) @ vectors.T, matrix)
        assert (np.diff(found) >= 0).all()


def test_spectra_grow_and_combine():
    """One vector at a time, in blocks, and in parts that are combined: the scatter of all."""
    rng = np.random.default_rng(5)
    rows = np.floor(rng.normal(size=(500, 12)) @ rng.normal(size=(12, 12)) * 30 + 50)
    rows[:, 3] = 7
    rows[:, 5] = rows[:, 4]
    centred = rows - rows.mean(axis=0)
    for block, parts in ((1, 1), (64, 1), (500, 1), (1, 5), (40, 3)):
        spectra = []
        for part in np.array_split(rows, parts):
            spectra.append(Spectrum.empty(12))
            for at in range(0, len(part), block):
                spectra[-1].add(part[at : at + block])
        for other in spectra[1:]:
            spectra[0].combine(other)
        s = spectra[0]
        assert s.n == 500
        close(s.mean, rows.mean(axis=0))
        close(s.vectors @ np.diag(s.values) @ s.vectors.T, centred.T @ centred)
        close(s.vectors.T @ s.vectors, np.eye(12), 1)


def expected(rows: list[tuple]) -> dict:
    """vec_id to (deviation, whitened) with numpy's eigenvectors of the whole covariance."""
    kept = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    lengths = [len(v) for _, v in kept]
    length = max(set(lengths), key=lambda n: (lengths.count(n), n))
    kept = [(i, v) for i, v in kept if len(v) == length]
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for _, v in kept])
    n, s = len(x), x.sum(axis=0)
    centred = (x * n - s) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    explained = values / values.sum() if values.sum() > 0 else values * 0
    whitened = np.where(explained > 1e-12, centred @ vectors / np.sqrt(np.maximum(values, 1e-9)), 0)[:, :32]
    return {"n": n, "explained": explained, "rows": [(kept[k][0], int(((n * x[k] - s) ** 2).sum()), whitened[k]) for k in range(n)]}


def same(found, rows) -> None:
    wanted = expected(rows)
    got = sorted(found, key=lambda r: (r[0] is not None, r[0], r[1]))
    want = sorted(wanted["rows"], key=lambda r: (r[0] is not None, r[0], r[1]))
    assert [r[:2] for r in got] == [r[:2] for r in want]
    a, b = np.array([r[2] for r in got]), np.array([r[2] for r in want])
    sign = np.where((a * b).sum(axis=0) < 0, -1, 1)
    assert np.abs(a - b * sign).max() < 1e-7


def made(n: int = 600, d: int = 5) -> list[tuple]:
    rng = np.random.default_rng(9)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(n, d)) * np.arange(1, d + 1))]
    return rows + [(None, [1.0] * d), (7, [0.5] * d), (7, [0.5] * d), (-1, None), (-2, []), (-3, [1.0] * (d - 1)), (-4, [None] + [1.0] * (d - 1)), (-5, [math.nan] * d), (-6, [math.inf] * d)]


@pytest.mark.parametrize("block", [1, whitening.BLOCK])
def test_small_table(spark, block):
    """Also the plain update per vector; twenty tasks are combined in two rounds."""
    rows = made()
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(20)
    found, model = whitening.whiten(table, block=block)
    same([(r["vec_id"], r["deviation"], r["whitened"]) for r in found.collect()], rows)
    assert model.n == 603 and model.identity_error < 1e-9
    assert np.abs(np.array(model.explained) - expected(rows)["explained"]).max() < 1e-12
    assert np.abs(model.components.T @ model.components - np.eye(5)).max() < 1e-12


def test_without_variance(spark):
    """One vector, equal vectors and a constant dimension: 0 along what doesn't vary."""
    for rows in ([(1, [1.0, 2.0])], [(i, [1.0, 2.0, 3.0]) for i in range(9)], [(i, [1.0, i * 0.5, -i * 1.0]) for i in range(9)]):
        found, model = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
        same([(r["vec_id"], r["deviation"], r["whitened"]) for r in found.collect()], rows)
        assert model.identity_error < 1e-9


def test_clashing_columns_huge_entries_and_no_rows(spark):
    table = spark.createDataFrame(made(40), "vec_id long, embedding array<double>")
    clashing = ["x", "whitened", "n", "deviation", "id", "s", *cases.CLASHING[:3]]
    more = table.withColumns({**{c: F.lit("clash") for c in clashing}, "dotted.name": F.lit(1)})
    found, _ = whitening.whiten(more)
    assert found.columns == [c for c in more.columns if c not in ("deviation", "whitened")] + ["deviation", "whitened"]
    row = dict(zip(found.columns, found.first(), strict=True))
    assert (row["x"], row["dotted.name"], len(row["whitened"])) == ("clash", 1, 5)
    huge = spark.createDataFrame([(1, [1e300]), (2, [1.5e10]), (3, [-1.5e10]), (4, [0.0]), (5, [0.0])], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["deviation"] for r in whitening.whiten(huge)[0].collect()}
    assert set(got) == {2, 3, 4, 5} and got[2] is None and got[4] == 0
    for rows in ([], [(1, None), (2, [])]):
        found, model = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
        assert model is None and found.count() == 0 and found.columns == ["vec_id", "embedding", "deviation", "whitened"]


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], r["embedding"]) for r in queries.table(spark, sf, "embeddings").collect()]
    got = queries.QUERIES["op11_incremental_whitening"](spark, sf).orderBy("vec_id", "component").collect()
    wanted = expected(rows)
    by_id: dict = {}
    for r in got:
        by_id.setdefault((r["vec_id"], r["deviation"]), []).append(r["whitened"])
        assert r["n"] == wanted["n"] and r["identity_error"] < 1e-4
        assert abs(r["explained"] / wanted["explained"][r["component"] - 1] - 1) < 1e-6
    assert all(len(w) == 32 for w in by_id.values())
    same([(i, d, w) for (i, d), w in by_id.items()], rows)
