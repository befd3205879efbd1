import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tidewire.llm import merkle, queries

from . import cases


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(values) -> str:
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes: list[str]) -> tuple[str, list[list[tuple[list[str], int]]]]:
    """Root and, for every leaf, its runs as (siblings, own place) from the lowest level up."""
    paths, owners = [[] for _ in nodes], [[k] for k in range(len(nodes))]
    while len(nodes) > 1:
        for at in range(0, len(nodes), 3):
            run = nodes[at : at + 3]
            for k in range(len(run)):
                for owner in owners[at + k]:
                    paths[owner].append((run[:k] + run[k + 1 :], k))
        owners = [sum(owners[at : at + 3], []) for at in range(0, len(nodes), 3)]
        nodes = [h(*nodes[at : at + 3]) for at in range(0, len(nodes), 3)]
    return nodes[0], paths


def expected(rows: list[tuple]) -> list[tuple]:
    """Of rows (doc_id, source, lang, n_chars, text): what the query returns."""
    by_source: dict = {}
    for r in rows:
        by_source.setdefault(r[1], []).append(r)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    found = {s: sorted(by_source[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for s in order}
    trees = {s: tree([leaf(r) for r in found[s]]) for s in order}
    if not order:
        return []
    root, tops = tree([trees[s][0] for s in order])
    made = []
    for k, s in enumerate(order):
        for r, path in zip(found[s], trees[s][1], strict=True):
            claim = leaf(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                claim = leaf((*r[:4], r[4] and r[4].replace("\n", "")))
            fold = claim
            for siblings, place in path + tops[k]:
                fold = h(*siblings[:place], fold, *siblings[place:])
            proof = h(*(x for siblings, _ in path + tops[k] for x in siblings))
            made.append((r[0], leaf(r), trees[s][0], root, proof, fold, fold == root))
    return sorted(made, key=str)


def checked(docs, **options):
    fields = [F.col(c) for c in merkle.FIELDS]
    tampered = [*fields[:4], F.replace("text", F.lit("\n"))]
    claim = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, merkle.leaf_of(tampered)).otherwise(merkle.leaf_of(fields))
    listed = merkle.manifest(docs.withColumns({"leaf": merkle.leaf_of(fields), "claim": claim}), **options)
    return merkle.verified(listed, F.col("claim"))


def digest_rows(found) -> list[tuple]:
    return sorted(map(tuple, found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=str)


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_groups_of_every_size(spark, levels):
    """Sizes around the powers of three, many sources, and blocks from three leaves up."""
    rng, rows = random.Random(levels), []
    for k, n in enumerate([1, 2, 3, 4, 8, 9, 10, 26, 27, 28, 29, 82, 244]):
        source = None if k == 4 else "ß" if k == 5 else f"s{k}"
        rows += [(1000 * k + i, source, "en", i, rng.choice(["a\nb", "x", None, "", "é\n"])) for i in range(n)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(7)
    assert digest_rows(checked(docs, block_levels=levels)) == expected(rows)


def test_awkward_documents(spark):
    docs = cases.documents(spark).withColumns({"place": F.lit("clash"), "group": F.lit("clash"), "digest": F.lit(1), "dotted.name": F.lit(2), "verified": F.lit(3)})
    found = checked(docs)
    assert digest_rows(found) == expected([tuple(r) for r in docs.select(*merkle.FIELDS).collect()])
    row = dict(zip(found.columns, found.first(), strict=True))
    assert (row["group"], row["digest"], row["dotted.name"], type(row["place"])) == ("clash", 1, 2, int)
    assert checked(cases.no_documents(spark)).count() == 0


def test_one_source_and_one_row(spark):
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    for rows in ([(4, "a", None, None, "x\ny")], [(i, "a", "en", 1, "x\ny") for i in range(30)], [(5, None, None, None, None)] * 5):
        assert digest_rows(checked(spark.createDataFrame(rows, schema))) == expected(rows)


def test_witnesses_grow():
    """A leaf's witness is what its siblings' completion has added so far, and only grows."""
    appender, before = merkle.Appender(), [b""] * 40
    for k in range(40):
        appender.append(hashlib.sha256(bytes([k])).digest())
        now = [appender.witness(i) for i in range(k + 1)]
        assert all(n.startswith(b) for n, b in zip(now, before, strict=False))
        before[: k + 1] = now
    root = appender.finish()
    nodes = [hashlib.sha256(bytes([k])).hexdigest() for k in range(40)]
    wanted, paths = tree(nodes)
    assert root.hex() == wanted
    for k, path in enumerate(paths):
        assert appender.witness(k).hex() == "".join(x for siblings, _ in path for x in siblings)
        assert merkle.folded(bytes.fromhex(nodes[k]), appender.witness(k), [(k, 40)]) == root


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in queries.table(spark, sf, "documents").select(*merkle.FIELDS).collect()]
    assert digest_rows(queries.QUERIES["op12_incremental_witnesses"](spark, sf)) == expected(rows)
