import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewire.llm import linededup, queries

from . import cases

SPACE = " \t\n\x0b\x0c\r"
LINE = "This line is long enough to count"


def key(line: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def expected(rows: list[tuple], min_length: int = 20, min_documents: int = 3) -> list[tuple]:
    """doc_id, n_lines, n_dropped, text of every row, by counting every line of every row."""
    holders: dict[str, list] = {}
    for i, text in rows:
        for k in {key(x) for x in (text or "").split("\n")}:
            if len(k) >= min_length:
                holders.setdefault(k, []).append(-1 if i is None else i)
    keep = {k: max(ids) for k, ids in holders.items() if len(ids) >= min_documents}
    made = []
    for i, text in rows:
        lines = (text or "").split("\n")
        left = [x for x in lines if keep.get(key(x), i if i is not None else -1) == (-1 if i is None else i)]
        made.append((i, len(lines), len(lines) - len(left), "\n".join(left)))
    return sorted(made, key=str)


def got(table) -> list[tuple]:
    return sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"] or "") for r in table.collect()), key=str)


TEXTS = [
    (1, f"{LINE}\nown one"), (2, f"\t{LINE.upper()}  \nshort\nshort"), (3, f"a\n{LINE}\nb\n{LINE}\n"), (4, "short"), (5, "short\n"), (6, "short\n\n"),
    (7, None), (8, ""), (9, "\n"), (None, f"{LINE}"), (None, "İstanbul'da güzel bir gün\nx"), (10, "İstanbul'da güzel bir gün"), (10, "İstanbul'da güzel bir gün\r"),
    (11, "İ" * 19), (12, "İ" * 19), (13, "İ" * 19), (14, "İ" * 20), (15, "İ" * 20), (16, "İ" * 20), (17, "twice but only twice in all"), (18, "twice but only twice in all"),
    (19, " no ascii space around "), (20, " no ascii space around "), (21, "no ascii space around"),
]


@pytest.mark.parametrize("bits", [linededup.MAX_BITS, 1])
def test_small_table(spark, bits):
    """Also with filters that are full and suspect nearly everything."""
    more = [(100 + i, f"line of the document {i // 4}\nand a line of its own {i}") for i in range(400)]
    docs = spark.createDataFrame(TEXTS + more, "doc_id long, text string").repartition(5)
    assert got(linededup.without_repeated_lines(docs, max_bits=max(bits, 8))) == expected(TEXTS + more)


def test_awkward_documents(spark):
    docs = cases.documents(spark).withColumns({"n_lines": F.lit("clash"), "drops": F.lit(1), "keys": F.lit(2), "dotted.name": F.lit(3), "a`b": F.lit(4)})
    found = linededup.without_repeated_lines(docs)
    assert got(found) == expected([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    assert found.columns == [c for c in docs.columns if c != "n_lines"] + ["n_lines", "n_dropped"]
    row = dict(zip(found.columns, found.first(), strict=True))
    assert (row["row"], row["drops"], row["keys"], row["dotted.name"], row["a`b"]) == ("clash", 1, 2, 3, 4)
    assert linededup.without_repeated_lines(cases.no_documents(spark)).count() == 0


def test_a_very_long_text_and_a_frequent_line(spark):
    long = "\n".join(f"line number {i % 5000} of a long text" for i in range(50_000))
    rows = [(0, long), (1, long), (2, long)] + [(i, f"{LINE}\nand {i}") for i in range(3, 2000)]
    assert got(linededup.without_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(16))) == expected(rows)


def test_filters_miss_nothing():
    """Whatever way documents are dealt, a hash of two documents is in the merged filter."""
    rng = np.random.default_rng(3)
    documents = [np.unique(rng.integers(0, 3000, 40).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for _ in range(60)]
    values, counts = np.unique(np.concatenate(documents), return_counts=True)
    parts = [linededup.Filters(1 << 17) for _ in range(4)]
    for k, hashes in enumerate(documents):
        parts[k % 4].add(hashes)
    once, twice = parts[0].once.copy(), parts[0].twice.copy()
    for p in parts[1:]:
        twice |= p.twice | (once & p.once)
        once |= p.once
    seen = linededup.contains(twice, linededup.places(values, 1 << 17))
    assert seen[counts > 1].all() and seen[counts == 1].mean() < 0.05


def test_only_suspected_keys_are_shuffled(spark):
    rows = [(i, f"a line of document {i} alone\n{LINE}" if i < 50 else f"a line of document {i} alone") for i in range(3000)]
    texts = spark.createDataFrame(rows, "doc_id long, text string").select("text").repartition(6)
    bits = linededup.filter_bits(texts)
    bitmap = linededup.twice_seen(texts, bits)
    own = linededup.hashes_of([f"a line of document {i} alone".encode() for i in range(3000)])
    assert linededup.contains(bitmap, linededup.places(own, bits)).mean() < 0.02
    assert linededup.contains(bitmap, linededup.places(linededup.hashes_of([linededup.key_of(LINE.encode())]), bits)).all()


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in queries.table(spark, sf, "documents").select("doc_id", "text").collect()]
    wanted = sorted((i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in expected(rows))
    assert sorted(tuple(r) for r in queries.QUERIES["op13_two_filter_line_dedup"](spark, sf).collect()) == wanted
