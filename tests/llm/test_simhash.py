import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from tidewire.llm import simhash
from tidewire.llm.queries import op5_simhash_multi_index, table

from . import cases


def slow_print(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", lowered) if w]
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, distance):
    group = {p: p for p in prints}

    def root(x):
        while group[x] != x:
            group[x] = group[group[x]]
            x = group[x]
        return x

    known = sorted(prints)
    for i, a in enumerate(known):
        for b in known[i + 1 :]:
            if (a ^ b).bit_count() <= distance:
                group[max(root(a), root(b))] = min(root(a), root(b))
    return {p: root(p) for p in known}


def check(rows, ids_and_texts, distance=simhash.DISTANCE):
    prints = [(i, slow_print(t)) for i, t in ids_and_texts]
    root = components({p for _, p in prints}, distance)
    lowest = {}
    for i, p in prints:
        if i is not None:
            lowest[root[p]] = min(i, lowest.get(root[p], i))
    order = lambda x: tuple((v is None, v) for v in x)
    assert sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in rows), key=order) == sorted(((i, f"{p:016x}", lowest.get(root[p])) for i, p in prints), key=order)


def digits(rows):
    return rows.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id").collect()


def test_awkward_documents(spark):
    check(digits(simhash.groups(cases.documents(spark))), [(i, t) for i, t, _ in cases.rows()])
    assert simhash.groups(cases.no_documents(spark)).count() == 0


def test_whole_table(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents").collect()
    check(op5_simhash_multi_index(spark, "/root/testdata/sf0.001").collect(), [(r["doc_id"], r["text"]) for r in docs])


@pytest.mark.parametrize(("distance", "segments"), [(4, 3), (4, 4), (4, 2), (3, 3), (6, 3), (0, 3)])
def test_links_equal_all_pairs(spark, distance, segments):
    random.seed(distance * 10 + segments)
    centers = [random.getrandbits(64) for _ in range(12)] + [0, (1 << 64) - 1, 1 << 63]
    prints = set(centers)
    for c in centers:
        for _ in range(12):
            prints.add(c ^ sum(1 << b for b in random.sample(range(64), random.randint(1, 7))))
    given = spark.createDataFrame([(simhash._signed(p),) for p in prints], "fp long")
    got = {frozenset((r["a"], r["b"])) for r in simhash.links(given, distance=distance, segments=segments).collect()}
    known = sorted(prints)
    assert got == {frozenset((simhash._signed(a), simhash._signed(b))) for i, a in enumerate(known) for b in known[i + 1 :] if (a ^ b).bit_count() <= distance}


def test_stars_contract_chains_and_hubs(spark):
    chain = [(i + 1, i) for i in range(300)]
    hub = [(2000 + i, 1000) for i in range(200)]
    shuffled = [(9000 + i, 9000 + i // 3) for i in range(1, 150)]
    edges = spark.createDataFrame(chain + hub + shuffled, "a long, b long")
    got = {r["a"]: r["b"] for r in simhash.stars(edges).collect()}
    assert got == {**{i + 1: 0 for i in range(300)}, **{2000 + i: 1000 for i in range(200)}, **{9000 + i: 9000 for i in range(1, 150)}}


def test_one_of_each_keeps_the_smallest_id(spark):
    docs = cases.documents(spark)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    prints = [(i, slow_print(t)) for i, t, _ in cases.rows()]
    root = components({p for _, p in prints}, simhash.DISTANCE)
    wanted = {}
    for i, p in prints:
        wanted[root[p]] = min(wanted.get(root[p], (True, 0)), (i is None, i or 0))
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == sorted(wanted.values())
