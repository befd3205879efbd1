from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidewire.llm import mixing
from tidewire.llm.queries import op10_source_mixing, table

from . import cases


def targets(sizes):
    """Shares by weight; what is above three times a source's size goes to the others, until none is above."""
    weight = {s: 1 + i % 3 for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    total, capped = sum(sizes.values()), set()
    while total:
        free = [s for s in sizes if s not in capped]
        level = (total - sum(3 * sizes[s] for s in capped)) / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 3 * sizes[s]}
        if not over:
            return {s: 3 * sizes[s] if s in capped else level * weight[s] for s in sizes}
        capped |= over
    return dict.fromkeys(sizes, 0)


def check(rows, given):
    """``given`` are (doc_id, text, source) of the same documents."""
    sizes = defaultdict(int)
    for _, t, s in given:
        sizes[s] += len(cases.words(t))
    wanted = targets(sizes)
    assert Counter((r["doc_id"], r["size"], r["source_size"]) for r in rows) == Counter((i, len(cases.words(t)), sizes[s]) for i, t, s in given)
    assert sorted(r["target"] for r in rows) == pytest.approx(sorted(wanted[s] for _, _, s in given))
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
    taken = defaultdict(int)
    for r in rows:
        taken[r["source_size"], round(r["target"], 3)] += r["taken"]
    for s in sizes:
        others = [x for x in sizes if (sizes[x], round(wanted[x], 3)) == (sizes[s], round(wanted[s], 3))]
        assert abs(taken[sizes[s], round(wanted[s], 3)] - len(others) * wanted[s]) <= len(others) * 2 * mixing.BLOCK


def test_awkward_documents(spark):
    check(mixing.mix(cases.documents(spark)).collect(), cases.rows())
    assert mixing.mix(cases.no_documents(spark)).count() == 0
    rows = mixing.mix(cases.documents(spark, [(1, None, None), (2, "", "a"), (None, " ", "b")])).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in rows] == [(0, 0.0, 0)] * 3


def test_whole_table_reruns_and_native(spark):
    sf = "/root/testdata/sf0.01"
    mixed = op10_source_mixing(spark, sf)
    rows = mixed.collect()
    check(rows, [(r["doc_id"], r["text"], r["source"]) for r in table(spark, sf, "documents").collect()])
    again = mixing.mix(table(spark, sf, "documents").repartition(7)).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    plan = mixed._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_small_sources_stop_at_three_times_their_size(spark):
    given = [(i, "w " * 500, "big") for i in range(40)] + [(100 + i, "w " * 64, f"s{i}") for i in range(6)]
    rows = mixing.mix(cases.documents(spark, given)).collect()
    check(rows, given)
    assert any(r["target"] == 3 * r["source_size"] and r["taken"] == 3 * r["size"] for r in rows)


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 1000])
def test_permutations(spark, n):
    for key in range(3):
        places = [r[0] for r in spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(key))).collect()]
        assert sorted(places) == list(range(n))
        if n == 1000:
            fixed = sum(p == i for i, p in enumerate(places))
            assert fixed < 10 and abs(sum(places[:500]) / 500 - 499.5) < 60


def slow_permuted(index, size, *keys):
    """The swap-or-not shuffle, one index at a time."""
    for r in range(1, mixing.ROUNDS + 1):
        partner = (spark_hash(mixing.SEED, r, *keys) % size - index) % size
        if spark_hash(mixing.SEED + 1, r, max(index, partner), *keys) % 2:
            index = partner
    return index


def spark_hash(*values):
    """Spark's xxhash64 of integers (32 bits where an int is given by position, else 64 bits): a chain of seeds."""
    import struct

    import xxhash

    seed = 42
    for k, v in enumerate(values):
        data = struct.pack("<i", v) if k < HASH_INTS else struct.pack("<q", v)
        seed = xxhash.xxh64_intdigest(data, seed)
    return seed - (1 << 64) if seed >> 63 else seed


HASH_INTS = 2


def test_counts_blocks_and_taken_words_follow_from_the_seed(spark, monkeypatch):
    """Everything from the plan on, anew: the draw, the sums over shards, the permutations and the words."""
    monkeypatch.setattr(mixing, "SHARD_SLOTS", 16)
    given = [(i, "w " * (40 + 7 * i), f"s{i % 3}") for i in range(12)]
    docs = cases.documents(spark, given)
    rows = mixing.ordered(mixing._sized(docs), ["no_source", "source", "doc_id", "size"], ["size"])
    planned = mixing.plan(rows)
    plan = {r["number"]: r for r in planned.collect()}
    every = sum(p["slots"] for p in plan.values())
    shards = -(-every // 16)
    counts = defaultdict(int)
    monkeypatch.setitem(globals(), "HASH_INTS", 1)
    for n, p in plan.items():
        for k in range(p["slots"]):
            counts[n, spark_hash(mixing.SEED + 2, n, k) % shards] += 1
    assert {(r["number"], r["shard"]): r["slots"] for r in mixing.shard_counts(planned).collect()} == dict(counts)
    monkeypatch.setitem(globals(), "HASH_INTS", 2)
    wanted, times = [], Counter()
    for n, p in plan.items():
        k = 0
        for shard in range(shards):
            for _ in range(counts[n, shard]):
                epoch, at = divmod(k, p["blocks"])
                block = slow_permuted(at, p["blocks"], n, epoch)
                wanted.append((n, shard, epoch, block))
                times[n, block] += 1
                k += 1
    assert sorted(tuple(r) for r in mixing.slots(planned).select("number", "shard", "epoch", "block").collect()) == sorted(wanted)
    number = {p["source"]: n for n, p in plan.items()}
    at, taken = defaultdict(int), {}
    for i, t, s in sorted(given, key=lambda g: (g[2], g[0])):
        taken[i] = sum(times[number[s], (at[s] + w) // mixing.BLOCK] for w in range(len(t.split())))
        at[s] += len(t.split())
    assert {r["doc_id"]: r["taken"] for r in mixing.mix(docs).collect()} == taken


def test_the_query_works_from_the_counts(spark):
    plan = op10_source_mixing(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "mixing-counts" in plan or "shard" in plan


def test_shards_get_multinomial_counts_and_exact_totals(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_SLOTS", 500)
    rows = cases.documents(spark, [(i, "w " * 4000, f"s{i % 3}") for i in range(300)])
    planned = mixing.plan(mixing.ordered(mixing._sized(rows), ["no_source", "source", "doc_id", "size"], ["size"]))
    totals = {r["number"]: r["slots"] for r in planned.collect()}
    counts = defaultdict(dict)
    for r in mixing.shard_counts(planned).collect():
        counts[r["shard"]][r["number"]] = r["slots"]
    assert {n: sum(c.get(n, 0) for c in counts.values()) for n in totals} == totals
    share = {n: t / sum(totals.values()) for n, t in totals.items()}
    sizes = [sum(c.values()) for c in counts.values()]
    assert all(abs(n - 500) < 6 * 500**0.5 for n in sizes) and len({tuple(sorted(c.items())) for c in counts.values()}) > 1
    assert all(abs(c.get(n, 0) - sum(c.values()) * share[n]) < 6 * (500 * share[n] * (1 - share[n])) ** 0.5 for c in counts.values() for n in totals)
    drawn = mixing.slots(planned).groupBy("shard", "number").count().collect()
    assert {(r["shard"], r["number"]): r["count"] for r in drawn} == {(s, n): c for s, of in counts.items() for n, c in of.items()}


def test_mixed_documents_hold_the_taken_words(spark):
    docs = cases.documents(spark, [(i, f"a{i} b\n c " * (20 + i), f"s{i % 4}") for i in range(50)])
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix(docs).collect()}
    got = defaultdict(int)
    for r in mixed.collect():
        assert r["n_chars"] == len(r["text"]) and set(cases.words(r["text"])) <= {f"a{r['doc_id']}", "b", "c"}
        got[r["doc_id"]] += len(cases.words(r["text"]))
    # Both count the same blocks; only the order of equal rows could differ.
    assert got == {i: n for i, n in taken.items() if n}


def test_a_use_keeps_its_shard(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_SLOTS", 8)
    docs = cases.documents(spark, [(i, f"a{i} b c " * 30, f"s{i % 2}") for i in range(20)]).drop("shard")
    with_shard = mixing.mixed_documents(docs, with_shard=True)
    assert with_shard.columns == [*docs.columns, "shard"]
    rows = with_shard.collect()
    assert len({r["shard"] for r in rows}) > 3
    assert Counter(r["text"] for r in rows) == Counter(r["text"] for r in mixing.mixed_documents(docs).collect())
