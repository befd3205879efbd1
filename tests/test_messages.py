"""Metrics at every message against a model that keeps the network node by node."""

import random

import pytest
from pyspark.sql import functions as F

from tidewire import storage
from tidewire.operators import forest, messages, reports

STALE = 60_000_000
SCHEMA = "network string, offset long, node_id long, t long, parent_id long, is_root boolean, seq long, objective_function string, dodag_id string, neighbors array<struct<id:bigint,cost:double>>"


@pytest.fixture(scope="module")
def sent():
    """Reports of two networks: one that changes all the time (with loops, moving roots, its router silent at times), one that hardly does."""
    rng = random.Random(11)
    t, rows = 0, []
    for offset in range(260):
        t += rng.choice([0, 1, 4, 15]) * 1_000_000
        lively = offset % 3 > 0
        node = rng.choice([1, 2, 3, 4, 5, 6, 7, 8, 9] if lively else [2, 3, 4])
        parent = rng.choice([None, *range(1, 10)]) if lively else node - 1
        flag = lively and rng.random() < 0.1
        heard = [(n, 1.0) for n in rng.sample(range(1, 10), rng.randint(0, 4))] if lively else [(node - 1, 1.0)]
        seq = None if rng.random() < 0.3 else offset
        rows.append(("lively" if lively else "calm", offset, node, t, parent, flag, seq, f"OF{node % 2}", f"fd00::{node}", heard))
    return rows


def frame(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("degree", F.size("neighbors"))
    return reports.with_history(df, stale=STALE // 1_000_000)


def stats(values):
    return (sum(values) / len(values), min(values), max(values)) if values else (0.0, None, None)


def paths(adjacent):
    """Longest and mean distance of all connected ordered pairs."""
    found = []
    for start in adjacent:
        seen, waiting = {start: 0}, [start]
        for node in waiting:
            for other in adjacent[node]:
                if other not in seen:
                    seen[other] = seen[node] + 1
                    waiting.append(other)
        found += [d for n, d in seen.items() if n != start]
    return (max(found), sum(found) / len(found)) if found else (0, 0.0)


def model(rows, kept):
    nodes, seqs, out = {}, {}, {}
    for network, offset, node, t, _, flag, seq, of, dag, heard in rows:
        here = nodes.setdefault(network, {})
        here[node] = (t, kept[offset], flag, {n for n, _ in heard})
        here = nodes[network] = {n: s for n, s in here.items() if t - s[0] <= STALE}
        seqs[network] = seqs.get(network) if seq is None else seq
        router = here.get(1, (t, None, True, set()))
        seen = {**here, 1: (*router[:2], True, router[3])}
        parents = {n: s[1] for n, s in seen.items() if s[1] is not None and s[1] != n}
        root = max(n for n, s in seen.items() if s[2])
        depths = []
        for n in seen:
            steps, at = 0, n
            while at != root and at in parents and steps <= len(seen):
                at, steps = parents[at], steps + 1
            if at == root and n != root:
                depths.append(steps)
        adjacent = {}
        for child, parent in parents.items():
            adjacent.setdefault(child, set()).add(parent)
            adjacent.setdefault(parent, set()).add(child)
        links = {frozenset((n, o)) for n, s in seen.items() for o in s[3] if o != n}
        degrees = stats([len(s[3]) for n, s in seen.items() if n != 1])
        out[network, offset] = (
            dag, of, root, len(seen), len(links), len(parents), *stats(depths), *paths(adjacent), *degrees, seqs[network]
        )
    return out


FIELDS = (
    "dag_id", "objective_function", "root_id", "node_count", "undirected_edge_count", "tree_edge_count", "depth_avg", "depth_min", "depth_max",
    "diameter", "avg_path_len", "neighbor_avg", "neighbor_min", "neighbor_max", "round_seq",
)


@pytest.mark.parametrize("limit", [40, 1 << 21])
def test_rows_match_the_model(spark, sent, limit):
    history = frame(spark, sent)
    kept = {r.offset: r.parent_id for r in history.collect()}
    got = messages.metrics_at_messages(history, stale=STALE // 1_000_000, limit=limit).collect()
    want = model(sent, kept)
    assert len(got) == len(want)
    for row in got:
        assert tuple(row[f] for f in FIELDS) == pytest.approx(want[row.network, row.offset]), row
    for network in ("lively", "calm"):
        total = 0.0
        for n, row in enumerate(sorted((r for r in got if r.network == network), key=lambda r: r.offset), 1):
            total += row.diameter
            assert (row.position, row.samples, row.diameter_avg) == (n, n, pytest.approx(total / n))


def test_calm_messages_share_a_tree(spark, sent):
    calm = frame(spark, [r for r in sent if r[0] == "calm"])
    versions = messages.positions(calm, stale=10**9)
    numbered, nodes = messages.tree_versions(versions, versions.select("network", "position"))
    assert numbered.agg(F.max("version")).first()[0] == 3 and nodes.count() == 6


def test_empty_table(spark):
    assert messages.metrics_at_messages(frame(spark, []), stale=60).count() == 0


def test_ranges_make_up_the_interval(spark, monkeypatch):
    monkeypatch.setattr(messages, "LARGEST", 4)
    rng = random.Random(2)
    given = [(a, a + rng.randint(0, 90)) for a in [rng.randint(1, 100) for _ in range(300)]]
    df = spark.createDataFrame(given, "a long, b long").select("a", "b", messages.ranges(F.col("a"), F.col("b")).alias("r"))
    for row in df.collect():
        held = [p for level, number in row.r for p in range(number << level, number + 1 << level)]
        assert sorted(held) == list(range(row.a, row.b))


@pytest.mark.parametrize(("block", "repeats"), [(7, 0), (256, 0), (11, 25)])
def test_versions_followed_and_worked_out_one_by_one_agree(spark, sent, block, repeats, monkeypatch):
    """Loops that open and close, roots on and off a loop, networks that come and go, blocks that begin in between."""
    monkeypatch.setattr(forest, "BLOCK", block)
    rng = random.Random(3)
    rows = [(*r[:2], rng.randint(1, 9), *r[3:]) for r in sent]
    # Messages that came twice.
    rows += rng.sample(rows, repeats)
    spans = messages.version_spans(versions := messages.positions(frame(spark, rows), stale=STALE // 1_000_000), versions.select("network", "position"))[1]
    names = ("network", "version", "root_id", "depth_avg", "depth_min", "depth_max", "diameter", "avg_path_len")

    def found(**options):
        return {(r.network, r.version): tuple(r) for r in messages.tree_shapes(spans, **options).select(*names).fillna(0).collect()}

    followed, one_by_one = found(), found(tree_nodes=0)
    assert followed.keys() == one_by_one.keys() and len(followed) > 150
    for key, row in followed.items():
        assert row == pytest.approx(one_by_one[key]), key


def test_no_row_per_version_and_node(spark, monkeypatch):
    """A changing chain of 2,000 nodes: what blocks hold grows with reports, not with versions times nodes."""
    monkeypatch.setattr(messages, "_each_version", None)
    rows = [("n", i, 2 + i % 2000, i * 1000, 1 + i % 2000, False, i, "OF0", None, []) for i in range(2000)]
    rows += [("n", 2000 + i, 2001, 2_000_000 + i * 1000, 1 + (i * 37) % 1999, False, i, "OF0", None, []) for i in range(1000)]
    got = {r.offset: r for r in messages.metrics_at_messages(frame(spark, rows), stale=10**6).collect()}
    assert len(got) == 3000
    for i in range(1999, 2000):
        assert (got[i].diameter, got[i].depth_max, got[i].depth_avg) == (2000, 2000, 1000.5)
    for i in (0, 500, 999):
        parent = 1 + (i * 37) % 1999
        assert got[2000 + i].depth_avg == pytest.approx((1999 * 1000 + parent) / 2000)


@pytest.fixture
def broadcasts_all(spark):
    """Spark takes every table for small, as it takes one whose files are well compressed."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1g")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_nothing_with_a_row_per_message_is_broadcast(spark, sent, broadcasts_all, monkeypatch, capsys):
    """Joins of intervals, positions and versions are shuffled whatever size Spark takes them for."""
    plans = {}

    def staged(df, label):
        df.explain()
        plans[label] = capsys.readouterr().out
        return storage.stage(df, label)

    monkeypatch.setattr(messages, "stage", staged)
    rows = messages.metrics_at_messages(frame(spark, sent), stale=STALE // 1_000_000)
    rows.explain()
    plans["result"] = capsys.readouterr().out
    assert rows.count() == len(sent)
    joins = {label: plan.count("SortMergeJoin") for label, plan in plans.items()}
    assert joins["message-totals"] == 2 and joins["tree-spans"] == 2 and joins["message-metrics"] == 5, joins
    # Networks of too many nodes, the only other side of a join, are a row each.
    for label in plans.keys() - {"tree-shapes"}:
        assert "Broadcast" not in plans[label], label


def test_block_sizes_of_many_networks_are_not_broadcast(spark, sent, broadcasts_all, monkeypatch, capsys):
    versions = messages.positions(frame(spark, sent), stale=STALE // 1_000_000)
    spans = storage.stage(messages.version_spans(versions, versions.select("network", "position"))[1], "spans")

    def found():
        out = forest.shapes(spans)
        out.explain()
        return "Broadcast" in capsys.readouterr().out, {(r.network, r.version): tuple(r) for r in out.collect()}

    few = found()
    monkeypatch.setattr(forest, "NETWORKS", 1)
    many = found()
    assert few[0] and not many[0]
    assert few[1] == many[1] and len(few[1]) > 100


def test_means_of_messages_that_came_twice_follow_one_order(spark, sent):
    """However the rows of the joins are dealt, those of a position keep their order."""
    rows = sent[:90]
    history = frame(spark, rows + random.Random(5).sample(rows, 20))

    def found(**options):
        got = messages.metrics_at_messages(history, stale=STALE // 1_000_000, **options).collect()
        return sorted(repr([round(v, 9) if isinstance(v, float) else v for v in r]) for r in got)

    whole = found()
    assert len(whole) > 110
    for partitions in ("1", "13"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            assert found(limit=25) == whole
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
