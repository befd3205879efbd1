import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewire.functions import addresses, routing, text
from tidewire.operators import graph, metrics, reports
from tidewire.sources import reports_json

SAMPLE = {
    "Seq #": 2, "Timestamp": 46, "Node ID": "2", "IPv6 Address": "fd00::202:2:2:2", "RPL Instance ID": 0,
    "DODAG ID": "fd00::201:1:1:1", "DODAG Version": 240, "RPL Rank": 259, "RPL DAG Rank": 2,
    "Preferred Parent": "fe80::201:1:1:1", "Def Route": "fe80::201:1:1:1",
    "neighbors": [
        {"addr": "fe80::201:1:1:1", "lladdr": "0001000100010001", "rpl_rank_raw": 128, "rpl_dag_rank": 1,
         "rpl_link_metric": 131, "is_rpl_parent": True, "is_preferred_parent": True},
        {"addr": "fe80::204:4:4:4", "lladdr": "0004000400040004", "rpl_rank_raw": 256, "rpl_dag_rank": 2,
         "rpl_link_metric": 128, "is_rpl_parent": True, "is_preferred_parent": False},
        {"addr": "fe80::203:3:3:3", "lladdr": "0003000300030003", "rpl_rank_raw": 451, "rpl_dag_rank": 3,
         "rpl_link_metric": 136, "is_rpl_parent": False, "is_preferred_parent": False},
    ],
    "objective_function": "MRHOF", "is_root": False,
}
START = datetime(2024, 1, 1)


def parsed(spark, messages):
    lines = spark.createDataFrame([(i, START + timedelta(seconds=i), m) for i, m in enumerate(messages)],
                                  "offset long, received_at timestamp, value string")
    return reports_json.parse_reports(lines)


def test_sample_message(spark):
    rows = parsed(spark, [json.dumps(SAMPLE)])
    state = reports.decode(reports_json.well_formed(rows).withColumn("network", F.lit("n")))
    row = state.first()
    assert {n.id: n.cost for n in row.neighbors} == {1: 131 / 128, 4: 1.0, 3: 136 / 128}
    assert (row.node_id, row.degree, row.parent_id, row.rank, row.dag_rank, row.is_root) == (2, 3, 1, 259, 2, False)
    snap = reports.add_synthetic_root(state.withColumns({"tick": F.lit(0).cast("long"), "age": F.lit(0).cast("long")}))
    root = snap.filter("node_id = 1").first()
    assert root.is_synthetic and root.objective_function == "MRHOF" and root.ipv6 == "fd00::201:1:1:1"
    assert {(r.node_id, r.depth) for r in graph.depths(snap).collect()} == {(1, 0), (2, 1)}
    figures = metrics.instant(snap, weighted=True).first()
    assert (figures.diameter, figures.avg_path_len, figures.node_count, figures.tree_edge_count) == (1, 1.0, 2, 1)
    assert (figures.undirected_edge_count, figures.neighbor_avg, figures.round_seq) == (3, 3.0, 2)
    # Nodes 3 and 4 do not report, so only the root link is in the mutual graph.
    assert (figures.wireless_diameter, figures.diameter_weighted) == (1, 131 / 128)


def test_broken_messages_are_kept_apart(spark):
    rows = parsed(spark, [json.dumps(SAMPLE), '{"Seq #": 1, "Node', "[]x", json.dumps({"Seq #": 1})])
    assert reports_json.well_formed(rows).count() == 1
    bad = reports_json.quarantined(rows).collect()
    assert len(bad) == 3 and sum(r._corrupt is not None for r in bad) >= 2


def test_message_text_round_trip(spark):
    rows = reports_json.well_formed(parsed(spark, [json.dumps(SAMPLE)]))
    sent = json.loads(rows.select(reports_json.to_report_json(rows)).first()[0])
    assert {k: v for k, v in sent.items() if k != "neighbors"} == {k: v for k, v in SAMPLE.items() if k != "neighbors"}
    assert sent["neighbors"][1]["rpl_link_metric"] == 128


def test_addresses(spark):
    cases = {"fe80::201:1:1:1": 1, "fd00::20A:a:A:a": 10, "fe80::1:0000000000000000f:0000000000000000f:0000000000000000f": 15, "fe80::1:ffffffffffffffff:ffffffffffffffff:ffffffffffffffff": None, "fe80::2ff:FF:FF:FF": 255, "fe80::1:2:3:4": None, "null": None, "": None}
    df = spark.createDataFrame(list(cases.items()), "a string, want long")
    for row in df.withColumn("got", addresses.node_id_from_address(F.col("a"))).collect():
        assert row.got == row.want, row
    lls = {"0001000100010001": "fe80::201:1:1:1", "00FF00ff00ff00ff": "fe80::2ff:ff:ff:ff", "0200020002000200": "fe80::200:200:200", "xyz": None}
    df = spark.createDataFrame(list(lls.items()), "a string, want string")
    for row in df.withColumn("got", addresses.link_local_from_lladdr(F.col("a"))).collect():
        assert row.got == row.want
    dodag = spark.createDataFrame([("fd00::201:1:1:1",), ("fd00::1",), (None,)], "d string")
    assert [r[0] for r in dodag.select(addresses.root_address(F.col("d"))).collect()] == [
        "fd00::201:1:1:1", "fe80::201:1:1:1", "fe80::201:1:1:1"]


def test_ranks_costs_and_names(spark):
    ranks = spark.createDataFrame([(259,), (128,), (256,), (451,), (127,)], "r int")
    assert [r[0] for r in ranks.select(routing.dag_rank(F.col("r"))).collect()] == [2, 1, 2, 3, 0]
    assert [r[0] for r in ranks.select(routing.is_root_rank(F.col("r"))).collect()] == [False, True, False, False, True]
    costs = spark.createDataFrame(
        [(384.0, 1, 1.0), (None, 256, None), (None, None, 64.0), (None, None, None), (0.0, 256, None), (1e-9, None, None)],
        "e double, m int, l double")
    got = [r[0] for r in costs.select(routing.link_cost(F.col("e"), F.col("m"), F.col("l"))).collect()]
    assert got == [3.0, 2.0, 0.5, 1.0, 1.0, 1e-6]
    codes = spark.createDataFrame([(0,), (1,), (7,), (None,)], "c int")
    assert [r[0] for r in codes.select(routing.objective_name(F.col("c"))).collect()] == ["OF0", "MRHOF", "Unknown", "Unknown"]


def test_repeated_neighbor_keeps_the_last_entry(spark):
    message = dict(SAMPLE, neighbors=[
        {"addr": "fe80::203:3:3:3", "rpl_link_metric": 128}, {"addr": "unparsable"},
        {"addr": "fd00::203:3:3:3", "rpl_link_metric": 256}])
    state = reports.decode(reports_json.well_formed(parsed(spark, [json.dumps(message)])).withColumn("network", F.lit("n")))
    assert [(n.id, n.cost) for n in state.first().neighbors] == [(3, 2.0)]
    joined = spark.range(1).select(text.joined_ids(F.array(F.lit(10), F.lit(9))).alias("ids"))
    assert joined.first()["ids"] == "9,10"


def history_model(rows, stale):
    """Row at a time: (session_start, kept parent, next time) per offset."""
    last, out, previous = {}, {}, {}
    for offset, node, t, parent in sorted(rows):
        before = last.get(node)
        start = before is None or t - before[0] > stale
        kept = parent if parent is not None else (None if start else before[1])
        out[offset] = [node, start, kept, None]
        if node in previous:
            out[previous[node]][3] = t
        previous[node] = offset
        last[node] = (t, kept)
    return {k: tuple(v) for k, v in out.items()}


@pytest.fixture(scope="module")
def timeline():
    rng = random.Random(5)
    t, rows = 0, []
    for offset in range(600):
        t += rng.choice([0, 1, 5, 20]) * 1_000_000
        node = 1 if rng.random() < 0.4 else rng.randint(2, 9)
        rows.append((offset, node, t, rng.choice([None, None, rng.randint(1, 9)])))
    return rows


def timeline_df(spark, rows):
    df = spark.createDataFrame(rows, "offset long, node_id long, t long, parent_id long")
    return df.withColumns({"network": F.lit("n"), "degree": (F.col("offset") % 4).cast("int"), "is_root": F.lit(False)})


@pytest.mark.parametrize("limit", [1, 16, 100_000])
def test_history_matches_model(spark, timeline, limit):
    got = reports.with_history(timeline_df(spark, timeline), stale=60, limit=limit).collect()
    want = history_model(timeline, 60_000_000)
    assert {r.offset: (r.node_id, r.session_start, r.parent_id, r.next_t) for r in got} == want


def visible_model(rows, tick, stale):
    newest = {}
    for offset, node, t, _ in sorted(rows):
        if t <= tick:
            newest[node] = (t, offset)
    return {(node, offset) for node, (t, offset) in newest.items() if tick - t <= stale}


@pytest.mark.parametrize(("span", "limit"), [(256, 1 << 21), (3, 20), (1, 1 << 21)])
def test_state_at_intervals_and_instants(spark, timeline, span, limit):
    history = reports.with_history(timeline_df(spark, timeline), stale=60)
    end = max(r[2] for r in timeline) + 61_000_000
    got = {(r.tick, r.node_id, r.offset) for r in reports.state_at_intervals(history, every=30, stale=60).collect()}
    want = {(tick // 1_000_000, *seen) for tick in range(0, end, 30_000_000) for seen in visible_model(timeline, tick, 60_000_000)}
    assert got == want
    # Given out of order and twice, beside one that nothing is visible at.
    instants = sorted({r[2] for r in timeline} | {-1, end + 10**9})
    ticks = spark.createDataFrame([("n", t) for t in [*reversed(instants), *instants, None]], "network string, tick_t long")
    got = {(r.tick_t, r.node_id, r.offset) for r in reports.state_at_ticks(history, ticks, stale=60, span=span, limit=limit).collect()}
    assert got == {(t, *seen) for t in instants for seen in visible_model(timeline, t, 60_000_000)}


def test_visibility_ends_exactly_at_stale(spark):
    rows = [(0, 2, 0, None), (1, 3, 60_000_000, None), (2, 4, 60_001_000, None)]
    history = reports.with_history(timeline_df(spark, rows), stale=60)
    ticks = spark.createDataFrame([("n", 60_000_000), ("n", 60_001_000)], "network string, tick_t long")
    got = {(r.tick_t, r.node_id) for r in reports.state_at_ticks(history, ticks, stale=60).collect()}
    assert got == {(60_000_000, 2), (60_000_000, 3), (60_001_000, 3), (60_001_000, 4)}


def test_instants_of_one_network_are_dealt_into_ranges(spark):
    # 40 nodes that report once and stay visible: 6,000 instants see all of them.
    rows = [(n, n + 2, n, None) for n in range(40)]
    history = reports.with_history(timeline_df(spark, rows), stale=60)
    ticks = spark.range(6000).selectExpr("'n' as network", "1000 + id * 1000 as tick_t")
    seen = reports.state_at_ticks(history, ticks, stale=60, span=100)
    assert (seen.count(), seen.select("tick_t").distinct().count()) == (240_000, 6000)
    assert seen.schema.names == [c for c in history.columns if c != "next_t"] + ["tick_t", "age"]
    with pytest.raises(ValueError, match="at least 1"):
        reports.state_at_ticks(history, ticks, stale=60, span=0)


@pytest.mark.parametrize("limit", [20, 1 << 21])
def test_degree_at_messages(spark, timeline, limit):
    got = {r.offset: r for r in metrics.degree_at_messages(timeline_df(spark, timeline), stale=60, limit=limit).collect()}
    seen = {}
    total = count = 0
    for offset, node, t, _ in sorted(timeline):
        if node != 1:
            seen[node] = (t, offset % 4)
        live = [d for s, d in seen.values() if t - s <= 60_000_000]
        mean = sum(live) / len(live) if live else 0.0
        total, count = total + mean, count + 1
        assert got[offset].visible == len(live)
        assert got[offset].neighbor_avg == pytest.approx(mean)
        assert got[offset].neighbor_avg_over_time == pytest.approx(total / count)
    assert len(got) == count


def test_reset_starts_empty(spark):
    rows = [(0, 2, 0, 7), (1, 0, 1, None), (2, 2, 2, None), (3, 2, 3, 8), (4, 2, 4, None)]
    cleared = reports.resets_as_epochs(timeline_df(spark, rows), reset=F.col("node_id") == 0, limit=2)
    history = reports.with_history(cleared, stale=60, keys=["network", "epoch", "node_id"], limit=2)
    assert {(r.offset, r.epoch, r.parent_id) for r in history.collect()} == {(0, 0, 7), (2, 1, None), (3, 1, 8), (4, 1, 8)}


def test_latest_passes_few_rows_on(spark, timeline):
    newest = reports.latest(timeline_df(spark, timeline))
    want = {}
    for offset, node, *_ in timeline:
        want[node] = max(offset, want.get(node, -1))
    assert {r.node_id: r.offset for r in newest.collect()} == want
    assert "WindowGroupLimit" in newest._jdf.queryExecution().executedPlan().toString()


def test_neighbor_table_merge(spark):
    routed = spark.createDataFrame(
        [
            (1, "fe80::1", 10, 128, 130, True, False, False),   # recent
            (1, "fe80::2", 61, 256, 130, True, False, False),   # old: out, and the cache entry with it
            (1, "fe80::3", None, 256, 130, True, True, False),  # preferred
            (1, "fe80::4", 99, 256, 130, False, False, True),   # default route
            (1, "fd00::5", 5, 256, 130, False, False, False),   # no proof of a single hop
            (1, "fd00::6", 5, 256, 130, False, False, False),   # proven by the cache
        ],
        "r long, addr string, age long, rank int, link_metric int, is_parent boolean, is_preferred boolean, is_default_route boolean",
    )
    cache = spark.createDataFrame(
        [(1, "fe80::2", 1, "aa"), (1, "fd00::6", 90, "bb"), (1, "fe80::7", 60, "cc"), (1, "fe80::8", 61, "dd"), (2, "fe80::1", 3, "ee")],
        "r long, addr string, age long, lladdr string",
    )
    got = reports.merge_neighbor_tables(routed, cache, keys=["r"]).collect()
    assert {(x.r, x.addr, x.lladdr, x["rank"], x.is_preferred) for x in got} == {
        (1, "fe80::1", None, 128, False), (1, "fe80::3", None, 256, True), (1, "fe80::4", None, 256, False),
        (1, "fd00::6", "bb", 256, False), (1, "fe80::7", "cc", None, False), (2, "fe80::1", "ee", None, False),
    }
