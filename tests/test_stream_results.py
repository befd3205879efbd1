"""Resets on a stream of reports, result tables that change together, and the reader of an output topic."""

import random

import pytest
from pyspark.sql import functions as F

from tidewire import storage
from tidewire.operators import metrics, reports
from tidewire.streaming import output_reader, runs
from tidewire.streaming.network_state import TriggerStates
from tidewire.streaming.result_tables import ResultTables, TriggerTables

SECOND = 1_000_000
SCHEMA = "network string, offset long, t long, node_id long, parent_id long, seq long, is_root boolean, objective_function string, rank int, dag_rank int, degree int, neighbors array<struct<id:bigint,cost:double>>"


def report(offset, node, parent=None, network="n", seconds=None):
    at = offset if seconds is None else seconds
    return (network, offset, at * SECOND, node, parent, offset, node == 1, "OF0", 1, 1, 0, [])


def reset_row(offset, network="n"):
    return (network, offset, offset * SECOND, -1, None, None, False, None, None, None, 0, [])


ROWS = [
    report(1, 2, 1), report(2, 3, 2), reset_row(3), report(4, 2), report(5, 3, 2), report(6, 2, 1), reset_row(7), reset_row(8),
    report(9, 3), report(10, 5, 3, "m"), reset_row(11), report(12, 5, None, "m"), report(13, 3, 1), reset_row(14, "m"), report(15, 2),
]


@pytest.mark.parametrize("cuts", [[], [3], [2, 3, 7, 8, 11], list(range(1, 15))])
def test_resets_over_any_deliveries(spark, tmp_path, cuts):
    """Also where a reset is the last or the only row of a delivery, and where a trigger is repeated."""
    handler = TriggerStates(str(tmp_path / "s"), every=1, stale=100, reset=F.col("node_id") == -1)
    edges = [0, *cuts, len(ROWS)]
    for number, (a, b) in enumerate(zip(edges, edges[1:])):
        for _ in range(2 if number == 1 else 1):
            handler(spark.createDataFrame(ROWS[a:b], SCHEMA), number)
    table = spark.createDataFrame(ROWS, SCHEMA)
    cleared = reports.resets_as_epochs(table, reset=F.col("node_id") == -1)
    whole = reports.with_history(cleared, stale=100, keys=["network", "epoch", "node_id"])
    fields = ["network", "offset", "node_id", "epoch", "parent_id", "session_start"]
    got = sorted(map(tuple, handler.history_result(spark).select(*fields).collect()))
    assert got == sorted(map(tuple, whole.select(*fields).collect()))

    # A row of an earlier epoch is seen until the reset and no longer.
    ends = {("n", e): o for e, o in enumerate([3, 7, 8, 11])} | {("m", 0): 14}
    seen = {(r.network, r.tick, r.node_id): r.offset for r in handler.result(spark).filter("tick <= 16").collect()}
    epoch = {("n", o): e for o, e in ((1, 0), (2, 0), (4, 1), (5, 1), (6, 1), (9, 3), (13, 4), (15, 4))} | {("m", 10): 0, ("m", 12): 0}
    wanted = {}
    for network, offset, _, node, *_ in [r for r in ROWS if r[3] != -1]:
        for tick in range(offset, 17):
            if tick < ends.get((network, epoch[network, offset]), 99):
                wanted[network, tick, node] = offset
    assert seen == wanted


def test_a_writer_that_stops_between_two_tables(spark, tmp_path):
    tables = ResultTables(str(tmp_path / "tables"))
    with pytest.raises(ValueError, match="nothing"):
        tables.read(spark, "a")
    number = lambda n: spark.range(1).select(F.lit(n).alias("n"))
    tables.publish(spark, {"a": number(1), "b": number(1)}, 0)
    broken = spark.range(1).select(F.raise_error(F.lit("lost")).alias("n"))
    with pytest.raises(Exception, match="lost"):
        tables.publish(spark, {"a": number(2), "b": broken}, 1)
    assert [t.first()["n"] for t in tables.read(spark, "a", "b")] == [1, 1]
    reader = tables.read(spark, "a", "b")
    tables.publish(spark, {"a": number(3), "b": number(3)}, 1)
    assert [t.first()["n"] for t in tables.read(spark, "a", "b")] == [3, 3]
    assert [t.first()["n"] for t in reader] == [1, 1]
    tables.publish(spark, {"a": number(4), "b": number(4)}, 2)
    assert tables.versions(spark) == [1, 2]


def test_tables_follow_each_trigger(spark, tmp_path):
    states = TriggerStates(str(tmp_path / "s"), every=10, stale=25, with_metrics=True)
    tables = ResultTables(str(tmp_path / "t"))
    handler = TriggerTables(states, tables)
    handler(spark.createDataFrame([report(1, 2, 1), report(2, 3, 2)], SCHEMA), 0)
    topology, nodes, general = tables.read(spark, "topology", "nodes", "general")
    assert {(r.tick, r.Node, r.Parent) for r in topology.collect()} == {(20, 2, "1"), (20, 3, "2")}
    handler(spark.createDataFrame([report(31, 4, 1)], SCHEMA), 1)
    topology, nodes, general = tables.read(spark, "topology", "nodes", "general")
    assert {(r.tick, r.Node, r.Parent) for r in topology.collect()} == {(50, 4, "1")}
    assert {r.Node for r in nodes.collect()} == {4} and general.first().tick == 50
    with pytest.raises(ValueError):
        TriggerTables(TriggerStates(str(tmp_path / "x"), every=1, stale=1), tables)


def test_output_is_read_once(spark, tmp_path):
    """Repeats in the same delivery, in the next one and over a restart; a repeat beyond the delay is given out as new."""
    runs.use_durable_state(spark)
    folder = str(tmp_path / "topic")

    def deliver(number, rows):
        data = [("output", "k", f"v{i}", i, hour) for i, hour in rows]
        table = spark.createDataFrame(data, "topic string, key string, value string, id string, hour long")
        written = table.select("topic", "key", "value", "id", F.timestamp_seconds(F.col("hour") * 3600).alias("timestamp"))
        written.write.parquet(f"{folder}/delivery={number}")
        seen = output_reader.once(output_reader.stream_messages(spark, f"{folder}/delivery=*"), within="2 hours")
        runs.run_available(runs.file_writer(seen, str(tmp_path / "rows"), str(tmp_path / "checkpoint")))

    deliver(0, [("a", 0), ("a", 0), ("b", 0)])
    deliver(1, [("a", 1), ("c", 1)])
    deliver(2, [("c", 2), ("b", 2), ("d", 2)])
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "rows")).collect()) == ["a", "b", "c", "d"]
    deliver(3, [("e", 9)])
    deliver(4, [("a", 10), ("e", 10)])
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "rows")).collect()) == ["a", "a", "b", "c", "d", "e"]
    storage.clear(spark)


STATE = ["network", "tick", "node_id", "offset", "parent_id", "degree", "age"]
NODE_FIELDS = "network string, offset long, t long, node_id long, parent_id long, degree int"


def batch_states(table, every, stale):
    return reports.state_at_intervals(reports.with_history(table, stale=stale), every=every, stale=stale)


def rows_of(df, names):
    return sorted(map(str, df.select(*names).collect()))


@pytest.mark.parametrize("falling", [False, True])
def test_late_reports_equal_the_batch(spark, tmp_path, falling):
    """Reports in any order over many triggers and time ranges; also where times fall along a node's order."""
    pick = random.Random(11)
    rows = []
    for i in range(150):
        t = pick.randint(0, 900) if falling else i * 6 + pick.randint(0, 5)
        rows.append(("n" if i % 3 else "m", i, t * SECOND, pick.randint(2, 4), pick.choice([None, None, 1, 2, 3]), i % 5))
    moved = sorted(rows, key=lambda r: r[1] + (pick.randint(0, 120) if pick.random() < 0.2 else 0))
    handler = TriggerStates(str(tmp_path / "s"), every=10, stale=40, span=50)
    for number in range(5):
        handler(spark.createDataFrame(moved[number * 30 : number * 30 + 30], NODE_FIELDS), number)
    handler(spark.createDataFrame(moved[120:], NODE_FIELDS), 4)
    table = spark.createDataFrame(rows, NODE_FIELDS)
    whole = reports.with_history(table, stale=40)
    fields = ["network", "offset", "node_id", "parent_id", "session_start"]
    # Read by a handler that has seen no trigger, as after a restart of the driver.
    restarted = TriggerStates(str(tmp_path / "s"), every=10, stale=40, span=50)
    assert rows_of(restarted.history_result(spark), fields) == rows_of(whole, fields)
    if not falling:
        assert rows_of(restarted.result(spark), STATE) == rows_of(batch_states(table, 10, 40), STATE)
        late = restarted.result(spark, since=500)
        assert rows_of(late, STATE) == rows_of(batch_states(table, 10, 40).filter("tick >= 500"), STATE)


def rows_read(spark, work):
    """Rows that the stages of ``work`` read from files."""
    store, jvm = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._jvm

    def stages():
        none = spark.sparkContext._gateway.new_array(jvm.double, 0)
        found = store.stageList(None, False, False, none, jvm.java.util.ArrayList())
        return {found.apply(i).stageId(): found.apply(i).inputRecords() for i in range(found.size())}

    before = set(stages())
    work()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    return sum(n for stage, n in stages().items() if stage not in before)


def test_a_late_report_reads_no_more_after_twenty_triggers(spark, tmp_path):
    handler = TriggerStates(str(tmp_path / "s"), every=10, stale=40)
    read = []
    for trigger in range(20):
        # 60 reports of 200 seconds; one of them comes a trigger late.
        offsets = [trigger * 60 + i for i in range(60) if i != 59] + ([trigger * 60 - 1] if trigger else [])
        rows = [report(o, 2 + o % 6, 1, seconds=o * 10 // 3) for o in offsets]
        batch = spark.createDataFrame(rows, SCHEMA)
        handler.with_metrics = trigger in (4, 19)
        read.append(rows_read(spark, lambda: handler(batch, trigger)))
    assert read[19] < 1.2 * read[4]
    assert max(read[14:19]) < 1.2 * max(read[2:4])
    table = spark.createDataFrame([report(o, 2 + o % 6, 1, seconds=o * 10 // 3) for o in range(1200) if o != 1199], SCHEMA)
    assert rows_of(handler.result(spark), STATE) == rows_of(batch_states(table, 10, 40), STATE)
    # As a new driver sees them: the last trigger's 200 seconds, and what its carried rows reach back.
    found = TriggerStates(handler.folder, every=10, stale=40).metrics_result(spark).filter("tick between 3800 and 3990")
    want = metrics.instant(reports.add_synthetic_root(batch_states(table, 10, 40).filter("tick between 3800 and 3990")))
    assert rows_of(found, ["tick", "node_count", "diameter"]) == rows_of(want, ["tick", "node_count", "diameter"])
