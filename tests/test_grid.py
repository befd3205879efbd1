import random

import pytest
from pyspark.sql import functions as F

from tidewire.operators import grid
from tidewire.sources import grid_csv, topics


@pytest.fixture(scope="module")
def cells():
    rng = random.Random(3)
    out = [(x, y, s, 10.0 * x + y + 0.5 * s) for x in range(3) for y in range(3) for s in range(5)]
    out += [(9, 9, 0, 1.0)]
    out += [(5, 5, s, round(rng.uniform(0, 100), 2)) for s in range(130)]
    return out


@pytest.fixture(scope="module")
def df(spark, cells):
    return (
        spark.createDataFrame(cells, "x int, y int, time_step int, temperature double")
        .withColumn("timestamp", F.timestamp_seconds("time_step"))
        .cache()
    )


def series(cells):
    out = {}
    for x, y, s, t in sorted(cells, key=lambda c: c[2]):
        out.setdefault((x, y), []).append((s, t))
    return out


@pytest.mark.parametrize("limit", [4, 1000])
def test_difference_stats(df, cells, limit):
    got = {(r.x, r.y): r for r in grid.difference_stats(df, limit=limit).collect()}
    assert (9, 9) not in got
    for cell, values in series(cells).items():
        if len(values) < 2:
            continue
        diffs = [b[1] - a[1] for a, b in zip(values, values[1:])]
        row = got.pop(cell)
        assert row.min_temp_diff == pytest.approx(min(diffs))
        assert row.max_temp_diff == pytest.approx(max(diffs))
        # The mean change telescopes.
        assert row.avg_temp_diff == pytest.approx((values[-1][1] - values[0][1]) / (len(values) - 1))
    assert not got


@pytest.mark.parametrize("size,slide", [(100, 10), (30, 20), (5, 5), (4, 10)])
def test_sliding_windows(df, cells, size, slide):
    got = {
        (r.x, r.y, r.window_start_step, r.window_end_step): r.temp_diff
        for r in grid.sliding_window_differences(df, size=f"{size} seconds", slide=f"{slide} seconds").collect()
    }
    rows = grid.sliding_window_differences(df, size=f"{size} seconds", slide=f"{slide} seconds").count()
    want, count = {}, 0
    for (x, y), values in series(cells).items():
        for start in range(-size // slide * slide - slide, 200, slide):
            held = [v for v in values if start <= v[0] < start + size]
            if held:
                count += 1
                want[(x, y, held[0][0], held[-1][0])] = held[-1][1] - held[0][1]
    assert rows == count
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k]) for k in want)


def test_max_window_difference(df):
    windows = grid.sliding_window_differences(df)
    got = {(r.x, r.y): r.max_temperature_diff for r in grid.max_window_difference(windows).collect()}
    assert got[(0, 0)] == pytest.approx(2.0) and got[(9, 9)] == 0.0


def test_step_changes(df, cells):
    changes = grid.step_changes(df, limit=6)
    got = {r.time_step: r.max_change for r in changes.collect()}
    want = {}
    for values in series(cells).values():
        for a, b in zip(values, values[1:]):
            want[a[0]] = max(want.get(a[0], 0.0), abs(b[1] - a[1]))
    assert got == pytest.approx(want)
    limit = sorted(want.values())[3]
    assert grid.first_step_below(changes, limit).first()[0] == min(s for s, c in want.items() if c < limit)
    assert grid.first_step_below(changes, -1.0).first()[0] is None


@pytest.mark.parametrize("tile", [1, 2, 64])
def test_stencil_residuals(df, cells, tile):
    values = {(x, y, s): t for x, y, s, t in cells}
    got = {(r.x, r.y, r.time_step): r for r in grid.stencil_residuals(df, k=0.2, tile=tile).collect()}
    want = {}
    for (x, y, s), t in values.items():
        if (x, y, s + 1) in values:
            around = sum(values.get((x + dx, y + dy, s), 0.0) for dx, dy in ((1, 0), (-1, 0), (0, 1), (0, -1)))
            want[(x, y, s)] = t + 0.2 * (around - 4 * t)
    assert got.keys() == want.keys()
    for key, expected in want.items():
        assert got[key].expected == pytest.approx(expected)
        observed = values[(key[0], key[1], key[2] + 1)]
        assert got[key].residual == pytest.approx(observed - expected)


def test_snapshot_files(spark, tmp_path):
    (tmp_path / "heat_diffusion0.csv").write_text("x,y,temperature\n0,0,100.0\n0,1,0.00001\n")
    (tmp_path / "heat_diffusion12.csv").write_text("x,y,temperature\n0,0,99.5\n0,1,broken\n")
    (tmp_path / "other.csv").write_text("x,y,temperature\n7,7,7\n")
    got = grid_csv.read_snapshots(spark, str(tmp_path)).collect()
    assert {(r.x, r.y, r.time_step, r.temperature) for r in got} == {(0, 0, 0, 100.0), (0, 1, 0, 0.00001), (0, 0, 12, 99.5)}
    assert {r.timestamp.second for r in got} == {0, 12}
    kept = grid_csv.read_snapshots(spark, str(tmp_path), keep_corrupt=True).collect()
    assert [r._corrupt for r in kept if r._corrupt] == ["0,1,broken"]


def test_csv_sink_and_step_layout(spark, df, tmp_path):
    topics.write_csv(df.select("x", "y", "temperature"), str(tmp_path / "out"), rows_per_file=20)
    topics.write_csv(df.select("x", "y", "temperature"), str(tmp_path / "out"), rows_per_file=20)
    files = list((tmp_path / "out").glob("*.csv"))
    assert len(files) >= 9 and all(len(f.read_text().splitlines()) <= 21 for f in files)
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).count() == df.count()
    grid_csv.ingest(df, str(tmp_path / "steps"))
    plan = spark.read.parquet(str(tmp_path / "steps")).filter("time_step = 3")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(time_step" in plan


def test_rows_travel_once_for_difference_stats(df):
    def plan(**options):
        return grid.difference_stats(df, **options)._jdf.queryExecution().executedPlan().toString()

    assert plan().count("Exchange hashpartitioning") == 1 and "Join" not in plan()
    # With a long cell the second exchange carries one row per chunk; only the small cut list is joined.
    cut = plan(limit=100)
    assert cut.count("Exchange hashpartitioning") == 2 and cut.count("Join") == 1 and "BroadcastHashJoin" in cut
