"""Statistics over gridded time series: one value per cell and step."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import ordered

CELL = ("x", "y")


def consecutive_differences(
    grid: DataFrame, *, keys: Sequence[str] = CELL, order: str = "time_step", value: str = "temperature",
    limit: int = ordered.ROW_LIMIT,
) -> DataFrame:
    """Rows with the previous step's value and the change; a cell's first step is dropped."""
    shifted = ordered.adjacent_rows(
        grid, keys=keys, order=order, previous={value: "prev_value", order: "prev_step"}, limit=limit
    )
    return shifted.filter(F.col("prev_value").isNotNull()).withColumn("diff", F.col(value) - F.col("prev_value"))


def difference_stats(
    grid: DataFrame, *, keys: Sequence[str] = CELL, order: str = "time_step", value: str = "temperature",
    limit: int = ordered.ROW_LIMIT,
) -> DataFrame:
    """Minimum, maximum and mean consecutive change per cell.

    Chunks (whole cells, unless a cell is too long for one task) are reduced where their
    rows already are; the changes across chunk borders come from the chunk summaries, so
    rows are shuffled once and never joined back.
    """
    local = F.col(value) - F.lag(value).over(ordered.chunk_window(keys, order))
    chunks = (
        ordered.chunked(grid, keys, order, limit)
        .rows.withColumn("__diff", local)
        .groupBy(*keys, ordered.CHUNK)
        .agg(
            F.min("__diff").alias("__min"),
            F.max("__diff").alias("__max"),
            F.sum("__diff").alias("__sum"),
            F.count("__diff").alias("__n"),
            F.min_by(value, order).alias("__first"),
            F.max_by(value, order).alias("__last"),
        )
    )
    border = F.col("__first") - F.lag("__last").over(ordered.key_window(keys))
    total = F.sum(F.coalesce("__sum", F.lit(0.0)) + F.coalesce("__border", F.lit(0.0)))
    changes = F.sum(F.col("__n") + F.col("__border").isNotNull().cast("int"))
    return (
        chunks.withColumn("__border", border)
        .groupBy(*keys)
        .agg(
            F.min(F.least("__min", "__border")).alias("min_temp_diff"),
            F.max(F.greatest("__max", "__border")).alias("max_temp_diff"),
            total.alias("__total"),
            changes.alias("__changes"),
        )
        .filter(F.col("__changes") > 0)
        .select(*keys, "min_temp_diff", "max_temp_diff", (F.col("__total") / F.col("__changes")).alias("avg_temp_diff"))
    )


def _seconds(text: str) -> int:
    units = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}
    number, unit = text.split()
    return int(number) * units[unit.rstrip("s")]


def panes(
    grid: DataFrame,
    *,
    keys: Sequence[str] = CELL,
    order: str = "time_step",
    value: str = "temperature",
    time: str = "timestamp",
    size: str = "100 seconds",
    slide: str = "10 seconds",
) -> DataFrame:
    """Rows folded into panes as long as the common divisor of size and slide.

    Panes of parts of the rows can be put together: ``windows_of_panes`` takes any number of rows per pane.
    """
    second = F.floor(ordered.micros(time) / F.lit(1_000_000))
    return (
        grid.groupBy(*keys, F.floor(second / F.lit(math.gcd(_seconds(size), _seconds(slide)))).alias("pane"))
        .agg(
            F.min_by(value, order).alias("first_value"),
            F.max_by(value, order).alias("last_value"),
            F.min(time).alias("first_time"),
            F.max(time).alias("last_time"),
            F.min(order).alias("first_step"),
            F.max(order).alias("last_step"),
        )
    )


def sliding_window_differences(
    grid: DataFrame,
    *,
    keys: Sequence[str] = CELL,
    order: str = "time_step",
    value: str = "temperature",
    time: str = "timestamp",
    size: str = "100 seconds",
    slide: str = "10 seconds",
) -> DataFrame:
    """Change between the first and last value of every epoch-aligned sliding window.

    Rows are first folded into panes, so the copies a row makes (one per window it belongs to)
    are made from panes, not rows.  Both groupings combine before their shuffle, so no pane or
    window of a hot cell arrives whole in one task.  Partial windows at both ends of the series are
    kept, and window_start / window_end are the extremes of the data inside the window.
    """
    folded = panes(grid, keys=keys, order=order, value=value, time=time, size=size, slide=slide)
    return windows_of_panes(folded, keys=keys, size=size, slide=slide)


def windows_of_panes(
    folded: DataFrame, *, keys: Sequence[str] = CELL, size: str = "100 seconds", slide: str = "10 seconds"
) -> DataFrame:
    """The sliding windows made of panes."""
    size_s, slide_s = _seconds(size), _seconds(slide)
    pane_s = math.gcd(size_s, slide_s)
    # Windows start at multiples of the slide; those holding the pane start in (pane_end - size, pane_start].
    start = F.col("pane") * F.lit(pane_s)
    lowest = F.floor((start + F.lit(pane_s - size_s - 1)) / F.lit(slide_s)) + 1
    highest = F.floor(start / F.lit(slide_s))
    return (
        folded.withColumns({"__lowest": lowest, "__highest": highest})
        .filter(F.col("__lowest") <= F.col("__highest"))
        .withColumn("__window", F.explode_outer(F.sequence("__lowest", "__highest")))
        .groupBy(*keys, "__window")
        .agg(
            F.min("first_time").alias("window_start"),
            F.max("last_time").alias("window_end"),
            F.min("first_step").alias("window_start_step"),
            F.max("last_step").alias("window_end_step"),
            F.min_by("first_value", "first_step").alias("temp_start"),
            F.max_by("last_value", "last_step").alias("temp_end"),
        )
        .select(
            *keys,
            "window_start",
            "window_end",
            "window_start_step",
            "window_end_step",
            (F.col("temp_end") - F.col("temp_start")).alias("temp_diff"),
        )
    )


def max_window_difference(windows: DataFrame, *, keys: Sequence[str] = CELL) -> DataFrame:
    """Largest (signed) windowed change per cell."""
    return windows.groupBy(*keys).agg(F.max("temp_diff").alias("max_temperature_diff"))


def step_changes(grid: DataFrame, **options) -> DataFrame:
    """Largest absolute change of any cell between a step and the next, per step."""
    return (
        consecutive_differences(grid, **options)
        .groupBy(F.col("prev_step").alias("time_step"))
        .agg(F.max(F.abs("diff")).alias("max_change"))
    )


def first_step_below(changes: DataFrame, threshold: float) -> DataFrame:
    """One row: the first step whose largest change is under ``threshold`` (null if none)."""
    return changes.filter(F.col("max_change") < threshold).agg(F.min("time_step").alias("first_step"))


def stencil_residuals(
    grid: DataFrame, *, k: float, value: str = "temperature", order: str = "time_step", tile: int = 64
) -> DataFrame:
    """Residual of the next snapshot against one explicit five-point diffusion step.

    expected(t+1) = T + k * (sum of the four neighbors - 4 T), neighbors off the grid count 0.
    The grid is cut into x/y/step tiles; only border cells are copied to the adjoining
    tile, and every neighbor is then found inside a tile that holds at most
    (tile + 2)^2 * (tile + 1) cells.
    """
    def tile_of(column):
        return F.floor(column / F.lit(tile))

    def reach(column, low, high):
        return F.sequence(tile_of(F.col(column) + low), tile_of(F.col(column) + high))

    t, s = F.col(value), F.col(order)
    placed = (
        grid.select("x", "y", s.alias("__s"), t.alias("__t"))
        .withColumn("__tx", F.explode_outer(reach("x", -1, 1)))
        .withColumn("__ty", F.explode_outer(reach("y", -1, 1)))
        .withColumn("__ts", F.explode_outer(reach("__s", -1, 0)))
    )
    box = ["__tx", "__ty", "__ts"]
    placed = placed.repartition(*box)

    along_x = Window.partitionBy(*box, "y", "__s").orderBy("x")
    along_y = Window.partitionBy(*box, "x", "__s").orderBy("y")
    along_s = Window.partitionBy(*box, "x", "y").orderBy("__s")

    def side(window, axis, shift):
        pick = F.lag if shift < 0 else F.lead
        there = pick(axis).over(window) == F.col(axis) + shift
        return F.when(there, pick("__t").over(window))

    missing = F.lit(0.0)
    looked = (
        placed.withColumns({"__w": side(along_x, "x", -1), "__e": side(along_x, "x", 1)})
        .withColumns({"__n": side(along_y, "y", -1), "__o": side(along_y, "y", 1)})
        .withColumn("__next", side(along_s, "__s", 1))
    )
    own = (
        (F.col("__tx") == tile_of(F.col("x")))
        & (F.col("__ty") == tile_of(F.col("y")))
        & (F.col("__ts") == tile_of(F.col("__s")))
    )
    around = sum((F.coalesce(F.col(c), missing) for c in ("__w", "__e", "__n", "__o")), missing)
    expected = F.col("__t") + F.lit(k) * (around - 4 * F.col("__t"))
    return (
        looked.filter(own & F.col("__next").isNotNull())
        .withColumn("expected", expected)
        .select(
            "x",
            "y",
            F.col("__s").alias(order),
            "expected",
            F.col("__next").alias("observed"),
            (F.col("__next") - F.col("expected")).alias("residual"),
        )
    )
