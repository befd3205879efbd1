"""Ranks, link costs and names used by routing reports, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rank units of one hop, and the smallest link cost.
RANK_UNIT = 128
MIN_COST = 1e-6

# Objective code point -> name.
OBJECTIVES = {0: "OF0", 1: "MRHOF"}


def dag_rank(rank: Column) -> Column:
    return F.floor(rank / F.lit(RANK_UNIT)).cast("int")


def is_root_rank(rank: Column) -> Column:
    return dag_rank(rank) <= 1


def objective_name(code: Column) -> Column:
    named = F.when(F.lit(False), F.lit(""))
    for number, name in OBJECTIVES.items():
        named = named.when(code == number, F.lit(name))
    return named.otherwise(F.lit("Unknown"))


def link_cost(etx: Column, rpl_link_metric: Column, link_metric: Column) -> Column:
    """Cost per hop: the first metric present over 128, at least 1e-6; 1 without a positive metric."""
    raw = F.coalesce(etx.cast("double"), rpl_link_metric.cast("double"), link_metric.cast("double"))
    usable = (raw > 0) & (raw < F.lit(float("inf")))
    return F.greatest(F.lit(MIN_COST), F.when(usable, raw / F.lit(float(RANK_UNIT))).otherwise(F.lit(1.0)))
