"""Declared schemas; nothing in the library infers one from data."""

from __future__ import annotations

from pyspark.sql import types as T

NEIGHBOR = T.StructType(
    [
        T.StructField("addr", T.StringType()),
        T.StructField("lladdr", T.StringType()),
        T.StructField("rpl_rank_raw", T.IntegerType()),
        T.StructField("rpl_dag_rank", T.IntegerType()),
        T.StructField("rpl_link_metric", T.IntegerType()),
        T.StructField("etx", T.DoubleType()),
        T.StructField("link_metric_to_neighbor", T.DoubleType()),
        T.StructField("is_rpl_parent", T.BooleanType()),
        T.StructField("is_preferred_parent", T.BooleanType()),
    ]
)

# JSON key -> column name and type of a routing report (fixed by the message format).
REPORT_KEYS = {
    "Board": ("board", T.StringType()),
    "Seq #": ("seq", T.LongType()),
    "Timestamp": ("device_time", T.LongType()),
    "Node ID": ("node_id", T.StringType()),
    "IPv6 Address": ("ipv6", T.StringType()),
    "RPL Instance ID": ("instance_id", T.IntegerType()),
    "DODAG ID": ("dodag_id", T.StringType()),
    "DODAG Version": ("dodag_version", T.IntegerType()),
    "RPL Rank": ("rank", T.IntegerType()),
    "RPL DAG Rank": ("dag_rank", T.IntegerType()),
    "Preferred Parent": ("preferred_parent", T.StringType()),
    "Def Route": ("def_route", T.StringType()),
    "neighbors": ("neighbors", T.ArrayType(NEIGHBOR)),
    "objective_function": ("objective_function", T.StringType()),
    "is_root": ("is_root", T.BooleanType()),
}

CORRUPT = "_corrupt"

REPORT_JSON = T.StructType(
    [T.StructField(key, kind) for key, (_, kind) in REPORT_KEYS.items()]
    + [T.StructField(CORRUPT, T.StringType())]
)

GRID_CSV = T.StructType(
    [
        T.StructField("x", T.IntegerType()),
        T.StructField("y", T.IntegerType()),
        T.StructField("temperature", T.DoubleType()),
        T.StructField("_corrupt", T.StringType()),
    ]
)

# A keyed reading as it arrives: both fields are text, the position orders them.
RAW_READING = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)
