"""Message and table texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Wording of the result message per sensor type (spelled as the consumers expect).
MESSAGE_WORDS = {
    "temperature": "temperature",
    "humidity": "humidity",
    "wind": "wind speed",
    "airQuality": "Air quiality",
}

ROOT_PARENT_TEXT = "—"


def result_message(sensor_type: Column, aggregate: str, result: Column) -> Column:
    """General form: ``{ "<type>_<aggregate>": <value>}``."""
    return F.format_string('{ "%s_%s": %f}', sensor_type, F.lit(aggregate), result)


def typed_result_message(sensor_type: Column, aggregate: str, result: Column) -> Column:
    """Per-type wording, e.g. ``{ average wind speed: 9.500000}`` (not JSON)."""
    words = F.when(F.lit(False), F.lit(""))
    for name, text in MESSAGE_WORDS.items():
        words = words.when(sensor_type == name, F.lit(text))
    return F.format_string("{ %s %s: %f}", F.lit(aggregate), words.otherwise(sensor_type), result)


def joined_ids(ids: Column) -> Column:
    """Comma-joined ids in numeric order."""
    return F.array_join(F.array_sort(ids).cast("array<string>"), ",")


def parent_text(is_root: Column, parent: Column) -> Column:
    return F.when(is_root, F.lit(ROOT_PARENT_TEXT)).otherwise(F.coalesce(parent.cast("string"), F.lit("")))
