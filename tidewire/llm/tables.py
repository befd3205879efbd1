"""What keeps the memory of Python workers bounded: workers are used again and again, by one stage after another."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable

from pyspark.sql import DataFrame


class BoundedTable(dict):
    """``table[key]`` makes a missing value, and keeps those in use.

    Values wait in a table of their own until they are used a second time, so that what is used once pushes nothing else out; a
    full one starts anew.  Once the main table is full, entries not used since the last time are forgotten.  Three
    tables of at most ``limit`` entries are held.
    """

    def __init__(self, make: Callable, limit: int):
        super().__init__()
        self._make, self._limit, self._old, self._new = make, limit, {}, {}

    def __missing__(self, key):
        value = self._new.pop(key, None)
        if value is None:
            value = self._old.get(key)
        if value is None:
            value = self._make(key)
            if len(self._new) >= self._limit:
                self._new = {}
            self._new[key] = value
            return value
        if len(self) >= self._limit:
            self._old = dict(self)
            self.clear()
        self[key] = value
        return value

    def forget(self) -> None:
        """Drop all entries."""
        self._old, self._new = {}, {}
        self.clear()


def release() -> None:
    """Hand memory that a finished task no longer needs back to the system; allocators would keep it otherwise."""
    gc.collect()
    trim()


def trim() -> None:
    """Hand back what is free already, for use within a task."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library has no such function
        return


def plain_names(docs: DataFrame, *needed: str) -> DataFrame:
    """The table with names ``c0``, ``c1``, ... for all columns but the needed ones.

    Operators work on such a table and give the names back at the end with ``toDF``: no name of their own clashes with one of the
    input's, and names with dots or backticks, which Spark's Arrow functions can't read, do no harm.
    """
    return docs.toDF(*[c if c in needed else f"c{i}" for i, c in enumerate(docs.columns)])
