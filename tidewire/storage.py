"""Shared-folder staging: cuts lineage so that a lost executor only costs a re-read.

Iterative operators write each round as a Parquet table and read it back.  The folder
comes from ``spark.checkpoint.dir`` (or the context's checkpoint directory); a
machine-local folder is used only when the master itself is local.
"""

from __future__ import annotations

import contextlib
import tempfile
import threading
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

_LOCAL_BASES: dict[str, str] = {}
_SCOPES = threading.local()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from the session settings."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError(
            "set spark.checkpoint.dir to a folder shared by all executors before running "
            "iterative or streaming operators on a cluster"
        )
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_BASES:
        _LOCAL_BASES[app] = tempfile.mkdtemp(prefix="tidewire-")
    return _LOCAL_BASES[app]


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh, unused path below the shared folder."""
    path = f"{shared_folder(spark)}/tidewire/{label}-{uuid.uuid4().hex}"
    for scope in getattr(_SCOPES, "open", [])[-1:]:
        scope.append(path)
    return path


@contextlib.contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Drops every folder made inside once the block ends; for work whose results are written elsewhere."""
    _SCOPES.open = [*getattr(_SCOPES, "open", []), []]
    try:
        yield
    finally:
        *_SCOPES.open, made = _SCOPES.open
        for path in made:
            drop(spark, path)


@contextlib.contextmanager
def recorded() -> Iterator[list[str]]:
    """Lists the folders made inside, for a caller that knows when nothing reads them any more."""
    _SCOPES.open = [*getattr(_SCOPES, "open", []), []]
    made = _SCOPES.open[-1]
    try:
        yield made
    finally:
        _SCOPES.open = _SCOPES.open[:-1]


def clear(spark: SparkSession) -> None:
    """Remove everything staged below the shared folder, once no result that reads it is needed any more."""
    drop(spark, f"{shared_folder(spark)}/tidewire")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and return a scan of it."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Rounds:
    """Staged state of a loop; a round's table is dropped two rounds later, once nothing reads it."""

    def __init__(self, spark: SparkSession, label: str):
        self._spark = spark
        self._root = new_folder(spark, label)
        self._round = 0
        self._schema = None

    def _path(self, number: int) -> str:
        return f"{self._root}/round={number}"

    def store(self, df: DataFrame) -> DataFrame:
        """Write the next round (all rounds have the first one's schema) and return a scan of it."""
        self._round += 1
        if self._schema is None:
            self._schema = df.schema
        df.write.parquet(self._path(self._round))
        if self._round > 2:
            drop(self._spark, self._path(self._round - 2))
        return self._spark.read.schema(self._schema).parquet(self._path(self._round))


def drop(spark: SparkSession, path: str) -> None:
    """Remove a staged folder nothing reads any more."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
