"""Result tables that are replaced together: a reader sees all of one trigger or all of the one before."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire import storage
from tidewire.operators import graph, metrics, reports

from .network_state import TriggerStates


class ResultTables:
    """Named tables with one folder per version and a pointer that is switched last.

    A version's tables are written to a folder of their own; only then its pointer, an empty file named by the
    version, is made.  Readers follow the newest pointer, so a writer that stops between two tables changes nothing for
    them, and the trigger that is repeated afterwards writes the same version anew.  The ``keep`` newest versions stay
    for readers that have begun.
    """

    def __init__(self, folder: str, *, keep: int = 2):
        self.folder, self.keep = folder.rstrip("/"), keep

    def _files(self, spark: SparkSession):
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/current")
        return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path

    def versions(self, spark: SparkSession) -> list[int]:
        """Versions with a pointer, the newest last."""
        files, path = self._files(spark)
        return sorted(int(f.getPath().getName()) for f in files.listStatus(path)) if files.exists(path) else []

    def publish(self, spark: SparkSession, tables: dict[str, DataFrame], version: int) -> None:
        for name, table in tables.items():
            table.write.mode("overwrite").parquet(f"{self.folder}/version={version}/{name}")
        files, path = self._files(spark)
        files.create(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, str(version)), True).close()
        for old in self.versions(spark)[: -self.keep]:
            # The pointer goes first: no reader is sent to a folder that is being dropped.
            storage.drop(spark, f"{self.folder}/current/{old}")
            storage.drop(spark, f"{self.folder}/version={old}")

    def read(self, spark: SparkSession, *names: str) -> list[DataFrame]:
        """The named tables, all of the newest version."""
        versions = self.versions(spark)
        if not versions:
            raise ValueError(f"nothing has been published in {self.folder}")
        return [spark.read.parquet(f"{self.folder}/version={versions[-1]}/{name}") for name in names]


class TriggerTables:
    """``foreachBatch`` handler: after each trigger's states and metrics the topology, per-node and general table of the newest tick."""

    def __init__(self, states: TriggerStates, tables: ResultTables):
        if not states.with_metrics:
            raise ValueError("the general table needs the metrics of every tick")
        self.states, self.tables = states, tables

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self.states(batch, batch_id)
        spark = batch.sparkSession
        with storage.temporary(spark):
            figures = storage.stage(self.states.metrics_result(spark), "figures")
            newest = figures.groupBy("network").agg(F.max("tick").alias("tick"))
            # A state's ticks lie side by side in the files of a trigger, so this reads little of the older ones.
            oldest = newest.agg(F.min("tick")).first()[0]
            if oldest is None:
                return
            state = self.states.result(spark, since=oldest).join(F.broadcast(newest), ["network", "tick"], "left_semi")
            nodes = storage.stage(graph.node_table(storage.stage(reports.add_synthetic_root(state), "newest")), "nodes")
            self.tables.publish(
                spark,
                {
                    "topology": metrics.topology_table(nodes),
                    "nodes": metrics.per_node_table(nodes, None),
                    "general": metrics.general_table(metrics.running_means(figures)),
                },
                batch_id,
            )
