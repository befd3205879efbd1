"""Network state on a stream: latest report per node, idle expiry, resets, per-tick snapshots."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidewire import storage
from tidewire.operators import metrics, reports

NEIGHBORS = "array<struct<id:bigint,cost:double>>"

# What a node's state keeps; neighbors travel as text through the processor.
_KEPT = [
    ("offset", T.LongType()),
    ("t", T.LongType()),
    ("seq", T.LongType()),
    ("parent_id", T.LongType()),
    ("objective_function", T.StringType()),
    ("rank", T.LongType()),
    ("dag_rank", T.LongType()),
    ("is_root", T.BooleanType()),
    ("degree", T.LongType()),
    ("neighbors", T.StringType()),
]
NODE_STATE = T.StructType([T.StructField(n, t) for n, t in _KEPT])
NODE_KEY = T.StructType([T.StructField("node_id", T.LongType())])
CLOCK = T.StructType([T.StructField("epoch", T.LongType()), T.StructField("next_tick", T.LongType())])
SNAPSHOT = T.StructType(
    [
        T.StructField("network", T.StringType()),
        T.StructField("epoch", T.LongType()),
        T.StructField("tick", T.LongType()),
        T.StructField("node_id", T.LongType()),
        *NODE_STATE.fields,
    ]
)
_NAMES = [n for n, _ in _KEPT]
_SECOND = 1_000_000


def _plain(value, kind):
    """State wants plain values; a column with gaps arrives as floats and NaN."""
    if value is None or value != value:
        return None
    if isinstance(kind, T.LongType):
        return int(value)
    return bool(value) if isinstance(kind, T.BooleanType) else value


class NetworkState(StatefulProcessor):
    """Nodes of one shard of a network; emits their state at every tick the clock passes."""

    def __init__(self, every: int, stale: float):
        self.every = every * _SECOND
        self.stale = int(round(stale * _SECOND))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.nodes = handle.getMapState("nodes", NODE_KEY, NODE_STATE)
        self.clock = handle.getValueState("clock", CLOCK)

    def _load(self):
        # One read per call; rows then work on the local copy, and only what changed is written back.
        self.live = {node: kept for (node,), kept in self.nodes.iterator()}
        self.stored, self.changed = set(self.live), set()

    def _save(self):
        for node in self.stored - self.live.keys():
            self.nodes.removeKey((node,))
        for node in self.changed & self.live.keys():
            self.nodes.updateValue((node,), self.live[node])

    def _snapshots(self, network, epoch, tick, until):
        """State rows for ticks from ``tick`` to before ``until`` (microseconds); forgets silent nodes."""
        out = []
        while tick < until:
            for node in [n for n, kept in self.live.items() if tick - kept[1] > self.stale]:
                del self.live[node]
            if not self.live:
                # Nobody is left to report: the next report sets the clock again.
                return out, None
            out += [(network, epoch, tick // _SECOND, node, *kept) for node, kept in self.live.items()]
            tick += self.every
        return out, tick

    def _first_tick(self, t):
        return -(-t // self.every) * self.every

    def _wake(self, tick):
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if tick is not None:
            self.handle.registerTimer(int(tick // 1000) + 1)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        network = key[0]
        # Bounded by the source's trigger limit; arrival order is the source offset.
        batch = pd.concat(list(rows), ignore_index=True).sort_values("offset")
        epoch, tick = self.clock.get() if self.clock.exists() else (0, None)
        self._load()
        out = []
        for row in batch.to_dict("records"):
            t = int(row["t"])
            if tick is not None:
                emitted, tick = self._snapshots(network, epoch, tick, t)
                out += emitted
            if row["reset"]:
                self.live.clear()
                epoch, tick = epoch + 1, None
                continue
            node = int(row["node_id"])
            kept = {name: _plain(row[name], kind) for name, kind in _KEPT}
            last = self.live.get(node)
            if kept["parent_id"] is None and last is not None and t - last[1] <= self.stale:
                kept["parent_id"] = last[3]
            self.live[node] = tuple(kept[name] for name in _NAMES)
            self.changed.add(node)
            if tick is None:
                tick = self._first_tick(t)
        self._save()
        self.clock.update((epoch, tick))
        self._wake(tick)
        yield pd.DataFrame(out, columns=SNAPSHOT.names)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        epoch, tick = self.clock.get()
        out = []
        if tick is not None:
            passed = timerValues.getCurrentWatermarkInMs() * 1000
            self._load()
            out, tick = self._snapshots(key[0], epoch, tick, passed)
            self._save()
            self.clock.update((epoch, tick))
            if tick is not None:
                self.handle.registerTimer(int(tick // 1000) + 1)
        yield pd.DataFrame(out, columns=SNAPSHOT.names)

    def close(self) -> None:
        pass


def snapshots(
    decoded: DataFrame,
    *,
    every: int,
    stale: float,
    resets: DataFrame | None = None,
    shards: int = 32,
    delay: str = "0 seconds",
) -> DataFrame:
    """Per-tick state rows (as ``reports.state_at_intervals``, plus ``epoch``) from decoded reports.

    A network's nodes are spread over ``shards`` state owners, so a network that sends most
    of the reports is not one task.  A reset row (network, offset, received_at) is copied to
    every shard, which is what bounds its cost.  ``received_at`` carries the watermark.
    """
    rows = decoded.select(
        "network",
        F.pmod(F.hash("node_id"), F.lit(shards)).alias("shard"),
        F.col("received_at").cast("timestamp").alias("received_at"),
        "node_id",
        *[F.col(n).cast(t).alias(n) if n != "neighbors" else F.to_json(n).alias(n) for n, t in _KEPT],
        F.lit(False).alias("reset"),
    )
    if resets is not None:
        control = resets.select(
            "network",
            F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
            F.col("received_at").cast("timestamp").alias("received_at"),
            F.col("offset").cast("bigint").alias("offset"),
            F.unix_micros(F.col("received_at").cast("timestamp")).alias("t"),
            F.lit(True).alias("reset"),
        )
        rows = rows.unionByName(control, allowMissingColumns=True)
    states = (
        rows.withWatermark("received_at", delay)
        .groupBy("network", "shard")
        .transformWithStateInPandas(
            statefulProcessor=NetworkState(every, stale),
            outputStructType=SNAPSHOT,
            outputMode="Append",
            timeMode="EventTime",
        )
    )
    return states.withColumns(
        {
            "neighbors": F.from_json("neighbors", NEIGHBORS),
            "age": F.col("tick") * F.lit(_SECOND) - F.col("t"),
        }
    )


class TickMetrics:
    """``foreachBatch`` handler: keeps the state rows and recomputes the metrics of the ticks they touch.

    Both tables are keyed by what is written, not by the attempt: a repeated trigger
    overwrites its own state folder and the same tick partitions.
    """

    def __init__(self, folder: str):
        self.folder = folder.rstrip("/")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        with storage.temporary(batch.sparkSession):
            self._trigger(batch, batch_id)

    def _trigger(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{self.folder}/state/trigger={batch_id}")
        arrived = spark.read.schema(batch.schema).parquet(f"{self.folder}/state/trigger={batch_id}")
        touched = arrived.select("epoch", "tick").distinct()
        if touched.isEmpty():
            return
        everything = spark.read.schema(batch.schema).option("basePath", f"{self.folder}/state").parquet(
            f"{self.folder}/state/trigger=*"
        )
        state = everything.select(*batch.columns).join(touched, ["epoch", "tick"], "left_semi")
        keys = ("network", "epoch", "tick")
        rooted = reports.add_synthetic_root(state, keys=keys)
        (
            metrics.instant(rooted, keys=keys)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("epoch", "tick")
            .parquet(f"{self.folder}/metrics")
        )

    def result(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.folder}/metrics")


class TriggerStates:
    """``foreachBatch`` handler: the batch history and state operators on each trigger's reports.

    Between triggers one filled row per node is carried.  Nodes whose reports arrive in order need nothing else.  A
    node with a report older than its carried row is worked out anew from that report on, starting with the filled row before it.  A
    trigger writes state rows under its number; where triggers disagree on a node at a tick, the later report
    and then the later trigger hold, so late reports correct what was written before.  With ``with_metrics`` the
    metrics of all ticks a trigger touches are written anew.

    Reports as they came (``log``), filled reports (``history``) and ``states`` lie in folders by time range (``span`` seconds, by default four
    times the longer of ``every`` and ``stale``) and trigger, and an index names the highest order value of a range.  A late report reads the
    ranges from ``stale`` before it on, and those that hold reports which come after it in order: what else a node sent can't
    reach it.  That rests on times that don't fall along a node's order; nodes seen to break it are remembered, and a late report
    of theirs reads everything.  Metrics read the ranges of the touched ticks.  So a trigger's work follows what it brings and how late that
    is, not the triggers before it.

    ``reset`` marks control rows that clear a network: what comes after one, in order of ``offset`` inside a trigger, belongs to
    the next *epoch*.  The number of control rows so far is carried per network, so a reset holds whether it came in
    this trigger, in an earlier one or as the last row of a delivery; nodes of an earlier epoch are not carried on, and
    their rows are no state any more from the time of the reset.

    Results can be read by a new handler on the same folder, also before its first trigger.
    """

    def __init__(self, folder: str, *, every: int, stale: float, with_metrics: bool = False, reset: Column | None = None, span: float | None = None):
        self.folder, self.every, self.stale, self.with_metrics = folder.rstrip("/"), every, stale, with_metrics
        self.reset, self.span = reset, int(span or 4 * max(every, stale))
        self.node = list(reports.NODE) if reset is None else ["network", "epoch", "node_id"]
        self._schemas: dict[str, T.StructType] = {}

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        with storage.temporary(batch.sparkSession):
            self._trigger(batch, batch_id)

    def _epochs(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """network and resets, the control rows up to and with a trigger."""
        return self._small(spark, "epochs", batch_id, "network string, resets long")

    def _small(self, spark: SparkSession, name: str, batch_id: int, schema: str | T.StructType) -> DataFrame:
        """A table that every trigger writes whole, as the trigger left it; empty before the first."""
        return spark.read.schema(schema).parquet(f"{self.folder}/{name}/trigger={batch_id}") if batch_id >= 0 else spark.createDataFrame([], schema)

    def _store_small(self, rows: DataFrame, name: str, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.folder}/{name}/trigger={batch_id}")
        if batch_id > 1:
            storage.drop(rows.sparkSession, f"{self.folder}/{name}/trigger={batch_id - 2}")

    def _store(self, rows: DataFrame, name: str, batch_id: int, seconds: Column) -> None:
        """Adds a trigger's rows to a table laid out by time range; a repeated trigger replaces its own."""
        kept = rows.withColumns({"range": self._range(seconds), "trigger": F.lit(batch_id).cast("bigint")})
        if name not in self._schemas:
            # For a new driver: empty results have no file that tells their columns.
            kept.limit(0).write.mode("overwrite").parquet(f"{self.folder}/schemas/{name}")
            self._schemas[name] = kept.schema
        by_range = kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("range", "trigger")
        by_range.parquet(f"{self.folder}/{name}")

    def _stored(self, spark: SparkSession, name: str, ranges: list[int] | None = None) -> DataFrame:
        """Rows of all triggers, of some time ranges or all; other ranges are not even listed."""
        if name not in self._schemas:
            self._schemas[name] = spark.read.parquet(f"{self.folder}/schemas/{name}").schema
        folder, schema = f"{self.folder}/{name}", self._schemas[name]
        if ranges is not None and not ranges:
            return spark.createDataFrame([], schema)
        paths = [folder] if ranges is None else [f"{folder}/range={r}" for r in ranges]
        return spark.read.schema(schema).option("basePath", folder).parquet(*paths)

    def _range(self, seconds: Column) -> Column:
        return F.coalesce(F.floor(seconds / F.lit(self.span)), F.lit(0)).cast("bigint")

    def _numbered(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """The batch without its control rows and with ``epoch``; keeps the counts and the times of the resets."""
        spark = batch.sparkSession
        batch = storage.stage(batch, "marked")
        before = self._epochs(spark, batch_id - 1)
        seen = batch.groupBy("network").agg(F.count_if(self.reset).alias("n"))
        resets = F.coalesce("resets", F.lit(0)) + F.coalesce("n", F.lit(0))
        self._store_small(before.join(seen, "network", "full").select("network", resets.cast("long").alias("resets")), "epochs", batch_id)
        known = before.withColumnRenamed("resets", "__before")
        epoch = (F.col("epoch") + F.coalesce("__before", F.lit(0))).cast("long")
        numbered = storage.stage(reports.resets_as_epochs(batch, reset=self.reset), "numbered")
        controls = batch.filter(self.reset).withColumn("epoch", F.row_number().over(Window.partitionBy("network").orderBy("offset")) - 1)
        ends = controls.join(known, "network", "left").select("network", epoch.alias("epoch"), F.col("t").alias("ended"))
        ends.write.mode("overwrite").parquet(f"{self.folder}/ends/trigger={batch_id}")
        return numbered.join(known, "network", "left").withColumn("epoch", epoch).drop("__before")

    def _again(self, late: DataFrame, columns: list[str], before: DataFrame, batch_id: int) -> DataFrame | None:
        """Earlier reports that late ones concern: as they came from the first late one on, and the filled one before it (``__carried``)."""
        spark, node = late.sparkSession, self.node
        found = late.agg(F.min("__since").alias("since"), F.min("__first").alias("first"), F.max("__falls").alias("falls")).first()
        if found["first"] is None:
            return None
        # One row per time range comes to the driver.
        reached = (F.col("range") >= found["since"]) | (F.col("highest") >= found["first"]) | F.lit(found["falls"])
        ranges = sorted(r["range"] for r in before.filter(reached).select("range").collect())
        # A repeated trigger finds what it wrote at its first attempt.
        log, history = (self._stored(spark, name, ranges).filter(F.col("trigger") < batch_id) for name in ("log", "history"))
        first = late.select(*node, "__first")
        as_came = log.join(first, node).filter(F.col("offset") >= F.col("__first")).select(*columns)
        filled = history.join(first, node).filter(F.col("offset") < F.col("__first"))
        seeds = filled.groupBy(*node).agg(F.max_by(F.struct(*columns), F.struct("offset", "trigger")).alias("__row")).select("__row.*")
        return as_came.withColumn("__carried", F.lit(False)).unionByName(seeds.withColumn("__carried", F.lit(True)))

    def _trigger(self, batch: DataFrame, batch_id: int) -> None:
        spark, node = batch.sparkSession, self.node
        if self.reset is not None:
            batch = self._numbered(batch, batch_id)
        columns, seconds = batch.columns, F.col("t") / _SECOND
        new = storage.stage(batch, "new")
        self._store(new, "log", batch_id, seconds)
        indexed = self._small(spark, "index", batch_id - 1, "range long, highest long")
        here = new.groupBy(self._range(seconds).alias("range")).agg(F.max("offset").cast("long").alias("highest"))
        self._store_small(indexed.unionByName(here).groupBy("range").agg(F.max("highest").alias("highest")), "index", batch_id)

        carried = self._small(spark, "carried", batch_id - 1, batch.schema)
        falling = self._small(spark, "falling", batch_id - 1, new.select(*node).schema)
        since = F.min(F.when(F.col("t").isNull(), F.lit(-(1 << 62))).otherwise(self._range(seconds - F.lit(self.stale))))
        first = new.groupBy(*node).agg(F.min("offset").alias("__first"), since.alias("__since"))
        last = carried.select(*node, F.col("offset").alias("__last"))
        arrived = storage.stage(
            first.join(last, node, "left").join(falling.withColumn("__falls", F.lit(True)), node, "left").select(
                *node, "__first", "__since", F.coalesce("__falls", F.lit(False)).alias("__falls"),
                F.coalesce(F.col("__first") < F.col("__last"), F.lit(False)).alias("__late"),
            ),
            "arrived",
        )
        late, in_order = arrived.filter("__late"), arrived.filter("not __late")
        again = self._again(late, columns, indexed, batch_id)
        rows = new.withColumn("__carried", F.lit(False)).unionByName(
            carried.join(in_order, node, "left_semi").withColumn("__carried", F.lit(True))
        )
        if again is not None:
            rows = rows.unionByName(again)
        history = storage.stage(reports.with_history(rows, stale=self.stale, keys=node), "history")
        # A carried row was written by the trigger that brought it.
        self._store(history.filter(~F.col("__carried")).drop("__carried", "next_t"), "history", batch_id, seconds)
        falls = history.filter(F.col("next_t") < F.col("t")).select(*node)
        self._store_small(falling.unionByName(falls).distinct(), "falling", batch_id)
        history = history.drop("__carried")
        states = reports.state_at_intervals(history, every=self.every, stale=self.stale)
        self._store(states, "states", batch_id, F.col("tick"))
        touched = states.select("network", "tick", self._range(F.col("tick")).alias("range")).distinct()
        newest = reports.latest(history.select(*columns), keys=node).unionByName(carried.join(arrived, node, "left_anti"))
        if self.reset is not None:
            now = self._epochs(spark, batch_id).withColumnRenamed("resets", "epoch")
            newest = newest.join(now, ["network", "epoch"], "left_semi").select(*columns)
        self._store_small(newest, "carried", batch_id)
        if self.with_metrics:
            self._write_metrics(storage.stage(touched, "touched"))

    def _write_metrics(self, touched: DataFrame) -> None:
        """Metrics of the ticks that a trigger wrote states of, from the time ranges that hold them."""
        spark = touched.sparkSession
        ranges = sorted(r["range"] for r in touched.select("range").distinct().collect())
        state = self._merged(spark, self._stored(spark, "states", ranges)).join(touched.drop("range"), ["network", "tick"], "left_semi")
        found = metrics.instant(reports.add_synthetic_root(storage.stage(state, "state")))
        if "metrics" not in self._schemas:
            found.limit(0).write.mode("overwrite").parquet(f"{self.folder}/schemas/metrics")
            self._schemas["metrics"] = found.schema
        by_tick = found.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("tick")
        by_tick.parquet(f"{self.folder}/metrics")

    def _merged(self, spark: SparkSession, every: DataFrame) -> DataFrame:
        """One row per node and tick."""
        if self.reset is not None:
            ends = spark.read.schema("network string, epoch long, ended long").parquet(f"{self.folder}/ends/trigger=*")
            every = every.join(ends, ["network", "epoch"], "left").filter(F.col("ended").isNull() | (F.col("tick") * _SECOND < F.col("ended"))).drop("ended")
        others = [c for c in every.columns if c not in ("network", "tick", "node_id", "trigger", "range")]
        best = F.max_by(F.struct(*others), F.struct("offset", "trigger")).alias("__row")
        return every.groupBy("network", "tick", "node_id").agg(best).select("network", "tick", "node_id", "__row.*")

    def result(self, spark: SparkSession, *, since: int | None = None) -> DataFrame:
        """State rows of all ticks so far, or from ``since`` on, those after the newest report included."""
        every = self._stored(spark, "states")
        if since is not None:
            every = every.filter((F.col("range") >= self._range(F.lit(since))) & (F.col("tick") >= since))
        return self._merged(spark, every)

    def history_result(self, spark: SparkSession) -> DataFrame:
        """Every report with its fields filled and ``session_start``; of a report written twice the later trigger's row."""
        every = self._stored(spark, "history")
        others = [c for c in every.columns if c not in ("network", "offset", "trigger", "range")]
        best = F.max_by(F.struct(*others), "trigger").alias("__row")
        return every.groupBy("network", "offset").agg(best).select("network", "offset", "__row.*")

    def metrics_result(self, spark: SparkSession) -> DataFrame:
        return self._stored(spark, "metrics")
