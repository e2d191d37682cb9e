"""Continuous delivery: a change stream written through foreachBatch, each transaction once, with its progress beside the data.

A delivery is a micro-batch of a query, named by both. It is written under its name, then recorded with the transactions it
held; readers see recorded deliveries only. So a batch that comes again before it was recorded replaces itself, one that
comes again later is passed over, and what a lost offset log leaves unrecorded is never seen.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerline.functions import gtid
from ledgerline.functions.ordered import DENSE, running_total
from ledgerline.operators.delivery import allowed, deduplicated, latest_state, receipts
from ledgerline.operators.snapshot import gate
from ledgerline.sources.scratch import released

INTERVALS = "source_uuid string, lo bigint, hi bigint"
RUNS = "run string, upto bigint"
#: Deliveries that are folded into one table at once.
FOLDED = 64


class Halt(RuntimeError):
    """Why delivery stopped: a code, never a value of a row."""


class Permanent(RuntimeError):
    """A fault that trying again can't mend."""


def _folder(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _names(spark: SparkSession, path: str) -> list[str]:
    """The entries of a folder that were written to their end."""
    fs, place = _folder(spark, path)
    if not fs.exists(place):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(place)]
    return [n for n in names if fs.exists(_folder(spark, f"{path}/{n}/_SUCCESS")[1])]


def patiently(task: Callable[[], object], code: str, tries: int = 5, pause: float = 0.1) -> object:
    """Runs the task again after a fault, each time after twice the pause; halts with the code when no try is left, and at
    once for a fault that is permanent."""
    for left in reversed(range(tries)):
        try:
            return task()
        except Exception as fault:
            if not left or isinstance(fault, Permanent):
                raise Halt(code) from fault
            time.sleep(pause)
            pause *= 2


@dataclass
class Progress:
    """The processed set of one pipeline, in a folder that the cluster shares.

    `done` holds a table a delivery with the intervals of that delivery alone. Now and then they are folded into a table
    under `base` with the last delivery of each run, and deleted. A table counts once its marker is there, so a crash at any
    point leaves what was recorded before in force.
    """

    spark: SparkSession
    path: str

    def _base(self) -> tuple[DataFrame, DataFrame, int]:
        found = sorted(int(n[5:]) for n in _names(self.spark, f"{self.path}/base") if n.startswith("runs-"))
        if not found:
            return self.spark.createDataFrame([], INTERVALS), self.spark.createDataFrame([], RUNS), 0
        return self.spark.read.schema(INTERVALS).parquet(f"{self.path}/base/set-{found[-1]}"), self.spark.read.schema(RUNS).parquet(f"{self.path}/base/runs-{found[-1]}"), found[-1]

    def _done(self) -> list[tuple[str, int]]:
        return [(n.rpartition("~")[0], int(n.rpartition("~")[2])) for n in _names(self.spark, f"{self.path}/done")]

    def read(self) -> DataFrame:
        """The intervals of all transactions that are done."""
        paths = [f"{self.path}/done/{run}~{k}" for run, k in self._done()]
        base = self._base()[0]
        return base.union(self.spark.read.schema(INTERVALS).parquet(*paths)) if paths else base

    def runs(self) -> dict[str, int]:
        """The last recorded delivery of each run; all before it are recorded too, or held nothing."""
        out = {r.run: r.upto for r in self._base()[1].collect()}
        for run, k in self._done():
            out[run] = max(k, out.get(run, k))
        return out

    def holds(self, run: str, batch: int) -> bool:
        return batch <= self.runs().get(run, -1)

    def seed(self, intervals: DataFrame) -> None:
        """Sets where to begin, only where nothing has been processed yet; never goes back."""
        if not self._done() and not self._base()[2]:
            self.record("seed", 0, intervals)

    def record(self, run: str, batch: int, intervals: DataFrame) -> None:
        """Adds the transactions of a delivery."""
        intervals.select("source_uuid", "lo", "hi").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/done/{run}~{batch}")
        done = self._done()
        if len(done) >= FOLDED:
            self._fold(done)

    def _fold(self, done: list[tuple[str, int]]) -> None:
        n = self._base()[2] + 1
        gtid.normalize(self.read()).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/base/set-{n}")
        self.spark.createDataFrame(list(self.runs().items()), RUNS).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/base/runs-{n}")
        for name in (*[f"done/{run}~{k}" for run, k in done], *[f"base/{kind}-{n - 2}" for kind in ("runs", "set")]):
            fs, place = _folder(self.spark, f"{self.path}/{name}")
            fs.delete(place, True)


Sink = Callable[[DataFrame, str], None]


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the query of a checkpoint, which no other checkpoint has."""
    fs, place = _folder(spark, f"{checkpoint}/metadata")
    return json.loads(spark.read.text(place.toString()).first()[0])["id"] if fs.exists(place) else uuid.uuid4().hex


@dataclass
class Pipeline:
    """Reads changes (source_uuid, gno, change_ix, op, schema, table, ...), delivers those not yet processed, then moves on.

    In each micro-batch: deduplicate by membership, filter by table, deliver, and only then record all transactions of the
    batch, the filtered ones too. A sink that fails leaves the progress as it was and ends the query; the batch comes
    again on restart. cursors, if given, tells the snapshot's state, and holds back what a later chunk will bring.

    A micro-batch must hold whole transactions, or `end` must name a column that is true in the last row of each: then a
    transaction that a micro-batch cuts waits, with nothing of it delivered or recorded, until its end was read.

    Rows with op `schema` are schema changes: they go to schema_sink, in order with the data of their source, so what came
    before them is delivered before. faults, if given, finds what is wrong with a batch, and must find nothing.
    """

    progress: Progress
    sink: Sink
    tables: list[tuple[str, str]] | None = None
    cursors: Callable[[], DataFrame] | None = None
    schema_sink: Sink | None = None
    faults: Callable[[DataFrame], DataFrame] | None = None
    retries: int = 5
    run: str = "run"
    end: str | None = None
    seen: list[dict] = field(default_factory=list)

    def deliver(self, batch: DataFrame, batch_id: int, points: DataFrame | None = None, keep: Callable[[], None] | None = None) -> None:
        """Delivers a batch of changes. points, if given, are the ids (source_uuid, gno) that are then done, changes or not;
        keep, if given, stores what must count from the record on."""
        if self.progress.holds(self.run, batch_id) or (points is None and batch.isEmpty()):
            return
        with released(self.progress.spark):
            self._deliver(batch, batch_id, points, keep)

    def _deliver(self, batch: DataFrame, batch_id: int, points: DataFrame | None, keep: Callable[[], None] | None) -> None:
        if self.faults is not None and (found := self.faults(batch).first()) is not None:
            raise Halt(found["reason"])
        if self.end is not None:
            batch, points, keep = self._whole(batch, batch_id)
        fresh = deduplicated(batch, self.progress.read()).persist()
        try:
            chosen = allowed(fresh, self.tables)
            if self.cursors is not None:
                chosen = gate(chosen, self.cursors(), key="k")
            name = f"{self.run}~{batch_id}"
            began = time.monotonic()
            try:
                self._in_order(chosen, name)
            except Exception as fault:
                raise Halt("sink_error") from fault
            took = time.monotonic() - began

            def record() -> None:
                if keep is not None:
                    keep()
                self.progress.record(self.run, batch_id, gtid.from_points(fresh if points is None else points))

            patiently(record, "checkpoint_write_failed", self.retries)
            self.seen.append(measured({"sink_ms": int(took * 1000)}, {"reason": "delivered"}))
        finally:
            fresh.unpersist()

    def _whole(self, batch: DataFrame, batch_id: int) -> tuple[DataFrame, DataFrame, Callable[[], None]]:
        """The rows of transactions whose end was read, with those that earlier batches left open, their ids, and what stores
        the rows that stay open. A new run reads from the beginning, so it doesn't take over what another one left."""
        from ledgerline.streaming.pool import Pool

        pool = Pool(batch.sparkSession, f"{self.progress.path}/open", self.progress, {"open": batch.schema})
        held, writer = pool.read()
        rows = batch.union(held["open"].select(*batch.columns)) if writer == self.run else batch
        ids = rows.where(F.col(self.end)).select("source_uuid", "gno").distinct()
        left = rows.join(ids, ["source_uuid", "gno"], "left_anti").select(*batch.columns)
        return rows.join(ids, ["source_uuid", "gno"], "left_semi").select(*batch.columns), ids, lambda: pool.write(self.run, batch_id, {"open": left})

    def _in_order(self, chosen: DataFrame, name: str) -> None:
        """Delivers the data between schema changes, and each schema change in its place. Schema changes are few a batch."""
        steps = chosen.where("op = 'schema'").groupBy("source_uuid").count().agg(F.max("count")).first()[0] or 0
        if not steps:
            self.sink(chosen, name)
            return
        ordered = running_total(chosen, ["source_uuid"], "gno", F.when(F.col("op") == "schema", 1).otherwise(0), "_step", DENSE).persist()
        for k in range(steps + 1):
            now = ordered.where(F.col("_step") == k)
            if k and self.schema_sink is not None:
                self.schema_sink(now.where("op = 'schema'").drop("_step"), f"{name}.{k}")
            self.sink(now.where("op <> 'schema'").drop("_step"), f"{name}.{k}" if k else name)
        ordered.unpersist()

    def start(self, changes: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
        return self.run_each(changes, checkpoint, self.deliver, trigger)

    def run_each(self, rows: DataFrame, checkpoint: str, deliver: Callable[[DataFrame, int], None], trigger: dict | None = None) -> StreamingQuery:
        """Runs deliver on each micro-batch, under the name of the query that the checkpoint belongs to."""
        spark = rows.sparkSession

        def batch(df: DataFrame, batch_id: int) -> None:
            self.run = run_of(spark, checkpoint)
            deliver(df, batch_id)

        return rows.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "500 milliseconds"})).start()


#: What may be told of a run; counts and times, and names that hold no value of a row.
MEASURES = ("change_count", "sink_ms", "establish_ms", "table_count", "row_count", "chunk_seq")
LABELS = ("server_version", "server_uuid", "tls", "reason", "gtid", "schema", "table", "kind", "missing_gtids")


def measured(measures: dict, labels: dict) -> dict:
    """Both together, if they hold allowed names and only counts of 0 and more; a refusal names the names, never a value."""
    strange = sorted({*measures} - {*MEASURES}) + sorted({*labels} - {*LABELS})
    if strange:
        raise ValueError(f"not allowed: {', '.join(map(str, strange))}")
    wrong = sorted(k for k, v in measures.items() if isinstance(v, bool) or not isinstance(v, (int, float)) or not v >= 0)
    if wrong:
        raise ValueError(f"not a count: {', '.join(wrong)}")
    return {**measures, **labels}


@dataclass
class Mirror:
    """A sink that keeps the current row of each key and a ledger of receipts, both written under the delivery's name.

    Only recorded deliveries are read: one that was written but never recorded comes again under its own name or another.
    """

    path: str
    key: list[str]
    order: str
    columns: list[str]
    progress: Progress

    def __call__(self, changes: DataFrame, name: str) -> None:
        changes.select(*self.key, self.order, "op", *self.columns).write.mode("overwrite").parquet(f"{self.path}/changes/{name}")
        receipts(changes).write.mode("overwrite").parquet(f"{self.path}/receipts/{name}")

    def _read(self, spark: SparkSession, kind: str) -> DataFrame:
        upto = self.progress.runs()
        names = [n for n in _names(spark, f"{self.path}/{kind}") if int(n.rpartition("~")[2].partition(".")[0]) <= upto.get(n.rpartition("~")[0], -1)]
        return spark.read.parquet(*[f"{self.path}/{kind}/{n}" for n in names])

    def state(self, spark: SparkSession) -> DataFrame:
        return latest_state(self._read(spark, "changes"), self.key, self.order, self.columns)

    def ledger(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, "receipts")


def new_checkpoint(root: str) -> str:
    return f"{root}/offsets-{uuid.uuid4().hex}"


def with_position(changes: DataFrame) -> DataFrame:
    """Adds gtid, `uuid:number`, as receipts name a transaction."""
    return changes.withColumn("gtid", F.concat_ws(":", "source_uuid", F.col("gno").cast("string")))
