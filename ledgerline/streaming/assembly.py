"""Transactions over micro-batches of captured events: what is open waits, what is prepared waits for its resolution.

A micro-batch may end anywhere: within a transaction, or between a prepare and its commit, which may lie days and files
apart. What an event batch leaves unfinished is carried in a pool of tables that comes into force with the record of the
delivery, so a restart goes on exactly where the record says.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import gtid
from ledgerline.operators import capture
from ledgerline.sources import binlog
from ledgerline.sources.records import EVENT
from ledgerline.sources.scratch import released, stored
from ledgerline.streaming.delivery import Halt, Pipeline, Progress
from ledgerline.streaming.pool import Pool

STEPS = "digest string, verb string, file string, at bigint, txn_ix bigint, gtid string, ts timestamp"
CHANGES = "gtid string, change_ix struct<seq:bigint,inner:bigint,change_ix:int>, schema string, table string, op string, before string, after string"
OUT = ["source_uuid", "gno", "change_ix", "commit_ts", "schema", "table", "op", "before", "after"]


@dataclass
class Step:
    """What one micro-batch of events comes to: changes to deliver, ids that are done, and what to carry on. It reads tables
    that were stored for it, so it is to be made and used within released()."""

    changes: DataFrame
    points: DataFrame
    carried: dict[str, DataFrame]


@dataclass
class Assembler:
    """Turns batches of raw events (file, seq, raw), in the order of each file, into whole transactions.

    - A transaction whose end wasn't read yet is carried as its events. A new run reads its files from their beginning, so
      it doesn't take over what another run left open; a transaction that then lacks its beginning is a fault.
    - A prepared transaction is carried as its decoded changes until its commit or rollback, over runs too. Neither of its
      ids is done before. A prepare that comes again while it is held is passed over.
    - recovered (digest) are those found prepared at the first start. Each explains one resolution without a prepare.
    - most_prepared bounds the transactions held: one more halts, as none may be dropped.
    - Without two_phase, a step of a two-phase transaction halts.

    Steps of transactions that the progress holds already are passed over. Any fault halts before anything is delivered.
    """

    spark: SparkSession
    path: str
    progress: Progress
    tables: list[tuple[str, str]] | None = None
    recovered: DataFrame | None = None
    most_prepared: int | None = None
    two_phase: bool = True

    @cached_property
    def pool(self) -> Pool:
        return Pool(self.spark, self.path, self.progress, {"open": EVENT, "prepared": STEPS, "changes": CHANGES, "used": "digest string"})

    def step(self, raw: DataFrame, run: str) -> Step:
        held, writer = self.pool.read()
        events = capture.placed_events(capture.told_events(raw, held["open"] if writer == run else None), self.tables)
        self._halt(capture.event_faults(events))
        open_ = events.where("kind = 'open'").select(*[c.split()[0] for c in EVENT.split(", ")])

        processed = self.progress.read()
        steps = capture.two_phase_steps(events)
        known = steps.columns
        fresh = gtid.non_members(steps.select("*", *capture.id_parts("gtid")), processed).select(*known)
        if not self.two_phase and not fresh.isEmpty():
            raise Halt("unsupported_transaction_shape")
        found = self._recovered().join(held["used"], "digest", "left_anti")
        outcomes = stored(capture.resolve_steps(held["prepared"].select(*known).union(fresh), found), "assembly-outcomes")
        self._halt(capture.outcome_faults(outcomes))

        waits = outcomes.where("outcome = 'held'")
        if self.most_prepared is not None and waits.count() > self.most_prepared:
            raise Halt("xa_prepared_pool_exhausted")

        changes = capture.numbered_changes(events, self.tables)
        at_once = capture.committed_at_once(events)
        done = outcomes.where("outcome = 'committed'").select(F.col("prepare_file").alias("file"), F.col("prepare_ix").alias("txn_ix"), "prepare_gtid", "ts")
        here = done.where("txn_ix is not null").select("file", "txn_ix", *capture.id_parts("prepare_gtid"), F.col("ts").alias("commit_ts"))
        now = changes.join(at_once.union(here), ["file", "txn_ix"]).select(*OUT)
        before = held["changes"].join(done.where("txn_ix is null").select(F.col("prepare_gtid").alias("gtid"), F.col("ts").alias("commit_ts")), "gtid").withColumns(
            dict(zip(("source_uuid", "gno"), capture.id_parts("gtid")))
        )
        ddl = capture.schema_changes(events)
        stated = ddl.join(at_once.select("source_uuid", "gno", "commit_ts"), ["source_uuid", "gno"]).select(
            "source_uuid", "gno", F.lit(None).cast("struct<seq:bigint,inner:bigint,change_ix:int>").alias("change_ix"), "commit_ts", "schema", "table", F.lit("schema").alias("op"),
            F.lit(None).cast("string").alias("before"), F.col("kind").alias("after"),
        )
        points = capture.done_points(events, outcomes)

        new_waits = waits.where("txn_ix is not null").select("file", "txn_ix", "gtid")
        kept = changes.join(new_waits, ["file", "txn_ix"]).select("gtid", "change_ix", "schema", "table", "op", "before", "after")
        still = held["changes"].join(waits.where("txn_ix is null").select("gtid"), "gtid", "left_semi")
        carried = {
            "open": open_,
            "prepared": waits.select("digest", F.lit("prepare").alias("verb"), "file", "at", F.lit(None).cast("bigint").alias("txn_ix"), "gtid", "ts"),
            "changes": still.select("gtid", "change_ix", "schema", "table", "op", "before", "after").union(kept),
            "used": held["used"].union(outcomes.where("outcome = 'advanced'").select("digest")).distinct(),
        }
        return Step(now.union(before.select(*OUT)).union(stated), points, carried)

    def _recovered(self) -> DataFrame:
        return self.recovered.select("digest") if self.recovered is not None else self.spark.createDataFrame([], "digest string")

    @staticmethod
    def _halt(faults: DataFrame) -> None:
        if (found := faults.first()) is not None:
            raise Halt(found["reason"])


@dataclass
class CapturedPipeline:
    """A pipeline fed with raw events: each micro-batch is assembled with what was carried, delivered, and recorded.

    The pool's next version is written before the record of the delivery and counts from then on, so rows, progress and pool
    move together.
    """

    pipeline: Pipeline
    assembler: Assembler
    seen: list[dict] = field(default_factory=list)

    def deliver(self, raw: DataFrame, batch_id: int) -> None:
        run = self.pipeline.run
        if self.pipeline.progress.holds(run, batch_id) or raw.isEmpty():
            return
        with released(self.assembler.spark):
            step = self.assembler.step(raw, run)
            self.pipeline.deliver(step.changes, batch_id, step.points, lambda: self.assembler.pool.write(run, batch_id, step.carried))

    def start(self, raw: DataFrame, checkpoint: str, trigger: dict | None = None):
        return self.pipeline.run_each(raw, checkpoint, self.deliver, trigger)


def raw_events(files: DataFrame) -> DataFrame:
    """The raw events of captured files (path, content)."""
    return binlog.split_events(files)
