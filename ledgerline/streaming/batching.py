"""Batches by count and deadline over micro-batches: the batch that is open at the end of one goes on in the next."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.delivery import deadline_batches
from ledgerline.sources.scratch import released, stored
from ledgerline.streaming.delivery import INTERVALS, Halt, Progress, Sink, patiently
from ledgerline.streaming.pool import Pool

ENTRIES = "source string, at bigint"


@dataclass
class Batching:
    """Closes batches of entries (source, at), each source's in the order of at, which rises, also from delivery to delivery.

    A batch closes with the entry that makes it `most`, with one that comes `flush` after its oldest, or once `flush` has
    passed since its last entry: by the next entry, or by `now`, if the caller tells the time. What is closed goes to the
    sink as (source, batch_start, batch_end, n); the entries of open batches are carried on in a pool that counts from the
    record of the delivery on. Where micro-batches end makes no difference to the batches. A new run reads from its
    beginning and takes over nothing.
    """

    progress: Progress
    path: str
    sink: Sink
    most: int
    flush: int
    run: str = "run"
    retries: int = 5

    @cached_property
    def pool(self) -> Pool:
        return Pool(self.progress.spark, self.path, self.progress, {"open": ENTRIES})

    def deliver(self, entries: DataFrame, batch_id: int, now: int | None = None) -> None:
        if self.progress.holds(self.run, batch_id):
            return
        with released(self.progress.spark):
            held, writer = self.pool.read()
            rows = entries.select("source", "at")
            rows = stored(rows.union(held["open"]) if writer == self.run else rows, "batching-entries")
            found = stored(deadline_batches(rows, "source", "at", self.most, self.flush), "batching-found")
            last = found.groupBy("source").agg(F.max("batch_start").alias("batch_start"), F.max_by("batch_end", "batch_start").alias("batch_end"), F.max_by("n", "batch_start").alias("n"))
            waits = (F.col("n") < self.most) & (F.col("batch_end") - F.col("batch_start") < self.flush)
            if now is not None:
                waits = waits & (F.lit(now) - F.col("batch_end") < self.flush)
            open_ = stored(last.where(waits).select("source", "batch_start"), "batching-open")
            try:
                self.sink(found.join(open_, ["source", "batch_start"], "left_anti").select("source", "batch_start", "batch_end", "n"), f"{self.run}~{batch_id}")
            except Exception as fault:
                raise Halt("sink_error") from fault
            left = rows.join(open_, "source").where(F.col("at") >= F.col("batch_start")).select("source", "at")

            def record() -> None:
                self.pool.write(self.run, batch_id, {"open": left})
                self.progress.record(self.run, batch_id, self.progress.spark.createDataFrame([], INTERVALS))

            patiently(record, "checkpoint_write_failed", self.retries)
