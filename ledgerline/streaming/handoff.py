"""Snapshot and stream by one writer: a chunk waits until the stream has come to the position it was read at.

A chunk is stored with the ids that its rows already hold. Until all of them are done, changes beyond them wait too, as the
chunk's rows would undo them. Then, in this order: changes that the chunk holds (of which the gate lets through what lies
behind the cursor), the chunk's rows, the cursor, and the changes beyond. Rows, cursor and progress count from one record on.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import gtid
from ledgerline.functions.keys import BEYOND
from ledgerline.operators.checks import drifted
from ledgerline.operators.delivery import allowed, deduplicated
from ledgerline.operators.snapshot import chunk_facts, chunk_rows_in_order, gate
from ledgerline.sources.scratch import released, stored
from ledgerline.streaming.backfill import STATE, SnapshotStore, state_of
from ledgerline.streaming.delivery import INTERVALS, Halt, Pipeline, measured, patiently
from ledgerline.streaming.pool import Pool

PLAN = "schema string, table string, chunk_seq bigint, upto {key}, final_chunk boolean"
CHUNK = "schema string, table string, upto {key}, final_chunk boolean"
#: The run of deliveries that bring chunks only.
FILL = "snapshot"


@dataclass
class _Chunk:
    schema: str
    table: str
    upto: int | bytes
    final: bool
    rows: DataFrame
    captured: DataFrame


@dataclass
class Handoff:
    """A pipeline whose tables are filled by chunks while it runs.

    read gives a table as it is now, in the columns of the changes (`columns`, a schema that names `key`), and the set of ids
    that it holds; both must be of the same moment. Keys are unique, integers or binary as functions.keys makes them. Where the chunks end is planned in one pass
    when the snapshot begins; a chunk is then read by a range of keys, which scans can push down, and the last one has no
    end. The sink must replace rows by key. What the sink may have received before a crash is kept apart (delivered_pk), so
    that a delete of such a key still goes on when the chunk is read anew.
    """

    pipeline: Pipeline
    path: str
    read: Callable[[str, str], tuple[DataFrame, DataFrame]]
    columns: str
    key: str = "k"
    size: int = 4096
    chunks: int = 16
    seen: list[dict] = field(default_factory=list)

    @property
    def spark(self) -> SparkSession:
        return self.pipeline.progress.spark

    @cached_property
    def _kind(self) -> str:
        """The kind of the keys."""
        return self.spark.createDataFrame([], self.columns).schema[self.key].dataType.simpleString()

    @cached_property
    def pool(self) -> Pool:
        kinds = {"state": state_of(self._kind), "plan": PLAN.format(key=self._kind), "chunk": CHUNK.format(key=self._kind), "rows": self.columns, "captured": INTERVALS, "waiting": self.columns, "owner": "run string"}
        return Pool(self.spark, f"{self.path}/pool", self.pipeline.progress, kinds)

    @cached_property
    def _delivered(self) -> SnapshotStore:
        return SnapshotStore(self.spark, f"{self.path}/delivered", self._kind)

    def begin(self, tables: DataFrame) -> None:
        """Starts with tables (schema, table, fingerprint), or goes on with the stored ones, which must be the same."""
        held, _ = self.pool.read()
        known = held["state"]
        if known.isEmpty():
            fresh = {"pk_cursor": self._kind, "delivered_pk": self._kind}
            state = tables.select("schema", "table", "fingerprint").withColumns({c: F.lit(None).cast(t) for c, t in fresh.items()}).withColumns({"chunk_seq": F.lit(0).cast("bigint"), "done": F.lit(False)})
            plan = self.spark.createDataFrame([], self.pool.schemas["plan"])
            for schema, table in sorted((r.schema, r.table) for r in tables.collect()):
                facts = chunk_facts(chunk_rows_in_order(self.read(schema, table)[0].select(self.key), [self.key], self.size), self.key)
                plan = plan.union(facts.select(F.lit(schema), F.lit(table), "chunk_seq", F.col("max_pk").cast(self._kind), "final_chunk"))
            self._delivered.write(state)
            empty = {t: self.spark.createDataFrame([], kind) for t, kind in self.pool.schemas.items()}
            self._record(FILL, self._next_fill(), empty | {"state": state, "plan": plan}, self.spark.createDataFrame([], INTERVALS))
        elif not drifted(tables, known).isEmpty():
            raise Halt("snapshot_config_drifted")
        elif not known.join(tables, ["schema", "table", "fingerprint"], "left_anti").isEmpty():
            raise Halt("snapshot_schema_drifted")

    def _next_fill(self) -> int:
        return self.pipeline.progress.runs().get(FILL, -1) + 1

    def deliver(self, batch: DataFrame, batch_id: int) -> None:
        """Delivers a micro-batch of changes, and the chunks whose position it reaches."""
        if not batch.isEmpty():
            self._deliver(batch, self.pipeline.run, batch_id)

    def advance(self) -> bool:
        """Brings chunks that need no more changes; false once all tables are done."""
        state = self.pool.read()[0]["state"]
        if state.where("not done").isEmpty():
            return False
        self._deliver(self.spark.createDataFrame([], self.columns), FILL, self._next_fill())
        return True

    def start(self, changes: DataFrame, checkpoint: str, trigger: dict | None = None):
        return self.pipeline.run_each(changes, checkpoint, self.deliver, trigger)

    def _deliver(self, batch: DataFrame, run: str, batch_id: int) -> None:
        progress = self.pipeline.progress
        if progress.holds(run, batch_id):
            return
        with released(self.spark):
            self._brought(batch, run, batch_id)

    def _brought(self, batch: DataFrame, run: str, batch_id: int) -> None:
        progress, names, name = self.pipeline.progress, self.spark.createDataFrame([], self.columns).columns, f"{run}~{batch_id}"
        if self.pipeline.faults is not None and (found := self.pipeline.faults(batch).first()) is not None:
            raise Halt(found["reason"])

        held, _ = self.pool.read()
        state = {(r.schema, r.table): r.asDict() for r in held["state"].collect()}
        for r in self._delivered.read().collect():
            state[r.schema, r.table]["delivered_pk"] = r.delivered_pk
        # Another run reads from its beginning, so what waits comes again; chunks alone take nothing from the stream.
        first = held["owner"].first()
        owner = run if run != FILL or first is None else first.run
        waiting = held["waiting"] if first is not None and first.run == owner else held["waiting"].limit(0)
        processed = stored(progress.read(), "handoff-processed")
        rest = stored(deduplicated(waiting.select(*names).union(batch.select(*names)), processed), "handoff-fresh")
        total = stored(gtid.union(processed, gtid.from_points(rest)), "handoff-total")
        chunk, part, brought = self._held(held) or self._read(state, held["plan"]), 0, 0

        def send(rows: DataFrame) -> None:
            nonlocal part
            try:
                self.pipeline._in_order(rows, f"{name}.{part}")
            except Exception as fault:
                raise Halt("sink_error") from fault
            part += 1

        while chunk is not None and brought < self.chunks and gtid.uncovered(chunk.captured, total).isEmpty():
            send(self._gated(gtid.members(rest, chunk.captured), state))
            mine = state[chunk.schema, chunk.table]
            mine["delivered_pk"] = chunk.upto
            patiently(lambda: self._delivered.write(self._rows(state)), "snapshot_store_failed")
            send(chunk.rows)
            mine |= {"pk_cursor": chunk.upto, "chunk_seq": mine["chunk_seq"] + 1, "done": chunk.final}
            self.seen.append(measured({"row_count": chunk.rows.count(), "chunk_seq": mine["chunk_seq"] - 1}, {"schema": chunk.schema, "table": chunk.table}))
            rest = stored(gtid.non_members(rest, chunk.captured), "handoff-rest")
            chunk, brought = self._read(state, held["plan"]), brought + 1
        now, later = (rest, rest.limit(0)) if chunk is None else (gtid.members(rest, chunk.captured), stored(gtid.non_members(rest, chunk.captured), "handoff-later"))
        send(self._gated(now, state))
        tables = {"state": self._rows(state), "plan": held["plan"], "waiting": later, "owner": self.spark.createDataFrame([(owner,)], "run string")}
        if chunk is None:
            tables |= {t: self.spark.createDataFrame([], self.pool.schemas[t]) for t in ("chunk", "rows", "captured")}
        else:
            tables |= {"chunk": self.spark.createDataFrame([(chunk.schema, chunk.table, chunk.upto, chunk.final)], self.pool.schemas["chunk"]), "rows": chunk.rows, "captured": chunk.captured}
        self._record(run, batch_id, tables, gtid.subtract(gtid.subtract(total, processed), gtid.from_points(later)))

    def _record(self, run: str, batch_id: int, tables: dict[str, DataFrame], ids: DataFrame) -> None:
        def record() -> None:
            self.pool.write(run, batch_id, tables)
            self.pipeline.progress.record(run, batch_id, ids)

        patiently(record, "checkpoint_write_failed", self.pipeline.retries)

    def _rows(self, state: dict) -> DataFrame:
        names = [c.split()[0] for c in STATE.split(", ")]
        return self.spark.createDataFrame([tuple(r[c] for c in names) for r in state.values()], state_of(self._kind))

    def _gated(self, changes: DataFrame, state: dict) -> DataFrame:
        cursors = self._rows(state).select("table", "pk_cursor", "delivered_pk", "done")
        return gate(allowed(changes, self.pipeline.tables), F.broadcast(cursors), key=self.key)

    def _held(self, held: dict[str, DataFrame]) -> _Chunk | None:
        r = held["chunk"].first()
        return r and _Chunk(r.schema, r.table, r.upto, r.final_chunk, held["rows"], held["captured"])

    def _read(self, state: dict, plan: DataFrame) -> _Chunk | None:
        """The next chunk of the first table that isn't done, stored as it is now with the ids it holds."""
        left = sorted(k for k, r in state.items() if not r["done"])
        if not left:
            return None
        schema, table = left[0]
        mine = state[left[0]]
        bound = plan.where((F.col("schema") == schema) & (F.col("table") == table) & (F.col("chunk_seq") == mine["chunk_seq"])).first()
        rows, captured = self.read(schema, table)
        final = bound is None or bound.final_chunk
        if mine["pk_cursor"] is not None:
            rows = rows.where(F.col(self.key) > mine["pk_cursor"])
        if not final:
            rows = rows.where(F.col(self.key) <= bound.upto)
        fields = self.spark.createDataFrame([], self.columns).schema
        fixed = {"op": "snapshot", "schema": schema, "table": table}
        full = rows.select(*[(F.lit(fixed[f.name]) if f.name in fixed else F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])
        taken, ids = stored(full, "handoff-chunk"), stored(captured.select("source_uuid", "lo", "hi"), "handoff-captured")
        return _Chunk(schema, table, (BEYOND if self._kind == "binary" else (1 << 63) - 1) if final else bound.upto, final, taken, ids)
