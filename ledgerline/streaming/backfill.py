"""The snapshot as it goes on: its state in a table, and chunks delivered between two marks, so that it resumes where it broke off."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.checks import drifted, pending_tables
from ledgerline.operators.snapshot import after_key, chunk_facts, chunk_rows_in_order
from ledgerline.sources.scratch import stored
from ledgerline.streaming.delivery import Halt, _folder, _names, measured, patiently

STATE = "schema string, table string, fingerprint string, pk_cursor bigint, delivered_pk bigint, chunk_seq bigint, done boolean"


def state_of(key: str) -> str:
    """The schema of a snapshot's state, with cursors of the kind of its keys."""
    return STATE.replace("_cursor bigint", f"_cursor {key}").replace("_pk bigint", f"_pk {key}")


@dataclass
class SnapshotStore:
    """One row a table: how far its snapshot is. Each state is a version of its own; the last that was written whole counts,
    and one that was cut off is written over."""

    spark: SparkSession
    path: str
    key: str = "bigint"  # the kind of the keys: that, or binary for keys of several columns (functions.keys)

    def read(self) -> DataFrame:
        versions, kind = self._versions(), state_of(self.key)
        return self.spark.createDataFrame(self.spark.read.schema(kind).parquet(f"{self.path}/v{versions[-1]}").collect(), kind) if versions else self.spark.createDataFrame([], kind)

    def _versions(self) -> list[int]:
        return sorted(int(n[1:]) for n in _names(self.spark, self.path))

    def write(self, state: DataFrame) -> None:
        versions = self._versions()
        n = versions[-1] + 1 if versions else 0
        state.select("schema", "table", "fingerprint", "pk_cursor", "delivered_pk", "chunk_seq", "done").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/v{n}")
        for old in versions[:-1]:
            fs, place = _folder(self.spark, f"{self.path}/v{old}")
            fs.delete(place, True)

    def put(self, schema: str, table: str, **values: object) -> None:
        """Sets columns of a table's row."""
        mine = (F.col("schema") == schema) & (F.col("table") == table)
        self.write(self.read().withColumns({c: F.when(mine, F.lit(v)).otherwise(F.col(c)) for c, v in values.items()}))

    def cursors(self) -> DataFrame:
        """What the gate between snapshot and stream looks at."""
        return self.read().select("table", "pk_cursor", "delivered_pk", "done")


@dataclass
class Backfill:
    """Delivers tables chunk by chunk, in the order of a unique key of the store's kind, to a sink that replaces rows by key.

    Before a chunk goes to the sink its last key is stored as delivered_pk, after it as pk_cursor. A snapshot that breaks
    off between the two reads that chunk again, and a delete of a key that the sink may have already still goes on.
    """

    store: SnapshotStore
    sink: Callable[[DataFrame, str], None]
    size: int = 4096
    seen: list[dict] = field(default_factory=list)
    _plans: dict[tuple[str, str], DataFrame] = field(default_factory=dict)

    def begin(self, tables: DataFrame) -> None:
        """Starts with tables (schema, table, fingerprint), or goes on with the stored ones, which must be the same."""
        stored = self.store.read()
        if stored.isEmpty():
            fresh = {"pk_cursor": self.store.key, "delivered_pk": self.store.key}
            self.store.write(tables.select("schema", "table", "fingerprint").withColumns({c: F.lit(None).cast(t) for c, t in fresh.items()}).withColumns({"chunk_seq": F.lit(0).cast("bigint"), "done": F.lit(False)}))
        elif not drifted(tables, stored).isEmpty():
            raise Halt("snapshot_config_drifted")
        elif not stored.join(tables, ["schema", "table", "fingerprint"], "left_anti").isEmpty():
            raise Halt("snapshot_schema_drifted")
        self.seen.append(measured({"table_count": tables.count()}, {"kind": "started"}))

    def step(self, read: Callable[[str, str], tuple[DataFrame, str]]) -> bool:
        """Delivers the next chunk of the first table that isn't done; false when all are. read gives a table and its key."""
        first = pending_tables(self.store.read()).first()
        if first is None:
            return False
        schema, table = first
        rows, key = read(schema, table)
        state = self.store.read().where((F.col("schema") == schema) & (F.col("table") == table)).first()
        rest = rows if state.pk_cursor is None else rows.where(after_key([key], [state.pk_cursor]))
        upto, last = self._next(schema, table, rest, key, state.pk_cursor)
        page = (rest if last else rest.where(F.col(key) <= F.lit(upto))).persist()
        try:
            facts = page.agg(F.count(F.lit(1)).alias("n"), F.max(key).alias("top")).first()
            if not facts.n:
                self.store.put(schema, table, **({"done": True} if last else {"pk_cursor": upto}))
                return True
            top = facts.top if last else upto
            patiently(lambda: self.store.put(schema, table, delivered_pk=top), "snapshot_store_failed")
            try:
                self.sink(page.withColumn("op", F.lit("snapshot")), f"{schema}.{table}~{state.chunk_seq}")
            except Exception as fault:
                raise Halt("snapshot_sink_error") from fault
            patiently(lambda: self.store.put(schema, table, pk_cursor=top, chunk_seq=state.chunk_seq + 1, done=last), "snapshot_store_failed")
            self.seen.append(measured({"row_count": facts.n, "chunk_seq": state.chunk_seq}, {"schema": schema, "table": table}))
            return True
        finally:
            page.unpersist()

    def _next(self, schema: str, table: str, rest: DataFrame, key: str, after: object) -> tuple[object, bool]:
        """Where the next chunk ends, and whether it is the last, which has no end.

        The ends of all chunks are planned in one pass over the keys that are left, when a table is begun or gone on with; a
        chunk is then a range of keys, which scans can push down.
        """
        if (schema, table) not in self._plans:
            self._plans[schema, table] = stored(chunk_facts(chunk_rows_in_order(rest.select(key), [key], self.size), key).select("max_pk"), "backfill-plan")
        plan = self._plans[schema, table]
        ahead = plan if after is None else plan.where(F.col("max_pk") > F.lit(after))
        found = ahead.agg(F.min("max_pk").alias("upto"), F.count(F.lit(1)).alias("left")).first()
        return found.upto, found.left <= 1

    def run(self, read: Callable[[str, str], tuple[DataFrame, str]]) -> None:
        while self.step(read):
            pass
