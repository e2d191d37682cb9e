"""A mirror that is merged: the current row of each key in a bounded number of tables, however many deliveries there were."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ledgerline.streaming.delivery import Progress, _folder, _names

#: What the manifest lists: tables by level, with the first and last delivery in each, by the order they came in.
MANIFEST = "level int, name string, first bigint, last bigint"


@dataclass
class MergedMirror:
    """A sink that keeps the last change of each key, in levels of tables that are merged as deliveries come in.

    A delivery writes one table: the last change of each of its keys, by `order`, dealt by a hash of the key to `buckets`
    partitions of the table, so that a look-up of keys reads their buckets only. Between deliveries the later one wins.

    Once `fan` recorded deliveries are there they are merged into one table of level 1, `fan` of those into one of level 2,
    and so on, so a key's change is written log(deliveries) times, and a reader meets fewer than `fan` tables a level.
    Deleted keys are dropped only where nothing older is left. What is merged is listed in a manifest; a new version of it,
    once it is whole, replaces the last at once. Tables that it names no more are deleted a merge later.

    Only recorded deliveries are read; one that comes again before it was recorded writes its table anew. One pipeline at
    a time writes.
    """

    path: str
    schema: str  # of the rows: key and other columns
    key: list[str]
    order: str
    progress: Progress
    buckets: int = 16
    fan: int = 8

    @property
    def spark(self) -> SparkSession:
        return self.progress.spark

    @cached_property
    def _fields(self) -> StructType:
        return self.spark.createDataFrame([], self.schema).schema

    @cached_property
    def _others(self) -> list[str]:
        return [f.name for f in self._fields if f.name not in self.key]

    @cached_property
    def _kinds(self) -> StructType:
        """Of a table: the rows, how each came to be, and the bucket."""
        return StructType([*self._fields, StructField("op", StringType()), StructField("bucket", IntegerType())])

    def __call__(self, changes: DataFrame, name: str) -> None:
        """Writes a delivery's changes (key, order, op, columns). Its name is `run~batch`, or `run~batch.step` of several."""
        delivery, _, step = name.partition(".")
        came = self._came()
        if step in ("", "0"):
            self._merge()
            for other, number in came.items():  # what a first try left, which was never recorded
                if other.partition(".")[0] == delivery:
                    self._delete(f"came/{number:012}~{other}")
        if changes.isEmpty():
            return
        number = 1 + max([*came.values(), *(r["last"] for r in self._manifest()[1])], default=0)
        typed = changes.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self._fields], "op", F.col(self.order).alias("_at"))
        self._last(typed).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/came/{number:012}~{name}")

    def _last(self, rows: DataFrame) -> DataFrame:
        """The last row of each key by _at."""
        kept = rows.groupBy(*self.key).agg(F.max_by(F.struct("op", *self._others), F.col("_at")).alias("_last"))
        bucket = F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")
        return kept.select(*self.key, *[F.col(f"_last.{c}").alias(c) for c in (*self._others, "op")], bucket.alias("bucket")).select(*self._kinds.names)

    def _came(self) -> dict[str, int]:
        """The order of each delivery that was written; the last writing of a name counts."""
        return {n.partition("~")[2]: int(n.partition("~")[0]) for n in sorted(_names(self.spark, f"{self.path}/came"))}

    def _recorded(self, after: int) -> list[tuple[int, str]]:
        """(order, folder) of the recorded deliveries after one, in order."""
        upto = self.progress.runs()
        out = []
        for name, number in self._came().items():
            run, _, batch = name.rpartition("~")
            if number > after and int(batch.partition(".")[0]) <= upto.get(run, -1):
                out.append((number, f"came/{number:012}~{name}"))
        return sorted(out)

    def _manifest(self) -> tuple[int, list[dict]]:
        versions = sorted(int(n[1:]) for n in _names(self.spark, f"{self.path}/manifest"))
        if not versions:
            return 0, []
        return versions[-1], [r.asDict() for r in self.spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest/v{versions[-1]}").collect()]

    def _merge(self) -> None:
        """Merges while a level has `fan` tables. One that was left unrecorded stays behind: it comes again under a later number."""
        version, tables = self._manifest()
        merged = max((r["last"] for r in tables), default=0)
        ready = self._recorded(merged)
        levels: dict[int, list[dict]] = {}
        for r in tables:
            levels.setdefault(r["level"], []).append(r)
        if len(ready) < self.fan:
            return
        named = {r["name"] for r in tables}
        garbage = [f"merged/{n}" for n in _names(self.spark, f"{self.path}/merged") if f"merged/{n}" not in named]
        garbage += [f"came/{number:012}~{name}" for name, number in self._came().items() if number <= merged]
        new = self._merged([{"name": name, "last": n} for n, name in ready], bottom=not tables)
        levels.setdefault(1, []).append({"level": 1, "name": new, "first": ready[0][0], "last": ready[-1][0]})
        level = 1
        while len(levels.get(level, [])) >= self.fan:
            parts = sorted(levels.pop(level), key=lambda r: r["first"])
            bottom = not any(r["first"] < parts[0]["first"] for rows in levels.values() for r in rows)
            new = self._merged(parts, bottom)
            levels.setdefault(level + 1, []).append({"level": level + 1, "name": new, "first": parts[0]["first"], "last": parts[-1]["last"]})
            level += 1
        now = [(r["level"], r["name"], r["first"], r["last"]) for rows in levels.values() for r in rows]
        self.spark.createDataFrame(now, MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/v{version + 1}")
        for name in (*garbage, f"manifest/v{version - 1}"):
            self._delete(name)

    def _merged(self, parts: list[dict], bottom: bool) -> str:
        """Writes one table of several, in their order, and returns its name."""
        rows = self._last(self._union(parts))
        name = f"merged/{uuid.uuid4().hex}"
        (rows.where("op <> 'delete'") if bottom else rows).repartition("bucket").write.partitionBy("bucket").parquet(f"{self.path}/{name}")
        return name

    def _union(self, parts: list[dict]) -> DataFrame:
        return reduce(DataFrame.union, [self.spark.read.schema(self._kinds).parquet(f"{self.path}/{r['name']}").select(*self._kinds.names).withColumn("_at", F.lit(r["last"])) for r in parts])

    def _delete(self, name: str) -> None:
        fs, place = _folder(self.spark, f"{self.path}/{name}")
        fs.delete(place, True)

    def _tables(self) -> Iterator[dict]:
        """Every table that counts, oldest first."""
        tables = self._manifest()[1]
        merged = max((r["last"] for r in tables), default=0)
        yield from sorted(tables, key=lambda r: r["first"])
        yield from ({"name": name, "last": n} for n, name in self._recorded(merged))

    def table_count(self) -> int:
        return len(list(self._tables()))

    def state(self) -> DataFrame:
        """The current rows, in the columns of the schema."""
        parts = list(self._tables())
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        return self._last(self._union(parts)).where("op <> 'delete'").select(*self._fields.names)

    def lookup(self, keys: DataFrame) -> DataFrame:
        """The current rows of some keys, from their buckets only."""
        parts = list(self._tables())
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        typed = keys.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self._fields if f.name in self.key]).distinct()
        wanted = typed.withColumn("bucket", F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int"))
        inside = [r.bucket for r in wanted.select("bucket").distinct().collect()]  # at most `buckets` numbers
        rows = self._union(parts).where(F.col("bucket").isin(inside)).join(wanted, ["bucket", *self.key], "left_semi")
        return self._last(rows).where("op <> 'delete'").select(*self._fields.names)
