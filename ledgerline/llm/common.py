"""Tables, scratch storage and column helpers that the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType
from pyspark.sql.window import Window

from ledgerline.sources.scratch import discard, scratch_dir, stored

__all__ = ["GAP", "SPACES", "WORD", "arrow_map", "bind", "discard", "held_out", "keeping_own", "number_copies", "number_in_order", "schema_with", "scratch_dir", "stored", "table", "words_of"]

#: A word for the operators that split on ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
#: Rows that go to a Python worker at once.
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bind(value: Column, body) -> Column:
    """body(value) with value computed once a row, however often body refers to it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    """The words of a text between ASCII white space; none for null."""
    trimmed = F.trim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(F.length(trimmed) == 0, F.array().cast("array<string>")).otherwise(F.split(trimmed, GAP))


def held_out(doc_id: Column) -> Column:
    """True for the rows whose labels no model may learn from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: StructType | str) -> DataFrame:
    """mapInArrow in batches of at most BATCH_ROWS rows, as texts may be long, and without memory kept after a task.

    Lowers the session's batch size, which is read when the result is run.
    """
    conf = df.sparkSession.conf
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key, "10000")) <= BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from fn(batches)
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def schema_with(df: DataFrame, **kinds: str | DataType) -> StructType:
    """The schema of df with more columns at its end."""
    out = StructType(list(df.schema.fields))
    for name, kind in kinds.items():
        out = out.add(name, kind)
    return out


def keeping_own(docs: DataFrame, added: tuple[str, ...], fn: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """fn(docs), which filters by columns it adds, with the columns that docs had, those of such names as they were."""
    own = {c: f"_own_{c}" for c in docs.columns if c in added}
    kept = fn(docs.withColumnsRenamed(own)).drop(*added)
    return kept.withColumnsRenamed({v: k for k, v in own.items()}).select(*docs.columns)


def number_in_order(df: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Adds position, from 0 without gaps in each group, in the given order.

    Rows are dealt by ranges of (group, order), so a group of any size is spread; only counts a range and group are summed.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = stored(df.repartitionByRange(n, group, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    counts = dealt.groupBy(group, "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col(group).alias("_group"), F.col("_range").alias("_at"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    local = F.row_number().over(Window.partitionBy(group, "_range").orderBy(*order)) - 1
    placed = dealt.withColumn("_local", local)
    return placed.join(starts, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_range") == F.col("_at"))).withColumn("position", (F.col("_start") + F.col("_local")).cast("bigint")).drop("_range", "_local", "_group", "_at", "_start")


def number_copies(rows: DataFrame, key: list[str], rid: str, name: str) -> DataFrame:
    """Adds name, from 0: which of the rows with an equal key a row is; rid is a number that no two rows share.

    Rows of a key are numbered within the spans of rid that Spark gives to partitions, and one row a span carries on.
    """
    dealt = rows.withColumn("_span", F.shiftright(F.col(rid), 33))
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in key]
    counts = dealt.groupBy(*key, "_span").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*key).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.where("_n > 0").select(*[F.col(c).alias(f"_of_{c}") for c in key], F.col("_span").alias("_at"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    local = dealt.withColumn("_local", F.row_number().over(Window.partitionBy(*key, "_span").orderBy(rid)) - 1)
    joined = local.join(starts, reduce(Column.__and__, same) & (F.col("_span") == F.col("_at")))
    return joined.withColumn(name, (F.col("_start") + F.col("_local")).cast("bigint")).select(*rows.columns, name)
