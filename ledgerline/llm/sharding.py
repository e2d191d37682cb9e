"""Shards by jump consistent hashing: no ring table, and adding a shard moves only rows that go into it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Fixed values of the published jump hash: the multiplier of its generator, and how often a key may jump at most here.
#: A key jumps about ln(shards) times; more than 128 jumps at any shard count has a chance below 1e-40, and fails the query.
MULTIPLIER = 2862933555777941757
MOST_JUMPS = 128


def _step(state: Column, n: int) -> Column:
    two_64 = F.lit(str(2**64)).cast("decimal(38,0)")
    key = (state["key"] * F.lit(MULTIPLIER).cast("decimal(19,0)") + F.lit(1)).cast("decimal(38,0)") % two_64
    key = key.cast("decimal(20,0)")
    high = F.floor(key / F.lit(2**33)).cast("double") + 1.0
    after = F.struct(
        key.alias("key"),
        state["at"].alias("shard"),
        F.floor((state["at"] + 1).cast("double") * (F.lit(float(2**31)) / high)).cast("bigint").alias("at"),
    )
    return F.when(state["at"] < n, after).otherwise(state)


def jump_shard(key: Column, n: int) -> Column:
    """The shard, 0 to n - 1, of a 64-bit integer key; a null key counts as 0."""
    key = F.coalesce(key.cast("bigint"), F.lit(0)).cast("decimal(20,0)")
    unsigned = F.when(key < 0, key + F.lit(str(2**64)).cast("decimal(20,0)")).otherwise(key).cast("decimal(20,0)")
    start = F.struct(unsigned.alias("key"), F.lit(-1).cast("bigint").alias("shard"), F.lit(0).cast("bigint").alias("at"))
    end = F.aggregate(F.sequence(F.lit(1), F.lit(min(n, MOST_JUMPS))), start, lambda s, _: _step(s, n))
    checked = F.aggregate(
        F.array(end), F.lit(-1).cast("bigint"),
        lambda _, s: F.when(s["at"] >= n, s["shard"]).otherwise(F.raise_error(F.lit("jump hash did not settle")).cast("bigint")),
    )
    return checked.cast("int")


def assign_shards(df: DataFrame, shards: int = 8, key: str = "doc_id") -> DataFrame:
    """Adds shard and grown_shard (the shard with one shard more) to every row, without a shuffle.

    A null key is key 0, equal keys share a shard, and columns of those names are replaced. An empty table stays empty.
    """
    return df.withColumns({"shard": jump_shard(F.col(key), shards), "grown_shard": jump_shard(F.col(key), shards + 1)})


def number_slots(rows: DataFrame, group: str, order: list[str], spread: Column, buckets: int = 2048) -> DataFrame:
    """Numbers the rows of each group from 0 without gaps, in the order of a bucket (`spread` modulo buckets), then `order`.

    Equal rows are counted before the shuffle and come back with consecutive slots, so that neither a large group nor
    many copies of a row meet in one task; only bucket totals, at most `buckets` a group, are summed in order.
    """
    once = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_copies"))
    once = once.withColumn("_bucket", F.pmod(spread, F.lit(buckets)).cast("int"))
    totals = rows.withColumn("_bucket", F.pmod(spread, F.lit(buckets)).cast("int")).groupBy(group, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(group, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy(group, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = once.withColumn("_within", F.coalesce(F.sum("_copies").over(within), F.lit(0)))
    first = F.col("_start") + F.col("_within")
    return placed.join(starts, [group, "_bucket"]).select(
        *rows.columns, F.explode(F.sequence(first, first + F.col("_copies") - 1)).alias("slot")
    )


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """One row per document: its size in bytes plus 1, checksum, law, shard, slot in the shard, and shard after growth.

    Null and empty texts have size 1 and checksum 0; repeated rows get consecutive slots of one shard.
    """
    narrow = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    spread = F.coalesce(F.col("doc_id") % 2048, F.lit(0)) + F.col("text_crc32")
    slots = number_slots(assign_shards(narrow, shards), "shard", ["doc_id", "text_crc32", "size"], spread)
    return slots.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
