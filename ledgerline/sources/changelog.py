"""Change logs made from the test tables: row changes of `events`, transactions of `orders` and `lineitem`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.ordered import DENSE, number_rows

#: The sources' uuid without its last digit, and how many sources there are.
UUID_HEAD, SOURCES = "00000000-0000-0000-0000-00000000000", 3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(seq, source_uuid, gno, pk, op, commit_ts, value, event_type): one single-change transaction an event, in the order of seq."""
    rows = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"),
        F.concat(F.lit(UUID_HEAD), (F.col("user_id") % SOURCES).cast("string")).alias("source_uuid"),
        F.col("user_id").alias("pk"),
        F.when(F.col("event_type") == "signup", "insert").when(F.col("event_type") == "error", "delete").otherwise("update").alias("op"),
        F.col("ts").alias("commit_ts"), "value", "event_type",
    )
    return number_rows(rows, ["source_uuid"], "seq", "gno", DENSE)


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_orderkey, o_orderstatus, l_linenumber, l_partkey, l_suppkey, l_quantity): changes of a transaction an order.

    An order without lines has one row with null line columns: a transaction without changes.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left").drop("l_orderkey")
