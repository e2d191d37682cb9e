"""Queries over deliveries that follow each other: what a stream carries from one to the next, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import gtid
from ledgerline.operators.delivery import latest_state
from ledgerline.plans.decode_queries import ORACLES as DECODE
from ledgerline.plans.decode_queries import order_files, prepared_order_events, read_orders, recovered_orders
from ledgerline.plans.flow_queries import ORACLES as FLOW
from ledgerline.plans.snapshot_queries import ORACLES as SNAPSHOT
from ledgerline.sources import captured
from ledgerline.sources.changelog import change_log, table
from ledgerline.sources.scratch import discard, scratch_dir, stored
from ledgerline.streaming.assembly import Assembler, CapturedPipeline
from ledgerline.streaming.batching import Batching
from ledgerline.streaming.delivery import Pipeline, Progress
from ledgerline.streaming.handoff import Handoff
from ledgerline.streaming.mirror import MergedMirror

#: Deliveries that a query's log is cut into.
SLICES = 3
LOGGED = "source_uuid string, gno bigint, op string, schema string, table string, k bigint, seq bigint, balance double"


def _folder(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def q47_snapshot_handoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers filled in chunks while the log of their changes comes in slices, both by one writer into one mirror.

    The table is read as it is at the server, which runs ahead of the deliveries, so chunks wait for their position.
    """
    folder = _folder(spark, "handoff")
    log = change_log(spark, sf_dir).select(
        "source_uuid", "gno", "op", F.lit("shop").alias("schema"), F.lit("customer").alias("table"), F.col("pk").alias("k"), "seq", F.col("value").cast("double").alias("balance")
    )
    log = stored(log, "handoff-log")
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("bigint").alias("k"), F.col("c_acctbal").cast("double").alias("balance"))
    end, n = log.agg(F.coalesce(F.max("seq"), F.lit(0)) + 1).first()[0], customers.count()
    at = [0]

    def read(schema: str, name: str) -> tuple[DataFrame, DataFrame]:
        seen = log.where(F.col("seq") < at[0])
        started = customers.select("k", F.lit(-1).cast("bigint").alias("seq"), F.lit("insert").alias("op"), "balance")
        now = latest_state(started.unionByName(seen.select("k", "seq", "op", "balance")), ["k"], "seq", ["balance"])
        return now.withColumn("seq", F.lit(at[0] - 1).cast("bigint")), gtid.from_points(seen)

    progress = Progress(spark, f"{folder}/progress")
    mirror = MergedMirror(f"{folder}/mirror", "k bigint, balance double", ["k"], "seq", progress)
    handoff = Handoff(Pipeline(progress, mirror), folder, read, LOGGED, size=max(1, -(-n // SLICES)), chunks=1)
    handoff.begin(spark.createDataFrame([("shop", "customer", "c")], "schema string, table string, fingerprint string"))
    for i in range(SLICES):
        at[0] = end * min(i + 2, SLICES) // SLICES  # a slice ahead of what is delivered
        handoff.deliver(log.where((F.col("seq") >= end * i // SLICES) & (F.col("seq") < end * (i + 1) // SLICES)), i)
    while handoff.advance():
        pass
    return mirror.state().select(F.col("k").alias("c_custkey"), "balance")


def q48_xa_over_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events of q45 in slices that cut transactions, and prepares from what ends them.

    A resolution that nothing explains halts a stream, so the files of keys 9, 29 and so on, which have no changes, stay out.
    """
    folder = _folder(spark, "assembly")
    events = stored(prepared_order_events(spark, sf_dir).where(F.col("file").cast("bigint") % 20 != 9), "assembly-events")
    progress = Progress(spark, f"{folder}/progress")

    def sink(changes: DataFrame, name: str) -> None:
        changes.select("source_uuid", "gno", "commit_ts", "after").write.mode("overwrite").parquet(f"{folder}/out/{name}")

    whole = Assembler(spark, f"{folder}/pool", progress, [("shop", "orders")], recovered_orders(spark, sf_dir))
    flow = CapturedPipeline(Pipeline(progress, sink), whole)
    for i, (low, high) in enumerate(((0, 3), (3, 6), (6, 1 << 30))):
        flow.deliver(events.where((F.col("seq") >= low) & (F.col("seq") < high)), i)
    discard(events)
    image = F.from_json("after", "id bigint, cents bigint")
    made = spark.read.schema("source_uuid string, gno bigint, commit_ts timestamp, after string").parquet(f"{folder}/out/*")
    return made.select("source_uuid", "gno", F.unix_seconds("commit_ts").alias("committed_at"), image["id"].alias("o_orderkey"), image["cents"].alias("cents"))


def q49_merged_mirror(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current row of each key after many deliveries, from the few tables that the mirror keeps."""
    folder = _folder(spark, "mirror")
    log = stored(change_log(spark, sf_dir).select("source_uuid", "gno", "pk", "seq", "op", "value", "commit_ts"), "mirror-log")
    progress = Progress(spark, f"{folder}/progress")
    mirror = MergedMirror(f"{folder}/tables", "pk bigint, value double, commit_ts timestamp", ["pk"], "seq", progress, buckets=4, fan=3)
    end = log.agg(F.coalesce(F.max("seq"), F.lit(0)) + 1).first()[0]
    parts = 3 * SLICES
    for i in range(parts):
        Pipeline(progress, mirror).deliver(log.where((F.col("seq") >= end * i // parts) & (F.col("seq") < end * (i + 1) // parts)), i)
    return mirror.state()


def q58_stream_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batches of q30, of entries that come in slices which cut batches; at the end the time is past every deadline."""
    folder, flush = _folder(spark, "batching"), 7_200_000_000
    log = stored(change_log(spark, sf_dir).select(F.col("source_uuid").alias("source"), "seq", F.unix_micros(F.col("commit_ts").cast("timestamp")).alias("at")), "batching-log")
    end, late = log.agg(F.coalesce(F.max("seq"), F.lit(0)) + 1, F.coalesce(F.max("at"), F.lit(0))).first()
    kind = "source string, batch_start bigint, batch_end bigint, n bigint"
    batches = Batching(Progress(spark, f"{folder}/progress"), f"{folder}/pool", lambda df, name: df.write.mode("overwrite").parquet(f"{folder}/out/{name}"), 50, flush)
    for i in range(2):
        batches.deliver(log.where((F.col("seq") >= end * i // 2) & (F.col("seq") < end * (i + 1) // 2)), i, late + flush if i else None)
    return spark.read.schema(kind).parquet(f"{folder}/out/*").withColumnRenamed("source", "source_uuid")


def q51_captured_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders from captured files of some thousand each, every file read in ranges by several tasks."""
    folder = _folder(spark, "captured")
    captured.write_files(order_files(spark, sf_dir), folder)
    captured.register(spark)
    return read_orders(spark.read.format("captured_log").option("path", folder).option("splitBytes", 1 << 16).load())


QUERIES = {f.__name__: f for f in (q47_snapshot_handoff, q48_xa_over_batches, q49_merged_mirror, q51_captured_log, q58_stream_batches)}
ORACLES = {
    "q47_snapshot_handoff": SNAPSHOT["q26_snapshot_then_stream_state"],
    "q48_xa_over_batches": DECODE["q45_xa_committed"],
    "q49_merged_mirror": FLOW["q27_latest_state"],
    "q58_stream_batches": FLOW["q30_batches_deadline"],
    "q51_captured_log": DECODE["q44_binary_decode"],
}
