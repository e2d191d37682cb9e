"""From captured files to committed changes: every file is read by itself, as no transaction runs over a file's end."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.operators.assemble import classify_ddl, order_faults
from ledgerline.operators.delivery import xid_digest
from ledgerline.sources import binlog, records
from ledgerline.sources.scratch import stored

ORDER = "_order"


def captured_events(files: DataFrame, tables: list[tuple[str, str]] | None = None) -> DataFrame:
    """The records (records.RECORDS) of files (path, content), payloads expanded, each file read once in its order.

    A statement before its transaction began commits itself. tables, if given, are those whose rows are read. The records are
    stored, so that what reads them doesn't read the files again; discard() deletes them.
    """
    return stored(records.file_records(files, tables), "captured-records")


def told_events(raw: DataFrame, open_: DataFrame | None = None) -> DataFrame:
    """Raw events (file, seq, raw), with those (records.EVENT) that earlier ones left open, as placed_events() takes them."""
    return records.to_read(raw, open_)


def placed_events(told: DataFrame, tables: list[tuple[str, str]] | None = None) -> DataFrame:
    """The records of told events, as a stored table. txn_ix is the running number of transactions in their file."""
    return stored(records.event_records(told, tables), "captured-records")


def capture_faults(events: DataFrame, recovered: DataFrame | None = None) -> DataFrame:
    """(file, seq, reason) of each damaged or unknown event, each break of order and each two-phase end that nothing
    explains; must be empty before anything is delivered."""
    return event_faults(events).union(outcome_faults(prepared_outcomes(events, recovered)))


def event_faults(events: DataFrame) -> DataFrame:
    """(file, seq, reason) of each damaged or unknown event and each break of order. A file that one task reads tells its
    breaks itself; those of a file of several spans are found by the marks it left."""
    marks = events.where("kind = 'mark'").select("file", (F.shiftleft("seq", binlog.INNER_BITS) + F.col("inner")).alias(ORDER), F.col("verb").alias("kind"))
    order = order_faults(marks, by="file", at=ORDER, span=binlog.ORDER_SPAN).select("file", F.shiftright(ORDER, binlog.INNER_BITS).cast("bigint"), "reason")
    return events.where("kind = 'fault'").select("file", "seq", "reason").union(order)


def outcome_faults(outcomes: DataFrame) -> DataFrame:
    """(file, seq, reason) of each step of a two-phase transaction that nothing explains."""
    odd = outcomes.where("outcome in ('xa_prepared_gtid_mismatch', 'xa_commit_without_prepare', 'xa_rollback_without_prepare')")
    return odd.select("file", F.shiftright("at", binlog.INNER_BITS).cast("bigint").alias("seq"), F.col("outcome").alias("reason"))


def prepared_outcomes(events: DataFrame, recovered: DataFrame | None = None) -> DataFrame:
    """(digest, file, at, txn_ix, gtid, prepare_file, prepare_ix, prepare_gtid, ts, outcome) of each step of a two-phase
    transaction, by its digest, as resolve_steps() has it. Files follow each other by name.
    """
    return resolve_steps(two_phase_steps(events), recovered)


def two_phase_steps(events: DataFrame) -> DataFrame:
    """(digest, verb, file, at, txn_ix, gtid, ts) of each prepare, and of each commit or rollback of a prepared transaction."""
    at = F.shiftleft("seq", binlog.INNER_BITS) + F.col("inner")
    return events.where("kind in ('xa_prepare', 'xa_resolve')").select("digest", "verb", "file", at.alias("at"), "txn_ix", "gtid", F.timestamp_seconds("timestamp").alias("ts"))


def resolve_steps(steps: DataFrame, recovered: DataFrame | None = None) -> DataFrame:
    """What each step (digest, verb, file, at, txn_ix, gtid, ts) of two-phase transactions comes to, in the order (file, at).

    A prepare is held until the next step of its digest: a commit or rollback resolves it; the same prepare again is
    repeated; one of another transaction is a fault. A commit or rollback without a prepare is advanced if its digest was
    found prepared at start (recovered: digest), once; else it is a fault named for the verb. Rows of a resolved prepare
    keep the prepare's id, and both ids count as processed from the resolution on.
    """
    found = (recovered if recovered is not None else steps.sparkSession.createDataFrame([], "digest string")).select("digest").distinct().withColumn("_found", F.lit(True))
    ordered = Window.partitionBy("digest").orderBy("file", "at")
    last = F.lag(F.struct("verb", "file", "txn_ix", "gtid")).over(ordered)
    # A repeated prepare counts as the first of its run.
    told = steps.withColumn("_last", last).withColumn("_again", F.coalesce((F.col("verb") == "prepare") & (F.col("_last.verb") == "prepare") & (F.col("gtid") == F.col("_last.gtid")), F.lit(False)))
    first = F.last(F.when(~F.col("_again"), F.struct("file", "txn_ix", "gtid")), ignorenulls=True).over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    following = F.first(F.when(~F.col("_again"), F.col("verb")), ignorenulls=True).over(ordered.rowsBetween(1, Window.unboundedFollowing))
    named = told.withColumns({"_first": first, "_next": following, "_alone": (F.col("verb") != "prepare") & ~F.coalesce(F.col("_last.verb") == "prepare", F.lit(False))})
    numbered = named.withColumn("_nth", F.sum(F.col("_alone").cast("int")).over(ordered.rowsBetween(Window.unboundedPreceding, 0))).join(found, "digest", "left")
    outcome = (
        F.when(F.col("_again"), "repeated").when((F.col("verb") == "prepare") & (F.col("_last.verb") == "prepare"), "xa_prepared_gtid_mismatch")
        .when(F.col("verb") == "prepare", F.when(F.col("_next").isNull() | (F.col("_next") == "prepare"), "held").otherwise("resolved"))
        .when(~F.col("_alone"), F.when(F.col("verb") == "commit", "committed").otherwise("rolled_back"))
        .when(F.col("_found") & (F.col("_nth") == 1), "advanced").otherwise(F.concat(F.lit("xa_"), F.col("verb"), F.lit("_without_prepare")))
    )
    mine = F.col("outcome").isin("committed", "rolled_back")
    return numbered.withColumn("outcome", outcome).select(
        "digest", "file", "at", "txn_ix", "gtid", *[F.when(mine, F.col(f"_first.{c}")).alias(n) for c, n in (("file", "prepare_file"), ("txn_ix", "prepare_ix"), ("gtid", "prepare_gtid"))], "ts", "outcome"
    )


def committed(events: DataFrame, recovered: DataFrame | None = None) -> DataFrame:
    """(file, txn_ix, source_uuid, gno, commit_ts) of each transaction that reached its end; one still open isn't there yet.

    A two-phase transaction is there once its commit was read, with its prepare's id and the commit's time.
    """
    two = prepared_outcomes(events, recovered).where("outcome = 'committed'").select(F.col("prepare_file").alias("file"), F.col("prepare_ix").alias("txn_ix"), F.col("prepare_gtid").alias("gtid"), F.col("ts").alias("commit_ts"))
    return committed_at_once(events).union(two.select("file", "txn_ix", *id_parts("gtid"), "commit_ts"))


def committed_at_once(events: DataFrame) -> DataFrame:
    """(file, txn_ix, source_uuid, gno, commit_ts) of the transactions that ended in one phase."""
    return events.where("kind = 'done'").select("file", "txn_ix", *id_parts("gtid"), F.timestamp_seconds("timestamp").alias("commit_ts"))


def id_parts(gtid: str) -> list[Column]:
    parts = F.split(gtid, ":")
    return [parts[0].alias("source_uuid"), parts[1].cast("bigint").alias("gno")]


def processed_points(events: DataFrame, recovered: DataFrame | None = None) -> DataFrame:
    """(source_uuid, gno) of all transactions that are done: a two-phase one's two ids from its resolution on, none before."""
    return done_points(events, prepared_outcomes(events, recovered))


def done_points(events: DataFrame, outcomes: DataFrame) -> DataFrame:
    """processed_points() by the outcomes (gtid, prepare_gtid, outcome) of its steps. What commits in two phases is resolved."""
    return committed_at_once(events).select("source_uuid", "gno").union(resolved_points(outcomes)).distinct()


def resolved_points(outcomes: DataFrame) -> DataFrame:
    """(source_uuid, gno) of both transactions of each resolution: the one that ends it, and the one it was prepared in."""
    done = outcomes.where("outcome in ('committed', 'rolled_back', 'advanced')")
    return done.select(F.explode(F.array_compact(F.array("gtid", "prepare_gtid"))).alias("_id")).select(*id_parts("_id"))


def committed_changes(events: DataFrame, tables: list[tuple[str, str]] | None = None, recovered: DataFrame | None = None) -> DataFrame:
    """(source_uuid, gno, change_ix, commit_ts, schema, table, op, before, after) of all committed changes of the tables.

    change_ix, a struct of places, orders the changes of a transaction.
    """
    joined = numbered_changes(events, tables).join(committed(events, recovered), ["file", "txn_ix"])
    return joined.select("source_uuid", "gno", "change_ix", "commit_ts", "schema", "table", "op", "before", "after")


def numbered_changes(events: DataFrame, tables: list[tuple[str, str]] | None = None) -> DataFrame:
    """(file, txn_ix, change_ix, schema, table, op, before, after) of all changes of the tables, committed or not. A row event
    that couldn't be read fails the query."""
    changes = events.where("kind = 'change'")
    if tables is not None:
        hit = F.col("schema").isNull()  # without a table map, so it fails below
        for s, t in tables:
            hit = hit | ((F.col("schema") == s) & (F.col("table") == t))
        changes = changes.where(hit)
    sound = F.when(F.col("reason").isNotNull(), F.raise_error(F.col("reason")).cast("boolean")).otherwise(True)
    return changes.where(sound).select("file", "txn_ix", F.struct("seq", "inner", "change_ix").alias("change_ix"), "schema", "table", "op", "before", "after")


def schema_changes(events: DataFrame) -> DataFrame:
    """(source_uuid, gno, kind, schema, table) of each statement that commits itself; its text goes no further."""
    ddl = events.where("kind = 'ddl'").select(*id_parts("gtid"), classify_ddl(F.col("after"), F.col("schema")).alias("_c"))
    return ddl.select("source_uuid", "gno", "_c.kind", "_c.schema", F.col("_c.table").alias("table"))


def stream_files(spark: SparkSession, folder: str) -> DataFrame:
    """Captured files as they come into a folder, for a pipeline that decodes each micro-batch of them."""
    kind = "path string, modificationTime timestamp, length bigint, content binary"
    return spark.readStream.schema(kind).format("binaryFile").option("maxFilesPerTrigger", 64).load(folder).select("path", "content")
