"""What is delivered: table filter, deduplication, batches, receipts, current state, and start-up checks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ledgerline.functions import gtid
from ledgerline.functions.ordered import DENSE, ROWS, asof_backward, number_rows
from ledgerline.sources.scratch import discard, stored


def allowed(changes: DataFrame, tables: list[tuple[str, str]] | None) -> DataFrame:
    """The changes of the listed (schema, table) pairs, all if None. The list is configuration, so it becomes a predicate
    that scans can push down, ahead of any decoding."""
    if tables is None:
        return changes
    hit = F.lit(False)
    for schema, name in tables:
        hit = hit | ((F.col("schema") == schema) & (F.col("table") == name))
    return changes.where(hit)


def deduplicated(changes: DataFrame, processed: DataFrame) -> DataFrame:
    """The changes whose transaction the processed set doesn't hold yet."""
    return gtid.non_members(changes, processed)


def count_batches(rows: DataFrame, by: str, at: str, most: int) -> DataFrame:
    """Adds batch, from 0: `most` transactions each, in order."""
    return number_rows(rows, [by], at, "_n").withColumn("batch", F.floor((F.col("_n") - 1) / most).cast("bigint")).drop("_n")


def deadline_batches(rows: DataFrame, by: str, at: str, most: int, flush: int) -> DataFrame:
    """(by, batch_start, batch_end, n): batches that close at `most` entries, or `flush` after the oldest, whichever is first.

    A batch closes after the entry that fills it or comes `flush` after its oldest, and before a pause of `flush`. `at` is
    a number that rises strictly. Where a batch would end is found for every possible start, by lookups ahead in the
    order. A batch goes over at most `most` entries, so only that many may be the first start in a span of ROWS or more; where
    each of these leaves the span is found within it, and which are real by doubling steps over them. Then every span is
    walked by itself.
    """
    placed = stored(number_rows(rows.select(by, F.col(at).cast("bigint").alias("at")), [by], "at", "i"), "batch-order")
    placed = placed.withColumn("_back", -F.col("i"))
    nexts = placed.select(by, (F.col("i") - 1).alias("i"), F.col("at").alias("_next_at"))
    gaps = placed.join(nexts, [by, "i"], "left").where(F.col("_next_at").isNull() | (F.col("_next_at") - F.col("at") >= flush)).select(by, F.col("_back").alias("_gap_back"), F.col("i").alias("gap_i"))
    ahead = asof_backward(placed, gaps, [by], "_back", "_gap_back", ["gap_i"], DENSE)
    due = ahead.withColumn("_due", -(F.col("at") + flush))
    late = placed.select(by, (-F.col("at")).alias("_late"), F.col("i").alias("late_i"))
    ends = asof_backward(due, late, [by], "_due", "_late", ["late_i"]).withColumn("end_i", F.least(F.col("i") + most - 1, F.col("gap_i"), F.coalesce("late_i", F.col("gap_i"))))
    width = max(ROWS, 16 * most)
    ends = stored(ends.select(by, "i", "at", "end_i", F.floor((F.col("i") - 1) / width).cast("bigint").alias("_span")), "batch-ends")
    steps = ends.select(by, "_span", "i", (F.col("end_i") + 1).alias("to"))
    kind = T.StructType([ends.schema[by], *ends.select("i", F.col("i").alias("to")).schema.fields])

    def leaving(part: pa.Table) -> pa.Table:
        """Where the batches that begin with each of the first `most` entries of a span go on after it."""
        i, to = _ordered(part)
        beyond, out = int(i[-1]) + 1, to.tolist()
        for k in range(len(out) - 1, -1, -1):
            if out[k] < beyond:
                out[k] = out[out[k] - int(i[0])]
        n = min(most, len(out))
        return pa.table({by: part.column(by).slice(0, n), "i": i[:n], "to": out[:n]})

    step = stored(steps.groupBy(by, "_span").applyInArrow(leaving, kind), "batch-steps")
    starts, n = step.where("i = 1").select(by, "i"), -1
    while True:
        starts = stored(starts.union(starts.join(step, [by, "i"]).select(by, F.col("to").alias("i"))).distinct(), "batch-starts")
        now = starts.count()
        if now == n:
            break
        n = now
        further = step.select(by, F.col("i").alias("to"), F.col("to").alias("_to"))
        step = stored(step.join(further, [by, "to"], "left").select(by, "i", F.coalesce("_to", "to").alias("to")), "batch-steps")
    discard(step)

    def walked(part: pa.Table) -> pa.Table:
        """The batches that begin in a span, from the one that its first start begins."""
        i, to = _ordered(part)
        heads = part.column("_head").to_numpy(zero_copy_only=False)
        at, first, out = int(i[0]), int(i[0]), []
        if heads.max() > 0:
            at, jumps = int(heads.max()), to.tolist()
            while at - first < len(jumps):
                out.append(at)
                at = jumps[at - first]
        return pa.table({by: pa.repeat(part.column(by)[0], len(out)).cast(part.schema.field(by).type), "i": pa.array(out, pa.int64()), "to": pa.array([int(to[x - first]) for x in out], pa.int64())})

    # Of the starts among the first entries of spans, one is each span's own; the others of it are beyond its end.
    heads = starts.withColumn("_span", F.floor((F.col("i") - 1) / width).cast("bigint")).groupBy(by, "_span").agg(F.min("i").alias("_head"))
    begun = steps.join(heads, [by, "_span"], "left").withColumn("_head", F.coalesce("_head", F.lit(0))).groupBy(by, "_span").applyInArrow(walked, kind)
    begun = stored(begun.select(by, "i", (F.col("to") - 1).alias("end_i")), "batch-begun")
    firsts = begun.join(ends.select(by, "i", F.col("at").alias("batch_start")), [by, "i"])
    return firsts.join(ends.select(by, F.col("i").alias("end_i"), F.col("at").alias("batch_end")), [by, "end_i"]).select(by, "batch_start", "batch_end", (F.col("end_i") - F.col("i") + 1).alias("n"))


def _ordered(part: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of a span's entries in order, without gaps, and where each would go on."""
    i, to = part.column("i").to_numpy(), part.column("to").to_numpy()
    order = np.argsort(i)
    return i[order], to[order]


def latest_state(changes: DataFrame, key: list[str], order: str, columns: list[str], op: str = "op") -> DataFrame:
    """The current row of each key: that of its last change, without keys whose last change deletes them."""
    last = changes.groupBy(*key).agg(F.max_by(F.struct(op, *columns), F.col(order)).alias("_last"))
    return last.where(F.col(f"_last.{op}") != "delete").select(*key, *[F.col(f"_last.{c}").alias(c) for c in columns])


def receipts(changes: DataFrame) -> DataFrame:
    """A ledger of what was delivered, without any value: (gtid, schema, table, op, commit_ts), as far as changes have them."""
    named = [c for c in ("schema", "table") if c in changes.columns]
    return changes.select(F.concat_ws(":", "source_uuid", F.col("gno").cast("string")).alias("gtid"), *named, "op", "commit_ts")


def xid_digest(format_id: Column, gtrid: Column, bqual: Column, namespace: str = "xa.v1") -> Column:
    """SHA-256 of the namespaced, length-prefixed two-phase id, so that no two ids share a digest."""

    def little(n: Column) -> Column:
        digits = F.lpad(F.hex(n.cast("bigint")), 8, "0")
        return F.unhex(F.concat(*[F.substring(digits, at, 2) for at in (7, 5, 3, 1)]))

    def framed(x: Column) -> Column:
        return F.concat(little(F.octet_length(x)), x.cast("binary"))

    return F.sha2(F.concat(F.lit(namespace).cast("binary"), little(format_id), framed(gtrid), framed(bqual)), 256)


def resolve_prepared(prepared: DataFrame, resolutions: DataFrame, recovered: DataFrame) -> DataFrame:
    """(digest, outcome) of every digest seen; each side may name a digest again, which counts once.

    Prepared and resolved: committed or rolled_back. Prepared only: held. Resolved only: advanced if it was found prepared
    at start (`recovered`), else a fault named for the verb. Resolved both ways: conflicting_resolutions. The steps of a
    digest that is used again, in order, are capture.resolve_steps().
    """
    ends = resolutions.groupBy("digest").agg(F.min("verb").alias("verb"), F.max("verb").alias("_other"))
    both = prepared.select("digest").distinct().withColumn("_prepared", F.lit(True)).join(ends, "digest", "full")
    known = both.join(recovered.select("digest").distinct().withColumn("_found", F.lit(True)), "digest", "left")
    outcome = (
        F.when(F.col("verb").isNull(), "held")
        .when(F.col("verb") != F.col("_other"), "conflicting_resolutions")
        .when(F.col("_prepared"), F.when(F.col("verb") == "commit", "committed").otherwise("rolled_back"))
        .when(F.col("_found"), "advanced")
        .otherwise(F.concat(F.lit("xa_"), F.col("verb"), F.lit("_without_prepare")))
    )
    return known.select("digest", outcome.alias("outcome"))


def gap_check(executed: DataFrame, purged: DataFrame, checkpoint: DataFrame, cases: DataFrame, key: str = "case_id") -> DataFrame:
    """(key, verdict) for each case: ok, source_identity_mismatch or data_gap.

    An empty checkpoint is ok. A checkpoint that the server hasn't executed is of another server; one after which the
    server has purged transactions leaves a gap.
    """
    keys = (key, "source_uuid")
    has = checkpoint.select(key).distinct().withColumn("_has", F.lit(True))
    beyond = gtid.subtract(checkpoint, executed, keys).select(key).distinct().withColumn("_beyond", F.lit(True))
    lost = gtid.intersect(gtid.subtract(executed, checkpoint, keys), purged, keys).select(key).distinct().withColumn("_lost", F.lit(True))
    facts = cases.select(key).join(has, key, "left").join(beyond, key, "left").join(lost, key, "left")
    return facts.select(key, F.when(F.col("_has").isNull(), "ok").when(F.col("_beyond"), "source_identity_mismatch").when(F.col("_lost"), "data_gap").otherwise("ok").alias("verdict"))


#: Server settings in the order they are checked, the value each must have, and the reason if not.
PRECONDITIONS = (
    ("binlog_format", "ROW", "binlog_format_not_row"),
    ("binlog_row_image", "FULL", "binlog_row_image_not_full"),
    ("binlog_row_metadata", "FULL", "binlog_row_metadata_not_full"),
    ("binlog_row_value_options", "", "binlog_row_value_options_not_empty"),
    ("gtid_mode", "ON", "gtid_mode_not_on"),
    ("log_bin", "1", "binlog_disabled"),
)
#: What a dump refusal with code 1236 says, and its reason, in the order they are looked for.
REFUSALS = (("checksum", "checksum_negotiation_failed"), ("purged", "data_gap"), ("server_uuid", "server_id_conflict"))


def precondition_fault() -> Column:
    """The first setting that is wrong, as a reason; null if all are right. A missing setting is wrong."""
    out = F.lit(None).cast("string")
    for name, want, reason in reversed(PRECONDITIONS):
        out = F.when(F.col(name).eqNullSafe(F.lit(want)), out).otherwise(F.lit(reason))
    return out


def dump_fault(code: Column, message: Column) -> Column:
    out = F.lit("unrecognized_dump_error")
    for part, reason in reversed(REFUSALS):
        out = F.when(F.contains(message, F.lit(part)), F.lit(reason)).otherwise(out)
    return F.when(code == 1236, out).otherwise(F.concat(F.lit("dump_failed_"), code.cast("string")))


def rank_within(by: list[str], order: list[str]) -> Column:
    return F.row_number().over(Window.partitionBy(*by).orderBy(*order))
