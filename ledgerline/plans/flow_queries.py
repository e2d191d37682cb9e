"""Queries over assembly, delivery and start-up checks, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import gtid
from ledgerline.functions.ordered import DENSE, asof_backward, fill_forward, number_rows
from ledgerline.operators import assemble as asm
from ledgerline.operators import delivery
from ledgerline.plans.gtid_queries import CL, RENDER, islands
from ledgerline.sources.changelog import change_log, table, transactions

#: How an event of the test table stands for an event of a stream, with 1 of 5 left out as in a damaged stream.
KINDS = "CASE WHEN event_type IN ('signup', 'click') THEN 'gtid' WHEN event_type = 'purchase' THEN 'rows' WHEN event_type = 'view' THEN 'xid' ELSE 'marker' END"

#: What a statement about a table may begin with, and its class; how its name may be written, with the schema and table that
#: this names; and what may follow. Every beginning meets every name, and what follows in turn. `@` stands for a row's table.
OPENINGS = (
    ("CREATE TABLE", "create_table"), ("create  table if not exists", "create_table"), ("Create Temporary Table", "create_table"), ("CREATE TEMPORARY TABLE IF NOT EXISTS", "create_table"),
    ("DROP TABLE", "drop_table"), ("drop table if exists", "drop_table"), ("DROP TEMPORARY TABLE IF EXISTS", "drop_table"), ("TRUNCATE", "truncate"), ("truncate\ttable", "truncate"), (" ALTER TABLE", "alter_table"),
)
NAMES = (("@", None, "@"), ("`@`", None, "@"), ("depot.@", "depot", "@"), ("`depot`.`@_2`", "depot", "@_2"), ('"depot"."@"', "depot", "@"))
ENDINGS = {"create_table": ("(k INT)", " (k INT, PRIMARY KEY (k))"), "drop_table": ("", ";", ", crates"), "truncate": ("", ";"), "alter_table": (" ADD COLUMN w INT", "\n DROP COLUMN w")}
OTHERS = ("OPTIMIZE TABLE @", "GRANT SELECT ON depot.@ TO u", "CREATE INDEX i ON @ (k)", "SET x = 'DROP TABLE @'")


def statements() -> list[tuple[str, str, str | None, str | None]]:
    """(sql, kind, schema, table) of every statement that the lists make; without a schema of its own it is in `home`."""
    out = []
    for opening, kind in OPENINGS:
        for k, (name, schema, table_name) in enumerate(NAMES):
            out.append((f"{opening} {name}{ENDINGS[kind][k % len(ENDINGS[kind])]}", kind, schema or "home", table_name))
    return out + [(sql, "other", None, None) for sql in OTHERS] + [("DROP TABLE", "drop_table", "home", None)]


#: How the settings of a server follow from an order, by PRECONDITIONS' names; and what is wrong with each, in their order.
SETTINGS = {
    "binlog_format": "CASE WHEN o_orderkey % 7 = 0 THEN 'MIXED' ELSE 'ROW' END", "binlog_row_image": "CASE WHEN o_custkey % 5 = 0 THEN 'MINIMAL' ELSE 'FULL' END",
    "binlog_row_metadata": "CASE WHEN o_orderkey % 11 <> 0 THEN 'FULL' END", "binlog_row_value_options": "CASE WHEN o_custkey % 13 = 0 THEN 'PARTIAL_JSON' ELSE '' END",
    "gtid_mode": "CASE WHEN o_orderstatus = 'P' THEN 'OFF' ELSE 'ON' END", "log_bin": "CASE WHEN o_orderkey % 17 = 0 THEN '0' ELSE '1' END",
}
#: What a server may say when it refuses, by the remainder of an event's id, with a code of 1236 unless said otherwise.
REFUSED = ("replica can not handle replication events with the checksum", "the source has purged binary logs", "a replica with the same server_uuid", "something else", "access denied", "purged logs and checksum")
OTHER_CODE = (4, 1045)


def values(rows: tuple, names: str) -> str:
    def one(x) -> str:
        return "NULL" if x is None else f"'{x.replace(chr(39), chr(39) * 2)}'" if isinstance(x, str) else str(x)

    return f"(VALUES {', '.join('(' + ', '.join(one(x) for x in r) + ')' for r in rows)}) AS v({names})"


def q11_table_filter_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = change_log(spark, sf_dir).withColumns({"schema": F.lit("app"), "table": F.concat(F.lit("t"), (F.col("pk") % 4).cast("string"))})
    delivered = delivery.allowed(log, [("app", "t0"), ("app", "t3")]).groupBy("source_uuid").agg(F.count(F.lit(1)).alias("delivered"))
    watermark = gtid.render_sources(gtid.from_points(log))
    return watermark.join(delivered, "source_uuid", "left").select("source_uuid", F.coalesce("delivered", F.lit(0)).cast("bigint").alias("delivered"), "gtid_set")


def q12_assemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = asm.assemble(transactions(spark, sf_dir), ["o_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"])
    text = F.array_join(F.transform("changes", lambda c: F.concat_ws("-", *[c[k].cast("string") for k in ("l_linenumber", "l_partkey", "l_suppkey")])), ",")
    return found.select("o_orderkey", "change_count", F.md5(text.cast("binary")).alias("digest"))


def q13_forward_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = change_log(spark, sf_dir).withColumn("gtid", F.when(F.col("gno") % 4 == 1, F.concat_ws(":", "source_uuid", F.col("gno").cast("string"))))
    return fill_forward(log.select("source_uuid", "seq", "gtid"), ["source_uuid"], "seq", "gtid", "filled", DENSE).select("seq", "filled")


def q14_schema_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    epoch = (F.unix_micros(F.col("o_orderdate").cast("timestamp")) / 1_000_000).cast("bigint")
    versions = table(spark, sf_dir, "orders").groupBy("o_custkey", epoch.alias("valid_from")).agg(F.max("o_orderkey").alias("version"))
    events = table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("o_custkey"), (F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000).cast("bigint").alias("at"))
    return asof_backward(events, versions, ["o_custkey"], "at", "valid_from", ["version"]).select("event_id", "version")


def q15_desync_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = change_log(spark, sf_dir).withColumn("kind", F.expr(KINDS))
    return asm.order_faults(events).groupBy("source_uuid", "reason").agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("first_seq"))


def q16_ddl_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = [sql for sql, *_ in statements()]
    name = F.concat(F.lit("t"), F.col("c_custkey").cast("string"))
    sql = F.replace(F.get(F.array(*map(F.lit, told)), (F.col("c_custkey") % len(told)).cast("int")), F.lit("@"), name)
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), sql.alias("sql"))
    return rows.select("id", asm.classify_ddl(F.col("sql"), F.lit("home")).alias("c")).select("id", "c.kind", "c.schema", F.col("c.table").alias("table_name"))


def _xid(key: str):
    return delivery.xid_digest(F.lit(7), F.concat(F.lit("trx-"), F.col(key).cast("string")), F.lit("b"))


def q17_xa_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", _xid("o_orderkey").alias("digest"))
    prepared = orders.where("o_orderkey % 10 <> 9")
    resolutions = orders.where("o_orderstatus <> 'P'").withColumn("verb", F.when(F.col("o_orderstatus") == "F", "commit").otherwise("rollback"))
    recovered = orders.where("o_orderkey % 20 = 9")
    outcome = delivery.resolve_prepared(prepared, resolutions, recovered)
    lines = transactions(spark, sf_dir).groupBy("o_orderkey").agg(F.count("l_linenumber").alias("n"))
    joined = outcome.join(orders, "digest").join(lines, "o_orderkey")
    return joined.groupBy("outcome").agg(F.count(F.lit(1)).alias("n_transactions"), F.sum(F.when(F.col("outcome") == "committed", F.col("n")).otherwise(0)).cast("bigint").alias("n_changes"))


def q18_xa_heldout_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.concat(F.lit("00000000-0000-0000-0000-00000000000"), (F.col("o_custkey") % 3).cast("string")).alias("source_uuid"), "o_orderkey", "o_orderstatus")
    return gtid.from_points(number_rows(orders, ["source_uuid"], "o_orderkey", "gno").where("o_orderstatus <> 'P'"))


def q27_latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery.latest_state(change_log(spark, sf_dir), ["pk"], "seq", ["value", "commit_ts"])


def q28_receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery.receipts(change_log(spark, sf_dir))


def q29_batches_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = delivery.count_batches(change_log(spark, sf_dir), "source_uuid", "seq", 100)
    return rows.groupBy("source_uuid", "batch").agg(F.count(F.lit(1)).alias("n"), F.max("gno").alias("last_gno"))


def q30_batches_deadline(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = change_log(spark, sf_dir).select("source_uuid", F.unix_micros(F.col("commit_ts").cast("timestamp")).alias("micros"))
    return delivery.deadline_batches(rows, "source_uuid", "micros", 50, 7_200_000_000)


def q34_preconditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), *[F.expr(e).alias(n) for n, e in SETTINGS.items()])
    return settings.select("id", F.coalesce(delivery.precondition_fault(), F.lit("ok")).alias("verdict"))


def q35_dump_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = (F.col("event_id") % len(REFUSED)).cast("int")
    said = F.concat_ws(" ", F.lit("error"), F.col("event_id").cast("string"), F.get(F.array(*map(F.lit, REFUSED)), kind))
    code = F.when(kind == OTHER_CODE[0], OTHER_CODE[1]).otherwise(1236)
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), delivery.dump_fault(code, said).alias("verdict"))


def q36_json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint").alias("k"))


def q40_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {
    f.__name__: f
    for f in (q11_table_filter_watermark, q12_assemble, q13_forward_fill, q14_schema_asof, q15_desync_counts, q16_ddl_classify, q17_xa_resolve, q18_xa_heldout_set, q27_latest_state, q28_receipts, q29_batches_count, q30_batches_deadline, q34_preconditions, q35_dump_error, q36_json_props, q40_census)
}

ORACLES = {
    "q11_table_filter_watermark": f"""WITH {CL}, i AS ({islands('SELECT source_uuid, gno FROM cl')}), r AS (SELECT split_part(s, ':', 1) AS source_uuid, s AS gtid_set FROM ({RENDER.format(rows='i')}))
      SELECT source_uuid, (SELECT count(*) FROM cl WHERE cl.source_uuid = r.source_uuid AND pk % 4 IN (0, 3))::BIGINT AS delivered, gtid_set FROM r""",
    "q12_assemble": """SELECT o_orderkey, count(l_orderkey)::BIGINT AS change_count,
        md5(coalesce(string_agg(l_linenumber || '-' || l_partkey || '-' || l_suppkey, ',' ORDER BY l_linenumber, l_partkey, l_suppkey), '')) AS digest
      FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey""",
    "q13_forward_fill": f"""WITH {CL} SELECT seq, last_value(CASE WHEN gno % 4 = 1 THEN source_uuid || ':' || gno END IGNORE NULLS) OVER (PARTITION BY source_uuid ORDER BY seq) AS filled FROM cl""",
    "q14_schema_asof": """WITH v AS (SELECT o_custkey, floor(epoch_us(o_orderdate) / 1000000)::BIGINT AS valid_from, max(o_orderkey) AS version FROM orders GROUP BY 1, 2)
      SELECT event_id, version FROM events e ASOF LEFT JOIN v ON e.user_id = v.o_custkey AND floor(epoch_us(e.ts) / 1000000)::BIGINT >= v.valid_from""",
    "q15_desync_counts": f"""WITH {CL}, k AS (SELECT *, {KINDS} AS kind FROM cl), t AS (SELECT *, sum(CASE WHEN kind = 'gtid' THEN 1 ELSE 0 END) OVER (PARTITION BY source_uuid ORDER BY seq) AS ix FROM k),
      e AS (SELECT *, min(CASE WHEN kind = 'xid' THEN seq END) OVER (PARTITION BY source_uuid, ix) AS ended FROM t),
      f AS (SELECT source_uuid, seq, CASE WHEN kind = 'rows' THEN 'rows_without_transaction' ELSE 'terminator_without_transaction' END AS reason FROM e WHERE kind IN ('rows', 'xid') AND (ix = 0 OR seq > ended)
            UNION ALL SELECT e.source_uuid, e.seq, 'gtid_within_open_transaction' FROM e WHERE kind = 'gtid' AND ix > 1
              AND NOT EXISTS (SELECT 1 FROM e AS p WHERE p.source_uuid = e.source_uuid AND p.ix = e.ix - 1 AND p.kind = 'xid'))
      SELECT source_uuid, reason, count(*)::BIGINT AS n, min(seq) AS first_seq FROM f GROUP BY 1, 2""",
    "q16_ddl_classify": f"""SELECT c_custkey AS id, kind, schema, replace(table_name, '@', 't' || c_custkey) AS table_name
      FROM customer JOIN {values(tuple((i, *c) for i, (_, *c) in enumerate(statements())), 'i, kind, schema, table_name')} ON c_custkey % {len(statements())} = i""",
    "q17_xa_resolve": """WITH o AS (SELECT o_orderkey, (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey) AS n,
        CASE WHEN o_orderstatus = 'P' THEN CASE WHEN o_orderkey % 10 <> 9 THEN 'held' END
             WHEN o_orderkey % 10 <> 9 THEN CASE o_orderstatus WHEN 'F' THEN 'committed' ELSE 'rolled_back' END
             WHEN o_orderkey % 20 = 9 THEN 'advanced' WHEN o_orderstatus = 'F' THEN 'xa_commit_without_prepare' ELSE 'xa_rollback_without_prepare' END AS outcome FROM orders)
      SELECT outcome, count(*)::BIGINT AS n_transactions, sum(CASE WHEN outcome = 'committed' THEN n ELSE 0 END)::BIGINT AS n_changes FROM o WHERE outcome IS NOT NULL GROUP BY 1""",
    "q18_xa_heldout_set": f"""WITH o AS (SELECT '00000000-0000-0000-0000-00000000000' || (o_custkey % 3)::VARCHAR AS source_uuid, o_orderstatus, row_number() OVER (PARTITION BY o_custkey % 3 ORDER BY o_orderkey) AS gno FROM orders)
      {islands("SELECT source_uuid, gno FROM o WHERE o_orderstatus <> 'P'")}""",
    "q27_latest_state": f"WITH {CL}, r AS (SELECT *, row_number() OVER (PARTITION BY pk ORDER BY seq DESC) AS rn FROM cl) SELECT pk, value, commit_ts FROM r WHERE rn = 1 AND op <> 'delete'",
    "q28_receipts": f"WITH {CL} SELECT source_uuid || ':' || gno AS gtid, op, commit_ts FROM cl",
    "q29_batches_count": f"WITH {CL} SELECT source_uuid, ((gno - 1) // 100)::BIGINT AS batch, count(*)::BIGINT AS n, max(gno) AS last_gno FROM cl GROUP BY 1, 2",
    "q30_batches_deadline": f"""WITH RECURSIVE {CL}, t AS (SELECT source_uuid, gno AS i, epoch_us(commit_ts) AS us, lead(epoch_us(commit_ts)) OVER (PARTITION BY source_uuid ORDER BY gno) AS nx FROM cl),
      w AS (SELECT source_uuid, i, us, nx, us AS oldest, 1 AS n, (1 >= 50 OR nx IS NULL OR nx - us >= 7200000000) AS closed FROM t WHERE i = 1
            UNION ALL SELECT t.source_uuid, t.i, t.us, t.nx, CASE WHEN w.closed THEN t.us ELSE w.oldest END, CASE WHEN w.closed THEN 1 ELSE w.n + 1 END,
              (CASE WHEN w.closed THEN 1 ELSE w.n + 1 END >= 50 OR t.us - CASE WHEN w.closed THEN t.us ELSE w.oldest END >= 7200000000 OR t.nx IS NULL OR t.nx - t.us >= 7200000000)
            FROM w JOIN t ON t.source_uuid = w.source_uuid AND t.i = w.i + 1)
      SELECT source_uuid, oldest AS batch_start, us AS batch_end, n::BIGINT AS n FROM w WHERE closed""",
    "q34_preconditions": """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 7 = 0 THEN 'binlog_format_not_row' WHEN o_custkey % 5 = 0 THEN 'binlog_row_image_not_full'
      WHEN o_orderkey % 11 = 0 THEN 'binlog_row_metadata_not_full' WHEN o_custkey % 13 = 0 THEN 'binlog_row_value_options_not_empty' WHEN o_orderstatus = 'P' THEN 'gtid_mode_not_on'
      WHEN o_orderkey % 17 = 0 THEN 'binlog_disabled' ELSE 'ok' END AS verdict FROM orders""",
    "q35_dump_error": """SELECT event_id AS id, CASE event_id % 6 WHEN 0 THEN 'checksum_negotiation_failed' WHEN 1 THEN 'data_gap' WHEN 2 THEN 'server_id_conflict'
      WHEN 3 THEN 'unrecognized_dump_error' WHEN 4 THEN 'dump_failed_1045' ELSE 'checksum_negotiation_failed' END AS verdict FROM events""",
    "q36_json_props": "SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k FROM events",
    "q40_census": "SELECT event_type, count(*)::BIGINT AS n FROM events GROUP BY 1",
}
