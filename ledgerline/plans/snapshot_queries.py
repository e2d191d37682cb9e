"""Queries over the snapshot and its gate, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import keys
from ledgerline.operators import checks, delivery, snapshot
from ledgerline.plans.gtid_queries import CL
from ledgerline.sources.changelog import change_log, table

MEMBERS = ("crate", "flat pack", "übergroß")
GATED = "CASE pk % 4 WHEN 0 THEN op = 'delete' AND pk <= 90 OR op <> 'delete' AND pk <= 60 WHEN 1 THEN op = 'delete' AND pk <= 40 ELSE true END"


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.chunk_rows(table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), "c_custkey", 128)


def q19_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _customers(spark, sf_dir).select("c_custkey", "chunk_seq")


def q20_final_chunk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.chunk_facts(_customers(spark, sf_dir), "c_custkey")


def q21_max_pk(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = snapshot.chunk_rows(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 4096)
    return snapshot.chunk_facts(orders, "o_orderkey").select("chunk_seq", "row_count", "max_pk", "final_chunk")


KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def q22_keyset_page_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.keyset_page(table(spark, sf_dir, "lineitem").select(*KEY), KEY, [100, 3, 0, 0], 500)


def _cursors(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("t0", 60, 90, False), ("t1", None, 40, False), ("t2", 5, 5, True)], "table string, pk_cursor int, delivered_pk int, done boolean")


def q23_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = change_log(spark, sf_dir).select("seq", "op", F.col("pk").alias("k"), F.concat(F.lit("t"), (F.col("pk") % 4).cast("string")).alias("table"))
    return snapshot.gate(log, _cursors(spark)).select("seq", "op", "k")


def q24_pk_split_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = change_log(spark, sf_dir).select("seq", "op", F.col("pk").alias("old_pk"), F.when((F.col("seq") % 7 == 0) & (F.col("op") == "update"), F.col("pk") + 40).otherwise(F.col("pk")).alias("new_pk"), F.concat(F.lit("t"), (F.col("pk") % 4).cast("string")).alias("table"))
    images = snapshot.split_key_updates(log, "old_pk", "new_pk")
    return snapshot.gate(images, _cursors(spark)).select("seq", "image_ix", "op", "k")


def q26_snapshot_then_stream_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = change_log(spark, sf_dir).select(F.col("pk").alias("c_custkey"), "seq", "op", F.col("value").alias("balance"))
    end = log.agg(F.max("seq")).first()[0] or 0
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_acctbal").alias("balance"))
    received = snapshot.snapshot_then_stream(customers, "c_custkey", ["balance"], log, 8, end)
    # Within a capture position the snapshot row comes first; a change at that very position was part of it.
    return delivery.latest_state(received, ["c_custkey"], "position", ["balance"])


def _index_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as columns of indexes: an order is a table, its lines are columns of the index that their supplier names."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("table"), F.when(F.col("l_suppkey") % 3 == 0, "PRIMARY").otherwise(F.concat(F.lit("ix"), (F.col("l_suppkey") % 3).cast("string"))).alias("index_name"),
        F.col("l_linenumber").alias("seq_in_index"), F.concat_ws("_", F.lit("c"), F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string")).alias("column_name"),
        (F.col("l_suppkey") % 5 != 0).alias("is_unique"), (F.col("l_partkey") % 7 == 0).alias("nullable"),
    )
    return lines.distinct()


def q32_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as columns of tables: number, part and supplier stand for place, name and type."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("table"), F.col("l_linenumber").alias("ordinal"), F.col("l_partkey").cast("string").alias("name"), F.col("l_suppkey").cast("string").alias("type"))
    return snapshot.fingerprint(lines).select(F.col("table").alias("table_name"), "fingerprint")


def q33_pk_introspect(spark: SparkSession, sf_dir: str) -> DataFrame:
    indexes = _index_columns(spark, sf_dir)
    return snapshot.choose_key(indexes.drop("nullable"), indexes.select("table", "column_name", "nullable").distinct()).select(F.col("table").alias("table_name"), "index_name", "key_columns")


def q37_enum_set_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", snapshot.enum_value(F.col("user_id") % 4, list(MEMBERS)).alias("size"), snapshot.set_value(F.col("user_id") % 8, ["a", "b", "c"]).alias("flags")
    )


def q38_unsigned_unwrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    signed = (F.col("o_orderkey") - 7000).cast("bigint")
    return table(spark, sf_dir, "orders").select("o_orderkey", snapshot.unwrap_unsigned(signed, 64).cast("string").alias("wide"), snapshot.unwrap_unsigned(signed, 32).cast("bigint").alias("narrow"))


def q39_canary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the order of keys as text agrees with their order as bytes, per nation."""
    rows = table(spark, sf_dir, "customer").select("c_nationkey", "c_name", F.col("c_name").cast("binary").alias("weight"))
    each = rows.groupBy("c_nationkey").agg(F.array_sort(F.collect_list("c_name")).alias("a"), F.array_sort(F.collect_list(F.struct("weight", "c_name"))).alias("b"))
    return each.select("c_nationkey", (F.col("a") == F.transform("b", lambda x: x["c_name"])).alias("ordered"))


def q41_no_pk(spark: SparkSession, sf_dir: str) -> DataFrame:
    indexes = _index_columns(spark, sf_dir)
    primary = indexes.where("index_name = 'PRIMARY'").select("table").distinct()
    return indexes.select("table").distinct().join(primary, "table", "left_anti").select(F.col("table").alias("table_name"))


def _chunks_by(rows: DataFrame, columns: list[str], size: int) -> DataFrame:
    """(chunk_seq, row_count, final_chunk, and the first and last of the first column) of chunks by one binary key."""
    chunks = snapshot.chunk_rows_in_order(rows.select(columns[0], keys.ordered_key(rows, *columns).alias("k")), ["k"], size)
    ends = chunks.groupBy("chunk_seq").agg(F.min(columns[0]).alias("first"), F.max(columns[0]).alias("last"))
    return snapshot.chunk_facts(chunks, "k").join(ends, "chunk_seq").select("chunk_seq", "row_count", "final_chunk", "first", "last")


def q52_composite_key_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chunks_by(table(spark, sf_dir, "lineitem").select(*KEY), KEY, 1000)


def q53_text_key_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks by a name, which is no number, and a key below it."""
    parts = table(spark, sf_dir, "part").select("p_name", "p_partkey")
    return _chunks_by(parts, ["p_name", "p_partkey"], 100)


def q54_base_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as a catalog: nations stand for schemas, of which four are the server's own."""
    own = F.get(F.array(*map(F.lit, checks.SYSTEM_SCHEMAS)), F.col("c_nationkey").cast("int"))
    schema = F.coalesce(own, F.concat(F.lit("s"), F.col("c_nationkey").cast("string")))
    kind = F.when(F.col("c_custkey") % 3 == 0, "VIEW").otherwise("BASE TABLE")
    catalog = table(spark, sf_dir, "customer").select(schema.alias("schema"), F.concat(F.lit("t"), (F.col("c_custkey") % 500).cast("string")).alias("table"), kind.alias("kind"))
    return checks.base_tables(catalog).select(F.col("schema").alias("schema_name"), F.col("table").alias("table_name"))


def _tables_of(spark: SparkSession, sf_dir: str, status: str) -> DataFrame:
    return table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == status).select(F.lit("s").alias("schema"), F.col("o_custkey").cast("string").alias("table")).distinct()


def q55_table_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with orders that are done stand for the configured tables, those with open ones for the stored."""
    return checks.drifted(_tables_of(spark, sf_dir, "F"), _tables_of(spark, sf_dir, "O")).select(F.col("table").alias("table_name"), "side")


def q56_not_captured(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.not_captured(_tables_of(spark, sf_dir, "F"), _tables_of(spark, sf_dir, "P")).select(F.col("table").alias("table_name"))


def q57_distinct_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = change_log(spark, sf_dir).select(F.when(F.col("op") != "insert", F.col("pk")).alias("before"), F.when(F.col("op") != "delete", F.col("pk") + F.col("seq") % 3).alias("after"))
    return checks.distinct_keys(log, "before", "after")


QUERIES = {
    f.__name__: f
    for f in (q19_chunks, q20_final_chunk, q21_max_pk, q22_keyset_page_composite, q23_gate, q24_pk_split_gate, q26_snapshot_then_stream_state, q32_fingerprint, q33_pk_introspect, q37_enum_set_decode, q38_unsigned_unwrap, q39_canary, q41_no_pk, q52_composite_key_chunks, q53_text_key_chunks, q54_base_tables, q55_table_drift, q56_not_captured, q57_distinct_keys)
}

INDEXED = """SELECT DISTINCT l_orderkey AS t, CASE WHEN l_suppkey % 3 = 0 THEN 'PRIMARY' ELSE 'ix' || (l_suppkey % 3) END AS ix, l_linenumber AS s, 'c_' || l_linenumber || '_' || l_partkey AS col,
  l_suppkey % 5 <> 0 AS u, l_partkey % 7 = 0 AS nullable FROM lineitem"""

ORACLES = {
    "q19_chunks": "SELECT c_custkey, ((row_number() OVER (ORDER BY c_custkey) - 1) // 128)::BIGINT AS chunk_seq FROM customer",
    "q20_final_chunk": """WITH c AS (SELECT c_custkey, ((row_number() OVER (ORDER BY c_custkey) - 1) // 128)::BIGINT AS chunk_seq FROM customer)
      SELECT chunk_seq, count(*)::BIGINT AS row_count, min(c_custkey) AS min_pk, max(c_custkey) AS max_pk, chunk_seq = (SELECT max(chunk_seq) FROM c) AS final_chunk FROM c GROUP BY 1""",
    "q21_max_pk": """WITH c AS (SELECT o_orderkey, ((row_number() OVER (ORDER BY o_orderkey) - 1) // 4096)::BIGINT AS chunk_seq FROM orders)
      SELECT chunk_seq, count(*)::BIGINT AS row_count, max(o_orderkey) AS max_pk, chunk_seq = (SELECT max(chunk_seq) FROM c) AS final_chunk FROM c GROUP BY 1""",
    "q22_keyset_page_composite": """WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE (l_orderkey, l_linenumber, l_partkey, l_suppkey) > (100, 3, 0, 0))
      SELECT *, (SELECT count(*) FROM r) <= 500 AS final_page FROM (SELECT * FROM r ORDER BY 1, 2, 3, 4 LIMIT 500)""",
    "q23_gate": f"WITH {CL} SELECT seq, op, pk AS k FROM cl WHERE {GATED}",
    "q24_pk_split_gate": f"""WITH {CL}, l AS (SELECT *, seq % 7 = 0 AND op = 'update' AS moved, 't' || (pk % 4) AS tbl FROM cl),
      h AS (SELECT seq, 0 AS image_ix, CASE WHEN moved THEN 'delete' ELSE op END AS op, pk AS k, tbl FROM l UNION ALL SELECT seq, 1, 'insert', pk + 40, tbl FROM l WHERE moved)
      SELECT seq, image_ix::INTEGER AS image_ix, op, k FROM h WHERE CASE tbl WHEN 't0' THEN op = 'delete' AND k <= 90 OR op <> 'delete' AND k <= 60 WHEN 't1' THEN op = 'delete' AND k <= 40 ELSE true END""",
    "q26_snapshot_then_stream_state": f"""WITH {CL}, r AS (SELECT *, row_number() OVER (PARTITION BY pk ORDER BY seq DESC) AS rn FROM cl)
      SELECT c_custkey, CASE WHEN r.pk IS NULL THEN c_acctbal ELSE r.value END AS balance FROM customer LEFT JOIN r ON r.pk = c_custkey AND rn = 1 WHERE r.pk IS NULL OR op <> 'delete'""",
    "q32_fingerprint": """SELECT l_orderkey AS table_name, upper(sha256(string_agg(c, chr(10) ORDER BY l_linenumber, c))) AS fingerprint
      FROM (SELECT l_orderkey, l_linenumber, l_linenumber || '|' || l_partkey || '|' || l_suppkey AS c FROM lineitem) GROUP BY 1""",
    "q33_pk_introspect": f"""WITH c AS ({INDEXED}), i AS (SELECT t, ix, string_agg(col, ',' ORDER BY s, col) AS key_columns FROM c GROUP BY 1, 2 HAVING bool_and(u) AND NOT bool_or(nullable))
      SELECT t AS table_name, ix AS index_name, key_columns FROM (SELECT *, row_number() OVER (PARTITION BY t ORDER BY ix <> 'PRIMARY', ix) AS rn FROM i) WHERE rn = 1""",
    "q37_enum_set_decode": """SELECT event_id, CASE user_id % 4 WHEN 0 THEN '' WHEN 1 THEN 'crate' WHEN 2 THEN 'flat pack' ELSE 'übergroß' END AS size,
      array_to_string(list_filter([CASE WHEN user_id % 2 = 1 THEN 'a' END, CASE WHEN user_id // 2 % 2 = 1 THEN 'b' END, CASE WHEN user_id // 4 % 2 = 1 THEN 'c' END], lambda x: x IS NOT NULL), ',') AS flags FROM events""",
    "q38_unsigned_unwrap": "SELECT o_orderkey, (CASE WHEN o_orderkey < 7000 THEN o_orderkey - 7000 + 18446744073709551616::HUGEINT ELSE o_orderkey - 7000 END)::VARCHAR AS wide, CASE WHEN o_orderkey < 7000 THEN o_orderkey - 7000 + 4294967296 ELSE o_orderkey - 7000 END AS narrow FROM orders",
    "q39_canary": "SELECT c_nationkey, list(c_name ORDER BY c_name) = list(c_name ORDER BY encode(c_name)) AS ordered FROM customer GROUP BY 1",
    "q52_composite_key_chunks": """WITH r AS (SELECT l_orderkey, (row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1) // 1000 AS c FROM lineitem)
      SELECT c::BIGINT AS chunk_seq, count(*)::BIGINT AS row_count, c = (SELECT max(c) FROM r) AS final_chunk, min(l_orderkey) AS first, max(l_orderkey) AS last FROM r GROUP BY c""",
    "q53_text_key_chunks": """WITH r AS (SELECT p_name, (row_number() OVER (ORDER BY p_name, p_partkey) - 1) // 100 AS c FROM part)
      SELECT c::BIGINT AS chunk_seq, count(*)::BIGINT AS row_count, c = (SELECT max(c) FROM r) AS final_chunk, min(p_name) AS first, max(p_name) AS last FROM r GROUP BY c""",
    "q54_base_tables": "SELECT DISTINCT 's' || c_nationkey AS schema_name, 't' || (c_custkey % 500) AS table_name FROM customer WHERE c_nationkey > 3 AND c_custkey % 3 <> 0",
    "q55_table_drift": """WITH f AS (SELECT DISTINCT o_custkey::VARCHAR AS t FROM orders WHERE o_orderstatus = 'F'), o AS (SELECT DISTINCT o_custkey::VARCHAR AS t FROM orders WHERE o_orderstatus = 'O')
      SELECT t AS table_name, 'configured' AS side FROM (FROM f EXCEPT FROM o) UNION ALL SELECT t, 'stored' FROM (FROM o EXCEPT FROM f)""",
    "q56_not_captured": "SELECT DISTINCT o_custkey::VARCHAR AS table_name FROM orders WHERE o_orderstatus = 'F' AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')",
    "q57_distinct_keys": f"WITH {CL} SELECT pk AS k FROM cl WHERE op <> 'insert' UNION SELECT pk + seq % 3 FROM cl WHERE op <> 'delete'",
    "q41_no_pk": "SELECT l_orderkey AS table_name FROM lineitem GROUP BY 1 HAVING count(*) FILTER (l_suppkey % 3 = 0) = 0",
}
