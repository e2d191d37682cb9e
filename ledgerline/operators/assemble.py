"""Transactions from an ordered event stream: forward fill, terminators, order faults, and statement classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.ordered import DENSE, running_total

#: Event kinds that begin, fill and end a transaction.
BEGIN, ROWS, TERMINATORS = "gtid", ("rows",), ("xid", "commit", "ddl", "xa_prepare", "xa_resolve")


def query_kind(sql: Column, begun: Column) -> Column:
    """What a statement event is, given whether its transaction has begun: begin, commit, marker, or ddl (which commits itself)."""
    text = F.upper(F.trim(sql))
    return F.when(text == "COMMIT", "commit").when((text == "BEGIN") | text.startswith("XA "), "begin").when(begun, "marker").otherwise("ddl")


def number_transactions(events: DataFrame, by: str = "source_uuid", at: str = "seq", kind: str = "kind", span: float = DENSE) -> DataFrame:
    """Adds txn_ix, the running count of transaction ids of the source; 0 before its first. span: how wide ROWS rows lie in `at`."""
    return running_total(events, [by], at, F.when(F.col(kind) == BEGIN, 1).otherwise(0), "txn_ix", span)


def assemble(changes: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """(key..., change_count, changes): each transaction's changes in order; one without changes still has its row.

    A transaction is the unit of delivery, so its changes come together; memory follows the largest one.
    """
    change = F.struct(*order)
    return changes.groupBy(*key).agg(
        F.count(F.col(order[0])).alias("change_count"), F.array_sort(F.collect_list(F.when(F.col(order[0]).isNotNull(), change))).alias("changes")
    )


def order_faults(events: DataFrame, by: str = "source_uuid", at: str = "seq", kind: str = "kind", span: float = DENSE) -> DataFrame:
    """(by, at, reason): every event that a well-formed stream can't have; a pipeline checks that there is none.

    Rows or a terminator outside a transaction, and a transaction id while another transaction is still open.
    """
    numbered = number_transactions(events, by, at, kind, span)
    ends = numbered.where(F.col(kind).isin(*TERMINATORS)).groupBy(by, "txn_ix").agg(F.min(at).alias("_end"))
    placed = numbered.join(ends, [by, "txn_ix"], "left")
    outside = (F.col("txn_ix") == 0) | (F.col(at) > F.col("_end"))
    late = placed.select(by, at, F.when(F.col(kind).isin(*ROWS) & outside, "rows_without_transaction").when(F.col(kind).isin(*TERMINATORS) & outside, "terminator_without_transaction").alias("reason"))
    begun = numbered.where(F.col(kind) == BEGIN).select(by, at, "txn_ix")
    open_before = begun.where("txn_ix > 1").withColumn("_before", F.col("txn_ix") - 1).join(ends.select(by, F.col("txn_ix").alias("_before"), F.lit(True).alias("_closed")), [by, "_before"], "left")
    return late.where("reason is not null").union(open_before.where("_closed is null").select(by, at, F.lit("gtid_within_open_transaction")))


def _bare(name: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(name, "^`+|`+$", ""), '^"+|"+$', "")


def classify_ddl(sql: Column, default_schema: Column) -> Column:
    """struct(kind, schema, table) of a statement; other kinds name no table. The statement's text goes no further."""
    words = F.split(F.trim(sql), r"\s+")
    text = F.concat(F.upper(F.array_join(words, " ")), F.lit(" "))
    kind = (
        F.when(F.regexp_like(text, F.lit("^CREATE (TEMPORARY )?TABLE ")), "create_table")
        .when(text.startswith("ALTER TABLE "), "alter_table")
        .when(F.regexp_like(text, F.lit("^DROP (TEMPORARY )?TABLE ")), "drop_table")
        .when(text.startswith("TRUNCATE "), "truncate")
        .otherwise("other")
    )
    skipped = F.regexp_extract(text, r"^(?:CREATE (?:TEMPORARY )?TABLE (?:IF NOT EXISTS )?|ALTER TABLE |DROP (?:TEMPORARY )?TABLE (?:IF EXISTS )?|TRUNCATE TABLE |TRUNCATE )", 0)
    token = F.get(words, F.size(F.split(skipped, " ")) - 1)
    name = F.regexp_replace(F.regexp_replace(F.regexp_extract(token, r"^[^(]*", 0), ";+$", ""), ",+$", "")
    parts = F.split(name, r"\.", 2)
    qualified = F.size(parts) == 2
    named = (kind != "other") & token.isNotNull()
    return F.struct(
        kind.alias("kind"),
        F.when(kind != "other", F.when(named & qualified, _bare(parts[0])).otherwise(default_schema)).alias("schema"),
        F.when(named, _bare(F.element_at(parts, -1))).alias("table"),
    )
