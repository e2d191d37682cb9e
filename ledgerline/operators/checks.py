"""Checks before a start: which tables there are, which are captured, and whether options and stored state agree."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Schemas of the server's own tables.
SYSTEM_SCHEMAS = ("mysql", "information_schema", "performance_schema", "sys")
NAME = ["schema", "table"]


def base_tables(catalog: DataFrame) -> DataFrame:
    """(schema, table), in order, of the base tables of a catalog (schema, table, kind) that aren't the server's own."""
    return catalog.where((F.col("kind") == "BASE TABLE") & ~F.col("schema").isin(*SYSTEM_SCHEMAS)).select(*NAME).distinct().orderBy(*NAME)


def pending_tables(state: DataFrame) -> DataFrame:
    """(schema, table) of those not yet done, in the order in which they are filled."""
    return state.where(~F.col("done")).select(*NAME).orderBy(*NAME)


def not_captured(snapshot: DataFrame, captured: DataFrame | None) -> DataFrame:
    """(schema, table) of a snapshot that the stream doesn't capture; must be empty. None captures all."""
    return snapshot.select(*NAME).join(captured, NAME, "left_anti") if captured is not None else snapshot.select(*NAME).where(F.lit(False))


def drifted(configured: DataFrame | None, stored: DataFrame) -> DataFrame:
    """(schema, table, side) of tables that only one of the options and the stored state names; must be empty. None takes
    the stored ones."""
    if configured is None:
        return stored.select(*NAME, F.lit("stored").alias("side")).where(F.lit(False))
    added = configured.select(*NAME).exceptAll(stored.select(*NAME)).withColumn("side", F.lit("configured"))
    return added.union(stored.select(*NAME).exceptAll(configured.select(*NAME)).withColumn("side", F.lit("stored"))).distinct()


def distinct_keys(changes: DataFrame, before: str, after: str) -> DataFrame:
    """(k): each key value that changes hold on either side, once."""
    return changes.select(F.col(before).alias("k")).union(changes.select(F.col(after).alias("k"))).where("k is not null").distinct()


def known_options(options: dict, allowed: Iterable[str]) -> dict:
    """The options, if all are known; a typing error must not silently mean the default."""
    if not set(options) <= set(allowed):
        raise ValueError("unknown_option")
    return options
