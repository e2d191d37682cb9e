"""The initial snapshot: keyset pages, chunks, key choice, fingerprints, and the gate between snapshot and stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.functions import gtid
from ledgerline.functions.ordered import asof_backward, number_rows
from ledgerline.sources.scratch import stored


def chunk_rows(table: DataFrame, key: str, size: int) -> DataFrame:
    """Adds chunk_seq, from 0: `size` rows each in the order of a unique integer key."""
    keyed = number_rows(table.withColumn("_all", F.lit(0)), ["_all"], key, "_n")
    return keyed.withColumn("chunk_seq", F.floor((F.col("_n") - 1) / size).cast("bigint")).drop("_n", "_all")


def chunk_rows_in_order(table: DataFrame, order: list[str], size: int) -> DataFrame:
    """Adds chunk_seq, from 0: `size` rows each in the order of columns of any kind, equal rows in any order.

    Rows are dealt by ranges of the order and numbered in each; one row a range carries how many come before.
    """
    n = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = stored(table.repartitionByRange(n, *order).withColumn("_range", F.spark_partition_id()), "chunk-ranges")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    local = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    placed = dealt.withColumn("_local", local).join(F.broadcast(starts), "_range")
    return placed.withColumn("chunk_seq", F.floor((F.col("_start") + F.col("_local")) / size).cast("bigint")).select(*table.columns, "chunk_seq")


def chunk_facts(chunks: DataFrame, key: str) -> DataFrame:
    """(chunk_seq, row_count, min_pk, max_pk, final_chunk) of each chunk."""
    facts = chunks.groupBy("chunk_seq").agg(F.count(F.lit(1)).alias("row_count"), F.min(key).alias("min_pk"), F.max(key).alias("max_pk"))
    last = facts.agg(F.max("chunk_seq").alias("_last"))
    return facts.crossJoin(F.broadcast(last)).select("chunk_seq", "row_count", "min_pk", "max_pk", (F.col("chunk_seq") == F.col("_last")).alias("final_chunk"))


def after_key(columns: list[str], values: list) -> Column:
    """The rows after a compound key in key order, as a predicate whose first column scans can push down."""
    out, equal = F.lit(False), F.lit(True)
    for name, value in zip(columns, values):
        out = out | (equal & (F.col(name) > F.lit(value)))
        equal = equal & (F.col(name) == F.lit(value))
    return (F.col(columns[0]) >= F.lit(values[0])) & out


def keyset_page(table: DataFrame, columns: list[str], after: list | None, size: int) -> DataFrame:
    """The next `size` rows after a key, with final_page: whether none is left behind them (one row more is read to tell)."""
    rest = table if after is None else table.where(after_key(columns, after))
    page = rest.orderBy(*columns).limit(size + 1)
    more = page.agg((F.count(F.lit(1)) <= size).alias("final_page"))
    return page.orderBy(*columns).limit(size).crossJoin(F.broadcast(more))


def fingerprint(columns: DataFrame, table: str = "table", ordinal: str = "ordinal", name: str = "name", kind: str = "type") -> DataFrame:
    """(table, fingerprint): a digest of each table's columns in order, which any added, dropped or retyped column changes."""
    line = F.struct(F.col(ordinal), F.concat_ws("|", F.col(ordinal).cast("string"), F.col(name), F.col(kind)).alias("line"))
    listed = columns.groupBy(table).agg(F.array_sort(F.collect_list(line)).alias("_lines"))
    return listed.select(table, F.upper(F.sha2(F.array_join(F.transform("_lines", lambda x: x["line"]), "\n"), 256)).alias("fingerprint"))


def choose_key(index_columns: DataFrame, columns: DataFrame) -> DataFrame:
    """(table, index_name, key_columns): the primary key, else the first by name of the unique indexes without a nullable column."""
    known = index_columns.join(columns.select("table", "column_name", "nullable"), ["table", "column_name"])
    each = known.groupBy("table", "index_name").agg(
        F.bool_and(~F.col("nullable")).alias("_sound"), F.bool_and("is_unique").alias("_unique"), F.array_sort(F.collect_list(F.struct("seq_in_index", "column_name"))).alias("_cols")
    )
    usable = each.where("_sound and _unique")
    best = usable.groupBy("table").agg(F.min(F.struct((F.col("index_name") != "PRIMARY").alias("_late"), "index_name", "_cols")).alias("_best"))
    return best.select("table", F.col("_best.index_name").alias("index_name"), F.array_join(F.transform("_best._cols", lambda c: c["column_name"]), ",").alias("key_columns"))


def unwrap_unsigned(value: Column, bits: int) -> Column:
    """The unsigned number that a signed column of so many bits stands for, exact to 64 bits."""
    wide = value.cast("decimal(20,0)")
    return F.when(wide < 0, wide + F.lit(str(2**bits)).cast("decimal(20,0)")).otherwise(wide).cast("decimal(20,0)")


def enum_value(index: Column, members: list[str]) -> Column:
    """The member of an enum's index, the empty text for 0; any other index fails the query."""
    listed = F.array(F.lit(""), *[F.lit(m) for m in members])
    return F.when(index.between(0, len(members)), F.get(listed, index.cast("int"))).otherwise(F.raise_error(F.lit("enum_index_out_of_range")).cast("string"))


def set_value(bitmap: Column, members: list[str]) -> Column:
    """The members of a set's bits, comma-joined in their declared order; a bit beyond them fails the query."""
    chosen = F.array_join(F.filter(F.array(*[F.when(F.shiftright(bitmap, i).bitwiseAND(F.lit(1)) == 1, F.lit(m)) for i, m in enumerate(members)]), lambda x: x.isNotNull()), ",")
    return F.when(F.shiftright(bitmap, len(members)) == 0, chosen).otherwise(F.raise_error(F.lit("set_member_out_of_range")).cast("string"))


def split_key_updates(changes: DataFrame, old: str, new: str) -> DataFrame:
    """Changes as single-key images: image_ix, op and k. An update that moves its key is a delete of the old, then an insert of the new."""
    moved = (F.col("op") == "update") & (F.col(old) != F.col(new))

    def image(ix: int, op: Column, k: str) -> Column:
        return F.struct(F.lit(ix).alias("image_ix"), op.alias("op"), F.col(k).alias("k"))

    single = F.array(image(0, F.col("op"), new))
    images = F.when(moved, F.array(image(0, F.lit("delete"), old), image(1, F.lit("insert"), new))).otherwise(F.when(F.col("op") == "delete", F.array(image(0, F.col("op"), old))).otherwise(single))
    return changes.withColumn("_image", F.explode(images)).withColumns({"image_ix": F.col("_image.image_ix"), "op": F.col("_image.op"), "k": F.col("_image.k")}).drop("_image")


def gate(images: DataFrame, cursors: DataFrame, key: str = "k") -> DataFrame:
    """The images that go on: of tables without a snapshot or with a finished one, and of keys that the sink has already.

    Deletes look at delivered_pk, what the sink may have received; all others at pk_cursor. A null threshold has passed
    nothing. cursors has one row a table.
    """
    joined = images.join(cursors.withColumn("_gated", F.lit(True)), "table", "left")
    threshold = F.when(F.col("op") == "delete", F.col("delivered_pk")).otherwise(F.col("pk_cursor"))
    passes = F.col("_gated").isNull() | F.col("done") | F.coalesce(F.col(key) <= threshold, F.lit(False))
    return joined.where(passes).select(*images.columns)


def ready_chunks(positions: DataFrame, processed: DataFrame, chunk: str = "chunk_seq") -> DataFrame:
    """(chunk, ready): whether the processed set holds all of the position at which a chunk was captured."""
    chunks = positions.select(chunk).distinct()
    captured = gtid.normalize(positions, (chunk, "source_uuid"))
    missing = gtid.uncovered(captured, processed).select(chunk).distinct().withColumn("_missing", F.lit(True))
    return chunks.join(missing, chunk, "left").select(chunk, F.col("_missing").isNull().alias("ready"))


def snapshot_then_stream(table: DataFrame, key: str, columns: list[str], changes: DataFrame, chunks: int, end: int) -> DataFrame:
    """(key, position, op, columns..., origin): all that a sink receives from a snapshot in chunks woven into a stream.

    Chunk c is captured at position floor((c + 1) * end / chunks): its rows as they were then. A change goes on exactly if
    it comes after the capture of the chunk that covers its key: the first whose last key is at or above it, the last chunk
    for keys beyond all, so keys that the table doesn't hold yet are covered too. With an empty table all changes go on.
    changes has key, seq, op and the columns.
    """
    n = table.count()
    size = max(1, -(-n // chunks))
    chunked = chunk_rows(table.select(key, *columns), key, size).withColumn("_captured", F.floor((F.col("chunk_seq") + 1) * F.lit(end) / chunks).cast("bigint"))
    bounds = chunked.groupBy("_captured", "chunk_seq").agg((-F.max(key)).alias("_last_back")).select(F.lit(0).alias("_all"), "_last_back", F.col("_captured").alias("_covered"))
    keys = changes.select(key).distinct().withColumns({"_all": F.lit(0), "_back": -F.col(key)})
    covered = asof_backward(keys, bounds, ["_all"], "_back", "_last_back", ["_covered"])
    final = F.broadcast(bounds.agg(F.max("_covered").alias("_final")))
    placed = changes.join(covered.crossJoin(final).select(key, F.coalesce("_covered", "_final").alias("_at")), key)
    seen = placed.where(F.col("seq") <= F.col("_at")).groupBy(key).agg(F.first("_at").alias("_at"), F.max_by(F.struct("op", *columns), F.col("seq")).alias("_last"))
    rows = chunked.join(seen, key, "full").where(F.col("_last").isNull() | (F.col("_last.op") != "delete"))
    taken = rows.select(key, F.coalesce("_captured", "_at").alias("position"), F.lit("snapshot").alias("op"), *[F.when(F.col("_last").isNull(), F.col(c)).otherwise(F.col(f"_last.{c}")).alias(c) for c in columns], F.lit("snapshot").alias("origin"))
    streamed = placed.where(F.col("_at").isNull() | (F.col("seq") > F.col("_at"))).select(key, F.col("seq").alias("position"), "op", *columns, F.lit("stream").alias("origin"))
    return taken.unionByName(streamed)
