"""Quotation linking: nested quotes are parsed, hashed and joined to the messages they come from; replies follow what they quote."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.llm.common import SPACES, bind, discard, number_in_order, stored

#: Turns of a conversation that are searched together for the last message with a passage.
SPAN = 1024
#: Classes of characters only, so that no depth of marks and no run of empty lines makes the matcher recurse.
_MARK = r"^[ \t>]*>"
_EMPTY_LINES = r"\n[ \t\r\n]*\n[ \t]*"


def _level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, f"({_MARK})", 1), r"[^>]", ""))


def passages(text: Column) -> Column:
    """Runs of lines of one quote level, as array<struct<level, lines>>; level 0 is the message's own. Null gives none."""
    lines = F.transform(F.split(text, r"\r?\n", -1), lambda x: F.struct(_level(x).alias("level"), F.trim(F.regexp_replace(x, _MARK, "")).alias("body"), x.alias("raw")))

    def runs(rows: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(rows) - 1), lambda i: (i == 0) | (F.get(rows, i)["level"] != F.get(rows, i - 1)["level"]))
        return bind(starts, lambda s: F.transform(s, lambda at, k: _run(rows, at, F.coalesce(F.get(s, k + 1), F.size(rows)))))

    return F.when(text.isNull(), F.array().cast("array<struct<level:int,lines:array<string>,raw:array<string>>>")).otherwise(bind(lines, runs))


def _run(rows: Column, at: Column, end: Column) -> Column:
    part = F.slice(rows, at + 1, end - at)
    return F.struct(F.get(rows, at)["level"].alias("level"), F.transform(part, lambda r: r["body"]).alias("lines"), F.transform(part, lambda r: r["raw"]).alias("raw"))


def normalised(text: Column) -> Column:
    """Letters and digits in lower case, with one blank between runs of them."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def own_text(parts: Column) -> Column:
    """The lines without a quote mark, as they are, trimmed at both ends."""
    own = F.flatten(F.transform(F.filter(parts, lambda p: p["level"] == 0), lambda p: p["raw"]))
    return F.trim(F.array_join(own, "\n"), F.lit(SPACES))


def _pieces(whole: Column, lines: Column) -> Column:
    """What a passage is known by: its whole text, its paragraphs and its lines, once each, normalised and not empty."""
    paragraphs = F.transform(F.split(whole, _EMPTY_LINES), normalised)
    return F.filter(F.array_distinct(F.concat(F.array(normalised(whole)), paragraphs, F.transform(lines, normalised))), lambda x: F.length(x) > 0)


def _keys(pieces: Column) -> Column:
    return F.transform(pieces, lambda x: F.struct(F.md5(x.cast("binary")).alias("hash"), F.length(x).alias("chars")))


def quote_links(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, level, origin_turn, chars): where each quote level of a message comes from.

    The origin of a quoted passage is the last earlier message of the conversation whose own text holds it whole, as a
    paragraph or as a line; where the passages of a level come from several, that with the most characters counts, and of
    those alike the latest. Turns are searched in spans, with the last holder in earlier spans carried over, so that a
    passage that every message repeats doesn't meet in one task.
    """
    parsed = messages.select("conv_id", "turn", passages(F.col("text")).alias("_parts"))
    own = parsed.select("conv_id", "turn", F.explode(_keys(_pieces(own_text(F.col("_parts")), F.split(own_text(F.col("_parts")), r"\r?\n", -1)))).alias("_key"))
    holders = own.select("conv_id", F.col("_key.hash").alias("hash"), F.col("turn"))
    each = parsed.select("conv_id", "turn", F.explode(F.filter("_parts", lambda p: p["level"] > 0)).alias("_quote"))
    quotes = each.select("conv_id", "turn", F.col("_quote.level").alias("level"), F.explode(_keys(_pieces(F.array_join("_quote.lines", "\n"), F.col("_quote.lines")))).alias("_key"))
    quotes = quotes.select("conv_id", "turn", "level", F.col("_key.hash").alias("hash"), F.col("_key.chars").alias("chars"))

    span = F.floor(F.col("turn") / SPAN).cast("bigint")
    told = stored(
        holders.distinct().select("conv_id", "hash", span.alias("span"), "turn", F.lit(None).cast("int").alias("level"), F.lit(None).cast("int").alias("chars"), F.col("turn").alias("held"))
        .union(quotes.select("conv_id", "hash", span.alias("span"), "turn", "level", "chars", F.lit(None).cast(messages.schema["turn"].dataType)))
        .where(F.col("conv_id").isNotNull() & F.col("turn").isNotNull()),
        "quote-keys",
    )
    asked = told.where("level is not null").select("conv_id", "hash").distinct()
    told = told.join(asked, ["conv_id", "hash"], "left_semi")
    spans = told.groupBy("conv_id", "hash", "span").agg(F.max("held").alias("_last"))
    carried = spans.withColumn("_before", F.max("_last").over(Window.partitionBy("conv_id", "hash").orderBy("span").rowsBetween(Window.unboundedPreceding, -1))).drop("_last")
    within = Window.partitionBy("conv_id", "hash", "span").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    found = told.withColumn("_here", F.max("held").over(within)).where("level is not null").join(carried, ["conv_id", "hash", "span"], "left")
    held = found.select("conv_id", "turn", "level", "chars", F.coalesce("_here", "_before").alias("origin_turn")).where("origin_turn is not null")
    by_origin = held.groupBy("conv_id", "turn", "level", "origin_turn").agg(F.sum("chars").alias("chars"))
    best = by_origin.groupBy("conv_id", "turn", "level").agg(F.max(F.struct("chars", "origin_turn")).alias("_best"))
    return best.select("conv_id", "turn", "level", F.col("_best.origin_turn").alias("origin_turn"), F.col("_best.chars").alias("chars"))


def _threads(parents: DataFrame) -> DataFrame:
    """(conv_id, turn, thread_turn, depth) for messages with a parent, by doubling: each round looks twice as far back."""
    now = stored(parents.select("conv_id", "turn", F.col("parent_turn").alias("up"), F.lit(1).cast("bigint").alias("depth")), "quote-threads")
    total = -1
    while True:
        further = now.select("conv_id", F.col("turn").alias("up"), F.col("up").alias("_up"), F.col("depth").alias("_more"))
        then = stored(now.join(further, ["conv_id", "up"], "left").select("conv_id", "turn", F.coalesce("_up", "up").alias("up"), (F.col("depth") + F.coalesce("_more", F.lit(0))).alias("depth")), "quote-threads")
        discard(now)
        now, before, total = then, total, then.agg(F.coalesce(F.sum("depth"), F.lit(0))).first()[0]
        if total == before or total == 0:
            return now.withColumnRenamed("up", "thread_turn")


def link_quotes(messages: DataFrame) -> DataFrame:
    """One row per message, without its quotes: conv_id, turn, role, parent_turn, thread_turn, depth, position, n_quotes, text.

    parent_turn is the message that the shallowest linked quote level comes from, null where no quote is found in an
    earlier message; such a message begins a thread. position orders a conversation by thread, then depth, then turn, so
    that a reply comes after what it replies to. Null texts give empty texts; rows with a null conv_id or turn link with
    nothing; repeated rows all come back, next to each other. Quotes may be nested to any depth. An empty table gives an
    empty result.
    """
    links = quote_links(messages)
    first = links.groupBy("conv_id", "turn").agg(F.min(F.struct("level", "origin_turn")).alias("_best"))
    parents = stored(first.select("conv_id", "turn", F.col("_best.origin_turn").alias("parent_turn")), "quote-parents")
    threads = parents.join(_threads(parents), ["conv_id", "turn"])
    parts = passages(F.col("text"))
    texts = messages.select("conv_id", "turn", "role", F.size(F.filter(parts, lambda p: p["level"] > 0)).alias("n_quotes"), own_text(parts).alias("text"))
    joined = texts.join(threads, ["conv_id", "turn"], "left").withColumns({"thread_turn": F.coalesce("thread_turn", "turn"), "depth": F.coalesce("depth", F.lit(0).cast("bigint"))})
    placed = number_in_order(joined, "conv_id", ["thread_turn", "depth", "turn", "role", "text"])
    return placed.select("conv_id", "turn", "role", "parent_turn", "thread_turn", "depth", "position", "n_quotes", "text")
