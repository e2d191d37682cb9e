"""Mixing sources to target weights: word blocks drawn by index through pseudorandom permutations.

The words of each source, laid end to end, are cut into blocks of fixed length. Each output shard has its number of slots
and draws by one multinomial how many of them each source fills; what the shards together draw over a source's quota is
then given to sources under theirs, slot by slot. The k-th block drawn from a source over all shards is block
permutation(k) of that source, so that no block comes twice before every block came once. Sources are rows of a table, so
there may be any number of them: the draw goes to groups of sources first, then within each group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.functions.ordered import running_total
from ledgerline.llm.common import SPACES, arrow_map, discard, number_copies, number_in_order, stored

#: Weights in the order of the sources, repeating; the mix's share of all words; most uses of a word.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_USES = 2
BLOCK_WORDS = 128
OUTPUT_SHARDS = 64
#: Sources that are drawn from together.
GROUP = 4096
#: Rows are laid end to end in buckets of about so many; slots are numbered in runs of so many.
BUCKET_ROWS, RUN = 1 << 14, 8192
#: The draws of so many copies of a row are listed together.
COPIES = 64
#: An index outside the domain goes through the permutation again: a quarter of them at most, so this often never.
MOST_WALKS = 32


def tokens(text: Column) -> Column:
    """Each word with the white space after it; white space before the first word is dropped."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"), F.lit(0))


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def water_level(sources: DataFrame, share: float = SHARE, most_uses: int = MOST_USES) -> float:
    """Words to take for each unit of weight, of sources (size, weight): `share` of all words in all.

    A source stops at `most_uses` times its size, and what it can't take raises the level for the others, until no more
    sources stop. Each round sums over the table; only sums reach the driver.
    """
    cap = F.col("size") * most_uses
    total = sources.agg(F.sum("size")).first()[0] or 0
    level, stopped = 0.0, -1
    while True:
        over = cap < F.col("weight") * F.lit(level)
        row = sources.agg(F.sum(F.when(over, cap).otherwise(0)), F.sum(F.when(over, 0).otherwise(F.col("weight"))), F.count(F.when(over, 1))).first()
        if row[2] == stopped or not row[1]:
            return level if row[1] else float("inf")
        level, stopped = (share * total - row[0]) / row[1], row[2]


def source_plan(sized: DataFrame, block_words: int) -> DataFrame:
    """A stored row a source, by code point with null last: src, source, source_size, target, blocks, quota, and the domain
    high x low of its permutation."""
    sizes = sized.groupBy("source").agg(F.sum("size").alias("size")).withColumns({"_all": F.lit(0), "_late": F.col("source").isNull()})
    numbered = number_in_order(sizes, "_all", ["_late", "source"])
    weights = F.array(*[F.lit(w) for w in WEIGHTS])
    sources = stored(numbered.select(F.col("position").alias("src"), "source", "size", F.get(weights, (F.col("position") % len(WEIGHTS)).cast("int")).alias("weight")), "mix-sources")
    level = water_level(sources)
    target = F.least((F.col("size") * MOST_USES).cast("double"), F.col("weight") * F.lit(level))
    blocks = F.ceil(F.col("size") / block_words).cast("bigint")
    planned = sources.select("src", "source", F.col("size").alias("source_size"), target.alias("target"), blocks.alias("blocks"))
    high = F.greatest(F.ceil(F.sqrt("blocks")).cast("bigint"), F.lit(1))
    quota = F.when(F.col("blocks") > 0, F.least(F.rint(F.col("target") * F.col("blocks") / F.col("source_size")).cast("bigint"), F.col("blocks") * MOST_USES)).otherwise(0)
    domain = planned.withColumns({"high": high, "quota": quota}).withColumn("low", F.greatest(F.ceil(F.col("blocks") / F.col("high")).cast("bigint"), F.lit(1)))
    plan = stored(domain, "mix-plan")
    discard(sources)
    return plan


def settled_draws(slots: np.ndarray, quotas: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """A row a shard, a column a source: how many of the shard's slots the source fills.

    Each row is one multinomial draw by the quotas. Of a source that came to more than its quota over all rows, slots chosen
    at random are given to sources that came to less, in random order. So rows keep their slots, and columns sum to the
    quotas, if these sum to the slots.
    """
    total = int(quotas.sum())
    if not total:
        return np.zeros((len(slots), len(quotas)), dtype=np.int64)
    counts = np.stack([rng.multinomial(n, quotas / total) for n in slots]).astype(np.int64)
    over = counts.sum(axis=0) - quotas
    freed = []  # the shards of the slots that change hands
    for s in np.flatnonzero(over > 0):
        back = rng.multivariate_hypergeometric(counts[:, s], over[s], method="marginals")
        counts[:, s] -= back
        freed.append(np.repeat(np.arange(len(slots)), back))
    if freed:
        takers = rng.permutation(np.repeat(np.flatnonzero(over < 0), -over[over < 0]))
        np.add.at(counts, (np.concatenate(freed), takers), 1)
    return counts


def draw_counts(plan: DataFrame, shards: int, seed: int) -> DataFrame:
    """(shard, src, n, first, blocks, high, low): how many blocks of a source each shard draws, by settled_draws().

    The shards' slots are alike to one, and all together those of the quotas. Quotas of groups of GROUP sources are drawn on
    the driver, which holds a number a group and shard; those of a group's sources in a task. `first` counts the source's
    blocks in the shards before.
    """
    grouped = plan.withColumn("_group", F.floor(F.col("src") / GROUP).cast("bigint"))
    totals = sorted((r["_group"], r.quota) for r in grouped.groupBy("_group").agg(F.sum("quota").alias("quota")).collect())
    total = sum(q for _, q in totals)
    slots = np.array([total // shards + (k < total % shards) for k in range(shards)])
    by_group = settled_draws(slots, np.array([q for _, q in totals], dtype=np.int64), np.random.default_rng((seed, 0)))
    drawn = {g: by_group[:, i].tolist() for i, (g, _) in enumerate(totals)}
    shared = plan.sparkSession.sparkContext.broadcast(drawn)
    names = ("shard", "src", "n", "first", "blocks", "high", "low")
    facts = ("src", "quota", "blocks", "high", "low")

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group, rows in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                columns = {c: np.array([r[c] for r in rows], dtype=np.int64) for c in facts}
                n = settled_draws(np.array(shared.value[group]), columns["quota"], np.random.default_rng((seed, 1, group)))
                shard, at = np.nonzero(n)
                first = (np.cumsum(n, axis=0) - n)[shard, at]
                out = (shard, columns["src"][at], n[shard, at], first, *[columns[c][at] for c in ("blocks", "high", "low")])
                yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in out], names=list(names))

    # A group is GROUP rows at most.
    lists = grouped.groupBy("_group").agg(F.array_sort(F.collect_list(F.struct(*facts))).alias("rows"))
    return arrow_map(lists, within, ", ".join(f"{c} bigint" for c in names))


def permuted(index: Column, high: Column, low: Column, n: Column, key: Column, rounds: int = 4) -> Column:
    """A pseudorandom permutation of 0 to n - 1 that needs no table.

    The index, written as (i div low, i mod low) in a domain of high x low >= n, goes through rounds that add a hash of one
    digit to the other, each of which can be undone; a result of n or more goes through again.
    """

    def add(s: Column, r: Column) -> Column:
        a = F.pmod(s["a"] + F.pmod(F.xxhash64(key, r, s["b"]), high), high)
        return F.transform(F.array(a), lambda x: F.struct(x.alias("a"), F.pmod(s["b"] + F.pmod(F.xxhash64(key, r, x, F.lit(1)), low), low).alias("b")))[0]

    def once(i: Column) -> Column:
        digits = F.struct(F.floor(i / low).cast("bigint").alias("a"), (i % low).alias("b"))
        return F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), digits, add, lambda s: s["a"] * low + s["b"])

    start = F.struct(index.cast("bigint").alias("i"), F.lit(False).alias("done"))
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(MOST_WALKS)), start,
        lambda s, _: F.when(s["done"], s).otherwise(F.transform(F.array(once(s["i"])), lambda x: F.struct(x.alias("i"), (x < n).alias("done")))[0]),
    )
    return F.transform(F.array(walked), lambda s: F.when(s["done"], s["i"]).otherwise(F.raise_error(F.lit("permutation did not settle")).cast("bigint")))[0]


def lay_out(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """Adds src, the source's number, and offset, where the row's words begin among those of its source.

    sized has rid, source, doc_id, hash and size. The order is that of a bucket (a hash of the row and of which of its copies
    it is), then doc_id, hash and copy, so that it is the same for the same rows. Only bucket totals are summed in order.
    """
    buckets = max(1, sized.count() // BUCKET_ROWS)
    known = sized.join(plan.select("src", F.col("source").alias("_name")), F.col("source").eqNullSafe(F.col("_name"))).drop("_name")
    rows = number_copies(known, ["src", "doc_id", "hash"], "rid", "_copy").withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "hash", "_copy"), F.lit(buckets)))
    totals = rows.groupBy("src", "_bucket").agg(F.sum("size").alias("_n"))
    starts = running_total(totals, ["src"], "_bucket", F.col("_n"), "_upto").select("src", "_bucket", (F.col("_upto") - F.col("_n")).alias("_start"))
    within = Window.partitionBy("src", "_bucket").orderBy("doc_id", "hash", "_copy").rowsBetween(Window.unboundedPreceding, -1)
    ordered = rows.withColumn("_within", F.coalesce(F.sum("size").over(within), F.lit(0)))
    placed = ordered.join(starts, ["src", "_bucket"]).withColumn("offset", (F.col("_start") + F.col("_within")).cast("bigint"))
    return placed.withColumnRenamed("_copy", "copy").drop("_bucket", "_start", "_within")


def drawn_blocks(plan: DataFrame, shards: int, seed: int) -> DataFrame:
    """(shard, slot, src, block): every block drawn, in slots that number the blocks of a shard from 0."""
    counts = stored(draw_counts(plan, shards, seed), "mix-draws")
    draws = running_total(counts, ["shard"], "src", F.col("n"), "_upto").withColumn("slot0", F.col("_upto") - F.col("n")).drop("_upto")
    # In two steps, of runs and then of the slots in a run, so that no row holds all slots of a large source.
    runs = draws.withColumn("at", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1, F.lit(RUN).cast("bigint")))).repartition(int(plan.sparkSession.conf.get("spark.sql.shuffle.partitions")), "shard", "src", "at")
    each = runs.withColumn("i", F.explode(F.sequence(F.col("at"), F.least(F.col("at") + RUN, F.col("n")) - 1)))
    k = F.col("first") + F.col("i")
    key = F.xxhash64(F.lit(seed), F.col("src"), F.floor(k / F.col("blocks")).cast("bigint"))
    numbered = each.select("shard", (F.col("slot0") + F.col("i")).alias("slot"), "src", "blocks", "high", "low", (k % F.col("blocks")).alias("i"), key.alias("key"))
    return numbered.select("shard", "slot", "src", permuted(F.col("i"), F.col("high"), F.col("low"), F.col("blocks"), F.col("key")).alias("block"))


def _keyed(docs: DataFrame) -> DataFrame:
    """docs with _id and _hash, which only equal rows share, the source as text and the size."""
    hashed = [F.to_json(F.struct(c)) if "map<" in t or "variant" in t else F.col(c) for c, t in docs.dtypes]  # maps have no hash
    return docs.withColumns({"_id": F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(2**63)).cast("bigint")), "_source": F.col("source").cast("string"), "_size": word_count(F.col("text")), "_hash": F.xxhash64(*hashed)})


def _sized(keyed: DataFrame) -> DataFrame:
    """The stored rows without their texts, with rid, which no two of them share."""
    named = keyed.select(F.monotonically_increasing_id().alias("rid"), "_id", "doc_id", F.col("_source").alias("source"), F.col("_size").alias("size"), F.col("_hash").alias("hash"))
    return stored(named, "mix-sizes")


def _blocks_of(laid: DataFrame, block_words: int) -> DataFrame:
    """A row for each block that a row's words lie in, with `words`, how many of them; rows without words have none."""
    first, last = F.floor(F.col("offset") / block_words).cast("bigint"), F.floor((F.col("offset") + F.col("size") - 1) / block_words).cast("bigint")
    spread = laid.where("size > 0").withColumn("block", F.explode(F.sequence(first, last)))
    return spread.withColumn("words", F.least(F.col("offset") + F.col("size"), (F.col("block") + 1) * block_words) - F.greatest(F.col("offset"), F.col("block") * block_words))


def mix_counts(docs: DataFrame, block_words: int = BLOCK_WORDS, shards: int = OUTPUT_SHARDS, seed: int = 11) -> DataFrame:
    """(doc_id, size, source_size, target, taken, source) for every row: the words that the mix takes of it, repeats counted.

    A null or empty text has size 0 and gives nothing, as does a source without words; a null source is a source, the
    last. Rows that repeat are rows of their own. An empty table gives an empty result.
    """
    sized = _sized(_keyed(docs))
    plan = source_plan(sized, block_words)
    laid = stored(lay_out(sized, plan), "mix-laid")
    uses = drawn_blocks(plan, shards, seed).groupBy("src", "block").agg(F.count(F.lit(1)).alias("uses"))
    # Made from a few rows, so Spark takes the uses for small.
    taken = _blocks_of(laid, block_words).join(uses.hint("merge"), ["src", "block"]).groupBy("rid").agg(F.sum(F.col("words") * F.col("uses")).cast("bigint").alias("taken"))
    facts = plan.select("src", "source_size", "target")
    return laid.join(taken, "rid", "left").join(facts, "src").select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("bigint")).alias("taken"), "source")


def mix_documents(docs: DataFrame, block_words: int = BLOCK_WORDS, shards: int = OUTPUT_SHARDS, seed: int = 11) -> DataFrame:
    """The mixed texts: the columns of docs, with a row for each part of a document in each block drawn, and shard and slot.

    text holds the part's words with the white space between them, n_chars (if docs has it) its length. A row without
    words gives nothing. Columns named shard and slot are replaced. Rows are placed and met with the draws by their numbers
    alone; each text moves once, to the list of its own parts.
    """
    base = docs.drop("shard", "slot")
    keyed = _keyed(base)
    sized = _sized(keyed)
    plan = source_plan(sized, block_words)
    laid = stored(lay_out(sized, plan), "mix-laid")
    discard(sized)
    drawn = _blocks_of(laid, block_words).join(drawn_blocks(plan, shards, seed).hint("merge"), ["src", "block"])
    begin = F.greatest(F.col("block") * block_words - F.col("offset"), F.lit(0)).cast("int").alias("begin")
    # The copies of a row, which are equal, share its text; each list is that of a few copies.
    lists = drawn.groupBy("_id", F.col("hash").alias("_hash"), F.floor(F.col("copy") / COPIES)).agg(F.collect_list(F.struct(begin, F.col("words").cast("int").alias("words"), "shard", "slot")).alias("_drawn")).select("_id", "_hash", "_drawn")
    whole = keyed.where("_size > 0").dropDuplicates(["_id", "_hash"])
    met = whole.join(lists.hint("merge"), ["_id", "_hash"]).withColumn("_tokens", tokens(F.col("text")))

    def part(d: Column) -> Column:
        text = F.rtrim(F.array_join(F.slice("_tokens", d["begin"] + 1, d["words"]), ""), F.lit(SPACES))
        return F.struct(text.alias("text"), d["shard"].cast("int").alias("shard"), d["slot"].alias("slot"))

    parts = met.withColumn("_part", F.explode(F.transform("_drawn", part))).drop("text").withColumns({c: F.col(f"_part.{c}") for c in ("text", "shard", "slot")})
    if "n_chars" in base.columns:
        parts = parts.withColumn("n_chars", F.length("text").cast("bigint"))
    return parts.select(*base.columns, "shard", "slot")
