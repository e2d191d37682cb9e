"""Ranked lexical search over a two-level quantised index, exact.

The exact level has a row a document: its terms, how often each occurs, and its length. The quantised level has a row a
block of documents: for each term the places of its documents and one byte each for what the term adds there, rounded up.
A search adds up bytes only, which bounds every document's score from above and, less a step a term, from below. The k-th
largest lower bound of an item is a score that its k-th document surely has, so only documents whose upper bound reaches it
are scored on the exact level, in integers.

Both levels are made where the texts are read, without a shuffle: documents stay in the order of their partitions, and a
document's number leads to its block. What moves are counts of the items' terms, bounds, and candidates.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.llm.common import arrow_map, discard, stored

#: Bytes of a term (digits, letters and all of UTF-8 beyond ASCII), A-Z in lower case; others part terms.
_KEEP = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
#: What one occurrence adds is at most 10^6 times its weight; a byte counts steps of that.
STEP = 4000
#: A block ends with this many documents or postings; a place in a block is 16 bits.
BLOCK_DOCS, BLOCK_POSTINGS = 1024, 1 << 18
#: Terms whose hashes a task remembers at once.
REMEMBERED = 1 << 18
#: Items that are searched at once, by bytes of their texts and by count; candidates that may be broadcast.
MOST_BYTES, MOST_ITEMS, MOST_CANDIDATES = 1 << 20, 2048, 1 << 18
#: Candidates that a task holds before it passes on those that its own bounds leave.
HELD = 1 << 16

FORWARD = "rid bigint, doc_id bigint, n bigint, terms array<bigint>, counts array<int>"
BLOCKS = "terms array<bigint>, ends array<int>, places binary, impacts binary, rids array<bigint>"


class Terms:
    """The distinct terms of a text as sorted 64-bit hashes, with their occurrences.

    That any term of 10^9 has the hash of one of 10^4 terms that are searched for has a chance of 6e-7.
    """

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        words = (text or "").encode("utf-8", "surrogatepass").translate(_KEEP).split()
        if len(self.known) > REMEMBERED:
            self.known = {}
        known = self.known
        for w in words:
            if w not in known:
                known[w] = xxhash.xxh64_intdigest(w)
        hashes = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words)).view(np.int64)
        return np.unique(hashes, return_counts=True)


def weight(documents: int, holding: int) -> int:
    """What a term counts that so many of the documents hold."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def impacts_of(counts: np.ndarray, n: np.ndarray, documents: int, all_terms: int) -> np.ndarray:
    """What a term with weight 1 adds to a document of n terms that holds it so often; all in integers.

    Products beyond 64 bits, of texts of more than 10^17 / documents terms, are made in Python's integers.
    """
    if documents * 90 * int(n.max(initial=0)) >= 1 << 62:
        length = np.array([100 - 90 + 90 * int(x) * documents // all_terms for x in n], dtype=np.int64)
    else:
        length = 100 - 90 + (90 * n * documents) // max(1, all_terms)
    return (1_000_000_000 * counts) // (1000 * counts + 8 * length)


@dataclass
class LexicalIndex:
    """exact: FORWARD, blocks: BLOCKS, both stored tables; documents that hold a term, and terms in all."""

    exact: DataFrame
    blocks: DataFrame
    documents: int
    all_terms: int

    def discard(self) -> None:
        discard(self.exact, self.blocks)


def _array(column: pa.Array, row: int) -> np.ndarray:
    return column[row].values.to_numpy(zero_copy_only=False)


def _lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, dtype=kind.to_pandas_dtype()), *parts]), kind))


def build_index(docs: DataFrame) -> LexicalIndex:
    """Indexes every row of docs (doc_id, text) and all its terms; repeated rows are documents of their own.

    Terms are the longest stretches of digits, ASCII letters and characters beyond ASCII, with A-Z in lower case. A null
    text, or one without terms, is never found. An empty table makes an empty index.
    """

    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms()
        for batch in batches:
            found = [terms(t.as_py()) for t in batch.column("text")]
            n = pa.array([int(c.sum()) for _, c in found], pa.int64())
            counts = [c.astype(np.int32) for _, c in found]
            yield pa.RecordBatch.from_arrays([batch.column("rid"), batch.column("doc_id"), n, _lists([t for t, _ in found], pa.int64()), _lists(counts, pa.int32())], names=["rid", "doc_id", "n", "terms", "counts"])

    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    exact = stored(arrow_map(rows, forward, FORWARD), "lexical-exact")
    facts = exact.where("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
    documents, all_terms = facts[0], facts[1] or 0

    def packed(held: list[tuple[int, int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        sizes = [len(t) for _, _, t, _ in held]
        terms, counts = np.concatenate([t for _, _, t, _ in held]), np.concatenate([c for _, _, _, c in held])
        place, n = np.repeat(np.arange(len(held), dtype=np.uint16), sizes), np.repeat(np.array([n for _, n, _, _ in held]), sizes)
        order = np.argsort(terms, kind="stable")
        steps = (-(-impacts_of(counts.astype(np.int64), n, documents, all_terms) // STEP)).astype(np.uint8)[order]
        ordered = terms[order]
        last = np.flatnonzero(np.r_[ordered[1:] != ordered[:-1], True])
        rids = np.array([rid for rid, _, _, _ in held])
        columns = [_lists([ordered[last]], pa.int64()), _lists([(last + 1).astype(np.int32)], pa.int32()), pa.array([place[order].tobytes()], pa.binary()), pa.array([steps.tobytes()], pa.binary()), _lists([rids], pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["terms", "ends", "places", "impacts", "rids"])

    def inverted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for i, (rid, n) in enumerate(zip(batch.column("rid").to_pylist(), batch.column("n").to_pylist())):
                terms = _array(batch.column("terms"), i)
                if held and (len(held) >= BLOCK_DOCS or size + len(terms) > BLOCK_POSTINGS):
                    yield packed(held)
                    held, size = [], 0
                held.append((rid, n, terms.copy(), _array(batch.column("counts"), i).copy()))
                size += len(terms)
        if held:
            yield packed(held)

    found = exact.where("n > 0").select("rid", "n", "terms", "counts")
    return LexicalIndex(exact, stored(arrow_map(found, inverted, BLOCKS), "lexical-blocks"), documents, all_terms)


def _holding(blocks: DataFrame, wanted: np.ndarray) -> np.ndarray:
    """How many documents hold each wanted term (sorted hashes), of which a task passes on a number each."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(wanted), dtype=np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                terms, ends = _array(batch.column("terms"), i), _array(batch.column("ends"), i)
                at = np.minimum(np.searchsorted(terms, wanted), len(terms) - 1)
                total += np.where(terms[at] == wanted, np.diff(ends, prepend=0)[at], 0)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["at", "n"])

    out = np.zeros(len(wanted), dtype=np.int64)
    for r in arrow_map(blocks.select("terms", "ends"), counted, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).collect():
        out[r["at"]] = r.n
    return out


@dataclass(frozen=True)
class _Queries:
    """Items as numbers: for each wanted term its weight and the items (by place in the list) that ask for it."""

    items: list[int]
    wanted: np.ndarray
    weights: np.ndarray
    askers: list[np.ndarray]


def _bounded(blocks: DataFrame, queries: _Queries, k: int) -> DataFrame:
    """(item, rid, low, high): every document whose upper bound reaches the k-th lower bound of its item in its task.

    The task's k-th lower bound is no more than that of all documents, so none is lost; it only rises as the task goes on.
    """
    n_items, item_ids = len(queries.items), np.array(queries.items, dtype=np.int64)

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.zeros((n_items, k), dtype=np.int64)  # rising, so that the first is the k-th largest
        held: list[tuple[np.ndarray, ...]] = []

        def left() -> list[np.ndarray]:
            """What the bounds of now leave of the candidates, as columns."""
            item, rid, low, high = (np.concatenate([np.zeros(0, dtype=np.int64), *c]) for c in zip(*held)) if held else [np.zeros(0, dtype=np.int64)] * 4
            on = high >= best[item, 0]
            return [item[on], rid[on], low[on], high[on]]

        def record(columns: list[np.ndarray]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c) for c in (item_ids[columns[0]], *columns[1:])], names=["item", "rid", "low", "high"])

        size = 0
        for batch in batches:
            for i in range(batch.num_rows):
                terms, ends, rids = (_array(batch.column(c), i) for c in ("terms", "ends", "rids"))
                places = np.frombuffer(batch.column("places")[i].as_py(), dtype=np.uint16)
                impacts = np.frombuffer(batch.column("impacts")[i].as_py(), dtype=np.uint8)
                high, slack = np.zeros((n_items, len(rids)), dtype=np.int64), np.zeros((n_items, len(rids)), dtype=np.int64)
                at = np.minimum(np.searchsorted(terms, queries.wanted), len(terms) - 1)
                for q in np.flatnonzero(terms[at] == queries.wanted).tolist():
                    part = slice(int(ends[at[q] - 1]) if at[q] else 0, int(ends[at[q]]))
                    cells = np.ix_(queries.askers[q], places[part])
                    high[cells] += queries.weights[q] * STEP * impacts[part].astype(np.int64)
                    slack[cells] += queries.weights[q] * (STEP - 1)
                low = np.maximum(high - slack, 0)
                top = np.partition(low, low.shape[1] - k, axis=1)[:, -k:] if low.shape[1] > k else low
                best = np.sort(np.concatenate([best, top], axis=1), axis=1)[:, -k:]
                item, place = np.nonzero((high >= best[:, :1]) & (high > 0))
                held.append((item, rids[place], low[item, place], high[item, place]))
                size += len(item)
                if size > HELD:
                    now = left()
                    size = len(now[0])
                    held = [tuple(now)]
                    if size > HELD // 2:
                        yield record(now)
                        held, size = [], 0
        yield record(left())

    return arrow_map(blocks, bounded, "item bigint, rid bigint, low bigint, high bigint")


def _scored(index: LexicalIndex, candidates: DataFrame, n: int, queries: _Queries) -> DataFrame:
    """(item, rid, doc_id, score) of the n candidates (item, rid) on the exact level.

    Up to MOST_CANDIDATES of them are broadcast; beyond, both sides are dealt by document.
    """
    exact = index.exact.where("n > 0")
    met = exact.join(F.broadcast(candidates), "rid") if n <= MOST_CANDIDATES else exact.join(candidates.hint("merge"), "rid")
    item_terms = [np.zeros(0, dtype=np.int64) for _ in queries.items]
    owner = {item: i for i, item in enumerate(queries.items)}
    pairs = np.array([(i, q) for q, mine in enumerate(queries.askers) for i in mine.tolist()], dtype=np.int64).reshape(-1, 2)
    for i in range(len(queries.items)):
        item_terms[i] = np.sort(pairs[pairs[:, 0] == i, 1])
    documents, all_terms = index.documents, index.all_terms

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = []
            for i, (item, n) in enumerate(zip(batch.column("item").to_pylist(), batch.column("n").to_pylist())):
                mine = item_terms[owner[item]]
                terms, counts = _array(batch.column("terms"), i), _array(batch.column("counts"), i).astype(np.int64)
                at = np.minimum(np.searchsorted(terms, queries.wanted[mine]), len(terms) - 1)
                held = terms[at] == queries.wanted[mine]
                each = impacts_of(counts[at[held]], np.full(int(held.sum()), n, dtype=np.int64), documents, all_terms)
                scores.append(int((queries.weights[mine[held]] * each).sum()))
            yield pa.RecordBatch.from_arrays([batch.column("item"), batch.column("rid"), batch.column("doc_id"), pa.array(scores, pa.int64())], names=["item", "rid", "doc_id", "score"])

    return arrow_map(met.select("item", "rid", "doc_id", "n", "terms", "counts"), scored, "item bigint, rid bigint, doc_id bigint, score bigint")


def _parts(items: DataFrame, most_bytes: int) -> Iterator[list[tuple[int, str | None]]]:
    """The items' numbers and texts on the driver, in parts of about most_bytes and MOST_ITEMS at most."""
    size, count = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count(F.lit(1))).first()
    n = 1 if size <= most_bytes and count <= MOST_ITEMS else max(-(-2 * size // most_bytes), -(-2 * count // MOST_ITEMS))
    for part in range(n):
        rows = items if n == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == part)
        yield [(r["item"], r.text) for r in rows.collect()]


def search(index: LexicalIndex, items: DataFrame, k: int = 10, most_bytes: int = MOST_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): for each row of items (item_id, text) the k documents that score highest, above 0.

    A term's weight is floor(1000 ln((2N+2)/(2df+1))); it adds its weight times (10^9 tf) div (1000 tf + 8m), where m is
    10 + ((90 n N) div L). Equal scores go by ascending doc_id, a missing one last, then by the order of rows. Items without
    terms, or with terms that no document holds, have no rows. Repeated items each get theirs. Items of more than
    most_bytes are searched in several passes over the blocks. An empty index or no items give an empty result.
    """
    if k < 1:
        raise ValueError("k must be 1 or more")
    spark = items.sparkSession
    numbered = stored(items.select(F.monotonically_increasing_id().alias("item"), "item_id", "text"), "lexical-items")
    found: DataFrame | None = None
    scratch: list[DataFrame] = []
    for part in _parts(numbered, most_bytes):
        now = _search_part(spark, index, part, k, scratch)
        found = now if found is None else found.union(now)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "rid")
    ranked = found.where("score > 0").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    best = stored(ranked, "lexical-best")
    discard(*scratch)
    return numbered.select("item", "item_id").join(F.broadcast(best) if best.count() <= MOST_CANDIDATES else best, "item").select("item_id", "rank", "doc_id", "score")


def _search_part(spark: SparkSession, index: LexicalIndex, part: list[tuple[int, str | None]], k: int, scratch: list[DataFrame]) -> DataFrame:
    """(item, rid, doc_id, score) of a part's candidates; the tables that this reads are added to scratch."""
    terms = Terms()
    asked = [(item, terms(text)[0]) for item, text in part]
    wanted = np.unique(np.concatenate([np.zeros(0, dtype=np.int64), *[t for _, t in asked]]))
    if not len(wanted) or not index.documents:
        return spark.createDataFrame([], "item bigint, rid bigint, doc_id bigint, score bigint")
    holding = _holding(index.blocks, wanted)
    weights = np.array([weight(index.documents, int(h)) if h else 0 for h in holding], dtype=np.int64)
    wanted, weights = wanted[holding > 0], weights[holding > 0]
    askers: list[list[int]] = [[] for _ in wanted]
    for i, (_, mine) in enumerate(asked):
        for q in np.searchsorted(wanted, mine[np.isin(mine, wanted)]).tolist():
            askers[q].append(i)
    queries = _Queries([item for item, _ in asked], wanted, weights, [np.array(a, dtype=np.int64) for a in askers])
    bounds = stored(_bounded(index.blocks, queries, k), "lexical-bounds")
    order = Window.partitionBy("item").orderBy(F.desc("low"))
    least = bounds.select("item", "low").withColumn("at", F.row_number().over(order)).where(F.col("at") <= k).groupBy("item").agg(F.min("low").alias("least"), F.count(F.lit(1)).alias("held"))
    reached = F.when(F.col("held") == k, F.col("least")).otherwise(F.lit(0))
    candidates = stored(bounds.join(F.broadcast(least), "item").where(F.col("high") >= reached).select("item", "rid"), "lexical-candidates")
    discard(bounds)
    scratch.append(candidates)
    return _scored(index, candidates, candidates.count(), queries)


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """search() over an index of docs that is made for it and deleted once the best are known."""
    index = build_index(docs)
    found = search(index, items, k)
    index.discard()
    return found
