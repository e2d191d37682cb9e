"""Benchmark passages in documents, found by one Aho-Corasick automaton in one scan of each normalised text."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import repeat

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType

from ledgerline.llm.common import arrow_map, keeping_own, schema_with, stored

#: Bytes of a word (digits, letters and all of UTF-8 beyond ASCII), A-Z in lower case; others part words.
_KEEP = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
ADDED = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated", "hit_chars")
_WORD_BYTES = re.compile(rb"[0-9a-z\x80-\xff]+")


def normal_words(text: str | None) -> list[bytes]:
    """Lower-cases A-Z and takes words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`, as UTF-8 bytes."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_KEEP).split()


def item_windows(words: list[bytes], width: int) -> list[tuple[bytes, ...]]:
    if not words:
        return []
    return [tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]


def build_automaton(items: list[tuple[str | None, str | None]], width: int) -> ahocorasick.Automaton | None:
    """One pattern for each distinct window, between blanks, with the number of its words and the items that have it."""
    owners: dict[tuple[bytes, ...], set[str | None]] = {}
    for item, text in items:
        for window in item_windows(normal_words(text), width):
            owners.setdefault(window, set()).add(item)
    if not owners:
        return None
    automaton = ahocorasick.Automaton()
    for window, names in owners.items():
        automaton.add_word(" " + b" ".join(window).decode("latin-1") + " ", (len(window), tuple(names)))
    automaton.make_automaton()
    return automaton


def scan(automaton: ahocorasick.Automaton | None, text: str | None) -> tuple[int, list[tuple[int, int, tuple[str | None, ...]]]]:
    """How many words the text has, and (first word, words, items) of each window in it, by rising last word.

    A window ends at the blank after its last word; the blanks up to there are counted on from the last window's end, so
    that each is counted once.
    """
    words = normal_words(text)
    if automaton is None or not words:
        return len(words), []
    line = " " + b" ".join(words).decode("latin-1") + " "
    found, upto, blanks = [], 0, 0
    for end, (n, items) in automaton.iter(line):
        blanks += line.count(" ", upto, end + 1)
        upto = end + 1
        found.append((blanks - 1 - n, n, items))
    return len(words), found


def word_spans(text: str) -> list[tuple[int, int]]:
    """Start and end of each normalised word in the characters of the original text."""
    raw = text.encode("utf-8", "surrogatepass").translate(_KEEP)
    spans, at, chars, whole = [], 0, 0, text.encode("utf-8", "surrogatepass")
    for m in _WORD_BYTES.finditer(raw):
        chars += len(whole[at : m.start()].decode("utf-8", "surrogatepass"))
        start = chars
        chars += len(whole[m.start() : m.end()].decode("utf-8", "surrogatepass"))
        spans.append((start, chars))
        at = m.end()
    return spans


def joined_runs(found: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The runs (first word, word after the last) of words inside any window (first, words)."""
    runs: list[list[int]] = []
    for first, n in sorted(found):
        if runs and first <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], first + n)
        else:
            runs.append([first, first + n])
    return [(a, b) for a, b in runs]


def _parts(benchmark: DataFrame, most_bytes: int) -> Iterator[list[tuple[str | None, str | None]]]:
    """The test items on the driver, in parts of about most_bytes at most: an automaton takes about 60 times their bytes in
    each worker. Parts are made by a hash of the item, so only a single longer item makes a longer part."""
    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = 1 if size <= most_bytes else -(-2 * size // most_bytes)
    for k in range(n):
        part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        yield [(r.item_id, r.text) for r in part.collect()]


def contamination_spans(docs: DataFrame, benchmark: DataFrame, width: int = 10, most_bytes: int = 8 << 20) -> DataFrame:
    """(doc_id, item_id, start, end): each occurrence of an item's window, as character offsets of the original text.

    A window is `width` consecutive words of an item; a shorter item with a word is one window. Null and empty texts and
    items have none. Repeated documents give repeated spans. Only automata of items of checked size are sent out; where
    there are several, the texts are scanned once for each.
    """

    def spans_of(items: list[tuple[str | None, str | None]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            automaton = build_automaton(items, width)
            for batch in batches:
                out = []
                for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                    if found := scan(automaton, text := text.as_py())[1]:
                        places = word_spans(text)
                        out += [(doc, item, places[f][0], places[f + n - 1][1]) for f, n, names in found for item in names]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out)) or [[]] * 4, (pa.int64(), pa.string(), pa.int64(), pa.int64()))], names=["doc_id", "item_id", "start", "end"])

        return spans

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    made = [arrow_map(texts, spans_of(items), "doc_id bigint, item_id string, start bigint, end bigint") for items in _parts(benchmark, most_bytes)]
    return reduce(DataFrame.union, made)


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = 10, most_bytes: int = 8 << 20) -> DataFrame:
    """Adds n_words, n_hit, n_items, items_sha256, contaminated and hit_chars to every document; replaces such columns.

    n_hit counts document words inside any occurrence of an item's window, hit_chars the characters that these words have
    in the original text. An item without an id counts for these, but not for n_items and
    items_sha256. A null text has no words. With no items, or no hit, items_sha256 is that of the empty string. Items over
    most_bytes are done in several passes, each with the automaton of a part, which hand on what they found row by row.
    """
    state = ["_first", "_length", "_names"]
    base = docs.drop(*ADDED, *state)
    parts = _parts(benchmark, most_bytes)
    items = next(parts)
    for more in parts:
        base = stored(_found(base, items, width), "contamination-part")
        items = more
    return _found(base, items, width, last=True).select(*docs.drop(*ADDED, *state).columns, *ADDED)


def _found(df: DataFrame, items: list[tuple[str | None, str | None]], width: int, last: bool = False) -> DataFrame:
    """One pass: what earlier passes and this one found, as lists, or as contamination()'s columns at the last pass."""
    carried = "_names" in df.columns
    base = df.drop("_first", "_length", "_names")
    numbers, texts = ArrayType(LongType()), ArrayType(StringType())
    kinds = {"n_words": "long", "n_hit": "long", "n_items": "long", "items_sha256": "string", "contaminated": "boolean", "hit_chars": "long"} if last else {"_first": numbers, "_length": numbers, "_names": texts}
    schema = schema_with(base, **kinds)
    arrow = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.int64()) if last else (pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.string()))
    names = base.columns

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = build_automaton(items, width)
        for batch in batches:
            rows = []
            before = zip(*[batch.column(c).to_pylist() for c in ("_first", "_length", "_names")]) if carried else repeat(([], [], []))
            for text, (first, length, known) in zip(batch.column("text"), before):
                n, found = scan(automaton, text := text.as_py())
                spans = list({*zip(first, length), *((f, k) for f, k, _ in found)})
                owners = sorted({*known, *(x for _, _, names in found for x in names if x is not None)})
                if not last:
                    rows.append(([f for f, _ in spans], [k for _, k in spans], owners))
                    continue
                runs = joined_runs(spans)
                places = word_spans(text) if runs else []
                hit = sum(b - a for a, b in runs)
                rows.append((n, hit, len(owners), hashlib.sha256(",".join(owners).encode()).hexdigest(), hit > 0, sum(places[i][1] - places[i][0] for a, b in runs for i in range(a, b))))
            more = [pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * len(arrow), arrow)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], *more], names=[*names, *kinds])

    return arrow_map(df, passed, schema)


def clean_documents(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any benchmark window, with their own columns as they were."""
    return keeping_own(docs, ADDED, lambda d: contamination(d, benchmark).where(~F.col("contaminated")))
