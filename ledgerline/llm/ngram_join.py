"""Near-duplicate documents by a grouped prefix join over word shingles, exact at any similarity.

Documents with equal shingle sets form a class; classes with equal prefixes and sizes form a group; only group leaders
enter the prefix join. A shingle's place in the order that prefixes follow comes from a count sketch of fixed size, rare
before frequent: any order gives the same links, this one keeps frequent passages out of the prefixes.

The join runs twice. First each entry meets the leader of its shingle's list, a number of pairs linear in the entries;
these links give first components. Then only pairs from different components are left to look at, and of those only what
the bounds allow: size and place hold for a group, as its members share them; bitmaps are compared member by member.
Every surviving pair is verified on whole shingle sets.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.llm.common import arrow_map, discard, stored

#: Counters of the sketch (64 MB, whatever the input), in blocks that are summed apart; least bits of a set's bitmap.
COUNTERS, BLOCK = 1 << 24, 1 << 16
BITS = 1024
#: Words whose hashes a task remembers at once.
REMEMBERED = 1 << 16
#: Most rows, of 64 bits each, in the table that tells which keys are surely not among those to go.
WORDS = 1 << 18
_SEED, _FACTOR = 0x9E3779B97F4A7C15, np.uint64(0xD6E8FEB86659FD93)


class Shingler:
    """The distinct shingles of a text as sorted 64-bit hashes; A-Z in lower case, words between ASCII white space.

    A text with fewer words than `width` has its whole sequence as its one shingle; one without words has none.
    Two different shingles among 10,000 agree with a chance of 3e-12.
    """

    def __init__(self, width: int) -> None:
        self.width, self.known = width, {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.zeros(0, dtype=np.uint64)
        if len(self.known) > REMEMBERED:
            self.known = {}
        known = self.known
        for w in words:
            if w not in known:
                known[w] = xxhash.xxh64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
        k = min(self.width, len(words))
        out = np.full(len(words) - k + 1, _SEED ^ k, dtype=np.uint64)
        for j in range(k):
            out = out * _FACTOR + h[j : len(h) - k + 1 + j]
        out ^= out >> np.uint64(31)
        out *= np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(29)
        return np.unique(out)


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def counted(df: DataFrame, hashes: Callable[[pa.RecordBatch], Iterator[np.ndarray]], spread: float = 0) -> tuple[np.ndarray, np.ndarray]:
    """The counters that hashes of df fall to, and how many, for those over mean + spread * sqrt(mean) + 0.7 * spread.

    Each task counts its own rows and passes on its counters, packed by block; each block is summed in one stream. What
    reaches the driver is a part of COUNTERS numbers, whatever the input.
    """

    def packed_blocks(at: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        edges = np.searchsorted(at, np.arange(0, COUNTERS + 1, BLOCK))
        rows = [(k, int(n[i:j].sum()), zlib.compress((at[i:j] % BLOCK).astype(np.uint16).tobytes() + n[i:j].astype(np.uint32).tobytes(), 1)) for k, (i, j) in enumerate(zip(edges[:-1], edges[1:])) if i < j]
        columns = list(zip(*rows)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.binary()))], names=["block", "total", "packed"])

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, dtype=np.uint32)
        for batch in batches:
            for h in hashes(batch):
                at, n = np.unique((h & np.uint64(COUNTERS - 1)).astype(np.uint32), return_counts=True)
                counts[at] += n.astype(np.uint32)
        at = np.flatnonzero(counts)
        yield packed_blocks(at, counts[at])

    kind = "block int, total bigint, packed binary"
    parts = stored(arrow_map(df, local, kind), "ngram-counts")
    mean = (parts.agg(F.sum("total")).first()[0] or 0) / COUNTERS
    least = mean + spread * mean**0.5 + 0.7 * spread if spread else 0

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, packed in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                at, n = unpacked(packed)
                total.setdefault(k, np.zeros(BLOCK, dtype=np.uint32))[at] += n
        for k in sorted(total):
            at = np.flatnonzero(total[k] > least)
            yield packed_blocks(at + k * BLOCK, total[k][at])

    found = sorted((r.block, bytes(r.packed)) for r in arrow_map(parts.repartition(COUNTERS // BLOCK, "block"), summed, kind).collect())
    discard(parts)
    each = [(unpacked(packed), k) for k, packed in found]
    return (np.concatenate([np.zeros(0, np.int64), *[at.astype(np.int64) + k * BLOCK for (at, _), k in each]]), np.concatenate([np.zeros(0, np.uint32), *[n for (_, n), _ in each]]))


def unpacked(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Places in a block, and the counts there."""
    raw = zlib.decompress(packed)
    n = len(raw) // 6
    return np.frombuffer(raw, dtype=np.uint16, count=n), np.frombuffer(raw, dtype=np.uint32, offset=2 * n)


def frequency_sketch(docs: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The counters too full for chance, with a level from 1 to 255 that follows the logarithm of their counts.

    Their shingles go last in the order. A counter of rare shingles alone is this full once in several hundred.
    """

    def hashes(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        shingler, held, size = Shingler(width), [], 0
        for text in batch.column(0):
            held.append(shingler(text.as_py()))
            size += len(held[-1])
            if size > 1 << 20:
                yield np.concatenate(held)
                held, size = [], 0
        if held:
            yield np.concatenate(held)

    at, n = counted(docs.select("text"), hashes, spread=3)
    return at, np.clip(8 * np.log2(np.maximum(n, 1)), 1, 255).astype(np.uint8)


def in_order(h: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """The shingles of a set, rare before frequent by the levels of all counters, then by hash."""
    level = levels[(h & np.uint64(COUNTERS - 1)).astype(np.int64)]
    frequent = level > 0
    if not frequent.any():
        return h
    late = h[frequent]
    return np.concatenate([h[~frequent], late[np.lexsort((late, level[frequent]))]])


def bitmap(h: np.ndarray) -> np.ndarray:
    """Parities of how many shingles fall to each bit, in a power of two of bits, at least BITS and the set's size.

    The shorter bitmap of two sets is compared to the longer one folded, as halves that are xored.
    """
    bits = max(BITS, 1 << (len(h) - 1).bit_length())
    parity = np.bincount((h >> np.uint64(24)).astype(np.int64) & (bits - 1), minlength=bits) & 1
    return np.packbits(parity.astype(np.uint8), bitorder="little").view(np.int64)


def signatures(docs: DataFrame, width: int, percent: int, sketch: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """A stored row per document (rid, doc_id, text): rid, doc_id, n, digests of its set and of its prefix and size, prefix, bitmap."""
    shared = docs.sparkSession.sparkContext.broadcast(sketch)

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        levels = np.zeros(COUNTERS, dtype=np.uint8)
        levels[shared.value[0]] = shared.value[1]
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                h = shingler(text.as_py())
                if not len(h):
                    rows.append((0, None, None, None, None))
                    continue
                prefix = in_order(h, levels)[: prefix_length(len(h), percent)].copy()
                rows.append((len(h), xxhash.xxh3_128_digest(h.tobytes()), xxhash.xxh3_128_digest(prefix.tobytes() + len(h).to_bytes(8, "little")), prefix.view(np.int64), bitmap(h)))
            columns = list(zip(*rows)) or [[]] * 5
            kinds = (pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("rid"), batch.column("doc_id"), *[pa.array(list(c), k) for c, k in zip(columns, kinds)]], names=["rid", "doc_id", "n", "digest", "pdigest", "prefix", "bits"])

    kind = "rid bigint, doc_id bigint, n bigint, digest binary, pdigest binary, prefix array<bigint>, bits array<bigint>"
    return stored(arrow_map(docs.select("rid", "doc_id", "text"), signed, kind), "ngram-signatures")


def needed_overlap(a: Column, b: Column, percent: int) -> Column:
    """The least intersection of sets of a and b shingles that link."""
    up = (a + b) * percent + (99 + percent)
    return ((up - up % (100 + percent)) / (100 + percent)).cast("bigint")


def may_link(n1: Column, p1: Column, n2: Column, p2: Column, percent: int) -> Column:
    """The size bound, and the position bound for the first shingle that two sets share, at places p1 and p2."""
    sizes = F.least(n1, n2) * 100 >= F.greatest(n1, n2) * percent
    return sizes & (F.least(n1 - p1, n2 - p2) * (100 + percent) >= (n1 + n2) * percent)


def bitmaps_allow(x: Column, y: Column, n1: Column, n2: Column, percent: int) -> Column:
    """Sets differ in at least as many shingles as their parity bitmaps differ in bits. Sizes that may link differ less
    than twofold, so one bitmap is at most twice as long as the other."""

    def folded(long: Column, other: Column) -> Column:
        half = F.size(other)
        return F.when(F.size(long) > half, F.zip_with(F.slice(long, F.lit(1), half), F.slice(long, half + 1, half), lambda a, b: a.bitwiseXOR(b))).otherwise(long)

    apart = F.aggregate(F.zip_with(folded(x, y), folded(y, x), lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda s, v: s + v)
    return apart <= n1 + n2 - 2 * needed_overlap(n1, n2, percent)


def without(rows: DataFrame, key: str, gone: DataFrame) -> DataFrame:
    """The rows whose key isn't in gone, a table of that one column.

    The bits that the keys of gone fall to make at most WORDS rows, whatever their number. A row whose bit isn't set stays
    where it is; the others, those to go and a share as large as that of the bits set, are joined with gone.
    """
    hashed = F.shiftrightunsigned(F.xxhash64(key), 40)
    word, bit = F.shiftrightunsigned(hashed, 6) % WORDS, (hashed % 64).cast("int")
    words = gone.groupBy(word.alias("_without_word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)).alias("_without_bits"))
    told = rows.withColumn("_without_word", word).join(F.broadcast(words), "_without_word", "left")
    doubtful = F.getbit(F.coalesce("_without_bits", F.lit(0).cast("bigint")), bit) == 1
    certain, other = told.where(~doubtful).select(*rows.columns), told.where(doubtful).select(*rows.columns)
    return certain.union(other.join(gone, key, "left_anti").select(*rows.columns))


def connected(edges: DataFrame) -> DataFrame:
    """(node, comp) for every node with an edge (a, b): comp is the smallest node of its component.

    Alternating large-star and small-star steps over a stored table of edges, until a step changes nothing.
    """
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "ngram-edges")
    mark = None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = large.withColumn("m", F.min("v").over(Window.partitionBy("u")))
        after = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v"))).distinct()
        then = stored(after, "ngram-edges")
        discard(now)
        now, before = then, mark
        mark = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if mark == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("comp")).union(now.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())


def _doc_key(doc_id: int | None) -> int:
    return xxhash.xxh64_intdigest(repr(doc_id).encode())


def verified(docs: DataFrame, pairs: DataFrame, members: DataFrame, width: int, percent: int) -> DataFrame:
    """The stored pairs (a, b) of nodes whose whole sets link.

    The sets are made again from the texts, for documents in a Bloom filter of fixed size over the ids that pairs need;
    what the filter lets through besides falls to the join on digests.
    """
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    wanted = stored(members.join(nodes, "node").select("node", "digest", "first_doc"), "ngram-wanted")

    def ids(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        yield np.array([_doc_key(d) for d in batch.column(0).to_pylist()], dtype=np.uint64)

    bits = np.zeros(COUNTERS, dtype=bool)
    bits[counted(wanted.select("first_doc"), ids)[0]] = True
    keep = docs.sparkSession.sparkContext.broadcast(np.packbits(bits))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, bits = Shingler(width), keep.value
        for batch in batches:
            digests, found = [], []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                k = _doc_key(doc) & (COUNTERS - 1)
                if bits[k >> 3] >> (7 - (k & 7)) & 1:
                    h = shingler(text.as_py())
                    if len(h):
                        digests.append(xxhash.xxh3_128_digest(h.tobytes()))
                        found.append(h.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(found, pa.list_(pa.int64()))], names=["digest", "items"])

    made = arrow_map(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), sets, "digest binary, items array<bigint>")
    whole = stored(made.join(wanted.select("node", "digest"), "digest").dropDuplicates(["node"]).select("node", "items"), "ngram-sets")
    left = whole.select(F.col("node").alias("a"), F.col("items").alias("x"))
    right = whole.select(F.col("node").alias("b"), F.col("items").alias("y"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", F.size("x").alias("n1"), F.size("y").alias("n2"), F.size(F.array_intersect("x", "y")).alias("shared"))
    links = stored(both.where(F.col("shared") * 100 >= (F.col("n1") + F.col("n2") - F.col("shared")) * percent).select("a", "b"), "ngram-links")
    discard(wanted, whole)
    return links


def _bounded(pairs: DataFrame, bitmaps: DataFrame, percent: int) -> DataFrame:
    """The pairs of nodes (a, b) that their own bitmaps allow."""
    a = bitmaps.select(F.col("node").alias("a"), F.col("bits").alias("x"), F.col("n").alias("n1"))
    b = bitmaps.select(F.col("node").alias("b"), F.col("bits").alias("y"), F.col("n").alias("n2"))
    return pairs.join(a, "a").join(b, "b").where(bitmaps_allow(F.col("x"), F.col("y"), F.col("n1"), F.col("n2"), percent)).select("a", "b")


def linked(docs: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The signatures of documents (rid, doc_id, text), and a stored row a class of equal sets: its node (a rid), digest,
    comp (the smallest node that links lead to), smallest doc_id and the rid of a row with that.
    """
    if not 50 < percent <= 100:
        raise ValueError("percent must be over 50 and up to 100")
    sketch = frequency_sketch(docs, width)
    signed = signatures(docs, width, percent, sketch)
    classes = signed.where("n > 0").groupBy("digest", "pdigest", "n").agg(F.min("rid").alias("node"), F.min("doc_id").alias("first_doc"), F.coalesce(F.min_by("rid", "doc_id"), F.min("rid")).alias("first_rid"))
    classes = stored(classes, "ngram-classes")
    groups = classes.groupBy("pdigest").agg(F.min("node").alias("gid"))
    members = stored(classes.join(groups, "pdigest").select("node", "gid", "n", "digest", "first_doc", "first_rid"), "ngram-members")
    some = signed.where("n > 0")
    followers = stored(some.select("rid").join(members.where("node = gid").select(F.col("gid").alias("rid")), "rid", "left_anti"), "ngram-followers")
    copies = stored(followers.join(members.select(F.col("node").alias("rid")), "rid", "left_anti"), "ngram-copies")
    bitmaps = stored(without(some.select("rid", "n", "bits"), "rid", copies).withColumnRenamed("rid", "node"), "ngram-bitmaps")

    entries = without(some.select("rid", "n", "prefix"), "rid", followers).select(F.col("rid").alias("gid"), "n", F.posexplode("prefix").alias("pos", "token"))
    listed = Window.partitionBy("token")
    entries = entries.withColumns({"lead": F.min(F.struct("pos", "gid", "n")).over(listed), "held": F.count(F.lit(1)).over(listed)}).where("held > 1")
    entries = stored(entries.select("token", "pos", "gid", "n", F.col("lead.gid").alias("lead_gid"), F.col("lead.pos").alias("lead_pos"), F.col("lead.n").alias("lead_n")), "ngram-entries")

    near = may_link(F.col("n"), F.col("pos"), F.col("lead_n"), F.col("lead_pos"), percent)
    star = entries.where((F.col("gid") != F.col("lead_gid")) & near).select(F.col("lead_gid").alias("a"), F.col("gid").alias("b")).distinct()
    inner = members.where("node <> gid").select(F.col("gid").alias("a"), F.col("node").alias("b"))
    first = stored(_bounded(star, bitmaps, percent).union(inner), "ngram-pairs")
    links = verified(docs, first, members, width, percent)
    known = stored(members.join(connected(links), "node", "left").withColumn("comp", F.coalesce("comp", "node")), "ngram-known")

    rest = stored(_cross_pairs(entries, known, bitmaps, percent), "ngram-pairs")
    if not rest.isEmpty():
        more = verified(docs, rest, members, width, percent)
        links = known.where("node <> comp").select(F.col("comp").alias("a"), F.col("node").alias("b")).union(more)
        known = stored(members.join(connected(links), "node", "left").withColumn("comp", F.coalesce("comp", "node")), "ngram-known")
    discard(first, rest, links, entries, classes, members, bitmaps, followers, copies)
    return signed, known


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row: documents link when 100 * intersection >= percent * union.

    component_id is the smallest doc_id that links lead to, its own included; rows with equal texts always share it. A
    null, empty or blank text has no shingles, links with nothing and is its own component. A null doc_id takes part in
    links but is never the smallest. Repeated rows all come back. An empty table gives an empty result.
    """
    signed, known = linked(docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("bigint").alias("doc_id"), "text"), width, percent)
    smallest = known.groupBy("comp").agg(F.min("first_doc").alias("component_id"))
    by_digest = known.select("digest", "comp").join(smallest, "comp").select("digest", "component_id")
    found = signed.select("doc_id", "n", "digest").join(by_digest, "digest", "left")
    return found.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def _cross_pairs(entries: DataFrame, known: DataFrame, bitmaps: DataFrame, percent: int) -> DataFrame:
    """Every pair of nodes from different components that the bounds allow and no verified link has joined yet.

    In the list of a shingle, a group is settled if all its nodes are in the one component of the leader's nodes. Two nodes
    of different components are not both in settled groups, so it is enough to join the others with the whole list. The
    members of a group have different sets, so pairs of groups become pairs of nodes before any bitmap is looked at.
    """
    comps = known.groupBy("gid").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    # The leader's components come from its own entry in the list, not from a join on leaders, of which few lead many lists.
    lead = F.max(F.when(F.col("gid") == F.col("lead_gid"), F.struct("lo", "hi"))).over(Window.partitionBy("token"))
    settled = (F.col("lo") == F.col("hi")) & (F.col("lead.lo") == F.col("lead.hi")) & (F.col("lo") == F.col("lead.lo"))
    judged = entries.join(comps, "gid").withColumn("lead", lead).select("token", "pos", "gid", "n", "lo", "hi", settled.alias("settled"))
    one = judged.where("not settled").select("token", *[F.col(c).alias(f"{c}1") for c in ("pos", "gid", "n", "lo", "hi")])
    two = judged.select("token", "settled", *[F.col(c).alias(f"{c}2") for c in ("pos", "gid", "n", "lo", "hi")])
    same = (F.col("lo1") == F.col("hi1")) & (F.col("lo2") == F.col("hi2")) & (F.col("lo1") == F.col("lo2"))
    ordered = F.when(F.col("settled"), F.col("gid1") != F.col("gid2")).otherwise(F.col("gid1") < F.col("gid2"))
    near = may_link(F.col("n1"), F.col("pos1"), F.col("n2"), F.col("pos2"), percent)
    met = one.join(two, (one["token"] == two["token"]) & ordered & ~same & near).select(F.least("gid1", "gid2").alias("a"), F.greatest("gid1", "gid2").alias("b")).distinct()
    each = known.select("gid", "node", "comp").join(bitmaps, "node")
    left = each.select(F.col("gid").alias("a"), F.col("node").alias("node1"), F.col("comp").alias("comp1"), F.col("bits").alias("x"), F.col("n").alias("n1"))
    right = each.select(F.col("gid").alias("b"), F.col("node").alias("node2"), F.col("comp").alias("comp2"), F.col("bits").alias("y"), F.col("n").alias("n2"))
    allowed = (F.col("comp1") != F.col("comp2")) & bitmaps_allow(F.col("x"), F.col("y"), F.col("n1"), F.col("n2"), percent)
    across = met.join(left, "a").join(right, "b").where(allowed).select(F.col("node1").alias("a"), F.col("node2").alias("b"))
    odd = known.join(comps, "gid").where("lo <> hi").select("gid", "node", "comp")
    head = odd.where("node = gid").select("gid", F.col("comp").alias("head"))
    minor = odd.join(head, "gid").where("comp <> head").select("gid", F.col("node").alias("a"), F.col("comp").alias("c1"))
    others = odd.join(head, "gid").select("gid", F.col("node").alias("b"), F.col("comp").alias("c2"), (F.col("comp") == F.col("head")).alias("main"))
    inside = minor.join(others, "gid").where((F.col("c1") != F.col("c2")) & (F.col("main") | (F.col("a") < F.col("b"))) & (F.col("b") != F.col("gid"))).select("a", "b")
    return across.union(inside)


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs of which one of each component is left: a row with the component's smallest doc_id, any one if it
    comes repeated, and a row without a doc_id only where the component has no other. Rows without shingles all stay.
    """
    whole = stored(docs.withColumn("_keep_rid", F.monotonically_increasing_id()), "ngram-docs")
    signed, known = linked(whole.select(F.col("_keep_rid").alias("rid"), F.col("doc_id").cast("bigint").alias("doc_id"), "text"), width, percent)
    first = known.groupBy("comp").agg(F.coalesce(F.min_by("first_rid", "first_doc"), F.min("first_rid")).alias("_keep_rid")).select("_keep_rid")
    gone = stored(signed.where("n > 0").select(F.col("rid").alias("_keep_rid")).join(first, "_keep_rid", "left_anti"), "ngram-gone")
    discard(signed, known)
    return without(whole, "_keep_rid", gone).select(*docs.columns)
