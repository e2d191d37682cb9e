"""Toxicity by a convolutional text classifier over hashed word embeddings, trained in numpy."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import arrow_map, held_out, keeping_own, schema_with
from ledgerline.llm.decontaminate import normal_words
from ledgerline.llm.labelled import labelled_sample

#: Buckets of the hashed embeddings, their size, the filter widths, and filters of each width.
BUCKETS, SIZE, WIDTHS, FILTERS = 1 << 18, 16, (1, 2, 3), 8
#: At most so many labels of each class are learnt from.
MOST_LABELS = 1500
#: Words that training works on at once.
SEGMENT = 1 << 15
#: The score from which a text counts as toxic.
LEVEL = 0.7
#: A bucket is trained if so many texts hold it.
LEAST = 4
#: Frequent words that tell the language of a text, from the text alone, for the thresholds.
STOP_WORDS = {
    "de": "der die das und ist von den des sich mit ein eine dem nicht auf für im",
    "en": "the of and to in is that it for was on with as by this are from",
    "es": "el los que y en por con las del se su para al una más como no",
    "fr": "le les et des du une dans qui pour pas sur au avec est un ne",
}
_MARKS = {w.encode(): k for k, words in enumerate(STOP_WORDS.values()) for w in words.split()}
_LANGS = (*STOP_WORDS, "other")
_PAD = 0


def _buckets(word: bytes) -> tuple[int, int, int]:
    """Of the word, its first 4 and its first 6 characters; bucket 0 stays empty."""
    text = word.decode("utf-8", "replace")
    return tuple(1 + zlib.crc32(mark + part) % (BUCKETS - 1) for mark, part in ((b"w", word), (b"4", text[:4].encode()), (b"6", text[:6].encode())))


def language_of(words: list[bytes]) -> int:
    """The language whose frequent words the text holds most of; `other` if it holds none."""
    n = [0] * len(STOP_WORDS)
    for w in words:
        if (k := _MARKS.get(w)) is not None:
            n[k] += 1
    return n.index(max(n)) if any(n) else len(n)


@dataclass
class Net:
    """Embeddings, filters[w][j] (what position j of a width-w window adds), their bias, and the output layer."""

    table: np.ndarray
    filters: list[np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    cuts: tuple[float, ...] = ()
    steep: float = 1.0

    def projections(self) -> np.ndarray:
        """For each bucket, what it adds at each position of each filter: a convolution is then a sum of looked-up rows."""
        return np.concatenate([self.table.astype(np.float32) @ w[j].astype(np.float32) for w in self.filters for j in range(len(w))], axis=1)

    def packed(self) -> tuple[np.ndarray, np.ndarray]:
        """The rows of projections() that aren't zero, after a row of zeros, and the row of each bucket: most were never trained."""
        whole = self.projections()
        used = whole.any(axis=1)
        return np.concatenate([np.zeros((1, whole.shape[1]), whole.dtype), whole[used]]), np.where(used, np.cumsum(used), 0).astype(np.int32)

    def score(self, pooled: np.ndarray, langs: np.ndarray) -> np.ndarray:
        z = np.maximum(pooled + self.bias, 0) @ self.out + self.out_bias
        cut = np.asarray(self.cuts)[langs]
        return 1 / (1 + np.exp(-np.clip(self.steep * (z - cut) + np.log(LEVEL / (1 - LEVEL)), -30, 30)))


class Encoder:
    """Rows of the projection sums of words, kept for the words seen last; at most `most` words at a time."""

    def __init__(self, tables: np.ndarray, most: int = 1 << 16, places: np.ndarray | None = None) -> None:
        """places, if given, tells the row of each bucket in tables."""
        self.tables, self.most, self.places = tables, most, places
        self.rows = np.zeros((most + 1, tables.shape[1]), dtype=np.float32)  # row 0 is the padding
        self.known: dict[bytes, int] = {}

    def ids(self, words: list[bytes]) -> np.ndarray:
        new = [w for w in set(words) if w not in self.known]
        if len(self.known) + len(new) > self.most:
            self.known = {}
            new = list(set(words))
        if new:
            first = len(self.known) + 1
            buckets = np.array([_buckets(w) for w in new])
            self.rows[first : first + len(new)] = self.tables[buckets if self.places is None else self.places[buckets]].sum(axis=1)
            self.known.update(zip(new, range(first, first + len(new))))
        return np.fromiter(map(self.known.__getitem__, words), dtype=np.int64, count=len(words))


def pooled_over(encoder: Encoder, words: list[bytes], chunk: int = 20_000) -> np.ndarray:
    """The largest answer of each filter over all windows of a whole text, chunk by chunk; windows may run over its end."""
    best = np.full(len(WIDTHS) * FILTERS, -np.inf, dtype=np.float32)
    longest = max(WIDTHS) - 1
    for at in range(0, max(len(words), 1), chunk):
        ids = encoder.ids(words[at : at + chunk + longest])
        n = max(1, min(chunk, len(words) - at))
        rows = encoder.rows[np.concatenate([ids, np.zeros(max(0, n + longest - len(ids)), dtype=np.int64)])]
        column = 0
        for k, width in enumerate(WIDTHS):
            answer = rows[:n, column : column + FILTERS]
            for j in range(1, width):
                answer = answer + rows[j : j + n, column + j * FILTERS : column + (j + 1) * FILTERS]
            column += width * FILTERS
            part = slice(k * FILTERS, (k + 1) * FILTERS)
            best[part] = np.maximum(best[part], answer.max(axis=0))
    return best


def bucket_ids(words: list[bytes], cache: dict[bytes, tuple[int, int, int]]) -> np.ndarray:
    """The buckets of each word, and of the padding after the last."""
    for w in set(words):
        if w not in cache:
            cache[w] = _buckets(w)
    ids = np.array([cache[w] for w in words], dtype=np.int32).reshape(-1, 3)
    return np.concatenate([ids, np.full((max(WIDTHS), 3), _PAD, dtype=np.int32)])


def pool_ids(net: Net, docs: list[np.ndarray], most: int = SEGMENT) -> tuple[np.ndarray, list[np.ndarray]]:
    """The largest answer of each filter over all windows of each text, and where: [text, filter] first words.

    Texts are worked on in segments, and as many segments at once as hold `most` words or so, so that memory doesn't follow
    the longest text.
    """
    longest = max(WIDTHS)
    best = np.full((len(docs), len(WIDTHS) * FILTERS), -np.inf)
    places = [np.zeros((len(docs), FILTERS), dtype=np.int64) for _ in WIDTHS]
    segments = [(i, at, min(at + most, max(len(d) - longest + 1, 1))) for i, d in enumerate(docs) for at in range(0, max(len(d) - longest + 1, 1), most)]
    while segments:
        taken, n = 0, 0
        while taken < len(segments) and (not taken or n + segments[taken][2] - segments[taken][1] <= most):
            n += segments[taken][2] - segments[taken][1] + longest - 1
            taken += 1
        now, segments = segments[:taken], segments[taken:]
        ids = np.concatenate([docs[i][at : end + longest - 1] for i, at, end in now])
        x = net.table[ids[:, 0]]
        x += net.table[ids[:, 1]]
        x += net.table[ids[:, 2]]
        for k, w in enumerate(net.filters):
            answer = sum(x[j : len(x) - longest + 1 + j] @ w[j] for j in range(len(w)))
            part, start = slice(k * FILTERS, (k + 1) * FILTERS), 0
            for i, at, end in now:
                mine = answer[start : start + end - at]
                place = mine.argmax(axis=0)
                value = mine[place, np.arange(FILTERS)]
                better = value > best[i, part]
                places[k][i] = np.where(better, at + place, places[k][i])
                best[i, part] = np.where(better, value, best[i, part])
                start += end - at + longest - 1
    return best, places


def train_net(docs: list[np.ndarray], y: np.ndarray, epochs: int = 6, batch: int = 48, seed: int = 5) -> Net:
    """Adam (plain descent for the embeddings) on the logistic loss, both classes weighing alike, over texts as bucket_ids().

    Only a bucket that LEAST texts hold is ever trained.

    Buckets of unseen words stay zero, so they add nothing to a window.
    """
    rng = np.random.default_rng(seed)
    held = np.zeros((2, BUCKETS))
    for ids, label in zip(docs, y):
        held[int(label), np.unique(ids)] += 1
    trained = held.sum(axis=0) >= LEAST
    trained[_PAD] = False
    net = Net(
        rng.normal(0, 0.05, (BUCKETS, SIZE)) * trained[:, None],
        [rng.normal(0, 0.3, (w, SIZE, FILTERS)) for w in WIDTHS], np.full(len(WIDTHS) * FILTERS, 0.05),
        rng.normal(0, 0.3, len(WIDTHS) * FILTERS), 0.0,
    )
    # The first number of an embedding starts as the z-score of how much more texts of class 1 hold its bucket.
    n0, n1 = max((1 - y).sum(), 1), max(y.sum(), 1)
    rate = np.clip(held.sum(axis=0) / len(docs), 1e-9, 1 - 1e-9)
    z = (held[1] / n1 - held[0] / n0) / np.sqrt(rate * (1 - rate) * (1 / n0 + 1 / n1)) * trained
    net.table[:, 0] = 2 * np.clip(z / max(z.max(), 1e-9), -1, 1)
    for w in net.filters:
        w[:, 0, :] = np.abs(w[:, 0, :])
    params = [*net.filters, net.bias, net.out]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    share = np.clip(y.mean(), 0.05, 0.95)
    step, out_bias = 0, 0.0
    for _ in range(epochs):
        order = rng.permutation(len(docs))
        for at in range(0, len(order), batch):
            mine = order[at : at + batch]
            pooled, places = pool_ids(net, [docs[i] for i in mine])
            hidden = pooled + net.bias
            active = np.maximum(hidden, 0)
            p = 1 / (1 + np.exp(-np.clip(active @ net.out + out_bias, -30, 30)))
            g = (p - y[mine]) * np.where(y[mine] == 1, 0.5 / share, 0.5 / (1 - share)) / len(mine)
            back = np.outer(g, net.out) * (hidden > 0)
            hits = [[np.stack([docs[i][at + j] for i, at in zip(mine, places[k])]) for j in range(len(w))] for k, w in enumerate(net.filters)]  # [text, filter, 3] buckets
            rows = [[net.table[hit].sum(axis=2) for hit in each] for each in hits]  # as they were before this step
            grads = []
            for k, w in enumerate(net.filters):
                part = back[:, k * FILTERS : (k + 1) * FILTERS]
                grads.append(np.zeros_like(w))
                for j in range(len(w)):
                    hit = hits[k][j]
                    grads[-1][j] = np.einsum("bfd,bf->df", rows[k][j], part)
                    into = part[:, :, None] * w[j].T[None]
                    for b in range(3):  # plain steps: scaled ones would let words of a single text grow like those of many
                        np.add.at(net.table, hit[:, :, b], -0.05 * into * trained[hit[:, :, b]][:, :, None])
            grads += [back.sum(axis=0), active.T @ g + 1e-4 * net.out]
            step += 1
            out_bias -= 0.01 * g.sum()
            for q, (param, grad) in enumerate(zip(params, grads)):
                first[q] = 0.9 * first[q] + 0.1 * grad
                second[q] = 0.999 * second[q] + 0.001 * grad * grad
                param -= 0.01 * (first[q] / (1 - 0.9**step)) / (np.sqrt(second[q] / (1 - 0.999**step)) + 1e-8)
    net.out_bias = out_bias
    return net


def best_cut(z: np.ndarray, y: np.ndarray) -> float:
    """The middle of the gap between two scores at which the errors cost least: the share of class 1 missed, and 3 times that of class 0 flagged."""
    order = np.argsort(z, kind="stable")
    z, y = z[order], y[order]
    missed = np.concatenate([[0], np.cumsum(y)]) / max(y.sum(), 1)
    false = 1 - np.concatenate([[0], np.cumsum(1 - y)]) / max((1 - y).sum(), 1)
    cost = missed + 3 * false
    least = np.flatnonzero(cost <= cost.min() + 1e-12)
    edges = np.concatenate([[z[0] - 1], (z[1:] + z[:-1]) / 2, [z[-1] + 1]])
    widths = np.concatenate([[0], np.diff(z), [0]])
    return float(edges[least[np.argmax(widths[least])]])


def calibrate(net: Net, z: np.ndarray, y: np.ndarray, langs: np.ndarray, least: int = 10) -> None:
    """A cut for each language of the text itself; one with under `least` texts of either class takes the cut of all."""
    whole, cuts = best_cut(z, y), []
    for k in range(len(_LANGS)):
        on = langs == k
        enough = min(y[on].sum(), (1 - y[on]).sum()) >= least
        cuts.append(best_cut(z[on], y[on]) if enough else whole)
    net.cuts, net.steep = tuple(cuts), float(6 / max(z.std(), 1e-6))


def train_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", most: int = MOST_LABELS) -> Net | None:
    """Trains on three quarters of a bounded labelled sample and calibrates on the rest; None without both classes.

    A sample whose rest holds under 20 texts of a class is calibrated as a whole.
    """
    rows = labelled_sample(docs.select("doc_id", "text"), labels, label, most).select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "_label").collect()
    rows.sort(key=lambda r: (r.doc_id, r.text))
    y = np.array([r._label for r in rows], dtype=float)
    if len(set(y.tolist())) < 2:
        return None
    cache: dict[bytes, tuple[int, int, int]] = {}
    texts, langs = [], []
    while rows:  # a text is let go once its buckets are known
        words = normal_words(rows.pop(0).text)
        texts.append(bucket_ids(words, cache))
        langs.append(language_of(words))
    learn = np.arange(len(texts)) % 4 != 0
    if len(set(y[learn].tolist())) < 2:
        learn[:] = True
    net = train_net([t for t, on in zip(texts, learn) if on], y[learn])
    pooled = np.concatenate([pool_ids(net, texts[i : i + 48])[0] for i in range(0, len(texts), 48)])
    z = np.maximum(pooled + net.bias, 0) @ net.out + net.out_bias
    fresh = ~learn if min(y[~learn].sum(), (1 - y[~learn]).sum()) >= 20 else np.ones(len(y), dtype=bool)
    calibrate(net, z[fresh], y[fresh], np.array(langs)[fresh])
    return net


def score_toxicity(docs: DataFrame, net: Net | None) -> DataFrame:
    """Adds held_out, score and predicted to every row from its whole text; replaces columns of those names.

    A null or empty text is scored as padding alone. Without a net all score 0. Only the text reaches the score: the
    language that picks the threshold is told from its own words. The net sent to each task is of fixed size.
    """
    base = docs.drop("held_out", "score", "predicted")
    if net is None:
        scored = base.withColumn("score", F.lit(0.0))
    else:
        # Workers hold what they score with, not the embeddings that it comes from.
        shared, tables = docs.sparkSession.sparkContext.broadcast(replace(net, table=net.table[:0], filters=[])), docs.sparkSession.sparkContext.broadcast(net.packed())
        at = base.columns.index("text")

        def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows, places = tables.value
            encoder, mine = Encoder(rows, places=places), shared.value
            for batch in batches:
                pooled, langs = [], []
                for text in batch.column(at):
                    words = normal_words(text.as_py())
                    pooled.append(pooled_over(encoder, words))
                    langs.append(language_of(words))
                scores = mine.score(np.stack(pooled), np.array(langs)) if pooled else np.zeros(0)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, "score"])

        scored = arrow_map(base, judged, schema_with(base, score="double"))
    return scored.withColumns({"held_out": held_out(F.col("doc_id")), "predicted": (F.col("score") >= LEVEL).cast("int")})


def without_toxic(docs: DataFrame, net: Net | None) -> DataFrame:
    """The documents that the net doesn't call toxic, with their own columns as they were."""
    return keeping_own(docs, ("held_out", "score", "predicted"), lambda d: score_toxicity(d, net).where("predicted = 0"))
