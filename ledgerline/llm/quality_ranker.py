"""Document quality by Bradley-Terry ranking: weights learnt from preference pairs, then a cut at a score quantile."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import held_out
from ledgerline.llm.labelled import class_shares, labelled_sample
from ledgerline.llm.text_stats import FEATURES, ratios, with_counts

#: At most so many labels of each class are learnt from, in so many preference pairs.
MOST_LABELS = 4000
PAIRS = 40_000


@dataclass(frozen=True)
class Ranker:
    """The score of a text is sigmoid(sharpness * (weights . scaled features - cut))."""

    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    cut: float
    sharpness: float

    def score(self) -> Column:
        raw = F.lit(-self.cut)
        for name, m, s, w in zip(FEATURES, self.mean, self.scale, self.weights):
            raw = raw + F.greatest(F.least((squeezed(name) - m) / s, F.lit(8.0)), F.lit(-8.0)) * F.lit(w)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-raw * self.sharpness))


def squeezed(name: str) -> Column:
    """Square roots spread the small shares, where most texts lie."""
    return F.col(name) if name in ("mean_word", "log_words") else F.sqrt(F.col(name))


def featured(df: DataFrame, text: str = "text") -> DataFrame:
    """df without its text, with the statistics of it."""
    return with_counts(df, text).withColumns(ratios())


def fit_pairs(x: np.ndarray, y: np.ndarray, share_bad: float, pairs: int = PAIRS, rounds: int = 400, seed: int = 7) -> tuple[np.ndarray, float, float]:
    """Weights from the logistic loss on feature differences of (preferred, other) pairs; then the cut.

    The cut is the quantile of the scores at `share_bad`, the labelled share of rejected texts, over the sample weighted
    to that share; the sharpness makes the spread of scores around it 1.
    """
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    rng = np.random.default_rng(seed)
    d = x[rng.choice(good, pairs)] - x[rng.choice(bad, pairs)]
    w, speed = np.zeros(x.shape[1]), np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))
        speed = 0.9 * speed + (d.T @ p) / pairs - 2e-3 * w
        w = w + 0.5 * speed
    raw = x @ w
    weight = np.where(y == 1, (1 - share_bad) / len(good), share_bad / len(bad))
    order = np.argsort(raw, kind="stable")
    reached = np.cumsum(weight[order])
    at = min(int(np.searchsorted(reached, share_bad - 1e-9)), len(raw) - 2)
    return w, float((raw[order[at]] + raw[order[at + 1]]) / 2), float(4 / max(raw.std(), 1e-6))


def train_ranker(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = MOST_LABELS) -> Ranker | None:
    """None where the labels that may be learnt from are of one class or none."""
    names = [squeezed(n).alias(n) for n in FEATURES]
    rows = featured(labelled_sample(docs.select("doc_id", "text"), labels, label, most)).select("_label", "doc_id", *names).collect()
    rows.sort(key=lambda r: (r.doc_id, tuple(r)))
    y = np.array([r[0] for r in rows])
    if len(set(y.tolist())) < 2:
        return None
    x = np.array([tuple(r)[2:] for r in rows], dtype=float)
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    bad, good = class_shares(labels, label)
    w, cut, sharpness = fit_pairs(np.clip((x - mean) / scale, -8, 8), y, bad / (bad + good))
    return Ranker(tuple(map(float, mean)), tuple(map(float, scale)), tuple(map(float, w)), cut, sharpness)


def score_quality(docs: DataFrame, ranker: Ranker | None) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of docs, repeated rows included, from the whole text.

    A null or empty text has the score of its all-zero statistics. Without a ranker all score 0.5 and are kept.
    """
    base = docs.select("doc_id", "text")
    scored = base.withColumn("score", F.lit(0.5)) if ranker is None else featured(base).withColumn("score", ranker.score())
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score").withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
