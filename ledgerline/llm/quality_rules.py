"""Quality rules as a learnt decision list: sequential covering grows and prunes threshold conjunctions, in order."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.labelled import labelled_sample
from ledgerline.llm.quality_ranker import featured
from ledgerline.llm.text_stats import FEATURES

MOST_LABELS = 4000


@dataclass(frozen=True)
class Rule:
    """A text is junk if every (statistic, sign, threshold) holds; sign is `>=` or `<=`."""

    terms: tuple[tuple[str, str, float], ...]

    def condition(self) -> Column:
        out = F.lit(True)
        for name, sign, at in self.terms:
            out = out & (F.col(name) >= at if sign == ">=" else F.col(name) <= at)
        return out

    def __str__(self) -> str:
        return " and ".join(f"{n} {s} {at:.6g}" for n, s, at in self.terms)


def _holds(x: np.ndarray, terms: list[tuple[int, str, float]]) -> np.ndarray:
    out = np.ones(len(x), dtype=bool)
    for j, sign, at in terms:
        out &= x[:, j] >= at if sign == ">=" else x[:, j] <= at
    return out


def _best_term(x: np.ndarray, junk: np.ndarray, cuts: list[np.ndarray], precise: float) -> tuple[int, str, float] | None:
    """The threshold that covers the most junk with precision `precise`; if none is so precise, that with the largest gain.

    The gain is the junk covered times the bits by which the rate of junk rises.
    """
    n0 = (~junk).sum()
    base, best = np.log2((junk.sum() + 1) / (len(junk) + 2)), None
    for j, edges in enumerate(cuts):
        for sign in (">=", "<="):
            for at in edges:
                on = x[:, j] >= at if sign == ">=" else x[:, j] <= at
                p, n = int((on & junk).sum()), int((on & ~junk).sum())
                gain = p * (np.log2((p + 1) / (p + n + 2)) - base)
                worth = (p >= 2 and p >= precise * (p + n), p if p >= precise * (p + n) else float(gain))
                if p and n < n0 and gain > 0 and (best is None or worth > best[0]):
                    best = (worth, (j, sign, float(at)))
    return best and best[1]


def learn_rules(x: np.ndarray, junk: np.ndarray, most_rules: int = 12, most_terms: int = 3, least_precision: float = 0.9, seed: int = 3) -> list[list[tuple[int, str, float]]]:
    """Grows each rule on two thirds of the rows that no rule covers yet and prunes it on the rest.

    Learning ends when the best rule's precision on the pruning rows falls below `least_precision`.
    """
    rng = np.random.default_rng(seed)
    left, rules = np.arange(len(x)), []
    while len(rules) < most_rules and junk[left].sum() >= 3:
        mixed = rng.permutation(left)
        third = len(mixed) // 3
        prune, grow = mixed[:third], mixed[third:]
        terms: list[tuple[int, str, float]] = []
        on = grow
        while len(terms) < most_terms and junk[on].any() and junk[on].mean() < (1 + least_precision) / 2:
            edges = [np.unique(np.quantile(c, np.linspace(0, 1, 41))) for c in x[on].T]
            edges = [(e[1:] + e[:-1]) / 2 for e in edges]
            found = _best_term(x[on], junk[on], edges, (1 + least_precision) / 2)
            if found is None:
                break
            terms.append(found)
            on = grow[_holds(x[grow], terms)]

        def worth(t: list[tuple[int, str, float]]) -> float:
            hit = _holds(x[prune], t)
            p, n = (hit & junk[prune]).sum(), (hit & ~junk[prune]).sum()
            return (p - n) / (p + n) if p + n else -1.0

        while len(terms) > 1 and worth(terms[:-1]) >= worth(terms):
            terms.pop()
        every = _holds(x[left], terms)
        good, bad = (every & junk[left]).sum(), (every & ~junk[left]).sum()
        if not terms or good < 2 or good < least_precision * (good + bad) or worth(terms) < 2 * least_precision - 1 - 0.1:
            break
        rules.append(terms)
        left = left[~every]
    return rules


def train_rules(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = MOST_LABELS) -> tuple[Rule, ...]:
    """The ordered rules for label 0, learnt from a bounded sample; none without labels of both classes."""
    rows = featured(labelled_sample(docs.select("doc_id", "text"), labels, label, most)).select("_label", "doc_id", *FEATURES).collect()
    rows.sort(key=lambda r: (r.doc_id, tuple(r)))
    junk = np.array([r[0] == 0 for r in rows], dtype=bool)
    if junk.all() or not junk.any():
        return ()
    learnt = learn_rules(np.array([tuple(r)[2:] for r in rows], dtype=float), junk)
    return tuple(Rule(tuple((FEATURES[j], sign, at) for j, sign, at in terms)) for terms in learnt)


def first_rule(rules: tuple[Rule, ...]) -> Column:
    """The number of the first rule that a row with the statistics fits, from 1; null if none."""
    out = F.lit(None).cast("int")
    for k in range(len(rules), 0, -1):
        out = F.when(rules[k - 1].condition(), F.lit(k)).otherwise(out)
    return out


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def judge_quality(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(doc_id, the counts, base_failed, kept, rule) for every row, from the whole text.

    A null, empty or blank text has no words, so it fails the base and is not kept. Repeated rows agree.
    """
    judged = featured(docs.select("doc_id", "text")).withColumn("base_failed", base_failed()).withColumn("rule", first_rule(rules))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.col("rule").isNull()).alias("kept"), F.when(~F.col("base_failed"), F.col("rule")).alias("rule"),
    )
