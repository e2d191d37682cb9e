"""Periodic runs of words (something said over and over) by Crochemore's partition refinement, and texts without them.

Places of a text fall into classes: at level p, two places are alike if the p words from them on are equal. A level's
classes split into the next one's by the class of the place after. Two neighbours in a class of level p that lie p apart
are a square of period p; squares at consecutive places are one run. A place that is alone in its class can't be part of
any longer repeat, and leaves.

While much of the text still moves, as in the first levels of prose, a level is one numpy sort. When little moves, only the
smaller parts of split classes are followed, in linked lists, so that a text takes n log n steps however it repeats.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, LongType, StructType

from ledgerline.llm.common import arrow_map, schema_with

RUNS = ArrayType(StructType().add("start", LongType()).add("length", LongType()).add("period", LongType()))
#: A level is sorted whole while more than one in so many of its places moves.
SHARE = 8


def _stretches(places: np.ndarray, period: int, least: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs whose squares begin at the given rising places, those of `least` words and more."""
    if len(places) <= least - 2 * period:
        return []
    edge = np.flatnonzero(np.diff(places) != 1)
    first, last = places[np.r_[0, edge + 1]], places[np.r_[edge, len(places) - 1]]
    return [(s, e - s + 2 * period, period) for s, e in zip(first.tolist(), last.tolist()) if e - s + 2 * period >= least]


class _Chains:
    """The classes of one level as linked lists, and what of them moves on to the next level.

    `small` holds the parts that left a class at the last step; its other places go on together.
    """

    def __init__(self, n: int, level: int, most: int, at: np.ndarray, group: np.ndarray, small: list[list[int]]) -> None:
        follows = np.flatnonzero(group[1:] == group[:-1])
        after, before, kind = (np.full(n + 1, -1, dtype=np.int64) for _ in range(3))
        after[at[follows]], before[at[follows + 1]], kind[at] = at[follows + 1], at[follows], group
        self.after, self.before, self.kind = after.tolist(), before.tolist(), kind.tolist()
        begins = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        self.head = dict(zip(group[begins].tolist(), at[begins].tolist()))
        self.size = dict(zip(group[begins].tolist(), np.diff(np.r_[begins, len(at)]).tolist()))
        self.n, self.level, self.most, self.small, self.live = n, level, most, small, len(at)
        self.fresh = int(group[-1]) + 1
        gaps = at[follows + 1] - at[follows]
        order = np.argsort(gaps, kind="stable")
        order = order[(gaps[order] >= level) & (gaps[order] <= most)]
        cuts = np.flatnonzero(np.diff(gaps[order])) + 1
        self.by_gap = {int(gaps[part[0]]): at[follows[part]].tolist() for part in np.split(order, cuts) if len(part)}

    def squares(self) -> np.ndarray:
        """Places with a neighbour as far as the level says; what lies in the list of a distance may have moved since."""
        p = self.level
        return np.array(sorted({i for i in self.by_gap.pop(p, ()) if self.kind[i] >= 0 and self.after[i] - i == p}), dtype=np.int64)

    def _near(self, i: int, j: int) -> None:
        if self.level < j - i <= self.most:
            self.by_gap.setdefault(j - i, []).append(i)

    def _unlink(self, i: int, k: int) -> None:
        a, b = self.before[i], self.after[i]
        if a >= 0:
            self.after[a] = b
        else:
            self.head[k] = b
        if b >= 0:
            self.before[b] = a
            if a >= 0:
                self._near(a, b)
        self.before[i] = self.after[i] = -1
        self.size[k] -= 1

    def _leave(self, k: int) -> None:
        """Lets the last place of a class go."""
        if self.size[k] == 1:
            self.kind[self.head[k]] = -1
            self.live -= 1
        if self.size[k] <= 1:
            del self.size[k], self.head[k]

    def step(self) -> None:
        end = self.n - self.level
        if (k := self.kind[end]) >= 0:
            self._unlink(end, k)
            self.kind[end] = -1
            self.live -= 1
            self._leave(k)
        moved: dict[int, list[list[int]]] = {}
        for part in self.small:
            into: dict[int, list[int]] = {}
            for j in part:
                if j and (k := self.kind[j - 1]) >= 0:
                    into.setdefault(k, []).append(j - 1)
            for k, places in into.items():
                moved.setdefault(k, []).append(places)
        self.small = []
        for k, parts in moved.items():
            rest = self.size[k] - sum(map(len, parts))
            if not rest and len(parts) == 1:
                continue
            largest = max(parts, key=len)
            for places in parts:
                self._split(k, places)
            if rest >= len(largest):
                self.small += parts
            else:
                self.small += [x for x in parts if x is not largest]
                if rest:
                    self.small.append(self._members(k))
            self._leave(k)
        self.level += 1

    def _split(self, k: int, places: list[int]) -> None:
        for i in places:
            self._unlink(i, k)
        if len(places) == 1:
            self.kind[places[0]] = -1
            self.live -= 1
            return
        c, self.fresh = self.fresh, self.fresh + 1
        self.head[c], self.size[c] = places[0], len(places)
        for i, j in zip(places, places[1:]):
            self.after[i], self.before[j] = j, i
            self._near(i, j)
        for i in places:
            self.kind[i] = c

    def _members(self, k: int) -> list[int]:
        out, i = [], self.head[k]
        while i >= 0:
            out.append(i)
            i = self.after[i]
        return out


def find_runs(words: np.ndarray, least: int = 6, exponent: int = 4) -> list[tuple[int, int, int]]:
    """(start, length, period) of every maximal run of numbered words, by start and then period.

    A run has its smallest period q, and max(least, exponent * q) words or more; exponent is 2 at least.
    """
    if exponent < 2:
        raise ValueError("a run repeats its period at least twice")
    n = len(words)
    most, runs = n // exponent, []
    at, keys, group, gone = np.arange(n), words.astype(np.int64), np.zeros(n, dtype=np.int64), None
    for p in range(1, most + 1):
        if not len(at):
            break
        order = np.argsort(keys, kind="stable")
        keys, at, above = keys[order], at[order], group[order]
        first = np.r_[True, keys[1:] != keys[:-1]]
        size = np.diff(np.r_[np.flatnonzero(first), len(at)])
        child = np.cumsum(first) - 1
        again = size[child] > 1
        whole, parent_of = at, above[first]
        at, group = at[again], child[again]
        if not len(at):
            break
        same = (group[1:] == group[:-1]) & (at[1:] - at[:-1] == p)
        runs += _stretches(np.sort(at[:-1][same]), p, max(least, exponent * p))
        # The largest part of each class above, which needn't be followed.
        largest = np.lexsort((size, parent_of))
        largest = largest[np.r_[parent_of[largest][1:] != parent_of[largest][:-1], True]]
        stays = np.zeros(len(size), dtype=bool)
        stays[largest] = size[largest] > 1
        moves = ~stays[child]
        if gone is not None and SHARE * (int(moves.sum()) + len(gone)) < len(at):
            places = whole[moves]
            small = [x.tolist() for x in np.split(places, np.flatnonzero(np.diff(child[moves])) + 1)] if len(places) else []
            chains = _Chains(n, p, most, at, group, small + [[i] for i in gone.tolist()])
            while True:
                chains.step()
                if chains.level > most or chains.live < 2:
                    break
                runs += _stretches(chains.squares(), chains.level, max(least, exponent * chains.level))
            break
        kind = np.full(n + 1, -1, dtype=np.int64)
        kind[at] = group
        next_kind = kind[at + 1]
        on = next_kind >= 0
        gone = at[~on]
        keys = group[on] * (int(group[-1]) + 1) + next_kind[on]
        at, group = at[on], group[on]
    return sorted((s, length, q) for s, length, q in runs)


def without_runs(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    inside = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        inside[start + period] += 1
        inside[start + length] -= 1
    return [w for w, k in zip(words, np.cumsum(inside).tolist()) if not k]


def periodic_runs(docs: DataFrame, text: str = "text", least: int = 6, exponent: int = 4) -> DataFrame:
    """docs with `runs` (start, length and period in words, by start and period) and `collapsed`: the words that no run holds
    after its first period, with one blank between. Columns of those names are replaced.

    Words lie between ASCII white space. A null, empty or blank text has no run and collapses to the empty string. Each
    row is worked on by itself, so repeated rows agree, an empty table stays empty, and a task holds one text at a time.
    """
    base = docs.drop("runs", "collapsed")
    own, schema = base.columns, schema_with(base, runs=RUNS, collapsed="string")
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs, collapsed = [], []
            for value in batch.column(text):
                words = (value.as_py() or "").encode("utf-8", "surrogatepass").split()
                known: dict[bytes, int] = {}
                ids = np.fromiter((known.setdefault(w, len(known)) for w in words), dtype=np.int64, count=len(words))
                mine = find_runs(ids, least, exponent)
                runs.append([{"start": s, "length": length, "period": q} for s, length, q in mine])
                collapsed.append(b" ".join(without_runs(words, mine)).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in own], pa.array(runs, kind), pa.array(collapsed, pa.string())], names=schema.names)

    return arrow_map(base, found, schema)
