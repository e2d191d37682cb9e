"""URL rules as one bit-parallel wildcard automaton that runs all patterns at once over each canonical URL."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import arrow_map, schema_with

#: The rules of production, as (host and path prefix, verdict).
RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)
#: Host globs that decide where no rule fits. What neither decides is allowed.
GLOBS = tuple(
    (f"*{part}*#*", "block")
    for part in (
        "free-bets", "spam-farm", "casino", "pharma-deals", "poker-", "slots-", "lottery-win", "payday-loan", "replica-watch", "viagra", "warez", "torrent-", "phish", "malware", "adult-", "xxx", "escort-",
        "free-followers", "crypto-giveaway", "clickbait", "pills",
    )
)
#: Cells of the matrix of bytes that one pass works on.
CELLS = 1 << 24


@dataclass(frozen=True)
class Automaton:
    """One bit a pattern state, in 64-bit words. `step[c]` has the states that byte c may lead into, `stay` those before a `*`."""

    step: np.ndarray
    start: np.ndarray
    stay: np.ndarray
    ends: tuple[tuple[int, int], ...]  # of each pattern: the word and bit of its last state

    def matches(self, texts: list[bytes]) -> np.ndarray:
        """A row a text, a column a pattern: whether the whole text fits the pattern.

        The texts go from long to short, as rows of a matrix of bytes of at most CELLS or of one text, so that each position
        is a slice of it and updates only the texts that reach it.
        """
        order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
        found, at = np.empty((len(texts), len(self.ends)), dtype=bool), 0
        while at < len(order):
            rows = order[at : at + max(1, CELLS // max(1, len(texts[order[at]])))]
            found[rows] = self._matched([texts[i] for i in rows])
            at += len(rows)
        return found

    def _matched(self, texts: list[bytes]) -> np.ndarray:
        width = len(texts[0])
        cells = np.frombuffer(b"".join(t.ljust(width, b"\0") for t in texts), dtype=np.uint8).reshape(len(texts), width)
        reach = np.searchsorted(-np.array([len(t) for t in texts]), -np.arange(width), side="left")
        state = np.tile(self.start, (len(texts), 1))
        for at, live in enumerate(reach.tolist()):
            now = state[:live]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:live] = (moved & self.step[cells[:live, at]]) | (now & self.stay)
        return np.stack([(state[:, word] >> np.uint64(bit)) & np.uint64(1) == 1 for word, bit in self.ends], axis=1) if self.ends else np.empty((len(texts), 0), dtype=bool)


def compile_globs(globs: list[str]) -> Automaton:
    """`*` stands for any bytes, `?` for one byte; all else for itself. A pattern must fit the whole text."""
    starts, stays, steps, ends, at = [], [], [], [], 0
    for glob in globs:
        starts.append(at)
        for c in glob.encode():
            if c == ord("*"):
                stays.append(at)
            else:
                at += 1
                steps.append((at, None if c == ord("?") else c))
        ends.append(at)
        at += 1
    words = at // 64 + 1

    def mask(bits: list[int]) -> np.ndarray:
        out = np.zeros(words, dtype=np.uint64)
        for b in bits:
            out[b // 64] |= np.uint64(1 << (b % 64))
        return out

    step = np.stack([mask([b for b, want in steps if want is None or want == c]) for c in range(256)])
    return Automaton(step, mask(starts), mask(stays), tuple((e // 64, e % 64) for e in ends))


def rule_globs(rules: tuple[tuple[str, str], ...]) -> list[tuple[str, int]]:
    """Each rule as globs over `host#path` (neither holds a `#`): its host itself and every subdomain."""
    out = []
    for k, (rule, _) in enumerate(rules):
        host, slash, path = rule.partition("/")
        out += [(f"{host}#{slash}{path}*", k), (f"*.{host}#{slash}{path}*", k)]
    return out


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, with A-Z in lower case; empty for null or without `://`."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    found = F.coalesce(F.regexp_extract(rest, r"^[^/?#]*", 0), F.lit(""))
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """From the host's end up to `?`, `#` or the end; empty for null or without `://`."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def judge_urls(
    df: DataFrame, url: str = "url", rules: tuple[tuple[str, str], ...] = RULES, globs: tuple[tuple[str, str], ...] = GLOBS, batch: int = 4096
) -> DataFrame:
    """Adds host, path, rule (the longest that fits, else null) and verdict; replaces columns of those names.

    A null url, or one without `://`, has an empty host and path, fits no rule and is allowed. Every row is judged by
    itself, so repeated rows agree and an empty table stays empty. Memory: at most `batch` URLs and their states at once.
    """
    base = df.drop("rule", "verdict").withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    owned = rule_globs(rules)
    patterns = [g for g, _ in owned] + [g for g, _ in globs]
    schema = schema_with(base, rule="string", verdict="string")

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = compile_globs(patterns)
        for whole in batches:
            for from_row in range(0, whole.num_rows, batch):
                part = whole.slice(from_row, batch)
                hosts, paths = part.column("host").to_pylist(), part.column("path").to_pylist()
                found = automaton.matches([f"{h}#{p}".encode() for h, p in zip(hosts, paths)])
                names, verdicts = [], []
                for row in found:
                    hit = np.flatnonzero(row).tolist()
                    mine = max((owned[k][1] for k in hit if k < len(owned)), key=lambda k: len(rules[k][0]), default=None)
                    other = next((globs[k - len(owned)][1] for k in hit if k >= len(owned)), "allow")
                    names.append(None if mine is None else rules[mine][0])
                    verdicts.append(other if mine is None else rules[mine][1])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(names, pa.string()), pa.array(verdicts, pa.string())], names=[*part.schema.names, "rule", "verdict"])

    return arrow_map(base, judged, schema)
