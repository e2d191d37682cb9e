"""Batches over micro-batch borders against a walk over all entries, with a failure in between."""

import random

import pytest

from ledgerline.streaming.batching import ENTRIES, Batching
from ledgerline.streaming.delivery import Halt, Progress


def walk(entries, most, flush):
    out = []
    for source in sorted({s for s, _ in entries}):
        batch = []
        for at in sorted(a for s, a in entries if s == source):
            if batch and (len(batch) == most or batch[-1] - batch[0] >= flush or at - batch[-1] >= flush):
                out.append((source, batch[0], batch[-1], len(batch)))
                batch = []
            batch.append(at)
        out.append((source, batch[0], batch[-1], len(batch)))
    return sorted(out)


def test_batches_do_not_depend_on_where_micro_batches_end(spark, tmp_path):
    rng, at, entries = random.Random(3), 0, []
    for _ in range(60):
        at += rng.choice([1, 2, 3, 9, 25])
        entries.append((rng.choice("ab"), at))
    got, fails = {}, [1]

    def sink(df, name):
        got[name] = [tuple(r) for r in df.collect()]
        if name == "run~1" and fails:
            raise OSError(fails.pop())

    def batching():
        return Batching(Progress(spark, f"{tmp_path}/p"), f"{tmp_path}/pool", sink, most=4, flush=20)

    for k, (a, b) in enumerate(((0, 25), (25, 26), (26, 60))):
        rows = spark.createDataFrame(entries[a:b], ENTRIES)
        try:
            batching().deliver(rows, k, at + 20 if k == 2 else None)
        except Halt:
            batching().deliver(rows, k)
    batching().deliver(rows, 2)  # recorded already
    assert sorted(x for rows in got.values() for x in rows) == walk(entries, 4, 20)
    early = Batching(Progress(spark, f"{tmp_path}/q"), f"{tmp_path}/q-pool", sink, most=4, flush=20, run="early")
    early.deliver(spark.createDataFrame([("a", 1), ("a", 2)], ENTRIES), 0, 21)
    assert got["early~0"] == []
    with pytest.raises(KeyError):
        got["early~1"]
    early.deliver(spark.createDataFrame([], ENTRIES), 1, 22)
    assert got["early~1"] == [("a", 1, 2, 2)]
