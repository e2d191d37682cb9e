"""Binary keys against the order of their columns, and a snapshot by a key of two columns."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import gtid
from ledgerline.functions.keys import BEYOND, ordered_key
from ledgerline.operators.snapshot import chunk_rows_in_order
from ledgerline.streaming.backfill import Backfill, SnapshotStore
from ledgerline.streaming.delivery import Pipeline, Progress
from ledgerline.streaming.handoff import Handoff
from ledgerline.streaming.mirror import MergedMirror

KIND = "i int, s string, n decimal(20,3), b binary, d date, t timestamp, l bigint, o boolean"


def test_keys_compare_as_their_columns(spark):
    rng = random.Random(9)
    texts = ["", "a", "a\0", "a\0b", "a\0\1", "a\1", "ab", "é", "ﬀ", "￿", "😀", None]

    def row():
        return (
            rng.choice([None, -1, 0, 1, -(2**31), 2**31 - 1]), rng.choice(texts), rng.choice([None, Decimal("-0.001"), Decimal("0"), Decimal("12345678901234567.125"), Decimal("-9.5"), Decimal("9.500")]),
            rng.choice([None, b"", b"\0", b"\0\0", b"\0\xff", b"\xff", b"\1"]), rng.choice([None, dt.date(1, 1, 1), dt.date(1969, 12, 31), dt.date(2024, 2, 29)]),
            rng.choice([None, dt.datetime(1969, 12, 31, 23, 59, 59, 999999), dt.datetime(2024, 1, 1)]), rng.choice([-(2**63), 2**63 - 1, 0, None]), rng.choice([None, False, True]),
        )

    rows = spark.createDataFrame([row() for _ in range(400)], KIND)
    for columns in (rows.columns, ["s", "b", "i"], ["n", "s"], ["b", "t"], ["l"]):
        keyed = rows.select(*columns, ordered_key(rows, *columns).alias("k"))
        found = [tuple(r)[:-1] for r in keyed.orderBy("k").collect()]
        assert found == [tuple(r) for r in rows.select(*columns).orderBy(*columns).collect()]
        assert keyed.select("k").distinct().count() == rows.select(*columns).distinct().count()
        assert keyed.agg(F.max("k")).first()[0] < BEYOND
    with pytest.raises(ValueError, match="unsupported_key_type"):
        ordered_key(spark.range(1).selectExpr("1.5D AS x"), "x")


def test_chunks_by_rank_whatever_the_range(spark):
    rows = spark.createDataFrame([(k,) for k in [*range(100), 2**60, -(2**62), *range(3)]], "k bigint")
    got = chunk_rows_in_order(rows, ["k"], 10).orderBy("chunk_seq", "k").collect()
    assert [(r.k, r.chunk_seq) for r in got] == [(k, i // 10) for i, k in enumerate(sorted([*range(100), 2**60, -(2**62), *range(3)]))]
    assert chunk_rows_in_order(rows.limit(0), ["k"], 10).count() == 0


def test_snapshots_by_a_key_of_two_columns(spark, tmp_path):
    plain = spark.createDataFrame([(f"n{i % 4}", i - 9, i) for i in range(20)], "a string, b int, v bigint")
    rows = plain.select(ordered_key(plain, "a", "b").alias("k"), "v")
    order = [r.v for r in plain.orderBy("a", "b").collect()]
    names = spark.createDataFrame([("s", "t", "f")], "schema string, table string, fingerprint string")
    got = []
    filling = Backfill(SnapshotStore(spark, f"{tmp_path}/state", "binary"), lambda df, _: got.append([r.v for r in df.orderBy("k").collect()]), size=8)
    filling.begin(names)
    filling.run(lambda s, t: (rows, "k"))
    assert got == [order[:8], order[8:16], order[16:]]

    kind = "source_uuid string, gno bigint, op string, schema string, table string, k binary, seq bigint, v bigint"
    keys = {r.v: bytes(r.k) for r in rows.collect()}
    log = [("a", 1, "update", "s", "t", keys[order[2]], 0, 500), ("a", 2, "delete", "s", "t", keys[order[19]], 1, None)]
    progress = Progress(spark, f"{tmp_path}/p")
    mirror = MergedMirror(f"{tmp_path}/m", "k binary, v bigint", ["k"], "seq", progress)
    ids = gtid.from_points(spark.createDataFrame([], "source_uuid string, gno bigint"))
    handoff = Handoff(Pipeline(progress, mirror), str(tmp_path), lambda s, t: (rows.withColumn("seq", F.lit(-1)), ids), kind, size=8, chunks=1)
    handoff.begin(names)
    handoff.deliver(spark.createDataFrame(log, kind), 0)
    while handoff.advance():
        pass
    # No chunk holds the changes, so they wait for all chunks.
    assert {bytes(r.k): r.v for r in mirror.state().collect()} == {keys[v]: 500 if v == order[2] else v for v in order[:19]}
