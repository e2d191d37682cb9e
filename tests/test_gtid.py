import random

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import gtid

U = [f"0000000{i}-0000-0000-0000-00000000000{i}" for i in range(3)]
KIND = "source_uuid string, lo bigint, hi bigint"


def make(spark, rng):
    """Sets of intervals that lie apart, touch, overlap, lie in each other, or begin or end where a span of 50 does."""
    rows = []
    for u in rng.sample(U, rng.randrange(len(U) + 1)):
        lo, hi = 7, 7 + rng.randrange(120)
        rows.append((u, lo, hi))
        for shape in rng.choices(("apart", "touching", "overlapping", "inside", "edge"), k=4):
            length = rng.randrange(1, 90)
            lo = {"apart": hi + 2 + rng.randrange(70), "touching": hi + 1, "overlapping": (lo + hi) // 2, "inside": lo, "edge": 50 * (hi // 50 + 1)}[shape]
            hi = max(lo, {"inside": lo + (hi - lo) // 2, "edge": lo + 49}.get(shape, lo + length))
            rows.append((u, lo, hi))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, KIND), {(u, i) for u, lo, hi in rows for i in range(lo, hi + 1)}


def points(df):
    rows = df.collect()
    out = [(r.source_uuid, i) for r in rows for i in range(r.lo, r.hi + 1)]
    assert len(out) == len(set(out))
    ends = {(r.source_uuid, r.hi + 1) for r in rows}
    assert not ends & {(r.source_uuid, r.lo) for r in rows}, "intervals touch"
    return set(out)


@pytest.mark.parametrize("seed", range(4))
def test_algebra_equals_sets_of_points(spark, seed):
    rng = random.Random(seed)
    (a, pa), (b, pb) = make(spark, rng), make(spark, rng)
    assert points(gtid.normalize(a, span=50)) == pa
    assert points(gtid.union(a, b)) == pa | pb
    assert points(gtid.subtract(a, b)) == pa - pb
    assert points(gtid.intersect(a, b)) == pa & pb
    assert gtid.is_subset(a, b).first().yes == (pa <= pb)
    assert gtid.is_disjoint(gtid.subtract(a, b), b).first().yes
    text = gtid.render(a)
    assert points(gtid.parse(text, "gtid_set")) == pa
    rows = spark.createDataFrame([(u.upper(), i) for u in U for i in (1, 77, 250, 560)], "source_uuid string, gno bigint")
    inside = {(r.source_uuid.lower(), r.gno) for r in gtid.members(rows, b).collect()}
    assert inside == {(u, i) for u in U for i in (1, 77, 250, 560)} & pb
    assert gtid.non_members(rows, b).count() == 12 - len(inside)


def test_render_and_empty_set(spark):
    df = spark.createDataFrame([(U[1], 4, 6), (U[1], 1, 3), (U[0], 9, 9)], KIND)
    assert gtid.render(df).first()[0] == f"{U[0]}:9,{U[1]}:1-6"
    empty = spark.createDataFrame([], KIND)
    assert gtid.render(empty).first()[0] == ""
    assert gtid.parse(gtid.render(empty), "gtid_set").isEmpty()


def broken(entry):
    """Every text that one edit at a place of the grammar makes of an entry, with which it is none any more."""
    uuid, _, rest = entry.partition(":")
    first, _, more = rest.partition(":")
    edits = {
        "the last digit of the uuid gone": f"{uuid[:-1]}:{rest}", "a letter past f": f"g{uuid[1:]}:{rest}", "a hyphen moved": f"{uuid[:7]}-{uuid[7]}{uuid[9:]}:{rest}",
        "no numbers": uuid, "nothing after the last colon": entry + ":", "nothing between colons": f"{uuid}::{rest}", "a zero first": f"{uuid}:0{rest}", "only zero": f"{uuid}:0:{more}",
        "a sign": f"{uuid}:-{rest}", "the interval turned": f"{uuid}:{'-'.join(reversed(first.split('-')))}:{more}", "no end": f"{uuid}:{first.split('-')[0]}-:{more}", "three ends": f"{uuid}:{first}-99:{more}",
        "a blank inside": f"{uuid}: {rest}", "a letter among digits": f"{uuid}:{first}x:{more}", "another comma": entry + ",,", "an empty entry": "," + entry, "a fraction": f"{uuid}:{rest}.5",
    }
    return edits.items()


def test_malformed_sets_are_refused(spark):
    df = spark.createDataFrame(list(broken(U[2] + ":31-47:52")), "what string, gtid_set string")
    assert [r.what for r in df.where(gtid.set_fault(df.gtid_set).isNull()).collect()] == []
    with pytest.raises(Exception, match="malformed transaction-id set"):
        gtid.parse(df.limit(1), "gtid_set").collect()


def test_comparing_sets_merges_nothing(spark, monkeypatch):
    """Whether a set holds another is told from the stretches of both, which needn't be merged to be counted."""
    a = spark.createDataFrame([(U[0], 1, 9), (U[0], 12, 20), (U[1], 5, 5)], KIND)
    b = spark.createDataFrame([(U[0], 2, 4), (U[0], 13, 20)], KIND)
    monkeypatch.setattr(gtid, "normalize", lambda *_: pytest.fail("merged"))
    assert [gtid.is_subset(x, y).first().yes for x, y in ((b, a), (a, b))] == [True, False]
    assert [gtid.is_disjoint(x, y).first().yes for x, y in ((a, b), (b, spark.createDataFrame([(U[0], 5, 12), (U[1], 2, 4)], KIND)))] == [False, True]
    assert [gtid.is_equal(x, y).first().yes for x, y in ((a, a), (a, b), (b, a))] == [True, False, False]


@pytest.mark.parametrize("seed", range(3))
def test_one_source_over_many_spans(spark, monkeypatch, seed):
    """Intervals of one source in spans of 16 numbers, some over many spans, with both ways to find members."""
    monkeypatch.setattr(gtid, "SPAN", 16)
    rng = random.Random(seed)

    def some(n):
        rows = [(U[0], lo, lo + rng.choice([0, 1, 3, 5, 200])) for lo in (rng.randrange(1, 4000) for _ in range(n))]
        return spark.createDataFrame(rows, KIND), {(u, i) for u, lo, hi in rows for i in range(lo, hi + 1)}

    (a, pa), (b, pb) = some(150), some(40)
    assert points(gtid.normalize(a, span=16)) == pa
    assert points(gtid.subtract(a, b)) == pa - pb and points(gtid.intersect(a, b)) == pa & pb
    rows = spark.range(1, 4300).selectExpr(f"'{U[0].upper()}' AS source_uuid", "id AS gno")
    for few in (0, 10_000):
        monkeypatch.setattr(gtid, "FEW", few)
        assert {r.gno for r in gtid.members(rows, a).collect()} == {i for _, i in pa if i < 4300}
        assert {r.gno for r in gtid.non_members(rows, a).collect()} == set(range(1, 4300)) - {i for _, i in pa}


def test_white_space_between_entries_parses(spark):
    df = spark.createDataFrame([(f" {U[0]}:1-3:7,\n{U[1].upper()}:2 ",)], "gtid_set string")
    assert gtid.render(gtid.parse(df, "gtid_set")).first()[0] == f"{U[0]}:1-3:7,{U[1]}:2"


def test_a_text_of_many_intervals_parses(spark):
    """One entry of 30,000 intervals, more than a pattern over a whole entry can go through."""
    text = U[0].upper() + "".join(f":{3 * i + 1}-{3 * i + 2}" for i in range(30_000))
    parsed = gtid.parse(spark.createDataFrame([(text,)], "gtid_set string"), "gtid_set")
    assert {(r.source_uuid, r.lo, r.hi) for r in parsed.collect()} == {(U[0], 3 * i + 1, 3 * i + 2) for i in range(30_000)}
    faults = spark.createDataFrame([(text + ":9-8",), (text + ":07",)], "gtid_set string").select(gtid.set_fault(F.col("gtid_set"))).collect()
    assert [r[0] for r in faults] == ["descending_interval", "malformed_entry"]
