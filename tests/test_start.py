"""The start of a pipeline: each refusal by its code, in order, and starts by checkpoint, by the server's position and by a set."""

import pytest
from test_capture import UUID, XID, gtid, prepared, query, rows, table, xa
from test_captured import content, previous, txn

from ledgerline.operators.delivery import PRECONDITIONS
from ledgerline.streaming.delivery import Halt
from ledgerline.streaming.start import Server, open_capture

SETS = "source_uuid string, lo bigint, hi bigint"
GOOD = {n: v for n, v, _ in PRECONDITIONS}


def server(spark, executed=(1, 9), purged=None, **settings):
    row = GOOD | settings
    sets = [spark.createDataFrame([(UUID, *x)] if x else [], SETS) for x in (executed, purged)]
    return Server(spark.createDataFrame([tuple(row.values())], ", ".join(f"{n} string" for n in row)), *sets)


def test_refusals(spark, tmp_path):
    def code(sink=lambda df, name: None, **options):
        with pytest.raises(Halt) as halt:
            open_capture(spark, str(tmp_path), sink, f"{tmp_path}/p", **options)
        return str(halt.value)

    assert code(tabels=[("a", "b")]) == "unknown_option"
    wrong = [{"tables": []}, {"tables": ["a.b"]}, {"xa": "maybe"}, {"start": 5}, {"start": "current"}, {"start": "1-2"}, {"tables": [("s", "a")], "snapshot_tables": [("s", "b")]}, {"sink": None}]
    assert {code(**o) for o in wrong} == {"config_invalid"}
    for name, _, reason in PRECONDITIONS:
        assert code(server=server(spark, **{name: "odd"})) == reason
    assert code(server=Server(server(spark).settings.limit(0), *[spark.createDataFrame([], SETS)] * 2)) == "precondition_query_failed"
    assert code(server=server(spark, (5, 9), (1, 8)), start=f"{UUID}:5") == "data_gap"


def test_a_set_that_the_server_has_not_is_refused(spark, tmp_path):
    with pytest.raises(Halt, match="^source_identity_mismatch$"):
        open_capture(spark, str(tmp_path), print, f"{tmp_path}/p", server=server(spark, (1, 4)), start=f"{UUID}:1-7")


@pytest.mark.parametrize("start, want", [("current", [4, 5]), (f"{UUID}:1-2", [3, 4, 5])])
def test_starts_and_goes_on(spark, tmp_path, start, want):
    folder, got = tmp_path / "in", []
    folder.mkdir()
    for i, n in enumerate((1, 3)):
        (folder / f"f{i}").write_bytes(content([(15, b"v4"), previous(*([(1, 2)] if i else [])), *[e for k in (n, n + 1) for e in txn(k, k)]]))

    def run(said):
        capture = open_capture(spark, str(folder), lambda df, _: got.extend(r.gno for r in df.collect()), f"{tmp_path}/p", start=said, server=server(spark, (1, 3)))
        capture.start(f"{tmp_path}/c", {"availableNow": True}).awaitTermination()

    run(start)
    (folder / "f2").write_bytes(content([(15, b"v4"), previous((1, 4)), *txn(5, 5)]))
    captured_more = open_capture(spark, str(folder), lambda df, _: got.extend(r.gno for r in df.collect()), f"{tmp_path}/p", start=start, server=server(spark, (1, 5)))
    captured_more.start(f"{tmp_path}/c", {"availableNow": True}).awaitTermination()
    assert sorted(got) == want


def test_two_phase_transactions_are_refused_unless_tracked(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "f0").write_bytes(content([gtid(1), query(f"XA START {xa('x')}"), table(1, "a"), rows(1, 10), prepared("x"), gtid(2), query(f"XA COMMIT {xa('x')}"), gtid(3), query("BEGIN"), XID]))
    got = []
    refused = open_capture(spark, str(folder), lambda df, _: got.extend(df.collect()), f"{tmp_path}/p")
    with pytest.raises(Halt, match="unsupported_transaction_shape"):
        refused.flow.deliver(spark.read.format("captured_log").option("path", str(folder)).load() if refused.events() is not None else None, 0)
    tracked = open_capture(spark, str(folder), lambda df, _: got.extend(r.gno for r in df.collect()), f"{tmp_path}/p", xa="track")
    tracked.start(f"{tmp_path}/c", {"availableNow": True}).awaitTermination()
    assert got == [1]
