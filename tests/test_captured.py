"""The captured-file source against a plain walk over the files: ranges, growth, damage and starts."""

import random
import struct

import binlog_writer as w
import pytest
from test_capture import SID, UUID, XID, gtid, query, rows, table

from ledgerline.sources import captured
from ledgerline.streaming.assembly import Assembler, CapturedPipeline
from ledgerline.streaming.delivery import Pipeline, Progress


def previous(*ranges):
    return 35, struct.pack("<Q", 1) + SID + struct.pack("<Q", len(ranges)) + b"".join(struct.pack("<QQ", a, b + 1) for a, b in ranges)


def content(events, placed=True):
    out = b"\xfebin"
    for kind, body in events:
        out += w.event(kind, body, log_pos=len(out) + 23 + len(body) if placed else 0)
    return out


def walk(data):
    at, out = 4, []
    while at < len(data):
        n = max(struct.unpack_from("<I", data, at + 9)[0], 19) if at + 19 <= len(data) else len(data) - at
        out.append((at // 19, data[at : at + n]))
        at += n
    return out


def read(folder, start="earliest", split=captured.SPLIT):
    f = captured.Folder(str(folder), split)
    out = []
    for part in f.ranges(f.start(start), f.latest()):
        for batch in f.events(part, rows=3):
            out += zip(*(batch.column(c).to_pylist() for c in ("file", "seq", "raw")))
    return out


def txn(n, *ids):
    return [gtid(n), query("BEGIN"), table(1, "a"), rows(1, *ids), XID]


@pytest.mark.parametrize("placed", [True, False])
def test_ranges_of_any_size_give_each_event_once(tmp_path, placed):
    rng = random.Random(4)
    events = [e for n in range(1, 40) for e in txn(n, *range(rng.randrange(1, 60)))]
    data = content(events, placed)
    for damage in (None, 500, 1400):
        bad = bytearray(data)
        if damage:
            at = next(seq * 19 for seq, raw in walk(data) if seq * 19 > damage)
            bad[next(p for p in range(at, at + 19) if captured.is_event(data, p, p, len(data))) + 20] ^= 1
        (tmp_path / "f0").write_bytes(bytes(bad))
        (tmp_path / "f1").write_bytes(content(txn(50, 1), placed))
        want = [("f0", *x) for x in walk(bytes(bad))] + [("f1", *x) for x in walk(content(txn(50, 1), placed))]
        for split in (captured.SPLIT, 1000, 64, 7):
            assert read(tmp_path, split=split) == want, (damage, split)


def test_the_last_whole_event_of_a_growing_file(tmp_path, monkeypatch):
    monkeypatch.setattr(captured, "LOOK", 50)
    data = content([e for n in range(1, 9) for e in txn(n, *range(30))])
    ends = [len(data)] + [seq * 19 for seq, _ in walk(data)]
    store = captured.Folder(str(tmp_path))._store[0]
    for size in [*range(0, 60), *range(1000, 1100), len(data) - 1, len(data)]:
        (tmp_path / "f").write_bytes(data[:size])
        at = captured.last_boundary(store, str(tmp_path / "f"), size)
        assert at <= size and (at == size or not captured.is_event(data[:size], at, at, size))
        assert at <= 4 or at == len(data) or captured.is_event(data, at, at, len(data))
    assert len(ends) > 40


def test_starts(tmp_path):
    f = captured.Folder(str(tmp_path))
    assert f.start("latest") == {"file": "", "at": 0} and f.start(f"{UUID}:1-9") == {"file": "", "at": 0}
    for i, (before, n) in enumerate((((1, 4), 5), ((1, 6), 7), ((1, 9), 10))):
        (tmp_path / f"f{i}").write_bytes(content([(15, b"v4"), previous(before), *txn(n, 1)]))
    assert f.start("earliest") == {"file": "", "at": 0}
    assert [f.start(f"{UUID.upper()}:1-{n}")["file"] for n in (4, 5, 6, 8, 9, 30)] == ["f0", "f0", "f1", "f1", "f2", "f2"]
    assert f.start(f"{UUID}:1-5:7-9, {UUID}:6")["file"] == "f2"
    assert f.start("latest")["file"] == "f2" and f.start("latest")["at"] == (tmp_path / "f2").stat().st_size
    for lacking in (f"{UUID}:2-9", f"{UUID}:1-3", "00000000-0000-0000-0000-000000000001:1-9"):
        with pytest.raises(ValueError, match="^data_gap$"):
            f.start(lacking)


def test_a_file_that_grows_is_read_by_several_tasks_and_delivered_once(spark, tmp_path):
    captured.register(spark)
    folder = tmp_path / "in"
    folder.mkdir()
    data = content([(15, b"v4"), previous(), *[e for n in range(1, 7) for e in txn(n, 10 * n, 10 * n + 1)]])
    progress, got = Progress(spark, f"{tmp_path}/progress"), []
    flow = CapturedPipeline(Pipeline(progress, lambda df, _: got.extend((r.gno, r.after) for r in df.collect())), Assembler(spark, f"{tmp_path}/pool", progress))
    for size in (300, len(data)):
        (folder / "f0").write_bytes(data[:size])
        stream = spark.readStream.format("captured_log").option("path", str(folder)).option("splitBytes", 200).load()
        flow.start(stream, f"{tmp_path}/c", {"availableNow": True}).awaitTermination()
    assert sorted(got) == [(n, f'{{"id": {10 * n + i}}}') for n in range(1, 7) for i in (0, 1)]
    whole = spark.read.format("captured_log").option("path", str(folder)).option("splitBytes", 200).load()
    assert whole.rdd.getNumPartitions() == -(-len(data) // 200) and whole.count() == len(walk(data))
    (folder / "f1").write_bytes(content([(15, b"v4"), previous((1, 6)), *txn(7, 70)]))
    after = spark.read.format("captured_log").option("path", str(folder)).option("start", captured.start_of(progress)).load()
    assert {r.file for r in after.select("file").distinct().collect()} == {"f1"}
