"""Captured files as a Spark source, batch and stream: events by byte ranges, and starts by transaction ids.

A file is cut into ranges that any number of tasks read. A task finds the first event in its range by the event's own length
and checksum, so nobody has to walk a file from its beginning. The stream's offset is a file and a place in it, as files
follow each other by name and only the last one grows; the id set that a pipeline has processed tells where to begin.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from ledgerline.functions import gtid
from ledgerline.sources.binlog import CHECKSUM, EVENT_SCHEMA, HEADER, KNOWN, MAGIC
from ledgerline.streaming.delivery import Progress

#: Fixed value: the type of the event that lists the ids of all earlier files.
PREVIOUS_IDS = 35
#: Bytes that a task reads at first to find an event, or the last whole one of a file; it goes on in doubling steps.
LOOK = 1 << 20
#: Bytes of a range, if the option `splitBytes` doesn't say.
SPLIT = 64 << 20

Intervals = dict[str, list[tuple[int, int]]]


def parse_set(text: str) -> Intervals:
    """Intervals (both ends included) by uuid of a set's text."""
    out: Intervals = {}
    for entry in re.sub(r"\s", "", text).lower().split(","):
        source, *ranges = entry.split(":")
        for r in ranges:
            lo, _, hi = r.partition("-")
            out.setdefault(source, []).append((int(lo), int(hi or lo)))
    return out


def holds(whole: Intervals, part: Intervals) -> bool:
    """Whether whole has every id of part."""
    for source, ranges in part.items():
        merged: list[list[int]] = []
        for lo, hi in sorted(whole.get(source, [])):
            if merged and lo <= merged[-1][1] + 1:
                merged[-1][1] = max(merged[-1][1], hi)
            else:
                merged.append([lo, hi])
        if any(not any(a <= lo and hi <= b for a, b in merged) for lo, hi in ranges):
            return False
    return True


def previous_ids(body: bytes) -> Intervals:
    out, at = {}, 8
    for _ in range(int.from_bytes(body[:8], "little")):
        s, n = body[at : at + 16].hex(), int.from_bytes(body[at + 16 : at + 24], "little")
        pairs = struct.unpack_from(f"<{2 * n}Q", body, at + 24)
        out["-".join((s[:8], s[8:12], s[12:16], s[16:20], s[20:]))] = [(a, b - 1) for a, b in zip(pairs[::2], pairs[1::2])]
        at += 24 + 16 * n
    return out


def _size(b: bytes, at: int) -> int:
    return struct.unpack_from("<I", b, at + 9)[0] if at + HEADER <= len(b) else 0


def is_event(b: bytes, at: int, place: int, end: int) -> bool:
    """Whether a whole, sound event begins at a place of the file, which is `at` in the bytes b; end is that of the file."""
    size = _size(b, at)
    if not HEADER + CHECKSUM <= size <= end - place or b[at + 4] not in KNOWN or at + size > len(b):
        return False
    after = struct.unpack_from("<I", b, at + 13)[0]
    if after and after != (place + size) & 0xFFFFFFFF:
        return False
    return zlib.crc32(memoryview(b)[at : at + size - CHECKSUM]) == int.from_bytes(b[at + size - CHECKSUM : at + size], "little")


class _File:
    """Bytes of a file from a place on, read as far as they are asked for."""

    def __init__(self, store: pafs.FileSystem, path: str, start: int, end: int) -> None:
        self.file, self.start, self.end, self.bytes = store.open_input_file(path), start, end, b""

    def upto(self, place: int) -> None:
        """Reads to the place, or the end."""
        have = self.start + len(self.bytes)
        if (more := min(place, self.end) - have) > 0:
            self.file.seek(have)
            self.bytes += self.file.read(more)

    def event_at(self, place: int) -> bool:
        self.upto(place + HEADER)
        self.upto(place + min(_size(self.bytes, place - self.start), self.end - place))
        return is_event(self.bytes, place - self.start, place, self.end)

    def first_event(self, place: int, stop: int) -> int:
        """The first place from one on, before another, at which an event begins; `stop` if there is none."""
        if place < len(MAGIC):
            self.upto(len(MAGIC))
            return len(MAGIC) if self.start == 0 and self.bytes.startswith(MAGIC) else place
        while place < stop:
            self.upto(place + LOOK)
            for at in range(place, min(stop, self.start + len(self.bytes))):
                size = _size(self.bytes, at - self.start)
                if HEADER + CHECKSUM <= size <= self.end - at and self.bytes[at - self.start + 4] in KNOWN and self.event_at(at):
                    return at
            place = min(stop, self.start + len(self.bytes))
        return stop


def last_boundary(store: pafs.FileSystem, path: str, size: int) -> int:
    """The place after the last whole event among the first `size` bytes of a file that may still grow."""
    window = LOOK
    while True:
        low = max(size - window, 0)
        file = _File(store, path, low, size)
        at = file.first_event(low, size)
        if low == 0 or at < size:
            at = min(at, size)
            while at < size and file.event_at(at):
                at += _size(file.bytes, at - low)
            return at
        window *= 2


@dataclass
class Range(InputPartition):
    """The events of a file that begin in [low, high); end is how far the file counts, closed whether it grows no more."""

    name: str
    low: int
    high: int
    end: int
    closed: bool


@dataclass
class Folder:
    """The captured files of a folder, in the order of their names."""

    path: str
    split: int = SPLIT

    @cached_property
    def _store(self) -> tuple[pafs.FileSystem, str]:
        if "://" in self.path or self.path.startswith("file:"):
            return pafs.FileSystem.from_uri(self.path if "://" in self.path else "file://" + self.path.removeprefix("file:"))
        return pafs.LocalFileSystem(), self.path

    def files(self) -> list[tuple[str, int]]:
        store, root = self._store
        found = [(f.base_name, f.size) for f in store.get_file_info(pafs.FileSelector(root)) if f.type == pafs.FileType.File]
        return sorted(f for f in found if not f[0].startswith((".", "_")) and not f[0].endswith(".index"))

    def _path(self, name: str) -> str:
        return f"{self._store[1]}/{name}"

    def latest(self) -> dict:
        files = self.files()
        return {"file": files[-1][0], "at": last_boundary(self._store[0], self._path(files[-1][0]), files[-1][1])} if files else {"file": "", "at": 0}

    def before(self, name: str, size: int) -> Intervals | None:
        """The ids of all files before one, as its head lists them; None if it doesn't."""
        file = _File(self._store[0], self._path(name), 0, size)
        at = file.first_event(0, size)
        for _ in range(4):
            if at >= size or not file.event_at(at):
                break
            n = _size(file.bytes, at)
            if file.bytes[at + 4] == PREVIOUS_IDS:
                return previous_ids(file.bytes[at + HEADER : at + n - CHECKSUM])
            at += n
        return None

    def start(self, said: str) -> dict:
        """Where to begin: `earliest`, `latest`, or the text of a set, for which it is the last file that has all that the set
        lacks. ValueError data_gap if files that held some of that are gone."""
        if said == "earliest":
            return {"file": "", "at": 0}
        if said == "latest":
            return self.latest()
        done, chosen = parse_set(said), None
        for name, size in self.files():
            ids = self.before(name, size)
            if ids is not None and not holds(done, ids):
                if chosen is None:
                    raise ValueError("data_gap")
                break
            if ids is not None or chosen is None:
                chosen = name
        return {"file": chosen or "", "at": 0}

    def ranges(self, start: dict, end: dict) -> list[Range]:
        out = []
        for name, size in self.files():
            if start["file"] <= name <= end["file"]:
                low, high, closed = start["at"] if name == start["file"] else 0, size, name < end["file"]
                high = high if closed else end["at"]
                out += [Range(name, at, min(at + self.split, high), high, closed) for at in range(low, high, self.split)]
        return out

    def events(self, part: Range, rows: int = 4096, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
        """The events of a range, each as its bytes. seq is the place over the least length of an event, so it rises.

        An event that isn't sound can't be found by its checksum, so it falls to the range before: a range goes on until it
        meets a sound event of the next. A cut last event of a closed file comes as it is.
        """
        file = _File(self._store[0], self._path(part.name), part.low, part.end)
        at = file.first_event(part.low, part.high)
        seqs, raws, held = [], [], 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([part.name] * len(seqs), pa.string()), pa.array(seqs, pa.int64()), pa.array(raws, pa.binary())], names=["file", "seq", "raw"])

        begun = at < part.high
        while begun and at < part.end and (at < part.high or not file.event_at(at)):
            file.upto(at + HEADER)
            n = max(_size(file.bytes, at - part.low), HEADER)
            whole = min(n, part.end - at)
            file.upto(at + whole)
            seqs.append(at // HEADER)
            raws.append(file.bytes[at - part.low : at - part.low + whole])
            held, at = held + whole, at + whole
            if len(seqs) >= rows or held >= size:
                yield batch()
                seqs, raws, held = [], [], 0
        if seqs:
            yield batch()


class _Batch(DataSourceReader):
    def __init__(self, folder: Folder, start: str) -> None:
        self.folder, self.start = folder, start

    def partitions(self) -> list[Range]:
        return self.folder.ranges(self.folder.start(self.start), self.folder.latest()) or [Range("", 0, 0, 0, True)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if partition.name:
            yield from self.folder.events(partition)


class _Stream(DataSourceStreamReader):
    def __init__(self, folder: Folder, start: str) -> None:
        self.folder, self.start = folder, start

    def initialOffset(self) -> dict:
        return self.folder.start(self.start)

    def latestOffset(self) -> dict:
        return self.folder.latest()

    def partitions(self, start: dict, end: dict) -> list[Range]:
        return self.folder.ranges(start, end)

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        yield from self.folder.events(partition)

    def commit(self, end: dict) -> None:
        pass


class CapturedLog(DataSource):
    """format("captured_log"): raw events (file, seq, raw) of a folder. Options: path, which pyarrow can open (a folder or URI);
    start (`earliest`, `latest` or a set's text); splitBytes."""

    @classmethod
    def name(cls) -> str:
        return "captured_log"

    def schema(self) -> str:
        return EVENT_SCHEMA

    def _folder(self) -> Folder:
        return Folder(self.options["path"].rstrip("/"), int(self.options.get("splitbytes", SPLIT)))

    def reader(self, schema) -> DataSourceReader:
        return _Batch(self._folder(), self.options.get("start", "earliest"))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Stream(self._folder(), self.options.get("start", "earliest"))


def write_files(files: DataFrame, folder: str) -> None:
    """Writes files (name, content) to a folder that all tasks share. A task that runs again writes the same bytes."""
    at = Folder(folder.rstrip("/"))

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = at._store
        store.create_dir(root)
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with store.open_output_stream(f"{root}/{name}") as out:
                    out.write(content)
            yield batch.select([0])

    files.select("name", "content").mapInArrow(written, "name string").count()


def register(spark: SparkSession) -> None:
    spark.dataSource.register(CapturedLog)


def start_of(progress: Progress) -> str:
    """The option `start` for what a pipeline has done so far."""
    done = gtid.render(progress.read()).first()
    return done[0] if done is not None and done[0] else "earliest"
