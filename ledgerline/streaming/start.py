"""One entry to start a pipeline over captured files: what must hold before the first event, in order, or a code why not."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerline.functions import gtid
from ledgerline.operators.checks import known_options, not_captured
from ledgerline.operators.delivery import gap_check, precondition_fault
from ledgerline.sources import captured
from ledgerline.streaming.assembly import Assembler, CapturedPipeline
from ledgerline.streaming.delivery import INTERVALS, Halt, Pipeline, Progress, Sink

#: The options that there are, beside the folder, the sink and the path of the pipeline's own tables.
OPTIONS = ("tables", "snapshot_tables", "start", "server", "xa", "most_prepared", "schema_sink", "retries", "split_bytes")
TABLES = "schema string, table string"


@dataclass
class Server:
    """What a server said when it was asked: its settings in one row (by PRECONDITIONS' names), the sets (source_uuid, lo, hi)
    that it has executed and purged, and the digests of transactions that it held prepared."""

    settings: DataFrame
    executed: DataFrame
    purged: DataFrame
    prepared: DataFrame | None = None


@dataclass
class Capture:
    """A pipeline that may start: its flow and where its files begin to count."""

    flow: CapturedPipeline
    folder: str
    begin: str
    split_bytes: int

    def events(self) -> DataFrame:
        spark = self.flow.assembler.spark
        captured.register(spark)
        return spark.readStream.format("captured_log").option("path", self.folder).option("start", self.begin).option("splitBytes", self.split_bytes).load()

    def start(self, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
        return self.flow.start(self.events(), checkpoint, trigger)


def _tables(spark: SparkSession, names: Iterable[tuple[str, str]] | None) -> DataFrame | None:
    return None if names is None else spark.createDataFrame(list(names), TABLES)


def _named(names: object) -> bool:
    return names is None or bool(names) and all(isinstance(n, tuple) and len(n) == 2 and all(isinstance(x, str) for x in n) for n in names)


def open_capture(spark: SparkSession, folder: str, sink: Sink, path: str, **options: object) -> Capture:
    """Checks in this order, and halts at the first that fails: options are known and of their kind; the tables of a snapshot
    are captured; the server's settings; the id set to go on from against what it has executed and purged.

    start: `checkpoint` (the default: what the pipeline has done, else all files), `current` (what the server has executed),
    or the text of a set. The last two begin a pipeline that has done nothing yet and are passed over by one that has, as
    files and the processed set must never disagree. xa: `refuse` (the default) halts at a two-phase transaction, `track`
    holds prepared ones. Without a server, only what needs none is checked.
    """
    try:
        known_options(options, OPTIONS)
    except ValueError as fault:
        raise Halt("unknown_option") from fault
    tables, wanted, said, server = (options.get(n) for n in ("tables", "snapshot_tables", "start", "server"))
    said, xa = said or "checkpoint", options.get("xa", "refuse")
    if not _named(tables) or not _named(wanted) or not callable(sink) or not isinstance(said, str) or xa not in ("refuse", "track") or said == "current" and server is None:
        raise Halt("config_invalid")
    if wanted is not None and not not_captured(_tables(spark, wanted), _tables(spark, tables)).isEmpty():
        raise Halt("config_invalid")
    progress = Progress(spark, f"{path}/progress")
    if server is not None:
        _refuse(server.settings.select(precondition_fault()).limit(2).collect())
    if progress.read().isEmpty() and said != "checkpoint":
        progress.seed(server.executed if said == "current" else _parsed(spark, said))
    if server is not None:
        _refuse_gap(server, progress.read())
    recovered = server.prepared if server is not None and xa == "track" else None
    flow = CapturedPipeline(
        Pipeline(progress, sink, schema_sink=options.get("schema_sink"), retries=options.get("retries", 5)),
        Assembler(spark, f"{path}/pool", progress, tables, recovered, options.get("most_prepared"), two_phase=xa == "track"),
    )
    return Capture(flow, folder, captured.start_of(progress), options.get("split_bytes", captured.SPLIT))


def _refuse(verdicts: list) -> None:
    if len(verdicts) != 1:
        raise Halt("precondition_query_failed")
    if verdicts[0][0] is not None:
        raise Halt(verdicts[0][0])


def _parsed(spark: SparkSession, text: str) -> DataFrame:
    rows = spark.createDataFrame([(text,)], "gtid_set string")
    if rows.select(gtid.set_fault(F.col("gtid_set"))).first()[0] is not None:
        raise Halt("config_invalid")
    return gtid.parse(rows, "gtid_set").select("source_uuid", "lo", "hi")


def _refuse_gap(server: Server, done: DataFrame) -> None:
    def case(sets: DataFrame) -> DataFrame:
        return sets.select(F.lit(0).alias("case_id"), *[c.split()[0] for c in INTERVALS.split(", ")])

    verdict = gap_check(case(server.executed), case(server.purged), case(done), server.settings.sparkSession.range(1).select(F.lit(0).alias("case_id"))).first().verdict
    if verdict != "ok":
        raise Halt(verdict)
