"""Intermediate tables in the folder that the cluster shares, which cut the lineage and outlive a lost executor."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


#: The tables stored within each open block of a thread.
_open = threading.local()


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end what was stored within: for work that needs no table after it, as a delivery."""
    _open.blocks = [*getattr(_open, "blocks", []), []]
    try:
        yield
    finally:
        for path in _open.blocks.pop():
            _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of the session. Without one, a session in one process, as in tests, gets a local folder; a
    cluster must name it, as its executors share no local folder."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the cluster shares")
        shared = "/tmp/checkpoints"
        spark.conf.set("spark.checkpoint.dir", shared)
    return shared.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes df as a table in the shared folder and returns a reader of it."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if blocks := getattr(_open, "blocks", None):
        blocks[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Deletes stored tables that nothing reads any more."""
    for df in tables:
        for path in {f.rpartition("/")[0] for f in df.inputFiles()}:
            _delete(df.sparkSession, path)
