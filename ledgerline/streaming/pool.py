"""What a pipeline carries from one delivery to the next: tables that come into force with the record of a delivery."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ledgerline.streaming.delivery import Progress, _folder, _names

#: Versions that are kept: the one in force, the one being written, and one more for who still reads it.
KEPT = 3


@dataclass
class Pool:
    """Named tables beside the progress of one pipeline, a version a delivery, written before the delivery is recorded.

    The version in force is the last whose delivery was recorded, so a crash between the two leaves the one before, and the
    delivery that comes again writes its version anew. One pipeline at a time writes.
    """

    spark: SparkSession
    path: str
    progress: Progress
    schemas: Mapping[str, str | StructType]

    def _versions(self) -> list[tuple[int, str, int]]:
        """(number, run, batch) of the versions whose tables are all there, oldest first."""
        fs, place = _folder(self.spark, self.path)
        if not fs.exists(place):
            return []
        out = []
        for name in sorted(s.getPath().getName() for s in fs.listStatus(place)):
            number, _, delivery = name.partition("~")
            if set(self.schemas) <= set(_names(self.spark, f"{self.path}/{name}")):
                run, _, batch = delivery.rpartition("~")
                out.append((int(number), run, int(batch)))
        return out

    def _in_force(self) -> tuple[int, str, int] | None:
        upto = self.progress.runs()
        recorded = [v for v in self._versions() if v[2] <= upto.get(v[1], -1)]
        return recorded[-1] if recorded else None

    def _place(self, version: tuple[int, str, int]) -> str:
        number, run, batch = version
        return f"{self.path}/{number:012}~{run}~{batch}"

    def read(self) -> tuple[dict[str, DataFrame], str | None]:
        """The tables in force, empty ones at first, and the run that wrote them."""
        now = self._in_force()
        if now is None:
            return {t: self.spark.createDataFrame([], kind) for t, kind in self.schemas.items()}, None
        return {t: self.spark.read.schema(kind).parquet(f"{self._place(now)}/{t}") for t, kind in self.schemas.items()}, now[1]

    def write(self, run: str, batch: int, tables: Mapping[str, DataFrame]) -> None:
        """Writes the version of a delivery, which comes into force when the progress records that delivery."""
        now = self._in_force()
        version = (now[0] + 1 if now else 1, run, batch)
        for name in self.schemas:
            tables[name].write.mode("overwrite").parquet(f"{self._place(version)}/{name}")
        for old in self._versions():
            if old[0] <= version[0] - KEPT:
                fs, place = _folder(self.spark, self._place(old))
                fs.delete(place, True)
