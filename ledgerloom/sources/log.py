"""A log that jobs append single rows to, in a bounded number of files.

An appended row is a file at once. When many have come together they are folded into a table with a folder per month; the
manifest that shows the new table also names the files it holds. A file is read as long as no manifest names it, so no
row is lost or doubled wherever a job stops.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerloom.sources.catalog import Catalog, Conflict
from ledgerloom.sources.files import children, delete

MONTH = "_month"


@dataclass(frozen=True)
class Log:
    """``stamp`` is the time of a row, by which it is put into a month."""

    catalog: Catalog
    name: str
    path: str
    schema: StructType
    stamp: str
    every: int = 256

    def _state(self) -> dict:
        return self.catalog.snapshot().tables.get(self.name, {})

    def _files(self) -> set[str]:
        return {f for f in children(self.catalog.spark, self.path) if f.endswith(".parquet")}

    def _read(self, files: set[str]) -> DataFrame:
        spark = self.catalog.spark
        if not files:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*[f"{self.path}/{f}" for f in sorted(files)])

    def rows(self) -> DataFrame:
        """All that was ever appended."""
        files = self._files()  # before the manifest: what a job folds in between is then in the table
        state = self._state()
        waiting = self._read(files - set(state.get("files", ())))
        return waiting.unionByName(self.catalog.read(self.name).drop(MONTH)) if state else waiting

    def append(self, rows: DataFrame) -> None:
        rows.coalesce(1).write.mode("append").parquet(self.path)
        if len(self._files()) >= self.every:
            self.fold()

    def fold(self) -> None:
        """Put what waits into the table. Another job may be at the same: one of them does it."""
        held, files = set(self._state().get("files", ())), self._files()
        waiting = files - held
        if len(waiting) >= self.every:
            rows = self._read(waiting).withColumn(MONTH, F.coalesce(F.date_format(self.stamp, "yyyy-MM"), F.lit("none")))
            try:
                staged = self.catalog.stage_folders(self.name, rows, MONTH)
                self.catalog.commit([replace(staged, state={**staged.state, "files": sorted(waiting | (held & files))})])
            except Conflict:
                return
            held |= waiting
        for file in files & held:
            delete(self.catalog.spark, f"{self.path}/{file}")
