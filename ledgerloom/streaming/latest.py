"""The newest delivery of each key as state of a stream, in a bounded number of files.

Micro-batches land as folders of their own. Every so many of them are folded into a table of the newest rows, dealt
into ranges of keys of which only those that changed are rewritten. The manifest that makes the new table visible
also says up to which micro-batch it reaches, so a row is in the table or still in its folder, never in both and never
lost: folders that the table already holds are not read, and go.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.latest import latest_per_key
from ledgerloom.sources.catalog import Catalog
from ledgerloom.sources.files import children, delete
from ledgerloom.sources.store import Store

RANGE = "_range"


@dataclass(frozen=True)
class Latest:
    """``read`` gives the rows of some landed folders as they are kept; ``newest_first`` orders the deliveries of a ``key``."""

    catalog: Catalog
    name: str
    landing: str
    column: str  # of the number of a micro-batch, in the names of its folders
    key: str
    newest_first: Callable[[], Sequence[Column]]
    read: Callable[[list[str]], DataFrame]
    every: int = 16
    ranges: int = 32

    def _upto(self) -> int:
        return self.catalog.snapshot().tables.get(self.name, {}).get("upto", -1)

    def _folders(self) -> dict[int, str]:
        names = [n for n in children(self.catalog.spark, self.landing) if n.startswith(f"{self.column}=")]
        return {int(n.partition("=")[2]): f"{self.landing}/{n}" for n in names}

    def _newest(self, rows: DataFrame) -> DataFrame:
        return latest_per_key(rows, [self.key], self.newest_first())

    def rows(self) -> DataFrame:
        """The newest row of each key of all that has landed."""
        upto = self._upto()
        waiting = [path for n, path in sorted(self._folders().items()) if n > upto]
        fresh = self.read(waiting)
        return self._newest(fresh if upto < 0 else self.catalog.read(self.name).drop(RANGE).unionByName(fresh))

    def fold(self, micro_batch: int) -> None:
        """Called when a micro-batch has landed. Folds what waits into the table once that is enough."""
        upto, folders = self._upto(), self._folders()
        waiting = {n: path for n, path in folders.items() if upto < n <= micro_batch}
        if len(waiting) >= self.every:
            self._fold(upto, waiting)
            upto = max(waiting)
        for n, path in folders.items():
            if n <= upto:
                delete(self.catalog.spark, path)

    def _fold(self, upto: int, waiting: dict[int, str]) -> None:
        with Store.temporary(self.catalog.spark) as store:
            dealt = F.pmod(F.xxhash64(self.key), F.lit(self.ranges)).cast("int")
            fresh = store.scratch(self._newest(self.read(list(waiting.values()))).withColumn(RANGE, dealt), "fresh")
            if upto < 0:
                staged = self.catalog.stage(self.name, fresh, RANGE, self.key)
            else:
                known = self.catalog.candidates(self.name, fresh).join(fresh.select(self.key), self.key, "left_semi")
                newest = store.scratch(self._newest(known.unionByName(fresh)), "newest")
                staged = self.catalog.stage_upsert(self.name, newest)
            self.catalog.commit([replace(staged, state={**staged.state, "upto": max(waiting)})])
