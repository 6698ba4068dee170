"""Tables that change together.

What is written is never changed: every write of a table is a folder of its own, with a folder per value of its
partition column inside. A manifest names the folders of every table; a new one is a new file that appears at once, so
readers see all tables of a commit or none, and go on with the folders they have. An update of some keys asks the key
index which folders may hold them, reads the keys of those only, and rewrites the folders that do.

    <root>/<table>/_version=<number>-<id>/[<column>=<value>/]   data
    <root>/_keys/<table>/_version=<number>-<id>                 key index of the folders of that write
    <root>/_manifests/<number>.json                             the state after a commit
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerloom.operators.upsert import upsert
from ledgerloom.sources import keyindex
from ledgerloom.sources.files import children, delete, exists, publish_text, read_text

_VERSION = "_version"
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
_SAFE = re.compile(r"[A-Za-z0-9_. -]+")
KEPT = 3  # manifests whose folders stay


Step = Callable[[DataFrame], DataFrame]


def _as_it_is(df: DataFrame) -> DataFrame:
    return df


class Conflict(RuntimeError):
    """Another commit came first."""


@dataclass(frozen=True)
class Staged:
    """A table as it will be: written, but not what readers see before it is committed."""

    name: str
    table: DataFrame
    state: dict
    base: int


@dataclass(frozen=True)
class Snapshot:
    """The tables as one manifest names them."""

    catalog: Catalog
    version: int
    tables: Mapping[str, dict]

    def exists(self, name: str) -> bool:
        return name in self.tables

    def read(self, name: str) -> DataFrame:
        return self.catalog._read(name, self.tables[name])


@dataclass(frozen=True)
class Catalog:
    """A folder of tables. One job commits at a time; a second one that started from the same state gets a ``Conflict``."""

    spark: SparkSession
    root: str

    # ---- reading ---------------------------------------------------------------------------

    def version(self) -> int:
        numbers = [int(n[:-5]) for n in children(self.spark, f"{self.root}/_manifests") if n.endswith(".json") and n[:-5].isdigit()]
        return max(numbers, default=0)

    def _manifest(self, version: int) -> dict:
        text = read_text(self.spark, f"{self.root}/_manifests/{version:012d}.json") if version else None
        return json.loads(text) if text else {}

    def snapshot(self) -> Snapshot:
        version = self.version()
        return Snapshot(self, version, self._manifest(version))

    def exists(self, name: str) -> bool:
        return self.snapshot().exists(name)

    def read(self, name: str) -> DataFrame:
        return self.snapshot().read(name)

    def _read(self, name: str, state: dict, folders: Sequence[str] | None = None) -> DataFrame:
        """The table, or some folders of it. The schema is kept in the manifest, so older folders show later columns as NULL."""
        schema, column = StructType.fromJson(state["schema"]), state["column"]
        chosen = state["folders"] if folders is None else {f: state["folders"][f] for f in folders}
        if not chosen:
            return self.spark.createDataFrame([], schema)
        base = f"{self.root}/{name}"
        if column is None:
            return self.spark.read.schema(schema).parquet(*[f"{base}/{_VERSION}={v}" for v in chosen.values()])
        full = StructType([*schema.fields]).add(_VERSION, "string")
        paths = [f"{base}/{_VERSION}={v}/{folder}" for folder, v in sorted(chosen.items())]
        return self.spark.read.schema(full).option("basePath", base).parquet(*paths).select(*schema.names)

    # ---- writing ---------------------------------------------------------------------------

    def _write(self, name: str, df: DataFrame, column: str | None, key: str | None, last: Step, base: int) -> dict[str, str]:
        """Write ``df`` as a version of its own, and its key index. Returns folder -> version."""
        version = f"{base + 1:012d}-{uuid.uuid4().hex[:8]}"
        path = f"{self.root}/{name}/{_VERSION}={version}"
        if column is None:
            last(df).write.parquet(path)
            return {"": version}
        # rebalancing writes few files per folder and splits a folder that holds much of the table
        last(df.hint("rebalance", column)).write.partitionBy(column).parquet(path)
        folders = [f for f in children(self.spark, path) if f.startswith(f"{column}=")]
        for folder in folders:
            if not _SAFE.fullmatch(folder.partition("=")[2]):
                raise ValueError(f"folder {folder!r}: a value may only hold letters, digits, blanks, '_', '.' and '-'")
        if key is not None and folders:
            rows = self.spark.read.schema(df.schema).parquet(path).select(self._folder(column).alias("folder"), F.col(key).cast("string").alias("key"))
            keyindex.built(rows).write.parquet(f"{self.root}/_keys/{name}/{_VERSION}={version}")
        return dict.fromkeys(folders, version)

    @staticmethod
    def _folder(column: str):
        """The folder a row belongs to."""
        return F.concat(F.lit(f"{column}="), F.coalesce(F.col(column).cast("string"), F.lit(_NO_VALUE)))

    def _staged(self, name: str, state: dict, base: int) -> Staged:
        return Staged(name, self._read(name, state), state, base)

    def stage(
        self, name: str, df: DataFrame, column: str | None = None, key: str | None = None, last: Step = _as_it_is
    ) -> Staged:
        """Write the whole table, in a folder per value of ``column``; ``key`` is what later updates find rows by.

        ``last`` is done to the rows right before they are written, after all shuffles.
        """
        base = self.version()
        folders = self._write(name, df, column, key, last, base)
        return self._staged(name, {"schema": df.schema.jsonValue(), "column": column, "key": key, "folders": folders}, base)

    def holders(self, name: str, state: dict, keys: DataFrame) -> list[str]:
        """The folders that may hold one of the ``keys``: all that do."""
        versions = sorted(set(state["folders"].values()))
        base = f"{self.root}/_keys/{name}"
        paths = [p for v in versions if exists(self.spark, p := f"{base}/{_VERSION}={v}")]
        if not paths:
            return []
        index = self.spark.read.schema(StructType([*keyindex.SCHEMA.fields]).add(_VERSION, "string")).option("basePath", base).parquet(*paths)
        current = self.spark.createDataFrame(list(state["folders"].items()), f"folder string, {_VERSION} string")  # a row per folder
        index = index.join(F.broadcast(current), ["folder", _VERSION], "left_semi")
        found = keyindex.may_hold(index, keys.select(F.col(state["key"]).cast("string").alias("key")))
        return [r["folder"] for r in found.select("folder").distinct().collect()]  # one per folder

    def candidates(self, name: str, keys: DataFrame) -> DataFrame:
        """The folders of a table that may hold one of the ``keys``: all rows that do, and others."""
        state = self.snapshot().tables[name]
        return self._read(name, state, self.holders(name, state, keys))

    def stage_upsert(self, name: str, delta: DataFrame, last: Step = _as_it_is) -> Staged:
        """The table with the rows of the delta's keys replaced. Folders they were in and those they go to are rewritten.

        ``delta`` is read several times: a written table.
        """
        base = self.version()
        state = self._manifest(base)[name]
        column, key = state["column"], state["key"]
        if delta.isEmpty():
            return self._staged(name, state, base)
        existing = self._read(name, state, self.holders(name, state, delta))
        before = existing.join(delta.select(key), key, "left_semi").select(self._folder(column).alias("folder"))
        touched = [r["folder"] for r in before.union(delta.select(self._folder(column))).distinct().collect()]  # one per folder
        old = self._read(name, state, [f for f in touched if f in state["folders"]])
        changed = upsert(old, delta, key)
        written = self._write(name, changed, column, key, last, base)
        kept = {f: v for f, v in state["folders"].items() if f not in touched}
        return self._staged(name, {**state, "schema": changed.schema.jsonValue(), "folders": kept | written}, base)

    def stage_folders(self, name: str, rows: DataFrame, column: str) -> Staged:
        """The table with ``rows`` added. Only the folders they go to are written again."""
        base = self.version()
        state = self._manifest(base).get(name)
        if state is None:
            return self.stage(name, rows, column)
        touched = [r["folder"] for r in rows.select(self._folder(column).alias("folder")).distinct().collect()]  # one per folder
        old = self._read(name, state, [f for f in touched if f in state["folders"]])
        written = self._write(name, old.unionByName(rows, allowMissingColumns=True), column, None, _as_it_is, base)
        return self._staged(name, {**state, "folders": state["folders"] | written}, base)

    # ---- committing ------------------------------------------------------------------------

    def commit(self, staged: Sequence[Staged]) -> Snapshot:
        """Make all staged tables what readers see, at once: by one new file."""
        version = self.version()
        if any(s.base != version for s in staged):
            raise Conflict(f"{self.root} was changed since {[s.name for s in staged if s.base != version]} were staged")
        tables = self._manifest(version) | {s.name: s.state for s in staged}
        if not publish_text(self.spark, f"{self.root}/_manifests/{version + 1:012d}.json", json.dumps(tables)):
            raise Conflict(f"{self.root} was changed while {[s.name for s in staged]} were committed")
        self.clear()
        return Snapshot(self, version + 1, tables)

    def clear(self) -> None:
        """Remove folders that none of the last manifests names. Those of a job that is still writing are newer and stay."""
        last = self.version()
        kept = [self._manifest(v) for v in range(max(1, last - KEPT + 1), last + 1)]
        for name in {t for m in kept for t in m}:
            used = {(v, f) for m in kept if name in m for f, v in m[name]["folders"].items()}
            for entry in children(self.spark, f"{self.root}/{name}"):
                version = entry.partition("=")[2]
                if not entry.startswith(f"{_VERSION}=") or int(version[:12]) >= last:
                    continue
                path = f"{self.root}/{name}/{entry}"
                if not any(v == version for v, _ in used):
                    delete(self.spark, path)
                    delete(self.spark, f"{self.root}/_keys/{name}/{entry}")
                    continue
                for folder in children(self.spark, path):
                    if "=" in folder and (version, folder) not in used:
                        delete(self.spark, f"{path}/{folder}")
        for file in children(self.spark, f"{self.root}/_manifests"):
            if file[:-5].isdigit() and int(file[:-5]) <= last - KEPT:
                delete(self.spark, f"{self.root}/_manifests/{file}")

    def replace(self, name: str, df: DataFrame, column: str | None = None, key: str | None = None) -> DataFrame:
        return self.commit([self.stage(name, df, column, key)]).read(name)

    def upsert(self, name: str, delta: DataFrame) -> DataFrame:
        return self.commit([self.stage_upsert(name, delta)]).read(name)
