"""Written tables.

A job that needs a stable intermediate result writes it as Parquet below the shared folder the
cluster names in ``spark.checkpoint.dir``; losing an executor then loses no work and never changes
row positions that later steps rely on.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_own_folders: set[str] = set()
_local_roots: dict[str, tempfile.TemporaryDirectory] = {}


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one only when Spark runs inside this one machine."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.TemporaryDirectory(prefix="ledgerloom-")
    return _local_roots[app].name


def _remove(spark: SparkSession, folder: str) -> None:
    if spark.sparkContext._jsc is None:  # stopped: nothing can be reached any more
        return
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@dataclass(frozen=True)
class Store:
    """A folder of tables, each written once."""

    spark: SparkSession
    root: str

    @classmethod
    def for_session(cls, spark: SparkSession) -> Store:
        """A store of its own below the folder of this application, which goes when the driver ends."""
        own = f"{shared_root(spark)}/ledgerloom/{spark.sparkContext.applicationId}"
        if own not in _own_folders:
            _own_folders.add(own)
            atexit.register(_remove, spark, own)
        return cls(spark, f"{own}/{uuid.uuid4().hex}")

    @classmethod
    @contextmanager
    def temporary(cls, spark: SparkSession) -> Iterator[Store]:
        """A store whose folder goes when the job is done."""
        store = cls.for_session(spark)
        try:
            yield store
        finally:
            store.remove()

    def remove(self) -> None:
        """Delete all its tables; nothing that still reads them can be evaluated any more."""
        _remove(self.spark, self.root)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, name: str, df: DataFrame) -> DataFrame:
        """Write ``df`` and return the table read back, so that later plans start at the files."""
        df.write.mode("overwrite").parquet(self.path(name))
        return self.read(name, df.schema)

    def read(self, name: str, schema: StructType) -> DataFrame:
        # the given schema saves the footer-reading job that inference would start
        return self.spark.read.schema(schema).parquet(self.path(name)).select(*schema.names)

    def unique(self, name: str) -> str:
        """A name nobody else uses."""
        return f"scratch/{name}-{uuid.uuid4().hex[:12]}"

    def scratch(self, df: DataFrame, name: str) -> DataFrame:
        return self.write(self.unique(name), df)


def file_stamp(spark: SparkSession, paths: Sequence[str]) -> tuple:
    """Every file below the paths with its length and change time, to notice that a source was replaced."""
    conf = spark._jsc.hadoopConfiguration()
    stamps = []
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        found = fs.listFiles(path, True) if fs.exists(path) else None
        while found is not None and found.hasNext():
            file = found.next()
            stamps.append((file.getPath().toString(), file.getLen(), file.getModificationTime()))
    return tuple(sorted(stamps))
