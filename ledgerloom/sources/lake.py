"""Files of the lake: batch folders, exports and audit records."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerloom.sources.files import delete, exists

_SAFE = re.compile(r"[A-Za-z0-9_.-]+")


def replace_batch(df: DataFrame, path: str, batch_id: str, column: str = "_batch_id") -> None:
    """Write one batch as its own partition folder, replacing an earlier load of the same batch.

    Overwriting the folder instead of relying on dynamic partition overwrite also clears the batch
    when its new content is empty.
    """
    if not _SAFE.fullmatch(batch_id):
        raise ValueError(f"batch id {batch_id!r} may only hold letters, digits, '_', '.' and '-'")
    df.drop(column).write.mode("overwrite").parquet(f"{path}/{column}={batch_id}")


def drop_batch(spark: SparkSession, path: str, batch_id: str, column: str = "_batch_id") -> None:
    delete(spark, f"{path}/{column}={batch_id}")


def read_batches(spark: SparkSession, path: str, schema: StructType, column: str = "_batch_id") -> DataFrame:
    """All batches of a table. The schema is given, so a batch id of digits stays text."""
    full = schema if column in schema.names else StructType([*schema.fields, StructField(column, StringType())])
    if not exists(spark, path):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).parquet(path)


def load_staged(spark: SparkSession, staged: str, path: str, schema: StructType, batch_id: str) -> int:
    """Bulk-load a staged batch folder; columns match by name in any case. Returns the rows loaded."""
    found = spark.read.option("mergeSchema", True).parquet(f"{staged}/batch_id={batch_id}")
    found = lower_names(found)
    names = [n for n in schema.names if n != "_batch_id"]
    missing = [n for n in names if n not in found.columns]
    if missing:
        raise ValueError(f"staged batch {batch_id} lacks {missing}")
    rows = found.select(*[F.col(n).cast(schema[n].dataType).alias(n) for n in names])
    replace_batch(rows, path, batch_id)
    return spark.read.parquet(f"{path}/_batch_id={batch_id}").count()


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header. Quotes are doubled and blanks at the ends stay, as readers expect."""
    options = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("overwrite").options(**options).csv(path)
