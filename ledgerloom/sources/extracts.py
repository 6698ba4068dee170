"""Readers for the source extracts: everything arrives as text.

A line that cannot be read is a row too: it keeps its text and the place it came from, so that it ends in quarantine
and not as a row of nulls.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerloom.functions.text import na_to_null
from ledgerloom.sources.lake import exists
from ledgerloom.sources.schemas import BLOCK, EXTRACT_COLUMNS, FILE, LINE, text_schema


@dataclass(frozen=True)
class SourceSpec:
    system: str
    file: str
    multi_line: bool = False

    @property
    def format(self) -> str:
        return "json" if self.file.endswith(".jsonl") else "csv"


# Which system delivers which file.
SOURCES = {
    "customers": SourceSpec("crm", "customers.csv"),
    "orders": SourceSpec("erp", "orders.jsonl"),
    "order_items": SourceSpec("erp", "order_items.csv"),
    "products": SourceSpec("catalog", "products.csv"),
    "fx_rates": SourceSpec("finance", "fx_rates.csv"),
}


def read_traced(spark: SparkSession, landing: str, table: str) -> DataFrame:
    """The columns of a table by their names in the file, as text, and where each row comes from.

    ``LINE`` is the text of an unreadable line, null for all others: a line that is no JSON object, or one with more fields
    than the header. Missing fields at the end of a line are null. ``FILE`` and ``BLOCK`` are the file and the offset of
    the part of it that was read at once.

    A header in another order is read right, one that lacks a column is refused, and so is a folder whose files
    have different headers. A quoted field may hold line breaks where the source says so; such a file is read as
    one piece.
    """
    spec = SOURCES[table]
    path = f"{landing}/{spec.system}/{spec.file}"
    if not exists(spark, path):
        raise FileNotFoundError(f"{spec.system} has not delivered {table}: no {path}")
    wanted = EXTRACT_COLUMNS[table]
    place = [F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK)]
    if spec.format == "json":
        reader = spark.read.option("columnNameOfCorruptRecord", LINE)
        return reader.schema(text_schema(table).add(LINE, "string")).json(path).select(*wanted, LINE, *place)
    # quotes are doubled inside a quoted field
    reader = spark.read.options(header=True, escape='"', multiLine=spec.multi_line)
    names = reader.csv(path).columns
    missing = [c for c in wanted if c not in names]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    given = StructType([StructField(c, StringType()) for c in (*names, LINE)])
    rows = reader.options(enforceSchema=False, columnNameOfCorruptRecord=LINE).schema(given).csv(path)
    too_long = F.when(_fields(F.col(LINE)) > len(names), F.col(LINE))
    return rows.select(*[na_to_null(F.col(f"`{c}`")).alias(c) for c in wanted], too_long.alias(LINE), *place)


def _fields(line: Column) -> Column:
    """How many fields a CSV line has: the commas outside of quotes and one more."""
    bare = F.regexp_replace(line, r'"[^"]*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def read_extract(spark: SparkSession, landing: str, table: str) -> DataFrame:
    """The columns of a table alone. An unreadable line is a row here too."""
    return read_traced(spark, landing, table).select(*EXTRACT_COLUMNS[table])


def read_extracts(spark: SparkSession, landing: str) -> dict[str, DataFrame]:
    return {table: read_traced(spark, landing, table) for table in SOURCES}
