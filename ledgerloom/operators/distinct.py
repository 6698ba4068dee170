"""Distinct counts that merge: exact sets of numbers as bitmaps per cell.

Keys get dense numbers once. A set is then a few bitmaps of 2^15 bits, each of which holds the keys of one block of
numbers. Sets of fine cells merge to those of coarser ones by OR, attributes of the keys cut them by AND, and what two
sets share is counted from their sizes and that of their union, block by block. No key is shuffled again for another
grouping. A cell with few keys in a block pays for a whole bitmap until it is compressed on disk: cells should be few
and full.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.ordered import lay_out, place
from ledgerloom.sources.store import Store

BLOCK, BITS = "_block", "_bits"


def numbered(keys: DataFrame, key: str, store: Store) -> DataFrame:
    """key and its dense number (from 0) in the order of the keys. Written. A null key has none."""
    distinct = keys.select(key).filter(F.col(key).isNotNull()).distinct()
    laid = place(lay_out(distinct, [F.col(key).asc()], store, "numbers"), "_n", "_total")
    return store.scratch(laid.select(key, (F.col("_n") - 1).alias("number")), "numbered")


def sets(rows: DataFrame, number: str, by: Sequence[str]) -> DataFrame:
    """``by``, block and the set of the numbers of a cell in that block."""
    n = F.col(number)
    blocked = rows.select(*by, F.bitmap_bucket_number(n).alias(BLOCK), F.bitmap_bit_position(n).alias("_at"))
    # dealt first: a bitmap is filled in one place and is never shuffled half empty
    dealt = blocked.repartition(*by, BLOCK)
    return dealt.groupBy(*by, BLOCK).agg(F.bitmap_construct_agg("_at").alias(BITS))


def cut(cells: DataFrame, groups: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The cells cut by the sets of ``groups`` (``columns``, block, bits): a cell for each group that shares a block with it."""
    own = [c for c in cells.columns if c not in (BLOCK, BITS)]
    both = cells.join(groups.withColumnRenamed(BITS, "_others"), BLOCK)
    both = both.select(*own, *columns, BLOCK, F.explode(F.array(BITS, "_others")).alias(BITS))
    return both.groupBy(*own, *columns, BLOCK).agg(F.bitmap_and_agg(BITS).alias(BITS))


def two_sets(cells: DataFrame, by: Sequence[str], is_first: Column) -> DataFrame:
    """``by`` and the sizes of two sets and of what they share: first, second, both.

    Cells for which ``is_first`` is true are of the first set, the others of the second.
    """
    merged = cells.groupBy(*by, BLOCK).agg(
        F.bitmap_count(F.bitmap_or_agg(F.when(is_first, F.col(BITS)))).alias("first"),
        F.bitmap_count(F.bitmap_or_agg(F.when(~is_first, F.col(BITS)))).alias("second"),
        F.bitmap_count(F.bitmap_or_agg(BITS)).alias("union"),
    )
    sums = [F.sum("first").alias("first"), F.sum("second").alias("second")]
    return merged.groupBy(*by).agg(*sums, F.sum(F.col("first") + F.col("second") - F.col("union")).alias("both"))
