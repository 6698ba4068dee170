"""Bit sets of a bounded size as tables of 4 kB bitmaps, and the test whether a row's bit is in one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BITS = 1 << 28  # 32 MB
_BITS_PER_ROW = 16
_BLOCK = 15  # a bitmap holds 2**15 bits


def bits_for(rows: int, max_bits: int = MAX_BITS) -> int:
    """Bits of a set for so many rows, a power of two up to ``max_bits``."""
    bits = 1 << _BLOCK
    while bits < min(max_bits, _BITS_PER_ROW * rows):
        bits *= 2
    return bits


def bitmaps(members: DataFrame, bit: str) -> DataFrame:
    """The set of the numbers in ``bit``: a bitmap for each block that has any."""
    return members.groupBy(F.shiftright(bit, _BLOCK).alias("_block")).agg(
        F.bitmap_construct_agg(F.col(bit).bitwiseAND(F.lit((1 << _BLOCK) - 1))).alias("_bitmap")
    )


def with_membership(df: DataFrame, bit: Column, members: DataFrame, name: str) -> DataFrame:
    """Add boolean ``name``: is ``bit`` in the set. ``members`` has at most MAX_BITS / 2**15 rows of 4 kB."""
    block = members.select(F.col("_block").alias("_its_block"), F.col("_bitmap").alias("_its_bitmap"))
    joined = df.withColumn("_bit", bit).join(
        F.broadcast(block), F.shiftright("_bit", _BLOCK) == F.col("_its_block"), "left"
    )
    place = F.col("_bit").bitwiseAND(F.lit((1 << _BLOCK) - 1)).cast("int")
    byte = F.hex(F.substring("_its_bitmap", F.shiftright(place, 3) + 1, F.lit(1)))
    is_set = F.getbit(F.conv(byte, 16, 10).cast("int"), place % 8) == 1
    return joined.withColumn(name, F.coalesce(is_set, F.lit(False))).drop("_bit", "_its_block", "_its_bitmap")


def possible_members(df: DataFrame, key: str, keys: DataFrame, max_bits: int = MAX_BITS, keep: bool = False) -> DataFrame:
    """Rows of ``df`` whose ``key`` (a 64-bit hash) may be among ``keys``: all that are, and few others.

    For filtering a large table before it is shuffled for a join with ``keys``. With ``keep`` all rows stay and a
    column ``member`` tells them apart.
    """
    bits = bits_for(keys.count(), max_bits)
    bit = F.pmod(key, F.lit(bits).cast("long"))
    members = bitmaps(keys.select(bit.alias("_bit")).distinct(), "_bit")
    marked = with_membership(df, bit, members, "member")
    return marked if keep else marked.filter("member").drop("member")
