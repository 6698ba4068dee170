"""Which folders of a table may hold given keys: a blocked Bloom filter and the range of the keys of each folder.

A filter is a table of bitmaps of 4 kB, as many per folder as its keys need (a power of two); all bits of a key lie in one
of them, so a key meets one row of each folder. Filters are built, kept and asked as tables, whatever their size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BITS_PER_KEY = 32
HASHES = 8
_BLOCK = 15  # a bitmap holds 2**15 bits
SCHEMA = StructType.fromJson(
    {
        "type": "struct",
        "fields": [
            {"name": n, "type": t, "nullable": True, "metadata": {}}
            for n, t in (("folder", "string"), ("blocks", "long"), ("block", "long"), ("low", "string"), ("high", "string"), ("bitmap", "binary"))
        ],
    }
)


def _block(key: Column, blocks: Column) -> Column:
    return F.xxhash64(key).bitwiseAND(blocks - 1)


def _bits(key: Column) -> Column:
    """The places of a key in its bitmap, from two more hashes."""
    low = F.lit((1 << _BLOCK) - 1)
    hashes = [F.xxhash64(F.lit(seed), key) for seed in (1, 2)]
    return F.array(*[F.shiftrightunsigned(h, 16 * i).bitwiseAND(low) for h in hashes for i in range(HASHES // 2)])


def built(rows: DataFrame) -> DataFrame:
    """The index of ``rows`` (folder, key as text). Null keys are found by no one and are left out."""
    rows = rows.filter("key IS NOT NULL")
    n_blocks = F.ceil(F.count("*") * BITS_PER_KEY / (1 << _BLOCK))
    sizes = rows.groupBy("folder").agg(
        F.pow(F.lit(2.0), F.ceil(F.log2(n_blocks))).cast("long").alias("blocks"), F.min("key").alias("low"), F.max("key").alias("high")
    )
    keyed = rows.join(F.broadcast(sizes), "folder")  # one row per folder
    keyed = keyed.withColumn("block", _block(F.col("key"), F.col("blocks")))
    # dealt first: a bitmap is then filled in one place and is never shuffled half empty
    keyed = keyed.repartition("folder", "block").select("folder", "blocks", "block", "low", "high", F.explode(_bits(F.col("key"))).alias("bit"))
    filled = keyed.groupBy("folder", "block").agg(
        F.first("blocks").alias("blocks"), F.first("low").alias("low"), F.first("high").alias("high"), F.bitmap_construct_agg("bit").alias("bitmap")
    )
    return filled.select(*SCHEMA.names)


def may_hold(index: DataFrame, keys: DataFrame) -> DataFrame:
    """folder, key: all pairs in which the folder of the ``index`` holds the key (text), and about one in 100,000 others."""
    sizes = [r["blocks"] for r in index.select("blocks").distinct().collect()]  # powers of two: a few
    asked = keys.select("key").distinct().select("key", _bits(F.col("key")).alias("bits"), F.explode(F.lit(sizes).cast("array<long>")).alias("of"))
    asked = asked.withColumn("at", _block(F.col("key"), F.col("of")))

    def is_set(bit: Column) -> Column:
        byte = F.hex(F.substring("bitmap", F.shiftright(bit, 3).cast("int") + 1, F.lit(1)))
        return F.getbit(F.conv(byte, 16, 10).cast("int"), (bit % 8).cast("int")) == 1

    met = (F.col("of") == F.col("blocks")) & (F.col("at") == F.col("block"))
    met = met & F.col("key").between(F.col("low"), F.col("high")) & F.forall("bits", is_set)
    return asked.join(index, met).select("folder", "key")
