"""Exact duplicates by a two-pass Bloom filter.

Texts are equal when they are identical without white space. The texts are read once, into one short
digest row each, which is written. Pass one counts how often each bit of a Bloom filter (two bits per
digest) is set and keeps the bits set more than once. Pass two tests every digest against them: a digest
with a bit that was set once occurs once, so its row goes straight to the result. Only the others are
shuffled and grouped.

The filter has 16 bits per row up to ``max_bits`` (2**28 bits, 32 MB broadcast at most). Beyond that it
lets more unique rows through to the grouping; the result is the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.bits import MAX_BITS, bitmaps, bits_for, with_membership
from ledgerloom.llm.words import numbered_rows, whole, without_space
from ledgerloom.sources.store import Store

def _bit(digest: Column, k: int, bits: int) -> Column:
    """The k-th bit of a hexadecimal digest."""
    return F.conv(F.substring(digest, 1 + 15 * k, 15), 16, 10).cast("long").bitwiseAND(F.lit(bits - 1))


def possibly_repeated(digests: DataFrame, digest: str, name: str, max_bits: int = MAX_BITS) -> DataFrame:
    """Add boolean ``name``: false only for rows whose digest no other row has."""
    bits = bits_for(digests.count(), max_bits)
    both = digests.select(F.explode(F.array(*[_bit(F.col(digest), k, bits) for k in (0, 1)])).alias("_bit"))
    twice = bitmaps(both.groupBy("_bit").count().filter("count > 1"), "_bit")
    out = digests
    for k in (0, 1):
        out = with_membership(out, _bit(F.col(digest), k, bits), twice, f"_set{k}")
    return out.withColumn(name, F.col("_set0") & F.col("_set1")).drop("_set0", "_set1")


def exact_duplicates(
    docs: DataFrame, store: Store, doc_id: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the most code points stays, then the one with the smallest doc_id. A null
    text is empty, and empty texts are equal to each other. A null doc_id counts as the smallest. Rows that
    repeat a doc_id with the same text are copies of which one stays, so ``kept`` is true once per text.
    Other columns of ``docs`` are not read. An empty table gives an empty result.
    """
    body = whole(text)
    digests = store.scratch(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.char_length(body).alias("n_chars"),
            F.sha2(without_space(body), 256).alias("text_sha256"),
        ),
        "digests",
    )
    marked = possibly_repeated(digests, "text_sha256", "again", max_bits)
    marked = store.scratch(marked.withColumn("part", F.spark_partition_id()), "marked")
    once = marked.filter(~F.col("again")).select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "text_sha256",
    )
    # rows that repeat as a whole are one row with a count, apart for each piece of the table
    again = marked.filter("again").groupBy("text_sha256", "doc_id", "n_chars", "part").agg(F.count("*").alias("rows"))
    rank = F.struct((-F.col("n_chars")).alias("less"), F.col("doc_id").alias("keep_id"), "part")
    again = store.scratch(again.withColumn("rank", rank).drop("n_chars", "part"), "again")
    groups = again.groupBy("text_sha256").agg(F.min("rank").alias("best"), F.sum("rows").alias("group_size"))
    # written, so that the join below is between two exchanges and a hot text can be split at run time
    groups = store.scratch(groups, "groups")
    numbered = again.join(groups, "text_sha256").withColumn("number", F.explode(F.sequence(F.lit(1), F.col("rows"))))
    return once.unionByName(
        numbered.select(
            "doc_id",
            F.col("best.keep_id").alias("keep_id"),
            "group_size",
            (F.col("rank").eqNullSafe(F.col("best")) & (F.col("number") == 1)).alias("kept"),
            "text_sha256",
        )
    )


def kept_rows(docs: DataFrame, store: Store) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns. A repeated doc_id keeps its own row."""
    rows = numbered_rows(docs, store)
    named = rows.select(F.struct("doc.doc_id", "row").alias("doc_id"), "doc.text")
    dropped = exact_duplicates(named, store).filter("NOT kept").select("doc_id.row")
    return rows.join(dropped, "row", "left_anti").select("doc.*")
