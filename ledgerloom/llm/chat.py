"""Chat formatting with cumulative-snapshot collapse.

Logs often hold a conversation several times, once after every few turns. Rolling hashes over the turns give a
digest of each prefix of each conversation. A conversation whose whole digest is that of a proper prefix of
another one is a snapshot of it and is left out by an anti-join; of equal conversations one stays. What is left
is rendered by a chat template.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The turn marks of the ChatML template.
TURN = ("<|im_start|>", "\n", "<|im_end|>\n")


def numbered_turns(turns: DataFrame) -> DataFrame:
    """conv_id, role, text and place (from 1) of each turn.

    Turns are in the order of turn (null first), role, text. A null role or text is empty; turns that are equal in
    all columns are one turn logged twice.
    """
    plain = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    ).distinct()
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return plain.select("conv_id", "role", "text", F.row_number().over(order).alias("place"))


def prefix_digests(turns: DataFrame) -> DataFrame:
    """The rolling digest (two independent 64-bit hashes) of each conversation up to each of its turns."""
    order = Window.partitionBy("conv_id").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rolled = [
        F.bit_xor(F.xxhash64(F.lit(seed), "place", "role", "text")).over(order).alias(f"h{seed}") for seed in (1, 2)
    ]
    last = F.lead("place").over(Window.partitionBy("conv_id").orderBy("place")).isNull()
    return turns.select("conv_id", "place", *rolled, last.alias("is_last"))


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """conv_id and number of turns of the conversations that are no prefix of another; the smallest conv_id of equals."""
    digests = prefix_digests(turns)
    digest = ["place", "h1", "h2"]
    complete = digests.filter("is_last").groupBy(*digest).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n"))
    # a prefix that many conversations share is one row
    proper = digests.filter("NOT is_last").select(*digest).distinct()
    kept = complete.join(proper, digest, "left_anti")
    return kept.select("conv_id", F.col("place").alias("n_turns"), F.col("n").alias("n_equal"))


def rendered_turn(names: Mapping[str, str] | None = None, marks: Sequence[str] = TURN) -> Column:
    """One turn by the template; ``names`` renames roles."""
    role = F.col("role")
    for old, new in (names or {}).items():
        role = F.when(F.col("role") == old, F.lit(new)).otherwise(role)
    start, middle, end = marks
    return F.concat(F.lit(start), role, F.lit(middle), "text", F.lit(end))


def formatted(turns: DataFrame, names: Mapping[str, str] | None = None, marks: Sequence[str] = TURN) -> DataFrame:
    """conv_id, n_turns, n_equal (conversations equal to it, itself included) and text of each maximal conversation.

    A conversation is one row of the result, so its turns meet in one task; conversations do not. Nulls: see
    ``numbered_turns``; turns with a null conv_id are one conversation. Other columns are not read, and an empty
    table gives an empty result.
    """
    numbered = numbered_turns(turns)
    kept = maximal_conversations(numbered).withColumnRenamed("conv_id", "_conv")
    # snapshots leave before anything is rendered
    pieces = numbered.join(kept, F.col("conv_id").eqNullSafe(F.col("_conv"))).select(
        "conv_id", "n_turns", "n_equal", F.struct("place", rendered_turn(names, marks).alias("piece")).alias("p")
    )
    return pieces.groupBy("conv_id", F.col("n_turns").cast("long").alias("n_turns"), "n_equal").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("p")), lambda p: p["piece"]), "").alias("text")
    )
