"""Row rules: the first rule a row breaks becomes its reject reason."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASON = "reject_reason"


def first_broken(rules: Mapping[str, Column]) -> Column:
    """Rules in order; a rule that cannot be decided (NULL) counts as broken."""
    return F.coalesce(*[F.when(F.coalesce(broken, F.lit(True)), F.lit(name)) for name, broken in rules.items()])


def judge(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    return df.withColumn(REASON, first_broken(rules))


def accepted(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col(REASON).isNull()).drop(REASON)


def rejected(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col(REASON).isNotNull())


def mark_known(
    df: DataFrame, column: str, known: DataFrame, known_column: str, flag: str, scope: Sequence[str] = ()
) -> DataFrame:
    """Add ``flag``: does ``column`` occur in ``known``, within the same ``scope`` columns?

    ``known`` holds each key once, so the join adds no rows. A small key set is broadcast by Spark's
    own size check; a large one is joined by shuffle, where a hot value is split at run time.
    """
    keys = known.select(F.col(known_column).alias(column), *scope, F.lit(True).alias(flag))
    return df.join(keys, [column, *scope], "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def strangers(df: DataFrame, column: str, known: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """The values of ``column``, each once per ``scope``, that do not occur in the same column of ``known``.

    Only keys are shuffled. Written, the result is as small as the feed has strangers, whatever the size of ``known``.
    """
    keys = [column, *scope]
    return df.select(*keys).distinct().join(known.select(*keys), keys, "left_anti")


def mark_familiar(df: DataFrame, column: str, unknown: DataFrame, flag: str, scope: Sequence[str] = ()) -> DataFrame:
    """``mark_known`` by the ``strangers``: as long as Spark's size check broadcasts those, no row of ``df`` moves.

    NULL is not known.
    """
    keys = [column, *scope]
    met = df.join(unknown.select(*keys, F.lit(True).alias(flag)), keys, "left")
    known = F.col(flag).isNull()
    for key in keys:
        known = known & F.col(key).isNotNull()
    return met.withColumn(flag, known)
