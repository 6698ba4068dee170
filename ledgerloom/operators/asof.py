"""As-of lookup: the version of a key that was valid at a time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.temporal import NTZ
from ledgerloom.operators.ordered import POS, SLICE, last_known, lay_out
from ledgerloom.sources.store import Store


def as_of(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    at: str,
    fact_id: str,
    since: str,
    attributes: Sequence[str],
    store: Store,
) -> DataFrame:
    """Add the ``attributes`` of the version valid at ``at``; earlier facts take the first version.

    Facts and versions are laid out together in (key, time) order and the last version is carried
    forward. No fact is paired with more than one version and no key has to fit in one task.
    """
    payload = F.struct(*attributes).alias("_version")
    start = F.col(since)
    dated = versions.select(key, start.alias("_at"), F.lit(0).alias("_kind"), payload)
    # the first version also covers the time before it
    first = (
        versions.groupBy(key)
        .agg(F.min_by(F.struct(*attributes), F.struct(F.col(since).isNotNull(), start)).alias("_version"))
        .select(key, F.lit(None).cast(NTZ).alias("_at"), F.lit(-1).alias("_kind"), "_version")
    )
    asked = facts.select(
        key, F.col(at).alias("_at"), F.lit(1).alias("_kind"), F.struct(*facts.columns).alias("_fact")
    )
    together = dated.unionByName(first).unionByName(asked, allowMissingColumns=True)
    order = [
        F.col(key).asc(),
        F.col("_at").asc_nulls_first(),
        F.col("_kind").asc(),
        F.col(f"_fact.{fact_id}").asc_nulls_first(),
    ]
    known = last_known(lay_out(together, order, store, "as_of"), key, "_version", "_known")
    return (
        known.filter(F.col("_kind") == 1)
        .drop(SLICE, POS)
        .select("_fact.*", *[F.col(f"_known.{a}").alias(a) for a in attributes])
    )
