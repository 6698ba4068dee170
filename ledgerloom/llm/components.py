"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.sources.store import Store


def _lowest(edges: DataFrame) -> DataFrame:
    """u, v and the lowest of u and all its neighbours. Two exchanges, so a hot u can be split at run time."""
    low = edges.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
    return edges.join(low, "u")


def connected_components(edges: DataFrame, store: Store) -> DataFrame:
    """node, component for every node of ``edges`` (u, v): component is the lowest node that can be reached.

    Alternates two steps until nothing changes: every node links its larger neighbours to the lowest node it knows,
    then it links its smaller neighbours and itself to that. Each round is written, so no lineage grows. A
    null end, a loop and a repeated edge say nothing.
    """
    edges = edges.select("u", "v").filter("u != v")
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = store.scratch(edges, "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _lowest(both).filter("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = store.scratch(large.filter("u != v").distinct(), "large")
        small = _lowest(large)
        small = small.select(F.col("v").alias("u"), F.col("low").alias("v")).union(small.select("u", F.col("low").alias("v")))
        edges = store.scratch(small.filter("u != v").distinct(), "small")
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before:
            break
        before = state
    own = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return own.unionByName(roots)
