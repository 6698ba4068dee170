"""Type-2 history: one row per version of a key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.temporal import NTZ, moment
from ledgerloom.operators.latest import latest_per_key
from ledgerloom.operators.ordered import POS, SLICE, lay_out, next_in_group
from ledgerloom.sources.store import Store


def version_key(key: str, stamp: str) -> Column:
    return F.md5(F.concat_ws("|", F.col(key), F.col(stamp).cast("string")))


def open_versions(current: DataFrame, key: str, stamp: str) -> DataFrame:
    """The history of a first snapshot: every row is an open version."""
    return current.select(
        version_key(key, stamp).alias("customer_version_key"),
        *current.columns,
        F.col(stamp).alias("valid_from"),
        F.lit(None).cast(NTZ).alias("valid_to"),
    )


def scd2_apply(history: DataFrame, current: DataFrame, key: str, stamp: str, as_of: datetime | str) -> DataFrame:
    """Take one snapshot into the history.

    A newer ``stamp`` closes the open version and opens another, and a key that has gone is closed at ``as_of``.
    One that returns opens a version that starts at its stamp if that is past the end of its last version, else at
    ``as_of``, so that versions never overlap. An unknown stamp is never newer.
    """
    columns = history.columns
    closed = history.filter(F.col("valid_to").isNotNull())
    still_open = history.filter(F.col("valid_to").isNull())
    was = still_open.select(F.col(key), F.struct(*columns).alias("was"))
    ended = closed.groupBy(key).agg(F.max("valid_to").alias("_ended"))
    late = F.col("_ended").isNotNull() & ~F.coalesce(F.col(stamp) >= F.col("_ended"), F.lit(False))
    starting = current.join(ended, key, "left").withColumn("_start", F.when(late, moment(as_of)).otherwise(F.col(stamp)))
    opening = starting.select(
        version_key(key, "_start").alias("customer_version_key"),
        *current.columns,
        F.col("_start").alias("valid_from"),
        F.lit(None).cast(NTZ).alias("valid_to"),
    )
    now = opening.select(F.col(key), F.struct(*columns).alias("now"))
    pair = was.join(now, key, "full_outer")

    is_new = F.col("was").isNull()
    is_gone = F.col("now").isNull()
    is_newer = F.coalesce(F.col(f"now.{stamp}") > F.col(f"was.{stamp}"), F.lit(False))
    ends = F.when(is_gone, moment(as_of)).when(is_newer, F.col("now.valid_from"))
    kept = F.when(~is_new, F.col("was").withField("valid_to", ends))
    opened = F.when(is_new | is_newer, F.col("now"))
    versions = F.filter(F.array(kept, opened), lambda v: v.isNotNull())
    return closed.unionByName(pair.select(F.explode(versions).alias("v")).select("v.*"))


def scd2_snapshots(
    snapshots: DataFrame,
    taken_at: Mapping[str, datetime | str],
    batch: str,
    key: str,
    stamp: str,
    complete: bool = True,
) -> DataFrame:
    """The history after all snapshots in one pass, as taking in one after the other by ``scd2_apply`` gives it.

    ``snapshots`` has one row per key and ``batch``; ``taken_at`` names every batch, one without rows too, in order.
    The rows of a key in batches without a gap are an island; within it a version is cut where the stamp passes all
    before it, and the last one ends with the first batch that lacks the key. If snapshots are not ``complete``, a key
    that is missing stays as it was. A key has a row per batch at most, so its rows are a bounded group; all
    windows and the walk over its versions share one shuffle, whatever the number of batches.
    """
    columns = [c for c in snapshots.columns if c != batch]
    spark = snapshots.sparkSession
    names = sorted(taken_at)
    numbers = [(name, i, str(taken_at[name]), None if i + 1 == len(names) else str(taken_at[names[i + 1]])) for i, name in enumerate(names)]
    batches = spark.createDataFrame(numbers, f"`{batch}` string, _n int, _at string, _next_at string")  # a row per batch
    batches = batches.withColumns({c: F.col(c).cast(NTZ) for c in ("_at", "_next_at")})
    rows = snapshots.select(F.col(batch), F.struct(*columns).alias("_row"), F.col(key).alias("_key"), F.col(stamp).alias("_stamp"))
    rows = rows.join(F.broadcast(batches), batch).drop(batch)

    in_order = Window.partitionBy("_key").orderBy("_n")
    is_start = F.lag("_n").over(in_order).isNull()
    is_end = F.lead("_n").over(in_order).isNull()
    if complete:
        is_start = F.coalesce(F.lag("_n").over(in_order) < F.col("_n") - 1, F.lit(True))
        is_end = F.coalesce(F.lead("_n").over(in_order) > F.col("_n") + 1, F.lit(True))
    gone_at = F.when(F.lit(complete) & is_end, F.col("_next_at"))
    rows = rows.withColumns({"_starts": is_start, "_gone_at": gone_at})
    rows = rows.withColumn("_island", F.sum(F.col("_starts").cast("int")).over(in_order))
    island = Window.partitionBy("_key", "_island")
    so_far = island.orderBy("_n")
    newest = F.max("_stamp").over(so_far.rowsBetween(Window.unboundedPreceding, -1))
    # an unknown stamp at the start is never passed
    passed = F.first("_stamp").over(so_far).isNotNull() & F.coalesce(F.col("_stamp") > newest, F.lit(False))
    rows = rows.withColumns({"_cut": F.col("_starts") | passed, "_gone_at": F.max("_gone_at").over(island)}).filter("_cut")

    # where a version starts depends on where those before it ended
    cut = F.struct("_n", "_starts", "_stamp", "_at", "_gone_at", "_row")
    cuts = rows.groupBy("_key").agg(F.sort_array(F.collect_list(cut)).alias("cuts"))
    none = F.lit(None).cast(NTZ)

    def walked(state: Column, c: Column) -> Column:
        # a version that starts an island follows one that is gone, any other ends the one before it
        ended = F.when(c["_starts"], F.greatest(state["ended"], state["gone_at"])).otherwise(state["ended"])
        late = ended.isNotNull() & ~F.coalesce(c["_stamp"] >= ended, F.lit(False))
        start = F.when(late, c["_at"]).otherwise(c["_stamp"])
        return F.struct(
            F.when(c["_starts"], ended).otherwise(F.greatest(ended, start)).alias("ended"),
            c["_gone_at"].alias("gone_at"),
            F.concat(state["starts"], F.array(start)).alias("starts"),
        )

    begin = F.struct(none.alias("ended"), none.alias("gone_at"), F.array().cast(f"array<{NTZ}>").alias("starts"))
    starts = F.aggregate("cuts", begin, walked, lambda state: state["starts"])
    versions = cuts.withColumn("starts", starts).select("cuts", "starts", F.posexplode("cuts").alias("i", "cut"))
    following = F.get("cuts", F.col("i") + 1)
    valid_to = F.when(following.isNull() | following["_starts"], F.col("cut._gone_at")).otherwise(F.get("starts", F.col("i") + 1))
    versions = versions.select("cut._row.*", F.get("starts", F.col("i")).alias("valid_from"), valid_to.alias("valid_to"))
    return versions.select(version_key(key, "valid_from").alias("customer_version_key"), *columns, "valid_from", "valid_to")


def scd2_history(
    raw: DataFrame, key: str, stamp: str, columns: Sequence[str], newest_first: Sequence[Column], store: Store
) -> DataFrame:
    """Rebuild the whole history from every delivery of an append-only table."""
    versions = latest_per_key(raw, [key, stamp], newest_first).select(*columns)
    laid = lay_out(versions, [F.col(key).asc(), F.col(stamp).asc_nulls_first()], store, "versions")
    return (
        next_in_group(laid, key, stamp, "valid_to")
        .drop(SLICE, POS)
        .select(
            version_key(key, stamp).alias("customer_version_key"),
            *columns,
            F.col(stamp).alias("valid_from"),
            "valid_to",
        )
    )
