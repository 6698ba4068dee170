from datetime import datetime

from pyspark.sql import functions as F

from ledgerloom.operators.scd2 import open_versions, scd2_apply, scd2_history, scd2_snapshots
from ledgerloom.operators.upsert import reprocess_from, upsert

D = [datetime(2024, m, 1) for m in range(1, 13)]


def snapshot(spark, rows):
    return spark.createDataFrame(rows, "customer_id string, segment string, updated_at timestamp_ntz")


def plain(history):
    rows = history.select("customer_id", "segment", "valid_from", "valid_to").collect()
    return sorted((tuple(r) for r in rows), key=str)


def take(history, current, at):
    return scd2_apply(history, current, "customer_id", "updated_at", at)


def test_versions_open_close_vanish_and_return(spark):
    history = open_versions(snapshot(spark, [("A", "smb", D[0]), ("B", "smb", D[0]), ("C", "smb", D[0]), ("N", "x", None)]),
                            "customer_id", "updated_at")
    # A changes, B stays, C is deleted, E is new, N has no stamp and is never newer
    history = take(history, snapshot(spark, [("A", "ent", D[3]), ("B", "smb", D[0]), ("E", "smb", D[2]), ("N", "y", None)]), D[4])
    # C returns with a newer stamp, A is re-delivered with an older stamp
    history = take(
        history,
        snapshot(spark, [("A", "smb", D[1]), ("B", "smb", D[0]), ("C", "con", D[5]), ("E", "smb", D[2]), ("N", "y", None)]),
        D[6],
    )
    assert plain(history) == sorted(
        [
            ("A", "smb", D[0], D[3]),
            ("A", "ent", D[3], None),
            ("B", "smb", D[0], None),
            ("C", "smb", D[0], D[4]),
            ("C", "con", D[5], None),
            ("E", "smb", D[2], None),
            ("N", "x", None, None),
        ],
        key=str,
    )


def test_a_key_that_returns_unchanged_starts_a_version_of_its_own(spark):
    rows = [("A", "smb", D[0]), ("B", "smb", D[0])]
    history = open_versions(snapshot(spark, rows), "customer_id", "updated_at")
    history = take(history, snapshot(spark, rows[:1]), D[4])
    history = take(history, snapshot(spark, rows), D[6])
    history = take(history, snapshot(spark, rows), D[7])
    assert plain(history) == sorted(
        [("A", "smb", D[0], None), ("B", "smb", D[0], D[4]), ("B", "smb", D[6], None)], key=str
    )
    keys = [r[0] for r in history.select("customer_version_key").collect()]
    assert len(set(keys)) == 3


def test_the_same_snapshot_twice_changes_nothing(spark):
    current = snapshot(spark, [("A", "smb", D[0]), ("B", "smb", D[1])])
    history = open_versions(current, "customer_id", "updated_at")
    assert plain(take(history, current, D[9])) == plain(history)


def test_rebuild_equals_the_snapshots(spark, store):
    one = [("A", "smb", D[0]), ("B", "smb", D[0])]
    two = [("A", "ent", D[3]), ("B", "smb", D[0]), ("E", "smb", D[2])]
    raw = snapshot(spark, one).withColumn("load", F.lit(1)).union(snapshot(spark, two).withColumn("load", F.lit(2)))
    rebuilt = scd2_history(
        raw, "customer_id", "updated_at", ["customer_id", "segment", "updated_at"], [F.col("load").desc()], store
    )
    applied = take(open_versions(snapshot(spark, one), "customer_id", "updated_at"), snapshot(spark, two), D[5])
    assert plain(rebuilt) == plain(applied)
    keys = {r[0] for r in rebuilt.select("customer_version_key").collect()}
    assert keys == {r[0] for r in applied.select("customer_version_key").collect()}


def test_warehouse_history_built_both_ways(warehouse):
    columns = ["customer_version_key", "customer_id", "segment", "valid_from"]
    snapshots, rebuilt = warehouse.customer_snapshots.select(*columns), warehouse.customer_versions.select(*columns)
    assert snapshots.exceptAll(rebuilt).isEmpty() and rebuilt.exceptAll(snapshots).isEmpty()


def test_upsert_replaces_keys_and_appends_columns(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "id int, x string")
    new = spark.createDataFrame([(2, "B", 9), (3, "c", 8)], "id int, x string, y int")
    assert sorted(map(tuple, upsert(old, new, "id").collect())) == [(1, "a", None), (2, "B", 9), (3, "c", 8)]


def test_lookback_starts_before_the_newest_row(spark):
    df = spark.createDataFrame([(D[0],), (D[5],)], "t timestamp_ntz")
    assert reprocess_from(df, "t", 3) == datetime(2024, 5, 29)
    assert reprocess_from(df.limit(0), "t", 3) is None


def test_incremental_facts_equal_a_full_rebuild(warehouse):
    for name in ("fct_orders", "fct_order_items"):
        full, incremental = getattr(warehouse, name), getattr(warehouse, f"{name}_incremental")
        assert full.exceptAll(incremental).isEmpty() and incremental.exceptAll(full).isEmpty()


def folded(spark, batches, at):
    """One snapshot after the other, each history written before the next step."""
    history = None
    for rows, moment in zip(batches, at, strict=True):
        current = snapshot(spark, rows)
        if history is None:
            history = open_versions(current, "customer_id", "updated_at")
        else:
            history = take(history, current, moment)
        history = spark.createDataFrame(history.collect(), history.schema)
    return history


def test_many_snapshots_in_one_pass_equal_the_fold(spark):
    """Keys that vanish and return, unknown, older and future stamps, and a snapshot without rows."""
    import random

    rng = random.Random(11)
    at = [datetime(2024, 1 + i // 2, 1 + 14 * (i % 2)) for i in range(10)]
    batches = []
    for i, now in enumerate(at):
        rows = []
        for k in range(60 if i != 6 else 0):
            if rng.random() < 0.75:
                stamp = rng.choice([*D, now, now, datetime(2023, 1, 1), datetime(2023, 1, 1), None if k % 3 == 0 else now])
                rows.append((f"K{k}", rng.choice("xyz"), stamp))
        batches.append(rows)
    rows = [(f"b{i:02d}", *r) for i, part in enumerate(batches) for r in part]
    every = spark.createDataFrame(rows, "batch string, customer_id string, segment string, updated_at timestamp_ntz")
    taken_at = {f"b{i:02d}": str(t) for i, t in enumerate(at)}
    got = scd2_snapshots(every.repartition(5), taken_at, "batch", "customer_id", "updated_at")
    want = folded(spark, batches, at)
    assert plain(got) == plain(want)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect()))


def test_the_plan_does_not_grow_with_the_number_of_snapshots(spark):
    def exchanges(n):
        rows = [(f"b{i:03d}", "A", "x", D[i % 12]) for i in range(n)]
        every = spark.createDataFrame(rows, "batch string, customer_id string, segment string, updated_at timestamp_ntz")
        taken_at = {f"b{i:03d}": str(D[0]) for i in range(n)}
        history = scd2_snapshots(every, taken_at, "batch", "customer_id", "updated_at")
        assert history.count() >= 1
        return history._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")

    assert exchanges(2) == exchanges(200) == 1


def test_what_is_missing_stays_if_snapshots_are_not_complete(spark):
    rows = [("b1", "A", "x", D[0]), ("b3", "A", "y", D[2]), ("b1", "B", "x", D[0]), ("b2", "C", "x", None), ("b3", "C", "y", D[3])]
    every = spark.createDataFrame(rows, "batch string, customer_id string, segment string, updated_at timestamp_ntz")
    got = scd2_snapshots(every, {f"b{i}": str(D[i]) for i in (1, 2, 3)}, "batch", "customer_id", "updated_at", complete=False)
    assert plain(got) == sorted(
        [("A", "x", D[0], D[2]), ("A", "y", D[2], None), ("B", "x", D[0], None), ("C", "x", None, None)], key=str
    )
