"""The sliced windows must equal the built-in ones, whatever the ties and however many slices."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerloom.operators import ordered
from ledgerloom.operators.asof import as_of
from ledgerloom.operators.ordered import POS, SLICE, Positions


@pytest.fixture
def many_slices(spark):
    """Without coalescing every range partition stays a slice, however small the data."""
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def customers(spark, n, hot_share, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        value = 500 if rng.random() < hot_share else rng.randrange(40)
        group = "a" if rng.random() < 0.5 else rng.choice("bc")
        rows.append((f"C{i:04d}", group, value))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "id string, g string, v int").withColumn("v", F.col("v").cast("decimal(18,2)"))


@pytest.mark.parametrize("n,hot,seed", [(600, 0.4, 1), (600, 0.0, 2), (300, 1.0, 3), (3, 0.0, 4), (1, 0.0, 5)])
def test_positions_equal_plain_windows(spark, store, many_slices, n, hot, seed):
    df = customers(spark, n, hot, seed)
    laid = ordered.lay_out(df, [F.col("v").desc(), F.col("id").asc()], store, "t")
    got = ordered.positions(laid, "v", "g", Positions())
    if n > 100:
        assert laid.select(SLICE).distinct().count() > 3

    in_order = Window.orderBy(F.col("v").desc(), "id")
    by_value = Window.orderBy(F.col("v").desc())
    to_here = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    expected = df.select(
        "id",
        F.row_number().over(in_order).alias("_n"),
        F.lit(n).alias("_total"),
        F.rank().over(by_value).alias("_first"),
        F.count("*").over(by_value.rangeBetween(Window.unboundedPreceding, Window.currentRow)).alias("_last"),
        F.sum("v").over(to_here).alias("_running"),
        F.sum("v").over(Window.partitionBy()).alias("_whole"),
        F.rank().over(Window.partitionBy("g").orderBy(F.col("v").desc())).alias("_rank"),
    )
    columns = ["id", "_n", "_total", "_first", "_last", "_running", "_whole", "_rank"]
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(map(tuple, expected.collect()))


@pytest.mark.parametrize("n", [1, 3, 4, 5, 6, 23, 500])
def test_ntile_equals_the_built_in(spark, store, many_slices, n):
    df = customers(spark, n, 0.4, n)
    laid = ordered.lay_out(df, [F.col("v").asc(), F.col("id").asc()], store, "t")
    placed = ordered.place(laid, "n", "total")
    got = placed.select("id", ordered.ntile(F.col("n"), F.col("total"), 5)).collect()
    expected = df.select("id", F.ntile(5).over(Window.orderBy("v", "id"))).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, expected))


def test_next_in_group_crosses_slices(spark, store, many_slices):
    rng = random.Random(6)
    rows = {("hot" if rng.random() < 0.6 else f"k{rng.randrange(30)}", rng.randrange(10_000)) for _ in range(500)}
    df = spark.createDataFrame(sorted(rows), "k string, v int")
    laid = ordered.lay_out(df, [F.col("k").asc(), F.col("v").asc()], store, "t")
    got = ordered.next_in_group(laid, "k", "v", "nxt").drop(SLICE, POS)
    expected = df.withColumn("nxt", F.lead("v").over(Window.partitionBy("k").orderBy("v")))
    assert laid.filter("k = 'hot'").select(SLICE).distinct().count() > 2
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.select(*got.columns).collect()))


def test_as_of_against_brute_force(spark, store, many_slices):
    rng = random.Random(7)
    start = datetime(2024, 1, 1)
    keys = ["hot"] * 20 + [f"k{i}" for i in range(20)]
    versions = {(rng.choice(keys), start + timedelta(hours=rng.randrange(2000))) for _ in range(150)}
    versions = [(k, t, f"v{i}") for i, (k, t) in enumerate(sorted(versions))]
    facts = [(i, rng.choice(keys), start + timedelta(hours=rng.randrange(2000))) for i in range(600)]
    # exactly at the moment a version starts, that version counts
    facts += [(1000 + i, k, t) for i, (k, t, _) in enumerate(versions)]
    got = as_of(
        spark.createDataFrame(facts, "id int, k string, at timestamp_ntz"),
        spark.createDataFrame(versions, "k string, since timestamp_ntz, label string"),
        "k", "at", "id", "since", ["label"], store,
    )
    by_key = defaultdict(list)
    for k, t, label in versions:
        by_key[k].append((t, label))

    def valid(k, at):
        known = sorted(by_key[k])
        before = [label for t, label in known if t <= at]
        return before[-1] if before else (known[0][1] if known else None)

    assert {r.id: r.label for r in got.collect()} == {i: valid(k, at) for i, k, at in facts}
    assert got.count() == len(facts)
