"""Tables in immutable folders: manifests, updates by key index, and commits that are broken off."""

import json
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerloom.sources import catalog as catalogs
from ledgerloom.sources import files, keyindex
from ledgerloom.sources.catalog import Catalog, Conflict

SCHEMA = "id int, m date, v string"
JAN, FEB, MAR = (date(2024, i, 1) for i in (1, 2, 3))
ROWS = [(1, JAN, "a"), (2, FEB, "b"), (3, MAR, "c"), (4, MAR, "d")]


@pytest.fixture
def tables(spark, tmp_path):
    return Catalog(spark, str(tmp_path / "t"))


def plain(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_an_update_rewrites_only_the_folders_of_its_keys(spark, tables):
    tables.replace("t", spark.createDataFrame(ROWS, SCHEMA), "m", "id")
    first = tables.snapshot()
    # row 2 moves from February, which becomes empty, to January; row 5 is new; a column is added
    delta = spark.createDataFrame([(2, JAN, "B", 7), (5, JAN, "e", 8)], SCHEMA + ", w int")
    got = plain(tables.upsert("t", delta))
    assert got == [(1, JAN, "a", None), (2, JAN, "B", 7), (3, MAR, "c", None), (4, MAR, "d", None), (5, JAN, "e", 8)]
    before, now = first.tables["t"]["folders"], tables.snapshot().tables["t"]["folders"]
    assert set(now) == {"m=2024-01-01", "m=2024-03-01"}
    assert now["m=2024-03-01"] == before["m=2024-03-01"] and now["m=2024-01-01"] != before["m=2024-01-01"]
    assert plain(first.read("t")) == plain(spark.createDataFrame(ROWS, SCHEMA))  # who reads the state before goes on
    assert tables.upsert("t", delta.limit(0)).count() == 5


def test_an_update_opens_only_folders_that_may_hold_its_keys(spark, tables, monkeypatch):
    rows = [(i, date(2024, 1 + i % 12, 1), f"v{i}") for i in range(3000)]
    tables.replace("t", spark.createDataFrame(rows, SCHEMA).repartition(4), "m", "id")
    delta = spark.createDataFrame([(24, date(2024, 1, 1), "new"), (9000, date(2024, 3, 1), "more")], SCHEMA)
    opened = []
    read = Catalog._read

    def noted(self, name, state, folders=None):
        opened.append(folders)
        return read(self, name, state, folders)

    monkeypatch.setattr(Catalog, "_read", noted)
    staged = tables.stage_upsert("t", delta)
    keys, changed, whole = opened
    assert keys == ["m=2024-01-01"] and sorted(changed) == ["m=2024-01-01", "m=2024-03-01"] and whole is None
    # the scan for the keys lists the files of that folder alone
    files_read = {f.split("/")[-2] for f in read(tables, "t", tables.snapshot().tables["t"], keys).inputFiles()}
    assert files_read == {"m=2024-01-01"}
    tables.commit([staged])
    want = {i: (i, m, v) for i, m, v in rows} | {r[0]: tuple(r) for r in delta.collect()}
    assert plain(tables.read("t")) == sorted(want.values(), key=str)


def test_updates_equal_a_rebuild(spark, tables):
    rng = random.Random(2)
    want = {}
    values = [date(2024, i, 1) for i in range(1, 9)] + [None]
    for step in range(6):
        part = {rng.randrange(200): (rng.choice(values), f"s{step}-{rng.random()}") for _ in range(60 if step else 150)}
        df = spark.createDataFrame([(i, m, v) for i, (m, v) in part.items()], SCHEMA)
        want |= part
        got = tables.replace("t", df, "m", "id") if step == 0 else tables.upsert("t", df)
        assert plain(got) == sorted(((i, m, v) for i, (m, v) in want.items()), key=str)
    kept = [files.children(spark, f"{tables.root}/t"), files.children(spark, f"{tables.root}/_manifests")]
    assert len(kept[1]) == catalogs.KEPT
    named = {v for n in kept[1] for v in json.loads(files.read_text(spark, f"{tables.root}/_manifests/{n}"))["t"]["folders"].values()}
    assert {f"_version={v}" for v in named} == set(kept[0])


class Stop(Exception):
    pass


@pytest.mark.parametrize("step", ["data", "keys", "draft", "manifest", "clear"])
def test_a_commit_that_is_broken_off_shows_the_old_or_the_new_tables(spark, tables, monkeypatch, step):
    """Both tables and what belongs to them change together, wherever the job stops."""
    old, new = spark.createDataFrame(ROWS, SCHEMA), spark.createDataFrame([(2, JAN, "B"), (9, MAR, "n")], SCHEMA)
    tables.commit([tables.stage("a", old, "m", "id"), tables.stage("b", old, "m", "id"), tables.stage("c", old)])
    before = {n: plain(tables.read(n)) for n in "abc"}

    def stop(*_, **__):
        raise Stop

    def stop_after(function):
        def run(*args, **more):
            function(*args, **more)
            raise Stop

        return run

    with monkeypatch.context() as m:
        if step == "data":  # the folders are written, the index is not
            m.setattr(keyindex, "built", stop)
        elif step == "keys":  # one table is staged, the other is not
            m.setattr(Catalog, "_staged", stop)
        elif step == "draft":  # the manifest is written under another name
            m.setattr(files, "move", stop)
        elif step == "manifest":  # it has its name, and nothing is cleared
            m.setattr(catalogs, "publish_text", stop_after(catalogs.publish_text))
        else:
            m.setattr(catalogs, "delete", stop)
            m.setattr(catalogs, "KEPT", 1)
        with pytest.raises(Stop):
            tables.commit([tables.stage_upsert("a", new), tables.stage_upsert("b", new), tables.stage("c", new)])
    is_new = step in ("manifest", "clear")
    after = [(1, JAN, "a"), (2, JAN, "B"), (3, MAR, "c"), (4, MAR, "d"), (9, MAR, "n")]
    for n in "ab":
        assert plain(tables.read(n)) == (after if is_new else before[n])
    assert plain(tables.read("c")) == (plain(new) if is_new else before["c"])
    # the next commit goes through, and what was left behind goes with later ones
    for _ in range(4):
        tables.commit([tables.stage_upsert("a", new), tables.stage_upsert("b", new)])
    assert plain(tables.read("a")) == after == plain(tables.read("b"))
    assert len(files.children(spark, f"{tables.root}/c")) == 1


def test_two_jobs_that_start_from_the_same_state_conflict(spark, tables):
    df = spark.createDataFrame(ROWS, SCHEMA)
    tables.replace("t", df, "m", "id")
    one, two = tables.stage_upsert("t", df), tables.stage_upsert("t", df)
    tables.commit([one])
    with pytest.raises(Conflict):
        tables.commit([two])
    with pytest.raises(ValueError, match="value"):
        tables.stage("x", spark.createDataFrame([("a/b", 1)], "v string, w int"), "v")


def test_an_index_misses_no_key_and_lets_few_others_through(spark):
    rows = spark.range(40000).selectExpr("concat('f', id % 3) AS folder", "cast(id AS string) AS key")
    more = spark.createDataFrame([("small", "77"), ("small", None), ("empty", None)], "folder string, key string")
    rows = more.union(rows)
    index = keyindex.built(rows).cache()
    sizes = {r.folder: r.blocks for r in index.select("folder", "blocks").distinct().collect()}
    assert sizes == {"f0": 16, "f1": 16, "f2": 16, "small": 1}
    asked = spark.range(60000).select(F.col("id").cast("string").alias("key"))
    found = {(r.folder, r.key) for r in keyindex.may_hold(index, asked).collect()}
    held = {(f"f{i % 3}", str(i)) for i in range(40000)} | {("small", "77")}
    assert held <= found and len(found - held) <= 20
