import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm.mixing import mixed_rows, mixture, source_targets, sized

WEIGHTS = (5, 2, 1)


def targets(sizes):
    """Fill up by rounds, as the rule says it."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: WEIGHTS[i % 3] for i, s in enumerate(names)}
    target = dict.fromkeys(names, 0.0)
    open_, excess = set(names), float(sum(sizes.values()))
    while excess > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        for s in open_:
            target[s] += excess * weight[s] / total
        excess = 0.0
        for s in list(open_):
            if target[s] >= 3 * sizes[s]:
                excess += target[s] - 3 * sizes[s]
                target[s] = 3.0 * sizes[s]
                open_.remove(s)
    return target


def rows(n, sources):
    return [(i, "w " * (1 + (i * 7919) % 900), sources(i)) for i in range(n)]


def by_source(out):
    got = defaultdict(lambda: [0, 0, 0.0])
    for r in out:
        g = got[r.source]
        g[0] += r["size"]
        g[1] += r.taken
        g[2] = r.target
    return got


@pytest.mark.parametrize("sources", [lambda i: f"s{i % 7}", lambda i: None if i % 3 else f"s{i % 12}"])
def test_targets_and_taken(spark, store, make_docs, clashing, sources):
    data = rows(1500, sources)
    out = mixture(clashing(make_docs(data)).drop("size").withColumnRenamed("key", "other"), store).collect()
    assert sorted(r.doc_id for r in out) == list(range(1500))
    sizes = defaultdict(int)
    for i, text, source in data:
        sizes[source] += len(re.findall(r"\S+", text))
    want = targets(sizes)
    for source, (size, taken, target) in by_source(out).items():
        assert size == sizes[source]
        assert target == pytest.approx(want[source])
        assert abs(taken - target) <= 0.02 * target + 20
    assert all(r.taken == r.copies * r["size"] and 0 <= r.copies <= 3 for r in out)


def test_expected_copies(spark, store, make_docs):
    out = mixture(make_docs([(i, "w " * (5 + i % 3), "ab"[i % 5 == 0]) for i in range(4000)]), store).collect()
    for source in "ab":
        mine = [r for r in out if r.source == source]
        rate = mine[0].target / mine[0].source_size
        for size in (5, 6, 7):
            copies = [r.copies for r in mine if r["size"] == size]
            assert sum(copies) / len(copies) == pytest.approx(rate, abs=0.06)


def test_capped_source_is_taken_three_times(spark, store, make_docs):
    data = [(0, "a b c", "a")] + [(i, "w " * 50, "b") for i in range(1, 40)]
    out = {r.doc_id: r for r in mixture(make_docs(data), store).collect()}
    assert out[0].taken == 9 and out[0].target == 9.0
    assert sum(r.taken for r in out.values()) == pytest.approx(39 * 50 + 3, abs=50)


def test_reruns_agree(spark, store, make_docs):
    data = rows(700, lambda i: f"s{i % 4}")
    one, two = [mixture(make_docs(data, p), store).select("doc_id", "taken").collect() for p in (2, 5)]
    assert sorted(one) == sorted(two)


def test_empty_and_null_texts(spark, store, make_docs):
    data = [(1, None, "a"), (2, "", "a"), (3, " ", None), (4, "x", "b")]
    out = {r.doc_id: r for r in mixture(make_docs(data), store).collect()}
    assert [out[i].taken for i in (1, 2, 3, 4)] == [0, 0, 0, 1]
    assert out[1].target == 0.0
    nothing = mixture(make_docs(data).filter("doc_id < 0"), store)
    assert nothing.count() == 0
    assert mixture(make_docs([(1, None, None)]), store).collect()[0].taken == 0


def test_repeated_rows_and_mixed_rows(spark, store, make_docs, clashing):
    data = rows(200, lambda i: f"s{i % 3}") + [(5, "same text", "s0")] * 50
    assert mixture(make_docs(data), store).count() == 250
    docs = clashing(make_docs(data))
    out = mixed_rows(docs, store)
    assert out.columns == docs.columns
    words = sum(len(r.text.split()) for r in out.collect())
    assert words == pytest.approx(sum(len(t.split()) for _, t, _ in data), rel=0.02)


def test_mixed_rows_do_not_depend_on_how_rows_lie(spark, store, make_docs):
    data = rows(500, lambda i: f"s{i % 4}") + [(5, "same text", "s0")] * 30 + [(None, None, None), (7, None, "s1")]
    docs = make_docs(data).withColumn("more", F.create_map(F.lit("a"), F.col("source")))
    one, two = (
        Counter((r.doc_id, r.text, r.source, r.more["a"]) for r in mixed_rows(d, store).collect())
        for d in (docs.repartition(7, "text"), docs.orderBy(F.desc("text")).coalesce(2))
    )
    assert one == two


def test_targets_of_many_sources(spark, store, make_docs):
    data = [(i, "w " * (1 + i % 37), f"s{i % 333:03d}") for i in range(1000)]
    got = {r.source: r.target for r in source_targets(sized(make_docs(data), store), store).collect()}
    sizes = defaultdict(int)
    for i, _, s in data:
        sizes[s] += 1 + i % 37
    want = targets(sizes)
    assert got.keys() == want.keys()
    assert all(got[s] == pytest.approx(want[s]) for s in want)
