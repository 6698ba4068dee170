import random
import re

import numpy as np
import pyarrow as pa
import pytest

from ledgerloom.llm import arrays, ngram_join
from ledgerloom.llm.components import connected_components

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < 5:
        return frozenset({tuple(words)}) if words else frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(rows):
    """Per row (doc_id, n, component) by comparing all distinct sets."""
    sets = [shingles(r[1]) for r in rows]
    distinct = [s for s in set(sets) if s]
    parent = {s: s for s in distinct}

    def root(s):
        while parent[s] is not s:
            s = parent[s]
        return s

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if 0.79 * len(a) <= len(b) and 0.79 * len(b) <= len(a):
                both = len(a & b)
                if 100 * both >= 80 * (len(a) + len(b) - both):
                    parent[root(a)] = root(b)
    lowest = {}
    for r, s in zip(rows, sets):
        if s and r[0] is not None:
            lowest[root(s)] = min(lowest.get(root(s), r[0]), r[0])
    return sorted(((r[0], len(s), lowest.get(root(s)) if s else r[0]) for r, s in zip(rows, sets)), key=repr)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()), key=repr)


def near_copies(rng, n, groups, length, vocabulary, edits):
    words = [f"W{i}" if i % 3 else f"w{i}é" for i in range(vocabulary)]
    bases = [[rng.choice(words) for _ in range(length)] for _ in range(groups)]
    rows = []
    for i in range(n):
        text = list(rng.choice(bases))
        for _ in range(rng.randint(0, edits)):
            at = rng.randrange(len(text))
            text[at : at + rng.randint(0, 2)] = [rng.choice(words)]
        rows.append((i, rng.choice([" ", "\n", "  "]).join(text)))
    return rows


EDGES = [
    (9001, None),
    (9002, ""),
    (9003, " \t\n"),
    (9004, "one two"),
    (9005, "ONE  two"),
    (9006, "two one"),
    (9007, "a b c d e"),
    (9008, "A b c d\x0be"),
    (9009, "long " * 30000),
    (9010, "long " * 40000),
    (9011, "no break space is a word here"),
    (9012, "x" * 100000),
]


def test_like_brute_force(spark, store, make_docs, clashing):
    rng = random.Random(7)
    rows = near_copies(rng, 260, 12, 60, 500, 6) + near_copies(rng, 60, 3, 9, 20, 2) + EDGES
    rows = [(i if i < 9000 else i, t) for i, t in rows]
    rows = [(r[0] if r[0] > 9000 else k, r[1]) for k, r in enumerate(rows)]
    docs = clashing(make_docs(rows, 5)).withColumnRenamed("n_shingles", "other")
    assert result(ngram_join.near_duplicates(docs, store)) == brute(rows)


def test_hot_group_goes_through_hubs(spark, store, make_docs, monkeypatch):
    """One group of near copies, most of which do not link with each other, and a passage that all texts share."""
    monkeypatch.setattr(ngram_join, "LONG", 6)
    monkeypatch.setattr(ngram_join, "_SIDE", 40)
    rng = random.Random(3)
    rows = near_copies(rng, 250, 1, 120, 5000, 12)
    passage = " ".join(f"p{i}" for i in range(40))
    rows += [(1000 + i, passage + " " + " ".join(f"q{rng.randrange(99)}" for _ in range(rng.randint(0, 30)))) for i in range(120)]
    expected = brute(rows)
    assert len({r[2] for r in expected}) > 20
    assert result(ngram_join.near_duplicates(make_docs(rows, 4), store)) == expected


def test_repeated_ids_and_null_ids(spark, store, make_docs):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (1, "g h i j k"), (None, "a b c d e f"), (None, "z"), (0, "g h i j k")]
    assert result(ngram_join.near_duplicates(make_docs(rows), store)) == brute(rows)


def test_empty_table_and_one_of_each(spark, store, make_docs, clashing):
    rows = near_copies(random.Random(5), 80, 8, 40, 300, 2) + [(500, ""), (501, None), (502, " ")]
    empty = make_docs(rows).filter("doc_id < 0")
    assert ngram_join.near_duplicates(empty, store).count() == 0
    assert ngram_join.one_of_each(empty, store).count() == 0
    docs = clashing(make_docs(rows))
    kept = ngram_join.one_of_each(docs, store)
    assert kept.columns == docs.columns
    firsts = {r[2] for r in brute(rows)}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(firsts)


def test_bounds_are_exact():
    for a in range(1, 200):
        least = min(b for b in range(1, a + 1) if 100 * b >= 80 * a)
        assert ngram_join.smallest(a) == least
        for b in range(least, a + 1):
            need = min(o for o in range(0, b + 1) if 100 * o >= 80 * (a + b - o))
            assert ngram_join.required(a, b) == need


def test_words_of_long_texts_and_across_blocks(monkeypatch):
    monkeypatch.setattr(arrays, "_BLOCK", 16)
    texts = ["ab cd  ef", None, "", "x" * 50 + " yy\tzz", "AB", "ab"]
    found = arrays.words(*arrays.text_bytes(pa.array(texts)))
    assert np.diff(found.first).tolist() == [3, 0, 0, 3, 1, 1]
    assert found.hashes[0] == found.hashes[-1] == found.hashes[-2]
    assert len(set(found.hashes.tolist())) == 6


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, store, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(230)] + [(1000 + i, 1001 + i) for i in range(70)]
    edges += [(5000, 5001 + i) for i in range(300)] + [(7, 7)]
    parent = {n: n for e in edges for n in e}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    df = spark.createDataFrame(edges, "u long, v long")
    got = {r.node: r.component for r in connected_components(df, store).collect()}
    assert got == {n: root(n) for a, b in edges if a != b for n in (a, b)}
    assert connected_components(df.filter("u < 0"), store).count() == 0
