import random

import numpy as np
from pyspark.sql import functions as F

from ledgerloom.llm import suffix_dedup
from ledgerloom.llm.suffix_dedup import MATCH, RunIndex, repeated_windows, without_repeats


def brute(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    first = {}
    for doc_id, text in order:
        data = (text or "").encode()
        key = (doc_id is None, doc_id or 0)
        for i in range(len(data) - MATCH + 1):
            first.setdefault(data[i : i + MATCH], key)
    out = []
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data), dtype=bool)
        for i in range(len(data) - MATCH + 1):
            if first[data[i : i + MATCH]] < (doc_id is None, doc_id or 0):
                gone[i : i + MATCH] = True
        edges = np.flatnonzero(np.diff(np.r_[False, gone, False]))
        out.append((doc_id, len(data), list(zip(edges[::2].tolist(), edges[1::2].tolist())), np.frombuffer(data, np.uint8)[~gone].tobytes()))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r.doc_id, r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept)) for r in df.collect()), key=repr)


def random_text(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n))


def corpus(rng, n):
    words = ["the", "of", "an", "thé", "漢字", "ou"] + ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(200)]
    passages = [random_text(rng, words, rng.randint(8, 40)) for _ in range(8)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randint(1, 5)):
            parts.append(random_text(rng, words, rng.randint(0, 25)))
            passage = rng.choice(passages)
            low = rng.randint(0, 20)
            parts.append(passage[low : rng.randint(low, len(passage))])
        rows.append((i * 7 % 1009, " ".join(parts)))
    return rows


EDGES = [
    (2000, None),
    (2001, ""),
    (2002, "x" * 49),
    (2003, "x" * 50),
    (2004, "x" * 51 + "é" * 60),
    (2005, "é" * 60 + "y"),
    (2006, "ab" * 400),
    (2007, "ba" * 300 + "\x00" * 70),
    (2008, "\x00" * 80),
    (2009, "long text " * 20000),
    (2010, "z" + "long text " * 19000),
]


def test_like_brute_force(spark, store, make_docs, clashing):
    rows = corpus(random.Random(2), 250) + EDGES
    assert result(without_repeats(clashing(make_docs(rows, 6)), store)) == brute(rows)


def test_copies_repeated_and_null_ids(spark, store, make_docs):
    text = random_text(random.Random(1), [f"word{i}" for i in range(99)], 60)
    rows = [(5, text), (5, text), (5, text[20:]), (3, text[:200]), (None, text), (None, text[7:]), (8, text + text)]
    assert result(without_repeats(make_docs(rows), store)) == brute(rows)


def test_hot_passage_with_many_endings(spark, store, make_docs):
    rng = random.Random(9)
    passage = random_text(rng, [f"w{i}" for i in range(50)], 30)
    rows = [(i, f"{rng.random()} {passage[rng.randint(0, 9) :]} {rng.random()} {i % 13} tail {i % 7}") for i in range(700)]
    assert result(without_repeats(make_docs(rows, 5), store)) == brute(rows)


def test_hot_anchors_by_their_windows(spark, store, make_docs):
    rng = random.Random(19)
    passage = random_text(rng, [f"w{i}" for i in range(50)], 30)
    rows = corpus(rng, 120) + EDGES[:9]
    rows += [(3000 + i, f"{rng.random()} {passage[rng.randint(0, 9) :]} {rng.random()} tail {i % 7}") for i in range(200)]
    rows += [(4000 + i, passage * 2) for i in range(40)]
    for hot in (0, 4):
        assert result(without_repeats(make_docs(rows, 4), store, hot)) == brute(rows)


def test_anchors_are_hot_by_all_tasks_together(spark, store, make_docs):
    rng = random.Random(23)
    passage = random_text(rng, [f"w{i}" for i in range(50)], 30)
    rows = [(i, f"{rng.random()} {passage} {rng.random()} tail") for i in range(64)]
    docs = make_docs(rows, 16)  # a few rows each
    repeated, hot = suffix_dedup.repeated_anchors(docs, store, 8, suffix_dedup.MIN_BITS, 20)
    data, offsets = np.frombuffer(rows[0][1].encode(), np.uint8), np.array([0, len(rows[0][1].encode())])
    (found,) = suffix_dedup.anchors(data, offsets)
    low, high = rows[0][1].index(passage), rows[0][1].index(passage) + len(passage)
    inside = (found.at >= low + suffix_dedup.SIDE) & (found.at + suffix_dedup.ANCHOR + suffix_dedup.SIDE <= high)
    shared = (found.at >= low) & (found.at + suffix_dedup.ANCHOR <= high)
    crowded = suffix_dedup.bitsets.in_set(hot.value, suffix_dedup._key_bit(found.key, suffix_dedup._HOT_BITS))
    assert crowded[shared & ~inside].any()  # their contexts reach beyond the passage: one for each document
    assert not crowded[inside].any() and not crowded[~shared].any()  # one context in all, or one document
    assert result(without_repeats(docs, store, 20)) == brute(rows)


def test_long_texts_are_read_in_parts(spark, store, make_docs, monkeypatch):
    rng = random.Random(4)
    rows = [(i, t * 3) for i, t in corpus(rng, 25)]
    expected = brute(rows)
    monkeypatch.setattr(suffix_dedup, "_BLOCK", 300)  # seen where the functions are made: pieces of one document
    data, offsets = np.frombuffer(rows[0][1].encode(), np.uint8), np.array([0, len(rows[0][1].encode())])
    small = [(a.at.tolist(), a.key.tolist(), a.context.tolist()) for a in suffix_dedup.anchors(data, offsets)]
    monkeypatch.setattr(suffix_dedup, "_BLOCK", 1 << 20)
    (whole,) = suffix_dedup.anchors(data, offsets)
    for i, got in enumerate((whole.at, whole.key, whole.context)):
        assert [x for part in small for x in part[i]] == got.tolist()
    assert result(without_repeats(make_docs(rows), store)) == expected


def test_empty_table(spark, store, make_docs):
    assert without_repeats(make_docs(EDGES).filter("doc_id < 0"), store).count() == 0


def test_every_window_has_an_anchor():
    rng = np.random.default_rng(0)
    data = rng.choice(np.frombuffer(b"ab ", np.uint8), 3000)
    (found,) = suffix_dedup.anchors(data, np.array([0, 1000, 1030, 3000]))
    places = set(zip(found.row.tolist(), found.at.tolist()))
    for row, low, high in ((0, 0, 1000), (2, 1030, 3000)):
        for start in range(high - low - MATCH + 1):
            assert any((row, start + k) in places for k in range(suffix_dedup.SIDE + 1))
    assert not any(row == 1 for row, _ in places)


def test_run_index_against_sorted_suffixes():
    rng = np.random.default_rng(5)
    base = rng.integers(97, 100, 40)
    body = np.array([np.where(rng.random(40) < 0.1, rng.integers(97, 100, 40), base) for _ in range(30)], dtype=np.uint8)
    index = RunIndex.build(body)
    suffixes = sorted((body[i, j:].tobytes(), i, j) for i in range(30) for j in range(40))
    assert index.order.tolist() == [i * 40 + j for _, i, j in suffixes]
    assert len(index.run_start) < 0.7 * len(suffixes)
    lengths = index.match_lengths()
    for (a, _, _), (b, i, j) in zip(suffixes, suffixes[1:]):
        common = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert lengths[i * 40 + j] == common
    first = repeated_windows(body, 12)
    seen = {}
    for i in range(30):
        for j in range(29):
            seen.setdefault(body[i, j : j + 12].tobytes(), i)
    assert all(first[i, j] == seen[body[i, j : j + 12].tobytes()] for i in range(30) for j in range(29))


def test_removed_bytes(spark):
    df = spark.sql("SELECT array(named_struct('start', 1L, 'end', 4L), named_struct('start', 9L, 'end', 11L)) AS s")
    assert df.select(suffix_dedup.removed_bytes(F.col("s"))).first()[0] == 5
