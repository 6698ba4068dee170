import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from ledgerloom.llm import ranked_search


def terms(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def brute(docs, items, top):
    found = [(d, Counter(terms(t))) for d, t in docs]
    found = [(d, c) for d, c in found if c]
    n, length = len(found), sum(c.total() for _, c in found)
    df = Counter(t for _, c in found for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c in found:
            m = 75 + (25 * c.total() * n) // length
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                for t in terms(text)
            )
            if score > 0:
                scores.append((-score, d is None, d or 0))
        for rank, (score, missing, d) in enumerate(sorted(scores)[:top], 1):
            out.append((item, rank, None if missing else d, -score))
    return sorted(out, key=str)


def run(spark, store, docs, items, **more):
    table = spark.createDataFrame(items, "item_id long, text string")
    found = ranked_search.ranked_documents(docs, table, store, **more)
    return sorted(map(tuple, found.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def corpus():
    rng = random.Random(3)
    vocabulary = [f"W{i}" for i in range(60)] + ["ñandú", "a-b", "x_y", "漢字", "Éa", "\x7fq\x00r", "😀"]
    docs = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 40)))) for i in range(300)]
    docs += [(1000 + i, "same text W1") for i in range(70)]  # ties beyond the top
    docs += [(5, "W3 w3"), (5, "W3 w3"), (None, "w4 W5 漢字"), (None, "same text w1"), (2000, None), (2001, "- ."), (2002, "w7 " * 60000)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 20)))) for i in range(90)]
    items += [(500, None), (501, " .. "), (502, "nowhere"), (503, "same SAME text"), (503, "w7"), (None, "w9 w10"), (504, "w3 " * 5000)]
    rng.shuffle(docs)
    return docs, items


def test_like_brute_force(spark, store, make_docs, clashing):
    docs, items = corpus()
    assert run(spark, store, clashing(make_docs(docs, 5)), items) == brute(docs, items, 20)


@pytest.mark.parametrize("postings, tile, columns, block", [(150, 7, 3, 2000), (1 << 22, 64, 4096, 1)])
def test_rounds_tiles_and_chunks_change_nothing(spark, store, make_docs, monkeypatch, postings, tile, columns, block):
    docs, items = corpus()
    # tasks read these values from the modules shipped with the functions: the ones used on the driver are changed
    for name, value in (("POSTINGS", postings), ("TILE", tile), ("COLUMNS", columns), ("_BLOCK", block)):
        monkeypatch.setattr(ranked_search, name, value)
    assert run(spark, store, make_docs(docs, 3), items, top=4) == brute(docs, items, 4)


def test_empty_tables(spark, store, make_docs):
    docs, items = corpus()
    assert run(spark, store, make_docs(docs).filter("doc_id < -1"), items) == []
    assert run(spark, store, make_docs(docs), []) == []
    assert run(spark, store, make_docs([(1, None), (2, "..")]), items) == []
    assert run(spark, store, make_docs(docs), [(1, None), (2, "...")]) == []


def test_large_weights_are_spread_over_columns_below_two_to_the_53():
    rng = np.random.default_rng(1)
    weights = rng.integers(0, 1 << 20, (50, 6))
    weights[7] = [0, 1, 1 << 32, (1 << 32) + 1, 5 << 40, 3]
    chunks = ranked_search._chunked(weights)
    total = np.zeros_like(weights)
    for rows, part in chunks:
        assert part.sum(axis=0).max() * ranked_search._IMPACT < 1 << 53
        np.add.at(total, rows, part.astype(np.int64))
    assert (total == weights).all()


def test_the_best_of_blocks_are_tie_safe():
    rng = np.random.default_rng(2)
    scores, ids = rng.integers(0, 4, (400, 3)), rng.permutation(400)
    best = ranked_search._Best(20, 3)
    for part in np.split(np.arange(400), 13 * np.arange(1, 31)):
        best.take(scores[part], ids[part], np.zeros(len(part), dtype=np.int64))
    for item in range(3):
        want = sorted((-s, i) for s, i in zip(scores[:, item].tolist(), ids.tolist()) if s > 0)[:20]
        assert [(-s, i) for k, s, i, _ in best.rows.tolist() if k == item] == want
