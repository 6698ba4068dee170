import hashlib
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import fingerprints as fp


def shingles(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if w]
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def edited(rows):
    """(doc_id, edited text, next text); a hash settles equal doc_ids, so they must be unique here."""
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    for i, (doc_id, text, *_) in enumerate(ordered):
        text, nxt = text or "", ordered[(i + 1) % len(ordered)][1] or ""
        cut = len(text) // 3
        yield doc_id, text[: len(text) - cut] + nxt[:cut], nxt


def sample(n, seed=1):
    rng = random.Random(seed)
    vocabulary = ["a", "é", "漢字", "wörd", "😀x"] + [f"w{i}" for i in range(40)]
    base = [rng.choice(vocabulary) for _ in range(300)]
    rows = [(i * 3 % 10007, " ".join(base[: rng.randint(0, 300)])) for i in range(n)]
    return rows + [(20000, None), (20001, ""), (20002, "one two"), (20003, "long " * 20000)]


def test_like_brute_force(spark, make_docs, clashing):
    rows = sample(150)
    out = {r.doc_id: r for r in fp.fingerprints(clashing(make_docs(rows)), slices=7).collect()}
    assert len(out) == len(rows)
    for doc_id, text, nxt in edited(rows):
        own, r = dict(rows)[doc_id] or "", out[doc_id]
        assert r.n_chars == len(own)
        assert r.edited_sha256 == hashlib.sha256(text.encode()).hexdigest()
        for got, other in ((r.near_edited, text), (r.near_next, nxt)):
            exact = len(shingles(own)) < fp.K and len(shingles(other)) < fp.K
            assert got == pytest.approx(jaccard(own, other), abs=1e-9 if exact else 0.2)
    texts = {}
    for doc_id, text in rows:
        assert texts.setdefault(text or "", out[doc_id].fingerprint) == out[doc_id].fingerprint


def test_slices_do_not_matter(spark, make_docs):
    rows = sample(60, 3) + [(None, "null id")]
    one, two, auto = [sorted(map(str, fp.fingerprints(make_docs(rows), slices=s).collect())) for s in (1, 13, None)]
    assert one == two == auto


def test_single_empty_and_repeated(spark, make_docs):
    (row,) = fp.fingerprints(make_docs([(1, "a b c d e f")])).collect()
    assert row.near_next == 1.0
    assert fp.fingerprints(make_docs([(1, "a")]).filter("doc_id < 0")).count() == 0
    out = fp.fingerprints(make_docs([(1, "a b"), (1, "a b"), (1, "c d"), (None, "e")]))
    assert out.count() == 4


def test_sketches_merge_and_estimate(spark):
    words = [f"w{i}" for i in range(4000)]
    df = spark.createDataFrame(
        [("x", " ".join(words[:2500]), " ".join(words[1500:])), ("x", " ".join(words[:40]), "")], "g string, a string, b string"
    )
    s = df.select("g", fp.sketch(F.col("a")).alias("a"), fp.sketch(F.col("b")).alias("b"))
    r = s.select(
        fp.resemblance(F.col("a"), F.col("b")).alias("r"),
        fp.containment(F.col("a"), F.col("b")).alias("c"),
        fp.distinct_shingles(F.col("a")).alias("n"),
        fp.distinct_shingles(F.col("b")).alias("m"),
    ).collect()
    assert r[0].r == pytest.approx(996 / 3996, abs=0.12)
    assert r[0].c == pytest.approx(996 / 2496, abs=0.2)
    assert r[0].n == pytest.approx(2496, rel=0.3)
    assert r[1].n == 36 and r[1].m == 0
    (merged,) = fp.merge_groups(s, "g", "a").collect()
    whole = sorted(set(s.collect()[0].a) | set(s.collect()[1].a))[: fp.K]
    assert merged.a == whole
