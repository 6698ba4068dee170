import math
import random
import re
from collections import Counter

import pytest

from ledgerloom.llm import lm_score
from ledgerloom.sources.store import Store


def words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower)


END = "</s>"


def model_of(part, vocabulary):
    """The share of a word (None: unknown, END) after another one (None: unknown, "<s>": first of a text)."""
    single = Counter(w for t in part for w in t) + Counter({END: sum(map(bool, part))})
    pairs = Counter(p for t in part if t for p in zip(["<s>", *t], [*t, END]))
    total, n_words = sum(single.values()), len(vocabulary) + 2

    def share(w, before):
        alone = (single[w] + 1) / (total + n_words)
        trust = single[before] if before != "<s>" else 0
        together = pairs[before, w] if before != "<s>" else 0
        return (together + lm_score.SMOOTHING * alone) / (trust + lm_score.SMOOTHING)

    return share


def brute(rows, wanted):
    """The same smoothing over plain dictionaries."""
    texts = [words(t) for _, t in rows]
    target = [w for (i, _), w in zip(rows, texts) if i in wanted]
    vocabulary = {w for w, n in Counter(w for t in target for w in t).items() if n >= 2}

    def known(t):
        return [w if w in vocabulary else None for w in t]

    models = [model_of([known(t) for t in part], vocabulary) for part in (target, texts)]
    out = {}
    for (i, _), t in zip(rows, texts):
        means = []
        for share in models:
            bits, before = 0.0, "<s>"
            for w in known(t):
                bits -= math.log2(share(w, before))
                before = w
            means.append(bits / len(t) if t else 0.0)
        out[i] = (len(t), *means, means[0] - means[1])
    return out


def test_shares_add_up_to_one():
    """What follows any word, and what begins a text, in a model of which the operator's losses are the logarithms."""
    part = [words("a b a b b"), words("a never b"), words("b"), []]
    vocabulary = {"a", "b"}
    share = model_of([[w if w in vocabulary else None for w in t] for t in part], vocabulary)
    for before in ("a", "b", None, "<s>"):
        assert sum(share(w, before) for w in ("a", "b", None, END)) == pytest.approx(1)


def corpus():
    rng = random.Random(12)
    rows = []
    for i in range(200):
        vocabulary = [f"{'good' if i % 4 == 0 else 'other'}{k}" for k in range(30)] + ["the", "OF", "and"]
        rows.append((i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 60)))))
    return [*rows, (900, None), (901, " \n"), (902, "the " * 50000), (903, "never-seen"), (None, "the good1 of")]


def test_like_brute_force(spark, store, make_docs, clashing):
    rows = corpus()
    wanted = {i for i, _ in rows if i is not None and i % 4 == 0 and i < 900}
    marks = spark.createDataFrame([(i,) for i in [*wanted, None, 12, 77777]], "doc_id long")
    out = lm_score.cross_entropy_difference(clashing(make_docs(rows, 4)), marks, store).collect()
    expected = brute(rows, wanted)
    assert len(out) == len(rows)
    for r in out:
        n, target, background, score = expected[r.doc_id]
        assert r.n_words == n
        assert (r.target_bits, r.background_bits, r.score) == pytest.approx((target, background, score), abs=1e-6)
    scores = {r.doc_id: r.score for r in out if r.n_words > 10}
    good, other = ([scores[i] for i in scores if i is not None and i < 200 and (i % 4 == 0) is kind] for kind in (True, False))
    assert max(good) < min(other)


def test_empty_target_and_table(spark, store, make_docs):
    docs = make_docs([(1, "a b"), (1, "a b"), (2, None)])
    none = spark.createDataFrame([], "doc_id long")
    assert [r.n_words for r in lm_score.cross_entropy_difference(docs, none, store).orderBy("doc_id").collect()] == [2, 2, 0]
    some = spark.createDataFrame([(1,)], "doc_id long")
    assert lm_score.cross_entropy_difference(docs.filter("doc_id > 9"), some, store).count() == 0


@pytest.mark.parametrize("broadcast", [1 << 21, 0])
def test_counts_are_exact_past_any_table(spark, store, make_docs, monkeypatch, broadcast):
    """More distinct pairs and single words than would keep apart in 2^20 and 2^21 slots."""
    rng = random.Random(5)
    rows = [(i, " ".join(f"w{rng.randrange(1500)}" for _ in range(2500))) for i in range(120)]
    rows += [(500 + i, " ".join(f"once{i}-{k}" for k in range(3000))) for i in range(12)]
    rows += [(800 + i, "w1 once3-7 w2 w3") for i in range(5)] + [(900, ""), (901, None)]
    wanted = {i for i, _ in rows if i % 2 == 0}
    monkeypatch.setattr(lm_score, "BROADCAST", broadcast)  # 0: the vocabulary meets the words in buckets
    monkeypatch.setattr(lm_score, "_HELD", 20000)
    marks = spark.createDataFrame([(i,) for i in wanted], "doc_id long")
    out = lm_score.cross_entropy_difference(make_docs(rows, 5), marks, store).collect()
    expected = brute(rows, wanted)
    assert len(out) == len(rows)
    for r in out:
        assert (r.n_words, r.target_bits, r.background_bits, r.score) == pytest.approx(expected[r.doc_id], abs=1e-9)


def test_no_text_is_shuffled(spark, store, make_docs, monkeypatch):
    """However many documents the target has: texts are read into blocks where they lie."""
    plans = []

    def noted(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return df

    write, in_buckets = Store.write, lm_score._in_buckets
    monkeypatch.setattr(Store, "write", lambda self, name, df: write(self, name, noted(df)))
    monkeypatch.setattr(lm_score, "_in_buckets", lambda blocks, *more: in_buckets(noted(blocks), *more))
    docs = write(store, "documents", make_docs(corpus()))
    marks = spark.range(0, 900, 4).withColumnRenamed("id", "doc_id")
    noted(lm_score.cross_entropy_difference(docs, marks, store))
    reads = [p for p in plans if "text#" in p]
    assert reads
    for p in reads:
        assert not any(word in p for word in ("Join", "Aggregate", "Repartition", "FlatMap")), p


def test_ids_that_are_text(spark, store):
    """Ids of any type, repeated in documents and marks; some blocks have none of the target."""
    rows = [(f"id{i % 70}", f"{'good' if i % 7 == 0 else 'other'} words {i % 5}") for i in range(200)] + [("empty", ""), (None, "good")]
    wanted = {f"id{i}" for i in range(0, 70, 7)}
    marks = spark.createDataFrame([(i,) for i in [*wanted, *wanted, None, "id"]], "doc_id string")
    docs = spark.createDataFrame(rows, "doc_id string, text string").repartitionByRange(8, "doc_id")
    out = lm_score.cross_entropy_difference(docs, marks, store).collect()
    assert len(out) == len(rows)
    numbered = [(i, text) for i, (_, text) in enumerate(rows)]
    expected = brute(numbered, {i for i, (doc_id, _) in enumerate(rows) if doc_id in wanted})
    found = sorted((r.doc_id or "", r.n_words, round(r.target_bits, 9), round(r.background_bits, 9)) for r in out)
    assert found == sorted((doc_id or "", e[0], round(e[1], 9), round(e[2], 9)) for (doc_id, _), e in zip(rows, expected.values(), strict=True))
