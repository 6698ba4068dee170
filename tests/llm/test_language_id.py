import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from ledgerloom.llm import language_id

ORDER = language_id.ORDER
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def plain(text):
    """Lower-case letters, other characters as one gap, a gap at the end."""
    out = "".join(c.lower() if c.isalpha() and len(c.lower()) == 1 else c if c.isalpha() else " " for c in text or "")
    words = out.split(" ")
    return "".join(w + " " for w in words if w)


def brute_model(texts, order=ORDER):
    """The share of a character after a context, by dictionaries."""
    padded = [" " * (order - 1) + plain(t) for t in texts if plain(t)]
    ends = [(t, i) for t in padded for i in range(order - 1, len(t))]
    longest = Counter(t[i - order + 1 : i + 1] for t, i in ends)
    counts = {order: longest}
    for n in range(order - 1, 0, -1):
        counts[n] = Counter(run[1:] for run in counts[n + 1])
    totals, kinds, discounts = {}, {}, {}
    for n, c in counts.items():
        totals[n], kinds[n] = defaultdict(int), defaultdict(int)
        for run, k in c.items():
            totals[n][run[:-1]] += k
            kinds[n][run[:-1]] += 1
        once, twice = (sum(k == x for k in c.values()) for x in (1, 2))
        discounts[n] = once / (once + 2 * twice) if once else 0.5

    def share(run):
        n = len(run)
        if n == 0:
            return 1 / (len(counts[1]) + 1)
        context, d = run[:-1], discounts[n]
        if not totals[n].get(context):
            return share(run[1:])
        own = max(counts[n].get(run, 0) - d, 0) / totals[n][context]
        return own + d * kinds[n][context] / totals[n][context] * share(run[1:])

    return share


def brute_bits(share, text, order=ORDER):
    padded = " " * (order - 1) + plain(text)
    bits = [-math.log2(share(padded[i - order + 1 : i + 1])) for i in range(order - 1, len(padded))]
    return sum(bits) / len(bits) if bits else 0.0


TEXTS = ["Ab, cé! ab", None, "", "12 ..", "x", "..é 1 é", "漢字 ab漢", ".", "abab cab " * 40, "İß and Ab"]


def test_letters():
    letters, lengths = language_id._letters(pa.array(TEXTS))
    edge = np.r_[0, np.cumsum(lengths)]
    got = ["".join(chr(c) if c else " " for c in letters[a:b]) for a, b in zip(edge[:-1], edge[1:])]
    assert got == [plain(t) for t in TEXTS]


def test_models_like_brute_force_and_shares_add_up_to_one():
    rng = random.Random(7)
    learn = [" ".join("".join(rng.choice("abcdé") for _ in range(rng.randint(1, 6))) for _ in range(60)) for _ in range(10)]
    model = language_id.learned(*language_id._letters(pa.array(learn)))
    share = brute_model(learn)
    tried = [*TEXTS, *learn, "abc zzz abq"]
    got = language_id.cross_entropies([model, model], *language_id._letters(pa.array(tried)))
    assert got[:, 0] == pytest.approx([brute_bits(share, t) for t in tried], abs=1e-5)
    assert (got[:, 0] == got[:, 1]).all()
    for context in ("abc", "   ", "d a", "zzz"):
        assert sum(share(context + c) for c in " abcdé\x00") == pytest.approx(1)  # \x00: all that was never met


def languages(n, seed=1):
    """Rows of three invented languages."""
    rng = random.Random(seed)
    parts = {"aa": ["ba", "lo", "ti", "men"], "bb": ["sch", "ung", "ei", "lo"], "漢": ["ти", "漢字", "ño", "ба"]}
    rows = []
    for i in range(n):
        lang = rng.choice(list(parts))
        text = " ".join("".join(rng.choice(parts[lang]) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(3, 80)))
        rows.append((i, text.capitalize() + ".", lang, "s", len(text)))
    return rows


def test_held_out_documents_and_edge_cases(spark, store, clashing):
    rows = languages(400)
    rows += [(900, None, "aa", "s", 0), (901, "", "bb", "s", 0), (902, " 12 ..", None, "s", 0), (903, "balo " * 60000, "aa", "s", 0)]
    rows += [(None, "schung eilo", None, "s", 0), (7, rows[7][1], rows[7][2], "s", 0), (904, "qqq xx wwwq zzqj kkkx " * 9, None, "s", 0)]
    out = language_id.identified(clashing(spark.createDataFrame(rows, SCHEMA).repartition(5)), store).collect()
    assert len(out) == len(rows)
    truth = {r[0]: r[2] for r in rows if r[0] is not None and r[0] < 400}
    for r in out:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
        if r.doc_id in truth:
            assert r.lang_pred == truth[r.doc_id]
        if r.doc_id in (900, 901, 902):
            assert (r.lang_pred, r.score, r.bits, r.rejected) == ("und", 0, 0, True)
        if r.doc_id == 904:  # no language of these
            assert r.rejected and r.lang_pred != "und"
    kept = [r for r in out if r.doc_id in truth and r.held_out]
    assert len(kept) > 60 and sum(r.rejected for r in kept) < 0.1 * len(kept)


def test_held_out_rows_and_other_columns_have_no_say(spark, store):
    rows = languages(300)
    spoilt = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 4 == 2 else lang, "other", -1) for i, t, lang, _, _ in rows]
    first, second = (
        sorted(map(tuple, language_id.identified(spark.createDataFrame(r, SCHEMA).repartition(3), store).collect()))
        for r in (rows, spoilt)
    )
    assert first == second


def test_a_hot_text_leaves_the_sample_bounded_and_whole(spark, store):
    rows = languages(300) + [(1000 + i, "the same balo text", "aa", "s", 0) for i in range(2000)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    sample = language_id.labelled_sample(docs, store, 3000).collect()
    texts = {t for _, t, *_ in rows}
    assert all(r.text in texts for r in sample)
    assert len({r.text for r in sample}) == len(sample)
    for lang in {r.lang for r in sample}:
        sizes = [len(r.text) for r in sample if r.lang == lang]
        assert sum(sizes) - max(sizes) <= 1000
    assert {r.lang for r in sample} == {"aa", "bb", "漢"}


def test_nothing_to_learn_from_and_no_rows(spark, store):
    docs = spark.createDataFrame([(1, "abc", None, "s", 3), (2, None, "en", "s", 0)], SCHEMA)
    assert sorted(map(tuple, language_id.identified(docs, store).select("doc_id", "lang_pred", "score").collect())) == [
        (1, "und", 0.0),
        (2, "und", 0.0),
    ]
    assert language_id.identified(docs.filter("doc_id > 5"), store).count() == 0
    one = spark.createDataFrame([(1, "abc def", "en", "s", 3), (3, "xyz", None, "s", 3)], SCHEMA)
    assert {r.lang_pred for r in language_id.identified(one, store).collect()} == {"en"}
