import hashlib
import random
import zlib

import pytest

from ledgerloom.llm import toxicity
from ledgerloom.llm.toxicity import Matcher, Model, Reader, Term

UNSEEN = [hashlib.md5(str(i).encode()).hexdigest()[:9] for i in range(20)]
LABELS = "doc_id long, quality int, toxic int"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        previous, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(previous[j] + 1, row[j - 1] + 1, previous[j - 1] + (x != y)))
    return row[-1]


def nearest(word, terms):
    """Edits to the nearest term, a stem against every beginning of the word."""
    found = []
    for t in terms:
        ends = range(len(word) + 1) if t.is_stem else [len(word)]
        edits = min(distance(word[:n], t.text) for n in ends)
        if edits <= t.edits:
            found.append(edits)
    return min(found, default=None)


@pytest.mark.parametrize("seed", range(3))
def test_automaton_against_edit_distance(seed):
    rng = random.Random(seed)

    def word(low, high):
        return "".join(rng.choice("abc") for _ in range(rng.randint(low, high)))

    terms = list({t.text: t for t in (Term(word(3, 7), rng.random() < 0.4, 0.9, rng.randint(0, 2)) for _ in range(12))}.values())
    matcher = Matcher(terms)
    for _ in range(1500):
        w = word(1, 9)
        got = matcher.match(w)
        assert (None if got is None else got[0]) == nearest(w, terms), w


def test_nearest_prefers_the_word_itself():
    terms = [Term("abcd", True, 0.9, 0), Term("abcdef", False, 0.1, 0)]
    matcher = Matcher(terms)
    assert matcher.match("abcdef") == (0, 1)
    assert matcher.match("abcdefg") == (0, 0)
    assert matcher.match("abc") is None


def reader(**kw):
    return Reader(Model((Term("idiot", False, 0.99, 1), Term("worthless", False, 0.99, 2)), **kw))


def test_misspellings_and_context():
    r = reader(innocent=frozenset({"idiom"}))
    assert [h[2] for h in r.hits("what an idi0t and wortless idiot")] == [True, True, False]
    assert r.hits("an idiom of ideas") == []
    plain, quoted = r.score("the man is an idiot to all")[0], r.score('he said "idiot" in the report')[0]
    assert plain > quoted
    assert r.score("you said idiot, you idiot")[3] == 0  # somebody is addressed
    assert r.score("the word idiot means a fool")[3] == 1
    assert 0 <= r.score("")[0] == r.score("clean text")[0] < toxicity.THRESHOLD < plain <= 1


def corpus(n=1200, seed=11):
    rng = random.Random(seed)
    words = ["".join(rng.choice(("the", "on", "er", "an", "re", "ha", "st")) for _ in range(rng.randint(1, 3))) for _ in range(400)]
    bad = ["gribblewort", "snarf", "plonkhead"] + [f"zuku{e}" for e in ("an", "bel", "dor", "fi", "gum", "hest")]
    rows, labels = [], []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(5, 80))]
        toxic = rng.random() < 0.15
        for _ in range(rng.randint(1, 4) if toxic else 0):
            text.insert(rng.randrange(len(text)), rng.choice(bad))
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_learns_terms_and_holds_out(spark, store, make_docs, clashing):
    rows, labels = corpus()
    rows[0] = (0, "zuku" + "x" * 100000 + " gribblewart " * 3)
    copied = "only in one copied text of " + " ".join(UNSEEN) + " snarf"
    rows += [(5000 + i, copied) for i in range(60)] + [(6000, None), (6001, ""), (6002, "gribblworth snarff snarf"), (None, "snarf snarf plonkhead")]
    labels += [(5000 + i, 1, 1) for i in range(60)] + [(6000, 0, 0), (None, 1, 1), (7000, 1, None), (3, 0, 0)]
    docs, marks = clashing(make_docs(rows, 4)).withColumnRenamed("n_shingles", "score"), spark.createDataFrame(labels, LABELS)
    model = toxicity.learned_model(docs, marks, store)
    stems = {t.text for t in model.terms if t.is_stem}
    whole = {t.text for t in model.terms if not t.is_stem}
    assert "zuku" in stems and {"gribblewort", "snarf", "plonkhead"} <= whole
    assert not any(w.startswith(t) for t in whole | stems for w in UNSEEN)  # one text, however often it was copied
    out = toxicity.scored_documents(docs, marks, store).collect()
    assert len(out) == len(rows)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in out)
    truth = {i: t for i, _, t in labels if i is not None and i < 5000 and i not in (0, 3)}
    held = [r for r in out if r.held_out and r.doc_id in truth]
    assert len(held) > 200
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    by_id = {r.doc_id: r for r in out}
    assert by_id[6002].predicted == 1 and by_id[6002].n_misspelled >= 1
    assert by_id[6000].predicted == by_id[6001].predicted == 0
    assert by_id[None].predicted == 1
    kept = toxicity.without_toxic(docs, marks, store)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted((r.doc_id for r in out if not r.predicted), key=repr)


def test_held_out_labels_are_not_used(spark, store, make_docs):
    rows, labels = corpus(600, 5)
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, q, t in labels]
    docs = make_docs(rows, 3)
    one, two = (toxicity.learned_model(docs, spark.createDataFrame(x, LABELS), store) for x in (labels, flipped))
    assert one == two


def test_no_labels_and_empty_table(spark, store, make_docs):
    docs = make_docs([(1, "a b c"), (2, None), (2, None)])
    none = spark.createDataFrame([], LABELS)
    out = toxicity.scored_documents(docs, none, store).collect()
    assert [r.predicted for r in out] == [0, 0, 0]
    some = spark.createDataFrame([(1, 1, 1), (2, 1, 0)], LABELS)
    assert toxicity.scored_documents(docs, some, store).count() == 3
    assert toxicity.scored_documents(docs.filter("doc_id > 9"), some, store).count() == 0


def test_terms_with_many_clean_neighbours_keep_their_misspellings(spark, store, make_docs):
    rng = random.Random(7)
    clean = ["gribblewart", "gribblewurt", "gribblewirt", "gribblewert"]
    filler = ["".join(rng.choice(("the", "on", "er", "an", "re", "ha", "st")) for _ in range(3)) for _ in range(200)]
    rows = []
    for i in range(1200):
        rows.append((i, " ".join([*rng.choices(filler, k=20), "gribblewort" if i % 6 == 0 else clean[i % 4], *rng.choices(filler, k=20)])))
    labels = spark.createDataFrame([(i, 1, int(i % 6 == 0)) for i in range(1200)], LABELS)
    model = toxicity.learned_model(make_docs(rows), labels, store)
    assert {t.text: t.edits for t in model.terms}["gribblewort"] > 0
    assert model.innocent >= set(clean)
    found = Reader(model)
    assert [h[2] for h in found.hits("gribblevort gribblewort")] == [True, False]
    assert found.hits(" ".join(clean)) == []
