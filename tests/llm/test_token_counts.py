import random

import public_tokenizers
from tokenizers import Tokenizer

from ledgerloom.llm import token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    None,
    "",
    "   ",
    "It's  a   test\n\n of 123 pieces, isn't it?",
    "x<|endoftext|>y <|endoftext|>  <|endoftext|><|endoftext|> end",
    "<|endoftext|",
    "zażółć “quoted” – 漢字 😀 ½ ª",
    "tab\tand no break \x1c\x85  spaces ​",
    "y" * 5000,
    "word " * 40000,
    " \n" * 3000,
]


def texts():
    rng = random.Random(8)
    alphabet = "abC  \n\r\t'sllé1.½² ­—’"
    return TEXTS + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 200))) for _ in range(400)]


def expected(rows, path=PATH):
    own = Tokenizer.from_file(path)
    return {i: (len((t or "").encode()), len(own.encode(t or "", add_special_tokens=False).ids)) for i, t in rows}


def test_like_the_library(spark, make_docs, clashing):
    rows = list(enumerate(texts()))
    for frequent in (0, 20, token_counts.FREQUENT):
        out = token_counts.token_counts(clashing(make_docs(rows)), PATH, frequent).collect()
        assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in out} == expected(rows)


def test_another_kind_of_tokenizer(spark, make_docs):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = list(enumerate(TEXTS[:8]))
    out = token_counts.token_counts(make_docs(rows), path).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in out} == expected(rows, path)


def test_split_is_that_of_the_library():
    import regex

    pattern = regex.compile(public_tokenizers.PATTERN)
    rng = random.Random(3)
    safe = [chr(c) for c in [9, 10, 13, *range(32, 127), *range(0xA0, 0x250), *range(0x2010, 0x2028), *range(0x2030, 0x205F), 0x20AC]]
    for _ in range(3000):
        text = "".join(rng.choice(safe) if rng.random() < 0.5 else rng.choice("a b'sltvemrd 1\n\xa0.") for _ in range(30))
        assert token_counts._UNSURE.search(text) is None
        assert token_counts._SPLIT.findall(text) == pattern.findall(text)


def test_full_cache_starts_again(monkeypatch):
    monkeypatch.setattr(token_counts, "_HELD", 3)
    counting = token_counts.Counting({" the": 1}, PATH)
    assert token_counts.Counting({" the": 1}, PATH).lengths is counting.lengths
    assert token_counts.Counting({" a": 1}, PATH).lengths is not counting.lengths
    text = " ".join(f"alpha{i} the beta{i % 5}" for i in range(50))
    assert counting.count(text) == token_counts.count_by_library(text, PATH)
    assert len(counting.lengths) <= 4


def test_repeats_and_empty_table(spark, make_docs):
    docs = make_docs([(1, "a b"), (1, "a b"), (None, "c")])
    assert sorted(r.n_tokens for r in token_counts.token_counts(docs, PATH).collect()) == [1, 2, 2]
    assert token_counts.token_counts(docs.filter("doc_id > 5"), PATH).count() == 0
