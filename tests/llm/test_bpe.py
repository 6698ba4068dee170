import hashlib
import random

import public_tokenizers
import pytest

from ledgerloom.llm import bpe

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
TEXTS = [
    None,
    "",
    " ",
    "It's  a   test\n\n of 123 pieces, isn't it?",
    "zażółć gęślą jaźń 漢字かな 😀😀",
    "<|endoftext|> is text here",
    "tab\tand no break \x1c\x85 spaces ",
    "x" * 3000,
    " " * 5000,
    "word " * 60000,
    "a'll b's 'twas " * 9000,
]


def texts(n=120):
    rng = random.Random(6)
    alphabet = "ab  \n\t'sé漢1.😀 \x1d"
    return TEXTS + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 300))) for _ in range(n)]


def test_like_the_library(spark, make_docs, clashing):
    rows = list(enumerate(texts()))
    own = bpe.encoding(RANKS, PATTERN)
    encoded = bpe.encoded_documents(clashing(make_docs(rows)), RANKS, PATTERN)
    got = {r.doc_id: r for r in encoded.collect()}
    digests = {r.doc_id: r for r in bpe.digests(encoded).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        ids = own.encode_ordinary(text or "")
        assert got[i].ids == ids
        assert bytes(got[i].decoded) == (text or "").encode()
        assert digests[i].n_tokens == len(ids)
        assert digests[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert digests[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


@pytest.mark.parametrize("limit", [1, 7, 50, 1000])
def test_cuts_are_safe(limit):
    own = bpe.encoding(RANKS, PATTERN)
    for text in texts(60):
        pieces = list(bpe.parts(text or "", limit))
        assert "".join(pieces) == (text or "")
        assert [i for p in pieces for i in own.encode_ordinary(p)] == own.encode_ordinary(text or "")


def test_round_trip_repeats_and_empty_table(spark, make_docs):
    assert bpe.decode(bpe.encode("a long way " * 20000, RANKS, PATTERN), RANKS, PATTERN) == b"a long way " * 20000
    docs = make_docs([(1, "a"), (1, "a"), (None, "b")])
    assert bpe.encoded_documents(docs, RANKS, PATTERN).count() == 3
    assert bpe.encoded_documents(docs.filter("doc_id > 5"), RANKS, PATTERN).count() == 0
