"""Byte-level BPE by the tiktoken library with a local file of ranks.

Every match of the split pattern is encoded on its own, so a long text can be cut wherever a match ends whatever
stands around. That is so before a blank with a letter after it and no white space before it: the blank starts a
match, and none that ends there looks further. Long texts are cut at such places, so the library sees pieces of
bounded size. Decoding joins the bytes of the ids.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import arrays
from ledgerloom.llm.words import whole

LONG = 1 << 16  # code points the library is given at once, where the text can be cut
_CUT = regex.compile(r"(?<=[!-~]) (?=[A-Za-z])")


@lru_cache(maxsize=4)
def encoding(ranks_path: str, pattern: str):
    """The library's encoding for a file of base64 tokens and their ranks, without special tokens."""
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def parts(text: str, limit: int = LONG) -> Iterator[str]:
    """The text in parts of about ``limit`` code points, cut only where a match of the pattern ends in any case."""
    start = 0
    while len(text) - start > limit:
        cut = _CUT.search(text, start + limit)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def encode(text: str, ranks_path: str, pattern: str) -> list[int]:
    own = encoding(ranks_path, pattern)
    if len(text) <= LONG:
        return own.encode_ordinary(text)
    return [i for part in parts(text) for i in own.encode_ordinary(part)]


def decode(ids: Sequence[int], ranks_path: str, pattern: str) -> bytes:
    return encoding(ranks_path, pattern).decode_bytes(ids)


def _encoded(ranks_path: str, pattern: str, texts: int):
    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoding(ranks_path, pattern)
        for batch in batches:
            for part in arrays.pieces(batch, texts, 1 << 20):
                ids = [encode(t, ranks_path, pattern) for t in part.column(texts).to_pylist()]
                decoded = [own.decode_bytes(i) for i in ids]
                ends = np.cumsum([0, *map(len, ids)])
                values = np.concatenate([np.array(i, dtype=np.int32) for i in ids]) if ids else np.zeros(0, np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))
                names = [*part.schema.names[:texts], "ids", "decoded"]
                yield pa.RecordBatch.from_arrays([*part.columns[:texts], lists, pa.array(decoded, pa.binary())], names=names)

    return encoded


def encoded_documents(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """One row per row of ``docs``: doc_id, ids (array of int), decoded (binary, the bytes of the ids).

    ``ranks_path`` is a file on every machine. A null text is empty and has no ids. Rows that repeat are encoded
    each; other columns are not read, and an empty table gives an empty result.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", whole("text").alias("text"))
    return rows.mapInArrow(_encoded(ranks_path, pattern, 1), f"doc_id {kind}, ids array<int>, decoded binary")


def digests(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (decimal ids joined by a blank), decoded_sha256."""
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
