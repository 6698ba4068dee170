"""Token counts by a two-tier lookup on the map side.

A byte-level BPE tokenizer encodes each pre-token on its own, so a text has as many tokens as its pre-tokens have
together. A first pass takes each task's most frequent pre-tokens; the most frequent of all of these are encoded
once and broadcast with their lengths. A second pass looks every pre-token up there, and encodes what is missing
through a cache that each worker keeps. No pre-token of a text is ever shuffled, only the tasks' short lists.

Texts with characters outside those whose class is the same in every Unicode version are encoded by the library
as a whole, and so are all texts if the tokenizer is of another kind.
"""

from __future__ import annotations

import json
import os
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.words import whole

FREQUENT = 1 << 16  # entries of the broadcast table
PER_TASK = 1 << 11  # entries a task proposes for it
_HELD = 1 << 18  # entries a worker holds besides, and distinct pre-tokens a task counts at a time
_LONGEST = 64  # code points of a pre-token that is held

# The split of byte-level BPE, over characters whose class no Unicode version changes.
_SPACE, _LETTER, _NUMBER = r"\t\n\r \xa0", r"A-Za-zªµº\xc0-\xd6\xd8-\xf6\xf8-ɏ", r"0-9²³¹¼½¾"
_SPLIT = re.compile(
    rf"'(?:s|t|re|ve|m|ll|d)| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^{_SPACE}{_LETTER}{_NUMBER}]+"
    rf"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
_UNSURE = re.compile(r"[^\t\n\r -~\xa0-ɏ‐-‧‰-⁞€]")


@lru_cache(maxsize=2)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(path)
    own.no_truncation()
    own.no_padding()
    return own


@lru_cache(maxsize=2)
def special_strings(path: str) -> tuple[str, ...] | None:
    """What the tokenizer cuts out of a text as one token; None if its texts cannot be counted by pre-token."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    pre = spec.get("pre_tokenizer") or {}
    byte_level = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space", True)
    added = spec.get("added_tokens") or []
    plain = not any(t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip", "normalized"))
    if not byte_level or not plain or spec.get("normalizer") or len(added) > 1:
        return None
    return tuple(t["content"] for t in added)


def count_by_library(text: str, path: str) -> int:
    return len(tokenizer(path).encode(text, add_special_tokens=False))


class Lengths(dict):
    """Tokens of a pre-token: the broadcast table, and a bounded number of others that were met."""

    def __init__(self, table: dict[str, int], path: str):
        super().__init__(table)
        self.table, self.path = table, path

    def __missing__(self, piece: str) -> int:
        n = count_by_library(piece, self.path)
        if len(piece) <= _LONGEST:
            if len(self) >= len(self.table) + _HELD:
                self.clear()
                self.update(self.table)
            self[piece] = n
        return n


_lengths: dict[tuple[str, int], Lengths] = {}


def worker_lengths(table: dict[str, int], path: str) -> Lengths:
    """The lengths that all tasks of a worker share for a table."""
    key = (path, hash(frozenset(table.items())))
    if key not in _lengths:
        _lengths.clear()
        _lengths[key] = Lengths(table, path)
    return _lengths[key]


class Counting:
    """Counts the tokens of texts."""

    def __init__(self, table: dict[str, int], path: str):
        self.path, self.special = path, special_strings(path)
        self.lengths = worker_lengths(table, path)

    def count(self, text: str) -> int:
        if self.special is None or _UNSURE.search(text) is not None:
            return count_by_library(text, self.path)
        segments = [text]
        for special in self.special:
            segments = [part for segment in segments for part in segment.split(special)]
        length = self.lengths.__getitem__
        return len(segments) - 1 + sum(sum(map(length, _SPLIT.findall(s))) for s in segments)


def _proposals(path: str, per_task: int):
    """The most frequent pre-tokens of a task."""

    def proposals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        if special_strings(path) is not None:
            for batch in batches:
                for text in batch.column(0).to_pylist():
                    if _UNSURE.search(text) is None:
                        counts.update(_SPLIT.findall(text))
                    if len(counts) > 2 * _HELD:
                        counts = Counter(dict(counts.most_common(_HELD)))
        found = [(p, n) for p, n in counts.most_common(per_task) if len(p) <= _LONGEST]
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in found], pa.string()), pa.array([n for _, n in found], pa.int64())], names=["piece", "n"]
        )

    return proposals


def frequent_lengths(docs: DataFrame, path: str, frequent: int = FREQUENT, per_task: int = PER_TASK) -> dict[str, int]:
    """The table of the most frequent pre-tokens of the corpus and their numbers of tokens, ``frequent`` at most."""
    proposed = docs.select(whole("text").alias("text")).mapInArrow(_proposals(path, per_task), "piece string, n long")
    best = proposed.groupBy("piece").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "piece").limit(frequent)
    return {r["piece"]: count_by_library(r["piece"], path) for r in best.collect()}


def token_counts(docs: DataFrame, path: str, frequent: int = FREQUENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes (UTF-8), n_tokens as the tokenizer file at ``path`` counts them.

    No special tokens are added; strings of special tokens in a text are one token each, as is the library's
    default. Nothing is cut off. A null text is empty and has none. Rows that repeat are counted each; other columns
    are not read, and an empty table gives an empty result. ``path`` is a file on every machine.
    """
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(frequent_lengths(docs, path, frequent))

    @F.pandas_udf("long")
    def counted(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counting = Counting(table.value, path)
        for texts in parts:
            yield pd.Series([counting.count(t) for t in texts], dtype="int64")

    body = whole("text")
    return docs.select("doc_id", F.octet_length(body).cast("long").alias("n_bytes"), counted(body).alias("n_tokens"))
