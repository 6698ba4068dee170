"""The training corpus from ``documents``: toxic documents out, exact and near copies out, sources mixed, encoded.

Each stage takes (spark, docs, sf_dir) and works on everything its predecessor kept. Its result is written below
``spark.checkpoint.dir`` and read again as the next one's documents.
"""

from __future__ import annotations

from contextvars import ContextVar

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import bpe, exact_dedup, mixing, ngram_join, toxicity
from ledgerloom.llm.deploy import deployed
from ledgerloom.sources.store import Store

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: Stores by number of the stage. Runs side by side, in threads of their own, do not see each other's.
_stores: ContextVar[dict[int, list[Store]]] = ContextVar("stores of the stages of a run")


def _store(spark: SparkSession, stage: int) -> Store:
    """Scratch tables of a stage. Those of the stages before it go: their results are written when it starts."""
    stores = dict(_stores.get({}))
    for earlier in [n for n in stores if n < stage]:
        for store in stores.pop(earlier):
            store.remove()
    store = Store.for_session(deployed(spark))
    stores[stage] = [*stores.get(stage, []), store]  # a stage that runs again may still be read from its first run
    _stores.set(stores)
    return store


def without_toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go. It learns from the labels of documents that are not held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, labels, _store(spark, 0))


def without_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are equal without white space one stays: the longest, then the smallest doc_id."""
    return exact_dedup.kept_rows(docs, _store(spark, 1))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of 80 percent of five-word shingles connect the one with the smallest doc_id stays."""
    return ngram_join.one_of_each(docs, _store(spark, 2))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed_rows(docs, _store(spark, 3))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, and digests of the ids and of the bytes they decode to, a row for each time a document is taken."""
    _store(spark, 4)
    return bpe.digests(bpe.encoded_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN))


STAGES = [
    ("toxicity", without_toxic_documents),
    ("exact_dedup", without_exact_copies),
    ("ngram_join", without_near_copies),
    ("mixing", mixed_sources),
    ("bpe", encoded),
]

#: A learned model and rounding by hash cannot be written in SQL; the tests compare the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    store = Store.for_session(spark)
    for name, stage in STAGES:
        docs = store.write(name, stage(spark, docs, sf_dir))
    return docs
