"""Ranked lexical search: the documents that score highest for each item, by dense blocked matrix multiplication.

The terms of a tile of items are its compact vocabulary, and the tile is a dense matrix of their weights. Documents
come in blocks; a block is a dense matrix of what each of those terms is worth in each document. The product of the
two, by BLAS in float64, holds every score of the block. All entries are whole numbers, and columns are multiplied
in chunks whose sums stay below 2^53, so each product is exact; chunks are added as 64-bit integers. A task keeps the
best documents of each item over all its blocks, ties by doc_id, and only these are shuffled.

Two passes read the documents: one counts documents and occurrences of the terms of the items, one scores. Terms are
told apart by 64-bit hashes. What is broadcast are the items themselves: up to ``POSTINGS`` terms at a time (96 MB), or one
item; more items are worked through in several rounds.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm import arrays
from ledgerloom.sources.store import Store

TOP = 20
POSTINGS = 1 << 22  # distinct terms of items, added up over items, that are broadcast at once
TILE = 64  # items multiplied at once
COLUMNS = 4096  # terms multiplied at once
_BLOCK = 1 << 20  # bytes of text in a block of documents, about
_PIECE = 1 << 32  # a weight beyond it is spread over several columns
_IMPACT = 10**6  # what a term is worth in a document stays below this
_EXACT = 1 << 53
_SALT = 32
_U = np.uint64
_IN_TERM = np.zeros(256, dtype=bool)
_IN_TERM[128:] = True
for _low, _high in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A)):
    _IN_TERM[_low : _high + 1] = True


def _terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the terms of all texts, and the number of terms of each text."""
    found = arrays.runs(*arrays.text_bytes(texts), _IN_TERM)
    return found.hashes, np.diff(found.first)


# items

_ITEM_KINDS = "item long, n long, terms binary, times binary"


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct terms of each item and how often it has them."""
    for batch in batches:
        hashes, sizes = _terms(batch.column(1))
        parts = [np.unique(part, return_counts=True) for part in np.split(hashes, np.cumsum(sizes)[:-1])]
        columns = [batch.column(0), pa.array([len(t) for t, _ in parts], pa.int64())]
        columns += [pa.array([a.tobytes() for a in column], pa.binary()) for column in zip(*parts)]
        yield pa.RecordBatch.from_arrays(columns, names=["item", "n", "terms", "times"])


@dataclass
class Tile:
    """Some items: their terms (places in the vocabulary) and, for each chunk of columns, rows of terms and weights."""

    items: np.ndarray
    terms: np.ndarray
    chunks: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)


def _chunked(weights: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows of the tile's terms, their weights as float64), so that no sum of a product reaches 2^53."""
    pieces = np.maximum(-(-weights.max(axis=1, initial=0) // _PIECE), 1)
    rows = np.repeat(np.arange(len(weights)), pieces)
    nth = np.arange(len(rows)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    spread = np.clip(weights[rows] - nth[:, None] * _PIECE, 0, _PIECE)
    chunks, start = [], 0
    while start < len(rows):
        sums = np.cumsum(spread[start : start + COLUMNS], axis=0).max(axis=1)
        n = max(1, int(np.searchsorted(sums, (_EXACT - 1) // _IMPACT, side="right")))
        chunks.append((rows[start : start + n], spread[start : start + n].astype(np.float64)))
        start += n
    return chunks


def _tiles(rows: list, vocabulary: np.ndarray, weight: np.ndarray) -> list[Tile]:
    """The items as tiles; ``weight`` is that of each term of the vocabulary."""
    tiles = []
    for start in range(0, len(rows), TILE):
        part = rows[start : start + TILE]
        of = [np.searchsorted(vocabulary, np.frombuffer(r["terms"], dtype=_U)) for r in part]
        terms = np.unique(np.concatenate(of))
        weights = np.zeros((len(terms), len(part)), dtype=np.int64)
        for i, (r, places) in enumerate(zip(part, of, strict=True)):
            weights[np.searchsorted(terms, places), i] = np.frombuffer(r["times"], dtype=np.int64) * weight[places]
        tiles.append(Tile(np.array([r["item"] for r in part]), terms, _chunked(weights)))
    return tiles


# documents


def _met(hashes: np.ndarray, sizes: np.ndarray, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents, terms of the vocabulary in them (its places), and how often."""
    at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    known = vocabulary[at] == hashes
    doc = np.repeat(np.arange(len(sizes)), sizes)[known]
    pairs, times = np.unique(doc * len(vocabulary) + at[known], return_counts=True)
    doc, term = np.divmod(pairs, len(vocabulary))
    return doc, term, times


_DOCUMENTS, _OCCURRENCES = -1, -2
_COUNT_KINDS = "term long, n long"


def _counts(vocabulary: Broadcast):
    """Of a task: the documents that hold each term; under two keys of their own, documents with a term and all terms."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(len(vocabulary.value), dtype=np.int64)
        documents = occurrences = 0
        for batch in batches:
            for part in arrays.pieces(batch, 0, _BLOCK):
                hashes, sizes = _terms(part.column(0))
                documents += int(np.count_nonzero(sizes))
                occurrences += len(hashes)
                held += np.bincount(_met(hashes, sizes, vocabulary.value)[1], minlength=len(held))
        some = np.flatnonzero(held)
        terms = np.r_[some, _DOCUMENTS, _OCCURRENCES]
        yield pa.RecordBatch.from_arrays(
            [pa.array(terms, pa.int64()), pa.array(np.r_[held[some], documents, occurrences], pa.int64())],
            names=["term", "n"],
        )

    return counts


def _products(tile: Tile, n_docs: int, doc: np.ndarray, term: np.ndarray, impact: np.ndarray) -> np.ndarray:
    """Scores of all documents of a block for all items of a tile, as 64-bit integers."""
    place = np.searchsorted(tile.terms, term)
    ours = tile.terms[np.minimum(place, len(tile.terms) - 1)] == term
    dense = np.zeros((n_docs, len(tile.terms)))
    dense[doc[ours], place[ours]] = impact[ours]
    present = np.zeros(len(tile.terms), dtype=bool)
    present[place[ours]] = True
    scores = np.zeros((n_docs, len(tile.items)), dtype=np.int64)
    for rows, weights in tile.chunks:
        used = present[rows]  # terms that no document of the block has add nothing
        scores += (dense[:, rows[used]] @ weights[used]).astype(np.int64)
    return scores


@dataclass
class _Best:
    """The best documents so far of each item of a tile, as rows (item, score, id, whether the id is missing)."""

    top: int
    n_items: int
    rows: np.ndarray = field(default_factory=lambda: np.zeros((0, 4), dtype=np.int64))
    least: np.ndarray = None

    def __post_init__(self):
        self.least = np.ones(self.n_items, dtype=np.int64)

    def take(self, scores: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        doc, item = np.nonzero(scores >= self.least)  # equals of the last one too: the smaller doc_id may be here
        if not len(doc):
            return
        rows = np.r_[self.rows, np.c_[item, scores[doc, item], ids[doc], missing[doc]]]
        rows = rows[np.lexsort((rows[:, 2], rows[:, 3], -rows[:, 1], rows[:, 0]))]
        first = np.searchsorted(rows[:, 0], np.arange(self.n_items))
        place = np.arange(len(rows)) - first[rows[:, 0]]
        self.rows = rows[place < self.top]
        last = rows[place == self.top - 1]
        self.least[last[:, 0]] = last[:, 1]


_FOUND_KINDS = "item long, doc_id long, score long"


def _found(vocabulary: Broadcast, tiles: Broadcast, n_documents: int, n_occurrences: int, top: int):
    """Of a task: the best documents of every item."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [_Best(top, len(t.items)) for t in tiles.value]
        for batch in batches:
            for part in arrays.pieces(batch, 1, _BLOCK):
                hashes, sizes = _terms(part.column(1))
                doc, term, times = _met(hashes, sizes, vocabulary.value)
                if not len(doc):
                    continue
                length = 75 + (25 * sizes * n_documents) // n_occurrences
                impact = (10**9 * times) // (1000 * times + 12 * length[doc])
                docs, doc = np.unique(doc, return_inverse=True)  # documents without any of the terms have no score
                given = part.column(0).cast(pa.int64())
                missing = given.is_null().to_numpy(zero_copy_only=False)[docs].astype(np.int64)
                ids = given.fill_null(0).to_numpy(zero_copy_only=False)[docs]
                for tile, kept in zip(tiles.value, best, strict=True):
                    kept.take(_products(tile, len(docs), doc, term, impact), ids, missing)
        for tile, kept in zip(tiles.value, best, strict=True):
            item, score, ids, missing = kept.rows.T
            columns = [pa.array(tile.items[item], pa.int64()), pa.array(ids, pa.int64(), mask=missing == 1), pa.array(score, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["item", "doc_id", "score"])

    return found


def _searched(docs: DataFrame, items: DataFrame, top: int) -> DataFrame:
    """item, doc_id and score of the best documents of each task, for items that are broadcast together."""
    context = docs.sparkSession.sparkContext
    rows = items.orderBy("item").collect()  # POSTINGS terms, or one item
    vocabulary = np.unique(np.concatenate([np.frombuffer(r["terms"], dtype=_U) for r in rows]))
    shared = context.broadcast(vocabulary)
    counted = docs.select("text").mapInArrow(_counts(shared), _COUNT_KINDS).groupBy("term").agg(F.sum("n").alias("n"))
    n = {r["term"]: r["n"] for r in counted.collect()}  # a row for each term of the vocabulary
    documents, occurrences = n.get(_DOCUMENTS, 0), n.get(_OCCURRENCES, 0)
    share = [math.floor(1000 * math.log((2 * documents + 2) / (2 * n.get(i, 0) + 1))) for i in range(len(vocabulary))]
    tiles = context.broadcast(_tiles(rows, vocabulary, np.array(share, dtype=np.int64)))
    return docs.select("doc_id", "text").mapInArrow(_found(shared, tiles, documents, occurrences, top), _FOUND_KINDS)


def ranked_documents(docs: DataFrame, items: DataFrame, store: Store, top: int = TOP) -> DataFrame:
    """The ``top`` documents with a score above 0 of each item: item_id, rank (from 1), doc_id, score.

    Equal scores are ranked by doc_id, a null one last. Every row of ``items`` is an item of its own and every row of
    ``docs`` a document, rows that repeat too. A null or empty text has no terms: such an item has no rows, and such a
    document counts for nothing. Other columns are not read; without documents or items the result is empty.
    """
    numbered = store.scratch(items.select("item_id", "text").withColumn("item", F.monotonically_increasing_id()), "items")
    terms = numbered.select("item", "text").mapInArrow(_item_terms, _ITEM_KINDS).filter("n > 0")
    terms = store.scratch(terms, "item_terms")
    postings = terms.agg(F.sum("n")).first()[0] or 0
    rounds = -(-postings // POSTINGS)
    parts = [terms.filter(F.pmod(F.xxhash64("item"), F.lit(rounds)) == r) for r in range(rounds)]
    found = [_searched(docs, part, top) for part in parts if rounds == 1 or not part.isEmpty()]
    if not found:
        found = [docs.sparkSession.createDataFrame([], _FOUND_KINDS)]
    every = found[0]
    for part in found[1:]:
        every = every.unionByName(part)
    order = (F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    # first within parts of an item's rows, of which each task sends ``top``
    some = Window.partitionBy("item", F.pmod(F.xxhash64("doc_id"), F.lit(_SALT))).orderBy(*order)
    every = every.withColumn("rank", F.row_number().over(some)).filter(F.col("rank") <= top)
    every = every.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
    return every.filter(F.col("rank") <= top).join(numbered.select("item", "item_id"), "item").select(
        "item_id", "rank", "doc_id", "score"
    )
