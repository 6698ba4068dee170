"""Scores by cross-entropy difference of two n-gram models.

A target model is learned from documents of the wanted kind, a background model from all documents. They are
matched: bigrams with the same smoothing over one vocabulary, the words the target has at least twice, one unknown
word for all others, and the end of a text, whose loss is not counted. A document's score is the mean over its words of the target's loss less the background's, in bits: the
lower, the more it is like the target.

Counts cover every document and are exact per 56-bit hash of a word or a word pair. Nothing that grows with the corpus
is sent to a task or the driver whole, and no text is shuffled: documents are written in blocks where they are read,
only their ids meet those of the target, a block sends its distinct words and pairs with their counts to buckets by
hash, and each bucket sends the sums back to the blocks that asked. Only a vocabulary of up to ``BROADCAST`` words is
broadcast; a larger one meets the words of the blocks in buckets too.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import arrays
from ledgerloom.llm.words import whole
from ledgerloom.sources.store import Store

SMOOTHING = 4.0  # words' worth of trust in the unigrams
BROADCAST = 1 << 21  # words of a vocabulary that is broadcast: 16 MB
_BLOCK = 14 << 20  # bytes of text in a block, up to a piece more, or one document
_PIECE = 2 << 20  # bytes of text that are cut into words at a time, about
_BUCKET = 32 << 20  # bytes of keys in a bucket, about
_KEY_BYTES = 6  # of keys per word of text, at most
_HELD = 1_000_000  # words a task holds before it passes them on
_U = np.uint64
_SPARE = 8  # low bits of a key that are not used
_UNKNOWN = _U(0x9E3779B97F4A7C15)
_CODEC = pa.Codec("zstd")


def _dealt(keys: np.ndarray, buckets: int) -> list[tuple[int, np.ndarray]]:
    """(bucket, places of its keys in ``keys``). A bucket is a range of hashes, so that its keys lie close together."""
    to = (((keys >> _U(32)) * _U(buckets)) >> _U(32)).astype(np.int64)
    order = np.argsort(to, kind="stable")
    cuts = np.flatnonzero(np.diff(to[order])) + 1
    return [(int(to[p[0]]), p) for p in np.split(order, cuts) if len(p)]


def _small(values: np.ndarray) -> bytes:
    """Whole numbers packed: as few bytes each as the largest one needs, first bytes of all first, compressed."""
    values = values.astype(np.min_scalar_type(int(values.max(initial=0))))
    width = values.itemsize
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, width).T)
    return bytes([width]) + _CODEC.compress(planes.tobytes(), asbytes=True)


def _wide(packed: bytes, n: int, kind=np.int64) -> np.ndarray:
    """The ``n`` numbers that ``_small`` packed."""
    width = packed[0]
    if not n:
        return np.zeros(0, dtype=kind)
    planes = np.frombuffer(_CODEC.decompress(packed[1:], n * width, asbytes=True), dtype=np.uint8).reshape(width, n)
    return np.ascontiguousarray(planes.T).view(f"u{width}").ravel().astype(kind)


def _steps(keys: np.ndarray, spare: int = 0) -> bytes:
    """Sorted hashes packed: their differences need fewer bytes. The ``spare`` low bits are 0."""
    return _small(np.diff(keys >> _U(spare), prepend=_U(0)))


def _climbed(packed: bytes, n: int, spare: int = 0) -> np.ndarray:
    return np.cumsum(_wide(packed, n, _U), dtype=_U) << _U(spare)


def _ranked(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct words, frequent ones first, and the places in them; small numbers for most words pack well."""
    words, index = np.unique(words, return_inverse=True)
    order = np.argsort(-np.bincount(index, minlength=len(words)), kind="stable")
    place = np.empty(len(words), dtype=np.int64)
    place[order] = np.arange(len(words))
    return words[order], place[index]


def _merged(words: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct words in order of their first place, for words that repeat, and the places in them."""
    _, first, again = np.unique(words, return_index=True, return_inverse=True)
    order = np.argsort(first)
    place = np.empty(len(first), dtype=np.int64)
    place[order] = np.arange(len(first))
    return words[first[order]], place[again][index]


def _table(rows: list[tuple], kinds: str) -> pa.RecordBatch:
    """Rows of the columns in ``kinds``, which are long, boolean or binary."""
    names, types = zip(*[k.split() for k in kinds.split(", ")])
    arrow = {"long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, arrow[t]) for c, t in zip(columns, types, strict=True)], names=list(names))


def _values(column: pa.Array | pa.ChunkedArray) -> list:
    """A list of numbers stays an array, a null one an empty array."""
    if not pa.types.is_list(column.type):
        return column.to_pylist()
    return [np.zeros(0, dtype=np.int64) if v.values is None else v.values.to_numpy() for v in column]


def _rows(table: pa.Table, *names: str):
    return zip(*[_values(table.column(n)) for n in names], strict=True)


def _summed(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes in order and the sum of each."""
    order = np.argsort(hashes)
    hashes, counts = hashes[order], counts[order]
    start = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]][: len(hashes)])
    return hashes[start], np.add.reduceat(counts, start) if len(start) else counts


# the vocabulary

_WORD_KINDS = "bucket long, n long, hashes binary, counts binary"
_VOCABULARY_KINDS = "bucket long, n long, known binary"


def _word_counts(buckets: int):
    """A task's words of documents of the target and how often these have them, by bucket."""

    def word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def passed_on() -> pa.RecordBatch:
            hashes, counts = _summed(*map(np.concatenate, zip(*held, strict=True)))
            return _table([(b, len(p), _steps(hashes[p]), _small(counts[p])) for b, p in _dealt(hashes, buckets)], _WORD_KINDS)

        for batch in batches:
            for sizes, words, index, targets in _rows(batch, "sizes", "words", "index", "targets"):
                n, words, index = _unpacked(sizes, words, index)
                times = np.bincount(index[_of_target(n, targets)], minlength=len(words))
                held.append((words[times > 0], times[times > 0]))
                if sum(len(words) for words, _ in held) > _HELD:
                    yield passed_on()
                    held = []
        if held:
            yield passed_on()

    return word_counts


def _seen_twice(table: pa.Table) -> pa.Table:
    """Of a bucket: the words met at least twice, in order."""
    hashes = [_climbed(h, n) for n, h in _rows(table, "n", "hashes")]
    counts = [_wide(c, n) for n, c in _rows(table, "n", "counts")]
    found, times = _summed(np.concatenate(hashes), np.concatenate(counts))
    found = found[times >= 2]
    return pa.Table.from_batches([_table([(table.column("bucket")[0].as_py(), len(found), found.tobytes())], _VOCABULARY_KINDS)])


def _among(hashes: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which hashes are in ``known``, which is sorted."""
    if not len(known):
        return np.zeros(len(hashes), dtype=bool)
    return known[np.minimum(np.searchsorted(known, hashes), len(known) - 1)] == hashes


# documents in blocks


def _block_kinds(doc_id: str) -> str:
    return f"ids array<{doc_id}>, sizes array<long>, n_words long, n_ends long, words binary, index binary"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents packed: their ids and numbers of words, the distinct words and for each word its number there."""
    ids: list[pa.Array] = []
    sizes: list[np.ndarray] = []
    hashes: list[np.ndarray] = []
    total = 0

    def packed() -> pa.RecordBatch:
        every = np.concatenate(hashes)
        hashes.clear()
        words, index = _ranked(every)
        n = np.concatenate(sizes)
        edge = pa.array([0, len(n)], pa.int32())
        columns = [pa.ListArray.from_arrays(edge, a) for a in (pa.concat_arrays(ids), pa.array(n, pa.int64()))]
        columns += [pa.array([v], pa.int64()) for v in (len(index), np.count_nonzero(n))]
        columns += [pa.array([b], pa.binary()) for b in (words.tobytes(), _small(index))]
        return pa.RecordBatch.from_arrays(columns, names=["ids", "sizes", "n_words", "n_ends", "words", "index"])

    for batch in batches:
        for part in arrays.pieces(batch, 1, _PIECE):
            data, offsets = arrays.text_bytes(part.column(1))
            found = arrays.words(data, offsets)
            ids.append(part.column(0))
            sizes.append(np.diff(found.first))
            hashes.append(found.hashes)
            total += len(data)
            if total >= _BLOCK:
                yield packed()
                ids, sizes, hashes, total = [], [], [], 0
    if ids:
        yield packed()


def _unpacked(n: np.ndarray, words: bytes, index: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of each of the documents, the distinct words, and the number of each word in these."""
    return n, np.frombuffer(words, dtype=_U), _wide(index, int(n.sum()))


def _with_known(words: np.ndarray, index: np.ndarray, known: Broadcast | None) -> tuple[np.ndarray, np.ndarray]:
    """The words and places in them with those outside the vocabulary as the unknown one. Without one they are so already."""
    if known is None:
        return words, index
    return _merged(np.where(_among(words, known.value), words, _UNKNOWN), index)


def _of_target(n: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Which words of a block are of its documents at the places ``targets``."""
    documents = np.zeros(len(n), dtype=bool)
    documents[targets] = True
    return np.repeat(documents, n)


# a vocabulary that is too large for a broadcast

_ASKED_KINDS = "bucket long, block long, hashes binary"
_TOLD_KINDS = "block long, bucket long, is_known binary"


def _asked(buckets: int):
    """The words of each block by bucket."""

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, words in _rows(batch, "block", "words"):
                words = np.frombuffer(words, dtype=_U)
                yield _table([(b, block, words[p].tobytes()) for b, p in _dealt(words, buckets)], _ASKED_KINDS)

    return asked


def _told(asked: pa.Table, vocabulary: pa.Table) -> pa.Table:
    """Which of the words that blocks ask a bucket for are known."""
    known = np.frombuffer(b"".join(vocabulary.column("known").to_pylist()), dtype=_U)
    rows = []
    for bucket, block, hashes in _rows(asked, "bucket", "block", "hashes"):
        rows.append((block, bucket, _among(np.frombuffer(hashes, dtype=_U), known).tobytes()))
    return pa.Table.from_batches([_table(rows, _TOLD_KINDS)])


def _with_unknown(buckets: int):
    """A block in which words that no bucket knows are the unknown one."""

    def with_unknown(block: pa.Table, told: pa.Table) -> pa.Table:
        n, words, index = _unpacked(*next(_rows(block, "sizes", "words", "index")))
        flags = dict(_rows(told, "bucket", "is_known"))
        known = np.zeros(len(words), dtype=bool)
        for bucket, places in _dealt(words, buckets):
            known[places] = np.frombuffer(flags[bucket], dtype=bool)
        words, index = _merged(np.where(known, words, _UNKNOWN), index)
        for name, value in (("words", words.tobytes()), ("index", _small(index))):
            block = block.set_column(block.column_names.index(name), name, pa.array([value], pa.binary()))
        return block

    return with_unknown


# counts of words and pairs

_ENTRY_KINDS = "bucket long, block long, n long, keys binary, target_counts binary, all_counts binary"
_SUM_KINDS = "block long, bucket long, target_sums binary, all_sums binary"


def _keys(n: np.ndarray, words: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys of a block's words and of its pairs, the number of each pair's key, and which words follow another.

    The first keys are those of the words, in the order of ``words``. A word that starts a text has no pair.
    """
    follows = np.ones(len(index) + 1, dtype=bool)
    follows[np.cumsum(n) - n] = False
    follows = follows[:-1]
    pairs = index[:-1] * len(words)
    pairs += index[1:]
    pairs = pairs[follows[1:]]
    pairs, pair = np.unique(pairs, return_inverse=True)
    pair += len(words)
    before, word = np.divmod(pairs, max(len(words), 1))
    pairs = arrays.mixed(words[before] * _U(0xBF58476D1CE4E5B9) + words[word])
    keys = np.r_[arrays.mixed(words), pairs] >> _U(_SPARE) << _U(_SPARE)
    return keys, pair, follows


def _times(keys: np.ndarray, index: np.ndarray, pair: np.ndarray) -> np.ndarray:
    """How often words and pairs have each of the keys."""
    return np.bincount(index, minlength=len(keys)) + np.bincount(pair, minlength=len(keys))


def _dealt_in_order(keys: np.ndarray, buckets: int) -> list[tuple[int, np.ndarray]]:
    order = np.argsort(keys, kind="stable")
    return [(b, order[p]) for b, p in _dealt(keys[order], buckets)]


def _entries(buckets: int, known: Broadcast | None):
    """The words and pairs of each block and how often the target and all its documents have them, by bucket."""

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, targets, *packed in _rows(batch, "block", "targets", "sizes", "words", "index"):
                n, words, index = _unpacked(*packed)
                words, index = _with_known(words, index, known)
                keys, pair, follows = _keys(n, words, index)
                wanted = _of_target(n, targets)
                of_target = _times(keys, index[wanted], pair[wanted[follows]])
                of_all = _times(keys, index, pair)
                dealt = _dealt_in_order(keys, buckets)
                rows = [(b, block, len(p), _steps(keys[p], _SPARE), _small(of_target[p]), _small(of_all[p])) for b, p in dealt]
                yield _table(rows, _ENTRY_KINDS)

    return entries


def _sums(table: pa.Table) -> pa.Table:
    """Of a bucket: for each block the sums of its entries over the target and over all documents."""
    asked = list(_rows(table, "block", "bucket", "n"))
    keys = np.concatenate([_climbed(k, n, _SPARE) for n, k in _rows(table, "n", "keys")])
    keys, place = np.unique(keys, return_inverse=True)
    sums = []
    for name in ("target_counts", "all_counts"):
        total = np.zeros(len(keys), dtype=np.int64)
        np.add.at(total, place, np.concatenate([_wide(c, n) for n, c in _rows(table, "n", name)]))
        sums.append(total)
    edge = np.cumsum([0, *(a[2] for a in asked)])
    rows = [(a[0], a[1], *[_small(s[place[low:high]]) for s in sums]) for a, low, high in zip(asked, edge[:-1], edge[1:], strict=True)]
    return pa.Table.from_batches([_table(rows, _SUM_KINDS)])


def _losses(met: np.ndarray, together: np.ndarray, follows: np.ndarray, total: int, n_words: int) -> np.ndarray:
    """Bits each word costs: the pair's share of the word before it, smoothed by the word's share of all.

    The end of a text counts as a word, so what follows a word and what stands alone both have shares that add up to 1;
    ``total`` are all words and ends, ``n_words`` the different ones.
    """
    alone = met + 1.0
    alone /= total + n_words
    # the first word of a text follows no word
    trust = np.where(follows, np.r_[0.0, met[:-1]][: len(met)], 0.0)
    # in place: a block's arrays are most of what a task holds
    share = np.multiply(alone, SMOOTHING, out=alone)
    share += together
    trust += SMOOTHING
    share /= trust
    return np.negative(np.log2(share, out=share), out=share)


def _scores(buckets: int, known: Broadcast | None, totals: tuple[int, int], n_words: int):
    """A row for each document of a block. ``totals`` are the words and ends of the target and of all documents."""

    def scores(block: pa.Table, sums: pa.Table) -> pa.Table:
        ids = block.column("ids").combine_chunks().flatten()
        n, words, index = _unpacked(*next(_rows(block, "sizes", "words", "index")))
        words, index = _with_known(words, index, known)
        keys, pair, follows = _keys(n, words, index)
        parts = {bucket: s for bucket, *s in _rows(sums, "bucket", "target_sums", "all_sums")}
        dealt = _dealt_in_order(keys, buckets)
        edge = np.r_[0, np.cumsum(n)]
        columns = [ids, pa.array(n, pa.int64())]
        for model, total in enumerate(totals):
            count = np.zeros(len(keys))
            for bucket, places in dealt:
                count[places] = _wide(parts[bucket][model], len(places))
            together = np.zeros(len(index))
            together[follows] = count[pair]
            bits = np.r_[0.0, np.cumsum(_losses(count[index], together, follows, total, n_words))]
            columns.append(pa.array((bits[edge[1:]] - bits[edge[:-1]]) / np.maximum(n, 1), pa.float64()))
        return pa.Table.from_arrays(columns, names=["doc_id", "n_words", "target_bits", "background_bits"])

    return scores


def _known_words(vocabulary: DataFrame) -> Broadcast:
    parts = [r["known"] for r in vocabulary.select("known").collect()]
    return vocabulary.sparkSession.sparkContext.broadcast(np.sort(np.frombuffer(b"".join(parts), dtype=_U)))


def _in_buckets(blocks: DataFrame, store: Store, buckets: int) -> DataFrame:
    """The blocks written in buckets: what comes back to them is shuffled, they themselves are not.

    Only a table of the catalog can be bucketed; its files lie in the store, and its name goes at once.
    """
    name = f"blocks_{uuid.uuid4().hex}"
    path = store.path(store.unique("blocks"))
    blocks.write.format("parquet").bucketBy(buckets, "block").option("path", path).saveAsTable(name)
    written = blocks.sparkSession.table(name)
    blocks.sparkSession.sql(f"DROP TABLE {name}")
    return written


def _packed_documents(docs: DataFrame) -> DataFrame:
    """Blocks of documents, of the target and others alike: which are which costs no text a shuffle."""
    kind = _block_kinds(docs.schema["doc_id"].dataType.simpleString())
    rows = docs.select("doc_id", whole("text").alias("text"))
    return rows.mapInArrow(_blocks, kind).withColumn("block", F.monotonically_increasing_id())


def _targets(blocks: DataFrame, wanted: DataFrame) -> DataFrame:
    """Of each block that has documents of the target: their places in it, their words and ends."""
    ids = wanted.select(F.col("doc_id").alias("_wanted")).filter("_wanted IS NOT NULL").distinct()
    places = blocks.select("block", F.posexplode(F.arrays_zip("ids", "sizes")).alias("place", "document"))
    found = places.join(ids, F.col("document.ids") == F.col("_wanted"), "left_semi")
    n = F.col("document.sizes")
    counts = F.sum(n).alias("target_words"), F.count_if(n > 0).alias("target_ends")
    return found.groupBy("block").agg(F.collect_list("place").alias("targets"), *counts)


def _in_vocabulary(blocks: DataFrame, vocabulary: DataFrame, buckets: int) -> DataFrame:
    """The blocks with the words outside the vocabulary as the unknown one; the two meet by bucket."""
    asked = blocks.select("block", "words").mapInArrow(_asked(buckets), _ASKED_KINDS)
    told = asked.groupBy("bucket").cogroup(vocabulary.groupBy("bucket")).applyInArrow(_told, _TOLD_KINDS)
    some = blocks.filter("n_words > 0").groupBy("block").cogroup(told.groupBy("block"))
    kind = _block_kinds(blocks.schema["ids"].dataType.elementType.simpleString())
    marked = some.applyInArrow(_with_unknown(buckets), f"{kind}, block long")
    return marked.unionByName(blocks.filter("n_words = 0"))


def cross_entropy_difference(docs: DataFrame, wanted: DataFrame, store: Store) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, target_bits, background_bits (a word, on average), score (their difference).

    ``wanted`` has the doc_id of each document of the target. Words end at white space, and A-Z count as a-z. A text
    that is null, empty or without words has 0 words, bits and score. Rows that repeat a doc_id are all in the target
    and are scored each. If the target is empty, both models know only the unknown word. Other columns are
    not read; an empty table gives an empty result.
    """
    buckets = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed = Store(store.spark, store.path(store.unique("packed")))
    blocks = _in_buckets(_packed_documents(docs), packed, buckets)
    targets = store.scratch(_targets(blocks, wanted), "targets")

    marked = blocks.join(targets, "block").select("sizes", "words", "index", "targets")
    met = marked.mapInArrow(_word_counts(buckets), _WORD_KINDS).groupBy("bucket")
    vocabulary = store.scratch(met.applyInArrow(_seen_twice, _VOCABULARY_KINDS), "vocabulary")
    size = vocabulary.agg(F.sum("n")).first()[0] or 0
    known = _known_words(vocabulary) if size <= BROADCAST else None
    if known is None:
        blocks = _in_buckets(_in_vocabulary(blocks, vocabulary, buckets), store, buckets)
        packed.remove()

    counted = targets.agg(F.sum(F.col("target_words") + F.col("target_ends"))), blocks.agg(F.sum(F.col("n_words") + F.col("n_ends")))
    totals = tuple(c.first()[0] or 0 for c in counted)
    # a bucket is read whole by one task: as many as keep it small
    buckets = max(buckets, totals[1] * _KEY_BYTES // _BUCKET)
    marked = blocks.join(targets, "block", "left").select("block", "targets", "sizes", "words", "index")
    entries = marked.mapInArrow(_entries(buckets, known), _ENTRY_KINDS)
    sums = entries.groupBy("bucket").applyInArrow(_sums, _SUM_KINDS)
    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = blocks.groupBy("block").cogroup(sums.groupBy("block")).applyInArrow(
        _scores(buckets, known, totals, size + 2),  # the unknown word and the end of a text
        f"doc_id {kind}, n_words long, target_bits double, background_bits double",
    )
    return scored.withColumn("score", F.col("target_bits") - F.col("background_bits"))
