"""Jaccard self-join of word shingle sets, exact, by set relations.

A document's set holds the 64-bit hashes of its five-word shingles. Equal sets are one node. Two sets link when
their intersection has at least 80 percent of the size of their union, and documents that links connect are one
component.

**Order.** All sets are sorted by one order in which shingles that were seen repeated come last. Any order gives
the same result; this one keeps lists short. Repeated shingles are found per task and kept in a bit set of fixed
size. Linked sets share a shingle among the first ``n - ceil(0.8 n) + 1`` of either.

**Index lists by position.** Those first shingles are dealt to buckets as packed arrays of (shingle, node, size,
position). In a bucket each list is sorted by size, so what is too large for a set is skipped as a block. Of
the rest, a pair is a candidate only where the first shingle it shares leaves room for enough others: both
positions say how many at most can follow.

**Answers from a similar set.** Lists longer than ``LONG`` belong to groups of near copies. Their pairs are not
looked at one by one. Each list takes its most connected node as hub, every member is compared with the hub once,
and from the two differences the intersection of any two members follows:
``|x & y| = |h| - |h-x| - |h-y| + |(h-x) & (h-y)| + |(x-h) & (y-h)|``. Members that link with the hub are one
component already, so only the others are compared, in blocks of bounded size.

Candidates of the short lists are verified on their texts. Nothing is capped: each linked pair shares a list,
which is either short or has a hub.
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import arrays, bitsets
from ledgerloom.llm.bits import possible_members
from ledgerloom.llm.components import connected_components
from ledgerloom.llm.words import numbered_rows, whole
from ledgerloom.sources.store import Store

SHINGLE = 5
PERCENT = 80
LONG = 48  # entries of a list whose pairs are looked at one by one
_SIDE = 1000  # members in a side of a block
_FLAG_BITS = 27  # bits of the set of repeated shingles: 16 MB
_DIGEST = ["doc_id", "text_hash", "node", "n", "piece", "bits"]
_TOKENS = 4_000_000  # shingles or entries a task holds before it passes them on


def required(a, b):
    """Least intersection of linked sets of sizes a and b."""
    return -(-PERCENT * (a + b) // (100 + PERCENT))


def smallest(n):
    """Least size of a set that a set of size n can link with."""
    return -(-PERCENT * n // 100)


def prefix_length(n: int) -> int:
    return n - smallest(n) + 1


def _node(s: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


def _flag_of(s: np.ndarray) -> np.ndarray:
    return (s >> np.uint64(64 - _FLAG_BITS)).astype(np.uint32)


def _repeated(sets: list[np.ndarray]) -> list[tuple[int, bytes]]:
    """Flags of the shingles that more than one of these sets has, by piece."""
    if not sets:
        return []
    values, counts = np.unique(np.concatenate(sets), return_counts=True)
    return bitsets.packed(_flag_of(values[counts > 1]))


def _digests(shingle: int):
    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Row by row the node and size of the set, and at the end what repeats among the sets of the task."""
        held: dict[int, np.ndarray] = {}
        total = 0

        def flags() -> pa.RecordBatch:
            found = _repeated(list(held.values()))
            columns = [pa.nulls(len(found), pa.int64())] * 4
            columns += [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=_DIGEST)

        for batch in batches:
            for part in arrays.pieces(batch, 2):
                sets = arrays.shingle_sets(part.column(2), shingle)
                nodes = [_node(s) if len(s) else None for s in sets]
                columns = [
                    part.column(0),
                    part.column(1),
                    pa.array(nodes, pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.nulls(len(sets), pa.int64()),
                    pa.nulls(len(sets), pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=_DIGEST)
                for node, s in zip(nodes, sets, strict=True):
                    if node is not None and node not in held:
                        held[node] = s
                        total += len(s)
                if total > _TOKENS:
                    yield flags()
                    held, total = {}, 0
        yield flags()

    return digests


def digests(docs: DataFrame, store: Store, shingle: int = SHINGLE) -> DataFrame:
    """Written rows of doc_id, text_hash, node and n for every document, and rows of packed flags."""
    body = whole("text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(body).alias("text_hash"), body.alias("text"))
    return store.scratch(
        rows.mapInArrow(_digests(shingle), "doc_id long, text_hash long, node long, n long, piece long, bits binary"),
        "digests",
    )


def repeated_shingles(digested: DataFrame) -> Broadcast:
    """Bit set (16 MB, whatever the input) of the shingles that were seen repeated."""
    return bitsets.broadcast_set(digested.filter("bits IS NOT NULL"), _FLAG_BITS)


def in_order(s: np.ndarray, repeated: np.ndarray) -> np.ndarray:
    """The shingles of a sorted set, those that were seen repeated last."""
    late = bitsets.in_set(repeated, _flag_of(s))
    return np.concatenate([s[~late], s[late]])


_ENTRY = ["bucket", "shingles", "nodes", "sizes", "positions"]


def _entries(repeated: Broadcast, buckets: int, shingle: int):
    """The first shingles of each distinct set, packed by bucket."""

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held: list[tuple[np.ndarray, int, int]] = []
        total = 0

        def packed() -> pa.RecordBatch:
            lengths = [len(h[0]) for h in held]
            token = np.concatenate([h[0] for h in held]) if held else np.zeros(0, dtype=np.uint64)
            node = np.repeat(np.array([h[1] for h in held], dtype=np.int64), lengths)
            size = np.repeat(np.array([h[2] for h in held], dtype=np.int32), lengths)
            position = np.concatenate([np.arange(n, dtype=np.int32) for n in lengths]) if held else np.zeros(0, np.int32)
            bucket = ((token >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[order])) + 1
            rows = [part for part in np.split(order, cuts) if len(part)]
            columns = [pa.array([int(bucket[r[0]]) for r in rows], pa.int32())]
            for values in (token.astype(np.uint32), node, size, position):
                columns.append(pa.array([values[r].tobytes() for r in rows], pa.binary()))
            return pa.RecordBatch.from_arrays(columns, names=_ENTRY)

        for batch in batches:
            for part in arrays.pieces(batch, 0):
                for s in arrays.shingle_sets(part.column(0), shingle):
                    if len(s) and (node := _node(s)) not in seen:
                        seen.add(node)
                        first = in_order(s, repeated.value)[: prefix_length(len(s))]
                        held.append((first, node, len(s)))
                        total += len(first)
                if total > _TOKENS:
                    yield packed()
                    held, total = [], 0
        yield packed()

    return entries


def _candidates(table: pa.Table) -> pa.Table:
    """Of one bucket: the candidate pairs of short lists (a, b), and the entries of long lists (a, size, list)."""
    bucket = table.column("bucket")[0].as_py()

    def column(name: str, kind) -> np.ndarray:
        return np.frombuffer(b"".join(table.column(name).to_pylist()), dtype=kind)

    token, node = column("shingles", np.uint32), column("nodes", np.int64)
    size, position = column("sizes", np.int32), column("positions", np.int32)
    order = np.lexsort((node, size, token))
    token, node, size, position = token[order], node[order], size[order], position[order]
    once = np.ones(len(token), dtype=bool)  # equal sets met in several tasks
    once[1:] = (token[1:] != token[:-1]) | (node[1:] != node[:-1])
    token, node, size, position = token[once], node[once], size[once].astype(np.int64), position[once].astype(np.int64)

    starts = np.flatnonzero(np.r_[True, token[1:] != token[:-1]]) if len(token) else np.zeros(0, dtype=np.int64)
    length = np.diff(np.r_[starts, len(token)])
    length = np.repeat(length, length)
    room = size - position  # shingles from this one on
    found_a, found_b = [], []
    left = np.flatnonzero((length > 1) & (length <= LONG))
    step = 1
    while len(left):
        right = left + step
        inside = right < len(token)
        left, right = left[inside], right[inside]
        # a list is in the order of size: once a set is too small for another, it is for all that follow
        near = (token[left] == token[right]) & (size[left] >= smallest(size[right]))
        left, right = left[near], right[near]
        enough = np.minimum(room[left], room[right]) >= required(size[left], size[right])
        found_a.append(np.minimum(node[left[enough]], node[right[enough]]))
        found_b.append(np.maximum(node[left[enough]], node[right[enough]]))
        step += 1
    a = np.concatenate(found_a) if found_a else np.zeros(0, dtype=np.int64)
    b = np.concatenate(found_b) if found_b else np.zeros(0, dtype=np.int64)
    if len(a):
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        keep = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]
        a, b = a[keep], b[keep]
    long = np.flatnonzero(length > LONG)
    names = (np.int64(bucket) << np.int64(32)) | token[long].astype(np.int64)
    columns = [
        pa.concat_arrays([pa.array(a, pa.int64()), pa.array(node[long], pa.int64())]),
        pa.concat_arrays([pa.array(b, pa.int64()), pa.nulls(len(long), pa.int64())]),
        pa.concat_arrays([pa.nulls(len(a), pa.int64()), pa.array(names, pa.int64())]),
    ]
    return pa.Table.from_arrays(columns, names=["a", "b", "list"])


def candidates(docs: DataFrame, repeated: Broadcast, store: Store, shingle: int = SHINGLE) -> DataFrame:
    """Written candidate pairs (a, b) of the short lists and members (a, list) of the long ones."""
    spark = docs.sparkSession
    buckets = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed = docs.select(whole("text").alias("text")).mapInArrow(
        _entries(repeated, buckets, shingle), "bucket int, shingles binary, nodes binary, sizes binary, positions binary"
    )
    return store.scratch(packed.groupBy("bucket").applyInArrow(_candidates, "a long, b long, list long"), "candidates")


class _Sets:
    """Sets of the texts met last."""

    def __init__(self, shingle: int, room: int = 128):
        self.shingle, self.room, self.held = shingle, room, OrderedDict()

    def of(self, node: int, text: str) -> np.ndarray:
        if node not in self.held:
            self.held[node] = arrays.shingle_sets(pa.array([text]), self.shingle)[0]
            if len(self.held) > self.room:
                self.held.popitem(last=False)
        self.held.move_to_end(node)
        return self.held[node]


def _linked(shingle: int):
    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = _Sets(shingle)
        for batch in batches:
            a, text_a, b, text_b = (batch.column(i).to_pylist() for i in range(4))
            keep = []
            for i in range(len(a)):
                x, y = sets.of(a[i], text_a[i]), sets.of(b[i], text_b[i])
                keep.append(arrays.intersection_size(x, y) >= required(len(x), len(y)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(pa.array(keep)), batch.column(2).filter(pa.array(keep))], names=["u", "v"]
            )

    return linked


def _differences(shingle: int):
    """Each member's set as its size and what it lacks of and has beyond the hub's."""

    def differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = _Sets(shingle)
        for batch in batches:
            hub, hub_text, node, text = (batch.column(i).to_pylist() for i in range(4))
            rows = []
            for i in range(len(hub)):
                h, x = sets.of(hub[i], hub_text[i]), sets.of(node[i], text[i])
                lacks, beyond = np.setdiff1d(h, x, True), np.setdiff1d(x, h, True)
                is_inner = len(x) - len(beyond) >= required(len(x), len(h))
                rows.append((hub[i], node[i], len(h), is_inner, lacks.tobytes(), beyond.tobytes()))
            columns = list(zip(*rows)) or [()] * 6
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=_MEMBER)

    return differences


_MEMBER = ["hub", "node", "hub_size", "is_inner", "lacks", "beyond"]


def _shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Matrix of intersection sizes of sorted arrays, by blocks of the values that both sides have."""
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    sides = []
    for side in (left, right):
        rows = np.repeat(np.arange(len(side)), [len(s) for s in side])
        sides.append((rows, np.concatenate(side) if side else np.zeros(0, dtype=np.uint64)))
    common = np.intersect1d(sides[0][1], sides[1][1])
    for start in range(0, len(common), 2048):
        values = common[start : start + 2048]
        dense = []
        for (rows, held), n in zip(sides, out.shape, strict=True):
            at = np.searchsorted(values, held)
            hit = values[np.minimum(at, len(values) - 1)] == held
            matrix = np.zeros((n, len(values)), dtype=np.float32)
            matrix[rows[hit], at[hit]] = 1
            dense.append(matrix)
        out += dense[0] @ dense[1].T
    return out


def _block_links(table: pa.Table) -> pa.Table:
    """Edges that connect what links between the two sides of a block of a hub's members."""
    rows = table.to_pylist()
    sides = [[r for r in rows if r["side"] == k] for k in (0, 1)]
    u, v = [], []
    if all(sides):
        lacks, beyond = ([[np.frombuffer(r[c], dtype=np.uint64) for r in s] for s in sides] for c in ("lacks", "beyond"))
        hub = rows[0]["hub_size"]
        without = [np.array([len(x) for x in s]) for s in lacks]
        more = [np.array([len(x) for x in s]) for s in beyond]
        size = [hub - w + m for w, m in zip(without, more, strict=True)]
        both = hub - without[0][:, None] - without[1][None, :] + _shared_counts(*lacks) + _shared_counts(*beyond)
        link = both >= required(size[0][:, None], size[1][None, :])
        label = [np.arange(len(sides[0])), len(sides[0]) + np.arange(len(sides[1]))]
        top = len(sides[0]) + len(sides[1])
        while True:  # each side takes the lowest label it links to
            low0 = np.minimum(label[0], np.where(link, label[1][None, :], top).min(axis=1))
            low1 = np.minimum(label[1], np.where(link, low0[:, None], top).min(axis=0))
            if (low0 == label[0]).all() and (low1 == label[1]).all():
                break
            label = [low0, low1]
        names = [r["node"] for r in sides[0] + sides[1]]
        for own, low in enumerate(np.concatenate(label).tolist()):
            if names[own] != names[low]:
                u.append(names[own])
                v.append(names[low])
    return pa.Table.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


def _hub_groups(members: DataFrame) -> DataFrame:
    """hub, node: each long list's members under its hub, the node that is in the most long lists."""
    degree = members.groupBy("node").agg(F.count("*").alias("degree"))
    ranked = members.join(degree, "node")
    hubs = ranked.groupBy("list").agg(F.max(F.struct("degree", "node")).alias("hub"))
    return members.join(hubs.select("list", F.col("hub.node").alias("hub")), "list").select("hub", "node").distinct()


def _hub_edges(described: DataFrame, store: Store) -> DataFrame:
    """Edges among the members of each hub: inner members link with it, the others are compared in blocks."""
    inner = described.filter("is_inner AND node != hub").select(F.col("hub").alias("u"), F.col("node").alias("v"))
    chunks = described.groupBy("hub").agg(
        F.ceil(F.count_if(~F.col("is_inner")) / _SIDE).alias("left_chunks"), F.ceil(F.count("*") / _SIDE).alias("right_chunks")
    )
    chunks = store.scratch(chunks.filter("left_chunks > 0"), "chunks")
    # written: both sides of the join are exchanges, so a hub with many members is split at run time
    dealt = described.join(chunks, "hub")
    deal = F.xxhash64("node")
    last = F.lit(1).cast("long")
    left = dealt.filter("NOT is_inner").select(
        *_MEMBER,
        F.lit(0).alias("side"),
        F.pmod(deal, F.col("left_chunks")).alias("i"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("right_chunks") - last)).alias("j"),
    )
    right = dealt.select(
        *_MEMBER,
        F.lit(1).alias("side"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("left_chunks") - last)).alias("i"),
        F.pmod(deal, F.col("right_chunks")).alias("j"),
    )
    blocks = left.unionByName(right).groupBy("hub", "i", "j").applyInArrow(_block_links, "u long, v long")
    return inner.unionByName(blocks)


def _texts_of(docs: DataFrame, wanted: DataFrame, store: Store) -> DataFrame:
    """node, text of the ``wanted`` (node, text_hash), one row each, written. Other texts are not shuffled."""
    rows = docs.select(whole("text").alias("text")).withColumn("text_hash", F.xxhash64("text"))
    rows = possible_members(rows, "text_hash", wanted.select("text_hash"))
    once = rows.groupBy("text_hash").agg(F.first("text").alias("text"))
    return store.scratch(once.join(wanted, "text_hash").select("node", "text"), "texts")


def linked_nodes(docs: DataFrame, digested: DataFrame, store: Store, shingle: int = SHINGLE) -> DataFrame:
    """Edges u, v between linked sets: all of them up to what connects the same nodes."""
    found = candidates(docs, repeated_shingles(digested), store, shingle)
    pairs = store.scratch(found.filter("list IS NULL").select("a", "b").distinct(), "pairs")
    members = store.scratch(found.filter("list IS NOT NULL").select(F.col("a").alias("node"), "list"), "members")
    groups = store.scratch(_hub_groups(members), "groups")

    names = pairs.select(F.explode(F.array("a", "b")).alias("node")).unionByName(groups.select("node")).distinct()
    nodes = digested.filter("node IS NOT NULL").groupBy("node").agg(F.min("text_hash").alias("text_hash"))
    texts = _texts_of(docs, store.scratch(nodes.join(names, "node"), "wanted"), store)

    def text_of(name: str) -> DataFrame:
        return texts.select(F.col("node").alias(name), F.col("text").alias(f"text_{name}"))

    verified = pairs.join(text_of("b"), "b").join(text_of("a"), "a").select("a", "text_a", "b", "text_b")
    verified = verified.mapInArrow(_linked(shingle), "u long, v long")
    described = groups.join(text_of("node"), "node").join(text_of("hub"), "hub").select("hub", "text_hub", "node", "text_node")
    kinds = "hub long, node long, hub_size long, is_inner boolean, lacks binary, beyond binary"
    described = store.scratch(described.mapInArrow(_differences(shingle), kinds), "described")
    return store.scratch(verified.unionByName(_hub_edges(described, store)), "links")


def near_duplicates(docs: DataFrame, store: Store, shingle: int = SHINGLE) -> DataFrame:
    r"""One row per row of ``docs``: doc_id, n_shingles, component_id.

    ``component_id`` is the smallest doc_id that can be reached by links, its own included. Words end at white space
    ``[\x20\x09-\x0D]``, and A-Z count as a-z. With fewer words than a shingle has, the whole sequence is the one
    shingle. A text that is null, empty or without words has an empty set and is linked with nothing. A null doc_id
    is never the smallest; a component of nothing else has the id null. Rows that repeat a doc_id are rows of their
    own. Other columns are not read, and an empty table gives an empty result.
    """
    digested = digests(docs, store, shingle)
    components = connected_components(linked_nodes(docs, digested, store, shingle), store)
    rows = digested.filter("bits IS NULL")
    nodes = rows.filter("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    nodes = store.scratch(nodes.join(components, "node", "left").withColumn("component", F.coalesce("component", "node")), "nodes")
    lowest = nodes.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    ids = store.scratch(nodes.join(lowest, "component").select("node", "component_id"), "ids")
    found = rows.filter("node IS NOT NULL").join(ids, "node").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    empty = rows.filter("node IS NULL").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return found.unionByName(empty)


def one_of_each(docs: DataFrame, store: Store, shingle: int = SHINGLE) -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the row that comes first by doc_id."""
    rows = numbered_rows(docs, store)
    order = F.struct(F.col("doc.doc_id").isNull(), "doc.doc_id", "row")
    named = rows.select(F.col("row").alias("doc_id"), "doc.text")
    found = store.scratch(near_duplicates(named, store, shingle).withColumnRenamed("doc_id", "row"), "found")
    ordered = found.join(rows.select("row", order.alias("order")), "row")
    best = ordered.groupBy("component_id").agg(F.min("order").alias("best")).select(F.col("best.row").alias("row"))
    return rows.join(best, "row", "left_semi").select("doc.*")
