"""Conversation prefix trie: what conversations share from their first turn on, as a z-fast trie.

A conversation is the sequence of digests of its prefixes, which roll on from turn to turn. The trie is compacted: a
node is a prefix at which conversations part or end, and it carries as its label the digests down from the node
above it, a node over (low, high]. Its handle is the digest at the two-fattest number of that range, the one
divisible by the largest power of two; handles are the keys of a hash table, here a table joined by them.

Conversations are inserted in batches. One that is still missing looks for the node at which it leaves the trie by fat
binary search over its length: as many joins with the handles as its length has bits, whatever the size of the trie. Where
several leave at the same place and go on alike, the one with the smallest conv_id goes in with all of its rest as
one label; the others follow with the next batch. Labels are split where conversations leave them. At the end every
label is expanded into the nodes of the plain trie.

Equal conversations are one sequence from the start. What many conversations share is one row of the trie, and sums over
subtrees go up by doubling: after k steps a node knows the 2^k levels below it. Texts are hashed where they are read
in order, in slices of a global order, so a conversation of any length is numbered and digested in parts. Its digests, 32 bytes
a turn, are one row later on.
"""

from __future__ import annotations

import hashlib
import operator
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.words import whole
from ledgerloom.operators.ordered import POS, SLICE
from ledgerloom.sources.store import Store

_SLICE_BITS = 33  # monotonically_increasing_id keeps the partition above these
_SEGMENT = 1 << 20  # bytes of conv_ids that go on as one row, about
_DIGEST = "d1 long, d2 long"
_ROLE_KEY, _TEXT_KEY = 16, 48  # characters of role and text that place a turn in a slice


# turns in order


def _sliced(df: DataFrame, by: list[Column], order: list[Column], keep: list[str], store: Store, name: str) -> DataFrame:
    """``df`` in a global order, written with each row's slice and place in it. ``by`` places rows and agrees with ``order``."""
    ranged = df.repartitionByRange(*by).sortWithinPartitions(*order)
    written = store.scratch(ranged.select(*keep, F.monotonically_increasing_id().alias("id")), name)
    place = F.col("id").bitwiseAND(F.lit((1 << _SLICE_BITS) - 1)) + 1
    return written.select(*keep, F.shiftright("id", _SLICE_BITS).cast("int").alias(SLICE), place.alias(POS))


def _running(sliced: DataFrame, values: dict[str, tuple], store: Store) -> DataFrame:
    """Running values of each conversation of a table sliced by conv_id.

    ``values`` has, per name, the aggregate of rows, the one of its values, and how two values join. A slice hands on
    the values of its last conversation; one row a slice is all that is broadcast.
    """
    within = Window.partitionBy(SLICE, "conv_id").orderBy(POS).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    kept = [c for c in sliced.columns if c not in values]
    rolled = store.scratch(sliced.select(*kept, *[of_rows.over(within).alias(n) for n, (of_rows, _, _) in values.items()]), "rolled")
    edges = rolled.groupBy(SLICE).agg(
        F.min("conv_id").alias("first"), F.max("conv_id").alias("last"), F.max_by(F.struct(*values), POS).alias("end")
    )
    # what the last conversation of a slice has come to over all the slices it runs through
    so_far = Window.partitionBy("last").orderBy(SLICE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.struct(*[of_values(F.col(f"end.{n}")).over(so_far).alias(n) for n, (_, of_values, _) in values.items()])
    edges = edges.withColumn("end", end)
    before = Window.orderBy(SLICE)
    edges = edges.select(F.col(SLICE).alias("at"), "first", F.lag("last").over(before).alias("last"), F.lag("end").over(before).alias("carried"))
    edges = edges.filter(F.col("first") == F.col("last")).select("at", "first", "carried")
    both = rolled.join(F.broadcast(edges), (F.col(SLICE) == F.col("at")) & (F.col("conv_id") == F.col("first")), "left")
    total = [
        F.when(F.col("carried").isNull(), F.col(n)).otherwise(join(F.col(f"carried.{n}"), F.col(n))).alias(n)
        for n, (_, _, join) in values.items()
    ]
    return both.select(*[c for c in kept if c not in (SLICE, POS)], *total)


def numbered_turns(turns: DataFrame, store: Store) -> DataFrame:
    """conv_id, place (from 1), t1, t2 (hashes of role and text) and n_chars of each turn.

    Turns are in the order of turn (null first), role, text; a null role or text is empty; equal rows are turns of
    their own. Rows without a conv_id belong to no conversation and are left out.
    """
    plain = turns.filter("conv_id IS NOT NULL").select("conv_id", "turn", whole("role").alias("role"), whole("text").alias("text"))
    plain = plain.withColumns(
        {f"t{i}": F.xxhash64(F.lit(i), "role", "text") for i in (1, 2)} | {"n_chars": F.length("text").cast("long")}
    )
    order = [F.col("conv_id").asc(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("text").asc()]
    # short keys that agree with the order: the bounds of the slices pass through the driver
    short = F.when(F.length("role") <= _ROLE_KEY, F.substring("text", 1, _TEXT_KEY))
    by = [*order[:2], F.substring("role", 1, _ROLE_KEY).asc(), short.asc_nulls_last()]
    sliced = _sliced(plain, by, order, ["conv_id", "t1", "t2", "n_chars"], store, "turns")
    return _running(sliced, {"place": (F.count(F.lit(1)), F.sum, operator.add)}, store)


def rebuilt(turns: DataFrame, store: Store) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations) in which each conversation begins like the first of its hundred.

    The first h turns of conversation c - c % 100, then the turns of c after its first h, for h = crc32(c) % 6.
    """
    numbered = store.scratch(numbered_turns(turns, store), "numbered")
    h = F.crc32(F.col("conv_id").cast("string")) % 6
    conversations = numbered.select("conv_id").distinct().withColumn("h", h)
    conversations = conversations.withColumn("base", F.col("conv_id") - F.col("conv_id") % 100)
    heads = numbered.filter((F.col("conv_id") % 100 == 0) & (F.col("place") <= 5))
    heads = heads.groupBy(F.col("conv_id").alias("base")).agg(F.collect_list(F.struct("place", "t1", "t2", "n_chars")).alias("head"))
    begins = F.filter(F.coalesce("head", F.array()), lambda t: t["place"] <= F.col("h"))
    conversations = store.scratch(conversations.join(heads, "base", "left").select("conv_id", begins.alias("head")), "conversations")
    borrowed = conversations.select("conv_id", F.explode("head").alias("t")).select("conv_id", "t.*")
    own = numbered.filter(F.col("place") > h).join(conversations, "conv_id")
    own = own.withColumn("place", F.col("place") - h + F.size("head")).select(*borrowed.columns)
    return borrowed.unionByName(own), conversations.select("conv_id")


def _digested(turns: DataFrame, store: Store) -> DataFrame:
    """conv_id, depth, d1, d2 (digests of the prefix that ends there), own (code points of the turn) and upto (of the prefix)."""
    keys = {f"d{i}": F.xxhash64(F.lit(i), "place", "t1", "t2") for i in (1, 2)}
    rows = turns.select("conv_id", F.col("place").cast("long").alias("depth"), F.col("n_chars").alias("own"), *[k.alias(n) for n, k in keys.items()])
    order = [F.col("conv_id").asc(), F.col("depth").asc()]
    sliced = _sliced(rows.withColumn("upto", F.col("own")), order, order, [*rows.columns, "upto"], store, "digests")
    mixed = {n: (F.bit_xor(n), F.bit_xor, Column.bitwiseXOR) for n in ("d1", "d2")}
    return _running(sliced, mixed | {"upto": (F.sum("upto"), F.sum, operator.add)}, store)


def _sequences(digests: DataFrame, conversations: DataFrame, store: Store) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(ends, distinct, sequences), written.

    ``ends`` has the digest of each whole conversation. Of the distinct ones: conv_id (the smallest), n (turns), m
    (conversations equal to it) and upto. ``sequences`` adds steps, the digests of the prefixes, for those with turns.
    """
    last = digests.groupBy("conv_id").agg(F.max(F.struct("depth", "d1", "d2", "upto")).alias("last"))
    ends = conversations.join(last, "conv_id", "left").select(
        "conv_id", *[F.coalesce(f"last.{c}", F.lit(0).cast("long")).alias(n) for c, n in (("depth", "n"), ("d1", "d1"), ("d2", "d2"), ("upto", "upto"))]
    )
    ends = store.scratch(ends, "ends")
    distinct = ends.groupBy("n", "d1", "d2").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("m"), F.max("upto").alias("upto"))
    distinct = store.scratch(distinct, "distinct")
    steps = digests.join(distinct.select("conv_id"), "conv_id", "left_semi").groupBy("conv_id")
    steps = steps.agg(F.sort_array(F.collect_list(F.struct("depth", "d1", "d2", "own", "upto"))).alias("steps"))
    return ends, distinct, store.scratch(distinct.join(steps, "conv_id").select("conv_id", "n", "steps"), "sequences")


# the trie


def two_fattest(low: Column, high: Column) -> Column:
    """The number in (low, high] that the largest power of two divides."""
    k = F.length(F.bin(low.bitwiseXOR(high))) - 1
    return F.call_function("shiftleft", F.call_function("shiftright", high, k), k)


def _high(node: Column) -> Column:
    return node["low"] + F.size(node["label"])


def _handles(trie: DataFrame) -> DataFrame:
    """The hash table of the trie: the digest at each node's handle."""
    node = F.struct("low", "label")
    at = F.col("label")[(two_fattest(F.col("low"), F.col("high")) - F.col("low") - 1).cast("int")]
    return trie.withColumn("high", _high(node)).select(at["d1"].alias("h1"), at["d2"].alias("h2"), node.alias("found"))


def _step(depth: Column) -> Column:
    """The digests of a conversation at a depth, null beyond its ends."""
    return F.get("steps", (depth - 1).cast("int"))


def _joined(state: DataFrame, key: Column, table: DataFrame, names: tuple[str, str]) -> DataFrame:
    """``state`` with ``found``: the row of ``table`` that has the digest ``key``. A null key finds nothing and is spread."""
    probing = state.withColumns({"k": key, "live": key.isNotNull()})
    probing = probing.withColumns(
        {"k1": F.coalesce("k.d1", F.xxhash64("conv_id")), "k2": F.coalesce("k.d2", F.col("conv_id"))}
    ).drop("k")
    met = (F.col("k1") == F.col(names[0])) & (F.col("k2") == F.col(names[1])) & F.col("live")
    return probing.join(table, met, "left").drop("k1", "k2", "live", *names)


def _located(missing: DataFrame, trie: DataFrame, bits: int) -> DataFrame:
    """The missing sequences with ``node``, at or under which each leaves the trie (null: at the root), and ``exit``, the depth.

    Fat binary search between ``lo`` and ``hi``, both the same for a number of probes that depends on the length only.
    """
    handles = _handles(trie)
    state = missing.withColumns({"lo": F.lit(0).cast("long"), "hi": F.col("n"), "node": F.lit(None).cast(handles.schema["found"].dataType)})
    for _ in range(bits):
        fat = F.when(F.col("lo") < F.col("hi"), two_fattest(F.col("lo"), F.col("hi")))
        state = _joined(state.withColumn("fat", fat), _step(F.col("fat")), handles, ("h1", "h2"))
        hit = F.col("found").isNotNull()
        state = state.withColumns(
            {
                "lo": F.when(hit, _high(F.col("found"))).otherwise(F.col("lo")),
                "hi": F.when(hit | F.col("fat").isNull(), F.col("hi")).otherwise(F.col("fat") - 1),
                "node": F.when(hit, F.col("found")).otherwise(F.col("node")),
            }
        ).drop("found", "fat")
    # the handle of the last node may lie beyond the exit: it is known by its first digest
    firsts = trie.select(F.col("label")[0]["d1"].alias("f1"), F.col("label")[0]["d2"].alias("f2"), F.struct("low", "label").alias("found"))
    below = F.coalesce(_high(F.col("node")), F.lit(0).cast("long")) + 1
    state = _joined(state, F.when(below <= F.col("n"), _step(below)), firsts, ("f1", "f2"))
    state = state.withColumn("node", F.coalesce("found", "node")).drop("found", "lo", "hi")
    # digests of prefixes: those that agree come first
    own = F.slice("steps", (F.col("node.low") + 1).cast("int"), F.size("node.label"))
    agree = F.zip_with(own, F.col("node.label"), lambda a, b: (a["d1"] == b["d1"]) & (a["d2"] == b["d2"]))
    met = F.col("node.low") + F.size(F.filter(agree, lambda x: x))
    return state.withColumn("exit", F.coalesce(met, F.lit(0).cast("long")))


def _digest(step: Column) -> Column:
    return F.struct(step["d1"].alias("d1"), step["d2"].alias("d2"))


def _end(label: Column) -> Column:
    return F.element_at(label, -1)


def _split(trie: DataFrame, located: DataFrame) -> DataFrame:
    """The trie with a node at every exit that lies inside a label."""
    inside = located.filter((F.col("exit") > F.col("node.low")) & (F.col("exit") < _high(F.col("node"))))
    end = _end(F.col("node.label"))
    cuts = inside.groupBy(end["d1"].alias("c1"), end["d2"].alias("c2")).agg(F.collect_set("exit").alias("cuts"))
    own = _end(F.col("label"))
    cut = trie.join(cuts, (own["d1"] == F.col("c1")) & (own["d2"] == F.col("c2")), "left")
    bounds = F.array_sort(F.concat(F.coalesce("cuts", F.array()), F.array("low", _high(F.struct("low", "label")))))
    cut = cut.withColumn("bounds", bounds)

    def part(i: Column) -> Column:
        start, stop = F.get("bounds", i), F.get("bounds", i + 1)
        label = F.slice("label", (start - F.col("low") + 1).cast("int"), (stop - start).cast("int"))
        above = F.when(i == 0, F.col("above")).otherwise(_digest(F.get("label", (start - F.col("low") - 1).cast("int"))))
        return F.struct(start.alias("low"), label.alias("label"), above.alias("above"))

    parts = F.transform(F.sequence(F.lit(0), F.size("bounds") - 2), part)
    return cut.select(F.explode(parts).alias("part")).select("part.*")


def _leaves(located: DataFrame) -> DataFrame:
    """conv_id and node of one conversation for each way on from an exit."""
    going_on = located.filter(F.col("n") > F.col("exit"))
    after = _step(F.col("exit") + 1)
    at = _step(F.col("exit"))
    zero = F.lit(0).cast("long")
    node = F.struct(
        "conv_id",
        F.col("exit").alias("low"),
        F.slice("steps", (F.col("exit") + 1).cast("int"), (F.col("n") - F.col("exit")).cast("int")).alias("label"),
        F.struct(F.coalesce(at["d1"], zero).alias("d1"), F.coalesce(at["d2"], zero).alias("d2")).alias("above"),
    )
    return going_on.groupBy(after["d1"].alias("g1"), after["d2"].alias("g2")).agg(F.min_by(node, "conv_id").alias("leaf")).select("leaf.*")


def compacted_trie(sequences: DataFrame, store: Store) -> DataFrame:
    """low, label (digests from low + 1 on) and above (the digest at low) of each node but the root. Written.

    ``sequences`` has conv_id, n and steps (depth, d1, d2, own, upto, from depth 1 on) of each distinct sequence.
    """
    missing = sequences
    bits = int(missing.agg(F.max("n")).first()[0] or 0).bit_length()
    trie = None
    while True:
        if trie is None:
            kind = sequences.schema["steps"].dataType.simpleString()
            located = missing.withColumns({"node": F.lit(None).cast(f"struct<low:bigint,label:{kind}>"), "exit": F.lit(0).cast("long")})
        else:
            located = store.scratch(_located(missing, trie, bits), "located")
        leaves = store.scratch(_leaves(located), "leaves")
        grown = leaves.drop("conv_id")
        trie = store.scratch(grown if trie is None else _split(trie, located).unionByName(grown), "trie")
        missing = located.filter(F.col("n") > F.col("exit")).join(leaves.select("conv_id"), "conv_id", "left_anti")
        missing = store.scratch(missing.select(*sequences.columns), "missing")
        if missing.isEmpty():
            return trie


# sums over subtrees

_SUMS = ("n_convs", "n_leaves", "weighed", "chars")


def _added_up(nodes: DataFrame, store: Store) -> DataFrame:
    """``nodes`` (key, above and values of their own) with the values of their subtrees: sums, and the smallest conv_id."""
    state = store.scratch(nodes.withColumn("up", F.col("above")), "subtrees")
    while not state.filter("up IS NOT NULL").isEmpty():
        lower = state.filter("up IS NOT NULL")
        added = lower.groupBy(F.col("up").alias("key")).agg(
            F.min("conv_id").alias("least"), *[F.sum(c).alias(f"more_{c}") for c in _SUMS]
        )
        # the root has nothing above it; all others look up what is twice as far
        jumps = state.filter("up IS NOT NULL").select(F.col("key").alias("_at"), F.col("up").alias("_further"))
        state = state.join(added, "key", "left").join(jumps, F.col("up") == F.col("_at"), "left")
        state = store.scratch(
            state.select(
                "key",
                "above",
                F.least("conv_id", "least").alias("conv_id"),
                *[(F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c) for c in _SUMS],
                F.col("_further").alias("up"),
            ),
            "subtrees",
        )
    return state.drop("up")


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows in the order of (d1, d2, conv_id): the decimal conv_ids of each digest, comma-joined, in segments."""
    ids: list[str] = []
    size, current = 0, None

    def passed_on() -> pa.RecordBatch:
        columns = [pa.array([v], pa.int64()) for v in (*current, int(ids[0]))] + [pa.array([",".join(ids)], pa.string())]
        return pa.RecordBatch.from_arrays(columns, names=["d1", "d2", "first", "ids"])

    for batch in batches:
        for d1, d2, conv_id in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if ids and ((d1, d2) != current or size > _SEGMENT):
                yield passed_on()
                ids, size = [], 0
            current = (d1, d2)
            ids.append(str(conv_id))
            size += len(ids[-1]) + 1
    if ids:
        yield passed_on()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of segments in order: the SHA-256 of each digest's whole list, which streams through."""
    state, current = None, None

    def told() -> pa.RecordBatch:
        columns = [pa.array([v], pa.int64()) for v in current] + [pa.array([state.hexdigest()], pa.string())]
        return pa.RecordBatch.from_arrays(columns, names=["d1", "d2", "ends_sha256"])

    for batch in batches:
        for d1, d2, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (d1, d2) == current:
                state.update(b",")
            else:
                if current is not None:
                    yield told()
                state, current = hashlib.sha256(), (d1, d2)
            state.update(ids.encode())
    if current is not None:
        yield told()


def _end_lists(ends: DataFrame) -> DataFrame:
    """The SHA-256 of the conv_ids that end at each digest. A long list is laid out by all tasks and hashed as a stream."""
    order = ("d1", "d2", "conv_id")
    laid = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    segments = laid.mapInArrow(_listed, f"{_DIGEST}, first long, ids string")
    return segments.repartition("d1", "d2").sortWithinPartitions("d1", "d2", "first").mapInArrow(_hashed, f"{_DIGEST}, ends_sha256 string")


def prefix_trie(turns: DataFrame, conversations: DataFrame, store: Store) -> DataFrame:
    """One row per node of the plain trie: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``turns`` has conv_id, place (from 1, without holes), t1, t2 and n_chars, as ``numbered_turns`` gives them;
    ``conversations`` the conv_id of each conversation once, those without turns too. Digests are two 64-bit hashes. Without
    conversations there is no node, not even the root.
    """
    digests = store.scratch(_digested(turns, store), "prefixes")
    ends, distinct, sequences = _sequences(digests, conversations, store)
    trie = compacted_trie(sequences, store)
    zero = F.lit(0).cast("long")
    before = F.col("label")[0]["upto"] - F.col("label")[0]["own"]  # code points above a label
    labels = trie.select(_digest(_end(F.col("label"))).alias("key"), "above", "label", before.alias("before"))
    edges = labels.select("key", "above", (_end(F.col("label"))["upto"] - F.col("before")).alias("chars"))
    nowhere = F.lit(None).cast(edges.schema["above"].dataType)
    root = ends.limit(1).select(F.struct(zero.alias("d1"), zero.alias("d2")).alias("key"), nowhere.alias("above"), zero.alias("chars"))
    children = trie.groupBy(F.col("above").alias("key")).agg(F.count("*").alias("n_children"))
    members = distinct.select(F.struct("d1", "d2").alias("key"), "conv_id", "m", "upto")
    nodes = edges.unionByName(root).join(children, "key", "left").join(members, "key", "left")
    nodes = nodes.select(
        "key",
        "above",
        "chars",
        "conv_id",
        F.coalesce("n_children", zero).alias("n_children"),
        F.coalesce("m", zero).alias("n_convs"),
        F.col("n_children").isNull().cast("long").alias("n_leaves"),
        F.coalesce(F.col("m") * F.col("upto"), zero).alias("weighed"),
    )
    nodes = store.scratch(nodes, "nodes")
    sums = _added_up(nodes.drop("n_children"), store)
    above = sums.select(F.col("key").alias("above"), F.col("conv_id").alias("above_conv_id"))
    hashes = _end_lists(ends).select(F.struct("d1", "d2").alias("key"), "ends_sha256")
    known = sums.join(nodes.select("key", "n_children"), "key").join(labels.drop("above"), "key", "left")
    known = known.join(hashes, "key", "left").join(above, "above", "left")

    # labels are expanded; the root has none and is one node
    top = F.array(F.lit(None).cast(trie.schema["label"].dataType.elementType))
    nodes = known.select("*", F.posexplode(F.coalesce("label", top)).alias("i", "step"))
    is_last = F.col("label").isNull() | (F.col("i") == F.size("label") - 1)
    subtree = F.col("weighed") - F.col("n_convs") * F.coalesce("before", zero) - F.col("chars")
    passed = F.coalesce(F.col("step.upto") - F.col("step.own") - F.col("before"), zero)
    return nodes.select(
        "conv_id",
        F.coalesce("step.depth", zero).alias("depth"),
        F.when(F.col("i") == 0, F.col("above_conv_id")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        "n_convs",
        F.when(is_last, F.col("n_children")).otherwise(F.lit(1).cast("long")).alias("n_children"),
        "n_leaves",
        (subtree - (F.col("n_convs") - 1) * passed).alias("saved_tokens"),
        F.coalesce(F.when(is_last, F.col("ends_sha256")), F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
