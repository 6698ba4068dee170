"""Mixing sources to target weights by pivotal dependent rounding.

A source's words are to be taken ``rate = target / words`` times. Every document is taken ``floor(rate)``
times and once more with the fraction as its probability. The rounding is dependent: two documents of a
source with fractional probabilities are paired and words move from one to the other, at random in which
direction, until one probability is 0 or 1. Expected copies stay what they were and the words taken stay
exactly on target, until one fractional document is left.

Pairing runs among documents of one size class (a power of two) in blocks of about ``block`` documents, a
fold over one bounded array, and each block passes one fractional document on. These are blocked again,
level by level, until a class of a source has one block: a reduction tree, so a source with a third of all
rows is as many tasks as it needs. A source is then left with at most one fractional document per size
class. They are rounded from the largest to the smallest, each to the side from which the smaller ones can best make
up for it, so what is missed is about half a document of the smallest class.

Randomness is a hash of the paired documents, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField

from ledgerloom.llm.words import let, numbered_rows, whole, word_count
from ledgerloom.operators.ordered import POS, SLICE, lay_out, place
from ledgerloom.sources.store import Store

WEIGHTS = (5, 2, 1)
MOST = 3  # times its own size, for a source and so for a document
BLOCK = 64
_NEAR = 1e-9


def _running(laid: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add the sum of each column over all rows before this one as ``<column>_before``, and in all as ``<column>_all``."""
    earlier = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    slices = laid.groupBy(SLICE).agg(*[F.sum(c).alias(c) for c in columns])
    slices = slices.select(
        SLICE,
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_{c}") for c in columns],
        *[F.sum(c).over(every).alias(f"{c}_all") for c in columns],
    )
    within = Window.partitionBy(SLICE).orderBy(POS).rowsBetween(Window.unboundedPreceding, -1)
    out = laid.join(F.broadcast(slices), SLICE)
    for c in columns:
        out = out.withColumn(f"{c}_before", F.col(f"_{c}") + F.coalesce(F.sum(c).over(within), F.lit(0)))
    return out.drop(*[f"_{c}" for c in columns])


def source_targets(
    sizes: DataFrame, store: Store, weights: Sequence[int] = WEIGHTS, most: int = MOST
) -> DataFrame:
    """A row per source: source, source_size, target.

    ``weights`` repeat over the sources by code point, null last, and share the words of all sources. A
    target ends at ``most`` times the words of its source; what is over goes to the others by weight, until
    none is above. That is: the target is the smaller of cap and weight times one level. In the order of
    cap to weight, a source is at its cap when the level of it and all later ones reaches it.
    """
    stats = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = place(lay_out(stats, [F.col("source").asc_nulls_last()], store, "sources"), "_n", "_total").drop(SLICE, POS)
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), ((F.col("_n") - 1) % len(weights) + 1).cast("int"))
    capped = by_name.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most)
    order = [(F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last()]
    filled = _running(lay_out(capped, order, store, "caps"), ["source_size", "weight", "cap"])
    level = (F.col("source_size_all") - F.col("cap_before")) / (F.col("weight_all") - F.col("weight_before"))
    at_cap = level >= F.col("cap") / F.col("weight")
    filled = store.scratch(filled.withColumn("at_cap", at_cap), "levels")
    below = F.when(~F.col("at_cap"), F.col("weight"))
    words = F.sum("source_size") - F.sum(F.when(F.col("at_cap"), F.col("cap")).otherwise(0))
    level = filled.agg((words / F.sum(below)).alias("level")).first()["level"]  # one number
    target = F.when(F.col("at_cap"), F.col("cap")).otherwise(F.lit(level or 0.0) * F.col("weight"))
    return filled.select("source", "source_size", target.cast("double").alias("target"))


def _unit(*parts: Column | str) -> Column:
    """A number from 0 up to 1 by hash."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") / F.lit(float(1 << 53))


def _meet(a: Column, b: Column, level: int) -> Column:
    """Pair two fractional documents: move words until one is whole. An array of both with their new ``x``."""
    up_a = F.least((1 - a["x"]) * a["size"], b["x"] * b["size"])  # words that can move from b to a
    up_b = F.least(a["x"] * a["size"], (1 - b["x"]) * b["size"])
    chance = _unit(F.lit(level), a["doc_id"], a["key"], b["doc_id"], b["key"])

    def moved(m: Column) -> Column:
        words = F.when(m["u"] * (m["up_a"] + m["up_b"]) < m["up_b"], m["up_a"]).otherwise(-m["up_b"])
        return let(
            words, lambda w: F.array(_with_x(a, a["x"] + w / a["size"]), _with_x(b, b["x"] - w / b["size"]))
        )

    return let(F.struct(up_a.alias("up_a"), up_b.alias("up_b"), chance.alias("u")), moved)


def _with_x(doc: Column, x: Column) -> Column:
    """The document with another probability, which is 0 or 1 when it is within rounding of it."""
    exact = let(x, lambda v: F.when(v < _NEAR, 0.0).when(v > 1 - _NEAR, 1.0).otherwise(v))
    return F.struct(*[doc[c].alias(c) for c in ("doc_id", "key", "size", "base")], exact.alias("x"))


_DOC = "struct<doc_id: {id}, key: bigint, size: bigint, base: bigint, x: double>"


def _fold(docs: Column, level: int, id_type: str) -> Column:
    """Pair the documents of an array one after the other: those that became whole, and the last fractional."""
    doc = _DOC.format(id=id_type)
    start = F.lit(None).cast(f"struct<open: {doc}, whole: array<{doc}>>")
    start = F.struct(start["open"].alias("open"), F.array().cast(f"array<{doc}>").alias("whole"))

    def is_open(d: Column) -> Column:
        return (d["x"] > 0) & (d["x"] < 1)

    def step(state: Column, d: Column) -> Column:
        both = F.when(state["open"].isNull(), F.array(d)).otherwise(_meet(state["open"], d, level))
        return let(
            both,
            lambda pair: F.struct(
                F.get(F.filter(pair, is_open), F.lit(0)).alias("open"),
                F.concat(state["whole"], F.filter(pair, lambda p: ~is_open(p))).alias("whole"),
            ),
        )

    return F.aggregate(docs, start, step)


def mix(sizes: DataFrame, targets: DataFrame, store: Store, block: int = BLOCK) -> DataFrame:
    """Copies of every row of ``sizes`` (doc_id, key, source, size) by the ``targets`` of its source.

    Returns doc_id, key, source, size, copies. ``key`` tells rows of equal doc_id apart. Rows without words are
    rounded alone, as they take nothing from the target. A null source is a source.
    """
    id_type = sizes.schema["doc_id"].dataType.simpleString()
    classed = sizes.withColumn("cls", F.when(F.col("size") > 0, F.floor(F.log2("size"))).otherwise(-1).cast("int"))
    counts = store.scratch(classed.groupBy("source", "cls").agg(F.count("*").alias("n")), "classes")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(1.0)
    t = targets.select(F.col("source").alias("_source"), rate.alias("_rate"))
    t = counts.join(t, F.col("source").eqNullSafe(F.col("_source"))).select(
        "_source", "_rate", "n", F.col("cls").alias("_cls")
    )
    rated = classed.join(t, F.col("source").eqNullSafe(F.col("_source")) & (F.col("cls") == F.col("_cls")))
    base = F.floor("_rate").cast("long")
    rated = rated.drop("_source", "_cls").withColumn("base", base).withColumn("x", F.col("_rate") - base)
    alone = (F.col("size") == 0) | (F.col("x") < _NEAR) | (F.col("x") > 1 - _NEAR)
    rated = store.scratch(rated.withColumn("alone", alone), "rated")

    copies_alone = F.col("base") + F.when(_unit(F.lit("alone"), "doc_id", "key") < F.col("x"), 1).otherwise(0)
    done = [rated.filter("alone").select("doc_id", "key", "source", "size", copies_alone.cast("long").alias("copies"))]

    def add(d: DataFrame) -> None:
        """Documents whose copies are whole now, one per row in ``d``."""
        copies = F.col("d.base") + F.col("d.x").cast("long")
        done.append(d.select("d.doc_id", "d.key", "source", "d.size", copies.alias("copies")))

    open_docs = rated.filter("NOT alone").select(
        "source",
        "cls",
        F.ceil(F.col("n") / block).alias("blocks"),
        F.struct("doc_id", "key", "size", "base", "x").alias("doc"),
    )
    open_docs = open_docs.withColumn("block", F.pmod(F.xxhash64(F.lit(0), "doc.doc_id", "doc.key"), "blocks"))
    left = -(-(counts.agg(F.max("n").alias("n")).first()["n"] or 0) // block)
    level = 0
    while True:
        # an array holds about ``block`` documents, whatever the size of the source
        folded = open_docs.groupBy("source", "cls", "block", "blocks").agg(
            _fold(F.sort_array(F.collect_list("doc")), level, id_type).alias("state")
        )
        folded = store.scratch(folded, f"level{level}")
        add(folded.select("source", F.explode("state.whole").alias("d")))
        open_docs = folded.filter("state.open IS NOT NULL").select(
            "source", "cls", F.ceil(F.col("blocks") / block).alias("blocks"), "block", F.col("state.open").alias("doc")
        )
        if left <= 1:
            break
        level, left = level + 1, -(-left // block)
        open_docs = open_docs.withColumn("block", F.pmod(F.xxhash64(F.lit(level), "block"), "blocks"))
    # one document per size class: 64 at most
    last = open_docs.groupBy("source").agg(_round_together(F.collect_list("doc"), id_type).alias("docs"))
    add(last.select("source", F.explode("docs").alias("d")))
    return reduce(DataFrame.unionByName, done)


def _round_together(docs: Column, id_type: str) -> Column:
    """Round documents from the largest on, each to the side from which the later ones can best make up for it."""
    doc = _DOC.format(id=id_type)
    largest_first = F.sort_array(F.transform(docs, lambda d: F.struct(d["size"].alias("size"), d.alias("doc"))), asc=False)

    def words(x) -> Column:
        return F.aggregate(docs, F.lit(0.0), lambda total, d: total + x(d) * d["size"])

    start = F.struct(
        F.lit(0.0).alias("over"),
        words(lambda d: 1 - d["x"]).alias("up"),  # what the documents still to come can add
        words(lambda d: d["x"]).alias("down"),
        F.array().cast(f"array<{doc}>").alias("docs"),
    )

    def step(state: Column, item: Column) -> Column:
        d = item["doc"]
        rise, fall = (1 - d["x"]) * d["size"], d["x"] * d["size"]
        up, down = state["up"] - rise, state["down"] - fall

        def side(over: Column, x: float) -> Column:
            missed = F.greatest(F.lit(0.0), over - down, -over - up)
            return F.struct(missed.alias("missed"), F.abs(over).alias("far"), over.alias("over"), F.lit(x).alias("x"))

        better = F.least(side(state["over"] + rise, 1.0), side(state["over"] - fall, 0.0))
        return let(
            better,
            lambda b: F.struct(
                b["over"].alias("over"),
                up.alias("up"),
                down.alias("down"),
                F.concat(state["docs"], F.array(_with_x(d, b["x"]))).alias("docs"),
            ),
        )

    return F.aggregate(largest_first, start, step, lambda state: state["docs"])


def sized(docs: DataFrame, store: Store) -> DataFrame:
    """doc_id, key, source, size (words) of every row, written."""
    rows = docs.select("doc_id", "source", word_count(whole("text")).alias("size"), F.xxhash64(whole("text")).alias("key"))
    return store.scratch(rows, "sizes")


def mixture(docs: DataFrame, store: Store, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, copies, taken.

    A null text has no words, a null source is a source of its own, the last. Sources without words have the
    target 0. Rows of equal doc_id and text are taken apart or together alike: each is a row. Other columns are
    not read; an empty table gives an empty result.
    """
    return _mixture(sized(docs, store), store, weights, most)


def _mixture(sizes: DataFrame, store: Store, weights: Sequence[int], most: int) -> DataFrame:
    targets = store.scratch(source_targets(sizes, store, weights, most), "targets")
    t = targets.select(F.col("source").alias("_source"), "source_size", "target")
    out = mix(sizes, targets, store).join(t, F.col("source").eqNullSafe(F.col("_source")))
    return out.select(
        "doc_id", "key", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def mixed_rows(docs: DataFrame, store: Store, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with all their columns.

    The draws know a row by its place in the order of hashes of whole rows, so they do not depend on how the rows lie in
    files and partitions. Rows that are equal in every column share a hash and change places freely.
    """
    rows = numbered_rows(docs, store)
    sizes = rows.select(
        "row",
        F.col("doc.source").alias("source"),
        word_count(whole("doc.text")).alias("size"),
        F.xxhash64(*_content(docs)).alias("key"),
        F.hash(*_content(docs)).alias("_check"),
    )
    laid = lay_out(sizes, [F.col(c) for c in ("key", "_check", "row")], store, "names")
    named = store.scratch(place(laid, "doc_id", "_total").select("doc_id", "row", "key", "source", "size"), "named")
    copies = _mixture(named.drop("row"), store, weights, most)
    taken = copies.filter("copies > 0").join(named.select("doc_id", "row"), "doc_id")
    taken = taken.select("row", F.sequence(F.lit(1), F.col("copies").cast("int")).alias("times"))
    return rows.join(taken, "row").select("doc", F.explode("times")).select("doc.*")


def _content(docs: DataFrame) -> list[Column]:
    """What a hash of a whole row of ``doc`` reads: every column, and which are null. Maps have no hash; their JSON has."""

    def value(field: StructField) -> Column:
        column = F.col("doc").getField(field.name)
        return F.to_json(F.struct(column)) if "map<" in field.dataType.simpleString() else column

    return [part for field in docs.schema for part in (value(field), F.col("doc").getField(field.name).isNull())]
