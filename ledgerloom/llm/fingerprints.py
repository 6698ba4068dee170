"""Document fingerprints: bottom-k sketches of word shingle hashes.

A sketch is the sorted array of the ``k`` smallest distinct 64-bit hashes of a text's five-word shingles (a
shorter text has one, of all its words). Sketches of parts merge into the sketch of the whole, and two sketches
estimate resemblance, containment and the number of distinct shingles. Sketches with fewer than ``k`` hashes
hold the whole set and give exact answers. Texts that are equal have equal sketches; a null text is empty and
has an empty sketch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.words import let, whole, word_list

K = 128
SHINGLE = 5
_SPAN = float(1 << 64)


def sketch(text: Column, k: int = K, shingle: int = SHINGLE) -> Column:
    """Sorted array of the k smallest distinct shingle hashes."""

    def shingles(words: Column) -> Column:
        several = F.transform(
            F.sequence(F.lit(1), F.size(words) - (shingle - 1)),
            lambda i: F.xxhash64(*[F.element_at(words, i + j) for j in range(shingle)]),
        )
        return (
            F.when(F.size(words) >= shingle, several)
            .when(F.size(words) > 0, F.array(F.xxhash64(words)))
            .otherwise(F.array().cast("array<bigint>"))
        )

    hashes = let(F.transform(word_list(text), lambda w: F.xxhash64(w)), shingles)
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of both parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_groups(sketches: DataFrame, key: str, column: str, k: int = K) -> DataFrame:
    """One sketch per key from the sketches of its parts. Each task passes on k hashes of a key at most."""
    hashes = sketches.select(key, F.explode(column).alias("_hash")).distinct()
    smallest = Window.partitionBy(key).orderBy("_hash")
    kept = hashes.withColumn("_n", F.row_number().over(smallest)).filter(F.col("_n") <= k)
    return kept.groupBy(key).agg(F.sort_array(F.collect_list("_hash")).alias(column))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated size of the intersection by the size of the union; 1 for two empty sketches."""

    def share(union: Column) -> Column:
        both = F.size(F.array_intersect(union, F.array_intersect(a, b)))
        return F.when(F.size(union) == 0, 1.0).otherwise(both / F.size(union))

    complete = (F.size(a) < k) & (F.size(b) < k)
    union = F.array_union(a, b)
    return let(F.when(complete, union).otherwise(F.slice(F.sort_array(union), 1, k)), share)


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles: exact below k."""
    largest = (F.element_at(a, -1).cast("double") + _SPAN / 2) / _SPAN
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / largest)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has too; 1 if a has none."""
    union = distinct_shingles(merged(a, b, k), k)
    share = resemblance(a, b, k) * union / distinct_shingles(a, k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(share, F.lit(1.0)))


def as_text(a: Column) -> Column:
    """The sketch as base64 of its hashes, eight bytes each; empty for an empty sketch."""
    return F.base64(F.unhex(F.array_join(F.transform(a, lambda h: F.lpad(F.hex(h), 16, "0")), "")))


def _slices(docs: DataFrame, doc_id: str, n: int) -> Column:
    """Number of the doc_id range a row is in, of about n even ones. The bounds are n numbers."""
    cuts = docs.agg(F.percentile_approx(doc_id, [i / n for i in range(1, n)], 10_000).alias("c")).first()["c"] or []
    cuts = sorted(set(cuts))
    if not cuts:
        return F.lit(0)
    bounds = F.array(*[F.lit(c) for c in cuts])
    steps = F.array(*[F.lit(1 << s) for s in reversed(range(len(cuts).bit_length()))])

    def search(low: Column, step: Column) -> Column:
        fits = (low + step <= len(cuts)) & (F.try_element_at(bounds, low + step) < F.col(doc_id))
        return F.when(fits, low + step).otherwise(low)

    return F.aggregate(steps, F.lit(0), search)


def with_next(docs: DataFrame, slices: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text and slice order of every row, the following rows of ``lead`` within reach.

    Rows are ordered by descending doc_id (null last), then by a hash of the text. Each slice of that order
    also gets a copy of the row that follows it (``_ghost``), the lowest slice the first row of all. So a window
    per slice sees the next row of each of its own, and the texts are shuffled once.
    """
    body = docs.select(F.col(doc_id).alias("doc_id"), whole(text).alias("text"))
    body = body.withColumn("_slice", _slices(body, "doc_id", slices)).withColumn("_tie", F.xxhash64("text"))
    edges = body.groupBy("_slice").agg(F.max("doc_id").alias("_first"))
    # one row per slice
    order, every = Window.orderBy("_slice"), Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    follows = edges.select("_first", F.coalesce(F.lead("_slice").over(order), F.min("_slice").over(every)).alias("_to"))
    ghosts = body.join(F.broadcast(follows), F.col("doc_id").eqNullSafe(F.col("_first")))
    ghosts = ghosts.select("doc_id", "text", F.col("_to").alias("_slice"), "_tie", F.lit(True).alias("_ghost"))
    return body.withColumn("_ghost", F.lit(False)).unionByName(ghosts)


def fingerprints(docs: DataFrame, k: int = K, slices: int | None = None) -> DataFrame:
    """One row per row of ``docs``: its fingerprint, that of its edited text, and how alike they are.

    In the edited text the last third of the code points (rounded down) is replaced by the first as many, or all,
    of the next document by descending doc_id; the first document follows the last. Returns doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_shingles (estimated).

    A null text is empty: its fingerprint is empty, and it is like another empty one (1) and unlike any other (0).
    Rows of equal doc_id follow each other in the order of a hash of their texts; a null doc_id is the last. A
    single row is its own next. Other columns are not read; an empty table gives an empty result.
    """
    slices = slices or 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = with_next(docs, slices)
    order = Window.partitionBy("_slice").orderBy("_ghost", F.desc_nulls_last("doc_id"), "_tie")
    n_chars, cut = F.char_length("text"), F.floor(F.char_length("text") / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n_chars - cut), F.substring("_next", F.lit(1), cut))
    rows = rows.withColumn("_next", F.coalesce(F.lead("text").over(order), F.lit("")))
    rows = rows.select(
        "doc_id", "_slice", "_ghost", "_tie",
        n_chars.cast("long").alias("n_chars"),
        sketch(F.col("text"), k).alias("_own"),
        F.when(~F.col("_ghost"), edited).alias("_edited"),
    )
    rows = rows.select(
        "doc_id", "_slice", "_ghost", "_tie", "n_chars", "_own",
        F.sha2("_edited", 256).alias("edited_sha256"),
        F.when(~F.col("_ghost"), sketch(F.col("_edited"), k)).alias("_changed"),
    )
    rows = rows.withColumn("_following", F.lead("_own").over(order)).filter(~F.col("_ghost"))
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("_own")).alias("fingerprint"),
        as_text(F.col("_changed")).alias("edited_fingerprint"),
        resemblance(F.col("_own"), F.col("_changed"), k).alias("near_edited"),
        resemblance(F.col("_own"), F.col("_following"), k).alias("near_next"),
        distinct_shingles(F.col("_own"), k).alias("n_shingles"),
    )
