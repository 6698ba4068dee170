import hashlib
import re

from ledgerloom.llm.exact_dedup import exact_duplicates, kept_rows


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(norm(r[1]), []).append(r)
    out = []
    for text, members in groups.items():
        best = min(members, key=lambda r: (-len(r[1] or ""), r[0] is not None, r[0] or 0))
        digest = hashlib.sha256(text.encode()).hexdigest()
        out += [(r[0], best[0], len(members), r is best, digest) for r in members]
    return out


def result(df):
    rows = df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    return sorted(map(tuple, rows), key=repr)


ROWS = [
    (1, "a b c"),
    (2, "a  b\tc"),
    (3, "abc"),
    (4, "x y"),
    (5, None),
    (6, ""),
    (7, " \n"),
    (8, "é\x0b\x0c\r è "),
    (9, "éè "),
    (10, "w " * 30000),
    (11, "w  " * 30000),
    (None, "x  y"),
    (12, "Abc"),
]


def test_groups_like_brute_force(spark, store, make_docs, clashing):
    assert result(exact_duplicates(clashing(make_docs(ROWS)), store)) == sorted(brute(ROWS), key=repr)


def test_many_groups_and_a_hot_one(spark, store, make_docs):
    rows = [(i, f"t{i % 700} " + " " * (i % 3)) for i in range(2000)] + [(5000 + i, "hot") for i in range(1000)]
    assert result(exact_duplicates(make_docs(rows), store)) == sorted(brute(rows), key=repr)


def test_saturated_filter_gives_the_same(spark, store, make_docs):
    rows = [(i, f"t{i % 3000}") for i in range(4000)]
    assert result(exact_duplicates(make_docs(rows), store, max_bits=1 << 15)) == sorted(brute(rows), key=repr)


def test_repeated_rows_keep_one(spark, store, make_docs):
    rows = [(1, "a"), (1, "a"), (1, "b"), (2, "a")]
    got = result(exact_duplicates(make_docs(rows), store))
    assert sorted((r[0], r[3]) for r in got) == [(1, False), (1, True), (1, True), (2, False)]
    left = kept_rows(make_docs(rows), store).collect()
    assert sorted((r.doc_id, r.text) for r in left) == [(1, "a"), (1, "b")]


def test_kept_rows_match_and_keep_columns(spark, store, make_docs, clashing):
    docs = clashing(make_docs(ROWS))
    left = kept_rows(docs, store)
    assert left.columns == docs.columns
    assert sorted((r.doc_id for r in left.collect()), key=repr) == sorted((b[0] for b in brute(ROWS) if b[3]), key=repr)


def test_empty_table(spark, store, make_docs):
    empty = make_docs(ROWS).filter("doc_id < 0")
    assert exact_duplicates(empty, store).count() == 0
    assert kept_rows(empty, store).count() == 0


def test_only_possibly_repeated_rows_are_grouped(spark, store, make_docs):
    from ledgerloom.llm.exact_dedup import possibly_repeated

    rows = [(i, f"unique text {i}") for i in range(3000)] + [(9000 + i, "copy") for i in range(5)]
    from pyspark.sql import functions as F

    digests = make_docs(rows).select("doc_id", F.sha2("text", 256).alias("d"))
    marked = possibly_repeated(digests, "d", "again").filter("again")
    ids = {r.doc_id for r in marked.collect()}
    assert set(range(9000, 9005)) <= ids
    assert len(ids) < 0.05 * len(rows)
