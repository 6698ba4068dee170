"""The queries of the text operators over a folder of benchmark tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (
    bpe,
    chat,
    exact_dedup,
    fingerprints,
    language_id,
    lm_score,
    mixing,
    ngram_join,
    prefix_trie,
    ranked_search,
    suffix_dedup,
    token_counts,
    toxicity,
)
from ledgerloom.llm.deploy import deployed
from ledgerloom.sources.store import Store

Query = Callable[[SparkSession, str], DataFrame]

CONTEXT_TOKENS = 512


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return deployed(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = (_table(spark, sf_dir, name) for name in ("documents", "labels"))
    return toxicity.scored_documents(documents, labels, Store.for_session(spark))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(_table(spark, sf_dir, "documents"), Store.for_session(spark))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.without_repeats(_table(spark, sf_dir, "documents"), Store.for_session(spark))
    return out.select(
        "doc_id",
        "n_bytes",
        suffix_dedup.removed_bytes(F.col("spans")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.digests(bpe.encoded_documents(documents, ranks, public_tokenizers.PATTERN))


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.formatted(_table(spark, sf_dir, "conversations"))


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = (_table(spark, sf_dir, name) for name in ("documents", "labels"))
    return lm_score.cross_entropy_difference(documents, labels.filter("quality = 1"), Store.for_session(spark))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(_table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents"), Store.for_session(spark))


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    out = mixing.mixture(docs, Store.for_session(spark))
    return out.select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    out = token_counts.token_counts(documents, public_tokenizers.path("byte_bpe_50k.json"))
    return out.withColumn("over_limit", F.col("n_tokens") > CONTEXT_TOKENS)


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identified(_table(spark, sf_dir, "documents"), Store.for_session(spark))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = Store.for_session(spark)
    return prefix_trie.prefix_trie(*prefix_trie.rebuilt(_table(spark, sf_dir, "conversations"), store), store)


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, items = (_table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return ranked_search.ranked_documents(documents, items, Store.for_session(spark))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_toxicity,
        op2_ngram_join,
        op3_suffix_dedup,
        op4_bpe,
        op5_chat_formatting,
        op6_lm_score,
        op7_fingerprints,
        op8_exact_dedup,
        op9_source_mixing,
        op10_token_counts,
        op11_language_id,
        op12_prefix_trie,
        op13_ranked_search,
    )
}

ORACLE: dict[str, str] = {
    "op5_chat_formatting": r"""
        WITH plain AS (
            SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        ), numbered AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place,
                count(*) OVER (PARTITION BY conv_id) AS n_turns
            FROM plain
        ), prefixes AS (
            SELECT conv_id, place, n_turns, sha256(string_agg(length(role) || ':' || role || length(text) || ':' || text, ',')
                OVER (PARTITION BY conv_id ORDER BY place)) AS digest
            FROM numbered
        ), complete AS (
            SELECT min(conv_id) AS conv_id, n_turns, count(*) AS n_equal, digest
            FROM prefixes WHERE place = n_turns GROUP BY digest, n_turns
        ), kept AS (
            SELECT * FROM complete WHERE digest NOT IN (SELECT digest FROM prefixes WHERE place < n_turns)
        )
        SELECT k.conv_id, k.n_turns, k.n_equal, string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY place) AS text
        FROM kept k JOIN numbered n ON n.conv_id IS NOT DISTINCT FROM k.conv_id
        GROUP BY k.conv_id, k.n_turns, k.n_equal
    """,
    "op8_exact_dedup": r"""
        WITH digests AS (
            SELECT doc_id, length(coalesce(text, '')) AS n_chars,
                sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
            FROM documents
        ), ranked AS (
            SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
                row_number() OVER best = 1 AS kept, text_sha256
            FROM digests WINDOW best AS (PARTITION BY text_sha256 ORDER BY n_chars DESC, doc_id)
        )
        SELECT * FROM ranked
    """,
    "op12_prefix_trie": r"""
        WITH crc AS (
            -- crc32 of the decimal: each digit's code, then eight times a shift
            SELECT conv_id, xor(4294967295, list_reduce(
                list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(conv_id::VARCHAR, ''),
                    lambda c: [unicode(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
                lambda a, x: CASE WHEN x >= 0 THEN xor(a, x)
                    WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END)) % 6 AS h
            FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)
        ), placed AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
            FROM conversations WHERE conv_id IS NOT NULL
        ), rebuilt AS (
            SELECT c.conv_id, 0 AS own, p.place, p.role, p.text
            FROM crc c JOIN placed p ON p.conv_id = c.conv_id - c.conv_id % 100 AND p.place <= c.h
            UNION ALL
            SELECT c.conv_id, 1, p.place, p.role, p.text FROM crc c JOIN placed p ON p.conv_id = c.conv_id AND p.place > c.h
        ), depths AS (
            SELECT *, row_number() OVER w AS depth FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY own, place)
        ), prefixes AS (
            SELECT conv_id, depth, length(text) AS n_chars, sha256(string_agg(
                length(role) || ':' || role || length(text) || ':' || text, ',') OVER (PARTITION BY conv_id ORDER BY depth)) AS node
            FROM depths
            UNION ALL
            SELECT conv_id, 0, 0, '' FROM crc
        ), steps AS (
            SELECT *, lag(node) OVER w AS above, lead(node) OVER w IS NULL AS is_end
            FROM prefixes WINDOW w AS (PARTITION BY conv_id ORDER BY depth)
        ), nodes AS (
            SELECT node, any_value(above) AS above, min(conv_id) AS conv_id, any_value(depth) AS depth, count(*) AS n_convs,
                (count(*) - 1) * any_value(n_chars) AS saved,
                sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (is_end), '')) AS ends_sha256
            FROM steps GROUP BY node
        ), children AS (
            SELECT above AS node, count(*) AS n_children FROM nodes WHERE above IS NOT NULL GROUP BY above
        ), passed AS (
            -- every node with all that lie on the way of a conversation through it
            SELECT DISTINCT u.node, v.node AS below FROM steps u JOIN steps v ON u.conv_id = v.conv_id AND u.depth <= v.depth
        ), sums AS (
            SELECT p.node, count(*) FILTER (c.n_children IS NULL) AS n_leaves, sum(n.saved)::BIGINT AS saved_tokens
            FROM passed p JOIN nodes n ON n.node = p.below LEFT JOIN children c ON c.node = p.below GROUP BY p.node
        )
        SELECT n.conv_id, n.depth::BIGINT AS depth, a.conv_id AS parent_conv_id, n.n_convs,
            coalesce(c.n_children, 0) AS n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
        FROM nodes n JOIN sums s ON s.node = n.node LEFT JOIN nodes a ON a.node = n.above LEFT JOIN children c ON c.node = n.node
    """,
    "op13_ranked_search": r"""
        WITH found AS (
            SELECT doc_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM documents
        ), sizes AS (
            SELECT doc_id, count(*) AS n FROM found GROUP BY doc_id
        ), totals AS (
            SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM sizes
        ), wanted AS (
            SELECT item_id, term, count(*) AS times FROM (
                SELECT item_id, unnest(regexp_extract_all(
                    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
                FROM benchmark
            ) GROUP BY item_id, term
        ), met AS (
            SELECT doc_id, term, count(*) AS tf FROM found WHERE term IN (SELECT term FROM wanted) GROUP BY doc_id, term
        ), weights AS (
            SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
            FROM met, totals GROUP BY term
        ), impacts AS (
            SELECT doc_id, term, (1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms)) AS impact
            FROM met JOIN sizes USING (doc_id), totals
        ), scores AS (
            SELECT item_id, doc_id, sum(times * w * impact)::BIGINT AS score
            FROM wanted JOIN weights USING (term) JOIN impacts USING (term) GROUP BY item_id, doc_id
        ), ranked AS (
            SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
            FROM scores WHERE score > 0
        )
        SELECT * FROM ranked WHERE rank <= 20
    """,
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
