import json

import duckdb
import pandas as pd
import pytest

import corpus_pipeline
from ledgerloom.llm import bpe, mixing, queries

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "labels", "conversations", "benchmark")


@pytest.fixture(scope="module")
def results(spark):
    return {name: query(spark, SF).toPandas() for name, query in queries.queries().items()}


def test_every_operator_has_a_query():
    names = sorted(int(n[2:].split("_")[0]) for n in queries.queries())
    assert names == list(range(1, 14))
    assert queries.oracle_sql().keys() <= queries.queries().keys()


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_oracle(results, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want, got = con.execute(queries.ORACLE[name]).df(), results[name]
    columns = sorted(want.columns)
    assert columns == sorted(got.columns)

    def plain(value):
        # whole numbers of a column with nulls come as floats
        if pd.isna(value):
            return None
        return int(value) if isinstance(value, float) and value == int(value) else value

    def rows(df):
        return sorted(json.dumps([plain(v) for v in r], default=str) for r in df[columns].astype(object).values.tolist())

    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - {"op5_chat_formatting", "op12_prefix_trie", "op13_ranked_search"}))
def test_one_row_per_document(results, name):
    import pyarrow.parquet as pq

    ids = sorted(pq.read_table(f"{SF}/documents.parquet", columns=["doc_id"]).column(0).to_pylist())
    assert sorted(results[name]["doc_id"]) == ids


def test_stages_take_effect(spark, results, tmp_path):
    """Each stage against the operator it calls, on what the stage before it kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = docs.toPandas()
        if name != "bpe":
            assert tuple(docs.columns) == corpus_pipeline.COLUMNS
    toxic = set(results["op1_toxicity"].query("predicted == 1").doc_id)
    assert set(kept["toxicity"].doc_id) == set(results["op1_toxicity"].doc_id) - toxic

    def squeezed(text):
        return "".join((text or "").split())

    survivors = {}
    for r in kept["toxicity"].itertuples():
        key = (-len(r.text or ""), r.doc_id)
        survivors[squeezed(r.text)] = min(survivors.get(squeezed(r.text), key), key)
    assert sorted(kept["exact_dedup"].doc_id) == sorted(k[1] for k in survivors.values())

    from test_ngram_join import brute

    rows = [(r.doc_id, r.text) for r in kept["exact_dedup"].itertuples()]
    assert sorted(kept["ngram_join"].doc_id) == sorted({r[2] for r in brute(rows)})

    size = kept["ngram_join"].text.str.split().str.len().sum()
    taken = kept["mixing"].text.str.split().str.len().sum()
    assert taken == pytest.approx(size, rel=0.1)
    assert kept["mixing"].doc_id.value_counts().max() <= mixing.MOST
    assert set(kept["mixing"].doc_id) <= set(kept["ngram_join"].doc_id)

    import public_tokenizers

    own = bpe.encoding(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    assert sorted(kept["bpe"].n_tokens) == sorted(len(own.encode_ordinary(t or "")) for t in kept["mixing"].text)


def test_pipeline_runs_all_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "ngram_join", "mixing", "bpe"]
    out = corpus_pipeline.run(spark, SF)
    assert set(out.columns) == {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}
    assert out.count() > 50
