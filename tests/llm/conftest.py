import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text[, source]) rows, over several partitions."""

    def make(rows, partitions=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(partitions)

    return make


@pytest.fixture
def clashing(spark):
    """Add columns whose names the operators use inside."""

    def add(df):
        from pyspark.sql import functions as F

        names = ("_slice", "_tie", "size", "key", "part", "rank", "again", "place", "_row", "best", "count", "n_shingles")
        return df.withColumns({n: F.lit("x") for n in names if n not in df.columns})

    return add
