import pytest

# Columns whose names the operators use themselves.
CLASHING = "1 AS id, 'x' AS text_key, 2L AS component, 'y' AS kept, 3 AS _row, 4 AS block, 5 AS g, 6 AS n, 7 AS piece"


@pytest.fixture(scope="session")
def documents(spark):
    """Builds a documents table from (doc_id, text, lang) rows, with extra columns of clashing names."""

    def build(rows):
        plain = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
        return plain.selectExpr("*", "'s' AS source", "CAST(length(text) AS BIGINT) AS n_chars", *CLASHING.split(", "))

    return build


@pytest.fixture(scope="session")
def small(spark):
    """Whole documents of the smallest scale, as a table and as a dictionary."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return docs, {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
