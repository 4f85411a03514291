import pytest

LONG = "lorem ipsum dolor " * 40_000


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows, and columns that clash with results."""
    rows = [
        (1, "same text here", "en", 1), (2, "same text here", None, None), (2, "same text here", None, None),
        (3, None, "en", 0), (4, "", "fr", 1), (None, "a row without id", "en", 1), (None, None, None, None),
        (5, LONG, "en", 1), (6, LONG, "en", 1), (7, "mail a.b@c.de now, call +49 30 1234 5678", "de", 0),
        (8, "123 !!! ???", "de", 0),
    ]
    schema = "doc_id long, text string, lang string, quality int"
    return spark.createDataFrame(rows, schema).selectExpr("*", "'x' AS keep_id", "'y' AS score", "1 AS kept", "'z' AS row_id")


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").cache()
