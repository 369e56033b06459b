import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def small(spark):
    """The smallest tables."""
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark):
    """Documents with nulls, an empty text, a repeated row and a column whose name clashes with made ones."""
    rows = [
        (1, "The cat sat on the mat and looked at the dog.", "en", "a", 45), (2, None, "en", "a", 0), (3, "", None, None, 0),
        (4, "The cat sat on the mat and looked at the dog.", "en", "b", 45), (4, "The cat sat on the mat and looked at the dog.", "en", "b", 45),
        (None, "A row without an id.", "en", "c", 20), (5, "x " * 30_000, "en", "c", 60_000), (6, "\n\t 123 !!", "fr", "d", 9),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return df.withColumns({"score": F.lit("mine"), "n_tokens": F.lit(-1)})


@pytest.fixture(scope="session")
def nothing(docs):
    return docs.limit(0)
