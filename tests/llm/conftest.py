import pytest
from pyspark.sql import functions as F


@pytest.fixture
def docs_of(spark):
    """Documents of the given texts, with the columns of the table."""

    def make(texts, **extra):
        rows = [(i, t, "en", f"src{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
        for name, value in extra.items():
            df = df.withColumn(name, F.lit(value))
        return df

    return make


# Nulls, empty and blank texts, repeats, and a very long text.
ODD_TEXTS = [None, "", " \n\t ", "one", "same words here", "same words here", "x" * 50_000, "w " * 30_000, "é😀 ½ \u0000 z"]
