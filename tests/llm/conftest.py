import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # extra columns with names that operators use inside
    T.StructField("n", T.LongType()), T.StructField("score", T.DoubleType()), T.StructField("key", T.StringType()),
])


@pytest.fixture(scope="session")
def documents(spark):
    """A documents table of (doc_id, text[, lang]) rows with clashing extra columns."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, None, None, 7, 0.5, "x") for r in rows]
        return spark.createDataFrame(full, DOCUMENTS)

    return make
