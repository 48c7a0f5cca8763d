import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
LABELS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()), T.StructField("toxic", T.IntegerType())])


@pytest.fixture(scope="session")
def make(spark):
    """Rows of (doc_id, text, source) as a documents table."""
    def build(rows):
        return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows], DOCS)

    return build


@pytest.fixture(scope="session")
def label(spark):
    return lambda rows: spark.createDataFrame(rows, LABELS)


