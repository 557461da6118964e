import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture
def docs(spark):
    def make(rows):
        return spark.createDataFrame([(i, t, None, s, None if t is None else len(t)) for i, t, s in rows], DOCS)

    return make
