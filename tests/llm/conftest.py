import pytest
from pyspark.sql import types as T


@pytest.fixture(scope="session")
def spark(spark):
    from panelkit.llm._common import importable
    importable(spark)
    return spark


@pytest.fixture
def documents(spark):
    """Documents with clashing extra columns; rows are (doc_id, text[, lang, source])."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                           T.StructField("n_chars", T.LongType()), T.StructField("size", T.StringType()),
                           T.StructField("key", T.StringType()), T.StructField("a.b", T.StringType())])

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s",
                 None if r[1] is None else len(r[1]), "x", "y", "z") for r in rows]
        return spark.createDataFrame(full, schema)

    return make
