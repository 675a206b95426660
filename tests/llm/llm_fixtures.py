"""Fixtures that the operator tests import (a second conftest would hide the first)."""

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def docs(spark):
    """A table of documents from (doc_id, text) or (doc_id, text, lang) rows."""
    def make(*rows):
        return spark.createDataFrame([(r[0], r[1], r[2] if len(r) > 2 else "en", "s", None if r[1] is None else len(r[1])) for r in rows], DOCS)
    return make
