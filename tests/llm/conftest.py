from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, cell long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents with extra columns whose names the operators use themselves."""

    def make(rows):
        return spark.createDataFrame([(i, t, lang, "s", 1, 0.5, 7) for i, t, lang in rows], DOCS)

    return make


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Nulls, empty and long texts, ties and repeated rows."""
    long = "word " * 30_000 + "Ünïcode 中文   end"
    rows = [
        (4, None, "en"), (2, "", None), (None, "no id at all here", "en"), (9, " \t\n", "en"), (7, long, "en"),
        (5, "same text here twice for all", "en"), (5, "same text here twice for all", "en"),
        (6, "same text here twice for all", "fr"), (3, "123 !!! $$$", "en"), (8, "x", "de"),
    ]
    return make_docs(rows), rows


@pytest.fixture(scope="session")
def vectors(spark):
    schema = T.StructType(
        [
            T.StructField("vec_id", T.LongType()),
            T.StructField("embedding", T.ArrayType(T.FloatType())),
            T.StructField("label", T.IntegerType()),
            T.StructField("block", T.StringType()),
        ]
    )
    return lambda rows: spark.createDataFrame([(i, v, label, "b") for i, v, label in rows], schema)
