import os

import pytest
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("n_tokens", T.StringType()), T.StructField("hash", T.StringType()),
    T.StructField("text_1", T.StringType()), T.StructField("kept", T.StringType()),
])

ODD = [
    None, "", " ", "\n\n", "a", "a" * 9000, "  two  spaces \n\n and\tlines \n", "tab\t\tx\r\ny",
    "no break wide  x", "line\x0bfeed\x0c x\x1c y\x85z", "it's we'll 12345 1 2 ...!? ",
    "<|endoftext|>", "x <|endoftext|> y<|endoftext|><|startoftext|> <|start", "漢字かな交じり文 \U0001f600‍",
    "é ́x İIΣ Σ", "՘֋ Ᲊx", "word " * 3000 + "end", "x" * 50 + " " * 500 + "y",
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns with clashing names."""
    rows = [(i, t, "x", None, "y", "z") for i, t in enumerate(ODD)]
    rows += [(3, ODD[3], None, None, None, None)] * 2 + [(6, ODD[6], None, None, None, None),
             (6, "other text", None, None, None, None), (None, "no id", None, None, None, None),
             (None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def tuples(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=repr)
