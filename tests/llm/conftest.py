import pytest
from pyspark.sql import types as T

#: Columns of documents plus some whose names the operators use themselves.
CLASHING = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        *(T.StructField(n, T.StringType()) for n in ("id", "key", "size", "row", "bucket", "keep_id", "digest", "hash", "pos", "next", "n")),
    ]
)


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark, sf):
    """Rows of documents as Python tuples (doc_id, text, source), by doc_id."""
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "source").collect()
    return sorted((r.doc_id, r.text, r.source) for r in rows)


@pytest.fixture(scope="session")
def odd(spark):
    """A frame of documents with extra columns, from (doc_id, text, source) tuples."""

    def make(rows):
        full = [(i, t, "en", s, None, *(["x"] * 11)) for i, t, s in rows]
        return spark.createDataFrame(full, CLASHING)

    return make


#: Nulls in any column, empty and long texts, ties and repeated rows.
ODD_ROWS = [
    (1, None, "b"),
    (2, "", "a"),
    (None, "Some words of a text without an id", None),
    (3, "Éa ABC abc\nline two\n\n line two ", "a"),
    (4, "éa abc ABC\nline two\n\n line two ", "a"),
    (5, "one", None),
    (5, "one", None),
    (6, "word " * 30_000, "c"),
    (7, " \t\n ", "b"),
    (8, "ÉA abc abc\nline two\n\n line two ", ""),
]


@pytest.fixture(scope="session")
def odd_rows():
    return ODD_ROWS
