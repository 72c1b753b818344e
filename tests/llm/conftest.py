import os

import duckdb
import pytest

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def small_docs(spark):
    """All documents of the smallest table and their rows."""
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return df, df.collect()


@pytest.fixture(scope="session")
def con():
    return duckdb.connect()


#: Texts that every per-document operator must survive.
ODD_TEXTS = [
    None,
    "",
    " \t\r\n\x0b\x0c ",
    "a",
    "\x00\x01",
    "é" * 7,
    "  non breaking   x",
    "😀 smile " * 30,
    "one two three four five six seven eight nine ten eleven",
    "one two three four five six seven eight nine ten eleven",
    "word " * 200_000,
    "$" * 100_000,
]


@pytest.fixture
def odd_docs(rows):
    """Nulls everywhere, empty and very long texts, repeated rows, extra columns with clashing names."""
    schema = (
        "doc_id bigint, text string, lang string, source string, n_chars bigint, KEPT string, fp string, ids string, "
        "n_words string, score string, fingerprint string, length string"
    )
    internal = ["p", "key", "row", "__row", "__host", "__runs0", "__c0", "__text", "__found", "__words", "__key", "__part", "__scan_text"]
    data = [(i, t, "en", "src0", 1, "x", "x", "x", "x", "x", "x", "x") for i, t in enumerate(ODD_TEXTS)]
    nothing = (None,) * 11
    data += [(None, "null id " * 9, *(None,) * 10), (None, None, *(None,) * 10), (3, "a", *(None,) * 10)]
    assert len(nothing) == 11
    return rows(schema, data).selectExpr("*", *[f"{i} as `{name}`" for i, name in enumerate(internal)])
