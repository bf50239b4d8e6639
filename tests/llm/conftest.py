from __future__ import annotations

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf() -> str:
    return SF


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) pairs, with the other columns of the table."""

    def build(rows):
        full = [(i, t, "en", "src", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")

    return build


#: Texts every operator over documents must take.
ODD = [None, "", " \t\n", "a", "é🙂", "word " * 30_000, "x" * 50_000, "same text here", "same text here", "\x00 nul \r\n line"]


@pytest.fixture(scope="session")
def odd(docs_of):
    """Odd texts with a repeated row, and columns whose names clash with outputs."""
    from pyspark.sql import functions as F

    rows = list(enumerate(ODD)) + [(7, "same text here")]
    df = docs_of(rows)
    for name in ("ids", "n_words", "kept", "spans", "base", "toxic", "fp", "start", "component_id", "n_bytes", "group"):
        df = df.withColumn(name, F.lit("mine"))
    return df
