from __future__ import annotations

import os
import tempfile

import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def tables(spark):
    def read(name: str):
        return spark.read.parquet(f"{SMALL}/{name}.parquet")

    return read


@pytest.fixture(scope="session")
def folder():
    """Stores tables as ``<folder>/<name>.parquet``, as queries expect them."""
    made = tempfile.mkdtemp(prefix="llm-tables-")

    def store(name: str, df) -> str:
        df.write.mode("overwrite").parquet(os.path.join(made, f"{name}.parquet"))
        return made

    return store


#: Rows that every operator on documents has to cope with: nulls, empty and very long texts, ties, repeats.
LONG = "aé中 " * 60_000
ODD_DOCUMENTS = [
    (1, None, None, None, None),
    (2, "", "en", "s1", 0),
    (3, "   \t\n", "en", "s1", 5),
    (4, "one", "en", None, 3),
    (5, LONG, "en", "s2", len(LONG)),
    (6, "x" * 300_000, "en", "s2", 300_000),
    (7, "same text here for you and me", "de", "s3", 29),
    (8, "same text here for you and me", "de", "s3", 29),
    (8, "same text here for you and me", "de", "s3", 29),
    (None, "no id at all in this row", "fr", "s3", 24),
    (-9, "nul \x00 byte and <|im_end|> é ß 中文字 \U0001f600", "fr", "", 40),
]


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows, with extra columns named like those the operators make."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ODD_DOCUMENTS, "doc_id long, text string, lang string, source string, n_chars long")
    extra = ("size", "fp", "component_id", "target", "shard", "place", "ids", "score", "spans", "root", "digest", "slot", "key")
    return df.withColumns({name: F.lit("mine") for name in extra})
