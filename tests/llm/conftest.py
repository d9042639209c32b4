import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i % 977}x{i}" for i in range(30_000))
ODD = [  # repeated rows, nulls in every column, empty and blank texts, ties, one very long text
    (1, "the same words here for all of us", "en", "a", 7), (2, "the same words here for all of us", "en", "a", 7),
    (2, "the same words here for all of us", "en", "a", 7), (3, None, "en", None, None), (4, "", None, "b", 0), (5, " \t\n ", "de", "b", 3),
    (None, "the same words here for all of us", None, None, None), (None, "nobody else says this at all", "en", "a", 1),
    (6, "one", "en", "a", 3), (7, "ONE", None, "a", 3), (8, "12345 !!! ###", "fr", "c", 13), (9, LONG, "en", "a", len(LONG)),
    (10, LONG + " tail", None, "a", len(LONG) + 5)]
KINDS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows with columns named like those inside the operators."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(ODD, KINDS)
    clashing = ["key", "n", "hash", "hashes", "digest", "run", "bucket", "words", "label", "row", "keep_id", "text_sha256", "doc", "item", "ids"]
    return df.select("*", *[F.lit("x").alias(c) for c in clashing])


@pytest.fixture(scope="session")
def none(spark, odd):
    return odd.filter("1 = 0")


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def small_texts(small):
    return {r.doc_id: r.text or "" for r in small.select("doc_id", "text").collect()}
