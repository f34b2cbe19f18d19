from __future__ import annotations

import public_tokenizers
import pytest

SF = "/root/testdata/sf0.001"

LONG = "lorem ipsum dolor sit amet " * 40_000

# id, text, source: nulls in every column, empty and very long texts, repeated rows, ids out of order.
ROWS = [
    (7, "The quick brown fox jumps over the lazy dog near the river bank", "a"),
    (3, "THE quick brown fox jumps over the lazy dog near the river bank", "a"),
    (9, None, "a"),
    (1, "", "b"),
    (2, "   \n\t ", None),
    (None, "the quick brown fox jumps over the lazy dog near the river bank", "b"),
    (5, LONG, "b"),
    (5, LONG, "b"),
    (6, "word", None),
    (4, "Ünïcode 🙂 текст é", ""),
]


@pytest.fixture(scope="session")
def edge(spark):
    """The edge rows, with extra columns whose names the operators use inside."""
    rows = [(i, t, s, "x", 1, 2, [3], "y") for i, t, s in ROWS]
    schema = "doc_id long, text string, source string, row string, size int, keep int, ids array<int>, class string"
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def byte_bpe():
    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def word_bpe():
    return public_tokenizers.path("word_bpe_49k.json")
