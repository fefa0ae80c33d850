from __future__ import annotations

import pytest

#: Texts with every edge case; ids repeat and are null, columns clash with names of results.
TEXTS = [
    (1, "one two three four five six seven eight nine ten " * 6, "en"),
    (2, "one  two three\tfour five six seven eight nine ten " * 6, "en"),
    (3, None, None),
    (4, "", "en"),
    (5, " \n\t ", "de"),
    (6, "### *** 123 456", "de"),
    (7, "der die das und nicht mit ist ein eine auf " * 9, "de"),
    (7, "der die das und nicht mit ist ein eine auf " * 9, "de"),
    (None, "der die das und nicht mit ist ein eine auf " * 9, None),
    (8, "a b c", "en"),
    (9, "A B C", "en"),
    (10, "word " * 30_000 + "\n" + "x" * 50_000, "en"),
    (11, "le la les des une dans pour que qui sur " * 12, "fr"),
    (12, "Le la les des une dans pour que qui sur " * 12 + "encore", "fr"),
    (13, "é́ ﬁ ① 😀 　x\u00a0y <s> </s> <|endoftext|> ▁a  b\r\n", "fr"),
    (None, None, None),
]
SCHEMA = "doc_id long, text string, lang string"


@pytest.fixture(scope="session")
def edge(spark):
    """Edge cases, with further columns whose names are those of results."""
    return spark.createDataFrame(
        [(*row, i, f"k{i}", True) for i, row in enumerate(TEXTS)],
        SCHEMA + ", n_words long, key string, kept boolean",
    )


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA + ", id long, row string")


@pytest.fixture(scope="session")
def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


@pytest.fixture(scope="session")
def pages(spark, folder):
    return spark.read.parquet(f"{folder}/pages.parquet")
