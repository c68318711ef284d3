"""Small documents with every awkward case, and the given ones."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SF_DIR = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, locator string, words string, kept string"


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    syllables = ["ka", "lo", "mi", "ren", "su", "tha", "vo", "zu", "pel", "dri"]
    return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(words))


def edge_rows() -> list[tuple]:
    """Nulls, empty texts, copies, near copies, shared passages, repeated rows, long words, odd spaces, clashing columns."""
    passage, base = prose(1, 70), prose(2, 300)
    edited = base.split()
    edited[40], edited[200] = "changed", "words"
    other = prose(3, 60)
    texts = [
        (1, base), (2, base), (3, " ".join(edited)), (4, None), (5, ""), (6, " \n\t "), (None, base), (None, None),
        (7, f"{prose(4, 50)} {passage} {prose(5, 50)}"), (8, f"{prose(6, 20)}\n{passage}"), (9, f"{passage} {passage}"),
        (10, other), (10, other), (10, other), (10, prose(7, 40)), (11, "x" * 3_000), (12, "a " * 600 + "b"),
        (13, "line one here\nline one here\nélan vital ça ñ 漢字 😀 " + prose(8, 30)), (14, "<|endoftext|> one  two three\x0bfour"),
        (15, "#$% & | * < >" * 9), (16, "WORD!! " * 40), (17, prose(9, 4)), (18, prose(10, 4_000)), (19, "ab" * 40), (20, "ab" * 90),
    ]
    sources = ["s1", "s2", None, "s10", "é"]
    return [
        (i, t, None if k % 4 else "en", sources[k % 5] if k % 3 else "s1", None, "r", "l", "w", "k")
        for k, (i, t) in enumerate(texts)
    ]


def edge_docs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3)


def no_docs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def given(spark: SparkSession) -> DataFrame:
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")
