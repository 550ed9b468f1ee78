"""Rows that operators must survive, and texts made up for the tests."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

# Extra columns are named as the operators' own.
DOCUMENTS = (
    "doc_id long, text string, source string, lang string, n_chars long, key string, row int, "
    "_key int, _row int, copies int, size int, band int, value int, ids string, part int, _turn int"
)


def words(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("abcdefghij") for _ in range(draw.randint(2, 8))) for _ in range(n))


def lines(seed: int, n: int) -> str:
    return "\n".join(words(seed * 1000 + i, 9) for i in range(n))


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Rows of (doc_id, text) or (doc_id, text, source)."""
    whole = [(*r, *["s"] * (3 - len(r)), "en", None, "k", 1, 2, 3, 4, 5, 6, 7, "i", 8, 9) for r in rows]
    return spark.createDataFrame(whole, DOCUMENTS)


def odd_rows() -> list[tuple]:
    long_ = lines(99, 2500)  # over 100 kB
    return [
        (1, lines(1, 12), "b"), (2, lines(1, 12), "b"), (3, None, "a"), (4, "", None), (5, " \n\t ", "a"),
        (6, "one", "a"), (7, "é😀\x00" * 5, "ü"), (8, long_, "b"), (9, long_ + " end", "b"),
        (None, lines(2, 6), "a"), (None, None, None), (10, lines(3, 5), None), (10, lines(3, 5), None),
        (11, "same " * 300, "a"), (12, "x" * 5000, "b"),
    ]
