"""Small inputs shared by the operator tests."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, h string, target double"


def words(n: int, seed: int) -> str:
    rnd = random.Random(seed)
    syl = ["an", "the", "re", "tion", "és", "ou", "in", "st", "ing", "le"]
    return " ".join("".join(rnd.choice(syl) for _ in range(rnd.randint(1, 4))) for _ in range(n))


def edge_rows() -> list[tuple]:
    """Nulls in every column, empty and long texts, ties, repeated rows; the
    last three columns clash with names that the operators use."""
    long = words(4000, 1)
    row = lambda i, t, s="a": (i, t, "en", s, None if t is None else len(t), 7, "x", 0.5)
    return [
        row(1, words(60, 2)), row(2, words(60, 2)), row(3, words(60, 2).replace(" ", "\t\n")),
        row(4, None), row(5, ""), row(6, " \n\t "), row(7, long, "b"), row(8, long + " x", None),
        row(None, words(30, 3)), row(None, words(30, 3)), row(9, words(60, 4), None), row(9, words(60, 4), None),
        (10, "one two", None, None, None, None, None, None), row(11, "ONE two", "c"), row(12, "é日本 𝄞 \x00", "c"),
    ]


def edge_docs(spark, rows=None):
    return spark.createDataFrame(edge_rows() if rows is None else rows, DOCS)


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


def read(spark, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
