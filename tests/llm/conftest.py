from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from orebed.llm.common import ready

LONG = "lorem ipsum dolor " * 30000


def odd_rows() -> list[tuple]:
    """Null ids, null and empty texts, a very long one, repeated rows and ids, odd white space."""
    return [
        (5, "The same text here, twice.", "en"),
        (3, "The same  text\there, twice.", "en"),
        (3, "The same  text\there, twice.", "en"),
        (8, "The same text here, twice.", None),
        (None, "The same text here, twice.", "en"),
        (None, None, None),
        (1, None, "de"),
        (2, "", "de"),
        (9, " \n\t ", "en"),
        (10, LONG, "en"),
        (11, LONG, "en"),
        (12, "Ünïcödé ßtraße 中文 한글 🙂 <|endoftext|> I'LL go\x1c.", "de"),
        (13, 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" and key Zx8Qp2Lm9Rt4Vw7Ky1Bn5', "en"),
        (13, "another text under an id that is there already", "en"),
        (14, "word", "en"),
    ]


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows with columns whose names the operators use themselves."""
    ready(spark)
    df = spark.createDataFrame(odd_rows(), "doc_id long, text string, lang string")
    for name in ("kept", "digest", "length", "task", "rank", "component_id", "held_out", "score", "row", "block", "words", "n"):
        df = df.withColumn(name, F.lit("x"))
    return df


@pytest.fixture(scope="session")
def empty(odd):
    return odd.where("false")
