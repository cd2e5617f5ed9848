from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Builds a documents table from (doc_id, text) pairs, with columns whose names may clash."""

    def build(rows, extra: bool = False):
        df = spark.createDataFrame([(d, t, "en", "src0", None if t is None else len(t)) for d, t in rows], SCHEMA)
        if extra:
            from pyspark.sql import functions as F

            names = ["_id", "_text", "_digest", "_hash", "_row", "_rank", "n", "words", "key", "c", "digest", "bucket", "unit", "label", "copies"]
            df = df.withColumns({x: F.lit("x") for x in names})
        return df

    return build


ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t"),
    (4, "one two"),
    (5, "one two"),
    (5, "one two"),
    (None, "one two three four five six"),
    (None, None),
    (7, "é ß 東京 " * 50),
    (8, "word" * 5_000),
    (9, "long text with many words " * 4_000),
]


@pytest.fixture(scope="session")
def odd():
    return ODD
