from __future__ import annotations

import random

import pytest

#: Texts that every operator has to take, by name.
TEXTS = {
    "null": None, "empty": "", "blank": " \t\n ", "one": "word", "unicode": "Ünïcödé ΑΣ ß 𝒳 日本語 é́  x",
    "special": "a<|endoftext|>b <|startoftext|> </s>", "repeat": "same words here " * 40, "no blanks": "ab1" * 3000,
    "long": " ".join(f"w{i % 977}" for i in range(30_000)), "lines": "\n".join(f"line {i}: text." for i in range(300)),
}
DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def odd_rows():
    """Odd texts, each once more under another id, one row repeated, and one without id."""
    rows = []
    for copy in range(2):
        for i, text in enumerate(TEXTS.values()):
            rows.append((i + 100 * copy, text, None if i % 3 else "en", None if i % 4 == 0 else f"s{i % 2}", len(text or "")))
    rows.append(rows[3])
    rows.append((None, "no id here", "en", "s0", 10))
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The same as a table, with columns named like results."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(odd_rows, DOCUMENTS)
    return df.withColumns({"N_Tokens": F.lit("x"), "ids": F.lit(1), "score": F.lit("y"), "spans": F.lit(0), "shard": F.lit("z"),
                           "block": F.lit(5), "fp": F.lit(6), "queue": F.lit(7), "bucket": F.lit(8)})


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture
def chance():
    return random.Random(5)
