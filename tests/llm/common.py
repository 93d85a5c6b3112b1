"""Small tables for the operators' tests."""

from __future__ import annotations

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SYLLABLES = "ka lo mi ne ru sta vel dor fin gas hul pem".split()


def word(rnd: random.Random) -> str:
    return "".join(rnd.choice(SYLLABLES) for _ in range(rnd.randint(1, 3)))


def sentence(rnd: random.Random, n: int) -> str:
    return " ".join(word(rnd) for _ in range(n)).capitalize() + "."


def prose(rnd: random.Random, sentences: int, breaks: int = 5) -> str:
    out = [sentence(rnd, rnd.randint(4, 11)) for _ in range(sentences)]
    return "".join(s + ("\n" if i % breaks == breaks - 1 else " ") for i, s in enumerate(out)).strip()


def documents(spark, texts, first=0):
    """Rows of the documents table; ``texts`` may hold (id, text) pairs."""
    pairs = [t if isinstance(t, tuple) else (first + i, t) for i, t in enumerate(texts)]
    rows = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in pairs]
    return spark.createDataFrame(rows, SCHEMA)


def odd_cases(spark):
    """Nulls, blanks, repeated rows, a very long text, and extra columns with names the operators use."""
    rnd = random.Random(3)
    texts = [None, "", "  \n ", "one", "a b c", "a b c", prose(rnd, 4), "x" * 200_000, "w " * 100_000, (5, "a b c"), (None, "null id here"), (None, None)]
    df = documents(spark, texts)
    return df.selectExpr("*", "1 AS part", "2 AS cls", "'k' AS token", "'z' AS segments", "3 AS asks", "4 AS key_id", "5 AS n_removed", "6 AS score")
