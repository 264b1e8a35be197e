"""Fixtures shared by the corpus operator tests."""

import random

SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, n int, t1 string, "
          "score string, accepted string, `a.b` int")


def documents(spark, texts, lang="en"):
    """A documents table with further columns whose names operators use too."""
    rows = [(i, t, lang, "s", len(t or ""), 1, "x", "y", "z", 2) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


def odd_texts():
    """Nulls, blanks, repeated rows, a null id and a very long text."""
    body = "one two three four five six seven eight nine ten eleven twelve. " * 3
    return [(1, None), (2, ""), (3, " \n\t "), (4, body), (4, body), (5, body), (None, "lonely words here"),
            (None, None), (6, "word " * 30000), (7, "été À là\u00a0! " * 5), (8, "x")]


def prose(rng: random.Random, words: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(words))


def rows_of(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)
