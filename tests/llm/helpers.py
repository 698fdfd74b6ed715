"""Small tables for the tests of text operators."""

import random

DOCS = "doc_id long, text string, lang string, source string"


def documents(spark, rows):
    """Rows of (doc_id, text[, lang[, source]])."""
    return spark.createDataFrame([(*r, *(None,) * (4 - len(r))) for r in rows], DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def with_clashes(df, *names):
    """Extra columns that bear the names an operator would like to use."""
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit("own").alias(n) for n in names])


def prose(seed, words, vocabulary=300):
    chance = random.Random(seed)
    parts = ["th", "an", "er", "on", "in", "ou", "st", "re", "ed", "ti"]
    known = ["".join(chance.choice(parts) for _ in range(chance.randint(1, 4))) for _ in range(vocabulary)]
    return " ".join(chance.choice(known) for _ in range(words))


HARD_TEXTS = [None, "", " ", "\n\t ", "a", "A b", "one two three", "é ß 中文 😀", "x" * 3000, "a\x00b", " 　", "<|endoftext|> ok", "#" * 50]
