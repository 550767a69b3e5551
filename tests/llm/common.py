"""Awkward documents that every operator has to take, and small helpers."""

import random

WORDS = "amber birch cedar dune ember fjord grove heath inlet jetty knoll larch mesa north oasis prairie".split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n)).capitalize() + "."


def prose(seed, sentences=6, words=9):
    rng = random.Random(seed)
    return " ".join(sentence(rng, words) for _ in range(sentences))


def odd_documents(spark):
    """Nulls in every column, empty and very long texts, repeats, ties, clashing extra columns."""
    long = prose(7, 2500)
    rows = [
        (1, prose(1), "en", "a", 3), (2, prose(1), None, "a", None), (3, None, "en", None, 1), (4, "", "en", "b", 0),
        (5, " \n\t ", "de", "b", 3), (6, long, "en", "c", len(long)), (7, "one", None, None, None),
        (8, "É ß ñandú — <|endoftext|> it's 3.14 a@b.c !!", "es", "c", 1), (9, prose(2), "en", "a", 2),
        (9, prose(2), "en", "a", 2), (None, prose(3), "en", "a", 2), (11, "x" * 5000, "en", "d", 1),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    clash = ["fp", "length", "score", "word", "hash", "digest", "item_id", "piece", "half", "_text"]
    from pyspark.sql import functions as F

    return docs.withColumns({c: F.lit(c) for c in clash})


def empty_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
