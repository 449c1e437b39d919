"""Small fixtures that every operator is held against."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

#: Nulls, empty and blank texts, a very long one, ties and repeated rows.
ODD = [
    (1, None, None, None, None), (2, "", "en", "a", 0), (3, "   \n\t ", "en", "a", 6), (None, "no id here at all", "en", "b", 17), (4, "word " * 50_000, "en", "b", 250_000),
    (5, "the same text twice over and over again", "en", None, 39), (5, "the same text twice over and over again", "en", None, 39), (6, "!!! ??? 123", "en", "c", 11), (7, "Ünḯcødé ẞtraße ﬁ \U0001f600", "de", "c", 20),
]


def words(n, seed, vocabulary=None):
    r = random.Random(seed)
    vocabulary = vocabulary or ["".join(r.choice("bcdfglmnprst") + r.choice("aeiou") for _ in range(r.randint(1, 4))) for _ in range(400)]
    return [r.choice(vocabulary) for _ in range(n)]


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


def odd(spark):
    """The odd rows with extra columns whose names clash with those that operators use inside."""
    from pyspark.sql import functions as F

    rows = frame(spark, ODD)
    names = ["_id", "_text", "_fp", "_hash", "_h", "_i", "_key", "_score", "_found", "_held", "_canon", "_tokens", "_lang", "_row", "taken", "size", "target", "score", "n_tokens", "fingerprint", "component", "first", "row", "_text_hash", "_size", "_source", "_shard"]
    return rows.withColumns({n: F.lit(f"x{n}") for n in names})


def none(spark):
    return frame(spark, [])
