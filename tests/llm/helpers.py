"""Small tables with every odd case, and brute-force forms."""

import re

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return WORDS.findall(text or "")


def prose(seed, n):
    import random

    rng = random.Random(seed)
    return " ".join(rng.choice("abcdefghij") + rng.choice(("an", "to", "ri", "lé", "sch")) + str(rng.randint(0, 99)) for _ in range(n))


def odd_rows():
    """Nulls in every column, empty and white texts, a very long text, ties, repeated rows and ids."""
    base = prose(1, 120)
    passage = prose(2, 40)
    return [
        (1, base, "en", "a", 3), (2, base, "en", "a", 3), (2, base, "en", "a", 3), (3, base + " more words", "en", "b", 3),
        (4, passage + " " + prose(3, 80), None, "b", None), (5, prose(4, 70) + " " + passage + "\n" + passage, "de", None, 9),
        (6, None, "en", "a", 1), (7, "", "en", "b", 0), (8, " \t\n\x0b\x0c\r ", "en", "a", 6), (9, "one", "en", "a", 3),
        (10, "Two  WORDS\x1c  x", "en", None, 2), (None, prose(5, 60), "en", "a", 1), (None, None, None, None, None),
        (11, prose(6, 30_000), "en", "c", 1), (11, prose(7, 60), "en", "c", 1), (12, "a b c " * 60, "en", "c", 1),
        (13, "# $ % " * 50, "en", "a", 1), (14, "<|endoftext|> don't  'll x ý \U0001f600 " + prose(8, 60), "fr", "a", 1),
    ]


def odd_docs(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


CLASHING = ("id", "h", "f", "row", "n_words", "kept", "spans", "block", "key", "a", "b", "v", "rank", "score", "epoch", "times", "text_key",
            "start", "length", "length_", "part", "shard", "_text_hash", "w", "t", "lines", "p", "q", "side", "chunk")


def with_clashes(df):
    """The table with more columns, named as the operators name theirs."""
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit(f"clash-{c}") for c in CLASHING})
