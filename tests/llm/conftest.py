import random

import pytest
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n int, fp string, slot string"


def rows_for_tests():
    """Small documents with nulls, empty and long texts, ties, repeated rows and clashing columns."""
    rng = random.Random(5)
    words = ["the", "und", "mañana", "élan", "x1", "Größe", "and", "of", "wörter", "tokens", "ab", "zz."]
    long = " ".join(rng.choice(words) for _ in range(6000))
    block = " ".join(rng.choice(words) for _ in range(60))
    out = [
        (1, "a b c", "en", "s1", 1, 0, "f", "t"), (2, None, None, None, None, None, None, None), (3, "", "en", "s1", 0, 1, "", ""),
        (4, long, "de", "s2", 1, 1, None, "x"), (5, long, "de", "s2", 1, 1, None, "x"), (6, f"{block} tail one", "fr", "s3", 2, 2, "q", "q"),
        (7, f"Head  two\t{block}", "fr", "s3", 2, 2, "q", "q"), (8, block, None, "s1", 2, 2, "q", "q"), (9, "### $$$ ||| 123", "es", None, 3, 3, "", ""),
        (10, "\n\n  \t ", "en", "s2", 4, 4, "", ""), (11, "x" * 5000, "en", "s4", 5, 5, "", ""), (12, "Ǻ   word ́x it's  I'll\r\nend", "en", "s4", 5, 5, "", ""),
    ]
    out += [out[0], out[3], (None, "a b c d e f", "en", "s1", 1, 0, "f", "t"), (None, None, None, None, None, None, None, None)]
    out += [(100 + i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 90))), rng.choice(["en", "de"]), f"s{i % 5}", i, i, "", "") for i in range(60)]
    return out


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(rows_for_tests(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def both(odd, small):
    """Both tables in one, under ids that differ."""
    cols = ["doc_id", "text", "lang", "source", "n_chars"]
    return odd.select(*cols).unionByName(small.select(*cols).withColumn("doc_id", F.col("doc_id") + 1000))
