"""Texts and a schema for odd tables."""

from pyspark.sql.types import LongType, StringType, StructField, StructType

#: Columns that a caller's table may have beside the operators' own; some have the names of measurements.
DOCS = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()), StructField("source", StringType()), StructField("n_words", LongType()), StructField("words", StringType()), StructField("fp", LongType()), StructField("g", LongType())])

WORDS = "the of and to in is it that for was on are with as his they be at one have this from or had by hot word but what some".split()


def prose(seed, n):
    import random

    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "er", "ing", "ly", "s"]) for _ in range(n)) + "."
