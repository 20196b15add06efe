"""Word counts and their commonality on the Zipf scale."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.functions.text import normalize, split_words
from lexiloom.session import written


def word_counts(docs: DataFrame, text: str = "text", by: list[str] | None = None) -> DataFrame:
    """Occurrences of every lower-case word; combined map-side, so frequent words do not skew."""
    keys = by or []
    words = docs.select(*keys, F.explode(split_words(normalize(F.col(text)))).alias("word"))
    return words.groupBy(*keys, "word").agg(F.count("*").alias("n"))


def zipf_vocabulary(docs: DataFrame, text: str = "text") -> DataFrame:
    """``word, n, commonality``: the base-10 logarithm of occurrences per billion words.

    The counts are stored once: the total is their sum, so the corpus is read and counted one time.
    """
    counts = written(word_counts(docs, text), "word_counts")
    total = counts.agg(F.sum("n")).first()[0]
    return counts.withColumn("commonality", F.log10(F.col("n") / F.lit(total) * F.lit(1e9)))
