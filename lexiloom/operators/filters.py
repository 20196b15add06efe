"""Row filters, and the reports that say what was filtered out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.functions.languages import LanguagePair
from lexiloom.functions.text import is_blank


def filter_threshold(df: DataFrame, threshold: float, score: str = "comet_score") -> DataFrame:
    if score not in df.columns:
        raise ValueError(f"Column {score!r} not found; available columns: {df.columns}")
    return df.filter(F.col(score) >= threshold)


def filter_known_language(df: DataFrame, pair: LanguagePair, language: str = "language") -> DataFrame:
    return df.filter(pair.is_member(F.col(language)))


def unknown_languages(df: DataFrame, pair: LanguagePair, language: str = "language") -> DataFrame:
    """Dropped languages with their row counts; null counts as unknown."""
    return df.filter(~pair.is_member(F.col(language))).groupBy(language).agg(F.count("*").alias("rows"))


def filter_completed(df: DataFrame, text: str = "translation_text") -> DataFrame:
    """Rows that already have a translation."""
    return df.filter(F.col(text).isNotNull() & (F.col(text) != ""))


def drop_null_rows(df: DataFrame) -> DataFrame:
    return df.dropna("any")


def drop_blank_text(df: DataFrame, text: str = "text") -> DataFrame:
    return df.filter(~is_blank(F.col(text)))


def drop_failed(df: DataFrame, value: str = "translation") -> DataFrame:
    return df.filter(F.col(value).isNotNull())


def filter_vocabulary(words: DataFrame, stop_words: list[str], low: float = 3.0, high: float = 4.0) -> DataFrame:
    """Alphabetic words inside an open band of commonality, without stop words.

    The stop words are a fixed literal list, part of the program and not of the data.
    """
    kept = words.filter(
        F.col("word").rlike(r"^\p{L}+$") & (F.col("commonality") > low) & (F.col("commonality") < high)
    )
    return kept.filter(~F.col("word").isin(stop_words)) if stop_words else kept


def failure_report(df: DataFrame, text: str, error: str = "error") -> DataFrame:
    """Failed rows with their reason and the beginning of their text."""
    return df.filter(F.col(error).isNotNull()).withColumn("preview", F.substring(text, 1, 80)).drop(text)
