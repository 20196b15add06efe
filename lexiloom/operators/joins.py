"""Resume, lookup and membership joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.operators.filters import filter_completed
from lexiloom.operators.skew import salted_join

INDEX = "_original_index"
UNTRANSLATED = "[UNTRANSLATED: "


def pending_rows(df: DataFrame, saved: DataFrame, key: str = INDEX, retry_failed: bool = True) -> DataFrame:
    """Rows that still have to be processed.

    With ``retry_failed`` only rows saved with a translation count as done; otherwise any saved row does.
    The key is unique on the left, so the join is balanced.
    """
    done = filter_completed(saved) if retry_failed else saved
    return df.join(done.select(key), key, "left_anti")


def resume_documents(docs: DataFrame, saved: DataFrame, key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """``(still to do, already there)``; saved rows that could not be read are done again."""
    readable = saved.filter(F.col("_corrupt_record").isNull()).drop("_corrupt_record") if (
        "_corrupt_record" in saved.columns
    ) else saved
    todo = docs.join(readable.select(key), key, "left_anti")
    there = readable.join(docs.select(key), key, "left_semi")
    return todo, there


def leftover_seeds(
    seeds: DataFrame, results: DataFrame, threshold: float, key: str = "doc_id", score: str = "comet_score"
) -> DataFrame:
    """Seed documents without a single sentence at or above the threshold.

    Results are reduced to one row per document before the join.
    """
    good = results.filter(F.col(score) >= threshold).select(key).distinct()
    return seeds.join(good, key, "left_anti")


def opposite_translation(
    df: DataFrame, position: str, out: str = "opposite_translation", reverse: str = "->"
) -> DataFrame:
    """For each row the translation of the first row of the other direction whose source is my target.

    The first row per (direction, source) is an aggregate with map-side combining.  The join splits target
    texts that are repeated in very many rows, and only those.
    """
    first = (
        df.groupBy("direction", "source")
        .agg(F.min_by("translation", position).alias(out))
        .withColumns({"_back": _reversed("direction", reverse), "_target": F.col("source")})
        .select("_back", "_target", out)
    )
    keyed = df.withColumns({"_back": F.col("direction"), "_target": F.col("target")})
    return salted_join(keyed, first, ["_back", "_target"], [position], "left").drop("_back", "_target")


def _reversed(direction: str, mark: str):
    parts = F.split(direction, mark)
    return F.concat(parts[1], F.lit(mark), parts[0])


def map_sentences(sentences: DataFrame, translated: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Translation of each sentence by its text; the last duplicate wins, a miss is marked.

    ``translated`` has ``doc, sentence_index, sentence, translation``.  The key holds the document, so a
    group is at most one document's repetitions.
    """
    last = translated.groupBy(doc, "sentence").agg(F.max_by("translation", "sentence_index").alias("_found"))
    joined = sentences.join(last, [doc, "sentence"], "left")
    return joined.withColumn(
        "translation",
        F.coalesce(F.col("_found"), F.concat(F.lit(UNTRANSLATED), F.col("sentence"), F.lit("]"))),
    ).drop("_found")


def attach_results(df: DataFrame, results: DataFrame, key: str = INDEX) -> DataFrame:
    """Results back at their rows by key; rows without a result keep nulls."""
    return df.join(results, key, "left")


def member_rows(df: DataFrame, members: DataFrame, key: str, spread: list[str]) -> DataFrame:
    """Rows whose key is in a table of keys."""
    return salted_join(df, members.select(key).distinct(), [key], spread, "left_semi")
