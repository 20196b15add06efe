"""Picking one row per group, gating groups, numbering rows and batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiloom.operators.skew import salted_join, with_positions
from lexiloom.providers.calls import EARLY_STOP, MIN_THRESHOLD
from lexiloom.session import written


def best_of_attempts(
    df: DataFrame, keys: list[str], score: str = "comet_score", attempt: str = "attempt"
) -> DataFrame:
    """Highest score per key; a null score ranks below all, the earliest attempt wins a tie.

    An aggregate instead of a ranking window: the attempts of a sentence are neighbours in one task, so
    map-side combining leaves one row per sentence to shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(F.coalesce(F.col(score), F.lit(-1.0)), -F.col(attempt))
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("_best"))
    return best.select(*keys, "_best.*")


def early_stop_select(
    df: DataFrame,
    keys: list[str],
    score: str = "score",
    attempt: str = "attempt",
    early_stop: float = EARLY_STOP,
    min_threshold: float = MIN_THRESHOLD,
) -> DataFrame:
    """First attempt that reaches ``early_stop``, else the best one from ``min_threshold`` on.

    Adds ``status``: accepted_early_stop, accepted or discarded (then the attempt's columns are null).
    """
    rest = [c for c in df.columns if c not in keys]
    value, order = F.col(score), F.col(attempt)
    picked = df.groupBy(*keys).agg(
        F.min_by(F.struct(*rest), F.when(value >= early_stop, order)).alias("_early"),
        F.max_by(F.struct(*rest), F.when(value > 0, F.struct(value, -order))).alias("_best"),
    )
    early, best = F.col("_early").isNotNull(), F.col(f"_best.{score}") >= min_threshold
    chosen = F.when(early, F.col("_early")).when(best, F.col("_best"))
    status = F.when(early, F.lit("accepted_early_stop")).when(best, F.lit("accepted")).otherwise(F.lit("discarded"))
    return picked.select(*keys, chosen.alias("_chosen"), status.alias("status")).select(*keys, "_chosen.*", "status")


def split_accepted(df: DataFrame, status: str = "status") -> tuple[DataFrame, DataFrame]:
    """``(accepted, discarded)`` rows of one selection."""
    accepted = F.col(status).startswith("accepted")
    return df.filter(accepted), df.filter(~accepted)


def file_gate(
    df: DataFrame, threshold: float, spread: list[str], file: str = "source_file", score: str = "comet_score"
) -> DataFrame:
    """Rows at or above the threshold, only from files whose mean lies strictly above it.

    The means combine map-side and are stored with the number of rows of each file, which tells which files the
    join has to split: one that holds a third of all rows is neither one window group nor one join partition.
    """
    good = F.count_if(F.col(score) >= threshold).alias("_rows")
    means = written(df.groupBy(file).agg(F.avg(score).alias("_mean"), good), "file_means")
    kept = means.filter(F.col("_mean") > threshold).select(file, "_rows")
    return salted_join(df.filter(F.col(score) >= threshold), kept, [file], spread, "left_semi", "_rows")


def first_match(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First row per key in the given order."""
    rest = [c for c in df.columns if c not in keys]
    first = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_first"))
    return first.select(*keys, "_first.*")


def attempt_indices(words: DataFrame, attempts: int, order: list[Column]) -> DataFrame:
    """One row per word and attempt, ``index = rank of the word * attempts + attempt``."""
    ranked = with_positions(words, order, "_rank")
    expanded = ranked.withColumn("attempt", F.explode(F.sequence(F.lit(0), F.lit(attempts - 1))))
    return expanded.withColumn("index", F.col("_rank") * attempts + F.col("attempt")).drop("_rank")


def length_batches(
    df: DataFrame, batch_size: int, length: Column, tie: str, language: str = "language", padded: int | None = None
) -> DataFrame:
    """Number the batches of ``batch_size`` rows of similar length within each language.

    One global order by (language, length, tie) serves all languages; a language's batches start at its
    first position.  The starts are one row per language; the join splits languages that hold too many rows.

    With ``padded``, a batch whose rows, all padded to its longest, exceed that many characters is cut in parts of equal
    numbers of rows that do not, down to one row: ``batch_part`` numbers them, and ``batch_longest`` is the longest
    text of a part.
    """
    measured = df.withColumn("_length", length)
    numbered = with_positions(measured, [F.col(language), F.col("_length"), F.col(tie)], "_position")
    starts = numbered.groupBy(language).agg(F.min("_position").alias("_start"), F.count("*").alias("_rows"))
    joined = salted_join(numbered, written(starts, "batch_starts"), [language], [tie], size="_rows")
    place = F.col("_position") - F.col("_start")
    batched = joined.withColumn("batch_id", F.floor(place / batch_size))
    if padded is not None:
        batch = Window.partitionBy(language, "batch_id")  # at most batch_size rows
        part = Window.partitionBy(language, "batch_id", "batch_part")
        longest = F.greatest(F.max("_length").over(batch), F.lit(1))
        rows = F.greatest(F.floor(F.lit(padded) / longest), F.lit(1))
        batched = batched.withColumn("batch_part", F.floor((place % batch_size) / rows)).withColumn(
            "batch_longest", F.max("_length").over(part)
        )
    return batched.drop("_position", "_start", "_length", "_rows")
