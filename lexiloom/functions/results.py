"""Shaping nested results into flat rows, metric lookup, argument checks."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.functions.text import is_blank

# Column order of the word dataset and of the sentence result table.
WORD_DATASET_COLUMNS = (
    "index",
    "word",
    "english_sentence",
    "kinyarwanda_word_translation",
    "kinyarwanda_sentence_translation",
    "substituted_word",
    "substituted_sentence",
    "kinyarwanda_word_score",
    "kinyarwanda_sentence_score",
    "full_output",
    "error",
)
SENTENCE_RESULT_COLUMNS = (
    "sentence_index",
    "original_sentence",
    "forward_translation",
    "back_translation",
    "comet_score",
    "temperature",
)


def metric_by_name(metrics: Column, name: str) -> Column:
    """Score of the first metric called ``name`` in an array of ``struct(name, score)``, else null."""
    return F.try_element_at(F.filter(metrics, lambda m: m["name"] == name), F.lit(1))["score"]


def overall_mean(metrics: Column) -> Column:
    """Plain mean of the scores; metrics on different scales are mixed as they are."""
    total = F.aggregate(metrics, F.lit(0.0), lambda acc, m: acc + m["score"])
    return F.when(F.size(metrics) > 0, total / F.size(metrics))


def overall_mean_scaled(metrics: Column, scales: dict[str, float]) -> Column:
    """Mean after dividing each score by the full scale of its metric (1 where none is given)."""
    entries = [F.lit(v) for item in scales.items() for v in item]
    scale = F.create_map(*entries)
    scaled = F.aggregate(
        metrics,
        F.lit(0.0),
        lambda acc, m: acc + m["score"] / F.coalesce(F.try_element_at(scale, m["name"]), F.lit(1.0)),
    )
    return F.when(F.size(metrics) > 0, scaled / F.size(metrics))


def flatten_result(index: Column, word: Column, result: Column, error: Column) -> list[Column]:
    """Columns of one word-dataset row.  A failed row keeps its index, word and error, the rest blank."""
    ok = error.isNull()

    def text(value: Column) -> Column:
        return F.when(ok, F.coalesce(value, F.lit(""))).otherwise(F.lit(""))

    values = (
        index,
        word,
        text(result["original_sentence"]),
        text(result["translated_descriptive_word"]),
        text(result["translated_substituted_sentence"]),
        text(result["descriptive_word"]),
        text(result["substituted_sentence"]),
        F.when(ok, result["word_score"]),
        F.when(ok, result["sentence_score"]),
        F.when(ok, F.to_json(result)).otherwise(F.lit("")),
        F.coalesce(error, F.lit("")),
    )
    return [value.alias(name) for value, name in zip(values, WORD_DATASET_COLUMNS)]


def rename_and_require(df: DataFrame, renames: dict[str, str], required: list[str]) -> DataFrame:
    """Rename known alternative column names, then insist on the required ones."""
    present = {old: new for old, new in renames.items() if old in df.columns and new not in df.columns}
    renamed = df.withColumnsRenamed(present)
    missing = [name for name in required if name not in renamed.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return renamed


def check_temperature(temperature: float) -> float:
    if not 0.0 <= temperature <= 2.0:
        raise ValueError(f"temperature must lie between 0 and 2, got {temperature}")
    return temperature


def check_languages(source: str, target: str) -> None:
    if source == target:
        raise ValueError("source and target language must differ")


def row_problem(
    word: Column | None = None,
    temperature: Column | None = None,
    source: Column | None = None,
    target: Column | None = None,
) -> Column:
    """Reason why a row cannot be processed, null where it can; bad rows are routed, not raised."""
    problem = F.lit(None).cast("string")
    checks = []
    if word is not None:
        checks.append((word.isNull() | is_blank(word), "blank word"))
    if temperature is not None:
        checks.append((temperature.isNull() | ~temperature.between(0.0, 2.0), "temperature out of range"))
    if source is not None and target is not None:
        checks.append((source == target, "same source and target language"))
    for bad, reason in reversed(checks):
        problem = F.when(bad, F.lit(reason)).otherwise(problem)
    return problem


def run_metadata(df: DataFrame, run_id: str, provider: str, started: datetime | None = None) -> DataFrame:
    """Tag rows with the run that made them and, where its start is given, with the milliseconds since then."""
    columns = {
        "run_id": F.lit(run_id),
        "provider": F.lit(provider),
        "created_at": F.current_timestamp(),
    }
    if started is not None:
        columns["duration_ms"] = F.unix_millis(F.current_timestamp()) - F.lit(round(started.timestamp() * 1000))
    return df.withColumns(columns)
