"""Evaluating translations: per row, per direction and over the corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.functions.metrics import Chrf, Metric, SentenceBleu, add_metrics, corpus_scores
from lexiloom.functions.responses import is_error
from lexiloom.functions.results import rename_and_require
from lexiloom.operators.aggregates import metric_summary
from lexiloom.operators.combine import expand_directions
from lexiloom.operators.joins import opposite_translation

RENAMES = {"source_text": "source", "reference": "target"}
REQUIRED = ["direction", "source", "target", "translation"]


def default_metrics() -> dict[str, Metric]:
    return {"bleu": SentenceBleu(4), "chrf": Chrf(word_order=2)}


def evaluate_rows(
    df: DataFrame, metrics: dict[str, Metric] | None = None, external: Metric | None = None, position: str | None = None
) -> DataFrame:
    """Metric columns for a table of (direction, source, target, translation).

    Reference metrics compare the translation with the target.  An external scorer sees (source,
    translation, opposite translation) and only rows that have an opposite translation; others get 0.
    """
    table = rename_and_require(df, RENAMES, REQUIRED)
    scored = add_metrics(table, metrics or default_metrics(), "source", "translation", "target")
    if external is None:
        return scored
    if position is None:
        raise ValueError("the lookup of opposite translations needs a position column")
    looked_up = opposite_translation(scored, position)
    return add_metrics(looked_up, {"comet": external}, "source", "translation", "opposite_translation")


def evaluate_table(
    df: DataFrame, metrics: dict[str, Metric] | None = None, external: Metric | None = None, position: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """``(scored rows, summary over all rows and per direction)``, with the external score where there is a scorer.

    The scored rows come from Python workers; write them once if both results are needed.
    """
    chosen = metrics or default_metrics()
    scored = evaluate_rows(df, chosen, external, position)
    return scored, metric_summary(scored, [*chosen, *(["comet"] if external is not None else [])])


def bidirectional_report(df: DataFrame) -> DataFrame:
    """Corpus BLEU and chrF with sample and error counts per direction, all from one aggregate."""
    scores = corpus_scores(df, "translation", "target", ["direction"], {"num_errors": is_error(F.col("translation"))})
    return scores.withColumn("error_rate", F.col("num_errors") / F.col("num_samples"))


def directed_pairs(df: DataFrame, first: str, second: str, names: tuple[str, str]) -> DataFrame:
    return expand_directions(df, first, second, names)
