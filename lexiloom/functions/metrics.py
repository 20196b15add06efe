"""Text metrics: BLEU, chrF, chrF++, edit similarity and the hook for external scorers.

Formulas follow the published definitions (Papineni et al. 2002; Chen and Cherry 2014; Popovic 2015 and
2017; Post 2018).  A row's counts are sufficient statistics: the sentence score is arithmetic on one
row's counts, the corpus score is the same arithmetic on their sums.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.functions import ngrams
from lexiloom.functions.edits import edit_distance
from lexiloom.functions.text import normalize

log = logging.getLogger(__name__)

CHRF_BETA = 2


# --- preparation -------------------------------------------------------------------------------


def without_space(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)[\s\x1c-\x1f]+", "")


def corpus_tokens(text: Column) -> Column:
    """Raw text with punctuation split off by blanks, as in the standard newswire tokenization."""
    line = F.replace(F.replace(text, F.lit("-\n"), F.lit("")), F.lit("\n"), F.lit(" "))
    for entity, char in (("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        line = F.replace(line, F.lit(entity), F.lit(char))
    line = F.concat(F.lit(" "), line, F.lit(" "))
    # The four replacements of that tokenization.
    for pattern, replacement in (
        (r"([\{-\~\[-\` -\&\(-\+\:-\@\/])", " $1 "),
        (r"([^0-9])([\.,])", "$1 $2 "),
        (r"([\.,])([^0-9])", " $1 $2"),
        (r"([0-9])(-)", "$1 $2 "),
    ):
        line = F.regexp_replace(line, pattern, replacement)
    return line


def chrf_words(text: Column) -> Column:
    """Text for the word part of chrF++: one mark is split off a word, its last if it is one, else its first.

    A word of one character stays whole.
    """
    mark, space = r"[!-/:-@\[-`{-~]", r"\s\x1c-\x1f"
    trailing = rf"(?U)(?<=[^{space}])({mark})(?=[{space}]|$)"
    leading = rf"(?U)(?<=^|[{space}])({mark})(?=[^{space}]*[^{space}!-/:-@\[-`{{-~](?:[{space}]|$))"
    return F.regexp_replace(F.regexp_replace(text, leading, "$1 "), trailing, " $1")


# --- corpus formulas on summed counts -----------------------------------------------------------


def with_corpus_bleu(df: DataFrame, orders: int = ngrams.WORD_ORDER) -> DataFrame:
    """Add ``bleu``, ``precision_n`` and ``bp`` to rows of summed counts ``wm1.. wh1.. wr1..``.

    Orders without a match are smoothed exponentially; an order without n-grams makes the score 0.
    """
    misses, halvings = {}, F.lit(0)
    for n in range(1, orders + 1):
        halvings = halvings + F.when((F.col(f"wh{n}") > 0) & (F.col(f"wm{n}") == 0), 1).otherwise(0)
        misses[f"_missed{n}"] = halvings
    precisions = {
        f"precision_{n}": F.when(F.col(f"wh{n}") == 0, F.lit(0.0))
        .when(F.col(f"wm{n}") == 0, F.lit(100.0) / (F.pow(F.lit(2.0), F.col(f"_missed{n}")) * F.col(f"wh{n}")))
        .otherwise(F.lit(100.0) * F.col(f"wm{n}") / F.col(f"wh{n}"))
        for n in range(1, orders + 1)
    }
    penalty = (
        F.when(F.col("wh1") >= F.col("wr1"), F.lit(1.0))
        .when(F.col("wh1") > 0, F.exp(F.lit(1.0) - F.col("wr1") / F.col("wh1")))
        .otherwise(F.lit(0.0))
    )
    staged = df.withColumns(misses).withColumns(precisions | {"bp": penalty})
    mean_log = sum((F.log(F.col(f"precision_{n}")) for n in range(1, orders + 1)), F.lit(0.0)) / orders
    matched = sum((F.col(f"wm{n}") for n in range(2, orders + 1)), F.col("wm1")) > 0
    score = F.when(matched & (F.col(f"wh{orders}") > 0), F.col("bp") * F.exp(mean_log)).otherwise(F.lit(0.0))
    return staged.withColumn("bleu", score).drop(*misses)


def with_corpus_chrf(df: DataFrame, orders: int = ngrams.CHAR_ORDER) -> DataFrame:
    """Add ``chrf``: precision and recall averaged over the orders both sides have, then F-beta."""
    precision, recall, counted = F.lit(0.0), F.lit(0.0), F.lit(0)
    for n in range(1, orders + 1):
        match, hyp, ref = F.col(f"cm{n}"), F.col(f"ch{n}"), F.col(f"cr{n}")
        both = (hyp > 0) & (ref > 0)
        precision = precision + F.when(both, match / hyp).otherwise(F.lit(0.0))
        recall = recall + F.when(both, match / ref).otherwise(F.lit(0.0))
        counted = counted + F.when(both, 1).otherwise(0)
    staged = df.withColumns({"_p": precision, "_r": recall, "_n": F.greatest(counted, F.lit(1))})
    staged = staged.withColumns({"_p": F.col("_p") / F.col("_n"), "_r": F.col("_r") / F.col("_n")})
    factor = float(CHRF_BETA**2)
    score = F.lit(100.0 * (1 + factor)) * F.col("_p") * F.col("_r") / (factor * F.col("_p") + F.col("_r"))
    return staged.withColumn(
        "chrf", F.when(F.col("_p") + F.col("_r") > 0, score).otherwise(F.lit(0.0))
    ).drop("_p", "_r", "_n")


# --- metrics on rows ----------------------------------------------------------------------------


class Metric:
    """A named score of (source, hypothesis, reference) columns."""

    name: str = ""
    needs_source = False

    def score(self, source: Column, hypothesis: Column, reference: Column) -> Column:
        raise NotImplementedError

    def scores_in_task(self) -> Callable[[list[str], list[str]], np.ndarray] | None:
        """The same score for texts inside a task, from hypotheses and references, where there is such a form."""
        return None


class SentenceBleu(Metric):
    """BLEU of normalized hypothesis against normalized reference."""

    def __init__(self, max_order: int = 4):
        self.max_order = max_order
        self.name = f"BLEU-{max_order}"

    def score(self, source, hypothesis, reference):
        max_order = self.max_order

        @F.pandas_udf("double")
        def bleu(hyp: pd.Series, ref: pd.Series) -> pd.Series:
            return pd.Series(ngrams.bleu_scores(hyp, ref, max_order))

        return bleu(normalize(hypothesis), normalize(reference))


class Chrf(Metric):
    """chrF, or chrF++ with ``word_order=2``; ``lowercase`` switches the whole normalization."""

    def __init__(self, word_order: int = 0, lowercase: bool = True):
        self.word_order = word_order
        self.lowercase = lowercase
        self.name = f"chrF++{word_order}" if word_order else "chrF"

    def score(self, source, hypothesis, reference):
        word_order = self.word_order
        if self.lowercase:
            hypothesis, reference = normalize(hypothesis), normalize(reference)

        @F.pandas_udf("double")
        def chrf(hyp: pd.Series, ref: pd.Series) -> pd.Series:
            return pd.Series(ngrams.chrf_scores(hyp, ref))

        @F.pandas_udf("double")
        def chrf_words_too(hyp: pd.Series, ref: pd.Series, hw: pd.Series, rw: pd.Series) -> pd.Series:
            return pd.Series(ngrams.chrf_word_scores(hyp, ref, hw, rw, word_order))

        if word_order == 0:
            return chrf(without_space(hypothesis), without_space(reference))
        return chrf_words_too(
            without_space(hypothesis), without_space(reference), chrf_words(hypothesis), chrf_words(reference)
        )

    def scores_in_task(self):
        return ngrams.bare_chrf_scores if self.word_order == 0 and self.lowercase else None


class EditSimilarity(Metric):
    """``1 - distance / longer length`` on code points, 1 when both texts are empty."""

    name = "EditDistance"

    def score(self, source, hypothesis, reference):
        return edit_similarity(reference, hypothesis)


class ExternalScorer(Metric):
    """A quality model: ``make`` opens it once per task, and it is called per Arrow batch.

    Rows without hypothesis or reference do not reach it; a batch on which it fails scores 0.
    """

    needs_source = True

    def __init__(self, name: str, make: Callable[[], Callable[[pd.Series, pd.Series, pd.Series], pd.Series]]):
        self.name = name
        self._make = make

    def score(self, source, hypothesis, reference):
        make, name = self._make, self.name

        @F.pandas_udf("double")
        def run(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
            scorer = make()
            for src, hyp, ref in batches:
                out = pd.Series(0.0, index=hyp.index)
                there = hyp.notna() & ref.notna()
                if there.any():
                    try:
                        out[there] = scorer(src[there], hyp[there], ref[there]).astype("float64").fillna(0.0)
                    except Exception:
                        log.warning("%s failed on %d rows", name, int(there.sum()), exc_info=True)
                yield out

        return run.asNondeterministic()(source, hypothesis, reference)


def add_metrics(
    df: DataFrame, metrics: dict[str, Metric], source: str, hypothesis: str, reference: str
) -> DataFrame:
    """Add one score column per metric; a row without hypothesis or reference, or a failed score, gets 0."""
    present = F.col(hypothesis).isNotNull() & F.col(reference).isNotNull()
    src = F.coalesce(F.col(source), F.lit(""))
    blank = [src, *(F.coalesce(F.col(c), F.lit("")) for c in (hypothesis, reference))]
    masked = [src, *(F.when(present, F.col(c)) for c in (hypothesis, reference))]  # models skip nulls
    scored = df.withColumns({column: metric.score(*(masked if metric.needs_source else blank)) for column, metric in metrics.items()})
    return scored.withColumns(
        {c: F.when(present, F.coalesce(F.col(c), F.lit(0.0))).otherwise(F.lit(0.0)) for c in metrics}
    )


def corpus_scores(
    df: DataFrame,
    hypothesis: str,
    reference: str,
    group_by: list[str] | None = None,
    counted_if: dict[str, Column] | None = None,
) -> DataFrame:
    """Corpus BLEU and chrF on raw text, per group or over all rows; ``counted_if`` counts rows in the same pass.

    Rows are reduced to counts first, and those are plain sums with map-side partial aggregation: a
    group holding a third of all rows still sends one row per task through the shuffle.
    """
    hyp, ref = F.col(hypothesis), F.col(reference)
    flags = counted_if or {}
    counted = df.select(
        *(group_by or []),
        *[condition.alias(name) for name, condition in flags.items()],
        ngrams.word_stats(corpus_tokens(hyp), corpus_tokens(ref)).alias("words"),
        ngrams.char_stats(without_space(hyp), without_space(ref)).alias("chars"),
    ).select(*(group_by or []), *flags, "words.*", "chars.*")
    sums = [F.sum(f"w{kind}{n}").alias(f"w{kind}{n}") for kind in "mhr" for n in range(1, ngrams.WORD_ORDER + 1)]
    for n in range(1, ngrams.CHAR_ORDER + 1):
        # A hypothesis' n-grams count only where the reference of the row has n-grams of that order.
        sums.append(F.sum(F.when(F.col(f"cr{n}") > 0, F.col(f"ch{n}")).otherwise(F.lit(0))).alias(f"ch{n}"))
        sums.append(F.sum(f"cm{n}").alias(f"cm{n}"))
        sums.append(F.sum(f"cr{n}").alias(f"cr{n}"))
    total = counted.groupBy(*(group_by or [])).agg(F.count("*").alias("num_samples"), *[F.count_if(name).alias(name) for name in flags], *sums)
    scored = with_corpus_chrf(with_corpus_bleu(total))
    return scored.select(
        *(group_by or []),
        "num_samples",
        "bleu",
        *[f"precision_{n}" for n in range(1, ngrams.WORD_ORDER + 1)],
        "bp",
        F.col("wh1").alias("sys_len"),
        F.col("wr1").alias("ref_len"),
        "chrf",
        *flags,
    )


def edit_similarity(a: Column, b: Column) -> Column:
    longer = F.greatest(F.char_length(a), F.char_length(b))
    return F.when(longer == 0, F.lit(1.0)).otherwise(F.lit(1.0) - edit_distance(a, b) / longer)
