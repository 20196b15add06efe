"""Line-first cleaning of documents, in SQL functions only.

Every line is judged by itself: punctuation (a short line without an end mark), navigation (separators between
few words), boilerplate (rights, licence and site phrases), markup debris (runs of symbols) and shouting (no
small letter).  Failing lines go; a document that loses too much text with them, or that fails the base
measures (too few words, too many words in repeated 3-word windows), is rejected.

Repeated windows are found inside the row by sorting 64-bit hashes of the windows, so there is no shuffle and
no group that could grow hot.

Defined results: null text has no words and is rejected for its length; blank lines are kept where they are
and count for nothing; columns of the input that have the name of an output column are replaced by it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.words import GAP, WORD, words

BOILERPLATE = (
    r"all rights reserved|licensed under|is licensed|terms of (use|service)|privacy policy|cookie policy|"
    r"use cookies|enable javascript|copyright \(c\)|©|sign up|subscribe to|click here|read more|share this|"
    r"follow us|powered by|skip to content"
)
END_MARK = r"[.!?…:;\"'”’»)\]][\x20\x09-\x0D]*\z"
SEPARATOR = r"(\A|[\x20\x09-\x0D])[|>»•·]"
SYMBOLS = r"[#*$%&<>{}=~^\\]{2,}"
SMALL = r"[a-zß-öø-ÿ]"
CAPITAL = r"[A-ZÀ-ÖØ-Þ]"


@dataclass(frozen=True)
class Rules:
    min_words: int = 50
    max_repeat_percent: int = 50
    short_line: int = 4  # words below which a line needs an end mark
    separator_percent: int = 20  # separators per word of a navigation line
    symbol_percent: int = 20  # symbol runs per word of a debris line
    shout_capitals: int = 4  # capitals of a line without a small letter
    min_left_percent: int = 60  # characters that must be left


def line_passes(line: Column, rules: Rules = Rules()) -> Column:
    """Whether a line stays; blank lines do."""
    n = F.regexp_count(line, F.lit(WORD.pattern))
    short = (n < rules.short_line) & ~line.rlike(END_MARK)
    separators = F.regexp_count(line, F.lit(SEPARATOR))
    navigation = (separators >= 2) & (separators * 100 >= n * rules.separator_percent)
    debris = F.regexp_count(line, F.lit(SYMBOLS)) * 100 >= n * rules.symbol_percent
    shouting = ~line.rlike(SMALL) & line.rlike(f"({CAPITAL}[^a-z]*){{{rules.shout_capitals}}}")
    boilerplate = F.lower(line).rlike(BOILERPLATE)
    return ~line.rlike(r"[^\x20\x09-\x0D]") | ~(short | navigation | debris | shouting | boilerplate)


def repeated_words(windows: Column, values: Column) -> Column:
    """Words in windows whose hash is among ``values``, the hashes that occur twice or more."""
    sorted_pairs = F.sort_array(F.transform(windows, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    few = F.filter(
        F.transform(windows, lambda x, i: F.when(F.array_contains(values, x), i)), lambda i: i.isNotNull()
    )
    # Beyond a few values a lookup in a list is slow: windows are matched with the sorted values instead.
    many = F.sort_array(
        F.transform(
            F.filter(
                F.transform(
                    sorted_pairs,
                    lambda p, k: F.struct(
                        p["i"].alias("i"),
                        (
                            (k > 0) & (p["x"] == F.get(F.col("_sorted"), k - 1))
                            | F.coalesce(p["x"] == F.get(F.col("_sorted"), k + 1), F.lit(False))
                        ).alias("twice"),
                    ),
                ),
                lambda p: p["twice"],
            ),
            lambda p: p["i"],
        )
    )
    return F.when(F.size(values) == 0, F.array().cast("array<int>")).when(F.size(values) <= 64, few).otherwise(many)


def measure(df: DataFrame, text: str = "text", rules: Rules = Rules()) -> DataFrame:
    """All columns of ``df`` with the measures, ``base_failed``, ``kept`` and ``clean_text``.

    ``clean_text`` holds the lines that pass, whether or not the document is kept.
    """
    added = (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "clean_text"
    )
    rest = [c for c in df.columns if c not in added]
    content = F.coalesce(F.col("_text"), F.lit(""))
    lines = F.split(content, "\n")
    worded = F.filter(lines, lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    step = df.select(*rest, F.col(text).alias("_text")).select(
        *rest, content.alias("_text"), worded.alias("_lines"), F.transform(words(content), lambda w: F.xxhash64(w)).alias("_hashes")
    )
    windows = F.slice(
        F.transform(
            F.col("_hashes"),
            lambda x, i: F.xxhash64(x, F.get(F.col("_hashes"), i + 1), F.get(F.col("_hashes"), i + 2)),
        ),
        F.lit(1),
        F.greatest(F.size("_hashes") - 2, F.lit(0)),
    )
    kept_lines = F.filter(F.split(F.col("_text"), "\n"), lambda line: line_passes(line, rules))
    step = step.select(
        *rest,
        "_text",
        F.size("_hashes").cast("long").alias("n_words"),
        F.length(F.regexp_replace("_text", GAP, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("_text", "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        windows.alias("_windows"),
        F.array_join(kept_lines, "\n").alias("clean_text"),
    )
    step = step.select("*", F.sort_array("_windows").alias("_sorted"))
    twice = F.filter(F.col("_sorted"), lambda x, i: (i > 0) & (x == F.get(F.col("_sorted"), i - 1)))
    step = step.select("*", F.array_distinct(twice).alias("_twice"))
    step = step.select("*", repeated_words(F.col("_windows"), F.col("_twice")).alias("_at"))
    covered = F.aggregate(
        F.transform(F.col("_at"), lambda x, i: F.least(F.lit(3), F.coalesce(F.get(F.col("_at"), i + 1) - x, F.lit(3)))),
        F.lit(0).cast("long"),
        lambda total, x: total + x,
    )
    # A filter on what follows must not be pushed below this step: it would write the steps before it out in
    # full, each as often as the next one mentions it.  Filters stop at a column that depends on the row's place.
    here = F.monotonically_increasing_id() >= 0
    step = step.select("*", F.when(here, covered).alias("n_repeat_words"))
    failed = (F.col("n_words") < rules.min_words) | (
        100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words")
    )
    left = 100 * F.length("clean_text").cast("long") >= rules.min_left_percent * F.length("_text").cast("long")
    return step.withColumn("base_failed", failed).select(
        *rest, *added[:5], "base_failed", (~F.col("base_failed") & left).alias("kept"), "clean_text"
    )


def clean(df: DataFrame, text: str = "text", rules: Rules = Rules()) -> DataFrame:
    """Kept documents with the lines that pass; the columns of ``df``, in order."""
    row = F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("_row")
    measured = measure(df.select(row, F.col(text).alias("_source")), "_source", rules).filter("kept")
    return measured.select(F.col("_row").withField(text, F.col("clean_text")).alias("_row")).select("_row.*")
