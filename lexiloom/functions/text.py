"""Sentence, word and chunk expressions over text columns.  All of them stay inside the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# These patterns decide where sentences begin and must not change.
SENTENCE_BOUNDARY = r"(?Ud)(?<!\w\.\w.)(?<![A-Z][a-z]\.)(?<=\.|\?|\!)\s+"
# Fixed value: a sentence is counted where any character is followed, later in its line, by terminators.
# Written without lazy steps: one character, the rest up to a terminator, the terminators.
SENTENCE_RUN = r"[^\n][^.!?\n]*+[.!?]++"
ASCII_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
DEFAULT_MAX_WORDS = 500

_PUNCTUATION = r"[!-/:-@\[-`{-~]+"
# Whitespace as Python's str.split and str.strip see it: Unicode White_Space plus the four separators.
_SPACE = r"(?U)[\s\x1c-\x1f]+"
_OPEN_END = r"(?<![^.!?\n])[^.!?\n]++(?=\n|\z)"
_EDGE_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def strip(text: Column) -> Column:
    """Remove leading and trailing Unicode whitespace (``trim`` only removes blanks)."""
    return F.regexp_replace(text, _EDGE_SPACE, "")


def is_blank(text: Column) -> Column:
    return text.isNull() | (strip(text) == "")


def split_words(text: Column) -> Column:
    """Whitespace-separated words; an empty array for blank text."""
    return F.filter(F.split(text, _SPACE, -1), lambda word: word != "")


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used, also inside lambdas."""
    return F.transform(F.array(value), use)[0]


def word_count(text: Column) -> Column:
    return F.size(split_words(text))


def sentence_count(text: Column) -> Column:
    """Number of runs that end in sentence punctuation.

    Not the size of ``split_sentences``: text after the last terminator is not counted here.  Such open
    ends are cut off first; a search that starts in one would run to its end at every character.
    """
    closed = F.regexp_replace(text, _OPEN_END, "")
    return F.regexp_count(closed, F.lit(SENTENCE_RUN))


def split_sentences(text: Column) -> Column:
    """Sentences of a text, trimmed, blanks dropped."""
    pieces = F.transform(F.split(text, SENTENCE_BOUNDARY, -1), strip)
    return F.filter(pieces, lambda piece: piece != "")


def normalize(text: Column) -> Column:
    """Lower-case and delete ASCII punctuation."""
    return F.regexp_replace(F.lower(text), _PUNCTUATION, "")


def with_chunks(df: DataFrame, text: str, out: str, max_words: int = DEFAULT_MAX_WORDS) -> DataFrame:
    """Add an array of chunks of a long text, cut at sentence ends, each of at least ``max_words`` words.

    A text of at most ``max_words`` words is its only chunk, untouched.  A longer one is cut after the
    first word ending in ``. ! ?`` once the open chunk holds ``max_words`` words; the rest stays as the
    last chunk.  The fold walks positions of terminators only, so its state is a few integers however
    long the text is.  Words and bounds are columns of their own, so each is computed once per row.
    """
    words, bounds = F.col("_words"), F.col("_bounds")
    ends = F.filter(
        F.transform(words, lambda word, i: F.when(_ends_sentence(word), i + 1)),
        lambda end: end.isNotNull(),
    )
    cuts = F.aggregate(
        ends,
        F.array(F.lit(0)),
        lambda taken, end: F.when(
            end - F.element_at(taken, -1) >= max_words, F.concat(taken, F.array(end))
        ).otherwise(taken),
    )
    chunks = F.transform(
        F.slice(bounds, F.lit(1), F.size(bounds) - 1),
        lambda start, i: F.array_join(F.slice(words, start + 1, F.element_at(bounds, i + 2) - start), " "),
    )
    return (
        df.withColumn("_words", split_words(F.col(text)))
        .withColumn("_bounds", F.array_distinct(F.concat(cuts, F.array(F.size(words)))))
        .withColumn(out, F.when(F.size(words) <= max_words, F.array(text)).otherwise(chunks))
        .drop("_words", "_bounds")
    )


def _ends_sentence(word: Column) -> Column:
    return word.endswith(".") | word.endswith("!") | word.endswith("?")


def join_parts(parts: Column) -> Column:
    """Parts of a text put back together with one blank between them."""
    return F.array_join(parts, " ")


def preview(text: Column, length: int = 80) -> Column:
    return F.substring(text, 1, length)
