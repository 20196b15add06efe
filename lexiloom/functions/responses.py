"""Reading what a model answered: cleaning, extraction, judge scores, error marks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexiloom.functions.text import bind, strip

# Labels a model may put in front of its answer, and how failures are marked.
ANSWER_LABEL = r"(?U)^(?:Translation|translation|Answer|answer):\s*"
ERROR_MARK = "[ERROR"
PLAIN_ERROR_MARK = "Error:"
GOOD_FROM = 4.0
ACCEPTABLE_FROM = 2.5

SERVER_SCHEMA = "response string, thinking string, done_reason string"
JUDGE_SCHEMA = "score string, fluency double, adequacy double, consistency double, reasoning string"
TRUNCATED = "output truncated at the token limit"
EMPTY = "empty translation"


def blank_to_null(text: Column) -> Column:
    return F.nullif(strip(text), F.lit(""))


def strip_label(text: Column) -> Column:
    """Drop one leading ``Translation:`` or ``Answer:`` label."""
    return F.when(
        F.regexp_like(text, F.lit(ANSWER_LABEL)), strip(F.regexp_replace(text, ANSWER_LABEL, ""))
    ).otherwise(text)


def clean_response(text: Column) -> Column:
    """Trimmed answer without label; null when there is none."""
    return blank_to_null(strip_label(strip(text)))


def extract_response(payload: Column) -> Column:
    """``struct(value, error)`` from a server's JSON answer.

    A cut-off answer is an error.  The ``response`` field wins; without it the last paragraph of the
    ``thinking`` field is taken.
    """
    data = F.from_json(payload, SERVER_SCHEMA)
    paragraphs = F.filter(
        F.transform(F.split(data["thinking"], "\n\n", -1), strip), lambda p: p != ""
    )
    answer = F.coalesce(blank_to_null(data["response"]), F.try_element_at(paragraphs, F.lit(-1)))
    truncated = F.coalesce(data["done_reason"], F.lit("stop")) == "length"
    return F.struct(
        F.when(~truncated, answer).alias("value"),
        F.when(truncated, F.lit(TRUNCATED)).when(answer.isNull(), F.lit(EMPTY)).alias("error"),
    )


def parse_judge(answer: Column) -> Column:
    """``struct(score, label, reasoning, error)`` from a judge's JSON, with or without code fences."""
    bare = strip(F.regexp_replace(answer, "```json|```", ""))
    read = lambda b: F.struct(
        F.from_json(b, JUDGE_SCHEMA, {"mode": "PERMISSIVE"}).alias("data"),
        F.json_object_keys(b).alias("keys"),
        b.endswith("}").alias("closed"),
    )
    return bind(bare, lambda b: bind(read(b), _judged))


def _judged(parsed: Column) -> Column:
    data, keys = parsed["data"], parsed["keys"]
    # A malformed document parses to a struct of nulls; an object is told from it by its keys.
    valid = keys.isNotNull() & parsed["closed"]
    # No score is 0; one that is there but is no number, null included, is an error.
    given = F.array_contains(keys, "score")
    number = data["score"].try_cast("double")
    valid = valid & (~given | number.isNotNull())
    score = F.when(valid, F.coalesce(number, F.lit(0.0)))
    return F.struct(
        score.alias("score"),
        judge_label(score).alias("label"),
        F.when(valid, strip(F.coalesce(data["reasoning"], F.lit("")))).alias("reasoning"),
        F.when(~F.coalesce(valid, F.lit(False)), F.lit("unreadable judge answer")).alias("error"),
    )


def judge_label(score: Column) -> Column:
    return (
        F.when(score >= GOOD_FROM, F.lit("good"))
        .when(score >= ACCEPTABLE_FROM, F.lit("acceptable"))
        .when(score.isNotNull(), F.lit("poor"))
    )


def is_error(text: Column) -> Column:
    """True where the text is a failure mark instead of a translation."""
    return F.coalesce(text.startswith(ERROR_MARK) | text.startswith(PLAIN_ERROR_MARK), F.lit(False))


def error_text(attempts: Column, reason: Column) -> Column:
    return F.concat(F.lit(f"{ERROR_MARK} after "), attempts.cast("string"), F.lit(" attempts: "), reason, F.lit("]"))
