"""Table translation: filter, resume, chunk, translate, append."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.functions.languages import DEFAULT_PAIR, LanguagePair
from lexiloom.functions.prompts import TRANSLATE_SYSTEM, render
from lexiloom.functions.results import check_languages
from lexiloom.functions.text import DEFAULT_MAX_WORDS, join_parts, with_chunks
from lexiloom.operators.filters import failure_report, filter_known_language
from lexiloom.operators.joins import INDEX, pending_rows
from lexiloom.providers import Provider, RetryPolicy, call_model
from lexiloom.operators.selection import length_batches
from lexiloom.providers.calls import call_batches, call_model_on_parts
from lexiloom.sources.committed import BATCHES, CommittedTable, append_as_completed

NO_TEXT = "no text"


def pair_system(pair: LanguagePair, language: Column, template: str = TRANSLATE_SYSTEM) -> Column:
    """System prompt from the row's language into the other one of the pair."""
    return render(template, src_lang=pair.name(language), tgt_lang=pair.name(pair.target(language)))


def translate(
    df: DataFrame,
    provider: Provider,
    source: str,
    target: str,
    model_name: str,
    text: str = "text",
    template: str = TRANSLATE_SYSTEM,
    temperature: float = 0.0,
    max_tokens: int | None = None,
    policy: RetryPolicy = RetryPolicy(),
) -> DataFrame:
    """Translate one text column in one direction: adds ``translation, error, attempts``."""
    check_languages(source, target)
    system = render(template, src_lang=source, tgt_lang=target)
    call = call_model(provider, F.col(text), system, model_name, temperature, max_tokens, policy)
    called = df.withColumn("_call", call)
    return called.withColumns(
        {
            "translation": F.col("_call.value"),
            "error": F.col("_call.error"),
            "attempts": F.col("_call.attempts"),
        }
    ).drop("_call")


def translate_table(
    df: DataFrame,
    provider: Provider,
    model_name: str,
    pair: LanguagePair = DEFAULT_PAIR,
    text: str = "text",
    language: str = "language",
    saved: DataFrame | None = None,
    max_words: int = DEFAULT_MAX_WORDS,
    max_tokens: int | None = None,
    policy: RetryPolicy = RetryPolicy(),
) -> DataFrame:
    """Rows of both directions translated in one plan; the direction is a column, not a pass.

    Filter and resume come before the model.  Chunks of a long text stay in their row, so nothing is
    shuffled to put them together.  Failed rows keep their error and a null translation; a row without a text
    is one of them and costs no call.
    """
    known = filter_known_language(df, pair, language)
    todo = known if saved is None else pending_rows(known, saved)
    call = call_model_on_parts(
        provider,
        F.col("_chunks"),
        pair_system(pair, F.col(language)),
        model_name,
        0.0,
        max_tokens,
        policy,
    )
    called = with_chunks(todo, text, "_chunks", max_words).withColumn("_call", call).drop("_chunks")
    error = F.when(F.col(text).isNull(), F.lit(NO_TEXT)).otherwise(F.col("_call.error"))
    return called.withColumns(
        {
            "translation_text": F.when(error.isNull(), join_parts(F.col("_call.values"))),
            "model_name": F.lit(model_name),
            "error": error,
            "attempts": F.col("_call.attempts"),
        }
    ).drop("_call")


def run_translate_table(
    df: DataFrame,
    output: str,
    provider: Provider,
    model_name: str,
    text: str = "text",
    batches: int = BATCHES,
    **options,
) -> tuple[DataFrame, DataFrame]:
    """Resumable job: translate what the output lacks and append it; ``(everything saved, failures of this run)``.

    Rows go through the model in ``batches`` parts by key, and each part is committed as soon as it is done, so a run that
    is lost costs one part and the next run takes up the rest.  Failed rows are written beside the others and
    taken up again.  A key that is saved is not appended again, whatever its translation, so a run can be repeated.
    """
    table = CommittedTable(df.sparkSession, output)
    before = table.read()
    saved = None if before is None else before.filter(F.col("error").isNull())
    known = filter_known_language(df, options.get("pair", DEFAULT_PAIR), options.get("language", "language"))
    todo = known if saved is None else pending_rows(known, saved)

    def answer(part: DataFrame) -> DataFrame:
        done = translate_table(part, provider, model_name, text=text, **options)
        if saved is None:
            return done
        there = saved.select(F.col(INDEX).alias("_saved")).distinct()
        marked = done.join(there, done[INDEX] == there["_saved"], "left")
        return marked.filter(F.col("_saved").isNull() | F.col("error").isNotNull()).drop("_saved")

    run = append_as_completed(todo, table, answer, INDEX, batches)
    return table.read().filter(F.col("error").isNull()).drop("error"), failure_report(table.read(run), text)


def with_index(df: DataFrame, order: list[Column]) -> DataFrame:
    """Add the row identity a resumed run relies on: the row's place in a fixed total order."""
    from lexiloom.operators.skew import with_positions

    return with_positions(df, order, INDEX)


def batch_translate(
    df: DataFrame,
    provider: Provider,
    model_name: str,
    pair: LanguagePair,
    text: str = "text",
    language: str = "language",
    key: str = INDEX,
    batch_size: int = 32,
    max_new_tokens: int = 512,
    padded: int = 1 << 16,
    policy: RetryPolicy = RetryPolicy(),
) -> DataFrame:
    """Batch inference: the model gets batches of one language and similar length, with one cap for a batch.

    A batch has at most ``batch_size`` rows, and fewer where they would exceed ``padded`` characters when padded to the
    longest of them.  The cap on new tokens is twice the longest text of the batch, ``max_new_tokens`` at most.  A batch
    is one row on its way to the model, so batches, not texts, are dealt to tasks, long ones among short ones.

    Adds ``batch_id`` and ``batch_part`` (numbers within the language), ``max_tokens``, ``translation_text``, ``error`` and
    ``model_name``.
    """
    known = filter_known_language(df, pair, language)
    length = F.coalesce(F.char_length(text), F.lit(0))
    batched = length_batches(known, batch_size, length, key, language, padded)
    cap = F.least(F.lit(max_new_tokens), F.col("batch_longest") * 2).cast("long")
    row = F.struct(*[c for c in df.columns if c not in (language, text)], F.col(text).alias("_text"))
    batches = batched.groupBy(language, "batch_id", "batch_part").agg(
        F.first(cap).alias("max_tokens"), F.collect_list(row).alias("_rows")
    )
    system = pair_system(pair, F.col(language))
    texts = F.transform("_rows", lambda r: r["_text"])
    call = call_batches(provider, texts, system, model_name, F.col("max_tokens"), policy)
    called = batches.withColumn("_calls", call).select(
        language, "batch_id", "batch_part", "max_tokens", F.inline(F.arrays_zip("_rows", "_calls"))
    )
    rest = [F.col(f"_rows.{c}") for c in df.columns if c not in (language, text)]
    return called.select(
        *rest, F.col("_rows._text").alias(text), language, "batch_id", "batch_part", "max_tokens",
        F.col("_calls.value").alias("translation_text"), F.col("_calls.error").alias("error"),
        F.lit(model_name).alias("model_name"),
    )
