"""Word datasets: prompt chains over a vocabulary, judged and kept with their errors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.functions import prompts
from lexiloom.functions.responses import parse_judge
from lexiloom.functions.results import flatten_result
from lexiloom.providers import Provider, RetryPolicy, Step, call_chain, call_model


def sentence_chain(source: str = "English", target: str = "Kinyarwanda") -> list[Step]:
    """Word, descriptor, sentence, substitution, both translations."""
    return [
        Step("descriptive_word", prompts.DESCRIBE_SYSTEM, "{word}", {"word": "word"}, 0.7),
        Step("original_sentence", prompts.SENTENCE_SYSTEM, "{word}", {"word": "word"}, 0.7),
        Step(
            "substituted_sentence",
            prompts.SUBSTITUTE_SYSTEM,
            prompts.SUBSTITUTE_TEXT,
            {"sentence": "original_sentence", "word": "word", "replacement": "descriptive_word"},
            0.7,
        ),
        Step(
            "translated_descriptive_word",
            _directed(prompts.TRANSLATE_SYSTEM, source, target),
            "{term}",
            {"term": "descriptive_word"},
        ),
        Step(
            "translated_substituted_sentence",
            _directed(prompts.ANCHORED_SYSTEM, source, target),
            "{sentence}",
            {
                "term": "descriptive_word",
                "term_translation": "translated_descriptive_word",
                "sentence": "substituted_sentence",
            },
        ),
    ]


def judge_chain(source: str = "English", target: str = "Kinyarwanda") -> list[Step]:
    """Judge's answers on both translations."""
    system = _directed(prompts.JUDGE_SYSTEM, source, target)
    return [
        Step("word_judgement", system, prompts.JUDGE_TEXT, {"source": "descriptive_word", "translation": "translated_descriptive_word"}, 0.7),
        Step(
            "sentence_judgement",
            system,
            prompts.JUDGE_TEXT,
            {"source": "substituted_sentence", "translation": "translated_substituted_sentence"},
            0.7,
        ),
    ]


def simple_chain(source: str = "English", target: str = "Kinyarwanda") -> list[Step]:
    """Word, simple sentence, translation."""
    return [
        Step("sentence", prompts.SIMPLE_SENTENCE_SYSTEM, "{word}", {"word": "word"}, 0.7),
        Step(
            "translation",
            _directed(prompts.WORD_IN_CONTEXT_SYSTEM, source, target),
            "{sentence}",
            {"sentence": "sentence", "word": "word"},
        ),
    ]


def _directed(template: str, source: str, target: str) -> str:
    return template.replace("{src_lang}", source).replace("{tgt_lang}", target)


def run_chain(
    df: DataFrame, steps: list[Step], provider: Provider, model_name: str, policy: RetryPolicy = RetryPolicy()
) -> DataFrame:
    """Run the steps in order: a column per step, and ``error`` with the first failure of the row."""
    made = {step.out for step in steps}
    needed = sorted({name for step in steps for name in step.slots.values()} - made)
    inputs = {name: F.coalesce(F.col(name), F.lit("")) for name in needed}
    chained = df.withColumn("_chain", call_chain(provider, inputs, steps, model_name, policy))
    return chained.select(*df.columns, "_chain.*")


def judge(
    df: DataFrame,
    provider: Provider,
    model_name: str,
    source: str,
    translation: str,
    out: str = "judgement",
    languages: tuple[str, str] = ("English", "Kinyarwanda"),
    policy: RetryPolicy = RetryPolicy(),
) -> DataFrame:
    """Add a struct ``score, label, reasoning, error`` of a model's rating of each translation."""
    call = call_model(
        provider,
        prompts.render(prompts.JUDGE_TEXT, source=F.col(source), translation=F.col(translation)),
        F.lit(_directed(prompts.JUDGE_SYSTEM, *languages)),
        model_name,
        policy=policy,
    )
    return df.withColumn("_call", call).withColumn(out, parse_judge(F.col("_call.value"))).drop("_call")


def word_dataset(
    attempts: DataFrame,
    provider: Provider,
    model_name: str,
    saved: DataFrame | None = None,
    retry_failed: bool = False,
    policy: RetryPolicy = RetryPolicy(),
    tasks: int | None = None,
) -> DataFrame:
    """Rows of the word dataset for ``index, word`` attempts that are not saved yet.

    By default any saved row counts as done, failed ones too; ``retry_failed`` takes those up again.
    The rows are short and their model calls long, so they are spread over ``tasks`` tasks (the session's
    parallelism by default) whatever their size in bytes.
    """
    if saved is not None:
        done = saved.filter(F.col("error") == "") if retry_failed else saved
        attempts = attempts.join(done.select("index"), "index", "left_anti")
    attempts = attempts.repartition(tasks or attempts.sparkSession.sparkContext.defaultParallelism)
    chained = run_chain(attempts, sentence_chain() + judge_chain(), provider, model_name, policy)
    judged = chained.withColumns(
        {"_word": parse_judge(F.col("word_judgement")), "_sentence": parse_judge(F.col("sentence_judgement"))}
    )
    error = F.coalesce("error", "_word.error", "_sentence.error")
    result = F.struct(
        "word",
        "descriptive_word",
        "original_sentence",
        "substituted_sentence",
        "translated_descriptive_word",
        "translated_substituted_sentence",
        F.col("_word.score").alias("word_score"),
        F.col("_sentence.score").alias("sentence_score"),
    )
    return judged.select(F.col("index"), F.col("word"), result.alias("_result"), error.alias("_error")).select(
        *flatten_result(F.col("index"), F.col("word"), F.col("_result"), F.col("_error"))
    )
