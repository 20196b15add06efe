"""Back-translation and the document jobs built on it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.functions.metrics import Metric, add_metrics
from lexiloom.functions.prompts import TRANSLATE_SYSTEM, fill, render
from lexiloom.functions.results import check_languages
from lexiloom.operators.aggregates import document_metadata
from lexiloom.operators.combine import expand_attempts, explode_sentences
from lexiloom.operators.joins import UNTRANSLATED, resume_documents
from lexiloom.operators.ordering import reconstruct_documents
from lexiloom.operators.selection import best_of_attempts
from lexiloom.providers import Provider, RetryPolicy, call_round_trip, passes, try_attempt, try_attempts
from lexiloom.providers.calls import DIGITS, EARLY_STOP, MIN_THRESHOLD, TEMPERATURES, Gate
from lexiloom.session import dealt, table_exists, written


def back_translate(
    df: DataFrame,
    provider: Provider,
    source: str,
    intermediate: str,
    model_name: str,
    metrics: dict[str, Metric],
    text: str = "text",
    temperature: str | float = 0.0,
    template: str = TRANSLATE_SYSTEM,
    policy: RetryPolicy = RetryPolicy(),
) -> DataFrame:
    """There and back, then every metric of the round trip against the original and their mean.

    Adds ``forward, back, error``, the metric columns and ``overall_score``.
    """
    check_languages(source, intermediate)
    degree = F.col(temperature) if isinstance(temperature, str) else temperature
    there = render(template, src_lang=source, tgt_lang=intermediate)
    home = render(template, src_lang=intermediate, tgt_lang=source)
    trip = call_round_trip(provider, F.col(text), there, home, model_name, degree, policy)
    named = df.withColumn("_trip", trip).select(*df.columns, "_trip.*")
    scored = add_metrics(named, metrics, "forward", "back", text)
    total = sum((F.col(m) for m in metrics), F.lit(0.0))
    return scored.withColumn("overall_score", total / len(metrics) if metrics else F.lit(None).cast("double"))


def document_attempts(
    docs: DataFrame,
    provider: Provider,
    source: str,
    intermediate: str,
    model_name: str,
    metric: Metric,
    temperatures: tuple[float, ...] = (1.0,),
    gate: Gate | None = None,
    policy: RetryPolicy = RetryPolicy(),
) -> DataFrame:
    """Best attempt per sentence in the layout of the sentence result table.

    ``gate`` tells which translations are in the target language.  Sentences without a single successful attempt that
    passes are missing.  Sentences are dealt to tasks once.  Where the metric can score in the task, a sentence's attempts
    are made, gated, scored and compared in one visit to Python, and only the best one leaves it; the selection then
    sees one row a sentence.  Other metrics get a row for every attempt.
    """
    check_languages(source, intermediate)
    sentences = explode_sentences(docs.select("doc_id", "text")).withColumnRenamed("sentence", "original_sentence")
    sentences = dealt(sentences, "doc_id", "sentence_index")
    scores = metric.scores_in_task()
    if scores is None:
        done = _all_attempts(sentences, provider, source, intermediate, model_name, metric, temperatures, gate, policy)
    else:
        there = fill(TRANSLATE_SYSTEM, {"src_lang": source, "tgt_lang": intermediate})
        home = fill(TRANSLATE_SYSTEM, {"src_lang": intermediate, "tgt_lang": source})
        attempt = try_attempts(
            provider, F.col("original_sentence"), there, home, model_name, temperatures, scores, gate, policy
        )
        tried = sentences.withColumn("_try", attempt).filter(F.col("_try.attempt").isNotNull())
        done = tried.select("*", "_try.*").drop("_try").withColumnRenamed("score", "comet_score")
    best = best_of_attempts(done, ["doc_id", "sentence_index"])
    return best.select(
        "doc_id",
        "sentence_index",
        "original_sentence",
        F.col("forward").alias("forward_translation"),
        F.col("back").alias("back_translation"),
        "comet_score",
        "temperature",
    )


def _all_attempts(
    sentences: DataFrame,
    provider: Provider,
    source: str,
    intermediate: str,
    model_name: str,
    metric: Metric,
    temperatures: tuple[float, ...],
    gate: Gate | None,
    policy: RetryPolicy,
) -> DataFrame:
    """Every good attempt that passes the gate as a row with its ``comet_score``."""
    done = back_translate(
        expand_attempts(sentences, temperatures),
        provider,
        source,
        intermediate,
        model_name,
        {"comet_score": metric},
        text="original_sentence",
        temperature="temperature",
        policy=policy,
    ).filter(F.col("error").isNull())
    if gate is not None:
        done = done.filter(passes(gate, F.col("forward")))
    return done.withColumn("comet_score", F.round("comet_score", DIGITS))


def synth_sentences(
    sentences: DataFrame,
    provider: Provider,
    source: str,
    target: str,
    model_name: str,
    sentence: str = "sentence",
    temperatures: tuple[float, ...] = TEMPERATURES,
    early_stop: float = EARLY_STOP,
    min_threshold: float = MIN_THRESHOLD,
    gate: Gate | None = None,
    policy: RetryPolicy = RetryPolicy(),
) -> DataFrame:
    """Temperature sweep in rounds over the sentences that are still open.

    Every round translates its sentences there and back at one temperature.  One that reaches ``early_stop`` (chrF of
    the round trip) is finished and leaves; the others go on with the best attempt so far, the first where scores are
    equal.  What is open after the last round is accepted from ``min_threshold`` on.  ``gate`` tells which
    translations are in the target language; other attempts count for nothing.

    A round is written to the shared folder before the next one reads its open sentences, so a lost executor costs work
    of one round, and calls are dealt evenly to tasks again as the open set shrinks.

    Adds ``translation, backtranslation, score, temperature, status``; without an accepted attempt the first four
    are null.
    """
    names = ("translation", "backtranslation", "score", "temperature")
    there = fill(TRANSLATE_SYSTEM, {"src_lang": source, "tgt_lang": target})
    home = fill(TRANSLATE_SYSTEM, {"src_lang": target, "tgt_lang": source})
    text, number = F.lit(None).cast("string"), F.lit(None).cast("double")
    best = F.struct(*[(text if n < 2 else number).alias(name) for n, name in enumerate(names)])
    open_ = sentences.select(F.struct(*sentences.columns).alias("_row"), best.alias("_best"))
    finished = []
    for temperature in temperatures:
        tried = dealt(open_, "_row").withColumn(
            "_try", try_attempt(provider, F.col(f"_row.{sentence}"), there, home, model_name, temperature, gate, policy)
        )
        score, so_far = F.col("_try.score"), F.coalesce(F.col("_best.score"), F.lit(0.0))
        usable = score.isNotNull() & ~F.isnan(score)
        stopped = usable & (score >= early_stop)
        attempt = F.struct("_try.forward", "_try.back", "_try.score", F.lit(temperature).alias("t"))
        better = usable & ((score >= early_stop) | (score > so_far))
        round_ = tried.select(
            "_row",
            F.when(better, attempt.cast(_BEST)).otherwise(F.col("_best")).alias("_best"),
            F.coalesce(stopped, F.lit(False)).alias("_stopped"),
        )
        done = written(round_, "sweep_round")
        finished.append(done.filter("_stopped"))
        open_ = done.filter("NOT _stopped").drop("_stopped")
        if open_.isEmpty():
            break
    rest = open_.withColumn("_stopped", F.lit(False))
    swept = reduce(DataFrame.unionByName, finished, rest)
    accepted = F.col("_stopped") | (F.coalesce(F.col("_best.score"), F.lit(0.0)) >= min_threshold) & (F.col("_best.score") > 0)
    status = F.when(F.col("_stopped"), "accepted_early_stop").when(accepted, "accepted").otherwise("discarded")
    return swept.select("_row.*", *[F.when(accepted, F.col(f"_best.{n}")).alias(n) for n in names], status.alias("status"))


_BEST = "struct<translation: string, backtranslation: string, score: double, temperature: double>"


def synth_documents(sentences: DataFrame) -> DataFrame:
    """Documents from swept sentences: reconstructed text and counts, discarded sentences marked."""
    shown = sentences.withColumn(
        "_shown",
        F.coalesce(F.col("translation"), F.concat(F.lit(UNTRANSLATED), F.col("sentence"), F.lit("]"))),
    )
    texts = reconstruct_documents(shown, text="_shown")
    return texts.join(document_metadata(sentences), "doc_id")


def run_document_job(docs: DataFrame, saved: DataFrame | None, results_path: str, **sweep) -> DataFrame:
    """Resumable document job: already saved documents are reloaded, the others are made.

    The swept sentences are written once; both the documents and later reports read that table.  Documents whose
    sentences are in it are not swept again, so a run that lost its documents can be repeated.  A document
    without a sentence has an empty text and zero counts.
    """
    spark = docs.sparkSession
    todo, there = (docs, None) if saved is None else resume_documents(docs, saved)
    missing = todo.select("doc_id", "text")
    if table_exists(spark, results_path):
        missing = missing.join(spark.read.parquet(results_path).select("doc_id").distinct(), "doc_id", "left_anti")
    synth_sentences(explode_sentences(missing), **sweep).write.mode("append").parquet(results_path)
    made = synth_documents(spark.read.parquet(results_path).join(todo.select("doc_id"), "doc_id", "left_semi"))
    made = todo.select("doc_id").join(made, "doc_id", "left").fillna("", ["reconstructed_text"])
    made = made.fillna(0, [c for c in made.columns if c not in ("doc_id", "reconstructed_text")])
    return made if there is None else made.unionByName(there, allowMissingColumns=True)
