"""Incremental runs over the driver tables, cut into files that arrive one after another."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexiloom.plans.translate import translate_table
from lexiloom.queries.base import INPUT, PAIR, SCORED, input_text, query, rounded, scored, table
from lexiloom.queries.jobs import CHUNKED, CIPHER
from lexiloom.queries.scalars import CHUNK_WORDS
from lexiloom.session import scratch_path
from lexiloom.streaming import jobs

INPUT_SCHEMA = "_original_index long, text string, language string, source string"


ROWS, SHORT_ROWS = 5_000, 100_000  # in a file, at most; short rows are some numbers


def _arrivals(spark, df, name: str, rows: int = ROWS) -> str:
    """A table as files of bounded size, as many as its rows make."""
    path = scratch_path(spark, name)
    df.write.option("maxRecordsPerFile", rows).parquet(path)
    return path


def _at_once(spark) -> int:
    """Files of a micro-batch: some for every core, so that a batch costs more than its planning and commits."""
    return 4 * spark.sparkContext.defaultParallelism


@query(
    "stream_translate",
    f"""WITH RECURSIVE {INPUT}, todo AS (SELECT * FROM input WHERE language IN ('en','fr')), {CHUNKED}
    SELECT _original_index, language, translation_text FROM done""",
)
def stream_translate(spark, sf_dir):
    path = _arrivals(spark, input_text(spark, sf_dir), "arrivals")
    stream = jobs.file_stream(spark, path, INPUT_SCHEMA, files_per_trigger=_at_once(spark))
    output, checkpoint = scratch_path(spark, "translated"), scratch_path(spark, "checkpoint")

    def transform(rows):
        done = translate_table(rows, CIPHER, "cipher", PAIR, max_words=CHUNK_WORDS)
        return done.select("_original_index", "language", "translation_text")

    jobs.append_stream(stream, transform, output, checkpoint).awaitTermination()
    return spark.read.parquet(output)


@query("stream_chunks", "SELECT conv_id, turn, role, length(text)::INT AS chars FROM conversations")
def stream_chunks(spark, sf_dir):
    path = _arrivals(spark, table(spark, sf_dir, "conversations"), "turns")
    schema = "conv_id long, turn long, role string, text string"
    output = scratch_path(spark, "measured")

    def handle(chunk, number):
        measured = chunk.select("conv_id", "turn", "role", F.char_length("text").alias("chars"))
        measured.write.mode("overwrite").parquet(f"{output}/chunk={number}")

    stream = jobs.file_stream(spark, path, schema, files_per_trigger=_at_once(spark))
    jobs.chunk_stream(stream, handle, scratch_path(spark, "checkpoint")).awaitTermination()
    return spark.read.parquet(output).drop("chunk")


@query(
    "stream_score_stats",
    f"""WITH {SCORED} SELECT source_file AS file, count(comet_score) AS num_scores, round(avg(comet_score),6) AS average_score,
    min(comet_score) AS min_score, max(comet_score) AS max_score FROM scored GROUP BY 1 HAVING count(comet_score) > 0""",
)
def stream_score_stats(spark, sf_dir):
    path = _arrivals(spark, scored(spark, sf_dir).select("source_file", "comet_score"), "scores", SHORT_ROWS)
    stream = jobs.file_stream(spark, path, "source_file string, comet_score double", files_per_trigger=_at_once(spark))
    output = scratch_path(spark, "stats")
    jobs.score_stats_stream(stream, output, scratch_path(spark, "checkpoint")).awaitTermination()
    return rounded(jobs.latest_stats(spark, output), "average_score")


@query("stream_resume_dedup", f"WITH {INPUT} SELECT _original_index, language, length(text)::INT AS chars FROM input")
def stream_resume_dedup(spark, sf_dir):
    """Every row arrives twice, in different files; keys are remembered for a day of event time."""
    rows = input_text(spark, sf_dir).select(
        "_original_index", "language", F.char_length("text").alias("chars"),
        F.timestamp_seconds(1_700_000_000 + F.col("_original_index") % 3600).alias("arrived"),
    )
    path = _arrivals(spark, rows.unionByName(rows), "twice", SHORT_ROWS)
    schema = "_original_index long, language string, chars int, arrived timestamp"
    stream = jobs.file_stream(spark, path, schema, files_per_trigger=_at_once(spark))
    output = scratch_path(spark, "unique")
    jobs.dedup_stream(stream, output, scratch_path(spark, "checkpoint"), event_time="arrived").awaitTermination()
    return spark.read.parquet(output).drop("arrived")
