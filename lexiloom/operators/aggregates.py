"""Score, length and job statistics.  Every aggregate combines map-side before its shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.session import written

from lexiloom.functions.responses import is_error
from lexiloom.functions.text import sentence_count, word_count

# Bounds of the score buckets; the last one includes its upper bound.
BUCKETS = ((0.0, 0.2), (0.2, 0.4), (0.4, 0.6), (0.6, 0.8), (0.8, 1.0))


def file_score_stats(df: DataFrame, file: str = "source_file", score: str = "comet_score") -> DataFrame:
    """Mean, count, minimum and maximum per file; files without a valid score are left out."""
    stats = df.groupBy(F.col(file).alias("file")).agg(
        F.avg(score).alias("average_score"),
        F.count(score).alias("num_scores"),
        F.min(score).alias("min_score"),
        F.max(score).alias("max_score"),
    )
    return stats.filter(F.col("num_scores") > 0)


def files_without_scores(df: DataFrame, file: str = "source_file", score: str = "comet_score") -> DataFrame:
    """Files that are skipped: no valid score in any of their rows."""
    return (
        df.groupBy(F.col(file).alias("file"))
        .agg(F.count("*").alias("rows"), F.count(score).alias("num_scores"))
        .filter(F.col("num_scores") == 0)
        .drop("num_scores")
    )


def overall_score_stats(
    df: DataFrame, threshold: float, file: str = "source_file", score: str = "comet_score"
) -> DataFrame:
    value = F.col(score)
    scored = df.filter(value.isNotNull())
    totals = scored.agg(
        F.avg(value).alias("overall_average"),
        F.min(value).alias("overall_min"),
        F.max(value).alias("overall_max"),
        F.stddev_samp(value).alias("std_dev"),
        F.count(value).alias("total_scores"),
        F.countDistinct(file).alias("files_processed"),
        F.count_if(value >= threshold).alias("scores_above_threshold"),
        F.count_if(value < threshold).alias("scores_below_threshold"),
    )
    return totals.withColumns(
        {
            "above_pct": _percent("scores_above_threshold", "total_scores"),
            "below_pct": _percent("scores_below_threshold", "total_scores"),
        }
    )


def _percent(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.col(part) * 100.0 / F.col(whole)).otherwise(F.lit(0.0))


def score_histogram(df: DataFrame, score: str = "comet_score") -> DataFrame:
    """Rows per score bucket; scores outside [0, 1] count in the total but in no bucket."""
    value = F.col(score)
    counts = [F.count(value).alias("total")]
    for low, high in BUCKETS:
        inside = (value >= low) & ((value <= high) if high == 1.0 else (value < high))
        counts.append(F.count_if(inside).alias(f"{low:.1f}-{high:.1f}"))
    wide = df.agg(*counts)
    names = [f"{low:.1f}-{high:.1f}" for low, high in BUCKETS]
    rows = wide.select(
        "total",
        F.explode(F.array(*[F.struct(F.lit(n).alias("bucket"), F.col(f"`{n}`").alias("scores")) for n in names])).alias("b"),
    )
    return rows.select("b.bucket", "b.scores", _share(F.col("b.scores"), F.col("total")).alias("pct"))


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part * 100.0 / whole).otherwise(F.lit(0.0))


def threshold_summary(df: DataFrame, threshold: float, score: str = "comet_score") -> DataFrame:
    counts = df.agg(
        F.count("*").alias("total_rows"), F.count_if(F.col(score) >= threshold).alias("rows_above")
    ).withColumn("rows_below", F.col("total_rows") - F.col("rows_above"))
    return counts.withColumns(
        {"pct_above": _percent("rows_above", "total_rows"), "pct_below": _percent("rows_below", "total_rows")}
    )


def sample_stats(sample: DataFrame, score: str = "comet_score") -> DataFrame:
    """Mean, minimum, maximum and exact median of a sample; its size bounds the median's memory."""
    return sample.agg(
        F.avg(score).alias("mean"), F.min(score).alias("min"), F.max(score).alias("max"), F.median(score).alias("median")
    )


def metric_summary(df: DataFrame, metrics: list[str], by: str = "direction") -> DataFrame:
    """Mean, deviation, minimum and maximum per metric, per direction and for all rows.

    ``overall`` tells the row of all rows from that of rows without a direction; both have a null one.
    """
    parts = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    overall = (F.grouping(by) == 1).alias("overall")
    wide = df.rollup(by).agg(overall, *[fn(m).alias(f"{m}_{part}") for m in metrics for part, fn in parts.items()])
    rows = [
        F.struct(F.lit(m).alias("metric"), *[F.col(f"{m}_{part}").alias(part) for part in parts]) for m in metrics
    ]
    return wide.select(by, "overall", F.explode(F.array(*rows)).alias("s")).select(by, "overall", "s.*")


def direction_summary(df: DataFrame, metrics: list[str], by: str = "direction") -> DataFrame:
    aggregates = [F.count("*").alias("examples")]
    for metric in metrics:
        aggregates += [F.avg(metric).alias(f"{metric}_mean"), F.stddev_samp(metric).alias(f"{metric}_std")]
    return df.groupBy(by).agg(*aggregates)


def error_rate(df: DataFrame, text: str = "translation") -> DataFrame:
    counts = df.agg(F.count("*").alias("num_samples"), F.count_if(is_error(F.col(text))).alias("num_errors"))
    return counts.withColumn(
        "error_rate",
        F.when(F.col("num_samples") > 0, F.col("num_errors") / F.col("num_samples")).otherwise(F.lit(0.0)),
    )


def corpus_length_stats(df: DataFrame, text: str = "text") -> DataFrame:
    measured = df.select(word_count(F.col(text)).alias("words"), sentence_count(F.col(text)).alias("sentences"))
    return measured.agg(
        *[
            fn(column).alias(f"{name}_{column}")
            for column in ("words", "sentences")
            for name, fn in (("mean", F.avg), ("min", F.min), ("max", F.max))
        ]
    )


def document_metadata(df: DataFrame, doc: str = "doc_id", score: str = "score", status: str = "status") -> DataFrame:
    """Per document: sentences in all, translated and discarded, success rate and mean score."""
    accepted = F.coalesce(F.col(status).startswith("accepted"), F.lit(False))
    counts = df.groupBy(doc).agg(
        F.count("*").alias("total_sentences"),
        F.count_if(accepted).alias("translated_sentences"),
        F.coalesce(F.avg(F.when(accepted, F.col(score))), F.lit(0.0)).alias("avg_score"),
    )
    return counts.withColumns(
        {
            "discarded_sentences": F.col("total_sentences") - F.col("translated_sentences"),
            "success_rate": _percent("translated_sentences", "total_sentences"),
        }
    )


def document_score_stats(df: DataFrame, doc: str = "doc_id", score: str = "comet_score") -> DataFrame:
    """Per document: sentences, mean, minimum and maximum score; null scores do not count."""
    return df.groupBy(doc).agg(
        F.count("*").alias("sentences"),
        F.avg(score).alias("avg_score"),
        F.min(score).alias("min_score"),
        F.max(score).alias("max_score"),
        F.when(F.count(score) > 0, F.lit("success")).otherwise(F.lit("failed")).alias("status"),
    )


def job_summary(documents: DataFrame) -> DataFrame:
    """Documents and sentences by status, and the mean of the document means."""
    return documents.groupBy("status").agg(
        F.count("*").alias("documents"),
        F.sum("sentences").alias("sentences"),
        F.avg("avg_score").alias("mean_of_means"),
    )


def word_failures(df: DataFrame, attempts: int, word: str = "word", error: str = "error") -> DataFrame:
    """Failed attempts per word, with a flag for words that failed every time."""
    failed = F.count_if(F.col(error).isNotNull() & (F.col(error) != ""))
    counts = df.groupBy(word).agg(failed.alias("failures"))
    return counts.filter(F.col("failures") > 0).withColumn("all_failed", F.col("failures") == attempts)


def processing_stats(df: DataFrame, name: str) -> DataFrame:
    """Processed files in name order, each with the total.

    The names stay rows; a single sorted list of all names would have to fit into one task.  They are made distinct
    once and stored, for their number and for the listing.
    """
    names = written(df.select(name).distinct(), "processed_names")
    return names.withColumn("total_processed", F.lit(names.count())).orderBy(name)


def distinct_values(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*columns).distinct()
