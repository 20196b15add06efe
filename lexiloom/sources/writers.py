"""Sinks.  A table is written as a directory of part files; no sink writes one file per row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.functions.results import SENTENCE_RESULT_COLUMNS
from lexiloom.operators.aggregates import corpus_length_stats
from lexiloom.operators.ordering import split_train_dev

CSV_OPTIONS = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
BUCKETS = 64
# Texts are written several times over in these files, so they shrink to a part; a file is then one task.
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
ROWS = 10_000  # of documents in a packed file, at most


def save_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    if fmt == "csv":
        df.write.mode(mode).options(**CSV_OPTIONS).csv(path)
    elif fmt in ("parquet", "json"):
        df.write.mode(mode).format(fmt).save(path)
    else:
        raise ValueError(f"Unknown format: {fmt!r}")


def laid_out(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows in a fixed column layout; a column they lack is an empty string."""
    return df.select(*[F.col(c) if c in df.columns else F.lit("").alias(c) for c in columns])


def append_results(df: DataFrame, path: str, columns: list[str], fmt: str = "parquet") -> None:
    """Append rows in a fixed column layout, as one write job that commits whole part files.

    ``committed.append_as_completed`` appends in batches that count one by one.
    """
    save_table(laid_out(df, columns), path, fmt, "append")


def write_seeds(docs: DataFrame, path: str) -> DataFrame:
    """Seed documents as a table, and their length profile."""
    docs.write.mode("overwrite").parquet(path)
    return corpus_length_stats(docs.sparkSession.read.parquet(path))


def write_results(df: DataFrame, path: str, doc: str = "doc_id", buckets: int = BUCKETS) -> None:
    """Sentence results as tab-separated files below ``bucket=`` folders of their document.

    Rebalancing gathers a bucket's rows into few files and splits a bucket that is too large for one task.
    """
    bucketed = df.select(
        F.pmod(F.xxhash64(doc), F.lit(buckets)).alias("bucket"), doc, *SENTENCE_RESULT_COLUMNS
    )
    bucketed.hint("rebalance", "bucket").write.mode("overwrite").options(**CSV_OPTIONS, **PACKED).option("sep", "\t").partitionBy("bucket").csv(path)


def write_documents(docs: DataFrame, path: str) -> None:
    docs.write.mode("overwrite").parquet(path)


def write_row_json(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").options(**PACKED, maxRecordsPerFile=ROWS).json(path)


def aggregate_row_json(rows: DataFrame, path: str) -> None:
    """All saved rows merged in order of their id: range-sorted part files, not one file."""
    rows.orderBy("row_id").write.mode("overwrite").options(**PACKED, maxRecordsPerFile=ROWS).json(path)


def write_report(metrics: DataFrame, translations: DataFrame, path: str) -> None:
    """Metric rows and (source, translation, reference) lines as JSON."""
    metrics.select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite").text(f"{path}/metrics")
    keys = [c for c in translations.columns if c not in ("source", "translation", "target")]
    lines = translations.select(*keys, "source", "translation", F.col("target").alias("reference"))
    lines.hint("rebalance", "direction").write.mode("overwrite").partitionBy("direction").json(f"{path}/translations")


def write_directions(df: DataFrame, path: str) -> None:
    """One folder per direction; ``->`` becomes ``-`` in its name."""
    named = df.withColumn("direction", F.replace("direction", F.lit("->"), F.lit("-")))
    named.hint("rebalance", "direction").write.mode("overwrite").options(**CSV_OPTIONS).partitionBy("direction").csv(path)


def publish_splits(
    df: DataFrame, path: str, keys: list[str], dev_share: float = 0.001, seed: int = 42
) -> None:
    split = split_train_dev(df, keys, dev_share, seed).hint("rebalance", "split")
    split.write.mode("overwrite").partitionBy("split").parquet(path)
