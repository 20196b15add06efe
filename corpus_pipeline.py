"""Documents to token ids: quality rules, line dedup, near-dedup, a mix of sources, byte-level BPE.

Each stage takes all rows its predecessor kept.  All but the last return the columns of ``documents``, with
``n_chars`` following the text.

* quality_rules: lines that fail go, documents that are rejected go.
* line_dedup: lines with an earlier copy go; a document that loses all its lines that way goes.
* minhash_dedup: one document of each component stays, the one with the smallest id.
* source_mix: the words the mix takes, one row per document and pass; documents it does not reach go.
* byte_bpe: token ids, with digests of the ids and of the decoded bytes.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.llm import byte_bpe, line_dedup, line_rules, lsh_forest, mixing
from lexiloom.llm.queries import public_ranks
from lexiloom.llm.registry import table
from lexiloom.llm.scratch import stored
from lexiloom.session import ship_package


def _counted(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of the input, with ``n_chars`` after the text where there is such a column."""
    if "n_chars" in columns:
        df = df.withColumn("n_chars", F.length("text").cast(df.schema["n_chars"].dataType))
    return df.select(*(F.col(f"`{c}`") for c in columns))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(line_rules.clean(docs), docs.columns)


def remove_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_all")
    lines = line_dedup.deduplicate(docs.select("doc_id", "text", row))
    left = lines.filter((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines")))
    changed = F.when(F.col("n_removed") > 0, F.col("dedup_text")).otherwise(F.col("text"))
    return _counted(left.select(F.col("_all").withField("text", changed).alias("_all")).select("_all.*"), docs.columns)


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    verdict = lsh_forest.near_duplicates(docs.select("doc_id", "text"), width=5, percent=80)
    gone = verdict.filter(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(mixing.Mix(docs).documents(), docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ranks, pattern = public_ranks()
    kept = [c for c in ("doc_id", "lang", "source", "text") if c in docs.columns]
    return byte_bpe.encode(docs.select(*kept), ranks, pattern, digests=True).drop("text")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _shipped(stage: Stage) -> Stage:
    """The stage, with the package sent to the executors first."""

    @wraps(stage)
    def start(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return stage(spark, docs, sf_dir)

    return start


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", _shipped(quality_rules)),
    ("line_dedup", _shipped(remove_lines)),
    ("minhash_dedup", _shipped(minhash_dedup)),
    ("source_mix", _shipped(source_mix)),
    ("byte_bpe", _shipped(encode)),
]

# Stages 3 to 5 (components, a pseudorandom mix, BPE) have no SQL form; tests/llm holds a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
