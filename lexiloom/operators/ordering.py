"""Orders, documents put together, samples and splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.functions.text import word_count
from lexiloom.operators.joins import INDEX


def shortest_first(df: DataFrame, text: str = "text", key: str = INDEX) -> DataFrame:
    """Short texts first, by an existing ``word_count`` column where there is one."""
    if "word_count" in df.columns:
        return df.orderBy("word_count", key)
    return df.withColumn("_words", word_count(F.col(text))).orderBy("_words", key).drop("_words")


def restore_order(df: DataFrame, key: str = INDEX) -> DataFrame:
    return df.orderBy(key)


def by_file_name(df: DataFrame, name: str = "file_name") -> DataFrame:
    """Lexicographic: row_10 comes before row_2."""
    return df.orderBy(name)


def order_vocabulary(words: DataFrame) -> DataFrame:
    return words.orderBy("commonality", "word")


def reconstruct_documents(
    df: DataFrame, doc: str = "doc_id", index: str = "sentence_index", text: str = "forward_translation"
) -> DataFrame:
    """A document's sentences in order, joined by one blank.

    A group is the sentences of one document, which were one row before they were taken apart.
    """
    parts = F.sort_array(F.collect_list(F.struct(F.col(index).alias("i"), F.col(text).alias("t"))))
    return df.groupBy(doc).agg(F.array_join(F.transform(parts, lambda p: p["t"]), " ").alias("reconstructed_text"))


def first_n(df: DataFrame, n: int, order: list[Column]) -> DataFrame:
    """The first ``n`` rows of an order: every task keeps its own first ``n``, and one merges them.

    For a share of a large table rather than a number of rows, use ``split_train_dev``.
    """
    return df.orderBy(*order).limit(n)


def shuffle_key(keys: list[str], seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))


def sample_n(df: DataFrame, n: int, keys: list[str], seed: int = 42) -> DataFrame:
    """``n`` rows in the order of a hash of their keys; all rows where there are fewer.

    The sample does not depend on how the input is partitioned.
    """
    keyed = df.withColumn("_draw", shuffle_key(keys, seed))
    return first_n(keyed, n, [F.col("_draw"), *[F.col(k) for k in keys]]).drop("_draw")


def split_train_dev(df: DataFrame, keys: list[str], dev_share: float = 0.001, seed: int = 42) -> DataFrame:
    """Add ``split``: a share of about ``dev_share`` goes to dev by the hash of the keys.

    Stable when the input grows or is repartitioned, and needs no shuffle.
    """
    draw = F.conv(F.substring(shuffle_key(keys, seed), 1, 8), 16, 10).cast("long")
    limit = int(dev_share * 2**32)
    return df.withColumn("split", F.when(draw < limit, F.lit("dev")).otherwise(F.lit("train")))
