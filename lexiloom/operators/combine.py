"""Unions and row generators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.functions.text import split_sentences


def union_aligned(tables: list[DataFrame]) -> DataFrame:
    """All rows of all tables; columns a table lacks become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def union_directions(tables: dict[str, DataFrame]) -> DataFrame:
    return union_aligned([df.withColumn("direction", F.lit(direction)) for direction, df in tables.items()])


def align_languages(
    df: DataFrame, languages: list[str], source: str = "src_lang", target: str = "tgt_lang"
) -> DataFrame:
    """One column per language: the original in the source's column, the translation in the target's.

    Decided per row, so tables with several directions are aligned as well.
    """
    columns = {
        name: F.when(F.col(source) == name, F.col("original_sentence")).when(
            F.col(target) == name, F.col("forward_translation")
        )
        for name in languages
    }
    return df.select(
        *[value.alias(name) for name, value in columns.items()],
        F.col("comet_score").alias("score"),
        "temperature",
        source,
        target,
    )


def dedup_words(words: DataFrame) -> DataFrame:
    """One row per word, the first in order of commonality."""
    rest = [c for c in words.columns if c != "word"]
    kept = words.groupBy("word").agg(F.min(F.struct("commonality", *[c for c in rest if c != "commonality"])).alias("_w"))
    return kept.select("word", "_w.*")


def explode_sentences(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per sentence with its 0-based index."""
    return explode_parts(docs, split_sentences(F.col(text)), ("sentence_index", "sentence"), [text])


def explode_parts(df: DataFrame, parts: Column, names: tuple[str, str], drop: list[str]) -> DataFrame:
    """One row per element of an array, with its 0-based index.

    The outer form keeps the optimizer from adding a filter on the array's size, which would be pushed
    down and compute the array twice; rows without elements are dropped after the fact.
    """
    others = [c for c in df.columns if c not in drop]
    return df.select(*others, F.posexplode_outer(parts).alias(*names)).filter(F.col(names[0]).isNotNull())


def expand_attempts(df: DataFrame, temperatures: tuple[float, ...]) -> DataFrame:
    """One row per temperature of the grid; the grid is literal, so 0.3 is 0.3."""
    grid = F.array(*[F.lit(t) for t in temperatures])
    return df.select("*", F.posexplode(grid).alias("attempt", "temperature"))


def expand_directions(df: DataFrame, first: str, second: str, names: tuple[str, str]) -> DataFrame:
    """Every aligned pair as two directed rows."""
    others = [c for c in df.columns if c not in (first, second)]
    a, b = names

    def directed(name: str, source: str, target: str) -> Column:
        return F.struct(F.lit(name).alias("direction"), F.col(source).alias("source"), F.col(target).alias("target"))

    both = F.array(directed(f"{a}->{b}", first, second), directed(f"{b}->{a}", second, first))
    return df.select(*others, F.inline(both))
