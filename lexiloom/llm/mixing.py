"""Mixing sources to target weights.

Each source is one stream of words: its documents in a pseudorandom order, packed into blocks of ``block``
words.  The mix takes as many words of a source as its target says: whole passes over its blocks first, then
the blocks that a keyed permutation of the block numbers puts first, the last of them in part.  Every pass has a
permutation of its own.  Output shards draw how many slots they get of each source from a multinomial distribution
(given the totals of the sources): a slot number belongs to the shard whose share of the draw it falls in, the
permutation of its pass maps it to a block, and blocks join by index.  ``documents(shard=...)`` writes the shard of
each document (that of the first block it is taken from) and partitions by it, ``shard_counts`` gives the draw.

The multinomial draw is a tree of binomial ones, each with a generator keyed by source and node, so a task draws
only the nodes its slots lie under and agrees with all others.

Targets follow the weights; none is above ``most`` times the size of its source, and what that cuts off is
shared among the others by weight until none is above.

A source may hold most rows: its documents are numbered in hash buckets of bounded size, whose offsets come
from a running sum over bucket totals, so no task sees a whole source.  The table of sources itself (name,
size, weight) is small by nature and solved on the driver; it must stay below ``MAX_SOURCES`` rows.

Defined results: null text has no words and is never taken; a null source is one of the sources, the last; a
source without words has target 0; equal rows are documents of their own, and their slices are summed where a
result is per document; reruns agree, whatever the partitions, since rows that tie are equal rows.
"""

from __future__ import annotations

import hashlib
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiloom.llm.scratch import stored
from lexiloom.llm.words import WORD, words

BLOCK = 1024
SHARD_WORDS = 1 << 21
MAX_SOURCES = 1_000_000
BUCKET_ROWS = 4096
SEED = 7


def water_filled(sizes: list[int], weights: list[int], total: Fraction, most: int) -> list[Fraction]:
    """Targets in proportion to the weights, none above ``most`` times its size, with the given sum if it fits."""
    caps = [Fraction(most * size) for size in sizes]
    targets = [Fraction(0)] * len(sizes)
    open_, left = list(range(len(sizes))), total
    while open_ and left > 0:
        weight = sum(weights[i] for i in open_)
        share = {i: left * weights[i] / weight for i in open_}
        full = [i for i in open_ if share[i] >= caps[i]]
        if not full:
            for i in open_:
                targets[i] = share[i]
            break
        for i in full:
            targets[i] = caps[i]
            left -= caps[i]
        open_ = [i for i in open_ if i not in set(full)]
    return targets


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: Fraction = Fraction(3, 2), most: int = 2
) -> DataFrame:
    """``_source``, ``source_size``, ``target`` and ``_words`` (the target in whole words) of each source.

    ``sizes`` has one row per source (``_source``, ``source_size``); weights repeat in code point order.
    """
    rows = [(r["_source"], int(r["source_size"])) for r in sizes.limit(MAX_SOURCES + 1).collect()]
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    rows.sort(key=lambda r: (r[0] == "", r[0]))  # code points; null last
    own = [size for _, size in rows]
    targets = water_filled(own, [weights[i % len(weights)] for i in range(len(rows))], share * sum(own), most)
    table = [(n, s, float(t), min(round(t), most * s)) for (n, s), t in zip(rows, targets, strict=True)]
    schema = "_source string, source_size long, target double, _words long"
    return sizes.sparkSession.createDataFrame(table, schema)


def _key(seed: int, name: str, turn: int | str) -> int:
    digest = hashlib.blake2b(f"{seed}|{turn}|{name}".encode(), digest_size=8).digest()
    return int.from_bytes(digest, "little")


def permuted(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """Place of each index in a pseudorandom permutation of 0..n-1: a four-round network that walks in cycles."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    rounds = [np.uint64((key * (2 * r + 1) + 0x9E3779B97F4A7C15 * r) & (2**64 - 1)) for r in range(1, 5)]

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & mask
        for k in rounds:
            with np.errstate(over="ignore"):
                f = (right + k) * np.uint64(0xBF58476D1CE4E5B9)
                f ^= f >> np.uint64(29)
                f *= np.uint64(0x94D049BB133111EB)
                f ^= f >> np.uint64(32)
            left, right = right, left ^ (f & mask)
        return (left << np.uint64(half)) | right

    out = once(index.astype(np.uint64))
    while (out >= n).any():
        again = out >= n
        out[again] = once(out[again])
    return out.astype(np.int64)


def shards_of(first: int, last: int, slots: int, shards: int, seed: int, name: str) -> np.ndarray:
    """Shard of each slot from ``first`` to ``last`` - 1 of a source that has ``slots``."""
    out = np.zeros(max(last - first, 0), np.int64)
    nodes = [(0, shards, 0, slots)]  # shards from, to; slots from, number of them
    while nodes:
        low, high, at, count = nodes.pop()
        start, end = max(at, first), min(at + count, last)
        if start >= end:
            continue
        if high - low == 1:
            out[start - first : end - first] = low
            continue
        middle = (low + high) // 2
        draw = np.random.default_rng(_key(seed, name, f"{low}-{high}"))
        left = int(draw.binomial(count, (middle - low) / (high - low)))
        nodes.append((low, middle, at, left))
        nodes.append((middle, high, at + left, count - left))
    return out


def unpermuted(place: int, n: int, key: int) -> int:
    """Index whose place in the permutation is ``place``."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask, whole = (1 << half) - 1, 2**64 - 1
    rounds = [(key * (2 * r + 1) + 0x9E3779B97F4A7C15 * r) & whole for r in range(1, 5)]

    def back(x: int) -> int:
        left, right = x >> half, x & mask
        for k in reversed(rounds):
            f = ((left + k) * 0xBF58476D1CE4E5B9) & whole
            f ^= f >> 29
            f = (f * 0x94D049BB133111EB) & whole
            f ^= f >> 32
            left, right = right ^ (f & mask), left
        return (left << half) | right

    out = back(place)
    while out >= n:
        out = back(out)
    return out


def row_hash(df: DataFrame) -> Column:
    """128 bits over all columns."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    return F.struct(F.xxhash64(*columns).alias("a"), F.xxhash64(F.lit(SEED), *columns).alias("b"))


def sized(df: DataFrame, key: str, text: str, source: str) -> DataFrame:
    """``_doc``, ``_row`` (hash of all columns), ``_source`` ('' for null, else 's' and the name) and ``_size``."""
    return df.select(
        F.col(f"`{key}`").alias("_doc"),
        row_hash(df).alias("_row"),
        F.coalesce(F.concat(F.lit("s"), F.col(f"`{source}`")), F.lit("")).alias("_source"),
        F.size(words(F.col(f"`{text}`"))).cast("long").alias("_size"),
    )


def packed(rows: DataFrame) -> DataFrame:
    """Rows with words, and ``_start``: the place of their first word in the stream of their source.

    The number of buckets follows the rows of the source, so a bucket holds about ``BUCKET_ROWS`` rows.
    """
    rows = rows.filter("_size > 0").withColumn("_hash", F.xxhash64(F.lit(SEED), "_doc", "_row"))
    buckets = rows.groupBy("_source").agg(F.ceil(F.count(F.lit(1)) / BUCKET_ROWS).alias("_buckets"))
    # One row per source: bounded by MAX_SOURCES.  A shuffle by source would gather a hot one in a task.
    rows = rows.join(F.broadcast(buckets), "_source").withColumn("_bucket", F.pmod("_hash", F.col("_buckets")))
    before = Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("_source", "_bucket")
        .agg(F.sum("_size").alias("_total"))
        .select("_source", "_bucket", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"))
    )
    inside = (
        Window.partitionBy("_source", "_bucket")
        .orderBy("_hash", "_doc", "_row")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    rows = rows.withColumn("_inside", F.coalesce(F.sum("_size").over(inside), F.lit(0)))
    return rows.join(offsets, ["_source", "_bucket"]).select(
        "_doc", "_row", "_source", "_size", (F.col("_offset") + F.col("_inside")).alias("_start")
    )


def slots(targets: DataFrame, block: int = BLOCK, shard_words: int = SHARD_WORDS, seed: int = SEED) -> DataFrame:
    """Slots of the mix: ``_source``, ``_block`` (its index), ``_pass``, ``_take`` (its words), ``_shard``.

    One row of a task makes up to 65,536 slots of one pass over one source.  The slots of a source fall on the
    output shards by a multinomial draw that depends on the seed and the source alone.
    """
    step = 1 << 16
    total = targets.agg(F.coalesce(F.sum("_words"), F.lit(0)).alias("_all"))
    long = F.lit(0).cast("long")
    chunks = (
        targets.filter("_words > 0")
        .crossJoin(F.broadcast(total))  # one row
        .withColumns(
            {
                "_whole": F.floor(F.col("_words") / F.col("source_size")).cast("long"),
                "_blocks": F.ceil(F.col("source_size") / block).cast("long"),
                "_shards": F.ceil(F.col("_all") / shard_words).cast("long"),
            }
        )
        .withColumn("_pass", F.explode(F.sequence(long, F.col("_whole"))))
        .withColumn("_from", F.explode(F.sequence(long, F.col("_blocks") - 1, F.lit(step).cast("long"))))
        .select("_source", "source_size", "_words", "_whole", "_blocks", "_shards", "_pass", "_from")
    )

    def run(frames):
        for frame in frames:
            for name, *numbers in frame.itertuples(index=False):
                size, wanted, whole, blocks, shards, turn, start = map(int, numbers)
                index = np.arange(start, min(start + step, blocks), dtype=np.int64)
                # After the whole passes, slot j of the last one takes the block at place j of the permutation
                # until the rest is filled; slots after the short block of the stream begin that much earlier.
                rest, key = wanted - whole * size, _key(seed, name, whole)
                short = blocks * block - size
                at = unpermuted(blocks - 1, blocks, key)
                last = -(-rest // block)
                if at < last:
                    last = min(blocks, -(-(rest + short) // block))
                if turn < whole:
                    chosen = permuted(index, blocks, _key(seed, name, turn))
                    take = np.full(len(index), block, np.int64)
                else:
                    index = index[index < last]
                    chosen = permuted(index, blocks, key)
                    take = np.clip(rest - (index * block - np.where(index > at, short, 0)), 0, block)
                begin = turn * blocks + start
                shard = shards_of(begin, begin + len(index), whole * blocks + last, shards, seed, name)
                yield pd.DataFrame(
                    {"_source": name, "_block": chosen, "_pass": turn, "_take": take, "_shard": shard}
                ).astype({"_source": object})

    return chunks.mapInPandas(run, "_source string, _block long, _pass long, _take long, _shard long")


def slices(rows: DataFrame, chosen: DataFrame, block: int = BLOCK) -> DataFrame:
    """Word ranges of documents that the mix takes: ``_from`` to ``_to`` of each piece, with pass and shard."""
    first = F.floor(F.col("_start") / block)
    last = F.floor((F.col("_start") + F.col("_size") - 1) / block)
    pieces = rows.withColumn("_block", F.explode(F.sequence(first, last)))
    joined = pieces.join(chosen, ["_source", "_block"])
    begin = F.col("_block") * block
    low = F.greatest(begin, F.col("_start"))
    high = F.least(begin + F.col("_take"), F.col("_start") + F.col("_size"))
    return joined.select(
        "_doc", "_row", "_source", "_start", "_size", "_block", "_pass", "_shard",
        (low - F.col("_start")).alias("_from"), (high - F.col("_start")).alias("_to"),
    ).filter("_to > _from")


class Mix:
    """One mix of a table: sizes, targets and the slices taken.  The narrow row table is written once."""

    def __init__(
        self, df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
        weights: tuple[int, ...] = (3, 1, 2), share: Fraction = Fraction(3, 2), most: int = 2,
        block: int = BLOCK, seed: int = SEED, shard_words: int = SHARD_WORDS,
    ):
        self.df, self.rows = df, stored(sized(df, key, text, source), "sizes")
        sizes = self.rows.groupBy("_source").agg(F.sum("_size").alias("source_size"))
        self.targets = source_targets(sizes, weights, share, most)
        self.slots = slots(self.targets, block, shard_words, seed)
        self.slices = slices(packed(self.rows), self.slots, block)

    def shard_counts(self) -> DataFrame:
        """``_shard``, ``_source`` and ``slots``, the number of blocks that the shard drew of the source."""
        return self.slots.groupBy("_shard", "_source").agg(F.count(F.lit(1)).alias("slots"))

    def per_document(self) -> DataFrame:
        """``_doc``, ``size``, ``source_size``, ``target``, ``taken``, ``first_shard``, ``last_shard``: one row per row.

        The last two are the lowest and the highest output shard that has words of the document (null: none).
        """
        shards = [F.min("_shard").alias("first_shard"), F.max("_shard").alias("last_shard")]
        taken = self.slices.groupBy("_row", "_start").agg(F.sum(F.expr("_to - _from")).alias("n"), *shards)
        worded = packed(self.rows).join(taken, ["_row", "_start"], "left")
        every = worded.select("_doc", "_source", "_size", "n", "first_shard", "last_shard").unionByName(
            self.rows.filter("_size = 0").select("_doc", "_source", "_size"), allowMissingColumns=True
        )
        return every.join(self.targets, "_source").select(
            "_doc",
            F.col("_size").alias("size"),
            "source_size",
            "target",
            F.coalesce("n", F.lit(0)).cast("long").alias("taken"),
            "first_shard",
            "last_shard",
        )

    def documents(self, text: str = "text", shard: str | None = None) -> DataFrame:
        """The mix as documents: one row per document and pass, with the words taken, in the columns of the table.

        A document taken whole keeps its text as it is; of one taken in part, the text from the first to the
        last word of each slice is kept, and slices that do not touch are joined by a line end.  ``shard`` names
        a column for the output shard, by which the rows are then partitioned; a clashing column is replaced.
        """

        @F.pandas_udf("string")
        def cut(texts: pd.Series, lows: pd.Series, highs: pd.Series) -> pd.Series:
            return pd.Series(
                [cut_words(t, lo, hi) for t, lo, hi in zip(texts, lows, highs, strict=True)], dtype=object
            )

        taken = self.slices.groupBy("_row", "_start", "_pass").agg(
            F.sort_array(F.collect_list(F.struct("_from", "_to", "_shard"))).alias("_ranges"),
            F.sum(F.expr("_to - _from")).alias("_n"),
            F.first("_size").alias("_size"),
        )
        columns = [F.col(f"`{c}`") for c in self.df.columns]
        rows = self.df.select(F.struct(*columns).alias("_all"), row_hash(self.df).alias("_row"))
        rows = rows.dropDuplicates(["_row"])
        joined = rows.join(taken, "_row").select(
            "_all", "_ranges", (F.col("_n") == F.col("_size")).alias("_entire")
        )
        body = F.col("_all").getField(text)
        part = cut(F.when(~F.col("_entire"), body), F.col("_ranges._from"), F.col("_ranges._to"))
        new = F.when(F.col("_entire"), body).otherwise(part)
        whole = F.col("_all").withField(text, new)
        if shard is None:
            return joined.select(whole.alias("_all")).select("_all.*")
        placed = joined.select(whole.withField(shard, F.col("_ranges")[0]["_shard"]).alias("_all")).select("_all.*")
        return placed.hint("rebalance", shard)


def cut_words(text: str | None, lows, highs) -> str | None:
    if text is None:
        return None
    spans = [m.span() for m in WORD.finditer(text)]
    joined: list[list[int]] = []
    for low, high in zip(map(int, lows), map(int, highs), strict=True):
        if joined and joined[-1][1] == low:
            joined[-1][1] = high
        else:
            joined.append([low, high])
    return "\n".join(text[spans[low][0] : spans[high - 1][1]] for low, high in joined)
