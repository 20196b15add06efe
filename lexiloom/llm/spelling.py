"""Spelling variants: words one edit apart, grouped under the most frequent, by a bit-sliced position index.

1. Words are counted with map-side combining over all texts.
2. Two words one edit apart agree in their first or in their last letters, half the length of the shorter one, so
   the vocabulary is dealt into blocks by (that length, side, letters).  A word lies in at most four blocks.
3. A task gathers blocks of one length into an index: for every position and letter a bitset over its words.  For a
   query word the recurrences step through its letters with whole bitsets at once, 64 words an operation and many
   queries an array, and keep three sets: words without an error so far, words with one letter replaced, and words
   with one letter more (these read the index one position further on).  Words with one letter less are the same
   pairs seen from the other side.
4. A block of more than ``SLICE`` words is dealt into slices by word hash; each pair of slices is a cell of its own, so
   no task holds more than two slices.
5. A pair is counted in the block of its first letters, or, if those differ, in that of its last.
6. Chains of forms are followed by pointer jumping; each round is written to the shared folder.

Defined results: null texts have no words; a null id reads as no characters before the colon; repeated rows count
twice; among near words of equal count the first in code-point order is the form; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.scratch import stored
from lexiloom.llm.words import lower_ascii

LETTERS = "A-Za-z\\u00C0-\\u00FF"  # fixed values: the letters of a word
LEAST_LETTERS = 6
LEAST_COUNT = 5
RATIO = 5
SLICE = 1 << 13
GATHER = 1 << 11  # words of small blocks indexed together
CELLS = 1 << 17  # 64-bit cells of one set over a batch of queries


def marred(key: Column, run: Column, every: int) -> Column:
    """The run, or, where the CRC-32 of ``key:run`` is divisible by ``every``, the run without one letter."""
    crc = F.crc32(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (crc % F.length(run)).cast("int")
    shorter = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(crc % every == 0, shorter).otherwise(run)


def vocabulary(
    df: DataFrame, key: str = "doc_id", text: str = "text", every: int = 199, letters: int = LEAST_LETTERS, count: int = LEAST_COUNT
) -> DataFrame:
    """``word`` and ``n`` of all words of at least ``letters`` letters that occur ``count`` times or more."""
    found = F.regexp_extract_all(F.col(f"`{text}`"), F.lit(f"[{LETTERS}]{{{letters},}}"), F.lit(0))
    runs = df.select(F.col(f"`{key}`").alias("_key"), F.explode(found).alias("_run"))
    words = runs.select("_key", lower_ascii(F.col("_run")).alias("_run")).select(marred(F.col("_key"), F.col("_run"), every).alias("word"))
    counted = words.filter(F.length("word") >= letters).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= count)


class PositionIndex:
    """Bitsets over words of ``length`` and ``length`` + 1 letters by position and letter."""

    def __init__(self, words: list[str], length: int):
        self.length = length
        self.codes = np.array(words, f"<U{length + 1}").view(np.uint32).reshape(len(words), length + 1)
        self.size = np.where(self.codes[:, length] == 0, length, length + 1)
        letters, code = np.unique(self.codes, return_inverse=True)
        self.code = code.reshape(self.codes.shape)
        self.wide = -(-len(words) // 64)
        self.bits = np.zeros((length + 1, len(letters), self.wide), np.uint64)
        rows = np.arange(len(words))
        for i in range(length + 1):
            member = np.zeros((len(letters), self.wide * 64), np.uint8)
            member[self.code[:, i], rows] = 1
            self.bits[i] = np.packbits(member, axis=1, bitorder="little").view(np.uint64)
        self.same = self._set(self.size == length)
        self.more = self._set(self.size == length + 1)

    def _set(self, member: np.ndarray) -> np.ndarray:
        padded = np.zeros(self.wide * 64, np.uint8)
        padded[: len(member)] = member
        return np.packbits(padded, bitorder="little").view(np.uint64)

    def near(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, word): one letter replaced, or the word has one letter more.  Queries have ``length`` letters."""
        exact = np.full((len(queries), self.wide), ~np.uint64(0))
        replaced = np.zeros_like(exact)
        longer = np.zeros_like(exact)
        for i in range(self.length):
            letter = self.code[queries, i]
            here, ahead = self.bits[i, letter], self.bits[i + 1, letter]
            longer = (longer | exact) & ahead
            replaced = (replaced & here) | (exact & ~here)
            exact &= here
        hits = (replaced & self.same) | ((longer | exact) & self.more)
        row, cell = np.nonzero(hits)
        if not len(row):
            return row, row
        spread = np.unpackbits(hits[row, cell].view(np.uint8).reshape(len(row), 8), axis=1, bitorder="little")
        which, bit = np.nonzero(spread)
        return queries[row[which]], cell[which] * 64 + bit


def near_pairs(words: list[str], length: int, block: np.ndarray, side: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of near words of one block, both ways round; ``side`` 1 stands for last letters.

    Where a cell holds two slices of a block (``part`` 0 and 1, not -1), only pairs across them count.
    """
    index = PositionIndex(words, length)
    half = length // 2
    queries = np.flatnonzero(index.size == length)
    step = max(1, CELLS // index.wide)
    lefts, rights = [], []
    for at in range(0, len(queries), step):
        a, b = index.near(queries[at : at + step])
        keep = (block[a] == block[b]) & ((part[a] < 0) | (part[a] != part[b]))
        a, b = a[keep], b[keep]
        fresh = (side[a] == 0) | (index.codes[a, :half] != index.codes[b, :half]).any(axis=1)
        lefts.append(a[fresh])
        rights.append(b[fresh])
    a, b = np.concatenate(lefts or [np.zeros(0, int)]), np.concatenate(rights or [np.zeros(0, int)])
    longer = index.size[b] > length  # equal lengths are found from both sides
    return np.concatenate([a, b[longer]]), np.concatenate([b, a[longer]])


NEAR = "word string, n_near long, near_n long, near string"
_NEAR = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("near_n", pa.int64()), ("near", pa.string())])


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per word and group of blocks: how many words are near, and the first of them."""

    def search(rows: list[tuple]) -> pa.RecordBatch | None:
        words = [r[5] for r in rows]
        cells: dict[tuple, int] = {}
        block = np.array([cells.setdefault(r[1:4], len(cells)) for r in rows])
        side, part = np.array([r[1] for r in rows]), np.array([r[4] for r in rows])
        n = np.array([r[6] for r in rows], np.int64)
        a, b = near_pairs(words, rows[0][0], block, side, part)
        if not len(a):
            return None
        rank = np.empty(len(words), np.int64)
        rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
        order = np.lexsort((rank[b], -n[b], a))
        a, b = a[order], b[order]
        first = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
        counts = np.diff(np.concatenate([first, [len(a)]]))
        columns = [
            pa.array([words[i] for i in a[first]]),
            pa.array(counts),
            pa.array(n[b[first]]),
            pa.array([words[i] for i in b[first]]),
        ]
        return pa.record_batch(columns, schema=_NEAR)

    rows: list[tuple] = []
    for batch in batches:
        for row in zip(*(batch[c].to_pylist() for c in ("length", "side", "chunk", "cell", "part", "word", "n")), strict=True):
            full = rows and len(rows) >= GATHER and row[:4] != rows[-1][:4]
            if rows and (full or row[0] != rows[-1][0]):
                found = search(rows)
                if found is not None:
                    yield found
                rows = []
            rows.append(row)
    if rows:
        found = search(rows)
        if found is not None:
            yield found


def near_words(words: DataFrame) -> DataFrame:
    """Of every word with words one edit apart: their number, the largest count among them and the first word of it."""
    size, word = F.length("word"), F.col("word")

    def posts(length: Column) -> list[Column]:
        half = (length / 2).cast("int")
        return [
            F.struct(length.alias("length"), F.lit(side).alias("side"), chunk.alias("chunk"))
            for side, chunk in ((0, F.substring(word, F.lit(1), half)), (1, F.substring(word, size - half + 1, half)))
        ]

    blocks = words.select("word", "n", F.explode(F.array(*posts(size), *posts(size - 1))).alias("_b")).select("_b.*", "word", "n")
    key = ["length", "side", "chunk"]
    hot = blocks.groupBy(key).agg(F.count(F.lit(1)).alias("_c")).filter(F.col("_c") > SLICE)
    hot = hot.select(*key, F.ceil(F.col("_c") / SLICE).cast("int").alias("_k"))
    dealt = blocks.join(hot, key, "left").withColumn("_a", F.pmod(F.xxhash64("word"), F.coalesce("_k", F.lit(1))).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.coalesce("_k", F.lit(1)) - 1)).alias("_o")
    cells = dealt.select(*key, "word", "n", "_a", other)
    low, high = F.least("_a", "_o"), F.greatest("_a", "_o")
    cells = cells.select(
        *key, F.struct(low.alias("low"), high.alias("high")).alias("cell"),
        F.when(low == high, -1).when(F.col("_a") == low, 0).otherwise(1).alias("part"), "word", "n",
    )
    cells = cells.withColumn("cell", F.concat_ws("-", "cell.low", "cell.high"))
    spread = cells.repartition(*key, "cell").sortWithinPartitions(*key, "cell", "word")
    found = spread.mapInArrow(_indexed, NEAR)
    best = F.min(F.struct((-F.col("near_n")).alias("rest"), F.col("near")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("_best"))


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``: the end of the chain of ``form`` that starts at each word of ``forms``."""
    now = stored(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("_moved")), "spelling_roots")
    while True:
        on = now.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        step = now.join(on, now["root"] == on["_at"], "left")
        step = step.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved"))
        now = stored(step, "spelling_roots")
        if now.filter("_moved").limit(1).count() == 0:
            return now.select("word", "root")


def group_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` of every row of ``words`` (``word``, ``n``)."""
    words = stored(words.select("word", "n"), "spelling_words")
    near = near_words(words).withColumnRenamed("word", "_w")
    joined = words.join(near, words["word"] == near["_w"], "left")
    best_n = -F.col("_best.rest")
    ruled = best_n >= ratio * F.col("n")
    table = joined.select(
        "word", F.when(ruled, F.col("_best.near")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(ruled, best_n).alias("form_n"),
    )
    table = stored(table, "spelling_forms")
    ends = roots(table.filter("form IS NOT NULL")).withColumnRenamed("word", "_w")
    out = table.join(ends, table["word"] == ends["_w"], "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
