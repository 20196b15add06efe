"""Language identification by character n-grams: a count model trained on labelled texts.

Score of a language: ``ln prior + sum over n-grams of ln((count + 1) / (all + distinct))``.

N-grams share ``BUCKETS`` buckets by the first digits of their MD5, so the model has that many rows whatever the corpus,
and logarithms are whole numbers of 1/``SCALE``.  Sums of whole numbers do not depend on the order of
rows or on how they are split, so one plan serves all sizes and gives the same answers in each.
"""

from __future__ import annotations

import sys
import uuid
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from hashlib import md5
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.functions.languages import LanguagePair
from lexiloom.functions.ngrams import portions
from lexiloom.session import materialize

ORDERS = (1, 2, 3)
DIGITS = 4
BUCKETS = 16**DIGITS
SCALE = 1 << 16
MEMO = 200_000  # n-grams whose bucket, and words whose weights, a worker remembers
MEMO_CHARS = 1 << 24  # of remembered words together
SLICE_CHARS = 1 << 20  # of texts that are scored together
_NOT_LETTERS = r"[^\p{L}]+"


# Letters by numbers from 1, Latin ones first, others in the order a process meets them; 0 is all that is no letter.
LETTERS = 128
_OTHER, _NEW = LETTERS - 1, -1  # a letter beyond those with a number, a character not met yet
_NUMBERS = np.full(sys.maxunicode + 1, _NEW, dtype=np.int16)
_KNOWN = [" "]
# Buckets of n-grams of numbered letters, -1 where not asked yet.
_BUCKETS_OF = {n: np.full(LETTERS**n, -1, dtype=np.int32) for n in ORDERS}


def _numbers(points: np.ndarray) -> np.ndarray:
    found = _NUMBERS[points]
    if (found == _NEW).any():
        for point in np.unique(points[found == _NEW]).tolist():
            if not chr(point).isalpha():
                _NUMBERS[point] = 0
            elif len(_KNOWN) == _OTHER:
                _NUMBERS[point] = _OTHER
            else:
                _NUMBERS[point] = len(_KNOWN)
                _KNOWN.append(chr(point))
        found = _NUMBERS[points]
    return found


_numbers(np.array([point for point in range(256) if chr(point).islower()]))


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def _letters(text: str) -> str:
    return _letters_of(text.lower())


def _letters_of(text: str) -> str:
    """A text with blanks for all that is no letter."""
    points = _points(text)
    return np.where(_numbers(points) > 0, points, np.uint32(32)).tobytes().decode("utf-32-le", "surrogatepass")


def _bucket(gram: str) -> int:
    return int(md5(gram.encode("utf-8", "surrogatepass")).hexdigest()[:DIGITS], 16)


def _grams(word: str) -> list[str]:
    """Character n-grams of a word with a blank on both sides.  Words are short, texts are not."""
    padded = f" {word} "
    return [padded[i : i + n] for n in ORDERS for i in range(len(padded) - n + 1)]


def _gram_buckets(order: int, letters: list[np.ndarray]) -> np.ndarray:
    """Buckets of the n-grams of letters that stand in the same place of each array."""
    table = _BUCKETS_OF[order]
    grams = letters[0].astype(np.int64)
    for letter in letters[1:]:
        grams = grams * LETTERS + letter
    found = table[grams]
    if (found < 0).any():
        for gram in np.unique(grams[found < 0]).tolist():
            table[gram] = _bucket("".join(_KNOWN[gram // LETTERS**n % LETTERS] for n in reversed(range(order))))
        found = table[grams]
    return found


def _text_buckets(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Buckets of all n-grams of lower-cased texts: ``rows`` of one, two and three, how often each one counts, and the
    number of places before each text and its end.

    Words are the runs of letters, each with a blank on both sides.  Here neighbours share the blank between them: it
    counts twice by itself, and three characters around it are no n-gram (their row is ``BUCKETS``).  Texts with letters
    beyond those with numbers have no such form.
    """
    numbers = _numbers(_points(" ".join(texts) + " "))  # a blank ends every text
    if (numbers == _OTHER).any():
        return None
    letter = numbers > 0
    kept = letter.copy()
    kept[1:] |= letter[:-1]  # and the blank after a word
    places = np.concatenate([[0], np.cumsum(kept)])[np.cumsum([0, *(len(text) + 1 for text in texts)])]
    row = np.concatenate([[0, 0], numbers[kept]])
    last, middle, first = row[2:], row[1:-1], row[:-2]
    three = np.where(middle > 0, _gram_buckets(3, [first, middle, last]), BUCKETS)
    return np.stack([_gram_buckets(1, [last]), _gram_buckets(2, [middle, last]), three]), 1 + (last == 0), places


@dataclass
class LanguageModel:
    """``grams(language, bucket, n)``, checkpointed, and ``languages(language, docs, total)``."""

    grams: DataFrame
    languages: DataFrame


LANGUAGES = 64  # whose bucket counts a task holds together
PLACES = 1 << 16  # characters whose n-grams are looked up together; their arrays stay in the processor's cache


def _counts(texts: list[str]) -> np.ndarray:
    """Occurrences of the n-grams of lower-cased texts by bucket."""
    found = _text_buckets(texts)
    if found is None:
        grams = (gram for text in texts for word in _letters_of(text).split() for gram in _grams(word))
        return np.bincount([_bucket(gram) for gram in grams], minlength=BUCKETS)
    rows, times, _ = found
    once = np.bincount(rows[1:].ravel(), minlength=BUCKETS + 1)[:BUCKETS]
    return once + np.bincount(rows[0], minlength=BUCKETS) + np.bincount(rows[0][times > 1], minlength=BUCKETS)


def _bucket_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts by language and bucket of the texts of a task, from ``language, text``."""
    counts: dict[str, np.ndarray] = {}

    def flush():
        for language, found in counts.items():
            buckets = np.flatnonzero(found)
            names = pa.array([language] * len(buckets), pa.string())
            yield pa.record_batch([names, pa.array(buckets, pa.int32()), pa.array(found[buckets])], ["language", "bucket", "n"])
        counts.clear()

    for batch in batches:
        texts_of = defaultdict(list)
        for language, text in zip(*(column.to_pylist() for column in batch.columns)):
            texts_of[language].append(text or "")
        for language, texts in texts_of.items():
            if language not in counts and len(counts) >= LANGUAGES:
                yield from flush()
            found = counts.setdefault(language, np.zeros(BUCKETS, np.int64))
            for a, b in portions(map(len, texts), PLACES):
                found += _counts(texts[a:b])
    yield from flush()


def train(docs: DataFrame, text: str = "text", language: str = "language") -> LanguageModel:
    """Count n-grams per language.

    A task counts its n-grams by bucket and sends one row per language and bucket, so the shuffle grows neither with
    the text nor with the vocabulary.
    """
    labelled = docs.filter(F.col(language).isNotNull()).select(F.lower(language).alias("language"), F.col(text).alias("text"))
    grams = materialize(
        labelled.select("language", F.lower("text").alias("text"))
        .mapInArrow(_bucket_counts, "language string, bucket int, n long")
        .groupBy("language", "bucket")
        .agg(F.sum("n").alias("n"))
    )
    totals = grams.groupBy("language").agg(F.sum("n").alias("total"))
    priors = labelled.groupBy("language").agg(F.count("*").alias("docs"))
    return LanguageModel(grams, priors.join(totals, "language", "left").fillna(0, ["total"]))


_HELD: dict[str, dict] = {}  # the last model of this process, by its key


@dataclass
class BucketTable:
    """The model as arrays: one row of weights per bucket and one column per language, so its size is known beforehand."""

    languages: tuple[str, ...]
    prior: np.ndarray
    weights: np.ndarray
    memo: dict[str, int] = field(default_factory=dict)
    words: dict[str, int] = field(default_factory=dict)
    word_chars: int = 0
    scores: np.ndarray | None = None  # by the numbers that ``words`` gives
    padded: np.ndarray | None = None  # weights, and zeros for what is no n-gram
    key: str = field(default_factory=lambda: uuid.uuid4().hex)

    def __getstate__(self):
        return self.__dict__ | {"memo": {}, "words": {}, "word_chars": 0, "scores": None, "padded": None}

    def __setstate__(self, state):
        """A worker's next task gets what the one before it remembered of the same model."""
        if state["key"] not in _HELD:
            _HELD.clear()
            _HELD[state["key"]] = state
        self.__dict__ = _HELD[state["key"]]

    def _row(self, gram: str) -> int:
        row = self.memo.get(gram)
        if row is None:
            if len(self.memo) >= MEMO:
                self.memo.clear()
            row = self.memo[gram] = _bucket(gram)
        return row

    def _learn(self, words: list[str]) -> None:
        """Weights of words that are not remembered, each the sum over its n-grams."""
        if len(self.words) > MEMO or self.word_chars > MEMO_CHARS:
            self.words, self.word_chars, self.scores = {}, 0, None
        new = [word for word in dict.fromkeys(words) if word not in self.words]
        if not new:
            return
        rows, starts = [], []
        for word in new:
            starts.append(len(rows))
            rows += map(self._row, _grams(word))
        found, known = np.add.reduceat(self.weights[rows], starts, axis=0), len(self.words)
        if self.scores is None or known + len(new) > len(self.scores):
            grown = np.zeros((2 * (known + len(new)), len(self.languages)), np.int64)
            if known:
                grown[:known] = self.scores[:known]
            self.scores = grown
        self.scores[known : known + len(new)] = found
        self.words.update(zip(new, range(known, known + len(new))))
        self.word_chars += sum(map(len, new))

    def _totals(self, texts: list[str]) -> np.ndarray:
        lists = [text.split() for text in texts]
        ends = np.cumsum([0, *map(len, lists)])
        words = list(chain.from_iterable(lists))
        total = np.tile(self.prior, (len(lists), 1))
        if words:
            self._learn(words)
            codes = np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))
            sums = np.vstack([np.zeros_like(self.prior), np.cumsum(self.scores[codes], axis=0)])
            total = total + sums[ends[1:]] - sums[ends[:-1]]
        return total

    def predict(self, texts: pd.Series) -> pd.Series:
        """Most likely language per text of spaced words, the first by name where several are.

        A word is taken apart once and then remembered; texts are scored some at a time, so memory does not grow with a batch.
        """
        texts = texts.tolist()
        best = [self._totals(texts[a:b]).argmax(axis=1) for a, b in portions(map(len, texts), SLICE_CHARS)]
        return pd.Series(np.array(self.languages, dtype=object)[np.concatenate(best)])

    def _text_totals(self, texts: list[str]) -> np.ndarray:
        """The same for lower-cased texts with all their characters, without a look at single words."""
        found = _text_buckets(texts)
        if found is None:
            return self._totals([_letters_of(text) for text in texts])
        (one, two, three), times, places = found
        if self.padded is None:
            self.padded = np.vstack([self.weights, np.zeros_like(self.prior)])
        sums = np.zeros((len(one) + 1, len(self.languages)), np.int64)
        np.cumsum(self.padded[one] * times[:, None] + self.padded[two] + self.padded[three], axis=0, out=sums[1:])
        return self.prior + np.diff(sums[places], axis=0)

    def is_language(self, texts: pd.Series, language: str) -> np.ndarray:
        """Whether texts, with all their characters, are in a language, by the first most likely one."""
        wanted = np.array([name == language for name in self.languages], dtype=bool)
        texts = [text.lower() for text in texts]
        most = max(PLACES // max(len(self.languages), 1), 1)
        best = [self._text_totals(texts[a:b]).argmax(axis=1) for a, b in portions(map(len, texts), most)]
        return wanted[np.concatenate(best)]


def _fixed(logarithms: np.ndarray) -> np.ndarray:
    return np.rint(logarithms * SCALE).astype(np.int64)


def bucket_table(model: LanguageModel) -> BucketTable:
    """The model for the tasks: at most ``BUCKETS`` rows per language reach the driver."""
    languages = model.languages.orderBy("language").toPandas()
    names = tuple(languages["language"])
    rows = model.grams.toPandas()
    counts = np.zeros((BUCKETS, len(names)), np.int64)
    counts[rows["bucket"].to_numpy(np.int64), pd.Index(names).get_indexer(rows["language"])] = rows["n"].to_numpy(np.int64)
    distinct = int((counts > 0).any(axis=1).sum())
    smooth = languages["total"].to_numpy(dtype=float) + distinct
    docs = languages["docs"].to_numpy(dtype=float)
    return BucketTable(names, _fixed(np.log(docs / docs.sum())), _fixed(np.log((counts + 1) / smooth)))


def predict_in_tasks(spark: SparkSession, table: BucketTable, text: Column) -> Column:
    """Prediction as a column; the model travels once per executor."""
    shared = spark.sparkContext.broadcast(table)

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield shared.value.predict(texts)

    return run(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), _NOT_LETTERS, " "))


def identify(docs: DataFrame, model: LanguageModel, text: str = "text", out: str = "detected") -> DataFrame:
    """Add the detected language; a text without letters has the most frequent one of the training."""
    return docs.withColumn(out, predict_in_tasks(docs.sparkSession, bucket_table(model), F.col(text)))


def language_gate(table: BucketTable, language: str) -> Callable[[pd.Series], np.ndarray]:
    """Predicate for the attempt sweep: is the text in the wanted language?  Case does not matter."""
    wanted = language.lower()
    return lambda texts: table.is_language(texts, wanted)


def matches_expected(detected: Column, expected: Column) -> Column:
    return F.lower(detected) == F.lower(expected)


def pair_model(docs: DataFrame, pair: LanguagePair, text: str = "text", language: str = "language") -> LanguageModel:
    return train(docs.filter(pair.is_member(F.col(language))), text, language)
