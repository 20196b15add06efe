"""Quality classifier: an interpolated modified Kneser-Ney trigram model of trusted text.

The model is counted over all words of all trusted documents but one text in ``HELD_OUT``; documents with
those set the limits, all of them, and every whole text is scored.  Nothing of the model goes to the driver or to
every worker but its few reserved tokens:

1. Documents are told in portions, each a row: its distinct words, and its texts as numbers of these.  Words of the
   portions meet the vocabulary of the trusted text by a join, so a portion learns the numbers of its own words.
2. N-grams travel as packed columns, each bigram once with the words before it, and lie in shards by their middle
   word; the bigrams of words that would fill a shard alone are dealt to several.  Shards add the counts of the
   portions and tell the shard that holds a context as a bigram what they have of it; it answers with the sums.
3. A token's log probability is a sum of weights of its word, of the word before, of its bigram and its trigram, each
   zero where the model has none: so a document's is a sum over n-grams.  Each portion sends every shard what it holds
   of it, counted by document, and each shard looks it up among its weights.  Portions do so in ``ROUNDS``, so that
   only a part of all n-grams lies on disk.  Weights are whole multiples of 1 / ``SCALE``: no sum depends on an order.

Tokens are words; one that the trusted text holds less than twice is replaced by its shape (small, capitalized, upper
case, number, with marks, other), and a word that repeats the one before it by a token of its own.  An end token
closes each document.  A document's mean log probability, drawn towards the mean of its language as by
``PRIOR`` tokens, must reach a quantile of its language.  That of n documents is moved away from the median by
2 / sqrt(n) of its distance to it, since few documents do not show the end of a distribution.  There is no limit
on the other side: copies of trusted text are as likely as it gets, and are good text.

Defined results: null and empty texts have the end token alone and are kept, since nothing speaks against them;
a language without trusted documents, null included, takes the limits of all languages; without any trusted
document all are kept; documents with several labels are trusted if all say so.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import partial, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiloom.llm.scratch import stored
from lexiloom.session import remove

PORTION = 12 << 20  # bytes of texts in a portion, if they are several
READS = 2  # in which texts meet their labels and make portions, since that join moves all text
SHARD_TOKENS = 4_000_000  # tokens that a shard looks up, about
ROUNDS = 5  # in which portions of at least four ask for their weights
SCALE = 100_000_000  # so that a weight is a number of 32 bits
MAX_DOCS = 10_000  # of a sample that fits the driver, as the next two
MAX_WORDS = 250_000
GIVERS = 100  # documents that a full sample holds at least
PRIOR = 20.0
QUANTILE = 0.995  # of the perplexities of trusted documents
HELD_OUT = 5  # one trusted text in so many is not learned
MEMO = 400_000
BITS = 21  # of a token number, so that three make a key

START, END, REPEAT, FIRST_SHAPE, SHAPES = 0, 1, 2, 3, 6
RESERVED = FIRST_SHAPE + SHAPES
_SMALL = re.compile(r"[^\W\d_A-ZÀ-ÖØ-Þ]+(?:['’-][^\W\d_A-ZÀ-ÖØ-Þ]+)*[.,;:!?]?\Z")
_CAPITAL = re.compile(r"[A-ZÀ-ÖØ-Þ][^\W\d_A-ZÀ-ÖØ-Þ]*[.,;:!?]?\Z")
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]{2,}[.,;:!?]?\Z")
_NUMBER = re.compile(r"[\d.,:/-]*\d[\d.,:/%-]*\Z")
_MARKS = frozenset(bytes([x]) for x in b".,;:!?")
_CODEC = pa.Codec("zstd", compression_level=3)
_LETTERS = re.compile(r"[^\W\d_]")


def shape(word: bytes) -> int:
    core = word[:-1] if word[-1:] in _MARKS else word
    if core.isalpha():  # of ASCII alone; the patterns say the same
        if core.islower():
            return 0
        if core[:1].isupper() and (len(core) == 1 or core[1:].islower()):
            return 1
    text = word.decode("utf-8", "replace")
    for number, pattern in enumerate((_SMALL, _CAPITAL, _UPPER, _NUMBER)):
        if pattern.match(text):
            return number
    return 4 if _LETTERS.search(text) else 5


class Numbers(dict):
    """Token number of a word; words outside the vocabulary get numbers of their own that tell their shape."""

    def __init__(self, vocabulary: list[bytes]):
        super().__init__({word: RESERVED + i for i, word in enumerate(vocabulary)})
        self.known, self.size = len(vocabulary), RESERVED + len(vocabulary)
        self.vocabulary = vocabulary

    def __missing__(self, word: bytes) -> int:
        value = self.size + SHAPES * (len(self) - self.known) + shape(word)
        self[word] = value
        return value

    def forget(self) -> None:
        if len(self) - self.known > MEMO:
            self.clear()
            self.update({word: RESERVED + i for i, word in enumerate(self.vocabulary)})

    def tokens(self, text: str | None) -> np.ndarray:
        """Token numbers of a text, the end token included."""
        self.forget()
        words = (text or "").encode("utf-8", "surrogatepass").split()  # at the same white space as elsewhere
        own = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        out = np.where(own >= self.size, FIRST_SHAPE + (own - self.size) % SHAPES, own)
        if len(own) > 1:
            out[1:][own[1:] == own[:-1]] = REPEAT
        return np.append(out, END)


def _keys(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bigram and trigram key of each token, after two start tokens."""
    padded = np.concatenate([[START, START], tokens])
    pair = padded[:-1] << BITS | padded[1:]
    return pair[1:], pair[:-1] << BITS | padded[2:]


@dataclass(frozen=True)
class Model:
    vocabulary: list[bytes]
    unigram: np.ndarray  # probability by token number
    unigram_rest: np.ndarray  # what a context leaves to the lower order
    pairs: np.ndarray  # sorted keys
    pair: np.ndarray
    pair_rest: np.ndarray
    triples: np.ndarray
    triple: np.ndarray

    def logs(self, tokens: np.ndarray) -> np.ndarray:
        """log10 probability of each token."""
        pair_keys, triple_keys = _keys(tokens)

        def find(keys: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            at = np.minimum(np.searchsorted(table, keys), max(len(table) - 1, 0))
            return at, (table[at] == keys) if len(table) else np.zeros(len(keys), bool)

        before = np.concatenate([[START], tokens[:-1]])
        at, known = find(pair_keys, self.pairs)
        p = self.unigram_rest[before] * self.unigram[tokens]
        p = np.where(known, self.pair[at] if len(self.pair) else 0.0, p)
        context = np.concatenate([[START << BITS | START], pair_keys[:-1]])
        at, known = find(context, self.pairs)
        rest = np.where(known, self.pair_rest[at] if len(self.pair) else 1.0, 1.0)
        at, known = find(triple_keys, self.triples)
        return np.log10(np.where(known, self.triple[at] if len(self.triple) else 0.0, rest * p))


def discounts(of_counts: dict[int, int]) -> list[float]:
    """Discounts of counts 1, 2 and from 3 on, from how many n-grams have counts 1 to 4."""
    n = [0, *(of_counts.get(i, 0) for i in range(1, 5))]
    if not n[1] or not n[2]:
        return [0.5, 0.5, 0.5]
    y = n[1] / (n[1] + 2 * n[2])
    return [min(max(k - (k + 1) * y * n[k + 1] / n[k], 0.1), k - 0.1) if n[k] else 0.5 for k in (1, 2, 3)]


def _discounts(counts: DataFrame) -> list[float]:
    return discounts({r["n"]: r["c"] for r in counts.filter("n <= 4").groupBy("n").agg(F.count(F.lit(1)).alias("c")).collect()})


_SUMS = {
    "_sum": F.sum,
    "_ones": lambda n: F.count(F.when(F.col(n) == 1, 1)),
    "_twos": lambda n: F.count(F.when(F.col(n) == 2, 1)),
    "_more": lambda n: F.count(F.when(F.col(n) > 2, 1)),
}  # what a context must know of the counts of its n-grams


def _rest(d: list[float]) -> Column:
    return (F.col("_ones") * d[0] + F.col("_twos") * d[1] + F.col("_more") * d[2]) / F.col("_sum")


def _contexts(counts: DataFrame, context: str) -> tuple[DataFrame, list[float]]:
    """``_sum`` of each context and ``rest``, what it leaves to the lower order, with the discounts."""
    d = _discounts(counts)
    sums = counts.groupBy(context).agg(*(of("n").alias(name) for name, of in _SUMS.items()))
    return sums.select(context, "_sum", _rest(d).alias("rest")), d


def _share(d: list[float]) -> Column:
    """Discounted share of an n-gram in its context."""
    cut = F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])
    return (F.col("n") - cut) / F.col("_sum")


def _discounted(counts: DataFrame, context: str) -> DataFrame:
    """``p`` (discounted share of the context) of each n-gram and ``rest`` (what its context leaves)."""
    sums, d = _contexts(counts, context)
    return counts.join(sums, context).withColumn("p", _share(d))


def sample_of(docs: DataFrame, learned: DataFrame, text: str) -> DataFrame:
    """Documents of ``learned`` (``doc_id``) in an order by hash while they stay within the bounds.

    For models that must fit the driver (``train``); ``classify`` learns from all.
    Ids are thinned before any text is read, so neither the driver nor a single task meets more than the sample.
    """
    share = min(1.0, MAX_DOCS / max(learned.count(), 1))
    draw = F.pmod(F.xxhash64(F.lit(10), "doc_id"), F.lit(1 << 30))
    some = learned.filter(draw < int(share * (1 << 30)))
    rows = docs.join(some, "doc_id", "left_semi").select("doc_id", F.col(text).alias("_text"))
    words, most = F.split("_text", r"[\x20\x09-\x0D]+"), max(1, MAX_WORDS // GIVERS)
    given = F.when(F.size(words) > most, F.array_join(F.slice(words, 1, most), " ")).otherwise(F.col("_text"))
    rows = stored(
        rows.select("doc_id", given.alias("_text"), draw.alias("_draw"), F.least(F.size(words), F.lit(most)).alias("_words")),
        "sample_candidates",
    )
    before = Window.orderBy("_draw", "doc_id").rowsBetween(Window.unboundedPreceding, 0)  # numbers of a sample
    totals = rows.select("doc_id", "_draw", "_words").withColumns(
        {"_total": F.sum("_words").over(before), "_place": F.count(F.lit(1)).over(before)}
    )
    inside = totals.filter((F.col("_total") <= MAX_WORDS) & (F.col("_place") <= MAX_DOCS)).select("doc_id")
    return rows.join(inside, "doc_id", "left_semi").select("doc_id", "_text")


def train(sample: DataFrame) -> Model:
    """The model in one process, as ``classify`` has it in shards; ``sample``: ``_text``, bounded in words."""
    words = sample.select(F.explode(F.split("_text", r"[\x20\x09-\x0D]+")).alias("w")).filter("w <> ''")
    twice = words.groupBy("w").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.encode("w", "utf-8").alias("w"))
    vocabulary = sorted(bytes(r["w"]) for r in twice.collect())  # at most MAX_WORDS / 2 words
    size = RESERVED + len(vocabulary)

    def grams(frames):
        numbers = Numbers(vocabulary)
        for frame in frames:
            for text in frame["_text"]:
                yield pd.DataFrame({"g": _keys(numbers.tokens(text))[1]})

    low = F.lit((1 << BITS) - 1)
    triples = sample.select("_text").mapInPandas(grams, "g long").groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    triples = stored(
        triples.select(
            "g", "n", F.shiftright("g", BITS).alias("uv"),
            F.col("g").bitwiseAND(F.lit((1 << (2 * BITS)) - 1)).alias("vw"),
        ),
        "trigrams",
    )
    # Lower orders count in how many contexts an n-gram occurs; after a start token there is one context only.
    first = F.shiftright("vw", BITS) == START
    pairs = triples.groupBy("vw").agg(F.when(F.first(first), F.sum("n")).otherwise(F.count(F.lit(1))).alias("n"))
    pairs = stored(
        pairs.select("vw", "n", F.shiftright("vw", BITS).alias("v"), F.col("vw").bitwiseAND(low).alias("w")), "bigrams"
    )
    singles = pairs.groupBy("w").agg(F.count(F.lit(1)).alias("n")).withColumn("all", F.lit(0))

    one = _discounted(singles, "all").select("w", "p", "rest").toPandas()
    unigram = np.zeros(size)
    unigram[one["w"]] = one["p"]
    unigram += (one["rest"].iloc[0] if len(one) else 1.0) / size
    two = _discounted(pairs, "v").select("vw", "v", "w", "p", "rest").toPandas().sort_values("vw")
    unigram_rest = np.ones(size)
    unigram_rest[two["v"]] = two["rest"]
    pair = two["p"].to_numpy() + two["rest"].to_numpy() * unigram[two["w"].to_numpy()]
    keys = two["vw"].to_numpy()
    three = _discounted(triples, "uv").select("g", "uv", "vw", "p", "rest").toPandas().sort_values("g", ignore_index=True)
    pair_rest = np.ones(len(keys))
    contexts = three.drop_duplicates("uv")
    at = np.searchsorted(keys, contexts["uv"].to_numpy())
    inside = (at < len(keys)) & (keys[np.minimum(at, max(len(keys) - 1, 0))] == contexts["uv"].to_numpy())
    pair_rest[at[inside]] = contexts["rest"].to_numpy()[inside]
    lower = pair[np.searchsorted(keys, three["vw"].to_numpy())]
    triple = three["p"].to_numpy() + three["rest"].to_numpy() * lower
    # The context of two start tokens is no bigram of the text: it is added by hand.
    start = contexts[contexts["uv"] == (START << BITS | START)]
    if len(start):
        keys = np.insert(keys, 0, START << BITS | START)
        pair, pair_rest = np.insert(pair, 0, unigram_rest[START] * unigram[START]), np.insert(pair_rest, 0, start["rest"].iloc[0])
    return Model(vocabulary, unigram, unigram_rest, keys, pair, pair_rest, three["g"].to_numpy(), triple)


def _forget(*tables: DataFrame) -> None:
    """Delete stored tables that are of no more use, since n-gram tables are as large as the text."""
    for table in tables:
        for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            remove(table.sparkSession, folder)


class Distinct(dict):
    """Words of a portion, numbered as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def portions(docs: DataFrame) -> DataFrame:
    """``docs``: ``doc_id``, ``lang``, ``_learn``, ``_text``.  A row for each portion, ``b`` its number, ``turn`` its round.

    ``words``, ``counts`` in documents to learn from, ``totals`` in all and ``shapes`` are by distinct word, ``sizes`` in
    words and the other columns by document; ``tokens`` has a number of a distinct word for each word.
    """
    bound = PORTION

    def one(columns: list[pa.Array], texts: list[bytes | None]) -> pa.RecordBatch:
        own = Distinct()
        found = []
        for text in texts:
            words = (text or b"").split()
            found.append(np.fromiter(map(own.__getitem__, words), np.uint32, len(words)))
        sizes = np.array([len(x) for x in found], np.int32)
        tokens = np.concatenate(found)
        totals = np.bincount(tokens, minlength=len(own)).astype(np.int64)
        order = np.argsort(-totals, kind="stable")  # small numbers for frequent words
        place = np.empty(len(order), np.uint32)
        place[order] = np.arange(len(order))
        tokens, totals, distinct = place[tokens], totals[order], list(own)
        distinct = [distinct[i] for i in order]
        learned = np.repeat(np.array([bool(x) for x in columns[2].to_pylist()]), sizes)
        counts = np.bincount(tokens[learned], minlength=len(own)).astype(np.int64)
        shapes = np.fromiter(map(shape, distinct), np.int8, len(own))
        by_word = (pa.array(x) for x in (counts, totals, shapes))
        lists = [*columns, pa.array(sizes), pa.array(distinct, pa.binary()), *by_word]
        arrays = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists]
        blob = _planes(tokens)
        names = ["doc_id", "lang", "learn", "sizes", "words", "counts", "totals", "shapes", "tokens"]
        return pa.RecordBatch.from_arrays([*arrays, pa.array([blob], pa.binary())], names)

    def run(batches):
        for batch in batches:
            texts = batch.column(3).cast(pa.binary()).to_pylist()
            begin = size = 0
            for i, text in enumerate(texts):
                if size and size + len(text or b"") > bound:
                    yield one([c.slice(begin, i - begin) for c in batch.columns[:3]], texts[begin:i])
                    begin, size = i, 0
                size += len(text or b"")
            if begin < len(texts):
                yield one([c.slice(begin) for c in batch.columns[:3]], texts[begin:])

    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = (
        f"doc_id array<{kinds['doc_id']}>, lang array<{kinds['lang']}>, learn array<boolean>, sizes array<int>, "
        "words array<binary>, counts array<long>, totals array<long>, shapes array<byte>, tokens binary"
    )
    tables = []
    for i in range(READS):
        read = docs.filter(F.pmod(F.xxhash64(F.lit(12), "doc_id"), F.lit(READS)) == i)
        found = read.select("doc_id", "lang", "_learn", "_text").mapInArrow(run, schema)
        found = found.withColumn("_mark", F.monotonically_increasing_id())  # task and place there
        turn = F.col("_mark") + F.shiftright("_mark", 33) + i
        found = found.select("*", (F.col("_mark") * READS + i).alias("b"), turn.alias("turn")).drop("_mark")
        tables.append(stored(found, "portions", "zstd"))
    return _together(tables)


class Layout:
    """Places of a portion's tokens, with two start tokens before each document and an end token behind it.

    ``tokens`` number reserved tokens as themselves and the words ``ids`` from ``RESERVED`` on.
    """

    def __init__(self, tokens: bytes, sizes: bytes, ids: bytes):
        self.ids = _from_planes(ids, steps=True)
        self.own = _from_planes(tokens)
        sizes = _from_planes(sizes)
        of = np.repeat(np.arange(len(sizes)), sizes)
        self.place = np.arange(len(of)) + 3 * of + 2
        self.stop = np.cumsum(sizes + 3) - 1
        real = np.ones(len(of) + 3 * len(sizes), bool)
        first = self.stop - sizes - 2
        real[first] = real[first + 1] = False
        self.at = np.flatnonzero(real)
        self.doc = np.repeat(np.arange(len(sizes)), sizes + 1)
        self.begins = np.cumsum(sizes + 1) - sizes - 1

    def spread(self, values: np.ndarray) -> np.ndarray:
        """A value of each token, from those of reserved tokens and of ``ids``."""
        out = np.full(len(self.own) + 3 * len(self.stop), values[START], np.int64)
        out[self.place] = values[self.own]
        out[self.stop] = values[END]
        return out

    def grams(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Token numbers of all trigrams."""
        x = self.spread(np.concatenate([np.arange(RESERVED), RESERVED + self.ids]))
        return x[self.at - 2], x[self.at - 1], x[self.at]


@dataclass(frozen=True)
class Shards:
    """Shard of a bigram: by its first word, and by the second too where the first is reserved or heavy."""

    count: int
    heavy: np.ndarray  # sorted token numbers
    split: np.ndarray  # into how many shards the bigrams of each go

    def of(self, v: np.ndarray, w: np.ndarray) -> np.ndarray:
        parts = np.where(v < RESERVED, self.count, 1)
        if len(self.heavy):
            at = np.minimum(np.searchsorted(self.heavy, v), len(self.heavy) - 1)
            parts = np.where(self.heavy[at] == v, self.split[at], parts)
        return (v * 1_000_003 + ((w * 2_654_435_761 & 0xFFFFFFFF) >> 8) % parts) % self.count


def vocabulary_of(parts: DataFrame, shards: int) -> tuple[DataFrame, int, Shards]:
    """``w`` and ``id`` of the words that trusted text holds twice, as a stored table, how many there are, and shards."""
    words = parts.select(F.explode(F.arrays_zip("words", "counts", "totals")).alias("x"))
    words = words.select(F.col("x.words").alias("w"), F.col("x.counts").alias("n"), F.col("x.totals").alias("t"))
    words = words.filter("n > 0 OR t > 255")  # totals need not be whole: they tell what fills a shard
    twice = words.groupBy("w").agg(F.sum("n").alias("n"), F.sum("t").alias("t")).filter("n > 1").select("w", "t")
    place = F.lit((1 << 33) - 1)
    twice = twice.orderBy(F.desc("t"))  # small numbers for frequent words
    marked = stored(twice.withColumn("_mark", F.monotonically_increasing_id()), "marked_words", "zstd")
    twice = marked.withColumns({"_part": F.shiftright("_mark", 33), "_place": F.col("_mark").bitwiseAND(place)})
    sizes = twice.groupBy("_part").agg((F.max("_place") + 1).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    bases = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_base"))
    ids = twice.join(F.broadcast(bases), "_part").select("w", "t", (F.col("_base") + F.col("_place")).cast("int").alias("id"))
    ids = stored(ids, "vocabulary", "zstd")
    _forget(marked)
    most = max(1, SHARD_TOKENS // 4)
    heavy = sorted((RESERVED + r["id"], r["t"]) for r in ids.filter(F.col("t") > most).collect())  # at most 4 a shard
    split = [min(shards, 1 + t // most) for _, t in heavy]
    return ids, ids.count(), Shards(shards, np.array([x for x, _ in heavy], np.int64), np.array(split, np.int64))


def coded(parts: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``b``, and packed: ``sizes`` and ``learn`` by document, ``ids`` of known words, ``tokens`` as of ``Layout``."""
    words = parts.select("b", F.posexplode("words").alias("pos", "w"))
    own = words.join(vocabulary.select("w", "id"), "w").groupBy("b").agg(F.collect_list(F.struct("pos", "id")).alias("_own"))
    own = own.select("b", F.col("_own.pos").alias("pos"), F.col("_own.id").alias("id"))
    names = ["b", "sizes", "learn", "ids", "tokens"]

    def run(frames):
        for frame in frames:
            columns = (frame[c] for c in ("b", "sizes", "learn", "shapes", "tokens", "pos", "id"))
            for b, sizes, learn, shapes, tokens, pos, ids in zip(*columns, strict=True):
                words = _from_planes(tokens)
                of = np.repeat(np.arange(len(sizes)), sizes)
                number = FIRST_SHAPE + np.asarray(shapes, np.int64)
                ids = np.zeros(0, np.int64) if ids is None else np.asarray(ids, np.int64)
                order = np.argsort(ids)
                if len(ids):
                    number[np.asarray(pos)[order]] = RESERVED + np.arange(len(ids))
                found = number[words]
                found[1:][(words[1:] == words[:-1]) & (of[1:] == of[:-1])] = REPEAT
                learn = _planes(np.array([bool(x) for x in learn]))
                found = _planes(found)
                yield pd.DataFrame([(b, _planes(sizes), learn, _planes(ids[order], steps=True), found)], columns=names)

    rows = _dealt(parts.select("b", "tokens", "sizes", "shapes", "learn")).join(own, "b", "left")
    return stored(rows.mapInPandas(run, "b long, " + ", ".join(f"{c} binary" for c in names[1:])), "coded")


def _dealt(parts: DataFrame) -> DataFrame:
    """Portions dealt to tasks by their number: they are few rows of much work."""
    context = parts.sparkSession.sparkContext
    return parts.repartition(max(4 * context.defaultParallelism, -(-parts.count() // 4)), "b")


def _planes(values: np.ndarray, steps: bool = False) -> bytes:
    """Packed whole numbers, or the steps between them: the low bytes of all, then the next ones."""
    own = np.asarray(values)
    top, signed = (int(own.max()), int(own.min()) < 0) if len(own) else (0, False)
    kind = "<i8" if signed else next(f"<u{size}" for size in (1, 2, 4, 8) if top < 1 << 8 * size)
    own = own.astype(kind)
    if steps and len(own):
        own[1:] = own[1:] - own[:-1]  # wraps around
    raw = own.view("u1").reshape(-1, own.itemsize).T.tobytes()
    return kind.encode() + len(raw).to_bytes(8, "little") + _CODEC.compress(raw, asbytes=True)


def _from_planes(raw: bytes, steps: bool = False) -> np.ndarray:
    kind, size = raw[:3].decode(), int.from_bytes(raw[3:11], "little")
    planes = np.frombuffer(_CODEC.decompress(raw[11:], size, asbytes=True) if size else b"", "u1").reshape(int(kind[-1]), -1)
    own = np.ascontiguousarray(planes.T).view(kind).ravel()
    return (np.cumsum(own, dtype=kind) if steps else own).astype(np.int64)


def _begins(*sorted_columns: np.ndarray) -> np.ndarray:
    """Where equal rows begin."""
    new = np.ones(len(sorted_columns[0]), bool)
    new[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in sorted_columns])
    return np.flatnonzero(new)


def _spans(sorted_column: np.ndarray) -> list[tuple[int, int]]:
    cuts = [*_begins(sorted_column).tolist(), len(sorted_column)]
    return list(zip(cuts[:-1], cuts[1:], strict=True))


def _ranked(v: np.ndarray, w: np.ndarray, shards: Shards) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Place of each bigram among the distinct ones in the order of shards, and these with their shards."""
    pairs, place = np.unique(v << 32 | w, return_inverse=True)
    v, w = pairs >> 32, pairs & 0xFFFFFFFF
    shard = shards.of(v, w)
    order = np.argsort(shard, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return rank[place], shard[order], v[order], w[order]


def _packed(v: np.ndarray, w: np.ndarray, runs: np.ndarray, u: np.ndarray) -> tuple[bytes, bytes, bytes, bytes]:
    return _planes(v, steps=True), _planes(w, steps=True), _planes(runs), _planes(u, steps=True)


def _unpacked(row) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bigrams in their order, how many rows each has, and the word before in each of these."""
    return *(_from_planes(x, steps=True) for x in (row.v, row.w)), _from_planes(row.runs), _from_planes(row.u, steps=True)


def _parcels(place: np.ndarray, shard: np.ndarray, v: np.ndarray, w: np.ndarray, *columns: np.ndarray):
    """For each shard: bigrams, how many rows each has, and the columns of these, the word before first, packed."""
    runs = np.bincount(place, minlength=len(v))
    ends = np.append(0, np.cumsum(runs))
    for i, j in _spans(shard):
        u, *more = (x[ends[i] : ends[j]] for x in columns)
        yield int(shard[i]), *_packed(v[i:j], w[i:j], runs[i:j], u), *map(_planes, more)


def trigrams(parts: DataFrame, shards: Shards) -> DataFrame:
    """A row for each shard ``s``: the trigrams of documents to learn from, and what its n-grams add to sums.

    ``v``, ``w``, ``runs``, ``u``, ``n`` are packed; ``seen`` has how many trigrams and bigrams have counts 1 to 4, then
    the sums of the two start tokens as a context; ``sums`` are by first word of a bigram, ``kinds`` by the last.
    """
    names = ["s", "v", "w", "runs", "u", "n"]

    def run(frames):
        for frame in frames:
            for row in frame.itertuples(index=False):
                learn = _from_planes(row.learn) > 0
                if not learn.any():
                    continue
                layout = Layout(row.tokens, row.sizes, row.ids)
                u, v, w = (x[learn[layout.doc]] for x in layout.grams())
                place, shard, v, w = _ranked(v, w, shards)
                keys, n = np.unique(place << 32 | u, return_counts=True)
                yield pd.DataFrame(list(_parcels(keys >> 32, shard, v, w, keys & 0xFFFFFFFF, n)), columns=names)

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        v, w, runs, u = (np.concatenate(x) for x in zip(*map(_unpacked, rows.itertuples(index=False)), strict=True))
        n = np.concatenate([_from_planes(x) for x in rows["n"]])
        pairs, place = np.unique(v << 32 | w, return_inverse=True)
        keys = np.repeat(place, runs) << 32 | u
        order = np.argsort(keys, kind="stable")  # of sorted runs
        keys = keys[order]
        at = _begins(keys)
        n, keys = np.add.reduceat(n[order], at), keys[at]
        u, runs = keys & 0xFFFFFFFF, np.bincount(keys >> 32)
        v, w = pairs >> 32, pairs & 0xFFFFFFFF
        m = _bigram_counts(v, runs, n)
        first, of = np.unique(v, return_inverse=True)
        last, kinds = np.unique(w, return_counts=True)
        begin = n[(u == START) & (np.repeat(v, runs) == START)]
        seen = [int((x == i).sum()) for x in (n, m) for i in range(1, 5)]
        sums = dict(zip(("v_sum", "v_ones", "v_twos", "v_more"), _sums_of(of, m), strict=True))
        return pd.DataFrame(
            {"s": rows["s"].iloc[:1]} | dict(zip(names[1:], (*_packed(v, w, runs, u), _planes(n)), strict=True))
            | {"seen": [seen + [int(x[0]) if len(begin) else 0 for x in _sums_of(np.zeros(len(begin), np.int64), begin)]]}
            | {"v_token": [first]} | {k: [x] for k, x in sums.items()} | {"w_token": [last], "w_kinds": [kinds]}
        )

    blobs = ", ".join(f"{c} binary" for c in names[1:])
    rows = parts.select("tokens", "sizes", "learn", "ids").mapInPandas(run, f"s long, {blobs}")
    lists = ", ".join(f"{c} array<long>" for c in ("seen", "v_token", "v_sum", "v_ones", "v_twos", "v_more", "w_token", "w_kinds"))
    return stored(rows.groupBy("s").applyInPandas(add, f"s long, {blobs}, {lists}"), "trigrams", "zstd")


def _bigram_counts(v: np.ndarray, runs: np.ndarray, n: np.ndarray) -> np.ndarray:
    """In how many contexts bigrams occur; after a start token there is one context only, and their count is taken."""
    return np.where(v == START, np.add.reduceat(n, np.cumsum(runs) - runs), runs)


def _sums_of(of: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
    """``_SUMS`` of counts by group, the numbers ``of`` from 0 on."""
    size = int(of.max()) + 1 if len(of) else 0
    total = np.zeros(size, np.int64)
    np.add.at(total, of, n)
    return [total, *(np.bincount(of[some], minlength=size) for some in (n == 1, n == 2, n > 2))]


def _rests(sums: list[np.ndarray], d: list[float]) -> np.ndarray:
    return (sums[1] * d[0] + sums[2] * d[1] + sums[3] * d[2]) / sums[0]


def _cut(n: np.ndarray, d: list[float]) -> np.ndarray:
    return n - np.array([0.0, *d])[np.minimum(n, 3)]


_GRAMS = ("v", "w", "runs", "u", "n")
_CONTEXT = ("sum", "ones", "twos", "more")


def _pairs(first: bytes, second: bytes) -> np.ndarray:
    return _from_planes(first, steps=True) << 32 | _from_planes(second, steps=True)


def _contexts_of(row, shards: Shards) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Contexts of a shard's trigrams in the order of their homes, with these, and the place and count of each trigram."""
    v, _, runs, u = _unpacked(row)
    return *_ranked(u, np.repeat(v, runs), shards), _from_planes(row.n)


def contexts(triples: DataFrame, shards: Shards) -> DataFrame:
    """Sums of contexts for each shard ``s``: from home ``h`` in the order of ``_contexts_of``, and those at ``home``.

    The home of a context is the shard that holds it as a bigram.
    """
    names = ["h", "s", "u", "v", *_CONTEXT]

    def tell(frames):
        for frame in frames:
            for row in frame.itertuples(index=False):
                place, home, u, v, n = _contexts_of(row, shards)
                sums = _sums_of(place, n)
                yield pd.DataFrame(
                    [
                        (int(home[i]), row.s, *(_planes(x[i:j], steps=True) for x in (u, v)), *(_planes(x[i:j]) for x in sums))
                        for i, j in _spans(home)
                    ],
                    columns=names,
                )

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        keys = [_pairs(u, v) for u, v in zip(rows["u"], rows["v"], strict=True)]
        pairs, place = np.unique(np.concatenate(keys), return_inverse=True)
        totals = []
        for c in _CONTEXT:
            total = np.zeros(len(pairs), np.int64)
            np.add.at(total, place, np.concatenate([_from_planes(x) for x in rows[c]]))
            totals.append(total)
        h, ends = int(rows["h"].iloc[0]), np.cumsum([0, *map(len, keys)])
        found = [
            (s, h, False, b"", b"", *(_planes(t[place[i:j]]) for t in totals))
            for s, i, j in zip(rows["s"], ends[:-1], ends[1:], strict=True)
        ]
        own = (_planes(x, steps=True) for x in (pairs >> 32, pairs & 0xFFFFFFFF))
        found.append((h, h, True, *own, *(_planes(t) for t in totals)))
        return pd.DataFrame(found, columns=["s", "h", "home", *names[2:]])

    blobs = ", ".join(f"{c} binary" for c in names[2:])
    told = triples.select("s", *_GRAMS).mapInPandas(tell, f"h long, s long, {blobs}")
    return told.groupBy("h").applyInPandas(add, f"s long, h long, home boolean, {blobs}")


@dataclass(frozen=True)
class Weights:
    """What makes logarithms to base 10, times ``SCALE``, of counts and the sums of their contexts."""

    d1: list[float]  # discounts of words, bigrams, trigrams
    d2: list[float]
    d3: list[float]
    total: int  # of the counts of words
    even: float  # what each token has of the rest of words
    start: int  # weight of the two start tokens as a context

    def one(self, kinds: np.ndarray) -> np.ndarray:
        """Probabilities of words."""
        return np.where(kinds > 0, _cut(kinds, self.d1) / self.total, 0.0) + self.even

    def rest(self, sums: list[np.ndarray]) -> np.ndarray:
        """What words leave to the lower order, as contexts."""
        return np.where(sums[0] > 0, _rests([np.maximum(sums[0], 1), *sums[1:]], self.d2), 1.0)

    def of(self, row, v: np.ndarray, w: np.ndarray, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Weights of a shard's bigrams and trigrams."""
        n, token, kinds = _from_planes(row.n), _from_planes(row.token, steps=True), _from_planes(row.kinds)
        words, left, after = ([_from_planes(getattr(row, f"{a}_{c}")) for c in _CONTEXT] for a in ("word", "left", "after"))
        p1, rest = self.one(kinds), self.rest(words)
        at_v, at_w = np.searchsorted(token, v), np.searchsorted(token, w)
        p1, rest = p1[at_w], rest[at_v]
        p2 = _cut(_bigram_counts(v, runs, n), self.d2) / words[0][at_v] + rest * p1
        two = p2 / (rest * p1)
        here = after[0] > 0
        two[here] *= _rests([x[here] for x in after], self.d3)
        lower = _rests(left, self.d3) * np.repeat(p2, runs)
        three = _cut(n, self.d3) / left[0] / lower + 1
        return _whole(np.log10(two)), _whole(np.log10(three))


def _whole(log: np.ndarray) -> np.ndarray:
    return np.rint(log * SCALE).astype(np.int64)


def weights(triples: DataFrame, vocabulary: int, shards: Shards) -> tuple[DataFrame, DataFrame, Weights]:
    """``kinds`` and sums as a context of each ``token``, sums for each shard ``s`` (``Weights.of``), and the discounts."""
    seen = triples.agg(*(F.sum(F.col("seen")[i]).alias(f"_{i}") for i in range(12))).first()
    seen = [x or 0 for x in seen]
    d3, d2 = (discounts(dict(enumerate(seen[i : i + 4], 1))) for i in (0, 4))
    each = triples.select(F.explode(F.arrays_zip("w_token", "w_kinds")).alias("x"))
    singles = each.groupBy(F.col("x.w_token").alias("w")).agg(F.sum("x.w_kinds").alias("kinds"))
    each = triples.select(F.explode(F.arrays_zip("v_token", *(f"v_{c}" for c in _CONTEXT))).alias("x"))
    after_one = each.groupBy(F.col("x.v_token").alias("v")).agg(*(F.sum(f"x.v_{c}").alias(c) for c in _CONTEXT))
    words = singles.join(after_one, F.col("w") == F.col("v"), "full").na.fill(0, ["kinds", *_CONTEXT])
    words = stored(words.select(F.coalesce("w", "v").alias("token"), "kinds", *_CONTEXT), "words", "zstd")
    all_, d1 = _contexts(words.filter("kinds > 0").select(F.col("kinds").alias("n"), F.lit(0).alias("all")), "all")
    total = all_.first()
    even = (total["rest"] if total else 1.0) / (RESERVED + vocabulary)
    start = int(_whole(np.log10(_rests(seen[8:], d3)))) if seen[8] else 0
    model = Weights(d1, d2, d3, total["_sum"] if total else 1, even, start)

    told = stored(contexts(triples, shards), "contexts")
    needs = triples.select("s", F.explode(F.array_union("v_token", "w_token")).alias("token")).join(words, "token")
    needs = needs.groupBy("s").agg(F.collect_list(F.struct("token", "kinds", *_CONTEXT)).alias("_words"))
    needs = needs.select("s", *(F.col(f"_words.{c}").alias(c) for c in ("token", "kinds", *_CONTEXT)))
    by_shard = told.groupBy("s").agg(F.collect_list(F.struct("h", "home", "u", "v", *_CONTEXT)).alias("told"))
    names = ["s", "token", "kinds", *(f"{a}_{c}" for a in ("word", "left", "after") for c in _CONTEXT)]

    def pack(frames):
        for frame in frames:
            for row in frame.itertuples(index=False):
                order = np.argsort(row.token)
                words = [np.asarray(getattr(row, c))[order] for c in ("token", "kinds", *_CONTEXT)]
                place, home, *_ = _contexts_of(row, shards)
                left = [np.zeros(len(home), np.int64) for _ in _CONTEXT]
                pairs = _pairs(row.v, row.w)
                after = [np.zeros(len(pairs), np.int64) for _ in _CONTEXT]
                for told in row.told:
                    sums = [_from_planes(told[c]) for c in _CONTEXT]
                    if told["home"]:
                        at, _ = _find(pairs, _pairs(told["u"], told["v"]), sums[0])
                        after = [np.where(at < 0, 0, x[at]) for x in sums]
                        continue
                    i = np.searchsorted(home, told["h"])
                    for own, part in zip(left, sums, strict=True):
                        own[i : i + len(part)] = part
                blobs = [_planes(x) for x in (*words[1:], *(x[place] for x in left), *after)]
                yield pd.DataFrame([(row.s, _planes(words[0], steps=True), *blobs)], columns=names)

    rows = triples.select("s", *_GRAMS).join(needs, "s").join(by_shard, "s")
    sums = stored(rows.mapInPandas(pack, "s long, " + ", ".join(f"{c} binary" for c in names[1:])), "sums")
    _forget(told)
    return words, sums, model


def single_words(parts: DataFrame, words: DataFrame, model: Weights) -> DataFrame:
    """``b``, ``docs`` and ``sums``: what documents have by words alone and by the two start tokens, as a stored table."""

    def tell(frames):
        for frame in frames:
            for b, ids in zip(frame["b"], frame["ids"], strict=True):
                yield pd.DataFrame({"b": b, "token": np.append(np.arange(RESERVED), RESERVED + _from_planes(ids, steps=True))})

    told = parts.select("b", "ids").mapInPandas(tell, "b long, token long").join(words, "token")
    told = told.groupBy("b").agg(F.collect_list(F.struct("token", "kinds", *_CONTEXT)).alias("_words"))
    told = told.select("b", *(F.col(f"_words.{c}").alias(c) for c in ("token", "kinds", *_CONTEXT)))

    def run(frames):
        for frame in frames:
            for row in frame.itertuples(index=False):
                layout = Layout(row.tokens, row.sizes, row.ids)
                one = np.full(RESERVED + len(layout.ids), _whole(np.log10(model.even)))
                rest = np.zeros(len(one), np.int64)
                if row.token is not None:
                    token = np.asarray(row.token)
                    at = np.where(token < RESERVED, token, RESERVED + np.searchsorted(layout.ids, token - RESERVED))
                    one[at] = _whole(np.log10(model.one(np.asarray(row.kinds))))
                    rest[at] = _whole(np.log10(model.rest([np.asarray(getattr(row, c)) for c in _CONTEXT])))
                single = layout.spread(one)[layout.at] + layout.spread(rest)[layout.at - 1]
                sums = np.add.reduceat(single, layout.begins) + model.start
                docs = _planes(np.arange(len(sums)), steps=True)
                yield pd.DataFrame([(row.b, docs, _planes(sums))], columns=["b", "docs", "sums"])

    rows = parts.select("b", "tokens", "sizes", "ids").join(told, "b", "left")
    return stored(rows.mapInPandas(run, "b long, docs binary, sums binary"), "single_words")


def asked(parts: DataFrame, shards: Shards) -> DataFrame:
    """What portions hold of each shard ``s``: ``v``, ``w``, ``runs``, ``u``, ``docs`` and ``n``, packed."""
    names = ["s", "b", "v", "w", "runs", "u", "docs", "n"]

    def run(frames):
        for frame in frames:
            for row in frame.itertuples(index=False):
                layout = Layout(row.tokens, row.sizes, row.ids)
                u, v, w = layout.grams()
                place, shard, v, w = _ranked(v, w, shards)
                keys, doc = place << 32 | u, layout.doc
                del place, u, layout
                order = np.argsort(keys, kind="stable")  # documents stay in order
                keys, doc = keys[order], doc[order]
                at = _begins(keys, doc)  # equal n-grams of a document are told once
                n, keys, doc = np.diff(np.append(at, len(keys))), keys[at], doc[at]
                del order, at
                parcels = _parcels(keys >> 32, shard, v, w, keys & 0xFFFFFFFF, doc, n)
                yield pd.DataFrame([(s, row.b, *blobs) for s, *blobs in parcels], columns=names)

    schema = "s long, b long, " + ", ".join(f"{c} binary" for c in names[2:])
    return parts.select("b", "tokens", "sizes", "ids").mapInPandas(run, schema)


def _find(keys: np.ndarray, table: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of keys in a sorted table, -1 where there is none, and their values, zero there."""
    if not len(table):
        return np.full(len(keys), -1), np.zeros(len(keys), np.int64)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    here = table[at] == keys
    return np.where(here, at, -1), np.where(here, values[at], 0)


def answered(asks: pd.DataFrame, grams: pd.DataFrame, model: Weights) -> pd.DataFrame:
    """Sums of weights by portion and document, within one shard."""
    pairs = triples = pair_weights = triple_weights = np.zeros(0, np.int64)
    for row in grams.itertuples(index=False):  # one at most
        v, w, runs, u = _unpacked(row)
        pairs, triples = v << 32 | w, np.repeat(np.arange(len(v)), runs) << 32 | u
        pair_weights, triple_weights = model.of(row, v, w, runs)
    found = []
    for row in asks.itertuples(index=False):
        if not len(pairs):
            break
        (v, w, runs, u), doc, n = _unpacked(row), _from_planes(row.docs), _from_planes(row.n)
        at, by_pair = _find(v << 32 | w, pairs, pair_weights)
        by_triple = _find(np.repeat(at, runs) << 32 | u, triples, triple_weights)[1]
        sums = np.zeros(int(doc.max()) + 1, np.int64)
        np.add.at(sums, doc, n * (np.repeat(by_pair, runs) + by_triple))
        some = np.flatnonzero(sums)
        if len(some):
            found.append((row.b, _planes(some, steps=True), _planes(sums[some])))
    return pd.DataFrame(found, columns=["b", "docs", "sums"])


def _added(frames):
    for frame in frames:
        for b, all_ in zip(frame["b"], frame["_all"], strict=True):
            found = [(_from_planes(x["docs"], steps=True), _from_planes(x["sums"])) for x in all_]
            total = np.zeros(max(int(doc.max()) for doc, _ in found) + 1, np.int64)
            for doc, sums in found:
                total[doc] += sums
            yield pd.DataFrame([(b, _planes(np.arange(len(total)), steps=True), _planes(total))], columns=["b", "docs", "sums"])


def _listed(frames):
    for frame in frames:
        yield pd.DataFrame({"b": frame["b"], "totals": [_from_planes(x) for x in frame["sums"]]})


def _together(tables: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


def scored(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``lang``, ``learn``, ``n_tokens`` and ``log10_prob`` of every row, as a stored table.

    ``docs``: ``doc_id``, ``lang``, ``_learn`` (whether the model learns from it) and ``_text``.
    """
    told = portions(docs)
    size = F.sum(F.expr("aggregate(sizes, 0L, (a, x) -> a + x + 1)"))
    tokens, count = told.agg(size, F.count(F.lit(1))).first()
    least = 4 * told.sparkSession.sparkContext.defaultParallelism
    rounds = min(ROUNDS, max(1, count // 4))
    vocabulary, known, shards = vocabulary_of(told, max(least, -(-(tokens or 0) // SHARD_TOKENS)))
    tables = [coded(told.filter(F.pmod("turn", F.lit(rounds)) == i), vocabulary) for i in range(rounds)]
    rows = stored(told.select("b", "doc_id", "lang", "learn", "sizes"), "rows")
    _forget(told, vocabulary)
    parts = _together(tables)
    triples = trigrams(parts, shards)
    words, sums, model = weights(triples, known, shards)
    answers = []
    for some in tables:
        answers.append(single_words(some, words, model))
        asks = asked(some, shards).groupBy("s")
        grams = triples.select("s", *_GRAMS).join(sums, "s").groupBy("s")
        some = asks.cogroup(grams).applyInPandas(partial(answered, model=model), "b long, docs binary, sums binary")
        some = some.groupBy("b").agg(F.collect_list(F.struct("docs", "sums")).alias("_all"))
        answers.append(stored(some.mapInPandas(_added, "b long, docs binary, sums binary"), "answers"))
    totals = _together(answers).groupBy("b").agg(F.collect_list(F.struct("docs", "sums")).alias("_all"))
    totals = totals.mapInPandas(_added, "b long, docs binary, sums binary").mapInPandas(_listed, "b long, totals array<long>")
    each = rows.join(totals, "b").select(F.explode(F.arrays_zip("doc_id", "lang", "learn", "sizes", "totals")).alias("x"))
    found = each.select(
        "x.doc_id", "x.lang", "x.learn", (F.col("x.sizes").cast("long") + 1).alias("n_tokens"),
        (F.col("x.totals") / SCALE).alias("log10_prob"),
    )
    found = stored(found, "scores")
    _forget(rows, *tables, words, triples, sums, *answers)
    return found


def classify(docs: DataFrame, labels: DataFrame, text: str = "text", trusted: Column | None = None) -> DataFrame:
    """``doc_id``, ``lang``, ``n_tokens``, ``perplexity``, ``limit`` (for long texts) and ``kept``.

    ``labels`` has ``doc_id``, ``quality`` and ``toxic``; ``trusted`` marks its trusted rows.
    """
    trusted = F.col("quality").eqNullSafe(1) & ~F.col("toxic").eqNullSafe(1) if trusted is None else trusted
    good = labels.groupBy("doc_id").agg(F.min(trusted.cast("int")).alias("_good")).filter("_good = 1")
    spared = F.pmod(F.xxhash64(F.lit(11), "_text"), F.lit(HELD_OUT)) == 0  # by text: no copy of one is learned
    rows = docs.select("doc_id", "lang", F.col(text).alias("_text")).join(good, "doc_id", "left")
    found = scored(rows.withColumn("_learn", F.when(F.col("_good") == 1, ~spared)))
    held_out = found.filter("NOT learn AND n_tokens > 1")
    inside = found.filter("learn IS NOT NULL AND n_tokens > 1")
    basis = held_out if held_out.limit(1).count() else inside  # a table whose trusted rows are all learned

    of_language = basis.groupBy("lang").agg(F.sum("log10_prob").alias("_s"), F.sum("n_tokens").alias("_t"))
    overall = basis.agg((F.sum("log10_prob") / F.sum("n_tokens")).alias("_all"))
    means = of_language.select(F.col("lang").alias("_lang"), (F.col("_s") / F.col("_t")).alias("_mean"))

    def drawn(frame: DataFrame) -> DataFrame:
        joined = frame.join(means, frame["lang"].eqNullSafe(means["_lang"]), "left").crossJoin(F.broadcast(overall))
        mean = F.coalesce("_mean", "_all")
        value = (F.col("log10_prob") + PRIOR * mean) / (F.col("n_tokens") + PRIOR)
        return joined.select(*frame.columns, value.alias("_value"))

    def limits(*by: str) -> DataFrame:
        ends = F.percentile_approx("_value", F.array(F.lit(1 - QUANTILE), F.lit(0.5)), F.lit(10_000))
        part = drawn(basis).groupBy(*by).agg(ends.alias("_ends"), F.count(F.lit(1)).alias("_n"))
        low, middle = F.col("_ends")[0], F.col("_ends")[1]
        return part.select(*by, (middle - (1 + 2 / F.sqrt("_n")) * (middle - low)).alias("_least"))

    own = limits("lang").withColumnsRenamed({"lang": "_lang", "_least": "_own"})
    valued = drawn(found)
    joined = valued.join(own, valued["lang"].eqNullSafe(own["_lang"]), "left").crossJoin(F.broadcast(limits()))
    least = F.coalesce("_own", "_least")
    fits = F.coalesce(F.col("_value") >= least, F.lit(True))
    return joined.select(
        "doc_id",
        "lang",
        "n_tokens",
        F.pow(F.lit(10.0), -F.col("log10_prob") / F.col("n_tokens")).alias("perplexity"),
        F.pow(F.lit(10.0), -least).alias("limit"),
        (fits | (F.col("n_tokens") == 1)).alias("kept"),
    )
