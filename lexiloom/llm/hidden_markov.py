"""Language-model scores of documents from a hidden Markov model trained over the corpus.

A document is its words in small ASCII letters and one end token.  Words fall into ``BUCKETS`` hash buckets; the
latent states emit buckets (the end is one of its own), and a bucket emits its words by their add-one counts, so
the model gives every text a probability and its tables are bounded however many words there are.

* Counts of words come from all training documents; each task combines its own before the shuffle.
* Baum-Welch: every partition runs the scaled forward and backward recursions over whole documents, many at a
  time, and returns expected counts; these meet in a tree of bounded fan-in, and the new tables go back out.
* Scores: the scaled forward recursion gives the exact likelihood of a whole sequence, the counts of its words
  the rest.  The ``HEAD`` most frequent words are looked up from a broadcast table of fixed size; the others,
  none of them frequent, are joined.

The base score is the add-one unigram score of the same counts.

Defined results: null and blank texts are the end token alone; without training documents every count is 0 and
the states stay as they start; rows that repeat an id are scored one by one; a null id trains (it has no
remainder, so it is not held out); columns of the input that clash with outputs are left out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.scratch import stored
from lexiloom.llm.words import lower_ascii, words

BUCKETS = 1 << 15
END = BUCKETS
STATES = 6
ROUNDS = 5
HEAD = 1 << 18
PRIOR = 50.0  # words that the corpus counts for in the emissions of a state
STICK = 20.0  # transitions that a state counts for before any are seen
CELLS = 300_000  # padded tokens of a batch
SLICES = 16
FAN_IN = 64


@dataclass(frozen=True)
class Tables:
    start: np.ndarray  # by state
    move: np.ndarray  # from, to
    emit: np.ndarray  # bucket, state


def first_tables(prior: np.ndarray, states: int = STATES) -> Tables:
    """States that differ by noise in their words: documents with the same words lean to the same state."""
    noise = np.random.default_rng(8).uniform(0.5, 1.5, (len(prior), states))
    emit = prior[:, None] * noise
    stay = 0.95
    move = np.full((states, states), (1 - stay) / max(states - 1, 1))
    np.fill_diagonal(move, stay if states > 1 else 1.0)
    return Tables(np.full(states, 1 / states), move, emit / emit.sum(axis=0))


def batches(sequences: list[np.ndarray]):
    """Positions of sequences of like length, longest first, whose padded size stays near ``CELLS``."""
    order = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))
    start = 0
    while start < len(order):
        width = len(sequences[order[start]])
        end = min(len(order), start + max(1, CELLS // width))
        yield order[start:end]
        start = end


def _padded(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Tokens by time and document, and how many documents are still running at each time."""
    lengths = np.array([len(s) for s in sequences])
    tokens = np.full((lengths[0], len(sequences)), END, np.int64)
    for i, s in enumerate(sequences):
        tokens[: len(s), i] = s
    running = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")
    return tokens, running


def forward(tables: Tables, sequences: list[np.ndarray], keep: bool = False):
    """Natural log likelihood of sequences (longest first); with ``keep`` also what the backward pass needs."""
    tokens, running = _padded(sequences)
    emitted = tables.emit[tokens]
    total = np.zeros(len(sequences))
    scales = np.ones(tokens.shape)
    alphas = np.zeros(emitted.shape) if keep else None
    alpha = tables.start * emitted[0]
    for t in range(len(tokens)):
        n = running[t]
        if t:
            alpha = (alpha[:n] @ tables.move) * emitted[t, :n]
        scale = alpha.sum(axis=1)
        alpha = alpha / scale[:, None]
        scales[t, :n] = scale
        if keep:
            alphas[t, :n] = alpha
    total = np.log(scales).sum(axis=0)
    return (total, tokens, running, emitted, scales, alphas) if keep else total


def expected_counts(tables: Tables, sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected starts, moves and emissions of a batch, and its log likelihood."""
    total, tokens, running, emitted, scales, alphas = forward(tables, sequences, keep=True)
    states = len(tables.start)
    gammas = np.zeros(emitted.shape)
    moves = np.zeros((states, states))
    beta = np.ones((len(sequences), states))
    for t in range(len(tokens) - 1, -1, -1):
        n = running[t]
        if t + 1 < len(tokens):
            m = running[t + 1]
            ahead = emitted[t + 1, :m] * beta[:m] / scales[t + 1, :m, None]
            moves += alphas[t, :m].T @ ahead
            beta[:m] = ahead @ tables.move.T
        gammas[t, :n] = alphas[t, :n] * beta[:n]
    moves *= tables.move
    live = np.arange(tokens.shape[1])[None, :] < running[:, None]
    at = tokens[live]
    weights = gammas[live]
    emissions = np.stack(
        [np.bincount(at, weights=weights[:, s], minlength=len(tables.emit)) for s in range(states)], axis=1
    )
    return gammas[0].sum(axis=0), moves, emissions, float(total.sum())


def next_tables(starts: np.ndarray, moves: np.ndarray, emissions: np.ndarray, prior: np.ndarray) -> Tables:
    states = len(starts)
    start = (starts + 1) / (starts.sum() + states)
    move = moves + 1 + STICK * np.eye(states)
    emit = emissions + PRIOR * prior[:, None]
    return Tables(start, move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def _sequences(column: pd.Series) -> list[np.ndarray]:
    return [np.append(np.frombuffer(raw, np.uint16), END).astype(np.int64) for raw in column]


def collected_counts(training: DataFrame, tables: Tables) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected counts of all training documents: sums per partition, then a tree of sums per slice of buckets."""
    spark = training.sparkSession
    shared = spark.sparkContext.broadcast(tables)  # STATES columns of BUCKETS + 1 numbers
    states = len(tables.start)

    def count(frames):
        from pyspark import TaskContext

        sums = None
        for frame in frames:
            sequences = _sequences(frame["seq"])
            for batch in batches(sequences):
                part = expected_counts(shared.value, [sequences[i] for i in batch])
                sums = part if sums is None else tuple(a + b for a, b in zip(sums, part, strict=True))
        if sums is not None:
            starts, moves, emissions, total = sums
            task = TaskContext.get().partitionId()
            rest = np.concatenate([starts, moves.ravel(), [total]]).tobytes()
            rows = [(-1, task, rest)]
            rows += [(i, task, part.tobytes()) for i, part in enumerate(np.array_split(emissions, SLICES))]
            yield pd.DataFrame(rows, columns=["slice", "task", "sums"])

    def add(key, frame: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(len(frame["sums"].iloc[0]) // 8)
        for raw in frame["sums"]:
            total += np.frombuffer(raw)
        return pd.DataFrame({"slice": [key[0]], "task": [key[1]], "sums": [total.tobytes()]})

    schema = "slice int, task int, sums binary"
    sums = training.select("seq").mapInPandas(count, schema)
    tasks = training.rdd.getNumPartitions()
    while tasks > 1:
        tasks = -(-tasks // FAN_IN)
        group = F.pmod(F.col("task"), F.lit(tasks)).cast("int").alias("task")
        sums = sums.select("slice", group, "sums").groupBy("slice", "task").applyInPandas(add, schema)
    found = {r["slice"]: np.frombuffer(bytes(r["sums"])) for r in sums.collect()}  # one row a slice
    if not found:
        return np.zeros(states), np.zeros((states, states)), np.zeros(tables.emit.shape), 0.0
    rest = found.pop(-1)
    emissions = np.concatenate([found[i] for i in range(SLICES)]).reshape(-1, states)
    return rest[:states], rest[states:-1].reshape(states, states), emissions, float(rest[-1])


def word_hashes(df: DataFrame, text: str) -> Column:
    return F.transform(words(lower_ascii(F.col(f"`{text}`"))), lambda w: F.xxhash64(w))


def frequent_words(counts: DataFrame) -> DataFrame:
    """The most frequent words, at most ``HEAD`` of them: whole bands of counts, an eighth of a power of two wide.

    Bands are few, so only their sizes and the words themselves reach the driver.
    """
    band = F.floor(8 * F.log2("c")).cast("int")
    sizes = sorted(counts.groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("n")).collect(), reverse=True)
    total, least = 0, None
    for row in sizes:
        total += row["n"]
        if total > HEAD:
            break
        least = row["band"]
    return counts.filter(F.lit(False) if least is None else band >= least)


def score(
    df: DataFrame, held_out: Column, key: str = "doc_id", text: str = "text", rounds: int = ROUNDS, states: int = STATES
) -> DataFrame:
    """``doc_id``, ``held_out``, token counts, ``train_tokens``, ``base_score`` and ``score`` (log10) of every row."""
    out = F.coalesce(held_out, F.lit(False))
    rows = df.select(F.col(f"`{key}`").alias("doc_id"), out.alias("held_out"), word_hashes(df, text).alias("h"))
    counts = stored(
        rows.filter(~F.col("held_out")).select(F.explode("h").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("c")),
        "word_counts",
    )
    bucket = F.pmod("word", F.lit(BUCKETS)).cast("int").alias("bucket")
    by_bucket = counts.groupBy(bucket).agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).toPandas()
    n_of, v_of = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
    n_of[by_bucket["bucket"]], v_of[by_bucket["bucket"]] = by_bucket["n"], by_bucket["v"]
    texts = df.select(out.alias("o")).filter(~F.col("o")).count()
    tokens, kinds = int(n_of.sum()) + texts, int(v_of.sum()) + (texts > 0)
    n_of[END] = texts
    prior = (n_of + 1) / (n_of.sum() + len(n_of))

    head = frequent_words(counts).toPandas().sort_values("word")
    frequent = df.sparkSession.sparkContext.broadcast((head["word"].to_numpy(np.int64), head["c"].to_numpy(np.int64)))

    def numbered(frames):
        known, c_of = frequent.value
        logs = np.log10(c_of + 1.0)
        for frame in frames:
            seqs, sizes, sums, seen, tails, times = [], [], [], [], [], []
            for h in frame["h"]:
                h = np.asarray(h, np.int64)
                at = np.minimum(np.searchsorted(known, h), max(len(known) - 1, 0))
                hit = known[at] == h if len(known) else np.zeros(len(h), bool)
                seqs.append((h % BUCKETS).astype(np.uint16).tobytes())
                sizes.append(len(h) + 1)
                sums.append(float(logs[at[hit]].sum()))
                seen.append(int(hit.sum()))
                tail, n = np.unique(h[~hit], return_counts=True)
                tails.append(tail)
                times.append(n)
            columns = {"seq": seqs, "n_tokens": sizes, "head_sum": sums, "head_known": seen, "tail": tails, "tf": times}
            yield frame[["row", "doc_id", "held_out"]].assign(**columns)

    schema = (
        "row long, doc_id long, held_out boolean, seq binary, n_tokens long, head_sum double, head_known long, "
        "tail array<long>, tf array<long>"
    )
    source = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", "h")
    documents = stored(source.mapInPandas(numbered, schema), "sequences")

    training = documents.filter(~F.col("held_out"))
    tables = first_tables(prior, states)
    for _ in range(rounds):
        starts, moves, emissions, _ = collected_counts(training, tables)
        tables = next_tables(starts, moves, emissions, prior)
    shared = df.sparkSession.sparkContext.broadcast((tables, np.log10(n_of + v_of + 1)))

    def likelihoods(frames):
        model, sizes = shared.value
        sizes = sizes.copy()
        sizes[END] = 0.0
        for frame in frames:
            sequences = _sequences(frame["seq"])
            values = np.zeros(len(sequences))
            for batch in batches(sequences):
                values[batch] = forward(model, [sequences[i] for i in batch]) / np.log(10)
            values -= [float(sizes[s].sum()) for s in sequences]
            yield frame.drop(columns="seq").assign(hmm=values)

    kept = documents.select("row", "doc_id", "held_out", "n_tokens", "head_sum", "head_known", "seq")
    fields = "row long, doc_id long, held_out boolean, n_tokens long, head_sum double, head_known long, hmm double"
    scored = kept.mapInPandas(likelihoods, fields)
    rare = documents.select("row", F.explode(F.arrays_zip("tail", "tf")).alias("x"))
    rare = rare.select("row", F.col("x.tail").alias("word"), F.col("x.tf").alias("tf")).join(counts, "word", "left")
    rest = rare.groupBy("row").agg(
        F.sum(F.col("tf") * F.log10(F.coalesce("c", F.lit(0)) + 1.0)).alias("_sum"),
        F.sum(F.when(F.col("c") > 0, F.col("tf")).otherwise(0)).alias("_known"),
    )
    joined = scored.join(rest, "row", "left")
    of_words = F.col("head_sum") + F.coalesce("_sum", F.lit(0.0))
    end = float(np.log10(texts + 1.0))
    below = float(np.log10(tokens + kinds + 1.0))
    return joined.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("head_known") + F.coalesce("_known", F.lit(0)) + int(texts > 0)).cast("long").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (of_words + end - F.col("n_tokens") * below).alias("base_score"),
        (of_words + F.col("hmm")).alias("score"),
    )
