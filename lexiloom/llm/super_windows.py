"""Removal of repeated word windows by super-k-mer partitioning.

A window is ``length`` consecutive words of one document.  Its minimiser is the first smallest among its runs of
``MINIMISER`` words, so equal windows have equal minimisers at equal places.  Consecutive windows that share a
minimiser are one super-window: its words travel once, as one string, to the bucket of that minimiser, where the
windows of each minimiser are sorted and counted by their words.

* Order of minimisers: by hash, but runs that are frequent in the corpus come last.  A window that reaches over the
  edge of a frequent passage has a run across that edge, which is rare, so only windows wholly inside such passages
  meet at a frequent minimiser, and those are equal.  Frequent runs are found by counting all runs of all texts: a
  task passes on those that make up half of ``SHARE`` of its runs (or ``OFTEN`` occurrences, if that is more), and
  those that make up half of ``SHARE`` of the corpus are frequent.  At most 2 / ``SHARE`` runs can be, 4 MB.
* Equal super-windows fold before they travel: a task sends one row per string and batch of texts.  Places of a
  string that occurs twice in a batch are known to repeat and need no answer; equal texts of a batch fold first.
* The strings of one batch for one bucket travel as one zstd block.  The number of buckets follows the corpus, so
  that a bucket holds about ``BUCKET`` bytes of strings.
* Answers are ranges of words by text digest; documents with equal texts have equal results.

Defined results: a null text has no words; texts shorter than a window keep all; windows are judged on the input, so
what is left may hold a repeated window across a gap; repeated rows are documents that repeat each other; the id is
copied as it is, null or not, and never used as a key; other columns are ignored.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.scratch import stored

LENGTH = 35
MINIMISER = 8
SHARE = 2.0**-18
OFTEN = 8
BATCH = 1 << 21  # bytes of texts cut together; a longer text is cut in parts
BUCKET = 48 << 20

_INDEX_BITS = 22
_INDEX = np.uint64((1 << _INDEX_BITS) - 1)
_LATE = np.uint64(1 << 63)
_RANDOM = np.random.default_rng(11)
_LETTERS = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_PLACES = _RANDOM.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Powers:
    """Powers of the base and of its inverse, as far as they have been asked for."""

    up = down = np.zeros(0, np.uint64)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            cls.up, cls.down = _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)
        return cls.up, cls.down


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    return h


class Words:
    """Words of several texts, one after the other: places in the joined bytes, text of each word, hashes of runs."""

    def __init__(self, texts: list[bytes], width: int):
        self.raw = b"\n".join(texts)  # words are joined by one space, texts by one line feed
        raw = np.frombuffer(self.raw, np.uint8)
        gaps = np.flatnonzero((raw == 32) | (raw == 10))
        self.begin = np.concatenate([[0], gaps + 1])
        self.end = np.concatenate([gaps, [len(raw)]])
        breaks = np.flatnonzero(raw[gaps] == 10) + 1
        self.first_word = np.concatenate([[0], breaks])
        sizes = np.diff(np.concatenate([self.first_word, [len(self.begin)]]))
        self.owner = np.repeat(np.arange(len(texts)), sizes)
        self.left = np.repeat(self.first_word + sizes, sizes) - np.arange(len(self.begin))  # words left in the text
        up, down = _Powers.upto(len(raw) + 1)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(_LETTERS[raw] * up[: len(raw)])])
        word = _mix((sums[self.end] - sums[self.begin]) * down[self.begin])
        n = max(len(word) - width + 1, 0)
        runs = np.zeros(n, np.uint64)
        for i in range(width):
            runs += word[i : i + n] * _PLACES[i]
        self.runs = _mix(runs)

    def cut(self, length: int, width: int, frequent: np.ndarray) -> tuple[np.ndarray, ...]:
        """Super-windows: first and last window (by first word), place of the minimiser and its hash."""
        rank = (self.runs >> np.uint64(1)) & ~_INDEX
        if len(frequent):
            at = np.minimum(np.searchsorted(frequent, self.runs), len(frequent) - 1)
            rank |= np.where(frequent[at] == self.runs, _LATE, np.uint64(0))
        low = rank | np.arange(len(rank), dtype=np.uint64)
        span, wide = 1, length - width + 1
        while 2 * span <= wide:  # smallest of a span from minima of half the span
            low = np.minimum(low[: len(low) - span], low[span:])
            span *= 2
        if span < wide:
            low = np.minimum(low[: len(low) - (wide - span)], low[wide - span :])
        windows = np.flatnonzero(self.left[: len(low)] >= length)
        if not len(windows):
            return (windows,) * 4
        place = (low[windows] & _INDEX).astype(np.int64)
        new = np.concatenate([[True], (place[1:] != place[:-1]) | (windows[1:] != windows[:-1] + 1)])
        first = np.flatnonzero(new)
        last = np.concatenate([first[1:] - 1, [len(windows) - 1]])
        return windows[first], windows[last], place[first], self.runs[place[first]]


def parts_of(text: bytes, length: int) -> Iterator[tuple[int, bytes]]:
    """Word sequences of a text, joined by one space, with the number of their first word.

    A long text comes in parts that overlap by one word less than a window, so every window is in exactly one.
    """
    words = text.split()
    if len(words) < length:
        return
    if len(text) <= BATCH:
        yield 0, b" ".join(words)
        return
    step = max(length, int(len(words) * BATCH / len(text)))
    for at in range(0, len(words) - length + 1, step):
        yield at, b" ".join(words[at : at + step + length - 1])


Part = tuple[int, int, bytes]  # number of the text in its batch, first word, words


def text_batches(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple[list[bytes], list[int], list[Part]]]:
    """Digests of distinct texts of a window and more, how often each occurs, and their parts.

    A batch has at most about twice ``BATCH`` bytes; one that ends inside a long text lets the text go on in the next.
    """
    number: dict[bytes, int] = {}
    keys: list[bytes] = []
    copies: list[int] = []
    parts: list[Part] = []
    size = 0
    for batch in batches:
        for key, text in zip(batch["_key"], batch["_text"], strict=True):
            digest = key.as_py()
            if digest in number:
                copies[number[digest]] += 1
                continue
            found = False
            for at, words in parts_of(text.as_py(), length):
                if not found:
                    number[digest] = len(keys)
                    keys.append(digest)
                    copies.append(1)
                    found = True
                parts.append((number[digest], at, words))
                size += len(words)
                if size >= BATCH:
                    yield keys, copies, parts
                    keys, copies, parts, size = [digest], [1], [], 0
                    number = {digest: 0}
    if parts or any(c > 1 for c in copies):
        yield keys, copies, parts


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted ranges without overlap."""
    out: list[tuple[int, int]] = []
    for begin, stop in sorted(ranges):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], stop))
        else:
            out.append((begin, stop))
    return out


def _pack(ranges: list[tuple[int, int]]) -> bytes:
    return np.array(ranges, np.int32).tobytes()


def unpack(ranges: bytes) -> list[tuple[int, int]]:
    return [tuple(x) for x in np.frombuffer(ranges, np.int32).reshape(-1, 2).tolist()]


ALL_WORDS = (0, 2**31 - 1)
SCHEMA = "bucket int, block binary, _key binary, ranges binary"
_ARROW = pa.schema(
    [("bucket", pa.int32()), ("block", pa.binary()), ("_key", pa.binary()), ("ranges", pa.binary())]
)
ANSWERS = "_key binary, ranges binary"
_ANSWERS = pa.schema([("_key", pa.binary()), ("ranges", pa.binary())])


class _Strings:
    """Super-windows of one batch, folded: string -> place of its minimiser, hash, text and first word, or repeated."""

    def __init__(self, keys: list[bytes], copies: list[int], parts: list[Part], length: int, frequent: np.ndarray):
        self.keys = keys
        self.known: dict[int, list[tuple[int, int]]] = {}  # ranges of words known to repeat, by text
        self.rows: dict[bytes, list] = {}
        if not parts:
            return
        words = Words([p[2] for p in parts], MINIMISER)
        first, last, place, run = words.cut(length, MINIMISER, frequent)
        owner = words.owner[first]
        start = first - words.first_word[owner]
        begin, end = words.begin[first], words.end[last + length - 1]
        columns = (begin, end, place - first, run, owner, start, last - first)
        for b, e, p, r, o, s, more in zip(*(c.tolist() for c in columns), strict=True):
            text, offset, _ = parts[o]
            at = (text, s + offset, s + offset + more + length)
            string = words.raw[b:e]
            row = self.rows.get(string)
            if row is None:
                self.rows[string] = [p, r, at, copies[text] > 1]
            else:
                if not row[3]:
                    row[3] = True
                    self._know(row[2])
                self._know(at)
        for text, n in enumerate(copies):
            if n > 1:
                self.known[text] = [ALL_WORDS]

    def _know(self, at: tuple[int, int, int]) -> None:
        self.known.setdefault(at[0], []).append(at[1:])

    def blocks(self, buckets: int) -> Iterator[tuple[int, bytes]]:
        """The strings of each bucket as one block."""
        if not self.rows:
            return
        strings = list(self.rows)
        rows = list(self.rows.values())
        run = np.array([r[1] for r in rows], np.uint64)
        bucket = (_mix(run) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[order])) + 1
        squeeze = zstandard.ZstdCompressor(level=3)
        for group in np.split(order, cuts):
            members = group.tolist()
            lone = [i for i in members if not rows[i][3]]
            body = b"".join(
                [
                    struct.pack("<II", len(members), len(lone)),
                    run[group].tobytes(),
                    np.array([len(strings[i]) for i in members], np.int32).tobytes(),
                    np.array([rows[i][0] for i in members], np.int16).tobytes(),
                    np.array([rows[i][3] for i in members], np.uint8).tobytes(),
                    np.array([rows[i][2][1] for i in lone], np.int32).tobytes(),
                    b"".join(self.keys[rows[i][2][0]] for i in lone),
                    b"".join(strings[i] for i in members),
                ]
            )
            yield int(bucket[members[0]]), squeeze.compress(body)


def _read_block(block: bytes) -> Iterator[tuple[int, bytes, int, tuple[bytes, int] | None]]:
    """Hash of the minimiser, string, place of the minimiser, and text digest and first word where an answer is due."""
    body = zstandard.ZstdDecompressor().decompress(block)
    n, lone = struct.unpack_from("<II", body)
    at = 8
    arrays = []
    for count, kind in ((n, np.uint64), (n, np.int32), (n, np.int16), (n, np.uint8), (lone, np.int32)):
        array = np.frombuffer(body, kind, count, at)
        at += array.nbytes
        arrays.append(array)
    keys, at = at, at + 16 * lone
    ends = (at + np.cumsum(arrays[1])).tolist()
    due = 0
    starts = arrays[4].tolist()
    for run, end, place, repeated in zip(arrays[0].tolist(), ends, arrays[2].tolist(), arrays[3].tolist(), strict=True):
        who = None
        if not repeated:
            who = (body[keys + 16 * due : keys + 16 * due + 16], starts[due])
            due += 1
        yield run, body[at:end], place, who
        at = end


def repeated_windows(strings: dict[bytes, tuple[int, bool]], length: int) -> dict[bytes, list[tuple[int, int]]]:
    """Ranges of repeated windows, in words, of super-windows of one minimiser (place of it; whether it repeats whole).

    Windows with the minimiser at one place are sorted together: others cannot equal them.
    """
    gaps = {s: [-1, *(i for i, c in enumerate(s) if c == 32), len(s)] for s in strings}
    at_place: dict[int, list[bytes]] = {}
    for s, (place, _) in strings.items():
        for p in range(max(place - (len(gaps[s]) - 1 - length), 0), place + 1):
            at_place.setdefault(p, []).append(s)
    hits: dict[bytes, list[int]] = {s: [] for s in strings}
    for p, members in at_place.items():
        if len(members) < 2:
            continue
        windows = []
        for i, s in enumerate(members):
            first = strings[s][0] - p
            windows.append((s[gaps[s][first] + 1 : gaps[s][first + length]], i, first))
        windows.sort()
        for a, b in zip(windows[:-1], windows[1:], strict=True):
            if a[0] == b[0]:
                for _, i, first in (a, b):
                    hits[members[i]].append(first)
    return {
        s: [(0, len(gaps[s]) - 1)] if strings[s][1] else merged([(j, j + length) for j in found])
        for s, found in hits.items()
    }


def _answers(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Counts the windows of a bucket, minimiser by minimiser; holds its distinct strings and nothing per occurrence."""

    def batch_of(found: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
        return pa.record_batch([pa.array([f[i] for f in found], pa.binary()) for i in (0, 1)], schema=_ANSWERS)

    groups: dict[int, dict[bytes, list]] = {}
    found: list[tuple[bytes, bytes]] = []
    for batch in batches:
        passed = batch.filter(batch["_key"].is_valid())
        if passed.num_rows:
            yield pa.record_batch([passed["_key"], passed["ranges"]], schema=_ANSWERS)
        for block in batch["block"]:
            if not block.is_valid:
                continue
            for run, string, place, who in _read_block(block.as_py()):
                strings = groups.setdefault(run, {})
                row = strings.get(string)
                if row is None:
                    strings[string] = [place, who]  # without a text: it repeats as a whole
                    continue
                for key, first in (x for x in (row[1], who) if x is not None):
                    found.append((key, _pack([(first, first + string.count(b" ") + 1)])))
                row[1] = None
            if len(found) >= 20_000:
                yield batch_of(found)
                found = []
    for strings in groups.values():
        if len(strings) == 1:
            continue
        for string, ranges in repeated_windows({s: (p, w is None) for s, (p, w) in strings.items()}, length).items():
            if strings[string][1] is not None and ranges:
                key, first = strings[string][1]
                found.append((key, _pack([(first + a, first + b) for a, b in ranges])))
        if len(found) >= 20_000:
            yield batch_of(found)
            found = []
    if found:
        yield batch_of(found)


def _texts(df: DataFrame, text: str) -> DataFrame:
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return df.select(F.unhex(F.md5(content)).alias("_key"), content.cast("binary").alias("_text"))


def frequent_runs(df: DataFrame, text: str = "text", length: int = LENGTH) -> tuple[np.ndarray, int]:
    """Sorted hashes of runs that are frequent in the corpus, at most 2 / ``SHARE``, and the bytes of all windows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("run", pa.int64()), ("n", pa.int64()), ("bytes", pa.int64())])
        runs = np.zeros(0, np.uint64)
        counts = np.zeros(0, np.int64)
        total = size = 0
        for _, _, parts in text_batches(batches, length):
            if not parts:
                continue
            words = Words([p[2] for p in parts], MINIMISER)
            whole = words.runs[words.left[: len(words.runs)] >= MINIMISER]
            total, size = total + len(whole), size + len(words.raw)
            found, n = np.unique(whole, return_counts=True)
            often = n >= 2  # of one batch, as what is left of a batch must not grow with the task
            both, of_both = np.concatenate([runs, found[often]]), np.concatenate([counts, n[often]])
            runs, at = np.unique(both, return_inverse=True)
            counts = np.bincount(at, of_both, len(runs)).astype(np.int64)
            if len(runs) > 4 / SHARE:
                runs, counts = (x[counts >= max(OFTEN, SHARE / 2 * total)] for x in (runs, counts))
        keep = counts >= max(OFTEN, SHARE / 2 * total)
        runs, counts = runs[keep].view(np.int64), counts[keep]
        yield pa.record_batch([pa.array(runs), pa.array(counts), pa.nulls(len(runs), pa.int64())], schema=schema)
        yield pa.record_batch([pa.nulls(1, pa.int64()), pa.array([total]), pa.array([size])], schema=schema)

    counted = stored(_texts(df, text).mapInArrow(count, "run long, n long, bytes long"), "window_runs")
    total, size = counted.filter("run IS NULL").agg(F.sum("n"), F.sum("bytes")).first()
    often = counted.filter("run IS NOT NULL").groupBy("run").agg(F.sum("n").alias("n"))
    often = often.filter(F.col("n") >= max(OFTEN, SHARE / 2 * (total or 0))).select("run").toPandas()["run"]
    return np.sort(often.to_numpy(np.int64).view(np.uint64)), size or 0


def repeated_ranges(df: DataFrame, text: str = "text", length: int = LENGTH) -> DataFrame:
    """``_key`` (MD5 of the text) and ``ranges`` of words in repeated windows, one row per text that has any."""
    spark = df.sparkSession
    frequent, size = frequent_runs(df, text, length)
    step = (length - MINIMISER + 2) / 2  # windows of a super-window, on average
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(size * (step + length) / step / BUCKET) + 1)
    sent = spark.sparkContext.broadcast(frequent)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, copies, parts in text_batches(batches, length):
            batch = _Strings(keys, copies, parts, length, sent.value)
            blocks = list(batch.blocks(buckets))
            n = len(blocks)
            if n:
                arrays = [pa.array([b for b, _ in blocks], pa.int32()), pa.array([x for _, x in blocks], pa.binary())]
                yield pa.record_batch([*arrays, pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())], schema=_ARROW)
            known = [(keys[t], _pack(merged(ranges))) for t, ranges in batch.known.items()]
            if known:
                at = [int.from_bytes(k[:4], "little") % buckets for k, _ in known]
                yield pa.record_batch(
                    [
                        pa.array(at, pa.int32()),
                        pa.nulls(len(at), pa.binary()),
                        pa.array([k for k, _ in known], pa.binary()),
                        pa.array([r for _, r in known], pa.binary()),
                    ],
                    schema=_ARROW,
                )

    rows = _texts(df, text).mapInArrow(cut, SCHEMA).repartitionById(buckets, F.col("bucket"))
    answers = rows.mapInArrow(lambda batches: _answers(batches, length), ANSWERS)
    return answers.groupBy("_key").agg(F.collect_set("ranges").alias("ranges"))


def remove_windows(df: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and ``kept_text`` (the words that stay, joined by one space) of every row."""
    if not MINIMISER < length < 1 << 15:
        raise ValueError("a window must be longer than a minimiser")
    found = stored(repeated_ranges(df, text, length), "window_ranges")
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = df.select(F.col(f"`{key}`").alias("doc_id"), content.alias("_text"))
    # Texts too short for a window, equal ones above all, are spread by their ids: no range has such a key.
    apart = F.concat_ws(" ", F.col("doc_id").cast("string"), F.lit("short"))
    digest = F.md5(F.when(F.octet_length("_text") >= 2 * length - 1, F.col("_text")).otherwise(apart))
    joined = rows.withColumn("_key", F.unhex(digest)).join(found, "_key", "left").select("doc_id", "_text", "ranges")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, kept = [], [], []
            for text_, ranges in zip(batch["_text"], batch["ranges"], strict=True):
                words = text_.as_py().encode().split()
                counts.append(len(words))
                gone = merged([r for packed in ranges.as_py() or () for r in unpack(packed)])
                left: list[bytes] = []
                at = 0
                for begin, stop in gone:
                    left += words[at:begin]
                    at = stop
                left += words[at:]
                removed.append(len(words) - len(left))
                kept.append(b" ".join(left).decode())
            columns = [batch["doc_id"], pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())]
            yield pa.record_batch(columns, names=["doc_id", "n_words", "n_removed", "kept_text"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(keep, f"doc_id {kind}, n_words long, n_removed long, kept_text string")
