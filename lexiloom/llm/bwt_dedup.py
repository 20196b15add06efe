"""Removal of long byte strings that occur more than once, by merging Burrows-Wheeler transforms of shards.

A window is a string of ``length`` bytes.  It belongs to its anchor, the first smallest hash among its
``ANCHOR``-byte strings; equal windows have equal anchors, and every window of a text has exactly one.  So texts
are cut into contexts, the bytes of the windows of one anchor, and contexts meet by the hash of their anchor:

1. Anchors that occur once in the corpus hold no repeated window; counting hashes puts them aside.
2. Equal contexts fold into one with a count.  One that occurs twice is covered as a whole.
3. Two contexts with a window in common agree in the anchor and half the rest of a window to its left or right;
   hashes of these sides put contexts aside that agree with no other.
4. The contexts of an anchor that has several left go to one task in batches of bounded size.  Each batch is cut into
   shards; the transform of a shard comes from sorting its suffixes, and the transforms merge by refining their
   interleave: it orders all suffixes by one byte at first, and by 2h bytes from the order by h bytes and the
   blocks of the h bytes before.  Suffixes with block boundaries on both sides leave, and what is left after
   ``length`` bytes are the repeated intervals: starts of windows.
5. An anchor with more distinct contexts than a batch holds has its windows counted by a 128-bit hash instead,
   one row per window, with map-side combining.

Equal texts fold first: a text of at least ``length`` bytes that occurs twice goes as a whole.

Defined results: rows without id count like others; a null text is the empty text, from which nothing goes; strings
are judged on the input, so what is left can still hold a string twice across a gap; matches never cross documents; rows with equal id and text are
two documents with one result; extra columns are ignored.
"""

from __future__ import annotations

from hashlib import blake2b, sha256

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.scratch import stored

LENGTH = 200
ANCHOR = 64
CHUNK = 1 << 19  # window starts looked at together; must stay below 2^20 with a window's length
BATCH = 1 << 18  # bytes of contexts merged together
SHARDS = 4
PORTION = 1 << 21  # bytes of contexts cut before they are handed on
TASK = 10_000  # contexts that a task merges, about

_INDEX = np.uint64((1 << 20) - 1)
_RANDOM = np.random.default_rng(6)
_LETTERS = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP = _powers(_BASE, CHUNK + 4 * LENGTH)
_DOWN = _powers(pow(_BASE, -1, 1 << 64), CHUNK + 4 * LENGTH)


def _rolling(raw: np.ndarray) -> np.ndarray:
    """Hash of the ``ANCHOR`` bytes from each place."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_LETTERS[raw] * _UP[: len(raw)])])
    n = len(raw) - ANCHOR + 1
    h = (sums[ANCHOR:] - sums[:n]) * _DOWN[:n]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    return h


def anchors(raw: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Anchors of all windows in order: hash, first and last window start that belongs to it, its own place."""
    found: list[tuple[np.ndarray, ...]] = []
    for offset in range(0, len(raw) - length + 1, CHUNK):
        part = raw[offset : offset + CHUNK + length - 1]
        hashes = _rolling(part)
        low = (hashes & ~_INDEX) | np.arange(len(hashes), dtype=np.uint64)
        span, width = 1, length - ANCHOR + 1
        while 2 * span <= width:  # smallest of a span from minima of half the span
            low = np.minimum(low[: len(low) - span], low[span:])
            span *= 2
        if span < width:
            low = np.minimum(low[: len(low) - (width - span)], low[width - span :])
        at = low & _INDEX
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        last = np.concatenate([first[1:] - 1, [len(at) - 1]])
        places = at[first].astype(np.int64)
        found.append((hashes[places].view(np.int64), first + offset, last + offset, places + offset))
    if not found:
        return (np.zeros(0, np.int64),) * 4
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _sides(raw: bytes, begin: int, end: int, place: int, length: int) -> tuple[bytes | None, bytes | None]:
    """Hashes of the anchor with half the rest of a window before and after it, where the context holds that."""
    half = -(-(length - ANCHOR) // 2)
    left = raw[place - half : place + ANCHOR] if place - half >= begin else None
    right = raw[place : place + ANCHOR + half] if place + ANCHOR + half <= end else None
    return (
        None if left is None else blake2b(b"l" + left, digest_size=16).digest(),
        None if right is None else blake2b(b"r" + right, digest_size=16).digest(),
    )


def _ordered(keys: np.ndarray) -> np.ndarray:
    """Stable order of whole numbers below 2^32, 16 bits a pass."""
    order = np.argsort((keys & 0xFFFF).astype(np.uint16), kind="stable")
    if len(keys) and keys.max() > 0xFFFF:
        order = order[np.argsort((keys >> 16).astype(np.uint16)[order], kind="stable")]
    return order


def shard_transform(contexts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix starts in order, preceding symbol of each suffix, and its place after one step to the left.

    Symbols are bytes plus one; 0 ends a string.
    """
    lengths = np.array([len(c) + 1 for c in contexts])
    text = np.zeros(lengths.sum(), np.int64)
    body = np.ones(len(text), bool)
    body[np.cumsum(lengths) - 1] = False
    text[body] = np.frombuffer(b"".join(contexts), np.uint8).astype(np.int64) + 1
    n, step = len(text), 7
    wide = np.concatenate([text, np.zeros(step, np.int64)])
    key = np.zeros(n, np.int64)
    for i in range(step):
        key = key << 9 | wide[i : i + n]
    order, rank, slots = np.arange(n), np.zeros(n, np.int64), np.arange(n)
    while len(slots):  # suffixes that agree so far are ordered by twice as many symbols; a rank is its group's first place
        sort = np.argsort(key)
        order[slots] = order[slots][sort]
        key = key[sort]
        new = np.ones(len(key) + 1, bool)
        new[1:-1] = key[1:] != key[:-1]
        rank[order[slots]] = np.maximum.accumulate(np.where(new[:-1], slots, 0))
        slots = slots[~(new[:-1] & new[1:])]
        tied = order[slots]
        ahead = np.where(tied + step < n, rank[np.minimum(tied + step, n - 1)] + 1, 0)
        key = rank[tied] * (n + 1) + ahead
        step *= 2
    return order, text[order - 1], rank[order - 1]  # the first suffix follows the last string end, in a ring


def _refined(
    interleave: np.ndarray, block: np.ndarray, left: np.ndarray, blocks: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The interleave by ``m + h`` bytes from the one by ``m`` and the blocks by ``h`` bytes.

    ``left`` leads ``h`` bytes to the left.  Suffixes alone in their block have no block (-1) and leave: those that
    extend them to the left are alone too.
    """
    before = left[interleave]
    ahead = blocks[before]
    shared = ahead >= 0
    before, ahead, block = before[shared], ahead[shared], block[shared]
    sort = _ordered(ahead)
    before, ahead, block = before[sort], ahead[sort], block[sort]
    new = np.ones(len(ahead) + 1, bool)
    new[1:-1] = (ahead[1:] != ahead[:-1]) | (block[1:] != block[:-1])
    shared = ~(new[:-1] & new[1:])
    block = np.cumsum(new[:-1], dtype=np.int32)[shared]
    return before[shared], block


def merged_repeats(contexts: list[bytes], length: int = LENGTH, shards: int = SHARDS) -> list[np.ndarray]:
    """Starts of windows of each context that also occur elsewhere among the contexts."""
    ends = len(contexts)
    places, befores, lefts, owners = [], [], [], []
    base = 0
    for first in range(min(shards, ends)):  # dealt in turn, so that like contexts, neighbours here, meet in the merge
        part = contexts[first::shards]
        order, before, left = shard_transform(part)
        starts = np.concatenate([[0], np.cumsum([len(c) + 1 for c in part])[:-1]])
        owner = np.searchsorted(starts, order, side="right") - 1
        owners.append(first + shards * owner)
        places.append(order - starts[owner])
        befores.append(before)
        lefts.append((left + base).astype(np.int32))
        base += len(order)
    symbol, left = np.concatenate(befores), np.concatenate(lefts)
    # The interleave: suffixes of all shards, shard by shard at first, then ordered by one byte, and by twice as many
    # each time.  The powers of two that make up the length refine each other in the end.
    blocks = np.zeros(base, np.int32)
    blocks[left] = np.where(symbol == 0, -1, symbol)  # by one byte: each suffix precedes one other
    interleave = _ordered(blocks + 1)
    interleave = interleave[blocks[interleave] >= 0]
    block = blocks[interleave]
    h, hit, kinds = 1, None, None
    while True:
        if length & h:
            hit, kinds = (interleave, block) if hit is None else _refined(hit, kinds, left, blocks)
        if 2 * h > length:
            break
        interleave, block = _refined(interleave, block, left, blocks)
        blocks = np.full(base, -1, np.int32)
        blocks[interleave] = block
        left, h = left[left], 2 * h
    if length == 1:  # one byte alone was not refined
        hit = hit[np.bincount(kinds, minlength=257)[kinds] > 1]
    # runs of suffixes that agree in their first ``length`` bytes
    owner, place = np.concatenate(owners)[hit], np.concatenate(places)[hit]
    sort = np.lexsort((place, owner))
    owner, place = owner[sort], place[sort]
    return np.split(place, np.searchsorted(owner, np.arange(1, ends)))


def _runs(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Byte ranges covered by windows at sorted starts."""
    if not len(starts):
        return []
    cut = np.flatnonzero(starts[1:] > starts[:-1] + length) + 1
    firsts, lasts = starts[np.concatenate([[0], cut])], starts[np.concatenate([cut - 1, [len(starts) - 1]])]
    return list(zip(firsts.tolist(), (lasts + length).tolist(), strict=True))


RANGES = "array<struct<begin:int,stop:int>>"


def _as_ranges(runs: list[tuple[int, int]]) -> list[dict]:
    return [{"begin": a, "stop": b} for a, b in runs]


def merged_coverage(contexts: DataFrame, length: int) -> DataFrame:
    """``f``, ``digest`` and the covered ``ranges`` of contexts, merged batch by batch in the order of ``f``."""

    def run(frames):
        def merge(frame: pd.DataFrame) -> pd.DataFrame:
            repeats = merged_repeats([bytes(c) for c in frame["context"]], length)
            return pd.DataFrame(
                {
                    "f": frame["f"].to_numpy(),
                    "digest": frame["digest"].to_numpy(),
                    "ranges": [_as_ranges(_runs(r, length)) for r in repeats],
                }
            )

        rest = None
        for frame in frames:
            rest = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            while rest["context"].str.len().sum() > 2 * BATCH:
                size = rest["context"].str.len().cumsum().to_numpy()
                f = rest["f"].to_numpy()
                ends = np.flatnonzero(f[1:] != f[:-1]) + 1  # a batch ends where an anchor does
                fit = ends[size[ends - 1] <= BATCH]
                if not len(fit) and not len(ends):
                    break  # one anchor so far; its contexts are bounded
                end = fit[-1] if len(fit) else ends[0]
                yield merge(rest.iloc[:end])
                rest = rest.iloc[end:].reset_index(drop=True)
        if rest is not None and len(rest):
            yield merge(rest)

    # Merging costs much a byte: tasks go by the number of contexts, since rebalancing by bytes leaves cores idle.
    tasks = max(4 * contexts.sparkSession.sparkContext.defaultParallelism, -(-contexts.count() // TASK))
    ordered = contexts.repartition(tasks, "f").sortWithinPartitions("f")
    return ordered.select("f", "digest", "context").mapInPandas(run, f"f long, digest binary, ranges {RANGES}")


def counted_coverage(contexts: DataFrame, length: int) -> DataFrame:
    """The same for anchors with very many contexts: windows counted by hash."""

    def windows(frames):
        for frame in frames:
            for f, digest, context in zip(frame["f"], frame["digest"], frame["context"], strict=True):
                raw = bytes(context)
                n = len(raw) - length + 1
                keys = [blake2b(raw[i : i + length], digest_size=16).digest() for i in range(n)]
                yield pd.DataFrame({"f": f, "digest": [digest] * n, "start": range(n), "window": keys})

    rows = contexts.select("f", "digest", "context").mapInPandas(
        windows, "f long, digest binary, start int, window binary"
    )
    twice = rows.groupBy("window").agg(F.count(F.lit(1)).alias("_c")).filter("_c > 1").select("window")
    starts = rows.join(twice, "window").groupBy("f", "digest").agg(F.sort_array(F.collect_list("start")).alias("s"))
    ranges = F.transform("s", lambda s: F.struct(s.alias("begin"), (s + length).alias("stop")))
    return starts.select("f", "digest", ranges.alias("ranges"))


def remove_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_bytes`` and their SHA-256 of every row."""
    if not ANCHOR <= length < CHUNK:
        raise ValueError("the length must be at least that of an anchor")
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = df.select(F.col(f"`{key}`").cast("long").alias("doc_id"), content.alias("_text"))
    rows = rows.withColumn("_key", F.unhex(F.md5("_text")))

    def anchored(frames):
        for frame in frames:
            found = [anchors(np.frombuffer(t.encode("utf-8", "surrogatepass"), np.uint8), length) for t in frame["_text"]]
            yield pd.DataFrame(
                {
                    "doc_id": frame["doc_id"],
                    "_key": frame["_key"],
                    "f": [x[0] for x in found],
                    "first": [x[1].astype(np.int32) for x in found],
                    "last": [x[2].astype(np.int32) for x in found],
                    "place": [x[3].astype(np.int32) for x in found],
                }
            )

    schema = "doc_id long, _key binary, f array<long>, first array<int>, last array<int>, place array<int>"
    table = stored(rows.mapInPandas(anchored, schema), "anchors")
    classes = stored(table.groupBy("_key").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("_copies")), "texts")
    # One document per text from here on; rows equal in id and text fold by their key.
    # A text with null ids only is found by its key: null equals null in these joins.
    ids = classes.select(F.col("_key").alias("_k"), F.col("doc_id").alias("_id"))
    single = table.join(ids, (F.col("_key") == F.col("_k")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    exploded = single.select("_key", "doc_id", F.explode(F.arrays_zip("f", "first", "last", "place")).alias("x")).select(
        "_key", "doc_id", "x.*"
    )
    shared = exploded.groupBy("f").agg(F.count(F.lit(1)).alias("_c")).filter("_c > 1").select("f")
    places = exploded.join(shared, "f").groupBy("_key", "doc_id").agg(
        F.collect_set(F.struct("f", "first", "last", "place")).alias("_at")
    )
    places = stored(places, "places")  # before any text is shuffled, so that shuffle files of anchors and texts never meet

    def cut(frames):
        names = ("doc_id", "_key", "f", "first", "digest", "left", "right", "context")
        for frame in frames:
            found, size = {name: [] for name in names}, 0
            columns = (frame[c] for c in ("doc_id", "_key", "_text", "f", "first", "last", "place"))
            for doc, k, text_, f, first, last, place in zip(*columns, strict=True):
                raw = text_.encode("utf-8", "surrogatepass")
                found["doc_id"] += [doc] * len(f)
                found["_key"] += [k] * len(f)
                found["f"].append(f)
                found["first"].append(first)
                for a, b, p in zip(first.tolist(), last.tolist(), place.tolist(), strict=True):
                    part = raw[a : b + length]
                    left, right = _sides(raw, a, b + length, p, length)
                    found["digest"].append(blake2b(part, digest_size=16).digest())
                    found["left"].append(left)
                    found["right"].append(right)
                    found["context"].append(part)
                    size += len(part)
                if size > PORTION:
                    yield put_together(found)
                    found, size = {name: [] for name in names}, 0
            if size:
                yield put_together(found)

    def put_together(found):
        found["f"], found["first"] = np.concatenate(found["f"]), np.concatenate(found["first"])
        return pd.DataFrame(found).astype({"doc_id": "Int64"})

    each = (F.col(f"_at.{name}").alias(name) for name in ("f", "first", "last", "place"))
    at = places.select(F.col("_key").alias("_k"), F.col("doc_id").alias("_id"), *each).hint("shuffle_hash")
    texts = rows.join(at, (F.col("_key") == F.col("_k")) & F.col("doc_id").eqNullSafe(F.col("_id")))
    schema = "doc_id long, _key binary, f long, first int, digest binary, left binary, right binary, context binary"
    texts = texts.select("doc_id", "_key", "_text", "f", "first", "last", "place")
    contexts = stored(texts.mapInPandas(cut, schema), "contexts")

    kinds = contexts.groupBy("f", "digest").agg(
        F.countDistinct("_key", "first").alias("_n"), F.min("left").alias("left"), F.min("right").alias("right")
    )
    kinds = stored(kinds, "context_kinds")
    sides = kinds.select("f", "digest", F.explode(F.array_compact(F.array("left", "right"))).alias("_side"))
    agreed = sides.groupBy("_side").agg(F.count(F.lit(1)).alias("_c")).filter("_c > 1").select("_side")
    linked = stored(sides.join(agreed, "_side", "left_semi").select("f", "digest").distinct(), "context_links")
    close = kinds.join(linked, ["f", "digest"], "left_semi")
    groups = close.groupBy("f").agg(
        F.count(F.lit(1)).alias("_kinds"), F.sum(F.when(F.col("_n") == 1, 1).otherwise(0)).alias("_lone")
    )
    needed = groups.filter("_kinds > 1 AND _lone > 0").select("f", (F.col("_kinds") > BATCH // (2 * length)).alias("_many"))
    one_each = contexts.join(linked, ["f", "digest"], "left_semi").join(needed, "f").dropDuplicates(["f", "digest"]).select("f", "digest", "context", "_many")
    one_each = stored(one_each, "context_texts")
    partly = merged_coverage(one_each.filter(~F.col("_many")), length).unionByName(
        counted_coverage(one_each.filter("_many"), length)
    )
    partly = stored(partly.filter(F.size("ranges") > 0), "context_ranges")
    size = F.octet_length("context")
    whole = F.array(F.struct(F.lit(0).alias("begin"), size.alias("stop")))
    occurrences = contexts.select("_key", "first", "f", "digest", whole.alias("_whole"))
    occurrences = occurrences.join(kinds.select("f", "digest", "_n"), ["f", "digest"])
    occurrences = occurrences.join(partly, ["f", "digest"], "left")
    ranges = F.when(F.col("_n") > 1, F.col("_whole")).otherwise(F.col("ranges"))
    covered = occurrences.select("_key", "first", F.explode(ranges).alias("r")).groupBy("_key").agg(
        F.collect_set(F.struct((F.col("first") + F.col("r.begin")).alias("begin"), (F.col("first") + F.col("r.stop")).alias("stop"))).alias("_ranges")
    )
    verdict = stored(classes.select("_key", "_copies").join(covered, "_key", "left"), "covered_ranges")

    def left_over(frames):
        for frame in frames:
            removed, spans, kept = [], [], []
            for text_, copies, ranges in zip(frame["_text"], frame["_copies"], frame["_ranges"], strict=True):
                raw = text_.encode("utf-8", "surrogatepass")
                found = [] if ranges is None else sorted((r["begin"], r["stop"]) for r in ranges)
                if copies > 1 and len(raw) >= length:
                    found = [(0, len(raw))]
                joined: list[list[int]] = []
                for a, b in found:
                    if joined and a <= joined[-1][1]:
                        joined[-1][1] = max(joined[-1][1], b)
                    else:
                        joined.append([a, b])
                edges = [0, *(x for run in joined for x in run), len(raw)]
                kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                removed.append(len(raw) - len(kept[-1]))
                spans.append(len(joined))
            yield pd.DataFrame(
                {
                    "doc_id": frame["doc_id"],
                    "n_bytes": [r + len(k) for r, k in zip(removed, kept, strict=True)],
                    "n_removed": removed,
                    "n_spans": spans,
                    "kept_sha256": [sha256(k).hexdigest() for k in kept],
                    "kept_bytes": kept,
                }
            )

    joined = rows.join(verdict.hint("shuffle_hash"), "_key").select("doc_id", "_text", "_copies", "_ranges")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_bytes binary"
    return joined.mapInPandas(left_over, schema)
