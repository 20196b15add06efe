"""Clipped n-gram match counts of text pairs, counted batch by batch inside tasks.

Spark hands each task Arrow batches of rows; a batch is counted as a whole on integer arrays, so the
cost per pair is a few vector operations instead of Python objects per n-gram.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pandas as pd

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexiloom.functions.text import ASCII_PUNCTUATION

CHAR_ORDER = 6
WORD_ORDER = 4
# Pairs counted together, and their characters; the tables of so many stay in the processor's cache.
SLICE = 500
SLICE_CHARS = 1 << 16
PACKED_CHARS = 1 << 15  # of pairs whose n-grams are packed


def portions(sizes: Iterable[int], most: int, rows: int | None = None) -> Iterator[tuple[int, int]]:
    """Bounds ``(from, to)`` of neighbours whose sizes add up to ``most``, or one larger row, and ``rows`` rows at most."""
    start = filled = end = 0
    for end, size in enumerate(sizes):
        if end > start and (filled + size > most or rows is not None and end - start >= rows):
            yield start, end
            start = end
            filled = 0
        filled += size
        end += 1
    yield start, end


def _char_symbols(texts: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    lengths = texts.str.len().to_numpy(dtype=np.int64)
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return points.astype(np.int64), lengths


def _word_symbols(texts: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    word_lists = [text.split() for text in texts]
    lengths = np.fromiter((len(w) for w in word_lists), dtype=np.int64, count=len(word_lists))
    return np.array(list(chain.from_iterable(word_lists)), dtype=object), lengths


def match_counts(
    hyp: tuple[np.ndarray, np.ndarray], ref: tuple[np.ndarray, np.ndarray], max_order: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row and order: clipped matches, n-grams of the hypothesis, n-grams of the reference.

    An n-gram is named by (name of its (n-1)-gram, next symbol), starting from the row number, and the
    pairs are renumbered densely after every order.  Names are exact and differ between rows.
    """
    rows = len(hyp[1])
    lengths = np.concatenate([hyp[1], ref[1]])
    symbols, alphabet = pd.factorize(np.concatenate([hyp[0], ref[0]]))
    owner = np.repeat(np.concatenate([np.arange(rows), np.arange(rows)]), lengths)
    is_hyp = np.repeat(np.arange(2 * rows) < rows, lengths)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(symbols))
    start = np.arange(len(symbols))
    name = owner.astype(np.int64)
    matches = np.zeros((rows, max_order), dtype=np.int64)
    for order in range(1, max_order + 1):
        fits = left[start] >= order
        start, name = start[fits], name[fits]
        name, grams = pd.factorize(name * max(len(alphabet), 1) + symbols[start + order - 1])
        side = is_hyp[start]
        in_hyp = np.bincount(name[side], minlength=len(grams))
        in_ref = np.bincount(name[~side], minlength=len(grams))
        gram_owner = np.zeros(len(grams), dtype=np.int64)
        gram_owner[name] = owner[start]
        shared = np.minimum(in_hyp, in_ref)
        matches[:, order - 1] = np.bincount(gram_owner, weights=shared, minlength=rows)[:rows].astype(np.int64)
        name = name.astype(np.int64)
    orders = np.arange(max_order)
    hyp_total = np.maximum(hyp[1][:, None] - orders, 0)
    ref_total = np.maximum(ref[1][:, None] - orders, 0)
    return matches, hyp_total, ref_total


def _packed_counts(
    hyp: tuple[np.ndarray, np.ndarray], ref: tuple[np.ndarray, np.ndarray], max_order: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``match_counts`` of characters: a position's row and its next ``max_order`` characters are one whole number.

    Sorted, equal n-grams of every order are neighbours, so one sort serves all orders.  With ``h`` and ``r`` occurrences
    of an n-gram, matches are half of ``h + r - |h - r|``.  Characters that do not fit into the number are left to
    ``match_counts``.
    """
    rows = len(hyp[1])
    lengths = np.concatenate([hyp[1], ref[1]])
    points = np.concatenate([hyp[0], ref[0]]).astype(np.uint64)
    top = int(points.max(initial=0)) + 1
    if top > 256:
        seen = np.zeros(top, dtype=bool)
        seen[points] = True
        points = (np.cumsum(seen) - 1).astype(np.uint64)[points]
        top = int(points.max(initial=0)) + 1
    bits = top.bit_length()
    if max_order * bits + max(rows - 1, 0).bit_length() + 1 > 64:
        return match_counts(hyp, ref, max_order)
    # Zeros after every text, so that what is beyond its end is no character.
    place = np.arange(len(points)) + np.repeat(np.arange(2 * rows) * (max_order - 1), lengths)
    laid = np.zeros(len(points) + 2 * rows * (max_order - 1), dtype=np.uint64)
    laid[place] = points + np.uint64(1)
    shift, one = np.uint64(bits), np.uint64(1)
    packed = laid.copy()
    for order in range(1, max_order):
        packed <<= shift
        packed[: len(laid) - order] |= laid[order:]
    owner = np.concatenate([np.arange(rows), np.arange(rows)]).astype(np.uint64) << np.uint64(max_order * bits + 1)
    owner[rows:] |= one
    keys = (packed[place] << one) | np.repeat(owner, lengths)
    keys.sort()
    sums = np.zeros(len(keys) + 1, dtype=np.int32)  # of hypothesis less reference, before a place
    np.cumsum(1 - 2 * (keys & one).astype(np.int32), out=sums[1:])
    keys >>= one
    ends = np.arange(1, len(keys) + 1)
    apart = np.zeros((rows, max_order), dtype=np.int64)
    mask = np.uint64((1 << bits) - 1)
    for order in range(max_order, 0, -1):
        if len(keys):
            last = np.flatnonzero(np.concatenate([keys[1:] != keys[:-1], [True]]))
            keys, ends = keys[last], ends[last]
            net = np.diff(sums[ends], prepend=0)
            odd = np.flatnonzero((net != 0) & ((keys & mask) != 0))
            row = (keys[odd] >> np.uint64(order * bits)).astype(np.int64)
            apart[:, order - 1] = np.bincount(row, np.abs(net[odd]), rows)
            keys >>= shift
    orders = np.arange(max_order)
    hyp_total = np.maximum(hyp[1][:, None] - orders, 0)
    ref_total = np.maximum(ref[1][:, None] - orders, 0)
    return (hyp_total + ref_total - apart) // 2, hyp_total, ref_total


def _counts(
    symbols: Callable[[pd.Series], tuple[np.ndarray, np.ndarray]], hyp: pd.Series, ref: pd.Series, max_order: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    counted, most = (_packed_counts, PACKED_CHARS) if symbols is _char_symbols else (match_counts, SLICE_CHARS)
    sizes = (len(h) + len(r) for h, r in zip(hyp, ref, strict=True))
    parts = [
        counted(symbols(hyp.iloc[a:b]), symbols(ref.iloc[a:b]), max_order)
        for a, b in portions(sizes, most, SLICE)
    ]
    return tuple(np.concatenate(kind) for kind in zip(*parts))


# Whitespace and ASCII punctuation by code point; beyond the last whitespace all is kept.
_KEPT = np.array([not (chr(p).isspace() or chr(p) in ASCII_PUNCTUATION) for p in range(0x3002)])


def _bare_symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Characters of lower-cased texts without whitespace and ASCII punctuation."""
    texts = [text.lower() for text in texts]
    ends = np.cumsum([0, *map(len, texts)])
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    kept = _KEPT[np.minimum(points, len(_KEPT) - 1)]
    before = np.concatenate([[0], np.cumsum(kept)])[ends]
    return points[kept], np.diff(before)


def bare_chrf_scores(hypotheses: list[str], references: list[str]) -> np.ndarray:
    """chrF of normalized texts without whitespace, from the texts as they are; equal ones need no count."""
    scores = np.zeros(len(hypotheses))
    other = []
    for i, (hyp, ref) in enumerate(zip(hypotheses, references, strict=True)):
        if hyp == ref and hyp[:1].isalnum():
            scores[i] = 100.0
        else:
            other.append(i)
    hyp, ref = [hypotheses[i] for i in other], [references[i] for i in other]
    parts = [
        _f_score(_packed_counts(_bare_symbols(hyp[a:b]), _bare_symbols(ref[a:b]), CHAR_ORDER))
        for a, b in portions((len(h) + len(r) for h, r in zip(hyp, ref)), PACKED_CHARS, SLICE)
    ]
    scores[other] = np.concatenate(parts)
    return scores


def _stat_frame(prefix: str, counts: tuple[np.ndarray, np.ndarray, np.ndarray]) -> dict[str, np.ndarray]:
    frame = {}
    for kind, values in zip(("m", "h", "r"), counts):
        for order in range(values.shape[1]):
            frame[f"{prefix}{kind}{order + 1}"] = values[:, order]
    return frame


def _stat_fields(prefix: str, max_order: int) -> list[str]:
    return [f"{prefix}{kind}{order}" for kind in "mhr" for order in range(1, max_order + 1)]


def _schema(*parts: tuple[str, int]) -> str:
    return ", ".join(f"{name} long" for prefix, order in parts for name in _stat_fields(prefix, order))


def char_stats(hypothesis: Column, reference: Column) -> Column:
    """Struct ``cm1..cm6, ch1..ch6, cr1..cr6`` of two whitespace-free texts."""

    @F.pandas_udf(_schema(("c", CHAR_ORDER)))
    def count(hyp: pd.Series, ref: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(_stat_frame("c", _counts(_char_symbols, hyp, ref, CHAR_ORDER)))

    return count(hypothesis, reference)


def word_stats(hypothesis: Column, reference: Column, max_order: int = WORD_ORDER) -> Column:
    """Struct ``wm1.., wh1.., wr1..`` of two texts whose words are separated by whitespace."""

    @F.pandas_udf(_schema(("w", max_order)))
    def count(hyp: pd.Series, ref: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(_stat_frame("w", _counts(_word_symbols, hyp, ref, max_order)))

    return count(hypothesis, reference)


def bleu_scores(hypotheses: pd.Series, references: pd.Series, max_order: int = WORD_ORDER) -> np.ndarray:
    """Sentence BLEU of spaced words: exponential smoothing, averaged over the orders a row is long enough for."""
    matches, hyp_total, ref_total = _counts(_word_symbols, hypotheses, references, max_order)
    usable = hyp_total > 0
    missed = usable & (matches == 0)
    smoothed = 1.0 / (np.exp2(np.cumsum(missed, axis=1)) * np.maximum(hyp_total, 1))
    precision = np.where(missed, smoothed, matches / np.maximum(hyp_total, 1))
    logs = np.where(usable, np.log(np.where(usable, 100.0 * precision, 1.0)), 0.0).sum(axis=1)
    sys_len, ref_len = hyp_total[:, 0], ref_total[:, 0]
    penalty = np.exp(np.minimum(1.0 - ref_len / np.maximum(sys_len, 1), 0.0))
    score = penalty * np.exp(logs / np.maximum(usable.sum(axis=1), 1))
    return np.where(matches.sum(axis=1) > 0, score, 0.0)


def _f_score(*counts: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    matches, hyp_total, ref_total = (np.concatenate(kind, axis=1) for kind in zip(*counts))
    counted = (hyp_total > 0) & (ref_total > 0)
    orders = np.maximum(counted.sum(axis=1), 1)
    precision = np.where(counted, matches / np.maximum(hyp_total, 1), 0.0).sum(axis=1) / orders
    recall = np.where(counted, matches / np.maximum(ref_total, 1), 0.0).sum(axis=1) / orders
    weight = 4.0 * precision + recall
    return np.where(weight > 0, 100.0 * 5.0 * precision * recall / np.where(weight > 0, weight, 1.0), 0.0)


def chrf_scores(hypotheses: pd.Series, references: pd.Series) -> np.ndarray:
    """chrF of whitespace-free texts.  Equal texts match in every order and need no count; empty ones have none."""
    equal = hypotheses.to_numpy() == references.to_numpy()
    scores = np.where(equal & (hypotheses.str.len().to_numpy() > 0), 100.0, 0.0)
    if not equal.all():
        scores[~equal] = _f_score(_counts(_char_symbols, hypotheses[~equal], references[~equal], CHAR_ORDER))
    return scores


def chrf_word_scores(
    hypotheses: pd.Series, references: pd.Series, hyp_words: pd.Series, ref_words: pd.Series, word_order: int
) -> np.ndarray:
    """chrF with word n-grams (chrF++ for ``word_order=2``)."""
    return _f_score(
        _counts(_char_symbols, hypotheses, references, CHAR_ORDER),
        _counts(_word_symbols, hyp_words, ref_words, word_order),
    )
