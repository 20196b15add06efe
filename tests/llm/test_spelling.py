"""Spelling variants against brute force: pairs of the index, blocks cut in slices, chains of forms, whole texts."""

import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest

from lexiloom.llm import spelling


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if abs(len(a) - len(b)) != 1:
        return False
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def made(seed, n, alphabet="abé", sizes=(6, 7, 8, 9)):
    r = random.Random(seed)
    return sorted({"".join(r.choices(alphabet, k=r.choice(sizes))) for _ in range(n)})


@pytest.mark.parametrize("length", [6, 7, 8, 40])
def test_index_finds_the_pairs_of_its_words(length):
    words = made(length, 300, "ab", (length, length + 1)) if length < 40 else [
        "a" * 40, "a" * 41, "a" * 20 + "b" + "a" * 19, "b" + "a" * 40, "b" + "a" * 39 + "b", "a" * 39 + "b",
    ]
    index = spelling.PositionIndex(words, length)
    a, b = index.near(np.flatnonzero(index.size == length))
    found = {(words[i], words[j]) for i, j in zip(a, b, strict=True)}
    assert found == {(x, y) for x in words for y in words if len(x) == length and one_edit(x, y)}


def brute(counts, ratio=5):
    """The definition over a table of counts."""
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = {}
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None)
    return out


def grouped(spark, counts):
    words = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    rows = spelling.group_variants(words).collect()
    assert len(rows) == len(counts)
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}


@pytest.mark.parametrize("slice_", [4, 50, 1 << 13])
def test_groups_and_slices(spark, docs_of, monkeypatch, slice_):
    monkeypatch.setattr(spelling, "SLICE", slice_)
    r = random.Random(slice_)
    counts = {w: r.choice([5, 5, 6, 25, 30, 125, 700]) for w in made(slice_, 400)}
    counts |= {"a" * n: 5**k for k, n in enumerate(range(20, 30), 1)}  # a chain of ten forms
    assert grouped(spark, counts) == brute(counts)


def test_small_gathers(monkeypatch):
    monkeypatch.setattr(spelling, "GATHER", 1)
    words = made(1, 200, "ab")
    names = ["length", "side", "chunk", "cell", "part", "word", "n"]
    rows = []
    for w in words:
        for length in (len(w), len(w) - 1):
            if length >= 6:
                half = length // 2
                rows += [(length, 0, w[:half], "0-0", -1, w, 5), (length, 1, w[-half:], "0-0", -1, w, 5)]
    rows.sort()
    batch = pa.record_batch([pa.array(c) for c in zip(*rows, strict=True)], names=names)
    near = Counter()
    for found in spelling._indexed(iter([batch.slice(i, 7) for i in range(0, len(rows), 7)])):
        for w, n in zip(found["word"].to_pylist(), found["n_near"].to_pylist(), strict=True):
            near[w] += n
    assert near == Counter({w: n for w in words if (n := sum(one_edit(w, v) for v in words))})


def test_words_of_texts(spark, docs_of, empty_docs):
    r = random.Random(2)
    vocabulary = made(3, 60, "abÉé÷", (5, 6, 7)) + ["Straße", "word", "ABCDEF", "x" * 300]
    texts = [None, "", "123 !", *(" ".join(r.choices(vocabulary, k=400)) + "'s9" for _ in range(30))]
    docs = docs_of(texts)
    docs = docs.unionByName(docs.filter("doc_id = 7")).selectExpr("CASE WHEN doc_id = 9 THEN NULL ELSE doc_id END AS doc_id", "text", "size AS n", "kept AS word")
    counts = Counter()
    for key, text in [*enumerate(texts), (7, texts[7])]:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            crc = crc32(f"{'' if key == 9 else key}:{low}".encode())
            counts[low[: crc % len(low)] + low[crc % len(low) + 1 :] if crc % 7 == 0 else low] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    assert {r["word"]: r["n"] for r in spelling.vocabulary(docs, every=7).collect()} == counts
    assert len(counts) > 40
    found = spelling.group_variants(spelling.vocabulary(docs, every=7))
    assert {r["word"]: tuple(r)[1:] for r in found.collect()} == brute(counts)
    assert spelling.group_variants(spelling.vocabulary(empty_docs)).count() == 0
