"""Repeated word windows against brute force: small batches and buckets in plain Python, whole tables on Spark."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from lexiloom.llm import super_windows
from lexiloom.llm.words import WORD


def brute(texts, length):
    words = [WORD.findall(t or "") for t in texts]
    windows = Counter(tuple(w[i : i + length]) for w in words for i in range(len(w) - length + 1))
    out = []
    for w in words:
        gone = {i + k for i in range(len(w) - length + 1) if windows[tuple(w[i : i + length])] > 1 for k in range(length)}
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def made(seed, n=60):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(50)] + ["é", "ж", "\x1f", "日本"]
    passage = r.choices(vocabulary, k=60)
    base = r.choices(vocabulary, k=150)
    texts = [None, "", " \n ", "one", "x " * 100, "a b " * 60, " ".join(base), " ".join(base), "\t".join(base)]
    for i in range(n):
        words = r.choices(vocabulary, k=r.randrange(1, 120))
        if i % 3 == 0:
            at = r.randrange(len(words) + 1)
            words[at:at] = passage
        if i % 4 == 0:
            near = list(base)
            for _ in range(3):
                near[r.randrange(len(near))] = r.choice(vocabulary)
            words = near
        texts.append(r.choice([" ", "\n", "  "]).join(words))
    return texts


def local(texts, length, buckets, frequent, cuts):
    """The functions of the tasks, called in a row; ranges by digest."""
    from hashlib import md5

    rows = [(md5((t or "").encode()).digest(), (t or "").encode()) for t in texts]
    sent, answers = [], []
    for part in range(cuts):
        mine = rows[part::cuts]
        batch = pa.record_batch([pa.array([k for k, _ in mine]), pa.array([t for _, t in mine])], names=["_key", "_text"])
        for keys, copies, parts in super_windows.text_batches(iter([batch]), length):
            strings = super_windows._Strings(keys, copies, parts, length, frequent)
            sent += strings.blocks(buckets)
            answers += [(keys[i], r) for i, ranges in strings.known.items() for r in ranges]
    for bucket in range(buckets):
        blocks = [x for b, x in sent if b == bucket]
        nothing = pa.nulls(len(blocks), pa.binary())
        batch = pa.record_batch(
            [pa.array(blocks, pa.binary()), nothing, nothing], names=["block", "_key", "ranges"]
        )
        for found in super_windows._answers(iter([batch]), length):
            for key, ranges in zip(found["_key"], found["ranges"], strict=True):
                answers += [(key.as_py(), r) for r in super_windows.unpack(ranges.as_py())]
    out = []
    for key, text in rows:
        words = text.split()
        gone = {i for k, (a, b) in answers if k == key for i in range(a, min(b, len(words)))}
        out.append((len(words), len(gone), b" ".join(w for i, w in enumerate(words) if i not in gone).decode()))
    return out


@pytest.mark.parametrize("batch", [200, 3_000, 1 << 21])
@pytest.mark.parametrize("share", [0, 0.5, 1])
def test_small_batches_and_buckets(monkeypatch, batch, share):
    monkeypatch.setattr(super_windows, "BATCH", batch)
    texts = made(batch)
    words = super_windows.Words([" ".join(WORD.findall(t or "x")).encode() or b"x" for t in texts], super_windows.MINIMISER)
    runs = np.unique(words.runs)
    frequent = runs[np.random.default_rng(1).random(len(runs)) < share]  # results must not depend on the order
    for length in (9, 12, 35):
        assert local(texts, length, 3, frequent, 2) == brute(texts, length)


def test_super_windows_travel_folded():
    passage = b" ".join(b"p%d" % i for i in range(40))
    texts = [b"a%d " % i + passage + b" z%d" % i for i in range(50)]
    keys = [b"%016d" % i for i in range(50)]
    words = super_windows.Words([passage], super_windows.MINIMISER)
    parts = [(i, 0, t) for i, t in enumerate(texts)]
    strings = super_windows._Strings(keys, [1] * 50, parts, 35, np.sort(words.runs))
    shared = [s for s, row in strings.rows.items() if row[3]]
    assert 0 < len(shared) < 5 and len(strings.rows) <= len(shared) + 100  # two edges of each text, no other string
    assert set(strings.known) == set(range(50))


def test_whole_tables(spark, docs_of, empty_docs):
    texts = made(5)
    docs = docs_of(texts)
    docs = docs.unionByName(docs.filter("doc_id = 20"))  # a repeated row
    docs = docs.selectExpr("CASE WHEN doc_id = 12 THEN NULL ELSE doc_id END AS doc_id", "text", "size AS n_words", "kept")
    want = brute([*texts, texts[20]], 35)
    found = sorted(tuple(r)[1:] for r in super_windows.remove_windows(docs.repartition(5)).collect())
    assert found == sorted(want)
    by_id = {r["doc_id"]: tuple(r)[1:] for r in super_windows.remove_windows(docs_of(texts)).collect()}
    plain = brute(texts, 35)
    assert by_id == dict(enumerate(plain))
    assert super_windows.remove_windows(empty_docs).count() == 0
    with pytest.raises(ValueError):
        super_windows.remove_windows(docs, length=8)


def test_long_text(docs_of):
    r = random.Random(3)
    text = " ".join(f"{r.randrange(10**6)}" for _ in range(700_000))  # several parts of one text
    again = " ".join(text.split()[650_000:650_100])
    found = {r["doc_id"]: r for r in super_windows.remove_windows(docs_of([text, again])).collect()}
    assert (found[0]["n_words"], found[0]["n_removed"], found[1]["n_removed"]) == (700_000, 100, 100)
    words = text.split()
    assert found[0]["kept_text"] == " ".join(words[:650_000] + words[650_100:])
