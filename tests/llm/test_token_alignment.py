"""Alignment of two tokenizers against brute force over whole texts, for all cuts in byte ranges."""

import random
from collections import Counter
from hashlib import sha256

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexiloom.llm import token_alignment

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tools():
    return token_alignment.aligner(*PATHS)


@pytest.fixture(scope="module")
def plain():
    """Tokens and their end places by the libraries alone, whole texts at a time."""
    import sentencepiece
    from tokenizers import Tokenizer, decoders

    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    letters = {c: i for i, c in zip([*range(33, 127), *range(161, 173), *range(174, 256)], [*map(chr, range(33, 127)), *map(chr, range(161, 173)), *map(chr, range(174, 256))])}
    letters |= {chr(256 + n): i for n, i in enumerate(i for i in range(256) if chr(i) not in letters)}

    def tokens(text):
        first = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        second = []
        for i in b.encode(text, num_threads=1):
            piece = b.id_to_piece(i)
            second.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
        return first, second

    return tokens


def brute(plain, texts):
    """Groups and links by the definition, as (n_a, n_b, n_groups, n_links, n_best, count_sum, groups)."""
    docs = []
    for text in texts:
        first, second = plain(text) if text else ([], [])
        raw = (" " + (text or "")).encode()
        if not text or b"".join(t for _, t in first) != raw or b"".join(t for _, t in second) != raw:
            docs.append(([], [], [], ""))
            continue
        ends = []
        for tokens in (first, second):
            at, here = 0, []
            for i, t in tokens:
                at += len(t)
                here.append((at, i))
            ends.append(here)
        links = [(i, j) for e, i in ends[0] for j in [x for f, x in ends[1] if f == e]]
        common = sorted({e for e, _ in ends[0]} & {e for e, _ in ends[1]})
        groups, low = [], 0
        for high in common:
            groups.append("|".join(",".join(str(i) for e, i in side if low < e <= high) for side in ends))
            low = high
        docs.append((first, second, links, ";".join(groups)))
    counts = Counter(x for d in docs for x in d[2])
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return [
        (len(a), len(b), g.count(";") + 1 if g else 0, len(k), sum(counts[x] == most[x[1]] for x in k), sum(counts[x] for x in k), g)
        for a, b, k, g in docs
    ]


TEXTS = st.text(
    alphabet=st.one_of(st.sampled_from(" \n\t\r,.a'sé!1\x1c\x85▁ 日😀the"), st.characters(codec="utf-8")), max_size=60
)


@settings(max_examples=400, deadline=None)
@given(TEXTS)
def test_whole_texts(tools, plain, text):
    found = next(tools.whole([text])) if text else None
    want = brute(plain, [text])[0]
    assert (found[:4] if found else (0, 0, 0, "")) == (*want[:3], want[6])


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXTS, min_size=1, max_size=3), st.integers(1, 40), st.randoms())
def test_any_cut_and_any_order_of_composition(tools, plain, texts, size, r):
    text = " word ".join(texts)
    parts = [tools.ranged(part, offset, low, high) for _, _, offset, low, high, part in token_alignment.chunk_ranges(text, size)]
    while len(parts) > 1:  # associative: any two neighbours first
        at = r.randrange(len(parts) - 1)
        parts[at : at + 2] = [token_alignment.compose(*parts[at : at + 2])]
    want = brute(plain, [text])[0]
    if parts[0].valid:
        assert (parts[0].n_a, parts[0].n_b, parts[0].n_groups, token_alignment.groups_of(parts[0])) == (*want[:3], want[6])
        assert sum(map(len, parts[0].links)) == want[3] and parts[0].suffix == ([], [])
    else:
        assert want[0] == 0


def test_cuts_inside_tokens_leave_open_parts(tools):
    text = "internationalization of responsibilities"
    parts = [tools.ranged(p, o, low, high) for size in range(3, 15) for _, _, o, low, high, p in token_alignment.chunk_ranges(text, size)]
    assert any(p.closed is None for p in parts) and any(p.suffix != ([], []) for p in parts)


def made(n, seed=4):
    r = random.Random(seed)
    syllables = ["th", "an", "er", "tion", "é", "ou", "日本", "😀", "ing", ".", ",", "'s", "\n", "  ", "1", "ß", "<0x41>", "<|endoftext|>"]
    words = ["".join(r.choices(syllables, k=r.randrange(1, 5))) for _ in range(80)]
    texts = [" ".join(r.choices(words, k=r.randrange(1, 60))) for _ in range(n)]
    return [None, "", " ", "▁", "a ▁ b", "\n\n", texts[0], *texts, "x" * 500, "the " * 200]


@pytest.mark.parametrize("chunk", [16, 100, 1 << 16])
def test_whole_tables(spark, docs_of, empty_docs, plain, monkeypatch, chunk):
    monkeypatch.setattr(token_alignment, "CHUNK", chunk)
    monkeypatch.setattr(token_alignment, "FAN", 3)
    texts = made(30)
    docs = docs_of(texts)
    docs = docs.unionByName(docs.filter("doc_id = 9")).selectExpr(
        "CASE WHEN doc_id = 12 THEN NULL ELSE doc_id END AS doc_id", "text", "size AS n_a", "kept AS groups"
    )
    want = brute(plain, [*texts, texts[9]])
    found = [tuple(r) for r in token_alignment.align(docs.repartition(3), *PATHS).collect()]
    keys = [None if i == 12 else i for i in range(len(texts))] + [9]
    assert sorted(found, key=str) == sorted([(k, *w) for k, w in zip(keys, want, strict=True)], key=str)
    hashed = {r["doc_id"]: r["groups"] for r in token_alignment.align(docs, *PATHS, groups=False).collect()}
    assert all(hashed[k] == (sha256(w[6].encode()).hexdigest() if w[6] else "") for k, w in zip(keys, want, strict=True))
    assert token_alignment.align(empty_docs, *PATHS).count() == 0


def test_links_pack(tools):
    import numpy as np

    links = np.array([5, 3, 3, 300_000, 0], np.uint32)
    assert token_alignment.unpack_links(token_alignment.pack_links(links)).tolist() == [0, 3, 3, 5, 300_000]
    assert len(token_alignment.unpack_links(token_alignment.pack_links(links[:0]))) == 0
