"""Parts that need no cluster, against brute force."""

import base64
import math
import random
import time
from collections import Counter
from itertools import product
from math import log

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexiloom.llm import bwt_dedup, byte_bpe, hidden_markov, html_templates, kd_search, kneser_ney, lsh_forest, mixing
from lexiloom.llm.queries import public_ranks


@pytest.fixture(scope="module")
def codecs():
    import tiktoken

    path, pattern = public_ranks()
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    plain = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return byte_bpe.codec(path, pattern), plain


TEXTS = st.text(alphabet=st.one_of(st.sampled_from(" \n\t\r,.a'sé!1\x1c\x85 日😀"), st.characters(codec="utf-8")), max_size=80)


@settings(max_examples=300, deadline=None)
@given(text=TEXTS)
def test_bpe_equals_the_plain_encoder(codecs, text):
    own, plain = codecs
    ids = np.frombuffer(own.encode([text])[0], "<u4")
    assert ids.tolist() == plain.encode_ordinary(text)
    assert own.decode(ids) == text.encode()
    starts, ends = own.offsets(text, ids)
    for token, a, b in zip(ids.tolist(), starts, ends, strict=True):
        assert own.bytes_of[token] in text[a:b].encode()  # whole characters around the token's bytes


def test_bpe_alphabet_and_memo(codecs, monkeypatch):
    alphabet = byte_bpe.byte_alphabet()
    assert len(set(alphabet)) == 256 and alphabet[ord("A")] == "A" and alphabet[0] == chr(256)
    own, plain = codecs
    monkeypatch.setattr(byte_bpe, "MEMO", 2)
    texts = ["one two three four", "", "five six seven"]
    assert [np.frombuffer(p, "<u4").tolist() for p in own.encode(texts)] == [plain.encode_ordinary(t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(
    contexts=st.lists(st.binary(min_size=3, max_size=24).map(lambda b: bytes(97 + x % 2 for x in b)), min_size=1, max_size=8, unique=True),
    shards=st.integers(1, 5),
    length=st.integers(2, 6),
)
def test_merged_transforms_find_all_repeats(contexts, shards, length):
    counts = Counter(c[i : i + length] for c in contexts for i in range(len(c) - length + 1))
    for context, starts in zip(contexts, bwt_dedup.merged_repeats(contexts, length, shards), strict=True):
        assert sorted(starts.tolist()) == [i for i in range(len(context) - length + 1) if counts[context[i : i + length]] > 1]


def test_anchors_cover_every_window_once(monkeypatch):
    random.seed(5)
    for raw in (random.randbytes(3000), b"a" * 1500, b"ab" * 700, random.randbytes(200), b"short"):
        for chunk in (1 << 19, 400):
            monkeypatch.setattr(bwt_dedup, "CHUNK", chunk)
            f, first, last, _ = bwt_dedup.anchors(np.frombuffer(raw, np.uint8))
            covered = [w for a, b in zip(first, last, strict=True) for w in range(a, b + 1)]
            assert covered == list(range(max(0, len(raw) - 199)))
    # equal windows have equal anchors, whatever is around them
    window = random.randbytes(200)
    keys = set()
    for _ in range(20):
        before = random.randbytes(random.randrange(300))
        raw = np.frombuffer(before + window + random.randbytes(300), np.uint8)
        f, first, last, _ = bwt_dedup.anchors(raw)
        keys |= {int(k) for k, a, b in zip(f, first, last, strict=True) if a <= len(before) <= b}
    assert len(keys) == 1


def test_forward_and_counts_equal_sums_over_all_paths():
    rng = np.random.default_rng(1)
    states, symbols = 2, hidden_markov.BUCKETS + 1
    emit = np.zeros((symbols, states))
    emit[[0, 1, 2, hidden_markov.END]] = rng.uniform(0.1, 1, (4, states))
    tables = hidden_markov.Tables(np.array([0.3, 0.7]), np.array([[0.9, 0.1], [0.4, 0.6]]), emit / emit.sum(axis=0))
    sequences = [np.array([0, 1, 2, 1, hidden_markov.END]), np.array([2, 0, hidden_markov.END]), np.array([hidden_markov.END])]
    moves, emissions, totals = np.zeros((2, 2)), np.zeros((symbols, 2)), []
    for seq in sequences:
        weights = {}
        for path in product(range(states), repeat=len(seq)):
            p = tables.start[path[0]] * tables.emit[seq[0], path[0]]
            for t in range(1, len(seq)):
                p *= tables.move[path[t - 1], path[t]] * tables.emit[seq[t], path[t]]
            weights[path] = p
        total = sum(weights.values())
        totals.append(log(total))
        for path, p in weights.items():
            for t, s in enumerate(path):
                emissions[seq[t], s] += p / total
                if t:
                    moves[path[t - 1], s] += p / total
    assert np.allclose(hidden_markov.forward(tables, sequences), totals)
    starts, found_moves, found, value = hidden_markov.expected_counts(tables, sequences)
    assert np.allclose(found_moves, moves) and np.allclose(found, emissions) and np.isclose(value, sum(totals))
    assert np.isclose(starts.sum(), 3)


def test_training_never_lowers_the_likelihood():
    rng = np.random.default_rng(2)
    kinds = [rng.integers(0, 40, 30), rng.integers(40, 80, 30)]
    sequences = sorted(
        (np.append(rng.choice(kinds[i % 2], 60 + i), hidden_markov.END) for i in range(30)), key=lambda s: -len(s)
    )
    prior = np.bincount(np.concatenate(sequences), minlength=hidden_markov.BUCKETS + 1) + 1e-9
    prior /= prior.sum()
    tables, values = hidden_markov.first_tables(prior, 2), []
    for _ in range(8):
        starts, moves, emissions, value = hidden_markov.expected_counts(tables, sequences)
        values.append(value)
        tables = hidden_markov.Tables(starts / starts.sum(), moves / moves.sum(axis=1, keepdims=True), emissions / emissions.sum(axis=0))
    assert all(b >= a - 1e-6 for a, b in zip(values, values[1:], strict=False)) and values[-1] > values[0] + 100


def test_permutations_and_shares():
    for n in (1, 2, 3, 5, 17, 1000):
        places = mixing.permuted(np.arange(n), n, 99)
        assert sorted(places) == list(range(n))
        assert [mixing.unpermuted(int(p), n, 99) for p in places[:40]] == list(range(min(n, 40)))
    targets = mixing.water_filled([100, 100, 100], [3, 1, 2], 450, 2)
    assert [float(t) for t in targets] == [200.0, 250 / 3, 500 / 3]
    assert mixing.water_filled([0, 0], [3, 1], 0, 2) == [0, 0] and mixing.water_filled([], [], 0, 2) == []
    assert mixing.cut_words(" a b\n c  d e ", [0, 2, 3], [1, 3, 4]) == "a\nc  d"


def test_tree_search_equals_brute_force():
    rng = np.random.default_rng(3)
    for scale in (1, 1 << 25):  # the second is beyond exact doubles
        ids = rng.permutation(400)
        vectors = np.floor(rng.normal(0, 5, (400, 3))) * scale
        vectors[50:90] = vectors[50]  # ties
        tree = kd_search.Tree(ids, vectors)
        queries = np.vstack([vectors[:20], np.zeros((1, 3))])
        own = np.append(ids[:20], -1)
        hits = tree.search(own, queries, np.full(21, -np.inf), 5)
        for q in range(21):
            exact = [(-sum(int(a) * int(b) for a, b in zip(v, queries[q], strict=True)), int(i)) for i, v in zip(ids, vectors, strict=True) if i != own[q]]
            want = [(i, -s) for s, i in sorted(exact)[:5]]
            got = sorted(((i, s) for o, i, s in hits if o == own[q]), key=lambda x: (-x[1], x[0]))
            assert got == want


def test_sketches_never_rule_out_a_link():
    rng = np.random.default_rng(4)
    for n in (20, 150, 900):
        base = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
        other = np.unique(np.concatenate([base[: int(len(base) * 0.93)], rng.integers(0, 1 << 63, max(1, n // 20), dtype=np.uint64)]))
        jaccard = len(np.intersect1d(base, other)) / len(np.union1d(base, other))
        a, b = lsh_forest.sketch(base).tobytes(), lsh_forest.sketch(other).tobytes()
        assert lsh_forest.sketches_allow([a], [b], jaccard)[0]
        far = lsh_forest.sketch(np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))).tobytes()
        assert not lsh_forest.sketches_allow([a], [far], 0.8)[0]


def test_filters_miss_less_than_the_regions():
    def tail(below, n, p):
        return sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(below))

    width, ends = lsh_forest.TREES * lsh_forest.DEPTH, np.array([100])
    for least in (0.8, 0.85):
        miss = (1 - least**lsh_forest.DEPTH) ** lsh_forest.TREES
        sig = np.arange(width, dtype=np.uint32)[None, :]
        for same in range(width + 1):
            other = np.where(np.arange(width) < same, sig, sig + 1000).astype(np.uint32)
            if lsh_forest._alike(sig, other, ends, ends, least)[0, 0] >= 0:
                break
        assert tail(same, width, least) < miss
        size = lsh_forest.SKETCH
        for both in range(size, 0, -1):  # `size` hashes of the union, then one above them that cuts each sketch off
            own = size - both
            low = np.arange(1, size + 1, dtype=np.uint32)
            a = np.concatenate([low[:both], low[both : both + own // 2], 1000 + np.arange(size, dtype=np.uint32)])[:size]
            b = np.concatenate([low[:both], low[both + own // 2 :], 1000 + np.arange(size, dtype=np.uint32)])[:size]
            if tail(both, size, least) < miss:
                break
            assert lsh_forest.sketches_allow([a.tobytes()], [b.tobytes()], least)[0]


def test_pages():
    def text(html):
        page = html_templates.Page(html)
        return " ".join(b for (b, _, _), kept in zip(page.blocks, page.kept, strict=True) if kept)

    assert text("") == "" and text("plain &amp; text") == "plain & text"
    assert text("<p>a&nbsp;b <b>c</b>d<br>e<p>f") == "a b cd e f"
    assert text("<nav>menu</nav><article><header><h1>T</h1><nav>x</nav></header><p>one<p>two <script>'</p>'</script>three</article><footer>f</footer>") == "T one two three"
    assert text("<article><p>x</p><section class='comments'><p>c</p></section><form>f</form>y</article><aside>z</aside>") == "x y"
    assert text("<div class=cookie-notice>n</div><div id='ad'>a</div><p>kept &lt;3 &am</p><!-- <p>no</p> -->") == "kept <3 &am"
    assert text("<style>p{}</style><title>t</title>body<article>unclosed <p>tail") == "unclosed tail"
    assert html_templates.host_of("https://u:p@WWW.Example.com:80/x?y") == "example.com"
    assert html_templates.host_of(None) is None


def test_damaged_pages():
    def text(html):
        page = html_templates.Page(html)
        return [block for (block, _, _), kept in zip(page.blocks, page.kept, strict=True) if kept]

    assert text("<p data=it's>Hello world. It's nice</p>") == ["Hello world. It's nice"]
    assert text('<p title="a > b">one</p><p a="x>two</p>') == ["one", "two"]
    assert text("<p>x <math>y</math> <label>z</label></p>") == ["x y z"]
    around = '<div class="cookie-warning"><article>A<div id="ad-box-1">no</div></article></div>'
    assert text(f'<div class="has-comments">{around}<div class="reader-comments">no</div></div>') == ["A"]


@pytest.mark.parametrize(
    "html",
    [
        "".join(f"<font color={i}><b>w {i}<p>x" for i in range(40_000)),
        "".join(f"<div class=ad><p>t {i}</p>" for i in range(30_000)),
        "<p><td>" + "<b>" * 50_000 + "<h1>x</h1>" * 50_000,
        "<b>" * 100_000 + "</i>" * 100_000,
        '<a b="x' * 100_000,
    ],
)
def test_nested_pages_take_linear_time(html):
    begin = time.process_time()
    page = html_templates.Page(html)
    assert time.process_time() - begin < 20 and len(page.kept) == len(page.blocks)


def test_shard_draws_agree_in_parts():
    whole = mixing.shards_of(0, 5000, 5000, 37, 7, "s")
    parts = [mixing.shards_of(i, min(i + 321, 5000), 5000, 37, 7, "s") for i in range(0, 5000, 321)]
    assert (np.concatenate(parts) == whole).all() and (np.diff(whole) >= 0).all()
    counts = np.bincount(whole, minlength=37)
    assert len(counts) == 37 and abs(counts - 5000 / 37).max() < 6 * (5000 / 37) ** 0.5
    assert (mixing.shards_of(0, 5000, 5000, 37, 7, "t") != whole).any()


def test_token_shapes_and_model():
    numbers = kneser_ney.Numbers([b"the"])
    tokens = numbers.tokens("the the odd Odd ODD 12 od%d !! the").tolist()
    shapes = [kneser_ney.FIRST_SHAPE + i for i in range(6)]
    assert tokens == [kneser_ney.RESERVED, kneser_ney.REPEAT, *shapes, kneser_ney.RESERVED, kneser_ney.END]
    assert numbers.tokens(None).tolist() == [kneser_ney.END]
    assert kneser_ney.discounts({1: 10, 2: 4, 3: 2, 4: 1}) == pytest.approx([1 - 2 * (10 / 18) * 0.4, 2 - 3 * (10 / 18) * 0.5, 3 - 4 * (10 / 18) * 0.5])
