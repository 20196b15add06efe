"""Operators over small tables with nulls, blanks, long texts, ties, repeated rows and clashing columns."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexiloom.llm import (
    bwt_dedup, byte_bpe, components, hidden_markov, html_templates, kd_search, kneser_ney, line_dedup, line_rules,
    lsh_forest, mixing,
)
from lexiloom.llm.queries import public_ranks
from lexiloom.llm.words import WORD, lower_words

rng = random.Random(7)
VOCABULARY = [f"w{i}" for i in range(400)]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choices(VOCABULARY, k=n))


LONG = "\n".join(prose(40, i) + "." for i in range(600))
BASE = prose(120, 1000)
NEAR = BASE.replace(BASE.split()[60], "changed", 1)
TEXTS = [
    None, "", "  \n\t ", "one", "one two", BASE, BASE, NEAR, LONG, LONG + "\nend", "É a é A", prose(130, 5) + "\n" + BASE,
    "x " * 300, "The line.\nThe line.\nOther", "MENU | HOME | ABOUT\n" + prose(80, 6) + ".",
    "😀",
]


def rows(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def test_encode_and_decode(spark, docs_of, empty_docs):
    path, pattern = public_ranks()
    docs = docs_of(TEXTS).withColumn("ids", F.lit("clash"))
    done = byte_bpe.encode(docs, path, pattern, offsets=True, digests=True)
    found = rows(done)
    for i, text in enumerate(TEXTS):
        raw = (text or "").encode()
        assert found[i]["decoded_sha256"] == hashlib.sha256(raw).hexdigest()
        assert found[i]["n_tokens"] == len(found[i]["ids"]) == len(found[i]["starts"])
        assert found[i]["size"] == 1 and found[i]["text"] == text
    back = rows(byte_bpe.decode(done.select("doc_id", "ids"), path, pattern))
    assert all(back[i]["decoded_text"] == (t or "") for i, t in enumerate(TEXTS))
    split = spark.createDataFrame([(0, found[15]["ids"][:1]), (1, None)], "doc_id long, ids array<int>")
    assert rows(byte_bpe.decode(split, path, pattern))[0]["decoded_text"] == "�"  # half a character
    assert byte_bpe.encode(empty_docs, path, pattern).count() == 0


def test_line_rules(docs_of, empty_docs):
    found = rows(line_rules.measure(docs_of(TEXTS)))
    for i, text in enumerate(TEXTS):
        words = WORD.findall(text or "")
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        windows = Counter(tuple(words[j : j + 3]) for j in range(len(words) - 2))
        hit = {j + k for j in range(len(words) - 2) if windows[tuple(words[j : j + 3])] > 1 for k in range(3)}
        got = found[i]
        assert (got["n_words"], got["word_chars"]) == (len(words), sum(map(len, words)))
        assert got["n_dup_lines"] == len(lines) - len(set(lines)) and got["n_repeat_words"] == len(hit)
        assert got["base_failed"] == (len(words) < 50 or 100 * len(hit) > 50 * len(words))
    assert found[14]["kept"] and found[14]["clean_text"].startswith("w")
    assert not found[0]["kept"] and not found[12]["kept"]
    clean = line_rules.clean(docs_of(TEXTS))
    assert "clean_text" in clean.columns and clean.filter("doc_id = 14").first()["text"].startswith("w")
    assert line_rules.clean(empty_docs).count() == 0
    many = " ".join(f"a{i} b{i} c{i}" for i in range(80)) * 2  # more repeated windows than a list is searched for
    got = line_rules.measure(docs_of([many])).first()
    assert got["n_repeat_words"] == got["n_words"] - 3 or got["n_repeat_words"] >= got["n_words"] - 4


def brute_lines(texts, min_words=6):
    """Places of lines with an earlier copy; word edit distance by dynamic programming."""

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    seen, gone = [], set()
    for d, text in enumerate(texts):
        for at, line in enumerate((text or "").split("\n")):
            words = tuple(WORD.findall(line))
            if not words:
                continue
            near = len(words) >= min_words
            if any(
                words == other or near and len(other) >= min_words and abs(len(words) - len(other)) <= 1 and distance(words, other) <= 1
                for other in seen
            ):
                gone.add((d, at))
            seen.append(words)
    return gone


def test_line_dedup_equals_brute_force(docs_of, empty_docs):
    r = random.Random(3)
    lines = [prose(n, n) for n in (5, 6, 7, 8, 16, 17, 24, 25, 96, 97, 130)]
    texts = []
    for _ in range(60):
        body = []
        for _ in range(r.randint(0, 5)):
            words = r.choice(lines).split()
            for _ in range(r.choice((0, 0, 1, 1, 2))):
                place = r.randrange(len(words))
                match r.randrange(3):
                    case 0: words[place] = "new"
                    case 1: words.insert(place, r.choice(words))
                    case _: words.pop(place)
            body.append(r.choice((" ", "  ", "\t")).join(words))
        texts.append("\n".join(body))
    texts += [None, "", "\n \n", "a a b c c d e", "a a b b c d e", LONG]
    gone = brute_lines(texts)
    found = rows(line_dedup.deduplicate(docs_of(texts)))
    for d, text in enumerate(texts):
        left = [x for at, x in enumerate((text or "").split("\n")) if (d, at) not in gone]
        assert found[d]["n_removed"] == sum(1 for x, _ in gone if x == d)
        assert found[d]["dedup_text"] == "\n".join(left)
    assert line_dedup.deduplicate(empty_docs).count() == 0
    twice = docs_of(["a b c d e f g"]).unionAll(docs_of(["a b c d e f g"]))
    assert [r["n_removed"] for r in line_dedup.deduplicate(twice).collect()] == [0, 0]


def brute_components(texts, width, percent):
    sets = []
    for text in texts:
        words = lower_words(text)
        sets.append({tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set())
    label = list(range(len(texts)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                label[b] = a
    return sets, [find(i) for i in range(len(texts))]


def test_line_dedup_of_rows_that_repeat_an_id(spark, docs_of):
    """Equal id and text: one document.  Equal id, other text: documents of their own."""
    first, near = "p q r s t u v w\nx y", "p q r s t u v X\nz z"
    df = spark.createDataFrame(
        [(1, first), (1, near), (1, first), (2, "x y\nz z\nown"), (None, "a b c d e f"), (None, "a b c d e g")],
        "doc_id long, text string",
    )
    left = Counter()
    for r in line_dedup.deduplicate(df).collect():
        left[r["doc_id"], r["dedup_text"]] += 1
    assert left[2, "own"] == 1
    kept_first = left == {(1, first): 2, (1, "z z"): 1, (2, "own"): 1, (None, ""): 1, **_one_of(left)}
    kept_near = left == {(1, near): 1, (1, "x y"): 2, (2, "own"): 1, (None, ""): 1, **_one_of(left)}
    assert kept_first or kept_near


def _one_of(left):
    return {k: 1 for k in left if k[0] is None and k[1] in ("a b c d e f", "a b c d e g")}


def test_line_keys_of_repeated_words(docs_of):
    """Windows that repeat cancel in one half of a key only; each of the three is one edit from an earlier line."""
    lines = ["x x x x x x x", "x x x x x x", "y x x x x x x x x", "y x x x x x x", "x y x y x y x y", "x y x y x y x x"]
    gone = line_dedup.deduplicate(docs_of(lines)).filter("n_removed > 0").collect()
    assert {r["doc_id"] for r in gone} == {1, 3, 5}


def test_rows_of_one_id_share_a_component(spark):
    a, b, c = prose(60, 50), prose(60, 51), prose(60, 52)
    rows_ = [(3, a), (5, a), (5, b), (7, b), (7, c), (9, c), (2, prose(60, 53)), (2, prose(60, 54)), (None, a)]
    df = spark.createDataFrame(rows_, "doc_id long, text string")
    found = {(r["doc_id"], r["component_id"], r["kept"]) for r in lsh_forest.near_duplicates(df).collect()}
    assert found == {(3, 3, True), (5, 3, False), (7, 3, False), (9, 3, False), (2, 2, True), *(f for f in found if f[0] is None)}


@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_near_duplicates_equal_brute_force(docs_of, empty_docs, width, percent):
    r = random.Random(width)
    texts = list(TEXTS)
    base = prose(150, 77).split()
    for _ in range(90):  # one dense group around a hub, some members of which only the hub links
        copy = list(base)
        for place in r.sample(range(len(copy)), r.randint(0, 6)):
            copy[place] = f"v{r.randrange(50)}"
        texts.append(" ".join(copy))
    texts += [BASE.upper(), "w1 w2", "W1  w2", prose(3, 2)]
    sets, labels = brute_components(texts, width, percent)
    found = rows(lsh_forest.near_duplicates(docs_of(texts), width=width, percent=percent))
    assert [found[i]["n_shingles"] for i in range(len(texts))] == [len(s) for s in sets]
    assert [found[i]["component_id"] for i in range(len(texts))] == labels
    assert all(found[i]["kept"] == (labels[i] == i) for i in range(len(texts)))
    assert lsh_forest.near_duplicates(empty_docs).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101 + i) for i in range(30)] + [(7, 7)]
    r = random.Random(1)
    r.shuffle(links)
    found = {x["node"]: x["label"] for x in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 131)}}


def test_mix(docs_of, empty_docs):
    docs = docs_of(TEXTS)
    mix = mixing.Mix(docs, block=16)
    found = mix.per_document().collect()
    assert len(found) == len(TEXTS)
    sizes = {i: len(WORD.findall(t or "")) for i, t in enumerate(TEXTS)}
    by_source = {}
    for r in found:
        assert r["size"] == sizes[r["_doc"]] and 0 <= r["taken"] <= 2 * r["size"]
        by_source.setdefault((r["source_size"], r["target"]), []).append(r["taken"])
    for (_, target), taken in by_source.items():
        assert abs(sum(taken) - target) <= 1
    assert sum(t for _, t in by_source) == pytest.approx(1.5 * sum(sizes.values()))
    again = mixing.Mix(docs.repartition(5), block=16).per_document().collect()
    assert sorted((r["_doc"], r["taken"]) for r in again) == sorted((r["_doc"], r["taken"]) for r in found)
    taken = Counter()
    for r in mix.documents().collect():
        taken[r["doc_id"]] += len(WORD.findall(r["text"]))
    assert taken == Counter({r["_doc"]: r["taken"] for r in found if r["taken"]})
    assert mixing.Mix(empty_docs).per_document().count() == 0 and mixing.Mix(empty_docs).documents().count() == 0
    doubled = mixing.Mix(docs.unionAll(docs), block=16).per_document().collect()
    assert len(doubled) == 2 * len(TEXTS) and all(r["taken"] <= 2 * r["size"] for r in doubled)
    without_ids = mixing.Mix(docs.withColumn("doc_id", F.lit(None).cast("long")), block=16).per_document().collect()
    assert abs(sum(r["taken"] for r in without_ids) - 1.5 * sum(sizes.values())) <= 3


def test_mix_equals_brute_force_over_many_shards(docs_of):
    """Streams of words, blocks, permutations and draws done by hand, from the places where documents start."""
    block, shard_words, seed = 16, 512, mixing.SEED
    docs = docs_of(TEXTS).withColumn("shard", F.lit("clash"))
    mix = mixing.Mix(docs, block=block, shard_words=shard_words)
    owner = {}
    for r in mixing.packed(mix.rows).collect():
        stream = owner.setdefault(r["_source"], {})
        for at in range(r["_start"], r["_start"] + r["_size"]):
            assert at not in stream
            stream[at] = r["_doc"]
    targets = {r["_source"]: r for r in mix.targets.collect()}
    shards = -(-sum(t["_words"] for t in targets.values()) // shard_words)
    assert shards > 10
    taken, drawn, of = Counter(), Counter(), {}
    for name, stream in owner.items():
        size, wanted = targets[name]["source_size"], targets[name]["_words"]
        assert sorted(stream) == list(range(size))
        blocks = -(-size // block)
        order, left, turn = [], wanted, 0
        while left > 0:
            for b in mixing.permuted(np.arange(blocks), blocks, mixing._key(seed, name, turn)):
                words = range(b * block, min((b + 1) * block, size))[: max(left, 0)]
                if len(words):
                    order.append(words)
                left -= len(words)
            turn += 1
        assert left == 0
        of_slot = mixing.shards_of(0, len(order), len(order), shards, seed, name)
        for words, shard in zip(order, of_slot, strict=True):
            drawn[int(shard), name] += 1
            for at in words:
                taken[stream[at]] += 1
                of.setdefault(stream[at], set()).add(int(shard))
    for r in mix.per_document().collect():
        assert r["taken"] == taken[r["_doc"]]
        mine = of.get(r["_doc"])
        assert (r["first_shard"], r["last_shard"]) == ((min(mine), max(mine)) if mine else (None, None))
    found = {(r["_shard"], r["_source"]): r["slots"] for r in mix.shard_counts().collect()}
    assert found == drawn and len({shard for shard, _ in found}) > 10
    placed = mix.documents(shard="shard").collect()
    assert all(r["shard"] in of[r["doc_id"]] for r in placed)
    plain = mix.documents().collect()
    assert sorted((r["doc_id"], r["text"]) for r in placed) == sorted((r["doc_id"], r["text"]) for r in plain)
    assert {r["shard"] for r in plain} == {"clash"}


def test_top_k(spark):
    r = np.random.default_rng(5)
    vectors = [(i, [float(x) for x in r.normal(0, 0.2, 4)], "x") for i in range(230)]
    vectors += [(300, None, "x"), (350, [1.0, None, 0.0, 0.0], "x"), (400, [float("nan"), 0.0, 0.0, 0.0], "x")]
    vectors += [(450, [float("inf"), 0.0, 0.0, 0.0], "x"), (500, [], "x"), (550, [1.0, 2.0], "x"), (10, vectors[10][1], "x")]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>, rank string")
    whole = {i: np.floor(256 * np.float32(v).astype(float)) for i, v, _ in vectors[:230]}
    found = {}
    for h in kd_search.top_k(df, F.col("vec_id") % 50 == 0).collect():
        found.setdefault(h["query_id"], []).append((h["rank"], h["vec_id"], h["score"]))
    assert sorted(found) == [0, 50, 100, 150, 200]
    for q, hits in found.items():
        scores = [(-int(whole[q] @ whole[i]), i) for i in [*whole, 10] if i != q]
        assert sorted(hits) == [(n + 1, i, -s) for n, (s, i) in enumerate(sorted(scores)[:5])]
    assert kd_search.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_repeats_equal_brute_force(docs_of, empty_docs, monkeypatch):
    passage = "\n".join(prose(60, 9) for _ in range(1))
    texts = [*TEXTS, prose(50, 1) + passage + prose(50, 2), passage + "é" * 150, "é" * 150 + prose(70, 3) + passage, "ab" * 400, "z" * 199, "z" * 199]
    raws = [(t or "").encode() for t in texts]
    counts = Counter(raw[i : i + 200] for raw in raws for i in range(len(raw) - 199))
    for many in (bwt_dedup.BATCH, 800):  # the second sends shared anchors to the counted way
        monkeypatch.setattr(bwt_dedup, "BATCH", many)
        found = rows(bwt_dedup.remove_repeats(docs_of(texts)))
        for i, raw in enumerate(raws):
            gone = np.zeros(len(raw), bool)
            for j in range(len(raw) - 199):
                if counts[raw[j : j + 200]] > 1:
                    gone[j : j + 200] = True
            kept = bytes(np.frombuffer(raw, np.uint8)[~gone])
            spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
            got = found[i]
            assert (got["n_bytes"], got["n_removed"], got["n_spans"]) == (len(raw), int(gone.sum()), spans)
            assert got["kept_bytes"] == kept and got["kept_sha256"] == hashlib.sha256(kept).hexdigest()
    assert bwt_dedup.remove_repeats(empty_docs).count() == 0


def test_repeats_of_rows_without_id_equal_brute_force(docs_of):
    passage, alone = prose(60, 9), prose(60, 10)
    texts = [prose(50, 1) + passage + prose(50, 2), prose(50, 3) + passage, prose(50, 4) + alone, alone + prose(50, 5), prose(70, 6)]
    raws = [t.encode() for t in texts]
    counts = Counter(raw[i : i + 200] for raw in raws for i in range(len(raw) - 199))
    docs = docs_of(texts).withColumn("doc_id", F.when(F.col("doc_id").isin(0, 4), F.col("doc_id")))
    want = Counter()
    for i, raw in enumerate(raws):
        gone = np.zeros(len(raw), bool)
        for j in range(len(raw) - 199):
            if counts[raw[j : j + 200]] > 1:
                gone[j : j + 200] = True
        want[(i if i in (0, 4) else None, bytes(np.frombuffer(raw, np.uint8)[~gone]), int(gone.sum()))] += 1
    got = Counter((r["doc_id"], bytes(r["kept_bytes"]), r["n_removed"]) for r in bwt_dedup.remove_repeats(docs).collect())
    assert got == want


def test_hidden_markov_scores(docs_of, empty_docs, monkeypatch):
    monkeypatch.setattr(hidden_markov, "HEAD", 20)  # most words are joined
    texts = [*TEXTS[:8], *(prose(40, i) for i in range(30)), "unseen words only here"]
    docs = docs_of(texts)
    found = rows(hidden_markov.score(docs, F.col("doc_id") % 5 == 2, rounds=2, states=2))
    counts, kinds = Counter(), Counter()
    for i, t in enumerate(texts):
        if i % 5 != 2:
            counts.update([*lower_words(t), None])
    n, v = sum(counts.values()), len(counts)
    for i, t in enumerate(texts):
        tokens = [*lower_words(t), None]
        got = found[i]
        assert got["held_out"] == (i % 5 == 2) and got["n_tokens"] == len(tokens) and got["train_tokens"] == n
        assert got["n_known"] == sum(counts[x] > 0 for x in tokens)
        base = sum(np.log10((counts[x] + 1) / (n + v + 1)) for x in tokens)
        assert got["base_score"] == pytest.approx(base, abs=1e-6) and got["score"] <= 0
    del kinds
    assert hidden_markov.score(empty_docs, F.lit(False), rounds=1).count() == 0
    every = hidden_markov.score(docs, F.lit(True), rounds=1).collect()  # nothing to learn from
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 and np.isfinite(r["score"]) for r in every)


def test_templates_go_and_articles_stay(spark):
    shell = "<div><p>Site name</p><p>All about things</p></div>{0}<div><span>Contact us at the site</span></div>"
    pages = [(i, "http://a.example/x", shell.format(f"<p>Story number {i}</p>")) for i in range(8)]
    pages += [(20 + i, "http://b.example/", f"<article><p>Same words</p></article><p>out {i}</p>") for i in range(8)]
    pages += [(40, None, None), (41, "", ""), (42, "http://c.example/", shell.format("<p>Alone</p>"))]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    found = rows(html_templates.main_text(df), "page_id")
    assert all(found[i]["text"] == f"Story number {i}" for i in range(8))
    assert all(found[20 + i]["text"] == "Same words" for i in range(8))
    assert found[40]["text"] == found[41]["text"] == "" and found[40]["n_chars"] == 0
    assert found[42]["text"] == "Site name All about things Alone Contact us at the site"
    assert html_templates.main_text(df.limit(0)).count() == 0
    assert html_templates.main_text(df.unionAll(df)).count() == 2 * len(pages)


def test_templates_inside_articles_go_and_count_articles_once(spark):
    page = "<article><h1>Title {0}</h1><p>Story {0}</p><div><p>Read more</p><p>Tell a friend</p></div></article>"
    pages = [(i, "http://a.example/x", page.format(i)) for i in range(8)]
    copy = "<article><h1>Same</h1><p>Words {0}</p></article><p>out {1}</p>"
    pages += [(20 + i, "http://b.example/x", copy.format(i % 4, i)) for i in range(12)]  # four articles only
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    found = rows(html_templates.main_text(df), "page_id")
    assert all(found[i]["text"] == f"Title {i} Story {i}" for i in range(8))
    assert all(found[20 + i]["text"] == f"Same Words {i % 4}" for i in range(12))


def test_wrapped_articles_stay(spark):
    classes = ("layout has-sidebar", "no-sidebar", "content-with-sidebar", "elementor-widget-text-editor", "widget", "sidebar")
    pages = [(i, f"http://{i}.example/", f"<div class='{c}'><article><p>Own words</p></article></div>") for i, c in enumerate(classes)]
    pages += [(20 + i, f"http://d{i}.example/", f"<div class='{c}'><p>Own words</p></div>") for i, c in enumerate(classes[:4])]
    copy = "<div id=page><article><p>Same words</p></article></div><p>out {0}</p>"
    pages += [(30 + i, "http://b.example/x", copy.format(i)) for i in range(6)]
    shell = "<div id=page><article><p>Same words</p></article></div><div><article><p>Story {0}</p></article></div>"
    pages += [(40 + i, "http://c.example/x", shell.format(i)) for i in range(6)]
    comments = "<main><p>Own words</p><div class=comments-area><article class=comment-body><p>first!</p></article></div></main>"
    pages += [(50, "http://e.example/", comments)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    found = rows(html_templates.main_text(df), "page_id")
    assert all(found[i]["text"] == "Own words" for i in [*range(6), *range(20, 24), 50])
    assert all(found[30 + i]["text"] == "Same words" for i in range(6))
    assert all(found[40 + i]["text"] == f"Same words Story {i}" for i in range(6))


def test_quality_model_tells_junk_from_prose(spark, docs_of, empty_docs):
    good = [prose(80, i) for i in range(300)]
    junk = [" ".join(f"{w.upper()}%%" for w in prose(80, 1000 + i).split()) for i in range(20)]
    docs = docs_of([*good, *junk, None, ""])
    labels = spark.createDataFrame([(i, 1, 0) for i in range(200)] + [(300, 0, 0), (5, 1, None)], "doc_id long, quality int, toxic int")
    found = rows(kneser_ney.classify(docs, labels))
    assert sum(found[i]["kept"] for i in range(300)) >= 290
    assert not any(found[300 + i]["kept"] for i in range(20))
    assert found[320]["kept"] and found[321]["kept"]
    assert all(r["kept"] for r in kneser_ney.classify(docs, labels.limit(0)).collect())
    assert kneser_ney.classify(empty_docs, labels).count() == 0


def test_a_long_trusted_document_leaves_room_for_others(spark, docs_of, monkeypatch):
    monkeypatch.setattr(kneser_ney, "MAX_WORDS", 2000)
    docs = docs_of([prose(10, i) for i in range(150)])
    first = docs.orderBy(F.pmod(F.xxhash64(F.lit(10), "doc_id"), F.lit(1 << 30))).first()["doc_id"]
    docs = docs.withColumn("text", F.when(F.col("doc_id") == first, F.lit(prose(3000, 1))).otherwise(F.col("text")))
    sample = rows(kneser_ney.sample_of(docs, docs.select("doc_id"), "text"))
    assert len(sample) == 150 and len(sample[first]["_text"].split()) == 20
    assert len(kneser_ney.train(kneser_ney.sample_of(docs, docs.select("doc_id"), "text")).vocabulary) > 100


def test_quality_model_sums_to_one(spark, docs_of):
    sample = docs_of([prose(60, i) for i in range(40)]).select("doc_id", F.col("text").alias("_text"))
    model = kneser_ney.train(sample)
    size = len(model.unigram)
    assert model.unigram.sum() == pytest.approx(1)
    for context in ([], [kneser_ney.RESERVED], [kneser_ney.RESERVED + 3, kneser_ney.RESERVED + 9], [kneser_ney.REPEAT] * 2):
        p = [10 ** model.logs(np.array([*context, w]))[-1] for w in range(size)]
        assert sum(p) == pytest.approx(1, abs=1e-6)
