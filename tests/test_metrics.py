"""Metrics against small independent implementations and hand-made values."""

import math
import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from lexiloom.functions import edits
from lexiloom.functions.edits import edit_distance
from lexiloom.functions.metrics import (
    Chrf,
    EditSimilarity,
    SentenceBleu,
    add_metrics,
    chrf_words,
    corpus_scores,

)

PAIRS = [
    ("the cat sat on the mat", "the cat sat on the mat"),
    ("the cat", "the cat sat on the mat"),
    ("a b c d e", "v w x y z"),
    ("", "something"),
    ("something", ""),
    ("", ""),
    ("The Cat, sat!", "the cat sat"),
    ("mat the on sat cat the", "the cat sat on the mat"),
    ("é è ê", "e è e"),
]


def python_bleu(hyp, ref, orders=4):
    hyp, ref = hyp.split(), ref.split()
    logs, used, k, matched = 0.0, 0, 0, 0
    for n in range(1, orders + 1):
        h = Counter(tuple(hyp[i : i + n]) for i in range(len(hyp) - n + 1))
        r = Counter(tuple(ref[i : i + n]) for i in range(len(ref) - n + 1))
        total, match = sum(h.values()), sum((h & r).values())
        if not total:
            break
        matched += match
        used += 1
        k += match == 0
        logs += math.log(100 * match / total if match else 100 / (2**k * total))
    if not matched:
        return 0.0
    bp = 1.0 if len(hyp) >= len(ref) else math.exp(1 - len(ref) / len(hyp))
    return bp * math.exp(logs / used)


def python_chrf(hyp, ref, word_order=0):
    sides = [("".join(hyp.split()), "".join(ref.split()), 6)]
    if word_order:
        sides.append((split_marks(hyp), split_marks(ref), word_order))
    p = q = n_used = 0
    for h_text, r_text, orders in sides:
        for n in range(1, orders + 1):
            h = Counter(tuple(h_text[i : i + n]) for i in range(len(h_text) - n + 1))
            r = Counter(tuple(r_text[i : i + n]) for i in range(len(r_text) - n + 1))
            if h and r:
                match = sum((h & r).values())
                p, q, n_used = p + match / sum(h.values()), q + match / sum(r.values()), n_used + 1
    if not n_used or p + q == 0:
        return 0.0
    p, q = p / n_used, q / n_used
    return 100 * 5 * p * q / (4 * p + q)


def split_marks(value):
    import string

    out = []
    for word in value.split():
        if len(word) > 1 and word[-1] in string.punctuation:
            out += [word[:-1], word[-1]]
        elif len(word) > 1 and word[0] in string.punctuation:
            out += [word[0], word[1:]]
        else:
            out.append(word)
    return out


def normal(value):
    import string

    return value.lower().translate(str.maketrans("", "", string.punctuation))


def table(spark, pairs):
    return spark.createDataFrame([(i, h, r) for i, (h, r) in enumerate(pairs)], "i int, h string, r string")


def random_pairs(count):
    rng = random.Random(7)
    words = ["a", "ab", "b!", "(c", "d,", "é", "!!", "(x)", "word.", "-"]
    make = lambda: " ".join(rng.choice(words) for _ in range(rng.randint(0, 9)))
    return [(make(), make()) for _ in range(count)]


def test_row_metrics(spark):
    pairs = PAIRS + random_pairs(80)
    metrics = {
        "bleu": SentenceBleu(),
        "bleu2": SentenceBleu(2),
        "chrf": Chrf(),
        "pp": Chrf(2),
        "raw": Chrf(2, lowercase=False),
    }
    rows = add_metrics(table(spark, pairs), metrics, "r", "h", "r").orderBy("i").collect()
    for row, (h, r) in zip(rows, pairs):
        nh, nr = normal(h), normal(r)
        assert row["bleu"] == pytest.approx(python_bleu(nh, nr))
        assert row["bleu2"] == pytest.approx(python_bleu(nh, nr, 2))
        assert row["chrf"] == pytest.approx(python_chrf(nh, nr))
        assert row["pp"] == pytest.approx(python_chrf(nh, nr, 2))
        assert row["raw"] == pytest.approx(python_chrf(h, r, 2)), (h, r)
    assert rows[0]["bleu"] == pytest.approx(100) and rows[0]["chrf"] == pytest.approx(100)
    assert rows[2]["bleu"] == 0 and rows[2]["chrf"] == 0


def test_marks_are_split_off_words(spark):
    values = ["a, (b) c! !! x .", "word.", "(x", "--a--", "", "a.\nb,"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string").orderBy("i")
    assert [r[0].split() for r in df.select(chrf_words(F.col("t"))).collect()] == [split_marks(v) for v in values]


def test_missing_texts_score_zero(spark):
    df = spark.createDataFrame([("a", None), (None, "a")], "h string, r string")
    rows = add_metrics(df, {"bleu": SentenceBleu(), "edit": EditSimilarity()}, "r", "h", "r").collect()
    assert [(r["bleu"], r["edit"]) for r in rows] == [(0.0, 0.0), (0.0, 0.0)]


def test_corpus_of_identical_rows_is_perfect(spark):
    df = spark.createDataFrame([("Hello, big world. It is 3.5 m.",) * 2] * 3, "h string, r string")
    row = corpus_scores(df, "h", "r").first()
    assert row["bleu"] == pytest.approx(100) and row["chrf"] == pytest.approx(100) and row["bp"] == 1
    assert row["sys_len"] == row["ref_len"] == 3 * 10  # Hello , big world . It is 3.5 m .


def test_corpus_score_is_the_same_for_any_partitioning(spark):
    df = table(spark, random_pairs(60))
    scores = [corpus_scores(df.repartition(n), "h", "r").first() for n in (1, 4, 16)]
    assert scores[0] == scores[1] == scores[2]


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_failing_scorers_give_zero_and_skip_masked_rows(spark):
    from lexiloom.functions.metrics import ExternalScorer

    def make():
        def score(source, hypothesis, reference):
            assert hypothesis.notna().all() and reference.notna().all()
            if (hypothesis == "boom").any():
                raise RuntimeError("no model")
            return hypothesis.str.len()

        return score

    for hypothesis, expected in (("abc", 3.0), ("boom", 0.0)):
        df = spark.createDataFrame([("s", hypothesis, "r"), ("s", None, "r"), ("s", "h", None)], "s string, h string, r string")
        done = add_metrics(df.coalesce(1), {"q": ExternalScorer("q", make)}, "s", "h", "r")
        assert sorted(r["q"] for r in done.collect()) == [0.0, 0.0, expected]


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="abé😀 ", max_size=150), st.text(alphabet="abé😀 ", max_size=150))
def test_edit_distance_equals_the_table(a, b):
    assert edits.levenshtein(a, b) == levenshtein(a, b)


def test_edit_distance_of_very_long_texts_takes_seconds():
    import time

    rng = random.Random(6)
    a = "".join(rng.choices("abcdefgh ", k=100_000))
    b = a[:50_000] + "x" + a[50_001:99_000]
    start = time.time()
    assert edits.levenshtein("q" + a + "p", "r" + b + "s") == 1003
    assert time.time() - start < 60


def test_edit_distance_of_nulls(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), (None, None), ("a", "a")], "a string, b string")
    assert [r[0] for r in df.select(edit_distance(F.col("a"), F.col("b"))).collect()] == [None, None, None, 0]


def test_edit_distance_of_long_texts(spark):
    rng = random.Random(5)
    a = "".join(rng.choice("abcdé ") for _ in range(1500))
    b = "".join(c for c in a if rng.random() > 0.1)
    df = spark.createDataFrame([(a, b), ("kitten", "sitting"), ("", ""), ("é", "e")], "a string, b string")
    rows = [r[0] for r in df.select(edit_distance(F.col("a"), F.col("b"))).collect()]
    assert rows == [levenshtein(a, b), 3, 0, 1]
