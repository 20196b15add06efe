"""Operators on small hand-made tables: ties, nulls, hot keys, resume, partition independence."""

import pytest

from pyspark.sql import functions as F

from lexiloom.operators import aggregates, combine, joins, language_id, ordering, selection
from lexiloom.operators.skew import salted_join, with_positions
from lexiloom.queries.base import attempts, sentences


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_best_of_attempts_ties_and_nulls(spark):
    df = spark.createDataFrame(
        [(1, 0, None), (1, 1, 0.5), (1, 2, 0.5), (2, 0, None), (2, 1, None), (3, 0, -0.5), (3, 1, None)],
        "s int, attempt int, comet_score double",
    )
    best = selection.best_of_attempts(df, ["s"]).select("s", "attempt", "comet_score")
    assert rows(best, "s") == [(1, 1, 0.5), (2, 0, None), (3, 0, -0.5)]


@pytest.mark.parametrize("text", [False, True])
def test_selection_of_numbers_and_of_texts_agree_with_a_sort(spark, text):
    import random

    r = random.Random(3)
    scores = [None, -0.0, 0.0, 1e-300, 2e-300, -5.5, -1.0, 49.999, 50.0, 94.99999999999999, 95.0, 95.00000000000001, 100.0]
    data = [(k, a, r.choice(scores), a / 10) for k in range(200) for a in range(r.randrange(1, 12))]
    r.shuffle(data)
    df = spark.createDataFrame(data, "k int, attempt int, score double, temperature double").repartition(5)
    df = df.withColumn("note", F.lit("x")) if text else df
    best, early = selection.best_of_attempts(df, ["k"], "score"), selection.early_stop_select(df, ["k"])
    by_key = {k: sorted(x[1:] for x in data if x[0] == k) for k in {x[0] for x in data}}
    top = {k: max(v, key=lambda x: (-1.0 if x[1] is None else x[1], -x[0])) for k, v in by_key.items()}
    assert {x["k"]: (x["attempt"], x["score"], x["temperature"]) for x in best.collect()} == top
    want = {}
    for k, v in by_key.items():
        stop = next((x for x in v if x[1] is not None and x[1] >= 95), None)
        good = max((x for x in v if (x[1] or 0) > 0), key=lambda x: (x[1], -x[0]), default=None)
        good = good if good is not None and good[1] >= 50 else None
        chosen = stop or good or (None, None, None)
        want[k] = (*chosen, "accepted_early_stop" if stop else "accepted" if good else "discarded")
    assert {x["k"]: (x["attempt"], x["score"], x["temperature"], x["status"]) for x in early.collect()} == want
    first = selection.first_match(df.withColumn("big", F.col("k").cast("long") % 7), ["k"], ["big", "attempt"])
    assert {x["k"]: x["attempt"] for x in first.collect()} == {k: v[0][0] for k, v in by_key.items()}


def test_early_stop_select(spark):
    data = [(1, 0, 40.0), (1, 1, 95.0), (1, 2, 99.0), (2, 0, 60.0), (2, 1, 60.0), (3, 0, 49.9), (4, 0, None), (5, 0, 50.0)]
    df = spark.createDataFrame(data, "s int, attempt int, score double")
    picked = selection.early_stop_select(df, ["s"]).select("s", "attempt", "status")
    assert rows(picked, "s") == [
        (1, 1, "accepted_early_stop"),
        (2, 0, "accepted"),
        (3, None, "discarded"),
        (4, None, "discarded"),
        (5, 0, "accepted"),
    ]


def test_selection_does_not_depend_on_partitions(spark, small):
    base = attempts(spark, small)
    results = [
        sorted(map(str, selection.early_stop_select(base.repartition(n), ["doc_id", "sentence_index"]).collect()))
        for n in (1, 4, 16)
    ]
    assert results[0] == results[1] == results[2]


def test_positions_are_dense_and_ordered_with_a_hot_key(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id") % 5).alias("k"))
    numbered = with_positions(df.repartition(9), [F.col("k"), F.col("id")], "pos").collect()
    expected = sorted((r["k"], r["id"]) for r in numbered)
    assert [(r["k"], r["id"]) for r in sorted(numbered, key=lambda r: r["pos"])] == expected
    assert sorted(r["pos"] for r in numbered) == list(range(3000))


def test_salted_join_keeps_every_row(spark):
    df = spark.range(2000).select("id", F.when(F.col("id") < 1500, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    keys = spark.createDataFrame([("hot", 1), ("1600", 2)], "k string, v int")
    assert salted_join(df, keys, ["k"], ["id"]).count() == 1501
    assert salted_join(df, keys, ["k"], ["id"], "left").count() == 2000
    assert salted_join(df, keys, ["k"], ["id"], "left_semi").count() == 1501
    assert salted_join(df, keys, ["k"], ["id"], "left_anti").count() == 499
    with pytest.raises(ValueError):
        salted_join(df, keys, ["k"], ["id"], "full")


def test_only_hot_keys_are_split(spark):
    """70 % of the rows on one key: no task holds much more than its share, no cold key is repeated."""
    from lexiloom.operators.skew import hot_keys, sized_keys

    n, parts = 40_000, int(spark.conf.get("spark.sql.shuffle.partitions"))
    df = spark.range(n).select("id", F.when(F.col("id") % 10 < 7, -1).otherwise(F.col("id") % 5000).cast("int").alias("k"))
    keys = df.groupBy("k").agg(F.count("*").alias("_rows"), F.lit("x" * 50).alias("name")).select(F.col("k").cast("long"), "_rows", "name")
    hot = hot_keys(df, ["k"])
    assert [(h, p) for h, p in hot] == sized_keys(keys.select(F.col("k").cast("int"), "_rows"), ["k"], "_rows") and len(hot) == 1
    assert hot[0][1] >= 0.7 * 2 * parts
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        for size in (None, "_rows"):
            joined = salted_join(df, keys, ["k"], ["id"], size=size)
            sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
            assert sum(sizes) == n and max(sizes) < 3 * n / parts
            plain = df.join(keys, "k").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
            assert plain > 0.7 * n
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert hot_keys(df.limit(0), ["k"]) == []
    cold = df.select(F.col("id").alias("k"), "id")
    assert hot_keys(cold, ["k"]) == []


def test_file_gate_is_strict(spark):
    data = [("a", 1, 0.5), ("a", 2, 0.5), ("b", 3, 0.9), ("b", 4, 0.3), ("c", 5, None)]
    df = spark.createDataFrame(data, "source_file string, id int, comet_score double")
    assert rows(selection.file_gate(df, 0.5, ["id"]).select("id"), "id") == [(3,)]


def test_histogram_bounds(spark):
    values = [-0.1, 0.0, 0.2, 0.4, 0.6, 0.6000001, 0.8, 1.0, 1.1, None]
    df = spark.createDataFrame([(v,) for v in values], "comet_score double")
    counts = {r["bucket"]: r["scores"] for r in aggregates.score_histogram(df).collect()}
    assert counts == {"0.0-0.2": 1, "0.2-0.4": 1, "0.4-0.6": 1, "0.6-0.8": 2, "0.8-1.0": 2}


def test_sentence_map_last_duplicate_wins(spark):
    texts = spark.createDataFrame([(1, 0, "x"), (1, 1, "y"), (1, 2, "x"), (2, 0, "x")], "doc_id int, sentence_index int, sentence string")
    done = spark.createDataFrame(
        [(1, 0, "x", "first"), (1, 2, "x", "last")], "doc_id int, sentence_index int, sentence string, translation string"
    )
    mapped = joins.map_sentences(texts, done).select("doc_id", "sentence_index", "translation")
    assert rows(mapped, "doc_id", "sentence_index") == [
        (1, 0, "last"),
        (1, 1, "[UNTRANSLATED: y]"),
        (1, 2, "last"),
        (2, 0, "[UNTRANSLATED: x]"),
    ]


def test_opposite_translation_takes_the_first(spark):
    data = [
        (1, "en->rw", "a", "b", "t1"),
        (2, "rw->en", "b", "a", "t2"),
        (3, "rw->en", "b", "a", "t3"),
        (4, "en->rw", "z", "nobody", "t4"),
    ]
    df = spark.createDataFrame(data, "id int, direction string, source string, target string, translation string")
    found = joins.opposite_translation(df, "id").select("id", "opposite_translation")
    assert rows(found, "id") == [(1, "t2"), (2, "t1"), (3, "t1"), (4, None)]


def test_leftover_seeds(spark):
    seeds = spark.createDataFrame([(1,), (2,), (3,)], "doc_id long")
    results = spark.createDataFrame([(1, 0.9), (1, 0.1), (2, 0.5), (2, None)], "doc_id long, comet_score double")
    assert rows(joins.leftover_seeds(seeds, results, 0.6), "doc_id") == [(2,), (3,)]


def test_sample_and_split(spark):
    df = spark.range(1000)
    first = rows(ordering.sample_n(df.repartition(3), 50, ["id"]), "id")
    assert first == rows(ordering.sample_n(df.repartition(11), 50, ["id"]), "id") and len(first) == 50
    assert ordering.sample_n(df, 5000, ["id"]).count() == 1000
    shares = ordering.split_train_dev(df, ["id"], 0.1).groupBy("split").count().collect()
    counts = {r["split"]: r["count"] for r in shares}
    assert sum(counts.values()) == 1000 and 60 < counts["dev"] < 140
    assert ordering.split_train_dev(df, ["id"], 0.0).filter("split = 'dev'").isEmpty()


def test_first_n_follows_the_order(spark):
    df = spark.range(500).repartition(7)
    assert rows(ordering.first_n(df, 40, [F.col("id").desc()]), "id") == [(i,) for i in range(460, 500)]


def test_directions_and_alignment(spark):
    df = spark.createDataFrame([(1, "hello", "muraho")], "id int, en string, rw string")
    assert rows(combine.expand_directions(df, "en", "rw", ("en", "rw")), "direction") == [
        (1, "en->rw", "hello", "muraho"),
        (1, "rw->en", "muraho", "hello"),
    ]
    mixed = spark.createDataFrame(
        [("o1", "f1", 0.9, 1.0, "english", "kinyarwanda"), ("o2", "f2", 0.8, 1.0, "kinyarwanda", "english")],
        "original_sentence string, forward_translation string, comet_score double, temperature double, src_lang string, tgt_lang string",
    )
    aligned = combine.align_languages(mixed, ["english", "kinyarwanda"]).select("english", "kinyarwanda")
    assert sorted(rows(aligned)) == [("f2", "o2"), ("o1", "f1")]


def test_length_batches_with_one_dominant_language(spark):
    df = spark.range(900).select(
        F.col("id"), F.when(F.col("id") % 10 < 7, "en").otherwise("fr").alias("language"), (F.col("id") * 7 % 50).alias("n")
    )
    batched = selection.length_batches(df, 32, F.col("n"), "id").collect()
    for language in ("en", "fr"):
        group = sorted((r["n"], r["id"], r["batch_id"]) for r in batched if r["language"] == language)
        assert [g[2] for g in group] == [i // 32 for i in range(len(group))]


def brute_language(trained, texts):
    """The definition in plain Python: buckets by digest, whole-number logarithms."""
    import math
    import re
    from collections import Counter
    from hashlib import md5

    def buckets(text):
        for word in re.sub(r"[^\w]|[\d_]", " ", text.lower()).split():
            padded = f" {word} "
            for n in (1, 2, 3):
                for i in range(len(padded) - n + 1):
                    yield int(md5(padded[i : i + n].encode()).hexdigest()[:4], 16)

    counts, docs = {}, Counter()
    for text, language in trained:
        counts.setdefault(language, Counter()).update(buckets(text))
        docs[language] += 1
    distinct = len({b for c in counts.values() for b in c})
    out = []
    for text in texts:
        found = list(buckets(text or ""))
        score = {
            language: round(math.log(docs[language] / sum(docs.values())) * 65536)
            + sum(round(math.log((c[b] + 1) / (c.total() + distinct)) * 65536) for b in found)
            for language, c in counts.items()
        }
        out.append(min(score, key=lambda x: (-score[x], x)))
    return out


def test_language_id_equals_its_definition_in_any_split(spark, small):
    pool = [(r["text"][:400], r["lang"]) for r in spark.read.parquet(f"{small}/documents.parquet").orderBy("doc_id").take(90)]
    trained, texts = pool[:60], [t for t, _ in pool[60:]] + ["", "123 !?", None, "É", "the the"]
    docs = spark.createDataFrame(trained, "text string, lang string")
    rows_ = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    want = brute_language(trained, texts)
    for parts in (1, 7):
        model = language_id.train(docs.repartition(parts), "text", "lang")
        found = rows(language_id.identify(rows_.repartition(parts), model).select("id", "detected"), "id")
        assert [r[1] for r in found] == want


def test_held_out_texts_are_identified(spark):
    from lexiloom.queries import queries

    found = queries()["lang_id"](spark, "/root/testdata/sf0.01").filter("held_out")
    total, right = found.selectExpr("count(*)", "count_if(expected)").first()
    assert total > 150 and right > 0.95 * total


def test_language_gate_ignores_case(spark):
    docs = spark.createDataFrame([("the cat and the dog", "English"), ("umwana n'umugabo", "Kinyarwanda")], "text string, language string")
    table = language_id.bucket_table(language_id.train(docs))
    import pandas as pd

    texts = pd.Series(["the dog", "umugabo"])
    assert list(language_id.language_gate(table, "KINYARWANDA")(texts)) == [False, True]


def test_word_failures(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", ""), ("b", "z"), ("c", None)], "word string, error string")
    assert rows(aggregates.word_failures(df, 2), "word") == [("a", 2, True), ("b", 1, False)]


def test_summary_tells_all_rows_from_rows_without_direction(spark):
    df = spark.createDataFrame([("en->fr", 1.0), (None, 3.0)], "direction string, bleu double")
    found = rows(aggregates.metric_summary(df, ["bleu"]).select("direction", "overall", "mean"), "overall", "direction")
    assert found == [(None, False, 3.0), ("en->fr", False, 1.0), (None, True, 2.0)]
