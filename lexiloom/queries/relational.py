"""Filters, joins, aggregates, selections, orders, unions and generators."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexiloom.functions.text import word_count
from lexiloom.operators import aggregates, combine, filters, joins, ordering, selection, vocabulary
from lexiloom.queries.standins import CODED, PLAIN
from lexiloom.queries.base import (
    ATTEMPTS,
    DIRECTED,
    GRID,
    INPUT,
    PAIR,
    PAIRS,
    SCORED,
    SENTENCES,
    attempts,
    directed,
    documents,
    input_text,
    pairs,
    query,
    rounded,
    scored,
    sentences,
    words_sql,
)
from lexiloom.session import scratch_path
from lexiloom.sources import readers, writers

T = 0.5


def ids(df):
    return df.select("doc_id", "sentence_index", "comet_score")


# --- filters ------------------------------------------------------------------------------------


@query("filter_threshold", f"WITH {SCORED} SELECT doc_id, sentence_index, comet_score FROM scored WHERE comet_score >= 0.8")
def filter_threshold(spark, sf_dir):
    return ids(filters.filter_threshold(scored(spark, sf_dir), 0.8))


@query(
    "filter_known_language",
    f"WITH {INPUT} SELECT language, count(*) AS rows FROM input WHERE lower(language) NOT IN ('en','fr') OR language IS NULL GROUP BY 1"
    f" UNION ALL SELECT 'kept '||language, count(*) FROM input WHERE lower(language) IN ('en','fr') GROUP BY 1",
)
def filter_known_language(spark, sf_dir):
    """Kept rows per language next to the report of dropped languages."""
    rows = input_text(spark, sf_dir).withColumn("language", F.upper("language"))
    kept = filters.filter_known_language(rows, PAIR).withColumn("language", F.concat(F.lit("kept "), F.lower("language")))
    dropped = filters.unknown_languages(rows, PAIR).withColumn("language", F.lower("language"))
    return dropped.unionByName(kept.groupBy("language").agg(F.count("*").alias("rows")))


def _translated(spark, sf_dir):
    """Translated table of all documents: some rows empty, some null, some of white space only."""
    kind = F.substring(F.md5(F.col("_original_index").cast("string")), 1, 1)
    value = (
        F.when(kind.isin("0", "1"), F.lit(""))
        .when(kind.isin("2", "3"), F.lit(None).cast("string"))
        .when(kind == "4", F.lit(" \n "))
        .otherwise(F.translate("text", PLAIN, CODED))
    )
    return input_text(spark, sf_dir).withColumn("translation_text", value)


TRANSLATED = f"""{INPUT},
kinds AS (SELECT *, substr(md5(_original_index::VARCHAR),1,1) AS k FROM input),
translated AS (SELECT *, CASE WHEN k IN ('0','1') THEN '' WHEN k IN ('2','3') THEN NULL
  WHEN k = '4' THEN ' '||chr(10)||' ' ELSE translate(text, '{PLAIN}', '{CODED}') END AS translation_text FROM kinds)"""


def _saved_table(spark, sf_dir):
    """What an earlier run saved: some documents are not in it."""
    kind = F.substring(F.md5(F.col("_original_index").cast("string")), 1, 1)
    return _translated(spark, sf_dir).filter(~kind.isin("c", "d", "e", "f"))


SAVED = f"{TRANSLATED}, saved AS (SELECT * FROM translated WHERE k NOT IN ('c','d','e','f'))"


@query(
    "filter_completed",
    f"WITH {TRANSLATED} SELECT _original_index, translation_text FROM translated WHERE translation_text IS NOT NULL AND translation_text <> ''",
)
def filter_completed(spark, sf_dir):
    return filters.filter_completed(_translated(spark, sf_dir)).select("_original_index", "translation_text")


@query(
    "drop_null_rows",
    f"WITH {SCORED} SELECT doc_id, sentence_index, comet_score FROM scored WHERE comet_score IS NOT NULL",
)
def drop_null_rows(spark, sf_dir):
    return ids(filters.drop_null_rows(scored(spark, sf_dir)))


@query(
    "drop_blank_text",
    f"WITH {TRANSLATED} SELECT _original_index FROM translated WHERE trim(translation_text, ' '||chr(10)) <> ''",
)
def drop_blank_text(spark, sf_dir):
    return filters.drop_blank_text(_translated(spark, sf_dir), "translation_text").select("_original_index")


STOP_WORDS = ["the", "of", "and", "la", "le", "de", "der", "die", "und"]
VOCABULARY = rf"""tokens AS (SELECT unnest({words_sql("regexp_replace(lower(text), '[[:punct:]]', '', 'g')")}) AS word FROM documents),
counts AS (SELECT word, count(*) AS n FROM tokens GROUP BY 1),
vocabulary AS (SELECT word, n, log10(n::DOUBLE / (SELECT sum(n) FROM counts)::BIGINT * 1e9::DOUBLE) AS commonality FROM counts)"""
STOP_SQL = ", ".join(f"'{w}'" for w in STOP_WORDS)


@query("vocabulary_zipf", f"WITH {VOCABULARY} SELECT word, n, round(commonality, 6) AS commonality FROM vocabulary")
def vocabulary_zipf(spark, sf_dir):
    return rounded(vocabulary.zipf_vocabulary(documents(spark, sf_dir)), "commonality")


def _band(spark, sf_dir):
    return filters.filter_vocabulary(vocabulary.zipf_vocabulary(documents(spark, sf_dir)), STOP_WORDS, 4.0, 6.0)


BAND = rf"""{VOCABULARY}, band AS (SELECT * FROM vocabulary WHERE regexp_matches(word, '^\pL+$') AND commonality > 4
  AND commonality < 6 AND word NOT IN ({STOP_SQL}))"""


@query("filter_vocabulary", f"WITH {BAND} SELECT word, round(commonality, 6) AS commonality FROM band")
def filter_vocabulary(spark, sf_dir):
    return rounded(_band(spark, sf_dir).select("word", "commonality"), "commonality")


@query(
    "order_vocabulary",
    f"WITH {BAND} SELECT word, round(commonality, 6) AS commonality FROM band ORDER BY commonality, word",
)
def order_vocabulary(spark, sf_dir):
    return rounded(ordering.order_vocabulary(_band(spark, sf_dir)).select("word", "commonality"), "commonality")


@query(
    "dedup_words",
    rf"""WITH w AS (SELECT unnest({words_sql("regexp_replace(lower(text), '[[:punct:]]', '', 'g')")}) AS word, lang FROM documents),
    c AS (SELECT lang, word, count(*) AS n FROM w GROUP BY ALL)
    SELECT word, min(n)::DOUBLE AS commonality, arg_min(lang, (n, lang)) AS lang FROM c GROUP BY 1""",
)
def dedup_words(spark, sf_dir):
    counts = vocabulary.word_counts(documents(spark, sf_dir), by=["lang"])
    return combine.dedup_words(counts.select("word", F.col("n").cast("double").alias("commonality"), "lang"))


@query(
    "drop_failed",
    f"WITH {TRANSLATED} SELECT _original_index FROM translated WHERE translation_text IS NOT NULL",
)
def drop_failed(spark, sf_dir):
    return filters.drop_failed(_translated(spark, sf_dir), "translation_text").select("_original_index")


# Sources whose files have no score column at all; those of src7 have one without a value.
BARE_SOURCES = ("src3", "src11")


def _mixed_folder(spark, sf_dir) -> str:
    """Result files of three layouts: all columns, other order of columns, no score column."""
    path = scratch_path(spark, "mixed")
    rows = scored(spark, sf_dir).withColumn("source", F.replace("source_file", F.lit(".tsv"), F.lit("")))
    columns = ["sentence_index", "original_sentence", "comet_score"]
    layouts = {
        "bare": (rows.filter(F.col("source").isin(*BARE_SOURCES)), columns[:2]),
        "turned": (rows.filter(F.col("source").isin("src1", "src7")), columns[::-1]),
        "whole": (rows.filter(~F.col("source").isin("src1", "src7", *BARE_SOURCES)), columns),
    }
    for name, (part, names) in layouts.items():
        out = part.select("source", *names).hint("rebalance", "source").write.options(**writers.CSV_OPTIONS)
        out.option("sep", "\t").option("compression", "none").partitionBy("source").csv(f"{path}/{name}")
    return path


@query(
    "skip_without_column",
    f"""WITH {SCORED} SELECT source_file AS file, CASE WHEN source_file IN ('src3.tsv','src11.tsv') THEN 'no column comet_score' ELSE 'no score' END AS reason
    FROM scored GROUP BY 1 HAVING count(comet_score) = 0 OR source_file IN ('src3.tsv','src11.tsv')""",
)
def skip_without_column(spark, sf_dir):
    """Files without the score column next to files whose column is empty, from one scan of all layouts."""
    path = _mixed_folder(spark, sf_dir)
    rows, _, skipped = readers.scan_mixed_results(spark, path, pattern="*.csv")
    # Spark names part files itself: the file is the folder that the part lies in.
    named = lambda path: F.concat(F.regexp_extract(path, "source=([^/]+)/", 1), F.lit(".tsv"))
    without = skipped.select(named("path").alias("file"), "reason").distinct()
    empty = aggregates.files_without_scores(rows.withColumn("source_file", named("source_path")))
    return without.unionByName(empty.select("file", F.lit("no score").alias("reason")))


# --- joins --------------------------------------------------------------------------------------


@query(
    "resume_anti_join",
    f"""WITH {SAVED} SELECT 'retry' AS policy, _original_index FROM input WHERE _original_index NOT IN
      (SELECT _original_index FROM saved WHERE translation_text <> '')
    UNION ALL SELECT 'saved', _original_index FROM input WHERE _original_index NOT IN (SELECT _original_index FROM saved)""",
)
def resume_anti_join(spark, sf_dir):
    rows, saved = input_text(spark, sf_dir).select("_original_index"), _saved_table(spark, sf_dir)
    retry = joins.pending_rows(rows, saved, retry_failed=True).withColumn("policy", F.lit("retry"))
    skip = joins.pending_rows(rows, saved, retry_failed=False).withColumn("policy", F.lit("saved"))
    return retry.unionByName(skip)


@query(
    "resume_documents",
    f"""WITH {SAVED} SELECT _original_index AS doc_id, CASE WHEN _original_index IN
      (SELECT _original_index FROM saved WHERE translation_text IS NOT NULL) THEN 'there' ELSE 'todo' END AS state FROM input""",
)
def resume_documents(spark, sf_dir):
    """Saved rows as files; those of the documents that have to be done again were cut off half-way."""
    path = scratch_path(spark, "saved_documents")
    saved = _saved_table(spark, sf_dir).select(F.col("_original_index").alias("row_id"), "text", "translation_text")
    line = F.to_json(F.struct("row_id", F.col("text").alias("original_text"), F.col("text").alias("reconstructed_text")))
    cut = F.when(F.col("translation_text").isNull(), F.expr("left(line, length(line) div 2)")).otherwise(F.col("line"))
    saved.withColumn("line", line).select(cut.alias("value")).write.text(path)
    found = readers.scan_row_json(spark, path, "part-*", multi_line=False).withColumnRenamed("row_id", "doc_id")
    todo, there = joins.resume_documents(documents(spark, sf_dir).select("doc_id"), found)
    there = there.select("doc_id", F.lit("there").alias("state"))
    return todo.withColumn("state", F.lit("todo")).unionByName(there)


@query(
    "seed_anti_join",
    f"WITH {SCORED} SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM scored WHERE comet_score >= 0.95)",
)
def seed_anti_join(spark, sf_dir):
    return joins.leftover_seeds(documents(spark, sf_dir).select("doc_id"), scored(spark, sf_dir), 0.95)


@query(
    "opposite_direction_lookup",
    f"""WITH {DIRECTED}, first_rows AS (SELECT direction, source, arg_min(translation, pair_id) AS t FROM directed GROUP BY ALL)
    SELECT d.pair_id, d.direction, f.t AS opposite_translation FROM directed d LEFT JOIN first_rows f
    ON f.direction = CASE d.direction WHEN 'en->fr' THEN 'fr->en' ELSE 'en->fr' END AND f.source = d.target""",
)
def opposite_direction_lookup(spark, sf_dir):
    found = joins.opposite_translation(directed(spark, sf_dir), "pair_id")
    return found.select("pair_id", "direction", "opposite_translation")


def _sentence_translations(spark, sf_dir):
    """Translations of most sentences; repeated sentences differ by their place."""
    rows = sentences(spark, sf_dir).select("doc_id", "sentence_index", "sentence")
    place = F.concat("sentence", F.lit(" #"), F.col("sentence_index").cast("string"))
    return rows.filter(~F.md5("sentence").startswith("0")).withColumn("translation", place)


@query(
    "sentence_map_join",
    f"""WITH {SENTENCES}, m AS (SELECT doc_id, sentence, arg_max(sentence||' #'||sentence_index, sentence_index) AS t
      FROM sentences WHERE md5(sentence) NOT LIKE '0%' GROUP BY ALL)
    SELECT s.doc_id, s.sentence_index, coalesce(m.t, '[UNTRANSLATED: '||s.sentence||']') AS translation
    FROM sentences s LEFT JOIN m USING (doc_id, sentence)""",
)
def sentence_map_join(spark, sf_dir):
    rows = sentences(spark, sf_dir).select("doc_id", "sentence_index", "sentence")
    mapped = joins.map_sentences(rows, _sentence_translations(spark, sf_dir))
    return mapped.select("doc_id", "sentence_index", "translation")


@query(
    "attach_results",
    f"WITH {SAVED} SELECT i._original_index, i.language, t.translation_text FROM input i LEFT JOIN saved t USING (_original_index)",
)
def attach_results(spark, sf_dir):
    results = _saved_table(spark, sf_dir).select("_original_index", "translation_text")
    return joins.attach_results(input_text(spark, sf_dir).select("_original_index", "language"), results)


@query(
    "member_semi_join",
    f"WITH {SCORED} SELECT doc_id, sentence_index, comet_score FROM scored WHERE source_file IN (SELECT source_file FROM scored GROUP BY 1 HAVING max(comet_score) > 1.049)",
)
def member_semi_join(spark, sf_dir):
    rows = scored(spark, sf_dir)
    files = rows.groupBy("source_file").agg(F.max("comet_score").alias("m")).filter(F.col("m") > 1.049)
    return ids(joins.member_rows(rows, files, "source_file", ["doc_id", "sentence_index"]))


# --- aggregates ---------------------------------------------------------------------------------


@query(
    "per_file_score_stats",
    f"""WITH {SCORED} SELECT source_file AS file, round(avg(comet_score),6) AS average_score, count(comet_score) AS num_scores,
    min(comet_score) AS min_score, max(comet_score) AS max_score FROM scored GROUP BY 1 HAVING count(comet_score) > 0""",
)
def per_file_score_stats(spark, sf_dir):
    return rounded(aggregates.file_score_stats(scored(spark, sf_dir)), "average_score")


@query(
    "overall_score_stats",
    f"""WITH {SCORED}, s AS (SELECT * FROM scored WHERE comet_score IS NOT NULL)
    SELECT round(avg(comet_score),6) AS overall_average, min(comet_score) AS overall_min, max(comet_score) AS overall_max,
    round(stddev_samp(comet_score),6) AS std_dev, count(*) AS total_scores, count(DISTINCT source_file) AS files_processed,
    count(*) FILTER (comet_score >= {T}) AS scores_above_threshold, count(*) FILTER (comet_score < {T}) AS scores_below_threshold,
    round(count(*) FILTER (comet_score >= {T}) * 100.0::DOUBLE / count(*), 6) AS above_pct,
    round(count(*) FILTER (comet_score < {T}) * 100.0::DOUBLE / count(*), 6) AS below_pct FROM s""",
)
def overall_score_stats(spark, sf_dir):
    stats = aggregates.overall_score_stats(scored(spark, sf_dir), T)
    return rounded(stats, "overall_average", "std_dev", "above_pct", "below_pct")


@query(
    "score_histogram",
    f"""WITH {SCORED}, b(bucket, lo, hi) AS (VALUES ('0.0-0.2', 0.0::DOUBLE, 0.2::DOUBLE), ('0.2-0.4', 0.2::DOUBLE, 0.4::DOUBLE),
      ('0.4-0.6', 0.4::DOUBLE, 0.6::DOUBLE), ('0.6-0.8', 0.6::DOUBLE, 0.8::DOUBLE), ('0.8-1.0', 0.8::DOUBLE, 1.0::DOUBLE)),
    t AS (SELECT count(comet_score) AS n FROM scored)
    SELECT b.bucket, count(s.comet_score) AS scores, round(count(s.comet_score)*100.0::DOUBLE/any_value(t.n), 6) AS pct
    FROM b CROSS JOIN t LEFT JOIN scored s ON s.comet_score >= b.lo AND (s.comet_score < b.hi OR (b.hi = 1 AND s.comet_score = 1))
    GROUP BY b.bucket""",
)
def score_histogram(spark, sf_dir):
    return rounded(aggregates.score_histogram(scored(spark, sf_dir)), "pct")


@query(
    "threshold_summary",
    f"""WITH {SCORED}, t AS (SELECT count(*) AS n, count(*) FILTER (comet_score >= 0.8) AS a FROM scored)
    SELECT n AS total_rows, a AS rows_above, n-a AS rows_below, round(a*100.0::DOUBLE/n,6) AS pct_above,
    round((n-a)*100.0::DOUBLE/n,6) AS pct_below FROM t""",
)
def threshold_summary(spark, sf_dir):
    return rounded(aggregates.threshold_summary(scored(spark, sf_dir), 0.8), "pct_above", "pct_below")


SAMPLE = f"""{SCORED}, pool AS (SELECT * FROM scored WHERE comet_score >= {T}),
sample AS (SELECT * FROM pool ORDER BY md5('42|'||doc_id||'|'||sentence_index), doc_id, sentence_index LIMIT 500)"""


def _sample(spark, sf_dir):
    pool = filters.filter_threshold(scored(spark, sf_dir), T)
    return ordering.sample_n(pool, 500, ["doc_id", "sentence_index"])


@query("sample_n", f"WITH {SAMPLE} SELECT doc_id, sentence_index, comet_score FROM sample")
def sample_n(spark, sf_dir):
    return ids(_sample(spark, sf_dir))


@query(
    "sample_stats",
    f"WITH {SAMPLE} SELECT round(avg(comet_score),6) AS mean, min(comet_score) AS min, max(comet_score) AS max, round(median(comet_score),6) AS median FROM sample",
)
def sample_stats(spark, sf_dir):
    return rounded(aggregates.sample_stats(_sample(spark, sf_dir)), "mean", "median")


def _measured(spark, sf_dir):
    """Directed pairs with two plain numbers in the place of metric scores."""
    return directed(spark, sf_dir).withColumns(
        {
            "bleu": F.char_length("translation").cast("double"),
            "chrf": word_count(F.col("target")).cast("double"),
        }
    )


MEASURED = f"{DIRECTED}, measured AS (SELECT *, length(translation)::DOUBLE AS bleu, len({words_sql('target')})::DOUBLE AS chrf FROM directed)"


@query(
    "metric_summary",
    f"""WITH {MEASURED}, m AS (SELECT direction, 'bleu' AS metric, bleu AS v FROM measured UNION ALL SELECT direction, 'chrf', chrf FROM measured)
    SELECT direction, grouping(direction) = 1 AS overall, metric, round(avg(v),6) AS mean, round(stddev_samp(v),6) AS std, min(v) AS min, max(v) AS max
    FROM m GROUP BY GROUPING SETS ((direction, metric), (metric))""",
)
def metric_summary(spark, sf_dir):
    return rounded(aggregates.metric_summary(_measured(spark, sf_dir), ["bleu", "chrf"]), "mean", "std")


@query(
    "direction_summary",
    f"""WITH {MEASURED} SELECT direction, count(*) AS examples, round(avg(bleu),6) AS bleu_mean, round(stddev_samp(bleu),6) AS bleu_std,
    round(avg(chrf),6) AS chrf_mean, round(stddev_samp(chrf),6) AS chrf_std FROM measured GROUP BY 1""",
)
def direction_summary(spark, sf_dir):
    summary = aggregates.direction_summary(_measured(spark, sf_dir), ["bleu", "chrf"])
    return rounded(summary, "bleu_mean", "bleu_std", "chrf_mean", "chrf_std")


@query(
    "error_rate",
    f"""WITH {DIRECTED}, e AS (SELECT count(*) AS n, count(*) FILTER (translation LIKE '[ERROR%') AS k FROM directed)
    SELECT n AS num_samples, k AS num_errors, round(k/n, 6) AS error_rate FROM e""",
)
def error_rate(spark, sf_dir):
    return rounded(aggregates.error_rate(directed(spark, sf_dir)), "error_rate")


@query(
    "corpus_length_stats",
    rf"""WITH m AS (SELECT len({words_sql('text')}) AS w, len(regexp_extract_all(text, '.+?[.!?]+')) AS s FROM documents)
    SELECT round(avg(w),6) AS mean_words, min(w)::INT AS min_words, max(w)::INT AS max_words,
    round(avg(s),6) AS mean_sentences, min(s)::INT AS min_sentences, max(s)::INT AS max_sentences FROM m""",
)
def corpus_length_stats(spark, sf_dir):
    return rounded(aggregates.corpus_length_stats(documents(spark, sf_dir)), "mean_words", "mean_sentences")


SELECTED = f"""{ATTEMPTS},
early AS (SELECT doc_id, sentence_index, min(attempt) AS a FROM attempts WHERE score >= 95 GROUP BY ALL),
top AS (SELECT doc_id, sentence_index, attempt AS a, score FROM attempts WHERE score > 0
  QUALIFY row_number() OVER (PARTITION BY doc_id, sentence_index ORDER BY score DESC, attempt) = 1),
choice AS (SELECT s.doc_id, s.sentence_index, coalesce(e.a, CASE WHEN t.score >= 50 THEN t.a END) AS attempt,
  CASE WHEN e.a IS NOT NULL THEN 'accepted_early_stop' WHEN t.score >= 50 THEN 'accepted' ELSE 'discarded' END AS status
  FROM sentences s LEFT JOIN early e USING (doc_id, sentence_index) LEFT JOIN top t USING (doc_id, sentence_index)),
selected AS (SELECT c.doc_id, c.sentence_index, c.attempt, a.temperature, a.score, c.status FROM choice c
  LEFT JOIN attempts a USING (doc_id, sentence_index, attempt))"""


def _selected(spark, sf_dir):
    return selection.early_stop_select(attempts(spark, sf_dir), ["doc_id", "sentence_index"])


@query("early_stop_select", f"WITH {SELECTED} SELECT doc_id, sentence_index, attempt, temperature, score, status FROM selected")
def early_stop_select(spark, sf_dir):
    return _selected(spark, sf_dir)


@query(
    "split_accepted",
    f"""WITH {SELECTED} SELECT CASE WHEN status LIKE 'accepted%' THEN 'accepted' ELSE 'discarded' END AS part,
    count(*) AS sentences, count(score) AS scores FROM selected GROUP BY 1""",
)
def split_accepted(spark, sf_dir):
    parts = zip(("accepted", "discarded"), selection.split_accepted(_selected(spark, sf_dir)))
    counted = [
        df.groupBy(F.lit(name).alias("part")).agg(F.count("*").alias("sentences"), F.count("score").alias("scores"))
        for name, df in parts
    ]
    return combine.union_aligned(counted)


@query(
    "document_metadata",
    f"""WITH {SELECTED} SELECT doc_id, count(*) AS total_sentences, count(*) FILTER (status LIKE 'accepted%') AS translated_sentences,
    round(coalesce(avg(score) FILTER (status LIKE 'accepted%'), 0), 6) AS avg_score,
    count(*) FILTER (status = 'discarded') AS discarded_sentences,
    round(count(*) FILTER (status LIKE 'accepted%') * 100.0::DOUBLE / count(*), 6) AS success_rate FROM selected GROUP BY 1""",
)
def document_metadata(spark, sf_dir):
    return rounded(aggregates.document_metadata(_selected(spark, sf_dir)), "avg_score", "success_rate")


DOCUMENT_SCORES = f"""{SCORED}, document_scores AS (SELECT doc_id, count(*) AS sentences, avg(comet_score) AS avg_score,
  min(comet_score) AS min_score, max(comet_score) AS max_score,
  CASE WHEN count(comet_score) > 0 THEN 'success' ELSE 'failed' END AS status FROM scored GROUP BY 1)"""


@query(
    "document_score_stats",
    f"WITH {DOCUMENT_SCORES} SELECT doc_id, sentences, round(avg_score,6) AS avg_score, min_score, max_score, status FROM document_scores",
)
def document_score_stats(spark, sf_dir):
    return rounded(aggregates.document_score_stats(scored(spark, sf_dir)), "avg_score")


@query(
    "job_summary",
    f"""WITH {DOCUMENT_SCORES} SELECT status, count(*) AS documents, sum(sentences)::BIGINT AS sentences,
    round(avg(avg_score),6) AS mean_of_means FROM document_scores GROUP BY 1""",
)
def job_summary(spark, sf_dir):
    return rounded(aggregates.job_summary(aggregates.document_score_stats(scored(spark, sf_dir))), "mean_of_means")


@query(
    "processing_stats",
    "SELECT DISTINCT 'row_'||doc_id||'.json' AS file_name, (SELECT count(*) FROM documents) AS total_processed FROM documents ORDER BY 1",
)
def processing_stats(spark, sf_dir):
    name = F.concat(F.lit("row_"), F.col("doc_id").cast("string"), F.lit(".json"))
    return aggregates.processing_stats(documents(spark, sf_dir).select(name.alias("file_name")), "file_name")


@query("distinct_values", "SELECT DISTINCT lang, source FROM documents")
def distinct_values(spark, sf_dir):
    return aggregates.distinct_values(documents(spark, sf_dir), ["lang", "source"])


# --- selection ----------------------------------------------------------------------------------


@query(
    "best_of_attempts",
    f"""WITH {ATTEMPTS} SELECT doc_id, sentence_index, attempt, temperature, score FROM attempts
    QUALIFY row_number() OVER (PARTITION BY doc_id, sentence_index ORDER BY coalesce(score,-1) DESC, attempt) = 1""",
)
def best_of_attempts(spark, sf_dir):
    return selection.best_of_attempts(attempts(spark, sf_dir), ["doc_id", "sentence_index"], "score")


@query(
    "file_gate",
    f"""WITH {SCORED}, m AS (SELECT source_file, avg(comet_score) AS a FROM scored GROUP BY 1)
    SELECT doc_id, sentence_index, comet_score FROM scored JOIN m USING (source_file) WHERE a > {T} AND comet_score >= {T}""",
)
def file_gate(spark, sf_dir):
    return ids(selection.file_gate(scored(spark, sf_dir), T, ["doc_id", "sentence_index"]))


@query(
    "first_match",
    f"""WITH {SENTENCES} SELECT sentence, doc_id, sentence_index FROM sentences
    QUALIFY row_number() OVER (PARTITION BY sentence ORDER BY doc_id, sentence_index) = 1""",
)
def first_match(spark, sf_dir):
    rows = sentences(spark, sf_dir).select("sentence", "doc_id", "sentence_index")
    return selection.first_match(rows, ["sentence"], ["doc_id", "sentence_index"])


@query(
    "attempt_index",
    f"""WITH {BAND}, r AS (SELECT word, row_number() OVER (ORDER BY n, word) - 1 AS rank FROM band)
    SELECT word, a::INT AS attempt, rank*5 + a AS "index" FROM r, range(5) t(a)""",
)
def attempt_index(spark, sf_dir):
    words = _band(spark, sf_dir).select("word", "n")
    return selection.attempt_indices(words, 5, [F.col("n"), F.col("word")]).select("word", "attempt", "index")


@query(
    "length_batches",
    """SELECT doc_id, lang, (row_number() OVER (PARTITION BY lang ORDER BY length(text), doc_id) - 1) // 32 AS batch_id FROM documents""",
)
def length_batches(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "lang", F.char_length("text").alias("chars"))
    return selection.length_batches(docs, 32, F.col("chars"), "doc_id", "lang").select("doc_id", "lang", "batch_id")


# --- orders, samples, splits --------------------------------------------------------------------


@query(
    "shortest_first",
    f"WITH {INPUT} SELECT _original_index, language FROM input ORDER BY len({words_sql('text')}), _original_index",
)
def shortest_first(spark, sf_dir):
    return ordering.shortest_first(input_text(spark, sf_dir)).select("_original_index", "language")


@query(
    "restore_order",
    f"WITH {TRANSLATED} SELECT _original_index, translation_text FROM translated WHERE language IN ('en','fr') ORDER BY 1",
)
def restore_order(spark, sf_dir):
    rows = _translated(spark, sf_dir)
    both = combine.union_aligned([rows.filter(F.col("language") == key) for key in PAIR.keys()])
    return ordering.restore_order(both).select("_original_index", "translation_text")


@query("order_documents", "SELECT 'row_'||doc_id||'.txt' AS file_name, n_chars FROM documents ORDER BY 1")
def order_documents(spark, sf_dir):
    name = F.concat(F.lit("row_"), F.col("doc_id").cast("string"), F.lit(".txt"))
    return ordering.by_file_name(documents(spark, sf_dir).select(name.alias("file_name"), "n_chars"))


@query(
    "reconstruct_document",
    f"""WITH {SCORED} SELECT doc_id, string_agg(forward_translation, ' ' ORDER BY sentence_index) AS reconstructed_text
    FROM scored GROUP BY 1""",
)
def reconstruct_document(spark, sf_dir):
    return ordering.reconstruct_documents(scored(spark, sf_dir))


@query("first_n", f"WITH {INPUT} SELECT _original_index, language FROM input ORDER BY 1 LIMIT 100")
def first_n(spark, sf_dir):
    rows = input_text(spark, sf_dir).select("_original_index", "language")
    return ordering.first_n(rows, 100, [F.col("_original_index")])


@query(
    "train_dev_split",
    """SELECT doc_id, CASE WHEN ('0x'||substr(md5('42|'||doc_id),1,8))::BIGINT < floor(0.01::DOUBLE*4294967296)
       THEN 'dev' ELSE 'train' END AS split FROM documents""",
)
def train_dev_split(spark, sf_dir):
    return ordering.split_train_dev(documents(spark, sf_dir).select("doc_id"), ["doc_id"], 0.01)


# --- unions and generators ----------------------------------------------------------------------


@query("union_files", f"WITH {SCORED} SELECT source_file, lang, count(*) AS rows, count(comet_score) AS scores FROM scored GROUP BY ALL")
def union_files(spark, sf_dir):
    """One table file per language, in different orders of columns, united by one scan of the folder."""
    path = scratch_path(spark, "per_language")
    rows = scored(spark, sf_dir).select("source_file", "lang", "comet_score", "sentence_index")
    rows.hint("rebalance", "lang").write.partitionBy("lang").parquet(path)
    schema = "source_file string, comet_score double, sentence_index int, lang string"
    return spark.read.schema(schema).parquet(path).groupBy("source_file", "lang").agg(
        F.count("*").alias("rows"), F.count("comet_score").alias("scores")
    )


@query(
    "union_directions",
    f"WITH {PAIRS} SELECT pair_id, sentence_en AS source, 'en->fr' AS direction FROM pairs UNION ALL SELECT pair_id, sentence_fr, 'fr->en' FROM pairs",
)
def union_directions(spark, sf_dir):
    rows = pairs(spark, sf_dir)
    return combine.union_directions(
        {
            "en->fr": rows.select("pair_id", F.col("sentence_en").alias("source")),
            "fr->en": rows.select("pair_id", F.col("sentence_fr").alias("source")),
        }
    )


@query(
    "union_aligned",
    f"""WITH {SCORED} SELECT doc_id, sentence_index, original_sentence AS en, NULL::VARCHAR AS fr FROM scored WHERE lang='en'
    UNION ALL SELECT doc_id, sentence_index, NULL, original_sentence FROM scored WHERE lang='fr'""",
)
def union_aligned(spark, sf_dir):
    rows = scored(spark, sf_dir)
    return combine.union_aligned(
        [
            rows.filter(F.col("lang") == key).select(
                "doc_id", "sentence_index", F.col("original_sentence").alias(key)
            )
            for key in PAIR.keys()
        ]
    )


@query(
    "explode_sentences",
    f"WITH {SENTENCES} SELECT doc_id, max(sentence_index)::INT AS last_index, count(*) AS sentences, sum(length(sentence))::BIGINT AS chars FROM sentences GROUP BY 1",
)
def explode_sentences(spark, sf_dir):
    return (
        combine.explode_sentences(documents(spark, sf_dir).select("doc_id", "text"))
        .groupBy("doc_id")
        .agg(
            F.max("sentence_index").alias("last_index"),
            F.count("*").alias("sentences"),
            F.sum(F.char_length("sentence")).alias("chars"),
        )
    )


@query("expand_attempts", f"WITH {ATTEMPTS} SELECT doc_id, sentence_index, attempt, temperature FROM attempts")
def expand_attempts(spark, sf_dir):
    rows = sentences(spark, sf_dir).select("doc_id", "sentence_index")
    return combine.expand_attempts(rows, GRID)


@query("expand_word_attempts", f"WITH {BAND} SELECT word, a::INT AS attempt FROM band, range(5) t(a)")
def expand_word_attempts(spark, sf_dir):
    return _band(spark, sf_dir).select("word", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("attempt"))


@query(
    "expand_directions",
    f"""WITH {PAIRS} SELECT pair_id, 'en->fr' AS direction, sentence_en AS source, sentence_fr AS target FROM pairs
    UNION ALL SELECT pair_id, 'fr->en', sentence_fr, sentence_en FROM pairs""",
)
def expand_directions(spark, sf_dir):
    return combine.expand_directions(pairs(spark, sf_dir), "sentence_en", "sentence_fr", ("en", "fr"))


@query(
    "failure_report",
    f"""WITH {TRANSLATED} SELECT _original_index, CASE WHEN translation_text IS NULL THEN 'null answer' ELSE 'blank answer' END AS error,
    text[1:80] AS preview FROM translated WHERE translation_text IS NULL OR translation_text = ''""",
)
def failure_report(spark, sf_dir):
    rows = _translated(spark, sf_dir).select(
        "_original_index",
        "text",
        F.when(F.col("translation_text").isNull(), F.lit("null answer"))
        .when(F.col("translation_text") == "", F.lit("blank answer"))
        .alias("error"),
    )
    return filters.failure_report(rows, "text")


