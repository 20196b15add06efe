"""Text metrics, evaluation reports and language identification."""

from __future__ import annotations

import pandas as pd

from pyspark.sql import functions as F

from lexiloom.functions.metrics import Chrf, EditSimilarity, ExternalScorer, SentenceBleu, add_metrics, corpus_scores
from lexiloom.operators import language_id
from lexiloom.plans import evaluate
from lexiloom.queries.standins import cipher_backward, cipher_forward
from lexiloom.queries.base import (
    DIRECTED,
    SENTENCES,
    backward_sql,
    directed,
    documents,
    forward_sql,
    query,
    rounded,
    sentences,
    words_sql,
)
from lexiloom.session import scratch_path
from lexiloom.sources import writers

# --- SQL for n-gram metrics -----------------------------------------------------------------------


def normalized_sql(text: str) -> str:
    return f"regexp_replace(lower({text}), '[[:punct:]]', '', 'g')"


def chars_sql(text: str) -> str:
    return rf"list_filter(string_split(regexp_replace({text}, '\s+', '', 'g'), ''), lambda c: c<>'')"


def chrf_words_sql(text: str) -> str:
    mark = r"[[:punct:]]"
    return f"""flatten(list_transform({words_sql(text)}, lambda w: CASE WHEN length(w)=1 THEN [w]
      WHEN regexp_matches(w, '{mark}$') THEN [w[:-2], w[-1:]] WHEN regexp_matches(w, '^{mark}') THEN [w[1], w[2:]] ELSE [w] END))"""


def tokens_sql(text: str) -> str:
    """Newswire tokenization of raw text."""
    line = f"replace(replace({text}, '-'||chr(10), ''), chr(10), ' ')"
    for entity, char in (("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        line = f"replace({line}, '{entity}', '{char}')"
    line = f"(' '||{line}||' ')"
    for pattern, into in (
        (r"([\x7b-\x7e\x5b-\x60 -&\x28-\x2b\x3a-\x40/])", r" \1 "),
        (r"([^0-9])([.,])", r"\1 \2 "),
        (r"([.,])([^0-9])", r" \1 \2"),
        (r"([0-9])(-)", r"\1 \2 "),
    ):
        line = f"regexp_replace({line}, '{pattern}', '{into}', 'g')"
    return words_sql(line)


def counts_sql(name: str, base: str, key: str, hyp: str, ref: str, orders: int) -> str:
    """CTEs ending in ``{name}``: matches ``m``, totals ``h`` and ``r`` per key and order ``n``."""

    def items(side: int, column: str) -> str:
        return f"SELECT {key}, {side} AS side, unnest({column}) AS x, unnest(range(len({column}))) AS pos FROM {name}_in"

    runs = ["x AS g1"] + [
        "x" + "".join(f"||chr(31)||lead(x, {k}) OVER w" for k in range(1, n)) + f" AS g{n}" for n in range(2, orders + 1)
    ]
    named = ", ".join(f"g{n}" for n in range(1, orders + 1))
    return f"""{name}_in AS (SELECT {key}, {hyp} AS hyp, {ref} AS ref FROM {base}),
{name}_items AS ({items(0, 'hyp')} UNION ALL {items(1, 'ref')}),
{name}_runs AS (SELECT {key}, side, {', '.join(runs)} FROM {name}_items WINDOW w AS (PARTITION BY {key}, side ORDER BY pos)),
{name}_all AS (SELECT {key}, side, unnest(range(1, {orders + 1})) AS n, unnest([{named}]) AS gram FROM {name}_runs),
{name}_grams AS (SELECT * FROM {name}_all WHERE gram IS NOT NULL),
{name}_counts AS (SELECT {key}, n, gram, count(*) FILTER (side=0) AS ch, count(*) FILTER (side=1) AS cr FROM {name}_grams GROUP BY ALL),
{name}_matches AS (SELECT {key}, n, sum(least(ch, cr)) AS m FROM {name}_counts GROUP BY ALL),
{name} AS (SELECT i.{key}, n, coalesce(m.m, 0)::DOUBLE AS m, greatest(len(hyp)-n+1, 0)::DOUBLE AS h,
  greatest(len(ref)-n+1, 0)::DOUBLE AS r FROM {name}_in i CROSS JOIN range(1, {orders + 1}) t(n)
  LEFT JOIN {name}_matches m USING ({key}, n))"""


def chrf_sql(name: str, counts: str, key: str) -> str:
    """CTE ``{name}(key, score)`` from the rows of one or more counts CTEs."""
    return f"""{name}_pr AS (SELECT {key}, coalesce(avg(m/h) FILTER (h>0 AND r>0), 0) AS p,
  coalesce(avg(m/r) FILTER (h>0 AND r>0), 0) AS q FROM {counts} GROUP BY ALL),
{name} AS (SELECT {key}, CASE WHEN p+q > 0 THEN 500.0::DOUBLE*p*q/(4*p+q) ELSE 0 END AS score FROM {name}_pr)"""


def bleu_sql(name: str, counts: str, key: str, effective: bool = True, orders: int = 4) -> str:
    used = "count(*) FILTER (h>0)" if effective else str(orders)
    complete = "" if effective else f"OR count(*) FILTER (h>0) < {orders}"
    return f"""{name}_k AS (SELECT *, count(*) FILTER (h>0 AND m=0) OVER (PARTITION BY {key} ORDER BY n) AS k FROM {counts}),
{name}_p AS (SELECT *, CASE WHEN h=0 THEN 0 WHEN m=0 THEN 100.0::DOUBLE/(pow(2,k)*h) ELSE 100.0::DOUBLE*m/h END AS p FROM {name}_k),
{name}_b AS (SELECT *, CASE WHEN h>=r THEN 1 WHEN h>0 THEN exp(1-r/h) ELSE 0 END AS bp FROM {name}_p),
{name} AS (SELECT {key}, CASE WHEN sum(m)=0 {complete} THEN 0 ELSE (max(bp) FILTER (n=1))*exp(sum(CASE WHEN h>0 THEN ln(p) ELSE 0 END)/{used}) END AS score
  FROM {name}_b GROUP BY ALL)"""


# --- metrics per row --------------------------------------------------------------------------------

LOSSY = f"""{SENTENCES},
lossy AS (SELECT doc_id*1000000+sentence_index AS id, sentence AS ref, {backward_sql(forward_sql('sentence', '5'))} AS hyp FROM sentences)"""


def lossy(spark, sf_dir):
    """Sentences next to a version that lost some words."""
    return sentences(spark, sf_dir).select(
        (F.col("doc_id") * 1000000 + F.col("sentence_index")).alias("id"),
        F.col("sentence").alias("ref"),
        cipher_backward(cipher_forward(F.col("sentence"), 5)).alias("hyp"),
    )


def _score(spark, sf_dir, metric):
    scored = add_metrics(lossy(spark, sf_dir), {"score": metric}, "ref", "hyp", "ref")
    return rounded(scored.select("id", "score"), "score")


BLEU_COUNTS = counts_sql("words", "lossy", "id", words_sql(normalized_sql("hyp")), words_sql(normalized_sql("ref")), 4)
CHRF_COUNTS = counts_sql("chars", "lossy", "id", chars_sql(normalized_sql("hyp")), chars_sql(normalized_sql("ref")), 6)
CHRF_WORD_COUNTS = counts_sql(
    "terms", "lossy", "id", chrf_words_sql(normalized_sql("hyp")), chrf_words_sql(normalized_sql("ref")), 2
)


@query(
    "sentence_bleu",
    f"WITH {LOSSY}, {BLEU_COUNTS}, {bleu_sql('bleu', 'words', 'id')} SELECT id, round(score, 6) AS score FROM bleu",
)
def sentence_bleu(spark, sf_dir):
    return _score(spark, sf_dir, SentenceBleu())


@query("chrf", f"WITH {LOSSY}, {CHRF_COUNTS}, {chrf_sql('chrf', 'chars', 'id')} SELECT id, round(score, 6) AS score FROM chrf")
def chrf(spark, sf_dir):
    return _score(spark, sf_dir, Chrf())


@query(
    "chrf_pp",
    f"""WITH {LOSSY}, {CHRF_COUNTS}, {CHRF_WORD_COUNTS}, both_counts AS (SELECT * FROM chars UNION ALL SELECT * FROM terms),
    {chrf_sql('chrf', 'both_counts', 'id')} SELECT id, round(score, 6) AS score FROM chrf""",
)
def chrf_pp(spark, sf_dir):
    return _score(spark, sf_dir, Chrf(word_order=2))


# One byte per letter, as the SQL engine's distance counts bytes.
_LETTERS = "éóèñçüêäößíÉÈÑÓÇÄÊÜÖÍ"
_BYTES = "||".join(f"chr({code})" for code in [1, 2, 3, 4, 5, 6, 7, 8, *range(14, 27)])


def _single_bytes(text: str) -> str:
    return f"translate({text}, '{_LETTERS}', {_BYTES})"


@query(
    "edit_similarity",
    f"""WITH {LOSSY} SELECT id, round(CASE WHEN greatest(length(hyp), length(ref)) = 0 THEN 1 ELSE
      1 - levenshtein({_single_bytes('ref')}, {_single_bytes('hyp')})::DOUBLE / greatest(length(hyp), length(ref)) END, 6) AS score FROM lossy""",
)
def edit_similarity(spark, sf_dir):
    return _score(spark, sf_dir, EditSimilarity())


# --- corpus metrics ---------------------------------------------------------------------------------

CORPUS_WORDS = counts_sql("words", "rows_", "id", tokens_sql("translation"), tokens_sql("target"), 4)
CORPUS_CHARS = counts_sql("chars", "rows_", "id", chars_sql("translation"), chars_sql("target"), 6)
CORPUS = f"""{DIRECTED}, rows_ AS (SELECT pair_id||direction AS id, direction, translation, target FROM directed),
{CORPUS_WORDS}, {CORPUS_CHARS},
word_sums AS (SELECT direction, n, sum(m) AS m, sum(h) AS h, sum(r) AS r FROM words JOIN rows_ USING (id) GROUP BY ALL),
char_sums AS (SELECT direction, n, sum(m) AS m, sum(CASE WHEN r>0 THEN h ELSE 0 END) AS h, sum(r) AS r FROM chars JOIN rows_ USING (id) GROUP BY ALL),
{bleu_sql('bleu', 'word_sums', 'direction', effective=False)}, {chrf_sql('chrf', 'char_sums', 'direction')},
lengths AS (SELECT direction, max(bp) FILTER (n=1) AS bp, (max(h) FILTER (n=1))::BIGINT AS sys_len, (max(r) FILTER (n=1))::BIGINT AS ref_len,
  {', '.join(f'max(p) FILTER (n={n}) AS precision_{n}' for n in range(1, 5))} FROM bleu_b GROUP BY 1),
samples AS (SELECT direction, count(*) AS num_samples, count(*) FILTER (translation LIKE '[ERROR%') AS num_errors FROM rows_ GROUP BY 1)"""
PRECISIONS = [f"precision_{n}" for n in range(1, 5)]


def _corpus(spark, sf_dir):
    return corpus_scores(directed(spark, sf_dir), "translation", "target", ["direction"])


@query(
    "corpus_bleu",
    f"""WITH {CORPUS} SELECT direction, num_samples, round(b.score,6) AS bleu, {', '.join(f'round({p},6) AS {p}' for p in PRECISIONS)},
    round(bp,6) AS bp, sys_len, ref_len FROM samples JOIN bleu b USING (direction) JOIN lengths USING (direction)""",
)
def corpus_bleu(spark, sf_dir):
    return rounded(_corpus(spark, sf_dir).drop("chrf"), "bleu", "bp", *PRECISIONS)


@query(
    "corpus_chrf",
    f"WITH {CORPUS} SELECT direction, num_samples, round(c.score,6) AS chrf FROM samples JOIN chrf c USING (direction)",
)
def corpus_chrf(spark, sf_dir):
    return rounded(_corpus(spark, sf_dir).select("direction", "num_samples", "chrf"), "chrf")


@query(
    "bidirectional_report",
    f"""WITH {CORPUS} SELECT direction, num_samples, num_errors, round(num_errors/num_samples,6) AS error_rate,
    round(b.score,6) AS bleu, round(c.score,6) AS chrf, sys_len, ref_len
    FROM samples JOIN bleu b USING (direction) JOIN chrf c USING (direction) JOIN lengths USING (direction)""",
)
def bidirectional_report(spark, sf_dir):
    report = evaluate.bidirectional_report(directed(spark, sf_dir))
    return rounded(
        report.select("direction", "num_samples", "num_errors", "error_rate", "bleu", "chrf", "sys_len", "ref_len"),
        "error_rate",
        "bleu",
        "chrf",
    )


@query(
    "write_metrics_report",
    f"""WITH {CORPUS} SELECT d.pair_id, d.direction, d.source, d.translation, d.target AS reference, num_samples, num_errors,
    round(b.score,6) AS bleu, round(c.score,6) AS chrf, sys_len, ref_len
    FROM directed d JOIN samples USING (direction) JOIN bleu b USING (direction) JOIN chrf c USING (direction) JOIN lengths USING (direction)""",
)
def write_metrics_report(spark, sf_dir):
    """The report as it is read back: scores of each direction, and its lines."""
    path = scratch_path(spark, "report")
    rows = directed(spark, sf_dir)
    report = evaluate.bidirectional_report(rows).select(
        "direction", "num_samples", "num_errors", "bleu", "chrf", "sys_len", "ref_len"
    )
    writers.write_report(report, rows, path)
    metrics = spark.read.schema(report.schema).json(f"{path}/metrics")
    lines = spark.read.schema(
        "pair_id long, direction string, source string, translation string, reference string"
    ).json(f"{path}/translations")
    return rounded(lines.join(metrics, "direction"), "bleu", "chrf")


# --- evaluation of tables ---------------------------------------------------------------------------


def length_scorer() -> ExternalScorer:
    """Stand-in for a quality model: how far hypothesis and reference agree in length, less for long sources."""

    def make():
        def score(src: pd.Series, hyp: pd.Series, ref: pd.Series) -> pd.Series:
            h, r, s = hyp.str.len(), ref.str.len(), src.str.len()
            return (h + 1) / (h + r + s + 3)

        return score

    return ExternalScorer("COMET", make)


def _comet_sql(src: str, hyp: str, ref: str) -> str:
    return f"(length({hyp})+1)::DOUBLE/(length({hyp})+length({ref})+length({src})+3)"


@query("external_score", f"WITH {DIRECTED} SELECT pair_id, direction, round({_comet_sql('source', 'translation', 'target')}, 6) AS comet FROM directed")
def external_score(spark, sf_dir):
    scored = add_metrics(directed(spark, sf_dir), {"comet": length_scorer()}, "source", "translation", "target")
    return rounded(scored.select("pair_id", "direction", "comet"), "comet")


ROWS = f"{DIRECTED}, rows_ AS (SELECT pair_id||direction AS id, * FROM directed)"
ROW_BLEU = f"""{counts_sql('words', 'rows_', 'id', words_sql(normalized_sql('translation')), words_sql(normalized_sql('target')), 4)},
{bleu_sql('bleu', 'words', 'id')}"""
ROW_CHRF = f"""{counts_sql('chars', 'rows_', 'id', chars_sql(normalized_sql('translation')), chars_sql(normalized_sql('target')), 6)},
{counts_sql('terms', 'rows_', 'id', chrf_words_sql(normalized_sql('translation')), chrf_words_sql(normalized_sql('target')), 2)},
both_counts AS (SELECT * FROM chars UNION ALL SELECT * FROM terms), {chrf_sql('chrf', 'both_counts', 'id')}"""
LOOKUP = """first_rows AS (SELECT direction, source, arg_min(translation, pair_id) AS opposite FROM directed GROUP BY ALL),
looked_up AS (SELECT d.*, f.opposite FROM rows_ d LEFT JOIN first_rows f
  ON f.direction = CASE d.direction WHEN 'en->fr' THEN 'fr->en' ELSE 'en->fr' END AND f.source = d.target)"""


@query(
    "metric_roles",
    f"""WITH {ROWS}, {ROW_BLEU} SELECT pair_id, direction, round(b.score, 6) AS bleu,
    round({_comet_sql('source', 'translation', 'target')}, 6) AS comet FROM rows_ JOIN bleu b USING (id)""",
)
def metric_roles(spark, sf_dir):
    """BLEU sees (translation, target), the external scorer (source, translation, target)."""
    metrics = {"bleu": SentenceBleu(), "comet": length_scorer()}
    scored = add_metrics(directed(spark, sf_dir), metrics, "source", "translation", "target")
    return rounded(scored.select("pair_id", "direction", *metrics), *metrics)


EVALUATED = f"""{ROWS}, {ROW_BLEU}, {ROW_CHRF}, {LOOKUP},
evaluated AS (SELECT l.pair_id, l.direction, b.score AS bleu, c.score AS chrf,
  coalesce(CASE WHEN opposite IS NOT NULL THEN {_comet_sql('source', 'translation', 'opposite')} END, 0) AS comet
  FROM looked_up l JOIN bleu b USING (id) JOIN chrf c USING (id))"""


def _evaluated(spark, sf_dir):
    return evaluate.evaluate_rows(directed(spark, sf_dir), external=length_scorer(), position="pair_id")


@query(
    "multi_metric_eval",
    f"WITH {EVALUATED} SELECT pair_id, direction, round(bleu,6) AS bleu, round(chrf,6) AS chrf, round(comet,6) AS comet FROM evaluated",
)
def multi_metric_eval(spark, sf_dir):
    scored = _evaluated(spark, sf_dir).select("pair_id", "direction", "bleu", "chrf", "comet")
    return rounded(scored, "bleu", "chrf", "comet")


@query(
    "evaluate_table",
    f"""WITH {EVALUATED}, m AS (SELECT direction, unnest(['bleu','chrf','comet']) AS metric, unnest([bleu, chrf, comet]) AS v FROM evaluated)
    SELECT direction, grouping(direction) = 1 AS overall, metric, round(avg(v),6) AS mean, round(stddev_samp(v),6) AS std, round(min(v),6) AS min, round(max(v),6) AS max
    FROM m GROUP BY GROUPING SETS ((direction, metric), (metric))""",
)
def evaluate_table(spark, sf_dir):
    """An existing table with the other column names, scored and summarized."""
    old = directed(spark, sf_dir).withColumnsRenamed({"source": "source_text", "target": "reference"})
    _, summary = evaluate.evaluate_table(old, external=length_scorer(), position="pair_id")
    return rounded(summary, "mean", "std", "min", "max")


# --- language identification ------------------------------------------------------------------------


def _letters_sql(text: str) -> str:
    return rf"list_filter(regexp_split_to_array(lower({text}), '[^\pL]+'), lambda w: w<>'')"


def language_sql(rows: str, key: str, text: str, training: str = "training") -> str:
    """CTE ``detected(key, language)``: ``training(lang, text)`` trains, ``rows`` are identified."""
    grams = ", ".join(f"list_transform(range(1, length(p)-{k}+2), lambda i: substr(p, i, {k}))" for k in (1, 2, 3))
    fixed = f"(round(ln({{0}}) * {language_id.SCALE}))::BIGINT"
    return rf"""train_words AS (SELECT lang, unnest({_letters_sql('text')}) AS word FROM {training}),
train_counts AS (SELECT lang, word, count(*) AS n FROM train_words GROUP BY ALL),
distinct_words AS (SELECT word, ' '||word||' ' AS p FROM (SELECT word FROM train_counts UNION SELECT unnest({_letters_sql(text)}) FROM {rows})),
word_buckets AS (SELECT word, ('0x'||substr(md5(gram),1,{language_id.DIGITS}))::INT AS bucket FROM (SELECT word, unnest(flatten([{grams}])) AS gram FROM distinct_words)),
profile AS (SELECT lang, bucket, sum(n) AS n FROM train_counts JOIN word_buckets USING (word) GROUP BY ALL),
sizes AS (SELECT lang, sum(n)::DOUBLE + (SELECT count(DISTINCT bucket) FROM profile) AS size FROM profile GROUP BY 1),
priors AS (SELECT lang, {fixed.format(f"count(*)::DOUBLE / (SELECT count(*) FROM {training})")} AS prior FROM {training} GROUP BY 1),
word_scores AS (SELECT g.word, s.lang, sum({fixed.format("(coalesce(p.n, 0)+1)::DOUBLE / s.size")}) AS score FROM word_buckets g CROSS JOIN sizes s
  LEFT JOIN profile p ON p.bucket = g.bucket AND p.lang = s.lang GROUP BY ALL),
row_words AS (SELECT {key}, word, count(*) AS c FROM (SELECT {key}, unnest({_letters_sql(text)}) AS word FROM {rows}) GROUP BY ALL),
gained AS (SELECT {key}, lang, sum(c*score) AS gain FROM row_words JOIN word_scores USING (word) GROUP BY ALL),
ranked AS (SELECT r.{key}, p.lang, p.prior + coalesce(g.gain, 0) AS score FROM {rows} r CROSS JOIN priors p
  LEFT JOIN gained g ON g.{key} = r.{key} AND g.lang = p.lang),
detected AS (SELECT {key}, lang AS language FROM ranked QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY score DESC, lang) = 1)"""


# One document in four is held out of the training.
HELD_OUT = "substr(md5(doc_id::VARCHAR),1,1) IN ('0','1','2','3')"
TRAINING = f"training AS (SELECT lang, text FROM documents WHERE NOT {HELD_OUT})"
WHOLE = "training AS (SELECT lang, text FROM documents)"


def held_out():
    return F.substring(F.md5(F.col("doc_id").cast("string")), 1, 1).isin(list("0123"))


def language_model(spark, sf_dir):
    return language_id.train(documents(spark, sf_dir).filter(~held_out()), "text", "lang")


@query(
    "lang_id",
    f"""WITH {TRAINING}, {language_sql('documents', 'doc_id', 'text')}
    SELECT doc_id, d.language AS detected, d.language = lang AS expected, {HELD_OUT} AS held_out FROM documents JOIN detected d USING (doc_id)""",
)
def lang_id(spark, sf_dir):
    """All documents by a model that has not seen the held-out ones."""
    found = language_id.identify(documents(spark, sf_dir), language_model(spark, sf_dir))
    matches = language_id.matches_expected(F.col("detected"), F.upper("lang"))
    return found.select("doc_id", "detected", matches.alias("expected"), held_out().alias("held_out"))


@query(
    "lang_id_gate",
    f"""WITH {LOSSY}, tagged AS (SELECT doc_id*1000000+sentence_index AS id, lang, sentence FROM sentences), {WHOLE},
    {language_sql('tagged', 'id', 'sentence')}
    SELECT id, lang FROM tagged JOIN detected d USING (id) WHERE d.language = lang""",
)
def lang_id_gate(spark, sf_dir):
    """Sentences that are in the language of their document, by a model of all documents."""
    rows = sentences(spark, sf_dir).select(
        (F.col("doc_id") * 1000000 + F.col("sentence_index")).alias("id"), "lang", "sentence"
    )
    model = language_id.train(documents(spark, sf_dir), "text", "lang")
    found = language_id.identify(rows, model, "sentence")
    return found.filter(language_id.matches_expected(F.col("detected"), F.col("lang"))).select("id", "lang")
