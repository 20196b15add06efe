"""Whole jobs around a model provider.  The stand-in providers make their results a function of the input."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexiloom.functions.metrics import Chrf, SentenceBleu
from lexiloom.operators.selection import attempt_indices
from lexiloom.operators import aggregates
from lexiloom.operators.language_id import bucket_table, language_gate, train
from lexiloom.plans import backtranslate, translate as translation, words as word_jobs
from lexiloom.providers import RetryPolicy, call_model
from lexiloom.providers.calls import TEMPERATURES
from lexiloom.queries.standins import CODED, PLAIN, CipherProvider, FlakyProvider, WordsmithProvider
from lexiloom.queries.base import (
    INPUT,
    PAIR,
    SENTENCES,
    backward_sql,
    documents,
    forward_sql,
    input_text,
    query,
    rounded,
    sentences,
    words_sql,
)
from lexiloom.queries.metrics import bleu_sql, chars_sql, chrf_sql, counts_sql, language_sql, normalized_sql
from lexiloom.queries.relational import BAND, _band
from lexiloom.queries.scalars import CHUNK_WORDS
from lexiloom.session import materialize

CIPHER = CipherProvider("English")
AT_ONCE = RetryPolicy(delay=0.0)


@query(
    "translate",
    f"SELECT doc_id, {forward_sql('text', '0')} AS translation, NULL::VARCHAR AS error, 1::INT AS attempts FROM documents",
)
def translate(spark, sf_dir):
    done = translation.translate(documents(spark, sf_dir), CIPHER, "English", "French", "cipher")
    return done.select("doc_id", "translation", "error", "attempts")


# --- round trips ------------------------------------------------------------------------------------

ROUND_TRIP = f"""{SENTENCES},
there AS (SELECT doc_id*1000000+sentence_index AS id, sentence, {forward_sql('sentence', '5')} AS forward FROM sentences),
trip AS (SELECT *, {backward_sql('forward')} AS back FROM there)"""
TRIP_BLEU = f"""{counts_sql('words', 'trip', 'id', words_sql(normalized_sql('back')), words_sql(normalized_sql('sentence')), 4)},
{bleu_sql('bleu', 'words', 'id')}"""
TRIP_CHRF = f"""{counts_sql('chars', 'trip', 'id', chars_sql(normalized_sql('back')), chars_sql(normalized_sql('sentence')), 6)},
{chrf_sql('chrf', 'chars', 'id')}"""


@query(
    "back_translate",
    f"""WITH {ROUND_TRIP}, {TRIP_BLEU}, {TRIP_CHRF} SELECT id, forward, back, round(b.score,6) AS bleu, round(c.score,6) AS chrf,
    round((b.score+c.score)/2,6) AS overall_score FROM trip JOIN bleu b USING (id) JOIN chrf c USING (id)""",
)
def back_translate(spark, sf_dir):
    rows = sentences(spark, sf_dir).select(
        (F.col("doc_id") * 1000000 + F.col("sentence_index")).alias("id"), "sentence"
    )
    metrics = {"bleu": SentenceBleu(), "chrf": Chrf()}
    done = backtranslate.back_translate(rows, CIPHER, "English", "French", "cipher", metrics, "sentence", 0.5)
    return rounded(done.select("id", "forward", "back", *metrics, "overall_score"), *metrics, "overall_score")


# The gate's model knows documents as they are and coded; a translation must look coded.
GATE_TRAINING = f"""training AS (SELECT 'english' AS lang, text FROM documents UNION ALL
  SELECT 'french', translate(text, '{PLAIN}', '{CODED}') FROM documents)"""
# The metric is computed once per distinct (sentence, round trip); attempts of repeated sentences share it.
SWEEP = f"""{SENTENCES}, {GATE_TRAINING},
tried AS MATERIALIZED (SELECT doc_id, sentence_index, sentence, t, {forward_sql('sentence', 't')} AS forward FROM sentences, range(11) g(t)),
gated AS (SELECT md5(forward) AS id, any_value(forward) AS forward FROM tried GROUP BY 1),
{language_sql('gated', 'id', 'forward')},
returned AS (SELECT tried.*, {backward_sql('forward')} AS back FROM tried JOIN detected d ON d.id = md5(forward) AND d.language = 'french'),
distinct_trips AS (SELECT md5(sentence||chr(1)||back) AS id, any_value(sentence) AS sentence, any_value(back) AS back FROM returned GROUP BY 1),
{counts_sql('chars', 'distinct_trips', 'id', chars_sql(normalized_sql('back')), chars_sql(normalized_sql('sentence')), 6)},
{chrf_sql('chrf', 'chars', 'id')},
judged AS MATERIALIZED (SELECT r.*, round(c.score, 9) AS score FROM returned r JOIN chrf c ON c.id = md5(r.sentence||chr(1)||r.back)),
early AS (SELECT doc_id, sentence_index, min(t) AS t FROM judged WHERE score >= 95 GROUP BY ALL),
top AS (SELECT doc_id, sentence_index, t, score FROM judged WHERE score > 0
  QUALIFY row_number() OVER (PARTITION BY doc_id, sentence_index ORDER BY score DESC, t) = 1),
choice AS (SELECT s.doc_id, s.sentence_index, s.sentence, coalesce(e.t, CASE WHEN t.score >= 50 THEN t.t END) AS t,
  CASE WHEN e.t IS NOT NULL THEN 'accepted_early_stop' WHEN t.score >= 50 THEN 'accepted' ELSE 'discarded' END AS status
  FROM sentences s LEFT JOIN early e USING (doc_id, sentence_index) LEFT JOIN top t USING (doc_id, sentence_index)),
swept AS (SELECT c.doc_id, c.sentence_index, c.sentence, j.forward AS translation, j.back AS backtranslation, j.score,
  c.t/10.0::DOUBLE AS temperature, c.status FROM choice c LEFT JOIN judged j USING (doc_id, sentence_index, t))"""


def _gate(spark, sf_dir):
    docs = documents(spark, sf_dir).select("text")
    plain = docs.withColumn("language", F.lit("English"))
    coded = docs.select(F.translate("text", PLAIN, CODED).alias("text"), F.lit("French").alias("language"))
    return language_gate(bucket_table(train(plain.unionByName(coded))), "French")


def _swept(spark, sf_dir):
    """All temperatures, with the language gate."""
    rows = sentences(spark, sf_dir).select("doc_id", "sentence_index", "sentence")
    return backtranslate.synth_sentences(rows, CIPHER, "English", "French", "cipher", gate=_gate(spark, sf_dir))


@query(
    "synth_sentences",
    f"WITH {SWEEP} SELECT doc_id, sentence_index, translation, backtranslation, round(score,6) AS score, temperature, status FROM swept",
)
def synth_sentences(spark, sf_dir):
    return rounded(_swept(spark, sf_dir).drop("sentence"), "score")


@query(
    "synth_documents",
    f"""WITH {SWEEP} SELECT doc_id,
    string_agg(coalesce(translation, '[UNTRANSLATED: '||sentence||']'), ' ' ORDER BY sentence_index) AS reconstructed_text,
    count(*) AS total_sentences, count(*) FILTER (status LIKE 'accepted%') AS translated_sentences,
    count(*) FILTER (status = 'discarded') AS discarded_sentences, round(coalesce(avg(score), 0), 6) AS avg_score,
    round(count(*) FILTER (status LIKE 'accepted%') * 100.0::DOUBLE / count(*), 6) AS success_rate FROM swept GROUP BY 1""",
)
def synth_documents(spark, sf_dir):
    return rounded(backtranslate.synth_documents(_swept(spark, sf_dir)), "avg_score", "success_rate")


@query(
    "document_attempts",
    f"""WITH {SWEEP}, best AS (SELECT * FROM judged QUALIFY row_number() OVER (PARTITION BY doc_id, sentence_index ORDER BY score DESC, t) = 1)
    SELECT doc_id, sentence_index, sentence AS original_sentence, forward AS forward_translation, back AS back_translation,
    round(score,6) AS comet_score, t/10.0::DOUBLE AS temperature FROM best""",
)
def document_attempts(spark, sf_dir):
    """The document job's other form: all temperatures are tried, the best attempt is kept."""
    done = backtranslate.document_attempts(
        documents(spark, sf_dir), CIPHER, "English", "French", "cipher", Chrf(), TEMPERATURES, _gate(spark, sf_dir)
    )
    return rounded(done, "comet_score")


# --- tables -----------------------------------------------------------------------------------------

CHUNKED = rf"""w AS (SELECT _original_index, language, text, {words_sql('text')} AS words FROM todo),
ends AS (SELECT _original_index, unnest(list_filter(list_transform(words, lambda w, i:
  CASE WHEN regexp_matches(w, '[.!?]$') THEN i END), lambda e: e IS NOT NULL)) AS e FROM w),
points AS (SELECT _original_index, e FROM ends UNION ALL SELECT _original_index, 0 FROM w),
links AS MATERIALIZED (SELECT p._original_index, p.e, n.e AS nxt FROM points p ASOF JOIN ends n
  ON p._original_index = n._original_index AND p.e + {CHUNK_WORDS} <= n.e),
cuts AS (SELECT _original_index, 0::BIGINT AS cut FROM w WHERE len(words) > {CHUNK_WORDS}
  UNION ALL SELECT c._original_index, l.nxt FROM cuts c JOIN links l ON l._original_index = c._original_index AND l.e = c.cut),
bounds AS (SELECT c._original_index, language, c.cut, words,
  coalesce(lead(c.cut) OVER (PARTITION BY c._original_index ORDER BY c.cut), len(words)) AS upto FROM cuts c JOIN w USING (_original_index)),
chunks AS (SELECT _original_index, language, cut, array_to_string(words[cut+1:upto], ' ') AS chunk FROM bounds WHERE upto > cut
  UNION ALL SELECT _original_index, language, 0, text FROM w WHERE len(words) <= {CHUNK_WORDS}),
answers AS (SELECT _original_index, language, cut, CASE language WHEN 'en' THEN {forward_sql('chunk', '0')}
  ELSE trim({backward_sql('chunk')}, ' '||chr(9)||chr(10)) END AS answer FROM chunks),
done AS (SELECT _original_index, language, string_agg(answer, ' ' ORDER BY cut) AS translation_text FROM answers GROUP BY ALL)"""


def _saved(spark, sf_dir):
    """Rows an earlier run translated; a part of them was saved blank."""
    kind = F.substring(F.md5(F.col("_original_index").cast("string")), 1, 1)
    text = F.when(kind == "1", F.lit("")).otherwise(F.lit("earlier"))
    return input_text(spark, sf_dir).filter(kind.isin("0", "1")).select("_original_index", text.alias("translation_text"))


@query(
    "translate_table",
    f"""WITH RECURSIVE {INPUT}, todo AS (SELECT * FROM input WHERE language IN ('en','fr') AND md5(_original_index::VARCHAR) NOT LIKE '0%'),
    {CHUNKED} SELECT _original_index, language, translation_text, 'cipher' AS model_name, NULL::VARCHAR AS error FROM done""",
)
def translate_table(spark, sf_dir):
    done = translation.translate_table(
        input_text(spark, sf_dir), CIPHER, "cipher", PAIR, saved=_saved(spark, sf_dir), max_words=CHUNK_WORDS
    )
    return done.select("_original_index", "language", "translation_text", "model_name", "error")


BATCH, PADDED = 8, 20_000


@query(
    "batch_inference",
    f"""WITH {INPUT}, p AS (SELECT *, length(text) AS len, row_number() OVER (PARTITION BY language ORDER BY length(text), _original_index) - 1 AS pos
      FROM input WHERE language IN ('en','fr')),
    b AS (SELECT *, pos // {BATCH} AS batch_id, max(len) OVER (PARTITION BY language, pos // {BATCH}) AS longest FROM p),
    c AS (SELECT *, (pos % {BATCH}) // greatest({PADDED} // longest, 1) AS batch_part FROM b)
    SELECT _original_index, language, batch_id, batch_part,
      least(512, 2 * max(len) OVER (PARTITION BY language, batch_id, batch_part))::BIGINT AS max_tokens,
      CASE language WHEN 'en' THEN {forward_sql('text', '0')} ELSE trim({backward_sql('text')}, ' '||chr(9)||chr(10)) END AS translation_text FROM c""",
)
def batch_inference(spark, sf_dir):
    done = translation.batch_translate(
        input_text(spark, sf_dir), CIPHER, "cipher", PAIR, batch_size=BATCH, padded=PADDED
    )
    return done.select("_original_index", "language", "batch_id", "batch_part", "max_tokens", "translation_text")


@query(
    "retry_policy",
    f"""WITH {SENTENCES}, k AS (SELECT doc_id, sentence_index, sentence, substr(md5(sentence),1,1) AS k FROM sentences)
    SELECT doc_id, sentence_index, CASE WHEN k NOT IN ('0','7') THEN {forward_sql('sentence', '0')} END AS value,
    CASE k WHEN '0' THEN 'authentication rejected' WHEN '7' THEN 'connection lost' END AS error,
    CASE WHEN k IN ('1','2') THEN 2 WHEN k IN ('3','4','5','6') THEN 3 WHEN k='7' THEN 9 ELSE 1 END::INT AS attempts,
    CASE WHEN k IN ('5','6','7') THEN 2048 ELSE 512 END::BIGINT AS budget FROM k""",
)
def retry_policy(spark, sf_dir):
    """Every way a call can fail, by the digest of its text: refused, throttled, blank, cut off, lost."""
    policy = RetryPolicy(attempts=3, delay=0.0, tiers=(1, 2, 4))
    call = call_model(FlakyProvider(CIPHER), F.col("sentence"), F.lit("from English to French"), "flaky", max_tokens=512, policy=policy)
    done = sentences(spark, sf_dir).select("doc_id", "sentence_index", call.alias("c"))
    return done.select("doc_id", "sentence_index", "c.*")


# --- prompt chains ----------------------------------------------------------------------------------


def _coded(text: str) -> str:
    return f"translate({text}, '{PLAIN}', '{CODED}')"


@query(
    "prompt_chain",
    f"""WITH {BAND} SELECT word, 'Here is '||word||' today.' AS sentence, {_coded("'Here is '||word||' today.'")} AS translation,
    NULL::VARCHAR AS error FROM band""",
)
def prompt_chain(spark, sf_dir):
    words = _band(spark, sf_dir).select("word").repartition(spark.sparkContext.defaultParallelism)
    return word_jobs.run_chain(words, word_jobs.simple_chain(), WordsmithProvider(), "smith", AT_ONCE)


def _rating(text: str) -> str:
    return f"(('0x'||substr(md5({text}),1,2))::BIGINT % 41 / 10.0::DOUBLE + 1)"


@query(
    "judge",
    f"""WITH {SENTENCES}, s AS (SELECT doc_id, sentence_index, {_rating("'Source: '||sentence||chr(10)||'Translation: '||" + _coded('sentence'))} AS score FROM sentences)
    SELECT doc_id, sentence_index, score, CASE WHEN score >= 4 THEN 'good' WHEN score >= 2.5 THEN 'acceptable' ELSE 'poor' END AS label,
    'rated' AS reasoning, NULL::VARCHAR AS error FROM s""",
)
def judge(spark, sf_dir):
    rows = sentences(spark, sf_dir).withColumn("translation", F.translate("sentence", PLAIN, CODED))
    rated = word_jobs.judge(rows, WordsmithProvider(), "smith", "sentence", "translation", policy=AT_ONCE)
    return rated.select("doc_id", "sentence_index", "judgement.*")


ATTEMPTS = 2


@query(
    "word_dataset",
    f"""WITH {BAND}, r AS (SELECT word, row_number() OVER (ORDER BY n, word) - 1 AS rank FROM band),
    todo AS (SELECT word, rank*{ATTEMPTS}+a AS "index" FROM r, range({ATTEMPTS}) t(a) WHERE md5((rank*{ATTEMPTS}+a)::VARCHAR) NOT LIKE '0%'),
    p AS (SELECT *, md5(word) LIKE '0%' AS bad, word||' kind' AS d FROM todo),
    q AS (SELECT *, 'Here is '||word||' today.' AS s, replace('Here is '||word||' today.', word, d) AS sub FROM p),
    x AS (SELECT *, {_coded('d')} AS td, {_coded('sub')} AS ts FROM q)
    SELECT "index", word, CASE WHEN bad THEN '' ELSE s END AS english_sentence, CASE WHEN bad THEN '' ELSE td END AS kinyarwanda_word_translation,
    CASE WHEN bad THEN '' ELSE ts END AS kinyarwanda_sentence_translation, CASE WHEN bad THEN '' ELSE d END AS substituted_word,
    CASE WHEN bad THEN '' ELSE sub END AS substituted_sentence,
    CASE WHEN NOT bad THEN {_rating("'Source: '||d||chr(10)||'Translation: '||td")} END AS kinyarwanda_word_score,
    CASE WHEN NOT bad THEN {_rating("'Source: '||sub||chr(10)||'Translation: '||ts")} END AS kinyarwanda_sentence_score,
    CASE WHEN bad THEN 'descriptive_word: no synonym found' ELSE '' END AS error FROM x""",
)
def word_dataset(spark, sf_dir):
    """Words of a commonality band, some attempts saved before; failed words stay in the result."""
    words = _band(spark, sf_dir).select("word", "n")
    indexed = materialize(attempt_indices(words, ATTEMPTS, [F.col("n"), F.col("word")]).select("index", "word"))
    saved = indexed.filter(F.md5(F.col("index").cast("string")).startswith("0")).withColumn("error", F.lit(""))
    return word_jobs.word_dataset(indexed, WordsmithProvider(), "smith", saved, policy=AT_ONCE).drop("full_output")


@query(
    "word_failures",
    f"""WITH {BAND}, r AS (SELECT word, row_number() OVER (ORDER BY n, word) - 1 AS rank FROM band),
    todo AS (SELECT word, rank*{ATTEMPTS}+a AS i FROM r, range({ATTEMPTS}) t(a) WHERE md5((rank*{ATTEMPTS}+a)::VARCHAR) NOT LIKE '0%')
    SELECT word, count(*) AS failures, count(*) = {ATTEMPTS} AS all_failed FROM todo WHERE md5(word) LIKE '0%' GROUP BY 1""",
)
def word_failures(spark, sf_dir):
    """Failures of a run of the word job: some words fail at every attempt, of some one attempt was saved before."""
    return aggregates.word_failures(word_dataset(spark, sf_dir), ATTEMPTS)
