"""Projections and scalar functions."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from lexiloom.functions import budgets, languages, prompts, responses, results, text
from lexiloom.operators.combine import align_languages, explode_parts
from lexiloom.queries.standins import CODED, PLAIN
from lexiloom.queries.base import (
    DIRECTED,
    INPUT,
    PAIR,
    SCORED,
    SENTENCES,
    directed,
    documents,
    hash_number,
    hash_sql,
    input_text,
    query,
    scored,
    sentences,
    words_sql,
)

CHUNK_WORDS = 100


@query("sentence_split", f"WITH {SENTENCES} SELECT doc_id, sentence_index, sentence FROM sentences")
def sentence_split(spark, sf_dir):
    return sentences(spark, sf_dir).select("doc_id", "sentence_index", "sentence")


@query("word_count", f"SELECT doc_id, len({words_sql('text')})::INT AS words FROM documents")
def word_count(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", text.word_count(F.col("text")).alias("words"))


@query(
    "sentence_count",
    "SELECT doc_id, len(regexp_extract_all(text, '.+?[.!?]+'))::INT AS sentences FROM documents",
)
def sentence_count(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", text.sentence_count(F.col("text")).alias("sentences"))


@query(
    "normalize_text",
    "SELECT doc_id, regexp_replace(lower(text), '[[:punct:]]', '', 'g') AS normalized FROM documents",
)
def normalize_text(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", text.normalize(F.col("text")).alias("normalized"))


@query(
    "chunk_text",
    rf"""WITH RECURSIVE w AS (SELECT doc_id, text, {words_sql('text')} AS words FROM documents),
    ends AS (SELECT doc_id, unnest(list_filter(list_transform(words, lambda w, i:
        CASE WHEN regexp_matches(w, '[.!?]$') THEN i END), lambda e: e IS NOT NULL)) AS e FROM w),
    points AS (SELECT doc_id, e FROM ends UNION ALL SELECT doc_id, 0 FROM w),
    links AS MATERIALIZED (SELECT p.doc_id, p.e, n.e AS nxt FROM points p ASOF JOIN ends n
        ON p.doc_id = n.doc_id AND p.e + {CHUNK_WORDS} <= n.e),
    cuts AS (SELECT doc_id, 0::BIGINT AS cut FROM w WHERE len(words) > {CHUNK_WORDS}
        UNION ALL SELECT c.doc_id, l.nxt FROM cuts c JOIN links l ON l.doc_id = c.doc_id AND l.e = c.cut),
    bounds AS (SELECT c.doc_id, c.cut, coalesce(lead(c.cut) OVER (PARTITION BY c.doc_id ORDER BY c.cut), len(w.words)) AS upto,
        row_number() OVER (PARTITION BY c.doc_id ORDER BY c.cut) - 1 AS chunk_index, w.words
        FROM cuts c JOIN w USING (doc_id))
    SELECT doc_id, chunk_index::INT AS chunk_index, array_to_string(words[cut+1:upto], ' ') AS chunk
    FROM bounds WHERE upto > cut
    UNION ALL SELECT doc_id, 0::INT, text FROM w WHERE len(words) <= {CHUNK_WORDS}""",
)
def chunk_text(spark, sf_dir):
    chunked = text.with_chunks(documents(spark, sf_dir).select("doc_id", "text"), "text", "chunks", CHUNK_WORDS)
    return explode_parts(chunked, F.col("chunks"), ("chunk_index", "chunk"), ["text", "chunks"])


@query(
    "chunk_rejoin",
    f"""WITH w AS (SELECT doc_id, text, {words_sql('text')} AS words FROM documents)
    SELECT doc_id, CASE WHEN len(words) <= {CHUNK_WORDS} THEN translate(text, '{PLAIN}', '{CODED}')
      ELSE translate(array_to_string(words, ' '), '{PLAIN}', '{CODED}') END AS translation FROM w""",
)
def chunk_rejoin(spark, sf_dir):
    chunked = text.with_chunks(documents(spark, sf_dir).select("doc_id", "text"), "text", "chunks", CHUNK_WORDS)
    mapped = F.transform("chunks", lambda c: F.translate(c, PLAIN, CODED))
    return chunked.select("doc_id", text.join_parts(mapped).alias("translation"))


BUDGET_SQL = (
    "least(greatest(floor((len(w)*1.3::DOUBLE*3.5::DOUBLE*1.5::DOUBLE + 511)/512)*512, 512), 16384)::BIGINT"
)


@query(
    "token_budget",
    f"WITH t AS (SELECT doc_id, {words_sql('text')} AS w FROM documents) SELECT doc_id, {BUDGET_SQL} AS budget FROM t",
)
def token_budget(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", budgets.token_budget(F.col("text")).alias("budget"))


@query(
    "budget_tiers",
    f"""WITH t AS (SELECT doc_id, {words_sql('text')} AS w FROM documents), b AS (SELECT doc_id, {BUDGET_SQL} AS b FROM t)
    SELECT doc_id, b AS tier_1, least(2*b, 16384)::BIGINT AS tier_2, least(4*b, 16384)::BIGINT AS tier_3 FROM b""",
)
def budget_tiers(spark, sf_dir):
    tiers = documents(spark, sf_dir).select(
        "doc_id", budgets.budget_tiers(budgets.token_budget(F.col("text"))).alias("t")
    )
    return tiers.select("doc_id", *[F.col("t")[i].alias(f"tier_{i + 1}") for i in range(3)])


@query(
    "batch_token_cap",
    """SELECT doc_id, doc_id // 32 AS batch_id,
       least(4096, 2 * max(length(text)) OVER (PARTITION BY doc_id // 32))::INT AS cap FROM documents""",
)
def batch_token_cap(spark, sf_dir):
    batched = documents(spark, sf_dir).withColumn("batch_id", F.floor(F.col("doc_id") / 32))
    return batched.select(
        "doc_id", "batch_id", budgets.batch_cap(F.char_length("text"), ["batch_id"], 4096).alias("cap")
    )


def _labelled():
    """Sentences as answers: with labels, padded, blank or plain, by their digest."""
    kind = F.substring(F.md5("sentence"), 1, 1)
    return (
        F.when(kind == "0", F.concat(F.lit("Translation: "), "sentence"))
        .when(kind == "1", F.concat(F.lit("answer:\n"), "sentence"))
        .when(kind == "2", F.concat(F.lit("Answer:"), "sentence"))
        .when(kind == "3", F.concat(F.lit("  \n"), "sentence", F.lit(" \t")))
        .when(kind == "4", F.lit(" \n"))
        .when(kind == "5", F.lit("translation: "))
        .otherwise(F.col("sentence"))
    )


LABELLED = f"""{SENTENCES},
labelled AS (SELECT doc_id, sentence_index, sentence, CASE substr(md5(sentence),1,1)
  WHEN '0' THEN 'Translation: '||sentence WHEN '1' THEN 'answer:'||chr(10)||sentence
  WHEN '2' THEN 'Answer:'||sentence WHEN '3' THEN '  '||chr(10)||sentence||' '||chr(9)
  WHEN '4' THEN ' '||chr(10) WHEN '5' THEN 'translation: ' ELSE sentence END AS answer FROM sentences)"""


@query(
    "strip_label",
    rf"""WITH {LABELLED} SELECT doc_id, sentence_index,
    CASE WHEN regexp_matches(answer, '^([Tt]ranslation|[Aa]nswer):')
      THEN trim(regexp_replace(answer, '^([Tt]ranslation|[Aa]nswer):\s*', ''), ' '||chr(9)||chr(10))
      ELSE answer END AS answer FROM labelled""",
)
def strip_label(spark, sf_dir):
    labelled = sentences(spark, sf_dir).withColumn("answer", _labelled())
    return labelled.select("doc_id", "sentence_index", responses.strip_label(F.col("answer")).alias("answer"))


@query(
    "clean_response",
    rf"""WITH {LABELLED} SELECT doc_id, sentence_index, nullif(trim(regexp_replace(
      trim(answer, ' '||chr(9)||chr(10)), '^([Tt]ranslation|[Aa]nswer):\s*', ''), ' '||chr(9)||chr(10)), '') AS answer
    FROM labelled""",
)
def clean_response(spark, sf_dir):
    labelled = sentences(spark, sf_dir).withColumn("answer", _labelled())
    return labelled.select("doc_id", "sentence_index", responses.clean_response(F.col("answer")).alias("answer"))


@query(
    "extract_response",
    f"""WITH d AS (SELECT *, substr(md5(doc_id::VARCHAR),1,1) AS k FROM documents)
    SELECT doc_id,
      CASE WHEN k IN ('0','1') THEN NULL WHEN k IN ('2','3') THEN 'last thought' WHEN k='4' THEN NULL
        ELSE nullif(trim(text, ' '||chr(9)||chr(10)), '') END AS value,
      CASE WHEN k IN ('0','1') THEN '{responses.TRUNCATED}' WHEN k='4' THEN '{responses.EMPTY}' END AS error
    FROM d""",
)
def extract_response(spark, sf_dir):
    kind = F.substring(F.md5(F.col("doc_id").cast("string")), 1, 1)
    payload = F.to_json(
        F.struct(
            F.when(kind.isin("2", "3", "4"), F.lit(" ")).otherwise(F.col("text")).alias("response"),
            F.when(kind.isin("2", "3"), F.lit("first idea\n\n last thought \n\n  ")).alias("thinking"),
            F.when(kind.isin("0", "1"), F.lit("length")).otherwise(F.lit("stop")).alias("done_reason"),
        )
    )
    answered = documents(spark, sf_dir).select("doc_id", responses.extract_response(payload).alias("r"))
    return answered.select("doc_id", "r.value", "r.error")


@query(
    "parse_judge_json",
    f"""WITH {SENTENCES}, k AS (SELECT doc_id, sentence_index, sentence, substr(md5(sentence),1,1) AS k,
        ({hash_sql('sentence')} % 51)/10.0::DOUBLE AS s FROM sentences),
    v AS (SELECT *, CASE WHEN k IN ('0','1') THEN NULL WHEN k='2' THEN 0.0::DOUBLE ELSE s END AS score FROM k)
    SELECT doc_id, sentence_index, score, CASE WHEN score >= 4 THEN 'good' WHEN score >= 2.5 THEN 'acceptable'
      WHEN score IS NOT NULL THEN 'poor' END AS label,
      CASE WHEN score IS NULL THEN NULL WHEN k='2' THEN '' ELSE sentence END AS reasoning,
      CASE WHEN score IS NULL THEN 'unreadable judge answer' END AS error FROM v""",
)
def parse_judge_json(spark, sf_dir):
    kind = F.substring(F.md5("sentence"), 1, 1)
    body = F.to_json(
        F.struct((hash_number(F.col("sentence")) % 51 / F.lit(10.0)).alias("score"), F.concat(F.lit(" "), "sentence").alias("reasoning"))
    )
    answer = (
        F.when(kind == "0", F.lit("I cannot rate this."))
        .when(kind == "1", F.lit('{"score": 3.'))
        .when(kind == "2", F.lit('```json\n{"fluency": 2.0}\n```'))
        .when(kind.isin("3", "4", "5", "6"), F.concat(F.lit("```json\n"), body, F.lit("\n```")))
        .otherwise(body)
    )
    parsed = sentences(spark, sf_dir).select("doc_id", "sentence_index", responses.parse_judge(answer).alias("j"))
    return parsed.select("doc_id", "sentence_index", "j.*")


@query(
    "judge_label",
    f"""WITH {SCORED}, s AS (SELECT doc_id, sentence_index, comet_score*5 AS score FROM scored)
    SELECT doc_id, sentence_index, CASE WHEN score >= 4 THEN 'good' WHEN score >= 2.5 THEN 'acceptable'
      WHEN score IS NOT NULL THEN 'poor' END AS label FROM s""",
)
def judge_label(spark, sf_dir):
    label = responses.judge_label(F.col("comet_score") * 5)
    return scored(spark, sf_dir).select("doc_id", "sentence_index", label.alias("label"))


@query(
    "render_prompt",
    f"""WITH {SENTENCES} SELECT doc_id, sentence_index,
    'Please translate this text from '||CASE lang WHEN 'en' THEN 'English' ELSE 'French' END||' to '||
    CASE lang WHEN 'en' THEN 'French' ELSE 'English' END||
    '. Answer with the translation alone, without labels or comments.'||chr(10)||chr(10)||'Text: {{tgt_lang}} '||sentence||
    chr(10)||chr(10)||'Translation:' AS prompt FROM sentences WHERE lang IN ('en','fr')""",
)
def render_prompt(spark, sf_dir):
    lang = F.col("lang")
    known = sentences(spark, sf_dir).filter(PAIR.is_member(lang))
    prompt = prompts.render(
        prompts.TRANSLATE_TEXT,
        src_lang=PAIR.name(lang),
        tgt_lang=PAIR.name(PAIR.target(lang)),
        sentence=F.concat(F.lit("{tgt_lang} "), "sentence"),
    )
    return known.select("doc_id", "sentence_index", prompt.alias("prompt"))


@query(
    "language_map",
    """SELECT doc_id, CASE lang WHEN 'en' THEN 'fr' WHEN 'fr' THEN 'en' END AS target,
    CASE lang WHEN 'en' THEN 'English' WHEN 'fr' THEN 'French' END AS name,
    CASE lang WHEN 'en' THEN 'eng_Latn' WHEN 'fr' THEN 'fra_Latn' END AS script_code,
    CASE WHEN lang IN ('en','fr') THEN lang END AS iso_code,
    upper(lang[1])||lang[2:] AS display FROM documents""",
)
def language_map(spark, sf_dir):
    lang = F.upper("lang")
    return documents(spark, sf_dir).select(
        "doc_id",
        PAIR.target(lang).alias("target"),
        PAIR.name(lang).alias("name"),
        PAIR.script_code(lang).alias("script_code"),
        PAIR.iso_code(lang).alias("iso_code"),
        languages.display_name(lang).alias("display"),
    )


@query(
    "model_route",
    """WITH m AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'hub/TranslateGemma-4b' WHEN doc_id % 3 = 1 THEN 'gpt-5'
        ELSE 'nllb-600M' END AS model, CASE WHEN lang='en' THEN 'Kinyarwanda' ELSE lang END AS l FROM documents)
    SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'chat' ELSE 'seq2seq' END AS backend,
    CASE WHEN doc_id % 3 = 1 THEN 1.0::DOUBLE ELSE 0.2::DOUBLE END AS temperature,
    CASE WHEN l='Kinyarwanda' THEN 'low_resource' ELSE 'general' END AS scorer FROM m""",
)
def model_route(spark, sf_dir):
    model = (
        F.when(F.col("doc_id") % 3 == 0, F.lit("hub/TranslateGemma-4b"))
        .when(F.col("doc_id") % 3 == 1, F.lit("gpt-5"))
        .otherwise(F.lit("nllb-600M"))
    )
    spoken = F.when(F.col("lang") == "en", F.lit("Kinyarwanda")).otherwise(F.col("lang"))
    return documents(spark, sf_dir).select(
        "doc_id",
        languages.backend_for(model).alias("backend"),
        languages.routed_temperature(model, F.lit(0.2)).alias("temperature"),
        languages.scorer_for(spoken).alias("scorer"),
    )


@query("direction_from_filename", "SELECT doc_id, lang||'->'||source AS direction FROM documents")
def direction_from_filename(spark, sf_dir):
    path = F.concat(F.lit("results/run.v2/"), "lang", F.lit("-"), "source", F.lit(".csv"))
    return documents(spark, sf_dir).select("doc_id", languages.direction_of_file(path).alias("direction"))


@query(
    "flatten_result",
    f"""WITH {SCORED}, r AS (SELECT *, CASE WHEN comet_score IS NULL THEN 'no score' END AS e FROM scored)
    SELECT doc_id*1000000+sentence_index AS "index", lang AS word,
    CASE WHEN e IS NULL THEN original_sentence ELSE '' END AS english_sentence,
    CASE WHEN e IS NULL THEN source_file ELSE '' END AS kinyarwanda_word_translation,
    CASE WHEN e IS NULL THEN forward_translation ELSE '' END AS kinyarwanda_sentence_translation,
    CASE WHEN e IS NULL THEN lang ELSE '' END AS substituted_word,
    CASE WHEN e IS NULL THEN back_translation ELSE '' END AS substituted_sentence,
    comet_score AS kinyarwanda_word_score, comet_score AS kinyarwanda_sentence_score,
    coalesce(e, '') AS error, CASE WHEN e IS NULL THEN original_sentence END AS out_sentence, CASE WHEN e IS NULL THEN source_file END AS out_term,
    CASE WHEN e IS NULL THEN forward_translation END AS out_translation, CASE WHEN e IS NULL THEN lang END AS out_word,
    CASE WHEN e IS NULL THEN back_translation END AS out_substituted, CASE WHEN e IS NULL THEN comet_score END AS out_word_score,
    CASE WHEN e IS NULL THEN comet_score END AS out_sentence_score FROM r""",
)
def flatten_result(spark, sf_dir):
    """The whole object that ``full_output`` holds, next to the flat columns."""
    names = {
        "original_sentence": "out_sentence",
        "translated_descriptive_word": "out_term",
        "translated_substituted_sentence": "out_translation",
        "descriptive_word": "out_word",
        "substituted_sentence": "out_substituted",
        "word_score": "out_word_score",
        "sentence_score": "out_sentence_score",
    }
    schema = ", ".join(f"{n} {'double' if n.endswith('score') else 'string'}" for n in names)
    flat = _flattened(spark, sf_dir).withColumn("_output", F.from_json("full_output", schema))
    return flat.withColumns({out: F.col(f"_output.{n}") for n, out in names.items()}).drop("full_output", "_output")


def _flattened(spark, sf_dir):
    result = F.struct(
        F.col("original_sentence"),
        F.col("source_file").alias("translated_descriptive_word"),
        F.col("forward_translation").alias("translated_substituted_sentence"),
        F.col("lang").alias("descriptive_word"),
        F.col("back_translation").alias("substituted_sentence"),
        F.col("comet_score").alias("word_score"),
        F.col("comet_score").alias("sentence_score"),
    )
    error = F.when(F.col("comet_score").isNull(), F.lit("no score"))
    index = F.col("doc_id") * 1000000 + F.col("sentence_index")
    return scored(spark, sf_dir).select(*results.flatten_result(index, F.col("lang"), result, error))


@query(
    "error_row",
    f"""WITH {SCORED} SELECT doc_id*1000000+sentence_index AS "index", lang AS word, '' AS english_sentence,
    NULL::DOUBLE AS kinyarwanda_word_score, '' AS full_output, 'no score' AS error FROM scored WHERE comet_score IS NULL""",
)
def error_row(spark, sf_dir):
    failed = _flattened(spark, sf_dir).filter(F.col("error") != "")
    return failed.select("index", "word", "english_sentence", "kinyarwanda_word_score", "full_output", "error")


@query(
    "metric_by_name",
    f"""WITH {SCORED} SELECT doc_id, sentence_index, CASE WHEN lang='en' THEN comet_score END AS score,
        NULL::DOUBLE AS missing FROM scored""",
)
def metric_by_name(spark, sf_dir):
    def entry(name, value):
        return F.struct(F.lit(name).alias("name"), value.alias("score"))

    value = F.col("comet_score")
    metrics = F.when(
        F.col("lang") == "en", F.array(entry("BLEU-4", F.lit(1.0)), entry("COMET", value), entry("COMET", F.lit(9.0)))
    ).otherwise(F.array(entry("BLEU-4", F.lit(1.0))))
    return scored(spark, sf_dir).select(
        "doc_id",
        "sentence_index",
        results.metric_by_name(metrics, "COMET").alias("score"),
        results.metric_by_name(metrics, "chrF").alias("missing"),
    )


@query(
    "overall_metric_mean",
    f"""WITH {SCORED} SELECT doc_id, sentence_index, round((length(original_sentence)+comet_score)/2, 6) AS overall,
    round((length(original_sentence)/100.0::DOUBLE+comet_score)/2, 6) AS overall_scaled FROM scored
    WHERE comet_score IS NOT NULL""",
)
def overall_metric_mean(spark, sf_dir):
    metrics = F.array(
        F.struct(F.lit("BLEU-4").alias("name"), F.char_length("original_sentence").cast("double").alias("score")),
        F.struct(F.lit("COMET").alias("name"), F.col("comet_score").alias("score")),
    )
    return (
        scored(spark, sf_dir)
        .filter(F.col("comet_score").isNotNull())
        .select(
            "doc_id",
            "sentence_index",
            F.round(results.overall_mean(metrics), 6).alias("overall"),
            F.round(results.overall_mean_scaled(metrics, {"BLEU-4": 100.0}), 6).alias("overall_scaled"),
        )
    )


@query(
    "align_language_columns",
    f"""WITH {SCORED}, p AS (SELECT *, lang AS src_lang, CASE lang WHEN 'en' THEN 'fr' ELSE 'en' END AS tgt_lang
      FROM scored WHERE lang IN ('en','fr'))
    SELECT CASE WHEN src_lang='en' THEN original_sentence ELSE forward_translation END AS en,
    CASE WHEN src_lang='fr' THEN original_sentence ELSE forward_translation END AS fr,
    comet_score AS score, temperature, src_lang, tgt_lang FROM p""",
)
def align_language_columns(spark, sf_dir):
    known = scored(spark, sf_dir).filter(PAIR.is_member(F.col("lang")))
    tagged = known.withColumns({"src_lang": F.col("lang"), "tgt_lang": PAIR.target(F.col("lang"))})
    return align_languages(tagged, PAIR.keys())


@query(
    "rename_validate",
    f"WITH {DIRECTED} SELECT pair_id, direction, source, target, translation FROM directed",
)
def rename_validate(spark, sf_dir):
    old = directed(spark, sf_dir).withColumnsRenamed({"source": "source_text", "target": "reference"})
    renamed = results.rename_and_require(
        old, {"source_text": "source", "reference": "target"}, ["direction", "source", "target", "translation"]
    )
    return renamed.select("pair_id", "direction", "source", "target", "translation")


@query(
    "tag_literals",
    f"WITH {INPUT} SELECT _original_index, 'cipher' AS model_name, 'en' AS src_lang, 'fr' AS tgt_lang, 'en->fr' AS direction FROM input",
)
def tag_literals(spark, sf_dir):
    return input_text(spark, sf_dir).select(
        "_original_index",
        F.lit("cipher").alias("model_name"),
        F.lit("en").alias("src_lang"),
        F.lit("fr").alias("tgt_lang"),
        languages.direction(F.lit("en"), F.lit("fr")).alias("direction"),
    )


@query("preview", "SELECT doc_id, text[1:80] AS short, text[1:100] AS long FROM documents")
def preview(spark, sf_dir):
    return documents(spark, sf_dir).select(
        "doc_id", text.preview(F.col("text")).alias("short"), text.preview(F.col("text"), 100).alias("long")
    )


@query(
    "is_error",
    f"WITH {DIRECTED} SELECT pair_id, direction, translation LIKE '[ERROR%' OR translation LIKE 'Error:%' AS failed FROM directed",
)
def is_error(spark, sf_dir):
    return directed(spark, sf_dir).select(
        "pair_id", "direction", responses.is_error(F.col("translation")).alias("failed")
    )


@query(
    "run_metadata",
    f"WITH {INPUT} SELECT _original_index, 'run-1' AS run_id, 'cipher' AS provider, TRUE AS stamped, TRUE AS timed FROM input",
)
def run_metadata(spark, sf_dir):
    started = datetime.now(timezone.utc) - timedelta(seconds=2)
    tagged = results.run_metadata(input_text(spark, sf_dir), "run-1", "cipher", started)
    return tagged.select(
        "_original_index",
        "run_id",
        "provider",
        F.col("created_at").isNotNull().alias("stamped"),
        F.col("duration_ms").between(2_000, 600_000).alias("timed"),
    )


@query(
    "guards",
    f"""WITH {SCORED}, g AS (SELECT doc_id, sentence_index, comet_score*2.5 AS t, lang,
        CASE WHEN sentence_index % 7 = 0 THEN ' ' ELSE original_sentence END AS word FROM scored)
    SELECT doc_id, sentence_index, CASE WHEN word=' ' THEN 'blank word'
      WHEN t IS NULL OR t < 0 OR t > 2 THEN 'temperature out of range'
      WHEN lang='fr' THEN 'same source and target language' END AS problem FROM g""",
)
def guards(spark, sf_dir):
    problem = results.row_problem(
        word=F.when(F.col("sentence_index") % 7 == 0, F.lit(" ")).otherwise(F.col("original_sentence")),
        temperature=F.col("comet_score") * 2.5,
        source=F.col("lang"),
        target=F.lit("fr"),
    )
    return scored(spark, sf_dir).select("doc_id", "sentence_index", problem.alias("problem"))
