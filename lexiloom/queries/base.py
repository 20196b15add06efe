"""The registry and the inputs its queries share, as DataFrames and as SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.functions.languages import Language, LanguagePair
from lexiloom.operators.combine import expand_directions, explode_sentences
from lexiloom.queries.standins import CODED, PLAIN, cipher_backward, cipher_forward, drop_below
from lexiloom.session import dealt, ship_package

PAIR = LanguagePair(Language("en", "English", "eng_Latn", "en"), Language("fr", "French", "fra_Latn", "fr"))


@dataclass(frozen=True)
class Entry:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Entry] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        if name in REGISTRY:
            raise ValueError(f"query {name!r} registered twice")

        @wraps(run)
        def start(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return run(spark, sf_dir)

        REGISTRY[name] = Entry(start, sql)
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, read as it is."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def input_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select(
        F.col("doc_id").alias("_original_index"), "text", F.col("lang").alias("language"), "source"
    )


INPUT = "input AS (SELECT doc_id AS _original_index, text, lang AS language, source FROM documents)"


def sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_sentences(documents(spark, sf_dir).select("doc_id", "lang", "source", "text"))


def split_sql(text: str) -> str:
    """Sentence split without look-behind: guard the exceptions, then cut, then drop the guards."""
    return rf"""list_filter(list_transform(regexp_split_to_array(
    regexp_replace(regexp_replace(regexp_replace({text},
      '([A-Z][a-z]\.)(\s)', '\1'||chr(2)||'\2','g'),
      '([\pL\pN_]\.[\pL\pN_][.?!])(\s)', '\1'||chr(2)||'\2','g'),
      '([.?!])\s+', '\1'||chr(1),'g'), chr(1)),
    lambda x: trim(replace(x,chr(2),''), ' '||chr(10)||chr(9)||chr(13))), lambda x: x<>'')"""


SENTENCES = f"""split_docs AS (SELECT doc_id, lang, source, {split_sql('text')} AS parts FROM documents),
sentences AS (SELECT doc_id, lang, source, unnest(range(len(parts)))::INT AS sentence_index,
  unnest(parts) AS sentence FROM split_docs)"""


def words_sql(text: str) -> str:
    return rf"list_filter(regexp_split_to_array({text}, '\s+'), lambda w: w<>'')"


def forward_sql(text: str, tenths: str) -> str:
    """Words kept at a temperature (in tenths, an SQL expression), letters replaced."""
    limits = ", ".join(f"'{drop_below(t)}'" for t in range(11))
    kept = (
        f"list_filter({words_sql(text)}, lambda w, i: i=1 OR "
        f"md5(({tenths})::VARCHAR||'|'||(i-1)||'|'||w) >= ([{limits}])[({tenths})+1])"
    )
    return f"translate(array_to_string({kept}, ' '), '{PLAIN}', '{CODED}')"


def backward_sql(text: str) -> str:
    return f"translate({text}, '{CODED}', '{PLAIN}')"


def hash_number(key: Column) -> Column:
    """First 32 bits of the key's digest as a number."""
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long")


def hash_sql(key: str) -> str:
    return f"('0x'||substr(md5({key}),1,8))::BIGINT"


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentence results with a score made from a digest; some scores are null, one file has none.

    Scores are multiples of a power of two, so their sums are exact and do not depend on the order of rows.
    """
    key = F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("sentence_index").cast("string"))
    missing = F.substring(F.md5(key), 9, 1).eqNullSafe("0") | (F.col("source") == "src7")
    score = F.when(~missing, (hash_number(key) % 9011 - 410) / F.lit(8192.0))
    return sentences(spark, sf_dir).select(
        F.concat("source", F.lit(".tsv")).alias("source_file"),
        "doc_id",
        "lang",
        "sentence_index",
        F.col("sentence").alias("original_sentence"),
        F.translate("sentence", PLAIN, CODED).alias("forward_translation"),
        F.col("sentence").alias("back_translation"),
        score.alias("comet_score"),
        F.lit(1.0).alias("temperature"),
    )


SCORED = f"""{SENTENCES},
scored AS (SELECT source||'.tsv' AS source_file, doc_id, lang, sentence_index, sentence AS original_sentence,
  translate(sentence, '{PLAIN}', '{CODED}') AS forward_translation, sentence AS back_translation,
  CASE WHEN substr(md5(doc_id||':'||sentence_index),9,1)='0' OR source='src7' THEN NULL
    ELSE ({hash_sql("doc_id||':'||sentence_index")} % 9011 - 410)/8192.0::DOUBLE END AS comet_score,
  1.0::DOUBLE AS temperature FROM sentences)"""

GRID = tuple(n / 10 for n in range(11))


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eleven attempts per sentence with a score of 0-100 made from a digest, some null.

    Sentences are dealt by their key before they are expanded, so that a selection by this key moves no attempts.
    """
    from lexiloom.operators.combine import expand_attempts

    keys = ["doc_id", "sentence_index"]
    grid = expand_attempts(dealt(sentences(spark, sf_dir).select(*keys), *keys), GRID)
    key = F.concat_ws(":", F.col("doc_id"), F.col("sentence_index"), F.col("attempt"))
    missing = F.substring(F.md5(key), 9, 1) == "0"
    return grid.withColumn("score", F.when(~missing, hash_number(key) % 6401 / F.lit(64.0)))


ATTEMPTS = f"""{SENTENCES},
grid AS (SELECT doc_id, sentence_index, unnest(range(11))::INT AS attempt FROM sentences),
attempts AS (SELECT *, attempt/10.0::DOUBLE AS temperature,
  CASE WHEN substr(md5(doc_id||':'||sentence_index||':'||attempt),9,1)='0' THEN NULL
   ELSE ({hash_sql("doc_id||':'||sentence_index||':'||attempt")} % 6401)/64.0::DOUBLE END AS score FROM grid)"""


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns with the assistant turn that follows, as an aligned table."""
    turns = table(spark, sf_dir, "conversations")
    asked = turns.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("sentence_en"))
    answered = turns.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("sentence_fr")
    )
    return asked.join(answered, ["conv_id", "turn"]).select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("pair_id"), "sentence_en", "sentence_fr"
    )


PAIRS = """pairs AS (SELECT u.conv_id*1000+u.turn AS pair_id, u.text AS sentence_en, a.text AS sentence_fr
  FROM conversations u JOIN conversations a ON a.conv_id=u.conv_id AND a.turn-1=u.turn
  WHERE u.role='user' AND a.role='assistant')"""


def directed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both directions with a translation: the target without some words, or a failure mark."""
    both = expand_directions(pairs(spark, sf_dir), "sentence_en", "sentence_fr", ("en", "fr"))
    key = F.concat(F.col("pair_id").cast("string"), F.col("direction"))
    failed = F.md5(key).startswith("0")
    lossy = cipher_backward(cipher_forward(F.col("target"), 5))
    return both.withColumn(
        "translation", F.when(failed, F.lit("[ERROR after 3 attempts: empty translation]")).otherwise(lossy)
    )


DIRECTED = f"""{PAIRS},
both_directions AS (SELECT pair_id, 'en->fr' AS direction, sentence_en AS source, sentence_fr AS target FROM pairs
  UNION ALL SELECT pair_id, 'fr->en', sentence_fr, sentence_en FROM pairs),
directed AS (SELECT *, CASE WHEN md5(pair_id||direction) LIKE '0%'
   THEN '[ERROR after 3 attempts: empty translation]'
   ELSE {backward_sql(forward_sql('target', '5'))} END AS translation FROM both_directions)"""


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})
