"""Scans and sinks: every query writes a driver table to the shared folder and reads it back."""

from __future__ import annotations

import pandas as pd

from pyspark.sql import functions as F

from lexiloom.operators.combine import union_aligned
from lexiloom.operators.joins import pending_rows
from lexiloom.operators.ordering import reconstruct_documents
from lexiloom.queries.base import (
    DIRECTED,
    PAIRS,
    SCORED,
    SENTENCES,
    directed,
    documents,
    pairs,
    query,
    rounded,
    scored,
    sentences,
    table,
    words_sql,
)
from lexiloom.queries.standins import CODED, PLAIN
from lexiloom.session import scratch_path, written
from lexiloom.sources import committed, readers, writers

DOCUMENT_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
FORMATS = ("csv", "json", "parquet")


@query(
    "read_table",
    "SELECT f AS format, doc_id, text, lang, source, n_chars FROM documents, (VALUES ('csv'),('json'),('parquet')) v(f)",
)
def read_table(spark, sf_dir):
    docs = documents(spark, sf_dir)
    tables = []
    for fmt in FORMATS:
        path = f"{scratch_path(spark, 'table')}/docs.{fmt}"
        writers.save_table(docs, path, fmt)
        tables.append(readers.read_table(spark, path, DOCUMENT_SCHEMA).withColumn("format", F.lit(fmt)))
    return union_aligned(tables)


@query(
    "save_table",
    "SELECT f AS format, lang, count(*) AS rows, sum(n_chars)::BIGINT AS chars FROM documents, (VALUES ('csv'),('json'),('parquet')) v(f) GROUP BY ALL",
)
def save_table(spark, sf_dir):
    docs = documents(spark, sf_dir)
    tables = []
    for fmt in FORMATS:
        path = f"{scratch_path(spark, 'table')}/docs.{fmt}"
        writers.save_table(docs, path, fmt)
        tables.append(readers.read_table(spark, path, DOCUMENT_SCHEMA).withColumn("format", F.lit(fmt)))
    return union_aligned(tables).groupBy("format", "lang").agg(
        F.count("*").alias("rows"), F.sum("n_chars").alias("chars")
    )


RESULT_COLUMNS = (
    "source_file, sentence_index, original_sentence, forward_translation, back_translation, comet_score, temperature"
)


def _result_folder(spark, sf_dir) -> str:
    """Sentence results as ``*.tsv`` files, some per source, below folders of that source."""
    path = scratch_path(spark, "tsv_results")
    rows = scored(spark, sf_dir).select("source_file", *RESULT_COLUMNS.split(", ")[1:])
    (
        rows.hint("rebalance", "source_file")
        .write.options(**writers.CSV_OPTIONS)
        .option("sep", "\t")
        .option("compression", "none")
        .partitionBy("source_file")
        .csv(path)
    )
    return path


@query("scan_result_folder", f"WITH {SCORED} SELECT {RESULT_COLUMNS} FROM scored")
def scan_result_folder(spark, sf_dir):
    """Spark names part files itself, so a row's file is the folder its part lies in."""
    path = _result_folder(spark, sf_dir)
    rows, _ = readers.scan_results(spark, path, pattern="*.csv")
    file = F.regexp_extract(F.col("_metadata.file_path"), r"source_file=([^/]+)/", 1)
    return rows.withColumn("source_file", file).select(*RESULT_COLUMNS.split(", "))


def _export_text_files(spark, sf_dir) -> str:
    """One ``row_{id}.txt`` per document, written by the tasks that hold the documents."""
    path = scratch_path(spark, "seed")

    def write(batches):
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(path if "://" in path else f"file://{path.removeprefix('file:')}")
        system.create_dir(base, recursive=True)
        for batch in batches:
            for doc_id, content in zip(batch["doc_id"], batch["text"]):
                with system.open_output_stream(f"{base}/row_{doc_id}.txt") as out:
                    out.write(content.encode("utf-8"))
            yield pd.DataFrame({"files": [len(batch)]})

    docs = documents(spark, sf_dir).select("doc_id", "text")
    docs.mapInPandas(write, "files long").agg(F.sum("files")).collect()
    return path


@query(
    "scan_text_folder",
    "SELECT doc_id, 'row_'||doc_id||'.txt' AS file_name, text FROM documents",
)
def scan_text_folder(spark, sf_dir):
    """Files are opened once: the sort looks at its input twice, for its bounds and for the rows."""
    found = written(readers.scan_documents(spark, _export_text_files(spark, sf_dir)), "scanned")
    return found.orderBy("file_name")


@query(
    "read_jsonl_chunks",
    """SELECT conv_id, turn, role, text, (row_number() OVER (ORDER BY conv_id, turn) - 1) // 100 AS chunk_id,
    (row_number() OVER (ORDER BY conv_id, turn) - 1) % 100 AS chunk_line FROM conversations""",
)
def read_jsonl_chunks(spark, sf_dir):
    path = scratch_path(spark, "conversations")
    table(spark, sf_dir, "conversations").orderBy("conv_id", "turn").write.json(path)
    schema = "conv_id long, turn long, role string, text string"
    return readers.read_json_chunks(spark, path, schema, 100).drop(readers.CORRUPT)


def _row_json(spark, sf_dir):
    """Documents with the result of every sentence and the counts of the document."""
    docs = documents(spark, sf_dir).select(F.col("doc_id").alias("row_id"), F.col("text").alias("original_text"))
    from lexiloom.functions.text import split_sentences

    good = lambda s: F.char_length(s) >= 40
    result = lambda s: F.struct(
        s.alias("source"),
        F.when(good(s), F.translate(s, PLAIN, CODED)).alias("translation"),
        F.when(good(s), s).alias("backtranslation"),
        F.when(good(s), F.char_length(s) / F.lit(4.0)).alias("score"),
        F.when(good(s), F.lit(0.5)).alias("temperature"),
        F.when(good(s), F.lit("accepted")).otherwise(F.lit("discarded")).alias("status"),
    )
    total = F.size("sentences").cast("long")
    done = F.size(F.filter("sentences", good)).cast("long")
    scores = F.aggregate("translated_sentences", F.lit(0.0), lambda a, r: a + F.coalesce(r["score"], F.lit(0.0)))
    metadata = F.struct(
        total.alias("total_sentences"),
        done.alias("translated_sentences"),
        (total - done).alias("discarded_sentences"),
        F.when(total > 0, done * 100.0 / total).otherwise(F.lit(0.0)).alias("success_rate"),
        F.when(done > 0, scores / done).otherwise(F.lit(0.0)).alias("avg_score"),
    )
    rows = docs.withColumn("sentences", split_sentences(F.col("original_text")))
    rows = rows.withColumn("translated_sentences", F.transform("sentences", result))
    return rows.withColumns({"reconstructed_text": F.array_join("sentences", " "), "metadata": metadata})


def _nested(rows):
    """The nested parts of saved rows as plain columns."""
    listed = lambda field, default: F.array_join(
        F.transform("translated_sentences", lambda r: F.coalesce(r[field].cast("string"), F.lit(default))), "|"
    )
    return rows.select(
        "row_id",
        F.size("sentences").alias("sentences"),
        "reconstructed_text",
        listed("source", "").alias("sources"),
        listed("translation", "-").alias("translations"),
        listed("status", "").alias("statuses"),
        F.round(F.aggregate("translated_sentences", F.lit(0.0), lambda a, r: a + F.coalesce(r["score"], F.lit(0.0))), 6).alias("score_sum"),
        "metadata.total_sentences",
        "metadata.translated_sentences",
        "metadata.discarded_sentences",
        F.round("metadata.success_rate", 6).alias("success_rate"),
        F.round("metadata.avg_score", 6).alias("avg_score"),
    )


def _row_json_sql(where: str = "true") -> str:
    good = "len(list_filter(parts, lambda s: length(s) >= 40))"
    total = "list_sum(list_transform(list_filter(parts, lambda s: length(s) >= 40), lambda s: length(s)/4.0::DOUBLE))"
    return f"""WITH {SENTENCES} SELECT doc_id AS row_id, len(parts)::INT AS sentences, array_to_string(parts, ' ') AS reconstructed_text,
    array_to_string(parts, '|') AS sources,
    array_to_string(list_transform(parts, lambda s: CASE WHEN length(s) >= 40 THEN translate(s, '{PLAIN}', '{CODED}') ELSE '-' END), '|') AS translations,
    array_to_string(list_transform(parts, lambda s: CASE WHEN length(s) >= 40 THEN 'accepted' ELSE 'discarded' END), '|') AS statuses,
    round(coalesce({total}, 0), 6) AS score_sum, len(parts)::BIGINT AS total_sentences, {good}::BIGINT AS translated_sentences,
    (len(parts) - {good})::BIGINT AS discarded_sentences,
    round(CASE WHEN len(parts) > 0 THEN {good}*100.0::DOUBLE/len(parts) ELSE 0 END, 6) AS success_rate,
    round(CASE WHEN {good} > 0 THEN {total}/{good} ELSE 0 END, 6) AS avg_score FROM split_docs WHERE {where}"""


# Saved rows that were cut off half-way: one document in twenty.
CUT_OFF = "doc_id % 20 = 7"


def _saved_rows(spark, sf_dir) -> str:
    """A folder of saved rows, some of which end in the middle."""
    path = scratch_path(spark, "rows")
    rows = _row_json(spark, sf_dir)
    writers.write_row_json(rows.filter("row_id % 20 <> 7"), f"{path}/whole")
    broken = rows.filter("row_id % 20 = 7").select(F.to_json(F.struct("*")).alias("value"))
    broken.select(F.expr("left(value, length(value) div 2)").alias("value")).write.options(lineSep="\n", **writers.PACKED).text(f"{path}/cut")
    return path


def _readable(rows):
    return rows.filter(F.col(readers.CORRUPT).isNull()).drop(readers.CORRUPT)


@query("scan_row_json", _row_json_sql(f"NOT ({CUT_OFF})"))
def scan_row_json(spark, sf_dir):
    """Rows that can be read; the cut-off ones are left over."""
    found = readers.scan_row_json(spark, _saved_rows(spark, sf_dir), "part-*", multi_line=False)
    return _nested(_readable(found))


@query("write_row_json", _row_json_sql())
def write_row_json(spark, sf_dir):
    path = scratch_path(spark, "rows")
    writers.write_row_json(_row_json(spark, sf_dir), path)
    return _nested(spark.read.schema(readers.ROW_JSON_SCHEMA).json(path))


@query("aggregate_row_json", _row_json_sql(f"NOT ({CUT_OFF})") + " ORDER BY row_id")
def aggregate_row_json(spark, sf_dir):
    """Rows saved one by one, then merged in order of their id."""
    found = readers.scan_row_json(spark, _saved_rows(spark, sf_dir), "part-*", multi_line=False)
    path = scratch_path(spark, "all_rows")
    writers.aggregate_row_json(_readable(found), path)
    return _nested(readers.scan_row_json(spark, path, "part-*", multi_line=False))


@query(
    "load_parallel_benchmark",
    f"WITH {PAIRS} SELECT pair_id, sentence_en, sentence_fr FROM pairs",
)
def load_parallel_benchmark(spark, sf_dir):
    path = f"{scratch_path(spark, 'benchmark')}/test.parquet"
    pairs(spark, sf_dir).withColumnsRenamed({"sentence_en": "en", "sentence_fr": "fr"}).write.parquet(path)
    return readers.load_parallel_benchmark(spark, path, "en", "fr")


TSV_ROWS = 200_000  # in a file: with quoted line ends a file is one task


@query(
    "read_results_tsv",
    f"""WITH {SCORED} SELECT sentence_index::VARCHAR AS sentence_index, original_sentence, forward_translation,
        back_translation, comet_score, temperature FROM scored""",
)
def read_results_tsv(spark, sf_dir):
    """All columns as text, as the saved file has them."""
    path = scratch_path(spark, "results")
    rows = scored(spark, sf_dir).select(*RESULT_COLUMNS.split(", ")[1:])
    rows.write.options(**writers.CSV_OPTIONS, maxRecordsPerFile=TSV_ROWS).option("sep", "\t").csv(path)
    schema = ", ".join(f"{name} string" for name in rows.columns)
    found = readers.read_results(spark, path, schema)
    return found.withColumns({c: F.col(c).cast("double") for c in ("comet_score", "temperature")})


@query("load_corpus", "SELECT doc_id, text FROM documents")
def load_corpus(spark, sf_dir):
    return readers.load_corpus(spark, f"{sf_dir}/documents.parquet").select("doc_id", "text")


class _Lost(Exception):
    """Ends a run between two batches."""


@query(
    "append_results",
    "SELECT doc_id, text, lang, '' AS note FROM documents",
)
def append_results(spark, sf_dir):
    """A run that is lost after three batches and a fourth one half-way, and the run that takes up the rest."""
    table = committed.CommittedTable(spark, scratch_path(spark, "appended"))
    docs = documents(spark, sf_dir)
    done = 0

    def lay_out(part):
        nonlocal done
        done += 1
        if done == 4:
            table.stage(writers.laid_out(part, RESULT_LAYOUT), "lost", 3)  # written, never committed
            raise _Lost
        return writers.laid_out(part, RESULT_LAYOUT)

    try:
        committed.append_as_completed(docs, table, lay_out, "doc_id")
    except _Lost:
        committed.append_as_completed(pending_rows(docs, table.read(), "doc_id", retry_failed=False), table, lay_out, "doc_id", 2)
    return table.read()


RESULT_LAYOUT = ["doc_id", "text", "lang", "note"]


LENGTH_SQL = f"""WITH m AS (SELECT len({words_sql('text')}) AS w, len(regexp_extract_all(text, '.+?[.!?]+')) AS s FROM documents)
    SELECT round(avg(w),6) AS mean_words, min(w)::INT AS min_words, max(w)::INT AS max_words,
    round(avg(s),6) AS mean_sentences, min(s)::INT AS min_sentences, max(s)::INT AS max_sentences FROM m"""


@query("write_seed_rows", LENGTH_SQL)
def write_seed_rows(spark, sf_dir):
    profile = writers.write_seeds(documents(spark, sf_dir).select("doc_id", "text"), scratch_path(spark, "seeds"))
    return rounded(profile, "mean_words", "mean_sentences")


@query("write_results_tsv", f"WITH {SCORED} SELECT doc_id, {RESULT_COLUMNS.replace('source_file, ', '')} FROM scored")
def write_results_tsv(spark, sf_dir):
    path = scratch_path(spark, "results")
    writers.write_results(scored(spark, sf_dir), path)
    return readers.read_results(spark, path, f"doc_id long, {readers.RESULT_SCHEMA}").drop("bucket")


@query(
    "write_documents",
    f"WITH {SENTENCES} SELECT doc_id, array_to_string(parts, ' ') AS reconstructed_text FROM split_docs WHERE len(parts) > 0",
)
def write_documents(spark, sf_dir):
    path = scratch_path(spark, "translation")
    writers.write_documents(reconstruct_documents(sentences(spark, sf_dir), text="sentence"), path)
    return spark.read.parquet(path)


@query(
    "write_direction_csv",
    f"WITH {DIRECTED} SELECT pair_id, replace(direction,'->','-') AS direction, source, target, translation FROM directed",
)
def write_direction_csv(spark, sf_dir):
    path = scratch_path(spark, "directions")
    writers.write_directions(directed(spark, sf_dir), path)
    return (
        spark.read.options(**readers.CSV_OPTIONS)
        .schema("pair_id long, source string, target string, translation string, direction string")
        .csv(path)
    )


@query(
    "publish_splits",
    r"""SELECT doc_id AS id, trim(text, ' '||chr(9)||chr(10)) AS text,
    CASE WHEN ('0x'||substr(md5('42|'||doc_id),1,8))::BIGINT < floor(0.05::DOUBLE*4294967296) THEN 'dev' ELSE 'train' END AS split
    FROM documents WHERE trim(text, ' '||chr(9)||chr(10)) <> ''""",
)
def publish_splits(spark, sf_dir):
    from lexiloom.functions.text import strip
    from lexiloom.operators.filters import drop_blank_text

    path = scratch_path(spark, "published")
    docs = drop_blank_text(documents(spark, sf_dir)).select(F.col("doc_id").alias("id"), strip(F.col("text")).alias("text"))
    writers.publish_splits(docs, path, ["id"], 0.05)
    return spark.read.parquet(path)
