"""Providers, retries, resumable jobs, sources and sinks, streams."""

import json

import pandas as pd
import pytest

from pyspark.sql import functions as F

from lexiloom.functions.metrics import Chrf, add_metrics
from lexiloom.functions.languages import DEFAULT_PAIR
from lexiloom.operators.combine import expand_attempts
from lexiloom.operators.selection import early_stop_select
from lexiloom.plans import backtranslate, translate
from lexiloom.providers import CallSettings, Provider, RetryPolicy, TruncatedOutput
from lexiloom.providers.base import run_batch
from lexiloom.queries.standins import CipherProvider, cipher_backward, cipher_forward
from lexiloom.queries.base import sentences
from lexiloom.sources import committed, readers, writers
from lexiloom.streaming import jobs as streams

CIPHER = CipherProvider("English")


class Scripted(Provider):
    """Answers from a list, one per call."""

    def __init__(self, answers):
        self.answers, self.budgets = list(answers), []

    def invoke(self, text, system, config):
        self.budgets.append(config.max_tokens)
        answer = self.answers.pop(0)
        if isinstance(answer, Exception):
            raise answer
        return answer


def call(answers, tokens=None, **policy):
    waits = []
    provider = Scripted(answers)
    outcome = run_batch(
        provider, RetryPolicy(sleep=waits.append, **policy), ["t"], ["s"], [CallSettings("m", max_tokens=tokens)]
    )[0]
    return outcome, waits, provider.budgets


class Short(Provider):
    """Loses an answer in the first batch and fails as a whole in the second."""

    def __init__(self):
        self.batches = 0

    def invoke_many(self, texts, systems, configs):
        self.batches += 1
        if self.batches == 2:
            raise RuntimeError("server down")
        return texts if self.batches > 2 else texts[1:]


def test_short_and_failing_batches_are_failed_rows():
    outcomes = run_batch(Short(), RetryPolicy(attempts=2, sleep=lambda _: None, tiers=(1,)), ["a", "b"], ["", ""], [CallSettings("m")] * 2)
    assert [o.value for o in outcomes] == [None, None]
    assert all(o.error == "server down" and o.attempts == 2 for o in outcomes)
    outcomes = run_batch(Short(), RetryPolicy(attempts=3, sleep=lambda _: None), ["a", "b"], ["", ""], [CallSettings("m")] * 2)
    assert [o.value for o in outcomes] == ["a", "b"]


def test_retry_then_success_with_growing_waits():
    outcome, waits, _ = call([RuntimeError("boom"), "  ", " Translation: yes "])
    assert (outcome.value, outcome.error, outcome.attempts) == ("yes", None, 3)
    assert waits == [5.0, 10.0]


def test_rate_limits_wait_longer_and_authentication_ends_at_once():
    outcome, waits, _ = call([RuntimeError("Rate limit"), "ok"])
    assert waits == [15.0] and outcome.value == "ok"
    outcome, waits, _ = call([RuntimeError("Authentication failed"), "never"])
    assert outcome.value is None and outcome.attempts == 1 and waits == []


def test_truncation_raises_the_budget():
    cut = TruncatedOutput("cut")
    outcome, waits, budgets = call([cut, cut, "done"], tokens=6000, tiers=(1, 2, 4))
    assert outcome.value == "done" and budgets == [6000, 12000, 16384] and waits == []
    outcome, _, _ = call([cut, cut, cut], tokens=600, tiers=(1, 2, 4))
    assert outcome.value is None and "truncated" in outcome.error


def test_all_attempts_fail():
    outcome, waits, _ = call([RuntimeError("x")] * 3)
    assert (outcome.value, outcome.error, outcome.attempts) == (None, "x", 3) and waits == [5.0, 10.0]


def test_settings_are_checked():
    with pytest.raises(ValueError):
        CallSettings("m", temperature=2.1)


def test_sweep_equals_selection_over_all_attempts(spark, small):
    """Early exit inside the task gives what selecting from all attempts gives."""
    rows = sentences(spark, small).select("doc_id", "sentence_index", "sentence")
    grid = (0.0, 0.5, 1.0)
    swept = backtranslate.synth_sentences(rows, CIPHER, "English", "French", "m", temperatures=grid)
    tried = expand_attempts(rows, grid).withColumn(
        "translation",
        F.when(F.col("attempt") == 0, cipher_forward(F.col("sentence"), 0))
        .when(F.col("attempt") == 1, cipher_forward(F.col("sentence"), 5))
        .otherwise(cipher_forward(F.col("sentence"), 10)),
    )
    tried = tried.withColumn("back", cipher_backward(F.col("translation")))
    scored = add_metrics(tried, {"score": Chrf()}, "sentence", "back", "sentence").withColumn("score", F.round("score", 9))
    picked = early_stop_select(scored, ["doc_id", "sentence_index"])
    columns = ["doc_id", "sentence_index", "translation", F.round("score", 6), "temperature", "status"]
    want = sorted(map(str, picked.select(*columns).collect()))
    assert sorted(map(str, swept.select(*columns).collect())) == want


def test_sweep_gate_skips_attempts(spark):
    df = spark.createDataFrame([("a b c",)], "sentence string")
    gate = lambda texts: texts.str.contains("never").to_numpy()
    row = backtranslate.synth_sentences(df, CIPHER, "English", "French", "m", gate=gate).first()
    assert row["status"] == "discarded" and row["translation"] is None and row["score"] is None


def test_table_job_resumes(spark, tmp_path):
    data = [(1, "hello you", "english"), (2, "muraho wowe", "Kinyarwanda"), (3, "bonjour", "french"), (4, "late", "english")]
    df = spark.createDataFrame(data, "_original_index long, text string, language string")
    path = str(tmp_path / "out")
    first, failed = translate.run_translate_table(df.filter("_original_index < 4"), path, CIPHER, "m", pair=DEFAULT_PAIR)
    assert [r[0] for r in first.orderBy("_original_index").select("_original_index").collect()] == [1, 2]
    assert failed.isEmpty()
    again, _ = translate.run_translate_table(df, path, CIPHER, "m", pair=DEFAULT_PAIR)
    assert [r[0] for r in again.orderBy("_original_index").select("_original_index").collect()] == [1, 2, 4]


def test_lost_run_continues_where_it_was_committed(spark, tmp_path):
    """A run killed between two batches, or between a batch and its record, then run again, equals a single run."""
    data = [(i, f"text number {i}", "english" if i % 3 else "Kinyarwanda") for i in range(60)]
    df = spark.createDataFrame(data, "_original_index long, text string, language string")
    single, _ = translate.run_translate_table(df, str(tmp_path / "single"), CIPHER, "m", batches=5)
    path = str(tmp_path / "lost")

    class Lost(Exception):
        pass

    for method, after in (("append", 2), ("commit", 1), ("stage", 0)):
        table, left = committed.CommittedTable, [after]
        whole = getattr(table, method)

        def dies(self, *arguments):
            if left[0] == 0:
                raise Lost
            left[0] -= 1
            return whole(self, *arguments)  # noqa: B023

        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(table, method, dies)
            with pytest.raises(Lost):
                translate.run_translate_table(df, path, CIPHER, "m", batches=5)
    found = committed.CommittedTable(spark, path)
    assert 0 < found.read().count() < 60 and len(found.folders()) == 3
    saved, failed = translate.run_translate_table(df, path, CIPHER, "m", batches=5)
    assert sorted(saved.collect()) == sorted(single.collect()) and failed.isEmpty()


def test_batches_reach_the_model_whole_and_within_their_budget(spark):
    class Batched(Provider):
        """Answers with what it got in one call."""

        def invoke_many(self, texts, systems, configs):
            assert len({(s, c.max_tokens) for s, c in zip(systems, configs, strict=True)}) == 1
            return [f"{len(texts)} {max(map(len, texts))} {configs[0].max_tokens}" for _ in texts]

    data = [(i, "x" * (i * 13 % 97 + 1), "english" if i % 5 else "Kinyarwanda", i * 2) for i in range(300)]
    data += [(900, "y" * 5000, "english", 0), (901, None, "english", 1)]
    df = spark.createDataFrame(data, "_original_index long, text string, language string, other int")
    done = translate.batch_translate(df, Batched(), "m", DEFAULT_PAIR, batch_size=16, max_new_tokens=150, padded=1000).collect()
    assert sorted((r["_original_index"], r["text"], r["language"], r["other"]) for r in done) == sorted(data)
    groups = {}
    for r in done:
        groups.setdefault((r["language"], r["batch_id"], r["batch_part"]), []).append(r)
    order = []
    for (language, batch, part), rows in sorted(groups.items()):
        lengths = [len(r["text"] or "") for r in rows]
        assert len(rows) <= 16 and (len(rows) == 1 or len(rows) * max(lengths) <= 1000)
        want = f"{len(rows)} {max(lengths)} {min(150, 2 * max(lengths))}"
        assert {r["translation_text"] for r in rows} == {want} and {r["max_tokens"] for r in rows} == {min(150, 2 * max(lengths))}
        order.append((language, min(lengths), max(lengths)))
    for a, b in zip(order, order[1:]):
        assert a[0] != b[0] or a[2] <= b[1]  # similar lengths meet


def test_commits(spark, tmp_path):
    table = committed.CommittedTable(spark, str(tmp_path))
    assert table.read() is None and table.folders() == []
    for n in range(4):
        table.append(spark.range(n * 10, n * 10 + 10), f"run{n % 2}", n)
    table.stage(spark.range(1000), "lost", 9)
    assert table.read().count() == 40 and sorted(r[0] for r in table.read("run1").collect()) == [*range(10, 20), *range(30, 40)]
    table.compact(lambda df: df.filter("id % 2 = 0"))
    assert len(table.folders()) == 1 and table.read().count() == 20
    table.append(spark.range(1), "run2", 0)
    assert len(table.folders()) == 2 and table.read().count() == 21


def test_failed_rows_are_reported_and_retried(spark, tmp_path):
    class Stubborn(Provider):
        def invoke(self, text, system, config):
            if text == "bad":
                raise RuntimeError("cannot")
            return text.upper()

    df = spark.createDataFrame([(1, "good", "english"), (2, "bad", "english")], "_original_index long, text string, language string")
    path, policy = str(tmp_path / "out"), RetryPolicy(delay=0.0)
    saved, failed = translate.run_translate_table(df, path, Stubborn(), "m", policy=policy)
    assert [r["translation_text"] for r in saved.collect()] == ["GOOD"]
    assert [(r["_original_index"], r["error"], r["preview"]) for r in failed.collect()] == [(2, "cannot", "bad")]
    saved, failed = translate.run_translate_table(df, path, Stubborn(), "m", policy=policy)
    assert saved.count() == 1 and failed.count() == 1


def test_rows_without_text_are_failures_and_runs_can_be_repeated(spark, tmp_path):
    df = spark.createDataFrame([(1, "good", "english"), (2, None, "english"), (3, "", "english")], "_original_index long, text string, language string")
    path = str(tmp_path / "out")
    for _ in range(3):
        saved, failed = translate.run_translate_table(df, path, CIPHER, "m")
        keys = [r[0] for r in saved.orderBy("_original_index").select("_original_index").collect()]
        assert len(keys) == len(set(keys)) and 1 in keys and 2 not in keys
        assert (2, "no text") in [(r["_original_index"], r["error"]) for r in failed.collect()]


def test_document_job_survives_the_loss_of_its_documents(spark, tmp_path):
    docs = spark.createDataFrame([(1, "One two. Three four."), (2, " "), (3, None)], "doc_id long, text string")
    sweep = {"provider": CIPHER, "source": "English", "target": "French", "model_name": "m"}
    made = [backtranslate.run_document_job(docs, None, str(tmp_path / "r"), **sweep).orderBy("doc_id").collect() for _ in range(2)]
    assert made[0] == made[1]
    assert [(r["doc_id"], r["total_sentences"], r["reconstructed_text"] == "") for r in made[0]] == [(1, 2, False), (2, 0, True), (3, 0, True)]
    assert spark.read.parquet(str(tmp_path / "r")).count() == 2


def test_document_job_resumes(spark, tmp_path):
    docs = spark.createDataFrame([(1, "One two. Three four."), (2, "Five six!")], "doc_id long, text string")
    sweep = {"provider": CIPHER, "source": "English", "target": "French", "model_name": "m"}
    made = backtranslate.run_document_job(docs.filter("doc_id = 1"), None, str(tmp_path / "r"), **sweep)
    saved = str(tmp_path / "docs")
    made.write.parquet(saved)
    both = backtranslate.run_document_job(docs, spark.read.parquet(saved), str(tmp_path / "r"), **sweep)
    found = both.orderBy("doc_id").select("doc_id", "total_sentences").collect()
    assert [tuple(r) for r in found] == [(1, 2), (2, 1)]


def test_formats_and_unknown_extension(spark, tmp_path):
    df = spark.createDataFrame([(1, ' say "hi"\nthere, '), (2, ""), (3, None)], "id long, text string")
    for fmt in ("csv", "json", "parquet"):
        path = str(tmp_path / f"t.{fmt}")
        writers.save_table(df, path, fmt)
        back = readers.read_table(spark, path, "id long, text string")
        # An empty CSV field is null, quoted or not; the other formats keep the empty string.
        empty = None if fmt == "csv" else ""
        assert [tuple(r) for r in back.orderBy("id").collect()] == [(1, ' say "hi"\nthere, '), (2, empty), (3, None)]
    with pytest.raises(ValueError, match="Unsupported extension"):
        readers.read_table(spark, "x.xlsx")
    with pytest.raises(ValueError, match="Unknown format"):
        writers.save_table(df, str(tmp_path / "x"), "xml")


def test_saved_arrow_dataset(spark, tmp_path):
    import pyarrow as pa

    folder = tmp_path / "saved"
    folder.mkdir()
    for part in range(2):
        table = pa.table({"text": [f"a{part}", f"b{part}"], "n": [part, part + 10]})
        with pa.OSFile(str(folder / f"data-{part}.arrow"), "wb") as sink, pa.ipc.new_stream(sink, table.schema) as out:
            out.write_table(table)
    assert sorted(map(tuple, readers.read_table(spark, str(folder)).collect())) == [("a0", 0), ("a1", 1), ("b0", 10), ("b1", 11)]


def test_mixed_result_folder(spark, tmp_path):
    good = "sentence_index\toriginal_sentence\tcomet_score\n0\tx\t0.5\n"
    (tmp_path / "row_1.tsv").write_text(good)
    (tmp_path / "row_2.tsv").write_text("comet_score\tsentence_index\tunknown\n0.7\t3\tq\n")
    (tmp_path / "row_3.tsv").write_text("sentence_index\toriginal_sentence\n0\ty\n")
    (tmp_path / "row_4.tsv").write_text('comet_score\toriginal_sentence\n0.1\t"two\nlines ""q"""\nx\ty\n0.2\n0.3\t\n')
    (tmp_path / "row_5.tsv").write_bytes(b"comet_score\toriginal_sentence\n0.4\tok\n0.5\t\xff\xfe\n")
    (tmp_path / "row_6.tsv").write_text("")  # a file without a byte is not listed
    rows, rejected, skipped = readers.scan_mixed_results(spark, str(tmp_path))
    found = rows.select("source_file", "sentence_index", "original_sentence", "comet_score").collect()
    want = [
        ("row_1.tsv", 0, "x", 0.5), ("row_2.tsv", 3, None, 0.7), ("row_4.tsv", None, 'two\nlines "q"', 0.1), ("row_4.tsv", None, None, 0.3)
    ]
    assert [t for t in sorted(map(tuple, found), key=str) if t[0] != "row_5.tsv"] == want
    assert sorted(r["source_file"] for r in rejected.collect()) == ["row_4.tsv", "row_4.tsv"]
    assert sorted(r[readers.CORRUPT].strip() for r in rejected.collect()) == ["0.2", "y\t\t\tx"]
    reasons = {r["file"]: r["reason"] for r in skipped.collect()}
    assert set(reasons) == {"row_3.tsv", "row_5.tsv"} and reasons["row_3.tsv"] == "no column comet_score"
    assert "UnicodeDecodeError" in reasons["row_5.tsv"]
    (tmp_path / "none").mkdir()
    with pytest.raises(ValueError, match="No .* files"):
        readers.scan_mixed_results(spark, str(tmp_path / "none"))


def test_result_folder_names_its_files(spark, tmp_path):
    header = "\t".join(["sentence_index", "original_sentence", "forward_translation", "back_translation", "comet_score", "temperature"])
    for i in range(3):
        (tmp_path / f"row_{i}.tsv").write_text(f"{header}\n{i}\ta\tb\tc\t0.{i}\t1.0\n")
    (tmp_path / "row_3.tsv").write_text(f"{header}\nnot a number\ta\tb\tc\t0.5\t1.0\n7\ta\tb\tc\t0.7\t1.0\n")
    rows, rejected = readers.scan_results(spark, str(tmp_path))
    found = rows.select("source_file", "comet_score").orderBy("source_file").collect()
    assert [tuple(r) for r in found] == [
        ("row_0.tsv", 0.0), ("row_1.tsv", 0.1), ("row_2.tsv", 0.2), ("row_3.tsv", 0.7)
    ]
    assert rejected.count() == 1
    bad = rejected.select("source_file", readers.CORRUPT).first()
    assert bad["source_file"] == "row_3.tsv" and bad[readers.CORRUPT].startswith("not a number")
    (tmp_path / "empty").mkdir()
    with pytest.raises(ValueError, match="No .* files"):
        readers.scan_results(spark, str(tmp_path / "empty"))


def test_row_json_indented_and_unreadable(spark, tmp_path):
    whole = {"row_id": 1, "reconstructed_text": "x", "metadata": {"total_sentences": 3, "avg_score": 0.5}}
    (tmp_path / "row_1.json").write_text(json.dumps(whole, indent=2))
    (tmp_path / "row_2.json").write_text("{broken")
    found = readers.scan_row_json(spark, str(tmp_path)).cache()
    assert [r["metadata"]["total_sentences"] for r in found.filter("row_id = 1").collect()] == [3]
    assert [r[readers.CORRUPT] for r in found.filter("row_id IS NULL").collect()] == ["{broken"]


def test_json_lines_in_chunks(spark, tmp_path):
    """Chunks follow the order of files and lines, also where a file is read in many byte ranges."""
    n = 0
    for part in range(3):
        lines = []
        for _ in range(700 + part):
            lines.append("" if n % 50 == 9 else "{broken" if n % 100 == 5 else json.dumps({"id": n, "text": "x" * (n % 60)}))
            n += 1
        (tmp_path / f"part-{part}.jsonl").write_text("\n".join(lines) + "\n")
    kept = [i for i in range(n) if i % 50 != 9]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("4096", before):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            rows = readers.read_json_chunks(spark, str(tmp_path), "id long, text string", 100).orderBy("chunk_id", "chunk_line").collect()
            assert [(r["chunk_id"], r["chunk_line"]) for r in rows] == [divmod(i, 100) for i in range(len(kept))]
            assert [r["id"] for r in rows] == [None if i % 100 == 5 else i for i in kept]
            assert all((r[readers.CORRUPT] == "{broken") == (r["id"] is None) for r in rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_text_folder(spark, tmp_path):
    (tmp_path / "row_10.txt").write_text("ten\nlines")
    (tmp_path / "row_2.txt").write_text("two")
    (tmp_path / "notes.txt").write_text("other")
    rows = readers.scan_documents(spark, str(tmp_path)).orderBy("file_name").collect()
    assert [tuple(r) for r in rows] == [
        (None, "notes.txt", "other"), (10, "row_10.txt", "ten\nlines"), (2, "row_2.txt", "two")
    ]


def test_stream_restarts_from_its_checkpoint(spark, tmp_path):
    source, output, checkpoint = (str(tmp_path / n) for n in ("in", "out", "ckpt"))

    def arrive(low, high):
        spark.range(low, high).withColumnRenamed("id", "_original_index").write.mode("append").parquet(source)

    def run():
        stream = streams.file_stream(spark, source, "_original_index long", files_per_trigger=1)
        streams.dedup_stream(stream, output, checkpoint).awaitTermination()
        return sorted(r[0] for r in spark.read.parquet(output).collect())

    arrive(0, 10)
    assert run() == list(range(10))
    arrive(5, 15)
    assert run() == list(range(15))
    assert run() == list(range(15))


def test_keys_are_remembered_for_a_time_and_across_a_restart(spark, tmp_path):
    source, output, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))

    def arrive(first, last, day):
        rows = spark.range(first, last).selectExpr("id AS _original_index", f"timestamp_seconds(1700000000 + {day} * 86400) AS at")
        rows.coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = streams.file_stream(spark, source, "_original_index long, at timestamp", files_per_trigger=1)
        streams.dedup_stream(stream, output, checkpoint, event_time="at", lateness="2 days").awaitTermination()
        return sorted(r[0] for r in spark.read.parquet(output).collect())

    arrive(0, 6, 0)
    assert run() == list(range(6))
    arrive(3, 9, 1)
    assert run() == list(range(9))  # another query, the same checkpoint
    arrive(20, 21, 10)
    arrive(20, 22, 11)
    assert run() == [*range(9), 20, 21]


def test_statistics_of_a_stream_stay_compact(spark, tmp_path):
    source, output, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    total = []
    for n in range(14):
        part = [(f"f{i % 3}", None if (i + n) % 7 == 0 else (i * n % 50) / 4) for i in range(20)]
        total += part
        spark.createDataFrame(part, "source_file string, comet_score double").coalesce(1).write.mode("append").parquet(source)
    stream = streams.file_stream(spark, source, "source_file string, comet_score double", files_per_trigger=1)
    query = streams.score_stats_stream(stream, output, checkpoint, epochs=4)
    query.awaitTermination()
    assert len(list((tmp_path / "out" / "batches").iterdir())) <= 12 and len(list((tmp_path / "out" / "commits").iterdir())) <= 12
    table = committed.CommittedTable(spark, output)
    assert table.last("stream") == 13 and len(table.folders()) <= 5

    def stats():
        return {r["file"]: (r["num_scores"], r["average_score"], r["min_score"], r["max_score"]) for r in streams.latest_stats(spark, output).collect()}

    want = {}
    for name in ("f0", "f1", "f2"):
        scores = [s for f, s in total if f == name and s is not None]
        want[name] = (len(scores), sum(scores) / len(scores), min(scores), max(scores))
    assert stats() == want
    # A micro-batch that is repeated because its run died before the checkpoint adds nothing.
    import shutil

    shutil.rmtree(checkpoint)
    stream = streams.file_stream(spark, source, "source_file string, comet_score double", files_per_trigger=1)
    streams.score_stats_stream(stream, output, checkpoint, epochs=4).awaitTermination()
    assert stats() == want
    assert streams.latest_stats(spark, str(tmp_path / "none")).isEmpty()


def test_external_scorer_sees_roles_in_order(spark):
    from lexiloom.functions.metrics import ExternalScorer

    def make():
        return lambda src, hyp, ref: pd.Series([float(len(s) * 100 + len(h) * 10 + len(r)) for s, h, r in zip(src, hyp, ref)])

    df = spark.createDataFrame([("a", "bb", "ccc")], "s string, h string, r string")
    assert add_metrics(df, {"x": ExternalScorer("x", make)}, "s", "h", "r").first()["x"] == 123.0
