"""The pipeline, stage by stage, against brute force on a small table."""

import hashlib

import corpus_pipeline
from pyspark.sql import functions as F
from test_llm_operators import TEXTS, brute_components, brute_lines, prose

from lexiloom.llm import line_rules, mixing
from lexiloom.llm.words import WORD


def test_stages(spark, docs_of):
    texts = [*TEXTS, *(prose(70 + i, 50 + i) + "." for i in range(20)), prose(75, 55) + ".", prose(70, 50) + " more."]
    docs = docs_of(texts).withColumn("n_chars", F.col("n_chars").cast("long"))
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "minhash_dedup", "source_mix", "byte_bpe"]
    kept = docs
    for name, stage in corpus_pipeline.STAGES:
        before = sorted(kept.select("doc_id", "text").collect(), key=lambda r: r["doc_id"]) if name != "byte_bpe" else []
        out = stage(spark, kept, "").cache()
        own = [r["text"] for r in before]
        if name != "byte_bpe":
            assert out.columns == docs.columns
            assert out.filter("n_chars <> length(text)").count() == 0
        if name == "quality_rules":
            want = {r["doc_id"]: r["clean_text"] for r in line_rules.measure(docs).collect() if r["kept"]}
            assert {r["doc_id"]: r["text"] for r in out.collect()} == want
        elif name == "line_dedup":
            gone = brute_lines(own)
            want = {}
            for d, r in enumerate(before):
                lines = r["text"].split("\n")
                left = [x for at, x in enumerate(lines) if (d, at) not in gone]
                if any(WORD.search(x) for x in left) or len(left) == len(lines):
                    want[r["doc_id"]] = "\n".join(left)
            assert {r["doc_id"]: r["text"] for r in out.collect()} == want
        elif name == "minhash_dedup":
            _, labels = brute_components(own, 5, 80)
            assert sorted(r["doc_id"] for r in out.collect()) == [r["doc_id"] for i, r in enumerate(before) if labels[i] == i]
        elif name == "source_mix":
            taken = {r["_doc"]: r["taken"] for r in mixing.Mix(kept).per_document().collect() if r["taken"]}
            found = {}
            for r in out.collect():
                found[r["doc_id"]] = found.get(r["doc_id"], 0) + len(WORD.findall(r["text"]))
            assert found == taken
            mixed = sorted((r["doc_id"], hashlib.sha256(r["text"].encode()).hexdigest()) for r in out.collect())
        else:
            assert sorted((r["doc_id"], r["decoded_sha256"]) for r in out.collect()) == mixed
        kept = out
    assert corpus_pipeline.ORACLE_SQL is None


def test_run_over_a_driver_table(spark, small):
    done = corpus_pipeline.run(spark, small)
    assert done.count() > 50 and {"doc_id", "n_tokens", "ids"} <= set(done.columns)
