"""The pipeline's stages against brute force on its own input, and the registered queries."""

import corpus_pipeline
import __spark_entry__
from kiln.llm import decontaminate, minhash_dedup, quality_rules, secret_scan
from kiln.llm.queries import LLM_QUERIES
from tests.llm.test_operators import dedup_brute, pairs

SF = "/root/testdata/sf0.001"


def test_stages_in_order(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, bench = docs.columns, spark.read.parquet(f"{SF}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF).cache()
        before, after = dict(pairs(docs)), dict(pairs(out))
        if name == "quality_rules":
            assert set(after) == {r.doc_id for r in quality_rules.quality(docs).where("kept").collect()}
        elif name == "minhash_dedup":
            assert set(after) == {i for i, _, c in dedup_brute(pairs(docs)) if i == c}
        elif name == "decontamination":
            assert set(before) - set(after) == {r.doc_id for r in decontaminate.leaks(docs, bench).collect()}
        elif name == "secret_scan":
            assert set(after) == set(before)
            assert {i for i in after if after[i] != before[i]} == {
                r.doc_id for r in secret_scan.scan(docs).where("size(spans) > 0").collect()}
            assert all(r.n_chars == len(r.text) for r in out.collect())
        if name != "bpe_encoding":
            assert out.columns == columns
        docs = out
    assert docs.columns == [*columns, "n_tokens", "ids"]
    assert corpus_pipeline.run(spark, SF).count() == docs.count()


def test_empty_documents_pass_through(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_kept_documents_stay_one_per_group(spark):
    docs = spark.createDataFrame([(5, "a b c d e f"), (3, "a b c d e f"), (9, "x y"), (None, "x y z"), (7, None)],
                                 "doc_id long, text string")
    assert {r.doc_id for r in minhash_dedup.keep_one(docs).collect()} == {3, 9, 7, None}


def test_registered():
    assert set(LLM_QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in LLM_QUERIES) == list(range(1, 14))
