"""The pipeline and the registered queries."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from strandline.llm import bpe, decontaminate, langid, pii, simhash
from strandline.llm.queries import ORACLE, QUERIES
from tests.oracle import connect, differences

SF = "/root/testdata/sf0.001"


def test_all_are_registered():
    numbers = {int(n.split("_")[0][2:]) for n in QUERIES}
    assert numbers == set(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), connect(SF), ORACLE[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op4_top_k", "op11_source_divergence"}))
def test_query_has_a_row_for_every_document(spark, name):
    found = contract.queries()[name](spark, SF)
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    assert found.count() == documents.count()
    assert found.select("doc_id").exceptAll(documents.select("doc_id")).count() == 0


def test_stages_do_what_they_say(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(10_001, "123 !!! 456", "en", "s", 11), (10_002, None, None, None, None)], docs.schema)
    docs = docs.union(extra).union(docs.limit(3)).cache()
    kept = corpus_pipeline.language(spark, docs, SF)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 2
    single = corpus_pipeline.near_copies(spark, kept, SF).cache()
    linked = simhash.similar_documents(kept)
    assert single.columns == docs.columns and single.count() == linked.select("component").distinct().count()
    clean = corpus_pipeline.benchmark_passages(spark, single, SF).cache()
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    hit = decontaminate.report(decontaminate.contaminated_words(single, benchmark)).where("contaminated").select("doc_id")
    assert clean.columns == docs.columns and hit.count() > 0
    assert clean.count() == single.count() - hit.count() and clean.join(hit, "doc_id").count() == 0
    masked = corpus_pipeline.personal_data(spark, clean, SF).cache()
    assert masked.columns == docs.columns and masked.count() == clean.count()
    for r in masked.collect():
        assert pii.base_spans(r["text"]) == [] and r["n_chars"] == len(r["text"])
    ids = corpus_pipeline.token_ids(spark, masked, SF)
    assert ids.count() == masked.count()
    found = {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in ids.collect()}
    counts = {r["doc_id"]: r["n_tokens"] for r in bpe.encode(masked, corpus_pipeline.public_tokenizers.path("word_bpe_49k.json")).collect()}
    assert {k: len(v) for k, v in found.items()} == counts


def test_run_is_its_stages(spark):
    result = corpus_pipeline.run(spark, SF)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_copies", "benchmark_passages", "personal_data", "token_ids"]
    assert 0 < result.count() < spark.read.parquet(f"{SF}/documents.parquet").count()


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_extra_columns_with_clashing_names(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    for name in ("row", "key", "fp", "lang_pred", "score", "spans", "masked", "_id", "_key", "component_id", "items", "id", "_hit_id", "_hit_key"):
        docs = docs.withColumn(name, F.lit(name))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        assert out.select("row").distinct().collect()[0][0] == "row"
    assert langid.UNKNOWN == "und"


def test_no_language_to_learn_from_rejects_no_text_with_letters(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40).withColumn("lang", F.lit(None).cast("string"))
    extra = spark.createDataFrame([(10_001, "123 !!! 456", None, "s", 11), (10_002, None, None, None, None)], docs.schema)
    kept = corpus_pipeline.language(spark, docs.union(extra), SF)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in docs.collect() if langid.words_of(r["text"] or "")} != set()
