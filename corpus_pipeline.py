"""A corpus from raw documents to token ids: language, near copies, benchmark passages, personal data, encoding."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm import bpe, decontaminate, langid, pii, simhash
from strandline.session import write_through

#: A text whose best language has less of the probability is rejected.
LEAST_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that have no letter, or no language of at least half the probability if any language was learnt."""
    model = langid.train(docs, public_tokenizers.path("piece_bpe_32k.model"))
    if not model.languages:
        return langid.with_letters(docs)
    found = langid.identify(docs, model, carry=True)
    return found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select("row.*")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    return simhash.one_of_each(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold a window of a benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked; ``n_chars`` follows where a text has changed."""
    found = pii.find(docs, pii.fit(pii.labelled_table(docs)), carry=True)
    changed = F.col("spans") != ""
    put = {"text": F.when(changed, F.col("masked")).otherwise(F.col("row.text")),
           "n_chars": F.when(changed, F.length("masked")).otherwise(F.col("row.n_chars")).cast("long")}
    return found.select(*(put.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document and digests of them and of what they decode to."""
    return bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json"), keep="ids")


STAGES = [
    ("language_id", language),
    ("near_copies", near_copies),
    ("benchmark_passages", benchmark_passages),
    ("personal_data", personal_data),
    ("token_ids", token_ids),
]

#: SQL can express neither the trained stages nor the fingerprints' hash.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages on ``documents``, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = write_through(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
