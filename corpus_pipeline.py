"""Corpus pipeline: documents to tokens, in stages.

Every stage is a function ``(spark, docs, sf_dir) -> DataFrame``.  ``run``
writes the result of each stage as Parquet in the shared folder and reads it
again as the input of the next, so a lost executor costs at most the stage that
is running.  All stages but the last return the columns they were given.

Defined results: a null or empty text is judged by the classifier like any
other, links with nothing, is never contaminated, has no secrets and no tokens.
Repeated rows are one group in the join, so one of them stays.  Rows with a null
id are kept like others (in a group of rows with null ids only, one stays).
Extra columns are passed on.  An empty table stays empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstar.llm import bpe, decontaminate, jaccard, quality, secrets
from tripstar.session import scratch_path

# The classifier and the matchers are not SQL: tested against brute force.
ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 7: documents that the classifier rejects go."""
    trees = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.keep_good(docs, trees)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 9: near duplicates (five-word shingles, similarity 0.8); the first
    document of each group stays."""
    return jaccard.keep_first(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 10: documents that contain a test item go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 3: secrets are masked; every document stays.  ``n_chars`` follows."""
    masked = secrets.redact(docs)
    if "n_chars" not in docs.columns:
        return masked
    return masked.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.char_length("text")).cast(docs.schema["n_chars"].dataType))


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 8: token counts and digests of the ids and of the text decoded from them."""
    return bpe.digest(bpe.tokenize(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [("quality_classifier", quality_classifier),
          ("ngram_jaccard_join", ngram_jaccard_join),
          ("benchmark_decontamination", benchmark_decontamination),
          ("secret_scans", secret_scans),
          ("bpe_tokens", bpe_tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, from the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, "pipeline", name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
