"""Texts whose bytes are not UTF-8: every operator and every pipeline stage
finishes, and reads or keeps them as its docstring says."""

import hashlib

import pytest
import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.fixtures import SF, needs_data
from tripstar.llm import (bpe, chosen_path, decontaminate, filter_audit, html_text, jaccard, language, perplexity, quality, secrets, sharding,
                          spelling, suffix_dedup)
from tripstar.llm.blocks import valid_text

BAD = [b"\xffA\xc3 password=abcdefgh", b"\xf0\x9f\x98 and \xe2\x82", b"\xed\xa0\x80 \xc0\x80 \xf5\x80", "fine é".encode(), b"", None]


@pytest.fixture()
def bad(spark, tmp_path):
    """Six rows, as plain Spark reads them from Parquet."""
    rows = [(i, None if t is None else bytearray(t)) for i, t in enumerate(BAD)]
    df = spark.createDataFrame(rows, "doc_id long, b binary").selectExpr(
        "doc_id", "CAST(b AS STRING) AS text", "CAST(b AS STRING) AS other", "'en' AS lang", "'s' AS source", "1 AS part")
    df.write.parquet(str(tmp_path / "bad"))
    return spark.read.parquet(str(tmp_path / "bad"))


def as_bytes(df, col="text"):
    return {r.doc_id: None if r.b is None else bytes(r.b) for r in df.select("doc_id", F.col(col).cast("binary").alias("b")).collect()}


def test_one_rule(bad):
    got = {r.doc_id: r.t for r in bad.select("doc_id", valid_text("text").alias("t")).collect()}
    assert got == {i: None if t is None else t.decode("utf-8", "replace") for i, t in enumerate(BAD)}


def test_operators_finish(spark, bad):
    pages = bad.select(F.col("doc_id").alias("page_id"), F.concat(F.lit("http://h.org/"), "text").alias("url"), F.col("text").alias("html"))
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(6)], "doc_id long, quality int, toxic int")
    for op in (suffix_dedup.dedup, secrets.scan, perplexity.judge, sharding.assign, jaccard.join, chosen_path.near_duplicates):
        assert op(bad).count() == len(BAD), op
    assert language.identify(pages).count() == len(BAD)
    assert perplexity.judge(bad.withColumn("lang", F.col("text"))).count() == len(BAD)
    assert quality.score(bad, quality.train(bad, labels)).count() == len(BAD)
    assert filter_audit.audit(bad, labels).count() == 600 and spelling.group(bad).count() == 0
    texts = {r.page_id: r.text for r in html_text.extract(pages).collect()}
    assert texts[0] == "\ufffdA\ufffd password=abcdefgh" and texts[1] == "\ufffd and \ufffd"
    spans = {r.doc_id: r.spans for r in secrets.scan(bad).collect()}
    assert spans[0] == "assign:4:21" and spans[1] == ""


def test_tokens(bad):
    got = {r.doc_id: r.decoded_sha256 for r in bpe.digest(bpe.tokenize(bad, public_tokenizers.path("byte_bpe_50k.json"))).collect()}
    assert got == {i: hashlib.sha256((t or b"").decode("utf-8", "replace").encode()).hexdigest() for i, t in enumerate(BAD)}


def test_stages_keep_the_bytes(spark, bad):
    items = spark.createDataFrame([(1, "no such words in it")], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    every = dict(enumerate(BAD))
    kept = jaccard.keep_first(bad)
    assert as_bytes(kept) == as_bytes(kept, "other") == every
    assert as_bytes(decontaminate.drop_contaminated(bad, items)) == every
    trees = quality.train(bad, labels)
    good = {r.doc_id for r in quality.score(bad, trees).where("predicted = 1").collect()}
    assert as_bytes(quality.keep_good(bad, trees)) == {i: t for i, t in every.items() if i in good}
    masked = as_bytes(secrets.redact(bad))
    assert masked.pop(0) == "\ufffdA\ufffd [assign]".encode() and masked == {i: t for i, t in every.items() if i}


@needs_data
def test_pipeline(spark, bad):
    docs = bad
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() <= len(BAD)
