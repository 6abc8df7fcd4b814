"""Each stage against a plain version on its own input."""

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from tests.llm.fixtures import needs_data
from tests.llm.test_bpe import direct
from tests.llm.test_decontaminate import d as decontaminate
from tests.llm.test_jaccard import brute
from tripstar.llm import quality
from tripstar.llm.secrets import mask, spans_of

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, part int, score double"


@needs_data
def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("*", "1 AS part", "0.5D AS score")
    rows = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        before, path = docs, str(tmp_path / name)
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        rows[name] = (before.collect(), docs.collect(), before.columns, docs.columns)
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert rows[name][2] == rows[name][3]
        assert rows[name][1]

    before, after, *_ = rows["quality_classifier"]
    trees = quality.train(spark.createDataFrame(before, SCHEMA), spark.read.parquet(f"{SF}/labels.parquet"))
    score = {r.doc_id: r.predicted for r in quality.score(spark.createDataFrame(before, SCHEMA), trees).collect()}
    assert {r.doc_id for r in after} == {i for i, p in score.items() if p}

    before, after, *_ = rows["ngram_jaccard_join"]
    groups = brute([(r.doc_id, r.text) for r in before], 5, 80)
    assert {r.doc_id for r in after} == {c for _, _, c in groups}
    assert {r.doc_id: r.text for r in after}.items() <= {r.doc_id: r.text for r in before}.items()

    before, after, *_ = rows["benchmark_decontamination"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    matcher = decontaminate.Matcher(items)
    assert {r.doc_id for r in after} == {r.doc_id for r in before if not matcher.find(decontaminate.normalise(r.text))}

    before, after, *_ = rows["secret_scans"]
    masked = {r.doc_id: mask(r.text, spans_of(r.text)[1]) for r in before}
    assert {r.doc_id: r.text for r in after} == masked
    assert all(r.n_chars == len(r.text) for r in after)

    before, after, *_ = rows["bpe_tokens"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert sorted(map(tuple, after), key=repr) == direct(tokenizer, [(r.doc_id, r.text) for r in before])


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None, None, None), (1, "", "en", "s", 0, 1, 1.0),
                                       (1, "", "en", "s", 0, 1, 1.0), (2, "secret=abcdefg " + "word " * 30, None, "s", None, 1, None)]])
def test_edge_rows(spark, tmp_path, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    assert docs.columns[:2] == ["doc_id", "n_tokens"] and docs.count() <= len(rows)


def test_registration():
    names = __spark_entry__.queries()
    assert "pipeline" in names and [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10
