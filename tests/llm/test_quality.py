import zlib

import numpy as np

from tests.llm.fixtures import frame, mixed_rows, needs_data
from tripstar.llm import quality
from tripstar.llm.blocks import _block
from tripstar.llm.quality import FEATURES, features, fit


def brute_score(trees, x):
    """Walk every tree node by node."""
    out = []
    for row in x:
        raw = trees.base
        for node in trees.roots.tolist():
            while trees.left[node] != node:
                node = int(trees.left[node] + (row[trees.feature[node]] > trees.threshold[node]))
            raw += trees.value[node]
        out.append(1 / (1 + np.exp(-raw)))
    return np.array(out)


def test_flat_traversal_matches_a_walk_and_learns():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 5)).astype(np.float32)
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    trees = fit(x, y, n_trees=30)
    assert np.allclose(trees.score(x), brute_score(trees, x))
    fresh = rng.normal(size=(500, 5)).astype(np.float32)
    assert ((trees.score(fresh) > 0.5) == ((fresh[:, 0] > 0) ^ (fresh[:, 1] > 0.5))).mean() > 0.9


def test_labels_of_one_kind_give_their_share():
    x = np.zeros((5, 3), np.float32)
    assert fit(x, np.ones(5)).score(x).min() > 0.99
    assert fit(x[:0], np.zeros(0)).score(x).tolist() == [0.5] * 5


def test_features_of_a_text_do_not_depend_on_its_block():
    texts = [t.encode() for _, t in mixed_rows() if t is not None]
    together = features(_block([1] * len(texts), texts))
    alone = np.vstack([features(_block([1], [t])) for t in texts])
    assert together.shape[1] == len(FEATURES) and np.allclose(together, alone, rtol=1e-4, atol=1e-5)
    assert np.isfinite(together).all()


def test_rows_folds_and_empty_tables(spark):
    rows = mixed_rows()
    docs = frame(spark, rows)
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(None, 1), (3, None)], "doc_id long, quality int")
    trees = quality.train(docs, labels)
    got = quality.score(docs, trees).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    assert all(zlib.crc32(str(r._id).encode()) % 5 for r in quality.training_rows(labels).collect())
    assert quality.training_rows(labels, max_rows=10).count() <= 30
    kept = quality.keep_good(docs, trees)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted for r in got)
    assert quality.score(docs.limit(0), quality.train(docs.limit(0), labels.limit(0))).count() == 0


@needs_data
def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = quality.score(docs, quality.train(docs, labels)).join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in got) >= 0.95 * len(got)


def test_an_id_in_a_third_of_all_rows_is_learned_from_once(spark, monkeypatch):
    fitted = []
    monkeypatch.setattr(quality, "fit", lambda x, y, **k: fitted.append((x, y)))
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(40)] + [(1, f"copy {i}") for i in range(20)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(1, 1)] * 5, "doc_id long, quality int")
    quality.train(docs.repartition(3), labels)
    quality.train(docs.repartition(5), labels)
    (x, y), (x2, y2) = fitted
    assert len(y) == labels.where(~quality.held_out("doc_id")).select("doc_id").distinct().count()
    assert (x == x2).all() and (y == y2).all()
