import hashlib

import numpy as np

from tests.llm.fixtures import SCHEMA, documents, frame, key_sorted, mixed_rows, needs_data
from tripstar.llm import suffix_dedup


def brute(rows, size=50):
    rank = lambda i: (i is None, i or 0)
    first, out = {}, []
    for i, t in rows:
        b = (t or "").encode()
        for k in range(len(b) - size + 1):
            w = b[k:k + size]
            first[w] = min(first.get(w, rank(i)), rank(i))
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - size + 1):
            if first[b[k:k + size]] < rank(i):
                gone[k:k + size] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((i, len(b), int(gone.sum()), len(edges) // 2, hashlib.sha256(kept).hexdigest()))
    return key_sorted(out)


def run(df, **more):
    return key_sorted(r[:5] for r in suffix_dedup.dedup(df, **more).collect())


def test_edge_rows_match_brute_force(spark):
    rows = mixed_rows()
    assert run(frame(spark, rows)) == brute(rows)


def test_anchors_of_many_parts_are_dealt_by_window(spark):
    rows = mixed_rows(seed=8)
    assert run(frame(spark, rows), hot_parts=0) == brute(rows)


@needs_data
def test_documents_match_brute_force(spark):
    rows = documents()
    got = run(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert got == brute(rows)
    assert sum(r[2] for r in got) > 0


def test_long_text_without_spaces(spark):
    rows = [(1, "ab" * 70_000), (2, "c" + "ab" * 100), (3, "z" * 49)]
    assert run(frame(spark, rows, 2)) == brute(rows)


def test_empty_table(spark):
    assert suffix_dedup.dedup(spark.createDataFrame([], SCHEMA)).collect() == []


def test_spans_are_the_removed_runs(spark):
    rows = [(1, "x" * 60), (2, "abc" + "x" * 55 + "def")]
    got = {r.doc_id: r for r in suffix_dedup.dedup(frame(spark, rows)).collect()}
    assert got[2].span_starts == [3] and got[2].span_ends == [58]
