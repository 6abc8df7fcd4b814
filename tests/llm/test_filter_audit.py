import random
import re
from collections import defaultdict
from itertools import permutations

import duckdb
import pytest

from tests.llm.fixtures import key_sorted, mixed_rows
from tripstar.llm import filter_audit


def brute(rows, labels):
    """(part, order, step) -> counts, document by document."""
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, x in labels if i is not None and x == 1}
    fails, low = [], {}
    for i, t, _ in rows:
        if i is not None:
            low[t or ""] = min(low.get(t or "", i), i)
    for i, t, _ in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails.append({f for f, bad in zip("ABCDE", (
            len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
            bool(re.search("[#$%&*|]", t)), i is not None and i > low[t])) if bad})
    out = defaultdict(lambda: [0] * 6)
    shapley = defaultdict(int)
    for (i, _, part), bad in zip(rows, fails):
        for order in permutations("ABCDE"):
            there = True
            for step, f in enumerate(order, 1):
                c = out[part or "", "".join(order), step]
                removed = there and f in bad
                c[2] += f in bad and not there
                there = there and f not in bad
                c[0] += there
                c[1] += removed
                c[3] += bad == {f}
                c[4] += removed and i in good
                c[5] += removed and i in toxic
                shapley[part or "", f] += removed
    return key_sorted((p, o, s, *c, shapley[p, o[s - 1]]) for (p, o, s), c in out.items())


def texts(n=80, seed=5):
    pick = random.Random(seed)
    rows = []
    for i in range(n):
        t = " ".join(pick.choices(["alpha", "Beta", "GAMMA", "é", "50%", "delta\tx", "\n"] + [f"w{k}" for k in range(90)],
                                  k=pick.choice([0, 3, 49, 50, 51, 90])))
        rows.append((pick.choice([None, i, i, i, 7]), pick.choice([t] * 5 + [None, "", "same text"]), pick.choice(["a", "b", "b", "b", None, ""])))
    rows += [(i, t, "c") for i, t, _ in rows[:20]] + rows[:6]  # copies in another part, repeated rows
    return rows


LABELS = [(i, i % 3 % 2, None if i % 5 else 1) for i in range(0, 80, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1)]


def run(spark, rows, labels=LABELS):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr(
        "doc_id", "text", "source", "1 AS part", "2 AS mask", "3 AS n", "'x' AS good").repartition(3)
    said = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "0 AS part", "'y' AS said")
    return filter_audit.audit(docs, said)


def test_counts_match_brute_force(spark):
    rows = texts()
    assert key_sorted(run(spark, rows).collect()) == brute(rows, LABELS)


def test_sql_matches_brute_force():
    rows = [(i, t, p) for i, t, p in texts(60, 9)]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.execute("CREATE TABLE labels (doc_id BIGINT, quality INT, toxic INT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    con.executemany("INSERT INTO labels VALUES (?, ?, ?)", LABELS)
    assert key_sorted(con.sql(filter_audit.oracle_sql()).fetchall()) == brute(rows, LABELS)


def test_null_and_empty_texts_long_texts_and_no_labels(spark):
    long = "Word " * 300_000
    rows = [(i, t, "s") for i, t in enumerate([None, "", long, long, "x"])] + [(None, None, None), (2, long, "s")]
    assert key_sorted(run(spark, rows, [(None, 1, 1)]).collect()) == brute(rows, [])


def test_fields_do_not_overflow_into_each_other():
    """Sums near the largest count a part can have unpack to what was added."""
    letters, n = "ABCDE", 2**61 - 1
    total = n * filter_audit.packed(letters, 0b0000101) + n * filter_audit.packed(letters, 0b1100101) + 3 * filter_audit.packed(letters, 0)
    got = filter_audit.unpacked(letters, total)
    want = sum(m.astype(object) * w for m, w in ((filter_audit.outcomes(letters, 0b0000101), n),
                                                  (filter_audit.outcomes(letters, 0b1100101), n), (filter_audit.outcomes(letters, 0), 3)))
    assert (got.astype(object) == want).all()


def test_bytes_that_are_not_utf8(spark):
    bad = spark.createDataFrame([(1, bytearray(b"\xffA\xc3 "), "s"), (2, bytearray(b"\xffA\xc3 "), "s")], "doc_id long, text binary, source string")
    got = filter_audit.audit(bad.selectExpr("doc_id", "CAST(text AS string) AS text", "source"),
                             spark.createDataFrame([], "doc_id long, quality int, toxic int")).where("filter_order = 'EABCD' AND step = 1").collect()
    assert [(r.kept, r.removed) for r in got] == [(1, 1)]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert filter_audit.audit(docs, spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")).collect() == []


@pytest.mark.parametrize("filters", [{"A": lambda t: t.rlike("a"), "B": lambda t: t.rlike("b")}])
def test_other_filters(spark, filters):
    docs = spark.createDataFrame([(1, "ab", "s"), (2, "b", "s"), (3, "b", "s")], "doc_id long, text string, source string")
    got = filter_audit.audit(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"), filters)
    rows = {(r.filter_order, r.step): r for r in got.collect()}
    assert len(rows) == 18 and rows["BAE", 1].removed == 3 and rows["ABE", 2].removed == 2 and rows["EAB", 1].unique_fails == 0
