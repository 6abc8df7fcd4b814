import random

import pytest

from tests.llm.fixtures import SCHEMA, documents, frame, mixed_rows, needs_data
from tripstar.llm import decontaminate as d

ITEMS = "item_id long, text string"


def brute_distance(item, text):
    """Smallest edit distance of the item to any stretch of the text."""
    row = list(range(len(item) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for i, x in enumerate(item, 1):
            new.append(min(row[i] + 1, new[-1] + 1, row[i - 1] + (x != c)))
        row = new
        best = min(best, row[-1])
    return best


def edit(pick, text, k):
    out = list(text)
    for _ in range(k):
        at = pick.randrange(len(out))
        how = pick.random()
        if how < .4:
            out[at] = pick.choice("qxz")
        elif how < .7:
            del out[at]
        else:
            out.insert(at, pick.choice("qxz"))
    return "".join(out)


def test_myers_matches_the_table():
    pick = random.Random(2)
    for _ in range(300):
        item = bytes(pick.choices(b"abc ", k=pick.randint(1, 90)))
        text = bytes(pick.choices(b"abc ", k=pick.randint(0, 120)))
        k = pick.randint(0, len(item))
        want = brute_distance(item, text)
        got, end = d.myers(item, text, k)
        assert got == (want if want <= k and (text or want <= k) and got >= 0 else -1)
        assert (got >= 0) == (want <= k and want < len(item) or want <= k and got >= 0)


@pytest.mark.parametrize("size", [5, 40, 120, 400])
def test_matcher_finds_what_brute_force_finds(size):
    pick = random.Random(size)
    words = ["".join(pick.choices("abcdefgh", k=pick.randint(2, 8))) for _ in range(60)]
    items = [(i, " ".join(pick.choices(words, k=size))[:size]) for i in range(6)]
    matcher = d.Matcher(items)
    for _ in range(40):
        i, item = pick.choice(items)
        k = pick.choice([0, 0, 1, d.budget(size), d.budget(size) + 1, d.budget(size) + 4])
        text = d.normalise(" ".join(pick.choices(words, k=20)) + " " + edit(pick, item, k) + " " + " ".join(pick.choices(words, k=20)))
        found = {q: dist for q, dist, _ in matcher.find(text)}
        for q, other in items:
            norm = d.normalise(other)
            dist = brute_distance(norm, text)
            assert found.get(q) == (dist if dist <= d.budget(len(norm)) else None), (q, other, text)


def test_rows_nulls_and_blocks(spark, monkeypatch):
    items = spark.createDataFrame([(1, "The quick brown fox jumps over"), (2, None), (3, " .. "), (None, "an item that has no id"),
                                   (4, "the QUICK, brown fox  jumps over")], ITEMS)
    rows = mixed_rows() + [(1000, "so the quick brown fox jumped over it"), (1001, "and An item that has no id!"), (1002, None)]
    got = {}
    for block_bytes in (1 << 22, 1):
        monkeypatch.setattr(d, "BLOCK_ITEM_BYTES", block_bytes)
        out = d.matches(frame(spark, rows), items).collect()
        assert len(out) == len(rows)
        got[block_bytes] = sorted((repr(r.doc_id), sorted(map(repr, r["items"]))) for r in out)
    assert got[1] == got[1 << 22]
    hits = {r.doc_id: sorted(r["items"], key=repr) for r in out if r.doc_id is not None and r.doc_id >= 1000}
    assert hits == {1000: [], 1001: [None], 1002: []}
    kept = d.drop_contaminated(frame(spark, rows), items)
    assert kept.columns == frame(spark, rows).columns
    assert kept.count() == sum(r.n_items == 0 for r in out)


def test_one_block_is_broadcast_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(d, "BLOCK_ITEM_BYTES", 40)
    items = [(i, f"test item number {i} of the benchmark") for i in range(3)]
    live, most, real = set(), [0], spark.sparkContext.broadcast

    def counted(value):
        out = real(value)
        live.add(id(out))
        most[0] = max(most[0], len(live))
        destroy = out.destroy
        out.destroy = lambda *a: (live.discard(id(out)), destroy(*a))
        return out

    monkeypatch.setattr(spark.sparkContext, "broadcast", counted)
    docs = frame(spark, [(i, f"so test item number {i} of the benchmark is here") for i in range(5)])
    table = spark.createDataFrame(items, ITEMS)
    one = d.Matcher(items)
    want = {i: [q for q, _, _ in one.find(d.normalise(f"so test item number {i} of the benchmark is here"))] for i in range(5)}
    assert want[0] == [0, 1, 2]  # one edit apart
    assert {r.doc_id: sorted(r["items"]) for r in d.matches(docs, table).collect()} == want
    assert most[0] == 1 and len(live) == 1
    live.clear()
    assert {r.doc_id for r in d.drop_contaminated(docs, table).collect()} == {i for i in range(5) if not want[i]}
    assert most[0] == 1


def test_empty_tables(spark):
    no_docs, no_items = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], ITEMS)
    docs = frame(spark, [(1, "text")])
    assert d.matches(docs, no_items).first().n_items == 0
    assert d.drop_contaminated(docs, no_items).count() == 1
    assert d.matches(no_docs, no_items).count() == 0


@needs_data
def test_planted_passages_are_found(spark):
    sf = "/root/testdata/sf0.01"
    rows, items = documents(sf), __import__("duckdb").sql(f"SELECT item_id, text FROM '{sf}/benchmark.parquet'").fetchall()
    want = {i for i, t in rows if any(x in t for _, x in items)}
    got = d.matches(spark.createDataFrame(rows, SCHEMA).repartition(4), spark.createDataFrame(items, ITEMS)).where("n_items > 0")
    assert want and want <= {r.doc_id for r in got.collect()}
