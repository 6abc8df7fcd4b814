import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.fixtures import SCHEMA, SF, documents, frame, key_sorted, needs_data
from tripstar.llm import spelling

TO_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counts(rows):
    c = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(TO_LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            c[run] += 1
    return {w: n for w, n in c.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute(rows):
    c = counts(rows)
    by_deletion = defaultdict(set)  # words one edit apart share a word with one letter out
    for w in c:
        by_deletion[w].add(w)
        for k in range(len(w)):
            by_deletion[w[:k] + w[k + 1:]].add(w)
    near = {w: {v for d in [w, *(w[:k] + w[k + 1:] for k in range(len(w)))] for v in by_deletion[d] if one_edit(w, v)} for w in c}
    form = {}
    for w in c:
        best = min(near[w], key=lambda v: (-c[v], v), default=None)
        form[w] = best if best is not None and c[best] >= 2 * c[w] else None
    out = []
    for w in c:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, c[w], len(near[w]), c[form[w]] if form[w] else None))
    return key_sorted(out)


def variants(seed, n):
    """Texts of words and their misspellings, with copies and edge rows."""
    pick = random.Random(seed)
    letters = "abcdeéßÀz×"
    base = ["".join(pick.choices(letters, k=pick.randint(4, 9))) for _ in range(12)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(pick.randint(0, 40)):
            w = pick.choice(base)
            for _ in range(pick.choice([0, 0, 0, 1, 1, 2])):
                k = pick.randrange(len(w) + 1)
                w = pick.choice([w[:k] + w[k + 1:], w[:k] + pick.choice(letters) + w[k:], w[:k] + pick.choice(letters) + w[k + 1:], w.upper()])
                w = w or "a"
            words.append(w)
        rows.append((pick.choice([None, i, i, i, 3]), pick.choice([" ".join(words)] * 8 + [None, "", "1 2, 3"])))
    return rows + rows[:9]


@pytest.mark.parametrize("symbols", [None, 2, 26])
def test_words_match_brute_force(spark, symbols):
    rows = variants(11, 400)
    want = brute(rows)
    assert sum(r[1] is not None for r in want) > 20
    assert key_sorted(spelling.group(frame(spark, rows), symbols=symbols).collect()) == want


@needs_data
def test_given_documents_match_brute_force(spark):
    from tripstar.llm.registry import op13_spelling_variants
    assert key_sorted(op13_spelling_variants(spark, SF).collect()) == brute(documents())


@pytest.mark.parametrize("symbols", [3, 9])
def test_neighbourhoods_hold_every_pair_once(symbols):
    rng = np.random.default_rng(symbols)
    words = {tuple(rng.integers(1, symbols + 1, rng.integers(2, 6)).tolist()) for _ in range(400)}
    by_key = {int(spelling.keys(np.array([w], np.uint64)).view(np.int64)[0]): w for w in words}
    got = Counter()
    for key, w in by_key.items():
        _, hits = spelling.neighbours(np.array([w], np.uint64), symbols)
        assert len(set(hits.tolist())) == len(hits)
        got.update(frozenset((w, by_key[h])) for h in hits.tolist() if h in by_key)
    want = {frozenset((a, b)) for a in words for b in words if a == b or one_edit(a, b)}
    assert set(got) == want and set(got.values()) == {1}


def test_long_words_and_long_texts(spark):
    long = "ab" * 1_000
    rows = [(1, f"{long} {long} {long}x {long}x"), (2, f"{long} {long}, {long} {long}x"), (3, "hello " * 200_000)]
    assert key_sorted(spelling.group(spark.createDataFrame(rows, SCHEMA)).collect()) == brute(rows)


def test_chains_are_followed_to_the_last_form(spark):
    rows = [(None, " ".join(w for k, w in enumerate(["aaaaabbbbb"[j:j + 5] for j in range(6)]) for _ in range(3 * 2**k)))] * 2
    want = brute(rows)
    assert {r[2] for r in want} == {"bbbbb"}
    assert key_sorted(spelling.group(spark.createDataFrame(rows, SCHEMA)).collect()) == want


def test_bytes_that_are_not_utf8_separate_words(spark):
    df = spark.createDataFrame([(1, bytearray(b"hello\xffworld hello\xc3 hello world world"))], "doc_id long, text binary")
    got = {r.word: r.n for r in spelling.group(df.selectExpr("doc_id", "CAST(text AS string) AS text")).collect()}
    want = counts([(1, "hello�world hello� hello world world")])
    assert got == want


def test_no_words(spark):
    assert spelling.group(spark.createDataFrame([], SCHEMA)).collect() == []
    assert spelling.group(spark.createDataFrame([(1, None), (2, ""), (3, "rare words")], SCHEMA)).collect() == []
