import random
import re
from collections import Counter

import numpy as np
import pytest

from tests.llm.fixtures import SCHEMA, documents, frame, key_sorted, needs_data
from tripstar.llm import jaccard
from tripstar.llm.trie import link_groups


def brute(rows, n=3, threshold=90):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    up = list(range(len(rows)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    where = {}
    for k, s in enumerate(sets):
        common = Counter()
        for x in s:
            for j in where.setdefault(x, []):
                common[j] += 1
            where[x].append(k)
        for j, o in common.items():
            if 100 * o >= threshold * (len(s) + len(sets[j]) - o):
                up[top(k)] = top(j)
    low = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            low[top(k)] = min(low.get(top(k), i), i)
    return key_sorted((i, len(sets[k]), low.get(top(k))) for k, (i, _) in enumerate(rows))


def near_copies(seed, n):
    pick = random.Random(seed)
    base = [[f"w{pick.randint(0, 400)}" for _ in range(pick.choice([1, 2, 3, 30, 80, 150]))] for _ in range(8)]
    rows = []
    for i in range(n):
        words = list(pick.choice(base))
        for _ in range(pick.choice([0, 0, 1, 1, 2, 3])):
            words[pick.randrange(len(words))] = f"x{pick.randint(0, 9)}" if pick.random() < .5 else words[0].upper()
        rows.append((pick.choice([None, i, i, i, i, i // 2]), pick.choice([" ".join(words)] * 12 + [None, "", "  \n"])))
    return rows


@pytest.mark.parametrize("threshold", [50, 80, 90])
def test_prefix_tree_links_what_brute_force_links(threshold):
    rng = np.random.default_rng(threshold)
    for _ in range(80):
        base = [rng.choice(60, rng.integers(1, 30), replace=False) for _ in range(3)]
        sets = []
        for _ in range(rng.integers(1, 40)):
            b = base[rng.integers(3)]
            sets.append(np.unique(np.concatenate([b[rng.random(len(b)) < rng.choice([1, .95, .8])], rng.integers(0, 80, rng.integers(0, 3))])))
        sizes = np.array([len(s) + int(rng.integers(0, 2)) for s in sets])
        group = link_groups([s.astype(np.uint64) for s in sets], sizes, threshold)
        up = list(range(len(sets)))

        def top(x):
            while up[x] != x:
                x = up[x]
            return x

        for i in range(len(sets)):
            for j in range(i):
                o = len(np.intersect1d(sets[i], sets[j]))
                if 100 * o >= threshold * (sizes[i] + sizes[j] - o):
                    up[top(i)] = top(j)
        pairs = {(top(k), g) for k, g in enumerate(group.tolist())}
        assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})


@pytest.mark.parametrize("block_sets", [10_000, 7])
def test_edge_rows_match_brute_force(spark, block_sets):
    rows = near_copies(5, 200)
    assert key_sorted(jaccard.join(frame(spark, rows), block_sets=block_sets).collect()) == brute(rows)


@needs_data
def test_documents_match_brute_force(spark):
    rows = documents()
    got = key_sorted(jaccard.join(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect())
    assert got == brute(rows)


def test_one_row_of_each_group_stays(spark):
    rows = [(k, t) for k, (_, t) in enumerate(near_copies(9, 120))]
    rows += rows[:3]
    df = frame(spark, rows)
    out = jaccard.keep_first(df, n=5, threshold=80)
    assert out.columns == df.columns
    got = out.select("doc_id", "text").collect()
    groups = brute(rows, 5, 80)
    alone = [i for i, n, _ in groups if not n]
    assert sorted(r.doc_id for r in got) == sorted([*alone, *{c for _, n, c in groups if n}])


def test_long_text_and_empty_table(spark):
    long = " ".join(f"w{k % 9000}" for k in range(60_000))
    rows = [(1, long), (2, long + " more"), (3, "other words here")]
    got = {r.doc_id: r.component_id for r in jaccard.join(frame(spark, rows, 2)).collect()}
    assert got == {1: 1, 2: 1, 3: 3}
    assert jaccard.join(spark.createDataFrame([], SCHEMA)).count() == 0
    assert jaccard.keep_first(spark.createDataFrame([], SCHEMA)).count() == 0
