import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.fixtures import SCHEMA, SF, documents, frame, key_sorted, needs_data
from tripstar.llm import chosen_path


def brute(rows, n=2, threshold=80):
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
    return key_sorted((i, len(sets[k]), low.get(top(k)), i == low.get(top(k))) for k, (i, _) in enumerate(rows))


def near_copies(seed, n, edits):
    pick = random.Random(seed)
    base = [[f"w{pick.randint(0, 400)}" for _ in range(pick.choice([1, 2, 3, 30, 80, 150]))] for _ in range(8)]
    rows = []
    for i in range(n):
        words = list(pick.choice(base))
        for _ in range(pick.choice(edits)):
            words[pick.randrange(len(words))] = f"x{pick.randint(0, 9)}" if pick.random() < .5 else words[0].upper()
        rows.append((pick.choice([None, i, i, i, i, i // 2]), pick.choice([" ".join(words)] * 12 + [None, "", "  \n"])))
    return rows + rows[:4]


@pytest.mark.parametrize("node_sets", [1_000, 6])
def test_components_match_brute_force(spark, node_sets):
    """Also with nodes so small that groups are branched on."""
    rows = near_copies(5, 160, [0, 0, 1, 1, 2, 3, 6])
    want = brute(rows)
    assert len({c for _, _, c, _ in want}) < 150
    assert key_sorted(chosen_path.near_duplicates(frame(spark, rows), node_sets=node_sets).collect()) == want


@needs_data
def test_given_documents_match_brute_force(spark):
    from tripstar.llm.registry import op12_chosen_path_dedup
    assert key_sorted(op12_chosen_path_dedup(spark, SF).collect()) == brute(documents())


def test_embedding_estimates_the_similarity():
    rng = np.random.default_rng(1)
    sets = []
    for _ in range(300):
        base = rng.integers(0, 2**63, 200).astype(np.uint64)
        sets += [np.unique(base[:180]), np.unique(base[20:])]  # 160 of 200
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    codes = chosen_path.embedded(np.concatenate(sets), starts).astype(np.uint8)
    got = chosen_path.estimate(codes[::2], codes[1::2])
    assert abs(got.mean() - .8) < .01 and got.std() < .045 and got.min() > chosen_path.cutoff(80)


def test_trees_reach_the_recall():
    """Two sets at the threshold share a path of every tree's first levels as
    often as the count of trees assumes."""
    rng, trees = np.random.default_rng(2), 40
    met = []
    for _ in range(150):
        a = rng.integers(0, 2**32, chosen_path.EMBED, dtype=np.uint64)
        b = np.where(rng.random(chosen_path.EMBED) < .8, a, rng.integers(0, 2**32, chosen_path.EMBED, dtype=np.uint64))
        tokens = chosen_path.places(np.stack([a, b]).astype(np.uint32))
        for tree in chosen_path._TREES[:trees]:
            owner, paths = np.arange(2), np.array([tree, tree], np.uint64)
            for _ in range(chosen_path.MEET_DEPTH):
                owner, paths = chosen_path.branch(tokens, owner, paths, 80)
            met.append(bool(set(paths[owner == 0].tolist()) & set(paths[owner == 1].tolist())))
    miss = (1 - np.mean(met)) ** chosen_path.trees_for()
    assert miss < 5e-4


def test_one_large_group_and_a_long_text(spark):
    pick = random.Random(8)
    words = [f"w{k}" for k in range(300)]
    rows = [(i, " ".join(w if k != i % 300 else f"y{i}" for k, w in enumerate(words))) for i in range(600)]
    long = " ".join(f"v{pick.randint(0, 10**9)}" for _ in range(300_000))
    rows += [(1000, long), (999, long + " one more"), (None, None), (None, long)]
    assert key_sorted(chosen_path.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()) == brute(rows)


def test_first_paths_are_shuffled_once(spark):
    """Paths of one class only, nearly all, are neither written nor dealt a second time."""
    rows = [(p, n) for p in range(40) for n in range(40) if n % 10 < 1 + p % 3 or n == p]
    paths = spark.createDataFrame(rows, "path long, node long")
    met = chosen_path._met(paths)
    assert met._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(path") == 1
    nodes = chosen_path._merged(paths).where("k > 1")
    want = paths.join(nodes, "path").select("path", "node", "k", "hub", "members")
    assert key_sorted(met.collect()) == key_sorted(want.collect())


def test_a_pair_is_compared_in_one_of_its_nodes():
    """Eight classes, alike by fours, in five nodes of all: their sets are sent to one."""
    rng = np.random.default_rng(4)
    group = [rng.integers(0, 256, chosen_path.EMBED, dtype=np.uint8).tobytes() for _ in range(2)]
    names = [50, 20, 40, 10, 30]
    batches = [pa.RecordBatch.from_pylist([
        {"path": 900 + name, "name": name, "node": n, "label": n, "size": 100, "code": group[n % 2], "names": names} for n in range(8)])
        for name in names]
    out = pa.Table.from_batches(list(chosen_path._open_members(80)(iter(batches))))
    assert out.column("path").to_pylist() == [910] * 8 and sorted(out.column("node").to_pylist()) == list(range(8))
    far = [{**r, "code": rng.integers(0, 256, chosen_path.EMBED, dtype=np.uint8).tobytes()} for r in batches[3].to_pylist()]
    assert not sum(b.num_rows for b in chosen_path._open_members(80)(iter([pa.RecordBatch.from_pylist(far)])))


def test_cutoff_of_open_pairs_loses_next_to_none():
    """A pair at the threshold agrees in a binomial number of tokens."""
    least = chosen_path.cutoff(80, chosen_path.OPEN_DEVIATIONS)
    lost = sum(math.comb(chosen_path.EMBED, k) * .8**k * .2**(chosen_path.EMBED - k) for k in range(chosen_path.EMBED + 1)
               if (k / chosen_path.EMBED - 1 / 256) / (1 - 1 / 256) < least)
    assert lost < 1e-7


def test_bytes_that_are_not_utf8_and_empty_table(spark):
    bad = spark.createDataFrame([(2, bytearray(b"\xffA\xc3 b c")), (1, bytearray(b"\xffa\xc3 b c"))], "doc_id long, text binary")
    got = chosen_path.near_duplicates(bad.selectExpr("doc_id", "CAST(text AS string) AS text")).collect()
    assert key_sorted(got) == [(1, 2, 1, True), (2, 2, 1, False)]
    assert chosen_path.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
