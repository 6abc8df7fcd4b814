"""Op 12, near duplicates by chosen paths over minwise tokens.

1. Texts are staged once (``part``).  Every document becomes its set of word
   n-grams; equal sets are one *class*.  A class is embedded as ``EMBED`` minwise
   tokens: two sets agree in a token with the probability of their similarity.
2. *Trees.*  A node of a tree is a path of chosen tokens.  At each node a class
   chooses its tokens by a hash of (path, place, token), each with probability
   1 / (threshold x EMBED), and goes on to the child of every token it chose.
   Which tokens are chosen depends on the path alone, so similar classes walk
   together: a class writes its first ``DEPTH`` levels without meeting the others,
   and Spark groups the paths.  :func:`trees_for` gives the number of independent
   trees that two classes at the threshold need to meet with probability
   ``RECALL``; more similar classes meet more often.
3. *Nodes.*  Nodes with the same members (as told by count and hash) are looked at
   once.  Every member is paired with the smallest class of its node.  Then small
   nodes are compared exhaustively, each in one task, for the pairs that no
   confirmed links connect yet: a node is small when the classes outside its
   largest component, times all its classes, are at most ``NODE_SETS`` squared.
   First all these pairs are compared by size and minwise codes, and a class stays
   in the node if one of its pairs may link (a pair at the threshold is lost with a
   probability of about 1e-8) and no other small node compares that pair: of the
   nodes that two classes share, the one of the smallest 32-bit hash does (for two
   hashes that meet by chance, about 1e-7 a pair).  The sets (as 32-bit hashes) of
   what stays meet in the node's task, their overlaps are matrix products, and the
   task returns as many links as unite its components, not its pairs.  Larger nodes
   are branched on, until none is left.
4. Pairs with the smallest class that the minwise tokens put at least 4 deviations
   below the threshold go; all others, and all links of step 3, are confirmed on
   the full sets, which travel from the staged texts to their pair.  The component
   of a document follows from the confirmed links.

A group of any size is dealt as its members: its stars are dealt in stretches of
``STAR`` pairs, and no task or driver holds a group.  The first level's paths, nearly
all of one class only, are shuffled once, as pairs (path, class): as every class is on
about 60 paths, no path has more than a sixtieth of them.  The nodes of the next
levels, where a group may be all there is, are merged in every task before they are
shuffled.  Nothing is capped: what a bound does not take is branched on.

Defined results: a document without words (null, empty or white space) has an
empty set and is its own component; fewer words than ``n`` give one shingle.
Repeated rows and copies are one class.  Rows with a null id take part, but a null
id is never the smallest: a component of null ids only has a null component id,
and ``kept`` compares null with null as equal.  Very long texts are read whole.  An
empty table gives an empty result.  Other columns are not read.  Bytes that are
not UTF-8 are letters of their words.  Shingles are told apart by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripstar.llm.blocks import Block, give_back, n_buckets, stage_parts, unpack, write_bucketed
from tripstar.llm.components import components, written
from tripstar.llm.kernels import distinct_per_doc, mix, shingles, word_hashes, word_spans

N = 2
THRESHOLD = 80
EMBED = 128
DEPTH = 3
RECALL = 0.9999
MEET_DEPTH = 5  # levels that two classes at the threshold survive together, in the count of trees
NODE_SETS = 3_000
TASK_SETS = 8  # a task holds at most this many times NODE_SETS classes of a node
TASK_TOKENS = 16 << 20  # and this many shingles
LEVELS = 2  # levels of a branch between two looks at the nodes
MAX_DEPTH = 24  # nodes this deep are compared whatever their size
STAR = 1_000
DEVIATIONS = 4
OPEN_DEVIATIONS = 6  # of the pairs of small nodes

_rng = np.random.Generator(np.random.PCG64(12))
_FACTORS = _rng.integers(0, 2**63, EMBED, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADDENDS = _rng.integers(0, 2**63, EMBED, dtype=np.uint64)
_TREES = _rng.integers(0, 2**63, 4096, dtype=np.uint64)


def trees_for(recall: float = RECALL, threshold: int = THRESHOLD, depth: int = MEET_DEPTH) -> int:
    """Independent trees in which two classes at the threshold meet at a node of
    the given depth at least once, with probability ``recall``."""
    shared = threshold / 100 * EMBED
    meet = 1.0
    for _ in range(depth):
        meet = 1 - (1 - meet / shared) ** shared
    return math.ceil(math.log(1 - recall) / math.log(1 - meet))


def sets_of(block: Block, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of the block's documents and the owner of each."""
    buf, off = np.frombuffer(block.data, np.uint8), block.offsets
    starts, ends, w_off = word_spans(buf, off)
    return distinct_per_doc(*shingles(word_hashes(buf, starts, ends, lower=True), w_off, n))


def embedded(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Minwise tokens (set, EMBED) of consecutive non-empty sets."""
    out = np.empty((len(starts), EMBED), np.uint32)
    for j in range(EMBED):
        out[:, j] = np.minimum.reduceat((hashes * _FACTORS[j] + _ADDENDS[j]) >> np.uint64(32), starts)
    return out


def branch(tokens: np.ndarray, owner: np.ndarray, paths: np.ndarray, threshold: int, chunk: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """One level: the children (owner, path) of the paths that sets are on."""
    limit = np.uint64(min(2**64 - 1, int(2**64 / (threshold / 100 * EMBED))))
    own, out = [], []
    for k in range(0, len(paths), chunk):
        v = mix(tokens[owner[k:k + chunk]] ^ paths[k:k + chunk, None])
        r, c = np.nonzero(v < limit)
        own.append(owner[k:k + chunk][r])
        out.append(mix(v[r, c] * np.uint64(0x9FB21C651E98DF25) + np.uint64(1)))
    return (np.concatenate(own) if own else owner[:0]), (np.concatenate(out) if out else paths[:0])


def places(sketch: np.ndarray) -> np.ndarray:
    """Tokens with their place, as 64-bit numbers."""
    return mix((np.arange(EMBED, dtype=np.uint64) << np.uint64(32)) + sketch.astype(np.uint64))


def _sketches(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, EMBED)


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity by the share of equal codes (the low byte of each token)."""
    same = np.count_nonzero(a == b, axis=-1) / EMBED
    return (same - 1 / 256) / (1 - 1 / 256)


def cutoff(threshold: int, deviations: int = DEVIATIONS) -> float:
    s = threshold / 100
    return s - deviations * math.sqrt(s * (1 - s) / EMBED)


def sizes_fit(a, b, threshold: int):
    """Two sets of such sizes can reach the threshold."""
    return 100 * np.minimum(a, b) >= threshold * np.maximum(a, b)


_ROWS = "part int, row long, doc_id long, n_shingles long, digest binary, sketch binary"
_ROWS_ARROW = pa.schema([("part", pa.int32()), ("row", pa.int64()), ("doc_id", pa.int64()), ("n_shingles", pa.int64()),
                         ("digest", pa.binary()), ("sketch", pa.binary())])


def _sketch_part(n: int):
    def run(key, table):
        give_back()
        part, at, seen, out = key[0].as_py(), 0, set(), []
        for block in unpack(table):
            h, owner = sets_of(block, n)
            bounds = np.searchsorted(owner, np.arange(len(block.lens) + 1))
            full = np.flatnonzero(np.diff(bounds))
            tokens = dict(zip(full.tolist(), embedded(h, bounds[full]) if len(full) else ()))
            for k, doc_id in enumerate(block.id_list()):
                size, digest, sketch = int(bounds[k + 1] - bounds[k]), None, None
                if size:
                    digest = hashlib.blake2b(h[bounds[k]:bounds[k + 1]].tobytes(), digest_size=16).digest()
                    if digest not in seen:  # the first of its set in this part
                        seen.add(digest)
                        sketch = tokens[k].tobytes()
                out.append((part, (part << 32) + at + k, doc_id, size, digest, sketch))
            at += len(block.lens)
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[]] * 6, _ROWS_ARROW)], schema=_ROWS_ARROW)

    return run


def _class_sketches(key, left, right):
    """The sketches of the classes among the rows of one part."""
    kept = left.filter(pa.array(np.isin(left.column("row").to_numpy(), right.column("node").to_numpy())))
    return kept.select(["row", "n_shingles", "sketch"]).rename_columns(["node", "size", "sketch"])


def _first_paths(trees: int, threshold: int):
    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                some = batch.slice(k, 256)
                tokens = places(_sketches(some.column(1)))
                owner = np.repeat(np.arange(len(tokens)), trees)
                paths = np.tile(_TREES[:trees], len(tokens))
                for _ in range(DEPTH):
                    owner, paths = branch(tokens, owner, paths, threshold)
                yield pa.RecordBatch.from_arrays([pa.array(paths.view(np.int64)), pa.array(some.column(0).to_numpy()[owner])],
                                                 names=["path", "node"])

    return run


def _next_paths(threshold: int):
    """(path, node, sketch) -> (path, node), ``LEVELS`` deeper."""
    def run(batches):
        for batch in batches:
            tokens = places(_sketches(batch.column(2)))
            owner, paths = np.arange(len(tokens)), batch.column(0).to_numpy().view(np.uint64)
            for _ in range(LEVELS):
                owner, paths = branch(tokens, owner, paths, threshold)
            yield pa.RecordBatch.from_arrays([pa.array(paths.view(np.int64)), pa.array(batch.column(1).to_numpy()[owner])],
                                             names=["path", "node"])

    return run


def _codes(column: pa.Array) -> np.ndarray:
    return _sketches(column).astype(np.uint8)


def _shorten(batches):
    for batch in batches:
        codes = _codes(batch.column(2))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([c.tobytes() for c in codes], pa.binary())],
                                         names=["node", "size", "code"])


def _bytes(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, EMBED)


def _likely(threshold: int):
    """(a, b, size_a, code_a, size_b, code_b) -> (a, b, near) of the pairs that may link."""
    def run(batches):
        for x in batches:
            if not x.num_rows:
                continue
            near = estimate(_bytes(x.column(3)), _bytes(x.column(5)))
            keep = pa.array((near >= cutoff(threshold)) & sizes_fit(x.column(2).to_numpy(), x.column(4).to_numpy(), threshold))
            yield pa.RecordBatch.from_arrays([x.column(0), x.column(1), pa.array(near)], names=["a", "b", "near"]).filter(keep)

    return run


def _groups(batches, keys: int):
    """Rows of one group at a time, from batches sorted by their first columns."""
    held, current = [], None
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            if row[:keys] != current:
                if held:
                    yield held
                held, current = [], row[:keys]
            held.append(row)
    if held:
        yield held


def overlaps(sets: list[np.ndarray], some: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets ``some`` with all, by products of
    0/1 matrices over stretches of the tokens that two or more sets hold."""
    flat, lens = np.concatenate(sets), np.array([len(s) for s in sets])
    values, token, counts = np.unique(flat, return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), lens)
    held = np.zeros(len(values), bool)
    held[token[np.isin(owner, some)]] = True
    use = held & (counts > 1)
    column = np.cumsum(use) - 1
    at = np.flatnonzero(use[token])
    at = at[np.argsort(column[token[at]], kind="stable")]
    column, owner = column[token[at]], owner[at]
    out = np.zeros((len(some), len(sets)), np.float32)
    width = max(64, (4 << 20) // len(sets))
    for k in range(0, int(use.sum()), width):
        lo, hi = np.searchsorted(column, [k, k + width])
        held_by = np.zeros((len(sets), width), np.float32)
        held_by[owner[lo:hi], column[lo:hi] - k] = 1
        out += held_by[some] @ held_by.T
    return out


def _open_members(threshold: int):
    """(path, name, node, label, size, code, names) -> the members that sizes and
    minwise tokens let link to another component of their node, by pairs that no node
    of a smaller name has.  ``names`` are those of all small nodes of a member."""
    least = cutoff(threshold, OPEN_DEVIATIONS)

    def run(batches):
        for rows in _groups(batches, 2):
            size, name = np.array([r[4] for r in rows]), rows[0][1]
            codes = np.frombuffer(b"".join(r[5] for r in rows), np.uint8).reshape(-1, EMBED)
            _, label, counts = np.unique([r[3] for r in rows], return_inverse=True, return_counts=True)
            before = [[x for x in r[6] if x < name] for r in rows]
            at = np.cumsum([0] + [len(x) for x in before])
            _, earlier = np.unique(np.array([x for some in before for x in some], np.int64), return_inverse=True)
            mine, seen = np.zeros(len(earlier), bool), np.zeros(len(earlier) + 1, np.int64)
            keep = np.zeros(len(rows), bool)
            for i in np.flatnonzero(label != np.argmax(counts)):
                near = np.flatnonzero((label != label[i]) & sizes_fit(size[i], size, threshold))
                near = near[estimate(codes[i], codes[near]) >= least]
                if len(near):
                    mine[earlier[at[i]:at[i + 1]]] = True
                    np.cumsum(mine[earlier], out=seen[1:])
                    mine[:] = False
                    near = near[seen[at[near + 1]] == seen[at[near]]]
                if len(near):
                    keep[near] = keep[i] = True
            kept = [(r[0], *r[2:5]) for r, k in zip(rows, keep) if k]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*kept) if kept else [[]] * 4)],
                                             names=["path", "node", "label", "size"])

    return run


def _compare_nodes(threshold: int):
    """Links between the components of a node's members (path, node, label, size,
    tokens): as many as unite what the node's links unite."""
    def run(batches):
        for rows in _groups(batches, 1):
            node = np.array([r[1] for r in rows])
            size = np.array([r[3] for r in rows])
            sets = [np.frombuffer(r[4], np.uint32) for r in rows]
            names, label, counts = np.unique([r[2] for r in rows], return_inverse=True, return_counts=True)
            del rows
            outside = np.flatnonzero(label != np.argmax(counts))
            both = overlaps(sets, outside)
            up = np.arange(len(names))  # the components that links have united
            a, b = [], []
            for i, shared in zip(outside, both):
                row = np.flatnonzero((100 * shared >= threshold * (size[i] + size - shared)) & (up[label] != up[label[i]]))
                _, first = np.unique(up[label[row]], return_index=True)  # one link to each other component
                for j in row[first].tolist():
                    if up[label[i]] != up[label[j]]:
                        a.append(min(node[i], node[j]))
                        b.append(max(node[i], node[j]))
                        up[up == up[label[j]]] = up[label[i]]
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def _pick_short(n: int, seed: int):
    """The sets of the wanted documents of one part, as 32-bit hashes."""
    def run(key, left, right):
        give_back()
        node, at = np.unique(right.column("node").to_numpy()), 0
        place, tokens = node & 0xFFFFFFFF, []
        for block in unpack(left):
            wanted = place[(place >= at) & (place < at + len(block.lens))] - at
            if len(wanted):
                tokens += [((mix(h + np.uint64(seed))) >> np.uint64(32)).astype(np.uint32).tobytes() for h in _few_sets(block, wanted, n)]
            at += len(block.lens)
        return pa.Table.from_arrays([pa.array(node, pa.int64()), pa.array(tokens, pa.binary())], names=["node", "tokens"])

    return run


def _few_sets(block: Block, wanted: np.ndarray, n: int) -> list[np.ndarray]:
    texts = block.texts()
    few = [texts[k] for k in wanted]
    h, owner = sets_of(Block(wanted, wanted < 0, np.array([len(t) for t in few], np.int64), wanted < 0, b"".join(few)), n)
    bounds = np.searchsorted(owner, np.arange(len(few) + 1))
    return [h[bounds[j]:bounds[j + 1]] for j in range(len(few))]


_SETS = "a long, deal long, kind int, node long, tokens binary"


def _pick(n: int):
    """The sets of the wanted documents of one part."""
    def run(key, left, right):
        give_back()
        node = right.column("node").to_numpy() & 0xFFFFFFFF
        tokens, at = {}, 0
        for block in unpack(left):
            wanted = np.unique(node[(node >= at) & (node < at + len(block.lens))]) - at
            if len(wanted):
                tokens.update((at + k, h.tobytes()) for k, h in zip(wanted.tolist(), _few_sets(block, wanted, n)))
            at += len(block.lens)
        return pa.Table.from_arrays([right.column("a"), right.column("deal"), right.column("kind"), right.column("node"),
                                     pa.array([tokens[k] for k in node.tolist()], pa.binary())],
                                    names=["a", "deal", "kind", "node", "tokens"])

    return run


def _confirm(threshold: int):
    """Links (a, b) of stars whose centre comes first: one set at a time."""
    def run(batches):
        centre, key = None, None
        for batch in batches:
            a, b = [], []
            for x, deal, kind, node, tokens in zip(*[c.to_pylist() for c in batch.columns]):
                have = np.frombuffer(tokens, np.uint64)
                if kind == 0:
                    centre, key = have, (x, deal)
                elif key == (x, deal):
                    both = len(np.intersect1d(centre, have, assume_unique=True))
                    if 100 * both >= threshold * (len(centre) + len(have) - both):
                        a.append(x)
                        b.append(node)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def part_of(row: str) -> Column:
    return F.shiftright(row, 32).cast("int")


def _merged(paths: DataFrame) -> DataFrame:
    """(path, k, hub, members) of the nodes: how many classes, the smallest, a hash of all."""
    return paths.groupBy("path").agg(F.count(F.lit(1)).alias("k"), F.min("node").alias("hub"),
                                     F.bit_xor(F.xxhash64("node")).alias("members"))


def _met(paths: DataFrame) -> DataFrame:
    """The paths (path, node) that two classes or more are on, with their node as in
    :func:`_merged`, by one shuffle of the pairs."""
    here = Window.partitionBy("path")
    met = paths.select("path", "node", F.count(F.lit(1)).over(here).alias("k")).where("k > 1")
    return met.withColumns({"hub": F.min("node").over(here), "members": F.bit_xor(F.xxhash64("node")).over(here)})


class _Search:
    """The state of a search: staged texts, class sketches, pairs already
    confirmed or refuted, and the components of the links found so far."""

    def __init__(self, staged: DataFrame, sketches: DataFrame, n: int, threshold: int):
        self.staged, self.sketches, self.n, self.threshold = staged, sketches, n, threshold
        self.codes = written(sketches.select("node", "size", "sketch").mapInArrow(_shorten, "node long, size long, code binary"), "codes")
        self.labels: DataFrame | None = None  # (node, label) of the classes with links
        self.tested: DataFrame | None = None

    def labelled(self, df: DataFrame, column: str, name: str) -> DataFrame:
        if self.labels is None:
            return df.withColumn(name, F.col(column))
        found = self.labels.select(F.col("node").alias(column), F.col("label").alias("_label"))
        return df.join(found, column, "left").withColumn(name, F.coalesce("_label", column)).drop("_label")

    def apart(self, pairs: DataFrame) -> DataFrame:
        """The pairs that are not known and whose classes are not connected."""
        if self.tested is not None:
            pairs = pairs.join(self.tested, ["a", "b"], "left_anti")
        if self.labels is None:
            return pairs
        names = pairs.columns
        return self.labelled(self.labelled(pairs, "a", "la"), "b", "lb").where("la <> lb").select(*names)

    def likely(self, pairs: DataFrame) -> DataFrame:
        """(a, b, near) of the pairs that sizes and minwise tokens do not rule out."""
        for x in "ab":
            pairs = pairs.join(self.codes.toDF(x, f"size_{x}", f"code_{x}"), x)
        return pairs.select("a", "b", "size_a", "code_a", "size_b", "code_b").mapInArrow(
            _likely(self.threshold), "a long, b long, near double")

    def confirm(self, pairs: DataFrame) -> DataFrame:
        """Compare the full sets of pairs (a, b) and unite what links; the links."""
        counts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / STAR).cast("long").alias("deals"))
        dealt = pairs.join(counts, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("deals")).alias("deal"))
        wanted = (dealt.select("a", "deal", F.lit(1).alias("kind"), F.col("b").alias("node"))
                       .union(dealt.select("a", "deal").distinct().select("a", "deal", F.lit(0), F.col("a"))))
        wanted = wanted.withColumn("part", part_of("node"))
        sets = self.staged.groupBy("part").cogroup(wanted.groupBy("part")).applyInArrow(_pick(self.n), _SETS)
        links = written(sets.repartition(n_buckets(pairs.sparkSession), "a", "deal").sortWithinPartitions("a", "deal", "kind")
                            .mapInArrow(_confirm(self.threshold), "a long, b long"), "links-found")
        known = pairs.select("a", "b")
        self.tested = known if self.tested is None else written(self.tested.unionByName(known), "tested")
        if links.isEmpty():
            return links
        if self.labels is None:
            self.labels = components(links)
            return links
        ends = self.labelled(self.labelled(links, "a", "la"), "b", "lb")
        merged = components(ends.select(F.col("la").alias("a"), F.col("lb").alias("b")))
        old = self.labels.unionByName(merged.select("node", F.col("node").alias("label"))).groupBy("node").agg(F.min("label").alias("old"))
        self.labels = written(old.join(merged.select(F.col("node").alias("old"), "label"), "old", "left")
                                 .select("node", F.coalesce("label", "old").alias("label")), "labels")
        return links

    def stars(self, inside: DataFrame) -> None:
        """Every member with the smallest class of its node: the best such pair of
        each class first, then those that are still apart."""
        pairs = inside.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
        pairs = written(self.likely(self.apart(pairs)), "stars")
        best = written(pairs.groupBy("b").agg(F.max_by("a", F.struct("near", "a")).alias("a")).select("a", "b"), "best-pairs")
        if best.isEmpty():
            return
        self.confirm(best)
        rest = written(self.apart(pairs.select("a", "b")), "rest-pairs")
        if not rest.isEmpty():
            self.confirm(rest)

    def open_nodes(self, inside: DataFrame, node_sets: int, last: bool) -> DataFrame:
        """(path, node, label, size, small) of the nodes with several components."""
        inside = self.labelled(inside.where("k > 2"), "node", "label")
        parts = inside.groupBy("path", "label").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("tokens")).groupBy("path").agg(
            F.sum("n").alias("k"), F.max("n").alias("largest"), F.sum("tokens").alias("tokens"))
        fits = (F.expr("(k - largest) * k") <= node_sets**2) & (F.col("k") <= node_sets * TASK_SETS) & (F.col("tokens") <= TASK_TOKENS)
        parts = parts.where("largest < k").select("path", (fits | F.lit(last)).alias("small"))
        return written(inside.join(parts, "path").select("path", "node", "label", "size", "small"), "open-nodes")

    def compare(self, small: DataFrame, seed: int) -> bool:
        """Compare the members of small nodes; whether every link found holds."""
        n_parts = n_buckets(small.sparkSession)
        named = small.withColumn("name", F.hash("path"))
        names = named.groupBy("node").agg(F.collect_list("name").alias("names"))
        small = written(named.join(self.codes.select("node", "code"), "node").join(names, "node")
                             .select("path", "name", "node", "label", "size", "code", "names")
                             .repartition(n_parts, "path").sortWithinPartitions("path")
                             .mapInArrow(_open_members(self.threshold), "path long, node long, label long, size long"), "open-members")
        wanted = small.select("node").distinct().withColumn("part", part_of("node"))
        sets = self.staged.groupBy("part").cogroup(wanted.groupBy("part")).applyInArrow(_pick_short(self.n, seed), "node long, tokens binary")
        found = (small.join(sets, "node").select("path", "node", "label", "size", "tokens")
                      .repartition(n_parts, "path").sortWithinPartitions("path")
                      .mapInArrow(_compare_nodes(self.threshold), "a long, b long").distinct())
        found = written(found, "open-links")
        n = found.count()
        return not n or self.confirm(found).count() == n

    def level(self, paths: DataFrame, depth: int, node_sets: int) -> DataFrame | None:
        """Look at the nodes of one level; the paths of the next, if any."""
        if depth == DEPTH:
            paths = written(_met(paths), "paths")
            nodes = paths.where("node = hub")
        else:
            paths = written(paths, "paths")
            nodes = _merged(paths).where("k > 1")
        nodes = written(nodes.groupBy("members", "k").agg(F.min("path").alias("path"), F.min("hub").alias("hub")).select("path", "k", "hub"), "nodes")
        inside = written(paths.select("path", "node").join(nodes, "path").join(self.codes.select("node", "size"), "node"), "node-members")
        self.stars(inside)
        seed, last = 0, depth >= MAX_DEPTH
        open_ = self.open_nodes(inside, node_sets, last)
        while not self.compare(open_.where("small"), seed):  # two short hashes met: once more, with others
            seed, open_ = seed + 1, self.open_nodes(inside, node_sets, last)
        large = open_.where("NOT small")
        if large.isEmpty():
            return None
        return (large.select("path", "node").join(self.sketches, "node").select("path", "node", "sketch")
                     .mapInArrow(_next_paths(self.threshold), "path long, node long"))


def near_duplicates(docs: DataFrame, n: int = N, threshold: int = THRESHOLD, recall: float = RECALL, id_col: str = "doc_id",
                    text_col: str = "text", node_sets: int = NODE_SETS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row."""
    staged = stage_parts(docs, id_col, text_col, "minwise_texts")
    rows = write_bucketed(staged.groupBy("part").applyInArrow(_sketch_part(n), _ROWS), "minwise_sketches")
    classes = written(rows.where("digest IS NOT NULL").groupBy("digest").agg(F.min("row").alias("node")), "classes")
    sketches = written(rows.where("sketch IS NOT NULL").select("part", "row", "n_shingles", "sketch").groupBy("part")
                           .cogroup(classes.select("node", part_of("node").alias("part")).groupBy("part"))
                           .applyInArrow(_class_sketches, "node long, size long, sketch binary"), "class-sketches")

    search = _Search(staged, sketches, n, threshold)
    paths, depth = sketches.select("node", "sketch").mapInArrow(_first_paths(trees_for(recall, threshold), threshold),
                                                                "path long, node long"), DEPTH
    while paths is not None:
        paths, depth = search.level(paths, depth, node_sets), depth + LEVELS

    # from classes back to documents
    label = search.labelled(classes, "node", "label")
    placed = (rows.select("row", "doc_id", "n_shingles", "digest").join(label.select("digest", "label"), "digest", "left")
                  .select("doc_id", "n_shingles", F.coalesce("label", "row").alias("label")))
    lowest = placed.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    return placed.join(lowest, "label").select("doc_id", "n_shingles", "component_id",
                                               F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
