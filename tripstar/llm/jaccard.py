"""Op 9, n-gram Jaccard join with prefix trees.

Documents link when the Jaccard similarity of their sets of word n-grams
reaches ``threshold`` percent; the result is the component of each document.

1. Texts are staged once by scan task (``part``).  Each task sends the distinct
   shingles it holds with their document counts, by hash bucket; a bucket
   answers each shingle's total count.  Shingles of one document cannot be
   shared: a document with too many of them cannot link with another text, and
   ends here.
2. The documents that are left keep the shingles that others hold, in the
   global order (rarest first).  Equal sets are one *class*.  Two classes that
   link share a shingle of their prefixes, so classes that meet on a prefix
   shingle, directly or over others, form a *block* (components of a star per
   shingle: ids only, no pairs).
3. The sets of a block meet in one task, which stores them in a prefix tree and
   probes it, sharing the overlaps of common paths and leaving subtrees by their
   remaining-length bounds (:mod:`tripstar.llm.trie`).
4. A block larger than ``BLOCK_SETS`` is dealt into tiles that all hold the same
   few pivots.  If the tiles' components do not become one, the classes outside
   the largest component are compared with all others, tile by tile, so no task
   holds more than two tiles and no pair of components is left out.

Defined results: texts are bytes, valid UTF-8 or not, and kept as they are; a document without words (null, empty or white space) has an
empty set and is its own component; fewer words than ``n`` give one shingle;
repeated rows and exact copies are one class; rows with a null id take part,
but a null id is never the smallest, and a component of null ids only has a
null component id; an empty table gives an empty result; other columns are not
read.  Shingles are told apart by 64-bit hashes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tripstar.llm.blocks import (block_order, expand, give_back, n_buckets, squeeze, stage_parts, unpack, whole_rows,
                                 write_bucketed)
from tripstar.llm.components import components, written
from tripstar.llm.kernels import distinct_per_doc, shingles, word_hashes, word_spans
from tripstar.llm.trie import link_groups

N = 3
THRESHOLD = 90
NEAR_N, NEAR_THRESHOLD = 5, 80  # near duplicates
BLOCK_SETS = 10_000
PIVOTS = 8


def _sets(block, n: int):
    """Distinct shingles of the block's documents and the owner of each."""
    buf, off = np.frombuffer(block.data, np.uint8), block.offsets
    starts, ends, w_off = word_spans(buf, off)
    return distinct_per_doc(*shingles(word_hashes(buf, starts, ends, lower=True), w_off, n))


def _cuts(h: np.ndarray, n: int) -> np.ndarray:
    edges = np.array([((b << 32) + n - 1) // n << 32 for b in range(1, n)], dtype=np.uint64)
    return np.concatenate([[0], np.searchsorted(h, edges), [len(h)]])


class _Part:
    """The sets of one part and its distinct shingles in hash order."""

    def __init__(self, table: pa.Table, n_gram: int, n: int):
        blocks = list(unpack(table))
        sets = [_sets(b, n_gram) for b in blocks]
        self.ids = [i for b in blocks for i in b.id_list()]
        base = np.concatenate([[0], np.cumsum([len(b.lens) for b in blocks])]).astype(np.int64)
        del blocks
        self.owner = np.concatenate([o + base[k] for k, (_, o) in enumerate(sets)] or [np.zeros(0, np.int64)]).astype(np.int32)
        self.hash = np.concatenate([h for h, _ in sets] or [np.zeros(0, np.uint64)])
        del sets
        self.values, self.place, self.counts = np.unique(self.hash, return_inverse=True, return_counts=True)
        self.cuts, self.n = _cuts(self.values, n), n

    def asked(self, part: int):
        bits = np.uint64(max(0, int(self.n - 1).bit_length() - 1))
        for b in range(self.n):
            v = self.values[self.cuts[b]:self.cuts[b + 1]]
            if len(v):
                low = ((v << bits) >> np.uint64(32)).astype(np.int64)
                yield (part, b, squeeze(np.diff(low, prepend=0).astype(np.uint32)),
                       squeeze(np.minimum(self.counts[self.cuts[b]:self.cuts[b + 1]], 255).astype(np.uint8)))

    def frequency(self, answers: pa.Table) -> np.ndarray:
        df = np.zeros(len(self.values), np.uint8)
        for k, b in enumerate(answers.column("bucket").to_pylist()):
            df[self.cuts[b]:self.cuts[b + 1]] = expand(answers.column("df")[k].as_py(), np.uint8)
        return df[self.place]


_ASK = "part int, bucket int, shingles binary, counts binary"
_ASK_ARROW = pa.schema([("part", pa.int32()), ("bucket", pa.int32()), ("shingles", pa.binary()), ("counts", pa.binary())])
_DF = "part int, bucket int, df binary"
_DF_ARROW = pa.schema([("part", pa.int32()), ("bucket", pa.int32()), ("df", pa.binary())])
_SETS = "part int, row long, doc_id long, n_shingles long, digest binary, tokens binary, prefix int"
_SETS_ARROW = pa.schema([("part", pa.int32()), ("row", pa.int64()), ("doc_id", pa.int64()), ("n_shingles", pa.int64()),
                         ("digest", pa.binary()), ("tokens", pa.binary()), ("prefix", pa.int32())])


def _rows(rows, schema: pa.Schema) -> pa.Table:
    return pa.Table.from_arrays([pa.array([r[j] for r in rows], f.type) for j, f in enumerate(schema)], schema=schema)


def _candidates(part: int, data: _Part, df: np.ndarray, threshold: int):
    """A row per document; sets only where a link to another row is possible,
    and once per distinct set of the part."""
    bounds = np.searchsorted(data.owner, np.arange(len(data.ids) + 1))
    seen = set()
    for k, doc_id in enumerate(data.ids):
        lo, hi = bounds[k], bounds[k + 1]
        n = int(hi - lo)
        shared = df[lo:hi] > 1
        need = (threshold * n + 99) // 100  # shingles that any partner shares
        alone = n - int(shared.sum())
        row = (part << 32) + k
        if not n or alone > n - need:
            yield part, row, doc_id, n, None, None, None
            continue
        h = data.hash[lo:hi]
        digest = hashlib.blake2b(h.tobytes(), digest_size=16).digest()
        if digest in seen:
            yield part, row, doc_id, n, digest, None, None
            continue
        seen.add(digest)
        h, f = h[shared], df[lo:hi][shared]
        tokens = h[np.lexsort((h, f))]
        yield part, row, doc_id, n, digest, tokens.tobytes(), n - need + 1 - alone


def _prefixes(sets: DataFrame) -> DataFrame:
    """(digest, row, shingle) for the prefix of every distinct set of a part."""
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                b = batch.slice(at, 256)
                tokens = [np.frombuffer(t.as_py(), np.int64)[:p] for t, p in zip(b.column(1), b.column(2).to_pylist())]
                n = np.array([len(t) for t in tokens])
                node = np.repeat(np.asarray(b.column(0)), n)
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(np.concatenate(tokens) if len(tokens) else np.zeros(0, np.int64))],
                                                 names=["row", "shingle"])

    return (sets.where("tokens IS NOT NULL").select("row", "tokens", "prefix")
                .mapInArrow(run, "row long, shingle long"))


_TILE = "block long, tile long, node long, n_shingles long, label long, tokens binary"
_LINK_ARROW = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _stream_groups(batches, keys: int):
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


def _join_tiles(tiles: DataFrame, threshold: int) -> DataFrame:
    """Links (node, smallest node of its group) inside every tile."""
    def run(batches):
        for rows in _stream_groups(batches, 2):
            sets = [np.frombuffer(r[5], np.uint64) for r in rows]
            group = link_groups(sets, np.array([r[3] for r in rows]), threshold)
            nodes = np.array([r[2] for r in rows])
            low = np.full(group.max() + 1, np.iinfo(np.int64).max)
            np.minimum.at(low, group, nodes)
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(low[group])], schema=_LINK_ARROW)

    return (tiles.repartition(n_buckets(tiles.sparkSession), "block", "tile").sortWithinPartitions("block", "tile")
                 .select("block", "tile", "node", "n_shingles", "label", "tokens").mapInArrow(run, "a long, b long"))


def join(docs: DataFrame, n: int = N, threshold: int = THRESHOLD, id_col: str = "doc_id", text_col: str = "text",
         block_sets: int = BLOCK_SETS) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row."""
    placed = _placed(stage_parts(docs, id_col, text_col, "jaccard_texts"), n, threshold, block_sets)
    lowest = placed.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    return placed.join(lowest, "label").select("doc_id", "n_shingles", "component_id")


def keep_first(docs: DataFrame, n: int = NEAR_N, threshold: int = NEAR_THRESHOLD, id_col: str = "doc_id",
               text_col: str = "text", block_sets: int = BLOCK_SETS) -> DataFrame:
    """One row of each component, all columns kept: the one with the smallest
    id, and the first of its copies."""
    staged = stage_parts(docs, id_col, text_col, "jaccard_texts", carry=True)
    placed = _placed(staged.drop("rest"), n, threshold, block_sets)
    first = (placed.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first"))
                   .select(F.expr("CAST(shiftright(first.row, 32) AS INT)").alias("part"), F.col("first.row").alias("row")))
    text_at = docs.columns.index(text_col)
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    schema = plain.withColumn(f"c{text_at}", F.col(f"c{text_at}").cast("string")).schema

    def keep(key, left, right):
        give_back()
        wanted = np.sort(right.column("row").to_numpy()) & 0xFFFFFFFF
        out, at = [], 0
        for k, block in zip(block_order(left), unpack(left)):
            n_rows = len(block.lens)
            lo, hi = np.searchsorted(wanted, [at, at + n_rows])
            if lo < hi:
                mark = np.zeros(n_rows, bool)
                mark[wanted[lo:hi] - at] = True
                out.append(whole_rows(block, left.column("rest")[k].as_py(), text_at, mark))
            at += n_rows
        return pa.concat_tables(out) if out else to_arrow_schema(schema).empty_table()

    kept = staged.groupBy("part").cogroup(first.groupBy("part")).applyInArrow(keep, schema)
    return kept.toDF(*docs.columns)


def _placed(staged: DataFrame, n: int, threshold: int, block_sets: int) -> DataFrame:
    """(row, doc_id, n_shingles, label) for every row; rows of a component
    share their label."""
    buckets = n_buckets(staged.sparkSession)

    def ask(key, table):
        give_back()
        return _rows(list(_Part(table, n, buckets).asked(key[0].as_py())), _ASK_ARROW)

    def count(table):
        give_back()
        asked = [np.cumsum(expand(b.as_py(), np.uint32), dtype=np.uint32) for b in table.column("shingles")]
        counts = [expand(b.as_py(), np.uint8) for b in table.column("counts")]
        values, at = np.unique(np.concatenate(asked), return_inverse=True)
        total = np.minimum(np.bincount(at, np.concatenate(counts)), 255).astype(np.uint8)
        cuts = np.cumsum([len(a) for a in asked])[:-1]
        return _rows(list(zip(table.column("part").to_pylist(), table.column("bucket").to_pylist(),
                              map(squeeze, np.split(total[at], cuts)))), _DF_ARROW)

    def candidates(key, left, right):
        give_back()
        if not left.num_rows:
            return _rows([], _SETS_ARROW)
        data = _Part(left, n, buckets)
        return _rows(list(_candidates(key[0].as_py(), data, data.frequency(right), threshold)), _SETS_ARROW)

    answers = staged.groupBy("part").applyInArrow(ask, _ASK).groupBy("bucket").applyInArrow(count, _DF)
    rows = write_bucketed(staged.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(candidates, _SETS), "jaccard_sets")

    # classes: rows with equal sets; a class is named by its smallest row
    member = rows.where("digest IS NOT NULL").select("row", "digest")
    classes = written(member.groupBy("digest").agg(F.min("row").alias("node")), "classes")
    member = written(member.join(classes, "digest").select("row", "node"), "members")
    nodes = member.where("row = node").select("node")

    # blocks: classes that meet on prefix shingles.  A shingle's star leads to
    # its smallest class; equal sets of other parts name the same classes.
    prefix = written(_prefixes(rows).join(nodes.select(F.col("node").alias("row")), "row", "left_semi")
                     .select(F.col("row").alias("node"), "shingle"), "prefixes")
    star = prefix.groupBy("shingle").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("k")).where("k > 1")
    blocks = components(prefix.join(star, "shingle").where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")))
    blocks = written(blocks.select("node", F.col("label").alias("block")), "blocks")
    links = _links(rows, blocks, threshold, block_sets)

    # from classes back to documents
    label = F.coalesce("label", "node", "row").alias("label")
    return (rows.select("row", "doc_id", "n_shingles").join(member, "row", "left")
                .join(links, "node", "left").select("row", "doc_id", "n_shingles", label))


def _links(rows: DataFrame, blocks: DataFrame, threshold: int, block_sets: int) -> DataFrame:
    """(node, label) by the links inside every block."""
    sizes = blocks.groupBy("block").agg(F.count(F.lit(1)).alias("k"))
    large = sizes.where(F.col("k") > block_sets)
    small = _gather(rows, blocks.join(large, "block", "left_anti").select("node", "block", F.lit(0).cast("long").alias("tile"),
                                                                           F.lit(None).cast("long").alias("label")))
    found = written(_join_tiles(small, threshold), "small-links")
    if large.isEmpty():
        return found.select(F.col("a").alias("node"), F.col("b").alias("label"))

    # tiles of one large block share its pivots (its smallest classes by hash)
    members = written(blocks.join(large, "block")
                      .withColumn("tiles", F.ceil(F.col("k") / block_sets).cast("long"))
                      .withColumn("spot", F.xxhash64("node")), "large-blocks")
    step = F.greatest(F.lit(1).cast("long"), (F.col("k") / PIVOTS).cast("long"))
    pivots = members.where(F.pmod(F.xxhash64("node", F.lit(2)), step) == 0).select("node", "block")  # about PIVOTS a block
    dealt = members.select("node", "block", F.pmod("spot", F.col("tiles")).alias("tile"))
    shared = (pivots.join(members.select("node", "tiles"), "node")
                    .select("node", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).alias("tile")))
    none = F.lit(None).cast("long").alias("label")
    first = components(_join_tiles(_gather(rows, dealt.union(shared).distinct().select("*", none)), threshold))
    state = written(members.join(first, "node", "left").select(
        "node", "block", "tiles", "spot", F.coalesce("label", "node").alias("label")), "large-labels")

    # classes outside the largest component of the block against all others
    per = state.groupBy("block", "label").agg(F.count(F.lit(1)).alias("k"))
    largest = per.groupBy("block").agg(F.max_by("label", F.struct("k", "label")).alias("top"), F.count(F.lit(1)).alias("parts"),
                                       (F.sum("k") - F.max("k")).alias("outside")).where("parts > 1")
    open_ = state.join(largest, "block").withColumn("deals", F.ceil(F.col("outside") / block_sets).cast("long"))
    outside = open_.where("label <> top").withColumn("deal", F.pmod(F.xxhash64("node", F.lit(1)), F.col("deals")))
    against = open_.select("node", "block", "label", F.pmod("spot", "tiles").alias("t"), "deals", "tiles")
    width = 1 << 24
    pairs = (outside.select("node", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).alias("t"), "deal")
             .select("node", "block", (F.col("deal") * width + F.col("t")).alias("tile"))
             .union(against.select("node", "block", "t", F.explode(F.sequence(F.lit(0).cast("long"), F.col("deals") - 1)).alias("deal"))
                           .select("node", "block", (F.col("deal") * width + F.col("t")).alias("tile"))).distinct())
    second = _join_tiles(_gather(rows, pairs.select("*", none)), threshold)
    merged = components(state.select(F.col("node").alias("a"), F.col("label").alias("b")).unionByName(second))
    rest = state.join(merged, "node", "left").select("node", F.coalesce(merged["label"], F.col("node")).alias("label"))
    return found.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(rest)


def _gather(rows: DataFrame, placed: DataFrame) -> DataFrame:
    """The sets of the placed classes: ids travel to the parts that hold the
    sets, and each set travels once per tile."""
    wanted = placed.select(F.expr("CAST(shiftright(node, 32) AS INT)").alias("part"), "node", "block", "tile", "label")

    def pick(key, left, right):
        give_back()
        at = {r: k for k, r in enumerate(left.column("row").to_pylist())}
        node = right.column("node").to_pylist()
        index = pa.array([at[x] for x in node], pa.int64())
        got = left.take(index)
        return pa.Table.from_arrays([right.column("block"), right.column("tile"), right.column("node"),
                                     got.column("n_shingles"), right.column("label"), got.column("tokens")],
                                    names=["block", "tile", "node", "n_shingles", "label", "tokens"])

    held = rows.where("tokens IS NOT NULL").select("part", "row", "n_shingles", "tokens")
    return held.groupBy("part").cogroup(wanted.groupBy("part")).applyInArrow(pick, _TILE)
