"""Op 7, quality classifier: histogram gradient-boosted trees.

Statistics of a text (character classes, word and line shape, repetition) are
computed inside the scan tasks, in blocks of about one MB.  The trees are
fitted on a bounded sample of labelled rows (``max_rows``, a documented
parameter): rows are kept by a hash of the id, so the sample is the same on
every run.  Fitting works on ``max_rows x len(FEATURES)`` small integers (bin
numbers).  The fitted trees are flattened into arrays (feature, threshold,
children, value), which have a size bound of ``trees x 2**(depth+1)`` nodes, and
every task walks all its rows through them level by level with numpy.

Defined results: texts are bytes, valid UTF-8 or not; a null or empty text has the statistics of an empty text and
is scored like any other; rows without labels are scored; repeated rows get the
same score; labels with a null id or a null label are not learned from; without
labels of both kinds the score is the share of good labels (0.5 if there are
none).  An empty table gives an empty result.  Other columns are not read by
:func:`score` and are passed on by :func:`keep_good`.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstar.llm.blocks import Block, _block, give_back, id_text, iter_blocks, small_batches
from tripstar.llm.kernels import distinct_per_doc, shingles, word_hashes, word_spans

MAX_TRAIN_ROWS = 20_000
KEEP_SCORE = 0.3
HOLD_OUT = 5  # ids whose crc32 is 0 modulo this are never learned from

FEATURES = (
    "log_bytes", "log_words", "word_length", "word_length_sd", "longest_word", "upper", "lower", "high",
    "digit", "space", "newline", "stop", "symbol", "bang", "pipe", "other", "entropy", "log_lines",
    "words_per_line", "distinct_words", "distinct_pairs", "distinct_fives", "caps_words", "symbol_words")

_CLASS = np.zeros(256, dtype=np.int64)
for _name, _bytes in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", bytes(range(128, 256)),
                                b"0123456789", b" \t\r\x0b\x0c", b"\n", b".,;:'\"()-", b"#*$%&<>@~^_=+", b"!?", b"|"), start=1):
    _CLASS[list(_bytes)] = _name
_N_CLASS = 11


def _sum_by(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(values) + 1)
    np.cumsum(values, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _distinct_share(h, owner, n_docs):
    total = np.bincount(owner, minlength=n_docs)
    distinct = np.bincount(distinct_per_doc(h, owner)[1], minlength=n_docs)
    return np.divide(distinct, total, out=np.ones(n_docs), where=total > 0)


def features(block: Block) -> np.ndarray:
    """One row of ``FEATURES`` per document of the block."""
    n = len(block.lens)
    buf, off = np.frombuffer(block.data, np.uint8), block.offsets
    doc = np.repeat(np.arange(n), block.lens)
    per_byte = np.bincount(doc * 256 + buf, minlength=n * 256).reshape(n, 256) if len(buf) else np.zeros((n, 256))
    size = np.maximum(block.lens, 1)[:, None]
    classes = np.zeros((n, _N_CLASS))
    for c in range(_N_CLASS):
        classes[:, c] = per_byte[:, _CLASS == c].sum(axis=1)
    share = per_byte / size
    entropy = -(share * np.log2(np.where(share > 0, share, 1))).sum(axis=1)
    starts, ends, w_off = word_spans(buf, off)
    n_words = np.diff(w_off)
    one = np.maximum(n_words, 1)
    length = (ends - starts).astype(float)
    mean = _sum_by(length, w_off) / one
    sd = np.sqrt(np.maximum(_sum_by(length**2, w_off) / one - mean**2, 0))
    w_doc = np.repeat(np.arange(n), n_words)
    longest = np.zeros(n)
    np.maximum.at(longest, w_doc, length)
    lower = np.zeros(len(buf) + 1)
    np.cumsum(_CLASS[buf] == 2, out=lower[1:])
    upper = np.zeros(len(buf) + 1)
    np.cumsum(_CLASS[buf] == 1, out=upper[1:])
    caps = (upper[ends] - upper[starts] >= 2) & (lower[ends] == lower[starts])
    odd = np.isin(_CLASS[buf[ends - 1]], (7, 8, 9)) & (buf[ends - 1] != 46) if len(starts) else np.zeros(0, bool)
    h = word_hashes(buf, starts, ends, lower=True)
    lines = classes[:, 6] + 1
    return np.column_stack([
        np.log1p(block.lens), np.log1p(n_words), mean, sd, longest, *(classes[:, [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 0]] / size).T,
        entropy, np.log1p(lines), n_words / lines,
        _distinct_share(h, w_doc, n), _distinct_share(*shingles(h, w_off, 2), n), _distinct_share(*shingles(h, w_off, 5), n),
        _sum_by(caps, w_off) / one, _sum_by(odd, w_off) / one]).astype(np.float32)


# fitting -------------------------------------------------------------------

@dataclass
class Trees:
    """Flat trees: node ``i`` goes to ``left[i]`` if feature <= threshold, else
    to ``left[i] + 1``; a leaf points at itself and holds ``value``."""

    base: float
    depth: int
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    value: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots.tolist():
            node = np.full(len(x), root)
            for _ in range(self.depth):
                right = x[rows, self.feature[node]] > self.threshold[node]
                leaf = self.left[node] == node
                node = np.where(leaf, node, self.left[node] + right)
            raw += self.value[node]
        return 1 / (1 + np.exp(-raw))


def _bin_edges(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1], method="lower"))


def fit(x: np.ndarray, y: np.ndarray, n_trees: int = 80, depth: int = 4, bins: int = 64,
        rate: float = 0.15, l2: float = 1.0, min_rows: int = 10) -> Trees:
    """Boosted trees for the logistic loss; splits are found on per-node
    histograms of gradients over the bins of each feature."""
    n, m = x.shape
    p = float(np.clip(y.mean() if n else 0.5, 1e-3, 1 - 1e-3))
    base = float(np.log(p / (1 - p)))
    feature, threshold, left, value, roots = [], [], [], [], []

    def node() -> int:
        for column, v in ((feature, 0), (threshold, 0.0), (left, len(left)), (value, 0.0)):
            column.append(v)
        return len(left) - 1

    if n == 0 or y.min() == y.max():
        n_trees = 0
    edges = [_bin_edges(x[:, j], bins) for j in range(m)] if n_trees else []
    binned = np.column_stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)]) if n_trees else None
    raw = np.full(n, base)
    for _ in range(n_trees):
        prob = 1 / (1 + np.exp(-raw))
        grad, hess = prob - y, prob * (1 - prob)
        roots.append(node())
        at = np.full(n, roots[-1])
        live = [roots[-1]]
        for level in range(depth + 1):
            nxt = []
            slot = np.full(len(left), -1)
            slot[live] = np.arange(len(live))
            rows = np.flatnonzero(slot[at] >= 0)
            s, g, h = slot[at[rows]], grad[rows], hess[rows]
            gs, hs = np.bincount(s, g, len(live)), np.bincount(s, h, len(live))
            for k, i in enumerate(live):
                value[i] = float(-rate * gs[k] / (hs[k] + l2))
            if level == depth:
                break
            best = [(0.0, -1, -1)] * len(live)
            for j in range(m):
                code = s * bins + binned[rows, j]
                size = len(live) * bins
                gl = np.bincount(code, g, size).reshape(-1, bins).cumsum(axis=1)[:, : len(edges[j])]
                hl = np.bincount(code, h, size).reshape(-1, bins).cumsum(axis=1)[:, : len(edges[j])]
                nl = np.bincount(code, minlength=size).reshape(-1, bins).cumsum(axis=1)[:, : len(edges[j])]
                if not gl.shape[1]:
                    continue
                total = np.bincount(s, minlength=len(live))[:, None]
                gain = gl**2 / (hl + l2) + (gs[:, None] - gl)**2 / (hs[:, None] - hl + l2) - (gs**2 / (hs + l2))[:, None]
                gain = np.where((nl >= min_rows) & (total - nl >= min_rows), gain, 0)
                for k, b in enumerate(gain.argmax(axis=1).tolist()):
                    if gain[k, b] > best[k][0] + 1e-9:
                        best[k] = (float(gain[k, b]), j, b)
            for k, i in enumerate(live):
                _, j, b = best[k]
                if j < 0:
                    continue
                feature[i], threshold[i], left[i] = j, float(edges[j][b]), node()
                value[i] = 0.0
                node()
                mine = rows[s == k]
                at[mine] = left[i] + (x[mine, j] > edges[j][b])
                nxt += [left[i], left[i] + 1]
            if not nxt:
                break
            live = nxt
        raw += np.array(value)[at]
    return Trees(base, depth + 1, np.array(roots, dtype=np.int64), np.array(feature or [0]),
                 np.array(threshold or [0.0], dtype=np.float32), np.array(left or [0]), np.array(value or [0.0]))


# Spark side ----------------------------------------------------------------

def held_out(id_col: str) -> Column:
    """Whether an id belongs to the fold that is never learned from."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % HOLD_OUT == 0


def training_rows(labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS, id_col: str = "doc_id",
                  label_col: str = "quality") -> DataFrame:
    """At most about ``max_rows`` labelled ids outside the held-out fold."""
    rows = (labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label"))
                  .where(F.col("_id").isNotNull() & F.col("_label").isNotNull() & ~held_out("_id"))
                  .groupBy("_id").agg(F.min("_label").alias("_label")))
    n = rows.count()
    if n > max_rows:
        grid = 1 << 30
        rows = rows.where(F.pmod(F.xxhash64("_id"), F.lit(grid)) < int(grid * max_rows / n))
    return rows


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS,
          id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Trees:
    """Fit on the sampled labelled documents, one row for each sampled id however
    often it is repeated (the smallest statistics).  The sample's ids are broadcast
    (at most about ``max_rows`` pairs) and its statistics collected (``max_rows x
    len(FEATURES)`` floats); nothing else goes through the driver."""
    sample = training_rows(labels, max_rows, id_col, label_col)
    rows = id_text(docs, id_col, text_col).join(F.broadcast(sample), "_id").select("_id", "_text", "_label")

    def stats(batches):
        for batch in batches:
            label = np.asarray(batch.column(2))
            at = 0
            for block in iter_blocks([batch]):
                n = len(block.lens)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block.ids), pa.array(label[at:at + n].astype(np.int32)),
                     pa.array(list(features(block)), pa.list_(pa.float32()))], names=["id", "label", "x"])
                at += n

    got = (rows.mapInArrow(stats, "id long, label int, x array<float>")
               .groupBy("id").agg(F.min(F.struct("label", "x")).alias("one")).select("id", "one.label", "one.x").toArrow())
    order = np.argsort(got.column("id").to_numpy(), kind="stable")
    y = got.column("label").to_numpy()[order].astype(float)
    flat = got.column("x").combine_chunks()
    x = flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))[order]
    return fit(x, y)


_SCORE = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def score(docs: DataFrame, trees: Trees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row."""
    model = docs.sparkSession.sparkContext.broadcast(trees)  # bounded: see Trees

    def run(batches):
        for block in iter_blocks(batches):
            s = model.value.score(features(block))
            yield pa.RecordBatch.from_arrays([pa.array(block.ids, mask=block.id_null), pa.array(s)], schema=_SCORE)
        give_back()

    scored = id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= KEEP_SCORE).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, trees: Trees, text_col: str = "text") -> DataFrame:
    """The rows whose text scores at least ``KEEP_SCORE``, all columns kept."""
    small_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(trees)

    @F.pandas_udf("boolean")
    def good(texts):
        raw = list(texts)
        out, at = np.zeros(len(raw), dtype=bool), 0
        while at < len(raw):
            size, to = 0, at
            while to < len(raw) and (to == at or size + len(raw[to] or b"") <= 1 << 20):
                size += len(raw[to] or b"")
                to += 1
            out[at:to] = model.value.score(features(_block([None] * (to - at), raw[at:to]))) >= KEEP_SCORE
            at = to
        return pd.Series(out)

    return docs.where(good(F.col(text_col).cast("binary")))
