"""Op 1, suffix-array dedup: depth-limited radix sort of suffixes.

A byte is removed when a 50-byte string that covers it also starts in a
document with a smaller id.  The suffixes of all documents are ordered by
most-significant-digit passes, only as deep as the 50-byte threshold; suffixes
that are alone in their group drop out after each pass, and the groups that are
left after the last digit are exactly the repeated windows.

Digit 0 is shared out by Spark.  It is the window's *anchor*: the smallest
36-byte gram (by hash) inside the window.  Equal windows have equal anchors at
equal places, and neighbouring windows mostly share theirs, so the windows of
one anchor travel as one *run* of bytes instead of one row per suffix.

1. Every scan task sends the distinct anchor hashes it holds, by hash bucket; a
   bucket answers which of them other tasks hold too.  Anchors that one
   document holds alone end here.
2. Runs of the anchors that are left go to their bucket, each distinct run once
   per task with the smallest id that has it.  The bucket sorts the windows by
   eight-byte digits, keeps groups with two or more ids after each digit, and
   answers, per window, the smallest id that has it.
3. Each task marks the windows for which a smaller id was answered.

An anchor held by many tasks (a common passage or phrase) is not sent to one
bucket: its windows travel one by one and are dealt by a hash of the window, so
a group that holds a third of all rows spreads over buckets; equal windows are
merged in the task that reads them.

Texts are staged once (see :mod:`tripstar.llm.blocks`) and never shuffled.

Defined results: null and empty texts have no bytes; texts shorter than the
threshold lose nothing; rows with the same id never remove bytes from each
other (a smaller id is needed), so repeated rows lose the same bytes; a null id
sorts after every other id, so such rows lose what any row with an id has, and
never remove from others; an empty table gives an empty result; other columns
are not read.  Windows of different tasks are compared byte by byte; equal runs
of one task are told by a 64-bit hash.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstar.llm.blocks import Block, expand, give_back, n_buckets, squeeze, stage_parts, unpack
from tripstar.llm.kernels import BASE, BYTE_TABLE, INVERSE, mix, power
from tripstar.session import scratch_path

THRESHOLD = 50
GRAM = 36  # long enough that grams rarely meet by chance, also in a much larger corpus
HOT_PARTS = 64  # an anchor in more scan tasks than this has its windows dealt one by one
SEGMENT = 1 << 16  # window starts worked on at once: arrays stay in the processor's cache
NO_ID = np.int64(2**63 - 1)  # null ids sort last


class _Grams:
    """Hashes of any gram of a buffer from prefix sums: sum of byte values
    times powers, divided by the power of the gram's place (mod 2**64)."""

    def __init__(self, buf: np.ndarray):
        n = len(buf)
        self.inverse = power(INVERSE, n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(BYTE_TABLE[buf] * power(BASE, n), out=self.sums[1:])

    def all(self, size: int) -> np.ndarray:
        h = self.sums[size:] - self.sums[:-size]
        return mix(h * self.inverse[:len(h)])

    def at(self, starts: np.ndarray, size: int) -> np.ndarray:
        return mix((self.sums[starts + size] - self.sums[starts]) * self.inverse[starts])


@dataclass
class Runs:
    """Maximal runs of window starts ``first..last`` that share an anchor."""

    first: np.ndarray
    last: np.ndarray
    anchor: np.ndarray  # hash of the anchor gram
    key: np.ndarray     # hash of the run's bytes
    doc: np.ndarray


def _segment_runs(buf: np.ndarray, base: int):
    """Runs of one stretch of bytes: first start, last start, anchor hash."""
    hashes = _Grams(buf)
    grams = hashes.all(GRAM)
    place = np.arange(len(grams), dtype=np.uint64)
    low = (grams & np.uint64(0xFFFFFFFF00000000)) | place  # ties: the leftmost
    width, left = 1, THRESHOLD - GRAM + 1
    while width * 2 <= left:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < left:
        low = np.minimum(low[:len(low) - (left - width)], low[left - width:])
    at = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
    cut = np.flatnonzero(at[1:] != at[:-1]) + 1
    first = np.concatenate([[0], cut])
    last = np.concatenate([cut, [len(at)]]) - 1
    # the smallest hashes crowd at the low end: mixed again before they are dealt
    return first + base, last + base, mix(grams[at[first]] + np.uint64(0x9E3779B97F4A7C15))


def runs_of(block: Block) -> Runs:
    """The runs of all documents of a block; places are in the block's buffer.
    Windows that would cross a document's end are left out."""
    buf, off = np.frombuffer(block.data, np.uint8), block.offsets
    cols = ([], [], [])
    for a in range(0, max(len(buf) - THRESHOLD + 1, 0), SEGMENT):
        piece = buf[a:a + SEGMENT + THRESHOLD - 1]
        for c, v in zip(cols, _segment_runs(piece, a)):
            c.append(v)
    if not cols[0]:
        z = np.zeros(0, np.int64)
        return Runs(z, z, z.astype(np.uint64), z.astype(np.uint64), z)
    first, last, anchor = map(np.concatenate, cols)
    # a run is cut at document ends: its valid starts, per document
    d0 = np.searchsorted(off, first, side="right") - 1
    d1 = np.searchsorted(off, last, side="right") - 1
    many = np.flatnonzero(d1 > d0)
    if len(many):
        extra = [(d, f, ll, h) for k in many.tolist() for f, ll, h in [(first[k], last[k], anchor[k])]
                 for d in range(int(d0[k]) + 1, int(d1[k]) + 1)]
        ed = np.array([e[0] for e in extra])
        first = np.concatenate([first, off[ed]])
        last = np.concatenate([last, np.array([e[2] for e in extra])])
        anchor = np.concatenate([anchor, np.array([e[3] for e in extra], dtype=np.uint64)])
        d0 = np.concatenate([d0, ed])
    last = np.minimum(last, off[d0 + 1] - THRESHOLD)
    ok = last >= first
    first, last, anchor, d0 = first[ok], last[ok], anchor[ok], d0[ok]
    order = np.argsort(first, kind="stable")
    first, last, anchor, d0 = first[order], last[order], anchor[order], d0[order]
    return Runs(first, last, anchor, _run_keys(buf, first, last, anchor), d0)


def _run_keys(buf, first, last, anchor):
    """A hash of the bytes of each run: its first and last window cover it."""
    key = np.empty(len(first), np.uint64)
    for a in range(0, max(len(buf) - THRESHOLD + 1, 0), SEGMENT):
        lo, hi = np.searchsorted(first, [a, a + SEGMENT])
        if lo < hi:
            grams = _Grams(buf[a:a + SEGMENT + 2 * THRESHOLD])
            f, e = first[lo:hi] - a, last[lo:hi] - a
            key[lo:hi] = (grams.at(f, THRESHOLD) * np.uint64(0x9E3779B97F4A7C15) + grams.at(e, THRESHOLD)
                          + (e - f).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return mix(key ^ anchor)


def _ids(block: Block) -> np.ndarray:
    return np.where(block.id_null, NO_ID, block.ids)


def _window_hashes(buf, starts):
    """Hashes of single windows (for anchors held by many tasks)."""
    out = np.empty(len(starts), np.uint64)
    for a in range(0, len(starts), SEGMENT):
        rows = np.lib.stride_tricks.sliding_window_view(buf, THRESHOLD)[starts[a:a + SEGMENT]]
        out[a:a + SEGMENT] = mix((BYTE_TABLE[rows] * power(BASE, THRESHOLD)).sum(axis=1, dtype=np.uint64))
    return out


# pass 1: which anchors do other documents hold? ------------------------------

def _anchors(blocks: list[tuple[Block, Runs]]):
    """Distinct anchor hashes of a part, whether two ids in it hold one, and
    the place of each run's anchor among them."""
    h = np.concatenate([r.anchor for _, r in blocks] or [np.zeros(0, np.uint64)])
    ids = np.concatenate([_ids(b)[r.doc] for b, r in blocks] or [np.zeros(0, np.int64)])
    if not len(h):
        return h, np.zeros(0, bool), np.zeros(0, np.int32)
    order = np.argsort(h)
    h, ids = h[order], ids[order]
    new = np.concatenate([[True], h[1:] != h[:-1]])
    start = np.flatnonzero(new)
    place = np.empty(len(h), np.int32)
    place[order] = np.cumsum(new, dtype=np.int32) - 1
    return h[start], np.minimum.reduceat(ids, start) != np.maximum.reduceat(ids, start), place


def _bucket_cuts(h: np.ndarray, n: int) -> np.ndarray:
    """Offsets of the n buckets in sorted hashes (by their top 32 bits)."""
    edges = np.array([((b << 32) + n - 1) // n << 32 for b in range(1, n)], dtype=np.uint64)
    return np.concatenate([[0], np.searchsorted(h, edges), [len(h)]])


def _fingerprint(h: np.ndarray, n: int) -> np.ndarray:
    """32 bits below those that choose the bucket."""
    bits = max(0, int(n - 1).bit_length() - 1)
    return ((h << np.uint64(bits)) >> np.uint64(32)).astype(np.uint32)


# pass 2: most-significant-digit sort of the windows ---------------------------

def radix_owners(text: np.ndarray, starts: np.ndarray, group: np.ndarray, ids: np.ndarray,
                 threshold: int = THRESHOLD) -> np.ndarray:
    """Smallest id per window, where windows ``text[start:start+threshold]`` of
    one group are compared.  Digits are eight bytes; after each digit, windows
    whose group holds a single id drop out and keep their own id."""
    owner = ids.copy()
    live = np.arange(len(starts))
    for at in range(0, threshold, 8):
        if not len(live):
            break
        digit = np.zeros(len(live), np.uint64)
        for j in range(at, min(at + 8, threshold)):
            digit = (digit << np.uint64(8)) | text[starts[live] + j]
        order = np.lexsort((digit, group[live]))
        live, digit = live[order], digit[order]
        g = group[live]
        new = np.ones(len(live), dtype=bool)
        new[1:] = (g[1:] != g[:-1]) | (digit[1:] != digit[:-1])
        first = np.flatnonzero(new)
        low, high = np.minimum.reduceat(ids[live], first), np.maximum.reduceat(ids[live], first)
        rank = np.cumsum(new) - 1
        group[live] = rank
        owner[live] = low[rank]
        keep = low[rank] != high[rank]
        owner[live[~keep]] = ids[live[~keep]]
        live = live[keep]
    return owner


_ASK = "part int, bucket int, anchors binary"
_ASK_ARROW = pa.schema([("part", pa.int32()), ("bucket", pa.int32()), ("anchors", pa.binary())])
_FLAGS = "part int, bucket int, flags binary"
_FLAGS_ARROW = pa.schema([("part", pa.int32()), ("bucket", pa.int32()), ("flags", pa.binary())])
_RUNS = "part int, bucket int, heads binary, bytes binary"
_RUNS_ARROW = pa.schema([("part", pa.int32()), ("bucket", pa.int32()), ("heads", pa.binary()), ("bytes", pa.binary())])
_OWNERS = "part int, bucket int, owners binary"
_OWNERS_ARROW = pa.schema([("part", pa.int32()), ("bucket", pa.int32()), ("owners", pa.binary())])
_MARKED = ("doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
           "span_starts array<long>, span_ends array<long>")
_MARKED_ARROW = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                           ("n_spans", pa.int64()), ("kept_sha256", pa.string()),
                           ("span_starts", pa.list_(pa.int64())), ("span_ends", pa.list_(pa.int64()))])


def _table(rows, schema: pa.Schema) -> pa.Table:
    return pa.Table.from_arrays([pa.array([r[j] for r in rows], f.type) for j, f in enumerate(schema)], schema=schema)


class _Part:
    """One part with its anchors and, once flagged, the runs it asks about."""

    def __init__(self, table: pa.Table, n: int):
        self.n = n
        self.blocks = [(b, runs_of(b)) for b in unpack(table)]
        self.hashes, self.within, self.place = _anchors(self.blocks)
        self.cuts = _bucket_cuts(self.hashes, n)

    def asked(self, part: int):
        for b in range(self.n):
            h = self.hashes[self.cuts[b]:self.cuts[b + 1]]
            if len(h):
                yield part, b, squeeze(np.diff(_fingerprint(h, self.n).astype(np.int64), prepend=0).astype(np.uint32))

    def flag(self, flags: pa.Table) -> None:
        """Take the answers of pass 1: 0 alone, 1 shared, 2 shared by many."""
        level = np.zeros(len(self.hashes), np.uint8)
        for k, b in enumerate(flags.column("bucket").to_pylist()):
            level[self.cuts[b]:self.cuts[b + 1]] = expand(flags.column("flags")[k].as_py(), np.uint8)
        level = np.maximum(level, self.within)
        # distinct runs, with the smallest id that has each
        where, first, last, key, spread, ids = ([] for _ in range(6))
        seen = 0
        for i, (block, r) in enumerate(self.blocks):
            lv = level[self.place[seen:seen + len(r.first)]]
            seen += len(r.first)
            buf, doc_ids = np.frombuffer(block.data, np.uint8), _ids(block)
            some = np.flatnonzero(lv == 1)
            hot = np.flatnonzero(lv == 2)
            size = r.last[hot] - r.first[hot] + 1
            single = np.repeat(r.first[hot] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum()) if len(hot) else hot
            h = _window_hashes(buf, single)
            where.append(np.full(len(some) + len(single), i))
            first.append(np.concatenate([r.first[some], single]))
            last.append(np.concatenate([r.last[some], single]))
            key.append(np.concatenate([r.key[some], h]))
            spread.append(np.concatenate([r.anchor[some], h]))
            ids.append(np.concatenate([doc_ids[r.doc[some]], doc_ids[np.repeat(r.doc[hot], size)]]))
        cat = lambda xs, t: np.concatenate(xs) if xs else np.zeros(0, t)
        self.where, self.first, self.last = cat(where, np.int64), cat(first, np.int64), cat(last, np.int64)
        key, spread, self.ids = cat(key, np.uint64), cat(spread, np.uint64), cat(ids, np.int64)
        order = np.lexsort((self.ids, key, spread))
        k, s = key[order], spread[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (k[1:] != k[:-1]) | (s[1:] != s[:-1])
        self.heads = order[new]                       # one representative per distinct run: its smallest id
        self.run_of = np.empty(len(order), np.int64)  # entry -> distinct run
        self.run_of[order] = np.cumsum(new) - 1
        self.spread = spread[self.heads]
        self.run_cuts = _bucket_cuts(self.spread, self.n)

    def runs(self, part: int):
        for b in range(self.n):
            heads = self.heads[self.run_cuts[b]:self.run_cuts[b + 1]]
            if not len(heads):
                continue
            pieces = [self.blocks[w][0].data[f:ll + THRESHOLD]
                      for w, f, ll in zip(self.where[heads].tolist(), self.first[heads].tolist(), self.last[heads].tolist())]
            steps = np.diff(self.spread[self.run_cuts[b]:self.run_cuts[b + 1]], prepend=np.uint64(0))  # sorted: small
            head = np.stack([steps.view(np.int64), self.ids[heads], self.last[heads] - self.first[heads] + 1])
            yield part, b, squeeze(head, 3), squeeze(np.frombuffer(b"".join(pieces), np.uint8), 6)

    def removed(self, owners: pa.Table):
        """Rows of the result, from the smallest id of every window."""
        count = self.last[self.heads] - self.first[self.heads] + 1
        at = np.concatenate([[0], np.cumsum(count)])
        smallest = np.full(at[-1], NO_ID)
        for k, b in enumerate(owners.column("bucket").to_pylist()):
            lo, hi = self.run_cuts[b], self.run_cuts[b + 1]
            smallest[at[lo]:at[hi]] = np.cumsum(expand(owners.column("owners")[k].as_py(), np.int64))
        order = np.argsort(self.where, kind="stable")
        bounds = np.searchsorted(self.where[order], np.arange(len(self.blocks) + 1))
        for i, (block, _) in enumerate(self.blocks):
            mine = order[bounds[i]:bounds[i + 1]]
            n = count[self.run_of[mine]]
            begin = np.concatenate([[0], np.cumsum(n)[:-1]]) if len(mine) else n
            step = np.arange(n.sum()) - np.repeat(begin, n)
            start = np.repeat(self.first[mine], n) + step
            owner = smallest[np.repeat(at[self.run_of[mine]], n) + step]
            marked = start[owner < np.repeat(self.ids[mine], n)]
            yield from _result(block, marked)


def _result(block: Block, marked: np.ndarray):
    """Rows of a block from the starts of its marked windows."""
    size = len(block.data)
    starts = np.zeros(size + THRESHOLD, np.int32)  # with a margin before the first byte
    starts[marked + THRESHOLD] = 1
    np.cumsum(starts, out=starts)
    gone = starts[THRESHOLD:] > starts[:size]  # a marked window starts in the last 50 places
    buf, off = np.frombuffer(block.data, np.uint8), block.offsets
    for d, i in enumerate(block.id_list()):
        a, b = off[d], off[d + 1]
        g = gone[a:b]
        if g.any():
            edge = np.flatnonzero(np.diff(np.concatenate([[0], g.view(np.int8), [0]])))
            kept = buf[a:b][~g].tobytes()
        else:
            edge, kept = np.zeros(0, np.int64), block.data[a:b]
        yield (i, int(b - a), int(g.sum()), len(edge) // 2, hashlib.sha256(kept).hexdigest(), edge[::2].tolist(), edge[1::2].tolist())


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          hot_parts: int = HOT_PARTS) -> DataFrame:
    """One row per document: sizes, number of removed runs and their places,
    and the digest of the bytes that stay."""
    staged = stage_parts(docs, id_col, text_col, "suffix_texts")
    n = n_buckets(docs.sparkSession)

    def ask(key, table):
        give_back()
        return _table(list(_Part(table, n).asked(key[0].as_py())), _ASK_ARROW)

    def answer(table):
        give_back()
        asked = [np.cumsum(expand(b.as_py(), np.uint32), dtype=np.uint32) for b in table.column("anchors")]
        values, counts = np.unique(np.concatenate(asked), return_counts=True)
        level = ((counts > 1).astype(np.uint8) + (counts > hot_parts))
        flags = [squeeze(level[np.searchsorted(values, a)]) for a in asked]
        return _table(list(zip(table.column("part").to_pylist(), table.column("bucket").to_pylist(), flags)), _FLAGS_ARROW)

    def send(key, left, right):
        give_back()
        part = _Part(left, n)
        part.flag(right)
        return _table(list(part.runs(key[0].as_py())), _RUNS_ARROW)

    def order(table):
        give_back()
        return _table(list(_bucket_owners(table)), _OWNERS_ARROW)

    def mark(key, left, flags_and_owners):
        give_back()
        part = _Part(left, n)
        asked = pc.is_valid(flags_and_owners.column("flags"))
        part.flag(flags_and_owners.filter(asked))
        return _table(list(part.removed(flags_and_owners.filter(pc.invert(asked)))), _MARKED_ARROW)

    flags = staged.groupBy("part").applyInArrow(ask, _ASK).groupBy("bucket").applyInArrow(answer, _FLAGS)
    flags = _written(flags)
    runs = staged.groupBy("part").cogroup(flags.groupBy("part")).applyInArrow(send, _RUNS)
    owners = runs.groupBy("bucket").applyInArrow(order, _OWNERS)
    replies = (flags.withColumn("owners", F.lit(None).cast("binary"))
                    .unionByName(owners.withColumn("flags", F.lit(None).cast("binary"))))
    return staged.groupBy("part").cogroup(replies.groupBy("part")).applyInArrow(mark, _MARKED)


def _written(df: DataFrame) -> DataFrame:
    """Written once in the shared folder: used by two passes."""
    path = scratch_path(df.sparkSession, "suffix-flags")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


CHUNK_WINDOWS = 1 << 18


def _bucket_owners(table: pa.Table):
    """Pass 2 for one bucket: the smallest id of every window, per part, as
    differences.  Equal runs are taken together first; windows are sorted only
    where an anchor stands in different runs, in ranges of whole groups of about
    ``CHUNK_WINDOWS`` windows."""
    parts = []
    for k in range(table.num_rows):
        head = expand(table.column("heads")[k].as_py(), np.int64).reshape(3, -1)
        text = expand(table.column("bytes")[k].as_py(), np.uint8)
        at = np.concatenate([[0], np.cumsum(head[2] + THRESHOLD - 1)])
        parts.append((np.cumsum(head[0].view(np.uint64)), head[1], head[2], at, text))
    # equal runs of all parts: one content, with the smallest id
    of, contents = [], {}
    for _, _, w, at, text in parts:
        data = text.tobytes()
        of.append(np.array([contents.setdefault(data[x:y], len(contents)) for x, y in zip(at[:-1].tolist(), at[1:].tolist())], dtype=np.int64))
    every = np.concatenate(of)
    smallest = np.full(len(contents), NO_ID)
    np.minimum.at(smallest, every, np.concatenate([p[1] for p in parts]))
    spread = np.empty(len(contents), np.uint64)
    spread[every] = np.concatenate([p[0] for p in parts])
    width = np.fromiter(map(len, contents), np.int64, len(contents)) - THRESHOLD + 1
    text_at = np.concatenate([[0], np.cumsum(width + THRESHOLD - 1)])
    text = np.frombuffer(b"".join(contents), np.uint8)
    del contents
    window_at = np.concatenate([[0], np.cumsum(width)])
    owner = np.repeat(smallest, width)
    order = np.argsort(spread, kind="stable")
    s = spread[order]
    new = np.concatenate([[True], s[1:] != s[:-1]])
    group = np.cumsum(new) - 1
    mixed = np.bincount(group)[group] > 1  # the anchor stands in different runs
    order, group = order[mixed], group[mixed]
    total, done = np.cumsum(width[order]), 0
    while done < len(order):
        to = int(np.searchsorted(total, (total[done - 1] if done else 0) + CHUNK_WINDOWS, side="right"))
        to = int(np.searchsorted(group, group[max(to, done + 1) - 1], side="right"))
        runs = order[done:to]
        n = width[runs]
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        owner[np.repeat(window_at[runs], n) + step] = radix_owners(
            text, np.repeat(text_at[runs], n) + step, np.repeat(group[done:to], n), np.repeat(smallest[runs], n))
        done = to
    for k, (_, _, w, _, _) in enumerate(parts):
        step = np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w)
        mine = owner[np.repeat(window_at[of[k]], w) + step]
        yield (table.column("part")[k].as_py(), table.column("bucket")[k].as_py(), squeeze(np.diff(mine, prepend=0), 3))
