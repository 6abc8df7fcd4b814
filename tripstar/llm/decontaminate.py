"""Op 10, benchmark decontamination: pigeonhole edit matching.

Texts are normalised to lower-case words with one space between them.  A
document is contaminated by a test item when some stretch of it is within
``k`` edits (insert, delete, substitute; bytes of UTF-8) of the whole item,
where ``k`` is ``ERROR_RATE`` of the item's length.

An item with budget ``k`` is cut into ``k + 1`` pieces.  ``k`` edits cannot
touch all of them, so every match contains one piece unchanged, at its place in
the item up to ``k`` positions.  The pieces of all items form one
Aho-Corasick automaton; each hit proposes a window of the document, overlapping
windows of an item are merged, and Myers' bit-parallel algorithm decides the
window exactly (one machine operation on an item-wide bit vector per byte).

The documents are only scanned, never shuffled.  Test items are a query set
run against all rows in blocks of ``BLOCK_ITEM_BYTES`` bytes of item text, one pass
for each: only one block is broadcast at a time and a task builds one matcher, so
memory is bounded however large the benchmark table is.  (A benchmark of one block,
the usual case, is one pass without a write.)

Texts and items are bytes, valid UTF-8 or not.  Items match anywhere, also inside a
longer word.

Defined results: null or empty items (no words) match nothing; a null or empty
document matches nothing; repeated items are reported per item id and repeated
rows per row; items with a null id take part under the id null (they
contaminate, and are counted).  Empty tables give rows without hits or no rows.
Other columns are passed on by :func:`drop_contaminated` and not read otherwise.
"""

from __future__ import annotations

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripstar.llm.blocks import small_batches
from tripstar.llm.components import written

ERROR_RATE = 0.05
BLOCK_ITEM_BYTES = 4 << 20

_NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c >= 128 else 32 for c in range(256))


def normalise(text: str | bytes | None) -> bytes:
    """Lower-case words (ASCII letters and digits, and all non-ASCII bytes),
    one space between them."""
    raw = b"" if text is None else text.encode("utf-8") if isinstance(text, str) else text
    return b" ".join(raw.translate(_NORMAL).split())


def budget(n: int) -> int:
    return int(n * ERROR_RATE)


def pieces(item: bytes) -> list[tuple[int, bytes]]:
    """The item cut into budget + 1 pieces of nearly equal length."""
    k = budget(len(item)) + 1
    cuts = [len(item) * i // k for i in range(k + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def myers(item: bytes, text: bytes, k: int, masks: dict[int, int] | None = None) -> tuple[int, int]:
    """Smallest edit distance between the item and any stretch of the text, if
    at most ``k``, and the end of the first such stretch; else (-1, -1)."""
    m = len(item)
    if not m:
        return -1, -1
    if masks is None:
        masks = bit_masks(item)
    ones, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = ones, 0, m
    best, end = k + 1, -1
    for j, c in enumerate(text, 1):
        eq = masks.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & ones
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
            if score < best:
                best, end = score, j
                if not best:
                    break
        ph = ph << 1 & ones  # the row above is 0: a match may start anywhere
        mh = mh << 1 & ones
        pv = mh | ~(xv | ph) & ones
        mv = ph & xv
    return (best, end) if best <= k else (-1, -1)


def bit_masks(item: bytes) -> dict[int, int]:
    masks: dict[int, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


class Matcher:
    """Items ready for matching; small enough to broadcast (one block)."""

    def __init__(self, items: list[tuple[int | None, str | bytes]]):
        self.items = [(i, n, budget(len(n)), bit_masks(n)) for i, t in items if (n := normalise(t))]
        where: dict[str, list[tuple[int, int, int]]] = {}
        for q, (_, n, _, _) in enumerate(self.items):
            for at, piece in pieces(n):
                where.setdefault(piece.decode("latin-1"), []).append((q, at, len(piece)))
        self.automaton = ahocorasick.Automaton()
        for piece, owners in where.items():
            self.automaton.add_word(piece, owners)
        if where:
            self.automaton.make_automaton()

    def find(self, text: bytes) -> list[tuple[int | None, int, int]]:
        """(item id, distance, end in the normalised text) of each item found."""
        if not self.items or not text:
            return []
        proposed: dict[int, list[tuple[int, int]]] = {}
        for end, owners in self.automaton.iter(text.decode("latin-1")):
            for q, at, size in owners:
                _, n, k, _ = self.items[q]
                start = end + 1 - size - at
                proposed.setdefault(q, []).append((start - k, start + len(n) + k))
        out = []
        for q, windows in proposed.items():
            i, n, k, masks = self.items[q]
            best = (-1, -1)
            for a, b in _merge(sorted(windows), len(text)):
                # the common case first: the item stands there unchanged
                exact = text.find(n, a, b)
                got = (0, exact + len(n)) if exact >= 0 else myers(n, text[a:b], k, masks)
                if exact < 0 and got[0] >= 0:
                    got = (got[0], got[1] + a)
                if got[0] >= 0 and (best[0] < 0 or got[0] < best[0]):
                    best = got
                    if not best[0]:
                        break
            if best[0] >= 0:
                out.append((i, *best))
        return sorted(out, key=lambda x: (x[0] is not None, x[0] or 0, x[1:]))


def _merge(windows: list[tuple[int, int]], n: int):
    a, b = windows[0]
    for s, e in windows[1:]:
        if s <= b:
            b = max(b, e)
        else:
            yield max(a, 0), min(b, n)
            a, b = s, e
    yield max(a, 0), min(b, n)


def item_blocks(items: DataFrame, id_col: str = "item_id", text_col: str = "text"):
    """The items in blocks of bounded size: they stream through the driver one
    partition at a time, and only one block is held."""
    block, size = [], 0
    rows = items.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("binary").alias("t")).where("t is not null")
    for row in rows.toLocalIterator():
        n = len(row.t)
        if block and size + n > BLOCK_ITEM_BYTES:
            yield block
            block, size = [], 0
        block.append((row.i, bytes(row.t)))
        size += n
    if block:
        yield block


_HITS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("t", T.BinaryType()),
                      *[T.StructField(c, T.ArrayType(T.LongType())) for c in ("items", "distances", "ends")]])
_HITS_ARROW = pa.schema([("doc_id", pa.int64()), ("t", pa.binary()), *[(c, pa.list_(pa.int64())) for c in ("items", "distances", "ends")]])


class _Task:
    """One block's matcher, built once per task from the broadcast items."""

    def __init__(self, block):
        self.block, self.matcher = block, None

    def find(self, raw) -> list[tuple[int | None, int, int]]:
        if self.matcher is None:
            self.matcher = Matcher(self.block.value)
        return self.matcher.find(normalise(raw))


def _passes(rows: DataFrame, items: DataFrame, item_id_col: str, item_text_col: str, one) -> DataFrame:
    """``one(rows, block)`` for block after block.  With several blocks each pass but
    the last is written, and its broadcast destroyed before the next is made."""
    sc, held = rows.sparkSession.sparkContext, None
    for block in item_blocks(items, item_id_col, item_text_col):
        if held is not None:
            rows = written(rows, "item-pass")
            held.destroy()
        held = sc.broadcast(block)
        rows = one(rows, held)
    return rows


def matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document: the items found in it, their distances and the
    ends of the matches in the normalised text."""
    small_batches(docs.sparkSession)

    def one(rows, block):
        def run(batches):
            task = _Task(block)
            for batch in batches:
                hits = [task.find(t.as_py()) for t in batch.column(1)]
                found = [[b + [h[j] for h in hs] for b, hs in zip(batch.column(2 + j).to_pylist(), hits)] for j in range(3)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], *[pa.array(c, pa.list_(pa.int64())) for c in found]],
                                                 schema=_HITS_ARROW)

        return rows.mapInArrow(run, _HITS)

    none = F.array().cast("array<bigint>")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("t"),
                       *[none.alias(c) for c in ("items", "distances", "ends")])
    found = _passes(rows, items, item_id_col, item_text_col, one)
    return found.select("doc_id", F.size("items").cast("long").alias("n_items"), "items", "distances", "ends")


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text",
                      item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows in which no item was found, all columns kept."""
    small_batches(docs.sparkSession)

    def one(rows, block):
        task = _Task(block)

        @F.pandas_udf("boolean")
        def clean(texts):
            return texts.map(lambda t: not task.find(t)).astype(bool)

        return rows.where(clean(F.col(text_col).cast("binary")))

    return _passes(docs, items, item_id_col, item_text_col, one)
