r"""Op 3, secret scans: recursive decoding worklist.

Base patterns run over the whole text.  Then a worklist unwraps layers: percent
escapes, Unicode escapes (with ``\U``, ``\u{}``, ``%u`` and octal bytes), character
references by number and name, base64 segments and compressed bytes.
Every new layer is scanned with the same patterns and is itself unwrapped, until
no layer is new; a layer that was seen before is not opened again, so cycles
end.  Each character of a layer carries the root span it came from, so a match
in any layer is reported as a span of the original text.

No layer is thrown away.  All patterns are ASCII, so bytes are read as Latin-1,
which gives every byte a character, and runs of UTF-16 and UTF-32 are read
besides.  A match in base64 is reported as the groups of four characters that hold
it (in base64 of compressed bytes, all of it), or, where base64 is wrapped over lines and joined, from the first to the last
line that holds a part of it.  Compressed bytes are
inflated with all their members and what follows them.  What inflates to more
than ``WINDOW`` bytes is scanned as a stream of windows that share ``OVERLAP``
bytes, so memory stays bounded; the time is that of all the bytes inside.

Defined results: a null or empty text has no spans; bytes that are not UTF-8 are read
as U+FFFD (:func:`redact` keeps them where it masks nothing); a repeated row is scanned
like any other; an empty table gives an empty result; other columns are not
read by :func:`scan` and are passed on unchanged by :func:`redact`.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import html
import lzma
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate, chain, groupby

import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstar.llm.blocks import small_batches, valid_text

# The three kinds of secrets, in the order they are listed.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # + is greedy, so shorter runs are just dropped
KINDS = ("assign", "access", "hex")
MIN_ASSIGN, MIN_ACCESS = 6, 20

# Inflated bytes are held a window at a time: decompression bombs must not take a
# task down.
WINDOW, OVERLAP = 64 << 20, 16 << 20
_PIECE, _STEP = 4 << 10, 1 << 20  # bytes given to a decompressor, and taken from it, at once

_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
# code units in hexadecimal (two escapes can be one character), octal bytes, character references
_UNIT = re.compile(r"(?:\\u|%u)([0-9A-Fa-f]{4})|\\u\{([0-9A-Fa-f]{1,6})\}|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})|\\([0-7]{3})")
_ESCAPE = re.compile(rf"(?:{_UNIT.pattern})+"
                     r"|&(?:#(?:[0-9]{1,7}|[xX][0-9A-Fa-f]{1,6})|[A-Za-z][A-Za-z0-9]{1,31});")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
_LINE = re.compile(r"[A-Za-z0-9+/_-]+")
_EOL = r"[ \t]*+(?:\r\n?|\n|(?:\\r)?\\n)[ \t]*+"
_WRAPPED = re.compile(rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++(?:{_EOL}[A-Za-z0-9+/_-]++)++(?:(?:{_EOL})?=){{0,2}}")
_BREAK = re.compile(_EOL)
_BYTES = re.compile(r"(?:\\x[0-9A-Fa-f]{2}){4,}")
# ASCII in UTF-16 and UTF-32 of either byte order, at any place
_WIDE = [re.compile(x, re.S) for x in (rb"(?:[\x01-\x7f]\x00){6,}", rb"(?:\x00[\x01-\x7f]){6,}",
                                       rb"(?:[\x01-\x7f]\x00{3}){6,}", rb"(?:\x00{3}[\x01-\x7f]){6,}")]
SCHEMA = ("doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, "
          "n_spans long, n_layers long")


def base_matches(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of the base matches, in report order."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def _decompressor(head: bytes):
    if head[:2] == b"\x1f\x8b":
        return zlib.decompressobj(31)
    if len(head) > 2 and head[0] == 0x78 and (head[0] * 256 + head[1]) % 31 == 0:
        return zlib.decompressobj()
    if head[:4] == b"\x28\xb5\x2f\xfd":
        return zstandard.ZstdDecompressor().decompressobj()
    if head[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if head[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor()
    return None


def _fed(engine, piece: bytes) -> Iterator[bytes]:
    """What a decompressor gives for a piece, at most ``_STEP`` bytes at once
    (zstd: what 4 KB can hold)."""
    if hasattr(engine, "needs_input"):  # bz2, xz
        yield engine.decompress(piece, _STEP)
        while not (engine.eof or engine.needs_input):
            yield engine.decompress(b"", _STEP)
    elif hasattr(engine, "unconsumed_tail") and hasattr(engine, "copy"):  # zlib
        yield engine.decompress(piece, _STEP)
        while engine.unconsumed_tail and not engine.eof:
            yield engine.decompress(engine.unconsumed_tail, _STEP)
    else:
        yield engine.decompress(piece)


def _inflated(parts: Iterator[bytes]) -> Iterator[bytes]:
    """The content of all members of a compressed stream.  Bytes that do not
    inflate, and those after the last member, come as they are."""
    parts = (x[i:i + _PIECE] for x in parts for i in range(0, len(x), _PIECE))
    left = b""
    while True:
        while len(left.lstrip(b"\0")) < 6 and (piece := next(parts, None)) is not None:
            left = (left if left.strip(b"\0") else left[-8:]) + piece
        engine = _decompressor(left.lstrip(b"\0"))  # members may be padded
        if engine is None:
            yield left
            yield from parts
            return
        left, held = left.lstrip(b"\0"), b""  # held: read since something came out
        try:
            while not engine.eof:
                piece = left or next(parts, None)
                if piece is None:
                    if hasattr(engine, "flush"):
                        yield engine.flush()
                    return
                left, held = b"", held + piece
                for out in _fed(engine, piece):
                    if out:
                        held = b""
                        yield out
        except (zlib.error, zstandard.ZstdError, OSError, lzma.LZMAError, EOFError, ValueError):
            yield held
            yield from parts
            return
        left = engine.unused_data


def _take(parts: Iterator[bytes], n: int) -> tuple[bytes, Iterator[bytes]]:
    """The first ``n`` bytes, and the rest."""
    out, size = [], 0
    for x in parts:
        out.append(x)
        size += len(x)
        if size >= n:
            break
    data = b"".join(out)
    return data[:n], chain([data[n:]], parts) if size > n else parts


def _windows(data: bytes) -> Iterator[tuple[bytes, bool]]:
    """(bytes, whether they were inflated): a byte layer as it is and without any
    compression around it, in overlapping windows.  What only looks compressed
    is seen as it is, too.  A level that holds itself ends there."""
    size, levels = max(WINDOW, len(data)), set()
    head, parts, inflated = data, iter(()), False
    while _decompressor(head) is not None and (key := hashlib.blake2b(head).digest()) not in levels:
        levels.add(key)
        yield head, inflated
        inner, parts = _take(_inflated(chain([head], parts)), size)
        inflated |= inner != head
        head = inner
    while True:
        yield head, inflated
        more, parts = _take(parts, size - OVERLAP)
        if not more:
            return
        head = head[-OVERLAP:] + more


def _open(data: bytes, plain: bool = True) -> Iterator[tuple[str, bool]]:
    """(text, whether its characters are the bytes given) of a byte layer; the
    bytes themselves only if ``plain``."""
    for window, inflated in _windows(data):
        if window and (plain or inflated):
            yield window.decode("latin-1"), not inflated
        if b"\0" in window:
            for wide in _WIDE:
                if runs := wide.findall(window):
                    yield "\ufffd".join(x.replace(b"\0", b"").decode("latin-1") for x in runs), False


class _Layer:
    """A text and, for each character, its span in the root text (None: the
    layer is the root; a single span: every character maps to it).  ``place``
    is the root span of the segment that holds the layer."""

    __slots__ = ("text", "at", "whole", "place")

    def __init__(self, text, at=None, whole=None, place=None):
        self.text, self.at, self.whole, self.place = text, at, whole, place or whole

    def span(self, start: int, end: int) -> tuple[int, int]:
        if self.whole:
            return self.whole
        if self.at is None:
            return start, end
        return self.at[start][0], self.at[end - 1][1]


class _Lines:
    """For each byte of wrapped base64, the span of the lines that hold it."""

    def __init__(self, spans: list[tuple[int, int]], lens: list[int]):
        self.spans, self.ends = spans, list(accumulate(lens))

    def __getitem__(self, i: int) -> tuple[int, int]:
        first, last = (bisect_right(self.ends, c) for c in (i * 8 // 6, (i * 8 + 7) // 6))
        return self.spans[first][0], self.spans[last][1]


class _Groups:
    """For each byte of base64 on one line, the span of its group of four characters."""

    def __init__(self, layer: _Layer, start: int, end: int):
        self.layer, self.start, self.end = layer, start, end

    def __getitem__(self, i: int) -> tuple[int, int]:
        at = self.start + i // 3 * 4
        return self.layer.span(at, min(at + 4, self.end))


def _in_place(layer: _Layer, pattern: re.Pattern, decode) -> _Layer | None:
    """The layer with every segment that decodes replaced, or None."""
    text, spans, last, changed = [], [], 0, False
    for m in pattern.finditer(layer.text):
        pieces = decode(m[0])
        if pieces is None:
            continue
        changed = True
        text.append(layer.text[last:m.start()])
        if not layer.whole:
            spans += [layer.span(i, i + 1) for i in range(last, m.start())]
        for chars, s, e in pieces:
            text.append(chars)
            if not layer.whole:
                spans += [layer.span(m.start() + s, m.start() + e)] * len(chars)
        last = m.end()
    if not changed:
        return None
    text.append(layer.text[last:])
    if layer.whole:
        return _Layer("".join(text), whole=layer.whole)
    spans += [layer.span(i, i + 1) for i in range(last, len(layer.text))]
    return _Layer("".join(text), spans, place=layer.place)


def _percent(run: str):
    # bytes that are not UTF-8 are read as Latin-1
    chars = bytes.fromhex(run.replace("%", "")).decode("utf-8", "surrogateescape")
    widths = [3 if "\udc80" <= c <= "\udcff" else 3 * len(c.encode("utf-8")) for c in chars]
    ends = list(accumulate(widths))
    return [(chr(ord(c) & 0xFF) if "\udc80" <= c <= "\udcff" else c, e - w, e) for c, w, e in zip(chars, widths, ends)]


def _escape(run: str):
    if run[0] == "&":
        c = html.unescape(run)
        return [(c, 0, len(run))] if c != run else None
    out = []
    for m in _UNIT.finditer(run):
        code = int(m[5], 8) if m[5] else int(m[1] or m[2] or m[3] or m[4], 16)
        if out and 0xDC00 <= code < 0xE000 and isinstance(out[-1][0], int) and 0xD800 <= out[-1][0] < 0xDC00:
            high, s, _ = out.pop()
            out.append((0x10000 + ((high - 0xD800) << 10) + code - 0xDC00, s, m.end()))
        else:
            out.append((code, m.start(), m.end()))
    return [("�" if 0xD800 <= c < 0xE000 or c > 0x10FFFF else chr(c), s, e) for c, s, e in out]


def _base64(body: str) -> bytes:
    """The bytes of a run of base64; a last character that is too many is left."""
    body = body[:len(body) - (len(body) % 4 == 1)].translate(_URL_SAFE)
    return base64.b64decode(body + "=" * (-len(body) % 4))


def _wrapped(text: str) -> Iterator[list[tuple[int, int]]]:
    """Base64 over several lines, as the places of its lines: all lines that
    follow each other (the first may start inside a line; lengths may differ),
    then each run of lines of one length with the shorter one after them."""
    for m in _WRAPPED.finditer(text):
        lines, at = [], m.start()
        while x := _LINE.match(text, at, m.end()):
            lines.append(x.span())
            if not (gap := _BREAK.match(text, x.end(), m.end())):
                break
            at = gap.end()
        yield lines
        runs, at = [], 0
        for size, run in groupby(lines, lambda x: x[1] - x[0]):
            at += len(list(run))
            runs.append((size, at))
        start = 0
        for k, (size, end) in enumerate(runs):
            last = end + (k + 1 < len(runs) and runs[k + 1][0] < size)
            if last - start > 1 and last - start < len(lines):
                yield lines[start:last]
            start = end


def _segments(layer: _Layer) -> Iterator[_Layer]:
    """Layers hidden in byte segments: base64, and escapes of compressed bytes
    or of wide characters."""
    held = set()  # starts of lines whose bytes an opened layer has, in the same lines

    def known(start: int, data: bytes) -> bool:
        return start in held and _decompressor(data) is None and b"\0" not in data

    for lines in _wrapped(layer.text):
        body = "".join(layer.text[a:b] for a, b in lines)
        if len(body) < 16 or known(lines[0][0], data := _base64(body)):
            continue
        spans = [layer.span(a, b) for a, b in lines]
        place = spans[0][0], spans[-1][1]
        at = _Lines(spans, [b - a for a, b in lines])
        held.update(a for (a, b), end in zip(lines, at.ends) if (end - (b - a)) % 4 == 0)
        for text, same in _open(data):
            yield _Layer(text, at, place=place) if same else _Layer(text, whole=place)
    for m in _BASE64.finditer(layer.text):
        data, whole = _base64(m[0].rstrip("=")), layer.span(m.start(), m.end())
        at = None if layer.whole or _decompressor(data) else _Groups(layer, m.start(), m.end())
        for text, same in () if known(m.start(), data) else _open(data):
            yield _Layer(text, at, place=whole) if same and at else _Layer(text, whole=whole)
    for pattern, strip in ((_PERCENT, "%"), (_BYTES, "\\x")):
        if strip in layer.text:
            for m in pattern.finditer(layer.text):
                whole = layer.span(m.start(), m.end())
                for text, _ in _open(bytes.fromhex(m[0].replace(strip, "")), plain=False):
                    yield _Layer(text, whole=whole)


def _children(layer: _Layer) -> Iterator[_Layer]:
    yield from _segments(layer)
    if "%" in layer.text and (x := _in_place(layer, _PERCENT, _percent)):
        yield x
    if any(x in layer.text for x in ("\\", "&", "%u")) and (x := _in_place(layer, _ESCAPE, _escape)):
        yield x


_URL_SAFE = str.maketrans("-_", "+/")


def decoded_matches(text: str) -> tuple[set[tuple[int, int, int]], int]:
    """Matches in the layers under a text, as root spans; number of layers."""
    found: set[tuple[int, int, int]] = set()
    seen = {hashlib.blake2b(text.encode("utf-8", "surrogatepass")).digest()}
    work, layers = [_children(_Layer(text))], 0  # depth first: one window of a stream is held at a time
    while work:
        x = next(work[-1], None)
        if x is None:
            work.pop()
            continue
        # the same layer text under another span is another finding
        key = hashlib.blake2b(x.text.encode("utf-8", "surrogatepass")).digest() + repr(x.place or "").encode()
        if key in seen:
            continue
        seen.add(key)
        layers += 1
        for s, kind, e in base_matches(x.text):
            a, b = x.span(s, e)
            found.add((a, kind, b))
        work.append(_children(x))
    return found, layers


def spans_of(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]], int]:
    """Base matches, all matches, number of layers opened."""
    base = base_matches(text)
    found, layers = decoded_matches(text)
    return base, sorted(found.union(base)), layers


def _join(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def _scan(batches):
    for batch in batches:
        rows = []
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1)):
            base, every, layers = spans_of(t.as_py() or "")
            n = [sum(k == j for _, j, _ in base) for k in range(3)]
            rows.append((i, *n, hashlib.sha256(_join(base).encode()).hexdigest(), _join(every), len(every), layers))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], schema=_ARROW)


_ARROW = pa.schema([("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()),
                    ("n_hex", pa.int64()), ("base_sha256", pa.string()), ("spans", pa.string()),
                    ("n_spans", pa.int64()), ("n_layers", pa.int64())])


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: base counts, digest of the base spans, all spans."""
    small_batches(df.sparkSession)
    return (df.select(F.col(id_col).cast("long").alias("doc_id"), valid_text(text_col).alias("text"))
              .mapInArrow(_scan, SCHEMA))


def mask(text: str, spans) -> str:
    """The text with every span replaced by ``[kind]``; spans that overlap are
    replaced together and named after the first of them."""
    out, last = [], 0
    for s, k, e in spans:
        if s >= last:
            out += [text[last:s], f"[{KINDS[k]}]"]
        last = max(last, e)
    return "".join([*out, text[last:]])


def redact(df: DataFrame, text_col: str = "text") -> DataFrame:
    """All rows and columns, with the secrets of ``text_col`` masked.  A text without
    secrets keeps its bytes as they are."""
    small_batches(df.sparkSession)

    @F.pandas_udf("string")
    def masked(texts):
        spans = (None if t is None else spans_of(t)[1] for t in texts)
        return pd.Series([mask(t, s) if s else None for t, s in zip(texts, spans)], dtype=object)

    return df.withColumn(text_col, F.coalesce(masked(valid_text(text_col)), F.col(text_col).cast("string")))
