"""Vectorised word kernels on UTF-8 buffers.

Words are maximal runs of bytes outside ``0x20`` and ``0x09-0x0D``, which is
the same as ``[^\\x20\\x09-\\x0D]+`` on code points.  Hashes are 64-bit and the
same in every process.
"""

from __future__ import annotations

import numpy as np

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True

_rng = np.random.Generator(np.random.PCG64(20240101))
BYTE_TABLE = _rng.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BYTE_TABLE_LOWER = BYTE_TABLE.copy()
BYTE_TABLE_LOWER[65:91] = BYTE_TABLE[97:123]
BASE = 0x9E3779B97F4A7C15 | 5
INVERSE = pow(BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        steps[0] = 1
        have = np.cumprod(steps, dtype=np.uint64)
        if n <= 1 << 22:  # longer tables are not kept
            _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_spans(buf: np.ndarray, doc_offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of concatenated documents, and the word
    offsets of each document.  A word never crosses a document's end."""
    word = (~IS_SPACE[buf]).view(np.int8)
    start = word.copy()
    start[1:] &= 1 - word[:-1]
    cuts = doc_offsets[1:-1]
    cuts = cuts[cuts < len(buf)]
    start[cuts] = word[cuts]
    starts = np.flatnonzero(start)
    end = word.copy()
    end[:-1] &= 1 - word[1:]
    inner = cuts[cuts > 0]
    end[inner - 1] = word[inner - 1]
    ends = np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, doc_offsets)


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash per word; with ``lower``, A-Z hash as a-z."""
    n = len(buf)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((BYTE_TABLE_LOWER if lower else BYTE_TABLE)[buf] * power(BASE, n), out=sums[1:])
    h = (sums[ends] - sums[starts]) * power(INVERSE, n)[starts] if n else np.zeros(0, np.uint64)
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


_STEP = np.uint64(0xA24BAED4963EE407)


def shingles(words: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word windows inside each document, with the document
    index of each.  A document of 1 to k-1 words has one shingle, its whole
    sequence; a document without words has none."""
    n_words = np.diff(offsets)
    n = len(words)
    parts, owners = [], []
    doc_of = np.repeat(np.arange(len(n_words)), n_words)
    if n >= k:
        h = words[: n - k + 1].copy()
        for j in range(1, k):
            h = h * _STEP + words[j: n - k + 1 + j]
        inside = doc_of[: n - k + 1] == doc_of[k - 1:]
        parts.append(mix(h[inside]))
        owners.append(doc_of[: n - k + 1][inside])
    for d in np.flatnonzero((n_words > 0) & (n_words < k)).tolist():
        h = np.uint64(len(words[offsets[d]:offsets[d + 1]]))
        with np.errstate(over="ignore"):
            for w in words[offsets[d]:offsets[d + 1]]:
                h = h * _STEP + w
        parts.append(mix(np.array([h ^ np.uint64(0x5851F42D4C957F2D)], dtype=np.uint64)))
        owners.append(np.array([d]))
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h, o = np.concatenate(parts), np.concatenate(owners)
    order = np.argsort(o, kind="stable")
    return h[order], o[order]


def distinct_per_doc(h: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of each document, sorted by (document, hash)."""
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    keep = np.ones(len(h), dtype=bool)
    keep[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    return h[keep], owner[keep]
