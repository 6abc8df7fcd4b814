"""Op 8, byte-level BPE over a distinct-word table.

1. Texts are split into words (a run of non-space characters with the one space
   before it; the rest of a white-space run is a word of its own).  The
   tokenizer's own splitting never joins characters of two such words, so a
   word encodes the same alone as in its text.
2. Each scan task sends the distinct words it holds, by hash bucket.  A bucket
   collects its words from all tasks: together the buckets are the table of
   distinct words, and each word is encoded once.
3. The ids go back to the tasks that asked (co-group on ``part``), where every
   position of every text looks its word up: the ids in order.  Texts stay
   where they were staged; only distinct words and their ids are shuffled.
4. Decoding looks every id up in the id-to-piece table (bounded by the
   vocabulary) and joins the pieces' bytes.

Special tokens inside a text are taken as the tokenizer takes them: they end
the words around them and have ids of their own.

Defined results: bytes that are not UTF-8 are read as U+FFFD; null and empty texts have no tokens and decode to the empty
string; repeated rows each get a row; null ids stay null; an empty table gives
an empty result; other columns are not read.  A task holds one scan split, its
distinct words and their ids.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstar.llm.blocks import expand, give_back, n_buckets, squeeze, stage_parts, unpack

# The characters that the tokenizer's \s matches.
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_WORD = re.compile(f" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]")
_CHUNK = 10_000


def words(text: str, specials: re.Pattern | None) -> list[str]:
    """The words of a text, in order; together they are the text."""
    if specials is None or not specials.search(text):
        return _WORD.findall(text)
    out = []
    for segment in specials.split(text):  # the group keeps the special tokens
        out += [segment] if specials.fullmatch(segment) else _WORD.findall(segment)
    return out


def byte_alphabet() -> dict[str, int]:
    """Character to byte of byte-level vocabularies: printable bytes stand for
    themselves, the others for the code points from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """What tasks need of a tokenizer file; its JSON is what is broadcast."""

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        added = {t["content"]: t["id"] for t in json.loads(spec)["added_tokens"]}
        self.specials = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        alphabet = byte_alphabet()
        self.pieces = [b""] * (max(self.tokenizer.get_vocab(True).values(), default=-1) + 1)
        for token, i in self.tokenizer.get_vocab(True).items():
            self.pieces[i] = token.encode() if token in added or not set(token) <= alphabet.keys() else bytes(alphabet[c] for c in token)

    def encode(self, distinct: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(distinct, add_special_tokens=False)]

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.pieces.__getitem__, ids.tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=1)
def vocabulary_of(spec: str) -> Vocabulary:
    """The vocabulary of a worker process, built once."""
    return Vocabulary(spec)


def _bucket(word: str, n: int) -> int:
    return zlib.crc32(word.encode("utf-8")) % n


def _by_bucket(distinct, n: int) -> dict[int, list[str]]:
    out: dict[int, list[str]] = {}
    for w in distinct:
        out.setdefault(_bucket(w, n), []).append(w)
    for ws in out.values():
        ws.sort()
    return out


def _positions(table: pa.Table, specials) -> tuple[list, dict[str, int]]:
    """(block, word numbers of each text) of one part, and its distinct words
    numbered.  Four bytes a word: a part's words are not held as strings."""
    blocks, number = [], {}
    for block in unpack(table):
        at = []
        for t in block.texts():
            ws = words(t.decode("utf-8", "replace"), specials)
            at.append(np.fromiter((number.setdefault(w, len(number)) for w in ws), np.int32, len(ws)))
        blocks.append((block.id_list(), at))
    return blocks, number


_ASK = "part int, bucket int, words binary"
_ASK_ARROW = pa.schema([("part", pa.int32()), ("bucket", pa.int32()), ("words", pa.binary())])
_ANSWER = "part int, bucket int, counts binary, ids binary"
_ANSWER_ARROW = pa.schema([("part", pa.int32()), ("bucket", pa.int32()), ("counts", pa.binary()), ("ids", pa.binary())])
_TOKENS = "doc_id long, ids binary, decoded string"
_TOKENS_ARROW = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("decoded", pa.string())])


def _pack_words(ws: list[str]) -> bytes:
    raw = [w.encode("utf-8") for w in ws]
    lens = np.array([len(r) for r in raw], dtype=np.uint32)
    return zstandard.ZstdCompressor(level=3).compress(np.uint32(len(raw)).tobytes() + lens.tobytes() + b"".join(raw))


def _unpack_words(blob: bytes) -> list[bytes]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(data, np.uint32, 1)[0])
    ends = np.cumsum(np.frombuffer(data, np.uint32, n, 4), dtype=np.int64) + 4 + 4 * n
    at, out = 4 + 4 * n, []
    for e in ends.tolist():
        out.append(data[at:e])
        at = e
    return out


def tokenize(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, decoded): ids as little-endian unsigned 32-bit integers,
    and the text decoded from them."""
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())
    staged = stage_parts(docs, id_col, text_col, "bpe_texts")
    n = n_buckets(spark)

    def ask(key, table):
        give_back()
        vocabulary = vocabulary_of(spec.value)
        part = key[0].as_py()
        distinct: set[str] = set()
        for block in unpack(table):
            for t in block.texts():
                distinct.update(words(t.decode("utf-8", "replace"), vocabulary.specials))
        rows = [(part, b, _pack_words(ws)) for b, ws in _by_bucket(distinct, n).items()]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * 3, _ASK_ARROW)], schema=_ASK_ARROW)

    def encode(table):
        """One bucket of the distinct-word table: encode, answer every part."""
        give_back()
        vocabulary = vocabulary_of(spec.value)
        asked = [_unpack_words(b.as_py()) for b in table.column("words")]
        distinct = sorted(set().union(*asked))
        known: dict[bytes, bytes] = {}
        for at in range(0, len(distinct), _CHUNK):
            chunk = distinct[at:at + _CHUNK]
            for w, ids in zip(chunk, vocabulary.encode([w.decode("utf-8") for w in chunk])):
                known[w] = np.array(ids, dtype="<u4").tobytes()
        counts, out = [], []
        for ws in asked:
            ids = [known[w] for w in ws]
            counts.append(squeeze(np.array([len(i) // 4 for i in ids], dtype=np.uint32)))
            out.append(squeeze(np.frombuffer(b"".join(ids), np.uint8)))
        return pa.Table.from_arrays([table.column("part"), table.column("bucket"), pa.array(counts, pa.binary()),
                                     pa.array(out, pa.binary())], schema=_ANSWER_ARROW)

    def join(left, right):
        give_back()
        vocabulary = vocabulary_of(spec.value)
        blocks, number = _positions(left, vocabulary.specials)
        grouped, ids_of = _by_bucket(number, n), [b""] * len(number)
        for k, b in enumerate(right.column("bucket").to_pylist()):
            ends = np.cumsum(expand(right.column("counts")[k].as_py(), np.uint32), dtype=np.int64) * 4
            ids = expand(right.column("ids")[k].as_py(), np.uint8).tobytes()
            at = 0
            for w, e in zip(grouped.pop(b), ends.tolist()):
                ids_of[number[w]] = ids[at:e]
                at = e
        del number, grouped
        doc_ids, out, decoded = [], [], []
        for block_ids, at in blocks:
            doc_ids += block_ids
            for places in at:
                ids = b"".join(map(ids_of.__getitem__, places.tolist()))
                out.append(ids)
                decoded.append(vocabulary.decode(np.frombuffer(ids, "<u4")))
        return pa.Table.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(out, pa.binary()),
                                     pa.array(decoded, pa.string())], schema=_TOKENS_ARROW)

    asked = staged.groupBy("part").applyInArrow(ask, _ASK)
    answers = asked.groupBy("bucket").applyInArrow(encode, _ANSWER)
    return staged.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(join, _TOKENS)


def digest(tokens: DataFrame) -> DataFrame:
    """Token counts and digests of :func:`tokenize`'s rows."""
    return tokens.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                         F.sha2("ids", 256).alias("ids_sha256"),
                         F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
