"""Op 13, spelling variant grouping by reduced-alphabet generation.

1. Words are counted over all texts by Spark: maximal runs of letters, A-Z as
   a-z, with the slips of :func:`slipped` put in.  Copies of a word collapse in
   every task before they are shuffled, so a frequent word is no hot key.
2. The letters are hashed to a few symbols.  Two words that differ by one edit
   have *reduced* words that are equal or differ by one edit.  The distinct
   reduced words generate their one-edit neighbourhoods, as 64-bit polynomial
   hashes: O(length x symbols) numbers for a word of any length.  An insertion
   is the deletion of the longer word read backwards, and a replacement leads
   back by a replacement, so each pair is generated on one of its two sides.
3. The neighbourhoods are joined with the reduced vocabulary, the pairs of
   reduced words that exist are expanded to their words, and every pair is
   verified on the original strings.  The number of symbols follows from the
   vocabulary (:func:`symbols_for`), so that a reduced word stands for a few
   words whatever the size of the corpus.
4. A word's form is its near word with the largest count.  Counts at least double
   from a word to its form, so the chain of forms has no cycle and at most 63
   steps; pointer doubling follows it to the root in a few rounds.

Defined results: null and empty texts have no words.  A null id counts as the
empty string in the slip rule.  Repeated rows are counted each.  Bytes that are
not UTF-8 separate words.  Ties between forms go to the smallest word in
code-point order.  An empty table, or one without a word that is frequent enough,
gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstar.session import staged_table

# What a word is, and the slips.
LETTERS = r"A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_LENGTH = 5
MIN_COUNT = 3
SLIP = 97
FORM_FACTOR = 2

MIN_SYMBOLS, MAX_SYMBOLS = 6, 26
CHUNK = 1 << 20  # hashes that a task generates at once
BASE = 0x9E3779B97F4A7C15 | 5
INVERSE = pow(BASE, -1, 1 << 64)


def slipped(doc_id: Column, run: Column) -> Column:
    """The run, without one code point where the checksum of id and run says so."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = F.pmod(h, F.char_length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))
    return F.when(h % SLIP == 0, cut).otherwise(run)


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words that are long and frequent enough."""
    # A run shorter than a word cannot become one: slips only shorten.
    runs = F.regexp_extract_all(F.col(text_col).cast("string"), F.lit(f"([{LETTERS}]{{{min_length},}})"), F.lit(1))
    rows = docs.select(F.col(id_col).alias("_id"), F.explode(runs).alias("run"))
    lower = F.when(F.col("run").rlike("[A-Z]"), F.translate("run", UPPER, LOWER)).otherwise(F.col("run"))
    rows = rows.select("_id", lower.alias("run")).select(slipped(F.col("_id"), F.col("run")).alias("word"))
    return (rows.where(F.char_length("word") >= min_length)
                .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count))


def symbols_for(words: DataFrame) -> int:
    """Symbols with which the words of each length are at most a quarter of the
    reduced words there can be.  One number reaches the driver."""
    per = words.groupBy(F.char_length("word").alias("length")).agg(F.count(F.lit(1)).alias("n"))
    need = per.agg(F.max(F.pow(F.col("n") * 4, F.lit(1.0) / F.col("length")))).first()[0]
    return min(MAX_SYMBOLS, max(MIN_SYMBOLS, math.ceil(need or 0)))


def reduced(words: list[str], symbols: int) -> list[np.ndarray]:
    """Symbols 1..symbols of every word."""
    codes = [np.frombuffer(w.encode("utf-32-le"), "<u4").astype(np.uint64) for w in words]
    return [((c * np.uint64(2654435761)) >> np.uint64(16)) % np.uint64(symbols) + np.uint64(1) for c in codes]


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


def keys(rows: np.ndarray) -> np.ndarray:
    """Polynomial hash of each row of symbols."""
    return (rows * _powers(BASE, rows.shape[1])).sum(axis=1, dtype=np.uint64)


def neighbours(rows: np.ndarray, symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the reduced words that each row of symbols pairs with:
    itself, every deletion, and the replacements with a larger hash."""
    m, length = rows.shape
    power = _powers(BASE, length)
    terms = rows * power
    before = np.cumsum(terms, axis=1, dtype=np.uint64)
    own = before[:, -1:]
    deleted = (before - terms) + (own - before) * np.uint64(INVERSE)
    first = np.ones(rows.shape, bool)  # deleting either of two equal symbols is the same
    first[:, 1:] = rows[:, 1:] != rows[:, :-1]
    r_del, _ = np.nonzero(first)
    other = np.arange(1, symbols + 1, dtype=np.uint64)
    replaced = own[:, :, None] + (other - rows[:, :, None]) * power[:, None]
    larger = (replaced.view(np.int64) > own.view(np.int64)[:, :, None]) & (other != rows[:, :, None])
    r_rep = np.nonzero(larger)[0]
    return (np.concatenate([np.arange(m), r_del, r_rep]),
            np.concatenate([own[:, 0], deleted[first], replaced[larger]]).view(np.int64))


def _reduce(symbols: int):
    def run(batches):
        for batch in batches:
            words = batch.column(1).to_pylist()
            red = reduced(words, symbols)
            key = np.array([keys(r[None, :])[0] for r in red], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(key), pa.array([r.astype(np.uint8).tobytes() for r in red], pa.binary())],
                names=["wid", "word", "n", "rkey", "symbols"])

    return run


def _generate(symbols: int):
    def run(batches):
        for batch in batches:
            key = batch.column(0).to_numpy()
            rows = [np.frombuffer(s, np.uint8).astype(np.uint64) for s in batch.column(1).to_pylist()]
            length = np.array([len(r) for r in rows])
            for n in np.unique(length).tolist():
                at = np.flatnonzero(length == n)
                step = max(1, CHUNK // (n * symbols))
                for k in range(0, len(at), step):
                    some = at[k:k + step]
                    owner, hit = neighbours(np.stack([rows[i] for i in some]), symbols)
                    yield pa.RecordBatch.from_arrays([pa.array(key[some][owner]), pa.array(hit)], names=["rkey", "hit"])

    return run


def near_pairs(vocabulary: DataFrame, symbols: int) -> DataFrame:
    """(a, b): every two words of ``vocabulary`` (wid, word, n, rkey, symbols)
    with one edit between them, once."""
    forms = vocabulary.groupBy("rkey").agg(F.first("symbols").alias("symbols"))
    hits = forms.mapInArrow(_generate(symbols), "rkey long, hit long")
    there = vocabulary.groupBy(F.col("rkey").alias("hit")).agg(F.count(F.lit(1)).alias("words"))
    # a reduced word that stands for one word only is no pair with itself
    hits = hits.join(there, "hit").where("rkey <> hit OR words > 1").select("rkey", "hit")
    left = vocabulary.select("rkey", F.struct("wid", "word", "n").alias("a"))
    right = vocabulary.select(F.col("rkey").alias("hit"), F.struct("wid", "word", "n").alias("b"))
    pairs = hits.join(left, "rkey").join(right, "hit").where("rkey <> hit OR a.wid < b.wid")
    return pairs.where(F.levenshtein(F.col("a.word"), F.col("b.word"), 1) == 1).select("a", "b")


def roots(forms: DataFrame) -> DataFrame:
    """(wid, root) by pointer doubling over (wid, up)."""
    known = staged_table(forms.select("wid", F.col("up").alias("root"), F.lit(True).alias("moved")), "spelling-roots")
    while True:
        jump = known.select(F.col("wid").alias("root"), F.col("root").alias("next"))
        further = known.drop("moved").join(jump, "root", "left")
        known = staged_table(further.select("wid", F.coalesce("next", "root").alias("root"),
                                            F.col("next").isNotNull().alias("moved")), "spelling-roots")
        if known.where("moved").isEmpty():
            return known.select("wid", "root")


def group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", symbols: int | None = None,
          min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word."""
    words = staged_table(count_words(docs, id_col, text_col, min_length, min_count)
                         .select(F.monotonically_increasing_id().alias("wid"), "word", "n"), "spelling-words")
    symbols = symbols or symbols_for(words)
    vocabulary = staged_table(words.mapInArrow(_reduce(symbols), "wid long, word string, n long, rkey long, symbols binary"),
                              "spelling-vocabulary")
    pairs = near_pairs(vocabulary, symbols)
    both = pairs.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("p")).select(
        F.col("p.a.wid").alias("wid"), F.col("p.a.n").alias("n"), F.col("p.b").alias("near"))
    best = F.min(F.struct((-F.col("near.n")).alias("down"), F.col("near.word").alias("word"), F.col("near.wid").alias("wid")))
    near = both.groupBy("wid").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"), F.first("n").alias("n"))
    fits = -F.col("best.down") >= F.col("n") * FORM_FACTOR
    near = staged_table(near.select("wid", "n_near", F.when(fits, F.col("best")).alias("best")), "spelling-near")

    last = roots(near.where("best IS NOT NULL").select("wid", F.col("best.wid").alias("up")))
    last = last.join(words.select(F.col("wid").alias("root"), F.col("word").alias("root_word")), "root").select("wid", "root_word")
    return (words.join(near, "wid", "left").join(last, "wid", "left")
                 .select("word", F.col("best.word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n",
                         F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), (-F.col("best.down")).alias("form_n")))
