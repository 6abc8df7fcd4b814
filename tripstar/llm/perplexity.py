"""Op 4, quality rules: n-gram perplexity bands beside plain text rules.

Counting rules (words, symbols, repeated lines and windows) are computed over
the whole text.  The language model is a modified Kneser-Ney model of
``ORDER``-grams of code points as they are written (case, accents, digits and
every script kept), one for each value of the language column:

1. Texts are staged in parts.  A task counts the n-grams of a part by language
   and fold; Spark sums the counts.  What is gathered grows with the corpus: no
   alphabet is fixed and no n-gram is left out.
2. Continuation counts, counts of counts, context totals and back-off weights are
   grouped aggregates, a level at a time, and the recursion from level to level is
   a join on (model, fold, n-gram).  No task trains a language, and no model passes
   through the driver.
3. A text has one of two folds, by a hash of its bytes, and is scored by the counts
   of the other fold: neither it nor its copies train the model that scores it.
4. The model is asked for the distinct n-grams of each part, as 64-bit hashes; the
   answers, sorted hash arrays of that part, meet its texts in a co-group.
5. A text's log-perplexity is its negative log probability for each letter or digit
   of it: runs of predictable marks add to the cost and not to the length.
6. The bands of a language are its median log-perplexity plus and minus ``UPPER``
   and ``LOWER`` times the median absolute deviation, from a histogram over all
   documents that pass the plain rules.  The mean over few characters varies more,
   so below ``BAND_CHARS`` characters the bands widen with the square root of the
   length.
7. Only the language's own model scores a text.  A quotation in another language
   is no noise: of a text's stretches of ``STRETCH`` characters, the share
   ``QUOTED`` that the model expects least is not counted.

A language (null counts as the empty string) with fewer than ``MIN_DOCS``
documents is scored by the model of all documents, and has the band of all.

Defined results: a null or empty text has no words and fails the plain rules;
repeated rows get equal rows; an n-gram that the other fold never has backs off
down to a uniform choice among its letters and one more; an empty table gives an
empty result; other columns are not read.  Code point U+FFFF in a text counts as
the mark before a text's start.  Repeated windows and n-grams are told apart by
64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripstar.llm.blocks import PART_SCHEMA, Block, block_order, give_back, pack, small_batches, unpack, valid_text, write_bucketed
from tripstar.llm.kernels import mix, word_hashes, word_spans
from tripstar.plans.joins import fits_broadcast, lookup_join
from tripstar.session import scratch_path

ORDER = 4
START = "\uffff"
EVERY = "*"             # the model of all languages; the others begin with "="
MIN_WORDS = 20          # fixed rule
MAX_REPEAT = 30         # percent, fixed rule
WINDOW = 8              # words
LOWER, UPPER = 4.0, 4.0
BAND_CHARS = 1500
STRETCH = 100
QUOTED = 0.3
MIN_DOCS = 20
PART = 64 << 20         # bytes of text that ask for their distinct n-grams once
NO_MODEL = 1 << 16      # choices where a fold has no text to learn from
_STEP = 1000            # histogram cells per unit of log-perplexity

_SYMBOL = np.zeros(256, dtype=np.int64)
_SYMBOL[list(b"#*$%&|<>")] = 1
_TURN = np.random.Generator(np.random.PCG64(20240404)).integers(0, 2**63, ORDER, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


# n-grams of texts ------------------------------------------------------------

def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, place, points, offsets): for each character of the texts, a hash of the
    n-gram that ends there and where it starts in ``points``; text offsets."""
    pad = START * (ORDER - 1)
    points = np.frombuffer((pad + pad.join(texts)).encode("utf-32-le", "replace"), np.uint32)
    n = len(points) - ORDER + 1
    lens = np.array([len(t) for t in texts], dtype=np.int64)
    begin = np.cumsum(lens + ORDER - 1) - lens - (ORDER - 1)
    keep = np.ones(n, dtype=bool)
    for j in range(ORDER - 1):
        ends = begin + lens + j
        keep[ends[ends < n]] = False
    place = np.flatnonzero(keep)
    h = np.zeros(n, np.uint64)
    for j in range(ORDER):
        h += points[j:j + n].astype(np.uint64) * _TURN[j]
    return mix(h[place]), place, points, np.concatenate([[0], np.cumsum(lens)])


def _keys(h: np.ndarray, lang: str, fold: int) -> np.ndarray:
    return mix(h + np.uint64(xxhash.xxh64_intdigest(f"{fold}{lang}")))


def _groups(table: pa.Table):
    """Blocks of a part, in order, with their texts and the rows of each (lang, fold)."""
    for k, block in zip(block_order(table), unpack(table)):
        with pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(table.column("rest")[k].as_py())) as stream:
            rest = stream.read_all()
        rows: dict[tuple[str, int], list[int]] = {}
        for i, group in enumerate(zip(rest.column(0).to_pylist(), rest.column(1).to_pylist())):
            rows.setdefault(group, []).append(i)
        yield block, [t.decode("utf-8", "replace") for t in block.texts()], rows


_GRAMS = "part int, lang string, fold int, gram string, key long, n long"
_GRAMS_ARROW = pa.schema([("part", pa.int32()), ("lang", pa.string()), ("fold", pa.int32()), ("gram", pa.string()),
                          ("key", pa.int64()), ("n", pa.int64())])


def _count_part(key, table):
    give_back()
    held: dict[tuple[str, int], list] = {}
    for _, texts, groups in _groups(table):
        for group, rows in groups.items():
            h, place, points, _ = grams([texts[i] for i in rows])
            if len(h):
                u, first, n = np.unique(h, return_index=True, return_counts=True)
                held.setdefault(group, []).append((u, np.lib.stride_tricks.sliding_window_view(points, ORDER)[place[first]], n))
    out = []
    for (lang, fold), found in held.items():
        h, spelt, n = (np.concatenate(x) for x in zip(*found))
        u, first, at = np.unique(h, return_index=True, return_inverse=True)
        n, letters_of = np.bincount(at, n).astype(np.int64), spelt[first]
        order = np.lexsort(letters_of.T[::-1])  # neighbours alike: the table is written smaller
        u, n, flat = u[order], n[order], letters_of[order].tobytes().decode("utf-32-le")
        out.append(pa.Table.from_arrays([
            pa.array(np.full(len(u), key[0].as_py(), np.int32)), pa.array([lang] * len(u), pa.string()),
            pa.array(np.full(len(u), fold, np.int32)), pa.array([flat[i:i + ORDER] for i in range(0, len(flat), ORDER)], pa.string()),
            pa.array(_keys(u, lang, fold).view(np.int64)), pa.array(n)], schema=_GRAMS_ARROW))
    return pa.concat_tables(out) if out else _GRAMS_ARROW.empty_table()


def stage(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The texts in parts, each with its language and fold."""
    small_batches(docs.sparkSession)
    text = F.col(text_col).cast("binary")
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), text.alias("_text"), F.coalesce(valid_text(lang_col), F.lit("")).alias("_lang"),
                       F.pmod(F.xxhash64(text), F.lit(2)).cast("int").alias("_fold"))
    return write_bucketed(rows.mapInArrow(lambda batches: pack(batches, PART), PART_SCHEMA), "perplexity_texts")


# the model -------------------------------------------------------------------

def written(df: DataFrame, name: str) -> DataFrame:
    """The rows, written once in the shared folder and read back; n-grams in order
    compress well."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


_MODEL_KEY = ["model", "fold"]


def _cut(first: int, letters: int, col: str = "gram") -> Column:
    return F.substring(col, first, letters)


def language_models(docs: DataFrame, lang_col: str = "lang") -> DataFrame:
    """(lang, model): a language's own model, or ``EVERY`` below ``MIN_DOCS`` documents."""
    lang = F.coalesce(valid_text(lang_col), F.lit(""))
    own = F.when(F.count(F.lit(1)) >= MIN_DOCS, F.concat(F.lit("="), F.first("lang"))).otherwise(F.lit(EVERY))
    return written(docs.select(lang.alias("lang")).groupBy("lang").agg(own.alias("model")), "languages")


def _levels(top: DataFrame) -> dict[int, DataFrame]:
    """Counts of the longest n-grams; below them, how many letters stand before each."""
    levels = {ORDER: top}
    for k in range(ORDER - 1, 0, -1):
        levels[k] = written(levels[k + 1].groupBy(*_MODEL_KEY, _cut(2, k).alias("gram")).agg(F.count(F.lit(1)).alias("n")), "ngram-level")
    return levels


def _discounts(level: DataFrame) -> DataFrame:
    """D(1), D(2), D(3+) of a level from its counts of counts, and its n-grams."""
    n1, n2, n3, n4 = (F.greatest(F.count_if(F.col("n") == k), F.lit(1)).cast("double") for k in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2)

    def inside(x, top):
        return F.greatest(F.lit(0.05), F.least(F.lit(top), x))

    return level.groupBy(*_MODEL_KEY).agg(inside(1 - 2 * y * n2 / n1, 0.95).alias("d1"), inside(2 - 3 * y * n3 / n2, 1.95).alias("d2"),
                                          inside(3 - 4 * y * n4 / n3, 2.95).alias("d3"), F.count(F.lit(1)).alias("types"))


def probabilities(top: DataFrame, asked: DataFrame) -> DataFrame:
    """(model, fold, gram, p) of the n-grams ``asked`` (model, fold, gram) under the
    modified Kneser-Ney models of the counts ``top`` (model, fold, gram, n)."""
    levels = _levels(top)
    need = {ORDER: asked}
    for k in range(ORDER - 1, 0, -1):
        need[k] = need[k + 1].select(*_MODEL_KEY, _cut(2, k).alias("gram")).distinct()
    lower = None
    for k in range(1, ORDER + 1):
        discounts = written(_discounts(levels[k]), "ngram-discounts")  # a row for each model and fold
        if fits_broadcast(discounts):
            discounts = F.broadcast(discounts)
        contexts = levels[k].groupBy(*_MODEL_KEY, _cut(1, k - 1).alias("context")).agg(
            F.sum("n").alias("total"), *[F.count_if(F.col("n") == i).alias(f"n{i}") for i in (1, 2)], F.count_if(F.col("n") > 2).alias("n3"))
        rows = (need[k].join(levels[k], [*_MODEL_KEY, "gram"], "left").withColumn("context", _cut(1, k - 1))
                       .join(contexts, [*_MODEL_KEY, "context"], "left").join(discounts, _MODEL_KEY, "left"))
        if lower is None:
            low = F.lit(1.0) / F.coalesce(F.col("types") + 1, F.lit(NO_MODEL))
        else:
            rows = rows.withColumn("suffix", _cut(2, k - 1)).join(
                lower.select(*_MODEL_KEY, F.col("gram").alias("suffix"), F.col("p").alias("low")), [*_MODEL_KEY, "suffix"])
            low = F.col("low")
        off = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        back = (F.col("d1") * F.col("n1") + F.col("d2") * F.col("n2") + F.col("d3") * F.col("n3")) / F.col("total")
        seen = F.coalesce((F.col("n") - off) / F.col("total"), F.lit(0.0)) + back * low
        lower = written(rows.select(*_MODEL_KEY, "gram", F.when(F.col("total").isNull(), low).otherwise(seen).alias("p")), "ngram-p")
    return lower


def answers(counted: DataFrame, languages: DataFrame) -> DataFrame:
    """(part, key, log_p) for the n-grams ``counted`` in each part, from the other fold."""
    total = written(counted.groupBy("lang", "fold", "gram", "key").agg(F.sum("n").alias("n")), "ngram-counts")
    total = lookup_join(total, languages, "lang", written=True)
    other = (F.lit(1) - F.col("fold")).alias("fold")
    top = total.where(F.col("model") != EVERY).select("model", other, "gram", "n")
    if not languages.where(F.col("model") == EVERY).isEmpty():
        every = written(total.groupBy(other, "gram").agg(F.sum("n").alias("n")), "ngram-level")
        top = top.unionByName(every.withColumn("model", F.lit(EVERY)))
    p = probabilities(top, total.select(*_MODEL_KEY, "gram").distinct())
    scored = total.join(p, [*_MODEL_KEY, "gram"]).select("key", F.log("p").cast("float").alias("log_p"))
    return counted.select("part", "key").join(scored, "key").select("part", "key", "log_p")


def letters(points: np.ndarray) -> np.ndarray:
    """1 for each letter or digit of any script."""
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(c).isalnum() for c in range(0x110000)), np.int64, 0x110000))
    return _LETTER[0][points]


_LETTER: list[np.ndarray] = []


def log_perplexity(log_p: np.ndarray, letter: np.ndarray, off: np.ndarray, quoted: float = QUOTED) -> np.ndarray:
    """Negative log probability of each text for a letter of it (1 if it has none),
    without the ``quoted`` share of its stretches that are expected least."""
    lens = np.diff(off)
    count = -(-lens // STRETCH)
    text = np.repeat(np.arange(len(lens)), count)
    rank = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    begin = off[:-1][text] + rank * STRETCH
    end = np.minimum(begin + STRETCH, off[1:][text])

    def between(x):
        sums = np.concatenate([[0], np.cumsum(x, dtype=np.float64)])
        return sums[end] - sums[begin]

    cost, size = -between(log_p), between(letter)
    order = np.lexsort((-cost / np.maximum(size, 1), text))
    order = order[rank >= np.floor(quoted * count)[text]]  # ``rank`` is also the place in a text's sorted stretches
    n = len(lens)
    return np.bincount(text[order], cost[order], n) / np.maximum(np.bincount(text[order], size[order], n), 1)


# plain rules -----------------------------------------------------------------

def plain_rules(block: Block) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words per text."""
    n, off = len(block.lens), block.offsets
    buf = np.frombuffer(block.data, np.uint8)
    starts, ends, w_off = word_spans(buf, off)
    n_words = np.diff(w_off)
    points = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
    chars = np.concatenate([[0], np.cumsum(points[ends] - points[starts])])
    symbols = np.concatenate([[0], np.cumsum(_SYMBOL[buf])])
    dup = np.zeros(n, np.int64)
    for i, t in enumerate(block.texts()):
        if b"\n" in t:
            lines = [x for x in t.split(b"\n") if x.split(None, 1)]
            dup[i] = len(lines) - len(set(lines))
    return {"n_words": n_words, "word_chars": chars[w_off[1:]] - chars[w_off[:-1]],
            "n_symbols": symbols[off[1:]] - symbols[off[:-1]], "n_dup_lines": dup,
            "n_repeat_words": repeated_words(word_hashes(buf, starts, ends), w_off)}


def repeated_words(words: np.ndarray, w_off: np.ndarray, k: int = WINDOW) -> np.ndarray:
    """Words inside k-word windows that their text holds twice or more."""
    n_docs, n = len(w_off) - 1, len(words)
    if n < k:
        return np.zeros(n_docs, np.int64)
    doc = np.repeat(np.arange(n_docs), np.diff(w_off))
    h = words[: n - k + 1].copy()
    for j in range(1, k):
        h = h * np.uint64(0xA24BAED4963EE407) + words[j: n - k + 1 + j]
    place = np.flatnonzero(doc[: n - k + 1] == doc[k - 1:])
    h = mix(h[place] + doc[place].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(h)
    same = h[order][1:] == h[order][:-1]
    twice = np.zeros(len(h), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    mark = np.zeros(n + k, np.int32)
    mark[place[twice] + k] = 1
    np.cumsum(mark, out=mark)
    covered = np.concatenate([[0], np.cumsum(mark[k:] > mark[:n])])
    return covered[w_off[1:]] - covered[w_off[:-1]]


_STATS = ("doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
          "n_repeat_words long, log_perplexity double")
_NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_STATS_ARROW = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), *[(c, pa.int64()) for c in _NAMES],
                          ("log_perplexity", pa.float64())])


def _score_part(left, right):
    """A part's texts and its sorted hash arrays."""
    give_back()
    keys = right.column("key").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(keys)
    keys, values = keys[order], right.column("log_p").to_numpy()[order]
    out = []
    for block, texts, groups in _groups(left):
        score, langs = np.zeros(len(texts)), [""] * len(texts)
        for (lang, fold), rows in groups.items():
            h, place, points, off = grams([texts[i] for i in rows])
            if len(h):
                found = values[np.searchsorted(keys, _keys(h, lang, fold))]
                score[rows] = log_perplexity(found, letters(points[place + ORDER - 1]), off)
            for i in rows:
                langs[i] = lang
        rules = plain_rules(block)
        out.append(pa.Table.from_arrays([pa.array(block.ids, mask=block.id_null), pa.array(langs, pa.string()),
                                         *[pa.array(rules[c], pa.int64()) for c in _NAMES], pa.array(score)], schema=_STATS_ARROW))
    return pa.concat_tables(out) if out else _STATS_ARROW.empty_table()


def statistics(docs: DataFrame, languages: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Plain counts and log-perplexity of every row."""
    staged = stage(docs, id_col, text_col, lang_col)
    counted = written(staged.groupBy("part").applyInArrow(_count_part, _GRAMS), "ngram-parts")
    found = answers(counted, languages)
    return staged.groupBy("part").cogroup(found.groupBy("part")).applyInArrow(_score_part, _STATS)


def _median(cells: DataFrame, value: str, out: str) -> DataFrame:
    """Lower median per model of a histogram (model, value, n)."""
    run = W.partitionBy("model").orderBy(value).rowsBetween(W.unboundedPreceding, 0)
    return (cells.groupBy("model", value).agg(F.sum("n").alias("n"))
                 .withColumn("upto", F.sum("n").over(run)).withColumn("all", F.sum("n").over(W.partitionBy("model")))
                 .where(F.col("upto") * 2 >= F.col("all"))
                 .groupBy("model").agg(F.min(value).alias(out)))


def bands(stats: DataFrame, lower: float = LOWER, upper: float = UPPER) -> DataFrame:
    """(model, middle, below, above) in log-perplexity: the band of a text of
    ``BAND_CHARS`` characters or more.  The band of ``EVERY`` comes from all rows of
    ``stats`` that pass the plain rules."""
    one = (stats.where(~_failed()).groupBy("model", F.floor(F.col("log_perplexity") * _STEP).alias("cell"))
                .agg(F.count(F.lit(1)).alias("n")))
    cells = one.where(F.col("model") != EVERY).unionByName(one.withColumn("model", F.lit(EVERY)))
    middle = _median(cells, "cell", "middle")
    spread = _median(cells.join(middle, "model").withColumn("off", F.abs(F.col("cell") - F.col("middle"))), "off", "mad")
    width = F.greatest("mad", F.lit(1)) / _STEP
    return (middle.join(spread, "model")
                  .select("model", (F.col("middle") / _STEP).alias("middle"), (lower * width).alias("below"), (upper * width).alias("above")))


def _failed():
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per document: counts, log-perplexity, ``base_failed``, ``kept``."""
    languages = language_models(docs, lang_col)
    stats = written(statistics(docs, languages, id_col, text_col, lang_col), "text-statistics")
    stats = lookup_join(stats, languages, "lang", written=True)
    chars = F.greatest(F.col("word_chars") + F.col("n_words"), F.lit(1))
    wider = F.greatest(F.lit(1.0), F.sqrt(F.lit(float(BAND_CHARS)) / chars))
    off = F.col("log_perplexity") - F.col("middle")
    inside = F.col("middle").isNull() | off.between(-wider * F.col("below"), wider * F.col("above"))
    return (lookup_join(stats, bands(stats), "model").withColumn("base_failed", _failed())
                 .select("doc_id", *_NAMES, "base_failed", (~F.col("base_failed") & inside).alias("kept"), "log_perplexity"))
