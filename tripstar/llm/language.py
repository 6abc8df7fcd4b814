"""Op 6, language identification by Bayesian evidence fusion.

The languages are ``LANGUAGES`` and every ISO 639 code that ``MIN_PAGES`` pages
or more declare, in order, and at last "other": any other language.  For every
page and language ``l`` three kinds of evidence are added as log probabilities:

* text: character trigrams (letters of all scripts, in lower case) of the page's text
  under a model of ``l``, counted
  over all pages by their declared language (weak labels), scaled by ``TEMPER``
  because neighbouring trigrams are not independent; "other" is counted on the
  pages that declare any other code, and takes all trigrams alike besides;
* markup: how often pages of language ``l`` declare what this page declares
  (the ``html`` and ``meta`` tags of the whole page, outside comments and scripts);
* address: a host prior, smoothed towards the prior of its address suffix,
  which is smoothed towards the prior of all pages.  The page's own share is
  taken out of the counts, so a page does not vouch for itself.

Markup and priors are counted with the pages' text posteriors (soft counts) by
grouped aggregation.  Pages are read twice (count, score); after that only one
narrow row per page is kept.  A host that holds a third of all pages is one row
of the prior table; the join of pages to that table is split by adaptive
execution where it is skewed.  What is broadcast is the trigram model, one cell
for each language and each of at most ``N_SYMBOLS ** 3`` trigrams seen, and the
markup table, at most (languages + 2) ** 2 cells; two and three letters bound the
languages.  ``posterior`` has the languages in that order; the column's metadata
names them.

Defined results: bytes that are not UTF-8 are read as U+FFFD; a page without text is judged by markup and address alone;
null html, null or unreadable URLs (host "" and suffix "") and unknown declared
languages ("other"; "none" if nothing is declared) are values like others;
repeated rows get equal rows, ties go to the first language in order; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstar.llm.components import written
from tripstar.llm.html_text import _ATTR, _pages, blocks

LANGUAGES = ("de", "en", "es", "fr")
TEMPER = 0.2
HOST_WEIGHT = 5.0    # pages that the suffix prior counts for in a host's prior
SUFFIX_WEIGHT = 20.0
SAYS_OWN, SAYS_OTHER = 8.0, 0.5  # prior counts of declarations
N_SYMBOLS = 96
LATIN = 63  # numbers below stand for separators and Latin letters

OTHER, NONE = "other", "none"
NO_LANGUAGE = frozenset(("und", "mul", "mis", "zxx"))  # codes that name no single language
UNTRAINED = 0.25  # below "other" where nothing declares a language
MIN_PAGES = 20  # pages that declare a language before it has a model

_QUOTED = r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+"
_TAG = re.compile(rf"<!--.*?(?:-->|\Z)|<(script|style|textarea|title|noscript|iframe|template)\b{_QUOTED}>.*?(?:</\1\b|\Z)"
                  rf"|<(html|meta)\b({_QUOTED})>|<(?:html|meta)\b[^>]*", re.I | re.S)
# tags with broken quotes
_LANG = re.compile(r"<html\b[^>]*?\s(?:xml:)?lang\s*=\s*[\"']?([a-zA-Z]+)", re.I)
_META = re.compile(r"<meta\b(?=[^>]*content-language)[^>]*?\scontent\s*=\s*[\"']?([a-zA-Z]+)", re.I)
_CODE = re.compile(r"\s*([a-zA-Z]+)")


def _alphabet() -> np.ndarray:
    """For each code point 0 where it separates words, else its letter in lower case:
    the Latin ones up to U+024F, then those of all other scripts, mixed over the
    numbers that are left.  Letters that share a number only blur the model: a text is
    told by its trigrams."""
    table = np.zeros(0x20000, dtype=np.int64)
    for c in range(len(table)):
        x = chr(c)
        if c >= 0x250 and unicodedata.category(x)[0] in "LM":  # with the vowel signs
            low = x.lower()
            table[c] = LATIN + _mixed(ord(low) if len(low) == 1 else c)
        elif c < 0x250 and x.isalpha() and len(low := x.lower()) == 1:
            o = ord(low)
            table[c] = 1 + o - 97 if 97 <= o < 123 else 27 + (o - 0xDF) % 36
    return table


def _mixed(point):
    """A number below ``N_SYMBOLS - LATIN`` for a code point of another script."""
    return (point * 0x9E3779B1 >> 15) % (N_SYMBOLS - LATIN)


_FOLD = _alphabet()


def trigrams(text: str) -> np.ndarray:
    """Codes of the trigrams of a text, words parted by one separator."""
    points = np.frombuffer(f" {text} ".encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    known = points < len(_FOLD)
    sym = np.where(known, _FOLD[np.where(known, points, 0)], LATIN + _mixed(points))
    sym = sym[np.concatenate([[True], (sym[1:] != 0) | (sym[:-1] != 0)])]
    return (sym[:-2] * N_SYMBOLS + sym[1:-1]) * N_SYMBOLS + sym[2:]


def _declarations(page: str) -> Iterator[tuple[str, str]]:
    """(tag, code) of the html and meta tags that declare a language."""
    for m in _TAG.finditer(page):
        if m[2]:
            tag = m[2].lower()
            attrs = {x[1].lower(): x[2] or x[3] or x[4] or "" for x in _ATTR.finditer(m[3])}
            if tag == "html":
                value = attrs.get("lang") or attrs.get("xml:lang") or ""
            else:
                says = any(v.strip().lower() == "content-language" for v in attrs.values())
                value = attrs.get("content", "") if says else ""
            if code := _CODE.match(value):
                yield tag, code[1].lower()
        elif not m[1] and (code := _LANG.match(m[0]) or _META.match(m[0])):
            yield m[0][1:5].lower(), code[1].lower()


def declared_code(page: str) -> str | None:
    """The language code the markup declares (html before meta), "other" for
    what is no ISO 639 code of a language, None if nothing is declared."""
    meta = None
    for tag, code in _declarations(page):
        if tag == "html":
            meta = code
            break
        meta = meta or code
    return meta if meta is None or 2 <= len(meta) <= 3 and meta not in NO_LANGUAGE else OTHER


def declared(page: str, languages: tuple[str, ...] = LANGUAGES) -> str:
    """The language the markup declares: a known one, "other" or "none"."""
    code = declared_code(page)
    return NONE if code is None else code if code in languages else OTHER


def _text(page: str) -> str:
    main, loose, marked = blocks(page)
    return " ".join(main if marked and main else loose)


@dataclass
class Model:
    """Log probabilities of trigrams: ``table`` has a row for each trigram seen
    (row 0: any other) and a column for each of ``names``; ``index`` is the row."""

    names: tuple[str, ...]
    index: np.ndarray
    table: np.ndarray

    def log_p(self, code: np.ndarray) -> np.ndarray:
        """Sum over the trigrams, per language."""
        return self.table[self.index[code]].sum(axis=0, dtype=np.float64)


def train(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> Model:
    """The trigram model of all languages: Witten-Bell smoothing towards all
    trigrams alike, which "other" is made of by half, so that text no language
    expects is "other" also beside languages with few pages."""
    cells = N_SYMBOLS**3  # this number itself stands for pages

    def rows(held):
        for lang, n in held.items():
            c = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(c), pa.string()), pa.array(c.astype(np.int32)), pa.array(n[c])],
                                             names=["lang", "code", "n"])

    def count(batches):
        held = {}
        for batch in batches:
            for page in batch.column(4):
                page = page.as_py() or ""
                lang = declared_code(page)
                if lang is None:
                    continue
                if lang not in held:
                    if len(held) == 8:
                        yield from rows(held)
                        held = {}
                    held[lang] = np.zeros(cells + 1, np.int64)
                code, n = np.unique(trigrams(_text(page)), return_counts=True)
                held[lang][code] += n
                held[lang][cells] += 1
        yield from rows(held)

    counts = written(_pages(pages, id_col, url_col, html_col).mapInArrow(count, "lang string, code int, n long")
                     .groupBy("lang", "code").agg(F.sum("n").alias("n")), "trigram-counts")
    often = counts.where((F.col("code") == cells) & (F.col("n") >= MIN_PAGES) & ~F.col("lang").isin(OTHER, *LANGUAGES))
    names = (*LANGUAGES, *sorted(r.lang for r in often.select("lang").collect()), OTHER)  # bounded: codes of 2 or 3 letters
    lang = F.when(F.col("lang").isin(*names), F.col("lang")).otherwise(OTHER)
    seen = (counts.where(F.col("code") < cells).groupBy(lang.alias("lang"), "code").agg(F.sum("n").alias("n"))).toArrow()  # bounded: see above
    code, row = np.unique(seen.column("code").to_numpy(), return_inverse=True)
    place = {x: k for k, x in enumerate(names)}
    column = np.array([place[x] for x in seen.column("lang").to_pylist()], dtype=np.int64)
    table = np.zeros((len(code) + 1, len(names)))
    table[row + 1, column] = seen.column("n").to_numpy()
    total, kinds = table.sum(axis=0), (table > 0).sum(axis=0)
    p = (table + kinds / cells) / np.maximum(total + kinds, 1)
    p[:, total == 0] = UNTRAINED / cells
    p[:, -1] = (table[:, -1] / total[-1] + 1 / cells) / 2 if total[-1] else 1 / cells
    index = np.zeros(cells, np.int32)
    index[code] = np.arange(1, len(code) + 1)
    return Model(names, index, np.log(p).astype(np.float32))


_SEEN = "page_id long, url string, host string, suffix string, declared string, n_trigrams long, text array<double>"
_SEEN_ARROW = pa.schema([("page_id", pa.int64()), *[(c, pa.string()) for c in ("url", "host", "suffix", "declared")],
                         ("n_trigrams", pa.int64()), ("text", pa.list_(pa.float64()))])


def read_pages(pages: DataFrame, model: Model, id_col: str = "page_id", url_col: str = "url",
               html_col: str = "html") -> DataFrame:
    """One narrow row per page: address, declared language, tempered text
    log-likelihood per language (relative to the best)."""
    held = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            said, n, text = [], [], []
            for page in batch.column(4):
                page = page.as_py() or ""
                code = trigrams(_text(page))
                code = code[code > 0]
                ll = TEMPER * held.value.log_p(code)
                said.append(declared(page, held.value.names))
                n.append(len(code))
                text.append(np.round(ll - ll.max(), 6).tolist())
            host = batch.column(2)
            suffix = pa.array([h.as_py().rsplit(":", 1)[0].rsplit(".", 1)[-1] for h in host], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), host, suffix, pa.array(said), pa.array(n),
                                              pa.array(text, pa.list_(pa.float64()))], schema=_SEEN_ARROW)

    return _pages(pages, id_col, url_col, html_col).mapInArrow(run, _SEEN)


def _softmax(col: str):
    top = F.array_max(col)
    weights = F.transform(F.col(col), lambda x: F.exp(x - top))
    total = F.aggregate(weights, F.lit(0.0), lambda a, x: a + x)
    return F.transform(weights, lambda x: x / total)


def _sums(col: str, name: str, k: int):
    """Sums of a vector's cells, rounded so that they do not depend on order."""
    return F.array(*[F.sum(F.round(F.col(col)[i], 6).cast("decimal(20,6)")).cast("double") for i in range(k)]).alias(name)


def _plus(*cols: str):
    """Sum of vectors, cell by cell."""
    first, *rest = cols
    out = F.col(first)
    for c in rest:
        out = F.zip_with(out, F.col(c), lambda x, y: x + y)
    return out


def identify(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, lang, confidence, declared, text_lang, posterior) for every page."""
    model = train(pages, id_col, url_col, html_col)
    k = len(model.names)
    seen = written(read_pages(pages, model, id_col, url_col, html_col), "page-evidence")
    soft = seen.withColumn("r", _softmax("text"))

    everything = soft.agg(_sums("r", "all", k))
    suffixes = soft.groupBy("suffix").agg(_sums("r", "in_suffix", k))
    hosts = soft.groupBy("host", "suffix").agg(_sums("r", "in_host", k)).join(suffixes, "suffix").drop("suffix")
    said = soft.groupBy("declared").agg(_sums("r", "says", k))  # at most k + 1 rows

    placed = (soft.join(hosts, "host").join(F.broadcast(said), "declared")
                  .withColumn("all", everything.scalar()))
    for col in ("all", "in_suffix", "in_host", "says"):  # without the page itself
        placed = placed.withColumn(col, F.zip_with(col, "r", lambda n, r: F.greatest(n - r, F.lit(0.0))))

    def share(own, weight, below):
        """Smoothed shares of the counts."""
        total = F.aggregate(F.col(own), F.lit(0.0), lambda a, x: a + x)
        return F.zip_with(own, below, lambda n, p: (n + weight * p) / (total + weight))

    total_all = F.aggregate(F.col("all"), F.lit(0.0), lambda a, x: a + x)
    placed = placed.withColumn("p_all", F.transform("all", lambda n: (n + 1.0) / (total_all + k)))
    placed = placed.withColumn("p_suffix", share("in_suffix", SUFFIX_WEIGHT, "p_all"))
    placed = placed.withColumn("p_host", share("in_host", HOST_WEIGHT, "p_suffix"))
    names = F.array(*[F.lit(x) for x in model.names])
    # a page mostly declares its own language, until the counts say otherwise
    own = F.transform(names, lambda x: F.when(x == F.col("declared"), SAYS_OWN).otherwise(SAYS_OTHER))
    placed = placed.withColumn("says", F.zip_with("says", own, lambda n, o: n + o))
    placed = placed.withColumn("markup", F.zip_with("says", "all", lambda n, a: F.log(n / (a + SAYS_OWN + SAYS_OTHER * k))))
    placed = placed.withColumn("host_log", F.transform("p_host", lambda p: F.log(p)))
    placed = placed.withColumn("score", _plus("text", "markup", "host_log"))

    def best(col):
        return F.element_at(names, F.array_position(F.col(col), F.array_max(col)).cast("int"))

    return (placed.withColumn("posterior", F.transform(_softmax("score"), lambda x: F.round(x, 6)))
                  .select("page_id", "url", best("posterior").alias("lang"), F.array_max("posterior").alias("confidence"),
                          "declared", F.when(F.col("n_trigrams") > 0, best("text")).alias("text_lang"),
                          F.col("posterior").alias("posterior", metadata={"languages": list(model.names)})))
