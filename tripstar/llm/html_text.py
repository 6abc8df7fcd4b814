"""Op 2, HTML extraction: structure, then nearest-URL page differencing.

1. A page is read once into blocks of text.  Parts that are never article text
   are dropped where the markup says so (menus, headers, footers, sidebars,
   notices, adverts, forms, scripts, styles, reader comments: by element, role,
   or words of the class and id).  White space inside a block becomes one
   space.  If the page marks its article (``article``, ``main``), blocks outside
   it are *loose*; without such a mark all blocks are loose.
2. Pages of a host with equal loose lines are copies and count as one, at the
   first of their places.  The different pages are ordered by host, path and id,
   and each is paired with its nearest neighbour of the same host.  Their loose
   lines are aligned by longest common subsequence, and the lines they share
   (menus and notices that carry no telling markup) are deleted.  Lines inside a
   marked article are not deleted: copies of an article on one host share all of
   them, unless the neighbour has the line outside its own (below).  A pair whose lines that are not shared are equal (moved lines), or are
   found on one page only, tells nothing: then the neighbour on the other side is
   taken.  Where the nearest page shares nearly all text, it may be the same
   article with another date, or a short one under the same menus: then only what
   the neighbour on the other side shares too is deleted, if it shares anything.
3. Pages with a marked article are paired and aligned in the same way among
   themselves, by all their lines in page order.  A shared line that lies inside the
   article here and outside it on the neighbour page is the host's, not the
   article's, and is deleted; one that both have inside stays (copies, headings).
   What is left of the article's lines is the text.  Without a marked article it is
   what differencing leaves of the loose lines.

Scale: pages without a marked article travel with their lines; of the others only
64-bit hashes of the lines do, and the deleted places, which go back to the pages
as they are read a second time.  Order comes from a range partitioning, so a
host that holds a third of all pages spreads over tasks.  The first and the last
page of a host in a range meet their neighbours over the range borders, from a
table of first and last pages per (host, range), so the result does not depend
on where the borders are.

A class is judged name by name: a telling word drops the element, also after the
name of what it belongs to ("article-comments", "post-share", "content-sidebar"), but
not a layout ("with-sidebar", "content-sidebar-wrap"), an article's own heading
("post-header") or a subject before its holder ("legal-content").  An id inside a
marked article is often made of a title, so headings and sections are never dropped for
it, and elsewhere words that may be a subject ("discussion", "legal-form") do not tell.

Defined results: null and empty html give an empty text; bytes that are not UTF-8
are read as U+FFFD; pages with a null or
unreadable URL share the host ""; a host with one page has nothing to compare;
repeated rows are pages like others (a copy is never used to delete its copy's
lines); an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripstar.llm.blocks import small_batches, valid_text
from tripstar.llm.components import written

# Elements, roles and name words that mark other than main text.
DROP = frozenset("""script style noscript template iframe object svg math canvas audio video picture map nav aside
footer form button select option optgroup textarea input label fieldset legend datalist dialog menu head title
header""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template".split())
BLOCK = frozenset("""address article blockquote body br center dd details div dl dt figcaption figure h1 h2 h3 h4 h5
h6 hr html li main ol p pre section summary table tbody td tfoot th thead tr ul""".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
WORDS = frozenset("""ad ads adv advert adverts advertisement advertising banner promo promoted promotion sponsor
sponsored cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe
subscription signup login nav navbar navigation menu breadcrumb breadcrumbs toolbar sidebar side aside widget
widgets footer foot header masthead topbar share sharing social related recommended recommendations teaser
comment comments commentlist disqus replies reply respond discussion pagination pager copyright disclaimer legal
search form""".split())
TOPICS = frozenset("""notice notices alert login header head search form social related discussion legal copyright
respond disclaimer overlay side foot""".split())  # also words of a text's own subject
LAYOUT = frozenset("has with without no".split())  # "with-sidebar"
HOLDERS = frozenset("main content article articles body post posts entry story page".split())
FRAMES = frozenset("wrap wrapper container layout grid row columns".split())  # "content-sidebar-wrap" holds both
SLUGS = frozenset("h1 h2 h3 h4 h5 h6 section p li dt dd blockquote figure table tr td th pre span a".split())
MAIN = frozenset(("article", "main"))
COPY_SHARE = 0.9
TABLE_BITS = 1 << 28

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</?[a-zA-Z][^>]*(?:>|\Z)", re.S)  # the last: broken quotes, a tag cut off by the end
_ATTR = re.compile(r"([a-zA-Z_:-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME = re.compile(r"[a-z]+|[A-Z][a-z]*")


def _attrs(attrs: str) -> Iterator[tuple[str, str]]:
    for m in _ATTR.finditer(attrs):
        yield m[1].lower(), m[2] or m[3] or m[4] or ""


def unwanted_name(name: str, slug: bool = False) -> bool:
    """Whether one class or id names something other than main text.  ``slug``:
    the name may be made of a heading, so words of a subject do not tell."""
    parts = [w.lower() for w in _NAME.findall(name)]
    telling = [k for k, w in enumerate(parts) if w in WORDS]
    if not telling or LAYOUT.intersection(parts):
        return False
    if slug and not any(parts[k] not in TOPICS for k in telling):
        return False
    holders = [k for k, w in enumerate(parts) if w in HOLDERS]
    if not holders:
        return True
    if parts[-1] in FRAMES and {"sidebar", "side", "aside"}.intersection(parts) and {"content", "main"}.intersection(parts):
        return False
    after = [parts[k] for k in telling if k > holders[0]]
    if after:  # "article-comments", "post-share"; not a text's own heading ("post-header")
        return any(w not in ("header", "head", "masthead") for w in after)
    return any(parts[k] not in TOPICS for k in telling)  # "comment-body"; not "legal-content"


def _unwanted(tag: str, attrs: str, in_main: bool) -> bool:
    if tag in DROP:
        return not (tag == "header" and in_main)  # an article's own heading
    if not attrs.strip():
        return False
    named = list(_attrs(attrs))
    classes = [c for name, value in named if name == "class" for c in value.split()]
    if tag in MAIN:  # an article inside the article may be a comment or a teaser
        return in_main and any(unwanted_name(c, slug=True) for c in classes)
    for name, value in named:
        if name == "class" and tag not in ("html", "body"):
            if any(map(unwanted_name, classes)):
                return True
        elif name == "id" and tag not in ("html", "body"):
            # inside an article the id of a heading or section is made of its title
            if in_main and (tag in SLUGS or "section" in classes):
                continue
            if unwanted_name(value, slug=in_main or tag in SLUGS):
                return True
        elif name == "role" and value.lower() in ROLES:
            return True
        elif name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        elif name == "style" and "display:none" in value.replace(" ", "").lower():
            return True
    return False


def blocks(page: str) -> tuple[list[str], list[str], bool]:
    """(lines of the marked article, loose lines, is an article marked)."""
    lines, marked = lines_of(page)
    return [x for x, inside in lines if inside], [x for x, inside in lines if not inside], marked


def lines_of(page: str) -> tuple[list[tuple[str, bool]], bool]:
    """The lines in page order, each with whether the marked article holds it;
    is an article marked."""
    lines, words = [], []
    stack: list[str] = []          # open elements that matter: dropped or main
    skip_at = main_at = 0          # stack depths, 0 while outside
    has_main, at = False, 0

    def flush():
        if words:
            line = " ".join(html.unescape("".join(words)).split())
            words.clear()
            if line:
                lines.append((line, bool(main_at)))

    n = len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        if not skip_at:
            words.append(page[at:m.start() if m else n])
        if not m:
            break
        at = m.end()
        if m[2] is None:
            continue
        tag, closing = m[2].lower(), bool(m[1])
        if not closing:
            if skip_at:
                if tag not in VOID:
                    stack.append(tag)
                    if tag in RAW:
                        at = _raw_end(page, tag, at)
                continue
            if tag in BLOCK or tag in DROP:
                flush()
            if tag in VOID:
                continue
            if _unwanted(tag, m[3], bool(main_at)):
                flush()
                stack.append(tag)
                skip_at = len(stack)
                if tag in RAW:
                    at = _raw_end(page, tag, at)
            elif tag in MAIN or "main" in m[3].lower() and ("role", "main") in ((n, v.lower()) for n, v in _attrs(m[3])):
                has_main = True
                stack.append(tag)
                main_at = main_at or len(stack)
            elif tag in BLOCK and tag not in ("p", "li", "td", "th", "tr", "dd", "dt", "br"):
                stack.append(tag)
        else:
            if not skip_at and (tag in BLOCK or tag in MAIN):
                flush()
            if tag in stack:
                while stack:
                    if not skip_at and len(stack) == main_at:
                        flush()
                    top = stack.pop()
                    if len(stack) < skip_at:
                        skip_at = 0
                    if len(stack) < main_at:
                        main_at = 0
                    if top == tag:
                        break
    if not skip_at:
        flush()
    return lines, has_main


def _raw_end(page: str, tag: str, at: int) -> int:
    """Where a raw element's content ends (its closing tag, or the page)."""
    m = re.compile(f"</{tag}[\\s>/]", re.I).search(page, at)
    return m.start() if m else len(page)


def _rows(mine: list[str], other: list[str]) -> Iterator[int]:
    """Bit-parallel rows of the table of longest common subsequences: bit ``j``
    of row ``i`` is 0 where the length for ``mine[:i + 1]`` grows at ``other[j]``."""
    places: dict[str, int] = {}
    for j, x in enumerate(other):
        places[x] = places.get(x, 0) | 1 << j
    every = (1 << len(other)) - 1
    row = every
    for x in mine:
        hit = row & places.get(x, 0)
        row = ((row + hit) | (row - hit)) & every
        yield row


def _lengths(mine: list[str], other: list[str]) -> np.ndarray:
    """Lengths for ``mine`` and each start of ``other``."""
    row = (1 << len(other)) - 1
    for row in _rows(mine, other):
        pass
    bits = np.unpackbits(np.frombuffer(row.to_bytes(len(other) // 8 + 1, "little"), np.uint8), bitorder="little")
    return np.concatenate([[0], np.cumsum(bits[:len(other)] == 0)])


def common_lines(mine: list[str], other: list[str]) -> list[tuple[int, int]]:
    """Pairs of places of a longest common subsequence.  Lines that the other
    side lacks are left out first; a table of more than ``TABLE_BITS`` is cut in
    two (Hirschberg), so memory is bounded."""
    both = set(mine) & set(other)
    left = [i for i, x in enumerate(mine) if x in both]
    right = [j for j, x in enumerate(other) if x in both]
    a, b = [mine[i] for i in left], [other[j] for j in right]
    out: list[tuple[int, int]] = []
    work = [(0, len(a), 0, len(b))]
    while work:
        i0, i1, j0, j1 = work.pop()
        if (i1 - i0) * (j1 - j0) > TABLE_BITS and i1 - i0 > 1:
            half = (i0 + i1) // 2
            total = _lengths(a[i0:half], b[j0:j1]) + _lengths(a[half:i1][::-1], b[j0:j1][::-1])[::-1]
            cut = j0 + int(total.argmax())
            work += [(i0, half, j0, cut), (half, i1, cut, j1)]
            continue
        table, i, j = list(_rows(a[i0:i1], b[j0:j1])), i1 - i0, j1 - j0
        while i and j:
            if table[i - 1] >> (j - 1) & 1:
                j -= 1
            else:
                i -= 1
                if not i or table[i - 1] >> (j - 1) & 1:
                    j -= 1
                    out.append((left[i0 + i], right[j0 + j]))
    return sorted(out)


def shared_lines(mine: list[str], other: list[str]) -> list[int] | None:
    """Places in ``mine`` of the lines on a longest common subsequence; None
    when the pages are copies of each other: the lines beside it are equal, or
    one page has none."""
    pairs = common_lines(mine, other)
    here, there = {i for i, _ in pairs}, {j for _, j in pairs}
    own = Counter(x for i, x in enumerate(mine) if i not in here)
    others = Counter(x for j, x in enumerate(other) if j not in there)
    return None if not own or not others or own == others else sorted(here)


def repeated_lines(mine: list[str], others: list[list[str]]) -> set[int]:
    """Places in ``mine`` of the lines to delete; ``others`` are the neighbours,
    the nearest first."""
    found = [set(x) for x in (shared_lines(mine, o) for o in others) if x is not None]
    if not found:
        return set()
    gone, *second = found
    if second and second[0] and sum(len(mine[i]) for i in gone) > COPY_SHARE * sum(map(len, mine)):
        gone = gone & second[0]
    return gone


def codes_of(lines: list[tuple[str, bool]]) -> list[int]:
    """64-bit hashes of the lines; the lowest bit is set inside the marked article."""
    return [int.from_bytes(hashlib.blake2b(line.encode("utf8", "replace"), digest_size=8).digest(), "little", signed=True) & ~1 | inside
            for line, inside in lines]


def lines_outside(mine: list[int], others: list[list[int]]) -> list[int]:
    """Places, among the lines of the marked article, of those that the page
    shares with the nearest page that tells something and that lie outside the
    marked article there; pages as codes, the nearest first."""
    place = np.cumsum([code & 1 for code in mine]) - 1
    lines = [code & ~1 for code in mine]
    for other in others:
        theirs = [code & ~1 for code in other]
        if shared_lines(lines, theirs) is not None:
            return [int(place[i]) for i, j in common_lines(lines, theirs) if mine[i] & 1 and not other[j] & 1]
    return []


_HOST = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)"


def _pages(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    small_batches(pages.sparkSession)
    url = F.coalesce(valid_text(url_col), F.lit(""))
    return pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.lower(F.regexp_extract(url, _HOST, 1)).alias("host"),
                        F.regexp_replace(F.regexp_replace(url, _HOST, ""), "[?#].*$", "").alias("path"),
                        valid_text(html_col).alias("html"))


_PARSED = "page_id long, url string, host string, path string, article array<string>, loose array<string>, codes array<long>"
_PARSED_ARROW = pa.schema([("page_id", pa.int64()), *[(c, pa.string()) for c in ("url", "host", "path")],
                           *[(c, pa.list_(pa.string())) for c in ("article", "loose")], ("codes", pa.list_(pa.int64()))])


def parse(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Pages read, for the differencing of every page: the lines of the marked
    article and the codes of all lines of the page in its order, or (null: none
    is marked) the loose lines."""
    def run(batches):
        for batch in batches:
            article, loose, codes = [], [], []
            for page in batch.column(4):
                lines, marked = lines_of(page.as_py() or "")
                inside = [x for x, main in lines if main]
                whole = bool(marked and inside)
                article.append(inside if whole else None)
                loose.append(None if whole else [x for x, _ in lines])
                codes.append(codes_of(lines) if whole else None)
            columns = [pa.array(c, f.type) for c, f in zip((article, loose, codes), list(_PARSED_ARROW)[4:])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], *columns], schema=_PARSED_ARROW)

    return _pages(pages, id_col, url_col, html_col).mapInArrow(run, _PARSED)


def _neighbours(light: DataFrame) -> DataFrame:
    """(host, digest, loose, other, second): each different page's loose lines,
    its nearest neighbour's and those of the neighbour on the other side.
    ``light`` is range-partitioned, ``range`` is the partition."""
    order = [F.col("path"), F.col("page_id"), F.col("digest")]
    inside = W.partitionBy("host", "range").orderBy(*order)
    lines = F.struct("path", "loose")
    near = light.withColumn("before", F.lag(lines).over(inside)).withColumn("after", F.lead(lines).over(inside))
    # over the range borders: the last page of the host before, the first one after
    border = (light.groupBy("host", "range").agg(F.min(F.struct(*order, "loose")).alias("first"),
                                                 F.max(F.struct(*order, "loose")).alias("last")))
    across = W.partitionBy("host").orderBy("range")
    border = (border.withColumn("left", F.lag(F.struct("last.path", "last.loose")).over(across))
                    .withColumn("right", F.lead(F.struct("first.path", "first.loose")).over(across))
                    .select("host", "range", "left", "right"))
    near = near.join(border, ["host", "range"], "left")
    before = F.coalesce("before", "left")
    after = F.coalesce("after", "right")
    # the neighbour with the longer common start of the path is nearer
    def common(side):
        return F.coalesce(F.expr(f"""aggregate(sequence(1, least(length(path), length({side}.path))), 0,
            (n, i) -> IF(n = i - 1 AND substr(path, i, 1) = substr({side}.path, i, 1), i, n))"""), F.lit(-1))

    near = near.withColumn("before", before).withColumn("after", after)
    nearer = common("before") >= common("after")
    return near.select("host", "digest", "loose", F.when(nearer, F.col("before.loose")).otherwise(F.col("after.loose")).alias("other"),
                       F.when(nearer, F.col("after.loose")).otherwise(F.col("before.loose")).alias("second"))


def _paired(lines: DataFrame, name: str) -> DataFrame:
    """:func:`_neighbours` of the different pages of each host."""
    different = written(lines.groupBy("host", "digest").agg(F.min(F.struct("path", "page_id", "loose")).alias("first"))
                             .select("host", "digest", "first.path", "first.page_id", "first.loose")
                             .repartitionByRange("host", "path", "page_id", "digest")
                             .withColumn("range", F.spark_partition_id()), name)
    return _neighbours(different)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) for every page.  Pages are read twice
    rather than written: of marked articles only the codes of their lines travel."""
    parsed = parse(pages, id_col, url_col, html_col).withColumn("host", F.coalesce("host", F.lit("")))
    by_lines, by_codes = (F.sha2(F.concat_ws(sep, lines), 256) for sep, lines in
                          (("\n", F.col("loose")), (",", F.col("codes").cast("array<string>"))))
    read = written(parsed.select("page_id", "url", "host", "path", "loose", "codes",
                                 F.when(F.col("codes").isNull(), by_lines).otherwise(by_codes).alias("digest")), "page-lines")
    loose = read.where("codes IS NULL").drop("codes")
    marked = read.where("codes IS NOT NULL").select("host", "path", "page_id", F.col("codes").alias("loose"), "digest")

    @F.pandas_udf("string")
    def differ(loose: pd.Series, other: pd.Series, second: pd.Series) -> pd.Series:
        out = []
        for mine, *others in zip(loose, other, second):
            mine = list(mine)
            gone = repeated_lines(mine, [list(x) for x in others if x is not None])
            out.append(" ".join(x for i, x in enumerate(mine) if i not in gone))
        return pd.Series(out, dtype=object)

    @F.pandas_udf("array<int>")
    def outside(mine: pd.Series, other: pd.Series, second: pd.Series) -> pd.Series:
        out = [lines_outside(m.tolist(), [x.tolist() for x in others if x is not None]) for m, *others in zip(mine, other, second)]
        return pd.Series(out, dtype=object)

    texts = _paired(loose.where(F.size("loose") > 0), "different-pages").select("host", "digest", differ("loose", "other", "second").alias("text"))
    rest = (loose.select("page_id", "url", "host", "digest").join(texts, ["host", "digest"], "left")
                 .select("page_id", "url", F.coalesce("text", F.lit("")).alias("text")))
    # written, so that Spark knows its size: the few articles that lose lines are looked up where they are
    gone = written(_paired(marked, "different-articles").select("host", "digest", outside("loose", "other", "second").alias("gone"))
                                                        .where(F.size("gone") > 0), "lines-outside")
    articles = (parsed.where("article IS NOT NULL").select("page_id", "url", "host", "article", by_codes.alias("digest"))
                      .join(gone, ["host", "digest"], "left"))
    left = F.when(F.col("gone").isNull(), F.col("article")).otherwise(
        F.filter("article", lambda _, i: ~F.array_contains("gone", i)))
    every = articles.select("page_id", "url", F.concat_ws(" ", left).alias("text")).unionByName(rest)
    return every.withColumn("n_chars", F.char_length("text").cast("long"))
