import random

from tests.llm.fixtures import key_sorted
from tripstar.llm import html_text
from tripstar.llm.html_text import blocks, codes_of, common_lines, lines_outside, repeated_lines, shared_lines

SCHEMA = "page_id long, url string, html string"


def text_of(spark, pages):
    df = spark.createDataFrame(pages, SCHEMA).selectExpr("*", "1 AS key", "2 AS range", "'h' AS host", "array('l') AS loose")
    return {(r.page_id, r.url): r.text for r in html_text.extract(df.repartition(3)).collect()}


def test_marked_article_and_what_is_dropped():
    page = ("<body><header>H</header><nav>menu</nav><main><header><h1>Title</h1></header><p>One&nbsp;two &amp;\n three"
            "<section class='comments'><p>nice!</p></section><p>four<aside>x</aside><form>f</form><br>five</main>"
            "<div>loose</div><script>var x='</main><p>no</p>'</script></body>")
    main, loose, marked = blocks(page)
    assert marked and main == ["Title", "One two & three", "four", "five"] and loose == ["loose"]


def kept(inner):
    return blocks(f"<article><p>a</p>{inner}<p>b</p></article>")[0] != ["a", "b"]


def test_names_of_what_belongs_to_an_article():
    for name in ("article-comments", "post-share", "article-footer", "content-sidebar", "main-menu", "postComments", "comment-body",
                 "sidebar-content", "article-share-buttons", "entry-related", "comments", "x post-ad y"):
        assert not kept(f"<div class='{name}'>x</div>"), name
    for name in ("with-sidebar", "has-footer", "no-comments", "content-sidebar-wrap", "post-header", "entry-content", "main body",
                 "legal-content", "article-body"):
        assert kept(f"<div class='{name}'>x</div>"), name
    assert kept("<div class='post with-sidebar'>x</div>") and not kept("<div class='post comments'>x</div>")


def test_ids_made_of_titles():
    for tag, name in (("h2", "legal-form"), ("section", "discussion"), ("section", "related-work"), ("h2", "social-change"), ("h3", "comments"),
                      ("div", "discussion"), ("div", "related-work")):
        assert kept(f"<{tag} id='{name}'>x</{tag}>"), name
    assert kept("<div class='section' id='comment-systems'>x</div>")
    assert not kept("<div id='comments'>x</div>") and not kept("<div id='sidebar'>x</div>") and not kept("<div id=related-posts-menu>x</div>")
    assert not kept("<section class='comments' id='c'>x</section>")


def test_comments_as_articles_inside_the_article():
    assert not kept("<article class='comment'><p>x</p></article>") and kept("<article><p>x</p></article>")
    assert blocks("<article class='sidebar'><p>x</p></article>")[0] == ["x"]


def test_marked_by_role():
    for role in ('role="main"', "role='main'", "role=main", "ROLE = Main"):
        assert blocks(f"<div {role}><p>a</p></div><p>b</p>") == (["a"], ["b"], True), role
    assert blocks("<div data-x='role=main'><p>a</p></div>")[2] is False


def test_broken_markup():
    assert blocks("plain <3 text a < b") == ([], ["plain <3 text a < b"], False)
    assert blocks("<p>kept</p><a href='x") == ([], ["kept"], False)
    assert blocks("<p>a<b>b</b>c<!-- gone -->d<p class=\"cookie-notice\">n</p><div class='with-sidebar'>e</div>")[1] == ["abcd", "e"]
    assert blocks("<article><p>cut off &am") == (["cut off &am"], [], True)
    assert blocks("") == ([], [], False)


def test_lines_shared_with_the_nearest_page_go(spark):
    frame = "<body><div>Home | About us</div><div><h1>{0}</h1><p>{0} story, {1}</p></div><div>Legal stuff</div></body>"
    pages = [(i, f"http://a.com/x/{i}", frame.format(f"Page{i}", "words " * (i + 3))) for i in range(12)]
    got = text_of(spark, pages)
    for i in range(12):
        assert got[(i, f"http://a.com/x/{i}")] == f"Page{i} Page{i} story, {('words ' * (i + 3)).strip()}"


def test_copies_do_not_delete_each_other(spark):
    page = "<body><div>All of this</div><div>is the same text</div></body>"
    got = text_of(spark, [(1, "http://a.com/1", page), (2, "http://a.com/2", page)])
    assert set(got.values()) == {"All of this is the same text"}


def test_nulls_ties_and_repeated_rows(spark):
    pages = [(1, None, None), (None, "bad url", "<p>x</p>"), (3, "", ""), (3, "", ""), (4, "http://one.org/", "<p>only</p>")]
    df = spark.createDataFrame(pages, SCHEMA)
    got = key_sorted((r.page_id, r.url, r.text, r.n_chars) for r in html_text.extract(df).collect())
    assert got == key_sorted([(1, None, "", 0), (None, "bad url", "x", 1), (3, "", "", 0), (3, "", "", 0), (4, "http://one.org/", "only", 4)])
    assert html_text.extract(df.limit(0)).count() == 0


def test_long_page():
    page = "<article>" + "<p>word</p>" * 50_000
    assert len(blocks(page)[0]) == 50_000


def test_alignment():
    assert shared_lines(["m", "a", "long own line", "f"], ["m", "x", "f"]) == [0, 3]
    assert shared_lines(["a", "b"], ["a", "b"]) is None


def table(a, b):
    """Length of a longest common subsequence, by the whole table."""
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_alignment_is_a_longest_common_subsequence(monkeypatch):
    pick = random.Random(2)
    cases = [(["n1", "p", "n2", "q", "n3", "S1", "S2"], ["S1", "S2", "n1", "r", "n2", "s", "n3"])]
    for _ in range(600):
        lines = "abcdefghijklmnop"[:pick.randint(1, 16)]
        cases.append((pick.choices(lines, k=pick.randint(0, 25)), pick.choices(lines, k=pick.randint(0, 25))))
    for bits in (html_text.TABLE_BITS, 40):  # the second cuts the tables in two
        monkeypatch.setattr(html_text, "TABLE_BITS", bits)
        for a, b in cases:
            pairs = common_lines(a, b)
            assert all(a[i] == b[j] for i, j in pairs) and len(pairs) == table(a, b)
            assert all(i < k and j < n for (i, j), (k, n) in zip(pairs, pairs[1:]))
    assert shared_lines(*cases[0]) == [0, 2, 4]
    assert len(common_lines(["x", "y"] * 10_000, ["y", "x"] * 10_000)) == 19_999


def test_copies_between_different_pages(spark):
    page = "<div>Home | About us</div><p>{}</p><div>Legal stuff</div>"
    pages = [(i, f"http://a.com/x/{i}", page.format("same story, " * 9 if 2 <= i < 7 else f"story {i}")) for i in range(9)]
    got = text_of(spark, pages)
    assert [got[(i, u)] for i, u, _ in pages] == [f"story {i}" if not 2 <= i < 7 else ("same story, " * 9).strip() for i in range(9)]


def test_short_articles_under_long_menus(spark):
    menu, foot = "<div>" + "Home | About us | " * 20 + "</div>", "<div>" + "Legal stuff " * 20 + "</div>"
    got = text_of(spark, [(i, f"http://a.com/{i}", f"{menu}<p>short story {i}</p>{foot}") for i in range(2)])
    assert sorted(got.values()) == ["short story 0", "short story 1"]


def test_a_copy_with_another_date_keeps_its_article():
    story = ["a long story that two pages tell " * 9]
    pages = [["menu", *story, f"day {i}", "foot"] for i in range(2)] + [["menu", "quite another story", "foot"]]
    assert repeated_lines(pages[1], [pages[0], pages[2]]) == {0, 3}
    assert shared_lines(["a", "b", "c"], ["c", "a", "b"]) is None  # moved


def test_range_borders_do_not_matter(spark):
    pages = [(10 * s + k, f"http://a.com/{s:02d}/{k}", f"<div>menu of part {s}</div><p>story {s} {k}</p>") for s in range(20) for k in range(2)]
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for n in (1, 7):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            assert text_of(spark, pages) == {(i, u): f"story {i // 10} {i % 10}" for i, u, _ in pages}, n
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def brute_texts(pages):
    """Differencing page by page, without Spark: every different page of a host
    against its neighbours in the order of paths, with the plain table."""
    def place(url):
        rest = url.split("://", 1)[1]
        host, _, path = rest.partition("/")
        return host.lower(), "/" + path.split("?")[0].split("#")[0]

    def pairs(a, b):
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a) - 1, -1, -1):
            for j in range(len(b) - 1, -1, -1):
                t[i][j] = t[i + 1][j + 1] + 1 if a[i] == b[j] else max(t[i + 1][j], t[i][j + 1])
        return t[0][0]

    def common_start(a, b):
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        return n

    texts, hosts = {}, {}
    for i, url, page in pages:
        main, loose, marked = blocks(page)
        if marked and main:
            texts[i] = " ".join(main)
        else:
            host, path = place(url)
            hosts.setdefault(host, {}).setdefault(tuple(loose), []).append((path, i))
    for found in hosts.values():
        for lines, at in found.items():
            if not lines:
                texts.update((i, "") for _, i in at)
        order = sorted((min(at), lines) for lines, at in found.items() if lines)
        for k, ((path, _), lines) in enumerate(order):
            sides = [order[j] for j in (k - 1, k + 1) if 0 <= j < len(order)]
            sides.sort(key=lambda s: -common_start(path, s[0][0]))  # stable: the one before first
            gone = repeated_lines(list(lines), [list(s[1]) for s in sides])
            for s in sides:  # the alignment is as long as the table says
                assert len(common_lines(list(lines), list(s[1]))) == pairs(lines, s[1])
            texts.update((i, " ".join(x for j, x in enumerate(lines) if j not in gone)) for _, i in found[lines])
    return texts


def test_whole_query_against_brute_force(spark):
    pick = random.Random(7)
    menus = [[f"menu {h} {k}" for k in range(4)] for h in range(3)]
    pages = []
    for i in range(120):
        h = pick.choice([0, 0, 0, 1, 2])
        body = [f"<p>line {pick.randint(0, 40)} of a story</p>" for _ in range(pick.randint(0, 5))]
        body = "".join(body) if i % 9 else f"<article>{''.join(body)}</article>"
        menu = "".join(f"<div>{x}</div>" for x in menus[h][:pick.randint(2, 4)])
        pages.append((i, f"http://Host{h}.org/{pick.choice('abc')}/{pick.randint(0, 30)}?q={i}", f"{menu}{body}<div>foot {h}</div>"))
    assert {i: t for (i, _), t in text_of(spark, pages).items()} == brute_texts(pages)


def test_pages_with_a_marked_article_are_differenced_too(spark):
    def page(i, inside="", outside=""):
        return f"<article><h1>News</h1>{inside}<p>story {i}</p></article>{outside}<div>foot</div>"

    ask = "<p>Tell us what you think</p>"
    pages = [(0, "http://a.com/0", page(0, outside=ask)), (1, "http://a.com/1", page(1, inside=ask)), (2, "http://a.com/2", page(2, outside=ask)),
             (3, "http://b.com/3", page(3, inside=ask)), (4, "http://b.com/4", page(4, inside=ask)), (5, "http://c.com/5", page(5, inside=ask)),
             (6, "http://a.com/1", page(1, inside=ask))]
    got = text_of(spark, pages)
    assert got == {(i, u): f"News {'Tell us what you think ' if i in (3, 4, 5) else ''}story {1 if i == 6 else i}" for i, u, _ in pages}


def test_article_lines_that_the_neighbour_has_outside():
    here = codes_of([("menu", False), ("title", True), ("ask", True), ("own", True), ("title", True)])
    there = codes_of([("menu", False), ("title", True), ("other", True), ("ask", False)])
    assert lines_outside(here, [there]) == [1] and lines_outside(there, [here]) == []
    assert lines_outside(here, [here, there]) == [1] and lines_outside(here, []) == []  # a copy tells nothing
