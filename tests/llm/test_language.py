import math
from collections import Counter, defaultdict

from tripstar.llm import language

SCHEMA = "page_id long, url string, html string"
WORDS = {"de": "der die das und nicht ein ist auch mit sich schön größer", "en": "the and that with from this have which their would",
         "es": "que los las por una con para señor niño está", "fr": "les des une dans est pour qui pas être déjà"}


def pages():
    out = []
    for k, (lang, words) in enumerate(WORDS.items()):
        for i in range(30):
            w = words.split()
            text = " ".join(w[(i * j + j) % len(w)] for j in range(20))
            out.append((k * 100 + i, f"http://{lang}.example.{'org' if lang == 'de' else 'com'}/{i}",
                        f'<html lang="{lang}"><body><article><p>{text}</p></article>'))
    return out


def run(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS text", "2 AS host", "3 AS declared").repartition(3)
    return {(r.page_id, r.url): r for r in language.identify(df).collect()}


def test_text_markup_and_host_decide(spark):
    odd = [(900, "http://de.example.org/x", '<html lang="en"><p>der die das und nicht auch sich</p>'),  # wrong markup
           (901, "http://fr.example.com/y", "<p></p>"),                                                # host only
           (902, "http://other.net/", '<html lang="es"></html>'),                                      # markup only
           (903, None, None), (None, "bad", "<p>x</p>")]
    got = run(spark, pages() + odd)
    assert all(got[(i, u)].lang == u[7:9] for i, u, _ in pages())
    lang = {i: got[(i, u)].lang for i, u, _ in odd}
    assert (lang[900], lang[901], lang[902]) == ("de", "fr", "es")
    assert got[(900, odd[0][1])].declared == "en" and got[(901, odd[1][1])].text_lang is None
    assert all(abs(sum(r.posterior) - 1) < 1e-4 for r in got.values())


def test_repeated_rows_and_order_do_not_matter(spark):
    rows = pages()[::3]
    a = run(spark, rows)
    b = run(spark, rows[::-1])
    assert {k: (r.lang, r.confidence) for k, r in a.items()} == {k: (r.lang, r.confidence) for k, r in b.items()}
    df = spark.createDataFrame(rows[:4] * 2, SCHEMA)
    assert language.identify(df).count() == 8


def test_declared():
    assert language.declared('<!DOCTYPE html><html class="x" lang=de-AT>') == "de"
    assert language.declared('<meta http-equiv="content-language" content="fr">') == "fr"
    assert language.declared("<html lang='pt'>") == "other" and language.declared("") == "none"


def test_empty_table_and_long_page(spark):
    assert language.identify(spark.createDataFrame([], SCHEMA)).count() == 0
    assert len(language.trigrams("ab " * 300_000)) > 800_000


def test_declared_wherever_it_stands():
    for long in ("<!-- <html lang='de'> " + "licence " * 5_000 + "-->", "<script>var x = \"<html lang='de'>\";" + "x();" * 9_000 + "</script>",
                 "<style>" + "p { }" * 9_000 + "</style>"):
        assert language.declared(long + '<html data-x="a>b" class="c" lang="fr">') == "fr"
        assert language.declared(f'<html><head>{long}<meta http-equiv="Content-Language" content="es, en">') == "es"
    assert language.declared("<meta name='description' content='de'><html data-x=' lang=en '>") == "none"
    assert language.declared("<html lang='und'>") == "other" and language.declared_code("<html lang='it-IT'>") == "it"


def test_languages_are_counted_and_others_told(spark):
    it = "che non una della con sono gli nel anche più perché essere questo".split()
    pl = "nie jest się na przez który jego był dla oraz została".split()
    more = [(1000 + i, f"http://it.example.it/{i}", f'<html lang="it"><p>{" ".join(it[(i * j + j) % len(it)] for j in range(20))}</p>')
            for i in range(30)]
    more += [(2000, "http://x.org/1", f'<html lang="pl"><p>{" ".join(pl * 2)}</p>'),
             (2001, "http://y.org/1", "<p>Это совсем другой текст о погоде и о людях в большом городе</p>"),
             (2002, "http://z.net/1", f"<p>{' '.join(it)}</p>")]
    known = [(i, u, h.replace("<p>", "<p>" + " ".join(WORDS[u[7:9]].split() * 40) + " ")) for i, u, h in pages()]
    got = {r.page_id: r for r in run(spark, known + more).values()}
    assert all(got[i].lang == u[7:9] for i, u, _ in known) and all(got[1000 + i].lang == "it" for i in range(30))
    assert got[1000].declared == "it" and got[2000].declared == "other"
    assert [got[i].lang for i in (2000, 2001, 2002)] == ["other", "other", "it"]
    field = language.identify(spark.createDataFrame(known + more, SCHEMA)).schema["posterior"]
    assert field.metadata["languages"] == ["de", "en", "es", "fr", "it", "other"] and len(got[2002].posterior) == 6


SCRIPTS = {"ru": "это все как его только мне было вот меня еще нет ему теперь когда", "uk": "це все як його тільки мені було від мене ще ні йому тепер коли що",
           "el": "και το να του η της με που την από για δεν είναι στο", "ar": "في من على أن إلى هذا التي الذي كان عن هذه مع بعد",
           "zh": "我们 他们 这个 没有 什么 现在 知道 可以 自己 时候 因为 所以", "hi": "के है में की से का को हैं पर यह और ने नहीं"}


def test_scripts_differ(spark):
    rows, k = [], 0
    for lang, words in SCRIPTS.items():
        w = words.split()
        for i in range(25):
            text = " ".join(w[(i * j + 3 * j) % len(w)] for j in range(12))
            rows.append((k, f"http://a.com/{k}", f'<html lang="{lang}"><p>{text}</p>'))
            k += 1
    odd = {lang: 1000 + i for i, lang in enumerate(SCRIPTS)}
    rows += [(i, f"http://host{i}.net/", f"<p>{' '.join(SCRIPTS[lang].split()[::-1])}</p>") for lang, i in odd.items()]
    got = {r.page_id: r for r in run(spark, pages() + rows).values()}
    assert {lang: got[i].lang for lang, i in odd.items()} == {lang: lang for lang in SCRIPTS}


def brute(rows):
    """The posterior of every page from the formulas of the docstring, with plain dictionaries."""
    cells = language.N_SYMBOLS ** 3
    seen = []
    for i, url, page in rows:
        host = url.split("//")[1].split("/")[0].lower()
        codes = language.trigrams(language._text(page or "")).tolist()
        seen.append((i, host, host.rsplit(".", 1)[-1], language.declared_code(page or ""), codes))
    pages_of = Counter(s[3] for s in seen if s[3])
    names = [*language.LANGUAGES, *sorted(x for x, n in pages_of.items() if n >= language.MIN_PAGES and x not in (*language.LANGUAGES, "other")), "other"]
    counts = {x: Counter() for x in names}
    for *_, code, codes in seen:
        if code:
            counts[code if code in names else "other"].update(codes)

    def log_p(x, t):
        n, total, kinds = counts[x][t], sum(counts[x].values()), len(counts[x])
        if x == "other":
            return math.log((n / total + 1 / cells) / 2 if total else 1 / cells)
        return math.log((n + kinds / cells) / (total + kinds) if total else language.UNTRAINED / cells)

    def soft(scores):
        w = [math.exp(s - max(scores)) for s in scores]
        return [x / sum(w) for x in w]

    text = []
    for *_, codes in seen:
        kept = Counter(c for c in codes if c > 0)
        text.append([language.TEMPER * sum(n * log_p(x, t) for t, n in kept.items()) for x in names])
    shares = [soft(t) for t in text]
    said = [language.NONE if s[3] is None else s[3] if s[3] in names else "other" for s in seen]
    sums = defaultdict(lambda: [0.0] * len(names))
    for s, d, r in zip(seen, said, shares):
        for key in ("all", ("suffix", s[2]), ("host", s[1]), ("said", d)):
            sums[key] = [a + b for a, b in zip(sums[key], r)]
    out = {}
    for s, d, r, t in zip(seen, said, shares, text):
        every, suffix, host, says = ([max(a - b, 0) for a, b in zip(sums[key], r)] for key in ("all", ("suffix", s[2]), ("host", s[1]), ("said", d)))
        score = []
        for k, x in enumerate(names):
            p = (every[k] + 1) / (sum(every) + len(names))
            p = (suffix[k] + language.SUFFIX_WEIGHT * p) / (sum(suffix) + language.SUFFIX_WEIGHT)
            p = (host[k] + language.HOST_WEIGHT * p) / (sum(host) + language.HOST_WEIGHT)
            own = language.SAYS_OWN if x == d else language.SAYS_OTHER
            markup = (says[k] + own) / (every[k] + language.SAYS_OWN + language.SAYS_OTHER * len(names))
            score.append(t[k] + math.log(markup) + math.log(p))
        out[s[0]] = soft(score)
    return names, out


def test_posterior_against_brute_force(spark):
    short = [(5000 + i, u, h[:h.index("<p>") + 16 + i % 9]) for i, u, h in pages()[::4]]
    odd = [(900, "http://de.example.org/x", '<html lang="en"><p>der die</p>'), (901, "http://fr.example.com/y", "<p></p>"),
           (902, "http://other.net/", '<html lang="es"></html>'), (903, "http://b.org/", "<p>так</p>"), (904, "http://b.org/2", '<html lang="pl"><p>nie jest</p>')]
    rows = pages()[:70] + short + odd
    names, want = brute(rows)
    got = run(spark, rows)
    assert len(got) == len(rows)
    for (i, _), r in got.items():
        assert max(abs(a - b) for a, b in zip(r.posterior, want[i])) < 1e-3, (i, list(r.posterior), want[i])
        assert r.lang == names[max(range(len(names)), key=lambda k: r.posterior[k])]
