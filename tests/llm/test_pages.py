import bisect
import math
import random
import time
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ordermart.llm import extraction as ex
from ordermart.llm import revisits as rv

from . import edges

PAGE = """<!DOCTYPE html><html><head><title>T {i}</title><style>p{{}}</style><script>var a="</p>";</script></head>
<body class="with-sidebar"><header><a href="/">Site</a></header><nav><ul><li>Home<li>About</ul></nav>
<div class="cookie-notice">We use cookies</div><div id="strip"><p>Same on every page</p></div>
<article><header><h1>Title {i} &amp; more</h1></header><p>First   para <b>bold</b>text {i}<br>next
<p>Second &lt;b&gt; &eacute; para {x}</p><div class="ad-slot">Buy</div><form><input>Search</form><ul><li>One<li>Two {x}</ul></article>
<aside>Related</aside><section id="comments"><article class="comment"><p>Nice post {x}</p></article></section>
<footer>&copy; {i}</footer></body></html>"""
TEXT = "Title {i} & more\nFirst para boldtext {i} next\nSecond <b> é para {x}\nOne\nTwo {x}"


def test_article_text_of_marked_pages(spark):
    rows = [(i, f"http://a.example/{i}", PAGE.format(i=i, x=edges.words(i, 5))) for i in range(6)]
    got = {r.page_id: r.text for r in ex.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: TEXT.format(i=i, x=edges.words(i, 5)) for i in range(6)}


@pytest.mark.parametrize("most", [200_000, 0])      # low places broadcast, or joined
def test_entropy_decides_without_marks(spark, monkeypatch, most):
    monkeypatch.setattr(ex, "LOW_PLACES", most)
    html = ("<body><div class=top><p>Menu A</p><p>Menu B</p></div><div class=body><p>{x}</p><p>{y}</p></div>"
            "<div class=base>Made by us</div></body>")
    rows = [(i, f"http://a.example/{i}", html.format(x=edges.words(i, 9), y=edges.words(100 + i, 9))) for i in range(8)]
    rows.append((50, "http://b.example/", html.format(x="only", y="page")))     # judged by too few pages: kept
    got = {r.page_id: r.text for r in ex.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(8):
        assert got[i] == edges.words(i, 9) + "\n" + edges.words(100 + i, 9)
    assert got[50] == "Menu A\nMenu B\nonly\npage\nMade by us"


def test_repeated_article_stays(spark):
    rows = [(i, f"http://a.example/{i}", PAGE.format(i=1, x="same")) for i in range(30)]
    got = [r.text for r in ex.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()]
    assert got == [TEXT.format(i=1, x="same")] * 30


def _texts(spark, htmls):
    rows = [(i, f"http://a.example/{i}", h) for i, h in enumerate(htmls)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return [r.text for r in ex.extract(df).orderBy("page_id").collect()]


def test_a_strip_that_all_articles_repeat_goes(spark):
    # "tools" is no listed word: only the tree can tell
    story = [edges.words(i, 60) for i in range(12)]
    html = "<body><main><div class=tools><b>Print this</b> or save it</div><p>{x}</p></main></body>"
    assert _texts(spark, [html.format(x=x) for x in story]) == story
    # near copies of one article count once: its title and its strip stay
    copies = [story[0] + " " + edges.words(90 + i, 2) for i in range(12)]
    got = _texts(spark, [html.format(x=x) for x in copies])
    assert got == ["Print this or save it\n" + x for x in copies]


def test_a_teaser_article_beside_a_story(spark):
    html = "<body><div class=story><p>{x}</p></div><article><p>Read {i} too</p></article></body>"
    story = [edges.words(i, 200) for i in range(12)]
    got = _texts(spark, [html.format(x=x, i=i) for i, x in enumerate(story)])
    assert all(x in t for x, t in zip(story, got))


@pytest.mark.parametrize("html", ["<div>x" * 100_000, "<b>" * 100_000 + "</i>" * 100_000, "<b>" * 100_000 + "<li>x</li>" * 20_000,
                                  "<p><b>" * 50_000 + "<div>y</div>" * 20_000])
def test_deep_markup_takes_linear_time(html):
    began = time.perf_counter()
    page = ex.Page(html)
    assert page.features() and page.main_text(frozenset()) is not None and time.perf_counter() - began < 8


def _importance(features):
    n = len(features)
    return 1.0 if n < 2 else -sum(c / n * math.log(c / n) for c in Counter(features).values()) / math.log(n)


def _brute(pages):
    """Texts of (host, html) by the definition: every place of every host judged over its pages in plain Python."""
    pages = [(h, ex.Page(x), x) for h, x in pages]
    judged = {}
    for every in (False, True):
        seen = {}
        for host, page, html in pages:
            sketch = int(ex._sketches([page.main_text(frozenset())])[0])
            for place, role, shape, content in page.features():
                copy = sketch if role == ex.ARTICLE else (host, html)
                seen.setdefault((None if every else host, place, role), {}).setdefault(copy, []).append((shape, content))
        for key, copies in seen.items():
            sides = [[min(v[j] for v in vs) for vs in copies.values()] for j in (0, 1)]
            judged[key] = len(copies), max(map(_importance, sides))

    def low(host, place, role):
        own, all_ = judged[host, place, role], judged[None, place, role]
        value = own[1] if own[0] >= ex.OWN_PAGES else all_[1] if all_[0] >= ex.ALL_PAGES else 1.0
        return role == ex.BOILER or value < (ex.ARTICLE_IMPORTANT if role == ex.ARTICLE else ex.IMPORTANT)

    return [p.main_text(frozenset(f[0] for f in p.features() if low(h, f[0], f[1]))) for h, p, _ in pages]


def test_extraction_equals_the_definition(spark):
    r = random.Random(4)
    rows = []
    for i in range(60):
        strip = r.choice(["Same strip", "Same strip", edges.words(i, 2)])
        inner = f"<div class=x{i % 2}>{strip}</div><p>{edges.words(r.randrange(40), 20)}</p>"
        body = [f"<main>{inner}</main>", f"<div class=s>{inner}</div>", f"<nav>{i}</nav><article>{inner}<h2>More</h2></article>"][i % 3]
        rows.append((i, f"http://h{r.choice([0, 0, 0, 1, 2, i])}.example/", f"<body>{body}<div>Base</div></body>"))
    got = [x.text for x in ex.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).orderBy("page_id").collect()]
    want = _brute([(u, h) for _, u, h in rows])
    plain = [ex.Page(h).main_text(frozenset()) for _, _, h in rows]
    assert got == want and sum(a != b for a, b in zip(got, plain)) > 20


def test_given_pages_keep_the_article_only(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for r in ex.extract(pages).collect():
        inner = r.html.split("<article>")[1].split("</article>")[0]
        title = ex._html.unescape(inner.split("<h1>")[1].split("</h1>")[0])
        assert r.text.startswith(" ".join(title.split())) and "<p>" not in r.text
        assert "track(" not in r.text and "&copy;" not in r.text


def test_extraction_edges(spark):
    rows = [(1, None, None), (2, "x", ""), (3, None, "plain  text\n here"), (None, "http://a.example", "<p>a<p>b"), (4, "u", "a < b <"),
            (5, "u", "<div" + " x" * 5000 + "><p>deep"), (6, "u", "<!-- open"), (7, "u", "</p></div>stray<br/>x<td>y"), (1, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1)).withColumn(
        "page_key", F.lit(1)).withColumn("low", F.lit(1)).withColumn("a.b", F.lit(1))
    out = ex.extract(df)
    assert out.columns == ["page_id", "url", "html", "page_key", "low", "a.b", "text"]
    got = defaultdict(list)
    for r in out.collect():
        got[r.page_id].append(r.text)
    assert got == {1: ["", ""], 2: [""], 3: ["plain text here"], None: ["a\nb"], 4: ["a < b <"], 5: ["deep"], 6: [""], 7: ["stray x\ny"]}
    assert ex.extract(df.filter("false")).count() == 0


def test_canonical_urls(spark):
    cases = {"HTTPS://WWW.Ex.org:443/a/#top": "ex.org/a", "http://ex.org/a?ref=x&p=2&utm_source=q": "ex.org/a?p=2",
             "ex.org": "ex.org", "http://Ex.org/?q=A": "ex.org?q=A", "http://ex.org/A.html//": "ex.org/A.html", "": ""}
    df = spark.createDataFrame([(k,) for k in cases] + [(None,)], "u string")
    got = {r.u: r.c for r in df.select("u", rv.canonical_url(F.col("u")).alias("c")).collect()}
    assert got == {**cases, None: None}


def _headers(**h):
    return [(k.replace("_", "-"), v) for k, v in h.items()]


def test_as_of_join_on_a_hot_url(spark):
    r, rows = random.Random(4), []
    for i in range(1500):
        url = "http://hot.example/x" if r.random() < 0.7 else f"http://hot.example/{r.randrange(9)}"
        full = r.random() < 0.2
        tag = r.choice(['"a"', 'W/"a"', '"b"', None])
        rows.append((i, r.choice([url, None]) if r.random() < 0.05 else url, None if r.random() < 0.02 else r.randrange(3000),
                     "response" if full else "revisit", tag, r.choice(["d1", "d2", None]), _headers(etag=str(i)),
                     f"p{i}" if full else None, i if full else None))
    rows += rows[:5]
    got = sorted((x.record_id, x.outcome, -1 if x.refers_to is None else x.refers_to)
                 for x in rv.resolve(spark.createDataFrame(rows, rv.RECORD)).collect())
    want = []
    bare = lambda t: t[2:] if t.startswith("W/") else t
    for i, url, ts, kind, tag, date, *_ in rows:
        if kind == "revisit":
            stored = [x for x in rows if x[3] == "response" and url and x[1] == url and ts is not None and x[2] is not None and x[2] < ts]
            best = max(stored, key=lambda x: (x[2], x[0]), default=None)
            if best is None:
                want.append((i, "unresolved", -1))
            else:
                agree = bare(tag) == bare(best[4]) if tag and best[4] else date is not None and date == best[5]
                want.append((i, "resolved", best[0]) if agree else (i, "mismatch", -1))
    assert got == sorted(want)


def test_an_outlying_time_widens_no_bucket(spark):
    times = [*range(10_000), 10 ** 15, -10 ** 15, None]
    df = spark.createDataFrame([(t,) for t in times], "ts long").withColumn("moment", F.col("ts").cast("double"))
    bounds = rv.time_bounds(df)
    held = Counter(bisect.bisect_right(bounds, t) for t in times if t is not None)
    assert len(held) == rv.LEAST_BUCKETS and max(held.values()) < 1.5 * len(times) / rv.LEAST_BUCKETS
    assert rv.time_bounds(df.filter("false")) == [0.0]
    # one record far off among those of a hot URL
    rows = [(i, "u/x", i if i < 200 else 10 ** 15, "response" if i % 7 == 0 else "revisit", '"t"', None, [], None, None) for i in range(201)]
    got = {r.record_id: r.refers_to for r in rv.resolve(spark.createDataFrame(rows, rv.RECORD)).collect()}
    assert got == {i: i // 7 * 7 for i in range(201) if i % 7}


def test_headers_merge_and_edges(spark):
    rows = [(1, "u/a", 1, "response", '"t"', None, _headers(etag='"t"', content_length="5", cache_control="old"), "p", 5),
            (2, "http://u/a/", 2, "revisit", 'W/"t"', None, _headers(Cache_Control="new", content_length="0"), None, None),
            (3, None, 3, "revisit", None, None, None, None, None), (4, "u/a", 1, "revisit", '"t"', None, [], None, None)]
    df = spark.createDataFrame(rows, rv.RECORD).withColumn("bucket", F.lit(1)).withColumn("stored", F.lit(1))
    got = {r.record_id: r for r in rv.resolve(df).collect()}
    assert got[2].refers_to == 1 and got[2].payload_chars == 5
    assert {h.name: h.value for h in got[2].headers} == {"etag": '"t"', "content-length": "5", "Cache-Control": "new"}
    assert got[3].outcome == got[4].outcome == "unresolved"
    assert rv.resolve(df.filter("false")).count() == 0
    joined = rv.with_payload(rv.resolve(df), spark.createDataFrame([(1, "body")], "record_id long, payload string"))
    assert {r.record_id: r.payload for r in joined.collect()} == {2: "body", 3: None, 4: None}
