"""Operator 6: main text of web pages by site style trees.

Method.  The pages of a host are merged into one tree: an element's place
is its chain of tags and classes from the root, and elements of one place
are one node whatever page they are on.  A node keeps how often its pages
show each presentation (the sequence of its children) and each content
(its own text).  The importance of a node is the entropy of these over the
host's pages, relative to the largest it could have: a menu that is the
same on every page has nearly none, an article has all.  A branch none of
whose nodes reaches ``IMPORTANT`` is low, and is removed from each page.

The presentation weighs in as a prior.  Elements that HTML or their class
names mark as navigation, forms, scripts, comments and so on
(``BOILER_TAGS``, ``BOILER_WORDS``) have the weight 0, whatever their entropy,
since menus and adverts may change from page to page.  In a marked article
(``article``, ``main``) the tree decides too, with a lower bar
(``ARTICLE_IMPORTANT``): blocks that nearly all articles of the host repeat go.
There, pages whose texts are copies or near copies (one least three-word
shingle) count once, since an article on many pages is still an article.
If a page marks its article, main text is looked for there only, unless that
holds less than ``ARTICLE_SHARE`` of what the tree left on the page (a
teaser beside the story); what holds an article stays.
Places that fewer than ``OWN_PAGES`` pages of a host have are judged by the
tree merged over all hosts, those that fewer than ``ALL_PAGES`` pages have
at all are kept.

Scale.  The first pass sends one narrow row per page and place.  Entropies
come from pre-aggregated group-bys over (host, place, feature), so a host
with a third of all pages is many small groups.  The low places come back
as a broadcast if their counted rows are few (``LOW_PLACES``).  Otherwise a
join on (host, place), which adaptive execution splits, brings them to the
pages as one short list per distinct page, so no list grows with a host.
The second pass cuts the pages.

Results on edge cases.  Null and empty html give empty text; a page without
markup is one block.  A null url is a host of its own (the empty one).
Unclosed and stray tags are tolerated;
time and memory are linear in the markup, however deep it is.  Pages that repeat get the same
text.  Other columns take no part.
"""

from __future__ import annotations

import html as _html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .words import shingles_of, words_of

#: Share of the largest possible entropy from which a node is important.
IMPORTANT = 0.5
#: The same for nodes inside a marked article.
ARTICLE_IMPORTANT = 0.1
#: Share of the letters left on a page from which marked articles are all of its main text.
ARTICLE_SHARE = 0.1
#: Pages with a place from which a host's own tree decides about it.
OWN_PAGES = 4
#: Pages with a place from which the tree of all hosts decides about it.
ALL_PAGES = 20

#: Low places (40 bytes or so each) up to which they are broadcast; a join brings more to their pages.
LOW_PLACES = 200_000

#: Fixed values of HTML: elements by role.
RAW = frozenset("script style textarea title noscript template iframe noembed noframes xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section
    summary table tbody td tfoot th thead title tr ul""".split())
BOILER_TAGS = frozenset("""head script style noscript template iframe svg math canvas object embed nav header footer
    aside form button input select textarea label fieldset menu dialog title noembed noframes xmp""".split())
ARTICLES = frozenset(("article", "main"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Words in class, id and role that name what is not main text.
BOILER_WORDS = frozenset("""ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments
    consent cookie cookies copyright disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter
    notice notices pager pagination popup promo promoted promotion related replies reply respond search share sharing
    sidebar signup skip social sponsor sponsored subscribe toolbar topbar widget widgets contentinfo complementary
    alert toast paywall adsbygoogle adslot adbox adunit""".split())
#: Class names that tell what an element has beside it, not what it is.
_BESIDE = re.compile(r"\b(?:with|has|no|without|is)[-_]\w+")
#: Ends implied by a start tag: an open element of the key's value is closed first.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
           "th": {"td", "th"}, "option": {"option"}}
_SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"},
           "option": {"select"}}

_MARKUP = re.compile(r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*>?|</?([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>?", re.S)
_NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?=[\s=/]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_TOKEN = re.compile(r"[a-z]+")
_DIGITS = re.compile(r"[0-9]+")
_ROOT = 0


def _hash(*parts) -> int:
    """64-bit signed hash of strings and numbers, the same in every process."""
    import hashlib
    return int.from_bytes(hashlib.blake2b("\x00".join(map(str, parts)).encode("utf-8", "surrogatepass"),
                                          digest_size=8).digest(), "little", signed=True)


class _Places:
    """Per worker process: (place, tag, names) -> place of the child; emptied when large."""

    known: dict = {}

    @classmethod
    def child(cls, parent: int, tag: str, names: str) -> int:
        key = (parent, tag, names)
        if key not in cls.known:
            if len(cls.known) > 200_000:
                cls.known.clear()
            cls.known[key] = _hash(*key)
        return cls.known[key]


NEUTRAL, BOILER, ARTICLE = 0, -1, 1


class Page:
    """Elements of a page (tag, place, parent, role) and its runs of text (element, text, block)."""

    def __init__(self, html: str):
        self.tag, self.place, self.parent, self.role, self.runs = ["#root"], [_ROOT], [-1], [NEUTRAL], []
        self._read(html)

    def _open(self, tag: str, attributes: str) -> None:
        top = self.stack[-1]
        inside = self.role[top]
        names, boiler = "", tag in BOILER_TAGS
        if attributes:
            found = [(a.lower(), x or y or z) for a, x, y, z in _NAMED.findall(attributes)]
            words = {w for _, v in found for w in _TOKEN.findall(_BESIDE.sub("", v.lower()))}
            if inside == ARTICLE:
                words.discard("header")     # an article's own header holds its title
            boiler = boiler or not words.isdisjoint(BOILER_WORDS) or bool(_HIDDEN.search(attributes))
            names = _DIGITS.sub("0", " ".join(sorted(v for a, v in found if a == "class")))
        if tag in ("body", "html") or (tag == "header" and inside == ARTICLE):
            boiler = False
        role = BOILER if boiler or inside == BOILER else ARTICLE if inside == ARTICLE or tag in ARTICLES else NEUTRAL
        self.tag.append(tag)
        self.place.append(_Places.child(self.place[top], tag, f"{names} {role}"))
        self.parent.append(top)
        self.role.append(role)

    def _read(self, html: str) -> None:
        self.stack, self.block, at = [0], 0, 0
        self.held: dict[str, int] = {}      # open elements of each tag
        low = None
        while True:
            m = _MARKUP.search(html, at)
            text = html[at:m.start()] if m else html[at:]
            if text and not text.isspace():
                self.runs.append((self.stack[-1], text, self.block))
            elif text and self.runs:
                self.runs.append((self.stack[-1], " ", self.block))
            if not m:
                break
            at = m.end()
            tag = m.group(1)
            if tag is None:
                continue
            tag = tag.lower()
            if html[m.start() + 1] == "/":
                self._close(tag)
                continue
            if tag == "br":
                self.runs.append((self.stack[-1], " ", self.block))
                continue
            if tag in BLOCKS:
                self.block += 1
                # a paragraph ends where a block begins
                self._end({"p"}, BLOCKS)
            if tag in _CLOSES:
                self._end(_CLOSES[tag], _SCOPES[tag])
            self._open(tag, m.group(2))
            if tag in VOID or m.group(2).endswith("/"):
                continue
            if tag in RAW:
                low = html.lower() if low is None else low
                end = low.find("</" + tag, at)
                at = len(html) if end < 0 else end
            self.stack.append(len(self.tag) - 1)
            self.held[tag] = self.held.get(tag, 0) + 1

    def _end(self, tags, within) -> None:
        """Close the innermost open element of ``tags`` that lies in no element of ``within``."""
        if not any(self.held.get(t) for t in tags):
            return
        for k in range(len(self.stack) - 1, 0, -1):
            name = self.tag[self.stack[k]]
            if name in tags:
                for i in self.stack[k:]:
                    self.held[self.tag[i]] -= 1
                del self.stack[k:]
                return
            if name in within:
                return

    def _close(self, tag: str) -> None:
        if tag in BLOCKS:
            self.block += 1
        self._end((tag,), ())

    def features(self) -> list[tuple[int, int, int, int]]:
        """(place, role, presentation, content) of each place of the page; content is all text of its branches."""
        n = len(self.tag)
        shape: dict[int, list] = {}
        for i in range(1, n):
            p, line = self.place[i], shape.setdefault(self.place[self.parent[i]], [])
            if not line or line[-1] != p:
                line.append(p)
        own: dict[int, list] = {}
        for i, text, _ in self.runs:
            own.setdefault(i, []).append(text)
        # an element's content is that of its own text and of its children, from the leaves up
        below: list = [None] * n
        content: dict[int, int] = {}
        role: dict[int, int] = {}
        for i in range(n - 1, 0, -1):
            if i in own or below[i] is not None:
                value = hash((_hash(*own.get(i, ())), below[i] or 0))   # of integers: the same in every process
                up, p = self.parent[i], self.place[i]
                below[up] = hash((below[up] or 0, value))
                content[p] = hash((content.get(p, 0), value))
        for i in range(1, n):
            role[self.place[i]] = self.role[i]
        return [(p, r, _hash(*shape.get(p, ())), content.get(p, 0)) for p, r in role.items()]

    def main_text(self, low: frozenset) -> str:
        """Blocks of main text, without the branches whose place is in ``low``."""
        n = len(self.tag)
        whole = [t in ("html", "body") for t in self.tag]      # what holds the page or an article stays
        for i in range(n - 1, 0, -1):
            if whole[i] or (self.role[i] == ARTICLE and self.role[self.parent[i]] != ARTICLE):
                whole[self.parent[i]] = True
        out = [False] * n
        for i in range(1, n):
            # inside an article only blocks go: an inline element is part of a sentence
            out[i] = out[self.parent[i]] or (self.place[i] in low and not whole[i]
                                             and (self.role[i] != ARTICLE or self.tag[i] in BLOCKS))
        size = {BOILER: 0, NEUTRAL: 0, ARTICLE: 0}
        for i, text, _ in self.runs:
            if not out[i]:
                size[self.role[i]] += len(text) - text.count(" ")
        marked = size[ARTICLE] > 0 and size[ARTICLE] >= ARTICLE_SHARE * (size[ARTICLE] + size[NEUTRAL])
        blocks: dict[int, list[str]] = {}
        for i, text, block in self.runs:
            if not out[i] and (self.role[i] == ARTICLE or (self.role[i] == NEUTRAL and not marked)):
                blocks.setdefault(block, []).append(text)
        lines = (" ".join(_html.unescape("".join(parts)).split()) for parts in blocks.values())
        return "\n".join(x for x in lines if x)


def _host(url):
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)", 1))


def _sketches(texts: list[str]) -> np.ndarray:
    """The least three-word shingle of each text: copies share it, near copies nearly always."""
    shingles, per = shingles_of(words_of(texts), 3)
    at = np.concatenate([[0], np.cumsum(per)])
    return np.array([shingles[a:b].min() if b > a else 0 for a, b in zip(at[:-1], at[1:])], dtype=np.uint64).view(np.int64)


def style_rows(pages: DataFrame) -> DataFrame:
    """(page_key, host, copy, place, role, presentation, content): a row for each place of each page.

    Rows of one copy count once: a page for its own, inside an article the pages with its sketch.
    """

    def fn(texts, rows):
        read = [Page(t) for t in texts]
        found = [p.features() for p in read]
        sketch = _sketches([p.main_text(frozenset()) for p in read])
        at = np.repeat(np.arange(len(texts)), [len(f) for f in found])
        place, role, shape, content = zip(*[x for f in found for x in f]) if len(at) else ((),) * 4
        key = rows.column(0).to_numpy()[at]
        copy = np.where(np.array(role, dtype=np.int64) == ARTICLE, sketch[at], key)
        return {"page_key": key, "host": rows.column(1).take(pa.array(at, pa.int64())), "copy": copy, "place": list(place),
                "role": list(role), "presentation": list(shape), "content": list(content)}

    return common.map_texts(pages, "html", fn, "page_key long, host string, copy long, place long, role int, "
                            "presentation long, content long", ["page_key", "host"])


def _importance(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, role, pages, entropy): of each place the larger of its presentation's and content's relative entropy."""
    once = rows.groupBy(*keys, "role", "copy").agg(F.min("presentation").alias("presentation"), F.min("content").alias("content"))
    kinds = once.select(*keys, "role", F.explode(F.array(
        F.struct(F.lit(0).alias("kind"), F.col("presentation").alias("feature")),
        F.struct(F.lit(1).alias("kind"), F.col("content").alias("feature")))).alias("f"))
    per = kinds.groupBy(*keys, "role", "f.kind", "f.feature").agg(F.count("*").alias("n"))
    total = per.groupBy(*keys, "role", "kind").agg(F.sum("n").alias("pages"), F.sum(F.col("n") * F.log("n")).alias("nlogn"))
    # entropy = log(pages) - sum(n log n) / pages, and log(pages) is the largest
    entropy = F.when(F.col("pages") > 1, (F.log("pages") - F.col("nlogn") / F.col("pages")) / F.log("pages")).otherwise(1.0)
    return (total.withColumn("entropy", entropy).groupBy(*keys, "role")
            .agg(F.max("pages").alias("pages"), F.max("entropy").alias("entropy")))


def low_places(rows: DataFrame) -> DataFrame:
    """(host, place) of the nodes whose importance is too low for their role."""
    own, every = _importance(rows, ["host", "place"]), _importance(rows, ["place"])
    judged = own.join(every.select("place", F.col("pages").alias("all_pages"), F.col("entropy").alias("all_entropy")), "place")
    entropy = (F.when(F.col("pages") >= OWN_PAGES, F.col("entropy"))
               .when(F.col("all_pages") >= ALL_PAGES, F.col("all_entropy")).otherwise(1.0))
    bar = F.when(F.col("role") == ARTICLE, ARTICLE_IMPORTANT).otherwise(IMPORTANT)
    return judged.filter((F.col("role") == BOILER) | (entropy < bar)).select("host", "place")


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` (url, html, ...) with the column ``text``: the main text of each page (a column of that name is replaced)."""
    common.ship_package(pages.sparkSession)
    names = [c for c in pages.columns if c != "text"]
    key = F.xxhash64(_host(pages["url"]), F.coalesce(pages["html"], F.lit("")))
    rows = common.materialise(style_rows(pages.select(
        key.alias("page_key"), _host(pages["url"]).alias("host"), "html")).distinct(), "styles")
    low = common.materialise(low_places(rows), "low")
    if low.count() <= LOW_PLACES:
        by_host: dict[str, set] = {}
        for r in low.collect():
            by_host.setdefault(r.host, set()).add(r.place)
        common.release(rows)
        held = pages.sparkSession.sparkContext.broadcast({h: frozenset(p) for h, p in by_host.items()})

        @F.pandas_udf("string")
        def main_text(html, host):
            import pandas as pd
            return pd.Series([Page(h or "").main_text(held.value.get(x, frozenset())) for h, x in zip(html, host)])

        return pages.select(*[pages[f"`{c}`"] for c in names], main_text(pages["html"], _host(pages["url"])).alias("text"))
    cuts = (rows.select("page_key", "host", "place").join(low, ["host", "place"])
            .groupBy("page_key").agg(F.collect_set("place").alias("low")))
    cuts = common.materialise(cuts, "cuts")
    common.release(rows)

    @F.pandas_udf("string")
    def cut_text(html, places):
        import pandas as pd
        return pd.Series([Page(h or "").main_text(frozenset(x) if x is not None else frozenset())
                          for h, x in zip(html, places)])

    joined = pages.join(cuts, key == cuts["page_key"], "left")
    return joined.select(*[pages[f"`{c}`"] for c in names], cut_text(pages["html"], cuts["low"]).alias("text"))


def op6_site_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page: page_id, url, text, n_chars."""
    pages = common.table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
