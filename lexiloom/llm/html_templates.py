"""Main text of web pages by site template removal.

1. Each page is parsed once, in Arrow batches, into blocks of text and the element subtrees that hold no whole
   article.  A subtree is hashed with its tag, attributes that do not vary by page (class, id, role) and text, from
   the leaves up: an element passes one digest to its parent, so work and memory are linear in the page.
2. Spark counts on how many articles of a host each subtree hash occurs, inside articles and outside.  Pages
   with the same article count once.
3. Subtrees with ``MIN_PAGES`` articles of their host and at least one in ``MIN_SHARE`` of them are the site's
   template; the blocks inside them go.
4. A site of few pages repeats nothing, and some parts change from page to page.  Of what is left, blocks in
   elements that are never content go by name, role or class (whole, or a word of PARTS in it): menus, headers and
   footers of the page, sidebars,
   notices, adverts, forms, reader comments.  Where a page has an article, what else is outside it goes too.
   Classes and ids are compared as a whole, and none rules out an element that holds an article (a reader's
   comment is none).

Copies of an article are still articles: what is inside counts once for all of them, by a hash of the article's
text, what is outside once for all pages of equal content, and an element that holds an article is no template.

Subtrees are counted by host, hash and article, then by host and hash, so no key holds more than its share.  What
a host's template holds is bounded by ``MIN_SHARE`` times the subtrees of a page; pages meet it by host.

Defined results: null or empty html gives an empty text; open elements end where their parents do; markup
inside scripts, styles and comments is not read; unknown character references stay as they are; rows that
repeat a page id are pages of their own; a null url is a host of its own; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from hashlib import blake2b
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.scratch import stored

MIN_PAGES = 5
MIN_SHARE = 20

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg object canvas xmp".split())
# Elements that break a line of text; the others run on.
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol option p pre search section "
    "select summary table tbody td tfoot th thead tr ul".split()
)
NEVER = frozenset(
    "nav footer aside form script style noscript template iframe svg object canvas textarea title head button "
    "select input menu dialog search xmp".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog form menu menubar".split())
# Classes and ids that name what is never content: whole ones, since "has-sidebar" names no sidebar.
CHROME = frozenset(
    "ad ads advert adverts advertisement advertising adsense adsbygoogle banner sponsor sponsors sponsored promo promos "
    "promotion nav navbar navigation menu breadcrumb breadcrumbs sidebar widget widgets footer masthead topbar cookie "
    "cookies consent gdpr notice popup modal newsletter subscribe signup login share sharing social related recommended "
    "comment comments disqus respond replies pagination pager toolbar "
    "ad-slot ad-container ad-banner ad-unit banner-ad main-nav site-nav nav-menu nav-links main-menu post-navigation "
    "site-header page-header siteheader pageheader site-footer page-footer main-sidebar left-sidebar right-sidebar "
    "widget-area cookie-notice cookie-banner cookie-consent cookie-bar gdpr-notice newsletter-signup share-buttons "
    "share-bar social-links social-share social-icons related-posts related-articles recommended-posts comment-list "
    "commentlist comments-area comment-section comment-form disqus_thread skip-link skiplink".split()
)
# Words that rule out in any name that is made of words, unless one of the others says it is only about them.
PARTS = frozenset("ad ads advert adverts advertisement cookie cookies comments share".split())
ABOUT = frozenset("no not has with without open closed content article post".split())
COMMENT = frozenset(["comment", "comment-body"])  # an article of these classes is a reader's
CLOSES = {  # an opening tag ends an open element of these names
    "p": frozenset(["p"]),
    "li": frozenset(["li"]),
    "option": frozenset(["option"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
}
ENDS_PARAGRAPH = BLOCK - {"br", "body", "html", "head", "option", "td", "th", "tr", "tbody", "thead", "tfoot"}
LIMITS = frozenset("article section div main body html ul ol table td th blockquote nav aside footer header form".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)"
    # Quotes count after an equals sign only; one that never ends is part of an unquoted value.
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?)*+)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
MARKS = frozenset(["class", "id", "role", "hidden", "aria-hidden"])
_SPACE = re.compile(r"[ \t\n\r\f\v\x85\xa0\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


def _bytes(data: bytes) -> bytes:
    return blake2b(data, digest_size=8).digest()


def _digest(data: bytes) -> int:
    return int.from_bytes(_bytes(data), "little", signed=True)


def _chrome(tokens: frozenset[str]) -> bool:
    """Whether one of these classes and ids names what is never content."""
    if not tokens.isdisjoint(CHROME):
        return True
    words = (frozenset(re.split("[-_]+", token)) for token in tokens)
    return any(not w.isdisjoint(PARTS) and w.isdisjoint(ABOUT) for w in words)


class Page:
    """Blocks of text in order, and the subtrees a template may hold.

    These are (hash, first block, last block + 1, hash of the text of the article around it or of the page's content).
    """

    def __init__(self, html: str):
        self.blocks: list[tuple[str, bool, bool]] = []  # text, whether it may be content, whether in an article
        self.subtrees: list[tuple[int, int, int, int]] = []
        self.text: list[str] = []
        # Open elements: name, whether content may be inside, number of the article around or 0, first block, tag,
        # digests of text inside, and the number of the innermost element around whose class or id rules it out, or 0.
        self.open: list[tuple[str, bool, int, int, bytes, list[bytes], int]] = [("", True, 0, 0, b"", [], 0)]
        self.depths: dict[str, list[int]] = defaultdict(list)  # of open elements of each name
        self.limits = [0]  # depths of open elements of LIMITS
        self.around = [0]  # of each element ruled out by a class or id: the next one around it
        self.articles = 0
        self.article_of: list[int] = []  # of each block
        self.spared = {0}  # elements ruled out by a class or id that hold an article, as all around them do
        self.by_class: list[int] = []  # of each block
        self.whole = 0  # so many of the open elements, from the outermost on, hold an article or are one
        place = 0
        while True:
            token = _TOKEN.search(html, place)
            if token is None:
                self._data(html[place:])
                break
            if token.start() > place:
                self._data(html[place : token.start()])
            place = token.end()
            name = token[2]
            if name is None:
                continue
            name = name.lower()
            if token[1]:
                self._end(name)
            else:
                self._start(name, token[3])
                if name in RAW:
                    close = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.IGNORECASE).search(html, place)
                    place = close.start() if close else len(html)
        self._pop_to(1)
        self._flush()
        self.blocks = [
            (text, content and named in self.spared, inside)
            for (text, content, inside), named in zip(self.blocks, self.by_class, strict=True)
        ]
        has_article = any(content and inside for _, content, inside in self.blocks)
        self.kept = [content and (inside or not has_article) for _, content, inside in self.blocks]
        texts: dict[int, list[str]] = {0: []}
        for (text, _, _), article, kept in zip(self.blocks, self.article_of, self.kept, strict=True):
            if kept:
                texts[0].append(text)
                if article:
                    texts.setdefault(article, []).append(text)
        of = {n: _digest("\0".join(t).encode("utf-8", "surrogatepass")) for n, t in texts.items()}
        self.subtrees = [(h, first, end, of.get(article, of[0])) for h, first, end, article in self.subtrees]

    def _data(self, data: str) -> None:
        self.text.append(unescape(data) if "&" in data else data)

    def _flush(self) -> None:
        if self.text:
            joined = _SPACE.sub(" ", "".join(self.text)).strip(" ")
            self.text = []
            if joined:
                top = self.open[-1]
                self.blocks.append((joined, top[1], top[2] > 0))
                self.article_of.append(top[2])
                self.by_class.append(top[6])
                top[5].append(_bytes(joined.encode("utf-8", "surrogatepass")))

    def _start(self, name: str, attributes: str) -> None:
        closes = CLOSES.get(name)
        if name in ENDS_PARAGRAPH:
            closes = (closes or frozenset()) | {"p"}
        if closes:
            depth = max(self._depth(other) for other in closes)
            if depth and depth >= self.limits[-1]:
                self._pop_to(depth)
        if name in BLOCK:
            self._flush()
        if name in VOID:
            return
        _, content, article, _, _, _, named = self.open[-1]
        marks = ""
        if attributes and len(attributes) > 1:
            found = [m for m in _ATTRIBUTE.finditer(attributes) if m[1].lower() in MARKS]
            marks = "|".join(f"{m[1].lower()}={m[2] or m[3] or m[4] or ''}" for m in found)
        is_article = name in ("article", "main") or "role=main" in marks
        if is_article and not article:
            self.articles += 1
            article = self.articles
        if name in NEVER or (name == "header" and not article) or (marks and self._hidden(marks, name)):
            content = False
        elif name == "header" and article and self.open[-1][0] not in ("article", "main"):
            content = False
        tokens = self._tokens(marks) if marks else frozenset()
        if is_article:
            if name == "main" or tokens.isdisjoint(COMMENT):
                while named not in self.spared:
                    self.spared.add(named)
                    named = self.around[named]
                named = self.open[-1][6]
        elif name not in ("html", "body") and _chrome(tokens):
            self.around.append(named)
            named = len(self.around) - 1
        tag = f"<{name} {marks}>".encode("utf-8", "surrogatepass")
        self.open.append((name, content, article, len(self.blocks), tag, [], named))
        self.depths[name].append(len(self.open) - 1)
        if name in LIMITS:
            self.limits.append(len(self.open) - 1)
        if is_article:
            self.whole = len(self.open)

    def _tokens(self, marks: str) -> frozenset[str]:
        """Classes and ids in small letters."""
        pairs = (mark.partition("=") for mark in marks.split("|"))
        return frozenset(token.lower() for kind, _, value in pairs if kind in ("class", "id") for token in value.split())

    def _hidden(self, marks: str, name: str) -> bool:
        if name in ("html", "body", "article", "main"):
            return False
        for mark in marks.split("|"):
            kind, _, value = mark.partition("=")
            if kind == "role" and value.lower() in ROLES:
                return True
            if kind == "hidden" or (kind == "aria-hidden" and value == "true"):
                return True
        return False

    def _end(self, name: str) -> None:
        if name in BLOCK:
            self._flush()
        if self._depth(name):
            self._pop_to(self._depth(name))

    def _depth(self, name: str) -> int:
        """Depth of the innermost open element of this name, 0 if none is open."""
        return self.depths[name][-1] if self.depths.get(name) else 0

    def _pop_to(self, depth: int) -> None:
        while len(self.open) > depth:
            self._pop()

    def _pop(self) -> None:
        if self.open[-1][0] in BLOCK:
            self._flush()
        name, _, article, first, tag, parts, _ = self.open.pop()
        self.depths[name].pop()
        if name in LIMITS:
            self.limits.pop()
        inside = parts[0] if len(parts) == 1 else _bytes(b"".join(parts))
        if parts:
            self.open[-1][5].append(inside)
        holds_article = len(self.open) < self.whole
        self.whole = min(self.whole, len(self.open))
        if self.text and name not in BLOCK:
            return  # text that runs on belongs to the block around it
        if not holds_article and len(self.blocks) > first and name not in ("html", "body"):
            self.subtrees.append((_digest(tag + b"\0" + inside), first, len(self.blocks), article))


def host_of(url: str | None) -> str | None:
    """Host name in small letters, without user, port and a leading www."""
    if url is None:
        return None
    rest = url.split("://", 1)[-1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0].rpartition("@")[2].split(":")[0].lower()
    return host.removeprefix("www.")


def parsed(pages: DataFrame, key: str, url: str, html: str) -> DataFrame:
    """One row per page: blocks, which of them may be content by name, and its subtrees."""
    source = pages.select(
        F.col(f"`{key}`").alias("page_id"), F.col(f"`{url}`").alias("url"), F.col(f"`{html}`").alias("html")
    )

    def run(frames):
        for frame in frames:
            for start in range(0, len(frame), 500):
                part = frame.iloc[start : start + 500]
                found = [Page(text or "") for text in part["html"]]
                yield pd.DataFrame(
                    {
                        "page_id": part["page_id"],
                        "url": part["url"],
                        "host": [host_of(u) for u in part["url"]],
                        "blocks": [[text for text, _, _ in page.blocks] for page in found],
                        "content": [page.kept for page in found],
                        "subtrees": [
                            [{"hash": h, "first": f, "last": e, "of": o} for h, f, e, o in page.subtrees] for page in found
                        ],
                    }
                )

    return source.mapInPandas(
        run,
        "page_id long, url string, host string, blocks array<string>, content array<boolean>, "
        "subtrees array<struct<hash:long,first:int,last:int,of:long>>",
    )


def templates(rows: DataFrame, min_pages: int = MIN_PAGES, min_share: int = MIN_SHARE) -> DataFrame:
    """``host`` and the subtree hashes of its template, of hosts that have one."""
    articles = rows.select("host", F.explode(F.array_distinct("subtrees.of")).alias("of")).distinct()
    pages_of = articles.groupBy("host").agg(F.count(F.lit(1)).alias("_pages"))
    pairs = F.transform("subtrees", lambda s: F.struct(s["hash"], s["of"]))
    hashes = rows.select("host", F.inline(F.array_distinct(pairs)).alias("hash", "of"))
    counts = hashes.distinct().groupBy("host", "hash").agg(F.count(F.lit(1)).alias("_c"))
    template = counts.filter(F.col("_c") >= min_pages).join(pages_of, "host")
    template = template.filter(F.col("_c") * min_share >= F.col("_pages"))
    return template.groupBy("host").agg(F.collect_list("hash").alias("_template"))


def decided(
    pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html",
    min_pages: int = MIN_PAGES, min_share: int = MIN_SHARE,
) -> DataFrame:
    """``page_id``, ``url``, ``blocks``, what the template takes (``in_template``) and what names leave (``content``)."""
    rows = stored(parsed(pages, key, url, html), "parsed_pages", compression="zstd")
    rows = rows.withColumn("host", F.coalesce(F.concat(F.lit("h"), "host"), F.lit("")))
    template = stored(templates(rows, min_pages, min_share), "templates")
    met = rows.join(template, "host", "left").withColumn(
        "_gone", F.filter("subtrees", lambda s: F.array_contains("_template", s["hash"]))
    )
    inside = F.transform(
        "blocks", lambda _, i: F.exists(F.col("_gone"), lambda g: (g["first"] <= i) & (i < g["last"]))
    )
    inside = F.when(F.size("_gone") > 0, inside).otherwise(F.transform("blocks", lambda _: F.lit(False)))
    return met.select("page_id", "url", "blocks", inside.alias("in_template"), "content")


def main_text(
    pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html",
    min_pages: int = MIN_PAGES, min_share: int = MIN_SHARE,
) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every page."""
    rows = decided(pages, key, url, html, min_pages, min_share)
    left = F.filter("blocks", lambda _, i: ~F.get("in_template", i) & F.get("content", i))
    text = F.array_join(left, " ")
    return rows.select("page_id", "url", text.alias("text"), F.length(text).cast("long").alias("n_chars"))
