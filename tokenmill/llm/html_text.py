"""Main-text extraction with site template removal.

1. Every page is parsed into an element tree and each element's subtree gets a hash of
   its tags and texts. Spark counts on how many pages of its host each hash occurs; a
   subtree on at least ``MIN_PAGES`` pages is part of the site's template. On hosts of
   more than ``SMALL_HOST`` pages that floor rises by ``MIN_PAGES`` with each doubling.
2. From each page the template's subtrees are deleted, and those that their tag, role or
   class names as menu, header, footer, sidebar, notice, advert, form or comment. What is
   left of the article (else of ``main``, else of the body) is the text.

An element that holds the article is never deleted, and inside the article a recurring
subtree is deleted only if it carries links or controls and no prose: copies of an
article, and passages that many articles share, stay. Elsewhere a subtree that is not a
mere menu (prose, or more text outside of links than in them) counts once for each
different text around it, so copies of a page without ``article`` stay too; and on such a
page no class, role or ``form`` drops the element that holds most of the page's text.

Counting is a partial aggregation by (host, hash), so a host with a third of all pages is
spread over tasks. The table of templates is written, and shipped to the executors if it
has at most ``SHIPPED`` entries. A larger one is joined to the pages' subtrees, and what
is found goes back to each page; no task holds a whole host's template then.
"""
from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise
from .url_rules import host_of

MIN_PAGES = 5
SMALL_HOST = 50
#: Template entries of all hosts that are shipped to the executors.
SHIPPED = 1 << 20

_TAG = re.compile(r"<!--(?:.*?-->|.*)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
_ATTR = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_RAW = {t: re.compile(f"</{t}(?=[\\s/>])[^>]*>", re.I) for t in ("script", "style", "textarea", "title", "iframe", "noscript", "xmp")}

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr td th".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre dd figcaption".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr "
                     "main menu nav ol p pre section table ul".split())
#: A start tag ends these open elements, up to the nearest of the second set.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}), "body": ({"head"}, set()),
}
DROPPED_TAGS = frozenset("nav footer aside form button select option input textarea fieldset iframe object embed applet noscript "
                         "template svg canvas audio video dialog menu script style head title".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
#: Words of class and id values that name what is not the article.
DROPPED_NAMES = frozenset(
    "ad ads adbox adsense advert advertisement advertising adverts banner banners sponsor sponsored promo promotion "
    "cookie cookies consent gdpr notice notices notification popup modal overlay newsletter subscribe subscription signup "
    "sidebar sidebars aside menu menus nav navbar navigation breadcrumb breadcrumbs pagination pager toolbar topbar "
    "share sharing social related recommended recommendations comment comments commentlist disqus reply replies respond "
    "footer masthead login search searchbox widget widgets copyright disclaimer skip".split())
CONTROLS = frozenset("a button input select textarea form img iframe".split())
#: Text inside these is no part of a page's own text.
LINKS = frozenset("a button select textarea option".split())
CONTENT = frozenset(("article", "main"))


class Tree:
    """Elements in document order; a child's index is above its parent's."""

    def __init__(self, source: str):
        self.tag, self.parent, self.drop, self.items = ["#page"], [-1], [False], [[]]
        self.by_name = [False]  # dropped, but only by class, id, role or as a form
        open_at, opened = [0], {"#page": 1}
        at = 0

        def close(until: int) -> None:
            while len(open_at) > until:
                opened[self.tag[open_at.pop()]] -= 1

        def close_nearest(names, stop=frozenset()) -> None:
            """Ends the outermost open element of ``names`` above the nearest of ``stop``."""
            depth, found = len(open_at) - 1, 0
            while depth > 0 and self.tag[open_at[depth]] not in stop:
                if self.tag[open_at[depth]] in names:
                    found = depth
                depth -= 1
            if found:
                close(found)

        def text(piece: str) -> None:
            if piece:
                self.items[open_at[-1]].append(html.unescape(piece) if "&" in piece else piece)

        while (m := _TAG.search(source, at)) is not None:
            text(source[at:m.start()])
            at = m.end()
            name = m[2] or m[5]
            if not name:
                continue
            name = name.lower()
            if m[1] or m[4]:
                if opened.get(name):
                    depth = len(open_at) - 1
                    while self.tag[open_at[depth]] != name:
                        depth -= 1
                    close(depth)
                continue
            if name in CLOSES_P and opened.get("p"):
                close_nearest({"p"}, {"article", "body", "td", "th", "button", "#page"})
            elif name in IMPLIED and any(opened.get(t) for t in IMPLIED[name][0]):
                close_nearest(*IMPLIED[name])
            if name in CLOSES_P and opened.get("head"):
                close_nearest({"head"})
            attrs = m[3] or m[6] or ""
            k = len(self.tag)
            self.tag.append(name)
            self.parent.append(open_at[-1])
            self.items.append([])
            named, hidden = self._named(name, attrs) if attrs else (False, False)
            self.drop.append(name in DROPPED_TAGS or named or hidden)
            self.by_name.append((name == "form" or named and name not in DROPPED_TAGS) and not hidden)
            self.items[open_at[-1]].append(k)
            if name in _RAW:  # no markup inside; none of these is part of the article's text
                end = _RAW[name].search(source, at)
                at = end.end() if end else len(source)
            elif name not in VOID and not attrs.endswith("/"):
                open_at.append(k)
                opened[name] = opened.get(name, 0) + 1
        text(source[at:])

    @staticmethod
    def _named(tag: str, attrs: str) -> tuple[bool, bool]:
        """Whether class, id or role name what is not the article, and whether the element is hidden."""
        named = hidden = False
        if tag in ("html", "body", "main"):
            return named, hidden
        for key, value in _ATTR.findall(attrs):
            key, value = key.lower(), value.strip("\"'").lower()
            if key in ("class", "id"):
                named = named or any(w in DROPPED_NAMES for w in re.split(r"[^a-z0-9]+", value))
            elif key == "role":
                named = named or value in DROPPED_ROLES
            elif key == "hidden" or key == "aria-hidden" and value == "true":
                hidden = True
            elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                hidden = True
        return named, hidden

    def summarise(self) -> None:
        """Bottom-up: subtree hash, and whether a subtree has text, content roots, controls or prose."""
        n = len(self.tag)
        self.hash, self.full = [0] * n, [False] * n
        self.holds_content, self.has_control, self.has_prose = [False] * n, [False] * n, [False] * n
        self.inside, self.in_article = [False] * n, [False] * n
        # a subtree's characters outside of links and in them, and a sum of hashes of the former texts
        self.loose, self.linked, self.around = [0] * n, [0] * n, [0] * n
        silent, link = [False] * n, [False] * n
        for k in range(1, n):
            silent[k] = silent[self.parent[k]] or self.drop[k] and not self.by_name[k]
            link[k] = link[self.parent[k]] or self.tag[k] in LINKS
            self.in_article[k] = self.in_article[self.parent[k]] or self.tag[self.parent[k]] == "article"
            self.inside[k] = self.inside[self.parent[k]] or self.tag[k] in CONTENT
        for k in range(n - 1, -1, -1):
            parts, tag = [self.tag[k]], self.tag[k]
            full, content, control, prose = False, tag in CONTENT and not self.drop[k], tag in CONTROLS, tag in PROSE
            for x in self.items[k]:
                if isinstance(x, str):
                    x = " ".join(x.split())
                    full = full or bool(x)
                    parts.append("t" + x)
                    if x and link[k]:
                        self.linked[k] += len(x)
                    elif x and not silent[k]:
                        self.loose[k] += len(x)
                        self.around[k] += xxhash.xxh64_intdigest(x.encode("utf-8", "surrogatepass"))
                else:
                    self.linked[k] += self.linked[x]
                    self.loose[k] += self.loose[x]
                    self.around[k] += self.around[x]
                    parts.append(f"e{self.hash[x]}")
                    full, content = full or self.full[x], content or self.holds_content[x]
                    control, prose = control or self.has_control[x], prose or self.has_prose[x]
            self.hash[k] = xxhash.xxh64_intdigest("\x00".join(parts).encode("utf-8", "surrogatepass")) - (1 << 63)
            self.full[k], self.holds_content[k], self.has_control[k], self.has_prose[k] = full, content, control, prose

    def candidate(self, k: int) -> bool:
        """Whether recurrence may delete element k."""
        if not self.full[k] or self.holds_content[k] or self.tag[k] in ("#page", "html", "body") or self.tag[k] in INLINE:
            return False
        return not self.inside[k] or self.has_control[k] and not self.has_prose[k]

    def candidates(self) -> dict[int, int]:
        """The subtrees that recurrence may delete: 0 if each page counts, else a hash of the text around."""
        out: dict[int, int] = {}
        for k in range(len(self.tag)):
            if self.candidate(k):
                menu = self.inside[k] or not self.has_prose[k] and self.has_control[k] and self.linked[k] >= self.loose[k]
                around = 0 if menu else (self.around[0] - self.around[k]) % ((1 << 63) - 1) + 1
                out[self.hash[k]] = min(around, out.get(self.hash[k], around))
        return out

    def dropped(self, k: int) -> bool:
        """Whether its tag or a name drops element k. What holds the article stays whatever it is called, and so
        does what holds most of the text of a page without one; reader comments inside an article may be articles too."""
        if self.drop[k] and not self.holds_content[0] and self.by_name[k] and 2 * self.loose[k] > self.loose[0]:
            return False
        return self.drop[k] and (self.in_article[k] or not self.holds_content[k])

    def text(self, template: set[int]) -> str:
        """Blocks of what is left, joined by an empty line."""
        gone = [self.dropped(k) or bool(template) and self.hash[k] in template and self.candidate(k)
                for k in range(len(self.tag))]
        for k in range(1, len(gone)):
            gone[k] = gone[k] or gone[self.parent[k]]
        roots = [k for name in ("main", "article") for k in range(len(gone)) if self.tag[k] == name and not gone[k]]
        # main if there is one, with articles outside of it; else articles; else the page
        scope = [False] * len(gone)
        for k in roots or [0]:
            scope[k] = True
        for k in range(1, len(gone)):
            scope[k] = scope[k] or scope[self.parent[k]]
        for k in range(len(gone)):  # a page header goes; an article's own header stays
            if self.tag[k] == "header" and not self.inside[k] and not self.holds_content[k] or k and gone[self.parent[k]]:
                gone[k] = True
        blocks, now = [], []

        def flush() -> None:
            block = " ".join("".join(now).split())
            now.clear()
            if block:
                blocks.append(block)

        todo: list = [0]
        while todo:
            x = todo.pop()
            if x is None:
                flush()
            elif isinstance(x, str):
                now.append(x)
            elif not gone[x]:
                inline = self.tag[x] in INLINE
                if not inline:
                    flush()
                    todo.append(None)
                elif self.tag[x] in ("br", "td", "th", "wbr"):
                    now.append("" if self.tag[x] == "wbr" else " ")
                for y in reversed(self.items[x]):
                    if not isinstance(y, str) or scope[x]:
                        todo.append(y)
        flush()
        return "\n\n".join(blocks)


def template_hashes(pages: DataFrame, url_col: str = "url", html_col: str = "html",
                    min_pages: int = MIN_PAGES) -> DataFrame:
    """``(host, hash)`` of the recurring subtrees of each host."""
    def hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            host, out, around = [], [], []
            for h, source in zip(batch["host"], batch["html"]):
                tree = Tree(source or "")
                tree.summarise()
                # 0 stands for the page itself
                mine = tree.candidates() | {0: 0}
                host.extend([h] * len(mine))
                out.extend(mine.keys())
                around.extend(mine.values())
            yield pd.DataFrame({"host": pd.Series(host, dtype=object), "hash": pd.Series(out, dtype="int64"),
                                "around": pd.Series(around, dtype="int64")})

    source = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))
    counted = materialise(source.mapInPandas(hashes, "host string, hash long, around long")
                          .groupBy("host", "hash", "around").agg(F.count("*").alias("n")).groupBy("host", "hash")
                          .agg(F.sum(F.when(F.col("around") == 0, F.col("n")).otherwise(1)).alias("n")).filter(f"n >= {min_pages}"), "html-counts")
    size = counted.filter("hash = 0").select(F.col("host").alias("p_host"), F.col("n").alias("pages"))
    floor = min_pages * (1 + F.log2(F.greatest(F.col("pages") / SMALL_HOST, F.lit(1.0))))
    return (counted.filter("hash <> 0").join(size, F.col("host") == F.col("p_host"))
            .filter(F.col("n") >= floor).select("host", "hash"))


def page_key(html: Column) -> Column:
    """Pages of a host with equal html have equal subtrees, so one entry does for them."""
    return F.md5(F.coalesce(html, F.lit("")))


def page_templates(source: DataFrame, templates: DataFrame) -> DataFrame:
    """``(t_host, t_key, template array<long>)``: the template's subtrees on each page of ``source`` (host, html) that has any."""
    def hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            host, key, out = [], [], []
            for h, k, html_source in zip(batch["host"], batch["key"], batch["html"]):
                tree = Tree(html_source or "")
                tree.summarise()
                mine = tree.candidates()
                host.extend([h] * len(mine))
                key.extend([k] * len(mine))
                out.extend(mine.keys())
            yield pd.DataFrame({"t_host": pd.Series(host, dtype=object), "t_key": pd.Series(key, dtype=object),
                                "t_hash": pd.Series(out, dtype="int64")})

    each = source.select("host", page_key(F.col("html")).alias("key"), "html").mapInPandas(
        hashes, "t_host string, t_key string, t_hash long")
    return (each.join(templates, (F.col("t_host") == F.col("host")) & (F.col("t_hash") == F.col("hash")))
            .groupBy("t_host", "t_key").agg(F.collect_set("t_hash").alias("template")))


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                 min_pages: int = MIN_PAGES, shipped: int = SHIPPED) -> DataFrame:
    """Per row of ``pages``: id, url, ``text``, ``n_chars``.

    A null or empty html gives the empty text; a page without ``://`` in its url belongs
    to the empty host; repeated rows count each and give equal texts; hosts with fewer
    than ``min_pages`` pages have no template; an empty table stays empty.
    """
    templates = materialise(template_hashes(pages, url_col, html_col, min_pages), "html-templates")
    source = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"),
                          host_of(F.col(url_col)).alias("host"))
    by_host = {}
    if templates.limit(shipped + 1).count() <= shipped:
        by_host = {r["host"]: np.array(r["hashes"], np.int64) for r in templates.groupBy("host").agg(
            F.sort_array(F.collect_list("hash")).alias("hashes")).collect()}
        joined = source.select("id", "url", "html", "host", F.lit(None).cast("array<bigint>").alias("template"))
    else:
        found = page_templates(source, templates)
        joined = source.join(found, (F.col("host") == F.col("t_host")) & (page_key(F.col("html")) == F.col("t_key")), "left").select(
            "id", "url", "html", "host", "template")
    shared = pages.sparkSession.sparkContext.broadcast(by_host)

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = []
            for source, host, template in zip(batch["html"], batch["host"], batch["template"]):
                tree = Tree(source or "")
                tree.summarise()
                if template is None and host in shared.value:
                    own, known = np.array(tree.hash, np.int64), shared.value[host]
                    at = np.minimum(np.searchsorted(known, own), len(known) - 1)
                    template = own[known[at] == own]
                texts.append(tree.text(set() if template is None else set(template.tolist())))
            yield pd.DataFrame({"id": batch["id"], "url": batch["url"], "text": texts, "n_chars": [len(t) for t in texts]},
                               columns=["id", "url", "text", "n_chars"]).astype({"text": object, "n_chars": "int64"})

    kinds = dict(source.dtypes)
    out = joined.mapInPandas(extract, f"id {kinds['id']}, url string, text string, n_chars long")
    return out.withColumnRenamed("id", id_col).withColumnRenamed("url", url_col)
