"""Main text of pages by wrappers that are induced for each host."""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b
from html import unescape

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenwell.llm.store import Scratch
from screenwell.session import broadcast_checked

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.S)
ATTRIBUTE = re.compile(r"""(class|id|role|itemprop|hidden|aria-hidden)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div",
         "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header",
         "hgroup", "hr", "html", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody",
         "td", "tfoot", "th", "thead", "tr", "ul"}
#: Elements that an opening one of the key closes, up to the nearest of the second set.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
          "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
DROPPED = {"head", "nav", "footer", "aside", "form", "button", "select", "menu", "dialog", "svg", "canvas", "object", "audio",
           "video", "map", "math", *RAW}
#: Words of classes, ids and roles that name page furniture.
FURNITURE = {"ad", "ads", "adbox", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion",
             "banner", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "alert", "sidebar", "menu", "nav", "navbar",
             "navigation", "breadcrumb", "breadcrumbs", "footer", "comment", "comments", "commentlist", "disqus", "respond",
             "replies", "share", "sharing", "social", "related", "recommended", "newsletter", "subscribe", "subscription",
             "popup", "modal", "overlay", "widget", "login", "signup", "search", "toolbar", "pagination", "pager", "masthead",
             "skip", "contentinfo", "complementary", "dialog"}
#: Words that may follow one of them: parts that furniture is made of.
PARTS = {"area", "bar", "block", "bottom", "box", "btn", "button", "buttons", "container", "content", "fixed", "form", "frame", "global",
         "group", "holder", "icons", "inner", "item", "items", "left", "link", "links", "list", "main", "message", "note", "outer", "panel",
         "right", "section", "site", "slot", "sticky", "top", "unit", "widget", "wrap", "wrapper", "zone"}
#: Words before them that speak of a page's layout instead.
LAYOUT = {"has", "no", "with", "without", "hide", "show", "is", "not"}
MAIN = {"articlebody", "article", "post", "entry", "story", "content", "main"}
DEPTH = 150


class Node:
    """An element: tag, path label (numbers in names are left out), names (words of class, id, role),
    whether one of them names furniture, children and texts in order."""

    __slots__ = ("tag", "label", "names", "named", "kids", "hidden")

    def __init__(self, tag: str, attributes: str):
        self.tag, self.kids, self.hidden = tag, [], False
        self.names, self.named, first = set(), False, ""
        if attributes:
            for name, value in ATTRIBUTE.findall(attributes):
                name, value = name.lower(), value.strip("\"'").lower()
                if name == "hidden" or name == "aria-hidden" and value == "true":
                    self.hidden = name == "hidden"
                    continue
                first = first or value
                for name in value.split():
                    words = [w for w in re.split(r"[^a-z]+", name) if w]
                    self.names.update(words)
                    self.named |= names_furniture(words)
        first = re.sub(r"[0-9]+", "", first)
        self.label = f"{tag}.{first}" if first else tag


def names_furniture(words: list[str]) -> bool:
    """Whether a name of these words is one of furniture: a word for it at the end, or followed by parts
    only, and none before it that speaks of layout (``has-sidebar``)."""
    end = len(words)
    while end and words[end - 1] in PARTS and words[end - 1] not in FURNITURE:
        end -= 1
    return bool(end and words[end - 1] in FURNITURE and not LAYOUT & set(words[: end - 1]))


def parse(html: str) -> Node:
    """The tree of a page; open elements end where others imply it or at the end."""
    root = Node("#", "")
    stack, at, low = [root], 0, None
    for m in TOKEN.finditer(html):
        if m.start() < at:
            continue
        if m.start() > at:
            stack[-1].kids.append(html[at: m.start()])
        at = m.end()
        tag = m[2] or m[5]
        if not tag:
            continue
        tag, closing = tag.lower(), m[1] or m[4]
        if closing:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
                if stack[k].tag in ("article", "main", "body") and tag not in ("body", "html"):
                    break
            continue
        if tag in BLOCK:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p":
                    del stack[k:]
                    break
                if stack[k].tag in BLOCK:
                    break
        if tag in CLOSES:
            ends, limits = CLOSES[tag]
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in limits:
                    break
                if stack[k].tag in ends:
                    del stack[k:]
        node = Node(tag, m[3] or m[6] or "")
        stack[-1].kids.append(node)
        if tag in RAW:
            low = html.lower() if low is None else low
            end = low.find(f"</{tag}", at)
            while end >= 0 and low[end + len(tag) + 2: end + len(tag) + 3].isalnum():
                end = low.find(f"</{tag}", end + 1)
            close = low.find(">", end) if end >= 0 else -1
            at = close + 1 if close >= 0 else len(html)
        elif tag not in VOID and not (m[3] or m[6] or "").endswith("/") and len(stack) < DEPTH:
            stack.append(node)
    rest = html[at:]
    cut = re.search(r"<[a-zA-Z/!?]", rest)
    stack[-1].kids.append(rest[: cut.start()] if cut else rest)
    return root


def furniture(node: Node, inside: bool) -> bool:
    """Whether an element is page furniture; ``inside``: within the main element."""
    if node.tag in ("html", "body", "article", "main") and not node.names & {"comment", "comments"}:
        return False
    return bool(node.tag in DROPPED or node.hidden or node.named
                or (not inside and (node.tag == "header" or "header" in node.names)))


def roots(tree: Node) -> list[Node]:
    """Outermost article elements; else main ones; else those named like a main text; else the page."""
    found: dict[str, list[Node]] = {"article": [], "main": [], "named": []}
    todo = [(tree, frozenset())]
    while todo:
        node, seen = todo.pop()
        kind = "article" if node.tag == "article" else "main" if node.tag == "main" or "main" in node.names and node.tag == "div" else (
            "named" if node.tag in ("div", "section") and node.names & MAIN else "")
        if kind and kind not in seen:
            found[kind].append(node)
            seen = seen | {kind}
        todo += [(k, seen) for k in reversed(node.kids) if isinstance(k, Node) and not furniture(k, False)]
    return next((nodes for nodes in found.values() if nodes), [tree])


def blocks(tree: Node, template: frozenset = frozenset()) -> list[str]:
    """Texts of the blocks of the main elements, without furniture and the host's template."""
    return [text for path, text in located(tree) if (path, text) not in template]


def located(tree: Node) -> list[tuple[str, str]]:
    """(path of the block element, text) of each block, in page order."""
    main, out, held = roots(tree), [], []
    within = main != [tree]

    def flush(path: str) -> None:
        text = " ".join(unescape("".join(held)).split())
        held.clear()
        if text:
            out.append((path, text))

    for top in main:
        todo: list = [(top, top.label, False)]
        while todo:
            item, path, ending = todo.pop()
            if isinstance(item, str):
                held.append(item)
            elif ending:
                flush(path)
            elif item.tag == "br":
                held.append(" ")
            elif item is top or not furniture(item, within):
                if item.tag in BLOCK:
                    flush(path.rpartition("/")[0])
                    todo.append((item, path, True))
                todo += [(k, path if isinstance(k, str) or k.tag not in BLOCK else f"{path}/{k.label}", False)
                         for k in reversed(item.kids)]
        flush(top.label)
    return out


def matching(a: Node, b: Node) -> list[tuple[Node, Node]]:
    """Aligned elements of two trees by simple tree matching: roots must have the same label, and the
    children are aligned in order so that most nodes match, those of equal text counted twice."""
    scores: dict[tuple[int, int], int] = {}
    texts: dict[int, str] = {}

    def text(n: Node) -> str:
        if id(n) not in texts:
            texts[id(n)] = own_text(n)
        return texts[id(n)]

    def children(n: Node) -> list[Node]:
        return [k for k in n.kids if isinstance(k, Node) and k.tag not in RAW]

    def table(x: Node, y: Node) -> list[list[int]]:
        xs, ys = children(x), children(y)
        m = [[0] * (len(ys) + 1) for _ in range(len(xs) + 1)]
        for i, p in enumerate(xs):
            for j, q in enumerate(ys):
                m[i + 1][j + 1] = max(m[i][j + 1], m[i + 1][j], m[i][j] + score(p, q))
        return m

    def score(x: Node, y: Node) -> int:
        if x.label != y.label:
            return 0
        key = id(x), id(y)
        if key not in scores:
            scores[key] = 1 + (text(x) != "" and text(x) == text(y)) + table(x, y)[-1][-1]
        return scores[key]

    out, todo = [], [(a, b)]
    while todo:
        x, y = todo.pop()
        out.append((x, y))
        xs, ys, m = children(x), children(y), table(x, y)
        i, j = len(xs), len(ys)
        while i and j:
            if m[i][j] == m[i - 1][j]:
                i -= 1
            elif m[i][j] == m[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                todo.append((xs[i], ys[j]))
    return out


def constants(one: Node, two: Node, blocks_one: list, blocks_two: list) -> list[tuple[str, str]]:
    """(path, text) of the main blocks of ``one`` that say the same at aligned places of ``two``; the
    main blocks of both are given (``located``)."""
    mine = dict.fromkeys(blocks_one)
    shared = {text for _, text in mine} & {text for _, text in blocks_two}
    if not shared:
        return []
    same = {a for a, b in ((own_text(x), own_text(y)) for x, y in matching(one, two)) if a and a == b}
    return [(path, text) for path, text in mine if text in shared and text in same]


def layout_of(tree: Node) -> str:
    """Labels of a page's main elements."""
    return " ".join(dict.fromkeys(n.label for n in roots(tree)))


def content_of(found: list[tuple[str, str]]) -> list[int]:
    """Eight hashes of the content of a page with these main blocks.

    A hash is the smallest one of the blocks under a hash function. Pages that repeat an article with
    an edited block mostly share it; pages that share a template mostly differ in it, unless a block of
    the template hashes low, which is unlikely under all eight.
    """
    joined = b"".join(blake2b(t.encode("utf-8", "replace"), digest_size=64).digest() for _, t in found)
    hashes = np.frombuffer(joined, "<u8").reshape(-1, 8) >> np.uint64(1)
    return hashes.min(axis=0).astype(np.int64).tolist() if len(hashes) else []


def own_text(node: Node) -> str:
    """Text of an element and its inline children."""
    out, todo = [], [node]
    while todo:
        item = todo.pop()
        if isinstance(item, str):
            out.append(item)
        elif item is node or item.tag not in BLOCK and item.tag not in RAW:
            todo += reversed(item.kids)
    return " ".join(unescape("".join(out)).split())


def host_of(url):
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1), F.lit("")))


def contents(rows: DataFrame, *keys: str) -> DataFrame:
    """Number of contents of each group: the largest count of different hashes under one function."""
    each = rows.select(*keys, F.posexplode("content").alias("function", "hash")).distinct()
    return each.groupBy(*keys, "function").count().groupBy(*keys).agg(F.max("count").alias("contents"))


def wrappers(pages: DataFrame, scratch: Scratch, models: int = 3, least: int = 4) -> DataFrame:
    """(host, template): (path, text) of the blocks that aligned pages of a host and layout share.

    Every page is aligned by simple tree matching with up to ``models`` pages of its host and layout
    that have about as many blocks as most. What is equal at aligned places is counted over all pages:
    a block is template when the pages that hold it have ``least`` contents or more, and over half of
    those of the layout. Counts are of contents (``content_of``), the largest of eight counts, so copies of
    an article do not make it a template.
    Blocks that no model page holds are not found. No host meets in one task.
    """
    rows = pages.where("html is not null").select("html", host_of(F.col("url")).alias("host"))

    def profile(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            kinds = []
            for html in batch["html"]:
                tree = parse(html)
                own = located(tree)
                kinds.append((layout_of(tree), content_of(own), len(own)))
            yield pd.concat([batch[["host", "page"]].reset_index(drop=True),
                             pd.DataFrame(kinds, columns=["layout", "content", "n"])], axis=1)

    seen = scratch.cut(rows.withColumn("page", F.xxhash64("host", "html")).select("host", "page", "html").mapInPandas(
        profile, "host string, page long, layout string, content array<long>, n long").where("n > 0"))
    usual = seen.groupBy("host", "layout").agg(F.percentile_approx("n", 0.5).alias("usual"))
    layouts = scratch.cut(contents(seen, "host", "layout").where(F.col("contents") >= least).join(usual, ["host", "layout"]))
    off = F.floor(F.log2(1 + F.abs(F.col("n") - F.col("usual"))))
    picks = seen.join(broadcast_checked(layouts), ["host", "layout"]).groupBy("host", "layout").agg(
        *[F.min(F.struct(off.alias("off"), F.xxhash64("page", F.lit(k)).alias("draw"), "page")).alias(f"k{k}") for k in range(models)])
    picks = scratch.cut(picks.select("host", "layout", F.explode(F.array_distinct(F.array(
        *[F.col(f"k{k}.page") for k in range(models)]))).alias("page")))
    chosen = rows.withColumn("page", F.xxhash64("host", "html")).join(broadcast_checked(picks), ["host", "page"])
    chosen = scratch.cut(chosen.groupBy("host", "layout", "page").agg(F.first("html").alias("model"))
                         .groupBy("host").agg(F.collect_list(F.struct("layout", "model")).alias("models")))

    def align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[tuple, list] = {}
        for batch in batches:
            out = []
            for host, html, found in batch[["host", "html", "models"]].itertuples(index=False):
                tree = parse(html)
                layout, own = layout_of(tree), located(tree)
                if (host, layout) not in known:
                    if len(known) > 100:
                        known.clear()
                    trees = [parse(m["model"]) for m in found if m["layout"] == layout]
                    known[host, layout] = [(model, located(model)) for model in trees]
                same = dict.fromkeys(c for model, blocks_there in known[host, layout]
                                     for c in constants(tree, model, own, blocks_there))
                if same:
                    content = content_of(own)
                    out += [(host, layout, path, text, content) for path, text in same]
            yield pd.DataFrame(out, columns=["host", "layout", "path", "text", "content"])

    held = rows.join(broadcast_checked(chosen), "host").mapInPandas(
        align, "host string, layout string, path string, text string, content array<long>")
    held = contents(held, "host", "layout", "path", "text").where(F.col("contents") >= least)
    held = held.withColumnRenamed("contents", "held").join(broadcast_checked(layouts), ["host", "layout"]).where(
        2 * F.col("held") > F.col("contents"))
    return held.groupBy("host").agg(F.collect_set(F.array("path", "text")).alias("template"))


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of each row: blocks of the main text joined by line breaks.

    Same-host pages are aligned by simple tree matching; what is constant becomes the host's
    template and goes, what varies is content (``wrappers``). Furniture is told by element and by
    whole names of class, id or role.
    Within a block, character references are decoded and white space (also ``br``) is one space.

    Null and empty html give an empty text; a host with fewer than four different pages has no
    template; unclosed and misnested markup is repaired; repeated rows stay; other columns are not
    read; an empty table gives an empty one.
    """
    scratch = Scratch(pages.sparkSession)
    found = scratch.cut(wrappers(pages, scratch))
    rows = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host")).join(broadcast_checked(found), "host", "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, frozenset] = {}
        for batch in batches:
            out = []
            for key, url, html, host, template in batch[["page_id", "url", "html", "host", "template"]].itertuples(index=False):
                if host not in known:
                    if len(known) > 1000:
                        known.clear()
                    known[host] = frozenset(tuple(t) for t in template) if template is not None else frozenset()
                text = "\n".join(blocks(parse(html), known[host])) if html else ""
                out.append((key, url, text, len(text)))
            yield pd.DataFrame(out, columns=["page_id", "url", "text", "n_chars"]).astype({"page_id": "Int64"})

    return scratch.finish(rows.select("page_id", "url", "html", "host", "template").mapInPandas(
        run, "page_id long, url string, text string, n_chars long"))
