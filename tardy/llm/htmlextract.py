"""Main text of web pages by composite text density.

Method: the page becomes a tree; every node gets its composite text density (characters per tag,
lowered by the share of link text and link tags), and the sum of its children's densities. The
node with the largest sum lies in the article; the least density on its path up to the body is
the threshold that tells content from the rest of the page. The article is the enclosing
``article`` or ``main`` element or, where a page has none, the highest node on that path that
still reaches the body's density. Parts that are never article (scripts, menus, forms, adverts,
notices, reader comments, ...) are known by element, role or class name and left out; lists
of links that fall below the threshold are left out as well. A name or a form leaves nothing out
that holds the article or most of the text outside links (see ``restore``).

The text: character references decoded, white space inside a block as one space, blocks in page
order joined by one newline.
"""

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tardy.llm.common import bounded_batches

# Element names by how a page uses them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title svg noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody "
    "td tfoot th thead tr ul".split())
ENDS_P = BLOCK - frozenset("body caption dd dt html legend li tbody td tfoot th thead tr".split())
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
            "th": ("td", "th"), "option": ("option",), "tbody": ("tr", "td", "th", "thead", "tbody"),
            "tfoot": ("tr", "td", "th", "tbody")}
SCOPES = frozenset("table ul ol dl body html article main".split())
NEVER = frozenset("head nav footer aside button select input dialog menu audio video canvas".split())
NEVER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu "
                        "menubar toolbar tablist".split())
NEVER_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox adslot banner sponsor sponsored promo promotion "
    "cookie cookies consent gdpr notice notices alert alerts notification popup modal overlay newsletter subscribe "
    "subscription signup login sidebar sidebars side rail menu menus nav navbar navigation navigator breadcrumb "
    "breadcrumbs crumbs topbar toolbar masthead footer comment comments commentlist disqus respond reply replies "
    "discussion share sharing social related recommended recommendations widget widgets pagination pager search "
    "skip hidden paywall".split())
COMMENT_NAMES = frozenset("comment comments commentlist disqus respond reply replies discussion".split())
# words that say no more than what a box is; a compound of them and listed names is a listed name
BOX_NAMES = frozenset("area bar block bottom box button buttons container form group icons inner item items left link "
                      "links list posts right section slot text title top unit wrap wrapper".split())
ARTICLE = ("article", "main")
BY_NAME, BY_COMMENT_NAME = "name", "comment name"        # reasons to leave an element out that restore() may take back

_TAG = re.compile(r"""<(?:!--.*?(?:-->|\Z)|[!?][^>]*>|(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>)""", re.S)
_LOOSE = re.compile(r"</?([a-zA-Z][^\s/>]*)[^>]*>")
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_NAME = re.compile(r"[a-z]+")


class Node:
    __slots__ = ("chars", "density", "drop", "link_chars", "link_tags", "parent", "parts", "plain", "tag", "tags", "total")

    def __init__(self, tag, parent, drop=False):
        self.tag, self.parent, self.drop, self.parts = tag, parent, drop, []
        self.chars = self.tags = self.link_chars = self.link_tags = self.plain = 0
        self.density = self.total = 0.0


def _listed(word: str) -> bool:
    """Is a class or id on the list of names, whole or as a compound of nothing but listed and box names?"""
    parts = _NAME.findall(word)
    return not NEVER_NAMES.isdisjoint(parts) and all(p in NEVER_NAMES or p in BOX_NAMES for p in parts)


def _never(tag: str, attributes: str, inside_article: bool) -> bool | str:
    """Is this element, by name, role or class, no part of an article? The reason, where it may be taken back."""
    if tag == "form":
        return BY_NAME
    if tag in NEVER or tag in RAW or tag == "header" and not inside_article:
        return True
    if not attributes or tag in ARTICLE or tag in ("html", "body"):
        return False
    why: bool | str = False
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "role" and value in NEVER_ROLES:
            why = why or BY_NAME
        if name == "style" and re.search(r"display\s*:\s*none", value):
            return True
        if name in ("class", "id"):
            for word in value.split():
                if word in ("header", "page-header", "site-header") or _listed(word):
                    why = why or BY_NAME
                    if not COMMENT_NAMES.isdisjoint(_NAME.findall(word)):
                        why = BY_COMMENT_NAME
    return why


def parse(page: str) -> Node:
    """Tree of a page; end tags that authors leave out are supplied, stray ones ignored."""
    root = Node("html", None)
    at, node, articles, n = 0, root, 0, len(page)
    last = page.rfind(">")
    # open elements below the root, by tag, and those that end a search; each with its depth
    depth, by_tag, scopes, blocks = 0, {}, [], []

    def close(target):
        nonlocal node, articles, depth
        while True:
            articles -= node.tag in ARTICLE
            by_tag[node.tag].pop()
            for held, tags in ((scopes, SCOPES), (blocks, BLOCK)):
                if node.tag in tags:
                    held.pop()
            depth -= 1
            done, node = node is target, node.parent
            if done:
                return

    def open_one(tags, scope):
        """The nearest open element among ``tags``, not looking beyond the nearest one in ``scope``."""
        found = max((by_tag[t][-1] for t in tags if by_tag.get(t)), default=None, key=lambda x: x[0])
        return found[1] if found and (not scope or found[0] >= scope[-1]) else None

    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            node.parts.append(page[at:])
            break
        if lt > at:
            node.parts.append(page[at:lt])
        if lt > last:                           # no bracket closes any more: text, up to a comment
            node.parts.append(page[lt:].split("<!--")[0])
            break
        m = _TAG.match(page, lt)
        if not m:
            m = _LOOSE.match(page, lt)          # an unfinished quote: up to the next bracket
            if not m:
                node.parts.append("<")          # a bare bracket is text
                at = lt + 1
                continue
            end, tag, attributes = page[lt + 1] == "/", m[1].lower(), ""
        else:
            if m[2] is None:                    # comment or declaration
                at = m.end()
                continue
            end, tag, attributes = m[1] == "/", m[2].lower(), m[3]
        at = m.end()
        if end:
            if tag not in ("html", "body"):
                # an inline end tag never closes a block around it
                found = open_one((tag,), scopes if tag in BLOCK else blocks)
                if found:
                    close(found)
            continue
        if tag in ENDS_P and (found := open_one(("p",), blocks)):
            close(found)
        while tag in SIBLINGS and (found := open_one(SIBLINGS[tag], scopes)):
            close(found)
        if tag in ("html", "body") and node is not root:
            continue
        child = Node(tag, node, _never(tag, attributes, articles > 0))
        node.parts.append(child)
        if tag in RAW:
            if not attributes.endswith("/"):
                stop = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
                at = stop.end() if stop else n
        elif tag not in VOID:
            articles += tag in ARTICLE
            node, depth = child, depth + 1
            by_tag.setdefault(tag, []).append((depth, child))
            for held, tags in ((scopes, SCOPES), (blocks, BLOCK)):
                if tag in tags:
                    held.append(depth)
    return root


def _below(root: Node, named: bool = False) -> list[Node]:
    """Kept nodes of a subtree, parents before children; with ``named`` also those left out by name."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack.extend(p for p in node.parts if not isinstance(p, str) and (not p.drop or named and p.drop is not True))
    return out


def _path(node: Node) -> list[Node]:
    """A node and what encloses it, up to the root."""
    out = [node]
    while out[-1].parent is not None:
        out.append(out[-1].parent)
    return out


def restore(root: Node) -> None:
    """Take back what a name or a form leaves out although it holds the article or most of the text.

    Text here is text outside links, over all nodes. What encloses the largest article or main
    element outside comments is taken back where that element has more text than the article found
    without it. So is an element with most of the page's text (inside that article: of the
    article's), unless a fair article lies elsewhere; reader comments need nine tenths of it.
    """
    nodes = _below(root, named=True)
    named = [x for x in nodes if x.drop]
    if not named:
        return
    for node in reversed(nodes):
        if node.tag != "a":
            node.plain += sum(len(" ".join(p.split())) for p in node.parts if isinstance(p, str))
            if node.parent is not None:
                node.parent.plain += node.plain
    articles = [x for x in nodes if x.tag in ARTICLE and x.plain]
    if any(x.drop == BY_COMMENT_NAME for x in named):
        articles = [x for x in articles if all(y.drop != BY_COMMENT_NAME for y in _path(x))]
    main = max(articles, key=lambda x: x.plain, default=None)
    around = _path(main) if main else []
    if any(x.drop for x in around):
        found = article(root)[0]
        if main.plain > found.chars - found.link_chars:
            for x in around:
                x.drop = False
        else:
            main, around = None, []
    inside = {id(x) for x in _below(main, named=True)} if main else set()
    for x in named:
        whole = main.plain if id(x) in inside else root.plain
        most = 10 * x.plain > 9 * whole if x.drop == BY_COMMENT_NAME else 2 * x.plain > whole
        elsewhere = main is not None and id(x) not in inside and 10 * main.plain >= x.plain
        if x.drop and most and not elsewhere:
            x.drop = False


def measure(root: Node) -> list[Node]:
    """Fill in density and the sum of the children's densities for every kept node."""
    nodes = _below(root)
    for node in reversed(nodes):
        own = sum(len(" ".join(p.split())) for p in node.parts if isinstance(p, str))
        inner = [p for p in node.parts if not isinstance(p, str) and not p.drop]
        node.chars = own + sum(p.chars for p in inner)
        node.tags = sum(p.tags + 1 for p in inner)
        is_link = node.tag == "a"
        node.link_chars = node.chars if is_link else sum(p.link_chars for p in inner)
        node.link_tags = sum(p.link_tags + (p.tag == "a") for p in inner)
    body = root
    ratio = body.link_chars / max(1, body.chars)
    for node in nodes:
        c, t = node.chars, max(1, node.tags)
        lc, lt = max(1, node.link_chars), max(1, node.link_tags)
        if c:
            base = math.log(c / max(1, c - node.link_chars) * node.link_chars + ratio * c + math.e)
            node.density = c / t * max(0.0, math.log(c / lc * t / lt)) / max(1e-9, math.log(base)) if base > 1 + 1e-9 else (
                c / t)
    for node in nodes:
        node.total = sum(p.density for p in node.parts if not isinstance(p, str) and not p.drop)
    return nodes


def article(root: Node) -> tuple[Node, float]:
    """(article node, density threshold)."""
    nodes = measure(root)
    path = _path(max(nodes, key=lambda x: (x.total, x.chars)))
    threshold = min(x.density for x in path)
    for node in path:
        if node.tag in ARTICLE:
            return node, threshold
    body = next((x for x in path if x.tag == "body"), root)
    inner = path[:path.index(body)]
    high = [x for x in inner if x.density >= body.density]
    return (high[-1] if high else body), threshold


def text_of(node: Node, threshold: float) -> str:
    """Blocks of a subtree in page order."""
    blocks, run = [], []

    def flush():
        if run:
            words = " ".join(html.unescape("".join(run)).split())
            if words:
                blocks.append(words)
            run.clear()

    stack: list = [node]
    while stack:
        part = stack.pop()
        if part is None:
            flush()
        elif isinstance(part, str):
            run.append(part)
        elif part.tag == "br":
            run.append(" ")
        elif not part.drop and not _link_list(part, node, threshold):
            if part.tag in BLOCK:
                flush()
                stack.append(None)
            stack.extend(reversed(part.parts))
    flush()
    return "\n".join(blocks)


def _link_list(part: Node, root: Node, threshold: float) -> bool:
    """A list of links: mostly link text, several links, below the threshold."""
    return (part is not root and part.tag in ("ul", "ol", "div", "table", "section") and part.link_tags > 2
            and 2 * part.link_chars > part.chars and part.density < threshold)


def extract(page: str) -> str:
    """Main text of one page; empty for an empty page or one without an article."""
    if not page:
        return ""
    root = parse(page)
    restore(root)
    return text_of(*article(root))


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text. Null html counts as empty and gives an empty text.

    Each whole page is handled in its own row; nothing is shuffled. Null ids and urls and repeated
    rows pass through. Only the three named columns are read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(x.as_py() or "") for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())],
                                             names=["page_id", "url", "text"])

    bounded_batches(pages.sparkSession)
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                        F.col(html_col).cast("string").alias("html"))
    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"page_id {kind}, url string, text string")
