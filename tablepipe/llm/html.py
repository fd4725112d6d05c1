"""Main text of web pages by composite text density (operator 4).

A page becomes a tree of elements (unclosed and misnested tags are closed where
the next block begins).  Elements that are boilerplate by tag, attribute, role or
whole class name (the lists below) are taken out, but never one that holds the
page's main element or largest article, or most of its text outside links (unless
it lies outside the article or main element of the page).  For every other element: C characters, T tags, LC characters and LT
tags in links below it, and

    density = C / T * log(C/LC * T/LT) / log(base),
    base    = ln(C / (C - LC) * LC + LC_body / C_body * C + e) + 1,

the characters per tag, lowered where much of the text is links.  The density sum
of an element adds its children's densities.  The element of the largest sum sets
the threshold: the smallest density on its path to the body.  From the body down,
where an element's density reaches the threshold, the subtree of largest sum
below it is content.

Blocks (the text between tags of block elements) are joined in page order.

Defined results: null, empty or text-free html gives empty text; text without
tags is its own main text; repeated rows are pages of their own; other columns
are ignored.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template svg math".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul option".split())
# Elements that only format text are not nodes: their text belongs to the block around them.
INLINE = frozenset("b i em strong u s small big sub sup span font code kbd samp var tt mark abbr acronym cite q dfn time del ins strike bdi bdo wbr br img data ruby rt rp nobr".split())
# A start tag of the first kind closes an open element of the second.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "thead": {"thead", "tbody", "tfoot"}, "tbody": {"thead", "tbody", "tfoot"}, "tfoot": {"thead", "tbody", "tfoot"}}
SCOPES = frozenset("ul ol dl table td th div section article main body html".split())
DROP_TAGS = frozenset("head nav footer aside form button select input label menu dialog canvas object audio video".split())
DROP_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog toolbar".split())
# Whole class names, and ids of elements that are no sections or headings of an article.
DROP_NAMES = frozenset(
    "nav navbar navigation menu submenu breadcrumb breadcrumbs main-nav site-nav top-nav nav-menu main-menu primary-menu main-navigation site-navigation footer site-footer page-footer "
    "masthead site-header sidebar left-sidebar right-sidebar sidebar-left sidebar-right widget widgets widget-area ad ads advert adverts advertisement adsbygoogle adsense ad-banner ad-container ad-slot sponsored "
    "cookie-banner cookie-bar cookie-consent cookie-notice gdpr-banner popup modal newsletter newsletter-signup subscribe-form signup-form login-form search-form searchform search-box "
    "comments comment-list commentlist comments-area comment-form disqus_thread share-buttons share-bar sharedaddy social-share social-links social-icons related-posts related-articles recommended-articles "
    "pager pagination toolbar skip-link skip-to-content".split()
)
# An id inside an article names a place in it, unless on one of these.
ID_TAGS = frozenset("div ul ol table".split())
# What these hold is no text of the page.
CONTROLS = frozenset("head button select input canvas object audio video".split())
KEEP_TAGS = frozenset("html body main article".split())


class Node:
    __slots__ = ("tag", "parent", "inside", "dropped", "link", "chars", "tags", "lchars", "ltags", "sum", "density")

    def __init__(self, tag: str, parent: int, inside: bool, dropped: bool, link: bool):
        self.tag, self.parent, self.inside, self.dropped, self.link = tag, parent, inside, dropped, link
        self.chars = self.tags = self.lchars = self.ltags = 0
        self.sum = self.density = 0.0


def _boilerplate(tag: str, raw: str, in_article: bool) -> bool:
    if tag in DROP_TAGS or tag == "header" and not in_article:
        return True
    if not raw or tag in KEEP_TAGS:
        return False
    attributes: dict[str, str] = {}
    for name, value in ATTRIBUTE.findall(raw):
        attributes.setdefault(name.lower(), value.strip("\"'").lower())  # of repeated attributes the first counts
    if "hidden" in attributes and attributes["hidden"] != "until-found" or attributes.get("aria-hidden") == "true":
        return True
    if not DROP_ROLES.isdisjoint(attributes.get("role", "").split()[:1]):
        return True
    if tag == "header" and in_article:
        return False
    if not DROP_NAMES.isdisjoint(attributes.get("class", "").split()):
        return True
    return attributes.get("id", "").strip() in DROP_NAMES and (not in_article or tag in ID_TAGS)


def _settle(nodes: list[Node], runs: list[tuple[int, str]]) -> None:
    """``dropped`` of every element, from what each is by itself."""
    text = [0] * len(nodes)  # characters outside links
    for k, piece in runs:
        if not nodes[k].link:
            text[k] += len("".join(piece.split()))
    for k in range(len(nodes) - 1, 0, -1):
        if nodes[k].tag in CONTROLS:
            text[k] = 0
        text[nodes[k].parent] += text[k]
    keeps = [False] * len(nodes)
    articles = [k for k, n in enumerate(nodes) if n.tag == "article"]
    stays = [max(articles, key=text.__getitem__, default=-1)] + [k for k, n in enumerate(nodes) if n.tag == "main"]
    for k in stays:
        while k >= 0 and not keeps[k]:
            keeps[k] = True
            k = nodes[k].parent
    clear = [True] * len(nodes)  # nothing around it is boilerplate by itself
    for k, node in enumerate(nodes[1:], 1):
        clear[k] = clear[node.parent] and not node.dropped
    found = any(k >= 0 and text[k] and clear[k] for k in stays)
    for k, node in enumerate(nodes[1:], 1):
        # Where the article is found, what lies outside all articles is not it, however long.
        kept = keeps[k] or 2 * text[k] > text[0] and (node.inside or not found)
        node.dropped = nodes[node.parent].dropped or node.dropped and not kept


def parse(page: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """The elements in page order (0: the root) and the text runs (element, text);
    an empty run marks a block boundary."""
    nodes, runs = [Node("body", -1, False, False, False)], []
    stack, at, size = [0], 0, len(page)

    def text(piece: str) -> None:
        if piece:
            runs.append((stack[-1], entities.unescape(piece) if "&" in piece else piece))

    while at < size:
        m = TOKEN.search(page, at)
        if not m:
            text(page[at:])
            break
        text(page[at : m.start()])
        at = m.end()
        closing, tag, raw = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if tag in ("html", "body"):
            continue
        if tag in RAW and not closing:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else (size if tag in ("script", "style", "textarea", "title") else at)
            if end or at == size:
                continue
        if closing:
            for k in range(len(stack) - 1, 0, -1):
                if nodes[stack[k]].tag == tag:
                    del stack[k:]
                    break
                if nodes[stack[k]].tag in SCOPES and tag not in SCOPES:
                    break
        else:
            if tag in BLOCK:  # a block ends an open paragraph and what is open in it
                for k in range(len(stack) - 1, 0, -1):
                    if nodes[stack[k]].tag == "p":
                        del stack[k:]
                        break
                    if nodes[stack[k]].tag in BLOCK:
                        break
            for k in range(len(stack) - 1, 0, -1) if tag in CLOSES else ():
                if nodes[stack[k]].tag in CLOSES[tag]:
                    del stack[k:]
                    break
                if nodes[stack[k]].tag in SCOPES:
                    break
            if tag == "br":
                runs.append((stack[-1], " "))
            up = nodes[stack[-1]]
            boilerplate = _boilerplate(tag, raw, up.inside)
            if tag in INLINE and not boilerplate:
                continue
            node = Node(tag, stack[-1], up.inside or tag in ("article", "main"), boilerplate, up.link or tag == "a")
            nodes.append(node)
            if tag not in VOID and not raw.endswith("/") or tag == "a":
                stack.append(len(nodes) - 1)
        if tag in BLOCK:
            runs.append((stack[-1], ""))
    _settle(nodes, runs)
    return nodes, runs


def _path(nodes: list[Node], k: int) -> list[int]:
    """``k`` and what it lies in, up to the body."""
    out = []
    while k >= 0:
        out.append(k)
        k = nodes[k].parent
    return out


def content(nodes: list[Node], runs: list[tuple[int, str]]) -> list[bool]:
    """For each element whether it belongs to the main text."""
    for k, piece in runs:
        n = len("".join(piece.split()))
        nodes[k].chars += n
        nodes[k].lchars += n if nodes[k].link else 0
    for k in range(len(nodes) - 1, 0, -1):  # children come after their parent
        node = nodes[k]
        if not node.dropped:
            up = nodes[node.parent]
            up.chars += node.chars
            up.lchars += node.lchars
            up.tags += node.tags + 1
            up.ltags += node.ltags + (node.tag == "a")
    body = nodes[0]
    share = body.lchars / max(body.chars, 1)
    for node in nodes:
        if not node.dropped and node.chars:
            tags, base = max(node.tags, 1), math.log(node.chars / max(node.chars - node.lchars, 1) * node.lchars + share * node.chars + math.e) + 1
            node.density = node.chars / tags * max(math.log(node.chars / max(node.lchars, 1) * tags / max(node.ltags, 1)) / math.log(base), 0.0)
    for node in nodes[1:]:
        if not node.dropped:
            nodes[node.parent].sum += node.density
    best = [k if not n.dropped else 0 for k, n in enumerate(nodes)]  # of each subtree, its element of largest sum
    for k in range(len(nodes) - 1, 0, -1):
        if not nodes[k].dropped and nodes[best[k]].sum >= nodes[best[nodes[k].parent]].sum and nodes[best[k]].sum > nodes[nodes[k].parent].sum:
            best[nodes[k].parent] = best[k]
    for k, node in enumerate(nodes):  # an article's parts stay together
        if node.tag in ("article", "main") and not node.dropped and not any(nodes[j].tag in ("article", "main") for j in _path(nodes, node.parent)):
            best[k] = k
    at, threshold = best[0], body.density
    at = next((k for k in reversed(_path(nodes, at)) if nodes[k].tag in ("article", "main")), at)
    best[0] = at
    while at > 0:
        threshold = min(threshold, nodes[at].density)
        at = nodes[at].parent
    marked = [False] * len(nodes)
    open_ = [False] * len(nodes)  # reached from the body through dense elements
    for k, node in enumerate(nodes):
        if node.dropped:
            continue
        if node.parent >= 0 and marked[node.parent]:
            marked[k] = True
        elif (node.parent < 0 or open_[node.parent]) and node.density >= threshold:
            open_[k] = True
            if best[k] == k or not node.sum:
                marked[k] = True
            else:
                marked[best[k]] = True
    for k, node in enumerate(nodes):  # what lies below a marked element, marked later in the walk
        if not node.dropped and node.parent >= 0 and marked[node.parent]:
            marked[k] = True
    return marked


def main_text(page: str | None) -> str:
    """The main text of a page, its blocks joined by an empty line."""
    if not page:
        return ""
    nodes, runs = parse(page)
    marked = content(nodes, runs)
    blocks, now = [], []
    for k, piece in runs:
        if not piece:
            blocks.append("".join(now))
            now = []
        elif marked[k] and not nodes[k].dropped:
            now.append(piece)
    blocks.append("".join(now))
    return "\n\n".join(b for b in (" ".join(x.split()) for x in blocks) if b)


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                some = batch.slice(k, 256)
                texts = [main_text(p) for p in some.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kind = pages.schema[id_col].dataType.simpleString()
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
