"""Main text of web pages by composite text density.

Every element gets its link-adjusted characters per tag; an element's density sum is the sum of its
children's densities. The subtree with the largest density sum is the article; the smallest density
on the path from body to it is the threshold that blocks beside that path must reach to join it.
What HTML itself or a class, id or role marks as boilerplate is a feature beside the density: such an
element counts for less in the search, and is cut where it lies beside or within what was chosen.
"""

from __future__ import annotations

import math
import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import slices

# fixed values: element names of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol option p pre search section summary table caption colgroup tbody td tfoot th thead tr ul xmp".split())
DROPPED = frozenset("head nav footer aside form script style noscript iframe noembed noframes embed applet svg canvas button select textarea input template dialog menu title audio video".split())
#: Of these, the ones that a page's builder may put around its article.
AROUND = frozenset("nav footer aside form dialog menu".split())
#: An open element of the key ends where one of the value's elements starts, up to the stopping elements.
P_ENDS = BLOCK - {"body", "html", "option", "tbody", "td", "tfoot", "th", "thead", "tr", "caption", "colgroup"}
SAME_END = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "thead": {"tbody", "tfoot", "thead"}, "tbody": {"tbody", "tfoot", "thead"}}
STOPS = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select", "datalist"}, "thead": {"table"}, "tbody": {"table"}}
SCOPE = frozenset("table td th caption button object marquee template".split())
# fixed values: roles and name parts of boilerplate
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising sponsor sponsored promo promos promotion banner banners "
    "nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars aside footer foot "
    "cookie cookies consent notice notices gdpr popup modal overlay newsletter subscribe subscription signup login "
    "comment comments commentlist disqus respond share sharing social related recommended recommendations widget widgets "
    "pagination pager toolbar copyright disclaimer".split()
)
COMMENTS = frozenset("comment comments commentlist disqus respond".split())
#: What may stand beside a name part of boilerplate in a class or id that still means boilerplate; has-sidebar, social-science or content-sidebar-wrap do not.
BESIDE = frozenset(
    "area bar block bottom box btn button buttons col column component container desktop fixed float form global group header heading "
    "icon icons inner inline item items label large left link links list main media mobile outer page panel post posts primary right row secondary "
    "section site slot small sticky story stories articles thread title top unit wrap wrapper wp js id".split()
)
#: Boilerplate of a page, but not within its article.
PAGE_NAMES = frozenset("header masthead topbar".split())
#: Elements whose class or id may tell their kind; those of running text are never judged by name.
NAMED = frozenset("div section ul ol dl table span ins center details fieldset figure iframe li".split())
#: Blocks that only lay out a page: beside the article they must be dense to belong to it.
LAYOUT = frozenset("div section center fieldset details dir address search".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup header".split())
#: What a density sum counts for within an element that is marked as boilerplate.
MARKED = 0.3
#: The share of the choice's characters that a layout block beside it needs to join it.
JOINS = 0.1
#: Characters outside links from which on a block whose name says several things counts as text.
LEAST_TEXT = 200
_TAG = re.compile(r"<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?>[^>=]|=\s*\"[^\"]*\"|=\s*'[^']*'|=)*+)(?:>|\Z)|<[!?][^>]*(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(\"[^\"]*\"?|'[^']*'?|[^\s>]+))?")
_PARTS = re.compile(r"[^a-z0-9]+")
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


#: How sure it is that an element is boilerplate: by its name among others, by its kind, whatever is in it.
WEAK, SOFT, HARD = 1, 2, 3


class Node:
    __slots__ = ("tag", "parent", "kids", "cut", "depth", "inner", "in_p", "chars", "link_chars", "tags", "link_tags", "density")

    def __init__(self, tag: str, parent: Node | None):
        self.tag, self.parent, self.kids, self.cut = tag, parent, [], 0
        self.depth = parent.depth + 1 if parent else 0
        self.inner = tag in ("article", "main") or parent is not None and parent.inner  # within an article
        #: The open p that a block would end.
        self.in_p = self if tag == "p" else None if parent is None or tag in SCOPE else parent.in_p
        self.chars = self.link_chars = self.tags = self.link_tags = 0
        self.density = 0.0


def attributes(source: str) -> dict[str, str]:
    """Lower-cased names and values of a start tag's attributes, the first of each name; no value: empty."""
    out: dict[str, str] = {}
    for name, value in _ATTR.findall(source):
        if value[:1] in ("'", '"'):
            value = value[1:].removesuffix(value[0])
        out.setdefault(name.lower(), value.lower())
    return out


def _named(value: str, names: frozenset) -> bool:
    """One of the names in a class or id is made of parts in ``names``, and nothing else that says something."""
    for name in value.split():
        parts = [x for x in _PARTS.split(name) if x]
        if not names.isdisjoint(parts) and all(x in names or x in NAMES or x in BESIDE or x[0].isdigit() for x in parts):
            return True
    return False


def _says_more(value: str) -> bool:
    """One of the names in a class or id has a part that is none of boilerplate or layout."""
    return any(x and x not in NAMES and x not in PAGE_NAMES and x not in BESIDE and not x[0].isdigit() for x in _PARTS.split(value))


def _boilerplate(node: Node, source: str) -> int:
    """0: none. WEAK, SOFT: unless densities speak against it. HARD: whatever is in it."""
    tag, outer = node.tag, node.parent
    found = SOFT if tag in AROUND or tag == "header" and not outer.inner else HARD if tag in DROPPED else 0
    if found == HARD or not source or tag in ("html", "body", "article", "main"):
        return found
    attrs = attributes(source)
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or _UNSEEN.search(attrs.get("style", "")):
        return HARD
    if attrs.get("role", "").strip() in ROLES:
        return SOFT
    if tag in NAMED:
        for value in (attrs.get("class", ""), attrs.get("id", "")):
            if _named(value, COMMENTS):
                return HARD
            if _named(value, NAMES) or _named(value, PAGE_NAMES) and not outer.inner:
                found = max(found, WEAK if _says_more(value) else SOFT)
    return found


def parse(html: str) -> Node:
    """The tree of elements and texts. Never fails: stray end tags are ignored, open elements end with
    the page. Every element is opened and closed once, and what a tag ends is found without a walk."""
    root = Node("#root", None)
    at, pos, size = root, 0, len(html)
    opened: dict[str, list[Node]] = {}  # open elements by tag, and those that end a scope
    scopes: list[int] = []

    def depth(tags) -> int:
        return max((opened[t][-1].depth for t in tags if opened.get(t)), default=-1)

    def close(to: int) -> None:
        """Close all elements at this depth and below."""
        nonlocal at
        while at.depth >= to:
            opened[at.tag].pop()
            if at.tag in SCOPE:
                scopes.pop()
            at = at.parent

    while pos < size:
        m = _TAG.search(html, pos)
        if m is None:
            at.kids.append(html[pos:])
            break
        if m.start() > pos:
            at.kids.append(html[pos : m.start()])
        pos = m.end()
        name = m.group(2)
        if name is None:
            continue
        tag = name.lower()
        if m.group(1):
            end = depth((tag,))
            if end > 0 and (tag in SCOPE or tag in ("html", "body") or not scopes or end > scopes[-1]):
                close(end)
            continue
        if tag in ("html", "body") and opened.get(tag):
            continue
        if tag == "body":  # ends an open head
            close(depth(("html",)) + 1 if opened.get("html") else 1)
        if tag in P_ENDS and at.in_p is not None:
            close(at.in_p.depth)
        if tag in SAME_END:
            stop = depth(STOPS[tag])
            while (end := depth(SAME_END[tag])) > stop:
                close(end)
                if tag not in ("tr", "tbody", "tfoot", "thead"):
                    break
        node = Node(tag, at)
        attrs = m.group(3)
        node.cut = _boilerplate(node, attrs)
        at.kids.append(node)
        if tag in VOID or attrs.endswith("/") and tag not in BLOCK and tag not in RAW:
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(html, pos)
            raw = html[pos : end.start() if end else size]
            node.kids.append(raw.replace("&", "&amp;") if tag == "xmp" else raw)
            pos = end.end() if end else size
            continue
        at = node
        opened.setdefault(tag, []).append(node)
        if tag in SCOPE:
            scopes.append(node.depth)
    return root


def _walk(root: Node) -> list[Node]:
    """The elements but for those whose kind has no text of the page, parents first."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack.extend(k for k in reversed(node.kids) if type(k) is Node and k.cut != HARD)
    return out


def measure(root: Node) -> list[Node]:
    """Counts and the composite density of every element of ``_walk``."""
    nodes = _walk(root)
    for node in reversed(nodes):
        for kid in node.kids:
            if type(kid) is str:
                node.chars += len("".join(kid.split()))
            elif kid.cut != HARD:
                node.chars += kid.chars
                node.link_chars += kid.link_chars
                node.tags += kid.tags + 1
                node.link_tags += kid.link_tags + (kid.tag == "a")
        if node.tag == "a":
            node.link_chars = node.chars
    whole = next((n for n in nodes if n.tag == "body"), root)
    ratio = whole.link_chars / whole.chars if whole.chars else 0.0
    for n in nodes:
        c, t, lc, lt = n.chars, max(1, n.tags), max(1, n.link_chars), max(1, n.link_tags)
        if not c:
            continue
        base = math.log(c / max(1, c - n.link_chars) * n.link_chars + ratio * c + math.e)
        n.density = max(0.0, c / t * math.log(max(c / lc * t / lt, 1.0) + 1.0) / base)
    return nodes


def density_sum(node: Node) -> float:
    return sum(k.density for k in node.kids if type(k) is Node and k.cut != HARD)


def _links(node: Node) -> bool:
    """Over a third of the element's characters are link text."""
    return 3 * node.link_chars > node.chars


def choose(root: Node) -> list[Node]:
    """The subtree of the largest density sum, sums within marked elements counting for MARKED of
    themselves, widened along the path to body by what stands beside it and belongs to it:

    * within an article or main, all of it, and of an article also the articles beside it;
    * running text, headings, lists and tables that are poor in links;
    * layout blocks of the path's smallest density or more that have JOINS of the choice's
      characters, and what stands between such blocks.

    Marked elements above the choice are released; those within it and what does not join are cut.
    """
    nodes = measure(root)
    body = next((n for n in nodes if n.tag == "body"), root)
    for n in nodes:  # a name among others only counts for blocks of few words or many links
        if n.cut == WEAK:
            n.cut = SOFT if _links(n) or n.chars - n.link_chars < LEAST_TEXT else 0
    best, most, marked = body, 0.0, {id(body): False}
    for n in _walk(body):
        inside = marked[id(n)] = n.cut == SOFT or n is not body and marked[id(n.parent)]
        total = MARKED * density_sum(n) if inside else sum(k.density * (MARKED if k.cut else 1.0) for k in n.kids if type(k) is Node and k.cut != HARD)
        if total > most:
            best, most = n, total
    if not most:
        return [body]
    # running text stands for the block that it is in
    while best is not body and best.tag not in LAYOUT and best.tag not in ("article", "main") and best.parent is not body:
        best = best.parent
    threshold, path = best.density, [best]
    while path[-1] is not body:
        threshold = min(threshold, path[-1].density)
        path[-1].cut = 0
        path.append(path[-1].parent)
    article = next((n for n in reversed(path) if n.tag == "main"), None) or next((n for n in reversed(path) if n.tag == "article"), None)
    if article is not None:
        if article.tag == "main":
            return [article]
        return [k for k in article.parent.kids if type(k) is Node and not k.cut and k.chars and (k is article or k.tag == "article")]
    top, cut, passed = best, [], []
    for at, up in zip(path, path[1:], strict=False):
        joins = []
        for k in up.kids:
            if type(k) is str:
                joins.append(any(map(str.isalnum, unescape(k))))
            else:
                joins.append(k is at or not k.cut and k.chars > 0 and not (k.tag in BLOCK and _links(k)) and (k.tag not in LAYOUT or k.density >= threshold and k.chars >= JOINS * best.chars))
        on = [i for i, (k, j) in enumerate(zip(up.kids, joins, strict=True)) if j or k is at]
        for i, k in enumerate(up.kids):
            if type(k) is Node and not joins[i] and k.tag in BLOCK and (_links(k) or not on[0] < i < on[-1]):
                passed.append(k)
        if len(on) > 1:
            top, cut = up, passed[:]
    for n in cut:
        n.cut = n.cut or SOFT
    return [top]


def text_of(node: Node) -> str:
    """The element's text: one line for each block, white space within it as one space."""
    blocks: list[list[str]] = [[]]
    stack: list = [node]
    while stack:
        x = stack.pop()
        if type(x) is str:
            blocks[-1].append(unescape(x))
        elif x is None:
            blocks.append([])
        elif not x.cut or x is node:
            if x.tag == "br":
                blocks[-1].append(" ")
                continue
            if x.tag in BLOCK:
                blocks.append([])
                stack.append(None)
            stack.extend(reversed(x.kids))
    lines = (" ".join("".join(b).split()) for b in blocks)
    return "\n".join(x for x in lines if x)


def extract(html: str | None) -> str:
    """Main text of a page; empty for null, empty and textless pages."""
    if not html:
        return ""
    root = parse(html)
    return "\n".join(x for x in map(text_of, choose(root)) if x)


def extract_pages(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` without html, with ``text`` and ``n_chars`` (code points). Row by row: ties, repeated
    rows and empty tables need no care; a column named text or n_chars is replaced."""
    keep = [f for f in pages.schema.fields if f.name != html_col and f.name.lower() not in ("text", "n_chars")]
    names = [f.name for f in keep]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keep) + (", " if keep else "") + "text string, n_chars long"

    def run(batches):
        for b in slices(batches):
            texts = [extract(x) for x in b.column(len(names)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], names=[*names, "text", "n_chars"])

    return pages.select(*[f"`{n}`" for n in names], f"`{html_col}`").mapInArrow(run, schema)


def op10_query(spark, sf_dir) -> DataFrame:
    return extract_pages(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))


def op10_sql() -> str:
    """The blocks of each page's article, which every page of the test tables has; elements and references are those that occur there."""
    return r"""
with p as (select page_id, url, regexp_extract(html, '<article>(.*?)</article>', 1, 's') as body from pages),
b as (select page_id, url, list_filter(list_transform(regexp_split_to_array(replace(body, '<br>', ' '), '</?(?:p|h1|div|ul|li)>'),
        lambda x: trim(regexp_replace(replace(replace(replace(replace(replace(regexp_replace(x, '<[^>]*>', '', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'), '\s+', ' ', 'g'))), lambda x: x <> '') as blocks from p)
select page_id, url, array_to_string(blocks, chr(10)) as text, length(array_to_string(blocks, chr(10)))::bigint as n_chars from b
"""
