"""Main text of web pages by composite text density.

Every DOM node gets a density: characters per tag, adjusted by how much of them are link text and how that compares
with the page's body.  What a node is called (its element, class or id) is evidence: it lowers the weight at which its
density counts, but removes nothing by itself, save the elements that cannot hold an article.  Names that speak of menus,
sidebars, adverts and the like, and being a form, are no evidence against a node that holds two thirds of the page's
unlinked text and all of its articles, since layouts are named after their parts; names of reader comments always are.  A
node's density sum adds
up its children's weighted densities.  The subtree with the largest sum is the core; the least density on the path from
it to the body is the threshold that other subtrees, loose text beside the core, and doubtful nodes inside it must reach.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import map_batches

TAG_START = re.compile(r"<(?=!--|[!?]|/?[a-zA-Z])")
TAG_STOP = re.compile("[>\"']")
NAME = re.compile(r"</?([^\s/>]+)")
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
UNSHOWN = re.compile(r"(?i)display\s*:\s*none")

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes template xmp svg math".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
BLOCK_ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "tbody": ("tr", "td", "th", "thead", "tbody"), "tfoot": ("tr", "td", "th", "tbody")}
SCOPE = frozenset("html body article aside div section main table td th ul ol dl blockquote nav header footer form button object caption".split())
#: Elements that hold menus, sidebars, forms, scripts or styles by their definition; a header inside an article does not.
FURNITURE_TAGS = frozenset("nav header footer aside form button select option menu dialog label input".split()) | RAW
#: Words in a class, id or role: of what stands beside an article, and of what may also be a part of one.
CERTAIN = frozenset(
    "ad ads adv advert adverts advertisement advertising banner promo promotion sponsor sponsored nav navbar navigation menu menubar breadcrumb breadcrumbs "
    "sidebar footer masthead topbar toolbar pagination pager comment comments commentlist disqus cookie cookies consent gdpr newsletter contentinfo complementary".split()
)
POSSIBLE = frozenset(
    "sponsoring aside widget foot header head related recommended recommendations share sharing social reply replies respond notice notices popup modal overlay "
    "subscribe subscription signup login search skip copyright".split()
)
#: Words of reader comments; words that say of a layout what it has or lacks, before or after the part's name.
COMMENTS = frozenset("comment comments commentlist disqus reply replies respond".split())
BEFORE, AFTER = frozenset("no with without has have hide show not".split()), frozenset("free less off".split())
NAMING = ("class", "id", "role", "aria-label", "itemtype")
WEIGHT_CERTAIN, WEIGHT_POSSIBLE = 0.02, 0.7
CONTAINERS = frozenset("article main section div body td center".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 header hgroup".split())
#: As in browsers, elements nested deeper become children of the node at this depth, so no walk upwards is long.
MOST_DEPTH = 512


class Node:
    __slots__ = ("tag", "attrs", "parent", "depth", "children", "chars", "tags", "link_chars", "link_tags", "density", "weight", "total", "unlinked", "shut", "mains")

    def __init__(self, tag: str, attrs: str = "", parent: Node | None = None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.depth = parent.depth + 1 if parent else 0
        self.children: list[Node | str] = []

    def attributes(self) -> dict[str, str]:
        return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(self.attrs)} if self.attrs else {}

    def closed(self) -> bool:
        """Whether this can't be article text whatever it holds: an element for something else, or a hidden one."""
        if self.tag in FURNITURE_TAGS and self.tag != "form":
            return self.tag != "header" or not self.inside("article", "main")
        if not self.attrs or self.tag in ("body", "html"):
            return False
        said = self.attributes()
        return "hidden" in said or said.get("aria-hidden", "").lower() == "true" or bool(UNSHOWN.search(said.get("style", "")))

    def names(self) -> set[str]:
        """Words of its class, id and role, without those by which a layout says what it has or lacks."""
        out: set[str] = set()
        said = self.attributes()
        for token in " ".join(said.get(a, "") for a in NAMING).split():
            parts = [w for w in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", token).lower()) if w]
            if not (len(parts) > 1 and (parts[0] in BEFORE or parts[-1] in AFTER)):
                out.update(parts)
        return out

    def evidence(self, body: Node) -> float:
        """The weight that element and names leave the node: 1 where they say nothing, 0 where it cannot be article text."""
        page = self.unlinked * 3 > body.unlinked * 2 and self.mains == body.mains
        if self.shut:
            return 0.0
        if self.tag == "form":
            return 1.0 if page else 0.0
        if not self.attrs or self.tag in ("body", "html", "article", "main"):
            return 1.0
        words = self.names() & (COMMENTS if page else CERTAIN | POSSIBLE)
        return WEIGHT_CERTAIN if words & CERTAIN else WEIGHT_POSSIBLE if words & POSSIBLE else 1.0

    def inside(self, *tags: str) -> bool:
        node = self.parent
        while node:
            if node.tag in tags:
                return True
            node = node.parent
        return False


def tokens(page: str) -> Iterator[tuple[int, int]]:
    """Start and end of every tag and comment, in time that grows with the page.

    A quote that never closes, or quotes that hide the end of every tag, are not to be trusted from there on; a tag that
    never ends is text, as is all after it; a comment that never ends takes the rest.
    """
    at, quotes = 0, True
    while m := TAG_START.search(page, at):
        start = m.start()
        if page.startswith("<!--", start):
            short = next((x for x in (">", "->") if page.startswith(x, start + 4)), None)
            end = start + 4 + len(short) if short else page.find("-->", start + 4) + 3
            at = end if end > 2 else len(page)
        elif page[start + 1] in "!?":
            at = page.find(">", start) + 1 or len(page)
        else:
            end = start + 1
            while quotes and (q := TAG_STOP.search(page, end)) and q[0] != ">":
                end = page.find(q[0], q.end()) + 1
                quotes = end > 0
            quotes = quotes and bool(q)
            end = q.end() if quotes else page.find(">", start) + 1
            if not end:
                return
            at = end
        yield start, at


def tree(page: str) -> Node:
    """The DOM, with the implied end tags of HTML; comments and the content of raw elements are left out."""
    root = node = Node("html")
    at, n = 0, len(page)
    opened: Counter[str] = Counter()  # elements of each name between the root and here

    def leave(place: Node) -> Node:
        up = node
        while up is not place:
            opened[up.tag] -= 1
            up = up.parent
        return place

    for start, end in tokens(page):
        if start < at:  # inside a script or the like
            continue
        if start > at:
            node.children.append(html.unescape(page[at:start]))
        at, token = end, page[start:end]
        if token[1] in "!?":
            continue
        tag = NAME.match(token)[1].lower()
        if token[1] == "/":
            if not opened[tag] or (tag == "p" and not _open(node, "p")):
                continue
            up = node
            while up and up.tag != tag:
                up = up.parent
            if up and up.parent:
                node = leave(up.parent)
            continue
        if tag == "html" or (tag == "body" and opened["body"]):
            continue
        if tag == "body":
            node = leave(root)
        if tag in RAW and not token.endswith("/>"):
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = end.end() if end else n
            continue
        if tag in BLOCK_ENDS_P and opened["p"]:
            node = leave(_close(node, ("p",)))
        if tag in CLOSES and any(opened[t] for t in CLOSES[tag]):
            node = leave(_close(node, CLOSES[tag]))
        new = Node(tag, token[1 + len(tag) : -1], node)
        node.children.append(new)
        if tag not in VOID and not token.endswith("/>") and new.depth < MOST_DEPTH:
            node = new
            opened[tag] += 1
    if at < n:
        node.children.append(html.unescape(page[at:]))
    return root


def _open(node: Node | None, tag: str) -> bool:
    while node:
        if node.tag == tag:
            return True
        if node.tag in SCOPE and tag == "p":
            return False
        node = node.parent
    return False


def _close(node: Node, tags: tuple[str, ...]) -> Node:
    """The place after closing the innermost open element of ``tags``, or ``node`` where none is open in its scope."""
    found, up = None, node
    while up and up.parent:
        if up.tag in tags:
            found = up
            if len(tags) == 1 or up.tag == tags[0]:
                break
        elif up.tag in SCOPE and up.tag not in ("td", "th"):
            break
        up = up.parent
    return found.parent if found else node


def _walk(root: Node) -> list[Node]:
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo.extend(c for c in reversed(node.children) if isinstance(c, Node))
    return out


def measure(root: Node) -> list[Node]:
    """All nodes in page order, with their counts, densities, weights and density sums.

    What cannot be article text counts neither for its own node nor for those around it.
    """
    nodes = _walk(root)
    for node in nodes:
        node.shut = node.parent.shut if node.parent else False
        node.shut = node.shut or node.closed()
    for node in reversed(nodes):
        own = sum(len("".join(c.split())) for c in node.children if isinstance(c, str))
        below = sum(c.unlinked for c in node.children if isinstance(c, Node))
        node.unlinked = 0 if node.shut or node.tag == "a" else own + below
        node.mains = sum(c.mains for c in node.children if isinstance(c, Node)) + (node.tag in ("article", "main") and node.unlinked > 0)
    for node in nodes:
        node.weight = (node.parent.weight if node.parent else 1.0) * node.evidence(root)
    for node in reversed(nodes):  # children before parents
        own = sum(len("".join(c.split())) for c in node.children if isinstance(c, str))
        below = [c for c in node.children if isinstance(c, Node) and c.weight]
        node.chars = own + sum(c.chars for c in below)
        node.tags = sum(c.tags + 1 for c in below)
        node.link_chars = node.chars if node.tag == "a" else sum(c.link_chars for c in below)
        node.link_tags = sum(c.link_tags + (c.tag == "a") for c in below)
    ratio = root.link_chars / max(1, root.chars)
    for node in nodes:
        node.density = density(node.chars, node.tags, node.link_chars, node.link_tags, ratio)
    for node in nodes:
        node.total = sum(c.density * c.weight for c in node.children if isinstance(c, Node))
    return nodes


def density(chars: int, tags: int, link_chars: int, link_tags: int, ratio: float) -> float:
    """Characters per tag, weighted by a logarithm to a base that grows with the share of links."""
    if not chars:
        return 0.0
    tags = max(1, tags)
    base = math.log(chars / max(1, chars - link_chars) * link_chars + ratio * chars + math.e)
    inner = chars / max(1, link_chars) * tags / max(1, link_tags)
    return chars / tags * (math.log(max(1.0, inner) + 1) / math.log(max(base, 1.5) + 1))


def blocks(parts: list[Node | str], threshold: float) -> list[str]:
    """Text of the parts, cut at block boundaries; nodes in them that are more doubtful than they must reach the threshold."""
    out: list[list[str]] = [[]]
    todo: list[tuple[Node | str | None, float]] = [(x, x.weight if isinstance(x, Node) else 1.0) for x in reversed(parts)]
    while todo:
        item, trust = todo.pop()
        if item is None:
            out.append([])
        elif isinstance(item, str):
            out[-1].append(item)
        elif item.tag == "br":
            out[-1].append(" ")
        elif item.weight < trust and item.density * item.weight < threshold * trust:
            continue
        else:
            if item.tag not in INLINE:
                out.append([])
                todo.append((None, trust))
            todo.extend((c, trust) for c in reversed(item.children))
    return [t for t in (" ".join("".join(b).split()) for b in out) if t]


def beside(node: Node, path: set[int], core: Node, threshold: float, ratio: float) -> list[Node | str]:
    """What is chosen of a node on the way to the core, in page order.

    Its children, loose text and inline elements in a row being one, are chosen when they reach the threshold; a
    heading before a chosen one goes with it, and what nothing speaks against and stands between two chosen ones does too.
    """
    items: list[tuple[list[Node | str], bool, bool, bool]] = []  # parts, chosen, heading, nothing speaks against it
    run: list[Node | str] = []

    def end_run() -> None:
        texts = "".join(c if isinstance(c, str) else " ".join(blocks([c], threshold)) for c in run)
        n = len("".join(texts.split()))
        if n:
            nodes = [c for c in run if isinstance(c, Node)]
            linked, links = sum(c.link_chars for c in nodes), sum(c.link_tags + (c.tag == "a") for c in nodes)
            items.append((list(run), density(n, len(nodes), linked, links, ratio) >= threshold, False, linked * 2 < n))
        run.clear()

    for c in node.children:
        if isinstance(c, str) or (c.tag in INLINE and id(c) not in path and c.weight == 1):
            run.append(c)
            continue
        if c.tag == "br":
            run.append(c)
            continue
        end_run()
        if c is core:
            items.append(([c], True, False, True))
        elif id(c) in path:
            items.append((beside(c, path, core, threshold, ratio), True, False, True))
        elif c.chars and c.weight:
            items.append(([c], c.density * c.weight >= threshold, c.tag in HEADINGS, c.weight == 1 and c.link_chars * 2 < c.chars))
    end_run()
    chosen = [i for i, x in enumerate(items) if x[1]]
    out: list[Node | str] = []
    for i, (parts, good, heading, clear) in enumerate(items):
        between = bool(chosen) and chosen[0] < i < chosen[-1]
        if good or (clear and (between or (heading and i + 1 < len(items) and items[i + 1][1]))):
            out += parts
            if isinstance(parts[-1], str) or parts[-1].tag in INLINE:
                out.append(Node("div"))  # a boundary after loose text
                out[-1].weight = out[-1].density = 1.0
    return out


def main_text(page: str | None) -> str:
    """The main text, its blocks joined by one space; empty for null, empty and text-free pages."""
    if not page:
        return ""
    root = tree(page)
    body = next((n for n in root.children if isinstance(n, Node) and n.tag == "body"), root)
    body.parent = None
    nodes = measure(body)
    if not body.chars:
        return ""
    core = max((n for n in nodes if n.weight), key=lambda n: n.total * n.weight)  # the first of equals, so the outermost
    while core.parent and core.tag not in CONTAINERS:
        core = core.parent
    path, up = [core], core
    while up.parent:
        up = up.parent
        path.append(up)
    threshold = min(n.density for n in path)
    if core is body:
        return " ".join(blocks([body], threshold))
    return " ".join(blocks(beside(body, set(map(id, path)), core, threshold, body.link_chars / max(1, body.chars)), threshold))


def extract_text(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row: the id, the url, ``text`` and ``n_chars`` (code points).

    Map-only, whole pages, in time that grows with the page also where tags never end or nest without bound.  Null and
    empty pages give the empty text; broken markup is read as far as it goes; of equal density sums the outermost counts;
    repeated rows are extracted each; an empty table gives an empty result; other columns are not read.
    """
    id_type, url_type = (df.schema[c].dataType.simpleString() for c in (id_col, url_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p) for p in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[id_col, url_col, "text", "n_chars"])

    return map_batches(df.select(id_col, url_col, html_col), run, f"`{id_col}` {id_type}, `{url_col}` {url_type}, text string, n_chars long")
