"""HTML main-text extraction by composite text density (operator 4).

A page becomes a DOM tree.  For every node the characters per tag are adjusted
by its links: a node full of link text is pulled down by the ratio of link to
other characters and by the page's own link share.  The density sum of a node is
the sum over its children; the subtree of the largest sum is the main text, and
the smallest density on its path up to the body is the threshold by which other
subtrees join it.  Elements that say what they are (navigation, forms, scripts,
notices, adverts, comments, ...) are left out before densities are taken, and a
selected node inside an ``article`` or ``main`` stands for that whole element.

Defined results: null or empty html, and pages without any text, give an empty
text; truncated or unclosed markup is read as far as it goes; unknown character
references stay as they are; very long pages are read whole, in time linear in
their length; repeated pages are repeated results.  Only the named columns are
read.  Narrow: one pass, no shuffle.
"""

from __future__ import annotations

import html as entities
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLICE_ROWS = 64

# Element names of the HTML standard by their role.
VOID = set("area base br col embed frame hr img input link meta param source track wbr".split())
RAW_TEXT = set("script style textarea title xmp iframe noembed noframes".split())
DROPPED = set("""head title script style noscript template nav footer aside form button select option input textarea label
    iframe object embed svg math canvas audio video map menu dialog noembed noframes datalist""".split())
BLOCKS = set("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer
    form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table caption
    tbody td tfoot th thead tr ul""".split())
CONTAINERS = set("article blockquote body center div dl figure html main ol root section table tbody td tr ul".split())
CLOSES_P = BLOCKS - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "li", "dd", "dt"}
# an opening tag closes these open elements, searched up to the given border elements
IMPLIED_END = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
               "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
               "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "option": ({"option"}, {"select"})}
IMPLIED_END["tfoot"] = IMPLIED_END["thead"] = IMPLIED_END["tbody"]
# Words in class, id or role of what is no article, for certain and perhaps.
CERTAIN = set("""ad ads advert adverts advertisement advertising adbox adsense sponsor sponsored cookie cookies consent gdpr popup
    modal overlay paywall newsletter subscribe subscription signup sidebar sidebars nav navbar navigation menu menus breadcrumb
    breadcrumbs pagination pager comment comments commentlist respond replies disqus share sharing social""".split())
PERHAPS = set("""promo promotion banner notice notices alert aside toolbar footer header masthead topbar reactions discussion related
    recommended recommendations widget widgets complementary contentinfo search""".split())
# First words of names that tell how a page is laid out
LAYOUT = {"no", "not", "has", "with", "without", "is"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6", "hgroup"}
MOST_OF_PAGE = 0.5            # a marked element with so much of the page's text is a frame around it
LINKED = 0.3                  # share of link text of what is perhaps no article
SHORT = 0.1                   # or its share of the page's text, if it holds no heading

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']|"[^"]*+"|'[^']*+')*+)>"""
                 r"""|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)""", re.S)
NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
WORDS = re.compile(r"[a-z]+")


class Node:
    __slots__ = ("tag", "parent", "children", "attrs", "chars", "tags", "link_chars", "link_tags", "density", "inside", "headed")

    def __init__(self, tag: str, parent: "Node | None", attrs: str = ""):
        self.tag, self.parent, self.attrs = tag, parent, attrs
        self.children: list[Node | str] = []


def parse(page: str) -> Node:
    """A DOM tree; the root stands for the whole page."""
    root = here = Node("root", None)
    open_tags: dict[str, int] = {}
    lowered = None

    def close_to(node: Node) -> Node:
        """Leave ``node`` and all that is open inside it."""
        at = here
        while True:
            open_tags[at.tag] -= 1
            if at is node:
                return at.parent
            at = at.parent

    at, size = 0, len(page)
    while at < size:
        found = TAG.search(page, at)
        if not found:
            here.children.append(page[at:])
            break
        if found.start() > at:
            here.children.append(page[at:found.start()])
        at = found.end()
        tag = found[2] or found[5]
        if tag is None:
            if found[0].startswith("<![CDATA["):
                here.children.append(entities.escape(found[0][9:].removesuffix("]]>")))
            continue
        tag = tag.lower()
        if found[1] or found[4]:                                   # an end tag
            if open_tags.get(tag):
                node = here
                while node.tag != tag:
                    node = node.parent
                here = close_to(node)
            continue
        attrs = found[3] or found[6] or ""
        if tag in CLOSES_P and open_tags.get("p"):
            node = here
            while node.tag != "p":
                node = node.parent
            here = close_to(node)
        if tag in IMPLIED_END:
            closes, border = IMPLIED_END[tag]
            node, outermost = here, None
            if any(open_tags.get(c) for c in closes):
                while node.parent and node.tag not in border:
                    outermost = node if node.tag in closes else outermost
                    node = node.parent
            if outermost:
                here = close_to(outermost)
        node = Node(tag, here, attrs)
        here.children.append(node)
        if tag in VOID or attrs.endswith("/") and tag not in BLOCKS and tag not in RAW_TEXT:
            continue
        if tag in RAW_TEXT:
            lowered = lowered or page.lower()
            end = lowered.find("</" + tag, at) if len(lowered) == size else page.find("</" + tag, at)
            end = size if end < 0 else end
            node.children.append(page[at:end])
            close = page.find(">", end)
            at = size if close < 0 else close + 1
            continue
        here = node
        open_tags[tag] = open_tags.get(tag, 0) + 1
    return root


def in_order(root: Node) -> list[Node]:
    """All nodes, parents first."""
    nodes = [root]
    for node in nodes:
        nodes.extend(c for c in node.children if isinstance(c, Node))
    return nodes


def dropped(node: Node) -> bool:
    """Is the element no article text by its tag, or hidden?"""
    if node.tag in DROPPED:
        return True
    if node.tag == "header":        # a page's header; an article's own header holds its heading
        return not node.inside
    return bool(node.attrs and node.tag not in KEPT and HIDDEN.search(node.attrs))


KEPT = {"html", "body", "article", "main"}


def mark(node: Node) -> str:
    """What an element's names say: "certain" (one word), "likely" (a word of a compound), "perhaps" or nothing.

    A heading's or section's id is made from its words, so only other elements are marked by their id; names such as
    ``no-sidebar`` describe the page's layout."""
    if not node.attrs or node.tag in KEPT or node.tag in HEADINGS:
        return ""
    found = ""
    for m in NAMES.finditer(node.attrs):
        if m[1].lower() == "id" and (node.tag == "section" or node.inside and node.tag not in ("div", "ul", "ol")):
            continue
        for name in (m[2] or m[3] or m[4] or "").lower().split():
            words = WORDS.findall(name)
            if words and words[0] in LAYOUT:
                continue
            if len(words) == 1 and words[0] in CERTAIN:
                return "certain"
            if any(w in CERTAIN for w in words):
                found = "likely"
            if any(w in PERHAPS for w in words):
                found = found or "perhaps"
    return found


def prune(root: Node) -> None:
    """Take out what is no article: by tag or hidden first; then what its names mark, if its share of the page's text and of links
    does not speak against it.  An element around a whole article stays."""
    nodes = in_order(root)
    holds = set()
    for node in nodes:
        if node.tag in ("article", "main"):
            up = node.parent
            while up and id(up) not in holds:
                holds.add(id(up))
                up = up.parent
    for node in nodes:
        node.inside = node.parent is not None and (node.parent.inside or node.parent.tag in ("article", "main"))
    for node in nodes:
        node.children = [c for c in node.children if isinstance(c, str) or id(c) in holds and c.tag not in RAW_TEXT or not dropped(c)]
    nodes = in_order(root)
    measure(nodes)
    for node in reversed(nodes):
        node.headed = node.tag in HEADINGS or any(c.headed for c in node.children if isinstance(c, Node))
    page = max(1, root.chars)

    def goes(node: Node) -> bool:
        kind = mark(node)
        if not kind or id(node) in holds:
            return False
        links, share = node.link_chars / max(1, node.chars), node.chars / page
        if kind == "certain" or links >= LINKED:
            return True
        if share >= MOST_OF_PAGE:
            return False
        if kind == "likely":
            return True
        return share < SHORT and not node.headed

    for node in nodes:
        node.children = [c for c in node.children if isinstance(c, str) or not goes(c)]


def measure(nodes: list[Node]) -> None:
    """Characters, tags, link characters and link tags of every subtree, then its composite density."""
    for node in reversed(nodes):
        node.chars = node.tags = node.link_chars = node.link_tags = 0
        for c in node.children:
            if isinstance(c, str):
                node.chars += len("".join(c.split()))
            else:
                node.chars += c.chars
                node.tags += 1 + c.tags
                node.link_chars += c.chars if c.tag == "a" else c.link_chars
                node.link_tags += c.link_tags + (c.tag == "a")
    page = nodes[0]
    link_share = page.link_chars / page.chars if page.chars else 0.0
    for node in nodes:
        per_tag = node.chars / max(1, node.tags)
        if not node.chars:
            node.density = 0.0
            continue
        other = max(1, node.chars - node.link_chars)
        base = math.log(node.chars / other * node.link_chars + link_share * node.chars + math.e)
        if base <= 1.0:                 # no link on the page: plain characters per tag
            node.density = per_tag
        else:
            ratio = node.chars / max(1, node.link_chars) * max(1, node.tags) / max(1, node.link_tags)
            node.density = per_tag * math.log(max(ratio, 1.0)) / math.log(base) if math.log(base) > 0 else per_tag


def select(root: Node) -> list[Node]:
    """The subtrees that make up the main text, in page order."""
    nodes = in_order(root)
    body = next((n for n in nodes if n.tag == "body"), root)
    nodes = in_order(body)
    measure(nodes)

    def best_in(top: Node) -> Node:
        """The container with the largest density sum; the outermost of equals."""
        return max((n for n in in_order(top) if n.tag in CONTAINERS),
                   key=lambda n: sum(c.density for c in n.children if isinstance(c, Node)), default=top)

    def whole(node: Node) -> Node:
        """The outermost article or main element around a node."""
        kept, up = node, node
        while up is not None:
            kept = up if up.tag in ("article", "main") else kept
            up = up.parent
        return kept

    best = best_in(body)
    path, up = [], best
    while up is not None and up is not body:
        path.append(up.density)
        up = up.parent
    threshold = min([*path, body.density])
    best = whole(best)
    taken = {id(best)}
    out, around, up = [], set(), best.parent
    while up is not None:
        around.add(id(up))
        up = up.parent
    # page order: walk down beside the selected subtree, taking other dense containers
    stack = [body]
    while stack:
        node = stack.pop()
        if id(node) in taken:
            out.append(node)
        elif id(node) in around:
            stack.extend(c for c in reversed(node.children) if isinstance(c, Node))
        elif node.density >= threshold > 0 and node.tag in BLOCKS and best.tag not in ("article", "main"):
            out.append(node)
        elif node.tag in ("article", "main") and node.chars and best.tag == node.tag and best.parent is node.parent:
            out.append(node)
    return out


def blocks(nodes: list[Node]) -> list[str]:
    """The texts of the blocks below ``nodes``: references decoded, white space single, trimmed."""
    out: list[str] = []
    parts: list[str] = []

    def flush():
        text = " ".join("".join(parts).split())
        if text:
            out.append(text)
        parts.clear()

    stack: list = [*reversed(nodes)]
    while stack:
        item = stack.pop()
        if isinstance(item, str):
            parts.append(entities.unescape(item))
        elif item is None:
            flush()
        elif item.tag == "br":
            parts.append(" ")
        else:
            block = item.tag in BLOCKS
            if block:
                flush()
                stack.append(None)
            stack.extend(reversed(item.children))
    flush()
    return out


def main_text(page: str | None) -> str:
    if not page:
        return ""
    root = parse(page)
    prune(root)
    return "\n\n".join(blocks(select(root)))


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", carry: tuple[str, ...] = ("url",)) -> DataFrame:
    """(id, carried columns, ``text``) for every row."""
    names = [id_col, *carry]
    rows = pages.select(F.col(html_col).cast("string").alias("page"), *[F.col(n).alias(f"c{i}") for i, n in enumerate(names)])
    kept = rows.drop("page")
    schema = kept.withColumn("text", F.lit("")).schema

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                texts = pa.array([main_text(p) for p in part.column("page").to_pylist()], pa.string())
                rest = part.drop_columns(["page"])
                yield rest.append_column("text", texts)

    out = rows.mapInArrow(run, schema)
    return out.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names)], "text")
