"""Main text of web pages by composite text density.

A page becomes a tree. Elements that are boilerplate by their nature (menus, forms, scripts,
hidden ones) or by name (class, id, role) are left out with all they hold. A class or id has
to be such a name as a whole, or to consist of such words and COMPANIONS. No element is left
out by name that holds an article or main element (other than articles that are so named
themselves, such as comments) or, on pages without any, most of the text. Of a header in an
article its headings stay.

For every other element the characters, tags, link characters and link tags of its subtree
give its composite density: characters per tag, times a logarithm that falls with the share
of links in it. The element whose children's densities have the largest sum is the core,
whatever its name. The least density on its path to the body is the threshold: beside that
path, subtrees that reach it are text as well, and so is what stands directly in the path's
elements, which all reach it. Where the path lies in an article or main element, subtrees
below the threshold stay, too, unless they are mostly links: short paragraphs have few
characters per tag.

Inside a block white space (no-break and other blanks of Unicode included) becomes one
space; blocks are joined in page order by an empty line. Defined cases: null or empty html
gives an empty text; unclosed elements end where their parent ends; broken markup is text;
html of any length is parsed as a whole, in memory that grows with it; repeated rows each
give their row; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from poiloom.llm.common import own_names, small_batches

#: One match is a comment, a declaration, an element whose content is no markup, or a tag.
MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(?:svg|math)(?=[\s/>])(?:[^>"']|"[^"]*"|'[^']*')*/>|<(script|style|noscript|template|textarea|title|iframe|svg|math|select|object|canvas|audio|video)(?=[\s/>])[^>]*>(?:.*?</\1\s*>|.*\Z)|<[!?][^>]*>|<(/?)([a-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""",
    re.DOTALL | re.IGNORECASE,
)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?|"[^"]*"|'[^']*'""")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that stand within a line of text.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img br".split())
#: Elements left out by nature.
BOILERPLATE = frozenset("nav header footer aside form button menu dialog head fieldset input".split())
#: Classes, ids and roles that mark what is left out.
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs sidebar footer comments comment commentlist disqus replies notice notices cookie cookies consent gdpr popup modal overlay newsletter subscribe subscription social share sharing related recommended widget login signup pagination pager skip".split()
)
WHOLE_NAMES = frozenset("header site-header page-header masthead topbar search searchbox toolbar alert".split())
#: Words that may stand beside NAMES in a class or id.
COMPANIONS = frozenset("site page main top bottom left right primary secondary global header list section block box slot unit links buttons button icons bar container wrapper form item items posts articles body text inner".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
#: A start tag ends an open element of the second set, up to the nearest of the third.
ENDS = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
}
BLANK = " \t\n\r\f\v"
#: Elements that hold an article as a whole.
WHOLE = frozenset(["article", "main"])
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


class Node:
    """An element: its own blocks and children in order, and its subtree's counts."""

    __slots__ = ("tag", "parent", "items", "out", "chars", "tags", "link_chars", "link_tags", "density", "named", "inline", "inside")

    def __init__(self, tag: str, parent: Node | None, out: bool, named: bool = False, inline: bool = False):
        self.tag, self.parent, self.out, self.named, self.inline = tag, parent, out, named, inline
        #: whether an article or main element is around it
        self.inside = parent is not None and (parent.inside or parent.tag in WHOLE)
        self.items: list = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = 0.0


def bad_name(name: str) -> bool:
    """Whether a class or id, in lower case, marks what is left out."""
    if name in NAMES or name in WHOLE_NAMES:
        return True
    words = {w for w in re.split(r"[^a-z]+", name) if len(w) > 1}
    return not words.isdisjoint(NAMES) and words <= NAMES | COMPANIONS


def left_out(tag: str, attributes: str) -> tuple[bool, bool]:
    """Whether an element is left out by its nature, and whether by its name."""
    if tag in BOILERPLATE:
        return True, False
    if not attributes or tag in ("html", "body"):
        return False, False
    named = hidden = False
    for m in ATTRIBUTE.finditer(attributes):
        name, value = (m[1] or "").lower(), (m[2] or m[3] or m[4] or "").lower()
        if name in ("class", "id"):
            named = named or any(map(bad_name, value.split()))
        elif name == "role":
            named = named or value in ROLES
        elif name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
            hidden = True
    return hidden and tag not in WHOLE, named


def parse(page: str) -> Node:
    """The page's tree; what is left out is not in it. An element's items are texts of blocks and child elements."""
    root = Node("html", None, False)
    node, pieces, links = root, [], 0
    at = 0

    def flush() -> None:
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                node.items.append(text)
                node.chars += len(text)
            pieces.clear()

    for m in MARKUP.finditer(page):
        start = m.start()
        if start > at and not node.out:
            pieces.append(page[at:start])
            if links:
                node.link_chars += len(page[at:start].strip(BLANK))
        at = m.end()
        tag = m[3]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in INLINE:
            if (node.out or node.inline) and node.tag == tag:  # within a line's part that is left out: it may hold others of its name
                if not node.out:
                    flush()
                    links = 0
                if m[2]:
                    node = node.parent
                else:
                    node.tags += 1
                    child = Node(tag, node, node.out, inline=True)
                    if not child.out:
                        node.items.append(child)
                    node = child
                continue
            if node.out:
                continue
            if tag == "br":
                pieces.append(" ")
                node.tags += 1
                continue
            if m[2]:
                if tag == "a" and links:
                    links -= 1
                continue
            node.tags += 1
            if tag == "a":
                node.link_tags += 1
                links += 1
            elif tag not in VOID and m[4] and any(why := left_out(tag, m[4])):
                # a line's part that is left out: it becomes an element of its own, up to its end tag
                flush()
                child = Node(tag, node, *why, inline=True)
                if not child.out:
                    node.items.append(child)
                node = child
            continue
        if not node.out:
            flush()
            links = 0
        if m[2]:
            up = node
            while up is not None and up.tag != tag:
                up = up.parent
            if up is not None and up is not root:
                node = up.parent
            continue
        if tag in ("html", "body") or tag in VOID:
            if not node.out:
                node.tags += 1
            if tag == "body":
                while node is not root:  # an unclosed head ends here
                    node = node.parent
            continue
        if node.tag == "p":
            node = node.parent
        elif tag in ENDS:
            own, limits = ENDS[tag]
            up = node
            while up is not root and up.tag not in limits and up.tag not in own:
                up = up.parent
            if up.tag in own:
                node = up.parent
        nature, named = left_out(tag, m[4])
        child = Node(tag, node, node.out or nature, named)
        if tag == "header" and child.inside and not node.out:
            child.out = False
        if not child.out:
            node.items.append(child)
        node = child
    if at < len(page) and not node.out:
        pieces.append(page[at:])
        flush()
    elif not node.out:
        flush()
    leave_out_named(root)
    keep_headings(root)
    return root


def keep_headings(root: Node) -> None:
    """Leaves only headings in the headers of articles."""
    order = [root]
    for n in order:
        if n.tag == "header":
            headings, todo = [], list(reversed(n.items))
            while todo:
                x = todo.pop()
                if type(x) is Node and x.tag in HEADINGS:
                    x.parent = n
                    headings.append(x)
                elif type(x) is Node:
                    todo.extend(reversed(x.items))
            n.items, n.chars, n.tags, n.link_chars, n.link_tags = headings, 0, 0, 0, 0
        order.extend(c for c in n.items if type(c) is Node)


def leave_out_named(root: Node) -> None:
    """Takes named elements out of the tree, but for those that hold the page's articles or, without any, most of its text."""
    order = [root]
    for n in order:
        order.extend(c for c in n.items if type(c) is Node)
    if not any(n.named for n in order):
        return
    chars = {id(n): n.chars for n in order}
    whole = {id(n): n.tag in WHOLE and not n.named for n in order}
    for n in reversed(order[1:]):
        chars[id(n.parent)] += chars[id(n)]
        whole[id(n.parent)] = whole[id(n.parent)] or whole[id(n)]
    articles, most = whole[id(root)], chars[id(root)] / 2

    def stays(n: Node) -> bool:
        return not n.named or n.tag in WHOLE or whole[id(n)] or (not articles and chars[id(n)] > most)

    for n in order:
        n.items = [c for c in n.items if type(c) is str or stays(c)]


def weigh(root: Node) -> list[Node]:
    """Adds subtree counts and densities; returns the elements, parents first."""
    order = [root]
    for n in order:
        order.extend(c for c in n.items if type(c) is Node)
    for n in reversed(order):
        if n.parent is not None:
            p = n.parent
            p.chars += n.chars
            p.tags += n.tags + 1
            p.link_chars += n.link_chars
            p.link_tags += n.link_tags
    share = root.link_chars / root.chars if root.chars else 0.0
    for n in order:
        if n.chars:
            tags, links, link_tags = max(n.tags, 1), max(min(n.link_chars, n.chars), 1), max(n.link_tags, 1)
            plain = max(n.chars - links, 1)
            # the base is 2 without any link, and grows with the share of links here and in the body
            base = 1 + math.log(n.chars / plain * min(n.link_chars, n.chars) + share * n.chars + math.e)
            n.density = n.chars / tags * max(0.0, math.log(n.chars / links * tags / link_tags + 1)) / math.log(base)
    return order


def densest(order: list[Node]) -> Node:
    """The element whose children's densities have the largest sum; one without children counts for itself."""
    best, most = order[0], -1.0
    for n in order:
        children = [c.density for c in n.items if type(c) is Node]
        total = sum(children) if children else n.density
        if total > most:
            best, most = n, total
    return best


def core(order: list[Node]) -> list[Node | str]:
    """The elements whose subtrees are the text, and texts beside them, in page order."""
    best = densest(order)
    threshold, up = best.density, best
    while up is not None:
        threshold, up = min(threshold, up.density), up.parent

    def stays(c: Node, beside: Node) -> bool:
        return c.chars > 0 and (c.density >= threshold or ((beside.inside or beside.tag in WHOLE) and 2 * c.link_chars <= c.chars))

    found: list[Node | str] = [best]
    n = best
    while n.parent is not None:
        children = [c for c in n.parent.items if type(c) is Node]
        at = next(i for i, c in enumerate(children) if c is n)
        # a heading just before the text belongs to it
        before = children[at - 1] if at and children[at - 1].tag in HEADINGS else None
        ok = [c for c in n.parent.items if type(c) is str or c is n or c is before or stays(c, n.parent)]
        here = next(i for i, c in enumerate(ok) if c is n)
        found = [*ok[:here], *found, *ok[here + 1 :]]
        n = n.parent
    return found


def blocks(node: Node | str) -> list[str]:
    found, todo = [], [node]
    while todo:
        x = todo.pop()
        if type(x) is str:
            found.append(x)
        else:
            todo.extend(reversed(x.items))
    return found


def main_text(page: str | None) -> str:
    """The page's main text; empty if there is none."""
    if not page:
        return ""
    order = weigh(parse(page))
    return "\n\n".join(b for n in core(order) for b in blocks(n))


def extract_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    small_batches(pages.sparkSession)
    d = own_names(pages, "page_id", "url", "html")
    kinds = {c: d.schema[c].dataType.simpleString() for c in ("page_id", "url")}

    def extract(batches):
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return d.mapInArrow(extract, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
