"""Main text of web pages by composite text density.

Every element of the page's tree gets its characters per tag, adjusted for links: text in links
lowers it, text outside raises it. The sum of an element's child densities peaks at the element
that directly holds the article. The least density on the path from there to ``body`` is the
page's threshold: elements at or above it are searched for their own peaks, and those make the
text. Elements that declare themselves menus, adverts, forms, notices, comments and the like
are taken out of the tree first; forms and those known by class or id only stay in if they hold
an ``article`` or ``main`` element, or if nothing else has text. If the peak lies in an ``article`` or ``main`` element, the
outermost such element around it is taken whole, and with it all other such elements, and the headings beside
it or beside what it stands in, at or above the page's threshold. Headings right in front of the text, and its h1 if it has none inside, come
with it from outside however short they are.
"""

from __future__ import annotations

import html
import math
import re

import pyarrow as pa

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Element names of HTML by how they are laid out or parsed.
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template", "svg", "xmp", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir",
    "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
    "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "section",
    "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
# A start tag of the key ends an open element of these names, up to the nearest of the limits.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}), "body": ({"head"}, set()),
}
KEEPS_P = {"button", "table", "td", "th", "caption", "object"}
PAGE_PARTS = {"nav", "footer", "aside", "form", "button", "select", "dialog", "menu", "object", "canvas", "audio", "video"}
PART_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "menu", "form"}
PART_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert(?:s|isement|ising)?|sponsor(?:ed)?|promo(?:tion)?s?|banner|cookies?|consent|gdpr|notices?|alert"
    r"|popup|modal|overlay|newsletter|subscribe|subscription|signup|login|sidebar|side-?bar|widgets?|related|recommended"
    r"|share|sharing|social|comments?|commentlist|disqus|respond|replies|breadcrumbs?|pagination|pager|menu|nav"
    r"|navbar|navigation|masthead|topbar|toolbar|footer|copyright|disclaimer|skip-?link)(?:$|[\s_-]|\d)",
    re.I,
)
# Words that a part's name is joined to; inside an article a name made of anything else is content.
LAYOUT_WORDS = {
    "area", "articles", "bar", "block", "body", "bottom", "box", "btn", "button", "buttons", "container", "content", "entry",
    "form", "group", "icons", "inline", "inner", "items", "left", "link", "links", "list", "outer", "panel", "post", "posts",
    "right", "row", "section", "slot", "stories", "text", "thread", "tools", "top", "unit", "wrap", "wrapper",
}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6", "hgroup"}
HEADER_NAMES = re.compile(r"(?:^|[\s_-])(?:header|head)(?:$|[\s_-])", re.I)
COMMENT_NAMES = re.compile(r"(?:^|[\s_-])(?:comments?|replies|reply|related|ad|advert|sponsored|promo)(?:$|[\s_-]|\d)", re.I)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$)", re.S
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")


class Node:
    __slots__ = ("tag", "parent", "parts", "part", "chars", "tags", "link_chars", "link_tags", "density", "total", "peak")

    def __init__(self, tag: str, parent: Node | None, part: int = 0):
        self.tag, self.parent, self.part = tag, parent, part
        self.parts: list = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0
        self.peak: Node | None = None


SURE, LIKELY = 1, 2


def _names_part(names: str, inside_article: bool) -> bool:
    """Whether a class or id says so. In an article a name counts as a whole: ``related-posts``, not ``related-work``."""
    if not inside_article:
        return PART_NAMES.search(names) is not None
    return any(
        PART_NAMES.search(name) and all(
            x.isdigit() or x.lower() in LAYOUT_WORDS or PART_NAMES.search(x) or x.lower() in ("side", "skip")
            for x in re.split("[-_]+", name) if x
        )
        for name in names.split()
    )


def _part(tag: str, attributes: str, inside_article: bool) -> int:
    """Whether an element declares itself to be something beside the article: 0, LIKELY or SURE."""
    if tag in PAGE_PARTS or tag == "header" and not inside_article:
        return LIKELY if tag == "form" else SURE
    if not attributes or tag in ("html", "body"):
        return 0
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
    names = re.sub(r"([a-z])([A-Z])", r"\1-\2", f"{found.get('class', '')} {found.get('id', '')}")
    if tag in ("article", "main"):
        return SURE if COMMENT_NAMES.search(names) else 0
    bare = re.sub(r"\"[^\"]*\"|'[^']*'", "", attributes)
    return LIKELY * bool(
        found.get("role", "").lower() in PART_ROLES
        or found.get("aria-hidden", "").lower() == "true"
        or re.search(r"(?:^|\s)hidden(?:\s|=|/|$)", bare)
        or re.search(r"display\s*:\s*none", found.get("style", ""))
        or _names_part(names, inside_article)
        or not inside_article and HEADER_NAMES.search(names)
    )


def parse(page: str) -> Node:
    """The page's tree, without the content of scripts, styles and the like."""
    root = Node("html", None)
    stack = [root]
    at, size, articles = 0, len(page), 0
    # Where elements of each name stand open, so that no tag searches the stack; and how many
    # elements at its bottom are known to hold an article.
    places: dict[str, list[int]] = {}
    holding = 0

    def close(n: int) -> None:
        nonlocal articles, holding
        for node in stack[n:]:
            articles -= node.tag in ("article", "main")
            places[node.tag].pop()
        del stack[n:]
        holding = min(holding, n)

    def innermost(tags: set[str]) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=0)

    while at < size:
        sign = page.find("<", at)
        if sign < 0:
            stack[-1].parts.append(page[at:])
            break
        if sign > at:
            stack[-1].parts.append(page[at:sign])
        m = _TOKEN.match(page, sign)
        if m is None:
            stack[-1].parts.append("<")
            at = sign + 1
            continue
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1]:
            if tag not in ("html", "body") and places.get(tag):
                close(places[tag][-1])
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else size
            continue
        if tag == "html":
            continue
        if tag in BLOCK and tag != "body" and places.get("p") and places["p"][-1] > innermost(KEEPS_P):
            close(places["p"][-1])
        if tag in ENDS:
            ended, limits = ENDS[tag]
            while innermost(ended) > innermost(limits):
                close(innermost(ended))
                if tag != "tr":
                    break
        node = Node(tag, stack[-1], _part(tag, m[3], articles > 0))
        if tag in ("article", "main") and not node.part:
            for above in stack[holding:]:
                above.part = SURE if above.part == SURE else 0
            holding = len(stack)
        stack[-1].parts.append(node)
        if tag not in VOID and not m[3].endswith("/"):
            places.setdefault(tag, []).append(len(stack))
            stack.append(node)
            articles += tag in ("article", "main")
    return root


def _in_order(root: Node) -> list[Node]:
    """Elements that count, each after its parent."""
    out = [root]
    for node in out:
        out.extend(p for p in node.parts if isinstance(p, Node) and not p.part and p.tag != "head")
    return out


def _weigh(nodes: list[Node]) -> None:
    """Counts from the leaves up, then densities: characters per tag, adjusted for links."""
    for node in reversed(nodes):
        node.chars += sum(len(p.strip()) for p in node.parts if isinstance(p, str))
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.link_tags + 1
        if node.parent is not None:
            up = node.parent
            up.chars += node.chars
            up.tags += node.tags + 1
            up.link_chars += node.link_chars
            up.link_tags += node.link_tags
    body = nodes[0]
    share = body.link_chars / max(body.chars, 1)
    for node in nodes:
        plain = max(node.chars - node.link_chars, 1)
        if node.chars:
            inner = node.chars / plain * node.link_chars + share * node.chars + math.e
            value = node.chars / max(node.link_chars, 1) * max(node.tags, 1) / max(node.link_tags, 1)
            node.density = node.chars / max(node.tags, 1) * math.log(max(value, 1.0)) / math.log(math.log(inner) + math.e - 1)
        if node.parent is not None:
            node.parent.total += node.density


def _find_peaks(nodes: list[Node]) -> None:
    """For every element, the one at or below it with the largest sum of child densities."""
    for node in reversed(nodes):
        if node.peak is None or node.total >= node.peak.total:
            node.peak = node
        up = node.parent
        if up is not None and (up.peak is None or node.peak.total >= up.peak.total):
            up.peak = node.peak


def _threshold(node: Node) -> float:
    """The least density on the path from an element to the body."""
    least, up = node.density, node
    while up is not None and up.tag != "html":
        least, up = min(least, up.density), up.parent
    return least


def _with_siblings(home: Node, peak: Node, nodes: list[Node]) -> list[Node]:
    """The outermost article around ``home``; other articles and headings beside it that are dense enough."""
    top, path, inside, up = home, set(), False, peak
    while up is not None:
        inside |= up is home
        up = up.parent
    threshold = _threshold(peak if inside else home)
    up = home
    while up is not None:
        if up.tag in ("article", "main"):
            top = up
        up = up.parent
    up = top.parent
    while up is not None:
        path.add(id(up))
        up = up.parent
    found = [top]
    for node in nodes:
        if node is not top and node.chars and node.density >= threshold:
            if node.tag in ("article", "main") or node.tag in HEADINGS and id(node.parent) in path:
                found.append(node)
    return found


def _with_headings(chosen: list[Node], nodes: list[Node]) -> list[Node]:
    """``chosen`` with the headings that introduce it from outside, however short.

    They stand beside the first chosen element or beside what that stands in, before it. Headings
    right in front of it count, with only headings between; if there is no h1 in it, so do all h1.
    Headings that are mostly links do not.
    """
    first = chosen[0]
    inside, waiting = set(), list(chosen)
    while waiting:
        node = waiting.pop()
        if id(node) not in inside:
            inside.add(id(node))
            waiting += [p for p in node.parts if isinstance(p, Node)]
    titled = any(n.tag == "h1" and n.chars and id(n) in inside for n in nodes)
    found, node, touching = [], first, True
    while node.parent is not None:
        before = []
        for p in node.parent.parts:
            if p is node:
                break
            before.append(p)
        for p in reversed(before):
            if isinstance(p, str):
                touching &= not p.strip()
            elif p.part or p.tag == "head" or not p.chars:
                continue
            elif p.tag in HEADINGS and 2 * p.link_chars < p.chars:
                if touching or p.tag == "h1" and not titled:
                    found.append(p)
            else:
                touching = False
        node = node.parent
    return [*chosen, *found]


def _chosen(root: Node, nodes: list[Node]) -> list[Node]:
    peak = root.peak
    if not peak.total:
        return [root]
    homes = [n for n in nodes if n.tag in ("article", "main")]
    node = peak
    while node is not None and node.tag not in ("article", "main"):
        node = node.parent
    if node is None and homes:
        # The peak is above the article: take it if it holds most of what is not in links.
        best = max(homes, key=lambda n: n.chars - n.link_chars)
        if 2 * (best.chars - best.link_chars) >= root.chars - root.link_chars:
            node = best
    if node is not None:
        return _with_headings(_with_siblings(node, peak, nodes), nodes)
    threshold = _threshold(peak)
    found, waiting = [], [root]
    while waiting:
        node = waiting.pop()
        if node is root or node.density >= threshold:
            best = node.peak
            if node is not root:
                found.append(best)
            elif best.density >= threshold:
                found.append(best)
            # The first in page order is looked at first.
            waiting += [p for p in reversed(node.parts) if isinstance(p, Node) and not p.part and p.tag != "head"]
    return _with_headings(found, nodes) if found else found


def _blocks(root: Node, chosen: list[Node]) -> list[str]:
    marks = {id(n) for n in chosen}
    out, now = [], []

    def end() -> None:
        text = " ".join(html.unescape("".join(now)).split())
        if text:
            out.append(text)
        now.clear()

    waiting: list[tuple] = [(root, False, False)]
    while waiting:
        item, inside, leaving = waiting.pop()
        if isinstance(item, str):
            if inside:
                now.append(item)
            continue
        if leaving:
            end()
            continue
        if item.part or item.tag == "head":
            if item.tag in BLOCK:
                end()
            continue
        inside = inside or id(item) in marks
        if item.tag == "br":
            now.append(" ")
        if item.tag in BLOCK:
            end()
            waiting.append((item, inside, True))
        waiting += [(p, inside, False) for p in reversed(item.parts)]
    end()
    return out


def main_text(page: str | None) -> str:
    """The article of a page: its blocks in page order, one a line. Null or empty pages have none."""
    if not page:
        return ""
    root = parse(page)
    body = next((p for p in root.parts if isinstance(p, Node) and p.tag == "body"), root)
    body.parent = None
    text = _text(body)
    if not text and _restore(body):
        text = _text(body)
    return text


def _text(body: Node) -> str:
    nodes = _in_order(body)
    _weigh(nodes)
    _find_peaks(nodes)
    return "\n".join(_blocks(body, _chosen(body, nodes)))


def _restore(body: Node) -> bool:
    """Take likely parts back into the tree, and clear all counts; false if there are none."""
    found, waiting = False, [body]
    for node in waiting:
        found |= node.part == LIKELY
        node.part = SURE if node.part == SURE else 0
        node.chars = node.tags = node.link_chars = node.link_tags = 0
        node.density = node.total = 0.0
        node.peak = None
        waiting.extend(p for p in node.parts if isinstance(p, Node))
    return found


@F.arrow_udf(StringType())
def page_text(pages: pa.Array) -> pa.Array:
    return pa.array([main_text(p.as_py()) for p in pages], pa.string())


def extract_text(df: DataFrame, page: str = "html", out: str = "text") -> DataFrame:
    """``df`` with the main text of each page in ``out`` (replaced if there), one row for each row."""
    return df.withColumn(out, page_text(F.col(page)))
