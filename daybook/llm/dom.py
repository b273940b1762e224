"""Block trees of HTML pages and their alignment by simple tree matching.

A tree holds the block elements of a page; inline elements dissolve into their
text, and every run of text between block borders is a leaf of its own.
"""

from __future__ import annotations

import re
from html import unescape

#: Elements that start and end a block of text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td "
    "tfoot th thead tr ul".split()
)
#: Elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content isn't markup and isn't shown as text.
RAW = frozenset("script style textarea title iframe xmp noembed noframes".split())
#: Elements that never hold main text.
NOISE_TAGS = frozenset("nav footer aside form button select dialog menu noscript template svg canvas object audio video map head search".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
#: Words of class names and ids that mark what isn't main text.
NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "copyright disqus footer gdpr header login masthead menu menus modal nav navbar navigation newsletter notice notices overlay "
    "pager pagination popup promo promotion related replies reply respond share sharing sidebar signup skip social sponsor "
    "sponsored subscribe toolbar widget widgets".split()
)
#: Words that tell a part of the article itself, such as its own header.
OWN_WORDS = frozenset("article content entry main post story".split())
COMMENT_WORDS = frozenset("comment comments reply replies respond".split())
#: An open element of the second kind ends where one of the first kind starts.
ENDS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "tbody": ("tr", "td", "th", "thead", "tbody"), "tfoot": ("tr", "td", "th", "tbody"),
}
#: Where the search for an element to end stops.
SCOPE = {
    "li": ("ul", "ol", "menu", "dir"), "dt": ("dl",), "dd": ("dl",), "option": ("select", "datalist"), "tr": ("table",),
    "td": ("table", "tr"), "th": ("table", "tr"), "tbody": ("table",), "tfoot": ("table",),
}
#: Deeper elements are children of the last one above, as in browsers.
DEPTH = 200

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)>""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'=<>/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Node:
    """A block element, or a run of text (tag ``#``)."""

    __slots__ = ("tag", "label", "up", "kids", "depth", "noise", "soft", "article", "main", "parts", "links", "mark", "size", "at")

    def __init__(self, tag: str, up: Node | None, label: str | None = None):
        self.tag, self.label, self.up, self.kids = tag, label or tag, up, []
        self.depth = up.depth + 1 if up else 0
        #: noise for certain, or by a name only
        self.noise, self.soft = bool(up and up.noise), False
        self.article, self.main = (up.article, up.main) if up else (False, False)
        self.parts, self.links = [], 0
        self.mark = self.size = self.at = 0
        if up:
            up.kids.append(self)

    @property
    def text(self) -> str:
        return " ".join("".join(self.parts).split())


def attributes(raw: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(raw):
        found.setdefault(name.lower(), unescape(a or b or c))
    return found


def _names(about: dict[str, str]) -> list[set[str]]:
    """Words of every class name and of the id."""
    raw = f"{about.get('class', '')} {about.get('id', '')}"
    return [set(re.split(r"[-_\d]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", name).lower())) for name in raw.split()]


def _noise(tag: str, about: dict[str, str], within: Node) -> tuple[bool, bool]:
    """(for certain, by a name only): an element that isn't main text."""
    sure = (
        tag in NOISE_TAGS
        or (tag == "header" and not within.article)
        or "hidden" in about
        or about.get("aria-hidden", "").lower() == "true"
        or about.get("role", "").lower() in NOISE_ROLES
        or bool(_HIDDEN.search(about.get("style", "")))
    )
    if tag in ("html", "body", "main", "h1"):
        return False, False
    names = _names(about)
    if tag == "article":  # inside another one it is a reader's comment
        return within.article or any(w & COMMENT_WORDS for w in names), False
    return sure, any(w & NOISE_WORDS and not w & OWN_WORDS for w in names)


def parse(html: str) -> list[Node]:
    """Nodes of the page's block tree in page order, the root first."""
    root = Node("#root", None)
    nodes, stack = [root], [("#root", root, 0, False)]  # (element, its block, links open, inline noise)
    leaf: Node | None = None

    def say(raw: str):
        nonlocal leaf
        tag, block, links, quiet = stack[-1]
        if quiet or not raw:
            return
        if leaf is None:
            if raw.isspace():
                return
            leaf = Node("#", block)
            nodes.append(leaf)
        said = unescape(raw)
        leaf.parts.append(said)
        if links:
            leaf.links += len(said.strip())

    def pop(to: int):
        nonlocal leaf
        if any(stack[k][0] in BLOCKS for k in range(to, len(stack))):
            leaf = None
        del stack[to:]

    at, end = 0, len(html)
    while at < end:
        lt = html.find("<", at)
        if lt < 0:
            say(html[at:])
            break
        if lt > at:
            say(html[at:lt])
        found = _TAG.match(html, lt)
        if not found:
            say("<")
            at = lt + 1
            continue
        at = found.end()
        close, tag, raw = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
        if not tag:
            continue
        tag = tag.lower()
        if close:
            if tag == "br":
                say(" ")
                continue
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    if tag in BLOCKS or not any(s[0] in BLOCKS for s in stack[k + 1 :]):
                        pop(k)
                    else:
                        del stack[k]
                    break
            else:
                if tag == "p":  # an end without a start is an empty paragraph
                    leaf = None
            continue
        if tag in RAW:
            if not raw.endswith("/") or tag in ("script", "style", "title", "textarea"):
                shut = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(html, at)
                at = shut.end() if shut else end
            continue
        if tag == "br":
            say(" ")
            continue
        if tag in BLOCKS:
            leaf = None
            for k in range(len(stack) - 1, 0, -1):  # a block ends an open paragraph
                if stack[k][0] == "p":
                    pop(k)
                    break
                if stack[k][0] in BLOCKS:
                    break
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in ENDS.get(tag, ()):
                    pop(k)
                elif stack[k][0] in SCOPE.get(tag, ("table",)):
                    break
                elif tag not in ENDS:
                    break
            if tag == "hr":
                continue
        elif tag in VOID:
            continue
        about = attributes(raw) if raw.strip(" /") else {}
        _, block, links, quiet = stack[-1]
        sure, named = _noise(tag, about, block)
        if tag in BLOCKS:
            if block.depth >= DEPTH:
                block = block.up
            kind = sorted(set(re.sub(r"\d+", "", about.get("class", "")).split()))
            node = Node(tag, block, " ".join([tag, *kind]))
            node.noise, node.soft = node.noise or sure, named
            if not node.noise:
                node.article, node.main = node.article or tag == "article", node.main or tag == "main" or about.get("role", "").lower() == "main"
            nodes.append(node)
            stack.append((tag, node, links, quiet))
        else:
            stack.append((tag, block, links + (tag == "a"), quiet or sure or (named and tag != "a")))
    # names alone don't make noise of what holds all of the page's articles
    def under(node: Node):
        while node is not None:
            yield node
            node = node.up

    whole = [n for n in nodes if n.tag in ("article", "main") and not n.noise]
    if whole and all(any(x.soft for x in under(n)) for n in whole):
        for n in whole:
            for x in under(n):
                x.soft = False
    for n in nodes:
        n.soft = n.soft or bool(n.up and n.up.soft)
    return nodes


def candidates(nodes: list[Node]) -> list[Node]:
    """Runs of text that may be main text: in the article or main element if there is one, else not noise and not mostly links."""
    runs = [n for n in nodes if n.tag == "#" and not n.noise and not n.soft and n.text]
    for inside in (lambda n: n.main and n.article, lambda n: n.article, lambda n: n.main):
        if any(map(inside, runs)):
            return [n for n in runs if inside(n)]
    return [n for n in runs if 2 * n.links <= len(n.text)]


# ------------------------------------------------------------------ matching


class Matcher:
    """Simple tree matching: the largest set of node pairs that keeps labels, order and parents."""

    def __init__(self):
        self.marks: dict[tuple, int] = {}
        self.scores: dict[tuple[int, int], int] = {}

    def prepare(self, nodes: list[Node]) -> list[Node]:
        """Marks equal subtrees with equal numbers; gives nodes their sizes and places."""
        for k in range(len(nodes) - 1, -1, -1):
            n = nodes[k]
            n.at, n.size = k, 1 + sum(x.size for x in n.kids)
            n.mark = self.marks.setdefault((n.label, *[x.mark for x in n.kids]), len(self.marks))
        return nodes

    @staticmethod
    def _trim(a: list[Node], b: list[Node]) -> tuple[int, int]:
        """Lengths of the equal start and end: pairing these is never worse."""
        n, head = min(len(a), len(b)), 0
        while head < n and a[head].mark == b[head].mark:
            head += 1
        tail = 0
        while tail < n - head and a[-1 - tail].mark == b[-1 - tail].mark:
            tail += 1
        return head, tail

    def _table(self, a: list[Node], b: list[Node]) -> list[list[int]]:
        table = [[0] * (len(b) + 1)]
        for x in a:
            above, row = table[-1], [0]
            for j, y in enumerate(b):
                best = above[j] + self.score(x, y)
                row.append(max(best, above[j + 1], row[j]))
            table.append(row)
        return table

    def score(self, a: Node, b: Node) -> int:
        if a.mark == b.mark:
            return a.size
        if a.label != b.label:
            return 0
        key = (a.mark, b.mark)
        if (known := self.scores.get(key)) is not None:
            return known
        head, tail = self._trim(a.kids, b.kids)
        total = 1 + sum(x.size for x in a.kids[:head]) + sum(x.size for x in a.kids[len(a.kids) - tail :])
        x, y = a.kids[head : len(a.kids) - tail], b.kids[head : len(b.kids) - tail]
        if x and y:
            total += self._table(x, y)[-1][-1]
        self.scores[key] = total
        return total

    def pairs(self, a: Node, b: Node) -> list[tuple[Node, Node]]:
        """The pairs of a largest matching of the trees under ``a`` and ``b`` (first ones first)."""
        out, todo = [], [(a, b)] if a.label == b.label else []
        while todo:
            a, b = todo.pop()
            out.append((a, b))
            head, tail = self._trim(a.kids, b.kids)
            todo += zip(a.kids[:head], b.kids[:head])
            if tail:
                todo += zip(a.kids[-tail:], b.kids[-tail:])
            x, y = a.kids[head : len(a.kids) - tail], b.kids[head : len(b.kids) - tail]
            if not (x and y):
                continue
            table, i, j = self._table(x, y), len(x), len(y)
            while i and j:
                if table[i][j] == table[i - 1][j]:
                    i -= 1
                elif table[i][j] == table[i][j - 1]:
                    j -= 1
                else:
                    i, j = i - 1, j - 1
                    todo.append((x[i], y[j]))
        return out
