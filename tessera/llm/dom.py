"""A small DOM for extraction: a forgiving parser, simple tree matching, text blocks."""

from __future__ import annotations

import html as _html
import re

#: Elements whose text is never shown or never part of an article.
SKIPPED = frozenset(
    "script style noscript template nav footer aside form button select textarea input iframe svg canvas object audio video map head title menu dialog".split()
)
RAW = frozenset("script style textarea title noscript template iframe svg".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var ruby rb rt rp br wbr img".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Words in class, id or role that mark what surrounds an article.
MARKS = frozenset(
    """ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus
    footer header masthead menu modal nav navbar navigation newsletter notice notification pagination pager popup promo promoted
    recommended related reply replies respond share sharing sidebar side social sponsor sponsored subscribe toolbar topbar widget
    alert gdpr paywall login signup skip complementary contentinfo search""".split()
)
#: Words that mark an article's own parts even where a mark above stands beside them.
OWN = frozenset("article entry post content body main story text".split())
#: What an opening tag closes when it is still open, and what stops the search for it.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
P_ENDERS = frozenset(
    """address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header
    hgroup hr main menu nav ol p pre section summary table ul""".split()
)

_TOKEN = re.compile(
    r"""<!--(?:.*?--\s*>|.*\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>"']|"[^"]*"|'[^']*')*+)>|<[!?][^>]*>|[^<]+|<""", re.S
)
_MARKED = re.compile(r"""\b(class|id|role|itemprop|aria-hidden|hidden|style)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[0-9])").split


class Node:
    """tag, words of its class and the like, label for matching, children: nodes and strings."""

    __slots__ = ("tag", "words", "label", "children", "parent", "skipped", "size", "number", "mark", "chars", "groups", "kind", "known")

    def __init__(self, tag: str, rest: str, parent: "Node | None"):
        self.tag, self.parent, self.children, self.number, self.known = tag, parent, [], -1, None
        found = dict((a.lower(), b or c or d) for a, b, c, d in _MARKED.findall(rest)) if "=" in rest else {}
        named = " ".join(found.get(k, "") for k in ("class", "id", "role", "itemprop")).lower()
        self.words = frozenset(w for w in _SPLIT(named) if w and not w.isdigit()) if named.strip() else frozenset()
        self.label = (tag, self.words)
        self.skipped = (
            tag in SKIPPED
            or bool(self.words & MARKS and not self.words & OWN and tag not in ("body", "html", "article", "main"))
            or bool(tag == "article" and self.words & {"comment", "comments", "reply", "related", "promo", "ad"})
            or bool(self.words & {"comment", "comments", "disqus", "sidebar", "respond"} and tag not in ("body", "html"))
            or found.get("aria-hidden", "").lower() == "true"
            or "display:none" in found.get("style", "").replace(" ", "").lower()
        )
        self.size = 0


def parse(html: str | None) -> Node:
    """The tree of a page; unclosed, crossed and stray tags are mended much as browsers do."""
    root = at = Node("#root", "", None)
    if not html:
        return root
    pos, end = 0, len(html)
    scan = _TOKEN.match
    while pos < end:
        token = scan(html, pos)
        pos = token.end()
        tag = token["tag"]
        if tag is None:
            text = token[0]
            if text[0] != "<" or len(text) == 1:
                at.children.append(text)
            continue
        tag = tag.lower()
        if token["end"]:
            up = at
            while up is not root and up.tag != tag:
                up = up.parent
            if up is not root:
                at = up.parent
            elif tag == "p":
                at.children.append(Node("p", "", at))
            continue
        if tag in P_ENDERS:
            up = at
            while up is not root and up.tag in INLINE:
                up = up.parent
            if up.tag == "p" or (tag in HEADINGS and up.tag in HEADINGS):
                at = up.parent
        elif tag in CLOSES:
            own, stop = CLOSES[tag]
            up, last = at, None
            while up is not root and up.tag not in stop:
                if up.tag in own:
                    last = up
                up = up.parent
            if last is not None:
                at = last.parent
        node = Node(tag, token["rest"], at)
        at.children.append(node)
        if tag in RAW:
            close = re.compile(f"</{re.escape(tag)}\\s*>", re.I).search(html, pos)
            pos = close.end() if close else end
        elif tag not in VOID and not token["rest"].rstrip().endswith("/"):
            at = node
    return root


def blocks(node: Node, in_article: bool = True) -> list[str]:
    """The text blocks under a node, in page order: references decoded, white space single, trimmed, none empty."""
    out: list[str] = []
    line: list[str] = []

    def flush() -> None:
        if line:
            text = " ".join(_html.unescape("".join(line)).split())
            line.clear()
            if text:
                out.append(text)

    stack: list[tuple[Node, int]] = [(node, 0)]
    while stack:
        at, k = stack.pop()
        if k == 0 and at.tag not in INLINE:
            flush()
        while k < len(at.children):
            child = at.children[k]
            k += 1
            if isinstance(child, str):
                line.append(child)
            elif child.tag == "br" or child.tag == "hr":
                line.append(" ")
            elif child.skipped and not (child.tag == "header" and in_article):
                if child.tag not in INLINE:
                    flush()
            elif child.tag == "header" and in_article and not _has_heading(child):
                flush()
            else:
                stack.append((at, k))
                stack.append((child, 0))
                break
        else:
            if at.tag not in INLINE:
                flush()
    flush()
    return out


def _has_heading(node: Node) -> bool:
    stack = [node]
    while stack:
        for c in stack.pop().children:
            if not isinstance(c, str):
                if c.tag in HEADINGS:
                    return True
                stack.append(c)
    return False


def shown(node: Node) -> int:
    """Sets size: characters of text under each node that is not skipped."""
    order, stack = [], [node]
    while stack:
        at = stack.pop()
        order.append(at)
        stack += [c for c in at.children if not isinstance(c, str)]
    for at in reversed(order):
        at.size = 0 if at.skipped else sum(len(c.strip()) if isinstance(c, str) else c.size for c in at.children)
    return node.size


#: Elements of which neighbours of one label are slots of their own; neighbours of any other element are a list, aligned as one slot.
CONTAINERS = frozenset("div section article main".split())
_PRIME, _BASE = (1 << 61) - 1, 0x1D8AF066F1D2B7A5


def marks(root: Node) -> None:
    """Sets mark and chars of the block nodes: a hash of a node's text blocks, made from those of its children, and their length."""
    from xxhash import xxh3_64_intdigest

    def flush(own: list) -> None:
        if own[3]:
            text = " ".join(_html.unescape("".join(own[3])).split())
            own[3] = []
            if text:
                own[0] = (own[0] * _BASE + xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))) % _PRIME
                own[1] += 1
                own[2] += len(text) + 1

    # own: hash, blocks, characters and open line of a block node, and the same of the node that its blocks belong to.
    stack: list[tuple[Node, int, list]] = [(root, 0, [0, 0, 0, [], None])]
    while stack:
        at, k, own = stack.pop()
        while k < len(at.children):
            child = at.children[k]
            k += 1
            if isinstance(child, str):
                own[3].append(child)
            elif child.tag == "br" or child.tag == "hr":
                own[3].append(" ")
                child.mark, child.chars = 0, 0
            elif child.tag in INLINE:
                if not child.skipped:
                    stack += [(at, k, own), (child, 0, own)]
                    break
            else:
                flush(own)
                out = not _has_heading(child) if child.tag == "header" else child.skipped
                stack += [(at, k, own), (child, 0, [0, 0, 0, [], None if out else own])]
                break
        else:
            if at.tag not in INLINE or at is root:
                flush(own)
                at.mark, at.chars, up = own[0], max(own[2] - 1, 0), own[4]
                if up is not None:
                    up[0] = (up[0] * pow(_BASE, own[1], _PRIME) + own[0]) % _PRIME
                    up[1] += own[1]
                    up[2] += own[2]


def shape(node: Node) -> list[tuple[Node, ...]]:
    """A node's block children; neighbours of one label as one group, if they are no containers."""
    groups: list[list[Node]] = []
    for c in node.children:
        if isinstance(c, str) or c.tag in INLINE or c.tag in ("script", "style", "link", "meta"):
            continue
        if groups and groups[-1][0].label == c.label and c.tag not in CONTAINERS:
            groups[-1].append(c)
        else:
            groups.append([c])
    return [tuple(g) for g in groups]


class Kind:
    """What the matcher sees of a subtree, one object for all that are alike: its label's number, size, and its groups' kinds."""

    __slots__ = ("label", "size", "parts")

    def __init__(self, label: int, parts: tuple):
        self.label, self.parts, self.size = label, parts, 1 + sum(p.size for p in parts)


def _outline(root: Node, base: dict, own: dict) -> None:
    """Sets groups and kind of the nodes that can be aligned; new kinds and labels go into own."""

    def known(key, make):
        found = base.get(key)
        if found is None:
            found = own.get(key)
            if found is None:
                found = own[key] = make()
        return found

    number = lambda: len(base) + len(own)
    order, stack = [], [root]
    while stack:
        at = stack.pop()
        at.groups = shape(at)
        order.append(at)
        stack += [g[0] for g in at.groups if len(g) == 1]
    for at in reversed(order):
        parts = []
        for g in at.groups:
            if len(g) == 1:
                parts.append(g[0].kind)
            else:
                label = known(g[0].label, number)
                parts.append(known((label, None), lambda label=label: Kind(label, ())))
        parts = tuple(parts)
        label = known(at.label, number)
        at.kind = known((label, parts), lambda label=label, parts=parts: Kind(label, parts))


def _weight(g: Kind, h: Kind, sizes: dict) -> int:
    if g is h:
        return g.size
    if g.label != h.label:
        return 0
    return sizes[g, h] if g.parts and h.parts else 1


def _few(x: list[Kind], y: list[Kind], sizes: dict) -> tuple[int, list[tuple[int, int]]]:
    """The largest match of two sequences and its pairs; of equal ones that with the earliest partners."""
    table = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i, g in enumerate(x):
        row, above = table[i + 1], table[i]
        for j, h in enumerate(y):
            best = above[j + 1] if above[j + 1] > row[j] else row[j]
            if g.label == h.label:
                found = above[j] + _weight(g, h, sizes)
                if found > best:
                    best = found
            row[j + 1] = best
    i, j, pairs = len(x), len(y), []
    while i and j:
        if table[i][j] == table[i - 1][j]:
            i -= 1
        elif table[i][j] == table[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            pairs.append((i, j))
    return table[-1][-1], pairs


def _many(x: list[Kind], y: list[Kind], sizes: dict) -> tuple[int, list[tuple[int, int]]]:
    """The same as _few for long sequences: by whole rows, of which about the root of their number is held at once."""
    import numpy as np

    column: dict = {}
    at = np.array([column.setdefault(h, len(column)) for h in y])
    alike: dict = {}
    for h, c in column.items():
        alike.setdefault(h.label, []).append((c, h))
    weights: dict = {}

    def below(above, i: int):
        g = x[i]
        key = g if g.parts else g.label
        if key not in weights:
            own = weights[key] = np.zeros(len(column), np.int32)
            for c, h in alike.get(g.label, ()):
                own[c] = _weight(g, h, sizes)
        row = np.zeros(len(y) + 1, np.int32)
        np.maximum.accumulate(np.maximum(above[1:], above[:-1] + weights[key][at]), out=row[1:])
        return row

    step = int(len(x) ** 0.5) + 1
    row = np.zeros(len(y) + 1, np.int32)
    held = {0: row}
    for i in range(len(x)):
        row = below(row, i)
        if (i + 1) % step == 0:
            held[i + 1] = row
    size, i, j, pairs, first = int(row[-1]), len(x), len(y), [], len(x)
    while i and j:
        if i <= first:
            first = (i - 1) // step * step
            rows = [held[first]]
            for r in range(first, i):
                rows.append(below(rows[-1], r))
        here, above = rows[i - first], rows[i - first - 1]
        if here[j] == above[j]:
            i -= 1
        elif here[j] == here[j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            pairs.append((i, j))
    return size, pairs


def _rest(x: tuple[Kind, ...], y: tuple[Kind, ...]) -> tuple[int, list[int], list[int]]:
    """How many first parts are the same, which always belong to a largest match; and the later ones that have a possible partner."""
    lead, least = 0, min(len(x), len(y))
    while lead < least and x[lead] is y[lead]:
        lead += 1
    if lead == least:
        return lead, [], []
    both = {x[i].label for i in range(lead, len(x))} & {y[j].label for j in range(lead, len(y))}
    return lead, [i for i in range(lead, len(x)) if x[i].label in both], [j for j in range(lead, len(y)) if y[j].label in both]


def _aligned(x: tuple[Kind, ...], y: tuple[Kind, ...], sizes: dict) -> tuple[int, list[tuple[int, int]]]:
    lead, p, q = _rest(x, y)
    size, pairs = sum(x[i].size for i in range(lead)), [(i, i) for i in range(lead)]
    if p:
        # Both give the same pairs; rows of arrays only pay where they are long.
        more, found = (_few if len(p) * len(q) < 1024 else _many)([x[i] for i in p], [y[j] for j in q], sizes)
        size += more
        pairs += [(p[i], q[j]) for i, j in found]
    return size, pairs


def _measure(a: Kind, b: Kind, sizes: dict) -> None:
    """Sizes of the largest matches of a and b and of all pairs under them that it takes to find it, deepest first."""
    stack = [(a, b)]
    while stack:
        a, b = stack[-1]
        if (a, b) in sizes:
            stack.pop()
            continue
        _, p, q = _rest(a.parts, b.parts)
        own: dict = {}
        for h in {b.parts[j] for j in q}:
            if h.parts:
                own.setdefault(h.label, []).append(h)
        lacking = [(g, h) for g in {a.parts[i] for i in p} if g.parts for h in own.get(g.label, ()) if g is not h and (g, h) not in sizes]
        if lacking:
            stack += lacking
        else:
            stack.pop()
            sizes[a, b] = 1 + _aligned(a.parts, b.parts, sizes)[0]


def match(a: Node, b: Node) -> tuple[int, list[tuple[tuple[Node, ...], tuple[Node, ...]]]]:
    """Simple tree matching (Yang 1991): the size and the pairs of the largest match that keeps order and ancestry.

    It is the largest for trees of any depth and width. Subtrees that are alike are measured once; time grows with
    the product of two nodes' numbers of children that differ, and of their different kinds of children.
    """
    if a.known is None:
        a.known = {}
        _outline(a, {}, a.known)
    _outline(b, a.known, {})
    sizes: dict = {}
    if a.kind is not b.kind:
        _measure(a.kind, b.kind, sizes)
    pairs, stack = [((a,), (b,))], [(a, b)]
    while stack:
        own, other = stack.pop()
        for i, j in _aligned(own.kind.parts, other.kind.parts, sizes)[1]:
            g, h = own.groups[i], other.groups[j]
            pairs.append((g, h))
            if len(g) == len(h) == 1:
                stack.append((g[0], h[0]))
    return len(pairs), pairs
