"""HTML extraction by wrapper induction.

Each host's template is the tree of one of its pages. Every page of the host is aligned with it by simple
tree matching; for each template slot the aligned texts are counted and their hashes' extremes kept, so that a
slot with one text throughout is constant (template) and the others vary (content). The wrapper is the slot
that holds the host's varying main text: its article or main elements, or else the deepest slot that keeps all
of what varies and is not a menu, header, footer, sidebar, notice, advert, form or comments. A page's text is that
slot's blocks without those of constant slots; a page that does not align is judged by its own tree in the same way.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, table
from tessera.llm.dom import INLINE, Node, blocks, marks, match, parse, shape, shown
from tessera.llm.urlfilter import host_of

#: A slot is constant if all of at least so many pages hold one text there.
PAGES = 3
#: Templates beyond so many bytes together are joined, not broadcast.
BROADCAST_BYTES = 32 << 20


def _number(root: Node) -> list[Node]:
    """All nodes in page order, numbered."""
    out, stack = [], [root]
    while stack:
        at = stack.pop()
        at.number = len(out)
        out.append(at)
        stack += [c for c in reversed(at.children) if not isinstance(c, str)]
    return out


def _chiefs(nodes: list[Node]) -> list[Node]:
    """The outermost article, or else main elements outside what is skipped, in page order."""
    for wanted in (lambda n: n.tag == "article", lambda n: n.tag == "main" or "articlebody" in n.words or "main" in n.words and n.tag in ("div", "section")):
        own = [n for n in nodes if wanted(n) and not _hidden(n)]
        if own:
            inside = {id(n) for n in own}
            return [n for n in own if not any(id(up) in inside for up in _above(n))]
    return []


def _above(node: Node) -> Iterator[Node]:
    while node.parent is not None:
        node = node.parent
        yield node


def _hidden(node: Node) -> bool:
    while node is not None:
        if node.skipped:
            return True
        node = node.parent
    return False


def content_roots(root: Node, weight) -> list[Node]:
    """The slots of the main text: the article or main elements, or the deepest that holds all of the weight."""
    chiefs = _chiefs(_number(root))
    if chiefs:
        return chiefs
    at = root
    while True:
        inner = [c for c in at.children if not isinstance(c, str) and not c.skipped and c.tag not in INLINE]
        best = max(inner, key=weight, default=None)
        if best is None or best.tag in ("p", "pre", "table", "ul", "ol", "dl", "blockquote") or best.tag[0] == "h" and best.tag[1:].isdigit():
            return [at]
        # Constant and skipped sisters weigh nothing; any other holds text that a descent would lose.
        others = sum(weight(c) for c in inner if c is not best)
        loose = sum(len("".join(c.split())) if isinstance(c, str) else c.size for c in at.children if isinstance(c, str) or c.tag in INLINE)
        if others or loose or not weight(best):
            return [at]
        at = best


def _joined(nodes: list[Node]) -> str:
    return "\n\n".join(t for n in nodes for t in blocks(n))


def slots(template: Node, page: Node) -> Iterator[tuple[int, int, int]]:
    """(template node, hash of the page's text there, its length) of each aligned pair."""
    marks(page)
    for own, other in match(template, page)[1]:
        mark = other[0].mark
        for n in other[1:]:
            mark = (mark * 31 + n.mark + 1) % ((1 << 61) - 1)
        yield own[0].number, mark, sum(n.chars for n in other) + len(other) - 1


def extract(html: str | None, template: Node | None, wrapper: int | None, constant: list[int] | None = None) -> str:
    """A page's main text: what its host's wrapper marks, or its own tree where that does not align; without constant slots."""
    page = parse(html)
    pairs = match(template, page)[1] if template is not None and wrapper is not None else []
    drop = set(constant or ())
    for own, other in pairs:
        if own[0].number in drop:
            for n in other:
                n.children = []
    shown(page)
    if not _chiefs(_number(page)):
        for own, other in pairs:
            if own[0].number == wrapper:
                if other[0].size:
                    return _joined([other[0]])
                break
    return _joined(content_roots(page, lambda n: n.size))


class _Templates:
    """Parsed templates, the last few hosts'."""

    def __init__(self, most: int = 256):
        self.most, self.known = most, {}

    def get(self, host: str, html: str | None) -> Node | None:
        if not html:
            return None
        if host not in self.known:
            if len(self.known) >= self.most:
                self.known.clear()
            tree = self.known[host] = parse(html)
            _number(tree)
            shown(tree)
        return self.known[host]


def _induce(host_slots: list[tuple], html: str) -> tuple[int, list[int]]:
    """The wrapper: the template node where the varying main text lies; and the constant slots, none if no slot varies.

    host_slots: (slot, pages, least, most, chars).
    """
    tree = parse(html)
    nodes = _number(tree)
    shown(tree)
    varying = {}
    for slot, pages, least, most, chars in host_slots:
        varying[slot] = 0.0 if pages >= PAGES and least == most else chars / pages
    constant = sorted(slot for slot, _, _, _, chars in host_slots if chars and not varying[slot])
    for node in nodes:
        for group in shape(node):
            # What varies in a list is spread over its members, so that none is taken for the whole.
            for member in group if len(group) > 1 else ():
                varying[member.number] = varying.get(group[0].number, 0.0) / len(group) if member is not group[0] else varying.get(member.number, 0.0)
    wrapper = content_roots(tree, lambda n: varying.get(n.number, 0.0))[0].number
    return wrapper, constant if any(varying.values()) else []


def extract_pages(pages: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """pages(page_id, url, html) -> (page_id, url, text, n_chars): the main text, and its code points.

    Null and empty html give an empty text, as do pages without text. Pages without a host share the empty host's
    wrapper. Repeated rows stay, each with its text. Extra columns are not read; an empty table gives an empty result.
    """
    scratch = scratch or Scratch(pages.sparkSession)
    own = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    chosen = own.filter("html IS NOT NULL AND html <> ''").groupBy("host").agg(F.min_by("html", F.xxhash64("page_id", "html")).alias("template"))
    chosen = scratch.keep(chosen, "templates")
    small = (chosen.agg(F.sum(F.octet_length("template"))).first()[0] or 0) <= BROADCAST_BYTES
    bounded = F.broadcast if small else (lambda df: df)

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates, sums = _Templates(), {}

        def out() -> pa.RecordBatch:
            rows = [(h, s, *v) for (h, s), v in sums.items()]
            sums.clear()
            kinds = (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
            names = ["host", "slot", "pages", "least", "most", "chars"]
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=names)

        for batch in batches:
            for host, html, template in zip(*(batch.column(k) for k in range(3)), strict=True):
                host, html = host.as_py(), html.as_py()
                tree = templates.get(host, template.as_py())
                if tree is None or not html:
                    continue
                page = parse(html)
                for slot, mark, chars in slots(tree, page):
                    seen = sums.get((host, slot))
                    if seen is None:
                        sums[host, slot] = [1, mark, mark, chars]
                    else:
                        seen[0] += 1
                        seen[1] = min(seen[1], mark)
                        seen[2] = max(seen[2], mark)
                        seen[3] += chars
            if len(sums) > 50_000:
                yield out()
        yield out()

    aligned = own.select("host", "html").join(bounded(chosen), "host")
    found = aligned.select("host", "html", "template").mapInArrow(align, "host string, slot int, pages long, least long, most long, chars long")
    found = found.groupBy("host", "slot").agg(F.sum("pages").alias("pages"), F.min("least").alias("least"), F.max("most").alias("most"), F.sum("chars").alias("chars"))
    # One row per template node, so a host's group is as large as one page's tree.
    found = found.groupBy("host").agg(F.collect_list(F.struct("slot", "pages", "least", "most", "chars")).alias("slots")).join(chosen, "host")

    def induce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept = [_induce([tuple(s.values()) for s in rows], html) for rows, html in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
            arrays = [pa.array([k[0] for k in kept], pa.int32()), pa.array([k[1] for k in kept], pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), *arrays], names=["host", "template", "wrapper", "constant"])

    wrappers = scratch.keep(found.select("host", "slots", "template").mapInArrow(induce, "host string, template string, wrapper int, constant array<int>"), "wrappers")

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates = _Templates()
        for b in batches:
            got = []
            for host, html, template, wrapper, constant in zip(*(b.column(k) for k in range(2, 7)), strict=True):
                got.append(extract(html.as_py(), templates.get(host.as_py(), template.as_py()), wrapper.as_py(), constant.as_py()))
            counts = pa.array([len(t) for t in got], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(got, pa.string()), counts], names=["page_id", "url", "text", "n_chars"])

    joined = own.join(bounded(wrappers), "host", "left").select("page_id", "url", "html", "host", "template", "wrapper", "constant")
    joined = joined.select("page_id", "url", "host", "html", "template", "wrapper", "constant")
    kind = pages.schema["page_id"].dataType.simpleString()
    return joined.mapInArrow(texts, f"page_id {kind}, url string, text string, n_chars long")


def op3_html_extraction(spark, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))
