"""A small tolerant HTML reader: block elements and text runs as a tree of nodes with statistics."""

from __future__ import annotations

import html
import re

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([A-Za-z_:][\w:.-]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_TOKENS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

# Element names of HTML by their role.
RAW = frozenset("script style textarea title".split())  # to their closing tag, or to the end of the page
SKIPPED = frozenset("noscript template iframe svg".split())  # to the closing tag that belongs to them; without one, only the tag; a svg may close itself
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""html head body article section nav aside header footer main div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd
    table caption thead tbody tfoot tr td th form fieldset blockquote pre figure figcaption address details summary
    select option button dialog menu hgroup center hr""".split())
CLOSES_P = BLOCK - {"button", "option", "select", "caption", "thead", "tbody", "tfoot", "tr", "td", "th", "html", "head", "body"}
SIBLING_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
                  "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "body": {"head"}}
SCOPE = frozenset("table ul ol dl select html body article section div form td th".split())


class Node:
    __slots__ = ("tag", "attrs", "parent", "children", "text", "links", "n_links", "controls", "depth", "at")

    def __init__(self, tag: str, attrs: dict, parent: Node | None) -> None:
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []
        self.text = ""  # of a run ("#text"): one line
        self.links = self.n_links = self.controls = 0
        self.depth = parent.depth + 1 if parent else 0
        if parent:
            parent.children.append(self)


def attributes(raw: str) -> dict:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(raw)} if raw and not raw.isspace() else {}


def attribute_tokens(attrs: dict) -> list[str]:
    """Lower-case words of class, id, role and aria-label, split at case and punctuation."""
    joined = " ".join(attrs.get(k, "") for k in ("class", "id", "role", "aria-label", "itemprop"))
    return [t.lower() for t in _TOKENS.findall(joined)] if joined.strip() else []


def _raw_end(page: str, tag: str, at: int) -> int:
    end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
    return end.end() if end else len(page)


def _skipped_ends(page: str, at: int) -> dict:
    """Where each SKIPPED element from ``at`` on ends, by the end of its opening tag; inner ones of the same name are counted."""
    ends: dict = {}
    opened: dict = {tag: [] for tag in SKIPPED}
    while (m := _TOKEN.search(page, at)) is not None:
        at, tag = m.end(), m[2].lower() if m[2] else None
        closed = tag is not None and m[3].rstrip().endswith("/")
        if tag in SKIPPED:
            if m[1]:
                if opened[tag]:
                    ends[opened[tag].pop()] = at
            elif not (closed and tag == "svg"):
                opened[tag].append(at)
        elif tag in RAW and not m[1] and not (closed and opened["svg"]):
            at = _raw_end(page, tag, at)
    return ends


def parse(page: str) -> Node:
    """The page as block elements and runs of inline text; scripts, styles, comments and titles have no text. Text in
    math and object elements is inline text."""
    root = top = Node("#root", {}, None)
    run: list = []  # (text, in a link)
    link, n_links, controls, at, size = False, 0, 0, 0, len(page)
    skipped = None

    def flush() -> None:
        nonlocal n_links, controls
        if run:
            text = run[0][0] if len(run) == 1 else "".join([t for t, _ in run])
            text = " ".join((html.unescape(text) if "&" in text else text).split())
            if text:
                node = Node("#text", {}, top)
                node.text, node.n_links = text, n_links
                node.links = sum([len(t.strip()) for t, inside in run if inside])
            run.clear()
        top.controls += controls
        n_links = controls = 0

    while at < size:
        m = _TOKEN.search(page, at)
        if m is None:
            run.append((page[at:], link))
            break
        if m.start() > at:
            run.append((page[at:m.start()], link))
        at = m.end()
        tag = m[2].lower() if m[2] else None
        if tag is None:
            continue
        if m[1]:
            if tag in BLOCK:
                node = top
                while node is not None and node.tag != tag:
                    node = node.parent
                if node is not None and node.parent is not None:
                    flush()
                    top, link = node.parent, False
            elif tag == "a":
                link = False
            continue
        if tag in RAW:
            at = _raw_end(page, tag, at)
            controls += tag == "textarea"
            continue
        if tag in SKIPPED:
            if not (tag == "svg" and m[3].rstrip().endswith("/")):
                skipped = _skipped_ends(page, m.start()) if skipped is None else skipped
                at = skipped.get(at, at)
            continue
        if tag in BLOCK:
            flush()
            link = False
            if tag in CLOSES_P:
                node = top
                while node.tag != "p" and node.tag not in SCOPE and node.parent is not None:
                    node = node.parent
                if node.tag == "p":
                    top = node.parent
            closes = SIBLING_CLOSES.get(tag, ())
            while top.tag in closes:
                top = top.parent
            if tag != "hr" and not m[3].rstrip().endswith("/"):
                top = Node(tag, attributes(m[3]), top)
                top.controls += tag in ("button", "select")
        elif tag == "a":
            link, n_links = True, n_links + 1
        elif tag == "br":
            run.append((" ", link))
        elif tag == "input":
            controls += 1
    flush()
    return root


def walk(root: Node) -> list[Node]:
    """All nodes, parents before children, in page order."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack.extend(reversed(node.children))
    return out
