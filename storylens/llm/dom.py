"""A small tolerant reader of HTML: block elements and the runs of text between their borders."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

#: Elements that break lines; all others only mark text inside a line. (fixed values)
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section
summary table tbody td tfoot th thead tr ul""".split())
#: Elements whose content is no text of the page: those whose content is raw, up to their own end tag or the page's end,
#: and those that hold elements and end with what is around them. (fixed values)
RAW = frozenset("iframe script style title".split())
HIDDEN = frozenset("noscript object svg template".split())
#: Elements of svg that can hold HTML; elsewhere in it a block ends it. (fixed values)
FOREIGN = frozenset("desc foreignobject".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTROLS = frozenset("button input option select textarea".split())
#: What an opening tag ends if it is open, up to the given elements. (fixed values)
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "option": ({"option"}, {"select"})}

# A comment may end at once (<!-->, <!--->), with -->, --!> or the page. Quotes count where a value begins; one that
# never closes is a sign like any other. A tag ends with > or the page.
_TAG = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)"
                  r"((?:=\s*(?:\"[^\"]*\"|'[^']*')|[^>])*?)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORDS = re.compile(r"[A-Za-z]+?(?=[A-Z][a-z]|[^A-Za-z]|$)|[A-Za-z]+")


@dataclass
class Page:
    """Nodes in page order, parents first. A run of text is a leaf with the tag ``#text``."""

    parent: list[int] = field(default_factory=list)
    tag: list[str] = field(default_factory=list)
    tokens: list[tuple[str, ...]] = field(default_factory=list)
    text: list[str] = field(default_factory=list)
    #: Characters of a run inside links, tags inside a run, and form controls below a node.
    linked: list[int] = field(default_factory=list)
    inline: list[int] = field(default_factory=list)
    controls: list[int] = field(default_factory=list)

    def add(self, parent: int, tag: str, tokens: tuple[str, ...] = (), text: str = "") -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.tokens.append(tokens)
        self.text.append(text)
        self.linked.append(0)
        self.inline.append(0)
        self.controls.append(0)
        return len(self.tag) - 1


def attribute_tokens(attributes: str) -> tuple[str, ...]:
    """Words of class, id and role, in lower case."""
    found = [w.lower() for m in _ATTRIBUTE.finditer(attributes) for w in _WORDS.findall(m[1] or m[2] or m[3] or "")]
    return tuple(dict.fromkeys(found))


def read(source: str) -> Page:
    page = Page()
    top = page.add(-1, "#page")
    open_: list[tuple[str, int]] = [("#page", top)]  # inline elements carry the node of the block around them
    pieces: list[str] = []
    links = linked = inside = hidden = 0

    def run_ends() -> None:
        nonlocal linked, inside
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            pieces.clear()
            if text:
                leaf = page.add(open_[-1][1], "#text", text=text)
                page.linked[leaf], page.inline[leaf] = min(linked, len(text)), inside
        linked = inside = 0

    def close(depth: int) -> None:
        nonlocal links, hidden
        closed = [tag for tag, _ in open_[depth:]]
        links -= closed.count("a")
        inner = next((i for i, tag in enumerate(closed) if tag in HIDDEN), len(closed))
        hidden -= sum(tag in HIDDEN for tag in closed[inner:])
        if not hidden and any(tag in BLOCKS for tag in closed[:inner]):  # blocks in hidden elements break no line
            run_ends()
        del open_[depth:]

    def text(value: str) -> None:
        nonlocal linked
        if value and not hidden:
            pieces.append(value)
            if links:
                linked += len(value)

    at, end = 0, len(source)
    while at < end:
        m = _TAG.search(source, at)
        if m is None:
            text(source[at:])
            break
        text(source[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            depth = next((i for i in range(len(open_) - 1, 0, -1) if open_[i][0] == tag), 0)
            if depth and tag not in BLOCKS and tag not in HIDDEN and any(t in BLOCKS for t, _ in open_[depth:]):
                links -= tag == "a"  # an inline end tag ends no block that began inside
                del open_[depth]
            elif depth:
                close(depth)
            elif tag == "p" and not hidden:
                run_ends()
            continue
        if hidden and tag in BLOCKS:
            svg = max((i for i, (t, _) in enumerate(open_) if t in HIDDEN), default=0)
            if open_[svg][0] == "svg" and not any(t in FOREIGN for t, _ in open_[svg:]):
                close(svg)
        if tag in RAW:
            if not m[3].endswith("/"):
                stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(source, at)
                at = stop.end() if stop else end
            continue
        if tag in HIDDEN:
            if not m[3].endswith("/"):
                open_.append((tag, open_[-1][1]))
                hidden += 1
            continue
        if hidden:  # without nodes; its tags only tell where it ends
            if tag not in VOID and not m[3].endswith("/"):
                open_.append((tag, open_[-1][1]))
                links += tag == "a"
            continue
        if tag == "head":  # what may stand in it has no text; the first that may not ends it
            continue
        if tag == "br":
            text("\n")
            continue
        if tag in CONTROLS:
            page.controls[open_[-1][1]] += 1
        if tag in BLOCKS:
            run_ends()
            ended, up_to = ENDS.get(tag, (frozenset(), frozenset()))
            # any block ends an open paragraph
            for i in range(len(open_) - 1, 0, -1):
                if open_[i][0] in ended or open_[i][0] == "p":
                    close(i)
                elif open_[i][0] in BLOCKS and (open_[i][0] in up_to or not ended):
                    break
            if tag not in VOID:
                open_.append((tag, page.add(open_[-1][1], tag, attribute_tokens(m[3]))))
        elif tag not in VOID:
            inside += 1
            if not m[3].endswith("/"):
                open_.append((tag, open_[-1][1]))
                links += tag == "a"
    run_ends()
    return page
