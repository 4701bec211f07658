"""A forgiving reader of HTML: nodes in document order and their text."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)
    |<(/?)([A-Za-z][^\s/>]*)((?:[^>"']++|"[^"<]*"|'[^'<]*')*+)>
    |<(/?)([A-Za-z][^\s/>]*)([^>]*)>
    |[^<]+|<""",
    re.S | re.X,
)
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
# their content is not text of the page
HIDDEN = frozenset("script style noscript template svg iframe object title textarea".split())
INLINE = frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small"
    " span strike strong sub sup time tt u var img input wbr".split()
)
# an opening tag ends an open element of these kinds, up to a border
_ENDS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
    "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
}
_BORDERS = frozenset("ul ol dl table tr td th article section div body main aside".split())


@dataclass
class Page:
    """Node ``i`` covers nodes ``i`` to ``end[i] - 1``; node 0 stands for the document."""

    tag: list[str] = field(default_factory=lambda: ["#page"])
    parent: list[int] = field(default_factory=lambda: [-1])
    depth: list[int] = field(default_factory=lambda: [0])
    attributes: list[str] = field(default_factory=lambda: [""])
    end: list[int] = field(default_factory=lambda: [0])
    # text in document order: node, characters, whether a block begins with it
    owner: list[int] = field(default_factory=list)
    text: list[str] = field(default_factory=list)
    fresh: list[bool] = field(default_factory=list)


def read(source: str) -> Page:
    page = Page()
    stack, opened = [0], {"#page": 1}
    fresh, at, size = True, 0, len(source)

    def close(count: int) -> None:
        for _ in range(count):
            node = stack.pop()
            page.end[node] = len(page.tag)
            opened[page.tag[node]] -= 1

    def end_open(kinds: tuple[str, ...], borders: frozenset[str]) -> None:
        if not any(opened.get(k) for k in kinds):
            return
        for up, node in enumerate(reversed(stack), 1):
            if page.tag[node] in kinds:
                close(up)
                return
            if page.tag[node] in borders:
                return

    while at < size:
        found = _TOKEN.match(source, at)
        at = found.end()
        name = found[2] or found[5]
        if name is None:
            piece = found[0]
            if piece[0] != "<" or piece == "<":
                page.owner.append(stack[-1])
                page.text.append(html.unescape(piece))
                page.fresh.append(fresh)
                fresh = False
            continue
        name = name.lower()
        block = name not in INLINE
        fresh = fresh or block
        if found[1] or found[4]:
            if opened.get(name):
                for up, node in enumerate(reversed(stack), 1):
                    if page.tag[node] == name:
                        close(up)
                        break
                    if not block and page.tag[node] not in INLINE:
                        break
            continue
        if block:
            end_open(("p",), _BORDERS)
        if name in _ENDS:
            end_open(_ENDS[name], _BORDERS - set(_ENDS[name]))
        if name in HIDDEN:
            if not found[0].endswith("/>"):
                over = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(source, at)
                at = over.end() if over else size
            fresh = fresh or name not in ("svg", "object")
            continue
        node = len(page.tag)
        page.tag.append(name)
        page.parent.append(stack[-1])
        page.depth.append(page.depth[stack[-1]] + 1)
        page.attributes.append((found[3] or found[6] or "").strip())
        page.end.append(node + 1)
        if name not in VOID and not found[0].endswith("/>"):
            stack.append(node)
            opened[name] = opened.get(name, 0) + 1
    close(len(stack))
    return page


def joined(page: Page, keep) -> str:
    """Kept text: white space within a block as one space, blocks joined by one."""
    blocks, now = [], []
    for owner, text, fresh in zip(page.owner, page.text, page.fresh, strict=True):
        if fresh and now:
            blocks.append("".join(now))
            now = []
        if keep[owner]:
            now.append(text)
    blocks.append("".join(now))
    return " ".join(" ".join(b.split()) for b in blocks if b.strip())
