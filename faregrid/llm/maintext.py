"""Main text of web pages: boosted trees over DOM nodes, decoded down the tree.

Every node that holds text gets features of itself, its subtree and its place: text
density, share of links and punctuation, words of its attributes, depth, siblings, and
the same of its ancestors. Boosted trees give the probability that its text belongs to
the article. Decoding finds the labelling with the best likelihood in which a node is
taken whole, dropped whole, or split into its children at a price, so that no node is
kept inside a dropped one or dropped inside a kept one.

The trees are fitted here: on at most ``PAGES`` pages of the table with the smallest
hash, labelled by their own ``article`` or ``main`` element, and on made pages of many
layouts (menus, notices, forms, comments in plain ``div``s). Node features are computed
in the tasks; at most ``PAGES * NODES`` rows of numbers come to the driver.

Defined results: a null or empty page, or one without text, gives an empty text;
repeated rows repeat their result; an empty table gives an empty result; columns other
than ``page_id``, ``url`` and ``html`` do not take part.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faregrid.llm import boosting, dom
from faregrid.llm.ship import ship

PAGES = 200
NODES = 400
MADE = 400
SPLIT_PRICE = 8.0
SEED = 11

_GROUPS = {
    "heading": "h1 h2 h3 h4 h5 h6",
    "prose": "p blockquote pre figcaption",
    "list": "ul ol li dl dt dd",
    "table": "table tbody thead tr td th",
    "form": "form button select option label fieldset legend input textarea",
    "article": "article main",
    "frame": "nav header footer aside menu dialog",
    "box": "div section center",
    "inline": " ".join(dom.INLINE - {"a"}),
    "link": "a",
}
GROUP = {tag: i for i, tags in enumerate(_GROUPS.values()) for tag in tags.split()}
_LINK, _FORM, _FRAME, _ARTICLE = (list(_GROUPS).index(g) for g in ("link", "form", "frame", "article"))
_GOOD = re.compile(r"(?i)article|content|main|post|entry|story|body|text|prose")
_BAD = re.compile(
    r"(?i)nav|menu|footer|header|side|\bads?\b|advert|banner|cookie|consent|notice|popup|modal|promo"
    r"|sponsor|comment|reply|discuss|share|social|related|widget|breadcrumb|form|subscri|newsletter"
    r"|login|search|tag-?list|copyright|hidden|display:\s*none"
)
_POINTS = re.compile(r"[.,;:!?]")


def _node_table(pages: list[dom.Page]) -> dict[str, np.ndarray]:
    """Nodes of all pages one after the other; places are global."""
    start = np.cumsum([0, *[len(p.tag) for p in pages]])
    total = start[-1]
    table = {name: np.zeros(total) for name in ("chars", "points", "runs", "good", "bad")}
    table["group"] = np.full(total, len(_GROUPS))
    for name in ("parent", "end", "depth", "page"):
        table[name] = np.zeros(total, dtype=np.int64)
    for number, page in enumerate(pages):
        lo, hi = start[number], start[number + 1]
        table["group"][lo:hi] = [GROUP.get(t, len(_GROUPS)) for t in page.tag]
        table["parent"][lo:hi] = np.asarray(page.parent) + lo
        table["end"][lo:hi] = np.asarray(page.end) + lo
        table["depth"][lo:hi] = page.depth
        table["page"][lo:hi] = lo
        for node, words in enumerate(page.attributes):
            if words:
                table["good"][lo + node] = bool(_GOOD.search(words))
                table["bad"][lo + node] = bool(_BAD.search(words))
        for owner, text in zip(page.owner, page.text, strict=True):
            size = len(text) if not text.isspace() else 0
            if size:
                table["chars"][lo + owner] += size
                table["points"][lo + owner] += len(_POINTS.findall(text))
                table["runs"][lo + owner] += 1
    return table


def features(table: dict[str, np.ndarray]) -> np.ndarray:
    """One row per node. Subtrees are stretches, so their sums are differences of sums."""
    total = len(table["chars"])
    at, end, root = np.arange(total), table["end"], table["page"]
    parent = np.maximum(table["parent"], root)

    def within(values: np.ndarray) -> np.ndarray:
        sums = np.r_[0.0, np.cumsum(values)]
        return sums[end] - sums[at]

    def above(flags: np.ndarray) -> np.ndarray:
        """How many nodes from here up to the page carry a flag."""
        steps = np.zeros(total + 1)
        np.add.at(steps, at, flags)
        np.add.at(steps, end, -flags)
        return np.cumsum(steps)[:total]

    group = table["group"]
    chars, points, runs = (within(table[c]) for c in ("chars", "points", "runs"))
    nodes = (end - at).astype(float)
    in_link = above((group == _LINK).astype(float)) > 0
    link_chars = within(table["chars"] * in_link)
    children = np.zeros(total)
    np.add.at(children, parent, table["depth"] > 0)
    # place among siblings: how many children the parent had before
    first = np.argsort(parent, kind="stable")
    run = np.r_[True, parent[first][1:] != parent[first][:-1]]
    since = np.maximum.accumulate(np.where(run, np.arange(total), 0))
    sibling = np.zeros(total)
    sibling[first] = np.arange(total) - since
    same = np.zeros(total)
    key = parent * (len(_GROUPS) + 1) + group
    _, where, many = np.unique(key, return_inverse=True, return_counts=True)
    same = many[where]
    before = np.r_[0.0, np.cumsum(table["chars"])][at] - np.r_[0.0, np.cumsum(table["chars"])][root]
    page_chars = chars[root]
    level = parent
    wide = [
        np.log1p(chars),
        chars / nodes,
        link_chars / (chars + 1),
        points / (chars + 1),
        chars / (runs + 1),
        table["depth"],
        sibling,
        children[level],
        chars / (chars[level] + 1),
        chars / (page_chars + 1),
        before / (page_chars + 1),
        np.log1p(table["chars"]),
        children,
        same / (children[level] + 1),
        np.log1p(chars[level]),
        link_chars[level] / (chars[level] + 1),
        points[level] / (chars[level] + 1),
        above((group == _ARTICLE).astype(float)),
        above((group == _FRAME).astype(float)),
        above((group == _FORM).astype(float)),
        above(table["good"]),
        above(table["bad"]),
        within(table["bad"]) / nodes,
        in_link,
        *[group == g for g in range(len(_GROUPS))],
    ]
    return np.stack([np.asarray(w, dtype=float) for w in wide], axis=1)


def decode(table: dict[str, np.ndarray], probability: np.ndarray, price: float = SPLIT_PRICE):
    """Which nodes are kept: whole subtrees in or out, splits paid for."""
    total = len(probability)
    at, end, parent, depth = np.arange(total), table["end"], table["parent"], table["depth"]
    p = np.clip(probability, 1e-4, 1 - 1e-4)
    gain = np.sqrt(table["chars"]) * (np.log(p) - np.log(1 - p))  # of being in, against out
    sums = np.r_[0.0, np.cumsum(gain)]
    whole = sums[end] - sums[at]
    split = np.maximum(gain, 0.0) - price
    best = np.zeros(total)
    order = np.argsort(depth, kind="stable")
    edges = np.searchsorted(depth[order], np.arange(depth.max(initial=0) + 2))
    for level in range(len(edges) - 2, -1, -1):
        here = order[edges[level] : edges[level + 1]]
        best[here] = np.maximum(np.maximum(whole[here], 0.0), split[here])
        if level:
            np.add.at(split, parent[here], best[here])
    keep = np.zeros(total, dtype=bool)
    settled = np.zeros(total, dtype=bool)
    for level in range(len(edges) - 1):
        here = order[edges[level] : edges[level + 1]]
        up = np.maximum(parent[here], table["page"][here])
        given = settled[up] & (level > 0)
        parted = ~given & (split[here] > np.maximum(whole[here], 0.0))
        keep[here] = np.where(given, keep[up], np.where(parted, gain[here] > 0, whole[here] > 0))
        settled[here] = ~parted
    return keep


def labelled(pages: list[dom.Page], table: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Places of the text nodes of pages with an article element, and whether they are in it."""
    group, end = table["group"], table["end"]
    inside = np.zeros(len(group) + 1)
    places = np.flatnonzero(group == _ARTICLE)
    np.add.at(inside, places, 1)
    np.add.at(inside, end[places], -1)
    has = np.isin(table["page"], table["page"][places])
    return np.flatnonzero((table["chars"] > 0) & has), np.cumsum(inside)[:-1] > 0


def made_pages(count: int = MADE, seed: int = SEED) -> tuple[list[str], list[list[str]]]:
    """Pages of random layouts, and the strings that belong to the article of each."""
    rng = random.Random(seed)

    def words(low: int, high: int) -> str:
        out = ["".join(rng.choice(("ta", "re", "mon", "li", "so", "ed", "en", "ar", "chu")) for _ in range(rng.randint(1, 4)))
               for _ in range(rng.randint(low, high))]
        text = " ".join(w + rng.choice(("", "", "", "", ",", ".")) for w in out)
        return f"{text.capitalize()}."

    def links(low: int, high: int) -> str:
        items = [f'<a href="/{i}">{words(1, 3)}</a>' for i in range(rng.randint(low, high))]
        if rng.random() < 0.7:
            return "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>"
        return " | ".join(items)

    def box(names: tuple[str, ...], tag: str, inner: str) -> str:
        name = rng.choice(names)
        if rng.random() < 0.5:
            return f"<{tag}>{inner}</{tag}>" if tag != "div" else f'<div class="{name}">{inner}</div>'
        return f'<div {rng.choice(("id", "class"))}="{name}">{inner}</div>'

    def extra(kind: str) -> str:
        if kind == "menu":
            return box(("menu", "navbar", "main-menu", "topnav"), "nav", links(3, 9))
        if kind == "header":
            return box(("header", "site-header", "masthead-header"), "header", words(1, 5) + links(0, 3))
        if kind == "footer":
            return box(("footer", "site-footer", "copyright"), "footer", f"&copy; {words(3, 14)}" + links(0, 4))
        if kind == "side":
            return box(("sidebar", "side", "widget", "related"), "aside", f"<h3>{words(1, 4)}</h3>" + links(2, 8) + (f"<p>{words(8, 30)}</p>" if rng.random() < 0.4 else ""))
        if kind == "ad":
            return box(("ad", "ads", "advert", "banner", "sponsored", "promo"), "div", words(4, 25))
        if kind == "notice":
            return box(("cookie", "cookie-notice", "consent", "notice", "popup"), "div", f"<p>{words(8, 30)}</p><button>{words(1, 2)}</button>")
        if kind == "form":
            return f"<form><label>{words(1, 3)}</label><input><p>{words(3, 14)}</p><button>{words(1, 2)}</button></form>"
        comments = "".join(f'<div class="comment"><b>{words(1, 2)}</b><p>{words(6, 50)}</p></div>' for _ in range(rng.randint(1, 6)))
        return box(("comments", "discussion", "replies"), "section", f"<h3>{words(1, 3)}</h3>{comments}") if rng.random() < 0.5 else f'<div class="comments">{comments}</div>'

    sources, wanted = [], []
    for number in range(count):
        mine = [words(3, 12)]
        body = f"<h1>{mine[0]}</h1>"
        inner = rng.sample(("ad", "side", "form"), rng.choice((0, 0, 0, 1)))
        for _ in range(rng.randint(1, 9)):
            mine.append(words(2, 90))
            kind = rng.random()
            if kind < 0.75:
                body += f"<p>{mine[-1]}" + "</p>" * (rng.random() < 0.8)
            elif kind < 0.85:
                body += f"<h2>{mine[-1]}</h2>"
            elif kind < 0.93:
                body += f"<ul><li>{mine[-1]}</li></ul>"
            else:
                body += f"<blockquote>{mine[-1]}</blockquote>"
            if inner and rng.random() < 0.3:
                body += extra(inner.pop())
        tag = rng.choice(('article', 'main', 'div class="content"', 'div id="post"', "div", "section", 'div class="c7"'))
        article = f"<{tag}>{body}</{tag.split()[0]}>"
        front = "".join(extra(k) for k in ("notice", "header", "menu", "ad", "side") if rng.random() < 0.5)
        back = "".join(extra(k) for k in ("side", "comments", "form", "ad", "notice", "footer") if rng.random() < 0.5)
        middle = f"<div>{article}{extra('side')}</div>" if rng.random() < 0.2 else article
        sources.append(f"<html><head><title>{mine[0]}</title></head><body>{front}{middle}{back}</body></html>")
        wanted.append(mine)
    return sources, wanted


def made_examples(count: int = MADE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sources, wanted = made_pages(count)
    pages = [dom.read(s) for s in sources]
    table = _node_table(pages)
    label = np.zeros(len(table["chars"]), dtype=bool)
    start = 0
    for page, mine in zip(pages, wanted, strict=True):
        known = set(mine)
        for owner, text in zip(page.owner, page.text, strict=True):
            label[start + owner] |= text in known
        start += len(page.tag)
    some = table["chars"] > 0
    return features(table)[some], label[some].astype(float), table["chars"][some]


def page_examples(pages: DataFrame, most: int = PAGES) -> np.ndarray:
    """Features, label and size of text nodes of at most ``most`` pages of the table."""
    drawn = F.xxhash64("page_id", "url").alias("_draw")
    last = pages.select(drawn).orderBy("_draw").limit(most).agg(F.max("_draw")).first()[0]
    if last is None:
        return np.zeros((0, 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column("html"):
                read = [dom.read(value.as_py() or "")]
                table = _node_table(read)
                places, inside = labelled(read, table)
                places = places[:NODES]
                rows = np.column_stack(
                    [features(table)[places], inside[places], table["chars"][places]]
                )
                yield pa.RecordBatch.from_pydict(
                    {"row": pa.array(rows.tolist(), pa.list_(pa.float64()))}
                )

    few = pages.select("html", drawn).filter(F.col("_draw") <= last).select("html")
    rows = few.mapInArrow(run, "row array<double>").limit(most * NODES).collect()
    return np.asarray(sorted(r["row"] for r in rows))


def fit(pages: DataFrame) -> boosting.Boosted:
    """The node classifier, from the table's own pages and made ones."""
    ship(pages.sparkSession)
    x, y, chars = made_examples()
    own = page_examples(pages)
    if len(own):
        x = np.vstack([x, own[:, :-2]])
        y, chars = np.r_[y, own[:, -2]], np.r_[chars, own[:, -1]]
    return boosting.fit(x, y, np.log1p(chars), trees=40, depth=4)


def extract(sources: list[str], model: boosting.Boosted) -> list[str]:
    """Main text of each page."""
    if not sources:
        return []
    pages = [dom.read(s) for s in sources]
    table = _node_table(pages)
    probability = np.zeros(len(table["chars"]))
    some = table["chars"] > 0
    if some.any():
        probability[some] = model.probability(features(table)[some])
    keep = decode(table, probability)
    ends = np.cumsum([len(p.tag) for p in pages])
    return [
        dom.joined(page, keep[end - len(page.tag) : end].tolist())
        for page, end in zip(pages, ends, strict=True)
    ]


def main_text(pages: DataFrame, model: boosting.Boosted | None = None) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every page; no shuffle."""
    model = model or fit(pages)
    spark = ship(pages.sparkSession)
    shared = spark.sparkContext.broadcast(model)  # 40 trees of at most 16 leaves

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                texts = extract([s or "" for s in part.column("html").to_pylist()], shared.value)
                yield pa.RecordBatch.from_pydict(
                    {
                        "page_id": part.column("page_id"),
                        "url": part.column("url"),
                        "text": pa.array(texts, pa.string()),
                        "n_chars": pa.array([len(t) for t in texts], pa.int64()),
                    }
                )

    id_type = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(
        run, f"page_id {id_type}, url string, text string, n_chars bigint"
    )
