"""Main text of web pages by tag-path ratios.

Every text node has a path of tags (with class and id) from the root; only what is never
shown (head, scripts, styles, comments, raw elements, templates) has none. For each path the
text length and the punctuation of its nodes are added up and divided by its nodes; both
ratios are smoothed over the page, multiplied, and paths at or above a part of the standard
deviation are high.

Names decide only where ratios leave it open. An element named like surroundings (menu,
footer, side column, notice, advert, form ...) is left out if it holds less than ``SHARE`` of the
text of high paths; one that holds more, such as a form around a whole page, stays. What
surrounds a high path closest is content: the article or main element, if there is one,
unless text outside of it that no name excuses reaches ``SHARE``. Within content, headers stay
in articles and where they hold the heading, blocks of nothing but links in low paths go,
and all other text nodes stay, however short.

White space within a block (``br`` included) becomes one space; blocks are joined by a
line feed. Null or empty pages give an empty text, repeated rows the same text each. Markup
that is not closed is closed by its parents. Pages are read whole. Extra columns are not
touched.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.text import small_batches

# Part of the standard deviation that a path's fused ratio must reach.
THRESHOLD = 0.3
# Share of the text of high paths from which on a part of the page stays whatever its name.
SHARE = 0.25
# Weights of a node and its neighbours up to two before and after it in the smoothing.
KERNEL = (1.0, 0.6, 0.15)

# Element names of HTML by their kind.
_VOID = {*"area base br col embed hr img input link meta param source track wbr".split()}
_RAW = {*"script style textarea title noscript iframe xmp noembed noframes".split()}
_BLOCK = {
    *"html body article section nav aside header footer main address blockquote center details dialog dd div dl dt".split(),
    *"fieldset figcaption figure form h1 h2 h3 h4 h5 h6 hgroup hr li menu ol p pre summary table tbody td tfoot th thead tr ul".split(),
}
_SECTION = {*"html body article section main div td blockquote".split()}
_CLOSED_BY_ITSELF = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
# Elements that are never shown; elements and words in class, id and role that name what surrounds an article.
_UNSEEN = {"head", "template"} | _RAW
_OUTSIDE_TAGS = {*"nav footer aside form button select option label dialog menu svg object".split()}
_HEADER_WORDS = {*"header masthead topbar banner".split()}
_HEADINGS = {"h1", "h2"}
_OUTSIDE_WORDS = {
    *"ad ads adv advert adverts advertisement advertisements advertising adsense promo promotion promoted sponsor sponsored".split(),
    *"nav navbar navigation menu menubar breadcrumb breadcrumbs toolbar footer foot colophon".split(),
    *"sidebar aside rail widget widgets related recommended recommendations share sharing social follow".split(),
    *"cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe subscription signup login".split(),
    *"comment comments commentlist disqus replies reply respond discussion form search pagination pager copyright legal".split(),
}
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>", re.S
)
_NAMES = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？¿¡]")


class _Element:
    __slots__ = ("tag", "path", "unseen")

    def __init__(self, tag: str, attributes: str, parent: _Element | None):
        names = [next(filter(None, m.groups()[1:]), "") for m in _NAMES.finditer(attributes)] if attributes else []
        label = ".".join([tag, *" ".join(names).split()])
        self.tag = tag
        self.path: tuple[str, ...] = (*parent.path, label) if parent else (label,)
        self.unseen = bool(parent and parent.unseen or tag in _UNSEEN)


def text_nodes(page: str) -> list[tuple[tuple[str, ...], int, str]]:
    """Path, block number and text of all nodes that are shown, in page order."""
    stack: list[_Element] = []
    out, block, at = [], 0, 0

    def pop_to(tag: str, walls: set[str]) -> bool:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i].tag == tag:
                del stack[i:]
                return True
            if stack[i].tag in walls:
                return False
        return False

    def say(text: str) -> None:
        if text and not (stack and stack[-1].unseen):
            out.append((stack[-1].path if stack else (), block, html.unescape(text)))

    while m := _TAG.search(page, at):
        say(page[at : m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        block += tag in _BLOCK
        if m[1] or m[4]:
            # An end tag of an inline element stays within its block.
            pop_to(tag, set() if tag in _BLOCK else _BLOCK)
            continue
        if tag in _BLOCK:
            pop_to("p", _BLOCK - {"p"})
        if tag in _CLOSED_BY_ITSELF:
            pop_to(tag, _CLOSED_BY_ITSELF[tag])
        if tag in _VOID:
            if tag == "br":
                say(" ")
            continue
        attributes = m[3] or m[6] or ""
        if tag in _RAW:
            end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(page, at)
            at = end.start() if end else len(page)
            stack.append(_Element(tag, attributes, stack[-1] if stack else None))
        elif not attributes.endswith("/") or tag in _BLOCK:
            stack.append(_Element(tag, attributes, stack[-1] if stack else None))
    say(page[at:])
    return out


def _ratios(nodes: list[tuple[tuple[str, ...], int, str]]) -> dict[tuple[str, ...], float]:
    """Fused ratio of every path: smoothed mean text length times smoothed mean punctuation."""
    totals: dict[tuple[str, ...], list[int]] = {}
    for path, _, text in nodes:
        own = totals.setdefault(path, [0, 0, 0])
        own[0] += 1
        own[1] += len(text.strip())
        own[2] += len(_PUNCTUATION.findall(text))
    length, marks = (np.array([totals[p][k] / totals[p][0] for p, _, _ in nodes]) for k in (1, 2))
    kernel = np.array([*KERNEL[:0:-1], *KERNEL])
    weight = np.convolve(np.ones(len(nodes)), kernel)[len(KERNEL) - 1 : len(KERNEL) - 1 + len(nodes)]
    smooth = lambda x: np.convolve(x, kernel)[len(KERNEL) - 1 : len(KERNEL) - 1 + len(nodes)] / weight
    fused = smooth(length) * smooth(1 + marks)
    sums: dict[tuple[str, ...], list[float]] = {}
    for (path, _, _), value in zip(nodes, fused):
        own = sums.setdefault(path, [0, 0.0])
        own[0] += 1
        own[1] += value
    return {p: v / n for p, (n, v) in sums.items()}


def _tag(label: str) -> str:
    return label.split(".")[0]


@lru_cache(1 << 16)
def _named(label: str) -> str:
    """What an element's names say it is: ``"outside"``, ``"header"`` or nothing."""
    tag, _, names = label.partition(".")
    if tag in ("html", "body", "article", "main"):
        return ""
    words = {w.lower() for w in _WORDS.findall(names)}
    if tag in _OUTSIDE_TAGS or words & _OUTSIDE_WORDS:
        return "outside"
    return "header" if tag == "header" or words & _HEADER_WORDS else ""


def _prefix_sums(of_paths: dict[tuple[str, ...], int]) -> dict[tuple[str, ...], int]:
    sums: dict[tuple[str, ...], int] = {}
    for path, n in of_paths.items():
        for i in range(len(path) + 1):
            sums[path[:i]] = sums.get(path[:i], 0) + n
    return sums


def _containers(high: dict[tuple[str, ...], int], sizes: dict[tuple[str, ...], int], open_: set[tuple[str, ...]]) -> set[tuple[str, ...]]:
    """What surrounds the high paths that are open: article or main, else sections that are mostly text of open paths."""
    inside = _prefix_sums({p: n for p, n in sizes.items() if p in open_})
    found: set[tuple[str, ...]] = set()
    for path in (p for p in high if p in open_):
        article = next((i for i, label in enumerate(path) if _tag(label) in ("article", "main")), None)
        if article is not None:
            found.add(path[: article + 1])
            continue
        end = next((i + 1 for i in range(len(path) - 1, -1, -1) if _tag(path[i]) in _SECTION), 0)
        while end > 1 and _tag(path[end - 2]) not in ("html", "body") and 2 * inside[path[:end]] >= inside[path[: end - 1]]:
            end -= 1
        found.add(path[:end])
    articles = {p for p in found if p and _tag(p[-1]) in ("article", "main")}
    above = {p[:i] for p in articles for i in range(len(p) + 1)}
    held = others = 0
    for path, n in high.items():
        if any(path[:i] in articles for i in range(len(path) + 1)):
            held += n
        elif path in open_ and not any(_named(path[i]) and path[: i + 1] not in above for i in range(len(path))):
            others += n
    return articles if articles and others < SHARE * (held + others) else found


def main_text(page: str | None) -> str:
    """The article of one page."""
    nodes = text_nodes(page) if page else []
    full = [n for n in nodes if n[2].strip()]
    if not full:
        return ""
    ratios = _ratios(full)
    values = np.array([ratios[p] for p, _, _ in full])
    least = min(THRESHOLD * values.std(), values.max())
    sizes: dict[tuple[str, ...], int] = {}
    for path, _, text in full:
        sizes[path] = sizes.get(path, 0) + len(text.strip())
    high = {p: n for p, n in sizes.items() if ratios[p] >= least}
    mass = _prefix_sums(high)
    heads = {p[:i] for p in sizes if any(_tag(label) in _HEADINGS for label in p) for i in range(len(p) + 1)}

    # Paths whose names exclude nothing; those that stay if they lie within content; those that stay as a part of a line.
    open_, within, inline = set(), set(), set()
    for path in sizes:
        weak = [i for i, label in enumerate(path) if _named(label) and mass.get(path[: i + 1], 0) < SHARE * mass[()]]
        first = next((i for i, label in enumerate(path) if _tag(label) in ("article", "main")), len(path))
        against = [_tag(path[i]) for i in weak if _named(path[i]) != "header" or i < first and path[: i + 1] not in heads]
        if not against:
            within.add(path)
        elif not any(tag in _BLOCK or tag in _OUTSIDE_TAGS for tag in against):
            inline.add(path)
        if all(_named(path[i]) == "header" and i > first for i in weak):
            open_.add(path)
    inside = _containers(high, sizes, open_)
    if not inside:  # only names are left to go by, and they exclude everything
        open_ = within = set(sizes)
        inside = _containers(high, sizes, open_)
    ends = {len(c) for c in inside}
    blocks: dict[int, list[str]] = {}
    other: set[int] = set()
    for path, block, text in nodes:
        if any(path[:i] in inside for i in ends) and (path in within or path in inline or not text.strip()):
            blocks.setdefault(block, []).append(text)
            if path in within and text.strip() and (path in high or not any(_tag(label) == "a" for label in path)):
                other.add(block)
    lines = (" ".join("".join(parts).split()) for block, parts in blocks.items() if block in other)
    return "\n".join(line for line in lines if line)


def extract(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            texts = [main_text(p) for p in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return rows.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
