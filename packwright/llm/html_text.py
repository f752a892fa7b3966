"""Main text of web pages by a tree-structured graphical model.

The block elements of a page form a tree. Each has a hidden state, main text or boilerplate. A
unary potential weighs an element's tag, class and id words, text and links; a potential on every
edge weighs the states of parent and child. Sum-product messages go from the leaves up to the root
and down again, which gives the exact marginal of every element; the text of elements whose
marginal reaches one half is the main text. The weights are fitted to labelled pages
(:mod:`packwright.llm.html_pages`) by gradient steps: observed minus expected counts, the latter
from the same messages.

Blocks are runs of text between the bounds of block elements; inline tags and ``br`` do not end one.
Character references are decoded, white space inside a block becomes one space, blocks are trimmed,
empty ones go, and the rest are joined in page order by two line breaks. Scripts, styles,
templates, drawings, comments and other markup have no text; neither do forms' controls. The text of
formulas and of fallbacks (``math``, ``object``, ``noscript``) is part of the block around it.

Null, empty and text-free pages give an empty text. Broken markup is read as far as it goes: open
elements end with their parent, unknown ends are ignored. Pages of any length and depth are read
whole. Repeated rows give repeated results.
"""

from __future__ import annotations

import functools
import html
import math
import re
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packwright.llm.frames import STEP_BYTES, batch, steps, strings, task_map
from packwright.llm.html_pages import labelled_pages

# HTML elements by how they are read.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Read up to the end tag, or to the end of the page without one, and without text.
RAW = set("script style textarea title iframe noframes xmp".split())
#: Elements whose text is none of the page's; block elements inside start no block.
MUTE = set("template svg select".split())
#: Inline elements that may hold blocks: their end tags end these too.
HOLDS = MUTE | set("math noscript object".split())
#: Start tags that stay inside an open ``select``; other blocks and controls end it.
IN_SELECT = set("option hr button legend".split())
BLOCK = set(
    "html head body address article aside blockquote button caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: A start tag that ends an open element of these names, unless one of the second lies between.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: Words of classes and ids that speak for or against main text.
AGAINST = re.compile(
    r"(?:^|[^a-z])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|nav\w*|menu|breadcrumbs?|header|masthead|footer|side(?:bar)?|widget\w*|related|recommend\w*|"
    r"share|social|comments?|disqus\w*|respon[ds]\w*|cookies?|consent|notice|popup|modal|newsletter|subscri\w*|login|search|pag(?:er|ination)|copyright|legal)(?![a-z])"
)
FOR = re.compile(r"(?:^|[^a-z])(?:article|content|post|entry|story|main|body|text)(?![a-z])")

_NAME = re.compile(r"(/)?([a-zA-Z][^\s/>]*)")
_STOP = re.compile(r"""[>"']""")
_NAMED = re.compile(r"""(?:^|[\s"'/])(class|id|role|style|hidden|data-main|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.IGNORECASE)

FEATURES = (
    "bias article main section div p heading list item table quote_or_code body nav aside footer header form button_or_label other "
    "against for hidden role_navigation link_share long_text short_text no_text sentence copyright"
).split()
_AT = {name: i for i, name in enumerate(FEATURES)}
_KIND = {t: t for t in ("article", "main", "section", "div", "p", "body", "nav", "aside", "footer", "header", "form")}
_KIND |= {f"h{i}": "heading" for i in range(1, 7)} | dict.fromkeys(("ul", "ol", "dl", "menu"), "list") | dict.fromkeys(("li", "dt", "dd"), "item")
_KIND |= dict.fromkeys(("table", "tbody", "thead", "tfoot", "tr", "td", "th", "caption"), "table") | dict.fromkeys(("blockquote", "pre", "figure", "figcaption"), "quote_or_code")
_KIND |= dict.fromkeys(("button", "label", "legend", "option", "fieldset"), "button_or_label")


class Page:
    """The block elements of a page, parents before children, and its text runs in order."""

    def __init__(self) -> None:
        self.tags, self.parents, self.marks = ["#page"], [-1], [""]
        self.chars, self.linked = [0], [0]
        self.blocks: list[tuple[int, str]] = []


class Tags:
    """Tags of a page, found in time in proportion to its length, whatever is broken in it."""

    def __init__(self, source: str) -> None:
        self.source, self.last = source, source.rfind(">")
        self.final = {quote: source.rfind(quote) for quote in "\"'"}
        self.dead: set[int] = set()

    def after(self, at: int) -> tuple[int, int, str, str, str] | None:
        """``(start, end, kind, name, rest)`` of the next tag; the kind is ``!``, ``/``, ``bad`` or empty."""
        while True:
            start = self.source.find("<", at)
            if start < 0:
                return None
            if self.source[start + 1 : start + 2] in ("!", "?"):
                return start, start + 2, "!", "", ""
            found = _NAME.match(self.source, start + 1) if start < self.last else None
            if found is None:
                at = start + 1
                continue
            end = self._close(found.end())
            if end is None:
                # Quotes that never close: the tag ends at the first bracket.
                return start, self.source.find(">", start) + 1, "bad", "", ""
            return start, end, found[1] or "", found[2].lower(), self.source[found.end() : end - 1]

    def _close(self, at: int) -> int | None:
        """End of the tag that goes on at ``at``, outside quotes.

        Places from which no end is in reach are remembered, so that no stretch is searched twice.
        """
        passed = []
        while at not in self.dead:
            passed.append(at)
            found = _STOP.search(self.source, at)
            if found is None:
                break
            if found[0] == ">":
                return found.end()
            if found.start() == self.final[found[0]]:
                break
            at = self.source.find(found[0], found.end()) + 1
        self.dead.update(passed)
        return None


def parse(source: str) -> Page:
    """The tree of a page and its blocks."""
    page, open_, run, tags = Page(), [("#page", 0)], [], Tags(source)
    at, size, links = 0, len(source), 0
    mute = 0  # where the outermost element without text is among the open ones; 0 if none is open
    where: dict[str, list[int]] = {}  # places of each name among the open elements
    blocks = [0]  # places of the block elements among them
    endless: set[str] = set()  # names without an end tag in the rest of the page

    def last(name: str) -> int:
        places = where.get(name)
        return places[-1] if places else 0

    def push(name: str, node: int) -> None:
        where.setdefault(name, []).append(len(open_))
        if name in BLOCK:
            blocks.append(len(open_))
        open_.append((name, node))

    def flush() -> None:
        if run:
            text = " ".join(html.unescape("".join(run)).split())
            run.clear()
            if text:
                node = open_[-1][1]
                page.blocks.append((node, text))
                page.chars[node] += len(text)

    def close_to(depth: int) -> None:
        nonlocal links, mute
        if any(name in BLOCK for name, _ in open_[depth : mute or None]):
            flush()
        for name, _ in open_[depth:]:
            links -= name == "a"
            where[name].pop()
        del open_[depth:]
        while blocks[-1] >= depth:
            blocks.pop()
        if mute >= depth:
            mute = 0

    def text(upto: int) -> None:
        if upto > at and not mute:
            run.append(source[at:upto])
            if links > 0:
                page.linked[open_[-1][1]] += upto - at

    while at < size:
        found = tags.after(at)
        if found is None:
            text(size)
            break
        start, end, kind, name, rest = found
        text(start)
        at = end
        if kind == "!":
            note = source.startswith("--", at)
            stop = source.find("-->" if note else ">", at + 2 * note)
            at = size if stop < 0 else stop + (3 if note else 1)
            continue
        if kind == "bad":
            continue
        if kind == "/":
            # An inline end does not close blocks.
            if last(name) and (name in BLOCK or name in HOLDS or blocks[-1] < last(name)):
                close_to(last(name))
            continue
        foreign = last("svg") or last("math")
        if rest.endswith("/") and (foreign or name in ("svg", "math")):
            continue
        if last("select") and name not in IN_SELECT and (name in BLOCK or name in ("select", "textarea", "input")):
            close_to(last("select"))
        foreign = last("svg") or last("math")  # closing a control may have ended it
        if foreign and name in BLOCK and not last("foreignobject"):
            close_to(foreign)
        if name in RAW:
            stop = None if name in endless else re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.IGNORECASE).search(source, at)
            if stop is None:
                endless.add(name)
            if stop is None and foreign:
                push(name, open_[-1][1])  # an ordinary element there
                continue
            stop = size if stop is None else source.find(">", stop.end())
            at = size if stop < 0 or stop == size else stop + 1
            continue
        if name in VOID:
            if mute:
                continue
            if name == "hr":
                flush()
            elif name in ("br", "wbr") and run:
                run.append(" " if name == "br" else "")
            continue
        if name not in BLOCK or mute:
            links += name == "a"
            if name in MUTE:
                mute = mute or len(open_)
            push(name, open_[-1][1])
            continue
        flush()
        if last("p") and last("p") == blocks[-1]:
            close_to(last("p"))  # a block ends an open paragraph
        if name in ENDS:
            ended, bounds = ENDS[name]
            bound = max(last(b) for b in bounds)
            inside = [where[e][i] for e in ended if e in where and (i := bisect_right(where[e], bound)) < len(where[e])]
            if inside:
                close_to(min(inside))
        page.tags.append(name)
        page.parents.append(open_[-1][1])
        page.marks.append(rest)
        page.chars.append(0)
        page.linked.append(0)
        push(name, len(page.tags) - 1)
    flush()
    return page


def features(page: Page) -> tuple[list[list[int]], list[bool]]:
    """Active features of every element, and whether a label marks it as main text."""
    first: dict[int, str] = {}
    for node, text in page.blocks:
        first.setdefault(node, text)
    found, main = [], []
    for node, tag in enumerate(page.tags):
        own = [0, _AT[_KIND.get(tag, "other")]]
        is_main = False
        if page.marks[node].strip(" /"):
            given = {k.lower(): (v or "").strip("\"'").lower() for k, v in _NAMED.findall(page.marks[node])}
            words = given.get("class", "") + " " + given.get("id", "")
            if AGAINST.search(words):
                own.append(_AT["against"])
            elif FOR.search(words):
                own.append(_AT["for"])
            if "hidden" in given or "display:none" in given.get("style", "").replace(" ", "") or given.get("aria-hidden") == "true":
                own.append(_AT["hidden"])
            if given.get("role", "") in ("navigation", "banner", "contentinfo", "complementary", "search", "alert", "dialog"):
                own.append(_AT["role_navigation"])
            is_main = "data-main" in given
        chars = page.chars[node]
        if chars == 0:
            own.append(_AT["no_text"])
        else:
            own.append(_AT["long_text"] if chars > 80 else _AT["short_text"])
            if page.linked[node] * 2 > chars:
                own.append(_AT["link_share"])
            text = first[node]
            if text[-1] in ".!?":
                own.append(_AT["sentence"])
            if text[0] == "\xa9":
                own.append(_AT["copyright"])
        found.append(own)
        main.append(is_main)
    return found, main


#: Parents whose edges have potentials of their own.
_FRAMES = ("article", "main")


def edge_kinds(page: Page) -> list[int]:
    """Which of the two tables of edge potentials holds above each element."""
    return [0] + [int(page.tags[p] in _FRAMES) for p in page.parents[1:]]


def _tables(pair) -> list[tuple[float, ...]]:
    return [tuple(math.exp(x) for x in pair[at : at + 4]) for at in (0, 4)]


def _bounded(odds: float) -> float:
    return math.exp(min(max(odds, -40.0), 40.0))


def marginals(parents: list[int], kinds: list[int], unary: list[float], pair, edges: list[float] | None = None) -> list[float]:
    """Log odds of main text of every element, by messages up and down the tree.

    ``unary`` is the log odds of an element by itself; ``pair`` holds, for each kind of edge, the
    log potentials of (parent, child) states 00, 01, 10, 11. Elements come after their parents.
    The expected counts of the states of edges are added to ``edges``.
    """
    tables, log = _tables(pair), math.log
    up, sent = list(unary), [0.0] * len(parents)
    for node in range(len(parents) - 1, 0, -1):
        p00, p01, p10, p11 = tables[kinds[node]]
        own = _bounded(up[node])
        sent[node] = log((p10 + p11 * own) / (p00 + p01 * own))
        up[parents[node]] += sent[node]
    for node in range(1, len(parents)):
        p00, p01, p10, p11 = tables[kinds[node]]
        above = _bounded(up[parents[node]] - sent[node])
        if edges is not None:
            own = _bounded(up[node])
            joint = (p00, p01 * own, p10 * above, p11 * above * own)
            total = sum(joint)
            for k in range(4):
                edges[4 * kinds[node] + k] += joint[k] / total
        up[node] += log((p01 + above * p11) / (p00 + above * p10))
    return up


@functools.lru_cache(maxsize=1)
def fit(rounds: int = 100, rate: float = 0.5, shrink: float = 0.005) -> tuple[tuple[float, ...], tuple[float, ...]]:
    """Weights of features and of edge states, by Adagrad on the likelihood of labelled pages."""
    data = []
    for source in labelled_pages():
        page = parse(source)
        found, marked = features(page)
        state = []
        for node, parent in enumerate(page.parents):
            # Parts that are boilerplate by class stay so inside the frame of the main text.
            apart = _AT["against"] in found[node] or page.tags[node] in ("aside", "form", "nav", "footer", "header")
            state.append(bool(marked[node] or (parent >= 0 and state[parent] and not apart)))
        data.append((page.parents, edge_kinds(page), found, state))
    weights, pair = np.zeros(len(FEATURES)), np.zeros(8)
    seen_w, seen_p = np.full(len(FEATURES), 1e-6), np.full(8, 1e-6)
    for _ in range(rounds):
        slope_w, slope_p = -shrink * weights, -shrink * pair
        now = weights.tolist()
        for parents, kinds, found, state in data:
            expected = [0.0] * 8
            odds = marginals(parents, kinds, [sum(now[f] for f in own) for own in found], pair.tolist(), expected)
            for own, z, s in zip(found, odds, state, strict=True):
                slope_w[own] += s - 1 / (1 + _bounded(-z))
            for node in range(1, len(parents)):
                slope_p[4 * kinds[node] + 2 * state[parents[node]] + state[node]] += 1
            slope_p -= expected
        seen_w += slope_w**2
        seen_p += slope_p**2
        weights += rate * slope_w / np.sqrt(seen_w)
        pair += rate * slope_p / np.sqrt(seen_p)
    return tuple(weights.tolist()), tuple(pair.tolist())


def main_text(source: str, model: tuple) -> str:
    """The main text of one page."""
    page = parse(source)
    if not page.blocks:
        return ""
    weights, pair = model
    odds = marginals(page.parents, edge_kinds(page), [sum(weights[f] for f in own) for own in features(page)[0]], pair)
    return "\n\n".join(text for node, text in page.blocks if odds[node] >= 0)


def extract(df: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``(*keep, text, n_chars)`` of every page; ``n_chars`` counts code points."""
    model = df.sparkSession.sparkContext.broadcast(fit())
    source = df.select(F.struct(*[F.col(c) for c in keep]).alias("rest"), F.col(html_col).cast("string").alias("text"))

    def run(batches):
        schema = None
        for part in steps(batches, STEP_BYTES):
            texts = [main_text(t, model.value) for t in strings(part.column("text"))]
            schema = schema or pa.schema([part.schema.field("rest"), ("text", pa.string()), ("n_chars", pa.int64())])
            yield batch(schema, rest=part.column("rest"), text=texts, n_chars=[len(t) for t in texts])

    rest = source.schema["rest"].dataType.simpleString()
    found = task_map(source, run, f"rest {rest}, text string, n_chars bigint")
    return found.select(*[F.col("rest").getField(c).alias(c) for c in keep], "text", "n_chars")
