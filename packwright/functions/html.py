"""Fields of a paper page.

Titles and links come from native expressions. Sections need to know how elements nest, so
they come from one Arrow-batched function around a small tree built with ``html.parser``.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from html.entities import html5
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from packwright.functions.text import WHITESPACE, strip

# Defaults, link pattern and section headings.
NO_TITLE = "Untitled Paper"
NO_ABSTRACT = "No abstract found"
REPOSITORY_HOSTS = ("github.com", "gitlab.com", "figshare.com", "zenodo.org", "doi.org")
METHODS_HEADING = "Methods|Methodology|Materials and Methods"
RESULTS_HEADING = "Results"

# The named entities most pages keep to.
ENTITIES = {
    "lt": "<",
    "gt": ">",
    "quot": '"',
    "apos": "'",
    "nbsp": "\xa0",
    "amp": "&",
}

_HIDDEN = r"(?is)<!--.*?-->|<(script|style|template)\b[^>]*>.*?</\1\s*>"
_H1 = r"(?is)<h1(?:\s[^>]*)?>.*?</h1\s*>"
_HREF = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)"""
_FIGCAPTION = r"(?is)<figcaption(?:\s[^>]*)?>(.*?)</figcaption\s*>"
_FIGURE = r"(?is)<figure(?:\s[^>]*)?>(.*?)</figure\s*>"
_TAG = r"(?s)<[^>]*>"


def visible_markup(html: Column) -> Column:
    """Markup without comments, scripts and styles."""
    return F.regexp_replace(html, _HIDDEN, "")


def _numeric_entity(piece: Column) -> Column:
    """Decode the text after ``&#`` when it starts with a code point and a semicolon."""
    digits = F.regexp_extract(piece, r"^([0-9]{1,7});", 1)
    hexits = F.regexp_extract(piece, r"^[xX]([0-9A-Fa-f]{1,6});", 1)
    code = F.when(digits != "", F.lpad(F.hex(digits.try_cast("bigint")), 8, "0")).when(
        hexits != "", F.lpad(hexits, 8, "0")
    )
    in_range = (code <= "0010FFFF") & ~F.upper(code).between("0000D800", "0000DFFF")
    character = F.decode(F.unhex(F.when(in_range, code)), "UTF-32")
    tail = F.substr(piece, F.instr(piece, ";") + F.lit(1))
    return F.coalesce(F.concat(character, tail), F.concat(F.lit("&#"), piece))


def _named_entity(piece: Column) -> Column:
    """Decode the text after ``&`` when it starts with a name of HTML and a semicolon."""
    name = F.regexp_extract(piece, r"^([A-Za-z][A-Za-z0-9]{1,31});", 1)
    known = F.lit(None).cast("string")
    for entity, character in ENTITIES.items():
        known = F.when(name == entity, F.lit(character)).otherwise(known)
    # The table of all names comes from the standard library; it is searched for rare ones only.
    names = json.dumps({k[:-1]: v for k, v in html5.items() if k.endswith(";")})
    others = F.try_element_at(F.from_json(F.lit(names), "map<string,string>"), name)
    character = F.when(name == "", F.lit(None)).otherwise(F.coalesce(known, others))
    tail = F.substr(piece, F.length(name) + F.lit(2))
    return F.coalesce(F.concat(character, tail), F.concat(F.lit("&"), piece))


def decode_entities(text: Column) -> Column:
    """Decode numeric entities and the named ones of HTML, each once."""

    def decoded(piece: Column, i: Column) -> Column:
        numeric = _numeric_entity(F.substr(piece, F.lit(2)))
        return (
            F.when(i == 0, piece)
            .when(F.startswith(piece, F.lit("#")), numeric)
            .otherwise(_named_entity(piece))
        )

    return F.array_join(F.transform(F.split(text, "&"), decoded), "")


def inner_text(markup: Column, separator: str = "") -> Column:
    """Text of a fragment: every string between tags stripped, empty ones dropped, joined."""
    strings = F.transform(F.split(markup, _TAG), lambda s: strip(decode_entities(s)))
    return F.array_join(F.filter(strings, lambda s: s != ""), separator)


def page_title(html: Column) -> Column:
    """Text of the first ``h1``, or the default title when the page has none."""
    found = F.nullif(F.regexp_extract(visible_markup(html), _H1, 0), F.lit(""))
    return F.coalesce(inner_text(found), F.lit(NO_TITLE))


def link_pattern(hosts: tuple[str, ...] = REPOSITORY_HOSTS) -> str:
    """Pattern a repository link has to start with."""
    joined = "|".join(re.escape(h) for h in hosts)
    return rf"^https?://({joined})[\w\-./%]+"


def page_hrefs(html: Column) -> Column:
    """Every ``href`` of an ``a`` element, decoded, in page order."""
    quoted = F.regexp_extract_all(visible_markup(html), F.lit(_HREF), F.lit(1))
    return F.transform(quoted, lambda h: decode_entities(F.trim(h, F.lit("\"'"))))


def repository_links(html: Column, hosts: tuple[str, ...] = REPOSITORY_HOSTS) -> Column:
    """Distinct links to the given hosts, sorted."""
    pattern = F.lit(link_pattern(hosts))
    kept = F.filter(page_hrefs(html), lambda h: F.rlike(h, pattern))
    return F.array_sort(F.array_distinct(kept))


def flat_figure_captions(html: Column) -> Column:
    """Caption of each figure that has a ``figcaption``, in page order."""
    figures = F.regexp_extract_all(visible_markup(html), F.lit(_FIGURE), F.lit(1))
    with_caption = F.filter(figures, lambda f: F.rlike(f, F.lit(_FIGCAPTION)))
    return F.transform(
        with_caption, lambda f: inner_text(F.regexp_extract(f, _FIGCAPTION, 1))
    )


def flat_section(html: Column, heading: str) -> Column:
    """Text under the first matching ``h2``/``h3`` of a page whose headings are siblings.

    For pages with wrapped headings use :func:`page_sections`, which follows the nesting.
    """
    opening = rf"(?is)<h[23](?:\s[^>]*)?>[^<]*(?:{heading})[^<]*</h[23]\s*>(.*?)(?:<h[23][\s>]|</body|$)"
    return inner_text(F.regexp_extract(visible_markup(html), opening, 1), "\n")


# --- sections that depend on nesting ---------------------------------------------------

# Fixed values from the HTML standard: elements without content, hidden text, and elements
# whose start ends an open paragraph or a sibling of their own kind.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
HIDDEN = frozenset(("script", "style", "template"))
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr main nav ol p pre section table ul".split()
)
ENDS_SIBLING = {
    "li": ("li",),
    "dd": ("dd", "dt"),
    "dt": ("dd", "dt"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "tr": ("td", "th", "tr"),
    "option": ("option",),
}

SECTIONS = (
    "abstract string, methods string, results string, captions string, status string, reason string"
)
OK, QUARANTINED = "ok", "quarantined"

# Pages without any of these elements have the default sections and need no tree.
_NESTED = r"(?i)<(section|h2|h3|figure)[\s/>]"


class _Node:
    __slots__ = ("attrs", "children", "name", "parent")

    def __init__(self, name, attrs, parent):
        self.name, self.attrs, self.parent, self.children = name, attrs, parent, []

    def walk(self):
        """This element's descendants in document order (no recursion: pages nest deeply)."""
        stack = list(reversed(self.children))
        while stack:
            item = stack.pop()
            yield item
            if isinstance(item, _Node) and item.name not in HIDDEN:
                stack.extend(reversed(item.children))

    def elements(self):
        return (item for item in self.walk() if isinstance(item, _Node))

    def text(self, separator):
        if self.name in HIDDEN:
            return ""
        strings = (s.strip(WHITESPACE) for s in self.walk() if isinstance(s, str))
        return separator.join(s for s in strings if s)

    def sole_string(self):
        node = self
        while isinstance(node, _Node):
            if len(node.children) != 1:
                return None
            node = node.children[0]
        return node


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.open = _Node("", {}, None)
        self.names = Counter()  # of the open elements, so that an end without start costs nothing

    def handle_starttag(self, tag, attrs):
        if tag in ENDS_PARAGRAPH and self.open.name == "p":
            self.close_open()
        while self.open.name in ENDS_SIBLING.get(tag, ()):
            self.close_open()
        node = _Node(tag, {k: v or "" for k, v in reversed(attrs)}, self.open)
        self.open.children.append(node)
        if tag not in VOID:
            self.open = node
            self.names[tag] += 1

    def close_open(self):
        self.names[self.open.name] -= 1
        self.open = self.open.parent

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if self.names[tag]:
            while self.open.name != tag:
                self.close_open()
            self.close_open()

    def handle_data(self, data):
        siblings = self.open.children
        if siblings and isinstance(siblings[-1], str):
            siblings[-1] += data
        else:
            siblings.append(data)


def _section_text(elements, heading):
    for node in elements:
        if node.name in ("h2", "h3"):
            title = node.sole_string()
            if title is not None and heading.search(title):
                break
    else:
        return ""
    siblings = node.parent.children
    after = siblings[next(i for i, s in enumerate(siblings) if s is node) + 1 :]
    parts = []
    for sibling in after:
        if isinstance(sibling, _Node):
            if sibling.name in ("h2", "h3"):
                break
            parts.append(sibling.text("\n"))
    return "\n".join(parts)


def _abstract(elements):
    for node in elements:
        if node.name == "section" and "abs" in node.attrs.get("aria-labelledby", "").lower():
            return node.text("\n")
    return NO_ABSTRACT


def _caption(figure):
    inside = list(figure.elements())
    named = [n for n in inside if n.name == "figcaption"]
    by_class = [
        n
        for n in inside
        if any("caption" in c.lower() for c in n.attrs.get("class", "").split())
    ]
    return next((n.text("") for n in named + by_class), None)


def parse_sections(html: str | None, methods: str, results: str) -> tuple[str, ...]:
    """(abstract, methods, results, captions) of one page."""
    if not html:
        return NO_ABSTRACT, "", "", ""
    tree = _Tree()
    tree.feed(html)
    tree.close()
    elements = list(tree.root.elements())
    captions = (_caption(n) for n in elements if n.name == "figure")
    return (
        _abstract(elements),
        _section_text(elements, re.compile(methods, re.IGNORECASE)),
        _section_text(elements, re.compile(results, re.IGNORECASE)),
        "\n".join(c for c in captions if c is not None),
    )


def judged_sections(html: str | None, methods: str, results: str) -> tuple[str | None, ...]:
    """:func:`parse_sections` with ``status, reason``; a page that cannot be parsed is kept aside."""
    try:
        return *parse_sections(html, methods, results), OK, None
    except (AssertionError, RecursionError, ValueError) as error:
        return None, None, None, None, QUARANTINED, f"cannot parse: {type(error).__name__}"


def judged_pages(pages, methods: str, results: str) -> list[tuple[str | None, ...]]:
    """:func:`judged_sections` of each page; equal pages of a batch are parsed only once."""
    judged: dict[str | None, tuple[str | None, ...]] = {}
    for page in pages:
        if page not in judged:
            judged[page] = judged_sections(page, methods, results)
    return [judged[page] for page in pages]


def page_sections(
    html: Column, methods: str = METHODS_HEADING, results: str = RESULTS_HEADING
) -> Column:
    """Struct ``abstract, methods, results, captions, status, reason``.

    Each page is parsed once (equal pages of a batch together), and only pages that have
    sections, headings or figures at all travel to the parser.
    """

    @F.pandas_udf(SECTIONS)
    def sections(pages: pd.Series) -> pd.DataFrame:
        rows = judged_pages(pages, methods, results)
        columns = ["abstract", "methods", "results", "captions", "status", "reason"]
        return pd.DataFrame(rows, columns=columns, dtype=object)

    return sections(F.when(F.rlike(html, F.lit(_NESTED)), html))
