"""Column functions that turn text, links and paths into fields.

Every function takes and returns a ``Column`` built only from native expressions, so a
projection that uses them stays inside whole-stage code generation and needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters removed by Python's str.strip().
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Section markers of a competition page, and the noise before a section.
DESCRIPTION, BACKGROUND, EVALUATION = "Description", "Background", "Evaluation"
END_MARKERS = ("Timeline", "Prizes & Awards", "Code", "Data")
SECTION_PREFIX = "link keyboard_arrow_up"

# Pattern of a numbered figure caption in plain text, and the text for none.
CAPTION_PATTERN = r"(Fig\.|Figure)(?U:\s)(?U:(\d+))(?U:\s*)\|([^\n]*)"
NO_CAPTION = "未找到明确的图表标题。"

# Extensions by role in an unpacked repository ('' = no extension).
DATA_FILE_EXTENSIONS = (".csv", ".json", ".txt", "")
CODE_FILE_EXTENSIONS = (".py", ".ipynb")

# Fixed value: characters of a long field kept in a prompt.
CONTEXT_CHARACTERS = 4000

FENCE = "```"
PYTHON_FENCE = "```python"


def strip(text: Column) -> Column:
    """Remove leading and trailing Unicode whitespace."""
    return F.trim(text, F.lit(WHITESPACE))


# --- sections, captions and code -------------------------------------------------------


def marker_slice(
    text: Column,
    start: str,
    ends: Sequence[str],
    *,
    to_end: bool = False,
    prefix: str = SECTION_PREFIX,
) -> Column:
    """Text after the first ``start`` up to the earliest of ``ends``.

    ``to_end=True`` lets the slice run to the end of the text when no end marker follows.
    Otherwise, and whenever ``start`` is absent, the result is a fixed message.
    """
    start_at = F.instr(text, start)
    rest = F.substr(text, start_at + F.lit(len(start)))
    found = [F.nullif(F.instr(rest, end), F.lit(0)) for end in ends]
    end_at = F.least(*found) if len(found) > 1 else found[0]
    cut = F.when(end_at.isNotNull(), F.substr(rest, F.lit(1), end_at - 1))
    if to_end:
        cut = cut.otherwise(rest)
    body = strip(cut)
    without_prefix = F.when(
        F.startswith(body, F.lit(prefix)), F.substr(body, F.lit(len(prefix) + 1))
    ).otherwise(body)
    message = F.lit(f"Could not find markers to slice '{start}'.")
    return F.when(text.isNull(), None).otherwise(
        F.coalesce(F.when(start_at > 0, strip(without_prefix)), message)
    )


def competition_sections(text: Column) -> dict[str, Column]:
    """The three sections of a competition page, by output name."""
    return {
        "description": marker_slice(text, DESCRIPTION, [BACKGROUND]),
        "background": marker_slice(text, BACKGROUND, [EVALUATION]),
        "evaluation": marker_slice(text, EVALUATION, END_MARKERS, to_end=True),
    }


def numbered_captions(text: Column) -> Column:
    """Array of ``(number, caption)`` for each ``Fig. n | caption`` in the text, in order."""
    numbers = F.regexp_extract_all(text, F.lit(CAPTION_PATTERN), F.lit(2))
    captions = F.regexp_extract_all(text, F.lit(CAPTION_PATTERN), F.lit(3))
    return F.transform(
        F.arrays_zip(numbers.alias("number"), captions.alias("caption")),
        lambda c: F.struct(c["number"].alias("number"), strip(c["caption"]).alias("caption")),
    )


def caption_context(captions: Column, position: Column) -> Column:
    """Caption text for the image at 0-based ``position``, or the default text."""
    caption = F.get(captions, position)
    return F.coalesce(
        F.concat(F.lit("Fig. "), caption["number"], F.lit(": "), caption["caption"]),
        F.lit(NO_CAPTION),
    )


def _fenced(text: Column, opening: str) -> tuple[Column, Column]:
    """(found, body) of the first block opened by ``opening`` and closed by a fence."""
    start_at = F.instr(text, opening)
    rest = F.substr(text, start_at + F.lit(len(opening)))
    end_at = F.instr(rest, FENCE)
    return (start_at > 0) & (end_at > 0), F.substr(rest, F.lit(1), end_at - 1)


def code_block(text: Column) -> Column:
    """Code of a reply: first closed Python block, else first closed block, else all of it."""
    in_python, python_body = _fenced(text, PYTHON_FENCE)
    in_plain, plain_body = _fenced(text, FENCE)
    return strip(F.when(in_python, python_body).when(in_plain, plain_body).otherwise(text))


def trim_fence(text: Column) -> Column:
    """Drop a leading Python fence and a trailing fence, trimming after each step."""
    body = strip(text)
    opened = F.when(
        F.startswith(body, F.lit(PYTHON_FENCE)),
        strip(F.substr(body, F.lit(len(PYTHON_FENCE) + 1))),
    ).otherwise(body)
    return F.when(
        F.endswith(opened, F.lit(FENCE)),
        strip(F.substr(opened, F.lit(1), F.length(opened) - len(FENCE))),
    ).otherwise(opened)


def snippet_extension(description: Column) -> Column:
    """``.py`` when the description speaks of Python, else ``.txt``."""
    is_python = F.contains(F.lower(F.coalesce(description, F.lit(""))), F.lit("python"))
    return F.when(is_python, ".py").otherwise(".txt")


def verdict(reply: Column) -> Column:
    """Severity of a reviewer's reply: ``error``, ``warning`` or ``pass``."""
    head = F.upper(F.substr(strip(reply), F.lit(1), F.lit(4)))
    return F.when(head == "FAIL", "error").when(head == "WARN", "warning").otherwise("pass")


# --- links and paths -------------------------------------------------------------------


def record_id(link: Column) -> Column:
    """Trailing digits of a repository link, null when there are none."""
    return F.nullif(F.regexp_extract(link, r"([0-9]+)$", 1), F.lit(""))


def last_segment(link: Column) -> Column:
    """Text after the last slash."""
    return F.substring_index(link, "/", -1)


def repo_name(link: Column) -> Column:
    """Last path segment of a URL without ``.git``; query and fragment do not count."""
    path = F.regexp_extract(
        link, r"(?s)^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", 1
    )
    name = F.substring_index(last_segment(path), ";", 1)
    return F.replace(name, F.lit(".git"), F.lit(""))


def extension(path: Column) -> Column:
    """Lower-cased last suffix of the base name; names that only start with dots have none."""
    return F.lower(F.regexp_extract(path, r"(?s)[^./][^/]*(\.[^./]*)$", 1))


def sanitize(name: Column) -> Column:
    """Replace both kinds of slash by an underscore."""
    return F.translate(name, "/\\", "__")


def slug(title: Column, characters: int) -> Column:
    """Folder name from a title: lower case, separators as ``_``, cut to ``characters``."""
    joined = F.regexp_replace(F.lower(title), r"(?U)[\s:/\\]+", "_")
    return F.substring(joined, 1, characters)


def classify_file(path: Column) -> Column:
    """``data``, ``code`` or ``ignored``, from the extension alone."""
    ext = extension(path)
    return (
        F.when(ext.isin(*DATA_FILE_EXTENSIONS), "data")
        .when(ext.isin(*CODE_FILE_EXTENSIONS), "code")
        .otherwise("ignored")
    )


def route_source(source: Column, exists: Column | None = None) -> Column:
    """Where an input goes; ``exists`` says whether a local path is there (default: yes)."""
    exists = F.lit(True) if exists is None else exists
    is_repository = F.contains(source, F.lit("zenodo.org")) | F.contains(
        source, F.lit("doi.org/10.5281/zenodo")
    )
    return (
        F.when(is_repository, "repository")
        .when(F.startswith(source, F.lit("http")), "unsupported_url")
        .when(exists & (extension(source) == ".pdf"), "pdf")
        .otherwise("unsupported")
    )


def route_link(link: Column) -> Column:
    """How a data link is handled: ``clone``, ``record`` or ``manual``."""
    return (
        F.when(F.contains(link, F.lit("github.com")), "clone")
        .when(F.contains(link, F.lit("zenodo")), "record")
        .otherwise("manual")
    )


# --- text assembled from fields --------------------------------------------------------


def prompt_context(
    title: Column,
    abstract: Column,
    methods: Column,
    results: Column,
    captions: Column,
    limit: int = CONTEXT_CHARACTERS,
) -> Column:
    """Labelled lines for a model; the two long sections are cut to ``limit`` characters."""
    # The labels.
    lines = [
        ("Title: ", title),
        ("Abstract: ", abstract),
        ("Methods Section Summary: ", F.substring(methods, 1, limit)),
        ("Results Section Summary: ", F.substring(results, 1, limit)),
        ("Figure/Table Captions: ", captions),
    ]
    return F.concat_ws(
        "\n", *[F.concat(F.lit(label), F.coalesce(text, F.lit(""))) for label, text in lines]
    )


def proposal_package(table_index: Column, proposal_index: Column) -> Column:
    """Working name of the package for one proposal of one table (both 1-based)."""
    return F.format_string("table_%d_proposal_%d", table_index, proposal_index)


def competition_package(table_index: Column, proposal_index: Column, target: Column) -> Column:
    """Final name of the package for one proposal."""
    return F.format_string("comp_t%d_p%d_%s", table_index, proposal_index, F.lower(target))


def indent_lines(text: Column) -> Column:
    """Indent every line after the first by two blanks."""
    return F.replace(text, F.lit("\n"), F.lit("\n  "))
