import os.path
import posixpath
import re
from urllib.parse import urlparse

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from packwright.functions import text as X


def python_slice(text, start, ends, to_end, prefix=X.SECTION_PREFIX):
    """Plain model of a marker slice."""
    if start not in text:
        return f"Could not find markers to slice '{start}'."
    begin = text.index(start) + len(start)
    found = [text.find(e, begin) for e in ends if text.find(e, begin) != -1]
    if not found and not to_end:
        return f"Could not find markers to slice '{start}'."
    body = text[begin : min(found)] if found else text[begin:]
    return body.strip().removeprefix(prefix).strip()


def python_code(text):
    """Plain model of code extraction."""
    for fence in ("```python", "```"):
        begin = text.find(fence)
        if begin != -1:
            end = text.find("```", begin + len(fence))
            if end != -1:
                return text[begin + len(fence) : end].strip()
    return text.strip()


def test_strip_matches_python(many):
    texts = ["\u3000 a b\t\n", "\x1c\x1fx\x85", "", "  ", "\u00a0é\u2028"]
    assert many(X.strip, texts) == [t.strip() for t in texts]


def test_marker_slice_cases(many):
    texts = [
        "x Description link keyboard_arrow_up about it Background b Evaluation e Timeline t",
        "Description a Evaluation rmse Code c Data d",
        "Background only",
        "Evaluation link keyboard_arrow_up",
        "Evaluation Description Background",
        "Background x Description y",
        "",
    ]
    for start, ends, to_end in (
        (X.DESCRIPTION, [X.BACKGROUND], False),
        (X.BACKGROUND, [X.EVALUATION], False),
        (X.EVALUATION, list(X.END_MARKERS), True),
    ):
        found = many(lambda c: X.marker_slice(c, start, ends, to_end=to_end), texts)
        assert found == [python_slice(t, start, ends, to_end) for t in texts]


def test_code_block_tiers(many):
    texts = [
        "Use:\n```python\nx = 1\n```\nok",
        "```\nls\n```",
        " plain ",
        "```a``` then ```python b",
        "none ```python```",
        "```python open",
        "``` one",
        "a```python b```python c``` d",
    ]
    assert many(X.code_block, texts) == [python_code(t) for t in texts]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(["```", "python", " ", "x", "\n", "Fig. "]), max_size=12).map("".join), min_size=30, max_size=60))
def test_code_block_matches_the_model(many, texts):
    assert many(X.code_block, texts) == [python_code(t) for t in texts]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from([*"ab ", "Evaluation", "Timeline", "Code", "Data", X.SECTION_PREFIX, "\n"]), max_size=12).map("".join), min_size=30, max_size=60))
def test_marker_slice_matches_the_model(many, texts):
    found = many(lambda c: X.marker_slice(c, X.EVALUATION, X.END_MARKERS, to_end=True), texts)
    assert found == [python_slice(t, X.EVALUATION, X.END_MARKERS, True) for t in texts]


def test_trim_fence(many):
    texts = ["```python\nx\n```", " ```python x", "x ```", "```\nx```", "x", "``````"]
    expected = ["x", "x", "x", "```\nx", "x", "```"]
    assert many(X.trim_fence, texts) == expected


def test_captions_match_python(many):
    pattern = re.compile(r"(Fig\.|Figure)\s(\d+)\s*\|(.*)")
    texts = [
        "Intro\nFig. 1 | Plot\u2028more\r\nFigure 22|  Bars  \nFig 3 | no\nFigure\u00a04 \n| next",
        "none",
        "Fig. 1|",
    ]
    found = many(X.numbered_captions, texts)
    expected = [[(n, c.strip()) for _, n, c in pattern.findall(t)] for t in texts]
    assert [[tuple(c) for c in caps] for caps in found] == expected


def test_verdict_and_snippet_extension(many):
    replies = [" fail: x", "WARN", "ok", "Failing", "a FAIL", "", "\u3000Warn: y"]
    assert many(X.verdict, replies) == ["error", "warning", "pass", "error", "pass", "pass", "warning"]
    assert many(X.snippet_extension, ["In PYTHON", "shell", None]) == [".py", ".txt", ".txt"]


def test_extension_matches_splitext(many):
    paths = [".bashrc", "a.tar.gz", "d.x/file", "d/.a.b", "a.", "..", "...a.b", "A.CSV", "x/y.z/", "a b.TXT", "a.b\n"]
    assert many(X.extension, paths) == [os.path.splitext(p)[1].lower() for p in paths]


def test_repo_name_matches_urlparse(many):
    links = [
        "https://github.com/o/r.git",
        "https://github.com/o/r.git?x=1#f/g",
        "http://h/a;b",
        "github.com/o/r",
        "https://github.com/o/r/",
        "https://github.com",
    ]
    expected = [urlparse(link).path.split("/")[-1].replace(".git", "") for link in links]
    assert many(X.repo_name, links) == expected


def test_record_ids(many):
    links = ["https://zenodo.org/records/123", "https://zenodo.org/x", "10.5281/zenodo.77"]
    assert many(X.record_id, links) == ["123", None, "77"]
    assert many(X.last_segment, links) == ["123", "x", "zenodo.77"]


def test_slug_and_sanitize(many):
    titles = ["A: b/c\\d  E\u00a0f", "x" * 200]
    expected = [re.sub(r"[\s:/\\]+", "_", t.lower())[:80] for t in titles]
    assert many(lambda c: X.slug(c, 80), titles) == expected
    assert many(X.sanitize, ["a/b\\c", "d"]) == ["a_b_c", "d"]


def test_classifier_and_routers(many):
    paths = ["project/data/G1", "project/run.py", "project/model.pkl", "a.CSV", "n.ipynb", "d.zip"]
    assert many(X.classify_file, paths) == ["data", "code", "ignored", "data", "code", "ignored"]
    sources = [
        "https://zenodo.org/records/1",
        "https://doi.org/10.5281/zenodo.5",
        "https://x.org/a.pdf",
        "a/b.PDF",
        "a/b.docx",
        "zenodo.org/x.pdf",
    ]
    assert many(X.route_source, sources) == [
        "repository",
        "repository",
        "unsupported_url",
        "pdf",
        "unsupported",
        "repository",
    ]
    links = ["https://github.com/zenodo", "https://zenodo.org/1", "https://doi.org/1"]
    assert many(X.route_link, links) == ["clone", "record", "manual"]


def test_posix_base_names_are_used(many):
    assert many(X.last_segment, ["a/b/c.txt"]) == [posixpath.basename("a/b/c.txt")]
