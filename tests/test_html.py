import html as stdlib_html
import re

from packwright.functions import html as H

PAGE = """<html><head><title>t</title><script>var a = '<h1>no</h1>';</script></head><body>
<!-- <h1>hidden</h1> <a href="https://github.com/hidden/x">h</a> -->
<h1 class="x"> Deep <i>learning</i> &amp; &#233;&#x4e2d; &lt;b&gt; </h1>
<section aria-labelledby="sec-abs"><h2>Abstract</h2><p>One <b>two</b></p><section><p>nested</p></section></section>
<div><h2>Materials and <i>Methods</i></h2><p>wrong</p></div>
<div><h3>Our METHODS</h3><p>m1<p>m2 <br>x</p><div><h2>Inner</h2>kept</div></div>
<h2>Results and more</h2><ul><li>r1<li>r2</ul><figure><img><figcaption>Cap <b>A</b></figcaption></figure>
<h2>End</h2><figure><div class="fig Caption-text">Cap B</div></figure><figure><p>none</p></figure>
<a href="https://github.com/o/r">1</a><a class='z' href='https://doi.org/10.1/x'>2</a>
<a href=https://zenodo.org/1>3</a><a href="https://github.com">4</a><a href="https://www.github.com/x">5</a>
<a href="https://gitlab.com/a?b=1&amp;c=2">6</a><a href="https://github.com/o/r">7</a></body></html>"""


def test_title(many):
    texts = [PAGE, "<p>none</p>", "<h1></h1>", "<H1>A\n B</H1>", None]
    assert many(H.page_title, texts) == ["Deeplearning& é中 <b>", "Untitled Paper", "", "A\n B", "Untitled Paper"]


def test_entities_match_the_standard(many):
    texts = ["&#8364; &#x1F600;x", "&amp;lt;", "&#xZZ; &#; a&#12", "&nbsp;|&quot;|&apos;", "plain"]
    expected = [stdlib_html.unescape(t) for t in texts]
    expected[2] = texts[2]
    assert many(H.decode_entities, texts) == expected


def test_links(many):
    assert many(H.repository_links, [PAGE]) == [
        [
            "https://doi.org/10.1/x",
            "https://github.com/o/r",
            "https://gitlab.com/a?b=1&c=2",
            "https://zenodo.org/1",
        ]
    ]
    pattern = re.compile(r"https?://(github\.com|gitlab\.com|figshare\.com|zenodo\.org|doi\.org)[\w\-\./%]+")
    hrefs = many(H.page_hrefs, [PAGE])[0]
    assert sorted({h for h in hrefs if pattern.match(h)}) == many(H.repository_links, [PAGE])[0]


def test_sections():
    abstract, methods, results, captions = H.parse_sections(PAGE, H.METHODS_HEADING, H.RESULTS_HEADING)
    assert abstract == "Abstract\nOne\ntwo\nnested"
    assert methods == "m1\nm2\nx\nInner\nkept"
    assert results == "r1\nr2\nCap\nA"
    assert captions == "CapA\nCap B"


def test_sections_defaults():
    assert H.parse_sections("", "Methods", "Results") == (H.NO_ABSTRACT, "", "", "")
    assert H.parse_sections(None, "Methods", "Results") == (H.NO_ABSTRACT, "", "", "")


def test_deep_nesting_does_not_overflow():
    page = "<div>" * 20_000 + "<h2>Methods</h2><p>x</p>" + "</div>" * 20_000
    assert H.parse_sections(page, "Methods", "Results")[1] == "x"


def test_page_sections_runs_in_batches(spark):
    from packwright.operators.assets import page_record

    pages = spark.createDataFrame([(1, PAGE), (2, "<p>x</p>"), (3, None)], "id int, html string")
    rows = {r.id: r for r in page_record(pages).collect()}
    assert rows[1].captions == "CapA\nCap B"
    assert rows[1].title == "Deeplearning& é中 <b>"
    assert rows[2].abstract == H.NO_ABSTRACT and rows[2].availability_links == []
    assert rows[3].methods == ""


def test_flat_section_agrees_with_the_tree(many):
    page = "<h1>t</h1><h2>Methods</h2><p>a</p><p>b <i>c</i></p><h3>More</h3><p>d</p><h2>Results</h2><p>e</p>"
    tree = H.parse_sections(page, H.METHODS_HEADING, H.RESULTS_HEADING)
    assert many(lambda c: H.flat_section(c, H.METHODS_HEADING), [page]) == [tree[1]]
    assert many(lambda c: H.flat_section(c, H.RESULTS_HEADING), [page]) == [tree[2]]
