import itertools
import math
import random
import time

import pytest

from packwright.llm import html_text
from packwright.llm.html_pages import labelled_pages


@pytest.fixture(scope="module")
def model():
    return html_text.fit()


def test_messages_give_the_marginals_of_all_states():
    r = random.Random(3)
    for _ in range(20):
        count = r.randint(1, 7)
        parents = [-1] + [r.randrange(i) for i in range(1, count)]
        kinds = [r.randint(0, 1) for _ in range(count)]
        unary, pair = [r.uniform(-2, 2) for _ in range(count)], [r.uniform(-2, 2) for _ in range(8)]
        total, on = 0.0, [0.0] * count
        for states in itertools.product((0, 1), repeat=count):
            weight = math.exp(sum(u for u, s in zip(unary, states, strict=True) if s) + sum(pair[4 * kinds[i] + 2 * states[parents[i]] + states[i]] for i in range(1, count)))
            total += weight
            for i, s in enumerate(states):
                on[i] += weight * s
        edges = [0.0] * 8
        odds = html_text.marginals(parents, kinds, unary, pair, edges)
        assert [1 / (1 + math.exp(-z)) for z in odds] == pytest.approx([x / total for x in on])
        assert sum(edges) == pytest.approx(count - 1)


def test_parse_reads_broken_markup():
    page = html_text.parse("<p>one<b>two<br>three<p>four &amp; five</i></p>six<ul><li>a<li>b</ul><script>x<p></script><!-- <p>no -->tail<div title='>'>in")
    assert [t for _, t in page.blocks] == ["onetwo three", "four & five", "six", "a", "b", "tail", "in"]
    assert html_text.parse("").blocks == [] and html_text.parse("<<<>&lt;").blocks[0][1].endswith("<")
    assert len(html_text.parse("<div>" * 3000 + "deep").blocks) == 1


def test_held_out_pages(model):
    wrong = blocks = 0
    for source in labelled_pages(60, seed=1234):
        page = html_text.parse(source)
        _, marked = html_text.features(page)
        inside = []
        for node, parent in enumerate(page.parents):
            inside.append(marked[node] or (parent >= 0 and inside[parent]))
        text = set(html_text.main_text(source, model).split("\n\n"))
        for node, block in page.blocks:
            blocks += 1
            wrong += inside[node] != (block in text)
    assert wrong / blocks < 0.08


def test_main_text_of_a_page(model):
    source = (
        "<html><body><nav><a href='/'>Home</a></nav><div class='cookie-notice'><p>We use cookies to serve you better. Accept them.</p></div>"
        "<article><h1>The  title</h1><p>First paragraph&nbsp;with <b>bold</b> text, and a second sentence.</p><p>Of.</p></article>"
        "<section class='comments'><p>Nice read, thank you for this one.</p></section><footer>&copy; 2020 All rights.</footer></body></html>"
    )
    assert html_text.main_text(source, model) == "The title\n\nFirst paragraph with bold text, and a second sentence.\n\nOf."


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [(1, "u", None, "t"), (2, None, "", "t"), (3, "v", "<article><p>Some text here.</p></article>", "t"), (3, "v", "<article><p>Some text here.</p></article>", "t"), (None, "w", "plain", "t")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    found = sorted(((str(r["page_id"]), r["url"], r["text"], r["n_chars"]) for r in html_text.extract(df).collect()), key=str)
    assert found[0][2:] == ("", 0) and found[1][1:] == (None, "", 0) and found[2][2:] == ("Some text here.", 15) and found[3] == found[2]
    assert html_text.extract(df.limit(0)).count() == 0


def test_empty_unclosed_and_fallback_elements():
    def blocks(source):
        return [t for _, t in html_text.parse(source).blocks]

    for tag in ("<svg width='1'/>", "<math/>", "<noscript>", "<object data='x'>", "<select><option>", "<svg>", "<svg><title/><path/>", "<template>"):
        assert blocks(f"<div>{tag}</div><article><p>one</p>{'' if tag == '<template>' else tag}<p>two</p></article>") == ["one", "two"], tag
    assert blocks("<p>a <math><mi>x</mi><mo>=</mo><mn>2</mn></math> b <object><b>c</b></object> <noscript>d</noscript> e</p>") == ["a x=2 b c d e"]
    assert blocks("<p>pick <select><option>A</option><option>B</select> now <svg><text>no</text><style>p</style></svg>or <template><p>no</p><div></template>then</p>") == ["pick now or then"]
    assert blocks("<p>a<script>x") == ["a"] and blocks("<svg><foreignObject><div>no</div></foreignObject></svg>yes") == ["yes"]
    assert blocks("<noscript><div>a<p>b</noscript>c") == ["a", "b", "c"]


@pytest.mark.parametrize(
    "page",
    [
        "<a " * 200_000,
        "<a '" * 200_000,
        "<x '\">" * 200_000,
        "<a" * 200_000 + ">",
        "<div>" * 100_000 + "</section>" * 100_000,
        "<span>" * 100_000 + "<p>" * 100_000,
        "<span>" * 100_000 + "<div></div>" * 100_000,
        "<b><div>" + "<i>" * 100_000 + "</b>" * 100_000,
        "<svg>" + "<script>" * 200_000,
        "<ul>" + "<span>" * 100_000 + "<li></li>" * 100_000,
    ],
    ids=lambda page: page[:24],
)
def test_long_broken_pages_take_time_in_proportion(page):
    begun = time.process_time()
    html_text.parse(page)
    assert time.process_time() - begun < 30


def test_tags_of_broken_markup():
    def tags(source):
        reader, at, found = html_text.Tags(source), 0, []
        while (tag := reader.after(at)) is not None:
            found.append(tag[2:4])
            at = tag[1]
        return found

    assert tags("a<b c='>'>d</B>e") == [("", "b"), ("/", "b")]
    assert tags("<b c='>d</b>") == [("bad", ""), ("/", "b")]
    assert tags("1 < 2 > 0 <p") == []
    assert tags("<p '\"'><q \">\" '>") == [("", "p"), ("bad", "")]


def test_drawing_inside_a_control():
    assert html_text.parse("<select><svg><div>text</div></select>").blocks[-1][1] == "text"
