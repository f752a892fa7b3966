"""Labelled pages on which the extraction model is fitted.

Pages are put together by rule from parts whose role is known: an element with ``data-main="1"``
holds main text, everything else is boilerplate. Layouts, tags, class names, lengths and numbers of
links vary, so that the model has to weigh structure against wording.
"""

from __future__ import annotations

import random

_WORDS = (
    "the of river stone market when light under people began work road through small house winter "
    "letter found after years garden with story open field between water children morning answer"
).split()


def _text(r: random.Random, low: int, high: int) -> str:
    words = [r.choice(_WORDS) for _ in range(r.randint(low, high))]
    return " ".join(w + r.choice([""] * 6 + [","]) for w in words).capitalize() + r.choice((".", ".", "!", "?", "", ""))


def _links(r: random.Random, count: int, item: str = "li") -> str:
    return "".join(f'<{item}><a href="/{i}">{r.choice(_WORDS).capitalize()} {r.choice(_WORDS)}</a></{item}>' for i in range(count))


def _around(r: random.Random) -> dict[str, list[str]]:
    """Boilerplate parts by where they stand."""
    nav = r.choice(["<nav><ul>{}</ul></nav>", '<div class="menu"><ul>{}</ul></div>', '<ul id="navigation">{}</ul>', '<div role="navigation">{}</div>'])
    return {
        "top": [
            nav.format(_links(r, r.randint(3, 9))),
            f"<header><h1>{_text(r, 1, 4)}</h1><p>{_text(r, 2, 8)}</p></header>",
            f'<div class="cookie-notice"><p>{_text(r, 8, 30)}</p><button>ok</button></div>',
            f'<div id="banner" class="ad">{_text(r, 4, 30)}</div>',
            f'<form action="/search"><label>{_text(r, 1, 3)}</label><input name="q"><button>go</button></form>',
            f'<p class="breadcrumb">{_links(r, 3, "span")}</p>',
        ],
        "side": [
            f"<aside><h2>{_text(r, 1, 4)}</h2><p>{_text(r, 5, 40)}</p><ul>{_links(r, 4)}</ul></aside>",
            f'<div class="sidebar"><h3>{_text(r, 1, 3)}</h3><ul>{_links(r, r.randint(3, 8))}</ul></div>',
            f'<div class="advert">{_text(r, 4, 40)}</div>',
            f'<div class="related"><h4>{_text(r, 1, 4)}</h4>{_links(r, 4, "p")}</div>',
            f'<div class="share social">{_links(r, 3, "span")}</div>',
        ],
        "bottom": [
            f'<section class="comments"><h3>{_text(r, 1, 3)}</h3>' + "".join(f'<div class="comment"><p>{_text(r, 4, 40)}</p></div>' for _ in range(r.randint(1, 4))) + "</section>",
            f'<div id="disqus_thread"><p>{_text(r, 5, 40)}</p></div>',
            f'<div class="newsletter"><p>{_text(r, 5, 20)}</p><form><input name="mail"><button>{_text(r, 1, 2)}</button></form></div>',
            f"<footer><p>&copy; {_text(r, 2, 14)}</p><ul>{_links(r, 4)}</ul></footer>",
            f"<footer>&copy; example &middot; {_text(r, 4, 20)}</footer>",
            f'<div class="footer">{_text(r, 3, 25)}</div>',
            f'<div class="pagination">{_links(r, 4, "span")}</div>',
        ],
    }


def _main(r: random.Random) -> str:
    """The main part, in one of several layouts."""
    parts = [f"<h1>{_text(r, 2, 9)}</h1>"] if r.random() < 0.8 else []
    for _ in range(r.choice((1, 1, 2, 3, 4, 6, 9))):
        kind = r.random()
        if kind < 0.66:
            parts.append(f"<p>{_text(r, 1, r.choice((4, 70)))}</p>")
        elif kind < 0.74:
            parts.append(f"<h2>{_text(r, 1, 6)}</h2>")
        elif kind < 0.80:
            parts.append("<ul>" + "".join(f"<li>{_text(r, 2, 12)}</li>" for _ in range(r.randint(2, 5))) + "</ul>")
        elif kind < 0.86:
            parts.append(f"<blockquote><p>{_text(r, 5, 30)}</p></blockquote>")
        elif kind < 0.92:
            parts.append(f'<p>{_text(r, 5, 30)} <a href="/x">{_text(r, 1, 3)}</a> {_text(r, 5, 20)}</p>')
        elif kind < 0.95:
            parts.append(f"<pre>{_text(r, 4, 20)}</pre>")
        else:
            parts.append("<table>" + "".join(f"<tr><td>{_text(r, 1, 5)}</td><td>{_text(r, 1, 5)}</td></tr>" for _ in range(3)) + "</table>")
    return "".join(parts)


def labelled_pages(count: int = 160, seed: int = 11) -> list[str]:
    """Pages whose main text lies in elements with ``data-main="1"``."""
    r, pages = random.Random(seed), []
    frames = (
        '<article data-main="1">{}</article>',
        '<article data-main="1">{}</article>',
        '<main><article data-main="1">{}</article></main>',
        '<main data-main="1">{}</main>',
        '<div class="content" data-main="1">{}</div>',
        '<div id="post-body" class="entry" data-main="1">{}</div>',
        '<div class="wrap"><section class="story" data-main="1">{}</section></div>',
        '<div data-main="1">{}</div>',
    )
    for _ in range(count):
        around = {place: [p for p in parts if r.random() < 0.4] for place, parts in _around(r).items()}
        main = r.choice(frames).format(_main(r))
        if r.random() < 0.25:  # an advert, a notice or comments inside the frame of the main text
            inside = r.choice(_around(r)["side"] + _around(r)["bottom"][:2])
            main = main.replace("</p>", "</p>" + inside, 1) if "<table" not in main else main
        side = "".join(around["side"])
        middle = side + main if r.random() < 0.4 else main + side
        pages.append(
            f"<!DOCTYPE html><html><head><title>{_text(r, 2, 8)}</title><style>p{{margin:0}}</style></head><body>"
            + "".join(around["top"]) + middle + "".join(around["bottom"]) + "<script>var x = 1;</script></body></html>"
        )
    return pages
