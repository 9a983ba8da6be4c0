"""Main text of pages written by hand: no names, hashed names, tables, other languages."""

import pytest

from loanlens.llm.html_tree import default_model, extract

SAY = "The council met again on Tuesday and agreed, after a long debate, to publish the results of its study. "
MENU = "<ul>" + "".join(f"<li><a href='/{k}'>Menu {k}</a></li>" for k in range(7)) + "</ul>"


def article(n=4, tag="p"):
    return "".join(f"<{tag}>{SAY * (1 + k % 3)}Part {k}.</{tag}>" for k in range(n))


def comments(attrs=""):
    return "".join(f"<div{attrs}><b>Reader {k}</b><p>I liked this a lot, many thanks for it, number {k}.</p></div>" for k in range(4))


PAGES = {
    "plain divs": f"<html><body><div>{MENU}</div><div><h1>Title</h1>{article()}</div><div>Copyright 2024 Example</div></body></html>",
    "divs for paragraphs": f"<body><div><div><a href=/>Home</a> <a href=/a>About</a></div><div><div>{article(5, 'div')}</div></div>"
                           "<div><a href=/x>Imprint</a></div></div></body>",
    "hashed names": f"<body><div class='css-a8f3k2x'>{MENU}</div><div class='css-99dk2l1'><div class='css-k2l1m0p'><h1>Title</h1>"
                    f"{article()}</div></div></body>",
    "table layout": "<body><table><tr><td><a href=1>News</a><br><a href=2>Sport</a><br><a href=3>Weather</a></td>"
                    f"<td><h2>Title</h2>{article()}</td></tr></table></body>",
    "german names": f"<body><div id='kopfzeile'><p>Zeitung</p>{MENU}</div><div id='inhalt'><h1>Title</h1>{article()}</div>"
                    f"<div id='seitenleiste'><h3>Mehr</h3>{MENU}</div><div id='kommentare'><h3>Kommentare</h3>{comments()}</div></body>",
    "spanish names": f"<body><div class='cabecera'>{MENU}</div><div class='cuerpo'>{article()}</div>"
                     f"<div class='comentarios'>{comments()}</div></body>",
    "usual names": f"<body><nav>{MENU}</nav><article><h1>Title</h1>{article()}</article><div class=comments>{comments()}</div></body>",
    "nothing around it": f"<body>{article()}</body>",
}


@pytest.mark.parametrize("name", sorted(PAGES))
def test_the_whole_article_and_nothing_else(name):
    blocks = extract([PAGES[name]], default_model())[0]
    n = 5 if name == "divs for paragraphs" else 4
    assert [b[-7:] for b in blocks if b != "Title"] == [f"Part {k}." for k in range(n)]


def test_no_page_with_prose_is_empty():
    pages = [f"<body>{'<div>' * d}<p>{SAY * 2}</p>{'</div>' * d}</body>" for d in range(6)] + [SAY * 3, f"<div>{SAY}</div>"]
    assert all(extract(pages, default_model()))
