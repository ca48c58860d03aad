"""Page shells, class names and hosts of several templates."""

import html
import random

import pytest

from cellstrata.llm import htmlextract


def texts(pages):
    content = htmlextract.content_paths(htmlextract.merged(htmlextract.page_wrapper(p) for p in pages))
    return [htmlextract.page_text(p, content) for p in pages]


SHELLS = ['<div class="layout with-sidebar">', '<div id="page" class="has-sidebar no-comments">', '<div class="sidebar layout">', '<div class="modal">', '<form id="form1">']


@pytest.mark.parametrize("shell", SHELLS)
@pytest.mark.parametrize("element", ["article", "main"])
def test_shell_around_an_article(shell, element):
    pages = [f'{shell}<nav>Menu {k}</nav><{element}><p>Text {k}</p><div class="ad">Buy {k}</div><div class="share" id="x">S{k}</div></{element}><div id="comments"><article>Reader {k}</article></div>' for k in range(3)]
    assert texts(pages) == [f"Text {k}" for k in range(3)]


def test_names_inside_an_article():
    page = '<article><section class="social history"><p>One</p></section><div class="form-of-government"><p>Two</p></div><div class="comments">Three</div></article>'
    assert texts([page]) == ["One Two"]


def test_shell_without_article():
    assert texts([f'<div class="sidebar"><p>Text {k}</p></div><nav>Menu {k}</nav>' for k in range(3)])[2] == "Text 2"


def test_host_of_several_templates(spark):
    made = ["<article><p>Text {}</p></article>", "<main><p>Text {}</p></main><footer>F</footer>", '<div class="a"><p>Intro {0}</p></div><h1>Head {0}</h1><div class="b"><p>Long running text {0}</p></div><div class="ad">Buy {0}</div>']
    rows = [(k, "http://a.example/x", made[k % 3].format(k)) for k in range(9)]
    got = {r.page_id: r.text for r in htmlextract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for k in range(9):
        assert got[k] == (f"Intro {k} Head {k} Long running text {k}" if k % 3 == 2 else f"Text {k}")


def test_alignment_tells_the_templates_text_inside_articles():
    page = '<article><h1>News</h1><div class="box">Read our guide</div><p>Text {0}</p><section><p>More {0}</p></section></article>'
    pages = [page.format(k) for k in range(4)]
    assert texts(pages) == [f"News Text {k} More {k}" for k in range(4)]  # the box is the same on all pages; headings stay
    assert texts(pages[:1] * 4) == ["News Read our guide Text 0 More 0"] * 4  # nothing differs, so nothing is the template's
    assert texts(pages[:2])[0] == "News Read our guide Text 0 More 0"  # too few pages to tell
    other = page.format(9).replace('<div class="box">Read our guide</div>', "")
    assert texts([*pages, other])[0] == "News Read our guide Text 0 More 0"  # a page lacks it, so it is that page's own


def made_site(r, n):
    """Pages of one host with their main text, by construction."""
    words = "river stone über light café 東京 moon & tree < bird > cloud field".split()

    def phrase(k):
        return " ".join(r.choice(words) for _ in range(r.randrange(3, 12))) + f" {k}-{r.randrange(10**6)}"

    element, shell, notice = r.choice(["article", "main"]), r.choice(["", '<div class="layout with-sidebar">']), r.choice(["", '<div class="box">Keep in touch</div>'])
    out = []
    for k in range(n):
        parts, body = [], []
        for _ in range(r.randrange(1, 8)):
            text = phrase(k)
            shown = html.escape(text).replace(" ", r.choice([" ", "\n  "]), 1)
            kind = r.choice(["<p>{}</p>", "<p>{}", "<ul><li>{}</li></ul>", "<div><p>{}</p></div>", "<blockquote>{}</blockquote>", "<h2>{}</h2>"])
            body.append(kind.format(shown))
            parts.append(text)
            body.append(r.choice(["", f'<div class="ad">{phrase(k)}</div>', f"<aside>{phrase(k)}</aside>", "<script>var x = '<p>no</p>';</script>", f'<form><label>{phrase(k)}</label></form>', "<!-- none -->"]))
        page = f"<html><body>{shell}<nav><a href='/'>Menu {k}</a></nav><header>{phrase(k)}</header><{element}>{notice}{''.join(body)}</{element}><section id='comments'><p>{phrase(k)}</p></section><footer>{phrase(k)}</footer>"
        out.append((page, " ".join(parts)))
    return out


@pytest.mark.parametrize("seed", range(12))
def test_made_sites(seed):
    r = random.Random(seed)
    site = made_site(r, r.randrange(4, 30))
    assert texts([page for page, _ in site]) == [text for _, text in site]


def test_odd_pages(spark):
    long = "<article>" + "<p>word one</p>" * 20_000 + "</article>"
    rows = [(1, "http://a.example/x", long), (1, "http://a.example/x", long), (None, None, None), (2, None, ""), (3, "no url", "<p>tie</p>"), (4, "no url", "<p>tie</p>")]
    table = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "7 AS host", "7 AS paths", "7 AS text", "7 AS n_chars", "7 AS wrapper")
    got = sorted(htmlextract.extract(table).select("page_id", "text", "n_chars").collect(), key=lambda r: r.page_id or 0)
    assert [r.page_id for r in got] == [None, 1, 1, 2, 3, 4] and all(r.n_chars == len(r.text) for r in got)
    assert (got[0].text, got[3].text, got[4].text, got[5].text) == ("", "", "tie", "tie")
    assert got[1].text == got[2].text == " ".join(["word one"] * 20_000)
    assert htmlextract.extract(table.where("page_id > 9")).collect() == []
