"""Main text of pages whose text is known: lists within the article stay, the site's own go; deep nesting takes no long time."""

import random
import time

import pytest

from tidewell.llm import html_text


def pages(main: str, n: int = 40):
    """Pages of one host: a menu whose targets differ, an article (or div) with a reference list and a list of facts, a notice."""
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdefghijkl") for _ in range(7))
    out = []
    for i in range(n):
        links = lambda k: "".join(f'<li><a href="/{word()}">{word()} {word()}</a></li>' for _ in range(k))
        menu, references = links(4), links(3)
        facts = f"<ul><li>Type: {r.choice(['bird', 'fish'])}</li><li>Size: {r.choice(['small', 'large'])}</li></ul>"
        text = [f"{word()} {word()} {word()} {i}" for _ in range(3)]
        body = f"<h1>T{i}</h1>" + "".join(f"<p>{t}</p>" for t in text) + facts + f"<ul>{references}</ul>"
        opened, closed = {"article": ("<article>", "</article>"), "main": ("<main>", "</main>"), "div": ('<div class="story">', "</div>")}[main]
        around = '<div class="x7"><p>We use cookies on this site</p></div>'
        page = f"<html><body><nav><ul>{menu}</ul></nav><div>{around}</div>{opened}{body}{closed}<div class='y1'><ul>{links(5)}</ul></div><footer>f</footer></body></html>"
        want = [f"T{i}", *text, *[x.split("<")[0] for x in facts.split("<li>")[1:]], *[x.split("<")[0] for x in references.split('">')[1:]]]
        out.append((i, f"http://h.example/{i}", page, "\n\n".join(want)))
    return out


@pytest.mark.parametrize("main", ["article", "main", "div"])
def test_lists_of_the_article_stay(spark, main):
    data = pages(main)
    got = {r["page_id"]: r["text"] for r in html_text.extract(spark.createDataFrame([p[:3] for p in data], "page_id long, url string, html string")).collect()}
    assert got == {p[0]: p[3] for p in data}


@pytest.mark.parametrize("page", ["<div>" * 4000 + "<p>x" + "</div>" * 4000, '<div class="page ads">' * 4000 + "<h1>t</h1><p>x" + "</div>" * 4000])
def test_deep_nesting_is_linear(page):
    began = time.process_time()
    blocks, boxes = html_text.parse(page)
    assert html_text.choose(blocks, boxes)[0][-1] == "x" and len(boxes) == 4000 * ("class" in page) + 4000 * ("class" not in page)
    assert time.process_time() - began < 1.5


def test_hashes_go_by_the_source():
    """Equal subtrees have equal hashes, wherever they stand; others don't; white space counts once."""
    a, b, c = (html_text.parse(f"<div><section>{x}</section><ul><li>z</li></ul></div>")[1] for x in ("<p>one</p>", "<p>one\n </p>", "<p>two</p>"))
    assert [x.exact for x in a[2:]] == [x.exact for x in c[2:]] and a[1].exact != c[1].exact and a[0].exact != c[0].exact
    assert html_text.parse("<div><p>a  b</p></div>")[1][0].exact == html_text.parse("<main><div><p>a\nb</p></div></main>")[1][0].exact
    assert b[1].exact != a[1].exact
