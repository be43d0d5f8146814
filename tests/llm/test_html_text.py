from __future__ import annotations

import html
import re
import time

import numpy as np
import pytest

from netpulse.llm.html_text import BONUS, LONG, SURGE, WINDOW, extracted, main_text
from netpulse.llm.queries import op6_html

from .conftest import SMALL

ARTICLE = "This is a sentence of the article that is long enough to count as text. "


def test_query_against_the_generated_articles(spark, tables):
    found = {r.page_id: r for r in op6_html(spark, SMALL).collect()}
    for page in tables("pages").collect():
        inner = re.search(r"<article>(.*?)</article>", page.html, re.DOTALL)[1]
        parts = re.split(r"</?(?:p|h1)>", inner)
        texts = [" ".join(html.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", p))).split()) for p in parts]
        assert found[page.page_id].text == "\n".join(t for t in texts if t)
        assert found[page.page_id].n_chars == len(found[page.page_id].text) and found[page.page_id].url == page.url


@pytest.mark.parametrize(
    "rest",
    [
        "<nav><ul><li><a href='/'>Home</a></li></ul></nav>",
        "<header><h1>Site</h1><p>" + ARTICLE + "</p></header>",
        "<div class='sidebar'><p>" + ARTICLE * 3 + "</p><div>more</div></div>",
        "<div id=\"cookie-notice\">We use cookies. <button>OK</button></div>",
        "<section class='comments'><article class='comment'><p>" + ARTICLE + "</p></article></section>",
        "<form><p>" + ARTICLE + "</p><input name=q></form>",
        "<div class=ad>Buy now</div>",
        "<script>document.write('<p>" + ARTICLE + "</p>')</script>",
        "<style>p{color:red}</style><!-- <p>" + ARTICLE + "</p> -->",
        "<footer>&copy; all rights</footer>",
        "<div role='complementary'>" + ARTICLE + "</div>",
        "<div hidden>" + ARTICLE + "</div>",
    ],
)
@pytest.mark.parametrize("tag", ["article", "div"])
def test_what_is_left_out(rest, tag):
    body = f"<p>{ARTICLE}a &lt; b&nbsp;&amp; c</p>\n<p>{ARTICLE}\n  two   <b>bold</b>lines<br>here</p><p>Short.</p>"
    want = f"{ARTICLE}a < b & c\n{ARTICLE}two boldlines here\nShort."
    for page in (f"{rest}<{tag}>{body}</{tag}>", f"<{tag}>{body}</{tag}>{rest}", f"<{tag}>{rest}{body}</{tag}>"):
        if tag == "article" and rest.startswith("<header") and page.startswith("<article><header"):
            continue  # a header inside an article holds its title
        assert main_text(f"<html><head><title>T</title></head><body>{page}</body></html>") == want


def test_short_scattered_lines_without_article_element():
    menu = "".join(f"<div>Item {i}</div><div></div>" for i in range(3))
    page = f"<body>{menu}<script>x</script><div>{ARTICLE}</div><div>{ARTICLE}</div><script>y</script>{menu}</body>"
    assert main_text(page) == f"{ARTICLE.strip()}\n{ARTICLE.strip()}"


@pytest.mark.parametrize("page", [None, "", "   ", "<", "<p", "<!--", "<div><div><p>", "&#0;&bogus;", "</p></div>", "<a b='>", "<script>never closed"])
def test_broken_pages_do_not_crash(page):
    assert isinstance(main_text(page), str)


def test_odd_rows(spark):
    rows = [(1, None, None), (None, "u", ""), (2, "u", "<p>" + "word " * 200_000), (3, "u", "<p>hi</p>"), (3, "u", "<p>hi</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as text", "1 as n_chars")
    found = extracted(df)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(r.n_chars for r in found.collect()) == [0, 0, 2, 2, 999_999]
    assert extracted(df.limit(0)).collect() == []


@pytest.mark.parametrize(
    "start,end",
    [
        ("<div class='layout has-sidebar'><article>", "</article></div>"),
        ("<div id='content' class='no-sidebar'><article>", "</article></div>"),
        ("<div class='social page'><main>", "</main></div>"),
        ("<div class='no-sidebar'>", "</div>"),
    ],
)
def test_marked_elements_around_the_text_stay(start, end):
    assert main_text(f"<body>{start}<p>{ARTICLE}</p><p>{ARTICLE}</p>{end}</body>") == f"{ARTICLE.strip()}\n{ARTICLE.strip()}"


def test_marked_elements_that_hold_long_text_stay():
    lines = "".join(f"<p>{ARTICLE * 3}</p>" for _ in range(2))
    linked = "".join(f"<p><a href='/'>{ARTICLE * 3}</a></p>" for _ in range(2))
    long = (ARTICLE * 3).strip()
    for tag in ("article", "div"):
        page = f"<{tag}><p>{ARTICLE * 3}</p>%s</{tag}>"
        assert main_text(page % f"<section id='related-work'>{lines}</section>") == "\n".join([long] * 3)
        assert main_text(page % f"<section id='related-work'>{linked}</section>") == long
        assert main_text(page % f"<section id='comments'>{lines}</section>") == long
    assert main_text(f"<article><div class='entry-header'>Title</div><p>{ARTICLE}</p></article>") == f"Title\n{ARTICLE.strip()}"


def test_text_beside_an_article_teaser_stays():
    body = f"<div><p>{ARTICLE * 4}</p><p>{ARTICLE * 4}</p></div>"
    long = (ARTICLE * 4).strip()
    teaser = "<article><p>Read more about it here, if you like</p></article>"
    assert main_text(f"<body>{body}<script></script>{teaser}</body>").startswith(f"{long}\n{long}")
    # an article that outweighs what stands around it decides alone
    assert main_text(f"<body><article>{body}<p>End.</p></article><div>{ARTICLE * 3}</div></body>") == f"{long}\n{long}\nEnd."


def test_short_marked_parts_inside_an_article():
    page = f"<article><p>{ARTICLE}</p>%s</article>"
    for part in ("<section class='search-results'>Found three.</section>", "<div class='notice'>Found three.</div>"):
        assert main_text(page % part) == f"{ARTICLE.strip()}\nFound three."
    for part in ("<div class='related'><a href='/'>Found three.</a></div>", "<div class='cookie-notice'>Found three.</div>"):
        assert main_text(page % part) == ARTICLE.strip()


def brute_force(lines):
    """Lines (text, in the article) of plain blocks by the definition, window by window."""

    def kept(sizes, least):
        sums = [sum(sizes[i : i + WINDOW]) for i in range(len(sizes))]
        out = []
        for i in range(len(sizes)):
            a, b = i, i
            while sums[i] and a and sums[a - 1]:
                a -= 1
            while sums[i] and b + 1 < len(sums) and sums[b + 1]:
                b += 1
            if sizes[i] and max(sums[a : b + 1]) >= least:
                out.append(i)
        return out

    around = [0 if inside else len(t) for t, inside in lines]
    weight = sum(BONUS * len(t) for t, inside in lines if inside)
    if 0 < weight >= sum(around[i] for i in kept(around, SURGE)):
        return "\n".join(t for t, inside in lines if t and inside)
    sizes = [len(t) * (BONUS if inside else 1) for t, inside in lines]
    most = max((sum(sizes[i : i + WINDOW]) for i in range(len(sizes))), default=0)
    return "\n".join(lines[i][0] for i in kept(sizes, min(SURGE, most)))


def test_lines_against_brute_force():
    rng = np.random.default_rng(6)
    for case in range(300):
        lines, page, inside = [], [], False
        for _ in range(rng.integers(1, 25)):
            kind = rng.integers(0, 8)
            if kind == 0 and case % 3:
                inside = not inside
                page.append("<article>" if inside else "</article>")
            elif kind < 3:
                page.append("<script>x</script>")
                lines += [("", False)] * WINDOW
            else:
                text = "a" * int(rng.choice([1, 5, 20, 30, 90]))
                page.append(f"<p>{text}</p>")
                lines.append((text, inside))
        assert main_text("".join(page) + "</article>" * inside) == brute_force(lines)


@pytest.mark.parametrize("chars", [LONG - 1, LONG])
@pytest.mark.parametrize("before", [0, 5])
def test_window_of_a_marked_element_stays_inside_it(chars, before):
    """Lines around the element add nothing to its windows, wherever in the page it stands."""
    marked = f"<div class='sidebar'><p>{'b' * 10}</p><p>{'c' * (chars - 20)}</p><p>{'d' * 10}</p><p>e</p></div>"
    around = f"<p>{'a' * 300}</p>" * before
    assert ("c" in main_text(f"<body>{around}{marked}<p>{'f' * 300}</p></body>")) == (chars >= LONG)


@pytest.mark.parametrize(
    "page",
    ["<p>a</p><div class=ad>" * 40_000, "<div class=sidebar>" * 50_000 + "</div>" * 50_000, "<a " * 300_000, "<svg>" * 100_000,
     "<i><div>" + "<b>" * 100_000 + "</i>" * 100_000, "<a '>\"" * 150_000, "<a \"'" * 200_000 + ">", "<!--" * 250_000],
)
def test_broken_pages_take_linear_time(page):
    seconds = []
    for part in (page[: len(page) // 4], page):
        start = time.process_time()
        main_text(part)
        seconds.append(time.process_time() - start)
    assert seconds[1] < 8 * seconds[0] + 0.5  # 4 times the page; 16 times if it were quadratic


def test_end_tags_that_are_missing():
    assert main_text(f"<article><p>{ARTICLE}<div class=ad>{ARTICLE}</article>") == f"{ARTICLE.strip()}\n{ARTICLE.strip()}"
    assert main_text(f"<article><ul><li>{ARTICLE}<li class=ad>Buy<li>{ARTICLE}</ul></article>") == f"{ARTICLE.strip()}\n{ARTICLE.strip()}"
    assert main_text(f"<article><p>a<b>b</i></p>{ARTICLE}</b></article>") == f"ab\n{ARTICLE.strip()}"
