from __future__ import annotations

import html
import random
import re
import time
from itertools import product

import pytest

from slotwise.llm.maintext import blocks, host_of, main_text, main_texts
from slotwise.llm.mincut import cheapest_labels

LONG = "This sentence tells a part of the story, and it goes on for quite some time before it ends."
OTHER = "Another paragraph follows with more of what the reader came for, told at some length as well."


def best_labels(gains, links):
    def worth(taken):
        return sum(g for g, t in zip(gains, taken) if t) - sum(w for a, b, w in links if taken[a] != taken[b])

    return list(min(product((False, True), repeat=len(gains)), key=lambda t: (-worth(t), sum(t))))


@pytest.mark.parametrize("seed", range(30))
def test_cuts_are_cheapest(seed):
    r = random.Random(seed)
    for _ in range(20):
        n = r.randint(1, 8)
        gains = [r.randint(-6, 6) for _ in range(n)]
        links = [(r.randrange(n), r.randrange(n), r.randint(0, 5)) for _ in range(r.randint(0, 14))]
        assert cheapest_labels(gains, links) == best_labels(gains, links)


def test_a_rest_that_needs_flow():
    n = 200
    gains = [5 if i % 2 else -4 for i in range(n)]
    links = [(i, i + 1, 7) for i in range(n - 1)]
    assert cheapest_labels(gains, links) == [True] * n
    assert cheapest_labels([-g for g in gains], links) == [False] * n


def plain_article(page):
    inside = re.search("<article>(.*)</article>", page, re.S)[1]
    pieces = re.split("</?(?:p|h1)>", re.sub("</?b>", "", inside.replace("<br>", " ")))
    return "\n\n".join(t for t in (" ".join(html.unescape(p).split()) for p in pieces) if t)


def test_whole_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    want = {(r["page_id"], r["url"], t := plain_article(r["html"]), len(t)) for r in pages.collect()}
    got = [tuple(r) for r in main_texts(pages).collect()]
    assert len(got) == pages.count() and set(got) == want


@pytest.mark.parametrize(
    "around",
    [
        "<header><a href='/'>Site</a> <h2>Welcome to the site of the year.</h2></header>{}<footer>© 2024 Site. {o}</footer>",
        "{}<aside><h3>More</h3><p>{o}</p></aside>",
        "<div class='sidebar-left'><p>{o}</p></div>{}<div id='sidebar'><ul><li><a href='#'>{o}</a></li></ul></div>",
        "<div class='cookie-notice'><p>{o}</p><button>Accept all</button></div>{}",
        "{}<section id='comments'><h2>2 comments</h2><article class='comment'><p>{o}</p></article></section>",
        "{}<div class='commentList'><div class='entry-content'><p>{o}</p></div></div>",
        "<div role='navigation'><p>{o}</p></div>{}<div class=advert>{o}</div>",
        "{}<form action='/go'><label>Your name</label><input name=x><select><option>{o}</option></select><textarea>{o}</textarea></form>",
        "<script>var x = '<p>{o}</p>';</script><style>p {{color: red}}</style><noscript>{o}</noscript>{}<!-- <p>{o}</p> -->",
        "<div hidden><p>{o}</p></div><p style='display: none'>{o}</p>{}<dialog>{o}</dialog>",
    ],
)
@pytest.mark.parametrize("article", ["<article>{}</article>", "<main>{}</main>", "<div class='post-content'>{}</div>", "<div>{}</div>"])
def test_kinds_of_boilerplate(around, article):
    inner = f"<h1>Title of it</h1><p>{LONG}</p><p>{LONG.upper()} <a href='/'>With a link</a>.</p><blockquote>{LONG[:59]}</blockquote><p>{LONG}"
    page = f"<html><body class='has-sidebar'>{around.format(article.format(inner), o=OTHER)}</body></html>"
    want = ["Title of it", LONG, f"{LONG.upper()} With a link.", LONG[:59], LONG]
    assert main_text(page).split("\n\n") == want


def test_short_blocks_follow_their_neighbours():
    page = f"<div><p>{LONG}</p><p>Yes.</p><p>{LONG}</p></div><div><p>Home</p><p>Yes.</p><p>Log out</p></div>"
    assert main_text(page).split("\n\n") == [LONG, "Yes.", LONG]


def test_references_white_space_and_inline_markup():
    page = "<article><p> a&amp;b\n\t&lt;i&gt;\u00a0 <b>bo</b>ld<br>x &eacute;&#233;&#x1F600; " + LONG + "</p>tail of the article, " + LONG + "</article>"
    assert main_text(page) == f"a&b <i> bold x éé\U0001f600 {LONG}\n\ntail of the article, {LONG}"


def test_unclosed_and_nested_elements():
    page = f"<article><p>{LONG}<p>{OTHER}<ul><li>{LONG}<ul><li>{OTHER}</ul><li>{LONG}</ul><table><tr><td>{LONG}<td>{OTHER}<tr><td>{LONG}</table>"
    assert [b.text for b in blocks(page)] == [LONG, OTHER, LONG, OTHER, LONG, LONG, OTHER, LONG]
    assert main_text(page).count("\n\n") == 7
    assert main_text("<p a='>' b=\">\" c=>" + LONG) == LONG
    assert main_text(f"<svg><text>{OTHER}</text></svg><article>{LONG}<svg/>{LONG}") == f"{LONG}{LONG}"


def test_no_text():
    for page in (None, "", "   ", "<html></html>", "<p></p><nav>x</nav>", "<script>" + LONG, "<!-- " + LONG):
        assert main_text(page) == ""


@pytest.mark.parametrize("part", ["<nav ", "<a href=\"", "<!--", "<title>", "<button>", "<p>", "<div>", "<li>x<div>", "&", "<", "<div class=", "<p><a>x</a> y. "])
def test_hostile_pages_take_linear_time(part):
    began = time.time()
    main_text(part * (200_000 // len(part)))
    main_text("<div>" * 600 + part * (200_000 // len(part)))
    assert time.time() - began < 10


def test_hosts():
    assert host_of("https://u@WWW.Example.com:80/a?b") == "www.example.com"
    assert host_of("mailto:x") is host_of(None) is host_of("") is None


def test_blocks_that_a_host_repeats(spark):
    lead = "<div><p>" + LONG + "</p></div>"
    line = "<div><p>All of our offers of the week, only here and only now, for you</p></div>"
    rows = [(i, f"http://a.example/{i}", f"{lead.replace('This', str(i))}{line}") for i in range(4)] + [(9, "http://b.example/", f"{lead}{line}")]
    got = {r["page_id"]: r["text"] for r in main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all("offers" not in got[i] and LONG[5:] in got[i] for i in range(4)) and "offers" in got[9]


def test_odd_rows(spark):
    page = f"<article>{LONG}</article>"
    rows = [(1, "http://a/", page, 1, "x"), (1, "http://a/", page, 1, "x"), (None, None, page, 2, None), (2, "", None, 3, "y"), (3, "http://a/", "", None, "y")]
    rows.append((4, "http://a/", "<article>" + f"<p>{LONG}</p>" * 20_000, 4, "z"))
    df = spark.createDataFrame(rows, "page_id long, url string, html string, page long, host string")
    got = sorted(((r["page_id"] or 0), r["url"] or "", r["text"], r["n_chars"]) for r in main_texts(df).collect())
    long = "\n\n".join([LONG] * 20_000)
    one = len(LONG)
    assert got == sorted([(1, "http://a/", LONG, one)] * 2 + [(0, "", LONG, one), (2, "", "", 0), (3, "http://a/", "", 0), (4, "http://a/", long, len(long))])


def test_empty_table(spark):
    assert main_texts(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
