"""Main text of pages against what the pages are made of."""

import html
import re

import numpy as np
import pytest

from shipreport.llm import htmltext as H


def one(page):
    return H.main_text([page], H.learnt())[0]


def test_whole_table(spark):
    """The article element of the test pages, taken out by hand."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in H.digest(pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        inside = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        cut = [" ".join(html.unescape(re.sub("<[^>]*>", "", x.replace("<br>", " "))).split()) for x in re.split("</?(?:h1|p)>", inside)]
        want = "\n\n".join(x for x in cut if x)
        assert got[r.page_id].text == want and got[r.page_id].n_chars == len(want) and got[r.page_id].url == r.url


TEXT = "A sentence of the article that is long enough to be one, with a few more words in it. " * 2


@pytest.mark.parametrize("page,want", [
    (f"<body><header><h2>Site</h2></header><main><h1>T</h1><p>{TEXT}</p></main><aside><p>{TEXT}</p></aside><footer>x</footer>", ["T", TEXT]),
    (f"<div class='cookie-notice'><p>{TEXT}</p></div><div class=post><h1>T</h1><p>{TEXT}</p></div><div id=comments><p>{TEXT}</p></div>", ["T", TEXT]),
    (f"<article><h1>T</h1><p>{TEXT}</p><section class='reader-comments'><p>{TEXT}</p></section><form><p>Mail</p></form></article>", ["T", TEXT]),
    (f"<nav><a href=/>Home</a> <a href=/b>News</a></nav><h1>T</h1><p>{TEXT}</p><div class=sidebar><p>{TEXT}</p></div>", ["T", TEXT]),
    (f"<article><p>{TEXT}<script>if (a < b) x('</p><p>no')</script><style>p{{}}</style><!-- <p>no</p> --></p></article>", [TEXT]),
    ("<article><h1>A &amp; B &lt;c&gt; &#233;&nbsp;&eacute;</h1><p>x <b>y</b>z<br>w\n\t v</p></article>", ["A & B <c> é é", "x yz w v"]),
    (f"<article><p>{TEXT}<p>{TEXT}<ul><li>one thing<li>another</ul></article>", [TEXT, TEXT, "one thing", "another"]),
    (f"<article><p>1 < 2 and 3 > 2, <a href='/x>y'>link</a> {TEXT}</p></article>", [f"1 < 2 and 3 > 2, link {TEXT}"]),
    (f"<ARTICLE><P>{TEXT}</P></ARTICLE><div hidden><p>{TEXT}</p></div>", [TEXT]),
    ("", []), ("   ", []), ("<script>", []), ("<p", ["<p"]), ("<!-- open", []), ("just words", ["just words"]),
])
def test_layouts(page, want):
    assert one(page) == [" ".join(w.split()) for w in want]


@pytest.mark.parametrize("page,want", [
    (f"<article><h1>T <svg class='i'/></h1><p>{TEXT}</p></article>", ["T", TEXT]),
    (f"<article><svg viewBox='0 0 1 1' /><p>{TEXT}</p><p>b <svg><path d='M0'/><text>no</text></svg>c</p></article>", [TEXT, "b c"]),
    (f"<article><div><object data=x></div><p>{TEXT}</p><p>b <object>no</object>c</p></article>", [TEXT, "b c"]),
    (f"<article><p><object data=x><p>no</p></object>b</p><p>{TEXT}</p></article>", ["b", TEXT]),
    (f"<article><div><select><option>no</div><p>{TEXT}</p></article>", [TEXT]),
    (f"<article><div><svg><path></div><p>{TEXT}</p></article>", [TEXT]),
    (f"<article><svg><path><p>{TEXT}</p></article>", [TEXT]),
    (f"<article><p>{TEXT}<svg><svg/><style>a::after {{ content: '</p>' }}</style><svg><g>no</g></svg>no</svg></p><p>b</p></article>", [TEXT, "b"]),
    (f"<article><p>{TEXT}<svg><foreignObject><div>no</div></foreignObject><title>no</title></svg></p></article>", [TEXT]),
    (f"<article><p>{TEXT}</p></article><textarea><p>{TEXT}</p>", [TEXT]),
])
def test_silent_elements_without_an_end(page, want):
    assert one(page) == [" ".join(w.split()) for w in want]


@pytest.mark.parametrize("page,want", [
    ("<article><p title=don't>Hello to all of you.</p><p>The second one's here.</p></article>", ["Hello to all of you.", "The second one's here."]),
    (f"<article><p title=\"open>{TEXT}</p><p>b</p></article>", [TEXT, "b"]),
    (f"<article><p data-x = 'a>b' y=\"c>d\" z=e/f>{TEXT}</p></article>", [TEXT]),
    ("<article><p>AT&amp<b>;T</b> and R&<i>lt;</i> here</p></article>", ["AT&;T and R&lt; here"]),
    (f"<nav><ul><li><a href=/>no</a></ul></nav><article><h1>T</h1><ul>{'<li><a href=/x/>an item</a></li>' * 10}</ul><p>{TEXT}</p></article>",
     ["T"] + ["an item"] * 10 + [TEXT]),
    (f"<article><p>{TEXT}<!x <p", [f"{TEXT}<!x <p"]),
])
def test_no_article_text_is_lost(page, want):
    assert one(page) == [" ".join(w.split()) for w in want]


@pytest.mark.parametrize("part", ["<a ", "<", "<!", "</a", "<p a='", '<p a="b ', "<svg><p>", "<div><object></div>", "<div id" + "id" * 50 + ">", "<!-", "<a b=\"'>"])
def test_unclosed_markup_takes_linear_time(part):
    import time

    page = part * (1_000_000 // len(part))
    start = time.process_time()
    H.blocks(page)
    assert time.process_time() - start < 20


def test_odd_rows(spark):
    long = f"<article><p>{TEXT * 20000}</p></article>"
    df = spark.createDataFrame([(1, "u", None, 5), (1, "u", "", 5), (None, None, f"<article><p>{TEXT}</p></article>", 5), (3, "v", long, 5)],
                               "page_id bigint, url string, html string, text int")
    got = H.digest(df).collect()
    assert sorted(r.n_chars for r in got) == [0, 0, len(TEXT.strip()), len((TEXT * 20000).strip())]
    assert H.digest(df.limit(0)).count() == 0
    assert dict(H.extracted(df).dtypes)["text"] == "string"


def test_the_tree_fits_its_table_and_uses_neighbours_when_they_decide():
    x, y = H.labelled_blocks()
    assert (H.learnt().predict(x) == y).mean() > 0.97
    rng = np.random.default_rng(1)
    x = rng.random((300, 4))
    y = (x[:, 2] > 0.3) & (x[:, 1] < 0.6)
    assert (H.grown(x, y).predict(x) == y).all()
    assert H.grown(x[:5], np.ones(5, bool)).low is None
