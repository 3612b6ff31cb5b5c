import html as h

import pytest

from seamwright.llm import html_text
from seamwright.llm.html_text import main_text

P = [
    "The first paragraph of the article says at some length what it is about, and goes on for a while.",
    "A second one follows, with as many words & marks as an ordinary paragraph of prose would have in it.",
    "Yes.",
    "The last paragraph ends the article with one more sentence of a usual length for such a text.",
]
NAV = "<nav><ul>" + "".join(f'<li><a href="/{w}">{w}</a></li>' for w in ("Home", "News", "Sport", "Mail")) + "</ul></nav>"


def paragraphs(tag="p"):
    return "".join(f"<{tag}>{h.escape(p)}</{tag}>" for p in P)


SHAPES = {
    "article": f"<html><head><title>T</title></head><body>{NAV}<div class='ad'>Buy this very good thing now, it is cheap and it lasts for a long time, we promise.</div><article><h1>Title</h1>{paragraphs()}</article><footer>&copy; someone, with all rights reserved and many other words</footer></body></html>",
    "main": f"<body><header><h1>Site</h1><p>A site about things that people like to read every day of the week.</p></header><main><h1>Title</h1>{paragraphs()}</main><aside><p>{P[0]}</p></aside></body>",
    "div": f"<body><div id='top-menu'><a href='/'>a</a> <a href='/b'>b</a></div><div><h1>Title</h1><div>{paragraphs()}</div></div><div class='sidebar'><p>{P[1]}</p></div><div id='comments'><h2>Comments</h2><p>{P[0]}</p><p>I think that this article is wrong in nearly all that it says.</p></div></body>",
    "article with a form around it": f"<body><form id='all'><div class='cookie-notice'><p>We use cookies to make this site better for you and for all others.</p></div><article class='post'><header><h1>Title</h1><p>By someone</p></header>{paragraphs()}<footer>Filed under things</footer><section class='comments'><article class='comment'><p>{P[0]}</p></article></section></article></form></body>",
    "unclosed": f"<body>{NAV}<article><h1>Title<p>" + "<p>".join(map(h.escape, P)) + "</article><footer>x",
    "script": f"<body><script>var a = '<p>not this</p>' < 3;</script><style>p{{}}</style><article><h1>Ti<b>tle</b></h1><!-- <p>nor this</p> -->{paragraphs()}<script>x('</article>')</script></article></body>",
    "table layout": f"<table><tr><td><a href=1>one</a><a href=2>two</a></td><td><h1>Title</h1>{paragraphs()}</td></tr></table>",
    "wrapper classes": f"<body class='no-sidebar has-comments'><div class='page-with-sidebar'><div class='main content'><h1 class='entry-header'>Title</h1>{paragraphs()}<div class='social share-buttons'>Share this on all the networks that you know of</div></div></div></body>",
    "names with other words": f"<body><div class='main-menu'>Choose from all that we have to offer to you today</div><div class='page-header'><h1>Site</h1><p>A site of many things to read for all of you</p></div><div class='content'><div class='post-header'><h1>Title</h1><span>By someone on a day in spring of that year</span></div>{paragraphs()}<div class='content-ad'><p>{P[0]}</p></div></div><div class='sidebar-wrapper'><p>{P[1]}</p></div><div class='page-footer'>All of the rights are reserved by someone</div></body>",
    "main in a named element": f"<div class='modal-open overlay'><main><h1>Title</h1>{paragraphs()}</main><section class='comments'><article><p>{P[0]}</p></article></section></div>",
    "list menu inside": f"<article><h1>Title</h1><ul><li><a href=1>one</a></li><li><a href=2>two</a></li><li><a href=3>three</a></li></ul>{paragraphs()}</article>",
}


@pytest.mark.parametrize("name", SHAPES)
def test_shapes(name):
    assert main_text(SHAPES[name]) == "\n".join(["Title", *P])


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("   \n ", ""),
        ("plain words alone", "plain words alone"),
        ("<nav><a href=x>only a menu</a></nav>", ""),
        ("<article><p>a</p></article>", "a"),
        ("<article><p>a&nbsp;b\n\t c<br>d</p><p> </p><p>&eacute;&#233;&amp;amp;&am</p></article>", "a b c d\néé&amp;&am"),
        ("<article><p>cut off in a ta<a hre", "cut off in a ta"),
        ("<article><p>cut off in a comment <!-- here <b>", "cut off in a comment"),
        ("<article><p>1 < 2 and 3 > 2</p></article>", "1 < 2 and 3 > 2"),
        ("<article><![foo[x]]><p>odd</p><![CDATA[y]]></article>", "odd"),
        ("<article><pre>a\n  b</pre></article>", "a b"),
        ("<article><table><tr><td>a</td><td>b</td></tr></table></article>", "a\nb"),
        ("<article><p>a</p></div></span></p><p>b</p></article>", "a\nb"),
    ],
)
def test_cases(page, text):
    assert main_text(page) == text


def test_very_long_and_deep_pages():
    long = "word " * 400_000
    assert main_text(f"<article><p>{long}</p></article>") == long.strip()
    deep = "<div>" * 20_000 + "<p>deep</p>" + "</div>" * 20_000 + "</span>" * 20_000
    assert main_text(deep) == "deep"
    assert main_text("<li>x" * 20_000).count("x") == 20_000


def test_ratios():
    import numpy as np

    flat = html_text.smoothed(np.full(9, 4.0))
    assert np.allclose(flat, 4)
    peak = html_text.smoothed(np.array([0, 0, 0, 9.0, 0, 0, 0]))
    assert peak.argmax() == 3 and peak[2] == peak[4] > peak[1] > peak[0]
    assert 2 < html_text.threshold(np.array([1, 1.5, 2, 8, 9.0])) < 8
    assert html_text.threshold(np.full(3, 2.0)) == 2


def test_query_rows(spark):
    rows = [(1, "u", SHAPES["article"], "x"), (1, "u", SHAPES["article"], "x"), (2, None, None, "y"), (None, "w", "<p>Word é</p>", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(map(tuple, html_text.extract(df).collect()), key=str)
    whole = "\n".join(["Title", *P])
    assert got == sorted([(1, "u", whole, len(whole)), (1, "u", whole, len(whole)), (2, None, "", 0), (None, "w", "Word é", 6)], key=str)
    assert html_text.extract(df.limit(0)).collect() == []
