"""HTML markup that once lost text or took quadratic time; repeated rows and very long pages."""

import time

from parcelscope.llm import html_extract as H


def _text(spark, pages):
    df = spark.createDataFrame([(i, "u", h, "x", 1) for i, h in enumerate(pages)], "page_id long, url string, html string, text string, n int")
    return {r.page_id: r.text for r in H.extract(df).collect()}


def test_quotes_only_count_in_values(spark):
    pages = ["<article><p title=it's>Hello there.</p><p>We don't know.</p></article>",
             "<article><p title=\"a > b\" data-x='c > d'>One two.</p><p a=b'c\"d e='>'>Three \"four\".</p></article>",
             "<article><p \"odd' name>Five.</p><p class = 'x' id=y / >Six it's.</p></article>",
             "<article><p title=\"never closed>Seven.</p><p>Eight.</p></article>"]
    got = _text(spark, pages)
    assert got[0] == "Hello there. We don't know." and got[1] == 'One two. Three "four".' and got[2] == "Five. Six it's."
    assert "Eight." in got[3]


def test_repeated_rows_and_long_pages(spark):
    page = "<html><body><nav><a href=x>Home</a></nav><article>" + "".join(f"<p>Sentence number {i} goes on.</p>" for i in range(20_000)) + "</article></body></html>"
    got = _text(spark, [page, page, None, ""])
    assert got[0] == got[1] == " ".join(f"Sentence number {i} goes on." for i in range(20_000)) and got[2] == got[3] == ""
    df = spark.createDataFrame([(1, "u", "<article><p>Same page here.</p></article>")] * 3, "page_id long, url string, html string")
    assert [r.text for r in H.extract(df).collect()] == ["Same page here."] * 3


def test_markup_is_read_in_linear_time():
    for source in ("<div>" * 40_000 + "</p>x" * 40_000, "<div class=content>" * 40_000 + "x", "<a <b c='" * 40_000, "<p a=\"" * 40_000,
                   "<button>" * 20_000 + "x", "<div " + "a=b " * 100_000):
        began = time.time()
        H.Page(source)
        assert time.time() - began < 20, source[:30]
