from __future__ import annotations

import random

from corpuslab.llm import pages


def length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = row
        row = [0]
        for j, y in enumerate(b):
            row.append(last[j] + 1 if x == y else max(row[j], last[j + 1]))
    return row[-1]


def test_longest_common_subsequence(monkeypatch):
    rng = random.Random(1)
    for cells in (1 << 28, 4):  # whole, then halved again and again
        monkeypatch.setattr(pages, "CELLS", cells)
        for _ in range(1500):
            a, b = ([rng.randint(0, 5) for _ in range(rng.randint(0, 14))] for _ in range(2))
            found = pages.shared_lines(a, b)
            assert all(a[i] == b[j] for i, j in found) and len(found) == length(a, b)
            assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(found, found[1:]))


def text_of(page):
    return pages.main_text(pages.lines_of(page), set())


def test_markup():
    page = (
        '<!DOCTYPE html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="no-sidebar">'
        '<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></ul></nav><!-- ad --><div class="cookie-notice">Ok</div>'
        '<article><header><h1>Head &amp; line</h1></header><p><b>One\n  two<br>three<p>fo<i>ur</i> &lt;x&gt; &#233;</p>'
        '<aside>Side</aside><form><input><label>Mail</label></form><div class="ad-box">Buy</div>'
        '<section id="comments"><p>Nice</p></section><ul><li>a<li>b</ul></article><footer>&copy; x</footer>')
    assert text_of(page) == "Head & line One two three four <x> é a b"
    assert text_of("<p>1 < 2 and 3<4</p><p hidden>no</p>") == "1 < 2 and 3<4"
    assert [text_of(p) for p in ("", "<", "<p", "plain", "<p>a</div></p>b", "<a href='x")] == ["", "<", "", "plain", "a b", ""]
    assert text_of("<div " * 3000 + "<p>x") in ("", "x")


def test_article_by_name():
    page = ('<div id="header">Top</div><div class="wrap"><div class="post-content"><div class="post-header"><h2>T</h2></div><p>a</p>'
            '<div class="post-comments">no</div></div><div class="col">Other</div></div>')
    assert text_of(page) == "T a"
    assert text_of('<div class="entry-header"><h1>T</h1></div><div class="x">b</div>') == "T b"


def site(spark, extra=()):
    frame = "<div><p>Acme portal</p><p>All about acme</p></div>{}<div><p>Contact us</p></div>"
    rows = [(i, f"https://a.org/n/{i}", frame.format(f"<div><p>Story {i} begins</p><p>and ends {i}.</p></div>")) for i in range(9)]
    return spark.createDataFrame([*rows, *extra], "page_id long, url string, html string")


def test_shared_lines_go_where_no_article_is_declared(spark):
    copies = [(20 + i, f"https://b.org/{i}", "<p>Same text</p><p>in both</p>") for i in range(2)]
    got = {r.page_id: r.text for r in pages.extract_text(site(spark, copies)).collect()}
    assert {i: got[i] for i in range(9)} == {i: f"Story {i} begins and ends {i}." for i in range(9)}
    assert got[20] == got[21] == "Same text in both"  # copies say nothing


def test_shared_article_text_stays(spark):
    page = "<nav>menu</nav><article><p>A common passage</p><p>own {}</p><p><a href='/'>Read more</a></p></article>"
    rows = [(i, f"http://c.net/{i}", page.format(i)) for i in range(3)]
    got = {r.page_id: r.text for r in pages.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"A common passage own {i}" for i in range(3)}


def test_stretches_do_not_matter(spark, monkeypatch):
    want = {r.page_id: r.text for r in pages.extract_text(site(spark)).collect()}
    monkeypatch.setattr(pages, "STRETCH", 2)
    assert {r.page_id: r.text for r in pages.extract_text(site(spark)).collect()} == want


def test_edges(spark):
    schema = "page_id long, url string, html string, text string, key long, host string, gone string"
    rows = [(1, None, "<p>x</p>", "a", 1, "h", "g"), (1, None, "<p>x</p>", "a", 1, "h", "g"), (2, "u", None, None, None, None, None),
            (None, None, None, None, None, None, None), (3, "http://h/x", "", "b", 2, "h", "g"),
            (4, "http://h/y", "<p>" + "long line " * 50_000, "b", 2, "h", "g")]
    got = pages.extract_text(spark.createDataFrame(rows, schema))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    texts = sorted((str(r.page_id), r.text[:9], r.n_chars) for r in got.collect())
    assert texts == [("1", "x", 1), ("1", "x", 1), ("2", "", 0), ("3", "", 0), ("4", "long line", 499_999), ("None", "", 0)]
    assert pages.extract_text(spark.createDataFrame([], schema)).count() == 0
