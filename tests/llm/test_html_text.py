import time
from html.parser import HTMLParser

import pytest

from wayfield.llm import html_text as H

PROSE = ("It was the best of times and it was the worst of times, and for all of that there was not one of "
         "them who would have said that it had been anything but the time that they had been given to live in. " * 2)


class ArticleParser(HTMLParser):
    """Text of the blocks inside <article>, by the standard parser."""

    def __init__(self):
        super().__init__()
        self.inside, self.found = 0, [[]]

    def handle_starttag(self, tag, attrs):
        self.inside += tag == "article"
        if tag in ("p", "h1", "article"):
            self.found.append([])
        if tag == "br" and self.inside:
            self.found[-1].append(" ")

    def handle_endtag(self, tag):
        self.inside -= tag == "article"
        if tag in ("p", "h1", "article"):
            self.found.append([])

    def handle_data(self, data):
        if self.inside:
            self.found[-1].append(data)


def test_pages_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    want = {}
    for r in pages.collect():
        parser = ArticleParser()
        parser.feed(r.html or "")
        parser.close()
        want[r.page_id] = "\n\n".join(t for t in (" ".join("".join(b).split()) for b in parser.found) if t)
    got = H.extract(pages.withColumn("text", pages.page_id)).collect()
    assert len(got) == len(want) and all(r.text == want[r.page_id] and r.n_chars == len(r.text) for r in got)


def test_boilerplate_goes():
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p>a{{}}</style></head><body class="home">
    <header class="site"><h1>Site</h1><p>{PROSE}</p></header><nav><a href=x>Home</a></nav>
    <div id="cookie-notice">We use cookies to {PROSE}</div>
    <main><article class="post"><header><h1>Title &amp; more</h1></header>
    <p>{PROSE}&nbsp;<a href="y">a link</a> in&#32;it&hellip;</p><!-- <p>hidden {PROSE}</p> -->
    <p>Short.</p><ul><li>one item</li><li>two<br>lines</li></ul>
    <aside>{PROSE}</aside><div class="ad">buy {PROSE}</div><form><p>{PROSE}</p><input name="q"></form>
    <script>var a = "<p>no</p>";</script><blockquote>a &lt;b&gt; c</blockquote>
    <div class="related"><a href=1>x</a></div><p>a | b | c</p></article>
    <section class="comments"><article class="comment"><p>{PROSE}</p></article></section></main>
    <div class="sidebar-left">{PROSE}</div><footer>&copy; {PROSE}</footer></body></html>"""
    prose = " ".join(PROSE.split())
    assert H.main_text(page).split("\n\n") == [
        "Title & more", f"{prose} a link in it…", "Short.", "one item", "two lines", "a <b> c", "a | b | c"]


def test_without_article_neighbours_decide():
    page = (f"<div><a href=1>Home</a> <a href=2>News</a></div><h2>Head</h2><p>{PROSE}</p><p>Yes.</p><p>{PROSE}</p>"
            "<div><p><a href=3>More links here</a></p><p>Next</p><p><a href=4>And even more of them</a></p></div>")
    got = H.main_text(page).split("\n\n")
    prose = " ".join(PROSE.split())
    assert got[-3:] == [prose, "Yes.", prose] and "Next" not in got and "Home News" not in got


def test_broken_and_edge_pages(spark):
    assert H.main_text("") == "" and H.main_text(None) == ""
    assert H.main_text("<p") == "" and H.main_text("<!-- x") == "" and H.main_text("<script>a") == ""
    assert H.main_text("<article><p>a < b and 3 > 2 <b>c</p>") == "a < b and 3 > 2 c"
    assert H.main_text('<article><p title="a > b">x</p><p class="y>z</p>') != ""
    rows = [(1, None, "u"), (2, "<article>" + "<p>word the and of</p>" * 20_000, None), (2, "<article><p>é🙂", "u")]
    df = spark.createDataFrame(rows, "page_id long, html string, n_chars string")
    got = H.extract(df).collect()
    assert sorted(r.n_chars for r in got) == [0, 2, 20_000 * len("word the and of") + 2 * 19_999]
    assert H.extract(df.limit(0)).count() == 0


ARTICLE = " ".join(PROSE.split())
INDONESIAN = ("Perjalanan panjang itu dimulai ketika matahari terbit, lalu mereka berjalan bersama melewati sawah hijau, "
              "sungai jernih serta hutan lebat sambil bercerita tentang masa kecil, keluarga, harapan, dan mimpi besar. " * 3).strip()


@pytest.mark.parametrize("page,text", [
    (f'<div class="layout has-sidebar"><p>{ARTICLE}</p></div>', ARTICLE),
    (f'<article class="post comments-open"><p>{ARTICLE}</p></article>', ARTICLE),
    (f'<main><div class="content with-side"><p>{ARTICLE}</p></div></main>', ARTICLE),
    (f'<nav><a href="/">Home</a> <a href="/a">About us</a></nav><p>{INDONESIAN}</p>', INDONESIAN),
    (f'<div class="search-results"><p>{ARTICLE}</p></div>', ARTICLE),
], ids=["layout", "state", "side", "language", "all named"])
def test_articles_stay(page, text):
    assert H.main_text(f"<html><body>{page}</body></html>") == text


def test_amount_decides_what_the_article_is():
    got = H.main_text(f"<body><article><p>Teaser here.</p></article><div><p>{ARTICLE}</p></div></body>")
    assert ARTICLE in got
    # reader comments go, also where they are longer than the article, and articles of their own
    comments = "".join(f'<article class="comment"><p>{ARTICLE}</p></article>' for _ in range(5))
    page = f'<body><article><p>{ARTICLE}</p></article><section class="comments">{comments}</section>{comments}</body>'
    assert H.main_text(page) == ARTICLE


def test_deep_and_wide_pages_in_linear_time():
    def seconds(n):
        page = ("<div>" * n + f"<p>{ARTICLE}</p>" + "</div>" * n + "</span></li>" * n
                + "".join(f"<article><p>{ARTICLE}</p><h2>x</h2></article>" for _ in range(n // 10)))
        start = time.perf_counter()
        got = H.main_text(page)
        assert got.count(ARTICLE) >= n // 10
        return time.perf_counter() - start
    small, large = min(seconds(2000) for _ in range(3)), min(seconds(16_000) for _ in range(2))
    assert large < 24 * small
