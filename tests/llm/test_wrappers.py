import html
import json
import re

from martwright.llm import shipping, wrappers

SF = "/root/testdata/sf0.001"


def article(page):
    inner = re.search(r"(?s)<article>(.*?)</article>", page)[1]
    return " ".join(html.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", inner))).split())


def test_articles_of_the_small_table(spark):
    shipping.importable(spark)
    rows = wrappers.extract(spark.read.parquet(f"{SF}/pages.parquet")).collect()
    assert all(r.text == article(r.html) and r.n_chars == len(r.text) for r in rows)


def page(i, paragraphs):
    body = "".join(f"<p>Text {i}.{n} of &lt;page&gt; {i} <b>bo</b>ld" for n in range(paragraphs))
    return (
        f"<html><head><title>t</title></head><body class='has-sidebar'><header>Site</header><ul class=menu><li>a<li>b</ul>"
        f"<div id=content><h2>Head {i}</h2>{body}</div><div class='sidebar'>links</div><div class=comments><p>me too</div>"
        f"<form>search</form><script>x</script></body></html>"
    )


def test_pages_without_an_article(spark):
    rows = [(i, "http://h.example/x", page(i, 1 + i % 4), "k") for i in range(8)]
    rows += [(90, None, None, "k"), (91, "http://other.example/", "", None), (92, "no address", "plain words", None), (92, "no address", "plain words", None)]
    found = wrappers.extract(spark.createDataFrame(rows, "page_id long, url string, html string, host string")).collect()
    assert len(found) == len(rows)
    for r in found:
        if r.page_id < 8:
            want = [f"Head {r.page_id}", *(f"Text {r.page_id}.{n} of <page> {r.page_id} bold" for n in range(1 + r.page_id % 4))]
            assert r.text == " ".join(want)
        elif r.page_id in (90, 91):
            assert r.text == "" and r.n_chars == 0
    assert wrappers.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def texts(spark, rows):
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r.page_id: r.text for r in wrappers.extract(frame).collect()}


def test_names_are_whole_and_articles_keep_their_sections(spark):
    found = texts(
        spark,
        [
            (1, "http://a.example/1", "<body class=has-sidebar><div class='content no-sidebar'><p>one two</div><div class=sidebar>out</div>"),
            (2, "http://b.example/1", "<div id=main-content class='post share-on'><p>three</p></div><div class='share links'>out</div>"),
            (3, "http://c.example/1", "<article><p>four</p><section class='related work'><p>five</p></section><div class=comments>out</div></article>"),
            (4, "http://d.example/1", "<p>foo<img src=x>bar <!-- out -->baz<br>next</p>"),
            (5, "http://e.example/1", "<article><h1>six</h1><nav>out</nav><article class=comment>out</article>seven</article><div>out</div>"),
        ],
    )
    assert found == {1: "one two", 2: "three", 3: "four five", 4: "foobar baz next", 5: "six seven"}


def test_pages_decide_by_themselves_whether_they_hold_an_article(spark):
    with_article = "<body><div class=x>out</div><article><p>in {0}</p></article>"
    without = "<body><div class=box><h2>Title {0}</h2></div><div class=text><p>body of {0} with many words, so that it weighs more</p></div><div class=x>same</div>"
    rows = [(i, "http://h.example/", with_article.format(i)) for i in range(3)]
    rows += [(10 + i, "http://h.example/", without.format(i)) for i in range(4)]
    # Rows without a readable address do not share a wrapper.
    rows += [(20, None, "<article>lone</article>"), (21, None, "<p>plain"), (22, "nowhere", "<p>other plain"), (23, None, None)]
    # Copies of a page are one page: what they hold is not a part of the frame.
    rows += [(30 + i, "http://copies.example/", "<div><p>copied text</p></div>") for i in range(5)]
    found = texts(spark, rows)
    for i in range(3):
        assert found[i] == f"in {i}"
    for i in range(4):
        assert found[10 + i] == f"Title {i} body of {i} with many words, so that it weighs more"
    assert [found[i] for i in (20, 21, 22, 23)] == ["lone", "plain", "other plain", ""]
    assert {found[30 + i] for i in range(5)} == {"copied text"}


def test_the_wrapper_names_the_slots_of_either_kind_of_page(spark):
    with_article = "<body><div class=x>out {0}</div><article><h1>Head {0}</h1><p>in {0}</p><p>Read more on our site</p></article>"
    rows = [("h", with_article.format(i)) for i in range(4)] + [("h", "<article><div><p>more</p></div></article>")]
    rows += [("h", f"<div class=text><p>body {i} of some length</p></div><div class=x>same</div>") for i in range(3)]
    rows += [("g", "<main>only articles here</main>"), ("f", None)]
    shipping.importable(spark)
    found = wrappers.chosen_slots(spark.createDataFrame(rows, "host string, html string").repartition(3)).collect()
    found = {r.host: [x and json.loads(x) for x in (r.in_article, r.without)] for r in found}
    assert found["h"] == [["*article>div>p", "*body>article>h1", "*body>article>p"], ["div.text>p"]]
    assert found["g"] == [["*main"], None] and found["f"] == [None, []]
    # An article is whole, whatever its pages share.
    article = [[e, False] for e in ("article", ["+", ["p", "#*article>p"]], "#*article>h2", "#div")]
    facts = {"*article>p": [5, 1, 1, [1, 2, 3]], "*article>h2": [900, 1, 2, [1, 2, 3]], "div": [5000, 1, 2, [1, 2, 3]]}
    assert wrappers.main_slots(article, facts) == {"*article>p", "*article>h2"}


def test_texts_that_all_different_pages_share_are_the_frame(spark):
    rows = [(i, "http://h.example/", f"<div><p>body {i} of some length</p><p class=end>Read more on our site</p></div>") for i in range(3)]
    assert texts(spark, rows) == {i: f"body {i} of some length" for i in range(3)}


def test_broken_pages_take_one_pass():
    import time

    pieces = ['<a "', "<a \">", "<a b=\"> '<a c='> \"", "<!", "<div class=x>t", "</script", "<div></p>", "<noscript>", "<", "&#", "<p class='"]
    start = time.monotonic()
    for piece in pieces:
        stream = wrappers.blocks(piece * (100_000 // len(piece)))
        wrappers.fold(stream)
    assert time.monotonic() - start < len(pieces)
    assert wrappers.blocks("1 < 2 <3 <b") == [("", "1 < 2 <3 <b")]
    assert wrappers.plain("&#" + "0" * 6000 + "65;&#" + "9" * 6000 + "; &lt;") == ["A�", "<"]
    a = [[f"#{i % 7}", False] for i in range(30_000)]
    start = time.monotonic()
    assert len(wrappers.align(a, a[2:])) >= len(a)
    assert time.monotonic() - start < 5
