import random

import numpy as np
import pytest

from skeinwork.llm import host_extract as H

PAGE = """<!DOCTYPE html><html lang=en><head><title>T</title><style>p{}</style><script>var a="</p><p>no";</script></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href="/x">menu</a></ul></nav><!-- <p>no</p> --><div class="ad-box">advert</div><div id="cookie-notice"><p>cookies</p></div>
<article><header><h1>Title &amp; more</h1></header><p><b>Lead   text<br>goes on<p>Second <i>p</i>ara&nbsp;here &lt;b&gt; 1 < 2<form><p>mail</p></form>
<ul><li>one<li>two</ul><div class="comments"><p>first!</p></div><p title="a > b">last</article><aside>side</aside><footer>&copy; 1</footer>"""


def test_markup():
    text, others = H.main_text(PAGE)
    assert text == "Title & more\nLead text goes on\nSecond para here <b> 1 < 2\none\ntwo\nlast"
    assert others == ["Site", "menu", "advert", "cookies", "mail", "first!", "side", "\u00a9 1"]
    assert H.main_text(None) == H.main_text("") == H.main_text("<article></article>") == ("", [])
    assert H.main_text("<main><p>a</main><p>b") == ("a", ["b"]) and H.main_text("<div role=main>x</div>") == ("x", [])
    assert H.main_text("just text") == (None, ["just text"])
    assert H.main_text("<p hidden>a<p style='display: none'>b<p>c<p aria-hidden=true>d") == (None, ["c"])
    assert H.main_text("<nav>menu</nav>") == ("", ["menu"])


def test_quoted_values_of_any_length():
    long = "x > y " * 100_000
    for quote in "\"'":
        assert H.main_text(f"<article><p title={quote}{long}{quote}>text</p></article>") == ("text", [])
    assert H.main_text('<article><p title="never closed>text</p></article>')[0] == "text"
    assert H.main_text("<article><p>it's > that's</p></article>")[0] == "it's > that's"


@pytest.mark.parametrize("html", ["<", "<p", "<p class='", "<!--", "<script>", "</p></div>", "<p>" * 5000, "<a b='" * 2000, "<div>" * 3000 + "x", "<<<>>>", "&#xD800;&#0;&bad;", "<p a=\">" * 100_001, "<p a='x" * 100_000, "<p a=\"'>" * 100_000])
def test_broken_markup_ends(html):
    H.main_text(html)


def brute(pages, least, run=H.RUN):
    """Texts of pages that are lists of blocks: without the runs of `run` tokens that stand on `least` of them."""
    on = {}
    for i, parts in enumerate(pages):
        words = " ".join(parts).split(" ")
        for j in range(len(words) - run + 1):
            on.setdefault(tuple(words[j : j + run]), set()).add(i)
    out = []
    for parts in pages:
        words = " ".join(parts).split(" ")
        covered = [False] * len(words)
        for j in range(len(words) - run + 1):
            if len(on[tuple(words[j : j + run])]) >= least:
                covered[j : j + run] = [True] * run
        left, at = [], 0
        for b in parts:
            n = len(b.split(" "))
            keep = " ".join(w for w, c in zip(words[at : at + n], covered[at : at + n]) if not c)
            left += [keep] if keep else []
            at += n
        out.append("\n".join(left))
    return out


def test_suffix_array_against_brute_force():
    for seed in range(20):
        r = random.Random(seed)
        tokens, page, streams = [], [], []
        for p in range(6):
            streams.append([r.randrange(3) for _ in range(r.randrange(0, 30))])
            own = streams[-1] + [-1 - p]
            tokens += own
            page += [p] * len(own)
        t = np.array(tokens)
        assert [tuple(tokens[i:]) for i in H.suffix_array(t)] == sorted(tuple(tokens[i:]) for i in range(len(tokens)))
        want = {}
        for p, own in enumerate(streams):
            for i in range(len(own) - 3):
                want.setdefault(tuple(own[i : i + 4]), set()).add(p)
        start, n = H.heads(t, np.array(page), 4)
        assert {tuple(tokens[s : s + 4]): k for s, k in zip(start, n)} == {g: len(p) for g, p in want.items()}


def words(r, k):
    return " ".join(f"w{r.randrange(10**6)}" for _ in range(k))


def test_unmarked_hosts_against_brute_force(spark):
    """Many pages in many tasks: the pieces' sums are those of the whole host."""
    r = random.Random(3)
    phrases = [words(r, k) for k in (3, 6, 7, 12, 25)]
    rows, pages, by_host = [], {}, {}
    for i in range(300):
        parts = [r.choice(phrases) if r.random() < 0.4 else words(r, r.randrange(1, 12)) for _ in range(r.randrange(1, 9))]
        host = r.choice("abc")
        by_host.setdefault(host, []).append(i)
        pages[i] = parts
        rows.append((i, f"https://{host.upper()}.example:80/{i}", "".join(f"<div>{b}</div>" for b in parts)))
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(7).selectExpr("*", "1 as text", "'x' as host")
    got = {r.page_id: r for r in H.extract(df).collect()}
    assert len(got) == 300 and all(r.decided == "host" for r in got.values())
    for ids in by_host.values():
        for i, text in zip(ids, brute([pages[i] for i in ids], H.PAGES)):
            assert got[i].text == text and got[i].n_chars == len(text)


def test_marked_pages_teach_what_surrounds_an_article(spark):
    """The menu that three marked pages hold in nav goes from an unmarked page too; copies of one article are one page."""
    menu, notice = "Home News About Contact Terms Privacy", "we value your privacy and so do our partners"
    marked = lambda i, text: (i, f"http://h/{i}", f"<nav>{menu}</nav><article>{text}</article><div class=cookie-notice>{notice}</div>")
    rows = [marked(i, f"article {i}") for i in range(3)] + [(9, "http://h/9", f"<div>{menu}</div><p>{words(random.Random(1), 9)}</p><div>{notice}</div>")]
    schema = "page_id long, url string, html string"
    got = {r.page_id: r for r in H.extract(spark.createDataFrame(rows, schema)).collect()}
    assert got[9].text == words(random.Random(1), 9) and got[9].decided == "host" and got[1].text == "article 1" and got[1].decided == "markup"
    copies = [marked(i, "the same article") for i in range(9)] + rows[3:]
    assert {r.page_id: r.text for r in H.extract(spark.createDataFrame(copies, schema)).collect()}[9].startswith(menu)


def test_cases(spark):
    rows = [(100, None, "<p>alone</p>"), (101, "https://a.example/z", None), (102, "mailto:x", PAGE), (0, "https://a.example/0", None), (0, "https://a.example/0", "x y"), (0, "https://a.example/0", "x y"), (None, None, "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted(((r.page_id, r.text[:5]) for r in H.extract(df).collect()), key=str)
    assert got == sorted([(100, "alone"), (101, ""), (102, "Title"), (0, ""), (0, "x y"), (0, "x y"), (None, "")], key=str)
    assert H.extract(df.limit(0)).count() == 0


def test_driver_pages(spark):
    import html
    import re

    rows = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    got = {r.page_id: r.text for r in H.op5_host_extract(spark, "/root/testdata/sf0.001").collect()}
    for p in rows:
        body = re.search("<article>(.*?)</article>", p.html, re.S).group(1)
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split("</?(?:p|h1)>", body)]
        assert got[p.page_id] == "\n".join(x for x in parts if x)


@pytest.mark.parametrize("wrapper", ["class='layout has-sidebar'", "class=no-sidebar", "class='elementor-widget-container'", "id=search-results-page", "class=widget", "class='overlay banner'"])
def test_class_takes_no_article_along(wrapper):
    page = "<nav>menu</nav><div class=ad-box>advert</div><div {}>{}<p>text</p><section id=social-history>a</section><div id=share-prices>b</div><div class=related-work>c</div><div class=social-share>no</div><article class=comment>no</article>{}</div>"
    in_main = page.replace("<article class=comment>no</article>", "").format(wrapper, "<main>", "</main>")
    assert H.main_text(in_main)[0] == "text\na\nb\nc"
    assert H.main_text(page.format(wrapper, "<article>", "</article>"))[0] == "text\na\nb\nc"
    assert H.main_text(f"<main><div {wrapper}><article>x</article></div></main>") == ("x", [])
    assert H.main_text(f"<div class=ad>advert</div><div {wrapper}><p>most of the text of the page</div>") == (None, ["most of the text of the page"])


def test_teasers_stay_out_of_the_text():
    assert H.main_text("<main><article>x</article><div class=related><article>teaser with more text</article></div></main>")[0] == "x"
    assert H.main_text("<article>x<div class='comments'><article>longer than the text</article></div></article>")[0] == "x"
