import html
import re

import numpy as np
import pytest

from framecurate.llm import html_crf as H


@pytest.fixture(scope="module")
def model(llm_spark):
    return H.train(llm_spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))


def test_leaf_blocks():
    page = ("<!DOCTYPE html><head><title>T &amp; U</title><style>p{}</style></head><body><!-- <p>no</p> -->"
            "<p class='a b'>one <b>two<br>three</b>&nbsp;&lt;x&gt;<p>four<script>var t='</p>';</script> five"
            "<ul><li>six<li>se<i>ven</i></ul><div>eight</div>nine <a href='>'>ten</a> 1 < 2")
    got = H.leaf_blocks(page)
    assert [b.text for b in got] == ["T & U", "one two three <x>", "four five", "six", "seven", "eight", "nine ten 1 < 2"]
    assert got[1].words == {"a", "b"} and got[4].tags == ("body", "ul", "li") and got[0].tags == ("head", "title")
    for odd in (None, "", "<", "<<<>>", "</p>", "<p", "<script>never closed", "&#xZZ; &bogus; &amp", "<div " + "a='" * 50,
                "<b>" * 2000 + "x", "<p>" * 3000, "\x00<p>\x00"):
        assert isinstance(H.leaf_blocks(odd), list)
    assert [b.text for b in H.leaf_blocks("a" * 200_000)] == ["a" * 200_000]


def test_only_raw_elements_lose_their_content(model):
    for tag in ("<svg viewBox='0 0 1 1'/>", "<math/>", "<object data='x'>", "<canvas>", "<noscript>", "<template>"):
        got = H.leaf_blocks(f"<div><p>one {tag} two</p><p>three</p></div><p>four</p>")
        assert [b.text for b in got] == ["one two", "three", "four"], tag
    kept = ("<p>a <math><mi>x</mi><mo>=</mo><mn>2</mn></math> b</p><p><object>c</object> <canvas>d</canvas></p>"
            "<noscript>e</noscript><p><svg><style/><text>f</text><text>g</text></svg>h</p>"
            "<p>i <svg><title>j</title></svg> k</p>")
    got = H.leaf_blocks(kept)
    assert [b.text for b in got] == ["a x=2 b", "c d", "e", "f g h", "i", "j", "k"] and got[-1].tags == ("p",)
    raw = "".join(f"<{t}>x <p>y</p></{t}>" for t in ("script", "style", "textarea", "template", "iframe", "noframes", "xmp"))
    assert [b.text for b in H.leaf_blocks(f"<p>one {raw} two</p>")] == ["one two"]
    body = "".join(f"<p>This is paragraph {i} of the article, and it has a few more words in it.</p>" for i in range(4))
    text = H.main_text(model, f"<article><h1>A title <svg/></h1>{body}<p>The sum of <math><mi>q</mi></math> "
                              f"is known, and <object>its picture</object> too.</p>{body}</article>")
    assert text.count("\n") == 9 and "The sum of q is known, and its picture too." in text


def test_viterbi_is_the_best_chain(model):
    rng = np.random.default_rng(3)
    names = list(model.names)
    for n in range(1, 9):
        x = [[names[i] for i in rng.integers(0, len(names), 4)] for _ in range(n)]
        e = model.scores(x)

        def total(y):
            return model.first[y[0]] + sum(e[i][k] for i, k in enumerate(y)) + sum(
                model.pair[a][b] for a, b in zip(y, y[1:], strict=False))
        best = max(total([m >> i & 1 for i in range(n)]) for m in range(1 << n))
        assert abs(total(model.decode(x)) - best) < 1e-9
    assert model.decode([]) == []


def test_held_out_labelled_pages(model):
    pairs = [(a, b) for x, y in H.labelled_pages(["Words of some sentence are here, and more."], 200, seed=77)
             for a, b in zip(model.decode(x), y, strict=True)]
    assert np.mean([a == b for a, b in pairs]) > 0.98


def test_articles_of_the_table(llm_spark, model):
    got = H.extract_text(llm_spark.read.parquet("/root/testdata/sf0.1/pages.parquet"), model).collect()
    pages = {r["page_id"]: r["html"] for r in llm_spark.read.parquet("/root/testdata/sf0.1/pages.parquet").collect()}
    assert len(got) == len(pages)
    for r in got:
        article = re.search(r"<article>(.*)</article>", pages[r["page_id"]], re.S)[1]
        parts = (" ".join(html.unescape(re.sub(r"<[^>]+>", "", p.replace("<br>", " "))).split())
                 for p in re.split(r"</?(?:p|h1)\b[^>]*>", article))
        assert r["text"] == "\n".join(p for p in parts if p) and r["n_chars"] == len(r["text"])


def test_parts_that_are_not_the_article_go(model):
    body = "".join(f"<p>This is paragraph {i} of the article, and it has a few more words in it.</p>" for i in range(4))
    page = ("<html><body><header><a href='/'>Site</a></header><nav><a href='/x'>Menu</a></nav>"
            f"<main><h1>A title</h1>{body}<aside><p>Side words.</p></aside><div class='ad'>Buy this now.</div>"
            "<form><label>Mail</label><button>Go</button></form>"
            "<section class='comments'><p>I read it, and liked it a lot.</p></section></main>"
            "<div class='cookie-notice'>We use cookies.</div><footer>&copy; Site</footer></body></html>")
    text = H.main_text(model, page)
    assert text.startswith("A title\nThis is paragraph 0") and text.count("\n") == 4
    for gone in ("Menu", "Side", "Buy", "Mail", "liked", "cookies", "©"):
        assert gone not in text


def test_odd_pages(llm_spark):
    rows = [(1, "u", None, "t", 5), (None, None, "", None, None), (2, "u", "<article><p>x</p></article>", "t", 1),
            (2, "u", "<article><p>x</p></article>", "t", 1)]
    df = llm_spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    model = H.train(df)
    got = H.extract_text(df, model)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((str(r["page_id"]), r["text"]) for r in got.collect())[0] == ("1", "")
    none = df.where("1 = 0")
    assert H.extract_text(none, H.train(none)).collect() == []
