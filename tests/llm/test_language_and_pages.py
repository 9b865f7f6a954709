"""Languages by held-out accuracy, pages by the article they were made from."""

import os
import random
import sys
import zlib

import numpy as np
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))

from cases import documents, sentence, texts  # noqa: E402

from silverloom.llm import html_extract, language_id, page_text  # noqa: E402
from silverloom.llm.queries.op3 import op3_language_id  # noqa: E402
from silverloom.llm.queries.op7 import op7_html_extraction  # noqa: E402

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    found = op3_language_id(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert len(found) == 1000
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in found)
    tested = [r for r in found if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in tested) >= 0.98 * len(tested)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_awkward_texts(spark):
    profiles = language_id.fit(documents(spark))
    rows = documents(spark).select("text", "hash", language_id.predict(F.col("text"), profiles).alias("p")).collect()
    assert len(rows) == len(texts())
    for r in rows:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["p"]["lang_pred"] == "und") != letters and (letters or r["p"]["score"] == 0)
    nothing = language_id.fit(documents(spark, []))
    assert {r["p"]["lang_pred"] for r in documents(spark).select(language_id.predict(F.col("text"), nothing).alias("p")).collect()} == {"und"}


def test_copies_teach_once(spark):
    rng = random.Random(3)
    rows = [(i, sentence(rng, lang, 20), lang, "s") for i, lang in enumerate(["en", "es", "de"] * 30)]
    copies = [(1000 + i, rows[0][1], "en", "s") for i in range(3000)]
    once, often = (language_id.fit(documents(spark, r), most=200) for r in (rows, rows + copies))
    assert once.languages == often.languages == ["de", "en", "es"]
    assert np.allclose(once.prototypes, often.prototypes) and np.allclose(once.mean, often.mean)


def test_vectors_are_bound_and_bundled(monkeypatch):
    """The bundle of a text is the mean of its trigrams' vectors, in whatever blocks it is made."""
    text = "Ab, abc ba"
    points = language_id.symbols(text)
    assert "".join(map(chr, points)) == " ab abc ba "

    def vector(p):
        return 1 - 2 * np.unpackbits(language_id.letter_bits(np.array([p], np.uint32), 256).view(np.uint8).reshape(1, -1), axis=1)[0].astype(int)

    want = sum(np.roll(vector(a), 2) * np.roll(vector(b), 1) * vector(c) for a, b, c in zip(points, points[1:], points[2:], strict=False))
    for block in (1 << 12, 2):
        monkeypatch.setattr(language_id, "TRIGRAMS", block)
        found, counts = language_id.bundles([None, text, "12"], 256)
        assert counts.tolist() == [0, len(points) - 2, 0]
        assert np.allclose(found[1] * counts[1], want) and not found[[0, 2]].any()


PAGE = """<!doctype html><html><head><title>T</title><style>p{{}}</style><script>var a="</p><p>no</p>";</script></head><body>
<header><h2>Site</h2></header><nav><ul><li>Home<li>More</ul></nav><div class="cookie-banner">We use <b>cookies</b></div>
<aside>Side <p>bar</p></aside><form><input value=x> Search <button>Go</button></form><!-- <p>no</p> -->
<article><h1>Head &amp; title</h1><p>One <b>bold</b>word&nbsp;and
 a<br>break &lt;tag&gt; &#233;<p>Two<div>Three <i>four</i></div><table><tr><td>c1<td>c2</table>
<section id="comments"><p>Reader says</p></section><div class="ad">Buy</div><footer>By me</footer></article>
<div id="disqus">No</div><footer>&copy; us</footer>"""


def test_one_page():
    blocks = html_extract.article_blocks(page_text.parse(PAGE.replace("{{}}", "{}")))
    assert [t for _, t in blocks] == ["Head & title", "One boldword and a break <tag> é", "Two", "Three four", "c1", "c2"]


def test_names_that_are_topics_stay():
    html = """<article><h2 id="related-work">Related work</h2><section id="discussion"><p>Found</p></section>
<div id="form-of-government">Republic</div><p class="notification-letters">Letters</p><section id="social-impact"><p>Impact</p></section>
<div class="share-buttons">Share</div><div class="lead related_posts">More</div><div id="comments">Reader</div>
<p>Sum <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math> here</p></article>"""
    want = ["Related work", "Found", "Republic", "Letters", "Impact", "Sum x=2 here"]
    assert [t for _, t in html_extract.article_blocks(page_text.parse(html))] == want


def test_unclosed_elements_end_with_their_parent():
    for tag in ("svg", "audio", "video", "object", "canvas", "template"):
        html = f"<article><div><p>a</p><{tag} x=1><g>lost<{tag}>lost</{tag}></div><p>b <{tag}><p>lost</p></{tag}>c</p></article>"
        assert [t for _, _, t in page_text.parse(html).blocks] == ["a", "b c"], tag
    assert [t for _, _, t in page_text.parse("<div><p>a <math><mi>x</div><p>b").blocks] == ["a x", "b"]


def test_broken_pages():
    for html in ("", None, "<", "a < b", "<p", "<p class='x>y</p>", "</p></div>text", "<script>never ends", "<!-- open", "&bogus; &#x110000;", "<div>" * 3000):
        page_text.parse(html)
    assert [t for _, _, t in page_text.parse("a < b<p>c").blocks] == ["a < b", "c"]


def site(n=60):
    """Pages without marked articles: the same notes on every page, and a text of its own."""
    rng = random.Random(9)
    rows = []
    for i in range(n):
        body = [sentence(rng, "en", rng.randint(5, 30)) for _ in range(3)]
        html = f"<body><div class=x1>Tick the box</div><div class=x2>{rng.choice(['Now', 'Then'])}</div><div class=c>" + "".join(f"<p>{b}</p>" for b in body) + "</div></body>"
        rows.append((i, f"http://Host.example/{i}", html, "\n".join(body), 1))
    return rows


def test_style_tree_finds_what_pages_share(spark):
    rows = site() + [(100 + i, f"http://host.example/copy{i}", site()[0][2], site()[0][3], 1) for i in range(40)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, want string, noise int")
    found = {r["page_id"]: r["text"] for r in html_extract.main_text(df).collect()}
    assert found == {r[0]: r[3] for r in rows}


def test_awkward_rows(spark):
    rows = [(1, None, None), (None, "x", "<p>a"), (2, "http://a.b/", ""), (2, "http://a.b/", ""), (3, "http://a.b/c", "<p>q")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = sorted(((r["page_id"], r["url"], r["text"]) for r in html_extract.main_text(df).collect()), key=repr)
    assert found == sorted([(1, None, ""), (None, "x", "a"), (2, "http://a.b/", ""), (2, "http://a.b/", ""), (3, "http://a.b/c", "q")], key=repr)
    assert html_extract.main_text(df.limit(0)).count() == 0


def test_pages_give_their_articles(spark):
    import html as h
    import re

    found = {r["page_id"]: r for r in op7_html_extraction(spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        article = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1].replace("<br>", " ")
        blocks = [" ".join(h.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>", article)]
        want = "\n".join(b for b in blocks if b)
        assert found[r["page_id"]]["text"] == want and found[r["page_id"]]["n_chars"] == len(want)
