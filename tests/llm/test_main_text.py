import time

import numpy as np
import pytest

from tessera.llm import main_text as M
from tessera.llm.html_blocks import blocks

VOCABULARY = ["the river was low and slow that year so the mill stood still for weeks while farmers waited".split(), "la maison est grande et le jardin petit mais on y vit bien".split()]


@pytest.fixture(scope="module")
def network():
    return M.trained(M.training_pages(VOCABULARY, M.TRAIN_PAGES, 11))


def texts(html):
    return [b.text for b in blocks(html)]


def test_blocks_and_implied_ends():
    assert texts("<p>a <b>b</b>c<br>d<p>e<div>f<span>g</span></div>h") == ["a bc d", "e", "fg", "h"]
    assert texts("<ul><li>a<li>b<ul><li>c</ul><li>d</ul><dl><dt>e<dd>f</dl>") == ["a", "b", "c", "d", "e", "f"]
    assert texts("<table><tr><td>a<td>b<tr><th>c</table><select><option>d<option>e</select>") == ["a", "b", "c", "d", "e"]
    assert [b.tag for b in blocks("<article><p>a</article>b</div></p>c")] == ["p", "", ""]


def test_character_references_and_space():
    assert texts("<p> a &amp;amp; &lt;b&gt;\n\t&eacute;&#233;&#xe9; x&nbsp;y &copy &unknown; &am</p>") == ["a &amp; <b> ééé x y © &unknown; &am"]
    assert texts("1 < 2 and <3 </ > <> b") == ["1 < 2 and <3 <> b"]


def test_unread_parts():
    page = """<!DOCTYPE html><head><title>t</title><style>p{}</style><script>var a="<p>x</p>";</script><meta charset=a></head><body><!-- <p>c</p> -->a
    <script>document.write("</p>")</script><template><p>z</p></template><svg><text>q</text></svg><noscript>n</noscript><textarea><p>t</textarea><p title="a > b">b</p><!--->c<!-- d --!>e<![CDATA[x]]>f"""
    assert texts(page) == ["a", "b", "cef"]
    assert texts("<head><title>t</title><p>a") == ["a"] and texts("<head>a<p>b") == ["a", "b"] and texts("<script>a") == [] and texts("<!-- a") == []
    assert texts(None) == [] and texts("") == [] and texts("<p></p> \n") == []


def test_broken_pages_take_linear_time():
    for page in ("<div>" * 60_000 + "a", "<!--" * 60_000, '<a "' * 60_000, "<li>" * 40_000 + "</div>" * 40_000, "<!-- a -->" * 40_000 + "--!>", "<" * 200_000, "<script>" * 40_000, "<div><li>" * 30_000 + "</p>" * 30_000, "&" * 200_000):
        began = time.time()
        blocks(page)
        assert time.time() - began < 8, page[:20]


def test_gradients_agree_with_differences():
    pages = M.training_pages(VOCABULARY, 3, 2)
    inputs, sizes = M.features(pages), np.array([len(p) for p in pages])
    wanted = np.array([b.label == "1" for p in pages for b in p], np.float32)
    p = {k: v.astype(np.float64) for k, v in M.parameters(1).items()}
    seen = np.ones(len(wanted), bool)
    g, _ = M.gradients(p, inputs, sizes, wanted, seen)
    r = np.random.default_rng(0)
    for name, v in p.items():
        spots = np.flatnonzero(g[name].ravel()) if name in ("paths", "words") else np.arange(v.size)
        for k in r.choice(spots, min(4, len(spots)), replace=False):
            at, e = np.unravel_index(k, v.shape), 1e-2
            old = v[at]
            v[at] = old + e
            up = M.gradients(p, inputs, sizes, wanted, seen)[1]
            v[at] = old - e
            down = M.gradients(p, inputs, sizes, wanted, seen)[1]
            v[at] = old
            assert abs((up - down) / (2 * e) - g[name][at]) < 2e-3 + 0.05 * abs(g[name][at]), name


def test_held_out_layouts(network):
    pages = M.training_pages([["andere", "wörter", "die", "nie", "gesehen", "wurden", "und", "doch", "text", "sind"]], 200, 77)
    right = [(b.label == "1") == (s >= 0.5) for p, x in zip(pages, M.scores(network, pages)) for b, s in zip(p, x)]
    assert np.mean(right) > 0.96
    alone = M.scores(network, [pages[3]])[0]
    assert np.allclose(alone, M.scores(network, pages)[3], atol=1e-4)


PAGE = """<html><head><title>A title</title></head><body class="home"><div id="cookie-banner"><p>We use cookies to improve your experience on this site. <button>Accept all</button></p></div>
<header class="site-header"><a href="/">The Daily</a><nav><ul><li><a href="/a">Home</a><li><a href="/b">News</a><li><a href="/c">Contact</a></ul></nav></header>
<div class="layout"><aside class="sidebar"><h3>Most read</h3><ul><li><a href=1>The mill that stood still for a year</a></li><li><a href=2>Farmers waited for rain</a></li></ul></aside>
<div class="post"><h1>The river was low</h1><p>The river was low and slow that year, so the mill stood still &amp; quiet.</p><div class="ad">Buy now! A special offer for you.</div>
<p>Farmers waited for weeks.</p><ul><li>wheat</li><li>rye &lt;old&gt;</li></ul><p>Then the rain came, and the river rose again within a day.</p>
<div class="comments"><h3>Comments</h3><div class="comment"><p>I remember that year well, the mill was still for weeks and the farmers waited.</p></div><form><label>Name</label><input><button>Send</button></form></div></div></div>
<footer><p>&copy; 2024 The Daily. All rights reserved.</p></footer></body></html>"""
WANTED = "The river was low The river was low and slow that year, so the mill stood still & quiet. Farmers waited for weeks. wheat rye <old> Then the rain came, and the river rose again within a day."


def test_operator(spark, network):
    rows = [(1, PAGE, "x"), (1, PAGE, "x"), (2, None, "y"), (3, "", None), (None, PAGE.replace("sidebar", "rail").replace('"post"', '"entry-content"'), "z"), (4, "<div><p>", "z")]
    df = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = {(r.page_id, r.text) for r in M.main_text(df, network).collect()}
    assert got == {(1, WANTED), (2, ""), (3, ""), (None, WANTED), (4, "")}
    assert M.main_text(df, network).count() == 6
    assert M.main_text(df.filter("page_id = 1").selectExpr("page_id", "html", "text as words"), network, keep=("words",)).columns == ["page_id", "words", "text"]
    told = M.labelled(df.filter("page_id = 1"), network).first()
    assert told.text == WANTED and len(told.blocks) == len(blocks(PAGE))


def test_long_pages(spark, network):
    body = "".join(f"<p>The river was low and slow that year, number {k}.</p>" for k in range(20_000))
    page = PAGE.replace("<p>Farmers waited for weeks.</p>", body + "<p>" + "mill stood still " * 100_000 + ".</p>")
    text = M.main_text(spark.createDataFrame([(1, page)], "page_id long, html string"), network).first().text
    assert all(f"number {k}." in text for k in range(0, 20_000, 7)) and text.count("mill stood still") >= 100_000 and "cookies" not in text and "All rights" not in text


def test_query_on_articles(spark, tmp_path):
    """The query's own training: pages of the table's kind, whose article is known."""
    layout = "<html><head><title>{0}</title></head><body><nav><ul><li><a href='/a'>{1}</a></li><li><a href='/b'>{2}</a></li></ul></nav><div class='ad'>{3}</div><article><h1>{0}</h1>{4}</article><footer>&copy; {2}</footer></body></html>"
    r = np.random.default_rng(3)
    words = VOCABULARY[0]
    say = lambda n: " ".join(r.choice(words, n))
    rows, wanted = [], {}
    for k in range(60):
        title, body = say(5), [say(int(r.integers(3, 60))) + "." for _ in range(int(r.integers(1, 8)))]
        rows.append((k, f"http://a/{k}", layout.format(title, say(1), say(1), say(6) + ".", "".join(f"<p>{p}" for p in body))))
        wanted[k] = " ".join([title, *body])
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = M.op12_main_text(spark, str(tmp_path))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    found = got.collect()
    assert all(r.n_chars == len(r.text) for r in found) and np.mean([r.text == wanted[r.page_id] for r in found]) > 0.95


def test_empty_table(spark):
    none = spark.createDataFrame([], "page_id long, html string")
    assert M.fit(none, train_pages=20, epochs=1) and M.main_text(none, M.parameters(0)).collect() == []
