from __future__ import annotations

import html
import re

from conftest import SF_DIR, rows

from tarmac.llm import html as main


def article(page):
    inner = page[page.find("<article>") + 9 :].split("</article>")[0]
    parts = (" ".join(html.unescape(re.sub("<[^>]*>?", " ", b)).split()) for b in re.split("</?(?:p|h1)>", inner))
    return "\n".join(p for p in parts if p)


def test_given_pages(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    want = sorted((r["page_id"], r["url"], article(r["html"])) for r in pages.collect())
    got = main.extract(pages)
    assert sorted(rows(got, "page_id", "url", "text")) == want
    assert all(n == len(t) for n, t in rows(got, "n_chars", "text"))


LONG = "Words that make a sentence of usual length, with a comma and an end. " * 3


def test_other_layouts():
    weights = main.weights(main.hand_counts())
    page = f"""<html><head><title>no</title><script>if (a < b) document.write("<p>no</p>")</script></head><body>
      <div id="cookie-notice">no <button>no</button></div><div class="site-header"><a href=/>no</a></div><ul class=menu><li>no</ul>
      <div class="sidebar"><h3>no</h3><p>no {LONG}</p></div><!-- <p>no</p> -->
      <div class="post-content"><h2>The
      title</h2><p>{LONG}</p><div class="ad-slot">no, buy</div><p>Caf&eacute; &lt;b&gt; a<b>b</b>c &amp;amp;</p><p>{LONG}</p>
      <form action=x><p>no</p><input></form><ul><li>A first</li><li>A second</li></ul><p>The last words of all.</p></div>
      <section id="comments"><p>no {LONG}</p></section><footer>&copy; no</footer></body>"""
    text = main.main_text(page, weights)
    sentence = " ".join(LONG.split())
    assert text.split("\n") == ["The title", sentence, "Café <b> abc &amp;", sentence, "A first", "A second", "The last words of all."]


def test_best_run_by_trying_all():
    weights = main.weights(main.hand_counts())
    for page in main.PAGES[::9]:
        own = main.blocks(page)[:-1]
        worth = [b.words * weights.word(b) for b in own]
        cost = [sum(weights.tags.get(t, -0.3) for t in b.tags) for b in own]
        value = lambda a, b: sum(worth[a:b]) + sum(cost[a + 1 : b])
        best = max(((a, b) for a in range(len(own)) for b in range(a + 1, len(own) + 1)), key=lambda r: value(*r))
        kept = [b.text for b in own[best[0] : best[1]] if not weights.boilerplate(b)]
        assert main.main_text(page, weights) == "\n".join(kept)


def read(page):
    return main.main_text(page, main.weights(main.hand_counts()))


def test_elements_left_open_hide_nothing():
    sentence = " ".join(LONG.split())
    article = f"<article><p>{LONG}</p><p>{LONG}</p></article>"
    for before in ("<select>", "<object data=x>", "<select><option>", "<canvas>", "<svg><g>", "<noscript>", "<p title=Don't>", "<i b='c' title=isn't href=x>", "<!-->", "<!--->"):
        assert read(f"<body>{before}{article}<p title='it'>") == f"{sentence}\n{sentence}", before
    # One left open does not reach to the end of a later one; what is closed stays out.
    page = f"<body><select>{article}<svg><text>no</text></svg><select><option>no</select><object><p>no {LONG}</p></object>"
    assert read(page) == f"{sentence}\n{sentence}"
    assert read(f"<body>{article}<script>if (a < b) '<p>{LONG}</p>'") == f"{sentence}\n{sentence}"


def test_deep_pages_take_linear_time():
    import time

    sentence = " ".join(LONG.split())
    for name, n in (("p", 50_000), ("div", 50_000), ("b", 50_000), ("i><div", 25_000)):
        start = time.time()
        assert read(f"<{name}>" * n + f"<article><p>{LONG}</p></article>" + f"</{name.split('>')[0]}>" * n) == sentence
        assert time.time() - start < 5


def test_inline_end_tags_leave_blocks_open():
    got = main.blocks("<b class=x><div>one</b>two</div>three")
    assert [(b.text, ".x" in b.features) for b in got[:-1]] == [("onetwo", True), ("three", False)]
