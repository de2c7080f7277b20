import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerflow.llm import html_lstm as H

PAGES = "page_id long, url string, html string"


@pytest.fixture(scope="module")
def model(spark):
    return H.fit(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))


def test_blocks():
    page = """<!DOCTYPE html><html><head><title>no</title><style>p{a:b}</style><script>var t="</p>";</script></head><body>
    <nav class="main-menu"><a href='x>y'>Home&nbsp;page</a></nav><p>one <b>two</b>
     three<br>four<p>five &lt;b&gt; &#228;&eacute;<!-- <p>hidden --><div id=sideBar>six<ul><li>a<li>b</ul></div>tail <h2>x</h3>y"""
    got = [(b.text, b.path[-1]) for b in H.blocks_of(page)]
    assert got == [("Home page", ("<nav", "main", "menu")), ("one two three four", ("<p",)), ("five <b> äé", ("<p",)), ("six", ("<div", "side", "bar")),
                   ("a", ("<li",)), ("b", ("<li",)), ("tail", ("<body",)), ("x", ("<h2",)), ("y", ("<body",))]
    assert H.blocks_of(page)[0].path[2] == ("<nav", "main", "menu") and H.blocks_of(page)[0].link == len("Home page")
    for broken in ("", "<", "<<<>>", "<p", "<a href=\"", "</p></div>", "<!--", "<script>x", "&", "plain", "<p class='a", "\x00<b>"):
        H.blocks_of(broken)


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    m = H.Labeller(3)
    xs = [rng.standard_normal((n, H.DIMS)).astype(np.float32) for n in (3, 5)]
    ys = [rng.integers(0, 2, len(x)).astype(np.float32) for x in xs]
    loss = lambda: -np.mean(np.concatenate([np.where(y > 0, np.log(p), np.log(1 - p)) for y, p in zip(ys, m.probabilities(xs))]).astype(float))
    before = {k: v.copy() for k, v in m.p.items()}
    m.fit(xs, ys, epochs=1)
    step = {k: m.p[k] - before[k] for k in before}
    m.p = {k: v.astype(np.float64) for k, v in before.items()}
    for k in before:  # one Adam step moves each weight against its gradient
        flat = np.abs(step[k]).reshape(-1).argsort()[-3:]
        for i in flat:
            w = m.p[k].reshape(-1)
            keep = w[i]
            w[i] = keep + 1e-4
            up = loss()
            w[i] = keep - 1e-4
            down = loss()
            w[i] = keep
            assert abs(up - down) < 1e-9 or np.sign(up - down) == -np.sign(step[k].reshape(-1)[i])


def test_held_out_templates(model):
    rng = np.random.default_rng(1234)
    words = ["".join(random.Random(i).choices("aeioulnrst", k=3 + i % 7)) for i in range(300)]
    features, right, total = H.Features(), 0, 0
    for _ in range(200):
        page, label = H.template_page(rng, words)
        blocks = H.blocks_of(page)
        for b, p in zip(blocks, model.probabilities([features.sequence(blocks)])[0]):
            if b.text in label:
                total += 1
                right += (p >= 0.5) == label[b.text]
    assert right / total > 0.96


def test_given_pages_are_extracted_whole(spark, model):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {}
    for r in pages.collect():
        blocks = H.blocks_of(r.html)
        want[r.page_id] = "\n".join(b.text for b, y in zip(blocks, H.semantic_labels(blocks)) if y == 1)
    got = H.extract_pages(pages.withColumn("text", F.lit("own")), model).collect()
    assert len(got) == len(want) and all(r.n_chars == len(r.text) for r in got)
    assert sum(r.text == want[r.page_id] for r in got) >= 0.99 * len(want)


def test_unusual_pages(spark, model):
    hand = """<html><body><header><div class="logo">My site</div></header><div class="cookie-banner"><p>We use cookies here.</p><button>OK</button></div>
    <ul class="menu"><li><a href=/>Home</a></li><li><a href=/b>About</a></li></ul>
    <main><h1>A title</h1><p>The first paragraph, which is long enough to be read &amp; kept.</p><p>And a second one, with a <a href=x>link</a> inside.</p></main>
    <aside class="sidebar"><h3>Related</h3><p>Other things to read</p></aside><form class=search><label>Find</label><button>Go</button></form>
    <section id="comments"><div class="comment"><p>Great read, thank you so much!</p></div></section><footer><p>&copy; My site</p></footer></body></html>"""
    rows = [(1, "u", hand), (2, None, None), (3, "u", ""), (4, "u", "<p"), (5, "u", "<article>" + "<p>again</p>" * 3000 + "</article>"), (1, "u", hand)]
    got = H.extract_pages(spark.createDataFrame(rows, PAGES), model).collect()
    assert len(got) == 6
    by = {r.page_id: r.text for r in got}
    assert by[1] == "A title\nThe first paragraph, which is long enough to be read & kept.\nAnd a second one, with a link inside."
    assert by[2] == by[3] == by[4] == "" and by[5].count("again") > 2900
    assert H.extract_pages(spark.createDataFrame([], PAGES), model).count() == 0


def test_learning_without_pages(spark):
    assert H.fit(spark.createDataFrame([], PAGES), 5).p["o"].shape == (2 * H.HIDDEN, 1)


def test_sample_holds_a_repeated_page_once(spark, monkeypatch):
    from ledgerflow.llm import html_lstm

    seen = []
    monkeypatch.setattr(html_lstm, "train", lambda pages: seen.extend(pages))
    html = [f"<p>page {i}</p>" for i in range(10)]
    rows = [(i, h) for i, h in enumerate(html + html[:1] * 200)]
    html_lstm.fit(spark.createDataFrame(rows, "page_id long, html string"), sample=210)
    assert seen == sorted(html)


def texts_of(page):
    return [b.text for b in H.blocks_of(page)]


def test_unread_elements_end_where_they_should():
    assert texts_of("<main><p>one</p><select><p>two</p></main><p>three") == ["one", "three"]
    assert texts_of("<p>E = <math><mi>m</mi><mo>c</mo></math> holds</p>") == ["E = mc holds"]
    assert texts_of("<div>a<video src=x><p>b</p></div><p>c</p>") == ["a", "c"]
    assert texts_of("<p>a<object><p>b<p>c") == ["a", "b", "c"]  # never ended: taken for empty
    assert texts_of("<p>x<svg><path/><title>t</title></svg>y</p>") == ["x y"]
    assert texts_of("<p>x<video><video>i</video>j</video>y</p><p>z") == ["x y", "z"]
    assert texts_of("<p>x<canvas><script>'</p></canvas>'</script>n</canvas>y") == ["x y"]
    assert texts_of("<p>a</p><script>if (a < b) '</p>'</script><p>b") == ["a", "b"]
    assert texts_of("<head><title>t</title><p>q") == ["q"]


def test_blocks_equal_a_plain_walk_of_the_layout():
    """Pages laid out at random, read by a walk over the layout itself."""
    rnd = random.Random(12)
    word = lambda: "".join(rnd.choice("abcdeä") for _ in range(rnd.randint(1, 6)))

    def element(depth):
        """Markup, and its texts: None where a block begins or ends."""
        kind = rnd.random()
        if depth > 4 or kind < 0.35:
            ws = [word() for _ in range(rnd.randint(1, 4))]
            return rnd.choice([" ", "\n", " \t "]).join(ws) + " ", ws
        if kind < 0.5:
            name = rnd.choice(["script", "style", "svg", "object", "select", "template"])
            return f"<{name}>{word()}</{name}> ", [None] if name == "select" else []
        inner = [element(depth + 1) for _ in range(rnd.randint(0, 3))]
        html = "".join(h for h, _ in inner)
        seen = [w for _, ws in inner for w in ws]
        if kind < 0.65:
            name = rnd.choice(["b", "span", "em", "a href=x", "math"])
            return f"<{name}>{html}</{name.split()[0]}>", seen
        name = rnd.choice(["div", "section", "article", "blockquote", "ul"])
        return f"<{name}>{html}</{name}>", [None, *seen, None]

    for _ in range(400):
        parts = [element(0) for _ in range(rnd.randint(1, 6))]
        want, held = [], []
        for w in [*(w for _, ws in parts for w in ws), None]:
            if w is not None:
                held.append(w)
            elif held:
                want.append(" ".join(held))
                held = []
        assert texts_of("".join(h for h, _ in parts)) == want
