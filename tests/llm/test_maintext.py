import tracemalloc

import numpy as np
import pytest

from tallyworks.llm import blocklstm, maintext
from tallyworks.llm.blocklstm import INPUTS, BlockLabeller, Features
from tallyworks.llm.htmlblocks import blocks_of

PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var x="<p>no</p>";</script></head><body>
<div class="cookie-notice"><p>We use cookies to improve this site.</p></div>
<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News &amp; more</a></li></ul></nav><!-- ad <p>no</p> -->
<article><h1>A long headline over the story of the day</h1><p>First paragraph with <b>bold</b>&nbsp;words,<br>a break
and a <a href="/x">link</a> &lt;inside&gt; of it.<p>Second paragraph that nobody closed, which goes on for a while.
<div class="ad">Buy this thing now, today only.</div><p>Third paragraph comes after the advert &amp; ends the story.</p></article>
<aside class="sidebar"><h3>Related articles</h3><ul><li><a href="/c">Another story</a></li></ul></aside>
<form><p>Subscribe to our newsletter</p><textarea>no</textarea></form>
<section class="comments"><h2>Comments</h2><div class="comment"><p>I think this is a very good story, thank you for it.</p></div></section>
<footer>&copy; 2021 Example. All rights reserved.</footer></body></html>"""
TEXT = [
    "A long headline over the story of the day",
    "First paragraph with bold words, a break and a link <inside> of it.",
    "Second paragraph that nobody closed, which goes on for a while.",
    "Third paragraph comes after the advert & ends the story.",
]


def pages(spark, htmls):
    rows = [(i, f"http://x/{i}", h) for i, h in enumerate(htmls)]
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS text", "'x' AS n_chars")


@pytest.fixture(scope="module")
def model(spark):
    return maintext.train_labeller(pages(spark, []).limit(0), made=700)


def test_blocks():
    texts = [b.text for b in blocks_of(PAGE)]
    assert texts[:4] == ["We use cookies to improve this site.", "Home", "News & more", TEXT[0]]
    assert [t for t in texts if t in TEXT] == TEXT and not any("no" == t for t in texts)
    assert [b.text for b in blocks_of("x &amp; y &am")] == ["x & y &am"]
    assert [b.text for b in blocks_of('<p title="a>b">one</p><p title=it\'s>two</p>1 < 2<p cut')] == ["one", "two", "1 < 2"]
    assert [b.text for b in blocks_of("<table><tr><td>a<td>b<tr><td>c</table><script>if (a<b) x")] == ["a", "b", "c"]
    assert blocks_of("") == [] and blocks_of("<!-- never ends") == []


def test_page_with_all_parts(spark, model):
    rows = maintext.extract_main_text(pages(spark, [PAGE, None, "", "<p", "<nav><a>x</a></nav>"]), model).orderBy("page_id").collect()
    assert rows[0].text == "\n\n".join(TEXT)
    assert [(r.text, r.n_chars) for r in rows[1:]] == [("", 0)] * 4
    assert rows[0].n_chars == len(rows[0].text) and rows[0].url == "http://x/0"


def test_held_out_made_pages(model):
    rng = np.random.default_rng(99)
    made = [maintext.made_page(rng, ["some other words that make up a text of its own", "more of it, and so on."]) for _ in range(150)]
    labels = model.label([Features().of(p) for p in made])
    right = [bool(k) == bool(b.label) for p, keep in zip(made, labels) for b, k in zip(p, keep)]
    assert np.mean(right) > 0.97


def test_gradients():
    rng = np.random.default_rng(0)
    model = BlockLabeller.new(rng)
    x, mask = rng.normal(size=(4, 3, INPUTS)).astype(np.float32), np.ones((4, 3), np.float32)
    mask[2:, 1] = 0
    labels = (rng.random((4, 3)) > 0.5).astype(np.float32)
    _, grads = model.gradients(x, mask, labels)
    for name, grad in grads.items():
        direction = rng.normal(size=grad.shape).astype(np.float32)
        before = model.weights[name]
        losses = []
        for sign in (1, -1):
            model.weights[name] = before + sign * 1e-2 * direction
            losses.append(model.gradients(x, mask, labels)[0])
        model.weights[name] = before
        assert abs((losses[0] - losses[1]) / 2e-2 - float((grad * direction).sum())) < 0.02 * (1 + abs(float((grad * direction).sum())))


def test_training_reads_one_page_of_bounded_length_for_each_id(spark):
    html = [f"<article><p>Text number {i} of some length, that goes on for a while, and then ends.</p></article><nav>menu</nav>" for i in range(6)]
    own = pages(spark, html)
    long = pages(spark, ["<article>" + "<p>word</p>" * 400 + "</article>"])
    one, two, three = (
        maintext.train_labeller(p, made=40, most_chars=2000).weights for p in (own, own.unionByName(own), long.unionByName(own))
    )
    assert all(np.array_equal(one[name], w) for weights in (two, three) for name, w in weights.items())


def test_repeated_rows_stay(spark, model):
    own = pages(spark, [PAGE, PAGE])
    rows = maintext.extract_main_text(own.unionByName(own), model).collect()
    assert len(rows) == 4 and len({r.text for r in rows}) == 1


def test_long_pages_and_empty_table(spark, model):
    long = "<body><article>" + "".join(f"<p>Paragraph number {i} of a very long page.</p>" for i in range(3000)) + "</article>"
    row = maintext.extract_main_text(pages(spark, [long]), model).collect()[0]
    assert row.text.count("\n\n") == 2999
    assert maintext.extract_main_text(pages(spark, []), model).collect() == []


def test_parts_of_a_page_are_labelled_as_the_whole(model):
    rng = np.random.default_rng(5)
    made = [b for _ in range(12) for b in maintext.made_page(rng, ["some words of a text that goes on.", "and more of it."])]
    whole = model.logits(*(a for a in blocklstm.padded([Features().of(made)])))[:, 0]
    sure = np.abs(whole) > 1e-4
    assert sure.mean() > 0.99
    for at_once in (1, 7, len(made) - 1, len(made), 10_000):
        parts = model.label_long(made, Features(), at_once)
        assert np.array_equal(parts[sure], (whole > 0)[sure])
    pages = [made[:3], [], made, made[5:60]]
    for cells in (1, 50, 100_000):
        for got, page in zip(model.label_blocks(pages, Features(), cells, 16), pages):
            expected = model.label([Features().of(page)])[0]
            assert len(got) == len(page) and np.mean(got == expected) > 0.99 if page else len(got) == 0


def test_memory_of_a_long_page_is_bounded(model):
    blocks = blocks_of("<body><article>" + "<p>One more short paragraph.</p>" * 45_000 + "</article>")
    assert len(blocks) == 45_000 > blocklstm.CELLS_AT_ONCE
    tracemalloc.start()
    kept = model.label_blocks([blocks], Features())[0]
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert kept.mean() > 0.99
    assert peak < 16e6  # the vectors of the page alone would be 36e6


def test_training_leaves_out_pages_of_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(maintext, "TRAINING_BLOCKS", 20)
    own = pages(spark, [f"<article><p>Text number {i} of some length, that goes on for a while.</p></article>" for i in range(4)])
    many = pages(spark, ["<article>" + "<p>word</p>" * 21 + "</article>"]).selectExpr("page_id + 9 AS page_id", "url", "html", "text", "n_chars")
    one, two = (maintext.train_labeller(p, made=40).weights for p in (own, own.unionByName(many)))
    assert all(np.array_equal(one[name], w) for name, w in two.items())
