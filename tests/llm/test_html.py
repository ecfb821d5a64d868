import itertools

import numpy as np
import pytest
from helpers import FOLDER

from ledgerlark.llm import html, layouts


@pytest.fixture(scope="module")
def field():
    return layouts.fitted_field()


def test_viterbi_is_the_best_of_all_labellings():
    draw = np.random.default_rng(1)
    for _ in range(30):
        f = html.Field({}, np.zeros(0), draw.normal(size=2), draw.normal(size=(2, 2)))
        scores = draw.normal(size=7).tolist()
        value = lambda y: f.start[y[0]] + sum(s for s, k in zip(scores, y) if k) + sum(f.step[a][b] for a, b in zip(y, y[1:]))  # noqa: B023, E731
        assert value(f.viterbi(scores)) == pytest.approx(max(map(value, itertools.product((0, 1), repeat=7))))


def test_likelihood_is_that_of_all_labellings():
    draw = np.random.default_rng(2)
    start, step, scores, lengths = draw.normal(size=2), draw.normal(size=(2, 2)), draw.normal(size=(2, 5)), np.array([5, 3])
    total, chance, steps = html.likelihood(scores, lengths, start, step)
    pairs = np.zeros((2, 2))
    for p, n in enumerate(lengths):
        all_ = list(itertools.product((0, 1), repeat=int(n)))
        w = np.exp([start[y[0]] + sum(scores[p, k] for k in range(n) if y[k]) + sum(step[a, b] for a, b in zip(y, y[1:])) for y in all_])
        assert total[p] == pytest.approx(np.log(w.sum()))
        assert chance[p, :n] == pytest.approx([sum(x for x, y in zip(w, all_) if y[k]) / w.sum() for k in range(n)])
        for x, y in zip(w, all_):
            for a, b in zip(y, y[1:]):
                pairs[a, b] += x / w.sum()
    assert steps == pytest.approx(pairs)


def test_held_out_layouts(field):
    right = total = 0
    for seed in range(500_000, 500_150):
        blocks, labels, _ = layouts.labelled_page(seed)
        if len(blocks) == len(labels):
            right += sum(a == b for a, b in zip(field.viterbi(field.scores(html.features(blocks))), labels))
            total += len(labels)
    assert total > 2000 and right / total > 0.97


def test_pages_give_their_articles(spark, field):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    for r, p in zip(sorted(html.main_texts(pages, field).collect()), sorted(pages.collect())):
        blocks = [b.text for b in html.leaf_blocks(p.html) if any(d.startswith("article") for d in b.path)]
        assert r.text == "\n".join(blocks) and r.n_chars == len(r.text) and r.url == p.url


def test_malformed_and_odd_pages(spark, field):
    assert [b.text for b in html.leaf_blocks("a < b &amp; c &eacute;<p>x<br>y  <p>z<!-- <p>no --><script>var p='</p>'</script>w<style>q")] == ["a < b & c é", "x y", "z w"]
    assert [b.text for b in html.leaf_blocks("<p>z<!-- no -->w")] == ["zw"]  # a comment joins, a script parts
    texts = [b.text for b in html.leaf_blocks("<p title='a > b'>x<br>y  <p>z &copy;<!-- no --> w<style>q")]
    assert texts == ["x y", "z © w"]
    assert [b.text for b in html.leaf_blocks('<p class="a>x</p><p>y')] and html.leaf_blocks("") == [] and html.leaf_blocks("<<<>>") is not None
    article = "<html><body><nav><a href=/>Home</a></nav><article><h1>T &lt;b&gt;</h1><p>" + "Long text here, again and again. " * 20_000 + "</p></article><div id=comments><p>I say so too.</p></div></body></html>"
    rows = [(1, None, None, 1), (2, "", "", 1), (3, "u", article, 1), (3, "u", article, 1), (None, None, "<div>", None)]
    out = html.main_texts(spark.createDataFrame(rows, "page_id bigint, url string, html string, text int"), field).collect()
    by = {r.page_id: r for r in out}
    assert len(out) == 5 and by[1].text == by[2].text == by[None].text == ""
    assert by[3].text == "T <b>\n" + ("Long text here, again and again. " * 20_000).strip()
    assert html.main_texts(spark.createDataFrame([], "page_id bigint, url string, html string"), field).count() == 0
