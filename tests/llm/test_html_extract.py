import itertools

import numpy as np

from tickframe.llm import html_extract as hx

ARTICLE = "<h1>Head &amp; line</h1><p><b>One<br>two</b>three, and more words here.<p>Next  para\n.</p>"
PAGE = ("<!DOCTYPE html><html><head><title>T &lt;</title><style>p{}</style>"
        "<script>var t=\"</p><article>x\";</script></head><body><nav><ul><li><a href='/a'>a</a>"
        "<li><a href=\"/b>c\">b</a></ul></nav><!-- <p>no</p> --><div class=\"ad\">Buy now.</div>"
        "{0}<footer>&copy; x &middot; All rights reserved.</footer></body></html>")
TEXT = "Head & line One twothree, and more words here. Next para ."


def _pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "clash", "clash") for i, u, h in rows],
                                 "page_id long, url string, html string, text string, "
                                 "labels string")


def _corpus():
    body = [f"<p>Sentence number {k}, with some words and more of them. And another one." * 1
            for k in range(6)]
    return [(k, f"http://a/{k}", PAGE.replace("{0}", "<article>" + ARTICLE + "".join(body[:k % 6])
                                              + "</article>")) for k in range(60)]


def test_blocks_and_broken_markup():
    blocks = hx.leaf_blocks(PAGE.replace("{0}", "<article>" + ARTICLE + "</article>"))
    assert [b.text for b in blocks] == [
        "T <", "a", "b", "Buy now.", "Head & line", "One twothree, and more words here.",
        "Next para .", "© x · All rights reserved."]
    assert hx.markup_labels(blocks) == [0, 0, 0, 0, 1, 1, 1, 0]
    for cut in range(0, len(PAGE), 7):
        hx.leaf_blocks(PAGE[:cut])
    assert [b.text for b in hx.leaf_blocks("a < b <1 &amp</p></div>x<p")] == ["a < b <1 &", "x"]


def test_pages(spark):
    rows = _corpus() + [(None, None, None), (900, "u", ""), (901, "u", "<p"), (902, "u", "   "),
                        (0, "http://a/0", _corpus()[0][2]),
                        (903, "u", "<article>" + "<p>word, and word.</p>" * 5000 + "</article>")]
    got = {}
    for r in hx.main_texts(_pages(spark, rows), rounds=15).collect():
        assert r.n_chars == len(r.text)
        got.setdefault(r.page_id, []).append(r.text)
    assert len(got[0]) == 2 and set(got[0]) == {TEXT}
    assert got[None] == [""] and got[900] == [""] and got[902] == [""]
    assert got[903] == [" ".join(["word, and word."] * 5000)]
    for k in range(60):
        want = " ".join([TEXT] + [f"Sentence number {j}, with some words and more of them. And "
                                  "another one." for j in range(k % 6)])
        assert set(got[k]) == {want}


def test_no_labelled_page_and_empty_table(spark):
    got = hx.main_texts(_pages(spark, [(1, "u", "<p>x</p>")])).collect()
    assert [(r.text, r.n_chars) for r in got] == [("", 0)]
    assert hx.main_texts(_pages(spark, [])).count() == 0


def test_bound_counts_labelled_pages_only(spark):
    plain = [(1000 + k, "u", f"<p>Just words {k}.</p>") for k in range(400)]
    docs = _pages(spark, _corpus()[:12] + plain)
    got = {r.page_id: r.text for r in hx.main_texts(docs, max_train=12, rounds=15).collect()}
    assert hx.count_labelled(docs) == 12
    assert all(got[k].startswith(TEXT) for k in range(12))
    picked = hx.bounded(spark.range(4000), hx.F.col("id"), 1000).count()
    assert 800 < picked < 1200


def _random_chain():
    draw = np.random.default_rng(5)
    return hx.Chain(draw.normal(size=(hx.FEATURES, 2)), draw.normal(size=(2, 2)),
                    draw.normal(size=(2, 2)))


def _score(model, active, labels):
    s = model._scores(active)
    return s[np.arange(len(labels)), labels].sum() + sum(
        model.step[a, b] for a, b in zip(labels, labels[1:], strict=False))


def test_viterbi_and_gradient_equal_enumeration():
    model, active = _random_chain(), [[1, 2], [3], [1, 5, 9], [7], [2, 3]]
    ways = list(itertools.product((0, 1), repeat=5))
    scores = np.array([_score(model, active, list(y)) for y in ways])
    assert tuple(model.viterbi(active)) == ways[int(scores.argmax())]
    # one page of five blocks, and one of a single block beside it
    short = [[4, 2]]
    p = np.exp(scores - np.logaddexp.reduce(scores))
    alone = np.array([_score(model, short, [0]), _score(model, short, [1])])
    q = np.exp(alone - np.logaddexp.reduce(alone))
    y = [0, 1, 1, 0, 1]
    emit, step, ends, like = model.gradient([short, active], [[1], y])
    assert np.isclose(like, np.log(p[ways.index(tuple(y))]) + np.log(q[1]))
    left = np.eye(2)[y] - sum(w * np.eye(2)[list(z)] for w, z in zip(p, ways, strict=True))
    left_short = np.eye(2)[1] - q
    want = np.zeros((hx.FEATURES, 2))
    for block, x in zip(active + short, [*left, left_short], strict=True):
        for f in block:
            want[f] += x
    assert np.allclose(emit, want)
    pairs = np.zeros((2, 2))
    for w, z in zip([1.0, *-p], [y, *ways], strict=True):
        for a, b in zip(z, z[1:], strict=False):
            pairs[a, b] += w
    assert np.allclose(step, pairs)
    assert np.allclose(ends, [left[0] + left_short, left[-1] + left_short])
