import pytest

from critica.llm import html_extract as H
from tests.llm.data import prose

SCHEMA = "page_id bigint, url string, html string, text string, n_chars string"


def page(i, shell="{nav}{ad}<article><h1>{title}</h1>{body}</article>{foot}", n=4):
    parts = {"nav": "<nav><ul>" + "".join(f'<li><a href="/{k}">{prose(k + 9, 1)}</a></li>' for k in range(6)) + "</ul></nav>",
             "ad": f'<!-- x --><div class="ad">{prose(400 + i, 12)}.</div>', "title": prose(i, 7),
             "body": "".join(f"<p>{prose(1000 * i + k, 30 + 5 * k)} &amp; <b>{prose(k, 2)}</b>.\n  end</p>" for k in range(n)),
             "foot": f"<footer>&copy; {prose(77, 4)}</footer>", "form": f"<form><label>{prose(5, 3)}</label><input></form>",
             "comments": f'<section class="comments"><p>{prose(600 + i, 20)}</p><p>{prose(700 + i, 15)}</p></section>',
             "side": f'<aside class="sidebar"><p>{prose(800 + i, 10)}</p></aside>',
             "cookie": f'<div id="cookie-notice"><p>{prose(42, 14)}</p></div>'}
    text = "\n".join([parts["title"], *[f"{prose(1000 * i + k, 30 + 5 * k)} & {prose(k, 2)}. end" for k in range(n)]])
    return (f'<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var t="</p>";</script></head><body>'
            f"{shell.format(**parts)}</body></html>"), text


SHELLS = ["{nav}{ad}<article><h1>{title}</h1>{body}</article>{foot}",
          "{cookie}<header>{nav}</header><main><article><h1>{title}</h1>{body}{comments}</article>{side}</main>{foot}",
          "{nav}<article><h1>{title}</h1>{ad}{body}{form}</article>{comments}{foot}",
          "<div id=main-menu class=menu>x y</div><main><h1>{title}</h1>{body}</main>{side}{form}{foot}"]


@pytest.fixture(scope="module")
def params():
    return H.train([page(i, SHELLS[i % 4])[0] for i in range(100)])


@pytest.mark.parametrize("shell", SHELLS)
def test_main_text_of_several_layouts(params, shell):
    for i in range(200, 240):
        html, want = page(i, shell)
        blocks = H.leaves(html)
        labels = H.label(params, [H.vectors(blocks)])[0]
        assert "\n".join(b[0] for b, keep in zip(blocks, labels) if keep) == want


def test_a_page_of_50000_blocks_is_labelled_in_bounded_memory(params):
    import tracemalloc

    pages = [H.vectors(H.leaves(page(i, SHELLS[i % 4])[0])) for i in range(63)]
    blocks = H.leaves("<article>" + "".join(f"<p>{prose(k, 6)}.</p>" for k in range(50_000)) + "</article><footer>x</footer>")
    long = H.vectors(blocks)
    assert len(long) == 50_001
    tracemalloc.start()
    labels = H.label(params, [*pages, long])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4 * long.nbytes and len(labels[-1]) == 50_001
    for x, y in zip(pages, labels):
        assert (H.label(params, [x])[0] == y).all()
    few = pages[5:8]
    want = H.states(params, *H.padded(few))[-1]
    assert all((want[:len(x), b] > 0).tolist() == y.tolist() for b, (x, y) in enumerate(zip(few, labels[5:8])))


def test_batches_are_bounded_by_padded_blocks():
    lengths = [3, 0, 50_000, 7, 900, 4, 20_000, 7]
    parts = list(H.batches_of(lengths, 1000))
    assert sorted(i for p in parts for i in p) == [0, 2, 3, 4, 5, 6, 7]
    assert all(len(p) == 1 or len(p) * max(lengths[i] for i in p) <= 1000 for p in parts)
    assert list(H.slices_of(["ab", None, "abc", "a" * 9, "b"], 5)) == [["ab", None, "abc"], ["a" * 9], ["b"]]


def test_blocks_of_malformed_markup():
    blocks = H.leaves("<article><p><b>one<br>two &lt;3<p>x &amp y<li>a<li>b</article>after<p title='a>b'>c</p><p>cut <a hre")
    assert [b[0] for b in blocks] == ["one two <3", "x & y", "a", "b", "after", "c", "cut"]
    assert [b[1][0] if b[1] else None for b in blocks] == ["article"] * 4 + [None, "p", "p"]
    assert H.leaves("") == [] and H.leaves("<script>x</script><!-- y") == [] and H.leaves("plain")[0][0] == "plain"


@pytest.mark.parametrize("html, want", [
    ("<p>before <svg/> after</p><p>more text</p>", ["before after", "more text"]),
    ("<p>a <svg><path d='x'>t</svg> b <svg><g> c</p><p>d</p>", ["a b", "d"]),
    ("<p>one</p>1 < 2 is true and this is the tail", ["one", "1 < 2 is true and this is the tail"]),
    ("<p>x <math><mi>a</mi><mo>+</mo></math> y <object data=q>alt</object> <noscript>ns</noscript> z</p>", ["x a+ y alt ns z"]),
    ("<p>a<object data=q/> b <math/> c</p><p>d</p>", ["a b c", "d"]),
    ("<p>u<script>var a='</p>'</script> v<style>p{}</style> w</p><template>t</template><p>z", ["u v w", "z"]),
    ("<p>a<template>never closed</p><p>b<iframe>c</p>", ["anever closed", "bc"]),
    ("x<script>never", ["x"]), ("a < b > c", ["a < b > c"]), ("<p>cut <a hre", ["cut"]), ("<title>t</title>z", ["z"]),
])
def test_no_text_is_lost(html, want):
    assert [b[0] for b in H.leaves(html)] == want


def test_captions_and_formulas_belong_to_the_article(params):
    for i in range(300, 310):
        html, want = page(i, SHELLS[0])
        more = f"<figure><img src=x><figcaption>{prose(i, 12)}.</figcaption></figure><p>{prose(i + 1, 9)} <math><mi>x</mi></math> end.</p>"
        blocks = H.leaves(html.replace("</article>", more + "</article>"))
        labels = H.label(params, [H.vectors(blocks)])[0]
        assert "\n".join(b[0] for b, keep in zip(blocks, labels) if keep) == f"{want}\n{prose(i, 12)}.\n{prose(i + 1, 9)} x end."


def test_many_unclosed_elements_take_linear_time():
    import time

    began = time.time()
    assert len(H.leaves("<p>a<template>b<iframe>c" * 60_000)) == 60_000
    assert time.time() - began < 20


def test_sample_of_repeated_long_and_few_pages(spark):
    rows = [(None, None, page(1)[0], "", "")] * 300 + [(1, "u", page(i)[0], "", "") for i in range(2, 8)]
    long = "<article>" + "".join(f"<p>{prose(k, 40)}.</p>" for k in range(2000)) + "</article>"
    rows += [(9, "long", long, "", ""), (10, "block", "<main>" + "y" * 500_000 + "</main>", "", ""), (11, "none", "<p></p>", "", "")]
    sample = H.training_sample(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert len(sample) == 9  # distinct pages with blocks, whatever their ids
    assert all(len(b) == len(y) > 0 and sum(len(t) for t, _, _ in b) <= H.TRAIN_CHARS for b, y in sample)
    assert len(H.training_sample(spark.createDataFrame(rows, SCHEMA), 4)) == 4
    assert H.training_sample(spark.createDataFrame([(1, "u", "", "", ""), (1, "u", None, "", "")], SCHEMA)) == []
    blocks, labels = H.run_of_blocks([(f"{k}" * 10, (), 0.0) for k in range(100)], list(range(100)), 50, 0.5)
    assert labels == [50, 51] and [b[0] for b in blocks] == ["50" * 10, "51" * 10]


def test_gradients_by_differences():
    import numpy as np

    rng = np.random.default_rng(0)
    xw = rng.standard_normal((5, 3, 4 * H.HIDDEN))
    wh = rng.standard_normal((H.HIDDEN, 4 * H.HIDDEN)) * 0.3
    mask = np.ones((5, 3, 1))
    mask[3:, 1] = 0
    target = rng.standard_normal((5, 3, H.HIDDEN))

    def loss(a, b):
        return sum((s[-1] * target[t]).sum() for t, s in enumerate(H.lstm_run(a, b, mask)))

    dxw, dwh = H.lstm_back(H.lstm_run(xw, wh, mask), target, wh, mask)
    for at in ((0, 0, 3), (2, 1, 20), (4, 2, 40)):
        d = np.zeros_like(xw)
        d[at] = 1e-3
        assert abs((loss(xw + d, wh) - loss(xw - d, wh)) / 2e-3 - dxw[at]) < 2e-2
    d = np.zeros_like(wh)
    d[3, 7] = 1e-3
    assert abs((loss(xw, wh + d) - loss(xw, wh - d)) / 2e-3 - dwh[3, 7]) < 2e-2


def test_table(spark):
    data = [(i, f"u{i}", page(i)[0], "x", "y") for i in range(40)]
    data += [data[0], (None, None, None, None, None), (50, "e", "", "", ""), (51, "t", "<p></p>", "", ""),
             (52, "long", page(52, n=150)[0], "", "")]
    got = H.extract_main_text(spark.createDataFrame(data, SCHEMA), train_pages=40).collect()
    want = [(i, f"u{i}", page(i)[1]) for i in range(40)] + [(0, "u0", page(0)[1]), (None, None, ""), (50, "e", ""), (51, "t", ""),
                                                            (52, "long", page(52, n=150)[1])]
    assert sorted(map(repr, map(tuple, got))) == sorted(repr((*w, len(w[2]))) for w in want)


def test_empty_table(spark):
    assert H.extract_main_text(spark.createDataFrame([], SCHEMA)).count() == 0
