import re

import numpy as np
import pytest

from tessera.llm import html_blocks as hb

WORDS = [f"wort{i}" for i in range(300)] + ["the", "casa", "rouge", "und,", "end."]


@pytest.fixture(scope="module")
def weights():
    rng = np.random.default_rng(5)
    return hb.train([(hb.vectors(f), y) for f, y in (hb.drawn_page(rng, WORDS) for _ in range(300))])


def test_blocks_of_odd_markup():
    page = """<html><head><title>no</title><style>p{}</style></head><body><p>one <b>two</b>
      three<p>four<br>five&nbsp;&amp; six<script>var t="</p>";</script><ul><li>a<li>b</ul><div>open"""
    assert [b.text for b in hb.blocks(page)] == ["one two three", "four five & six", "a", "b", "open"]
    assert hb.blocks(None) == hb.blocks("") == hb.blocks("<!-- only -->") == []


def test_gradients_match_differences():
    rng = np.random.default_rng(2)
    w = hb.new_weights()
    d = hb.PATH_DIM + hb.WORD_DIM + hb.SHARES
    x, lengths = hb._padded([rng.standard_normal((n, d)) for n in (3, 1, 5)])
    y = rng.integers(0, 2, x.shape[:2]).astype(float)
    _, g = hb.gradients(w, x, lengths, y)
    for name in w:
        for _ in range(4):
            at = tuple(rng.integers(0, n) for n in w[name].shape)
            kept = w[name][at]
            both = []
            for step in (1e-5, -1e-5):
                w[name][at] = kept + step
                both.append(hb.gradients(w, x, lengths, y)[0])
            w[name][at] = kept
            assert abs((both[0] - both[1]) / 2e-5 - g[name][at]) < 1e-5


def test_held_out_pages(weights):
    rng = np.random.default_rng(77)
    pages = [hb.drawn_page(rng, WORDS) for _ in range(150)]
    right = sum((on == (y > 0)).sum() for (_, y), on in zip(pages, hb.label(weights, [f for f, _ in pages])))
    assert right / sum(len(y) for _, y in pages) > 0.95


def test_extract(spark, weights):
    page = '<body><nav><ul><li><a href="#">home</a></li></ul></nav><div class="ad">buy</div><article><h1>Title  here</h1><p><b>First &lt;one&gt;.<br><p>Second\n two.</p></article><footer>&copy; x</footer>'
    df = spark.createDataFrame([(1, page, "t"), (2, None, None), (3, "", ""), (4, "<p>", "")], "page_id long, html string, text string")
    got = {r.page_id: (r.text, r.n_chars) for r in hb.extract(df, weights).collect()}
    assert got == {1: ("Title here\nFirst <one>.\nSecond two.", 35), 2: ("", 0), 3: ("", 0), 4: ("", 0)}


def test_fit_on_empty_table(spark):
    assert hb.fit(spark.createDataFrame([], "page_id long, html string"))["out"].shape[1] == 1


def test_words_are_read_to_the_end_of_a_block():
    start = "same words " * 60
    a, b = (hb.vectors([hb.Block((("p",), None), start + end, 0)]) for end in ("alpha beta gamma", "delta omega kappa"))
    words = slice(hb.PATH_DIM, hb.PATH_DIM + hb.WORD_DIM)
    assert not np.array_equal(a[0, words], b[0, words])
    more = hb.vectors([hb.Block((("p",), None), start * 2, 0)])
    assert more[0, hb.PATH_DIM + hb.WORD_DIM + 2] == np.float32(np.log1p(240) / 5)


def test_training_reads_pages_to_their_end():
    x = hb.vectors([hb.Block((("p",), None), f"words {i}", 0) for i in range(60)])
    y = np.ones(60)
    tail = y.copy()
    tail[50:] = 0
    a, b = (hb.train([(x, labels)], steps=2) for labels in (y, tail))
    assert any(not np.array_equal(a[k], b[k]) for k in a)


def test_text_of_formulas_and_drawings_is_kept():
    page = """<p>so <math><semantics><mrow><mi>E</mi><mo>=</mo><mi>m</mi></mrow><annotation>tex</annotation></semantics></math> holds</p>
      <svg><title>no</title><text>label</text></svg><object><p>instead</p></object><canvas>chart</canvas><noscript>no</noscript>"""
    assert [b.text for b in hb.blocks(page)] == ["so E=m holds", "label", "instead", "chart"]


def test_deep_pages_take_linear_time():
    import time

    took = []
    for n in (2_000, 16_000):
        start = time.perf_counter()
        found = hb.blocks("".join(f"<div class=c{i % 7}>w{i} <b>x" for i in range(n)) + "</div>" * n)
        took.append(time.perf_counter() - start)
        assert len(found) == n and found[-1].text == f"w{n - 1} x"
    assert took[1] < 30 * took[0] + 1


def plain_labels(w, x):
    """The labeller block by block, without padding or batches."""
    n = hb.HIDDEN

    def one(side, rows):
        h, c, out = np.zeros(n), np.zeros(n), []
        for row in rows:
            z = row @ w[f"x{side}"] + w[f"c{side}"] + h @ w[f"h{side}"]
            i, f, o = (1 / (1 + np.exp(-z[k * n : (k + 1) * n])) for k in range(3))
            c = f * c + i * np.tanh(z[3 * n :])
            h = o * np.tanh(c)
            out.append(h)
        return out

    ahead, behind = one("f", x), one("b", x[::-1])[::-1]
    return [float(np.concatenate([a, b, row]) @ w["out"][:, 0] + w["bias"][0]) >= 0 for a, b, row in zip(ahead, behind, x)]


def test_labels_match_a_plain_pass(spark, weights):
    rng = np.random.default_rng(91)
    pages = [hb.drawn_page(rng, WORDS)[0] for _ in range(20)] + [[]]
    got = hb.label(weights, pages)
    for found, on in zip(pages, got):
        assert on.tolist() == plain_labels(weights, hb.vectors(found).astype(float))


def test_repeated_and_long_pages(spark, weights):
    long = "<article>" + "".join(f"<p>{'wort1 casa ' * 40}{i}.</p>" for i in range(3_000)) + "</article>"
    df = spark.createDataFrame([(1, long), (1, long), (2, "<p>a")], "page_id long, html string")
    rows = hb.extract(df, weights).collect()
    assert len(rows) == 3 and rows[0].text == rows[1].text and rows[0].text.count("\n") > 2_950
    assert rows[0].n_chars == len(rows[0].text)


def test_tags_that_may_be_left_out(spark):
    said = ["Main text here.", "More."]
    for page in (
        "<html><head><title>t</title><p>Main text here.</p><p>More.</p></html>",
        "<head><title>t</title><meta charset=x><link rel=y>Main text here.<p>More.",
        "<html><head><script>var a</script><b>Main text here.</b><p>More.</html>",
        "<html><head><noscript><p>hidden</p></noscript><style>p{}</style><body>Main text here.<p>More.",
        "<title>t</title><p>Main text here.<p>More.",
        "<html><head></head><p>Main text here.</p>More.</html>",
    ):
        assert [b.text for b in hb.blocks(page)] == said, page


def plain_blocks(html):
    """Texts of blocks by cutting at tags, for pages whose elements all have their end tags."""
    import html as entities

    shown = re.sub(r"(?is)<(script|style|head|noscript|template|iframe|title)\b.*?</\1\s*>|<!--.*?-->|<![^>]*>", "", html)
    inline = "|".join(sorted(hb._INLINE - {"br", "img"}, key=len, reverse=True))
    shown = re.sub(rf"(?i)</?(?:{inline})(?=[\s>/])[^>]*>", "", re.sub(r"(?i)<(br|img)\b[^>]*>", " ", shown))
    parts = re.split(r"<[^>]*>", shown)
    return [t for t in (" ".join(entities.unescape(p).split()) for p in parts) if t]


def test_blocks_as_a_second_reader_sees_them():
    import duckdb

    pages = [r[0] for r in duckdb.connect().execute("SELECT html FROM '/root/testdata/sf0.01/pages.parquet'").fetchall()]
    same = sum([b.text for b in hb.blocks(p)] == plain_blocks(p) for p in pages if p)
    assert same == sum(1 for p in pages if p)


def test_all_of_a_deep_path_counts_and_long_pages_are_read_alone():
    deep = "<div class=first>" + "<div>" * 3000
    found = hb.blocks("<section class=outer>" + deep + "<p>text here</p>" + "</div>" * 3001 + "<p>after</p></section>")
    plain = [hb.vectors([hb.Block(b.above, b.text, b.linked)]) for b in found]
    assert all(np.array_equal(hb.vectors([b]), p) for b, p in zip(found, plain)) and len(found) == 2
    assert ".first" in found[0].path and ".first" not in found[1].path
    w = hb.new_weights()
    pages = [hb.blocks("<p>a b</p>" * n) for n in (1, 3, 9000, 2, 5000, 5000, 7, 0)]
    got = hb.label(w, pages)
    assert [len(g) for g in got] == [len(p) for p in pages]
    assert all(np.array_equal(g, hb.label(w, [p])[0]) for g, p in zip(got, pages))
