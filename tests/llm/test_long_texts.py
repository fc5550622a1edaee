"""Texts that are counted with arrays have the counts of plain loops."""

from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import quality_model, quality_rules, toxicity
from tessera.llm.word_windows import LONG, n_repeated, window_ids, word_ids

TEXTS = st.lists(st.sampled_from(["a", "b", "cé", "\x0b", "\n", "  ", " ", "#", "🙂", ""]), max_size=60).map(" ".join)


@settings(deadline=None, max_examples=200)
@given(TEXTS, st.integers(1, 7))
def test_windows_are_equal_where_their_words_are(text, width):
    words = text.encode().split()
    ids = window_ids(word_ids(text.encode()), width)
    plain = [tuple(words[i : i + width]) for i in range(len(words) - width + 1)]
    assert len(ids) == len(plain) and len(set(zip(ids.tolist(), plain))) == len(set(plain)) == len(set(ids.tolist()))
    times = Counter(plain)
    assert n_repeated(ids, width) == len({i + k for i, w in enumerate(plain) if times[w] > 1 for k in range(width)})


@settings(deadline=None, max_examples=200)
@given(TEXTS, st.integers(3, 40))
def test_both_ways_count_alike(text, block):
    raw = text.encode()
    counts, shape = quality_rules.base_counts(text), quality_model.statistics(text)
    table = np.sin(np.arange(quality_rules.BUCKETS, dtype=float))
    both = np.array([quality_rules.gram_counts(raw) + 1, quality_rules.gram_counts(raw) + 2], float)
    ratio, own = quality_rules.ratio(table, raw), quality_rules.ratio_without_own(both, raw)
    assert quality_rules.gram_counts(raw).tolist() == np.bincount(quality_rules.grams(raw), minlength=quality_rules.BUCKETS).tolist()
    before = quality_rules.LONG
    quality_rules.LONG = quality_model.LONG = block
    try:
        assert quality_rules.base_counts(text) == counts
        assert quality_model.statistics(text) == shape
        assert abs(quality_rules.ratio(table, raw) - ratio) < 1e-12
        assert abs(quality_rules.ratio_without_own(both, raw) - own) < 1e-12
    finally:
        quality_rules.LONG = quality_model.LONG = before


def test_texts_of_50_megabytes_with_and_without_spaces():
    part = "one two three four five six\n"
    spaced, dense = part * (50_000_000 // len(part)), "x" * 50_000_000
    assert len(spaced) > LONG
    n = 6 * (50_000_000 // len(part))
    assert quality_rules.base_counts(spaced)[::4] == (n, n) and quality_rules.base_counts(dense) == (1, 50_000_000, 0, 0, 0)
    assert np.isfinite(quality_model.statistics(spaced)).all() and quality_model.statistics(dense)[11:14] == [1.0, 1.0, 0.0]


def test_long_words_are_not_kept():
    model = toxicity.Model(b"the vornik of", b"the and of", b"the and of", np.zeros(toxicity.GAINS), np.zeros(1), np.zeros(1))
    gains = toxicity.Gains(model)
    text = "x" * 2_000_000 + " vornik and " + "y" * 65
    assert gains.histogram(text).sum() == 4 and set(gains.cache) == {b"vornik", b"and"}
    assert gains.histogram(text).tolist() == toxicity.Gains(model).histogram(text).tolist()
