import random
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tessera.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def plain_best_fit(lengths, capacity):
    """How many sequences best-fit decreasing opens, piece by piece."""
    rooms = []
    for length in sorted(lengths, reverse=True):
        fit = min((r for r in rooms if r >= length), default=None)
        if fit is None:
            fit = capacity
        else:
            rooms.remove(fit)
        rooms.append(fit - length)
    return len(rooms)


def check_places(rows, capacity):
    held = defaultdict(list)
    for sequence, offset, length in rows:
        held[sequence].append((offset, length))
    for own in held.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(1, 40), st.integers(1, 5)), max_size=40))
def test_a_sweep_takes_the_smallest_gap_that_fits(rows):
    rows = sorted(((kind, size, n, 10 * i) for i, (kind, size, n) in enumerate(rows)), key=lambda r: (-r[1], r[0]))
    got = packing.sweep(rows, 40)
    gaps = sorted((size for kind, size, n, _ in rows if kind == 0 for _ in range(n)))
    wanted = Counter()
    for _, size, n, first in (r for r in rows if r[0] == 1):
        for rank in range(first, first + n):
            fit = next((g for g in gaps if g >= size), None)
            if fit is not None:
                gaps.remove(fit)
                wanted[(size, rank, 40 - fit)] += 1
    placed = Counter((size, first + i, offset) for kind, size, n, first, _, offset in got if kind == 2 for i in range(n))
    assert placed == wanted
    total = lambda found, kind: sum(r[2] for r in found if r[0] == kind)
    assert total(got, 1) + total(got, 2) == total(rows, 1)


def test_as_few_sequences_as_plain_best_fit(spark):
    rnd = random.Random(11)
    for capacity, n in ((64, 300), (64, 0), (1024, 900)):
        lengths = [min(capacity, int(rnd.expovariate(4 / capacity)) + 1) for _ in range(n)] + [capacity] * (n // 9)
        counts = Counter(lengths)
        df = spark.createDataFrame(list(counts.items()), "size long, n long")
        plan, opened = packing.best_fit(df, capacity)
        rows = [(r.sequence + i, r.offset, r.size) for r in plan.collect() for i in range(r.n)]
        assert Counter(r[2] for r in rows) == counts and check_places(rows, capacity) == opened
        assert opened <= plain_best_fit(lengths, capacity) * 1.01 + 1


def test_rows_without_a_place(spark):
    df = spark.createDataFrame([(1, 5, 9), (2, None, 9), (3, 0, 9), (4, 11, 9), (5, 5, 9), (5, 5, 9)], "doc_id long, length int, offset int")
    got = sorted(((r.doc_id, r.sequence_id, r.offset) for r in packing.pack(df, capacity=10).collect()), key=str)
    assert [r for r in got if r[1] is None] == [(2, None, None), (3, None, None), (4, None, None)]
    placed = [r for r in got if r[1] is not None]
    assert len({r[1:] for r in placed}) == 3 and {r[2] for r in placed} == {0, 5} and len({r[1] for r in placed}) == 2


def test_pieces_and_places(spark):
    rnd = random.Random(5)
    texts = [" ".join(rnd.choice(["the", "gehen", "sol", "xq###", "<|endoftext|>"]) for _ in range(rnd.choice([0, 3, 40, 900, 3000]))) for _ in range(60)] + [None, "", "", "  a  b"]
    df = spark.createDataFrame([(i % 50, t, "p") for i, t in enumerate(texts)], "doc_id long, text string, piece string")
    got = packing.pack(packing.pieces(df, PATH)).collect()
    library = Tokenizer.from_file(PATH)
    wanted = []
    for i, t in enumerate(texts):
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        n = (len(ids) - 1) % 1024 + 1
        cuts = [0, *range(n, len(ids) + 1, 1024)]
        wanted += [(i % 50, p, a, b - a, crc32(ids[a:b].tobytes())) for p, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(wanted)
    held = defaultdict(list)
    for r in got:
        held[r.sequence_id].append((r.offset, r.length))
    for own in held.values():
        assert [a for a, _ in sorted(own)] == list(np.cumsum([0, *(n for _, n in sorted(own))])[:-1]) and sum(n for _, n in own) <= 1024
    assert len(held) <= sum(r.length for r in got) / 1024 * 1.1 + 1


def test_empty_table(spark):
    assert packing.pack(packing.pieces(spark.createDataFrame([], "doc_id long, text string"), PATH)).count() == 0


def test_long_white_space_and_long_words_as_the_library_has_them():
    v, library = packing._Ranked(PATH), Tokenizer.from_file(PATH)
    for text in (" " * 2_000_000, "\n" * 1_200_000 + " x", "a" * 300_000, "b" + "\u00a0 " * 60_000 + "c", " " * 20_000 + "\n" * 20_000 + "d", "x" + " " * 9_999 + "y" + " " * 10_000 + "z " + "\t" * 30_000):
        wanted = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(v.encode(text), np.uint32).tolist() == wanted, text[:5]
