import random
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import suffix_dedup as sd


def brute(rows):
    """Kept bytes of each row: every 50-byte string is looked up in the rows with smaller keys."""
    last = 2**63 - 1
    first = defaultdict(lambda: last)
    raws = [(last if k is None else k, (t or "").encode()) for k, t in rows]
    for k, raw in raws:
        for i in range(len(raw) - 49):
            first[raw[i : i + 50]] = min(first[raw[i : i + 50]], k)
    out = []
    for k, raw in raws:
        gone = bytearray(len(raw))
        for i in range(len(raw) - 49):
            if first[raw[i : i + 50]] < k:
                gone[i : i + 50] = b"\x01" * 50
        spans = bytes(gone).replace(b"\x00", b" ").split()
        out.append((bytes(b for b, g in zip(raw, gone) if not g), len(raw), sum(gone), len(spans)))
    return out


def check(spark, rows):
    df = spark.createDataFrame([(i, k, t, "k") for i, (k, t) in enumerate(rows)], "n long, doc_id long, text string, kept string").repartition(3)
    got = {r.n: (bytes(r.kept), r.n_bytes, r.n_removed, r.n_spans) for r in sd.remove_repeats(df).collect()}
    wanted = brute(rows)
    assert len(got) == len(rows)
    for i, w in enumerate(wanted):
        assert got[i] == w, i


def test_same_as_looking_up_every_string(spark):
    rnd = random.Random(4)
    words = ["".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 8))) for _ in range(60)]
    text = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    passages = [text(n) for n in (8, 12, 20, 60, 200)]
    rows = [(rnd.randrange(400), " ".join(rnd.choice(passages) if rnd.random() < 0.4 else text(rnd.randint(1, 30)) for _ in range(rnd.randint(1, 6)))) for _ in range(150)]
    rows += [(k, passages[3]) for k in (5, 900, 901, 901, None, None)] + [(7, None), (8, ""), (9, "x" * 49), (10, "y" * 50), (11, "y" * 50), (12, "y" * 400), (3, "z" * 300), (4, "ab" * 200), (2, "b" + "ab" * 90)]
    check(spark, rows)


def test_empty_table(spark):
    assert sd.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


rows_of = st.lists(st.lists(st.binary(min_size=4, max_size=4).map(lambda b: bytes(x & 3 for x in b)), max_size=30).map(lambda x: sorted(x)), max_size=9)


@settings(max_examples=200, deadline=None)
@given(rows_of)
def test_merge_is_a_sort(runs):
    shared = [[0] + [next((i for i in range(4) if a[i] != b[i]), 4) for a, b in zip(r, r[1:])] for r in runs]
    order, prefix = sd.merge(runs, shared, 4)
    at = [0] * len(runs)
    merged = []
    for r in order:
        merged.append(runs[r][at[r]])
        at[r] += 1
    assert merged == sorted(x for r in runs for x in r)
    assert prefix[1:] == [next((i for i in range(4) if a[i] != b[i]), 4) for a, b in zip(merged, merged[1:])]


def test_front_code_round_trip():
    rng = np.random.default_rng(1)
    rows = np.sort(rng.integers(0, 3, (200, 6), np.uint8).view("S6").reshape(-1)).view(np.uint8).reshape(-1, 6)
    assert (sd.front_decode(*sd.front_code(rows), 6) == rows).all()


def test_strings_of_grams_with_several_suffixes_are_looked_up_together(monkeypatch):
    """Few calls however many strings, and what looking up every string gives."""
    import sys

    rnd = random.Random(7)
    gram = "sixteen letters."
    some = ["".join(rnd.choice("ab") for _ in range(rnd.choice((3, 40)))) for _ in range(8)]
    texts = [rnd.choice(some) + gram + rnd.choice(some) for _ in range(400)]
    names, own = [list(range(0, 400, 2)), list(range(1, 400, 2))], {}
    for r, docs in enumerate(names):
        rows, keys = [], []
        for d in docs:
            raw, p = texts[d].encode(), texts[d].index(gram)
            left, right = raw[max(0, p - sd._LEFT) : p][::-1], raw[p : p + sd.WIDTH]
            if len(left) + len(right) >= sd.WIDTH:
                rows.append(right.ljust(sd.WIDTH, b"\0") + left.ljust(sd._LEFT, b"\0") + bytes([len(right), len(left) + 1]))
                keys.append(d)
        different = sorted(set(rows))
        least = [min(k for k, x in zip(keys, rows) if x == y) for y in different]
        made = np.frombuffer(b"".join(different), np.uint8).reshape(-1, sd._ROW)
        many = np.array([rows.count(y) > 1 for y in different])
        own[r] = (made, sd.front_code(made)[0], np.array(least, np.int64), many, np.arange(len(different)))
    first: dict = {}
    wanted = {r: set() for r in own}
    strings = {}
    for r, (made, _, least, _, _) in own.items():
        for e, row in enumerate(made):
            right, left = int(row[-2]), int(row[-1]) - 1
            for o in range(sd.WIDTH - right, left + 1):
                s = (o, row[sd.WIDTH : sd.WIDTH + o][::-1].tobytes() + row[: sd.WIDTH - o].tobytes())
                strings[r, e, o] = s
                first[s] = min(first.get(s, 10**9), int(least[e]))
    for (r, e, o), s in strings.items():
        if first[s] < own[r][2][e] or own[r][3][e]:
            wanted[r].add((e, o, first[s]))
    calls = [0]
    merged = sd.merge([[x.tobytes() for x in own[r][0]] for r in own], [own[r][1].tolist() for r in own])
    monkeypatch.setattr(sd, "merge", lambda *_: merged)
    for block in (1 << 16, 5):
        monkeypatch.setattr(sd, "_BLOCK", block, raising=False)
        calls[0] = 0
        sys.setprofile(lambda *_: calls.__setitem__(0, calls[0] + 1))
        try:
            got = sd._answers(own)
        finally:
            sys.setprofile(None)
        assert {r: {(e, o, v) for e, o1, o2, v in zip(*map(np.ndarray.tolist, a)) for o in range(o1, o2 + 1)} for r, a in got.items()} == wanted
        assert calls[0] < 2 * len(strings)
