import random
from collections import Counter

import numpy as np

from tessera.llm import near_dup

RND = random.Random(8)
WORDS = ["".join(RND.choice("abcdefghij") for _ in range(RND.randint(2, 7))) for _ in range(400)]


def text(n):
    return " ".join(RND.choice(WORDS) for _ in range(n))


def edited(base, times):
    words = base.split()
    for _ in range(times):
        words[RND.randrange(len(words))] = RND.choice(WORDS)
    return " ".join(words)


def weighted(words, idf):
    """Shingle weights of one text, word by word."""
    out = Counter()
    span = min(5, len(words))
    for i in range(len(words) - span + 1 if words else 0):
        own = words[i : i + span]
        out[" ".join(own)] += sum(idf(w) for w in own) / span
    return out


def brute(rows):
    """The smallest key of each row's component under exact weighted similarity, all pairs compared."""
    texts = [t or "" for _, t in rows]
    bucket = {w: int(near_dup.word_hashes([w.encode()])[0][0] >> np.uint64(46)) for t in texts for w in t.split()}
    df = Counter(b for t in texts for b in {bucket[w] for w in t.split()})
    idf = lambda w: np.log((len(texts) + 1) / (df[bucket[w]] + 1)) + 1
    vectors = [weighted(t.split(), idf) for t in texts]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            shared = sum((vectors[i] & vectors[j]).values())
            total = sum(vectors[i].values()) + sum(vectors[j].values()) - shared
            if texts[i] == texts[j] or (total and shared / total >= 0.8):
                parent[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), k), k)
    return {k: least[find(i)] for i, (k, _) in enumerate(rows)}


def test_groups_match_all_pairs(spark):
    bases = [text(n) for n in (3, 30, 80, 200, 400)]
    rows = [(i, b) for i, b in enumerate(bases)]
    rows += [(100 + i, edited(bases[2 + i % 3], 1 + i % 3)) for i in range(60)]
    rows += [(200 + i, text(60)) for i in range(40)] + [(300, bases[1]), (301, bases[1]), (302, None), (303, ""), (304, "  "), (305, bases[0])]
    df = spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, text string, class_id int")
    got = near_dup.near_duplicates(df).collect()
    assert {r.doc_id: r.class_id for r in got} == brute(rows)
    assert Counter(r.class_id for r in got if r.is_first) == Counter({r.class_id: 1 for r in got})
    assert all(r.class_id == r.doc_id for r in got if r.is_first)


def test_repeated_rows_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (None, "a b c"), (None, "x")], "doc_id long, text string")
    got = near_dup.near_duplicates(df).collect()
    assert len(got) == 4 and sum(r.is_first for r in got) == 2
    assert near_dup.near_duplicates(df.limit(0)).count() == 0


def test_samples_meet_as_often_as_texts_are_alike():
    idf = np.ones(near_dup.WORD_BUCKETS)
    base = text(300)
    pairs = [(base.encode(), edited(base, 12).encode()) for _ in range(30)]
    share, wanted = [], []
    for a, b in pairs:
        keys = near_dup.band_keys(*near_dup.shingles([a, b], idf))
        share.append((keys[0] == keys[1]).mean())
        wanted.append(near_dup._similarity(a, b, idf) ** near_dup.ROWS)
    assert abs(np.mean(share) - np.mean(wanted)) < 0.06


def banded(rows, idf):
    """The smallest key of each row's component, every pair that shares a bucket compared."""
    raw = [t.encode() for _, t in rows]
    h, w, begin = near_dup.shingles(raw, idf)
    keys = near_dup.band_keys(h, w, begin)
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in np.flatnonzero((keys[:i] == keys[i]).any(axis=1)):
            if near_dup._similarity(raw[i], raw[j], idf) >= 0.8:
                parent[find(i)] = find(int(j))
    least = {}
    for i, (k, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), k), k)
    return {k: least[find(i)] for i, (k, _) in enumerate(rows)}


def test_large_buckets_link_all_that_share_a_bucket(spark, monkeypatch):
    """Chains of edits, whose links often hang on one member: no member of a large bucket may be left out."""
    monkeypatch.setattr(near_dup, "GROUP", 3)
    monkeypatch.setattr(near_dup, "FIRSTS", 1)
    texts = []
    for _ in range(6):
        own = text(80)
        for _ in range(30):
            texts.append(own)
            own = edited(own, 1)
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in near_dup.near_duplicates(df).collect()}
    assert got == banded(rows, near_dup.inverse_frequencies(df))


def test_small_limits_change_no_class(spark, monkeypatch):
    """Buckets of too many members or bytes take another path and give the classes of all banded pairs."""
    for name, value in {"GROUP": 20, "GROUP_BYTES": 4_000, "FIRSTS": 2}.items():
        monkeypatch.setattr(near_dup, name, value)
    base = text(150)
    rows = [(i, edited(base, i % 9)) for i in range(40)] + [(100 + i, edited(base, 20 + i)) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in near_dup.near_duplicates(df).collect()}
    assert got == banded(rows, near_dup.inverse_frequencies(df))


def test_null_and_repeated_keys_keep_one_row_a_class(spark):
    base = text(120)
    near = edited(base, 1)
    other = text(100)
    rows = [(None, base), (None, near), (1, other), (1, text(90)), (None, ""), (None, None), (2, other)]
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    firsts = [(r.doc_id, r.class_id) for r in got if r.is_first]
    assert len(got) == 7 and sorted(firsts, key=str) == [(1, 1), (1, 1), (None, None), (None, None)]


def test_long_texts_are_compared_whole(spark):
    base = text(30_000)
    rows = [(1, base), (2, base + " " + text(300)), (3, base[: len(base) // 2]), (4, text(30_000))]
    got = {r.doc_id: r.class_id for r in near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4}
