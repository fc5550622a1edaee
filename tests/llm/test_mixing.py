import hashlib
import math
import random
import re
from fractions import Fraction

from tessera.llm import mixing

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute_targets(sizes):
    """Shares dealt again and again until none is above twice its size."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, open_, target = Fraction(3 * sum(sizes.values()), 2), set(names), {}
    while open_:
        share = {s: left * weight[s] / sum(weight[t] for t in open_) for s in open_}
        above = {s for s in open_ if share[s] > 2 * sizes[s]}
        if not above:
            return target | share
        for s in above:
            target[s] = Fraction(2 * sizes[s])
            left -= target[s]
        open_ -= above
    return target


def brute(rows, weight):
    size = {(i, d): len(WORD.findall(t or "")) for i, (d, t, s) in enumerate(rows)}
    of = {}
    for i, (d, t, s) in enumerate(rows):
        of[s] = of.get(s, 0) + size[i, d]
    target, out = brute_targets(of), {}
    for s in of:
        budget, own = math.floor(target[s]), [(i, d) for i, (d, t, x) in enumerate(rows) if x == s]
        epochs = budget // of[s] if of[s] else 0
        rest = budget - epochs * of[s]

        def key(k):
            name = "" if k[1] is None else str(k[1])
            u = (int(hashlib.md5(name.encode()).hexdigest()[:13], 16) + 0.5) / 2**52
            return -math.log(u) / weight.get(k[1], 1.0), name, size[k]

        groups = {}
        for k in own:
            groups.setdefault(key(k), []).append(k)
        for g in sorted(groups):
            words = sum(size[k] for k in groups[g])
            for k in groups[g]:
                out[k[0]] = (size[k], of[s], float(target[s]), epochs * size[k] + (size[k] if words <= rest else rest // len(groups[g])))
            rest = max(0, rest - words)
    return out


def check(spark, rows, weight):
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, source string, key long")
    quality = spark.createDataFrame(list(weight.items()), "doc_id long, weight double")
    got = sorted(map(tuple, mixing.mix(df, quality).collect()), key=repr)
    want = sorted(((rows[i][0], *v) for i, v in brute(rows, weight).items()), key=repr)
    assert got == want
    return got


def test_same_as_dealing_again_and_again(spark):
    rnd = random.Random(12)
    rows = [(i, " \t".join("w" for _ in range(rnd.choice([1, 5, 40, 300]))), rnd.choice(["s%d" % (i % 11), "hot", "hot", None, "é", "z\U0001f600", "z￿"])) for i in range(900)]
    rows += [(2000, "one   two\x0bthree", "tiny"), (2001, None, "empty"), (2002, "", "empty"), (2003, "a " * 30_000, "tiny")]
    weight = {i: rnd.choice([0.5, 2.0, 7.25]) for i in range(0, 900, 3)}
    got = check(spark, rows, weight)
    by = {}
    for d, size, total, target, taken in got:
        assert 0 <= taken <= 2 * size
        by.setdefault((total, target), []).append(taken)
    assert sum(map(sum, by.values())) <= 1.5 * sum(len(WORD.findall(t or "")) for _, t, _ in rows)


def test_repeated_rows_and_null_ids_share_alike(spark):
    rows = [(None, "a b c", "s")] * 50 + [(7, "a b c d", "s")] * 20 + [(8, "x y", "t")] * 3 + [(9, "q " * 500, "u")]
    check(spark, rows, {})


def test_weights_that_say_nothing_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b", "s"), (2, "c d", "s")], "doc_id long, text string, source string")
    odd = spark.createDataFrame([(1, float("nan")), (2, -1.0), (2, None), (None, 3.0)], "doc_id long, weight double")
    assert sorted(mixing.mix(df, odd).collect()) == sorted(mixing.mix(df).collect())
    assert mixing.mix(df.limit(0)).collect() == []
    nothing = mixing.mix(spark.createDataFrame([(1, None, None)], "doc_id long, text string, source string")).collect()
    assert [tuple(r) for r in nothing] == [(1, 0, 0, 0.0, 0)]


def test_heavier_documents_come_sooner(spark):
    df = spark.range(4000).selectExpr("id as doc_id", "'a b c d' as text", "if(id < 3000, 'a', 'b') as source")
    heavy = df.selectExpr("doc_id", "if(doc_id % 2 = 0, 4.0D, 1.0D) as weight")
    got = mixing.mix(df, heavy).collect()
    often = {k: [r.taken for r in got if r.source_size == 4000 and r.doc_id % 2 == k] for k in (0, 1)}
    assert sum(often[0]) >= sum(often[1])
    assert all(r.target <= 2 * r.source_size for r in got)
