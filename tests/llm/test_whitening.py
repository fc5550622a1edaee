import numpy as np
import pytest

from tessera.llm import whitening


def brute(vectors):
    """Components by one decomposition of all rows at once, deviations with Python's integers."""
    x = np.array([[int(np.floor(1024 * float(c))) + 100_000 for c in v] for v in vectors], object)
    n, s = len(x), x.sum(axis=0)
    y = x * n - s
    centred = (y / n).astype(float)
    e, u = np.linalg.eigh(centred.T @ centred / n)
    e, u = e[::-1][:8], u[:, ::-1][:, :8]
    return n, [int(sum(v * v for v in row)) for row in y], centred @ u / np.sqrt(e), e, np.trace(centred.T @ centred / n)


def test_same_as_one_decomposition(spark):
    rnd = np.random.default_rng(11)
    vectors = (rnd.normal(size=(700, 12)) * np.arange(1, 13) @ np.linalg.qr(rnd.normal(size=(12, 12)))[0] / 10 + 3).tolist()
    vectors += [vectors[0]] * 300  # one vector holds a third of the rows
    rows = [(i, v, "x") for i, v in enumerate(vectors)]
    rows += [(9001, None, "x"), (9002, [None] * 12, "x"), (9003, [float("nan")] + [0.0] * 11, "x"), (9004, [float("-inf")] * 12, "x"), (9005, [1.0], "x"), (9006, [], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, component string").repartition(7)
    got = whitening.whiten(df).collect()
    n, deviations, z, e, total = brute(vectors)
    assert len(got) == 8 * n
    signs = {}
    for r in got:
        k = r.component - 1
        assert (r.n, int(r.deviation)) == (n, deviations[r.vec_id])
        assert r.explained == pytest.approx(e[k] / total, rel=1e-9)
        assert r.identity_error <= 1e-9
        if abs(z[r.vec_id, k]) > 0.1:
            signs.setdefault(k, set()).add(np.sign(r.whitened * z[r.vec_id, k]))
        assert abs(abs(r.whitened) - abs(z[r.vec_id, k])) < 1e-7
    assert all(len(s) == 1 for s in signs.values()) and len(signs) == 8


def test_merging_keeps_a_small_spread_around_a_large_mean():
    rnd = np.random.default_rng(3)
    x = rnd.integers(-3, 4, size=(5000, 3)) + 2**50
    parts = [whitening.Moments.of(p) for p in np.array_split(x, 37)] + [whitening.Moments.of(x[:0])]
    merged = parts[0]
    for p in parts[1:]:
        merged = merged.merge(p)
    small = (x - 2**50).astype(float)
    assert np.allclose(merged.covariance(), np.cov(small.T, bias=True), rtol=1e-12)
    assert merged.sums.tolist() == [int(v) for v in x.astype(object).sum(axis=0)]


def test_few_dimensions_no_variance_and_empty_tables(spark):
    df = spark.createDataFrame([(None, [0.5, 1.0]), (None, [0.5, 1.0]), (3, [2.5, 1.0])], "vec_id long, embedding array<float>")
    got = sorted(whitening.whiten(df).collect(), key=lambda r: (r.component, r.vec_id or 0))
    assert [r.component for r in got] == [1] * 3 + [2] * 3
    assert got[0].explained == 1.0 and got[3].whitened is None and got[3].explained == 0.0
    assert int(got[2].deviation) == 4096**2 and got[0].identity_error < 1e-9
    alone = whitening.whiten(df.limit(1)).collect()
    assert [(r.n, r.whitened, r.explained, r.identity_error) for r in alone] == [(1, None, None, None)] * 2
    assert whitening.whiten(df.limit(0)).collect() == []
    assert whitening.whiten(df.limit(0)).columns == whitening.whiten(df).columns


def test_huge_entries_stay_exact(spark):
    df = spark.createDataFrame([(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [0.0, 2.0])], "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in whitening.whiten(df).withColumn("as_long", whitening.as_long("deviation")).collect() if r.component == 1}
    big = whitening.LARGEST
    assert got[3].as_long == (3 * 2048 - 3072) ** 2  # the large entries cancel in the sum
    assert got[1].as_long is None and (got[1].deviation is None or int(got[1].deviation) == (3 * big) ** 2 + 3072**2)
