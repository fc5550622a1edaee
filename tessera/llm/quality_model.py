"""A quality classifier: document statistics, random Fourier features, ridge regression and an isotonic calibration.

Sixteen statistics of a text's shape are mapped to cosines whose inner products approximate a Gaussian kernel.  Each
task sums its rows' normal equations; the sums are added by Spark and solved once.  Scores of the same bounded sample are
then calibrated by an isotonic fit.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import materialise, reach_workers
from tessera.llm.labelled import LABELLED_ROWS, isotonic, labelled_sample
from tessera.llm.word_windows import LONG, window_ids, word_ids

FEATURES = 128
WIDTH = 0.35
RIDGE = 1e-3
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGITS = b"0123456789"
_SPACE = b" \t\n\v\f\r"
_SYMBOLS = b"#*$%&|<>"
_STOPS = b".,;:"
_LOUD = b"!?"


def statistics(text: str) -> list[float]:
    """Sixteen numbers, most of them shares, that describe the shape of a text; all are 0 for an empty one."""
    raw = text.encode()
    n = len(raw)
    if not n:
        return [0.0] * 16
    share = lambda table: (n - len(raw.translate(None, table))) / n
    n_words, different, top, same_as_next, n_windows, n_different = (_long_shape if n > LONG else _shape)(raw)
    m = max(n_words, 1)
    lines = raw.split(b"\n")
    full = [x for x in lines if x.strip(_SPACE)]
    loud, symbols = share(_LOUD), share(_SYMBOLS)
    return [
        np.log1p(n) / 12,
        np.log1p(n_words) / 10,
        min(n / m / 20, 2.0),
        share(_UPPER),
        share(_LOWER),
        share(_DIGITS) * 2,
        share(_SPACE),
        min(symbols * 4, 2.0),
        share(_STOPS) * 4,
        min(loud * 4, 2.0),
        (n - len(text)) / n * 2,
        different / m,
        top / m,
        same_as_next / m,
        1 - n_different / max(n_windows, 1),
        1 - len(set(full)) / max(len(full), 1),
    ]


def _shape(raw: bytes) -> tuple[int, ...]:
    """Numbers of words, different words, copies of the most frequent one, words equal to the next, windows of three words
    and different windows."""
    words = raw.split()
    times = Counter(words)
    windows = list(zip(words, words[1:], words[2:]))
    return len(words), len(times), max(times.values(), default=0), sum(map(bytes.__eq__, words, words[1:])), len(windows), len(set(windows))


def _long_shape(raw: bytes) -> tuple[int, ...]:
    """The same numbers without an object a word or window."""
    ids = word_ids(raw)
    times, windows = np.bincount(ids), window_ids(ids, 3)
    return len(ids), len(times), int(times.max(initial=0)), int((ids[1:] == ids[:-1]).sum()), len(windows), int(windows.max(initial=-1)) + 1


def fourier(x: np.ndarray, n: int = FEATURES, width: float = WIDTH, seed: int = 11) -> np.ndarray:
    """Random cosine features of rows of statistics, and a constant; the draw depends on the seed alone."""
    rng = np.random.default_rng(seed)
    w = rng.standard_normal((x.shape[1], n)) / width
    b = rng.uniform(0, 2 * np.pi, n)
    return np.hstack([np.sqrt(2 / n) * np.cos(x @ w + b), np.ones((len(x), 1))])


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray
    learned: bool = True

    def raw(self, x: np.ndarray) -> np.ndarray:
        return fourier(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.knots, self.values), 0.0, 1.0)


def _with_statistics(df: DataFrame, text: str, out: str) -> DataFrame:
    reach_workers(df.sparkSession)

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def stats(texts: pa.Array) -> pa.Array:
        return pa.array([statistics(s or "") for s in texts.to_pylist()], pa.list_(pa.float64()))

    return df.withColumn(out, stats(F.col(text)))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", bound: int = LABELLED_ROWS) -> Model:
    """Learn from at most ``bound`` labelled documents outside the held-out fold; without any, all scores are 0.

    The calibration is fitted on scores of each half of them by the ridge of the other half; the ridge itself learns from
    both.
    """
    half = F.pmod(F.xxhash64("doc_id", F.lit(8)), F.lit(2)).cast("int").alias("half")
    sample = _with_statistics(labelled_sample(docs, labels, label, bound), "text", "x").select("x", "y", half)
    sample = materialise(sample, "quality-sample")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, FEATURES + 1, FEATURES + 2))
        for batch in batches:
            if batch.num_rows:
                z = fourier(np.array(batch.column(0).to_pylist()))
                y, side = np.asarray(batch.column(1)), np.asarray(batch.column(2))
                for k in (0, 1):
                    own = z[side == k]
                    total[k] += own.T @ np.hstack([own, y[side == k, None]])
        k, i, j = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(i), pa.array(j), pa.array(total[k, i, j])], ["k", "i", "j", "v"])

    parts = sample.mapInArrow(sums, "k long, i long, j long, v double").groupBy("k", "i", "j").agg(F.sum("v").alias("v"))
    total = np.zeros((2, FEATURES + 1, FEATURES + 2))
    for r in parts.collect():  # a fixed number of cells
        total[r["k"], r["i"], r["j"]] = r["v"]
    weights = _ridge(total.sum(axis=0))
    rows = sample.collect()  # at most ``bound`` rows of eighteen numbers
    if not rows:
        return Model(weights, *isotonic(np.array([]), np.array([])), learned=False)
    z, y, side = fourier(np.array([r["x"] for r in rows])), np.array([r["y"] for r in rows]), np.array([r["half"] for r in rows])
    other = [_ridge(total[1 - k]) if total[1 - k].any() else weights for k in (0, 1)]
    return Model(weights, *isotonic(np.where(side == 0, z @ other[0], z @ other[1]), y))


def _ridge(total: np.ndarray) -> np.ndarray:
    """Weights from summed normal equations, the last column of which belongs to the labels."""
    n = max(total[FEATURES, FEATURES], 1.0)
    return np.linalg.solve(total[:, :-1] + RIDGE * n * np.eye(FEATURES + 1), total[:, -1])


def classify(df: DataFrame, model: Model, text: str = "text", out: str = "score", threshold: float = 0.3) -> DataFrame:
    """Add ``out`` (0 to 1, higher for better texts) and ``predicted`` (1 at the threshold or above) to each row.

    Null texts count as empty.  Other columns pass; clashing ones are replaced.
    """
    reach_workers(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)  # of fixed size but for the knots, which the sample bounds

    @F.arrow_udf(T.DoubleType())
    def score(texts: pa.Array) -> pa.Array:
        rows = texts.to_pylist()
        if not rows:
            return pa.array([], pa.float64())
        return pa.array(shared.value.score(np.array([statistics(s or "") for s in rows])))

    return df.withColumn(out, score(F.col(text))).withColumn("predicted", (F.col(out) >= threshold).cast("int"))
