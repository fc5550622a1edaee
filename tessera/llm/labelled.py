"""Labelled rows to learn from, a plain isotonic fit and counts of held-out quality."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import held_out

#: No model of this subpackage learns from more labelled rows than this; which ones, a hash of doc_id decides.
LABELLED_ROWS = 24_000


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, bound: int = LABELLED_ROWS) -> DataFrame:
    """(doc_id, text, y) of at most ``bound`` labelled documents outside the held-out fold, one row a document.

    Null ids and null labels are left out; of repeated labels of a document the largest counts, of rows that repeat an id
    the smallest text (null counts as empty).  Empty tables give no rows.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max(label).cast("double").alias("y"))
    n = known.count()
    if n > bound:
        cut = int(bound / n * (1 << 30) * 0.98)
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < cut).orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    # at most ``bound`` rows of two numbers, so this side is small by construction
    found = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(known), "doc_id")
    return found.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("y").alias("y"))


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the non-decreasing least-squares fit of ``y`` on ``score`` (pool adjacent violators)."""
    if not len(score):
        return np.array([0.0]), np.array([0.0])
    order = np.argsort(score, kind="stable")
    xs, first = np.unique(score[order], return_index=True)
    sums = np.add.reduceat(y[order], first)
    counts = np.diff(np.append(first, len(y)))
    blocks: list[list[float]] = []  # first and last score, sum, count
    for x, s, c in zip(xs, sums, counts):
        blocks.append([x, x, s, c])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][3] >= blocks[-1][2] * blocks[-2][3]:
            last = blocks.pop()
            blocks[-1][1] = last[1]
            blocks[-1][2] += last[2]
            blocks[-1][3] += last[3]
    knots = [(x, s / c) for a, b, s, c in blocks for x in ((a,) if a == b else (a, b))]
    return np.array([k[0] for k in knots]), np.array([k[1] for k in knots])
