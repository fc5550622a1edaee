"""Vectors of a batch as a matrix."""

import numpy as np
import pyarrow as pa

from tessera.operators import vectors


def test_lists_become_a_matrix():
    rows = [[0.5, 1.0, -2.0], [3.0, 4.0, 5.0], [6.0, 7.0, 8.0]]
    for kind in (pa.float32(), pa.float64()):
        a = pa.array(rows, pa.list_(kind))
        assert np.array_equal(vectors.matrix(a), np.array(rows)) and vectors.matrix(a).dtype == np.float64
        assert np.array_equal(vectors.matrix(a.slice(1)), np.array(rows[1:]))
