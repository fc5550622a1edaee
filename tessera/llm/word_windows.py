"""Words and windows of words of one text as arrays, for texts too long to hold a tuple a window."""

from __future__ import annotations

import re

import numpy as np

#: Texts of more bytes are counted with arrays; the counts are the same.
LONG = 1 << 20
_WORD = re.compile(rb"[^ \t\n\v\f\r]+")


def word_ids(raw: bytes) -> np.ndarray:
    """A number for each word (run without ASCII white space) of a text, in order; equal words have equal numbers.

    Each different word is held once.  An empty text has none.
    """
    ids: dict[bytes, int] = {}
    return np.fromiter((ids.setdefault(m.group(), len(ids)) for m in _WORD.finditer(raw)), np.int64)


def window_ids(ids: np.ndarray, width: int) -> np.ndarray:
    """A number for each window of ``width`` words; equal windows have equal numbers.  Fewer words have no window."""
    if len(ids) < width:
        return np.zeros(0, np.int64)
    have = 1
    while have < width:
        # two windows that touch or overlap make one longer window, and their two numbers make one
        step = min(have, width - have)
        pairs = ids[:-step] * (int(ids.max()) + 1) + ids[step:]
        ids = np.unique(pairs, return_inverse=True)[1]
        have += step
    return ids


def n_repeated(windows: np.ndarray, width: int) -> int:
    """How many words stand in windows that occur twice or more."""
    if not len(windows):
        return 0
    again = np.bincount(windows)[windows] > 1
    edges = np.zeros(len(windows) + width, np.int64)
    edges[: len(windows)] += again
    edges[width:] -= again
    return int((np.cumsum(edges) > 0).sum())
