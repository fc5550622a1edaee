"""Byte-level BPE encoding and decoding.

A word's merges come off a segment tree over its adjacent pairs.  A leaf holds rank and position of one pair, so the
root is the leftmost pair of the lowest rank; a merge changes three leaves, each in logarithmic time, until the root says
that no pair can be merged.  A node of the tree has sixteen children, so most words have the root alone above the leaves.

Texts are cut before each space that stands alone before a non-space.  No pre-token crosses such a cut, so the pieces
are encoded on their own and frequent ones come from a bounded cache.  Texts with other runs of spaces go through the
pattern whole.
"""

from __future__ import annotations

import json
from array import array
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import reach_workers, worker_slot

#: The published pattern that splits a text before byte-level merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

PIECE_ENTRIES = 300_000
WORD_ENTRIES = 800_000
CACHED_CHARS = 48
#: A leaf of the tree: rank, the merged id and the position of a pair, the most significant first.
_ID_BITS, _AT_BITS = 17, 26
_ID, _AT = (1 << _ID_BITS) - 1, (1 << _AT_BITS) - 1
_NONE = 1 << 60
_FAN = 16


def _byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    table = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [table[b] for b in range(256)]


class Vocabulary:
    """Merges, ids and special tokens of a tokenizers file of the byte-level BPE kind."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        ids = spec["model"]["vocab"]
        symbols = _byte_symbols()
        as_byte = {c: b for b, c in enumerate(symbols)}
        self.of_byte = [ids[c] for c in symbols]
        self.merges = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[ids[a] << 32 | ids[b]] = rank << _ID_BITS + _AT_BITS | ids[a + b] << _AT_BITS
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.bytes_of = {i: bytes(as_byte[c] for c in s) for s, i in ids.items()}
        self.bytes_of |= {i: s.encode() for s, i in self.special.items()}
        self.words = regex.compile(PATTERN)
        self.odd_space = regex.compile(r" (?:\s|\Z)")
        known = sorted(self.special, key=len, reverse=True)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, known)) + ")") if known else None
        self.word_cache: dict[str, bytes] = {}
        self.piece_cache: dict[str, bytes] = {}
        self.older_pieces: dict[str, bytes] = {}  # what the cache held before it was last full

    def merge(self, ids: list[int]) -> list[int]:
        """Merge the pairs of one word, lowest rank first and leftmost among equals."""
        m = len(ids) - 1  # leaves: one for each adjacent pair
        if m < 1:
            return ids
        if m > _AT:
            return self._merge_wide(ids)
        get = self.merges.get
        leaves = [_NONE if (hit := get(a << 32 | b)) is None else hit | i for i, (a, b) in enumerate(zip(ids, ids[1:]))]
        tree = [leaves]  # each level holds the minima of the one before, _FAN to a node; the last has one node
        while len(tree) == 1 or len(tree[-1]) > 1:
            below = tree[-1]
            tree.append([min(below[i : i + _FAN]) for i in range(0, len(below), _FAN)])
        root = tree[-1]
        after = list(range(1, m + 2))
        before = list(range(-1, m))
        while (top := root[0]) < _NONE:
            left = top & _AT
            ids[left] = new = top >> _AT_BITS & _ID
            gone = after[left]
            ids[gone] = -1
            right = after[left] = after[gone]
            hit = None
            if right <= m:
                before[right] = left
                hit = get(new << 32 | ids[right])
            leaves[left] = _NONE if hit is None else hit | left
            if gone < m:
                leaves[gone] = _NONE
            prev = before[left]
            if prev >= 0:
                hit = get(ids[prev] << 32 | new)
                leaves[prev] = _NONE if hit is None else hit | prev
            if m <= _FAN:
                root[0] = min(leaves)
                continue
            for at in {prev // _FAN if prev >= 0 else left // _FAN, left // _FAN, min(gone, m - 1) // _FAN}:
                below = leaves
                for level in tree[1:]:
                    low = min(below[at * _FAN : at * _FAN + _FAN])
                    if level[at] == low:
                        break
                    level[at] = low
                    below = level
                    at //= _FAN
        return [x for x in ids if x >= 0]

    def _merge_wide(self, ids: list[int]) -> list[int]:
        """The same for a word whose positions have no room in a leaf: leaves are pairs of rank and position in a heap."""
        m, get = len(ids) - 1, self.merges.get
        hit = [get(a << 32 | b) for a, b in zip(ids, ids[1:])]
        heap = [(h >> _AT_BITS, i) for i, h in enumerate(hit) if h is not None]
        heapify(heap)
        after, before = array("q", range(1, m + 2)), array("q", range(-1, m))
        while heap:
            top, left = heappop(heap)
            gone = after[left] if ids[left] >= 0 else m + 1
            if gone > m or (h := get(ids[left] << 32 | ids[gone])) is None or h >> _AT_BITS != top:
                continue  # the pair has changed since
            ids[left], ids[gone] = top & _ID, -1
            right = after[left] = after[gone]
            if right <= m:
                before[right] = left
            for a, b in ((before[left], left), (left, right)):
                if a >= 0 and b <= m and (h := get(ids[a] << 32 | ids[b])) is not None:
                    heappush(heap, (h >> _AT_BITS, a))
        return [x for x in ids if x >= 0]

    def _word(self, word: str) -> bytes:
        hit = self.word_cache.get(word)
        if hit is None:
            of_byte = self.of_byte
            hit = array("I", self.merge([of_byte[b] for b in word.encode()])).tobytes()
            if len(word) <= CACHED_CHARS:
                if len(self.word_cache) >= WORD_ENTRIES:
                    self.word_cache.clear()
                self.word_cache[word] = hit
        return hit

    def _whole(self, text: str) -> bytes:
        """Ids of a text by the pattern alone."""
        return b"".join(map(self._word, self.words.findall(text)))

    def _marked(self, text: str) -> bytes:
        """Ids of a text that holds special tokens."""
        parts = self.marks.split(text)
        return b"".join(array("I", [self.special[p]]).tobytes() if p in self.special else self._whole(p) for p in parts)

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if self.marks and self.marks.search(text):
            return self._marked(text)
        if self.odd_space.search(text):
            return self._whole(text)
        first, *pieces = text.split(" ")
        cache, older = self.piece_cache, self.older_pieces
        found = list(map(cache.get, pieces))
        if None in found:
            for i, hit in enumerate(found):
                if hit is None:
                    piece = pieces[i]
                    found[i] = hit = cache.get(piece) or older.get(piece) or self._whole(" " + piece)
                    if len(piece) <= CACHED_CHARS:
                        if len(cache) >= PIECE_ENTRIES:
                            older = self.older_pieces = cache
                            cache = self.piece_cache = {}
                        cache[piece] = hit
        return self._whole(first) + b"".join(found)

    def decode(self, ids: bytes) -> str:
        """The text of packed ids; bytes that are no UTF-8 become U+FFFD, ids outside the vocabulary nothing."""
        of = self.bytes_of
        try:
            raw = b"".join(map(of.__getitem__, array("I", ids)))
        except KeyError:
            raw = b"".join(of.get(i, b"") for i in array("I", ids))
        return raw.decode("utf-8", "replace")


def vocabulary(path: str) -> Vocabulary:
    """One vocabulary for each Python worker."""
    return worker_slot("bpe", path, lambda: Vocabulary(path))


def encode(df: DataFrame, vocab_path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """Add ``out``: the ids of ``text`` packed as little-endian unsigned 32-bit integers (binary).

    Null and empty texts give empty binaries, and no text is too long: words of more than 2^26 bytes, whose positions have
    no room in a leaf of the tree, are merged over a heap of the same pairs.  All other columns pass; one named as ``out`` is replaced.
    """
    reach_workers(df.sparkSession)

    @F.arrow_udf(T.BinaryType())
    def ids(texts: pa.Array) -> pa.Array:
        v = vocabulary(vocab_path)
        return pa.array([v.encode(s) if s else b"" for s in texts.to_pylist()], pa.binary())

    return df.withColumn(out, ids(F.col(text)))


def decode(df: DataFrame, vocab_path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add ``out``: the text of the packed ids in ``ids``, special tokens included.  Null ids give an empty text."""
    reach_workers(df.sparkSession)

    @F.arrow_udf(T.StringType())
    def texts(packed: pa.Array) -> pa.Array:
        v = vocabulary(vocab_path)
        return pa.array([v.decode(b) if b else "" for b in packed.to_pylist()], pa.string())

    return df.withColumn(out, texts(F.col(ids)))


def n_ids(ids: str | Column = "ids") -> Column:
    """How many ids a packed column holds."""
    col = F.col(ids) if isinstance(ids, str) else ids
    return (F.octet_length(col) / 4).cast("long")
