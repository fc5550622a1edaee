"""Removal of byte strings that an earlier document also has, by a distributed merge sort of suffix runs.

A string of ``WIDTH`` bytes is held by the smallest hash among its ``GRAM``-byte grams (the rightmost of equal ones).  Equal
strings are held at equal places, so suffixes that start at such anchors are enough: about one position in eighteen.

1. Rows are gathered into runs of some megabytes, written once to a bucketed table so that later steps find them without
   moving texts.  Each run sends the sorted hashes of its anchors, by hash range, and learns which occur in two documents.
2. Suffixes at those anchors, with what stands before them as far as the anchor holds a string, are sorted in each run;
   equal ones become one with their smallest document.  They are front-coded: each as the length of the prefix shared with
   the one before and the bytes that differ.
3. Front-coded runs are exchanged by ranges of suffixes.  A loser tree merges them: the front code says how much a new
   suffix shares with the one put out last, so whole prefixes that are known to be equal are never compared again.
4. Where a gram has one suffix alone, its strings all have the smallest document of that suffix; else the strings are
   looked up one by one.  What each run needs to know comes back to it, and it cuts its texts.

What is exchanged grows with the text that repeats; one suffix comes from a run at most once, so no group grows with the
copies of a passage but with the number of runs.
"""

from __future__ import annotations

import io
import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import materialise, n_tasks, reach_workers, scratch_dir

WIDTH = 50
GRAM = 16
RUN_BYTES = 8 << 20
_PART = 2 << 20  # bytes that are hashed at once
_SPAN = WIDTH - GRAM + 1  # gram positions in a string
_LEFT = _SPAN - 1  # most bytes before an anchor
_ROW = WIDTH + _LEFT + 2  # suffix, reversed left part, both lengths
_LAST = np.int64(2**63 - 1)
_BLOCK = 1 << 16  # suffixes whose strings are looked up at once, but for those of one gram
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _pack(values: np.ndarray) -> bytes:
    """Numbers with their bytes grouped by place, then compressed."""
    raw = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T.tobytes() if len(values) else b""
    return zstandard.ZstdCompressor(level=1).compress(raw)


def _unpack(raw: bytes, kind) -> np.ndarray:
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(flat.reshape(size, -1).T).reshape(-1).view(kind) if len(flat) else np.zeros(0, kind)


def _pack_sorted(values: np.ndarray) -> bytes:
    return _pack(np.diff(values, prepend=np.uint64(0)))


def _unpack_sorted(raw: bytes) -> np.ndarray:
    return np.cumsum(_unpack(raw, np.uint64), dtype=np.uint64)


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Where each text begins, and the end; all texts one after another."""
    return np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64), np.frombuffer(b"".join(texts), np.uint8)


class Run:
    """Some rows' texts one after another, their anchors and the strings that each anchor holds."""

    def __init__(self, texts: list[bytes]):
        self.bounds, self.raw = _joined(texts)
        anchors, hashes, firsts, lasts, docs = [], [], [], [], []
        first = 0
        while first < len(texts):
            end = max(first + 1, int(np.searchsorted(self.bounds, self.bounds[first] + _PART, "right")) - 1)
            for into, values in zip((anchors, hashes, firsts, lasts, docs), self._anchors(first, end)):
                into.append(values)
            first = end
        empty = [np.zeros(0, np.int64)]
        self.anchor, self.first, self.last, self.doc = (np.concatenate(x or empty) for x in (anchors, firsts, lasts, docs))
        self.hash = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)

    def _anchors(self, first: int, end: int) -> tuple[np.ndarray, ...]:
        """Anchors of documents first to end: place, hash, first and last start of the strings held, document."""
        lo, hi = self.bounds[first], self.bounds[end]
        raw = self.raw[lo:hi]
        n = len(raw) - WIDTH + 1
        if n <= 0:
            none = np.zeros(0, np.int64)
            return none, none.astype(np.uint64), none, none, none
        # two unaligned words at each place
        words = np.zeros(len(raw) - 7, np.uint64)
        for k in range(8):
            some = np.frombuffer(raw[k : k + (len(raw) - k) // 8 * 8].tobytes(), "<u8")
            words[k::8][: len(some)] = some
        h = words[: len(raw) - GRAM + 1] * _M1
        h ^= h >> np.uint64(31)
        h += words[8 : 8 + len(h)]
        h *= _M2
        h ^= h >> np.uint64(29)
        h *= _M1
        bits = np.uint64(32)  # the same for all texts, so that equal strings choose alike
        mask = (np.uint64(1) << bits) - np.uint64(1)
        low = (h >> bits << bits) | (mask - np.arange(len(h), dtype=np.uint64))
        span = 1
        while span * 2 <= _SPAN:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        if span < _SPAN:
            low = np.minimum(low[: -(_SPAN - span)], low[_SPAN - span :])
        held = (mask - (low & mask)).astype(np.int64)  # the anchor of the string at each place
        owner = np.repeat(np.arange(first, end), np.diff(self.bounds[first : end + 1]))
        whole = owner[:n] == owner[WIDTH - 1 :]
        start = np.flatnonzero(whole)
        if not len(start):
            none = np.zeros(0, np.int64)
            return none, none.astype(np.uint64), none, none, none
        own = held[start]
        new = np.concatenate([[True], (own[1:] != own[:-1]) | (owner[start[1:]] != owner[start[:-1]])])
        heads = np.flatnonzero(new)
        tails = np.concatenate([heads[1:], [len(own)]]) - 1
        at = own[heads]
        return at + lo, h[at], start[heads] + lo, start[tails] + lo, owner[start[heads]]

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """The sorted hashes (48 bits) of the anchors, and whether each occurs in two documents of this run."""
        h = self.hash >> np.uint64(16)
        order = np.lexsort((self.doc, h))
        h, doc = h[order], self.doc[order]
        heads = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
        tails = np.concatenate([heads[1:], [len(h)]]) - 1 if len(h) else heads
        return h[heads], doc[heads] != doc[tails]

    def suffixes(self, repeated: np.ndarray, keys: np.ndarray) -> dict[str, np.ndarray]:
        """The different suffixes at repeated anchors in order, and the occurrences of each.

        A row holds the bytes from the anchor to the end of the last string held, the bytes before it down to the first
        in reverse, and both lengths.
        """
        use = np.flatnonzero(np.isin(self.hash >> np.uint64(16), repeated))
        p, s1, s2, doc = self.anchor[use], self.first[use], self.last[use], self.doc[use]
        right, left = s2 + WIDTH - p, p - s1
        rows = np.zeros((len(use), _ROW), np.uint8)
        padded = np.concatenate([np.zeros(_LEFT, np.uint8), self.raw, np.zeros(WIDTH, np.uint8)])
        around = np.lib.stride_tricks.sliding_window_view(padded, _LEFT + WIDTH)
        columns = np.arange(WIDTH)
        for a in range(0, len(use), 50_000):
            z = slice(a, a + 50_000)
            near = around[p[z]]
            np.multiply(near[:, _LEFT:], columns < right[z, None], out=rows[z, :WIDTH])
            np.multiply(near[:, _LEFT - 1 :: -1], columns[:_LEFT] < left[z, None], out=rows[z, WIDTH:-2])
        rows[:, -2], rows[:, -1] = right, left + 1
        flat = rows.view(f"S{_ROW}").reshape(-1)
        order = np.argsort(flat, kind="stable")
        flat = flat[order]
        new = np.concatenate([[True], flat[1:] != flat[:-1]]) if len(flat) else np.zeros(0, bool)
        heads = np.flatnonzero(new)
        key = keys[doc[order]]
        least = np.minimum.reduceat(key, heads) if len(heads) else key
        most = np.maximum.reduceat(key, heads) if len(heads) else key
        return {"rows": rows[order][heads], "least": least, "many": least != most, "first": heads, "p": p[order], "doc": doc[order]}


def front_code(rows: np.ndarray) -> tuple[np.ndarray, bytes]:
    """How many bytes each sorted row shares with the one before, and the other bytes."""
    if not len(rows):
        return np.zeros(0, np.uint8), b""
    differ = rows[1:] != rows[:-1]
    shared = np.concatenate([[0], np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])]).astype(np.uint8)
    return shared, rows[np.arange(rows.shape[1]) >= shared[:, None]].tobytes()


def front_decode(shared: np.ndarray, rest: bytes, width: int = _ROW) -> np.ndarray:
    rows = np.zeros((len(shared), width), np.uint8)
    if not len(shared):
        return rows
    flat, shared = np.frombuffer(rest, np.uint8), shared.astype(np.int64)
    start = np.cumsum(width - shared) - width  # where the row's first byte would stand, had it shared none
    for j in range(width):
        own = np.flatnonzero(shared <= j)  # rows that bring their byte here
        rows[:, j] = np.repeat(flat[start[own] + j], np.diff(np.append(own, len(rows))))
    return rows


def merge(runs: list[list[bytes]], shared: list[list[int]], width: int = _ROW) -> tuple[list[int], list[int]]:
    """Merge sorted runs of rows with a loser tree: the run of each row in order, and what it shares with the one before.

    ``shared`` gives that number for each row within its run.  A node of the tree keeps the run that lost there and how much
    its row shares with the winner that passed.  Of two rows that share different lengths with the row put out last, the
    one that shares more is smaller; only rows that share the same length are compared, from that length on.
    """
    k = 1
    while k < max(len(runs), 1):
        k *= 2
    ends = [len(r) for r in runs] + [0] * (k - len(runs))
    at = [0] * k
    order: list[int] = []
    prefix: list[int] = []
    lost = [0] * k
    lost_shared = [0] * k

    def build(node: int) -> tuple[int, int]:
        if node >= k:
            return node - k, 0
        a, _ = build(2 * node)
        b, _ = build(2 * node + 1)
        if at[a] >= ends[a]:
            a, b = b, a
        same = -1
        if at[b] < ends[b]:
            x, y = runs[a][0], runs[b][0]
            diff = int.from_bytes(x, "big") ^ int.from_bytes(y, "big")
            same = width - (diff.bit_length() + 7) // 8
            if y < x:
                a, b = b, a
        lost[node], lost_shared[node] = b, same
        return a, 0

    winner, same = build(1) if k > 1 else (0, 0)
    from_bytes = int.from_bytes
    while at[winner] < ends[winner]:
        order.append(winner)
        prefix.append(same)
        place = at[winner] = at[winner] + 1
        own = winner
        if place < ends[own]:
            same = shared[own][place]
            row = runs[own][place]
        else:
            same, row = -1, b""
        node = (own + k) >> 1
        while node:
            other = lost_shared[node]
            if same < other:
                lost_shared[node], same = same, other
                lost[node], own = own, lost[node]
                row = runs[own][at[own]]
            elif same == other and same >= 0:
                rival = lost[node]
                other_row = runs[rival][at[rival]]
                if same < width:
                    diff = from_bytes(row[same:], "big") ^ from_bytes(other_row[same:], "big")
                    both = width - (diff.bit_length() + 7) // 8
                    if diff and other_row[both] < row[both]:
                        lost[node], own, row = own, rival, other_row
                    lost_shared[node] = both
            node >>= 1
        winner = own
    return order, prefix


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Rows one at a time, so that only one run's payload is held."""
    for i in range(batch.num_rows):
        yield tuple(c[i].as_py() for c in batch.columns)


def _read(payload: bytes) -> pa.Table:
    return pa.ipc.open_stream(payload).read_all()


def _texts(table: pa.Table, text: str) -> list[bytes]:
    return [(s or "").encode() for s in table.column(text).to_pylist()]


def _keys(table: pa.Table, key: str) -> np.ndarray:
    return np.array([_LAST if k is None else k for k in table.column(key).to_pylist()], np.int64)


def _range_of(rows: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """The range of each suffix row among cuts of its first eight bytes."""
    head = np.ascontiguousarray(rows[:, :8]).view(">u8").reshape(-1).astype(np.uint64) if len(rows) else np.zeros(0, np.uint64)
    return np.searchsorted(cuts, head, "right")


def _segments(rows: np.ndarray, shared: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, ...]:
    """The strings of different sorted suffixes as stretches of one smallest document: suffix, first and last offset before
    the anchor, document.

    The string at an offset is what stands that far to the left and the rest to the right, so it has a number for each part:
    how many suffixes before, in the order of the part, differ from their neighbour within it.
    """
    n = len(rows)
    right, left = rows[:, -2].astype(np.int64), rows[:, -1].astype(np.int64) - 1
    before = np.ascontiguousarray(rows[:, WIDTH:-2])
    turned = np.argsort(before.view(f"S{_LEFT}").reshape(-1), kind="stable")
    differ = before[turned][1:] != before[turned][:-1]
    same = np.concatenate([[0], np.where(differ.any(axis=1), differ.argmax(axis=1), _LEFT)])
    values = np.full((n, _SPAN), -1, np.int64)
    held = np.zeros((n, _SPAN), bool)
    of_left = np.zeros(n, np.int64)
    for o in range(_SPAN):
        use = np.flatnonzero((left >= o) & (right >= WIDTH - o))
        if not len(use):
            continue
        of_left[turned] = np.cumsum(same < o)
        key = (np.cumsum(shared < WIDTH - o) * (n + 1) + of_left)[use]
        by = np.argsort(key, kind="stable")
        new = np.concatenate([[True], key[by[1:]] != key[by[:-1]]])
        values[use[by], o] = np.minimum.reduceat(low[use[by]], np.flatnonzero(new))[np.cumsum(new) - 1]
        held[use, o] = True
    new = held.copy()
    new[:, 1:] &= ~held[:, :-1] | (values[:, 1:] != values[:, :-1])
    last = held.copy()
    last[:, :-1] &= ~held[:, 1:] | (values[:, 1:] != values[:, :-1])
    which, first = np.nonzero(new)
    return which, first, np.nonzero(last)[1], values[which, first]


def _answers(runs: dict[int, tuple[np.ndarray, ...]]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each run: entries, first and last offset of strings before their anchors, and the smallest document there."""
    names = list(runs)
    rows = [runs[r][0] for r in names]
    flat = [m.tobytes() for m in rows]
    order, prefix = merge([[x[a : a + _ROW] for a in range(0, len(x), _ROW)] for x in flat], [runs[r][1].tolist() for r in names])
    del flat
    if not order:
        return {}
    order, prefix = np.array(order), np.array(prefix)
    nth = np.zeros(len(order), np.int64)
    for i in range(len(names)):
        own = order == i
        nth[own] = np.arange(own.sum())
    least, many, entry = (np.zeros(len(order), t) for t in (np.int64, bool, np.int64))
    sizes = np.zeros((len(order), 2), np.int64)
    for i, r in enumerate(names):
        own = order == i
        least[own], many[own], entry[own] = runs[r][2], runs[r][3], runs[r][4]
        sizes[own] = rows[i][:, -2:]
    right, left = sizes[:, 0], sizes[:, 1] - 1
    heads = np.flatnonzero(prefix < _ROW)  # different suffixes
    low = np.minimum.reduceat(least, heads)
    context = np.cumsum(prefix < _ROW) - 1
    gram_heads = np.flatnonzero(prefix[heads] < GRAM)
    alone = np.diff(np.append(gram_heads, len(heads))) == 1
    lone = np.repeat(alone, np.diff(np.append(gram_heads, len(heads))))
    # strings of a suffix that is alone with its gram
    out_of = [[] for _ in names]
    use = lone[context] & ((low[context] < least) | many)
    for i in range(len(names)):
        at = np.flatnonzero(use & (order == i))
        out_of[i].append(np.stack([entry[at], WIDTH - right[at], left[at], low[context[at]]], axis=1) if len(at) else np.zeros((0, 4), np.int64))
    # else each string is looked up, some grams at a time
    extra: list[list[np.ndarray]] = [[] for _ in names]
    ends = np.append(heads[1:], len(order))
    bounds = np.append(gram_heads, len(heads))
    several = np.flatnonzero(~alone)
    sizes_of = np.cumsum(bounds[several + 1] - bounds[several])
    for block in np.split(several, np.searchsorted(sizes_of, np.arange(_BLOCK, int(sizes_of[-1]), _BLOCK))) if len(several) else []:
        n_of = bounds[block + 1] - bounds[block]
        c = np.repeat(bounds[block] - np.cumsum(n_of) + n_of, n_of) + np.arange(n_of.sum())
        if not len(c):
            continue
        at = heads[c]
        own_rows = np.zeros((len(c), _ROW), np.uint8)
        for i in range(len(names)):
            own = order[at] == i
            own_rows[own] = rows[i][nth[at[own]]]
        which, o1, o2, value = _segments(own_rows, prefix[at], low[c])
        n = ends[c[which]] - at[which]
        seg = np.repeat(np.arange(len(which)), n)
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + at[which[seg]]
        use = (value[seg] < least[place]) | many[place]
        seg, place = seg[use], place[use]
        told = np.stack([entry[place], o1[seg], o2[seg], value[seg]], axis=1)
        for i in range(len(names)):
            extra[i].append(told[order[place] == i])
    result = {}
    for i, r in enumerate(names):
        rows_out = np.concatenate(out_of[i] + extra[i])
        if len(rows_out):
            result[r] = tuple(rows_out.T)
    return result


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", as_text: bool = False) -> DataFrame:
    """Add kept (binary), n_bytes, n_removed and n_spans to each row.

    Each byte of ``text`` that lies in a string of 50 bytes which also starts in a row with a smaller ``key`` is removed; strings
    are judged on the input and matches never cross rows.  Null texts count as empty; rows with null keys count as later
    than all others and not as earlier than each other, as do rows of equal keys.  Keys are longs.  With ``as_text`` kept is a
    string without the bytes of characters that were cut in two.  A text has at most 2 GB, as a cell of Spark has.  Other
    columns pass; clashing ones are replaced.  :func:`~tessera.llm.common.drop_scratch` removes the table of runs.
    """
    spark = docs.sparkSession
    reach_workers(spark)
    docs = docs.drop("kept", "n_bytes", "n_removed", "n_spans")
    tasks = n_tasks(spark)
    buckets, ranges = 4 * tasks, 2 * tasks

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            lengths = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(text)), 0)).astype(np.int64)
            ends = np.cumsum(lengths)
            first = 0
            while first < batch.num_rows:
                done = ends[first - 1] if first else 0
                n = int(np.searchsorted(ends, done + RUN_BYTES - size, "left")) + 1 - first
                part = batch.slice(first, min(n, batch.num_rows - first))
                held.append(part)
                first += part.num_rows
                size += int(ends[first - 1] - done)
                if size >= RUN_BYTES:
                    yield _as_run(held)
                    held, size = [], 0
        if held:
            yield _as_run(held)

    def _as_run(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        sink = io.BytesIO()
        with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
            writer.write_table(table)
        run = Run(_texts(table, text))
        keys, many = run.keys()
        cut = np.searchsorted(_bucket(keys, buckets), np.arange(buckets + 1))
        packed = [_pack_sorted(keys[a:b]) + b"" for a, b in zip(cut, cut[1:])]
        flags = [np.packbits(many[a:b]).tobytes() for a, b in zip(cut, cut[1:])]
        some = run.anchor[:: max(1, len(run.anchor) // 256)][:256]
        heads = [int.from_bytes(run.raw[p : p + 6].tobytes(), "big") for p in some]
        name = int.from_bytes(os.urandom(8), "big") >> 1
        return pa.RecordBatch.from_arrays(
            [
                pa.array([name], pa.int64()),
                pa.array([sink.getvalue()], pa.large_binary()).cast(pa.binary()),
                pa.array([packed], pa.list_(pa.binary())),
                pa.array([flags], pa.list_(pa.binary())),
                pa.array([heads], pa.list_(pa.int64())),
            ],
            ["run", "payload", "keys", "flags", "heads"],
        )

    made = docs.mapInArrow(gather, "run long, payload binary, keys array<binary>, flags array<binary>, heads array<long>")
    name = f"tessera_runs_{uuid.uuid4().hex}"
    # bucketed by run: later joins leave the payloads where they are
    made.write.bucketBy(2 * tasks, "run").option("path", f"{scratch_dir(spark)}/{name}").option("compression", "none").saveAsTable(name)
    runs = spark.table(name)

    shares = [(i + 1) / ranges for i in range(ranges - 1)]
    cuts = runs.select(F.explode("heads").alias("h")).select(F.percentile_approx("h", shares, 10_000 + 20 * ranges)).first()[0] if shares else []
    cuts = np.unique(np.array(cuts or [], np.uint64)) << np.uint64(16)

    def repeated(group: pa.Table) -> pa.Table:
        own = [_unpack_sorted(x) for x in group.column("packed").to_pylist()]
        twice = [np.unpackbits(np.frombuffer(f, np.uint8), count=len(k)).astype(bool) for f, k in zip(group.column("flag").to_pylist(), own)]
        all_keys, counts = np.unique(np.concatenate(own), return_counts=True)
        known = np.union1d(all_keys[counts > 1], np.concatenate([k[t] for k, t in zip(own, twice)]))
        out = [_pack_sorted(np.intersect1d(k, known, assume_unique=True)) for k in own]
        return pa.table({"run": group.column("run"), "again": pa.array(out, pa.binary())})

    keyed = runs.select("run", F.posexplode(F.arrays_zip("keys", "flags")).alias("bucket", "z")).select(
        "run", "bucket", F.col("z.keys").alias("packed"), F.col("z.flags").alias("flag")
    )
    again = keyed.groupBy("bucket").applyInArrow(repeated, "run long, again binary")
    again = materialise(again.groupBy("run").agg(F.collect_list("again").alias("again")), "repeated")

    def _open(payload: bytes, packed: list[bytes]) -> dict[str, np.ndarray]:
        table = _read(payload)
        known = np.concatenate([_unpack_sorted(x) for x in packed] or [np.zeros(0, np.uint64)])
        return Run(_texts(table, text)).suffixes(known, _keys(table, key))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run_name, payload, packed in _rows(batch):
                found = _open(payload, packed)
                rows = found["rows"]
                cut = np.searchsorted(_range_of(rows, cuts), np.arange(len(cuts) + 2))
                out = []
                for i, (a, b) in enumerate(zip(cut, cut[1:])):
                    if a < b:
                        shared, rest = front_code(rows[a:b])
                        out.append((i, run_name, int(a), _pack(shared), zstandard.ZstdCompressor(level=3).compress(rest), _pack(found["least"][a:b]), np.packbits(found["many"][a:b]).tobytes()))
                # where the suffixes are, for cutting: a group of its own that only passes through
                places = [_pack(found[c].astype(np.uint32)) for c in ("p", "doc", "first")]
                out.append((-1 - run_name, run_name, 0, *places, b""))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["range", "run", "base", "shared", "rest", "least", "many"])

    def combine(group: pa.Table) -> pa.Table:
        own = {}
        if group.num_rows and group.column("range")[0].as_py() < 0:
            return pa.table({"run": group.column("run"), "answer": pa.nulls(group.num_rows, pa.binary()), **{c: group.column(k) for c, k in (("p", "shared"), ("doc", "rest"), ("first", "least"))}})
        for r in group.to_pylist():
            shared = _unpack(r["shared"], np.uint8)
            rows = front_decode(shared, zstandard.ZstdDecompressor().decompress(r["rest"]))
            many = np.unpackbits(np.frombuffer(r["many"], np.uint8), count=len(rows)).astype(bool)
            own[r["run"]] = (rows, shared, _unpack(r["least"], np.int64), many, r["base"] + np.arange(len(rows)))
        found = _answers(own)
        return pa.table({"run": pa.array(list(found), pa.int64()), "answer": pa.array([_pack(np.stack(a, axis=1).reshape(-1)) for a in found.values()], pa.binary()), **{c: pa.nulls(len(found), pa.binary()) for c in ("p", "doc", "first")}})

    joined = runs.select("run", "payload").join(again.hint("shuffle_hash"), "run")
    sent = joined.mapInArrow(send, "range long, run long, base long, shared binary, rest binary, least binary, many binary")
    answers = sent.groupBy("range").applyInArrow(combine, "run long, answer binary, p binary, doc binary, first binary")
    places = (F.first(c, ignorenulls=True).alias(c) for c in ("p", "doc", "first"))
    answers = materialise(answers.groupBy("run").agg(F.collect_list("answer").alias("answers"), *places), "answers")

    def cut_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, payload, told, *places in _rows(batch):
                table = _read(payload)
                bounds, raw = _joined(_texts(table, text))
                marks = np.zeros(len(raw) + 1, np.int32)
                if told:
                    p, doc, first = (_unpack(x, np.uint32).astype(np.int64) for x in places)
                    keys = _keys(table, key)
                    entry, o1, o2, low = np.concatenate([_unpack(x, np.int64).reshape(-1, 4) for x in told]).T
                    heads, ends = first[entry], np.append(first[1:], len(p))[entry]
                    n = ends - heads
                    which = np.repeat(np.arange(len(entry)), n)
                    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + heads[which]
                    later = low[which] < keys[doc[at]]
                    which, at = which[later], at[later]
                    p = p[at]
                    np.add.at(marks, p - o2[which], 1)
                    np.add.at(marks, p - o1[which] + WIDTH, -1)
                np.cumsum(marks, out=marks)
                gone = marks[:-1] > 0
                del marks
                kept, removed, spans = [], [], []
                for a, b in zip(bounds, bounds[1:]):
                    own = gone[a:b]
                    n = int(own.sum())
                    removed.append(n)
                    spans.append(int(own[:1].sum() + (own[1:] & ~own[:-1]).sum()) if n else 0)
                    left = (raw[a:b][~own] if n else raw[a:b]).tobytes()
                    kept.append(left.decode("utf-8", "ignore") if as_text else left)
                out = table.append_column("kept", pa.array(kept, pa.string() if as_text else pa.binary()))
                for c, values in (("n_bytes", np.diff(bounds)), ("n_removed", removed), ("n_spans", spans)):
                    out = out.append_column(c, pa.array(values, pa.int64()))
                yield from out.combine_chunks().to_batches(max_chunksize=2_000)

    joined = runs.select("run", "payload").join(answers.hint("shuffle_hash"), "run", "left")
    schema = T.StructType(
        [*docs.schema.fields, T.StructField("kept", T.StringType() if as_text else T.BinaryType()), *(T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans"))]
    )
    return joined.mapInArrow(cut_texts, schema)


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of sorted 48-bit hashes: ranges of equal width."""
    return ((keys >> np.uint64(16)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
