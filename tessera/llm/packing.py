"""Best-fit packing of token pieces into sequences, in bulk-synchronous rounds.

Pieces are range-sorted by length once, which gives each a rank among those of its length.  Pieces of one length are alike,
and so are gaps of one size, so both are kept as runs: so many pieces of a length from some rank on, so many sequences,
numbered without holes, that all have the same room left.  Both tables stay small beside the pieces (6,680 placements of
476,262 pieces in one measurement), and each is a table of Spark.

A round range-sorts gaps and pieces together by size and sweeps each range from the largest size down: a piece takes its
successor, the smallest gap at or above its size that no longer piece has taken.  Where more pieces want gaps than there
are, the longer ones and then the lower ranks win, and the rest stay for the next round.  Gaps that took a piece shrink and
return in the next round.  What ranges could not match by themselves meets in a sweep over all sizes.  When no piece fits
anywhere, as many sequences open as the tokens left need at least, each with one of the longest.  The driver keeps counters
alone.  Rows of pieces move only in the first sort; at the end each finds its run by length and rank.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import reduce
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm import bpe
from tessera.llm.common import materialise, n_tasks, reach_workers, worker_slot

CAPACITY = 1024
LONG_SPACE = 10_000
END = 2

PIECES = T.ArrayType(
    T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())])
)


class _Ranked(bpe.Vocabulary):
    """The same ids with the words' merges left to tiktoken, where ranks and ids of the vocabulary agree."""

    def __init__(self, path: str):
        super().__init__(path)
        ranks = {raw: i for i, raw in self.bytes_of.items() if i not in self.special.values()}
        self.long_space = regex.compile(r"\s{%d,}+" % LONG_SPACE)
        in_order = sorted(self.merges.values())
        self.engine = None
        if all(a >> bpe._AT_BITS & bpe._ID < b >> bpe._AT_BITS & bpe._ID for a, b in zip(in_order, in_order[1:])) and len(ranks) == 256 + len(in_order):
            self.engine = tiktoken.Encoding("file", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_ordinary

    def _whole(self, text: str) -> bytes:
        if not self.engine:
            return super()._whole(text)
        # the engine's pattern keeps a state for each white-space character of a run, so long runs are words of their own here
        out, start = [], 0
        for run in self.long_space.finditer(text):
            end = run.end() - (run.end() < len(text))  # the last one belongs to what follows
            out += [array("I", self.engine(text[start : run.start()])).tobytes(), self._word(text[run.start() : end])]
            start = end
        out.append(array("I", self.engine(text[start:])).tobytes())
        return b"".join(out)


def _vocabulary(path: str) -> _Ranked:
    return worker_slot("packing", path, lambda: _Ranked(path))


def cut(n: int, capacity: int) -> Iterator[tuple[int, int]]:
    """(start, length) of a document's pieces: all of the full capacity but the first, which has the rest."""
    start, length = 0, (n - 1) % capacity + 1
    while start < n:
        yield start, length
        start, length = start + length, capacity


def pieces(df: DataFrame, vocab_path: str, text: str = "text", capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """One row a piece: the columns of ``df`` without ``text``, and piece, start, length and ids_crc32.

    Ids of a text are followed by the id ``end``, so null and empty texts have one piece of one token.  Clashing columns
    are replaced.
    """
    reach_workers(df.sparkSession)
    mark = array("I", [end]).tobytes()

    @F.arrow_udf(PIECES)
    def made(texts: pa.Array) -> pa.Array:
        v = _vocabulary(vocab_path)
        ends, starts, lengths, sums = [0], [], [], []
        for s in texts.to_pylist():
            ids = v.encode(s or "") + mark
            for start, length in cut(len(ids) // 4, capacity):
                starts.append(start)
                lengths.append(length)
                sums.append(crc32(ids[4 * start : 4 * (start + length)]))
            ends.append(len(starts))
        rows = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (starts, lengths, sums)], ["start", "length", "ids_crc32"])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows)

    kept = [c for c in df.columns if c not in (text, "piece", "start", "length", "ids_crc32")]
    return df.select(*kept, F.posexplode(made(F.col(text))).alias("piece", "__piece")).select(*kept, "piece", "__piece.*")


STATE = "kind int, size long, n long, first long, sequence long, offset long"
_GAP, _PIECE, _PLACED = 0, 1, 2
RANGES = 8
UNION = 12
PLAN_ROWS = 200_000  # a larger plan is not broadcast


def sweep(rows: list[tuple[int, int, int, int]], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Match runs (kind, size, n, first) in order of falling size, gaps before pieces of their size.

    Gives rows of :data:`STATE`: what is left of gaps and pieces, gaps that took a piece at their new size, and placements:
    pieces of a size from rank ``first`` on, in sequences from ``sequence`` on, at ``offset``.
    """
    open_: list[list[int]] = []  # the last one is the smallest
    out = []
    for kind, size, n, first in rows:
        if kind == _GAP:
            open_.append([size, n, first])
            continue
        while n and open_:
            gap, n_gaps, sequence = open_[-1]
            k = min(n, n_gaps)
            out.append((_PLACED, size, k, first, sequence, capacity - gap))
            if gap > size:
                out.append((_GAP, gap - size, k, sequence, None, None))
            n, first = n - k, first + k
            if k < n_gaps:
                open_[-1] = [gap, n_gaps - k, sequence + k]
            else:
                open_.pop()
        if n:
            out.append((_PIECE, size, n, first, None, None))
    return out + [(_GAP, *gap, None, None) for gap in open_]


def best_fit(pieces_of: DataFrame, capacity: int = CAPACITY) -> tuple[DataFrame, int]:
    """Placements (rows of :data:`STATE`) of runs of pieces (size, n), and the number of sequences.

    Sizes lie between 1 and ``capacity`` and are each in one row.  An empty table has no placements.
    """
    spark = pieces_of.sparkSession

    def swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns))]
        columns = list(zip(*sweep(rows, capacity))) or [[]] * 6
        kinds = [pa.int32()] + [pa.int64()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [x.split()[0] for x in STATE.split(", ")])

    def counted(df: DataFrame) -> tuple[int, int, int]:
        is_piece = F.col("kind") == _PIECE
        r = df.agg(F.count_if(F.col("kind") == _PLACED), F.sum(F.when(is_piece, F.col("n"))), F.sum(F.when(is_piece, F.col("n") * F.col("size")))).first()
        return r[0], r[1] or 0, r[2] or 0

    nothing = F.lit(None).cast("long")
    state = pieces_of.select(F.lit(_PIECE).alias("kind"), "size", "n", F.lit(0).cast("long").alias("first"), nothing.alias("sequence"), nothing.alias("offset"))
    state = materialise(state, "runs")
    placed: list[DataFrame] = []
    _, n_left, tokens = counted(state)
    opened, n_ranges, idle = 0, RANGES, True
    while n_left:
        if idle and n_ranges == 1 or not opened:
            need = -(-tokens // capacity)
            before = F.coalesce(F.sum("n").over(Window.orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
            # at most one row a size
            longest = state.where(F.col("kind") == _PIECE).withColumn("before", before).withColumn("k", F.greatest(F.lit(0), F.least("n", F.lit(need) - F.col("before"))))
            start = F.when(F.col("k") > 0, F.array(
                F.struct(F.lit(_PLACED).alias("kind"), "size", F.col("k").alias("n"), "first", (F.lit(opened) + F.col("before")).alias("sequence"), F.lit(0).cast("long").alias("offset")),
                F.struct(F.lit(_GAP).alias("kind"), (F.lit(capacity) - F.col("size")).alias("size"), F.col("k").alias("n"), (F.lit(opened) + F.col("before")).alias("first"), nothing.alias("sequence"), nothing.alias("offset")),
            ))
            rest = F.struct(F.lit(_PIECE).alias("kind"), "size", (F.col("n") - F.col("k")).alias("n"), (F.col("first") + F.col("k")).alias("first"), nothing.alias("sequence"), nothing.alias("offset"))
            rows = longest.select(F.inline(F.concat(F.coalesce(start, F.array().cast("array<struct<kind:int,size:bigint,n:bigint,first:bigint,sequence:bigint,offset:bigint>>")), F.array(rest))))
            after = rows.where("n > 0 and size > 0").unionByName(state.where(F.col("kind") == _GAP))
            opened += min(need, n_left)
            n_ranges = RANGES
        else:
            n_ranges = 1 if idle else n_ranges
            rows = state.select("kind", "size", "n", "first")
            rows = rows.repartitionByRange(n_ranges, F.desc("size")) if n_ranges > 1 else rows.coalesce(1)
            after = rows.sortWithinPartitions(F.desc("size"), "kind").mapInArrow(swept, STATE)
        after = materialise(after, "runs")
        n_placed, n_left, tokens = counted(after)
        placed.append(after.where(F.col("kind") == _PLACED))
        if len(placed) == UNION:  # plans over the placements stay small, however many rounds there are
            placed = [materialise(reduce(DataFrame.unionByName, placed).coalesce(RANGES), "placed")]
        state = after.where(F.col("kind") != _PLACED)
        idle = not n_placed
    return reduce(DataFrame.unionByName, placed, state.limit(0)), opened


def pack(items: DataFrame, length: str = "length", capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset (longs) to each row: its place among sequences of at most ``capacity``.

    Offsets in a sequence have no gaps.  Rows of one length take places in the order of a number given to each row before
    the sort, so repeated rows have places of their own.  Rows whose length is null, less than 1 or more than ``capacity``
    have no place: both columns are null.  An empty table gives no rows.  Other columns pass; clashing ones are replaced.
    """
    spark = items.sparkSession
    reach_workers(spark)
    items = items.drop("sequence_id", "offset")
    at = items.columns.index(length)
    items = materialise(items.withColumn("__row", F.monotonically_increasing_id()), "pieces")
    fits = F.coalesce(F.col(length).between(1, capacity), F.lit(False))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            sizes = np.asarray(batch.column(at))
            ranks = np.zeros(len(sizes), np.int64)
            for size in np.unique(sizes):
                own = sizes == size
                ranks[own] = seen[size] + np.arange(own.sum())
                seen[size] += own.sum()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ranks)], [*batch.schema.names, "__rank"])

    ordered = items.where(fits).repartitionByRange(2 * n_tasks(spark), F.desc(length), "__row").sortWithinPartitions(F.desc(length), "__row")
    schema = T.StructType([*ordered.schema.fields, T.StructField("__rank", T.LongType())])
    ranked = ordered.mapInArrow(number, schema).withColumn("__part", F.spark_partition_id())
    ranked = materialise(ranked, "ranked")
    # a range partition holds neighbouring lengths: a row for each length and partition, capacity + partitions at most
    parts = materialise(ranked.groupBy(F.col(length).cast("long").alias("size"), "__part").agg(F.count(F.lit(1)).alias("n")), "lengths")
    before = F.sum("n").over(Window.partitionBy("size").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    base = parts.select(F.col("size").alias("__size"), F.col("__part").alias("__p"), F.coalesce(before, F.lit(0)).alias("__before"))
    plan, _ = best_fit(parts.groupBy("size").agg(F.sum("n").alias("n")), capacity)
    # a row a length: its runs by first rank, so that each piece finds its own by halving and meets no other
    run = F.struct("first", "sequence", "offset")
    plan = plan.groupBy(F.col("size").alias("__len")).agg(F.array_sort(F.collect_list(run)).alias("__runs"))
    total, most = plan.agg(F.sum(F.size("__runs")), F.max(F.size("__runs"))).first()
    small = F.broadcast if (total or 0) <= PLAN_ROWS else lambda df: df
    steps = F.array(*(F.lit(1 << i) for i in reversed(range((most or 1).bit_length()))))
    last = F.aggregate(steps, F.lit(0), lambda at, step: F.when((at + step <= F.size("__runs")) & (F.try_element_at("__runs", at + step)["first"] <= F.col("__at")), at + step).otherwise(at))
    ranked = ranked.join(F.broadcast(base), (F.col(length) == F.col("__size")) & (F.col("__part") == F.col("__p")))
    ranked = ranked.withColumn("__at", F.col("__before") + F.col("__rank"))
    columns = [c for c in items.columns if c != "__row"]
    placed = ranked.join(small(plan), F.col(length) == F.col("__len")).withColumn("__run", F.element_at("__runs", last))
    placed = placed.select(*columns, (F.col("__run.sequence") + F.col("__at") - F.col("__run.first")).alias("sequence_id"), F.col("__run.offset").alias("offset"))
    none = F.lit(None).cast("long")
    return placed.unionByName(items.where(~fits).select(*columns, none.alias("sequence_id"), none.alias("offset")))
