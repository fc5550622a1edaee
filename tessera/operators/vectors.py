"""Vector tables (id, vector, ...): exact similarity search in blocks, restricted scoring, maintenance."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.ids import content_id, cosine

THRESHOLD = 0.2
#: Queries that are scored against a batch at once; more are scored block by block.
QUERY_BLOCK = 2_048


def search(vectors: DataFrame, queries: DataFrame, k: int = 40, threshold: float = THRESHOLD, column: str = "vector") -> DataFrame:
    """(query_id, id, similarity, rank) of the ``k`` most similar rows of each query at or above a threshold; ties by id.

    The queries (query_id, vector) are a stated set that is read to the driver: its vectors must fit there and in a task.  The
    table is read once: each task multiplies its batches with the queries, block by block, and keeps of each query the ``k``
    best of all its batches (ties at the edge with them), so at most that many a task are exchanged.
    """
    spark = vectors.sparkSession
    rows = queries.select("query_id", F.col(column).alias("v")).orderBy("query_id").collect()
    q = np.array([r["v"] for r in rows], np.float64) if rows else np.zeros((0, 1))
    norms = np.linalg.norm(q, axis=1, keepdims=True)
    shared = spark.sparkContext.broadcast(([r["query_id"] for r in rows], q / np.where(norms == 0, 1, norms)))
    kinds = dict(queries.dtypes)["query_id"], dict(vectors.dtypes)["id"]
    out = vectors.select("id", column).mapInArrow(_best(shared, k, threshold, kinds), f"query_id {kinds[0]}, id {kinds[1]}, similarity double")
    w = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "id")
    return out.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def matrix(lists: pa.Array) -> np.ndarray:
    """Lists of one length as rows of doubles, without an object for each number."""
    flat = lists.flatten()
    if lists.null_count or flat.null_count or len(set(lists.value_lengths().unique().to_pylist())) != 1:
        return np.array(lists.to_pylist(), np.float64)
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)


_ARROW = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}


def _best(shared, k: int, threshold: float, kinds: tuple[str, str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, q = shared.value
        best: list[tuple[np.ndarray, list]] = [(np.zeros(0), [])] * len(ids)
        for batch in batches:
            if not batch.num_rows or not ids:
                continue
            own = batch.column(0).to_pylist()
            v = matrix(batch.column(1))
            norm = np.linalg.norm(v, axis=1, keepdims=True)
            v = (v / np.where(norm == 0, 1, norm)).T
            for first in range(0, len(ids), QUERY_BLOCK):
                for i, s in enumerate(q[first : first + QUERY_BLOCK] @ v, first):
                    near = np.flatnonzero(s >= threshold)
                    if not len(near):
                        continue
                    sims, names = np.concatenate([best[i][0], s[near]]), best[i][1] + [own[j] for j in near]
                    if len(sims) > k:
                        # ties at the edge all stay, so that ids can break them
                        kept = np.flatnonzero(sims >= np.partition(sims, len(sims) - k)[len(sims) - k])
                        sims, names = sims[kept], [names[j] for j in kept]
                    best[i] = (sims, names)
        for first in range(0, len(ids), 256):
            rows = [(ids[i], n, float(s)) for i in range(first, min(first + 256, len(ids))) for s, n in zip(*best[i])]
            if rows:
                types = (*(_ARROW[t] for t in kinds), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["query_id", "id", "similarity"])

    return run


def among(vectors: DataFrame, candidates: DataFrame, query: list[float], k: int) -> DataFrame:
    """The ``k`` most similar of candidate ids; no row at all if a candidate lacks a vector (the caller then falls back)."""
    rows = candidates.select("id").distinct().join(vectors.select("id", "vector"), "id", "left")
    lacking = rows.agg(F.coalesce(F.bool_or(F.col("vector").isNull()), F.lit(False)).alias("lacking"))
    q = F.array(*[F.lit(float(x)) for x in query])
    scored = rows.where(F.col("vector").isNotNull()).select("id", cosine("vector", q).alias("similarity"))
    kept = scored.join(F.broadcast(lacking), ~F.col("lacking")).drop("lacking")  # one row
    return kept.orderBy(F.desc("similarity"), "id").limit(k)


def upsert(vectors: DataFrame, new: DataFrame, embed: Callable[[list[str]], np.ndarray], dimension: int) -> DataFrame:
    """The table with new rows (id, content) embedded in batches; an id that was there is replaced."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.asarray(embed(batch.column(1).to_pylist()), np.float32)
            if made.shape != (batch.num_rows, dimension):
                raise ValueError(f"the embedding function gave {made.shape}, not {(batch.num_rows, dimension)}")
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made.tolist(), pa.list_(pa.float32()))], ["id", "content", "vector"])

    fresh = new.select("id", "content").mapInArrow(run, "id string, content string, vector array<float>")
    return vectors.select("id", "content", "vector").join(fresh.select("id"), "id", "left_anti").unionByName(fresh)


def without_entity(vectors: DataFrame, name: str) -> DataFrame:
    return vectors.where(F.col("id") != content_id(F.lit(name), "ent-"))


def without_relations_of(vectors: DataFrame, name: str) -> DataFrame:
    return vectors.where((F.col("src_id") != name) & (F.col("tgt_id") != name))
