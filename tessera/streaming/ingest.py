"""New documents as a stream: micro-batches go through the same plans as batches.

Ids are hashes of contents, so a batch that is run again after a lost executor changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tessera.operators import mutations
from tessera.plans.engine import contents
from tessera.sources.scratch import materialise
from tessera.sources.tables import Store


class ProgressLog(StreamingQueryListener):
    """Writes a row for each micro-batch of a store's streams that had input: name, batch, rows read (twice what came,
    as a batch is read for its ids and again for its texts), rows a second."""

    def __init__(self, store: Store):
        self.store = store

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.numInputRows:
            row = {"run": str(p.runId), "name": p.name or "", "batch": p.batchId, "at": p.timestamp, "n_rows": p.numInputRows, "rows_a_second": p.processedRowsPerSecond}
            self.store.put(self.store.at("_progress", f"{p.runId}-{p.batchId}.json"), row, replace=True)

    def onQueryTerminated(self, event) -> None:
        pass


def progress(store: Store) -> DataFrame:
    """The rows of :class:`ProgressLog`."""
    columns = "run string, name string, batch long, at string, n_rows long, rows_a_second double"
    return store.spark.read.schema(columns).json(store.at("_progress")) if store.names(store.at("_progress")) else store.spark.createDataFrame([], columns)


def enqueue_stream(spark: SparkSession, source: str, schema: str, store: Store, checkpoint: str) -> StreamingQuery:
    """Follow Parquet files (pos, text, file_path) under a directory until none is left; each batch adds cleaned texts to
    full_docs and rows to doc_status of a store, in one commit."""

    def batch(df: DataFrame, _: int) -> None:
        t = store.begin("enqueue-stream")
        queued = materialise(mutations.enqueue(df, t.read("full_docs")), "queued")
        states = queued.select(
            "id", "status", "content_summary", F.col("content_length").cast("int").alias("content_length"), F.lit(0).alias("chunks_count"), F.array().cast("array<string>").alias("chunks_list"),
            F.current_timestamp().alias("created_at"), F.current_timestamp().alias("updated_at"), "file_path", F.lit(None).cast("string").alias("track_id"), F.lit(None).cast("string").alias("error_msg"),
            F.create_map(F.lit("original"), F.coalesce("original_id", F.lit(""))).alias("metadata"),
        )
        t.change("doc_status", states)
        t.change("full_docs", contents(df, queued))
        t.publish("enqueue stream")

    stream = spark.readStream.schema(schema).parquet(source)
    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def event_counts(events: DataFrame, delay: str = "10 minutes", window: str = "1 hour") -> DataFrame:
    """Counts and sums of an event stream by window and type, closed by a watermark; also for batches."""
    rows = events.withWatermark("ts", delay) if events.isStreaming else events
    g = rows.groupBy(F.window("ts", window), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return g.select(F.col("window.start").alias("start"), "event_type", "n", "total")
