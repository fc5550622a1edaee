"""Changes of tables as plans: each gives the table that comes after."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.ids import content_id
from tessera.functions.text import file_path, sanitize, summary
from tessera.operators.ranking import last_write, numbered
from tessera.sources.scratch import materialise


def upsert(table: DataFrame, new: DataFrame, now: int, key: str = "id", pos: str = "pos") -> DataFrame:
    """New rows replace old ones of their key; create_time stays, update_time is ``now``; of repeated keys the last counts."""
    last = last_write(new, [key], pos).drop(pos)
    times = table.select(key, F.col("create_time").alias("__created"))
    fresh = last.join(times, key, "left").withColumn("create_time", F.coalesce("__created", F.lit(now))).withColumn("update_time", F.lit(now)).drop("__created")
    return table.join(last.select(key), key, "left_anti").unionByName(fresh.select(*table.columns))


def delete(table: DataFrame, gone: DataFrame, key: str = "id") -> DataFrame:
    return table.join(gone.select(key), key, "left_anti")


def enqueue(texts: DataFrame, full_docs: DataFrame, text: str = "text", path: str = "file_path", pos: str = "pos") -> DataFrame:
    """Status rows of offered texts (pos, text, file_path): a first text is pending under the md5 of its clean content; a text
    that came before or is stored is a failed duplicate, with an id of its own that names the original.  Positions may repeat;
    of texts at one position the one with the smaller path counts as first."""
    clean = texts.withColumn("content", sanitize(text)).withColumn("doc_id", content_id("content", "doc-"))
    # ids and summaries alone go on, so that texts are cleaned once and never move
    rows = clean.select(pos, "doc_id", summary("content").alias("content_summary"), F.char_length("content").alias("content_length"), file_path(path).alias("file_path"))
    nth = F.row_number().over(Window.partitionBy("doc_id", pos).orderBy("file_path"))
    rows = materialise(rows.withColumn("__nth", nth), "cleaned")
    first = rows.groupBy("doc_id").agg(F.min(pos).alias("__first"))
    stored = full_docs.select(F.col("id").alias("doc_id"), F.lit(True).alias("__stored")).distinct()
    rows = rows.join(first, "doc_id").join(stored, "doc_id", "left")
    again = F.col("__stored").isNotNull() | (F.col(pos) != F.col("__first")) | (F.col("__nth") > 1)
    more = F.when(F.col("__nth") > 1, F.concat(F.lit("-"), F.col("__nth").cast("string"))).otherwise(F.lit(""))
    dup = content_id(F.concat("doc_id", F.lit("-"), F.col(pos).cast("string"), more), "dup-")
    return rows.select(
        F.when(again, dup).otherwise(F.col("doc_id")).alias("id"), F.when(again, "failed").otherwise("pending").alias("status"), "content_summary", "content_length", "file_path",
        F.when(again, F.col("doc_id")).alias("original_id"), pos,
    )


def enqueue_errors(files: DataFrame) -> DataFrame:
    """Failed status rows of files (file_path, error) that could not be read."""
    return files.select(content_id("file_path", "error-").alias("id"), F.lit("failed").alias("status"), "file_path", F.col("error").alias("error_msg"))


def repair(status: DataFrame, full_docs: DataFrame) -> DataFrame:
    """Status rows after repair: rows without content go unless they failed; stuck rows wait again."""
    kept = status.join(full_docs.select("id", F.lit(True).alias("__has")), "id", "left").where("__has or status = 'failed'").drop("__has")
    stuck = F.col("status").isin("processing", "preprocessed")
    return kept.withColumn("status", F.when(stuck, F.lit("pending")).otherwise(F.col("status")))


def deletion_impact(objects: DataFrame, chunks: DataFrame, key: str = "entity", source: str = "source_id") -> DataFrame:
    """(key, action, n_left) of objects' sources (key, source_id) when chunks (source_id) go: delete, rebuild or keep."""
    gone = chunks.select(source).distinct().withColumn("__gone", F.lit(True))
    rows = objects.select(key, source).distinct().join(gone, source, "left")
    counted = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.count("__gone").alias("g"))
    action = F.when(F.col("g") == 0, "keep").when(F.col("g") == F.col("n"), "delete").otherwise("rebuild")
    return counted.select(key, action.alias("action"), (F.col("n") - F.col("g")).alias("n_left"))


def reference_decisions(contributions: DataFrame, document: str) -> DataFrame:
    """(object_id, decision): what a document's objects come to when it goes: objects others still support are kept."""
    own = contributions.where(F.col("document_id") == document).select("object_id").distinct()
    others = contributions.where((F.col("document_id") != document) & F.col("active")).groupBy("object_id").agg(F.count(F.lit(1)).alias("n"))
    rows = own.join(others, "object_id", "left")
    return rows.select("object_id", F.when(F.coalesce("n", F.lit(0)) == 0, "DELETE").otherwise("KEEP").alias("decision"), F.coalesce("n", F.lit(0)).alias("n_active"))


def append_cache_keys(chunks: DataFrame, new: DataFrame) -> DataFrame:
    """Chunks (chunk_id, llm_cache_list) with new keys (chunk_id, key) added once each."""
    more = new.groupBy("chunk_id").agg(F.array_sort(F.collect_set("key")).alias("__keys"))
    return chunks.join(more, "chunk_id", "left").withColumn("llm_cache_list", F.array_union("llm_cache_list", F.coalesce("__keys", F.array().cast("array<string>")))).drop("__keys")


def clean_query_cache(cache: DataFrame, kinds: str = "all") -> DataFrame:
    """A cache without rows of queries, keywords, or both, in any mode but the default."""
    kind = F.split("key", ":")[1]
    gone = {"all": ("query", "keywords"), "query": ("query",), "keywords": ("keywords",)}[kinds]
    return cache.where(~((F.split("key", ":")[0] != "default") & kind.isin(*gone)))


def version_plan(changes: DataFrame) -> DataFrame:
    """(step, action, stable_id) that bring a store from one document version to the next (stable_id, change): writes,
    then checks, activations, deactivations and deletions, each in the order of ids."""
    spark = changes.sparkSession
    steps = spark.createDataFrame([("ADDED", 0, "WRITE"), ("UPDATED", 0, "WRITE"), ("ADDED", 2, "ACTIVATE"), ("UPDATED", 2, "ACTIVATE"), ("UPDATED", 3, "DEACTIVATE_OLD"), ("REMOVED", 3, "DEACTIVATE_OLD"), ("REMOVED", 4, "DELETE")], "change string, phase int, action string")
    rows = changes.join(F.broadcast(steps), "change")  # seven rows
    return numbered(rows, "step", "phase", "stable_id", "action").select("step", "action", "stable_id")
