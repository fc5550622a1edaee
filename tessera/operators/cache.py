"""The model's answers kept by prompt: probes, writes, and calls of what is not there."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.ids import args_hash, cache_key
from tessera.functions.text import without_thinking
from tessera.operators.ranking import first_of
from tessera.sources.scratch import materialise


def keyed(calls: DataFrame, prompt: str = "prompt") -> DataFrame:
    """Calls (mode, cache_type, prompt) with their cache key."""
    return calls.withColumn("key", cache_key("mode", "cache_type", args_hash(prompt)))


def probe(calls: DataFrame, cache: DataFrame, modes: tuple[str, ...] | None = None) -> DataFrame:
    """Keyed calls with content and create_time of their hit, nulls without one; modes that are not named are not looked up."""
    found = cache.select("key", F.col("return").alias("content"), F.coalesce("create_time", F.lit(0)).alias("create_time"))
    if modes is not None:
        found = found.where(F.split("key", ":")[0].isin(*modes))
    return calls.join(found, "key", "left")


def write(cache: DataFrame, answers: DataFrame, now: int) -> DataFrame:
    """The cache with answers (key, content, cache_type, prompt, pos); empty ones and those that it has already change nothing.

    Of answers to one key the last counts; a key keeps its create_time.
    """
    last = first_of(answers.where("content <> ''"), ["key"], F.desc("pos"))
    old = cache.select("key", F.col("return").alias("__old"), F.col("create_time").alias("__created"))
    new = last.join(old, "key", "left").where(F.col("__old").isNull() | (F.col("__old") != F.col("content")))
    time = F.lit(now).cast("long")
    new = new.select("key", F.col("content").alias("return"), "cache_type", F.col("prompt").alias("original_prompt"), F.coalesce("__created", time).alias("create_time"), time.alias("update_time"))
    return cache.join(new.select("key"), "key", "left_anti").unionByName(new)


def answer(calls: DataFrame, cache: DataFrame, model: Callable[[list[str]], list[str]], now: int) -> tuple[DataFrame, DataFrame]:
    """Calls (pos, mode, cache_type, prompt) with their content and whether it was kept, and the cache that comes after.

    The model sees each different prompt that has no hit once, in batches; thinking is taken off its answers.  They are written
    before they are used, so a lost task asks only for its own again.
    """
    rows = probe(keyed(calls), cache)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(model(batch.column(2).to_pylist()), pa.string())], ["key", "cache_type", "prompt", "content"])

    asked = rows.where("content is null").groupBy("key").agg(F.first("cache_type").alias("cache_type"), F.first("prompt").alias("prompt"))
    made = asked.mapInArrow(run, "key string, cache_type string, prompt string, content string").withColumn("content", without_thinking("content"))
    made = materialise(made.withColumn("pos", F.lit(0)), "answers")
    fresh = made.select("key", F.col("content").alias("__made"))
    out = rows.join(fresh, "key", "left").withColumn("hit", F.col("content").isNotNull()).withColumn("content", F.coalesce("content", "__made")).drop("__made")
    return out, write(cache, made, now)
