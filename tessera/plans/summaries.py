"""Long lists of descriptions made short by a model of the caller, in rounds."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import SEP, keyword_lists
from tessera.operators import cache
from tessera.operators.chunking import words
from tessera.sources.scratch import materialise


def summarise(
    rows: DataFrame, key: str, model: Callable[[list[list[str]]], list[str]], few: int = 8, short: int = 1_200, window: int = 12_000
) -> DataFrame:
    """(key, description, asked) of rows (key, pos, description): descriptions of a key in the order of ``pos``, as one text.

    Fewer than ``few`` of at most ``short`` tokens are joined as they are.  Else each round deals a key's descriptions, two at
    least, into windows of tokens; the model makes one text of each window, and the texts are the descriptions of the next
    round, until they are few and short or one.  A window is at most so many tokens and a row of the next round, so no task
    holds more than that of a key.  Empty descriptions drop out; a key without any has no row.
    """
    left = rows.where("description <> ''").select(key, F.col("pos").cast("long").alias("pos"), "description")
    left = materialise(left.withColumn("tokens", F.size(words("description"))).withColumn("asked", F.lit(False)), "descriptions")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "description"))), lambda x: x["description"]), SEP)
    done: DataFrame | None = None

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(model(b.column(2).to_pylist()), pa.string())], [key, "pos", "description"])

    while True:
        sizes = left.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.sum("tokens").alias("total"), F.bool_or("asked").alias("was_asked"))
        sizes = materialise(sizes.withColumn("is_done", (F.col("n") == 1) & (F.col("was_asked") | (F.col("total") <= short)) | (F.col("n") < few) & (F.col("total") <= short)), "sizes")
        ready = left.join(sizes.where("is_done"), key).groupBy(key).agg(joined.alias("description"), F.first("was_asked").alias("asked"))
        done = ready if done is None else done.unionByName(ready)
        if sizes.where("not is_done").isEmpty():
            return done
        rest = left.join(sizes.where("not is_done").select(key), key, "left_semi")
        w = Window.partitionBy(key).orderBy("pos")
        # windows of tokens, each of two descriptions at least where there are two
        by_tokens = F.floor((F.sum("tokens").over(w.rowsBetween(Window.unboundedPreceding, 0)) - 1) / window)
        by_pairs = F.floor((F.row_number().over(w) - 1) / 2)
        part = rest.withColumn("part", F.least(by_tokens, by_pairs))
        asked = part.groupBy(key, F.col("part").cast("long").alias("pos")).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "description"))), lambda x: x["description"]).alias("texts"))
        made = asked.select(key, "pos", "texts").mapInArrow(ask, f"{key} {dict(rows.dtypes)[key]}, pos long, description string")
        left = materialise(made.withColumn("tokens", F.size(words("description"))).withColumn("asked", F.lit(True)), "descriptions")


def keywords(questions: DataFrame, kept: DataFrame, model: Callable[[list[str]], list[str]], now: int = 0) -> tuple[DataFrame, DataFrame]:
    """Questions (pos, mode, prompt) with high_level_keywords and low_level_keywords from kept or new answers, and the cache after."""
    found, after = cache.answer(questions.withColumn("cache_type", F.lit("keywords")), kept, model, now)
    parsed = found.withColumn("k", keyword_lists("content"))
    none = F.array().cast("array<string>")
    return parsed.select("pos", F.coalesce("k.high_level_keywords", none).alias("high_level_keywords"), F.coalesce("k.low_level_keywords", none).alias("low_level_keywords"), "hit"), after
