"""From raw documents to packed training sequences: five stages, each written before the next reads it.

Each stage takes (spark, docs, sf_dir) and returns a frame; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import near_dup, packing, quality_model, suffix_dedup, toxicity
from tessera.llm.common import materialise
from tessera.llm.queries import BYTE_BPE

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; it learns from the documents it is given.

    Null and empty texts are judged like others.  Without a labelled document to learn from nothing is rejected.
    """
    model = quality_model.fit(docs, _labels(spark, sf_dir))
    if not model.learned:
        return docs.select(*COLUMNS)
    return quality_model.classify(docs, model).where("predicted = 1").select(*COLUMNS)


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject: all of them where no label says what is toxic.

    Null and empty texts have no windows and stay.
    """
    model = toxicity.fit(docs, _labels(spark, sf_dir))
    return toxicity.classify(docs, model).where("predicted = 0").select(*COLUMNS)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document, by doc_id, of each near-duplicate group; of rows that repeat an id and a text one stays.

    Null and empty texts are one group.
    """
    return near_dup.near_duplicates(docs).where("is_first").select(*COLUMNS)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the byte strings that earlier ones have.

    Bytes of a character that was cut in two are left out; n_chars is counted anew.  Every row stays, also one of which
    nothing is left; null texts become empty.
    """
    cut = suffix_dedup.remove_repeats(docs, as_text=True).withColumn("text", F.col("kept"))
    return cut.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of 1024 tokens; an empty one has one piece of one token."""
    return packing.pack(packing.pieces(docs.select("doc_id", "text"), BYTE_BPE))


STAGES = [
    ("quality", quality),
    ("toxicity", without_toxic),
    ("near duplicates", without_near_duplicates),
    ("repeats", without_repeats),
    ("packing", packed),
]

#: No stage can be put in SQL: tests/llm/test_pipeline.py holds each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
