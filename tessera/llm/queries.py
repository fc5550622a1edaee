"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, fingerprints, html_blocks, mixing, near_dup, packing, quality_model, quality_rules, sharding, spelling, suffix_dedup, toxicity, whitening
from tessera.llm.common import held_out, n_tasks

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded texts of all documents."""
    df = _docs(spark, sf_dir).select("doc_id", "text")
    df = bpe.decode(bpe.encode(df, BYTE_BPE), BYTE_BPE)
    return df.select(
        "doc_id",
        bpe.n_ids().alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Winnowing fingerprints of all documents and of their edited texts, compared with the next documents."""
    return fingerprints.compare_with_next(_docs(spark, sf_dir), blocks=4 * n_tasks(spark))


SHARD_BYTES = 1 << 20


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The extendible-hashing shard of every document, each shard of at most 1 MiB."""
    found = sharding.shard(_docs(spark, sf_dir).select("doc_id", "text"), SHARD_BYTES)
    return found.select("doc_id", "n_bytes", "shard", "depth", "overflow", "shard_bytes")


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the 50-byte strings that earlier documents have."""
    found = suffix_dedup.remove_repeats(_docs(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents by compression distance."""
    docs = _docs(spark, sf_dir).select("doc_id", "text")
    model = toxicity.fit(docs, _labels(spark, sf_dir))
    found = toxicity.classify(docs, model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the likelihood-ratio verdict of all documents; trusted are documents labelled of good quality."""
    docs = _docs(spark, sf_dir).select("doc_id", "text")
    labels = _labels(spark, sf_dir).where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    trusted = labels.where("quality = 1").select("doc_id").distinct()
    found = quality_rules.judge(docs, trusted)
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "ratio")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of 1024 tokens."""
    docs = _docs(spark, sf_dir).select("doc_id", "text")
    return packing.pack(packing.pieces(docs, BYTE_BPE))


def op8_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents by random Fourier features and ridge regression."""
    docs = _docs(spark, sf_dir).select("doc_id", "text")
    model = quality_model.fit(docs, _labels(spark, sf_dir))
    found = quality_model.classify(docs, model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    found = html_blocks.extract(pages, html_blocks.fit(pages))
    return found.select("page_id", "url", "text", "n_chars")


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document."""
    docs = _docs(spark, sf_dir).select("doc_id", "text")
    return near_dup.near_duplicates(docs, keep_text=False).select("doc_id", "class_id", "is_first")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first eight whitened components of every embedding."""
    found = whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return found.withColumn("deviation", whitening.as_long("deviation"))


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix of all sources takes of every document; documents labelled of good quality weigh 2, of bad quality 0.5."""
    weight = F.when(F.col("quality") == 1, 2.0).when(F.col("quality") == 0, 0.5).alias("weight")
    return mixing.mix(_docs(spark, sf_dir), _labels(spark, sf_dir).select("doc_id", weight))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spelling variants among the words of all documents."""
    return spelling.variants(_docs(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_fingerprints": op1_fingerprints,
    "op2_sharding": op2_sharding,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_toxicity": op4_toxicity,
    "op5_quality_rules": op5_quality_rules,
    "op6_bpe": op6_bpe,
    "op7_packing": op7_packing,
    "op8_quality_model": op8_quality_model,
    "op9_html": op9_html,
    "op10_near_duplicates": op10_near_duplicates,
    "op11_whitening": op11_whitening,
    "op12_mixing": op12_mixing,
    "op13_spelling": op13_spelling,
}

ORACLE_SQL: dict[str, str] = {
    # a document's shard is its shortest hash prefix whose documents fit the limit
    "op2_sharding": f"""
        WITH d AS (
            SELECT doc_id, octet_length(encode(coalesce(text, ''))) AS n_bytes,
                   ('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15))::BIGINT AS bits FROM documents
        ), p AS (
            SELECT doc_id, n_bytes, depth, bits, bits >> (60 - depth) AS prefix FROM d, range(0, 61) AS r(depth)
        ), b AS (
            SELECT *, sum(n_bytes) OVER (PARTITION BY depth, prefix) AS shard_bytes,
                   count(*) OVER (PARTITION BY depth, prefix) AS n_rows FROM p
        ), leaf AS (
            SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY depth) AS k FROM b
            WHERE shard_bytes <= {SHARD_BYTES} OR n_rows = 1
        )
        SELECT doc_id, n_bytes, substr(lpad(bin(bits), 60, '0'), 1, depth) AS shard, CAST(depth AS INTEGER) AS depth,
               CAST(0 AS BIGINT) AS overflow, CAST(shard_bytes AS BIGINT) AS shard_bytes
        FROM leaf WHERE k = 1
    """,
    # a source is full where all sources, filled up to its own level, do not exceed the whole
    "op12_mixing": """
        WITH q AS (
            SELECT doc_id, CASE max(CASE quality WHEN 1 THEN 2.0 WHEN 0 THEN 0.5 END) WHEN 2.0 THEN 2.0::DOUBLE WHEN 0.5 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS weight
            FROM labels GROUP BY doc_id
        ), d AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size, coalesce(weight, 1.0::DOUBLE) AS weight
            FROM documents LEFT JOIN q USING (doc_id)
        ), s AS (
            SELECT source, sum(size) AS source_size, [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT]::HUGEINT AS w FROM d GROUP BY source
        ), f AS (
            SELECT *, (SELECT sum(source_size) FROM s) AS whole,
                   2 * (SELECT sum(least(2 * t.source_size * s.w, 2 * s.source_size * t.w)) FROM s AS t) <= 3 * s.w * (SELECT sum(source_size) FROM s) AS filled FROM s
        ), a AS (
            SELECT source, source_size, filled, w * (3 * whole - 4 * coalesce(sum(source_size) FILTER (filled) OVER (), 0)) AS words, 2 * sum(w) FILTER (NOT filled) OVER () AS parts FROM f
        ), b AS (
            SELECT source, source_size, CASE WHEN filled THEN source_size * 2.0::DOUBLE ELSE words::DOUBLE / parts::DOUBLE END AS target,
                   CASE WHEN filled THEN 2 * source_size ELSE words // parts END AS budget FROM a
        ), k AS (
            SELECT doc_id, size, b.*, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs,
                   sum(size) OVER (PARTITION BY d.source ORDER BY -ln((('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE) / weight, CAST(doc_id AS VARCHAR)
                                   ROWS UNBOUNDED PRECEDING) AS upto
            FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source
        )
        SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target,
               CAST(epochs * size + greatest(0, least(size, budget - epochs * source_size - (upto - size))) AS BIGINT) AS taken FROM k
    """,
}
