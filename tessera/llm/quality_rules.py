"""Quality rules: counts of words, symbols, repeated lines and windows, and a hashed n-gram likelihood ratio.

Two multinomials over hashed byte n-grams are counted: one over trusted documents, one over the whole corpus.  A text's
verdict is the mean log ratio of its n-grams, compared with one threshold; no document is sampled away.

The trusted side is the smaller one, so its multinomial leans on the corpus's: it is smoothed by a tenth of its size, spread
as the corpus is.  N-grams that no trusted text has then count against a text by a bounded amount, also in languages of
which few texts are trusted.  The threshold is the ratio that all but one in a hundred trusted documents reach when each is
scored without its own n-grams on the trusted side.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import reach_workers
from tessera.llm.word_windows import LONG, n_repeated, window_ids, word_ids

N = 4
BUCKETS = 1 << 16
LEAN = 0.1
LEAST_SHARE = 0.01
#: More trusted keys than this are joined by a shuffle and not broadcast.
BROADCAST_KEYS = 2_000_000
WINDOW = 5
_SPACE = b" \t\n\v\f\r"
_SYMBOLS = b"#*$%&|<>"
_PRIME, _SPREAD = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)


def grams(raw: bytes, n: int = N, buckets: int = BUCKETS) -> np.ndarray:
    """Bucket of each byte n-gram of a text."""
    b = np.frombuffer(raw, np.uint8)
    if len(b) < n:
        return np.zeros(0, np.int64)
    wide = b.astype(np.uint64)
    h = wide[: len(b) - n + 1].copy()
    for j in range(1, n):
        h *= _PRIME
        h += wide[j : len(b) - n + 1 + j]
    h *= _SPREAD
    return (h >> np.uint64(64 - (buckets - 1).bit_length())).astype(np.int64)


def gram_counts(raw: bytes) -> np.ndarray:
    """How often each bucket occurs among the n-grams of a text, block by block of a long one."""
    counts = np.zeros(BUCKETS, np.int64)
    for at in range(0, max(len(raw) - N + 1, 0), LONG):
        counts += np.bincount(grams(raw[at : at + LONG + N - 1]), minlength=BUCKETS)
    return counts


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of a text.

    Words are runs without space, tab, LF, VT, FF or CR.  n_dup_lines counts lines with a word that equal an earlier
    line; n_repeat_words counts the words inside five-word windows that occur twice or more, the first included.
    """
    raw = text.encode()
    if len(raw) > LONG:
        ids = word_ids(raw)
        n, repeated = len(ids), n_repeated(window_ids(ids, WINDOW), WINDOW)
    else:
        words = raw.split()
        n, repeated = len(words), _repeated(words)
    spaces = len(raw) - len(raw.translate(None, _SPACE))
    symbols = len(raw) - len(raw.translate(None, _SYMBOLS))
    dup, seen = 0, set()
    if b"\n" in raw:
        for line in raw.split(b"\n"):
            if line.strip(_SPACE):
                if line in seen:
                    dup += 1
                seen.add(line)
    return n, len(text) - spaces, symbols, dup, repeated


def _repeated(words: list[bytes]) -> int:
    """:func:`n_repeated` of a list of words."""
    windows = list(zip(*(words[i:] for i in range(WINDOW))))
    if len(set(windows)) == len(windows):
        return 0
    times = Counter(windows)
    covered = bytearray(len(words))
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered[i : i + WINDOW] = b"\x01" * WINDOW
    return covered.count(1)


def corpus_counts(df: DataFrame, text: str = "text", trusted: str = "trusted") -> DataFrame:
    """(bucket, n_trusted, n_raw) over all rows; each task counts into two fixed vectors before anything moves."""
    reach_workers(df.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            for s, good in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                c = gram_counts((s or "").encode())
                both[1] += c
                if good:
                    both[0] += c
        at = np.flatnonzero(both[1])
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(both[0][at]), pa.array(both[1][at])], ["bucket", "n_trusted", "n_raw"])

    part = df.select(text, trusted).mapInArrow(count, "bucket long, n_trusted long, n_raw long")
    return part.groupBy("bucket").agg(F.sum("n_trusted").alias("n_trusted"), F.sum("n_raw").alias("n_raw"))


def bucket_counts(counts: DataFrame) -> np.ndarray:
    """Trusted and raw counts of every bucket; at most :data:`BUCKETS` rows are read."""
    both = np.zeros((2, BUCKETS))
    for r in counts.collect():
        both[:, r["bucket"]] = r["n_trusted"], r["n_raw"]
    return both


def log_ratios(both: np.ndarray) -> np.ndarray:
    """log p(trusted) - log p(raw) of every bucket; 0 without trusted counts."""
    return _ratios(both[0], both[1], both.sum(axis=1)) if both[0].any() else np.zeros(both.shape[1])


def _ratios(trusted: np.ndarray, raw: np.ndarray, totals: np.ndarray) -> np.ndarray:
    share = (raw + 1) / (totals[1] + BUCKETS)
    lean = LEAN * totals[0]
    return np.log((trusted + lean * share) / (totals[0] + lean)) - np.log(share)


def ratio(ratio_of: np.ndarray, raw: bytes) -> float:
    """Mean log ratio of a text's n-grams; 0 without any."""
    if len(raw) > LONG:
        return float(ratio_of @ gram_counts(raw) / (len(raw) - N + 1))
    at = grams(raw)
    return float(ratio_of[at].mean()) if len(at) else 0.0


def ratio_without_own(both: np.ndarray, raw: bytes) -> float:
    """Mean log ratio of a trusted text's n-grams with these taken off the trusted side."""
    if len(raw) > LONG:
        times = gram_counts(raw)
        found = np.flatnonzero(times)
        times = times[found]
    else:
        found, times = np.unique(grams(raw), return_counts=True)
    n = times.sum()
    left = both.sum(axis=1) - [n, 0]
    if not n or left[0] <= 0:
        return 0.0
    return float(_ratios(both[0][found] - times, both[1][found], left) @ times / n)


RULES = T.StructType(
    [T.StructField(c, T.LongType()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [T.StructField("ratio", T.DoubleType())]
)


def judge(df: DataFrame, trusted_ids: DataFrame, text: str = "text", key: str = "doc_id", threshold: float | None = None) -> DataFrame:
    """Add the counts of :func:`base_counts`, ratio, base_failed and kept to each row.

    ``trusted_ids`` holds the keys of trusted documents.  Null texts count as empty: no words, ratio 0.  Without any trusted
    document all ratios are 0 and none is rejected for its ratio.  ``base_failed`` holds with fewer than ten words or over a
    fifth of them repeated; ``kept`` is false there, else whether the ratio reaches the threshold (that of trusted documents
    if none is given).  Rows that repeat a key are trusted alike.  Other columns pass; clashing ones are replaced.
    """
    spark = df.sparkSession
    reach_workers(spark)
    ids = trusted_ids.select(F.col(key).alias("__id")).where(F.col("__id").isNotNull()).distinct().withColumn("__good", F.lit(True))
    if ids.count() <= BROADCAST_KEYS:
        ids = F.broadcast(ids)  # as many keys at most
    rows = df.select(F.coalesce(F.col(text), F.lit("")).alias("text"), F.col(key).alias("__id")).join(ids, "__id", "left")
    both = bucket_counts(corpus_counts(rows.select("text", F.coalesce("__good", F.lit(False)).alias("trusted"))))
    table = spark.sparkContext.broadcast((both, log_ratios(both)))  # a fixed number of buckets
    if threshold is None:
        # no filter on what the function gives: that would be pushed below the join and so score every text
        found = rows.where("__good").select(_rules(table, True)("text").alias("r"))
        threshold = found.agg(F.percentile("r.ratio", F.lit(LEAST_SHARE))).first()[0]
        threshold = float("-inf") if threshold is None else threshold
    out = df.withColumn("__rules", _rules(table, False)(F.col(text)))
    for c in RULES.names:
        out = out.withColumn(c, F.col("__rules")[c])
    failed = _failed(F.col("n_words"), F.col("n_repeat_words"))
    return out.drop("__rules").withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("ratio") >= threshold))


def _failed(n_words: Column | int, n_repeat_words: Column | int) -> Column | bool:
    return (n_words < 10) | (100 * n_repeat_words > 20 * n_words)


def _rules(table, without_own: bool):
    """Base counts and ratio of texts; ``without_own`` takes a text's own n-grams off the trusted side, and gives no ratio to
    texts that fail the base rules."""

    @F.arrow_udf(RULES)
    def rules(texts: pa.Array) -> pa.Array:
        both, ratio_of = table.value
        rows, means = [], []
        for s in texts.to_pylist():
            s = s or ""
            rows.append(base_counts(s))
            raw = s.encode()
            if without_own:
                means.append(None if _failed(rows[-1][0], rows[-1][4]) else ratio_without_own(both, raw))
            else:
                means.append(ratio(ratio_of, raw))
        columns = list(zip(*rows)) if rows else [()] * 5
        return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns] + [pa.array(means, pa.float64())], RULES.names)

    return rules
