"""Toxicity by compression distance.

Two zstandard dictionaries are made: one of windows of toxic text, one of windows of ordinary text.  A window is a
word between fixed ordinary context.  A window that the toxic dictionary shortens more than the ordinary one gains
bytes; how much each gain tells is calibrated on labelled documents that the dictionaries have not seen, and so is the
mapping from a document's summed evidence to a score.

A toxic document is ordinary in most of its windows, so the windows to train on are chosen by how much oftener they
occur in toxic than in ordinary documents.  The dictionaries share their ordinary part, and differ in the chosen
windows alone.  They hold the windows as they are (raw content) instead of the segments that zstandard's own trainer cuts:
that trainer splits and drops the few windows that matter, and found two thirds as many toxic texts (README).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import materialise, reach_workers, worker_slot
from tessera.llm.labelled import LABELLED_ROWS, isotonic, labelled_sample

DICTIONARY_BYTES = 2_000
SHARED_BYTES = 2_048
LEVEL = 6
LEAST_ODDS = 4.5
LEAST_WORDS = 20
GAINS = 12  # gains from 0 (or less) to 11 (or more) bytes
CACHE_ENTRIES = 100_000
CACHE_BYTES = 64  # longer windows are compressed each time, so that the cache is bounded in bytes too
#: ASCII punctuation is left out of windows.
_PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())


def windows(text: str) -> list[bytes]:
    """The words of a text in lower case, without ASCII punctuation."""
    return text.lower().encode().translate(None, _PUNCTUATION).split()


def _words(text: Column) -> Column:
    """The same windows as a column."""
    bare = F.regexp_replace(F.lower(text), r"[!-/:-@\[-`{-~]", "")
    return F.filter(F.split(bare, r"[ \t\n\x0B\f\r]+"), lambda w: F.length(w) > 2)


@dataclass(frozen=True)
class Model:
    toxic: bytes
    ordinary: bytes
    context: bytes
    evidence: np.ndarray
    knots: np.ndarray
    values: np.ndarray


class Gains:
    """Bytes that the toxic dictionary saves over the ordinary one, window by window, with a bounded cache."""

    def __init__(self, model: Model):
        parameters = zstandard.ZstdCompressionParameters.from_level(LEVEL, min_match=3, write_content_size=False)
        make = lambda d: zstandard.ZstdCompressor(
            dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=parameters
        )
        self.of_toxic, self.of_ordinary = make(model.toxic).compress, make(model.ordinary).compress
        self.before, self.after = model.context + b" ", b" " + model.context[:16]
        self.cache: dict[bytes, int] = {}

    def of(self, word: bytes) -> int:
        hit = self.cache.get(word)
        if hit is None:
            framed = self.before + word + self.after
            hit = len(self.of_ordinary(framed)) - len(self.of_toxic(framed))
            hit = min(max(hit, 0), GAINS - 1)
            if len(word) <= CACHE_BYTES:
                if len(self.cache) >= CACHE_ENTRIES:
                    self.cache.clear()
                self.cache[word] = hit
        return hit

    def histogram(self, text: str) -> np.ndarray:
        words = windows(text)
        if not words:
            return np.zeros(GAINS, np.int64)
        return np.bincount(np.fromiter(map(self.of, words), np.int64, len(words)), minlength=GAINS)


def _gains(model: Model) -> Gains:
    """One set of compressors and one cache for each Python worker and model."""
    return worker_slot("toxicity", (model.toxic, model.ordinary), lambda: Gains(model))


def _strength(h: np.ndarray, evidence: np.ndarray) -> np.ndarray:
    """Summed evidence of documents, over the root of their numbers of windows."""
    return h @ evidence / np.sqrt(np.maximum(h.sum(axis=1), 1))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", bound: int = LABELLED_ROWS) -> Model:
    """Learn from at most ``bound`` labelled documents outside the held-out fold.

    Half of them, by a hash of doc_id, give the dictionaries; the other half calibrate.  Without toxic documents the
    dictionaries are the same and all scores are the share of label 1.
    """
    reach_workers(docs.sparkSession)
    sample = materialise(labelled_sample(docs, labels, label, bound), "toxic-sample")
    half = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(2)) == 0
    learn = sample.where(half)
    n_toxic, n_ordinary = (learn.where(F.col("y") == y).count() for y in (1, 0))
    words = learn.select("y", F.explode(F.array_distinct(_words(F.col("text")))).alias("word"))
    counts = words.groupBy("word").agg(F.sum("y").alias("t"), F.sum(1 - F.col("y")).alias("o"))
    odds = F.log((F.col("t") + 0.5) / (n_toxic + 1)) - F.log((F.col("o") + 0.5) / (n_ordinary + 1))
    counts = counts.withColumn("odds", odds).withColumn("order", F.col("odds") * F.sqrt("t"))
    ranked = counts.where(F.col("t") >= 3).orderBy(F.desc("order"), "word").limit(DICTIONARY_BYTES // 4).collect()
    sure = [r["word"] for r in ranked if r["odds"] >= LEAST_ODDS] or [r["word"] for r in ranked[:LEAST_WORDS] if r["odds"] > 1]
    if len(sure) < LEAST_WORDS:
        sure += [r["word"] for r in ranked[:LEAST_WORDS] if r["odds"] > 1 and r["word"] not in set(sure)]
    # the ordinary part: words in a fixed pseudo-random order
    plain = counts.where((F.col("odds") < 0.5) & (F.col("o") > 0)).orderBy(F.xxhash64("word"), "word").limit((DICTIONARY_BYTES + SHARED_BYTES) // 3).collect()
    plain = b" ".join(r["word"].encode() for r in plain) or b"the and of"
    chosen = b" ".join(w.encode() for w in reversed(sure))[-DICTIONARY_BYTES:]
    shared = plain[len(chosen) : len(chosen) + SHARED_BYTES] or plain
    context = plain[:24]
    model = Model(
        shared + b" " + chosen + b" " + context, shared + b" " + plain[: len(chosen)] + b" " + context, context, np.zeros(GAINS), np.zeros(1), np.zeros(1)
    )
    rows = _with_histogram(sample.where(~half), model, "text").select("h", "y").collect()  # at most ``bound`` short rows
    if not rows:
        return model
    h, y = np.array([r["h"] for r in rows], float), np.array([r["y"] for r in rows])
    total = np.array([h[y == k].sum(axis=0) for k in (1, 0)])
    share = np.log(total + 0.5) - np.log(total.sum(axis=1, keepdims=True) + 0.5 * GAINS)
    evidence = np.maximum(share[0] - share[1], 0.0)
    evidence[:2] = 0.0
    knots, values = isotonic(_strength(h, evidence), y)
    return Model(model.toxic, model.ordinary, context, evidence, knots, values)


def _with_histogram(df: DataFrame, model: Model, text: str, out: str = "h") -> DataFrame:
    reach_workers(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)  # two dictionaries of fixed size

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def gains(texts: pa.Array) -> pa.Array:
        g = _gains(shared.value)
        return pa.array([g.histogram(s or "") for s in texts.to_pylist()], pa.list_(pa.int64()))

    return df.withColumn(out, gains(F.col(text)))


def classify(df: DataFrame, model: Model, text: str = "text", out: str = "score", threshold: float = 0.5) -> DataFrame:
    """Add ``out`` (0 to 1, higher for more toxic texts) and ``predicted`` (1 at the threshold or above) to each row.

    Null and empty texts have no windows and get the score of no evidence.  Other columns pass; clashing ones are
    replaced.
    """
    reach_workers(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(T.DoubleType())
    def score(texts: pa.Array) -> pa.Array:
        m = shared.value
        g = _gains(m)
        rows = texts.to_pylist()
        if not rows:
            return pa.array([], pa.float64())
        h = np.array([g.histogram(s or "") for s in rows], float)
        return pa.array(np.clip(np.interp(_strength(h, m.evidence), m.knots, m.values), 0.0, 1.0))

    return df.withColumn(out, score(F.col(text))).withColumn("predicted", (F.col(out) >= threshold).cast("int"))
