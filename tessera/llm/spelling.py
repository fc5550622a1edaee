"""Spelling variants: words one edit apart, each pointed at its commonest neighbour.

Every word emits its full neighbourhood: all distinct deletions, replacements and insertions over the observed alphabet.  A
candidate that is a word is a neighbour; nothing is measured afterwards.

A word of 8 characters has some 900 candidates, nearly all of which are no words.  They are made as hashes in numpy: the hash
of a word is a polynomial, so that of a candidate follows from those of a prefix and a suffix in a few operations.  A Bloom
filter of the vocabulary's hashes, of a size bounded by :data:`MOST_BITS`, drops candidates that cannot be words before they
are written out and shuffled; the hash join with the vocabulary compares the words themselves, so the filter changes what is
moved and nothing else.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialise, reach_workers

RUN = "[A-Za-z\\u00C0-\\u00FF]+"
#: A run loses a character where this divides its hash.
ODDS = 97
#: Words have at least so many characters and occurrences; a form is at least so many times as common.
LEAST_CHARS, LEAST_COUNT, TIMES = 5, 3, 2
#: Bits of the filter for each word and at most (128 MiB), hashes set for each word.
BITS_EACH, MOST_BITS, PROBES = 64, 1 << 30, 4
#: Candidates that a task holds at a time.
BLOCK = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def lower_ascii(run: Column) -> Column:
    """A run with A-Z alone in lower case."""
    ascii_only = F.char_length(run) == F.octet_length(run)
    return F.when(ascii_only, F.lower(run)).otherwise(F.translate(run, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def occurrences(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word) a row for each run of letters: in lower case, without one character where the hash of id and run says so.

    Null texts have none; a null id counts as an empty one.
    """
    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    runs = docs.select(name.alias("name"), F.explode(F.regexp_extract_all(F.col(text), F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.select("name", lower_ascii(F.col("run")).alias("run"))
    runs = runs.withColumn("h", F.crc32(F.concat("name", F.lit(":"), "run").cast("binary")))
    at = F.pmod("h", F.char_length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.expr("substring(run, CAST(h % char_length(run) AS INT) + 2)"))
    return runs.select(F.when(F.col("h") % ODDS == 0, cut).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame) -> DataFrame:
    """(word, n) of long enough words that occur often enough."""
    counted = words.where(F.char_length("word") >= LEAST_CHARS).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= LEAST_COUNT)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX[0]
    h = (h ^ (h >> np.uint64(27))) * _MIX[1]
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, _BASE), dtype=np.uint64)])


def _prefixes(chars: np.ndarray) -> np.ndarray:
    """Hashes of all prefixes of each row of characters, the empty one first: h(w c) = h(w) base + c + 1."""
    out = np.zeros((chars.shape[0], chars.shape[1] + 1), np.uint64)
    for i in range(chars.shape[1]):
        out[:, i + 1] = out[:, i] * _BASE + chars[:, i].astype(np.uint64) + np.uint64(1)
    return out


def _grid(words: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1)


def _by_length(words: list[str]) -> Iterator[list[bytes]]:
    """Words of one length at a time; letters of the pattern take a byte in latin-1."""
    rows = [w.encode("latin-1") for w in words]
    rows.sort(key=len)
    start = 0
    for i in range(1, len(rows) + 1):
        if i == len(rows) or len(rows[i]) != len(rows[start]):
            yield rows[start:i]
            start = i


def _slots(h: np.ndarray, probe: int, bits: int) -> np.ndarray:
    return _mixed(h + np.uint64(probe * int(_MIX[0]) % (1 << 64))) & np.uint64(bits - 1)


def _holds(table: np.ndarray, slot: np.ndarray) -> np.ndarray:
    return (table[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 > 0


def bloom(words: DataFrame, n: int) -> np.ndarray:
    """The filter of a vocabulary (word): bits in bytes, built in pieces by tasks that each own a range of the bits."""
    bits = 1 << max(13, min(BITS_EACH * max(n, 1), MOST_BITS).bit_length() - 1)
    piece = max(1 << 13, bits >> 10)

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in _by_length(batch.column(0).to_pylist()):
                h = _prefixes(_grid(rows))[:, -1]
                found = np.concatenate([_slots(h, p, bits) for p in range(PROBES)]).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(found // piece), pa.array(found % piece)], ["piece", "slot"])

    def pack(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(piece, bool)
        for batch in batches:
            own[np.asarray(batch.column(1))] = True
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int64()), pa.array([np.packbits(own, bitorder="little").tobytes()])], ["piece", "bits"])

    pieces = words.mapInArrow(slots, "piece long, slot long").groupBy("piece").applyInArrow(pack, "piece long, bits binary")
    table = np.zeros(bits // 8, np.uint8)
    for row in pieces.toLocalIterator():  # at most 1,024 rows, MOST_BITS together
        at = row["piece"] * piece // 8
        table[at : at + piece // 8] = np.frombuffer(row["bits"], np.uint8)
    return table


def edits(rows: list[bytes], alphabet: np.ndarray, table: np.ndarray) -> Iterator[tuple[bytes, bytes]]:
    """(word, candidate) for words of one length: every distinct deletion, replacement and insertion, but for those that the
    filter knows to be no words.

    A character is deleted from a run of equal ones once, replaced by others only, and inserted only before a character
    unlike it or at the end; so no candidate comes twice.
    """
    size, bits = len(rows[0]), len(table) * 8
    power = _powers(size + 1)
    letters = alphabet.astype(np.uint64) + np.uint64(1)
    width = max(1, min(size + 1, BLOCK // max(1, len(alphabet))))
    height = max(1, BLOCK // (width * max(1, len(alphabet))))
    for top in range(0, len(rows), height):
        own = rows[top : top + height]
        chars = _grid(own)
        before = _prefixes(chars)
        whole = before[:, -1:]
        for left in range(0, size + 1, width):
            at = np.arange(left, min(left + width, size + 1))
            after = whole - before[:, at] * power[size - at]  # hashes of what follows a place
            inside = at[at < size]
            follows = whole - before[:, inside + 1] * power[size - 1 - inside]
            first = np.ones((len(own), len(inside)), bool)
            last = inside < size - 1
            first[:, last] = chars[:, inside[last]] != chars[:, inside[last] + 1]
            gone = before[:, inside] * power[size - 1 - inside] + follows
            put = (before[:, inside, None] * _BASE + letters) * power[size - 1 - inside][None, :, None] + follows[:, :, None]
            unlike = chars[:, inside, None] != alphabet
            more = (before[:, at, None] * _BASE + letters) * power[size - at][None, :, None] + after[:, :, None]
            fits = np.ones((len(own), len(at), len(alphabet)), bool)
            fits[:, : len(inside)] = unlike
            for kind, h, ok in (("delete", gone, first), ("replace", put, unlike), ("insert", more, fits)):
                where = np.flatnonzero(ok.ravel())
                flat = h.ravel()[where]
                for p in range(PROBES):
                    held = _holds(table, _slots(flat, p, bits))
                    where, flat = where[held], flat[held]
                found = np.unravel_index(where, h.shape)
                for k in range(len(where)):
                    word, i = own[found[0][k]], left + int(found[1][k])
                    if kind == "delete":
                        yield word, word[:i] + word[i + 1 :]
                    else:
                        letter = bytes([alphabet[found[2][k]]])
                        yield word, word[:i] + letter + word[i + (kind == "replace") :]


def neighbours(words: DataFrame, n: int) -> DataFrame:
    """(word, near) of all pairs of words (word) of a vocabulary of ``n`` that are one edit apart, in both directions."""
    spark = words.sparkSession
    reach_workers(spark)
    letters = words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).where("c <> ''").distinct().collect()
    alphabet = np.array(sorted(r["c"].encode("latin-1")[0] for r in letters), np.uint8)  # at most 90 letters
    shared = spark.sparkContext.broadcast((alphabet, bloom(words, n)))  # at most MOST_BITS

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alphabet, table = shared.value
        for batch in batches:
            for rows in _by_length(batch.column(0).to_pylist()):
                have, want, held = [], [], 0
                for word, other in edits(rows, alphabet, table):
                    have.append(word.decode("latin-1"))
                    want.append(other.decode("latin-1"))
                    held += len(word)
                    if held > BLOCK:
                        yield pa.RecordBatch.from_arrays([pa.array(have), pa.array(want)], ["word", "near"])
                        have, want, held = [], [], 0
                yield pa.RecordBatch.from_arrays([pa.array(have, pa.string()), pa.array(want, pa.string())], ["word", "near"])

    found = words.mapInArrow(near, "word string, near string")
    return found.join(words.withColumnRenamed("word", "near"), "near", "left_semi").select("word", "near")


def roots(forms: DataFrame, rounds: int = 64) -> DataFrame:
    """(word, root): where following ``form`` from each word (word, form) ends.  A form is at least twice as common, so
    chains are short; each round doubles the steps followed."""
    to = materialise(forms.where("form is not null").select("word", F.col("form").alias("root")), "spelling-roots")
    for _ in range(rounds):
        further = to.join(to.select(F.col("word").alias("root"), F.col("root").alias("__further")), "root", "left")
        after = materialise(further.select("word", F.coalesce("__further", "root").alias("root"), F.col("__further").isNotNull().alias("moved")), "spelling-roots")
        to = after.select("word", "root")
        if after.where("moved").isEmpty():
            break
    return forms.select("word").join(to, "word", "left").select("word", F.coalesce("root", "word").alias("root"))


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each word of the documents (key, text).

    ``n_near`` counts the words that are one inserted, deleted or replaced character away; ``form`` is the commonest of them
    (the first in code-point order among equals) where it is at least twice as common as the word, else null with its
    ``form_n``; ``root`` is where forms lead, the word itself without one.  Rows that repeat count as often as they come;
    null texts and an empty table give no words; other columns do not pass.
    """
    words = materialise(vocabulary(occurrences(docs.select(key, text), key, text)), "spelling-words")
    n = words.count()
    tasks = words.sparkSession.conf.get("spark.sql.shuffle.partitions")
    near = neighbours(words.select("word").repartition(int(tasks), "word"), n)
    counts = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    found = near.join(counts, "near").groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("form"))).alias("best"))
    rows = words.join(found, "word", "left").withColumn("fit", -F.col("best.n") >= TIMES * F.col("n"))
    rows = rows.select(
        "word", F.when(F.col("fit"), F.col("best.form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(F.col("fit"), -F.col("best.n")).alias("form_n")
    )
    rows = materialise(rows, "spelling-forms")
    return rows.join(roots(rows), "word").select("word", "form", "root", "n", "n_near", "form_n")
