"""Winnowing fingerprints of documents, with DataFrame functions alone.

Units are chosen by what they hold, never by how long a run of characters is: among Latin, Greek and Cyrillic letters a unit
ends after each o and u (of these scripts, with marks too) and at the end of the run, so a word is one unit or two and a run
of any length is cut; any other character that is no white space (digits, signs, characters of scripts without spaces) is a
unit of its own.  Whether a unit
ends between two characters depends on these two alone, so a passage has the same units wherever it stands, but for the
first and the last, which may go on outside of it.  Each ``k`` neighbouring units give one hash; of every ``window``
neighbouring hashes the smallest is kept, the rightmost of equal ones, with its position.  Two texts that share ``k + window
- 1`` = 11 whole units in a row therefore share at least one kept hash (the guarantee of winnowing): some eight words, or 13
characters of a script without spaces, whatever stands beside them.

The hash of a k-gram rolls by doubling: the hash of ``2m`` units combines those of two runs of ``m``.  Window minima are
found the same way, so each step costs a few passes over an array and no substring is cut twice.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 4
WINDOW = 8
#: Letters whose runs are cut after some of them, and these.
LETTERS = "A-Za-z\\u00AA\\u00B5\\u00BA\\u00C0-\\u00D6\\u00D8-\\u00F6\\u00F8-\\u024F\\u0370-\\u03FF\\u0400-\\u052F\\u1E00-\\u1EFF"
ENDS = "OUou\u00D2-\u00D6\u00D8-\u00DC\u00F2-\u00F6\u00F8-\u00FC\u039F\u03A5\u03BF\u03C5\u041E\u0423\u043E\u0443"
_POS = 31  # bits of a position under a hash


def _doubled(df: DataFrame, values: str, width: int, combine) -> DataFrame:
    """Combine each ``width`` neighbours of the array column ``values`` (a power of two) by doubling.

    Each step is a column of its own, so that no step is computed twice.
    """
    span = 1
    while span < width:
        n = F.greatest(F.size(values) - span, F.lit(0))
        df = df.withColumn(values, F.zip_with(F.slice(values, F.lit(1), n), F.slice(values, F.lit(span + 1), n), combine))
        span *= 2
    return df


def _class(of: str, less: str = "") -> str:
    """The characters of a class less those of another, as a class that lists those under U+0100 one by one before the rest.

    The pattern engine looks these up in a table, while it tries ranges one after the other.
    """
    has = re.compile(f"[{of}]"), re.compile(f"[{less}]" if less else r"(?!)")
    low = "".join(f"\\x{i:02X}" for i in range(256) if has[0].match(chr(i)) and not has[1].match(chr(i)))
    rest = f"[\u0100-\u1EFF&&[{of}]" + (f"&&[^{less}]]" if less else "]")
    return f"[[{low}]{rest}]"


def _units(text: Column) -> Column:
    closed, ends = _class(LETTERS, ENDS), _class(ENDS)
    unit = rf"{closed}*+{ends}++|{closed}++|[^\x20\x09-\x0D]"
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(unit), F.lit(0))


def _power_of_two(n: int, what: str) -> None:
    if n < 1 or n & (n - 1):
        raise ValueError(f"{what} must be a power of two, not {n}")


def with_fingerprint(df: DataFrame, text: str = "text", out: str = "marks", k: int = K, window: int = WINDOW) -> DataFrame:
    """Add ``out``: an array of longs, ``hash << 31 | (2**31 - 1 - position)``, in the order of positions.

    Null, empty and blank texts have no units and get an empty array.  A text with fewer than ``k`` units has the one hash
    of all of them at position 0; one with fewer hashes than ``window`` keeps their minimum.  Equal texts get equal arrays.
    Other columns pass; one named as ``out`` is replaced.
    """
    _power_of_two(k, "k")
    _power_of_two(window, "window")
    top = (1 << _POS) - 1
    units, hashes, minima, all_at_once = (f"__{out}_{x}" for x in ("units", "hashes", "minima", "once"))
    df = df.withColumn(units, _units(F.col(text)))
    df = df.withColumn(hashes, F.transform(units, lambda u: F.xxhash64(u)))
    df = df.withColumn(all_at_once, F.when(F.size(units).between(1, k - 1), F.array(F.xxhash64(F.col(units))))).drop(units)
    df = _doubled(df, hashes, k, lambda a, b: F.xxhash64(a, b))
    df = df.withColumn(
        hashes,
        F.transform(
            F.coalesce(all_at_once, hashes),
            lambda h, i: F.shiftleft(h.bitwiseAND(F.lit((1 << 32) - 1)), _POS).bitwiseOR(F.lit(top) - i.cast("bigint")),
        ),
    )
    df = df.withColumn(minima, F.col(hashes))
    df = _doubled(df, minima, window, lambda a, b: F.least(a, b))
    few = F.size(hashes).between(1, window - 1)
    return df.withColumn(out, F.when(few, F.array(F.array_min(hashes))).otherwise(F.array_distinct(minima))).drop(hashes, minima, all_at_once)


def hashes_of(marks: str | Column) -> Column:
    """The set of hashes of a fingerprint, without positions."""
    col = F.col(marks) if isinstance(marks, str) else marks
    return F.array_distinct(F.transform(col, lambda m: F.shiftright(m, _POS)))


def positions_of(marks: str | Column) -> Column:
    """The unit positions of a fingerprint's hashes."""
    col = F.col(marks) if isinstance(marks, str) else marks
    top = (1 << _POS) - 1
    return F.transform(col, lambda m: F.lit(top) - m.bitwiseAND(F.lit(top)))


def as_text(marks: str | Column) -> Column:
    """A fingerprint as ``position:hash`` in hexadecimal digits, joined by spaces; an empty one as an empty string."""
    col = F.col(marks) if isinstance(marks, str) else marks
    top = (1 << _POS) - 1
    marks = F.transform(col, lambda m: F.concat(F.hex(F.lit(top) - m.bitwiseAND(F.lit(top))), F.lit(":"), F.hex(F.shiftright(m, _POS))))
    return F.lower(F.array_join(marks, " "))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard likeness of two sets of hashes; 1 when both are empty."""
    shared = F.size(F.array_intersect(a, b))
    total = F.size(a) + F.size(b) - shared
    return F.when(total == 0, F.lit(1.0)).otherwise(shared / total)


def with_neighbours(df: DataFrame, key: str, blocks: int) -> tuple[DataFrame, Window]:
    """Deal rows into blocks of neighbouring keys, descending, each ended by a copy of the next block's first rows.

    The keys that bound the blocks are quantiles of ``key`` and are keys themselves, so the first rows of a block are
    known before any row moves.  The copies have ``__ghost`` true; the last block ends with the largest key's rows.
    Null keys come last.  Rows of one key (nulls too) are in one block.
    """
    shares = [i / blocks for i in range(blocks + 1)]
    cuts = df.select(F.percentile_approx(key, shares, max(10_000, 20 * blocks))).first()[0]
    cuts = sorted(set(cuts or ()), reverse=True)
    bounds = F.split(F.lit(",".join(map(str, cuts))), ",").cast("array<bigint>")  # one constant, however many cuts
    n = max(1, len(cuts))
    # the block of a key: how many cuts lie above it or on it, by halving
    steps = F.array(*(F.lit(1 << i) for i in reversed(range(n.bit_length()))))
    above = F.aggregate(steps, F.lit(0), lambda at, step: F.when((at + step <= n) & (F.try_element_at(bounds, at + step) >= F.col(key)), at + step).otherwise(at))
    df = df.withColumn("__above", above if cuts else F.lit(0))
    df = df.withColumn("__block", F.when(F.col(key).isNull(), F.lit(n - 1)).otherwise(F.greatest(F.col("__above") - 1, F.lit(0))))
    first = F.coalesce((F.col("__above") > 0) & (F.try_element_at(bounds, F.col("__above")) == F.col(key)), F.lit(False))
    copies = F.when(
        first,
        F.array(
            F.struct(F.col("__block").alias("block"), F.lit(False).alias("ghost")),
            F.struct(F.when(F.col("__block") == 0, n - 1).otherwise(F.col("__block") - 1).alias("block"), F.lit(True).alias("ghost")),
        ),
    ).otherwise(F.array(F.struct(F.col("__block").alias("block"), F.lit(False).alias("ghost"))))
    df = df.withColumn("__copy", F.explode(copies))
    df = df.withColumn("__block", F.col("__copy.block")).withColumn("__ghost", F.col("__copy.ghost")).drop("__copy", "__above")
    return df, Window.partitionBy("__block").orderBy(F.col("__ghost").asc(), F.col(key).desc_nulls_last())


def compare_with_next(df: DataFrame, key: str = "doc_id", text: str = "text", blocks: int = 64) -> DataFrame:
    """Fingerprint each text, the text with its last third replaced from the next one, and compare all three.

    The next text is the one with the next smaller ``key``; after the smallest comes the largest.  The edited text has its
    last floor(n / 3) code points replaced by the first as many of the next (by all, if it has fewer).  Null texts count
    as empty, null keys come last, equal keys follow each other in the order of their texts.  A lone row is its own next.
    Returns ``key``, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    """
    base = df.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("text"))
    base, w = with_neighbours(base, key, blocks)
    w = w.orderBy(F.col("__ghost").asc(), F.col(key).desc_nulls_last(), F.col("text"))
    after = F.coalesce(F.lead("text").over(w), F.col("text"))
    cut = F.floor(F.char_length("text") / 3).cast("int")
    base = base.withColumn("__next", after)
    base = base.withColumn(
        "__edited",
        F.concat(F.left(F.col("text"), F.char_length("text") - cut), F.left(F.col("__next"), cut)),
    ).drop("__next")
    base = with_fingerprint(with_fingerprint(base, "text", "__marks"), "__edited", "__edited_marks")
    base = base.withColumn("__hashes", hashes_of("__marks"))
    base = base.withColumn("__next_hashes", F.coalesce(F.lead("__hashes").over(w), F.col("__hashes")))
    return base.where(~F.col("__ghost")).select(
        key,
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("__edited", 256).alias("edited_sha256"),
        as_text("__marks").alias("fingerprint"),
        as_text("__edited_marks").alias("edited_fingerprint"),
        likeness(F.col("__hashes"), hashes_of("__edited_marks")).alias("near_edited"),
        likeness(F.col("__hashes"), F.col("__next_hashes")).alias("near_next"),
    )
