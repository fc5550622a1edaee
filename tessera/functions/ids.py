"""Content-derived identifiers and canonical keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.text import SEP, _col


def content_id(text: Column | str, prefix: str = "") -> Column:
    """``prefix`` and the md5 of a text in UTF-8; null texts have null ids."""
    return F.concat(F.lit(prefix), F.md5(_col(text).cast("binary")))


def args_hash(*args: Column | str) -> Column:
    return F.md5(F.concat(*[F.coalesce(_col(a).cast("string"), F.lit("None")) for a in args]).cast("binary"))


def low(a: Column | str, b: Column | str) -> Column:
    return F.least(_col(a), _col(b))


def high(a: Column | str, b: Column | str) -> Column:
    return F.greatest(_col(a), _col(b))


def pair_key(a: Column | str, b: Column | str) -> Column:
    """The undirected key of a relation: both ends in order, joined by the separator."""
    return F.concat(low(a, b), F.lit(SEP), high(a, b))


def pair_of(key: Column | str) -> Column:
    """Both ends of a relation key; a key that has not exactly two parts is an error."""
    parts = F.split(_col(key), SEP)
    return F.when(F.size(parts) == 2, parts).otherwise(F.raise_error(F.concat(F.lit("not a relation key: "), _col(key))).cast("array<string>"))


def relation_ids(a: Column | str, b: Column | str) -> Column:
    """Ids of a relation's vector row: of the canonical order, and of the reverse where it differs."""
    return F.array_distinct(F.array(content_id(F.concat(low(a, b), high(a, b)), "rel-"), content_id(F.concat(high(a, b), low(a, b)), "rel-")))


def cache_key(mode: Column | str, kind: Column | str, digest: Column | str) -> Column:
    return F.concat_ws(":", _col(mode), _col(kind), _col(digest))


def cache_parts(key: Column | str) -> Column:
    """(mode, cache_type, hash) of a cache key; null where it has fewer than three parts."""
    parts = F.split(_col(key), ":", 3)
    return F.when(F.size(parts) == 3, F.struct(parts[0].alias("mode"), parts[1].alias("cache_type"), parts[2].alias("hash")))


def semantic_hash(*columns: Column | str) -> Column:
    """sha256 of the columns as canonical JSON, white space folded."""
    return F.sha2(F.regexp_replace(F.to_json(F.struct(*[_col(c) for c in columns])), r"\s+", " "), 256)


def projection_hash(explicit: Column, content_hash: Column, *columns: Column | str) -> Column:
    return F.coalesce(explicit, content_hash, semantic_hash(*columns))


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine similarity of two arrays of doubles; 0 where either is a zero vector."""
    a, b = _col(a), _col(b)
    add = lambda s, x: s + x
    zero = F.lit(0.0)
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), zero, add)
    norm = lambda v: F.sqrt(F.aggregate(F.transform(v, lambda x: x.cast("double") * x.cast("double")), zero, add))
    lengths = norm(a) * norm(b)
    return F.when(lengths == 0, zero).otherwise(dot / lengths)
