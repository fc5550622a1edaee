"""Clean-up and parsing of text as column expressions."""

from __future__ import annotations

import html
import json
import re
import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEP = "<SEP>"

#: Words that lexical ranking leaves out.
STOPWORDS = (
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "how", "in", "into", "is", "it", "its", "of", "on", "or",
    "that", "the", "their", "to", "what", "with",
)

#: Terms that tell what a question about versions wants, in the order in which they are tried.
INTENT_TERMS = (
    ("AS_OF_TIME", ("截至", "as of")),
    ("COMPARE", ("差异", "对比", "compare", "difference")),
    ("MIGRATION", ("迁移", "初始化", "migration", "initialization")),
    ("HISTORICAL", ("历史", "以前", "旧版", "historical", "previous")),
    ("CURRENT", ("当前", "现行", "最新", "current", "latest")),
)

#: Han characters, the characters beside which spaces go next to them, and full-width forms with their ASCII.
_HAN = r"\x{4e00}-\x{9fa5}"
_HAN_MATE = r"a-zA-Z0-9\(\)\[\]@#$%!&\*\-=+_"
_WIDE, _NARROW = "－＋／＊（）—　", "-+/*()- "

#: Damaged forms of a delimiter around the core ``{e}``, tried in this order; the cases in tests/test_text.py
#: have one of each.
DAMAGED = (
    r"<\|{e}\|*?{e}\|>", r"<\|\\{e}\|>", r"<\|+>", r"<.?\|{e}\|.?>", r"<\|?{e}\|?>", r"<[^|]{e}\|>|<\|{e}[^|]>",
    r"<\|{e}\|+(?!>)", r"<\|{e}:(?!>)", r"<\|+{e}>", r"<\|\|(?!>)", r"(?<!<)\|{e}\|>", r"<\|{e}\|>\|", r"\|\|{e}\|\|",
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _strip(c: Column) -> Column:
    """A text without white space (of ASCII) at both ends."""
    return F.btrim(c, F.lit(" \t\n\x0b\f\r"))


def sanitize(text: Column | str) -> Column:
    """Strip, decode HTML entities, and drop characters that UTF-8 or XML stores refuse (controls but tab, LF and CR)."""

    @F.arrow_udf(T.StringType())
    def unescape(values: pa.Array) -> pa.Array:
        return pa.array((html.unescape(v.as_py()) if v.is_valid else None for v in values), pa.string())

    trimmed = _strip(_col(text))
    # texts without an ampersand hold no entity and do not go to Python
    decoded = F.coalesce(unescape(F.when(F.contains(trimmed, F.lit("&")), trimmed)), trimmed)
    clean = F.regexp_replace(decoded, r"[\x00-\x08\x0B\x0C\x0E-\x1F\x{FFFE}\x{FFFF}]", "")
    return _strip(clean)


def _unquoted(c: Column, opening: str, closing: str) -> Column:
    """A text without one pair of outer quotes that holds no such quote."""
    return F.regexp_replace(c, f"(?s)^{opening}([^{opening}{closing}]*){closing}$", "$1")


def normalize_name(name: Column | str, inner_quotes: bool = False) -> Column:
    """A name or description as extraction stores it.

    Paragraph and line-break tags go, full-width forms become ASCII, spaces next to Han characters go, a pair of outer quotes
    goes, and short numbers become empty.  With ``inner_quotes`` also quotes in and around Han text go.
    """
    given = _col(name)
    c = F.regexp_replace(given, r"(?i)</p\s*>|<p\s*>|<p/>|</br\s*>|<br\s*>|<br/>", "")
    full = "".join(chr(0xFF21 + i) for i in range(26)) + "".join(chr(0xFF41 + i) for i in range(26)) + "".join(chr(0xFF10 + i) for i in range(10))
    half = "".join(chr(65 + i) for i in range(26)) + "".join(chr(97 + i) for i in range(26)) + "0123456789"
    c = F.translate(c, full + _WIDE, half + _NARROW)
    c = F.regexp_replace(c, rf"(?<=[{_HAN}])\s+(?=[{_HAN}{_HAN_MATE}])", "")
    c = F.regexp_replace(c, rf"(?<=[{_HAN_MATE}])\s+(?=[{_HAN}])", "")
    for opening, closing in (('"', '"'), ("'", "'"), ("“", "”"), ("‘", "’"), ("《", "》")):
        c = _unquoted(c, opening, closing)
    if inner_quotes:
        c = F.translate(c, "“”‘’", "")
        c = F.regexp_replace(c, rf"['\"]+(?=[{_HAN}])|(?<=[{_HAN}])['\"]+", "")
        c = F.regexp_replace(F.translate(c, " ", " "), r"(?<=\D)\x{202F}", " ")
    # no step so far changes plain text
    c = _strip(F.when(given.rlike(r"[^ -~]|[<'\"]"), c).otherwise(given))
    return F.regexp_replace(c, r"^(?:[0-9]{1,2}|(?=[0-9]*[.])[0-9.]{1,5})$[\x{85}\x{2028}\x{2029}]?", "")


def without_thinking(text: Column | str) -> Column:
    """Drop everything up to an orphan closing think tag, then whole think blocks, then outer space."""
    c = F.regexp_replace(_col(text), r"(?s)^((?!<think>).)*?</think>", "")
    return _strip(F.regexp_replace(c, r"(?s)<think>.*?</think>", ""))


def repair_delimiters(record: Column | str, core: str = "#") -> Column:
    """Turn damaged forms of the field delimiter ``<|#|>`` back into it, from the closest forms to the least."""
    d, e = f"<|{core}|>", re.escape(core)
    given = c = _col(record)
    for form in DAMAGED:
        c = F.regexp_replace(c, form.replace("{e}", e), d)
    if not core or set(core) & set("<|>"):
        return c
    # each form holds one of these beside whole delimiters
    return F.when(F.replace(given, F.lit(d), F.lit("")).rlike(rf"[<|>]|{e}"), c).otherwise(given)


def split_on(text: Column | str, markers: list[str]) -> Column:
    """Parts of a text between any of some markers, trimmed, without empty ones."""
    if not markers:
        return F.array(_col(text))
    parts = F.split(_col(text), "|".join(map(re.escape, markers)))
    return F.filter(F.transform(parts, lambda x: _strip(x)), lambda x: x != "")


def is_float(text: Column | str) -> Column:
    return _col(text).rlike(r"^[-+]?[0-9]*\.?[0-9]+$")


def summary(text: Column | str, most: int = 250) -> Column:
    c = _strip(_col(text))
    return F.when(F.char_length(c) > most, F.concat(F.left(c, F.lit(most)), F.lit("..."))).otherwise(c)


def capped(name: Column | str, most: int = 256) -> Column:
    return F.left(_col(name), F.lit(most))


def file_path(path: Column | str, unknown: str = "unknown_source") -> Column:
    """A path trimmed; null, empty and the old placeholder become ``unknown``."""
    c = F.trim(_col(path))
    return F.coalesce(F.when((c == "") | (c == "no-file-path"), None).otherwise(c), F.lit(unknown))


def _dated(ts: Column, rest: str) -> Column:
    """A time as its year, in four digits or as many as it has and without a sign, and the rest of a pattern."""
    # yyyy puts a plus sign before years of five digits
    return F.when(F.year(ts) > 9999, F.date_format(ts, f"y{rest}")).otherwise(F.date_format(ts, f"yyyy{rest}"))


def epoch_text(seconds: Column | str) -> Column:
    return _dated(F.timestamp_seconds(_col(seconds)), "-MM-dd HH:mm:ss")


def iso_text(ts: Column | str) -> Column:
    return F.concat(_dated(_col(ts), "-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))


def track_id(prefix: str = "upload") -> Column:
    return F.concat(F.lit(prefix + "_"), F.date_format(F.current_timestamp(), "yyyyMMdd_HHmmss"), F.lit("_"), F.substring(F.expr("uuid()"), 1, 8))


def json_lines(df, order: str, columns: list[str]) -> Column:
    """One text: a JSON object a row, in the order of a column.  The rows of one group must fit one task."""
    rows = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.to_json(F.struct(*columns)).alias("j"))))
    return F.array_join(F.transform(rows, lambda r: r["j"]), "\n")


def keyword_lists(text: Column | str) -> Column:
    """high_level_keywords and low_level_keywords of a JSON answer, also where prose or fences surround it."""
    schema = "struct<high_level_keywords:array<string>,low_level_keywords:array<string>>"
    body = F.regexp_extract(_col(text), r"(?s)\{.*\}", 0)
    return F.from_json(body, schema)


def decode_escapes(text: Column | str) -> Column:
    """``\\uXXXX`` sequences as characters; a broken one stays as it is."""

    @F.arrow_udf(T.StringType())
    def decode(values: pa.Array) -> pa.Array:
        one = lambda m: json.loads(f'"{m.group(0)}"')
        out = []
        for v in values.to_pylist():
            out.append(None if v is None else re.sub(r"(\\u[dD][89abAB]\w{2}\\u[dD][c-fC-F][0-9a-fA-F]{2}|\\u(?![dD][89a-fA-F])[0-9a-fA-F]{4})", one, v))
        return pa.array(out, pa.string())

    return decode(_col(text))


def sort_key(label: Column | str) -> Column:
    """What labels are sorted by: their lower case."""
    return F.lower(_col(label))


def term_key(term: Column | str) -> Column:
    """A term for lookup: NFKC, connectors as spaces, case folded, then without spaces and punctuation."""

    @F.arrow_udf(T.StringType())
    def fold(values: pa.Array) -> pa.Array:
        return pa.array([None if v is None else unicodedata.normalize("NFKC", v).casefold() for v in values.to_pylist()], pa.string())

    return F.regexp_replace(fold(_col(term)), r"[\s_\-‐‑‒–—―/\\.,;:()\[\]{}'\"`]+", "")


def slug(part: Column | str) -> Column:
    c = F.regexp_replace(F.lower(F.trim(_col(part))), r"[^a-z0-9]+", "-")
    return F.regexp_replace(c, r"^-+|-+$", "")


def object_urn(module, domain, feature, object_type, canonical, dimension) -> Column:
    """A stable name of six parts for a semantic object; missing parts have fixed stand-ins."""
    parts = [F.coalesce(_col(module), F.lit("global")), F.coalesce(_col(domain), F.lit("domain")), F.coalesce(_col(feature), F.lit("feature")), _col(object_type), _col(canonical), F.coalesce(_col(dimension), F.lit("default"))]
    return F.concat(F.lit("urn:pfss:"), F.concat_ws(":", *map(slug, parts)))


def group_key(*parts: Column | str) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.lower(F.trim(_col(p))), F.lit("")) for p in parts])


def tokens(text: Column | str) -> Column:
    """Lexical tokens: runs of letters and digits in lower case, two characters or more, without stop words."""
    found = F.regexp_extract_all(F.lower(_col(text)), F.lit("([a-z0-9]+)"), F.lit(1))
    return F.filter(found, lambda t: (F.length(t) > 1) & ~t.isin(*STOPWORDS))


def token_overlap(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(tokens(a), tokens(b)))


def version_intent(text: Column | str, explicit: Column | None = None, as_of: Column | None = None) -> Column:
    """What a question about versions wants: an explicit wish first, then a date, then the first term that it holds."""
    low = F.lower(_col(text))
    out = F.lit("UNSPECIFIED")
    for intent, terms in reversed(INTENT_TERMS):
        hit = F.lit(False)
        for t in terms:
            hit = hit | F.contains(low, F.lit(t))
        out = F.when(hit, F.lit(intent)).otherwise(out)
    if as_of is not None:
        out = F.when(as_of.isNotNull(), F.lit("AS_OF_TIME")).otherwise(out)
    return F.coalesce(explicit, out) if explicit is not None else out


def query_mode(text: Column | str) -> Column:
    """(query, mode, context_only, user_prompt) of a chat line such as ``/localcontext[prompt] question``."""
    pattern = r"(?s)^/(local|global|naive|hybrid|mix|bypass|context)?(context)?(?:\[([^\]]*)\])?\s*(.*)$"
    c = _col(text)
    word = F.regexp_extract(c, pattern, 1)
    slash = c.rlike(pattern)
    return F.struct(
        F.when(slash, F.regexp_extract(c, pattern, 4)).otherwise(c).alias("query"),
        F.when(slash & word.isin("local", "global", "naive", "hybrid", "mix", "bypass"), word).otherwise(F.lit("mix")).alias("mode"),
        (slash & ((word == "context") | (F.regexp_extract(c, pattern, 2) != ""))).alias("context_only"),
        F.when(slash & F.contains(c, F.lit("[")), F.regexp_extract(c, pattern, 3)).alias("user_prompt"),
    )
