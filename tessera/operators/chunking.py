"""Texts into token windows, and extraction answers into records."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.ids import content_id
from tessera.functions.text import is_float, normalize_name, repair_delimiters

#: The form of extraction answers.
DELIMITER, COMPLETE = "<|#|>", "<|COMPLETE|>"
_TOKEN = re.compile("[^\x20\x09-\x0d]+")


def words(text: Column | str) -> Column:
    """White-space tokens of a text."""
    c = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(c, r"\s+"), lambda x: x != "")


def windows(df: DataFrame, tokens: Column, size: int = 1200, overlap: int = 100) -> DataFrame:
    """(…, chunk_order_index, tokens, content): windows of ``size`` tokens, ``size - overlap`` apart.

    A window starts at every step below the number of tokens, so a last one within the overlap still appears.
    """
    if not 0 <= overlap < size:
        raise ValueError("the overlap must lie between 0 and the size")
    step = size - overlap
    df = df.withColumn("__tokens", tokens)
    n = F.size("__tokens")
    starts = F.when(n > 0, F.sequence(F.lit(0), n - 1, F.lit(step))).otherwise(F.array().cast("array<int>"))
    parts = F.transform(starts, lambda s: F.struct(F.least(F.lit(size), n - s).alias("tokens"), F.array_join(F.slice("__tokens", s + 1, size), " ").alias("content")))
    out = df.select(*[c for c in df.columns if c != "__tokens"], F.posexplode(parts).alias("chunk_order_index", "__part"))
    return out.select("*", "__part.tokens", "__part.content").drop("__part")


def windows_by(
    df: DataFrame, text: str, encode: Callable[[str], Sequence], decode: Callable[[Sequence], str], size: int = 1200, overlap: int = 100
) -> DataFrame:
    """The same windows in the tokens of a tokenizer that the caller passes; contents are trimmed, null texts have none."""
    if not 0 <= overlap < size:
        raise ValueError("the overlap must lie between 0 and the size")
    kind = "array<struct<tokens:int,content:string>>"

    @F.arrow_udf(kind)
    def cut(texts: pa.Array) -> pa.Array:
        rows = []
        for t in texts.to_pylist():
            ids = encode(t) if t else []
            parts = [ids[i : i + size] for i in range(0, len(ids), size - overlap)]
            rows.append([{"tokens": len(p), "content": decode(p).strip(" \t\n\r\x0b\f")} for p in parts])
        return pa.array(rows, pa.list_(pa.struct([("tokens", pa.int32()), ("content", pa.string())])))

    out = df.select("*", F.posexplode(cut(text)).alias("chunk_order_index", "__part"))
    return out.select("*", "__part.tokens", "__part.content").drop("__part")


def chunks_by(df: DataFrame, text: str, chunk: Callable[[str], list[str]]) -> DataFrame:
    """(…, chunk_order_index, content): the parts into which a function of the caller cuts each text."""

    @F.arrow_udf("array<string>")
    def cut(texts: pa.Array) -> pa.Array:
        return pa.array([chunk(t) if t else [] for t in texts.to_pylist()], pa.list_(pa.string()))

    return df.select("*", F.posexplode(cut(text)).alias("chunk_order_index", "content"))


def rerank(docs: DataFrame, question: str, score: Callable[[str, list[str]], list[float]], top: int, least: float | None = None) -> DataFrame:
    """(pos, score, rank): the ``top`` documents (pos, content) by a function that scores texts against a question, in batches.

    Scores below ``least`` drop out; ties go by pos.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score(question, b.column(1).to_pylist()), pa.float64())], ["pos", "score"])

    rows = docs.select("pos", "content").mapInArrow(run, f"pos {dict(docs.dtypes)['pos']}, score double")
    best = (rows if least is None else rows.where(F.col("score") >= least)).orderBy(F.desc("score"), "pos").limit(top)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("score"), "pos")))  # ``top`` rows


def split_windows(df: DataFrame, text: str, mark: str, size: int, overlap: int, only: bool = False) -> DataFrame:
    """Parts between a mark, each cut into windows where it is too long; with ``only`` a long part is an error."""
    parts = df.select("*", F.posexplode(F.split(text, F.lit(f"\\Q{mark}\\E"))).alias("part", "__text"))
    n = F.size(words("__text"))
    if only:
        parts = parts.withColumn("__text", F.when(n > size, F.raise_error(F.lit("a part exceeds the chunk size")).cast("string")).otherwise(F.col("__text")))
    return windows(parts, words("__text"), size, overlap).drop("__text")


def rerank_windows(df: DataFrame, tokens: Column, size: int, overlap: int) -> DataFrame:
    """Windows that stop once one reaches the end; an overlap of the size or more is clamped."""
    overlap = min(overlap, size - 1)
    step = size - overlap
    out = windows(df.withColumn("__all", F.size(tokens)), tokens, size, overlap)
    first = F.col("chunk_order_index") * step
    return out.where((F.col("chunk_order_index") == 0) | (first - step + size < F.col("__all"))).drop("__all")


def with_chunk_ids(chunks: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Chunks under ids of their content; of equal chunks of a document the last stays."""
    rows = chunks.withColumn("chunk_id", content_id("content", "chunk-"))
    last = rows.groupBy(doc, "chunk_id").agg(F.max("chunk_order_index").alias("chunk_order_index"))
    return rows.join(last, [doc, "chunk_id", "chunk_order_index"], "left_semi")


def text_blocks(df: DataFrame, text: str, is_title: Column, key: str) -> DataFrame:
    """(key, block, title, n_lines): lines gathered under the title line above them; lines before the first are left out."""
    from pyspark.sql import Window

    lines = df.select(key, F.posexplode(F.split(text, "\n")).alias("line_no", "line"))
    w = Window.partitionBy(key).orderBy("line_no")
    lines = lines.withColumn("block", F.sum(F.when(is_title, 1).otherwise(0)).over(w)).where("block > 0")
    return lines.groupBy(key, "block").agg(F.min_by("line", "line_no").alias("title"), F.count(F.lit(1)).alias("n_lines"))


def extraction_records(answers: DataFrame, key: str = "chunk_id", text: str = "answer", kind: str | None = None) -> DataFrame:
    """(key, pos, kind, fields): records of extraction answers, delimiters repaired; text after the end mark is left out.

    With a ``kind`` only its records are repaired and put out: damaged forms begin with ``<`` or ``|``, so repairing does not
    change the letters that a record begins with.
    """
    body = F.split(F.col(text), F.lit(f"\\Q{COMPLETE}\\E"))[0]

    def fields(record: Column) -> Column:
        parts = F.transform(F.split(repair_delimiters(F.trim(record)), F.lit(f"\\Q{DELIMITER}\\E")), lambda x: F.trim(x))
        wanted = F.trim(record) != ""
        return F.when(wanted if kind is None else wanted & F.startswith(F.lower(F.trim(record)), F.lit(kind)), parts)

    # fields are made before rows are: a filter on them would repair each record once more for every condition
    rows = answers.select(key, F.posexplode(F.transform(F.split(body, "\n"), fields)).alias("pos", "fields")).where("fields is not null")
    rows = rows.withColumn("kind", F.lower(F.get("fields", F.lit(0))))
    return rows if kind is None else rows.where(F.col("kind") == kind)


def _made(rows: DataFrame, **columns: Column) -> DataFrame:
    """Rows with more columns that later filters do not compute again."""
    return rows.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def entity_records(records: DataFrame) -> DataFrame:
    """Valid entities (name, entity_type, description): four fields, none empty; of a list of types the first, in lower case."""
    rows = records.where((F.col("kind") == "entity") & (F.size("fields") == 4))
    kind = F.regexp_replace(F.lower(F.split(normalize_name(F.get("fields", F.lit(2)), True), ",")[0]), " ", "")
    rows = _made(rows, name=normalize_name(F.get("fields", F.lit(1)), True), entity_type=kind, description=normalize_name(F.get("fields", F.lit(3))))
    return rows.where("name <> '' and description <> '' and entity_type <> '' and not entity_type rlike '[()<>|/\\\\\\\\]'").drop("fields", "kind")


def relation_records(records: DataFrame) -> DataFrame:
    """Valid relations (src, tgt, keywords, description, weight): five fields, different ends; a weight that is no number is 1."""
    rows = records.where((F.col("kind") == "relation") & (F.size("fields") >= 5))
    last = F.element_at("fields", -1)
    rows = _made(
        rows, src=normalize_name(F.get("fields", F.lit(1)), True), tgt=normalize_name(F.get("fields", F.lit(2)), True),
        keywords=F.regexp_replace(normalize_name(F.get("fields", F.lit(3)), True), "，", ","), description=normalize_name(F.get("fields", F.lit(4))),
    )
    weight = F.when((F.size("fields") > 5) & is_float(last), last.cast("double")).otherwise(F.lit(1.0))
    return rows.withColumn("weight", weight).where("src <> '' and tgt <> '' and src <> tgt").drop("fields", "kind")


def windows_with_offsets(df: DataFrame, text: str, size: int = 1200, overlap: int = 100) -> DataFrame:
    """(…, chunk_order_index, tokens, start, length, content): token windows of :func:`windows` as they stand in the text.

    ``content`` is the text from ``start`` (code points, from 0) on, white space inside kept, so a repeated passage has the
    place it was cut from.  Tokens are runs of other characters than ASCII white space; null texts have none.
    """
    if not 0 <= overlap < size:
        raise ValueError("the overlap must lie between 0 and the size")

    @F.arrow_udf("array<struct<tokens:int,start:long,length:long>>")
    def cut(texts: pa.Array) -> pa.Array:
        rows = []
        for t in texts.to_pylist():
            spans = [m.span() for m in _TOKEN.finditer(t or "")]
            own = [spans[i : i + size] for i in range(0, len(spans), size - overlap)]
            rows.append([{"tokens": len(w), "start": w[0][0], "length": w[-1][1] - w[0][0]} for w in own])
        return pa.array(rows, pa.list_(pa.struct([("tokens", pa.int32()), ("start", pa.int64()), ("length", pa.int64())])))

    out = df.select("*", F.posexplode(cut(text)).alias("chunk_order_index", "__span"))
    whole = F.substring(F.col(text), (F.col("__span.start") + 1).cast("int"), F.col("__span.length").cast("int"))
    return out.select("*", "__span.tokens", "__span.start", "__span.length", whole.alias("content")).drop("__span")


def section_units(df: DataFrame, key: str, text: str, is_title: Column, is_heading: Column, kinds: dict[str, Column]) -> DataFrame:
    """(unit_id, key, block, section, title, kind, start, length, line_start, line_end, content): texts cut into sections.

    ``is_title`` and ``is_heading`` are conditions on ``line``: a title opens a block and its first section, a heading
    another section of the block.  Lines before the first title are left out, but a text without any title is one block 0.
    ``kinds`` names conditions on ``content``, of which the first that holds counts, else ``unknown``.  Sections of a block
    follow each other without gap or overlap and cover it; empty ones (white space alone) have no unit.  ``start`` counts
    code points from 0, the lines' ends included in what they end; equal contents at other places have other ids.
    """
    lines = df.select(F.col(key).alias("key"), F.posexplode(F.split(text, "\n")).alias("line_no", "line"))
    lines = lines.withColumn("t", F.coalesce(is_title, F.lit(False))).withColumn("h", F.coalesce(is_heading, F.lit(False)))
    lines = lines.select("key", "line_no", F.char_length("line").alias("n"), "t", "h", F.when(F.col("t"), F.col("line")).alias("title"))
    w = Window.partitionBy("key").orderBy("line_no")
    lines = lines.withColumn("start", F.sum(F.col("n") + 1).over(w) - F.col("n") - 1).withColumn("block", F.sum(F.col("t").cast("long")).over(w))
    lines = lines.withColumn("cut", F.sum((F.col("t") | F.col("h")).cast("long")).over(w))
    spans = lines.groupBy("key", "block", "cut").agg(
        F.min("start").alias("start"), (F.max(F.col("start") + F.col("n") + 1) - F.min("start")).alias("length"), F.min("line_no").alias("line_start"), F.max("line_no").alias("line_end"), F.max("title").alias("title")
    )
    blocks = Window.partitionBy("key", "block").orderBy("cut")
    spans = spans.withColumn("section", F.row_number().over(blocks) - 1).withColumn("title", F.first("title", ignorenulls=True).over(blocks)).withColumn("last", F.max("block").over(Window.partitionBy("key")))
    # the spans of a text meet it once more as one row, so that texts are not carried along with every line
    spans = spans.where((F.col("block") > 0) | (F.col("last") == 0)).groupBy("key").agg(F.collect_list(F.struct("block", "section", "title", "start", "length", "line_start", "line_end")).alias("s"))
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("whole")).join(spans, "key").select("key", "whole", F.inline("s"))
    rows = rows.withColumn("content", F.substring(F.col("whole"), (F.col("start") + 1).cast("int"), F.col("length").cast("int"))).where("trim(translate(content, '\n\t\r', '   ')) <> ''")
    kind = F.lit("unknown")
    for name, holds in reversed(kinds.items()):
        kind = F.when(holds, F.lit(name)).otherwise(kind)
    unit = F.concat(F.lit("unit-"), F.md5(F.concat_ws(":", F.col("key").cast("string"), F.col("start").cast("string"), "content").cast("binary")))
    return rows.select(unit.alias("unit_id"), F.col("key").alias(key), "block", "section", "title", kind.alias("kind"), "start", F.char_length("content").cast("long").alias("length"), "line_start", "line_end", "content")


def enrich_units(units: DataFrame, objects: DataFrame, id: str = "unit_id", content: str = "content", most_words: int = 3) -> DataFrame:
    """Units with ``n_known`` and ``context``: JSON of the known objects (object_id, object_type, term) that a unit names.

    A term of up to ``most_words`` words is named where its words follow each other in the content, case aside.  Units and
    objects meet by an equi-join on such runs of words, so no unit is held against all objects.  Units that name nothing have
    an empty list.  Ids are distinct; terms of more words are not found.
    """
    tokens = F.regexp_extract_all(F.lower(content), F.lit(r"([^\x20\x09-\x0D.,;:!?()]+)"), F.lit(1))
    rows = units.select(F.col(id).alias("unit"), tokens.alias("w"))

    def of(n: int) -> Column:
        return F.when(F.size("w") >= n, F.transform(F.sequence(F.lit(1), F.size("w") - n + 1), lambda i: F.array_join(F.slice("w", i, n), " ")))

    runs = F.array_distinct(F.flatten(F.array_compact(F.array(*map(of, range(1, most_words + 1))))))
    terms = objects.select(F.lower(F.trim("term")).alias("run"), "object_id", "object_type").distinct()
    found = rows.select("unit", F.explode(runs).alias("run")).join(terms, "run").groupBy("unit").agg(F.array_sort(F.collect_set(F.struct("object_id", "object_type", F.col("run").alias("term")))).alias("known"))
    out = units.join(found.withColumnRenamed("unit", id), id, "left")
    known = F.coalesce("known", F.array().cast("array<struct<object_id:string,object_type:string,term:string>>"))
    return out.withColumn("n_known", F.size(known)).withColumn("context", F.to_json(F.struct(F.col(id).alias("unitId"), known.alias("knownObjects")))).drop("known")
