"""Tables in and out of a workspace: JSON that any reader takes, whole graphs as csv, sheets, md or txt, caches between stores."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from xml.sax.saxutils import escape, quoteattr

import pyarrow as pa
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.ids import content_id, high, low
from tessera.functions.text import SEP
from tessera.sources.tables import Store

#: A sheet holds no more rows than this, its header among them.
SHEET_ROWS = 1_048_576
#: A csv file holds no more rows than this: values may span lines, so readers do not split a file.
CSV_ROWS = 500_000
_WORKBOOK = '<?xml version="1.0" encoding="UTF-8"?><Workbook xmlns="urn:schemas-microsoft-com:office:spreadsheet" xmlns:ss="urn:schemas-microsoft-com:office:spreadsheet">'


def _readable(c: Column, kind: T.DataType) -> Column:
    """A column whose texts, however deep they are nested, have no bytes that are no UTF-8; well-formed ones stay as they are."""
    if isinstance(kind, T.StringType):
        return F.when(F.is_valid_utf8(c), c).otherwise(F.replace(F.make_valid_utf8(c), F.lit("�"), F.lit("")))
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: _readable(x, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.transform_values(c, lambda _, v: _readable(v, kind.valueType))
    if isinstance(kind, T.StructType):
        return F.when(c.isNotNull(), F.struct(*[_readable(c[f.name], f.dataType).alias(f.name) for f in kind.fields]))
    return c


def _broken(c: Column, kind: T.DataType) -> Column:
    """Whether a column holds a text that :func:`_readable` changes."""
    if isinstance(kind, T.StringType):
        found = ~F.is_valid_utf8(c)
    elif isinstance(kind, T.ArrayType):
        found = F.exists(c, lambda x: _broken(x, kind.elementType))
    elif isinstance(kind, T.MapType):
        found = F.exists(F.map_values(c), lambda v: _broken(v, kind.valueType))
    elif isinstance(kind, T.StructType):
        found = reduce(lambda a, b: a | b, [_broken(c[f.name], f.dataType) for f in kind.fields], F.lit(False))
    else:
        found = F.lit(False)
    return F.coalesce(found, F.lit(False))


def write_json(rows: DataFrame, path: str) -> int:
    """Write rows as JSON lines; returns how many of them held bytes that are no UTF-8, which are left out.

    Above 0 the file differs from the caller's rows, which should be read again.  Rows are repaired and counted in the pass
    that writes them.  Keys of maps are taken as they are.
    """
    seen = Observation()
    fields = rows.schema.fields
    broken = reduce(lambda a, b: a | b, [_broken(F.col(f"`{f.name}`"), f.dataType) for f in fields], F.lit(False))
    counted = rows.observe(seen, F.count_if(broken).alias("n"))
    counted.select(*[_readable(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in fields]).write.mode("overwrite").json(path)
    return seen.get["n"]


def load_json(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """Rows of a JSON file or folder, of one document or of lines; None where there is nothing at the path."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return None
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.option("multiLine", True).json(path) if path.endswith(".json") else reader.json(path)


def graph_sections(nodes: DataFrame, edges: DataFrame, vectors: bool = False) -> dict[str, DataFrame]:
    """The three parts of an export: entities, relations from both ends (none to itself), and what the relation index holds.

    Data of nodes and edges stand in one JSON column; with ``vectors`` their vectors stand in another.
    """
    data = lambda df, *out: F.to_json(F.struct(*[c for c in df.columns if c not in (*out, "vector")]))
    vector = lambda df, id_: [F.to_json(F.struct(id_.alias("id"), "vector")).alias("vector_data")] if vectors and "vector" in df.columns else []
    source = F.concat_ws(SEP, "source_ids").alias("source_id")
    key = content_id(F.concat(low("src", "tgt"), high("src", "tgt")), "rel-")
    held = edges.select("src", "tgt", source, data(edges).alias("graph_data"), *vector(edges, key))
    pairs = F.array(F.struct("src", "tgt"), F.struct(F.col("tgt").alias("src"), F.col("src").alias("tgt")))
    turned = held.where("src <> tgt").select(F.explode(pairs).alias("pair"), *held.columns[2:])
    return {
        "entities": nodes.select(F.col("id").alias("entity_name"), source, data(nodes).alias("graph_data"), *vector(nodes, content_id("id", "ent-"))),
        "relations": turned.select(F.col("pair.src").alias("src_entity"), F.col("pair.tgt").alias("tgt_entity"), *held.columns[2:]),
        "relationships": edges.select(key.alias("relationship_id"), data(edges, "source_ids").alias("data")),
    }


def _table(names: list[str], title: str, kind: str):
    """Writes batches of a section as lines: of a Markdown table, of ``name: value`` lists, or of sheets of a workbook.

    Every task's lines are whole by themselves: a table with its header, a workbook with as many sheets as its rows need.
    """

    def cells(values, tag: str = "String") -> str:
        return "<Row>" + "".join(f'<Cell><Data ss:Type="{tag}">{escape(v or "")}</Data></Cell>' for v in values) + "</Row>"

    def lines(rows: Iterator[tuple]) -> Iterator[str]:
        if kind == "md":
            yield from (f"## {title}", "", "| " + " | ".join(names) + " |", "|" + " --- |" * len(names))
            yield from ("| " + " | ".join((v or "").replace("|", "\\|").replace("\n", " ") for v in row) + " |" for row in rows)
            yield ""
        elif kind == "txt":
            for row in rows:
                yield from (f"{n}: {v or ''}" for n, v in zip(names, row))
                yield ""
        else:
            yield _WORKBOOK
            for n, row in enumerate(rows):
                if n % (SHEET_ROWS - 1) == 0:
                    yield ("</Table></Worksheet>" if n else "") + f"<Worksheet ss:Name={quoteattr(title if n == 0 else f'{title} {n // (SHEET_ROWS - 1) + 1}')}><Table>{cells(names)}"
                yield cells(row)
            yield "</Table></Worksheet></Workbook>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns)))
        first = next(rows, None)
        if first is None:
            return
        out: list[str] = []
        for line in lines(row for part in ((first,), rows) for row in part):
            out.append(line)
            if len(out) == 1_000:
                yield pa.RecordBatch.from_arrays([pa.array(out)], ["value"])
                out = []
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])

    return run


def export_sections(sections: dict[str, DataFrame], path: str, kind: str = "csv", compression: str = "none") -> None:
    """Write each section into a folder of its own under a path: as csv, md, txt or excel; other kinds are an error.

    Excel stands for spreadsheets in XML, which Excel opens and Spark can write in parts; each part is a workbook.  An empty
    section gives a folder without tables.  Sections say the same things several times over, so large ones are best written
    with a compression (gzip), which readers know by the ending of the files.
    """
    if kind not in ("csv", "excel", "md", "txt"):
        raise ValueError(f"unknown export format: {kind}")
    for name, rows in sections.items():
        texts = rows.select(*[F.col(c).cast("string").alias(c) for c in rows.columns])
        if kind == "csv":
            texts.write.mode("overwrite").option("header", True).option("escape", '"').option("maxRecordsPerFile", CSV_ROWS).option("compression", compression).csv(f"{path}/{name}")
        else:
            texts.mapInArrow(_table(rows.columns, name.capitalize(), kind), "value string").write.mode("overwrite").option("compression", compression).text(f"{path}/{name}")


def copy_cache(source: Store, target: Store, kinds: tuple[str, ...] = ("extract", "summary"), batches: int = 4) -> DataFrame:
    """Copy kept answers of the default mode from one workspace to another, in batches of the source's buckets.

    Returns (batch, n, error): a batch that cannot be written is noted, with the reason and no rows, and the next one goes on.
    Each is a commit of its own, so a copy that was broken off and is called again writes the same rows again to the same
    effect; only the folders of its buckets are read for it.  A cache of many TB wants as many batches as buckets.
    """
    table = "llm_response_cache"
    entry = source.manifest()["tables"].get(table)
    done = []
    buckets = sorted(map(int, (entry or {}).get("folders", {})))
    for batch in range(min(batches, len(buckets))):
        try:
            rows = source.load(table, entry, set(buckets[batch::batches])).where(F.substring_index("id", ":", 2).isin(*[f"default:{k}" for k in kinds]))
            n = rows.count()
            if n:
                target.change(table, rows)
            done.append((batch, n, None))
        except (PySparkException, OSError, RuntimeError) as e:
            done.append((batch, 0, f"{type(e).__name__}: {e}"[:500]))
    return source.spark.createDataFrame(done, "batch int, n long, error string")
