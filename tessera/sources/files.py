"""Files in and out: documents of a directory, term registries, graph imports, exports."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TEXT_SUFFIXES = ("txt", "md", "mdx", "html", "htm", "json", "jsonl", "csv", "tsv", "xml", "yaml", "yml", "log", "py", "java", "sql", "rst", "tex")
OFFICE_SUFFIXES = ("docx", "pptx", "xlsx")
GRAPH_ROWS = 500_000  # nodes or edges of a GraphML file at most: a task reads files whole
_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_A = "{http://schemas.openxmlformats.org/drawingml/2006/main}"
_S = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"


def _docx(data: bytes) -> str:
    """Paragraphs and tables in document order; cells are tab-delimited."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        body = ElementTree.fromstring(z.read("word/document.xml")).find(f"{_W}body")
    text = lambda e: "".join(t.text or "" for t in e.iter(f"{_W}t"))
    out = []
    for e in body:
        if e.tag == f"{_W}p":
            out.append(text(e))
        elif e.tag == f"{_W}tbl":
            for row in e.iter(f"{_W}tr"):
                out.append("\t".join(text(c).replace("\\", "\\\\").replace("\t", "\\t").replace("\n", "\\n") for c in row.iter(f"{_W}tc")))
    return "\n".join(out)


def _pptx(data: bytes) -> str:
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = sorted((n for n in z.namelist() if n.startswith("ppt/slides/slide")), key=lambda n: (len(n), n))
        return "\n".join("".join(t.text or "" for t in p.iter(f"{_A}t")) for n in names for p in ElementTree.fromstring(z.read(n)).iter(f"{_A}p"))


def _xlsx(data: bytes) -> str:
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in s.iter(f"{_S}t")) for s in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{_S}si")]
        out = []
        for n in sorted((n for n in z.namelist() if n.startswith("xl/worksheets/sheet")), key=lambda n: (len(n), n)):
            out.append(f"===== {n.rsplit('/', 1)[1][:-4]} =====")
            for row in ElementTree.fromstring(z.read(n)).iter(f"{_S}row"):
                cells = []
                for c in row.iter(f"{_S}c"):
                    v = c.find(f"{_S}v")
                    value = "".join(t.text or "" for t in c.iter(f"{_S}t")) if v is None else v.text or ""
                    cells.append(shared[int(value)] if c.get("t") == "s" else value)
                out.append("\t".join(cells))
    return "\n".join(out)


def read_directory(spark: SparkSession, path: str) -> DataFrame:
    """(file_path, text, error) of the files under a directory; text is null where a file cannot be read, with the reason."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, errors = [], []
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                suffix = name.rsplit(".", 1)[-1].lower()
                try:
                    if suffix in TEXT_SUFFIXES:
                        text = data.decode("utf-8")
                    else:
                        text = {"docx": _docx, "pptx": _pptx, "xlsx": _xlsx}[suffix](data)
                    texts.append(text if text.strip() else None)
                    errors.append(None if text.strip() else "empty file")
                except KeyError:
                    texts.append(None)
                    errors.append(f"unsupported file type: {suffix}")
                except Exception as e:  # a broken file becomes a failed row and not a failed job
                    texts.append(None)
                    errors.append(f"{type(e).__name__}: {e}"[:500])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(errors, pa.string())], ["file_path", "text", "error"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(F.col("path").alias("file_path"), "content").mapInArrow(read, "file_path string, text string, error string")


def discover(spark: SparkSession, path: str) -> DataFrame:
    """(file_path, hash, role): files of a directory, one for each content; the role comes from the path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    rows = files.select(F.col("path").alias("file_path"), F.sha2("content", 256).alias("hash"))
    first = rows.withColumn("n", F.row_number().over(Window.partitionBy("hash").orderBy("file_path"))).where("n = 1").drop("n")
    low = F.lower("file_path")
    return first.withColumn("role", F.when(low.contains("test"), "TEST").when(low.contains("spec"), "SPEC").otherwise("SOURCE"))


TERM_COLUMNS = (
    "module_code string, system_name string, domain_code string, feature_key string, object_type string, source_term string, canonical_term string, source_language string, canonical_language string, "
    "synonym_type string, confidence double, status string, requires_scope boolean, effective_from string, effective_to string, owner string, comments string"
)


def term_registry(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).schema(TERM_COLUMNS).csv(path)


def read_graphml(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of a GraphML file, each with its data as a map; edges are brought to canonical order."""
    keys = spark.read.format("xml").option("rowTag", "node").option("recursiveFileLookup", True).option("attributePrefix", "_").schema("_id string, data array<struct<_VALUE:string,_key:string>>").load(path)
    edges = spark.read.format("xml").option("rowTag", "edge").option("recursiveFileLookup", True).option("attributePrefix", "_").schema("_source string, _target string, data array<struct<_VALUE:string,_key:string>>").load(path)
    data = F.map_from_entries(F.transform(F.coalesce("data", F.array().cast("array<struct<_VALUE:string,_key:string>>")), lambda d: F.struct(d["_key"], d["_VALUE"])))
    return (
        keys.select(F.col("_id").alias("id"), data.alias("properties")),
        edges.select(F.least("_source", "_target").alias("src"), F.greatest("_source", "_target").alias("tgt"), data.alias("properties")),
    )


def export(rows: DataFrame, path: str, kind: str) -> None:
    """Write rows as csv, json, md (a table a file part) or txt (``name: value`` lines); other kinds are an error."""
    if kind == "csv":
        rows.write.mode("overwrite").option("header", True).csv(path)
    elif kind == "json":
        rows.write.mode("overwrite").json(path)
    elif kind == "md":
        cell = lambda c: F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("|"), F.lit("\\|"))
        rows.select(F.concat(F.lit("| "), F.concat_ws(" | ", *map(cell, rows.columns)), F.lit(" |")).alias("value")).write.mode("overwrite").text(path)
    elif kind == "txt":
        rows.select(F.concat_ws("\n", *[F.concat(F.lit(f"{c}: "), F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in rows.columns], F.lit("")).alias("value")).write.mode("overwrite").text(path)
    else:
        raise ValueError(f"unknown export format: {kind}")


def write_graphml(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """Nodes (id, ...) and edges (src, tgt, ...) as GraphML: two folders of files of at most ``GRAPH_ROWS`` each, each a graph by itself, that
    :func:`read_graphml` reads as one.  Null attributes are left out; what an earlier call wrote there is replaced."""
    from xml.sax.saxutils import escape, quoteattr

    head, tail = '<graphml xmlns="http://graphml.graphdrawing.org/xmlns"><graph edgedefault="undirected">', "</graph></graphml>"

    def element(kind: str, names: list[str], ends: int):
        marks = ("id",) if kind == "node" else ("source", "target")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lines, n = [head], 0
            for b in batches:
                for row in zip(*(c.to_pylist() for c in b.columns)):
                    if n and n % GRAPH_ROWS == 0:
                        lines += [tail, head]
                    n += 1
                    own = " ".join(f"{m}={quoteattr(v)}" for m, v in zip(marks, row))
                    data = "".join(f'<data key="{n}">{escape(v)}</data>' for n, v in zip(names[ends:], row[ends:]) if v is not None)
                    lines.append(f"<{kind} {own}>{data}</{kind}>")
                yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["value"])
                lines = []
            yield pa.RecordBatch.from_arrays([pa.array([*lines, tail])], ["value"])

        return run

    for df, kind, ends in ((nodes, "node", ["id"]), (edges, "edge", ["src", "tgt"])):
        names = [*ends, *[c for c in df.columns if c not in ends]]
        rows = df.select(*[F.col(c).cast("string").alias(c) for c in names])
        rows.mapInArrow(element(kind, names, len(ends)), "value string").write.mode("overwrite").option("maxRecordsPerFile", GRAPH_ROWS + 2).text(f"{path}/{kind}s")
