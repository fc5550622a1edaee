"""Point and batch lookups, filters and paging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.ids import content_id, high, low, relation_ids

STATUSES = ("pending", "processing", "preprocessed", "processed", "failed")
SORT_FIELDS = ("created_at", "updated_at", "id", "file_path")


def get_by_id(table: DataFrame, id_: str) -> DataFrame:
    """The row of an id, with 0 for missing times."""
    row = table.where(F.col("id") == id_)
    for c in ("create_time", "update_time"):
        row = row.withColumn(c, F.coalesce(F.col(c), F.lit(0)) if c in table.columns else F.lit(0))
    return row


def get_by_ids(table: DataFrame, wanted: DataFrame, id_: str = "id", pos: str = "pos") -> DataFrame:
    """One row for each row of ``wanted`` (pos, id), in its order; missing ids have nulls."""
    return wanted.join(table, id_, "left").orderBy(pos)


def missing_keys(wanted: DataFrame, table: DataFrame, id_: str = "id") -> DataFrame:
    """Keys that are not stored yet."""
    return wanted.select(id_).distinct().join(table.select(id_), id_, "left_anti")


def existing_keys(wanted: DataFrame, table: DataFrame, id_: str = "id") -> DataFrame:
    return wanted.select(id_).distinct().join(table.select(id_), id_, "left_semi")


def by_status(docs: DataFrame, statuses: list[str]) -> DataFrame:
    """Rows with one of some statuses, with defaults for an empty path and missing metadata, without content."""
    out = docs.where(F.col("status").isin(*statuses))
    path = F.coalesce(F.nullif(F.trim("file_path"), F.lit("")), F.lit("no-file-path"))
    return out.withColumn("file_path", path).drop("content")


def by_track(docs: DataFrame, track_id: str) -> DataFrame:
    """Rows that came in under a track id."""
    return docs.where(F.col("track_id") == track_id)


def emptiness(tables: dict[str, DataFrame]) -> DataFrame:
    """(name, is_empty) of some tables, of each of which one row is looked for."""
    out = None
    for name, df in tables.items():
        one = df.limit(1).agg((F.count(F.lit(1)) == 0).alias("is_empty")).select(F.lit(name).alias("name"), "is_empty")
        out = one if out is None else out.unionByName(one)
    return out


def issues(table: DataFrame, **equal: str) -> DataFrame:
    """Issues with given values of some columns (document_id, source_us_id, semantic_object_id, issue_type), by id."""
    for c, v in equal.items():
        table = table.where(F.col(c) == v)
    return table.orderBy("issue_id")


def by_path(docs: DataFrame, path: str) -> DataFrame:
    """The first row, by id, of a file path."""
    return docs.where(F.col("file_path") == path).orderBy("id").limit(1)


def has_edge(edges: DataFrame, a: str, b: str) -> DataFrame:
    """The edge between two nodes in either order."""
    return edges.where((F.col("src") == low(F.lit(a), F.lit(b))) & (F.col("tgt") == high(F.lit(a), F.lit(b))))


def search_labels(nodes: DataFrame, query: str, limit: int = 50, label: str = "id") -> DataFrame:
    """Labels that contain a text, best first.

    An exact match scores 1000, a prefix 500, else 100 less the label's length, and 50 more where a word begins with the
    text.  Ties are in label order; a blank text finds nothing.
    """
    q = query.strip().lower()
    name = F.lower(F.col(label))
    inner = F.contains(name, F.lit(" " + q)) | F.contains(name, F.lit("_" + q))
    score = F.when(name == q, 1000).when(name.startswith(q), 500).otherwise(100 - F.char_length(label) + F.when(inner, 50).otherwise(0))
    hits = nodes.where(F.contains(name, F.lit(q)) if q else F.lit(False))
    return hits.select(F.col(label).alias("label"), score.alias("score")).orderBy(F.desc("score"), "label").limit(limit)


def paginate(docs: DataFrame, page: int = 1, page_size: int = 50, sort: str = "updated_at", descending: bool = True, status: str | None = None) -> DataFrame:
    """A page of rows and the total: also where the page is empty the total stays, in one row of nulls.

    Page and size are clamped (from 1; 10 to 200), unknown sort fields become ``updated_at``, nulls come last and ids break
    ties.
    """
    page, page_size = max(page, 1), min(max(page_size, 10), 200)
    sort = sort if sort in SORT_FIELDS else "updated_at"
    rows = docs.where(F.col("status") == status) if status else docs
    by = F.col(sort).desc_nulls_last() if descending else F.col(sort).asc_nulls_last()
    part = rows.orderBy(by, "id").offset((page - 1) * page_size).limit(page_size)
    total = rows.agg(F.count(F.lit(1)).alias("total"))
    return total.join(F.broadcast(part), F.lit(True), "left")  # at most 200 rows beside one


def relation_info(relations: DataFrame, pairs: DataFrame) -> DataFrame:
    """Relation rows of pairs (a, b), found under the id of the canonical order or else of the reverse."""
    # ids move as the 16 bytes that they are made of, and are written out again at the end
    raw = lambda c: F.unhex(F.substring(c, 5, 32))
    known = relations.where(F.col("id") == F.concat(F.lit("rel-"), F.lower(F.hex(raw("id"))))).select(raw("id").alias("raw"))
    tries = pairs.select("a", "b", F.posexplode(F.transform(relation_ids("a", "b"), raw)).alias("try", "raw"))
    hits = tries.join(known, "raw", "left_semi").groupBy("a", "b").agg(F.min("try").alias("try"))
    return hits.select("a", "b", F.element_at(relation_ids("a", "b"), F.col("try") + 1).alias("id"))


def entity_info(nodes: DataFrame, vectors: DataFrame, name: str) -> DataFrame:
    node = nodes.where(F.col("id") == name).withColumn("vector_id", content_id("id", "ent-"))
    return node.join(vectors.select(F.col("id").alias("vector_id"), "vector"), "vector_id", "left")


def in_scope(strict: bool, **scope: str | None) -> Column:
    """A predicate that holds where every given part of the scope agrees; without ``strict`` it always holds."""
    out = F.lit(True)
    if strict:
        for c, v in scope.items():
            if v is not None:
                out = out & (F.coalesce(F.col(c), F.lit("")) == v)
    return out


def channel(candidates: DataFrame, name: str, include_historical: bool = False) -> DataFrame:
    """The candidates of a retrieval channel, each with the trust that the channel allows."""
    c = candidates.where(~F.col("deleted"))
    if name == "RAW_TEXT":
        c = c.where((F.col("channel") == "RAW_TEXT") & ~F.contains("text", F.lit("<DSL_CONTEXT>")))
        return c if include_historical else c.where("active")
    if name == "TRUSTED":
        return c.where(F.col("channel").isin("PFSS_ENTITY", "PFSS_RELATION", "PFSS_PATH"))
    if name == "GENERIC_GRAPH":
        return c.where(F.col("channel") == name).withColumn("factual_weight", F.least("factual_weight", F.lit(0.2))).withColumn("trust_tier", F.lit("T4"))
    return c.where(F.col("channel").isin("ISSUE_SIDECAR", "VERSION_CONTEXT")).withColumn("factual_weight", F.lit(0.0)).withColumn("trust_tier", F.lit("T5"))
