"""Edits of the graph by hand: creation, change, renaming, merging, removal, rebuilding and bulk import, as plans.

Nodes have an id and attributes; edges have src < tgt and attributes.  Each function gives the tables that come after.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.ids import content_id, high, low
from tessera.functions.text import SEP
from tessera.operators import aggregates, graph
from tessera.operators.ranking import first_of


def create_entities(nodes: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes with new ones (pos, id, description, ...), and (pos, id, outcome): created, exists, no_name or no_description.

    Of new rows with one id the first counts; the others exist then.
    """
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    known = nodes.select("id", F.lit(True).alias("__known"))
    fit = ~blank("id") & ~blank("description")
    first = new.where(fit).groupBy("id").agg(F.min("pos").alias("__first"))
    rows = new.join(known, "id", "left").join(first, "id", "left")
    outcome = (
        F.when(blank("id"), "no_name").when(F.col("__known") | (F.col("pos") > F.col("__first")), "exists").when(blank("description"), "no_description").otherwise("created")
    )
    rows = rows.withColumn("outcome", outcome)
    added = rows.where("outcome = 'created'").select(*[F.col(c) if c in new.columns else F.lit(None).cast(t).alias(c) for c, t in nodes.dtypes])
    return nodes.unionByName(added), rows.select("pos", "id", "outcome")


def create_relations(edges: DataFrame, nodes: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges with new ones (pos, a, b, ...), and (pos, a, b, outcome): created, exists, no_end or loop."""
    ids = nodes.select("id")
    has = lambda c: ids.select(F.col("id").alias(c), F.lit(True).alias(f"__{c}"))
    rows = graph.canonical(new.withColumn("src", F.col("a")).withColumn("tgt", F.col("b")))
    rows = rows.join(has("a"), "a", "left").join(has("b"), "b", "left").join(edges.select("src", "tgt", F.lit(True).alias("__known")), ["src", "tgt"], "left")
    first = rows.where("__a and __b and a <> b").groupBy("src", "tgt").agg(F.min("pos").alias("__first"))
    rows = rows.join(first, ["src", "tgt"], "left")
    outcome = F.when(F.col("a") == F.col("b"), "loop").when(F.col("__a").isNull() | F.col("__b").isNull(), "no_end")
    rows = rows.withColumn("outcome", outcome.when(F.col("__known") | (F.col("pos") > F.col("__first")), "exists").otherwise("created"))
    added = rows.where("outcome = 'created'").select(*[F.col(c) if c in rows.columns else F.lit(None).cast(t).alias(c) for c, t in edges.dtypes])
    return edges.unionByName(added), rows.select("pos", "a", "b", "outcome")


def edit_rows(table: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """A table with the columns of ``changes`` replaced where they are not null; keys that are not there change nothing."""
    put = [c for c in changes.columns if c not in keys]
    other = changes.select(*keys, *[F.col(c).alias(f"__{c}") for c in put])
    rows = table.join(other, keys, "left")
    return rows.select(*[F.coalesce(f"__{c}", c).alias(c) if c in put else F.col(c) for c in table.columns])


def edit_relations(edges: DataFrame, changes: DataFrame) -> DataFrame:
    """Edges with changes (a, b, ...) of pairs in either order."""
    return edit_rows(edges, graph.canonical(changes, "a", "b").withColumnsRenamed({"a": "src", "b": "tgt"}), ["src", "tgt"])


def delete_relations(edges: DataFrame, pairs: DataFrame) -> DataFrame:
    """Edges without pairs (a, b) in either order."""
    return edges.join(graph.canonical(pairs.select("a", "b"), "a", "b").withColumnsRenamed({"a": "src", "b": "tgt"}).distinct(), ["src", "tgt"], "left_anti")


def rename_entity(nodes: DataFrame, edges: DataFrame, old: str, new: str, allow_merge: bool = False) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges with an entity under another name.

    A name that another entity has is an error, or with ``allow_merge`` both become one (see :func:`merge_entities`).
    """
    if old == new:
        return nodes, edges
    if not nodes.where(F.col("id") == new).isEmpty():
        if not allow_merge:
            raise ValueError(f"there is an entity named {new}")
        return merge_entities(nodes, edges, [old], new)
    to = lambda c: F.when(F.col(c) == old, F.lit(new)).otherwise(F.col(c)).alias(c)
    moved = edges.select(*[to(c) if c in ("src", "tgt") else F.col(c) for c in edges.columns])
    return nodes.select(*[to(c) if c == "id" else F.col(c) for c in nodes.columns]), graph.canonical(moved).select(*edges.columns)


def merge_entities(nodes: DataFrame, edges: DataFrame, sources: list[str], target: str, strategies: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges with some entities merged into ``target``.

    Attributes merge by the named strategies of :func:`aggregates.merge_attributes`, the target's own first and then the
    sources' in order; others keep the first value, arrays become the union.  Edges are redirected, loops drop out, and edges
    that fall together merge as :func:`graph.merge_nodes` says.
    """
    names = [target, *[s for s in sources if s != target]]
    order = F.array_position(F.array(*map(F.lit, names)), F.col("id"))
    own = nodes.where(F.col("id").isin(names)).withColumn("__order", order).withColumn("__key", F.lit(target))
    kinds = dict(nodes.dtypes)
    ways = [aggregates.merged_value(c, kinds[c], (strategies or {}).get(c, "keep_first"), F.col("__order")).cast(kinds[c]).alias(c) for c in nodes.columns if c != "id"]
    merged = own.groupBy(F.col("__key").alias("id")).agg(*ways)  # as many rows as names
    rest = nodes.where(~F.col("id").isin(names))
    return rest.unionByName(merged.select(*nodes.columns)), graph.merge_nodes(edges, names, target)


def rebuild_entities(fragments: DataFrame, lost: DataFrame, cap: int = 300) -> DataFrame:
    """Entities that lose chunks (source_id), merged anew from the fragments of their other chunks; none is left of others.

    ``fragments`` are those of :func:`aggregates.merge_entities`.
    """
    gone = lost.select("source_id").distinct()
    hit = fragments.join(gone, "source_id", "left_semi").select("entity").distinct()
    left = fragments.join(hit, "entity", "left_semi").join(gone, "source_id", "left_anti")
    return aggregates.merge_entities(left, cap)


def describe_by_relations(nodes: DataFrame, edges: DataFrame, ids: DataFrame) -> DataFrame:
    """Nodes (id, description, ...) among ``ids`` that no fragment is left of, described by their edges (src, tgt, description).

    The different descriptions of a node's edges are joined in the order of the first other end that has them; a node whose
    edges say nothing keeps its own.
    """
    said = edges.where(F.coalesce("description", F.lit("")) != "")
    ends = F.explode(F.array(F.struct(F.col("src").alias("id"), F.col("tgt").alias("other")), F.struct(F.col("tgt").alias("id"), F.col("src").alias("other"))))
    told = said.select(ends.alias("e"), F.col("description").alias("d")).select("e.id", "e.other", "d").join(ids.select("id").distinct(), "id", "left_semi")
    # moved before they are sorted for the smallest end, so no task holds both what made its edges and a sort of their ends;
    # by both ends, since a node of many edges that say the same is more than a task should have
    once = told.repartition("id", "other").groupBy("id", "d").agg(F.min("other").alias("other"))
    lists = once.groupBy("id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("other", "d"))), lambda x: x["d"]), SEP).alias("__told"))
    found = nodes.join(ids.select("id").distinct(), "id", "left_semi").join(lists, "id", "left")
    return found.withColumn("description", F.coalesce("__told", "description")).select(*nodes.columns)


def rebuild_relations(fragments: DataFrame, lost: DataFrame) -> DataFrame:
    """Relations that lose chunks (source_id), merged anew from the fragments of their other chunks, of either direction."""
    gone = lost.select("source_id").distinct()
    pairs = fragments.withColumn("__a", low("src", "tgt")).withColumn("__b", high("src", "tgt"))
    hit = pairs.join(gone, "source_id", "left_semi").select("__a", "__b").distinct()
    left = pairs.join(hit, ["__a", "__b"], "left_semi").join(gone, "source_id", "left_anti").drop("__a", "__b")
    return aggregates.merge_relations(left)


def import_graph(chunks: DataFrame, entities: DataFrame, relations: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Chunks, nodes and edges of a graph that the caller made.

    Chunks (source_id, content) get content ids.  Entities (pos, name, entity_type, description, source_id) and relations
    (pos, src, tgt, description, keywords, weight, source_id) point at chunks by source id, unknown ones at ``UNKNOWN``; of
    rows with one name or pair the last counts.  Ends without an entity become nodes of unknown type.
    """
    cut = chunks.select(content_id("content", "chunk-").alias("id"), "content", "source_id")
    of = cut.groupBy("source_id").agg(F.min("id").alias("chunk_id"))
    at = lambda df: df.join(of, "source_id", "left").withColumn("chunk_id", F.coalesce("chunk_id", F.lit("UNKNOWN")))
    # the last row of each name or pair is found before chunks are joined, so the others never move to their chunks
    last = lambda df, *keys: df.groupBy(*keys).agg(F.max(F.struct("pos", *[c for c in df.columns if c not in ("pos", *keys)])).alias("r")).select(*keys, "r.*")
    nodes = at(last(entities, "name")).select(F.col("name").alias("id"), F.coalesce("entity_type", F.lit("UNKNOWN")).alias("entity_type"), F.coalesce("description", F.lit("")).alias("description"), "chunk_id")
    edges = at(first_of(graph.canonical(relations), ["src", "tgt"], F.desc("pos"))).select("src", "tgt", "description", "keywords", F.coalesce("weight", F.lit(1.0)).alias("weight"), "chunk_id")
    ends = edges.select(F.explode(F.array("src", "tgt")).alias("id"), "chunk_id").groupBy("id").agg(F.min("chunk_id").alias("chunk_id"))
    ends = ends.join(nodes.select("id"), "id", "left_anti").select("id", F.lit("UNKNOWN").alias("entity_type"), F.lit("UNKNOWN").alias("description"), "chunk_id")
    return cut, nodes.unionByName(ends), edges


def import_chunks(stored: DataFrame, doc_id: str, chunks: DataFrame) -> DataFrame:
    """Chunk rows (id, full_doc_id, content) of a text that the caller cut; those that are stored already drop out."""
    rows = chunks.select(content_id("content", "chunk-").alias("id"), F.lit(doc_id).alias("full_doc_id"), "content").dropDuplicates(["id"])
    return rows.join(stored.select("id"), "id", "left_anti")


def batches(relations: DataFrame, size: int, order: str = "pos") -> DataFrame:
    """(batch, kind, key): relations dealt into batches of at most ``size`` by a dense number column, and each batch's ends."""
    dealt = relations.withColumn("batch", F.floor(F.col(order) / size))
    own = dealt.select("batch", F.lit("relation").alias("kind"), F.concat("src", F.lit(SEP), "tgt").alias("key"))
    ends = dealt.select("batch", F.lit("entity").alias("kind"), F.explode(F.array("src", "tgt")).alias("key")).distinct()
    return own.unionByName(ends)


def track_chunks(rows: DataFrame, key: str, sources: str = "source_ids") -> DataFrame:
    """(key, chunk_ids, count): tracking rows from the source lists of nodes or edges; rows without sources have none."""
    ids = rows.select(key, F.explode(sources).alias("c")).where("c is not null and trim(c) <> ''")
    return ids.groupBy(key).agg(F.array_sort(F.collect_set("c")).alias("chunk_ids")).withColumn("count", F.size("chunk_ids"))
