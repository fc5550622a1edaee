"""Joins beyond key lookups: expansions between entities, relations and chunks, intervals, time, scopes and differences."""

from __future__ import annotations

from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators import graph
from tessera.operators.ranking import first_of


def local_entities(hits: DataFrame, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Vector hits (id, pos) with their nodes and degrees as rank, in the order of the hits; hits without nodes drop out."""
    rows = hits.join(nodes, "id")
    return rows.join(graph.degrees(edges).withColumnRenamed("node", "id"), "id", "left").withColumn("rank", F.coalesce("degree", F.lit(0))).drop("degree")


def entity_edges(hits: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges at hit entities, each once, with both degrees' sum as rank; best by rank, weight, then ends."""
    return ranked_edges(touched_edges(hits, edges), edges)


def touched_edges(hits: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges at hit entities (id), each once."""
    at = hits.select(F.col("id").alias("node")).distinct()
    return edges.join(at.withColumnRenamed("node", "src"), "src", "left_semi").unionByName(edges.join(at.withColumnRenamed("node", "tgt"), "tgt", "left_semi").join(at.withColumnRenamed("node", "src"), "src", "left_anti"))


def ranked_edges(whole: DataFrame, edges: DataFrame) -> DataFrame:
    """Some edges with the sum of their ends' degrees among all edges as rank; best by rank, weight, then ends."""
    # degrees of the touched ends alone: other ends drop out before they are counted
    ends = graph.endpoints(whole).select("node").distinct()
    d = graph.endpoints(edges).join(ends, "node", "left_semi").groupBy("node").agg(F.count(F.lit(1)).alias("degree"))
    a, b = d.select(F.col("node").alias("src"), F.col("degree").alias("d1")), d.select(F.col("node").alias("tgt"), F.col("degree").alias("d2"))
    return whole.join(a, "src").join(b, "tgt").withColumn("rank", F.col("d1") + F.col("d2")).drop("d1", "d2").orderBy(F.desc("rank"), F.desc("weight"), "src", "tgt")


def edge_entities(edge_hits: DataFrame, nodes: DataFrame) -> DataFrame:
    """Nodes at edge hits (src, tgt, pos) in the order in which they come first, sources before targets."""
    ends = edge_hits.select("pos", F.posexplode(F.array("src", "tgt")).alias("side", "id"))
    once = first_of(ends, ["id"], "pos", "side")
    return once.join(nodes, "id")


def owned_chunks(owners: DataFrame, chunks: DataFrame, id_: str = "id", sources: str = "source_ids") -> DataFrame:
    """Chunks of ranked owners (id, pos, source_ids): each with its first owner and with how many owners refer to it."""
    refs = owners.select(F.col(id_).alias("owner"), F.col("pos").alias("owner_pos"), F.posexplode(sources).alias("chunk_pos", "chunk_id"))
    w = Window.partitionBy("chunk_id")
    counted = refs.withColumn("occurrences", F.count(F.lit(1)).over(w))
    return first_of(counted, ["chunk_id"], "owner_pos", "chunk_pos").join(chunks, "chunk_id")


def owned_chunks_without(owners: DataFrame, chunks: DataFrame, taken: DataFrame) -> DataFrame:
    """The same without chunks (chunk_id) that are taken already."""
    return owned_chunks(owners, chunks).join(taken.select("chunk_id"), "chunk_id", "left_anti")


def cached_extractions(chunks: DataFrame, cache: DataFrame) -> DataFrame:
    """Cache rows of extraction for chunks (chunk_id, llm_cache_list), by time within the chunk's earliest time."""
    keys = chunks.select("chunk_id", F.explode("llm_cache_list").alias("key"))
    rows = keys.join(cache.where("cache_type = 'extract'"), ["key", "chunk_id"])
    first = F.min("create_time").over(Window.partitionBy("chunk_id"))
    return rows.withColumn("chunk_time", first)


def overlaps(a: DataFrame, b: DataFrame, group: str, width: int = 2_000) -> DataFrame:
    """Pairs of half-open intervals (a_id, start, end) and (b_id, start, end) of one group that overlap, and by how much.

    Both sides are dealt into blocks of ``width`` offsets, so the join is on equal keys; a pair is put out in the block where
    its overlap begins.  Ratios have six decimals; the type says which side holds the other.
    """
    span = lambda s, e: F.explode(F.sequence(F.floor(F.col(s) / width), F.floor((F.greatest(F.col(e), F.col(s) + 1) - 1) / width)))
    left = a.select(group, "a_id", F.col("start").alias("a0"), F.col("end").alias("a1")).withColumn("block", span("a0", "a1"))
    right = b.select(group, "b_id", F.col("start").alias("b0"), F.col("end").alias("b1")).withColumn("block", span("b0", "b1"))
    both = left.join(right, [group, "block"]).where("a0 < b1 and b0 < a1")
    begin, end = F.greatest("a0", "b0"), F.least("a1", "b1")
    both = both.where(F.floor(begin / width) == F.col("block"))
    n = end - begin
    kind = (
        F.when(F.expr("a0 = b0 and a1 = b1"), "FULL").when(F.expr("a0 <= b0 and a1 >= b1"), "CONTAINS").when(F.expr("b0 <= a0 and b1 >= a1"), "PARTIAL").otherwise("OVERLAPS")
    )
    return both.select(
        group, "a_id", "b_id", begin.alias("overlap_start"), end.alias("overlap_end"), n.alias("overlap"),
        F.round(n / F.greatest(F.col("a1") - F.col("a0"), F.lit(1)), 6).alias("a_ratio"), F.round(n / F.greatest(F.col("b1") - F.col("b0"), F.lit(1)), 6).alias("b_ratio"), kind.alias("link_type"),
    )


def valid_at(at: Column) -> Column:
    """Whether a half-open validity (valid_from, valid_to) holds a time; a null start never does, a null end is open."""
    return F.coalesce((F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (at < F.col("valid_to"))), F.lit(False))


def resolve_terms(terms: DataFrame, registry: DataFrame, scope: list[str]) -> DataFrame:
    """The registry entry of each term (key and scope columns): scopes must agree where the entry names them; of several
    entries the one that names most wins, then a confirmed one, then the more confident, then the id.

    Only the best entry of each key and set of named scopes can win, so the others go before the join; a term meets the rest
    by equal keys, once for each choice of scopes that an entry may name.  So the cost grows with both tables and not with
    how many entries share a key.
    """
    columns = [f"r_{c}" for c in scope]
    r = registry.select("key", *[F.col(c).alias(f"r_{c}") for c in scope], "canonical", "status", "confidence", "entry_id")
    better = ((F.col("status") == "CONFIRMED").desc(), F.desc("confidence"), "entry_id")
    r = first_of(r, ["key", *columns], *better)
    naming = F.array(*[F.col(c).isNotNull() for c in columns])
    choices = F.array(*[F.array(*map(F.lit, held)) for held in product((False, True), repeat=len(scope))])
    asked = terms.withColumn("__named", F.explode(choices))
    for i, c in enumerate(scope):
        asked = asked.where(~F.col("__named")[i] | F.col(c).isNotNull())
    meets = [F.col("key") == F.col("__key"), F.col("__named") == F.col("__naming")]
    meets += [F.when(F.col("__named")[i], F.col(c)).eqNullSafe(F.col(f"r_{c}")) for i, c in enumerate(scope)]
    rows = asked.join(r.withColumn("__naming", naming).withColumnRenamed("key", "__key"), reduce(lambda x, y: x & y, meets)).drop("__key", "__naming")
    rows = rows.withColumn("specificity", F.size(F.filter("__named", lambda x: x))).drop("__named")
    best = first_of(rows, ["term_id"], F.desc("specificity"), *better)
    return best.drop(*columns)


def check_signatures(relations: DataFrame, signatures: DataFrame) -> DataFrame:
    """Relations (relation_type, src_type, tgt_type) with a code: OK, UNKNOWN_ or INVALID_RELATION_SIGNATURE."""
    known = signatures.groupBy("relation_type").agg(F.collect_set(F.concat_ws(">", "src_type", "tgt_type")).alias("allowed"))
    rows = relations.join(F.broadcast(known), "relation_type", "left")  # one row a relation type
    code = (
        F.when(F.col("allowed").isNull(), "UNKNOWN_RELATION_SIGNATURE")
        .when(F.array_contains("allowed", F.concat_ws(">", "src_type", "tgt_type")), "OK")
        .otherwise("INVALID_RELATION_SIGNATURE")
    )
    return rows.withColumn("code", code).drop("allowed")


def difference(old: DataFrame, new: DataFrame, key: str = "stable_id") -> DataFrame:
    """(key, change): ADDED, REMOVED, UPDATED or UNCHANGED by the hash of each side."""
    o, n = old.select(key, F.col("hash").alias("old_hash")), new.select(key, F.col("hash").alias("new_hash"))
    change = (
        F.when(F.col("old_hash").isNull(), "ADDED").when(F.col("new_hash").isNull(), "REMOVED").when(F.col("old_hash") == F.col("new_hash"), "UNCHANGED").otherwise("UPDATED")
    )
    return o.join(n, key, "full_outer").select(key, change.alias("change"))


def conflicts(items: DataFrame, group: str, opposites: list[tuple[str, str]]) -> DataFrame:
    """Items of a group whose texts hold a word that others' texts hold the opposite of: (group, topic, item_id, n_opposed, opposed).

    One row for an item, topic and side, with how many items of the group stand against it and the smallest of them, so a hot
    group costs as many rows as it has items and no pairs.  An item that holds both words does not stand against itself.
    """
    sides = None
    for i, (x, y) in enumerate(opposites):
        for side, word in ((0, x), (1, y)):
            some = items.where(F.contains(F.lower("text"), F.lit(word))).select(group, "item_id", F.lit(i).alias("topic"), F.lit(side).alias("side"))
            sides = some if sides is None else sides.unionByName(some)
    sides = sides.distinct()
    # the two smallest ids of a side tell the smallest other one of every item
    ids = sides.groupBy(group, "topic", "side").agg(F.count(F.lit(1)).alias("n"), F.min("item_id").alias("first"))
    seconds = sides.join(ids, [group, "topic", "side"]).where("item_id <> first").groupBy(group, "topic", "side").agg(F.min("item_id").alias("second"))
    other = ids.join(seconds, [group, "topic", "side"], "left").withColumn("side", 1 - F.col("side"))
    both = sides.groupBy(group, "topic", "item_id").agg((F.count(F.lit(1)) > 1).alias("is_both"))
    rows = sides.join(other, [group, "topic", "side"]).join(both, [group, "topic", "item_id"])
    opposed = F.when(F.col("is_both") & (F.col("first") == F.col("item_id")), F.col("second")).otherwise(F.col("first"))
    n = F.col("n") - F.col("is_both").cast("int")
    return rows.select(group, "topic", "side", "item_id", n.alias("n_opposed"), opposed.alias("opposed")).where("n_opposed > 0")


def ownership(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(doc, entities): different entities of each document by the chunks that both name."""
    chunks = docs.select("doc", F.explode("chunks").alias("chunk"))
    sources = nodes.select("entity", F.explode("sources").alias("chunk"))
    return chunks.join(sources, "chunk").select("doc", "entity").distinct()


def coverage(payload: DataFrame, records: DataFrame, key: str, required: list[str]) -> DataFrame:
    """One row: how many payload keys have no record, and how many records miss each required field."""
    missing = F.coalesce(F.col("__found"), F.lit(False))
    rows = payload.select(key).join(records.withColumn("__found", F.lit(True)), key, "left")
    return rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(~missing).alias("missing_record"), *[F.count_if(missing & F.col(c).isNull()).alias(f"missing_{c}") for c in required])


def trace(objects: DataFrame, steps: list[tuple[str, DataFrame]]) -> DataFrame:
    """Objects followed through a chain of tables, each joined on a named column of what came before; the first side is the
    few objects that are asked for, so each step reads what they touch."""
    for column, table in steps:
        objects = objects.join(table, column)
    return objects
