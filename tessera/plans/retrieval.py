"""Retrieval: lexical ranking, and the naive, local, global, hybrid and mixed modes over a knowledge base."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import text
from tessera.operators import aggregates, chunking, joins, ranking, vectors
from tessera.sources.scratch import materialise


#: Pairs of a question and a document that a task of :func:`lexical_ranking` scores, about.
PAIRS_A_TASK = 1_000_000


def lexical_ranking(docs: DataFrame, questions: DataFrame, key: str, k: int, decimals: int = 9) -> DataFrame:
    """(key, doc, score, rank) of the ``k`` documents (doc, text) that match each question (key, text) best.

    A token scores (1 + ln tf) times its idf; ties go by document.  Postings of the questions' tokens alone are joined.
    """
    n = docs.count()
    tf = docs.select("doc", F.explode(text.tokens("text")).alias("token")).groupBy("doc", "token").agg(F.count(F.lit(1)).alias("tf"))
    asked = questions.select(key, F.explode(F.array_distinct(text.tokens("text"))).alias("token"))
    posted = tf.join(asked.select("token").distinct(), "token", "left_semi")
    idf = aggregates.document_frequencies(posted, n)
    hits = posted.join(asked.join(idf, "token"), "token").select(key, "doc", ((1 + F.log("tf")) * F.col("idf")).alias("part"))
    # dealt by document, so a task scores a bounded number of pairs
    parts = n * questions.count() // PAIRS_A_TASK + 1
    scored = hits.repartition(parts, "doc").groupBy(key, "doc").agg(F.round(F.sum("part"), decimals).alias("score"))
    w = Window.partitionBy(key).orderBy(F.desc("score"), "doc")
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


@dataclass(frozen=True)
class QueryParam:
    """What a query may set.

    ``model`` maps prompts to answers and goes before the workspace's own.  ``rerank`` scores texts against a question; scores
    below ``min_rerank_score`` drop out, and a text without one has 1.  ``history``, ``response_type`` and ``user_prompt`` are for
    the caller's prompt.
    """

    mode: str = "mix"
    top_k: int = 40
    chunk_top_k: int = 20
    max_entity_tokens: int = 6_000
    max_relation_tokens: int = 8_000
    max_total_tokens: int = 30_000
    related_chunks: int = 5
    cosine_threshold: float = 0.2
    hl_keywords: tuple[str, ...] = field(default_factory=tuple)
    ll_keywords: tuple[str, ...] = field(default_factory=tuple)
    model: Callable[[list[str]], list[str]] | None = None
    rerank: Callable[[str, list[str]], list[float | None]] | None = None
    min_rerank_score: float = 0.0
    history: tuple[tuple[str, str], ...] = ()
    response_type: str = "Multiple Paragraphs"
    user_prompt: str = ""
    only_need_prompt: bool = False


MODES = ("local", "global", "hybrid", "mix", "naive", "bypass")


@dataclass(frozen=True)
class KnowledgeBase:
    """Tables: chunks (chunk_id, content, file_path, vector), nodes (id, entity_type, description, source_ids, vector), edges
    (src, tgt, description, weight, source_ids, vector)."""

    chunks: DataFrame
    nodes: DataFrame
    edges: DataFrame


def _hits(table: DataFrame, vector: list[float], p: QueryParam, k: int) -> DataFrame:
    q = table.sparkSession.createDataFrame([(0, [float(x) for x in vector])], "query_id int, vector array<double>")
    found = vectors.search(table.select("id", "vector"), q, k, p.cosine_threshold)
    return found.select("id", F.col("rank").alias("pos"), "similarity")


def _at(table: DataFrame, few: DataFrame) -> DataFrame:
    """Rows of a table at the ids of a list of hits or their ends: at most three a hit, so they stand in the plan, and the filter
    goes below joins and groups that a table is made of."""
    return table.where(F.col("id").isin([r["id"] for r in few.select("id").collect()]))


def post_process(chunks: DataFrame, question: str, p: QueryParam) -> DataFrame:
    """What is left of a result list of chunks (pos, content, ...): reranked where there is a function for it, the best
    ``chunk_top_k`` of those with enough score, as many as the token budget holds; with their place and ids DC1, DC2, ..."""
    rows = chunks
    if p.rerank is not None:
        rerank = p.rerank
        scored = lambda q, texts: [1.0 if s is None else float(s) for s in rerank(q, texts)]
        best = chunking.rerank(rows.select("pos", "content"), question, scored, p.chunk_top_k, p.min_rerank_score)
        rows = rows.join(best, "pos").drop("pos").withColumnRenamed("rank", "pos")
    rows = rows.orderBy("pos").limit(p.chunk_top_k).withColumn("tokens", F.size(chunking.words("content")))
    return ranking.sequence_ids(ranking.token_budget(rows, p.max_total_tokens), "pos")


def retrieve(kb: KnowledgeBase, vector: list[float], p: QueryParam, low: list[float] | None = None, high: list[float] | None = None, question: str = "") -> dict[str, DataFrame]:
    """Frames ``entities``, ``relations``, ``chunks`` and ``references`` that answer a query vector in a mode.

    Local: entities near the query and edges at them; global: edges near it and their ends; hybrid takes turns between both;
    mix adds chunks near the query; naive has chunks alone.  Each list is cut at its token budget, a prefix that no later row
    can join again.  Entities are looked up by ``low`` and relations by ``high`` where these are given; an empty one leaves its
    half out.

    Tables may be plans over larger ones.  Each list is written once and looked up as the few rows that it is, so what
    looks it up goes below what the tables are made of, and nothing but the search over edges moves a whole table.
    """
    if p.mode not in MODES:
        raise ValueError(f"no such mode: {p.mode}")
    spark = kb.nodes.sparkSession
    low, high = (vector if v is None else v for v in (low, high))
    entities = relations = None
    nodes, edges = kb.nodes.drop("vector"), kb.edges.drop("vector")
    if p.mode in ("local", "hybrid", "mix") and len(low):
        hits = materialise(_hits(kb.nodes, low, p, p.top_k), "hits")
        # hits are nodes, and nothing here reads their degrees
        entities = hits.select("id", "pos")
        touched = materialise(joins.touched_edges(hits, edges), "touched")
        # tokens are at least one a row, so no more rows can fit the budget; a hub's other edges are never numbered
        near = joins.ranked_edges(touched, edges).limit(p.max_relation_tokens)
        relations = near.withColumn("pos", F.row_number().over(Window.orderBy(F.desc("rank"), F.desc("weight"), "src", "tgt"))).drop("rank")
    if p.mode in ("global", "hybrid", "mix") and len(high):
        keyed = kb.edges.withColumn("id", F.concat_ws("\x01", "src", "tgt"))
        hits = materialise(_hits(keyed, high, p, p.top_k), "hits").select("id", "pos")
        found = materialise(hits.join(_at(keyed.drop("vector"), hits), "id").drop("id"), "found")
        ends = joins.edge_entities(found, nodes)
        ends = ends.withColumn("pos", F.row_number().over(Window.orderBy("pos", "side"))).select("id", "pos")
        entities = ends if entities is None else ranking.interleave([entities, ends], "id").select("id", F.col("turn").alias("pos"))
        key = lambda df: df.withColumn("k", F.concat_ws("\x01", "src", "tgt"))
        relations = found if relations is None else ranking.interleave([key(relations), key(found)], "k").drop("k", "pos").withColumnRenamed("turn", "pos")
    out: dict[str, DataFrame] = {}
    lists = []
    if p.mode in ("mix", "naive"):
        near = _hits(kb.chunks.withColumnRenamed("chunk_id", "id"), vector, p, p.chunk_top_k)
        lists.append(near.select(F.col("id").alias("chunk_id"), "pos"))
    if entities is not None:
        size = lambda *c: F.size(chunking.words(F.concat_ws(" ", *c)))
        entities = materialise(entities, "entities")
        entities = entities.join(_at(nodes, entities), "id").withColumn("tokens", size("id", "entity_type", "description"))
        out["entities"] = materialise(ranking.token_budget(entities, p.max_entity_tokens), "entities")
        relations = relations.withColumn("tokens", size("src", "tgt", "description"))
        out["relations"] = materialise(ranking.token_budget(relations, p.max_relation_tokens), "relations")
        bare = kb.chunks.select("chunk_id")
        by_entity = joins.owned_chunks(out["entities"], bare)
        by_edge = joins.owned_chunks_without(out["relations"].withColumn("id", F.concat_ws("\x01", "src", "tgt")), bare, by_entity)
        for owned in (by_entity, by_edge):
            w = Window.orderBy("owner_pos", F.desc("occurrences"), "chunk_pos")
            few = ranking.first_of(owned.withColumn("n", F.row_number().over(Window.partitionBy("owner").orderBy(F.desc("occurrences"), "chunk_pos"))), ["chunk_id"], "owner_pos")
            few = few.where(F.col("n") <= p.related_chunks).orderBy("owner_pos", F.desc("occurrences"), "chunk_pos").limit(p.chunk_top_k)
            lists.append(few.withColumn("pos", F.row_number().over(w)).select("chunk_id", "pos"))
    if lists:
        merged = ranking.interleave(lists, "chunk_id").select("chunk_id", F.col("turn").alias("pos"))
        out["chunks"] = post_process(merged.join(kb.chunks.drop("vector"), "chunk_id"), question, p)
        out["references"] = aggregates.references(out["chunks"])
    if p.mode == "bypass":
        out = {"chunks": spark.createDataFrame([], "chunk_id string, content string")}
    return out


def text_only(docs: DataFrame, terms: list[str], k: int) -> DataFrame:
    """(doc_id, score) of the ``k`` documents (doc_id, text) that hold most of some terms as tokens; none without any."""
    found = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("([a-z0-9]+)"), F.lit(1)))
    scored = docs.select("doc_id", F.size(F.array_intersect(found, F.array(*map(F.lit, terms)))).alias("score"))
    return scored.where("score > 0").orderBy(F.desc("score"), "doc_id").limit(k)


def user_format(**frames: DataFrame) -> dict[str, DataFrame]:
    """Frames of :func:`retrieve` with the names and columns that callers get: entities, relationships, chunks, references."""
    shapes = {
        "entities": ("entities", {"id": "entity_name", "entity_type": "entity_type", "description": "description", "source_ids": "source_id", "file_path": "file_path"}),
        "relations": ("relationships", {"src": "src_id", "tgt": "tgt_id", "description": "description", "keywords": "keywords", "weight": "weight", "source_ids": "source_id", "file_path": "file_path"}),
        "chunks": ("chunks", {"chunk_id": "chunk_id", "content": "content", "file_path": "file_path", "reference_id": "reference_id"}),
        "references": ("references", {"reference_id": "reference_id", "file_path": "file_path"}),
    }
    out = {}
    for name, df in frames.items():
        to, columns = shapes[name]
        out[to] = df.select(*[(F.col(c) if c in df.columns else F.lit("")).alias(n) for c, n in columns.items()])
    return out
