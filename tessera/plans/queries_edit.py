"""Queries over edits of the graph, imports, rebuilding and the cache of answers."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import ids, text
from tessera.operators import aggregates, cache, chunking, editing, graph, joins, lookups, ranking, vectors
from tessera.plans.registry import KG, query
from tessera.plans.retrieval import QueryParam, post_process


def _name(prefix, column):
    return F.concat(F.lit(prefix), F.col(column).cast("string"))


@query("mut_delete_relation", "SELECT src, tgt, weight FROM edges WHERE NOT contains(src, '7')", "edges")
def mut_delete_relation(spark, d):
    edges = KG(spark, d).cte("edges")
    gone = edges.where("contains(src, '7')").select(F.col("tgt").alias("a"), F.col("src").alias("b"))
    return editing.delete_relations(edges, gone).select("src", "tgt", "weight")


@query("mut_rename_entity", "SELECT least(src, t) AS src, greatest(src, t) AS tgt, weight FROM (SELECT src, weight, CASE WHEN tgt = 'supp-1' THEN 'a-seller' ELSE tgt END AS t FROM edges)", "edges")
def mut_rename_entity(spark, d):
    kg = KG(spark, d)
    return editing.rename_entity(kg.cte("nodes"), kg.cte("edges"), "supp-1", "a-seller")[1].select("src", "tgt", "weight")


def _described(kg):
    """Edges with all attributes of a relation, one row a pair."""
    return kg.cte("frag").groupBy("src", "tgt").agg(
        F.sum("weight").alias("weight"), F.array_join(F.array_sort(F.collect_set("keywords")), ",").alias("keywords"), F.concat(F.lit("sold by "), F.max("tgt")).alias("description"),
        F.array_sort(F.collect_set("source_id")).alias("source_ids"), F.concat(F.lit("file-"), F.min("source_id")).alias("file_path"),
    )


@query(
    "mut_edit_entity",
    """+ e AS (SELECT src, tgt, sum(weight) AS weight, 'sold by ' || tgt AS description, 'file-' || min(source_id) AS file_path FROM frag GROUP BY src, tgt),
        m AS (SELECT *, CASE WHEN tgt = 'supp-1' THEN 'supp-2' ELSE tgt END AS t FROM e),
        k AS (SELECT src, CASE WHEN tgt = 'supp-1' THEN 'supp-2' ELSE tgt END AS t, array_to_string(list_sort(list_distinct(list(x))), ',') AS keywords, count(DISTINCT source_id) AS n_sources
            FROM (SELECT src, tgt, source_id, unnest(string_split(keywords, ',')) AS x FROM frag) GROUP BY ALL),
        u AS (SELECT src, tgt, array_to_string(list_sort(list_distinct(list(keywords))), ',') AS keywords FROM frag GROUP BY ALL)
        SELECT m.src, m.t AS tgt, max(weight) AS weight, string_agg(description, E'\n\n' ORDER BY m.tgt) AS description, string_agg(DISTINCT file_path, '<SEP>' ORDER BY file_path) AS file_path,
            min(CASE WHEN m.t = 'supp-2' THEN k.keywords ELSE u.keywords END) AS keywords, min(k.n_sources) AS n_sources
        FROM m JOIN k ON k.src = m.src AND k.t = m.t JOIN u ON u.src = m.src AND u.tgt = m.tgt GROUP BY 1, 2""", "frag",
)
def mut_edit_entity(spark, d):
    kg = KG(spark, d)
    edges = editing.rename_entity(kg.cte("nodes"), _described(kg), "supp-1", "supp-2", allow_merge=True)[1]
    # paths of a pair come in the order of its old ends; here by name
    paths = F.array_join(F.array_sort(F.split("file_path", "<SEP>")), "<SEP>")
    return edges.select("src", "tgt", "weight", "description", paths.alias("file_path"), "keywords", F.size("source_ids").cast("long").alias("n_sources"))


@query(
    "mut_merge_entities",
    """+ m AS (SELECT 'supp-2' AS id, 'SUPPLIER' AS entity_type, string_agg(name, '<SEP>' ORDER BY CASE id WHEN 'supp-2' THEN 0 WHEN 'supp-3' THEN 1 ELSE 2 END) AS name FROM nodes WHERE id IN ('supp-1', 'supp-2', 'supp-3'))
        SELECT id, entity_type, name FROM nodes WHERE id NOT IN ('supp-1', 'supp-2', 'supp-3') UNION ALL SELECT id, entity_type, name FROM m""", "nodes",
)
def mut_merge_entities(spark, d):
    kg = KG(spark, d)
    return editing.merge_entities(kg.cte("nodes"), kg.cte("edges"), ["supp-3", "supp-1"], "supp-2", {"name": "join_unique"})[0].select("id", "entity_type", "name")


@query("mut_edit_relation", "SELECT src, tgt, CASE WHEN contains(src, '9') THEN 0.5 ELSE weight END AS weight, n FROM edges", "edges")
def mut_edit_relation(spark, d):
    edges = KG(spark, d).cte("edges")
    weight = dict(edges.dtypes)["weight"]
    changes = edges.where("contains(src, '9')").select(F.col("tgt").alias("a"), F.col("src").alias("b"), F.lit(0.5).cast(weight).alias("weight"), F.lit(None).cast("long").alias("n"))
    return editing.edit_relations(edges, changes)


@query(
    "mut_create_entity",
    """+ c AS (SELECT c_custkey AS pos, CASE WHEN c_custkey % 11 = 0 THEN ' ' ELSE 'supp-' || (c_custkey % 40) END AS id, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_mktsegment END AS description FROM customer),
        f AS (SELECT id, min(pos) AS first FROM c WHERE trim(id) <> '' AND description <> '' GROUP BY 1)
        SELECT pos, c.id, CASE WHEN trim(c.id) = '' THEN 'no_name' WHEN n.id IS NOT NULL OR pos > first THEN 'exists' WHEN description = '' THEN 'no_description' ELSE 'created' END AS outcome
        FROM c LEFT JOIN nodes n ON n.id = c.id LEFT JOIN f ON f.id = c.id""", "nodes",
)
def mut_create_entity(spark, d):
    kg = KG(spark, d)
    new = kg.table("customer").selectExpr(
        "c_custkey AS pos", "CASE WHEN c_custkey % 11 = 0 THEN ' ' ELSE concat('supp-', c_custkey % 40) END AS id", "CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_mktsegment END AS description"
    )
    return editing.create_entities(kg.cte("nodes"), new)[1]


@query(
    "mut_create_relation",
    """+ c AS (SELECT o_orderkey AS pos, 'supp-' || (o_orderkey % 12) AS a, CASE WHEN o_orderkey % 7 = 0 THEN 'supp-' || (o_orderkey % 12) ELSE 'part-' || (o_custkey % 30) END AS b FROM orders),
        k AS (SELECT *, least(a, b) AS src, greatest(a, b) AS tgt, a IN (SELECT id FROM nodes) AND b IN (SELECT id FROM nodes) AS ends FROM c), f AS (SELECT src, tgt, min(pos) AS first FROM k WHERE ends AND a <> b GROUP BY ALL)
        SELECT pos, a, b, CASE WHEN a = b THEN 'loop' WHEN NOT ends THEN 'no_end' WHEN e.src IS NOT NULL OR pos > first THEN 'exists' ELSE 'created' END AS outcome
        FROM k LEFT JOIN edges e ON e.src = k.src AND e.tgt = k.tgt LEFT JOIN f ON f.src = k.src AND f.tgt = k.tgt""", "nodes", "edges",
)
def mut_create_relation(spark, d):
    kg = KG(spark, d)
    new = kg.table("orders").selectExpr("o_orderkey AS pos", "concat('supp-', o_orderkey % 12) AS a", "CASE WHEN o_orderkey % 7 = 0 THEN concat('supp-', o_orderkey % 12) ELSE concat('part-', o_custkey % 30) END AS b")
    return editing.create_relations(kg.cte("edges"), kg.cte("nodes"), new)[1]


def _lost(f):
    return f.where("cast(substr(source_id, 7) as bigint) % 3 = 0").select("source_id")


@query(
    "mut_rebuild_entity",
    """+ l AS (SELECT *, CAST(substr(source_id, 7) AS BIGINT) % 3 = 0 AS gone FROM frag), h AS (SELECT DISTINCT src FROM l WHERE gone), s AS (SELECT src, keywords, min(pos) AS p FROM l WHERE NOT gone AND src IN (SELECT src FROM h) GROUP BY ALL)
        SELECT src AS entity, string_agg(keywords, '<SEP>' ORDER BY p, keywords) AS description FROM s GROUP BY 1""", "frag",
)
def mut_rebuild_entity(spark, d):
    f = KG(spark, d).cte("frag")
    fragments = f.select(F.col("src").alias("entity"), F.lit("part").alias("entity_type"), F.col("keywords").alias("description"), "source_id", "pos")
    return editing.rebuild_entities(fragments, _lost(f)).select("entity", F.array_join("descriptions", "<SEP>").alias("description"))


@query(
    "mut_rebuild_by_relations",
    """+ e AS (SELECT src, tgt, CASE WHEN n % 5 = 0 THEN '' ELSE n || ' times, ' || weight::BIGINT END AS d FROM edges), x AS (SELECT src AS id, tgt AS other, d FROM e UNION ALL SELECT tgt, src, d FROM e),
        o AS (SELECT id, d, min(other) AS p FROM x WHERE d <> '' GROUP BY ALL), l AS (SELECT id, string_agg(d, '<SEP>' ORDER BY p, d) AS told FROM o GROUP BY 1)
        SELECT nodes.id, coalesce(told, name) AS description FROM nodes LEFT JOIN l ON l.id = nodes.id WHERE length(nodes.id) % 2 = 0""", "edges", "nodes",
)
def mut_rebuild_by_relations(spark, d):
    kg = KG(spark, d)
    said = F.when(F.col("n") % 5 == 0, "").otherwise(F.concat(F.col("n").cast("string"), F.lit(" times, "), F.col("weight").cast("long").cast("string")))
    edges = kg.cte("edges").select("src", "tgt", said.alias("description"))
    nodes = kg.cte("nodes").select("id", F.col("name").alias("description"))
    return editing.describe_by_relations(nodes, edges, nodes.where("length(id) % 2 = 0"))  # what lost its fragments


@query(
    "mut_rebuild_relation",
    """+ l AS (SELECT *, CAST(substr(source_id, 7) AS BIGINT) % 3 = 0 AS gone FROM frag), h AS (SELECT DISTINCT src, tgt FROM l WHERE gone)
        SELECT l.src, l.tgt, sum(weight) AS weight, count(*) AS n_fragments FROM l JOIN h ON h.src = l.src AND h.tgt = l.tgt WHERE NOT gone GROUP BY ALL""", "frag",
)
def mut_rebuild_relation(spark, d):
    f = KG(spark, d).cte("frag")
    # half of the fragments name the pair the other way round
    turned = f.withColumn("a", F.when(F.col("pos") % 2 == 0, F.col("tgt")).otherwise(F.col("src"))).withColumn("b", F.when(F.col("pos") % 2 == 0, F.col("src")).otherwise(F.col("tgt")))
    return editing.rebuild_relations(turned.drop("src", "tgt").withColumnsRenamed({"a": "src", "b": "tgt"}), _lost(f)).select("src", "tgt", "weight", "n_fragments")


CUSTOM_SQL = """+ ch AS (SELECT 'o-' || o_orderkey AS source_id, min('chunk-' || md5(o_orderpriority || o_orderkey)) AS chunk_id FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1),
    en AS (SELECT src AS id, 'thing' AS entity_type, arg_max('o-' || substr(source_id, 7), pos * 1000000 + tgt_key) AS source_id FROM (SELECT *, CAST(substr(tgt, 6) AS BIGINT) AS tgt_key FROM frag) GROUP BY 1)"""


def _custom(spark, d):
    kg = KG(spark, d)
    chunks = kg.table("orders").where("o_orderkey % 2 = 0").select(F.concat("o_orderpriority", F.col("o_orderkey").cast("string")).alias("content"), _name("o-", "o_orderkey").alias("source_id"))
    f = kg.cte("frag").withColumn("source_id", F.concat(F.lit("o-"), F.substring("source_id", 7, 20)))
    pos = F.struct("pos", F.substring("tgt", 6, 20).cast("long")).alias("pos")
    entities = f.select(pos, F.col("src").alias("name"), F.lit("thing").alias("entity_type"), F.lit(None).cast("string").alias("description"), "source_id")
    relations = f.select(pos, F.col("tgt").alias("src"), F.col("src").alias("tgt"), F.lit("sold").alias("description"), "keywords", F.col("weight").cast("double").alias("weight"), "source_id")
    return editing.import_graph(chunks, entities, relations)


@query(
    "src_custom_graph",
    CUSTOM_SQL + """ SELECT en.id, entity_type, coalesce(chunk_id, 'UNKNOWN') AS chunk_id FROM en LEFT JOIN ch USING (source_id)
        UNION ALL SELECT tgt, 'UNKNOWN', min(c) FROM (SELECT src, tgt, coalesce(chunk_id, 'UNKNOWN') AS c FROM (SELECT src, tgt, arg_max('o-' || substr(source_id, 7), pos) AS source_id FROM frag GROUP BY ALL) LEFT JOIN ch USING (source_id)) GROUP BY tgt""", "frag",
)
def src_custom_graph(spark, d):
    return _custom(spark, d)[1].select("id", "entity_type", "chunk_id")


@query("src_custom_relations", "SELECT src, tgt, arg_max(weight, pos)::DOUBLE AS weight FROM frag GROUP BY ALL", "frag")
def src_custom_relations(spark, d):
    return _custom(spark, d)[2].select("src", "tgt", "weight")


@query("src_custom_chunks", "SELECT DISTINCT 'chunk-' || md5(o_orderpriority) AS id, 'doc-x' AS full_doc_id, o_orderpriority AS content FROM orders WHERE o_orderpriority NOT LIKE '%URGENT%'")
def src_custom_chunks(spark, d):
    o = KG(spark, d).table("orders").select(F.col("o_orderpriority").alias("content"))
    stored = o.where("content like '%URGENT%'").select(ids.content_id("content", "chunk-").alias("id")).distinct()
    return editing.import_chunks(stored, "doc-x", o)


@query(
    "txt_batches",
    """WITH r AS (SELECT o_orderkey AS pos, 'c-' || o_custkey AS src, 'p-' || o_orderpriority AS tgt, CAST(floor(o_orderkey / 100) AS BIGINT) AS batch FROM orders)
        SELECT batch, 'relation' AS kind, src || '<SEP>' || tgt AS key FROM r UNION ALL SELECT DISTINCT batch, 'entity', unnest([src, tgt]) FROM r""",
)
def txt_batches(spark, d):
    r = KG(spark, d).table("orders").select(F.col("o_orderkey").alias("pos"), _name("c-", "o_custkey").alias("src"), F.concat(F.lit("p-"), "o_orderpriority").alias("tgt"))
    return editing.batches(r, 100)


@query("mut_chunk_tracking", "SELECT src AS id, string_agg(DISTINCT source_id, ',' ORDER BY source_id) AS chunk_ids, count(DISTINCT source_id)::INTEGER AS count FROM frag GROUP BY 1", "frag")
def mut_chunk_tracking(spark, d):
    nodes = KG(spark, d).cte("frag").groupBy(F.col("src").alias("id")).agg(F.collect_list("source_id").alias("source_ids"))
    return editing.track_chunks(nodes, "id").withColumn("chunk_ids", F.array_join("chunk_ids", ","))


@query(
    "graph_has_cycle", "SELECT 'chain' AS graph, false AS cyclic UNION ALL SELECT 'ring', true UNION ALL SELECT 'sales', bool_or(src >= tgt) FROM edges", "edges",
)
def graph_has_cycle(spark, d):
    kg = KG(spark, d)
    n = kg.table("supplier").select(F.col("s_suppkey").alias("src"), (F.col("s_suppkey") + 1).alias("tgt"))
    last = kg.table("supplier").agg(F.max("s_suppkey").alias("src")).withColumn("tgt", F.lit(1).cast("long"))
    ring = n.select(F.col("src").cast("long"), F.col("tgt").cast("long")).join(last.select("src"), "src", "left_anti").unionByName(last.select(F.col("src").cast("long"), "tgt"))
    found = [(name, graph.has_cycle(e)) for name, e in (("chain", n), ("ring", ring), ("sales", kg.cte("edges")))]
    return spark.createDataFrame(found, "graph string, cyclic boolean")


# --- the cache of answers ---------------------------------------------------------------------------------------------

CALLS_SQL = "c AS (SELECT o_orderkey AS pos, CASE o_orderkey % 3 WHEN 0 THEN 'default' WHEN 1 THEN 'mix' ELSE 'local' END AS mode, 'query' AS cache_type, o_orderpriority || (o_custkey % 50) AS prompt FROM orders), k AS (SELECT *, mode || ':query:' || md5(prompt) AS key FROM c)"
KEPT_SQL = CALLS_SQL + ", h AS (SELECT DISTINCT key, 'kept ' || prompt AS content, CAST(7 AS BIGINT) AS create_time FROM k WHERE prompt LIKE '%URGENT%')"


def _calls(spark, d):
    c = KG(spark, d).table("orders").selectExpr("o_orderkey AS pos", "CASE o_orderkey % 3 WHEN 0 THEN 'default' WHEN 1 THEN 'mix' ELSE 'local' END AS mode", "'query' AS cache_type", "concat(o_orderpriority, o_custkey % 50) AS prompt")
    kept = cache.keyed(c).where("prompt like '%URGENT%'").groupBy("key").agg(F.first("prompt").alias("original_prompt"))
    time = F.lit(7).cast("long")
    kept = kept.select("key", F.concat(F.lit("kept "), "original_prompt").alias("return"), F.lit("query").alias("cache_type"), "original_prompt", time.alias("create_time"), time.alias("update_time"))
    return c, kept


@query("qry_cache_probe", f"WITH {KEPT_SQL} SELECT pos, k.key, content, create_time FROM k LEFT JOIN h ON h.key = k.key AND mode <> 'local'")
def qry_cache_probe(spark, d):
    c, kept = _calls(spark, d)
    return cache.probe(cache.keyed(c), kept, ("default", "mix")).select("pos", "key", "content", "create_time")


@query(
    "qry_cache_write",
    f"""WITH {KEPT_SQL}, a AS (SELECT key, arg_max(CASE WHEN pos % 5 = 0 THEN '' WHEN prompt LIKE '%URGENT%' AND pos % 2 = 0 THEN 'kept ' || prompt ELSE 'new ' || pos END, pos) FILTER (WHERE pos % 5 <> 0) AS content FROM k GROUP BY 1)
        SELECT coalesce(h.key, a.key) AS key, coalesce(a.content, h.content) AS answer, CASE WHEN h.key IS NOT NULL THEN 7 ELSE 9 END::BIGINT AS create_time, CASE WHEN a.content IS NULL OR a.content = h.content THEN 7 ELSE 9 END::BIGINT AS update_time
        FROM h FULL JOIN a ON h.key = a.key WHERE coalesce(a.content, h.content) IS NOT NULL""",
)
def qry_cache_write(spark, d):
    c, kept = _calls(spark, d)
    answers = cache.keyed(c).withColumn("content", F.expr("CASE WHEN pos % 5 = 0 THEN '' WHEN prompt LIKE '%URGENT%' AND pos % 2 = 0 THEN concat('kept ', prompt) ELSE concat('new ', pos) END"))
    return cache.write(kept, answers, 9).select("key", F.col("return").alias("answer"), "create_time", "update_time")


@query("qry_cached_calls", f"WITH {KEPT_SQL} SELECT pos, coalesce(content, upper(prompt)) AS content, content IS NOT NULL AS hit FROM k LEFT JOIN h ON h.key = k.key")
def qry_cached_calls(spark, d):
    c, kept = _calls(spark, d)
    found, _ = cache.answer(c, kept, lambda prompts: [f"<think>x</think> {p.upper()}" for p in prompts], 9)
    return found.select("pos", "content", "hit")


@query("join_cached_extractions", "SELECT 'chunk-' || o_custkey AS chunk_id, 'k-' || o_orderkey AS key, min(o_orderkey) OVER (PARTITION BY o_custkey) AS chunk_time FROM orders WHERE o_orderkey % 4 <> 0")
def join_cached_extractions(spark, d):
    o = KG(spark, d).table("orders")
    key, chunk = _name("k-", "o_orderkey"), _name("chunk-", "o_custkey")
    chunks = o.groupBy(chunk.alias("chunk_id")).agg(F.collect_list(key).alias("llm_cache_list"))
    kept = o.select(key.alias("key"), chunk.alias("chunk_id"), F.when(F.col("o_orderkey") % 4 == 0, "summary").otherwise("extract").alias("cache_type"), F.col("o_orderkey").alias("create_time"))
    return joins.cached_extractions(chunks, kept).select("chunk_id", "key", "chunk_time")


# --- lookups, names and texts -----------------------------------------------------------------------------------------


@query("flt_docs_by_track", "SELECT id, status FROM (SELECT *, 'track-' || (owner % 9) AS track_id FROM docs) WHERE track_id = 'track-4'", "docs")
def flt_docs_by_track(spark, d):
    docs = KG(spark, d).cte("docs").withColumn("track_id", F.concat(F.lit("track-"), (F.col("owner") % 9).cast("string")))
    return lookups.by_track(docs, "track-4").select("id", "status")


@query("flt_is_empty", "SELECT 'docs' AS name, count(*) = 0 AS is_empty FROM docs UNION ALL SELECT 'none', true", "docs")
def flt_is_empty(spark, d):
    docs = KG(spark, d).cte("docs")
    return lookups.emptiness({"docs": docs, "none": docs.where("status = 'lost'")})


@query("flt_relation_info", "SELECT a, b, CASE WHEN k % 2 = 0 THEN 'rel-' || md5(b || a) ELSE 'rel-' || md5(a || b) END AS id FROM (SELECT tgt AS b, src AS a, CAST(substr(src, 6) AS BIGINT) AS k FROM edges)", "edges")
def flt_relation_info(spark, d):
    e = KG(spark, d).cte("edges").select(F.col("src").alias("a"), F.col("tgt").alias("b"), F.substring("src", 6, 20).cast("long").alias("k"))
    stored = e.select(F.when(F.col("k") % 2 == 0, ids.content_id(F.concat("b", "a"), "rel-")).otherwise(ids.content_id(F.concat("a", "b"), "rel-")).alias("id"))
    return lookups.relation_info(stored, e.select("a", "b"))


@query("flt_entity_info", "SELECT id, name, 'ent-' || md5(id) AS vector_id FROM nodes WHERE id = 'supp-3'", "nodes")
def flt_entity_info(spark, d):
    nodes = KG(spark, d).cte("nodes")
    stored = nodes.select(ids.content_id("id", "ent-").alias("id"), F.array(F.lit(1.0)).alias("vector"))
    return lookups.entity_info(nodes, stored, "supp-3").where("vector is not null").select("id", "name", "vector_id")


@query("flt_in_scope", "SELECT o_orderkey AS id FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'")
def flt_in_scope(spark, d):
    o = KG(spark, d).table("orders")
    return o.where(lookups.in_scope(True, o_orderpriority="1-URGENT", o_orderstatus="F", o_comment=None)).select(F.col("o_orderkey").alias("id"))


@query(
    "flt_query_mode",
    """SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'local' WHEN 1 THEN 'naive' ELSE 'mix' END AS mode, doc_id % 4 = 1 AS context_only, CASE WHEN doc_id % 4 = 0 THEN 'brief' END AS user_prompt, 'q' || doc_id AS query FROM documents""",
)
def flt_query_mode(spark, d):
    q = F.concat(F.lit("q"), F.col("doc_id").cast("string"))
    docs = KG(spark, d).table("documents").select("doc_id", F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit("/local[brief] "), q)).when(F.col("doc_id") % 4 == 1, F.concat(F.lit("/naivecontext "), q)).otherwise(q).alias("line"))
    return docs.select("doc_id", text.query_mode("line").alias("p")).select("doc_id", "p.mode", "p.context_only", "p.user_prompt", "p.query")


@query("fn_sanitize", "SELECT doc_id, '<' || trim(text, E' \\n\\t\\r\\x0B\\f') || '>' AS text FROM documents")
def fn_sanitize(spark, d):
    docs = KG(spark, d).table("documents")
    return docs.select("doc_id", text.sanitize(F.concat(F.lit("  &lt;\x01"), F.regexp_replace("text", r"^\s+|\s+$", ""), F.lit("\x02&gt;\n"))).alias("text"))


@query("fn_args_hash", "SELECT o_orderkey AS id, md5(o_orderpriority || coalesce(NULL, 'None') || o_orderkey) AS hash FROM orders")
def fn_args_hash(spark, d):
    return KG(spark, d).table("orders").select(F.col("o_orderkey").alias("id"), ids.args_hash("o_orderpriority", F.lit(None), "o_orderkey").alias("hash"))


@query("fn_pair_parts", "SELECT src AS a, tgt AS b FROM edges", "edges")
def fn_pair_parts(spark, d):
    parts = KG(spark, d).cte("edges").select(ids.pair_of(ids.pair_key("tgt", "src")).alias("p"))
    return parts.select(F.col("p")[0].alias("a"), F.col("p")[1].alias("b"))


@query("fn_json_lines", """SELECT o_custkey AS id, string_agg('{"k":' || o_orderkey || ',"s":"' || o_orderstatus || '"}', E'\\n' ORDER BY o_orderkey) AS lines FROM orders GROUP BY 1""")
def fn_json_lines(spark, d):
    o = KG(spark, d).table("orders").selectExpr("o_custkey AS id", "o_orderkey AS k", "o_orderstatus AS s")
    return o.groupBy("id").agg(text.json_lines(o, "k", ["k", "s"]).alias("lines"))


@query("fn_keywords", "SELECT o_orderkey AS id, 'h' || o_custkey || ',' || o_orderstatus AS high, 'low' AS low FROM orders")
def fn_keywords(spark, d):
    answer = F.concat(F.lit('Sure: ```json\n{"high_level_keywords": ["h'), F.col("o_custkey").cast("string"), F.lit('", "'), "o_orderstatus", F.lit('"], "low_level_keywords": ["low"]}\n``` done'))
    k = KG(spark, d).table("orders").select(F.col("o_orderkey").alias("id"), text.keyword_lists(answer).alias("k"))
    return k.select("id", F.array_join("k.high_level_keywords", ",").alias("high"), F.array_join("k.low_level_keywords", ",").alias("low"))


@query("fn_escapes", "SELECT o_orderkey AS id, 'é' || o_orderstatus || '\\u00g' AS text FROM orders")
def fn_escapes(spark, d):
    return KG(spark, d).table("orders").select(F.col("o_orderkey").alias("id"), text.decode_escapes(F.concat(F.lit("\\u00e9"), "o_orderstatus", F.lit("\\u00g"))).alias("text"))


@query("fn_term_key", "SELECT p_partkey AS id, regexp_replace(lower(p_name), '[ _.,-]', '', 'g') || 'fi1' AS key FROM part")
def fn_term_key(spark, d):
    return KG(spark, d).table("part").select(F.col("p_partkey").alias("id"), text.term_key(F.concat(F.upper("p_name"), F.lit(" ﬁ-１"))).alias("key"))


@query("fn_token_overlap", "WITH t AS (SELECT o_orderkey AS id, o_orderkey % 4 AS n FROM orders) SELECT id, (CASE WHEN n = 0 THEN 2 WHEN n = 1 THEN 1 ELSE 0 END)::INTEGER AS score FROM t")
def fn_token_overlap(spark, d):
    o = KG(spark, d).table("orders")
    said = F.when(F.col("o_orderkey") % 4 == 0, "Blue ships of the north").when(F.col("o_orderkey") % 4 == 1, "north, by the way").otherwise("nothing")
    return o.select(F.col("o_orderkey").alias("id"), text.token_overlap(said, F.lit("the blue north is wide")).alias("score"))


@query("fn_semantic_hash", """SELECT o_orderkey AS id, sha256('{"o_orderstatus":"' || o_orderstatus || '","n":' || o_custkey || '}') AS hash FROM orders""")
def fn_semantic_hash(spark, d):
    o = KG(spark, d).table("orders").withColumn("n", F.col("o_custkey"))
    return o.select(F.col("o_orderkey").alias("id"), ids.semantic_hash("o_orderstatus", "n").alias("hash"))


@query("fn_projection_hash", """SELECT o_orderkey AS id, CASE o_orderkey % 3 WHEN 0 THEN 'given' WHEN 1 THEN 'content' ELSE sha256('{"o_orderstatus":"' || o_orderstatus || '"}') END AS hash FROM orders""")
def fn_projection_hash(spark, d):
    k = F.col("o_orderkey") % 3
    return KG(spark, d).table("orders").select(F.col("o_orderkey").alias("id"), ids.projection_hash(F.when(k == 0, "given"), F.when(k == 1, "content"), "o_orderstatus").alias("hash"))


@query("set_id_delta", "SELECT o_orderkey AS id, 'a,c,d' || CASE WHEN o_orderkey % 2 = 0 THEN ',e' ELSE '' END AS ids FROM orders")
def set_id_delta(spark, d):
    lit = lambda s: F.split(F.lit(s), ",")
    new = F.when(F.col("o_orderkey") % 2 == 0, lit("c,e")).otherwise(lit("c"))
    return KG(spark, d).table("orders").select(F.col("o_orderkey").alias("id"), F.array_join(ranking.id_delta(lit("a,b,c,d"), lit("b,c"), new), ",").alias("ids"))


@query("vec_delete_entity", "SELECT id FROM nodes WHERE id <> 'supp-3'", "nodes")
def vec_delete_entity(spark, d):
    nodes = KG(spark, d).cte("nodes").select(F.col("id").alias("name"), ids.content_id("id", "ent-").alias("id"))
    return vectors.without_entity(nodes, "supp-3").select(F.col("name").alias("id"))


@query(
    "txt_windows_tokenizer",
    """SELECT doc_id, CAST(i AS INTEGER) AS chunk_order_index, trim(substr(text, i * 600 + 1, 800), E' \\n\\t\\r\\x0B\\f') AS content, least(800, length(text) - i * 600)::INTEGER AS tokens
        FROM (SELECT doc_id, text, unnest(range(0, (length(text) + 599) // 600)) AS i FROM documents)""",
)
def txt_windows_tokenizer(spark, d):
    docs = KG(spark, d).table("documents").select("doc_id", F.col("text").alias("whole"))
    # a tokenizer of single characters, as a caller may pass one
    return chunking.windows_by(docs, "whole", list, "".join, 800, 200).select("doc_id", "chunk_order_index", "content", "tokens")


@query("qry_rerank", "SELECT pos, round(score, 6) AS score, CAST(row_number() OVER (ORDER BY score DESC, pos) AS INTEGER) AS rank FROM (SELECT doc_id AS pos, length(text) / 1000.0E0 AS score FROM documents) ORDER BY score DESC, pos LIMIT 20")
def qry_rerank(spark, d):
    docs = KG(spark, d).table("documents").select(F.col("doc_id").alias("pos"), F.col("text").alias("content"))
    found = chunking.rerank(docs, "which is long", lambda q, texts: [len(t) / 1000 for t in texts], 20)
    return found.select("pos", F.round("score", 6).alias("score"), "rank")


@query("agg_retrieval_summary", "SELECT 0.75::DOUBLE AS recall_at_k, 0.5::DOUBLE AS mrr, (count(*) // 2)::BIGINT AS n_full, 0::BIGINT AS n_none FROM (SELECT unnest(range(0, 2 * (SELECT count(*) FROM orders))))")
def agg_retrieval_summary(spark, d):
    o = KG(spark, d).table("orders").select(F.explode(F.array(F.lit(0), F.lit(1))).alias("even"))
    rows = o.select(F.array(F.lit("a"), F.lit("b")).alias("expected"), F.when(F.col("even") == 0, F.split(F.lit("x,a,b"), ",")).otherwise(F.split(F.lit("y,b,z,a"), ",")).alias("ranked"))
    return aggregates.retrieval_summary(rows, 3)


@query(
    "qry_chunk_list",
    """WITH s AS (SELECT doc_id, text, length(text) / 1000.0E0 AS score, len(list_filter(string_split_regex(text, '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '')) AS tokens FROM documents),
        r AS (SELECT *, row_number() OVER (ORDER BY score DESC, doc_id) AS pos FROM s WHERE score >= 1.5), c AS (SELECT *, sum(tokens) OVER (ORDER BY pos) AS running FROM r WHERE pos <= 20)
        SELECT 'DC' || pos AS id, doc_id FROM c WHERE running <= 60000""",
)
def qry_chunk_list(spark, d):
    docs = KG(spark, d).table("documents").select("doc_id", F.col("doc_id").alias("pos"), F.col("text").alias("content"))
    p = QueryParam(chunk_top_k=20, max_total_tokens=60_000, rerank=lambda q, texts: [len(t) / 1000 for t in texts], min_rerank_score=1.5)
    return post_process(docs, "which is long", p).select("id", "doc_id")
