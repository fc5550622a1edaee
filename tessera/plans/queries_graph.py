"""Queries over lookups, joins, aggregates and the graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.ids import content_id
from tessera.operators import aggregates, graph, joins, lookups, mutations, ranking
from tessera.plans.registry import KG, query


def _ids(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


WANTED = [(0, "doc-7"), (1, "doc-nowhere"), (2, "doc-3"), (3, "doc-7")]
WANTED_SQL = "+ w(pos, id) AS (VALUES (0, 'doc-7'), (1, 'doc-nowhere'), (2, 'doc-3'), (3, 'doc-7'))"


@query("flt_get_by_id", "SELECT id, status, 0::INTEGER AS create_time, 0::INTEGER AS update_time FROM docs WHERE id = 'doc-7'", "docs")
def flt_get_by_id(spark, d):
    return lookups.get_by_id(KG(spark, d).cte("docs").select("id", "status"), "doc-7")


@query("flt_get_by_ids", WANTED_SQL + " SELECT w.pos, w.id, status FROM w LEFT JOIN docs ON docs.id = w.id", "docs")
def flt_get_by_ids(spark, d):
    return lookups.get_by_ids(KG(spark, d).cte("docs").select("id", "status"), _ids(spark, WANTED, "pos int, id string")).select("pos", "id", "status")


@query("join_filter_keys", WANTED_SQL + " SELECT DISTINCT id FROM w WHERE id NOT IN (SELECT id FROM docs)", "docs")
def join_filter_keys(spark, d):
    return lookups.missing_keys(_ids(spark, WANTED, "pos int, id string"), KG(spark, d).cte("docs"))


@query("join_existing_keys", WANTED_SQL + " SELECT DISTINCT id FROM w WHERE id IN (SELECT id FROM docs)", "docs")
def join_existing_keys(spark, d):
    return lookups.existing_keys(_ids(spark, WANTED, "pos int, id string"), KG(spark, d).cte("docs"))


@query(
    "flt_docs_by_status",
    "SELECT id, status, coalesce(nullif(trim(file_path), ''), 'no-file-path') AS file_path FROM docs WHERE status IN ('failed', 'pending')", "docs",
)
def flt_docs_by_status(spark, d):
    return lookups.by_status(KG(spark, d).cte("docs"), ["failed", "pending"]).select("id", "status", "file_path")


@query("flt_doc_by_path", "SELECT id, file_path FROM docs WHERE file_path = 'file-11' ORDER BY id LIMIT 1", "docs")
def flt_doc_by_path(spark, d):
    return lookups.by_path(KG(spark, d).cte("docs"), "file-11").select("id", "file_path")


@query("flt_has_edge", "SELECT src, tgt, weight FROM edges WHERE src = 'part-10' AND tgt = (SELECT min(tgt) FROM edges WHERE src = 'part-10')", "edges")
def flt_has_edge(spark, d):
    edges = KG(spark, d).cte("edges")
    other = edges.where("src = 'part-10'").agg(F.min("tgt")).first()[0]
    return lookups.has_edge(edges, other or "", "part-10").select("src", "tgt", "weight")


@query("flt_all_labels", "SELECT DISTINCT id FROM nodes", "nodes")
def flt_all_labels(spark, d):
    return KG(spark, d).cte("nodes").select("id").distinct().orderBy("id")


@query(
    "flt_search_labels",
    """SELECT id AS label, CAST(CASE WHEN lower(id) = 'part-1' THEN 1000 WHEN starts_with(lower(id), 'part-1') THEN 500
        ELSE 100 - length(id) + CASE WHEN contains(lower(id), ' part-1') OR contains(lower(id), '_part-1') THEN 50 ELSE 0 END END AS INTEGER) AS score
        FROM nodes WHERE contains(lower(id), 'part-1') ORDER BY score DESC, label LIMIT 25""", "nodes",
)
def flt_search_labels(spark, d):
    return lookups.search_labels(KG(spark, d).cte("nodes"), "Part-1 ", 25)


@query(
    "topk_paginate",
    """+ r AS (SELECT * FROM docs WHERE status = 'pending'), p AS (SELECT id, created_at FROM r ORDER BY created_at DESC NULLS LAST, id LIMIT 10 OFFSET 20)
        SELECT (SELECT count(*) FROM r) AS total, id, created_at FROM p""", "docs",
)
def topk_paginate(spark, d):
    return lookups.paginate(KG(spark, d).cte("docs"), 3, 5, "created_at", True, "pending").select("total", "id", "created_at")


@query(
    "join_total_of_empty_page",
    "SELECT count(*) AS total, CAST(NULL AS VARCHAR) AS id FROM docs", "docs",
)
def join_total_of_empty_page(spark, d):
    return lookups.paginate(KG(spark, d).cte("docs"), 10**6, 200, "id", False).select("total", "id")


@query("agg_status_counts", "SELECT s.status, count(docs.id) AS n FROM (VALUES ('pending'), ('processing'), ('preprocessed'), ('processed'), ('failed')) AS s(status) LEFT JOIN docs ON docs.status = s.status GROUP BY s.status UNION ALL SELECT 'all', count(*) FROM docs", "docs")
def agg_status_counts(spark, d):
    return aggregates.status_counts(KG(spark, d).cte("docs"), total=True)


@query("agg_node_degree", "SELECT node, degree FROM deg", "deg")
def agg_node_degree(spark, d):
    return graph.degrees(KG(spark, d).cte("edges"))


@query("agg_edge_degree", "SELECT e.src, e.tgt, a.degree + b.degree AS degree FROM edges e JOIN deg a ON a.node = e.src JOIN deg b ON b.node = e.tgt", "deg")
def agg_edge_degree(spark, d):
    return graph.edge_degrees(KG(spark, d).cte("edges")).select("src", "tgt", "degree")


@query("agg_degrees_zero_filled", "SELECT nodes.id AS node, coalesce(degree, 0) AS degree FROM nodes LEFT JOIN deg ON deg.node = nodes.id", "nodes", "deg")
def agg_degrees_zero_filled(spark, d):
    kg = KG(spark, d)
    return graph.degrees_of(kg.cte("nodes").select(F.col("id").alias("node")), kg.cte("edges"))


@query("agg_popular_labels", "SELECT node, degree FROM deg ORDER BY degree DESC, node LIMIT 30", "deg")
def agg_popular_labels(spark, d):
    return graph.popular(KG(spark, d).cte("edges"), 30)


@query(
    "agg_merge_relations",
    """+ k AS (SELECT DISTINCT src, tgt, unnest(string_split(keywords, ',')) AS k FROM frag), j AS (SELECT src, tgt, string_agg(k, ',' ORDER BY k) AS keywords FROM k GROUP BY src, tgt)
        SELECT edges.src, edges.tgt, weight, j.keywords, n AS n_fragments FROM edges JOIN j ON j.src = edges.src AND j.tgt = edges.tgt""", "edges",
)
def agg_merge_relations(spark, d):
    return aggregates.merge_relations(KG(spark, d).cte("frag"))


ENTITY_FRAGMENTS = """SELECT 'cust-' || o_custkey AS entity, o_orderpriority AS entity_type, o_orderstatus || ' ' || o_orderpriority AS description,
    'chunk-' || (o_orderkey % 997) AS source_id, o_orderkey AS pos FROM orders"""


@query(
    "agg_merge_entities",
    f"""WITH f AS ({ENTITY_FRAGMENTS}), t AS (SELECT entity, entity_type, count(*) AS n, min(pos) AS seen FROM f GROUP BY ALL),
        y AS (SELECT entity, entity_type, row_number() OVER (PARTITION BY entity ORDER BY n DESC, seen) AS k FROM t),
        i AS (SELECT entity, source_id, min(pos) AS pos FROM f GROUP BY ALL), l AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY pos DESC) AS k FROM i),
        s AS (SELECT entity, string_agg(source_id, '<SEP>' ORDER BY pos) AS source_ids FROM l WHERE k <= 5 GROUP BY entity),
        x AS (SELECT entity, description, min(pos) AS pos FROM f GROUP BY ALL), z AS (SELECT entity, string_agg(description, '<SEP>' ORDER BY pos) AS descriptions FROM x GROUP BY entity)
        SELECT y.entity, y.entity_type, s.source_ids, z.descriptions FROM y JOIN s USING (entity) JOIN z USING (entity) WHERE k = 1""",
)
def agg_merge_entities(spark, d):
    KG(spark, d).table("orders").createOrReplaceTempView("orders")
    rows = aggregates.merge_entities(spark.sql(ENTITY_FRAGMENTS), cap=5)
    return rows.select("entity", "entity_type", F.array_join("source_ids", "<SEP>").alias("source_ids"), F.array_join("descriptions", "<SEP>").alias("descriptions"))


@query("win_majority_type", f"WITH f AS ({ENTITY_FRAGMENTS}), t AS (SELECT entity, entity_type, count(*) AS n, min(pos) AS seen FROM f GROUP BY ALL) SELECT entity, arg_min(entity_type, -n * 1000000000 + seen) AS entity_type FROM t GROUP BY entity")
def win_majority_type(spark, d):
    KG(spark, d).table("orders").createOrReplaceTempView("orders")
    return aggregates.majority(spark.sql(ENTITY_FRAGMENTS), "entity", "entity_type", "pos")


for _how, _sql in {
    "keep_first": "arg_min(o_orderpriority, o_orderkey)",
    "keep_last": "arg_max(o_orderpriority, o_orderkey)",
    "max": "max(o_totalprice)",
}.items():

    def _attributes(spark, d, how=_how):
        column = "o_totalprice" if how == "max" else "o_orderpriority"
        return aggregates.merge_attributes(KG(spark, d).table("orders"), "o_custkey", column, how, "o_orderkey").withColumnRenamed(column, "value")

    query(f"agg_attributes_{_how}", f"SELECT o_custkey, {_sql} AS value FROM orders GROUP BY o_custkey")(_attributes)


@query(
    "agg_attributes_join_unique",
    "WITH x AS (SELECT o_custkey, o_orderpriority AS v, min(o_orderkey) AS p FROM orders GROUP BY ALL) SELECT o_custkey, string_agg(v, '<SEP>' ORDER BY p) AS value FROM x GROUP BY o_custkey",
)
def agg_attributes_join_unique(spark, d):
    return aggregates.merge_attributes(KG(spark, d).table("orders"), "o_custkey", "o_orderpriority", "join_unique", "o_orderkey").withColumnRenamed("o_orderpriority", "value")


@query(
    "agg_references",
    """WITH c AS (SELECT 'file-' || (o_custkey % 41) AS file_path, o_orderkey AS pos FROM orders), g AS (SELECT file_path, count(*) AS n, min(pos) AS f FROM c GROUP BY 1)
        SELECT file_path, CAST(row_number() OVER (ORDER BY n DESC, f) AS VARCHAR) AS reference_id, n FROM g""",
)
def agg_references(spark, d):
    o = KG(spark, d).table("orders")
    return aggregates.references(o.select(F.concat(F.lit("file-"), (F.col("o_custkey") % 41).cast("string")).alias("file_path"), F.col("o_orderkey").alias("pos")))


for _how, _sql in {"max": "max(l_tax)", "first": "arg_min(l_tax, l_linenumber * 1000000000000 + l_partkey * 1000000 + l_suppkey * 100 + CAST(l_quantity AS BIGINT))"}.items():

    def _rerank(spark, d, how=_how):
        rows = KG(spark, d).table("lineitem").select(F.col("l_orderkey").alias("doc"), F.expr("l_linenumber * 1000000000000 + l_partkey * 1000000 + l_suppkey * 100 + CAST(l_quantity AS BIGINT)").alias("pos"), F.col("l_tax").alias("score"))
        return aggregates.rerank_documents(rows, how)

    query(f"agg_rerank_{_how}", f"SELECT l_orderkey AS doc, {_sql} AS score FROM lineitem GROUP BY 1")(_rerank)


@query(
    "agg_covered_intervals",
    """WITH i AS (SELECT o_custkey AS k, (o_orderkey * 37) % 5000 AS s, (o_orderkey * 37) % 5000 + 1 + o_orderkey % 400 AS e FROM orders),
        w AS (SELECT *, max(e) OVER (PARTITION BY k ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM i)
        SELECT k, CAST(sum(greatest(e - greatest(s, coalesce(b, s)), 0)) AS BIGINT) AS covered FROM w GROUP BY k""",
)
def agg_covered_intervals(spark, d):
    o = KG(spark, d).table("orders")
    s = (F.col("o_orderkey") * 37) % 5000
    return aggregates.covered(o.select(F.col("o_custkey").alias("k"), s.alias("start"), (s + 1 + F.col("o_orderkey") % 400).alias("end")), "k")


@query("agg_latency", "SELECT event_type, round(quantile_cont(value, 0.5), 6) AS median_ms, round(quantile_cont(value, 0.95), 6) AS p95_ms, min(value) AS min_ms, max(value) AS max_ms FROM events GROUP BY 1")
def agg_latency(spark, d):
    rows = aggregates.latency(KG(spark, d).table("events"), "value", "event_type")
    return rows.withColumn("median_ms", F.round("median_ms", 6)).withColumn("p95_ms", F.round("p95_ms", 6))


@query("agg_token_usage", "SELECT CAST(sum(l_linenumber) AS BIGINT) AS prompt_tokens, CAST(sum(l_orderkey % 7) AS BIGINT) AS completion_tokens, CAST(sum(l_linenumber + l_orderkey % 7) AS BIGINT) AS total_tokens, count(*) AS calls FROM lineitem")
def agg_token_usage(spark, d):
    rows = KG(spark, d).table("lineitem").select(F.col("l_linenumber").cast("long").alias("prompt_tokens"), (F.col("l_orderkey") % 7).alias("completion_tokens"), F.lit(None).cast("long").alias("total_tokens"))
    return aggregates.usage(rows)


@query("join_local_entities", "+ h AS (SELECT 'part-' || p_partkey AS id, row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) AS pos FROM part QUALIFY pos <= 40) SELECT h.id, h.pos, nodes.entity_type, coalesce(deg.degree, 0) AS rank FROM h JOIN nodes ON nodes.id = h.id LEFT JOIN deg ON deg.node = h.id", "nodes", "deg")
def join_local_entities(spark, d):
    kg = KG(spark, d)
    return joins.local_entities(_hits(kg), kg.cte("nodes"), kg.cte("edges")).select("id", "pos", "entity_type", "rank")


HITS_SQL = "h AS (SELECT 'part-' || p_partkey AS id, row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) AS pos FROM part QUALIFY pos <= 40)"


def _hits(kg, n=40):
    top = kg.table("part").orderBy(F.desc("p_retailprice"), "p_partkey").limit(n)
    from pyspark.sql import Window

    return top.select(F.concat(F.lit("part-"), F.col("p_partkey").cast("string")).alias("id"), F.row_number().over(Window.orderBy(F.desc("p_retailprice"), "p_partkey")).cast("long").alias("pos"))


@query("join_entity_edges", f"+ {HITS_SQL}, x AS (SELECT DISTINCT src, tgt FROM edges WHERE src IN (SELECT id FROM h) OR tgt IN (SELECT id FROM h)) SELECT x.src, x.tgt, weight, a.degree + b.degree AS rank FROM x JOIN edges USING (src, tgt) JOIN deg a ON a.node = x.src JOIN deg b ON b.node = x.tgt", "deg")
def join_entity_edges(spark, d):
    kg = KG(spark, d)
    return joins.entity_edges(_hits(kg), kg.cte("edges")).select("src", "tgt", "weight", "rank")


@query("join_edge_entities", "+ t AS (SELECT src, tgt, row_number() OVER (ORDER BY weight DESC, src, tgt) AS pos FROM edges QUALIFY pos <= 50), x AS (SELECT src AS id, pos, 0 AS side FROM t UNION ALL SELECT tgt, pos, 1 FROM t) SELECT id, min(pos) AS pos FROM x GROUP BY id", "edges")
def join_edge_entities(spark, d):
    from pyspark.sql import Window

    kg = KG(spark, d)
    top = kg.cte("edges").orderBy(F.desc("weight"), "src", "tgt").limit(50)
    top = top.withColumn("pos", F.row_number().over(Window.orderBy(F.desc("weight"), "src", "tgt")).cast("long"))
    return joins.edge_entities(top, kg.cte("nodes")).select("id", "pos")


OWNED_SQL = """c AS (SELECT h.id AS owner, h.pos AS owner_pos, frag.source_id AS chunk_id, min(frag.pos) AS p FROM h JOIN frag ON frag.src = h.id GROUP BY ALL),
    o AS (SELECT *, count(*) OVER (PARTITION BY chunk_id) AS occurrences, row_number() OVER (PARTITION BY chunk_id ORDER BY owner_pos, p) AS k FROM c)"""


def _owners(kg):
    ids = kg.cte("frag").groupBy("src", "source_id").agg(F.min("pos").alias("p"))
    lists = ids.groupBy("src").agg(aggregates.ordered_distinct(F.col("source_id"), F.col("p")).alias("source_ids"))
    return _hits(kg).join(lists, F.col("id") == F.col("src")).select("id", "pos", "source_ids")


@query("join_entity_chunks", f"+ {HITS_SQL}, {OWNED_SQL} SELECT chunk_id, owner, owner_pos, occurrences FROM o WHERE k = 1", "frag")
def join_entity_chunks(spark, d):
    kg = KG(spark, d)
    chunks = kg.cte("frag").select(F.col("source_id").alias("chunk_id")).distinct()
    return joins.owned_chunks(_owners(kg), chunks).select("chunk_id", "owner", "owner_pos", "occurrences")


@query("join_relation_chunks", f"+ {HITS_SQL}, {OWNED_SQL} SELECT chunk_id, owner, owner_pos, occurrences FROM o WHERE k = 1 AND chunk_id NOT LIKE '%1'", "frag")
def join_relation_chunks(spark, d):
    kg = KG(spark, d)
    chunks = kg.cte("frag").select(F.col("source_id").alias("chunk_id")).distinct()
    return joins.owned_chunks_without(_owners(kg), chunks, chunks.where("chunk_id like '%1'")).select("chunk_id", "owner", "owner_pos", "occurrences")


@query("join_missing_endpoints", "SELECT DISTINCT node AS id, 'UNKNOWN' AS entity_type FROM ends WHERE node NOT IN (SELECT id FROM nodes WHERE entity_type <> 'SUPPLIER')", "ends", "nodes")
def join_missing_endpoints(spark, d):
    kg = KG(spark, d)
    return graph.missing_endpoints(kg.cte("edges"), kg.cte("nodes").where("entity_type <> 'SUPPLIER'"))


@query("join_adjacency", "+ w AS (SELECT 'supp-' || s_suppkey AS node FROM supplier WHERE s_suppkey % 10 = 0) SELECT w.node, e.src, e.tgt FROM w JOIN edges e ON e.src = w.node OR e.tgt = w.node", "edges")
def join_adjacency(spark, d):
    kg = KG(spark, d)
    w = kg.table("supplier").where("s_suppkey % 10 = 0").select(F.concat(F.lit("supp-"), F.col("s_suppkey").cast("string")).alias("node"))
    return graph.adjacency(w, kg.cte("edges"))


@query("join_pairs", "+ p(a, b) AS (SELECT tgt, src FROM edges WHERE src LIKE '%7') SELECT a, b, weight FROM p JOIN edges ON edges.src = least(a, b) AND edges.tgt = greatest(a, b)", "edges")
def join_pairs(spark, d):
    edges = KG(spark, d).cte("edges")
    return graph.edges_of_pairs(edges.where("src like '%7'").select(F.col("tgt").alias("a"), F.col("src").alias("b")), edges).select("a", "b", "weight")


@query("join_export_pairs", "SELECT src, tgt FROM edges UNION ALL SELECT tgt, src FROM edges", "edges")
def join_export_pairs(spark, d):
    return graph.endpoints(KG(spark, d).cte("edges")).select(F.col("node").alias("src"), F.col("other").alias("tgt"))


INTERVALS = {
    "a": "SELECT CAST(floor(l_orderkey / 64) AS BIGINT) AS g, l_orderkey * 10 + l_linenumber AS a_id, l_orderkey % 64 * 16 AS s, l_orderkey % 64 * 16 + CAST(l_quantity AS BIGINT) AS e FROM lineitem",
    "b": "SELECT CAST(floor(o_orderkey / 64) AS BIGINT) AS g, o_orderkey AS b_id, o_orderkey % 64 * 16 AS s, o_orderkey % 64 * 16 + 20 AS e FROM orders",
}


@query(
    "join_overlaps",
    f"""WITH a AS ({INTERVALS['a']}), b AS ({INTERVALS['b']}), j AS (SELECT a.g, a_id, b_id, a.s AS a0, a.e AS a1, b.s AS b0, b.e AS b1 FROM a JOIN b ON a.g = b.g AND a.s < b.e AND b.s < a.e)
        SELECT g, a_id, b_id, greatest(a0, b0) AS overlap_start, least(a1, b1) AS overlap_end, least(a1, b1) - greatest(a0, b0) AS overlap,
        round((least(a1, b1) - greatest(a0, b0)) / greatest(a1 - a0, 1), 6) AS a_ratio, round((least(a1, b1) - greatest(a0, b0)) / greatest(b1 - b0, 1), 6) AS b_ratio,
        CASE WHEN a0 = b0 AND a1 = b1 THEN 'FULL' WHEN a0 <= b0 AND a1 >= b1 THEN 'CONTAINS' WHEN b0 <= a0 AND b1 >= a1 THEN 'PARTIAL' ELSE 'OVERLAPS' END AS link_type FROM j""",
)
def join_overlaps(spark, d):
    kg = KG(spark, d)
    for t in ("lineitem", "orders"):
        kg.table(t).createOrReplaceTempView(t)
    a, b = (spark.sql(INTERVALS[k]).withColumnRenamed("s", "start").withColumnRenamed("e", "end") for k in "ab")
    return joins.overlaps(a, b, "g", 500)


@query("join_valid_at", "SELECT o_orderkey AS id FROM orders WHERE o_orderdate <= TIMESTAMP '1995-01-01' AND (o_orderkey % 5 = 0 OR TIMESTAMP '1995-01-01' < o_orderdate + INTERVAL 200 DAY)")
def join_valid_at(spark, d):
    o = KG(spark, d).table("orders").withColumn("valid_from", F.col("o_orderdate"))
    o = o.withColumn("valid_to", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderdate") + F.expr("interval 200 days")))
    return o.where(joins.valid_at(F.to_timestamp(F.lit("1995-01-01")).cast(dict(o.dtypes)["o_orderdate"]))).select(F.col("o_orderkey").alias("id"))


@query(
    "join_version_difference",
    """WITH o AS (SELECT o_orderkey AS stable_id, md5(o_orderpriority) AS hash FROM orders WHERE o_orderkey % 3 <> 0),
        n AS (SELECT o_orderkey AS stable_id, md5(CASE WHEN o_orderkey % 11 = 0 THEN 'x' ELSE o_orderpriority END) AS hash FROM orders WHERE o_orderkey % 4 <> 0)
        SELECT coalesce(o.stable_id, n.stable_id) AS stable_id, CASE WHEN o.hash IS NULL THEN 'ADDED' WHEN n.hash IS NULL THEN 'REMOVED' WHEN o.hash = n.hash THEN 'UNCHANGED' ELSE 'UPDATED' END AS change
        FROM o FULL JOIN n ON o.stable_id = n.stable_id""",
)
def join_version_difference(spark, d):
    o = KG(spark, d).table("orders").select(F.col("o_orderkey").alias("stable_id"), F.col("o_orderpriority").alias("p"))
    old = o.where("stable_id % 3 <> 0").select("stable_id", F.md5("p").alias("hash"))
    new = o.where("stable_id % 4 <> 0").select("stable_id", F.md5(F.when(F.col("stable_id") % 11 == 0, "x").otherwise(F.col("p"))).alias("hash"))
    return joins.difference(old, new)


@query("join_signatures", "SELECT p_partkey AS id, CASE WHEN p_brand = 'Brand#11' THEN 'UNKNOWN_RELATION_SIGNATURE' WHEN p_size % 2 = 0 THEN 'OK' ELSE 'INVALID_RELATION_SIGNATURE' END AS code FROM part")
def join_signatures(spark, d):
    p = KG(spark, d).table("part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("relation_type"), F.when(F.col("p_size") % 2 == 0, "A").otherwise("B").alias("src_type"), F.lit("C").alias("tgt_type"))
    allowed = p.where("relation_type <> 'Brand#11'").select("relation_type", F.lit("A").alias("src_type"), F.lit("C").alias("tgt_type")).distinct()
    return joins.check_signatures(p, allowed).select("id", "code")


@query(
    "join_scoped_terms",
    """WITH t AS (SELECT c_custkey AS term_id, c_mktsegment AS key, c_nationkey % 5 AS module, c_nationkey % 3 AS domain FROM customer),
        r AS (SELECT s_suppkey AS entry_id, CASE s_suppkey % 5 WHEN 0 THEN 'BUILDING' WHEN 1 THEN 'MACHINERY' WHEN 2 THEN 'AUTOMOBILE' WHEN 3 THEN 'FURNITURE' ELSE 'HOUSEHOLD' END AS key,
            CASE WHEN s_suppkey % 2 = 0 THEN s_nationkey % 5 END AS module, CASE WHEN s_suppkey % 3 = 0 THEN s_nationkey % 3 END AS domain, CASE WHEN s_suppkey % 4 = 0 THEN 'CONFIRMED' ELSE 'CANDIDATE' END AS status, s_acctbal AS confidence FROM supplier),
        j AS (SELECT term_id, entry_id, row_number() OVER (PARTITION BY term_id ORDER BY (r.module IS NOT NULL)::INT + (r.domain IS NOT NULL)::INT DESC, (status = 'CONFIRMED')::INT DESC, confidence DESC, entry_id) AS k
            FROM t JOIN r ON t.key = r.key AND (r.module IS NULL OR r.module = t.module) AND (r.domain IS NULL OR r.domain = t.domain))
        SELECT term_id, entry_id FROM j WHERE k = 1""",
)
def join_scoped_terms(spark, d):
    kg = KG(spark, d)
    t = kg.table("customer").selectExpr("c_custkey AS term_id", "c_mktsegment AS key", "c_nationkey % 5 AS module", "c_nationkey % 3 AS domain")
    r = kg.table("supplier").selectExpr(
        "s_suppkey AS entry_id", "CASE s_suppkey % 5 WHEN 0 THEN 'BUILDING' WHEN 1 THEN 'MACHINERY' WHEN 2 THEN 'AUTOMOBILE' WHEN 3 THEN 'FURNITURE' ELSE 'HOUSEHOLD' END AS key",
        "CASE WHEN s_suppkey % 2 = 0 THEN s_nationkey % 5 END AS module", "CASE WHEN s_suppkey % 3 = 0 THEN s_nationkey % 3 END AS domain",
        "CASE WHEN s_suppkey % 4 = 0 THEN 'CONFIRMED' ELSE 'CANDIDATE' END AS status", "s_acctbal AS confidence", "s_name AS canonical",
    )
    return joins.resolve_terms(t, r, ["module", "domain"]).select("term_id", "entry_id")


@query(
    "join_conflicts",
    """WITH i AS (SELECT o_orderkey AS item_id, o_custkey AS g, CASE WHEN o_orderpriority LIKE '%URGENT%' THEN 0 WHEN o_orderpriority LIKE '%LOW%' THEN 1 END AS side FROM orders),
        s AS (SELECT g, 1 - side AS side, count(*) AS n, min(item_id) AS first FROM i WHERE side IS NOT NULL GROUP BY ALL)
        SELECT i.g, CAST(0 AS INTEGER) AS topic, CAST(i.side AS INTEGER) AS side, item_id, n AS n_opposed, first AS opposed FROM i JOIN s ON s.g = i.g AND s.side = i.side""",
)
def join_conflicts(spark, d):
    i = KG(spark, d).table("orders").selectExpr("o_orderkey AS item_id", "o_custkey AS g", "o_orderpriority AS text")
    return joins.conflicts(i, "g", [("urgent", "low")])


@query("join_doc_entities", "SELECT DISTINCT l_orderkey AS doc, 'part-' || l_partkey AS entity FROM lineitem")
def join_doc_entities(spark, d):
    kg = KG(spark, d)
    f = kg.cte("frag")
    docs = kg.table("orders").select(F.col("o_orderkey").alias("doc"), F.array(F.concat(F.lit("chunk-"), F.col("o_orderkey").cast("string"))).alias("chunks"))
    nodes = f.groupBy(F.col("src").alias("entity")).agg(F.collect_set("source_id").alias("sources"))
    return joins.ownership(docs, nodes)


@query("join_integrity", "SELECT (SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 9 <> 0)) AS lost_orders, (SELECT count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part)) AS lost_parts")
def join_integrity(spark, d):
    kg = KG(spark, d)
    li = kg.table("lineitem")
    a = li.join(kg.table("orders").where("o_orderkey % 9 <> 0"), F.col("l_orderkey") == F.col("o_orderkey"), "left_anti").agg(F.count(F.lit(1)).alias("lost_orders"))
    return a.crossJoin(li.join(kg.table("part"), F.col("l_partkey") == F.col("p_partkey"), "left_anti").agg(F.count(F.lit(1)).alias("lost_parts")))  # one row each


@query("join_coverage", "SELECT count(*) AS n, count(*) FILTER (WHERE c.c_custkey IS NULL) AS missing_record, count(*) FILTER (WHERE c.c_custkey IS NOT NULL AND c.seg IS NULL) AS missing_seg FROM (SELECT DISTINCT o_custkey AS k FROM orders) o LEFT JOIN (SELECT c_custkey, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS seg FROM customer WHERE c_custkey % 6 <> 0) c ON o.k = c.c_custkey")
def join_coverage(spark, d):
    kg = KG(spark, d)
    payload = kg.table("orders").select(F.col("o_custkey").alias("k")).distinct()
    records = kg.table("customer").where("c_custkey % 6 <> 0").select(F.col("c_custkey").alias("k"), F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("seg"))
    return joins.coverage(payload, records, "k", ["seg"])


@query("graph_top_degree", "+ t AS (SELECT nodes.id AS node, coalesce(degree, 0) AS degree FROM nodes LEFT JOIN deg ON deg.node = nodes.id ORDER BY degree DESC, node LIMIT 400) SELECT src, tgt FROM edges WHERE src IN (SELECT node FROM t) AND tgt IN (SELECT node FROM t)", "nodes", "deg")
def graph_top_degree(spark, d):
    kg = KG(spark, d)
    return graph.top_degree_subgraph(kg.cte("nodes"), kg.cte("edges"), 400)[1].select("src", "tgt")


@query(
    "graph_neighbourhood",
    """+ l1 AS (SELECT DISTINCT other AS node FROM ends WHERE node = 'supp-1'), l2 AS (SELECT DISTINCT other AS node FROM ends WHERE node IN (SELECT node FROM l1) AND other <> 'supp-1' AND other NOT IN (SELECT node FROM l1)),
        s AS (SELECT 'supp-1' AS node, 0 AS depth UNION ALL SELECT node, 1 FROM l1 UNION ALL SELECT node, 2 FROM l2)
        SELECT s.node, s.depth, deg.degree FROM s JOIN deg ON deg.node = s.node ORDER BY depth, degree DESC, s.node LIMIT 150""", "deg",
)
def graph_neighbourhood(spark, d):
    return graph.neighbourhood(KG(spark, d).cte("edges"), "supp-1", 2, 150)[0]


@query(
    "graph_paths",
    """+ o AS (SELECT node AS a, other AS b, least(node, other) || '-' || greatest(node, other) AS e FROM ends WHERE node = 'supp-1'),
        t AS (SELECT a, b, other AS c, e AS e1, least(b, other) || '-' || greatest(b, other) AS e2 FROM o JOIN ends ON ends.node = o.b WHERE other <> a),
        r AS (SELECT 1 AS hops, a || '>' || b AS path, e AS edges FROM o UNION ALL SELECT 2, a || '>' || b || '>' || c, least(e1, e2) || '|' || greatest(e1, e2) FROM t),
        g AS (SELECT hops, edges, min(path) AS path FROM r GROUP BY ALL) SELECT hops, path FROM g ORDER BY hops, path LIMIT 200""", "ends",
)
def graph_paths(spark, d):
    seeds = spark.createDataFrame([("supp-1",)], "node string")
    return graph.paths(KG(spark, d).cte("edges"), seeds, 200).select("hops", "path")


@query("graph_delete_nodes", "SELECT src, tgt FROM edges WHERE tgt NOT IN ('supp-1', 'supp-2') AND src NOT LIKE '%5'", "edges")
def graph_delete_nodes(spark, d):
    kg = KG(spark, d)
    gone = kg.cte("nodes").where("id in ('supp-1', 'supp-2') or id like 'part-%5'").select("id").unionByName(spark.createDataFrame([("nobody",)], "id string"))
    return graph.delete_nodes(kg.cte("nodes"), kg.cte("edges"), gone)[1].select("src", "tgt")


@query("graph_merge_nodes", "+ m AS (SELECT src, CASE WHEN tgt IN ('supp-2', 'supp-3') THEN 'supp-1' ELSE tgt END AS tgt, weight, n, tgt AS old FROM edges) SELECT least(src, tgt) AS src, greatest(src, tgt) AS tgt, max(weight) AS weight, arg_min(n, old) AS n FROM m WHERE src <> tgt GROUP BY 1, 2", "edges")
def graph_merge_nodes(spark, d):
    return graph.merge_nodes(KG(spark, d).cte("edges"), ["supp-2", "supp-3"], "supp-1")


@query("graph_upsert", "+ n AS (SELECT 'part-' || p_partkey AS id, CASE WHEN p_size % 2 = 0 THEN 'NEW' END AS entity_type FROM part WHERE p_partkey % 10 = 0) SELECT nodes.id, coalesce(n.entity_type, nodes.entity_type) AS entity_type, nodes.name FROM nodes LEFT JOIN n ON n.id = nodes.id", "nodes")
def graph_upsert(spark, d):
    kg = KG(spark, d)
    new = kg.table("part").where("p_partkey % 10 = 0").select(F.concat(F.lit("part-"), F.col("p_partkey").cast("string")).alias("id"), F.when(F.col("p_size") % 2 == 0, "NEW").alias("entity_type"), F.lit(1).alias("pos"))
    return graph.upsert(kg.cte("nodes"), new, ["id"])


@query("mut_upsert", "SELECT id, status, CAST(5 AS BIGINT) AS create_time, CAST(CASE WHEN owner % 2 = 0 THEN 9 ELSE 6 END AS BIGINT) AS update_time FROM docs", "docs")
def mut_upsert(spark, d):
    docs = KG(spark, d).cte("docs")
    old = docs.select("id", "status", F.lit(5).cast("long").alias("create_time"), F.lit(6).cast("long").alias("update_time"))
    new = docs.where("owner % 2 = 0").select("id", "status", F.lit(1).alias("pos"))
    return mutations.upsert(old, new, 9).select("id", "status", F.col("create_time").cast("long").alias("create_time"), F.col("update_time").cast("long").alias("update_time"))


@query("mut_delete", "SELECT id FROM docs WHERE status <> 'failed'", "docs")
def mut_delete(spark, d):
    docs = KG(spark, d).cte("docs").select("id", "status")
    return mutations.delete(docs, docs.where("status = 'failed'").unionByName(spark.createDataFrame([("nobody", "")], docs.schema))).select("id")


@query("mut_deletion_impact", "SELECT src AS entity, CASE WHEN count(*) FILTER (WHERE g) = 0 THEN 'keep' WHEN count(*) FILTER (WHERE g) = count(*) THEN 'delete' ELSE 'rebuild' END AS action, count(*) FILTER (WHERE NOT g) AS n_left FROM (SELECT DISTINCT src, source_id, CAST(substr(source_id, 7) AS BIGINT) % 3 = 0 AS g FROM frag) GROUP BY src", "frag")
def mut_deletion_impact(spark, d):
    f = KG(spark, d).cte("frag").select(F.col("src").alias("entity"), "source_id")
    return mutations.deletion_impact(f, f.where("cast(substr(source_id, 7) as bigint) % 3 = 0"))


@query("mut_repair", "SELECT id, CASE WHEN status = 'processed' THEN 'pending' ELSE status END AS status FROM docs WHERE owner % 4 <> 0 OR status = 'failed'", "docs")
def mut_repair(spark, d):
    docs = KG(spark, d).cte("docs")
    status = docs.select("id", F.when(F.col("status") == "processed", "processing").otherwise(F.col("status")).alias("status"))
    return mutations.repair(status, docs.where("owner % 4 <> 0"))


@query(
    "set_enqueue",
    """WITH t AS (SELECT doc_id AS pos, trim(text, E' \\n\\t\\r') AS content FROM documents), k AS (SELECT *, 'doc-' || md5(content) AS d FROM t), f AS (SELECT d, min(pos) AS first FROM k GROUP BY d)
        SELECT pos, CASE WHEN pos <> first THEN 'dup-' || md5(k.d || '-' || pos) ELSE k.d END AS id, CASE WHEN pos <> first THEN 'failed' ELSE 'pending' END AS status, CASE WHEN pos <> first THEN k.d END AS original_id
        FROM k JOIN f ON f.d = k.d""",
)
def set_enqueue(spark, d):
    docs = KG(spark, d).table("documents").select(F.col("doc_id").alias("pos"), "text", F.lit("").alias("file_path"))
    stored = spark.createDataFrame([], "id string")
    return mutations.enqueue(docs, stored).select("pos", "id", "status", "original_id")


@query("mut_error_docs", "SELECT 'error-' || md5(file_path) AS id, 'failed' AS status, file_path FROM docs WHERE owner = 11", "docs")
def mut_error_docs(spark, d):
    return mutations.enqueue_errors(KG(spark, d).cte("docs").where("owner = 11").select("file_path", F.lit("unreadable").alias("error"))).select("id", "status", "file_path")


@query("mut_reference_decisions", "+ o AS (SELECT DISTINCT l_partkey AS object_id FROM lineitem WHERE l_orderkey = 1), a AS (SELECT l_partkey AS object_id, count(*) AS n FROM lineitem WHERE l_orderkey <> 1 AND l_returnflag = 'N' GROUP BY 1) SELECT o.object_id, CASE WHEN coalesce(n, 0) = 0 THEN 'DELETE' ELSE 'KEEP' END AS decision, coalesce(n, 0) AS n_active FROM o LEFT JOIN a ON a.object_id = o.object_id".replace("+ o", "WITH o"))
def mut_reference_decisions(spark, d):
    c = KG(spark, d).table("lineitem").select(F.col("l_partkey").alias("object_id"), F.col("l_orderkey").cast("string").alias("document_id"), (F.col("l_returnflag") == "N").alias("active"))
    return mutations.reference_decisions(c, "1")


@query("mut_version_plan", "WITH c AS (SELECT o_orderkey AS stable_id, CASE o_orderstatus WHEN 'O' THEN 'ADDED' WHEN 'F' THEN 'UPDATED' ELSE 'REMOVED' END AS change FROM orders), s(change, phase, action) AS (VALUES ('ADDED', 0, 'WRITE'), ('UPDATED', 0, 'WRITE'), ('ADDED', 2, 'ACTIVATE'), ('UPDATED', 2, 'ACTIVATE'), ('UPDATED', 3, 'DEACTIVATE_OLD'), ('REMOVED', 3, 'DEACTIVATE_OLD'), ('REMOVED', 4, 'DELETE')) SELECT row_number() OVER (ORDER BY phase, stable_id, action) AS step, action, stable_id FROM c JOIN s USING (change)")
def mut_version_plan(spark, d):
    c = KG(spark, d).table("orders").selectExpr("o_orderkey AS stable_id", "CASE o_orderstatus WHEN 'O' THEN 'ADDED' WHEN 'F' THEN 'UPDATED' ELSE 'REMOVED' END AS change")
    return mutations.version_plan(c).withColumn("step", F.col("step").cast("long"))


@query("win_last_write", "SELECT l_orderkey AS id, arg_max(l_comment, p) AS value FROM (SELECT l_orderkey, l_returnflag || l_linenumber AS l_comment, l_linenumber AS p FROM lineitem) GROUP BY 1")
def win_last_write(spark, d):
    # an order may have several lines of one number: the first in the table counts, as in arg_max, which passes over nulls
    at = F.struct("_metadata.file_path", "_metadata.row_index").alias("at")
    rows = KG(spark, d).table("lineitem").select(F.col("l_orderkey").alias("id"), F.concat("l_returnflag", F.col("l_linenumber").cast("string")).alias("value"), F.col("l_linenumber").alias("pos"), at)
    rows = rows.withColumn("pos", F.when(F.col("value").isNotNull(), F.col("pos")))
    return ranking.last_write(rows, ["id"], "pos", "at").select("id", "value")


@query("fn_relation_ids", "SELECT src, tgt, 'rel-' || md5(src || tgt) AS id, 'rel-' || md5(tgt || src) AS reverse_id, src || '<SEP>' || tgt AS key FROM edges", "edges")
def fn_relation_ids(spark, d):
    from tessera.functions.ids import pair_key, relation_ids

    e = KG(spark, d).cte("edges")
    ids = relation_ids("tgt", "src")
    return e.select("src", "tgt", ids[0].alias("id"), ids[1].alias("reverse_id"), pair_key("tgt", "src").alias("key"))


@query("fn_content_id", "SELECT doc_id, 'doc-' || md5(text) AS id FROM documents")
def fn_content_id(spark, d):
    return KG(spark, d).table("documents").select("doc_id", content_id("text", "doc-").alias("id"))
