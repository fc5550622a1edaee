"""Queries over text functions, chunking, vectors, ranking, retrieval, versions and gates."""

from __future__ import annotations

import re

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.functions import ids, text
from tessera.operators import aggregates, chunking, gates, lookups, mutations, ranking, vectors, versions
from tessera.plans.registry import KG, query


@query("fn_summary", "SELECT doc_id, CASE WHEN length(t) > 250 THEN left(t, 250) || '...' ELSE t END AS summary FROM (SELECT doc_id, trim(text, E' \\n\\t\\r') AS t FROM documents)")
def fn_summary(spark, d):
    return KG(spark, d).table("documents").select("doc_id", text.summary("text").alias("summary"))


@query("fn_tokens", "SELECT doc_id, array_to_string(list_filter(regexp_extract_all(lower(text), '[a-z0-9]+'), lambda x: length(x) > 1 AND x NOT IN ('" + "', '".join(text.STOPWORDS) + "')), ' ') AS tokens FROM documents")
def fn_tokens(spark, d):
    return KG(spark, d).table("documents").select("doc_id", F.array_join(text.tokens("text"), " ").alias("tokens"))


@query("fn_capped_name", "SELECT doc_id, left(text, 256) AS name FROM documents")
def fn_capped_name(spark, d):
    return KG(spark, d).table("documents").select("doc_id", text.capped("text").alias("name"))


@query("fn_file_path", "SELECT id, coalesce(nullif(trim(file_path), ''), 'unknown_source') AS file_path FROM docs", "docs")
def fn_file_path(spark, d):
    return KG(spark, d).cte("docs").select("id", text.file_path("file_path").alias("file_path"))


@query("fn_times", "SELECT o_orderkey AS id, strftime(to_timestamp(o_orderkey * 86400)::TIMESTAMP, '%Y-%m-%d %H:%M:%S') AS epoch, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS iso FROM orders")
def fn_times(spark, d):
    return KG(spark, d).table("orders").select(F.col("o_orderkey").alias("id"), text.epoch_text(F.col("o_orderkey") * 86400).alias("epoch"), text.iso_text("o_orderdate").alias("iso"))


@query("fn_cache_keys", "SELECT o_orderkey AS id, 'mix:query:' || md5(o_orderpriority) AS key, 'mix' AS mode, 'query' AS cache_type, md5(o_orderpriority) AS hash FROM orders")
def fn_cache_keys(spark, d):
    o = KG(spark, d).table("orders").select(F.col("o_orderkey").alias("id"), ids.cache_key(F.lit("mix"), F.lit("query"), F.md5("o_orderpriority")).alias("key"))
    return o.select("id", "key", ids.cache_parts("key").alias("p")).select("id", "key", "p.*")


@query("fn_urn", "SELECT p_partkey AS id, 'urn:pfss:global:domain:' || trim(regexp_replace(lower(p_brand), '[^a-z0-9]+', '-', 'g'), '-') || ':' || trim(regexp_replace(lower(p_type), '[^a-z0-9]+', '-', 'g'), '-') || ':' || trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '-') || ':default' AS urn FROM part")
def fn_urn(spark, d):
    none = F.lit(None).cast("string")
    return KG(spark, d).table("part").select(F.col("p_partkey").alias("id"), text.object_urn(none, none, "p_brand", "p_type", "p_name", none).alias("urn"))


@query("fn_group_key", "SELECT p_partkey AS id, lower(p_brand) || '|' || lower(p_type) || '|' AS key FROM part")
def fn_group_key(spark, d):
    return KG(spark, d).table("part").select(F.col("p_partkey").alias("id"), text.group_key("p_brand", "p_type", F.lit(None).cast("string")).alias("key"))


@query("fn_is_float", "SELECT DISTINCT w AS word, regexp_full_match(w, '[-+]?[0-9]*\\.?[0-9]+') AS is_float FROM (SELECT unnest(string_split(text, ' ')) AS w FROM documents)")
def fn_is_float(spark, d):
    w = KG(spark, d).table("documents").select(F.explode(F.split("text", " ")).alias("word")).distinct()
    return w.select("word", text.is_float("word").alias("is_float"))


@query("fn_version_intent", "SELECT item_id, CASE WHEN contains(t, 'as of') THEN 'AS_OF_TIME' WHEN contains(t, 'compare') THEN 'COMPARE' WHEN contains(t, 'previous') THEN 'HISTORICAL' WHEN contains(t, 'latest') THEN 'CURRENT' ELSE 'UNSPECIFIED' END AS intent FROM (SELECT item_id, lower(CASE item_id % 5 WHEN 0 THEN 'Compare ' WHEN 1 THEN 'the LATEST ' WHEN 2 THEN 'previous as of ' WHEN 3 THEN 'previous ' ELSE '' END || text) AS t FROM benchmark)")
def fn_version_intent(spark, d):
    b = KG(spark, d).table("benchmark")
    lead = F.expr("CASE item_id % 5 WHEN 0 THEN 'Compare ' WHEN 1 THEN 'the LATEST ' WHEN 2 THEN 'previous as of ' WHEN 3 THEN 'previous ' ELSE '' END")
    return b.select("item_id", text.version_intent(F.concat(lead, "text")).alias("intent"))


@query("fn_split_markers", "SELECT p_partkey AS id, array_to_string(list_filter(list_transform(regexp_split_to_array(p_type, ' |#'), lambda x: trim(x)), lambda x: x <> ''), '|') AS parts FROM part")
def fn_split_markers(spark, d):
    return KG(spark, d).table("part").select(F.col("p_partkey").alias("id"), F.array_join(text.split_on("p_type", [" ", "#"]), "|").alias("parts"))


@query("fn_think_tags", "SELECT o_orderkey AS id, o_orderpriority AS answer FROM orders")
def fn_think_tags(spark, d):
    o = KG(spark, d).table("orders")
    noisy = F.concat(F.lit("lost thought</think> <think>a\nb</think>"), "o_orderpriority", F.lit("<think>more</think> "))
    return o.select(F.col("o_orderkey").alias("id"), text.without_thinking(noisy).alias("answer"))


@query("fn_delimiters", "SELECT o_orderkey AS id, 'entity<|#|>' || o_orderpriority || '<|#|>x' AS record FROM orders")
def fn_delimiters(spark, d):
    o = KG(spark, d).table("orders")
    forms = ["<|##|>", r"<|\#|>", "<||>", "<X|#|>", "<#>", "<|#X>", "<||#>"]
    bad = F.element_at(F.array(*map(F.lit, forms)), (F.col("o_orderkey") % len(forms) + 1).cast("int"))
    return o.select(F.col("o_orderkey").alias("id"), text.repair_delimiters(F.concat(F.lit("entity"), bad, "o_orderpriority", F.lit("<|#|>x"))).alias("record"))


@query("fn_normalize_name", "SELECT p_partkey AS id, p_name AS name FROM part")
def fn_normalize_name(spark, d):
    return KG(spark, d).table("part").select(F.col("p_partkey").alias("id"), text.normalize_name(F.concat(F.lit('<p>"'), "p_name", F.lit('"</p>'))).alias("name"))


CHUNK_SQL = """w AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '') AS t FROM documents),
    c AS (SELECT doc_id, t, unnest(range(0, len(t), {step})) AS s FROM w)"""


@query(
    "txt_windows",
    "WITH " + CHUNK_SQL.format(step=90) + """ SELECT doc_id, CAST(s // 90 AS INTEGER) AS chunk_order_index, CAST(least(100, len(t) - s) AS INTEGER) AS tokens, md5(array_to_string(list_slice(t, s + 1, s + 100), ' ')) AS content_md5 FROM c""",
)
def txt_windows(spark, d):
    docs = KG(spark, d).table("documents").select("doc_id", "text")
    return chunking.windows(docs, chunking.words("text"), 100, 10).select("doc_id", "chunk_order_index", "tokens", F.md5("content").alias("content_md5"))


@query(
    "txt_rerank_windows",
    "WITH " + CHUNK_SQL.format(step=90) + """ SELECT doc_id, CAST(s // 90 AS INTEGER) AS chunk_order_index, CAST(least(100, len(t) - s) AS INTEGER) AS tokens FROM c WHERE s = 0 OR s - 90 + 100 < len(t)""",
)
def txt_rerank_windows(spark, d):
    docs = KG(spark, d).table("documents").select("doc_id", "text")
    return chunking.rerank_windows(docs, chunking.words("text"), 100, 10).select("doc_id", "chunk_order_index", "tokens")


@query(
    "txt_chunk_ids",
    "WITH " + CHUNK_SQL.format(step=50) + """, k AS (SELECT doc_id, 'chunk-' || md5(array_to_string(list_slice(t, s + 1, s + 50), ' ')) AS chunk_id, s // 50 AS i FROM c)
        SELECT doc_id, chunk_id, CAST(max(i) AS INTEGER) AS chunk_order_index FROM k GROUP BY ALL""",
)
def txt_chunk_ids(spark, d):
    docs = KG(spark, d).table("documents").select("doc_id", "text")
    return chunking.with_chunk_ids(chunking.windows(docs, chunking.words("text"), 50, 0)).select("doc_id", "chunk_id", "chunk_order_index")


@query(
    "txt_split_windows",
    """WITH p AS (SELECT doc_id, unnest(string_split(text, E'\\n')) AS x, generate_subscripts(string_split(text, E'\\n'), 1) - 1 AS part FROM documents), w AS (SELECT doc_id, part, list_filter(regexp_split_to_array(x, '\\s+'), lambda y: y <> '') AS t FROM p),
        c AS (SELECT doc_id, part, t, unnest(range(0, len(t), 35)) AS s FROM w) SELECT doc_id, CAST(part AS INTEGER) AS part, CAST(s // 35 AS INTEGER) AS chunk_order_index, CAST(least(40, len(t) - s) AS INTEGER) AS tokens FROM c""",
)
def txt_split_windows(spark, d):
    docs = KG(spark, d).table("documents").select("doc_id", "text")
    return chunking.split_windows(docs, "text", "\n", 40, 5).select("doc_id", "part", "chunk_order_index", "tokens")


@query(
    "txt_blocks",
    """WITH l AS (SELECT doc_id, unnest(string_split(text, E'\\n')) AS line, generate_subscripts(string_split(text, E'\\n'), 1) AS i FROM documents),
        b AS (SELECT *, sum(CASE WHEN length(line) < 60 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS block FROM l)
        SELECT doc_id, CAST(block AS BIGINT) AS block, arg_min(line, i) AS title, count(*) AS n_lines FROM b WHERE block > 0 GROUP BY doc_id, block""",
)
def txt_blocks(spark, d):
    docs = KG(spark, d).table("documents").select("doc_id", "text")
    return chunking.text_blocks(docs, "text", F.char_length("line") < 60, "doc_id")


ANSWERS = """SELECT l_orderkey AS chunk_id, string_agg(r, E'\\n' ORDER BY l_linenumber, l_partkey, l_suppkey) || E'\\n<|COMPLETE|>\\njunk' AS answer FROM (
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'entity<|#|>Part ' || l_partkey || '<|#|>Thing, Other<|#|>about ' || l_partkey || E'\\nrelation<|#|>Part ' || l_partkey || '<|#|>Supp ' || l_suppkey || '<|#|>' || l_returnflag || '<|#|>sold<|#|>' || CAST(l_quantity AS INTEGER) AS r
    FROM lineitem) GROUP BY l_orderkey"""


def _answers(spark, d):
    li = KG(spark, d).table("lineitem")
    key, supp = F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")
    two = F.concat(
        F.lit("entity<|#|>Part "), key, F.lit("<|#|>Thing, Other<|#|>about "), key, F.lit("\nrelation<|##|>Part "), key, F.lit("<#>Supp "), supp, F.lit("<|#|>"),
        "l_returnflag", F.lit("<|#|>sold<|#|>"), F.col("l_quantity").cast("int").cast("string"),
    )
    rows = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", two.alias("r"))))
    joined = li.groupBy(F.col("l_orderkey").alias("chunk_id")).agg(rows.alias("rows"))
    return joined.select("chunk_id", F.concat(F.array_join(F.transform("rows", lambda x: x["r"]), "\n"), F.lit("\n<|COMPLETE|>\njunk")).alias("answer"))


@query("txt_entity_records", "SELECT l_orderkey AS chunk_id, 'Part ' || l_partkey AS name, 'thing' AS entity_type, 'about ' || l_partkey AS description, count(*) AS n FROM lineitem GROUP BY ALL")
def txt_entity_records(spark, d):
    rows = chunking.entity_records(chunking.extraction_records(_answers(spark, d), kind="entity"))
    return rows.groupBy("chunk_id", "name", "entity_type", "description").agg(F.count(F.lit(1)).alias("n"))


@query("txt_relation_records", "SELECT l_orderkey AS chunk_id, 'Part ' || l_partkey AS src, 'Supp ' || l_suppkey AS tgt, l_returnflag AS keywords, sum(CAST(CAST(l_quantity AS INTEGER) AS DOUBLE)) AS weight FROM lineitem GROUP BY ALL")
def txt_relation_records(spark, d):
    rows = chunking.relation_records(chunking.extraction_records(_answers(spark, d), kind="relation"))
    return rows.groupBy("chunk_id", "src", "tgt", "keywords").agg(F.sum("weight").alias("weight"))


VEC_SQL = """s AS (SELECT q.vec_id AS query_id, v.vec_id AS id, list_cosine_similarity(q.embedding::DOUBLE[], v.embedding::DOUBLE[]) AS similarity FROM embeddings q JOIN embeddings v ON true WHERE q.vec_id % 50 = 0)"""


@query("vec_search", f"WITH {VEC_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, id) AS rank FROM s WHERE similarity >= 0.2) SELECT query_id, id, round(similarity, 6) AS similarity, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 20")
def vec_search(spark, d):
    e = KG(spark, d).table("embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    found = vectors.search(e, e.where("id % 50 = 0").withColumnRenamed("id", "query_id"), 20)
    return found.withColumn("similarity", F.round("similarity", 6))


@query("vec_among", f"WITH {VEC_SQL} SELECT id, round(similarity, 6) AS similarity FROM s WHERE query_id = 0 AND id % 7 = 1 ORDER BY s.similarity DESC, id LIMIT 15")
def vec_among(spark, d):
    e = KG(spark, d).table("embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    q = e.where("id = 0").first()["vector"]
    return vectors.among(e, e.where("id % 7 = 1").select("id"), q, 15).withColumn("similarity", F.round("similarity", 6))


@query("vec_among_missing", "SELECT vec_id AS id, 0.0::DOUBLE AS similarity FROM embeddings WHERE false")
def vec_among_missing(spark, d):
    e = KG(spark, d).table("embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return vectors.among(e, e.select("id").unionByName(spark.createDataFrame([(10**9,)], "id long")), [1.0] * 64, 15)


@query("vec_delete_relations", "SELECT src, tgt FROM edges WHERE src <> 'part-7' AND tgt <> 'part-7'", "edges")
def vec_delete_relations(spark, d):
    e = KG(spark, d).cte("edges").withColumnsRenamed({"src": "src_id", "tgt": "tgt_id"})
    return vectors.without_relations_of(e, "part-7").select(F.col("src_id").alias("src"), F.col("tgt_id").alias("tgt"))


@query("win_token_budget", "WITH r AS (SELECT o_custkey, o_orderkey, sum(1 + o_orderkey % 400) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING) AS running FROM orders) SELECT o_custkey, o_orderkey, CAST(running AS BIGINT) AS running FROM r WHERE running <= 1000")
def win_token_budget(spark, d):
    o = KG(spark, d).table("orders").select("o_custkey", "o_orderkey", (1 + F.col("o_orderkey") % 400).alias("tokens"))
    return ranking.token_budget(o, 1000, "tokens", "o_orderkey", ["o_custkey"]).select("o_custkey", "o_orderkey", "running")


INTERLEAVE_SQL = """s AS (SELECT p_partkey AS k, row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) AS pos, 0 AS src FROM part QUALIFY pos <= 60
    UNION ALL SELECT p_partkey, row_number() OVER (ORDER BY p_size DESC, p_partkey), 1 FROM part QUALIFY row_number() OVER (ORDER BY p_size DESC, p_partkey) <= 60
    UNION ALL SELECT p_partkey, row_number() OVER (ORDER BY p_name, p_partkey), 2 FROM part QUALIFY row_number() OVER (ORDER BY p_name, p_partkey) <= 60),
    o AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY pos, src) AS n FROM s)"""


def _ranked_parts(spark, d):
    p = KG(spark, d).table("part")
    out = []
    for order in ([F.desc("p_retailprice")], [F.desc("p_size")], [F.asc("p_name")]):
        top = p.orderBy(*order, "p_partkey").limit(60)
        out.append(top.select(F.col("p_partkey").alias("k"), F.row_number().over(Window.orderBy(*order, "p_partkey")).cast("long").alias("pos")))
    return out


@query("win_interleave_two", f"WITH {INTERLEAVE_SQL.replace('UNION ALL SELECT p_partkey, row_number() OVER (ORDER BY p_name, p_partkey), 2 FROM part QUALIFY row_number() OVER (ORDER BY p_name, p_partkey) <= 60', '')} SELECT k, row_number() OVER (ORDER BY pos, src) AS turn FROM o WHERE n = 1")
def win_interleave_two(spark, d):
    return ranking.interleave(_ranked_parts(spark, d)[:2], "k").select("k", F.col("turn").cast("long").alias("turn"))


@query("win_interleave_three", f"WITH {INTERLEAVE_SQL} SELECT k, row_number() OVER (ORDER BY pos, src) AS turn FROM o WHERE n = 1")
def win_interleave_three(spark, d):
    return ranking.interleave(_ranked_parts(spark, d), "k").select("k", F.col("turn").cast("long").alias("turn"))


@query("win_polled_quota", "WITH p AS (SELECT p_partkey AS k, row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) - 1 AS r FROM part QUALIFY r < 40), s AS (SELECT k, 10.0::DOUBLE - r * (9.0::DOUBLE / 39) AS x FROM p) SELECT k, CAST(round_even(x, 0) AS INTEGER) AS quota FROM s")
def win_polled_quota(spark, d):
    top = KG(spark, d).table("part").orderBy(F.desc("p_retailprice"), "p_partkey").limit(40)
    pos = F.row_number().over(Window.orderBy(F.desc("p_retailprice"), "p_partkey"))
    return ranking.polled_quota(top.select(F.col("p_partkey").alias("k"), pos.alias("pos")), 10, 1).select("k", "quota")


LIST_SQL = "x AS (SELECT o_custkey AS id, list('c' || (o_orderkey % 13) ORDER BY o_orderkey) AS a, list('c' || (o_orderkey % 11) ORDER BY o_orderkey DESC) AS b FROM orders GROUP BY 1)"


def _lists(spark, d):
    o = KG(spark, d).table("orders")
    name = lambda m: F.concat(F.lit("c"), (F.col("o_orderkey") % m).cast("string"))
    in_order = lambda m: F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", name(m).alias("v")))), lambda x: x["v"])
    return o.groupBy(F.col("o_custkey").alias("id")).agg(in_order(13).alias("a"), F.reverse(in_order(11)).alias("b"))


@query("win_limit_ids", f"WITH {LIST_SQL} SELECT id, array_to_string(list_slice(a, greatest(len(a) - 3, 1), len(a)), ',') AS fifo, array_to_string(list_slice(a, 1, 4), ',') AS kept, '' AS none FROM x")
def win_limit_ids(spark, d):
    x = _lists(spark, d)
    join = lambda c: F.array_join(c, ",")
    return x.select("id", join(ranking.limit_ids(F.col("a"), 4)).alias("fifo"), join(ranking.limit_ids(F.col("a"), 4, "KEEP")).alias("kept"), join(ranking.limit_ids(F.col("a"), 0)).alias("none"))


@query("set_subtract", f"WITH {LIST_SQL} SELECT id, array_to_string(list_filter(a, lambda v: NOT list_contains(b, v)), ',') AS kept FROM x")
def set_subtract(spark, d):
    return _lists(spark, d).select("id", F.array_join(ranking.subtract_ids(F.col("a"), F.col("b")), ",").alias("kept"))


@query("set_recall", f"WITH {LIST_SQL} SELECT id, round(len(list_intersect(list_distinct(a), b))::DOUBLE / len(list_distinct(a)), 6) AS recall FROM x")
def set_recall(spark, d):
    return _lists(spark, d).select("id", F.round(aggregates.set_recall(F.col("a"), F.col("b")), 6).alias("recall"))


@query("agg_idf", "WITH t AS (SELECT DISTINCT doc_id, unnest(list_filter(regexp_extract_all(lower(text), '[a-z0-9]+'), lambda x: length(x) > 1 AND x NOT IN ('" + "', '".join(text.STOPWORDS) + "'))) AS token FROM documents), n AS (SELECT count(*) AS n FROM documents) SELECT token, round(ln((n + 1.0) / (count(*) + 1)) + 1, 6) AS idf FROM t, n GROUP BY token, n")
def agg_idf(spark, d):
    docs = KG(spark, d).table("documents")
    tokens = docs.select(F.col("doc_id").alias("doc"), F.explode(text.tokens("text")).alias("token"))
    return aggregates.document_frequencies(tokens, docs.count()).withColumn("idf", F.round("idf", 6))


CANDIDATES = """SELECT l_orderkey * 10 + l_linenumber AS candidate_id, CASE l_linenumber WHEN 1 THEN 'RAW_TEXT' WHEN 2 THEN 'PFSS_ENTITY' WHEN 3 THEN 'PFSS_RELATION' WHEN 4 THEN 'PFSS_PATH' WHEN 5 THEN 'GENERIC_GRAPH' WHEN 6 THEN 'ISSUE_SIDECAR' ELSE 'VERSION_CONTEXT' END AS channel,
    l_extendedprice AS raw_score, CASE WHEN l_linenumber = 5 THEN 0.25E0 ELSE 1.0E0 END AS factual_weight, 'key-' || l_partkey AS dedup_key, 'D' || (l_suppkey % 5) AS domain_code, 'F' || (l_suppkey % 7) AS feature_key,
    CASE WHEN l_returnflag = 'A' THEN 'CONFLICT' ELSE 'CURRENT' END AS version_status, l_linestatus = 'F' AS has_evidence, l_returnflag = 'R' AS factual_path
    FROM (SELECT l_orderkey, l_linenumber, r.l_partkey, r.l_suppkey, r.l_extendedprice, r.l_returnflag, r.l_linestatus
        FROM (SELECT l_orderkey, l_linenumber, min(struct_pack(l_partkey := l_partkey, l_suppkey := l_suppkey, l_extendedprice := l_extendedprice, l_returnflag := l_returnflag, l_linestatus := l_linestatus)) AS r
            FROM lineitem GROUP BY l_orderkey, l_linenumber))"""
NORMAL_SQL = f"""c AS ({CANDIDATES}), n AS (SELECT *, row_number() OVER (PARTITION BY channel ORDER BY raw_score DESC, candidate_id) AS channel_rank,
    CASE WHEN max(raw_score) OVER w = min(raw_score) OVER w THEN 1.0 ELSE (raw_score - min(raw_score) OVER w) / (max(raw_score) OVER w - min(raw_score) OVER w) END AS normalized_score FROM c WINDOW w AS (PARTITION BY channel))"""


def _candidates(spark, d):
    KG(spark, d).table("lineitem").createOrReplaceTempView("lineitem")
    return spark.sql(re.sub(r"struct_pack\((.*?)\)\)", lambda m: f"struct({re.sub(r'\w+ := ', '', m[1])}))", CANDIDATES))


@query("win_channel_rank", f"WITH {NORMAL_SQL} SELECT candidate_id, CAST(channel_rank AS INTEGER) AS channel_rank, round(normalized_score, 6) AS normalized_score FROM n")
def win_channel_rank(spark, d):
    return ranking.normalize_channels(_candidates(spark, d)).select("candidate_id", "channel_rank", F.round("normalized_score", 6).alias("normalized_score"))


PRIORITY_SQL = "CASE channel " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in ranking.CHANNEL_PRIORITY.items()) + " ELSE 99 END"


@query("win_dedup_winner", f"WITH {NORMAL_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY dedup_key ORDER BY {PRIORITY_SQL}, normalized_score DESC, candidate_id) AS k FROM n) SELECT dedup_key, candidate_id, channel FROM r WHERE k = 1")
def win_dedup_winner(spark, d):
    return ranking.deduplicate_channels(ranking.scale_channels(_candidates(spark, d))).select("dedup_key", "candidate_id", "channel")


WEIGHT_SQL = "CASE channel " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in ranking.CHANNEL_WEIGHTS.items()) + " ELSE 0.1 END::DOUBLE"


@query(
    "qry_fusion",
    f"""WITH {NORMAL_SQL} SELECT candidate_id, round({WEIGHT_SQL} * CASE WHEN channel IN ('ISSUE_SIDECAR', 'VERSION_CONTEXT') THEN 0.0 ELSE factual_weight END * (1.0E0 / (60.0E0 + channel_rank))
        + CASE WHEN domain_code = 'D1' THEN 0.002 ELSE 0 END::DOUBLE + CASE WHEN feature_key IN ('F2', 'F3') THEN 0.002 ELSE 0 END::DOUBLE - CASE WHEN version_status = 'CONFLICT' THEN 0.003 ELSE 0 END::DOUBLE
        - CASE WHEN NOT has_evidence AND channel LIKE 'PFSS%' THEN 0.004 ELSE 0 END::DOUBLE, 9) AS fused_score FROM n""",
)
def qry_fusion(spark, d):
    fused = ranking.fuse(ranking.normalize_channels(_candidates(spark, d)), ["D1"], ["F2", "F3"])
    return fused.select("candidate_id", "fused_score")


@query("qry_fallback", f"WITH c AS ({CANDIDATES}), s AS (SELECT bool_or(channel = 'RAW_TEXT') AS raw, bool_or(channel LIKE 'PFSS%') AS trusted, bool_or(version_status = 'CONFLICT') AS warned, count(*) AS n FROM c) SELECT CASE WHEN trusted AND warned THEN 'PFSS_WITH_VERSION_WARNING' ELSE 'HYBRID_EVIDENCE_READY' END AS status, n FROM s")
def qry_fallback(spark, d):
    return ranking.fallback(_candidates(spark, d))


@query("flt_channel_generic", f"WITH c AS ({CANDIDATES}) SELECT candidate_id, least(factual_weight, 0.2E0) AS factual_weight, 'T4' AS trust_tier FROM c WHERE channel = 'GENERIC_GRAPH'")
def flt_channel_generic(spark, d):
    c = _candidates(spark, d).withColumn("deleted", F.lit(False)).withColumn("active", F.lit(True)).withColumn("text", F.lit("t"))
    return lookups.channel(c, "GENERIC_GRAPH").select("candidate_id", "factual_weight", "trust_tier")


@query(
    "qry_lexical_ranker",
    "WITH stop AS (SELECT unnest(['" + "', '".join(text.STOPWORDS) + """']) AS s), d AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS token FROM documents),
        t AS (SELECT doc_id, token, count(*) AS tf FROM d WHERE length(token) > 1 AND token NOT IN (SELECT s FROM stop) GROUP BY ALL), n AS (SELECT count(*) AS n FROM documents),
        i AS (SELECT token, ln((n + 1.0) / (count(*) + 1)) + 1 AS idf FROM t, n GROUP BY token, n), q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS token FROM benchmark),
        s AS (SELECT item_id, doc_id, round(sum((1 + ln(tf)) * idf), 4) AS score FROM q JOIN t USING (token) JOIN i USING (token) GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s)
        SELECT item_id, doc_id, score, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 5""",
)
def qry_lexical_ranker(spark, d):
    from tessera.plans.retrieval import lexical_ranking

    kg = KG(spark, d)
    docs = kg.table("documents").select(F.col("doc_id").alias("doc"), "text")
    found = lexical_ranking(docs, kg.table("benchmark").select("item_id", "text"), "item_id", 5, decimals=4)
    return found.select("item_id", F.col("doc").alias("doc_id"), "score", "rank")


VERSIONS = """SELECT o_custkey AS version_group_key, o_orderkey AS version_member_id, CASE o_orderkey % 6 WHEN 0 THEN 'CURRENT' WHEN 1 THEN 'HISTORICAL' WHEN 2 THEN 'SUPERSEDED' ELSE 'UNKNOWN' END AS version_status,
    o_orderkey % 8 = 0 AS latest_flag, CAST(o_orderdate AS VARCHAR(30)) AS valid_from, CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderdate + INTERVAL 300 DAY AS VARCHAR(30)) END AS valid_to, CAST(NULL AS BIGINT) AS supersedes_member_id,
    'CONFIRMED' AS review_decision, o_orderkey % 9 <> 0 AS active, false AS deleted, o_orderkey % 31 <> 0 AS has_evidence, CASE WHEN o_orderkey % 23 = 0 THEN 1 ELSE 0 END AS n_issues,
    o_orderkey % 100 / 100.0E0 AS semantic_relevance_score, o_orderkey % 10 / 10.0E0 AS evidence_quality_score, false AS document_deleted FROM orders"""
RESOLVE_SQL = """g AS (SELECT version_group_key, count(*) FILTER (WHERE active) AS n, count(*) FILTER (WHERE active AND NOT has_evidence) AS bare, count(*) FILTER (WHERE active AND n_issues > 0) AS issues,
    count(*) FILTER (WHERE active AND version_status = 'CURRENT') AS nc, min(version_member_id) FILTER (WHERE active AND version_status = 'CURRENT') AS c, count(*) FILTER (WHERE active AND latest_flag) AS nl, min(version_member_id) FILTER (WHERE active AND latest_flag) AS l FROM v GROUP BY 1),
    r AS (SELECT version_group_key, CASE WHEN n = 0 OR bare > 0 THEN 'NO_CONFIRMED_CURRENT' WHEN issues > 0 THEN 'VERSION_REVIEW_REQUIRED' WHEN nc > 1 THEN 'MULTIPLE_CURRENT_CONFLICT' WHEN nc = 1 THEN 'CONFIRMED_CURRENT' WHEN nl > 1 THEN 'MULTIPLE_LATEST_CONFLICT' WHEN nl = 1 THEN 'CONFIRMED_CURRENT' ELSE 'NO_CONFIRMED_CURRENT' END AS resolution,
        CASE WHEN n > 0 AND bare = 0 AND issues = 0 AND nc = 1 THEN c WHEN n > 0 AND bare = 0 AND issues = 0 AND nc = 0 AND nl = 1 THEN l END AS current_member FROM g)"""


def _versions(spark, d):
    KG(spark, d).table("orders").createOrReplaceTempView("orders")
    return spark.sql(VERSIONS.replace("INTERVAL 300 DAY", "INTERVAL 300 DAYS"))


@query("qry_current_version", f"WITH v AS ({VERSIONS}), {RESOLVE_SQL} SELECT version_group_key, resolution, current_member FROM r")
def qry_current_version(spark, d):
    return versions.resolve_current(_versions(spark, d))


@query("qry_as_of_version", f"WITH v AS ({VERSIONS}), g AS (SELECT version_group_key, count(*) FILTER (WHERE h) AS n, min(version_member_id) FILTER (WHERE h) AS m, bool_and(has_evidence OR NOT h) AS ok FROM (SELECT *, active AND valid_from <= '1996-06-01 00:00:00' AND (valid_to IS NULL OR '1996-06-01 00:00:00' < valid_to) AS h FROM v) GROUP BY 1) SELECT version_group_key, CASE WHEN n > 1 THEN 'VALID_TIME_OVERLAP' WHEN n = 1 AND ok THEN 'AS_OF_MATCH' ELSE 'AS_OF_NO_MATCH' END AS resolution, CASE WHEN n = 1 AND ok THEN m END AS member FROM g")
def qry_as_of_version(spark, d):
    return versions.resolve_as_of(_versions(spark, d), "1996-06-01 00:00:00")


@query(
    "qry_version_rank",
    f"""WITH v AS ({VERSIONS}), {RESOLVE_SQL}, s AS (SELECT v.version_group_key, version_member_id, round(semantic_relevance_score + evidence_quality_score + CASE WHEN active THEN 0.5 ELSE 0 END
        + CASE version_status WHEN 'CURRENT' THEN 2.0 WHEN 'UNKNOWN' THEN -0.2 ELSE 0.2 END + CASE WHEN latest_flag THEN 1.5 ELSE 0 END + CASE WHEN current_member = version_member_id THEN 3.0 ELSE 0 END - CASE WHEN version_status IN ('HISTORICAL', 'SUPERSEDED') THEN 0.75 ELSE 0 END
        - CASE WHEN NOT has_evidence THEN 2.0 ELSE 0 END - CASE WHEN n_issues > 0 THEN 1.5 ELSE 0 END - CASE WHEN version_status = 'UNKNOWN' THEN 0.75 ELSE 0 END, 6) AS score FROM v LEFT JOIN r ON r.version_group_key = v.version_group_key),
        k AS (SELECT *, row_number() OVER (PARTITION BY version_group_key ORDER BY score DESC, version_member_id) AS place FROM s) SELECT version_group_key, version_member_id, score FROM k WHERE place = 1""",
)
def qry_version_rank(spark, d):
    v = _versions(spark, d)
    ranked = versions.rank(v, "CURRENT", versions.resolve_current(v))
    return versions.select_by_intent(ranked, "CURRENT").select("version_group_key", "version_member_id", "score")


@query("mut_clean_query_cache", "SELECT key FROM (SELECT CASE o_orderkey % 3 WHEN 0 THEN 'default' WHEN 1 THEN 'mix' ELSE 'local' END || ':' || CASE o_orderkey % 4 WHEN 0 THEN 'query' WHEN 1 THEN 'keywords' ELSE 'extract' END || ':' || o_orderkey AS key FROM orders) WHERE key LIKE 'default%' OR (key NOT LIKE '%:query:%' AND key NOT LIKE '%:keywords:%')")
def mut_clean_query_cache(spark, d):
    o = KG(spark, d).table("orders").selectExpr("CASE o_orderkey % 3 WHEN 0 THEN 'default' WHEN 1 THEN 'mix' ELSE 'local' END || ':' || CASE o_orderkey % 4 WHEN 0 THEN 'query' WHEN 1 THEN 'keywords' ELSE 'extract' END || ':' || o_orderkey AS key")
    return mutations.clean_query_cache(o)


@query("agg_cache_counts", "SELECT mode, kind AS cache_type, count(*) AS n FROM (SELECT CASE o_orderkey % 3 WHEN 0 THEN 'default' WHEN 1 THEN 'mix' ELSE 'local' END AS mode, CASE o_orderkey % 4 WHEN 0 THEN 'query' WHEN 1 THEN 'keywords' ELSE 'extract' END AS kind FROM orders) GROUP BY ALL")
def agg_cache_counts(spark, d):
    o = KG(spark, d).table("orders").selectExpr("CASE o_orderkey % 3 WHEN 0 THEN 'default' WHEN 1 THEN 'mix' ELSE 'local' END || ':' || CASE o_orderkey % 4 WHEN 0 THEN 'query' WHEN 1 THEN 'keywords' ELSE 'extract' END || ':' || o_orderkey AS key")
    p = o.select(ids.cache_parts("key").alias("p")).select("p.mode", "p.cache_type")
    return p.groupBy("mode", "cache_type").agg(F.count(F.lit(1)).alias("n"))


@query("gate_term_identity", "SELECT c_mktsegment AS alias, count(DISTINCT c_nationkey % 3) AS n_identities FROM customer GROUP BY 1 HAVING count(DISTINCT c_nationkey % 3) > 1")
def gate_term_identity(spark, d):
    c = KG(spark, d).table("customer").select(F.col("c_mktsegment").alias("alias"), (F.col("c_nationkey") % 3).alias("identity"))
    return gates.term_identity(c)


@query("gate_citations", "SELECT count(*) AS n, count(*) FILTER (WHERE o_orderkey IS NULL) AS invalid, count(*) FILTER (WHERE l_returnflag = 'A') AS unsupported FROM lineitem LEFT JOIN (SELECT o_orderkey FROM orders WHERE o_orderkey % 13 <> 0) ON l_orderkey = o_orderkey")
def gate_citations(spark, d):
    kg = KG(spark, d)
    claims = kg.table("lineitem").select(F.col("l_orderkey").alias("evidence_id"), (F.col("l_returnflag") != "A").alias("supported"))
    return gates.citations(claims, kg.table("orders").where("o_orderkey % 13 <> 0").select(F.col("o_orderkey").alias("evidence_id")))


@query("gate_ab_comparison", "SELECT event_type AS module, round(avg(value) FILTER (WHERE user_id % 2 = 1) - avg(value) FILTER (WHERE user_id % 2 = 0), 6) AS delta, CASE WHEN avg(value) FILTER (WHERE user_id % 2 = 1) > avg(value) FILTER (WHERE user_id % 2 = 0) + 0.02 THEN 'IMPROVED' WHEN avg(value) FILTER (WHERE user_id % 2 = 1) < avg(value) FILTER (WHERE user_id % 2 = 0) - 0.02 THEN 'DEGRADED' ELSE 'SAME' END AS label FROM events GROUP BY 1")
def gate_ab_comparison(spark, d):
    e = KG(spark, d).table("events").select(F.col("event_type").alias("module"), F.when(F.col("user_id") % 2 == 1, "candidate").otherwise("baseline").alias("arm"), F.col("value").alias("score"))
    return gates.ab_comparison(e, 0.02).select("module", F.round("delta", 6).alias("delta"), "label")


@query("gate_counters", "SELECT count(*) FILTER (WHERE l_returnflag = 'A' AND l_linestatus = 'F') AS unsafe_promotions, count(*) FILTER (WHERE l_tax = 0) AS hard_judgements FROM lineitem")
def gate_counters(spark, d):
    li = KG(spark, d).table("lineitem")
    return gates.counters(li, unsafe_promotions=(F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F"), hard_judgements=F.col("l_tax") == 0)


@query("gate_coverage", "SELECT c_mktsegment AS grp, round(count(o_custkey)::DOUBLE / count(*), 6) AS ratio, CASE WHEN count(o_custkey) = count(*) THEN 'FULL' WHEN count(o_custkey) = 0 THEN 'NONE' ELSE 'PARTIAL' END AS label FROM customer LEFT JOIN (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'P') ON c_custkey = o_custkey GROUP BY 1")
def gate_coverage(spark, d):
    kg = KG(spark, d)
    wanted = kg.table("customer").select(F.col("c_mktsegment").alias("grp"), F.col("c_custkey").alias("object_id"))
    return gates.coverage(wanted, kg.table("orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("object_id")), "grp").withColumn("ratio", F.round("ratio", 6))
