"""Queries that write tables, files and streams and read them back, and retrieval over the driver's tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tessera.functions import text
from tessera.operators import chunking, vectors
from tessera.plans.registry import KG, query
from tessera.plans.retrieval import KnowledgeBase, QueryParam, retrieve
from tessera.sources import exchange, files
from tessera.sources.scratch import materialise, scratch_dir
from tessera.sources.tables import Store, flatten_cache


def _fresh(spark, name):
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _full_docs(spark, d):
    time = F.lit(1).cast("long")
    return KG(spark, d).table("documents").select(F.col("doc_id").cast("string").alias("id"), F.col("text").alias("content"), F.col("source").alias("file_path"), time.alias("create_time"), time.alias("update_time"))


@query("src_kv_round_trip", "SELECT CAST(doc_id AS VARCHAR) AS id, md5(text) AS hash FROM documents")
def src_kv_round_trip(spark, d):
    store = Store(spark, _fresh(spark, "kv"))
    store.commit("full_docs", _full_docs(spark, d).where("id % 2 = 0"))
    store.commit("full_docs", store.read("full_docs").unionByName(_full_docs(spark, d).where("id % 2 = 1")))
    return store.read("full_docs").select("id", F.md5(F.col("content").cast("binary")).alias("hash"))


@query("src_workspaces", "SELECT 'a' AS workspace, count(*) AS n FROM documents WHERE lang = 'en' UNION ALL SELECT 'b', count(*) FROM documents WHERE lang <> 'en' UNION ALL SELECT 'c', 0")
def src_workspaces(spark, d):
    docs = _full_docs(spark, d).join(KG(spark, d).table("documents").select(F.col("doc_id").cast("string").alias("id"), "lang"), "id")
    root = _fresh(spark, "spaces")
    stores = {w: Store(spark, root, w) for w in "abc"}
    stores["a"].commit("full_docs", docs.where("lang = 'en'"))
    stores["b"].commit("full_docs", docs.where("lang <> 'en'"))
    stores["c"].commit("full_docs", docs)
    stores["c"].drop("full_docs")
    out = [s.read("full_docs").agg(F.count(F.lit(1)).alias("n")).select(F.lit(w).alias("workspace"), "n") for w, s in stores.items()]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query("src_rollback", "SELECT count(*) AS n FROM documents WHERE doc_id % 3 = 0")
def src_rollback(spark, d):
    store = Store(spark, _fresh(spark, "kv"))
    first = store.commit("full_docs", _full_docs(spark, d).where("id % 3 = 0"))
    store.commit("full_docs", _full_docs(spark, d))
    return store.read("full_docs", first).agg(F.count(F.lit(1)).alias("n"))


@query("src_status_scan", "SELECT status, count(*) AS n FROM docs GROUP BY 1", "docs")
def src_status_scan(spark, d):
    store = Store(spark, _fresh(spark, "kv"))
    none = F.lit(None).cast("string")
    rows = KG(spark, d).cte("docs").select(
        "id", "status", F.col("content").alias("content_summary"), F.char_length("content").alias("content_length"), F.lit(0).alias("chunks_count"), F.array().cast("array<string>").alias("chunks_list"),
        F.col("created_at").cast("timestamp").alias("created_at"), F.col("updated_at").cast("timestamp").alias("updated_at"), "file_path", none.alias("track_id"), none.alias("error_msg"), F.create_map().cast("map<string,string>").alias("metadata"),
    )
    store.commit("doc_status", rows)
    return store.read("doc_status").groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query("src_vector_store", "SELECT vec_id AS id, len(embedding)::INTEGER AS n, round(list_sum(embedding::DOUBLE[]), 4) AS total FROM embeddings")
def src_vector_store(spark, d):
    store = Store(spark, _fresh(spark, "kv"))
    e = KG(spark, d).table("embeddings").select(F.col("vec_id").cast("string").alias("id"), F.lit("").alias("content"), F.lit("").alias("full_doc_id"), F.lit("").alias("file_path"), F.col("embedding").cast("array<float>").alias("vector"))
    store.commit("chunks", e)
    total = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return store.read("chunks").select(F.col("id").cast("long").alias("id"), F.size("vector").alias("n"), F.round(total, 4).alias("total"))


@query("src_graphml_round_trip", "SELECT src, tgt, CAST(n AS VARCHAR) AS n FROM edges", "edges")
def src_graphml_round_trip(spark, d):
    kg, at = KG(spark, d), _fresh(spark, "graphml")
    files.write_graphml(kg.cte("nodes"), kg.cte("edges").select("src", "tgt", "n"), at)
    return files.read_graphml(spark, at)[1].select("src", "tgt", F.col("properties")["n"].alias("n"))


@query("src_export_csv", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def src_export_csv(spark, d):
    at = _fresh(spark, "csv")
    files.export(KG(spark, d).table("customer").select("c_custkey", "c_name", "c_mktsegment"), at, "csv")
    return spark.read.option("header", True).schema("c_custkey long, c_name string, c_mktsegment string").csv(at)


@query("src_export_json", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def src_export_json(spark, d):
    at = _fresh(spark, "json")
    files.export(KG(spark, d).table("customer").select("c_custkey", "c_name", "c_mktsegment"), at, "json")
    return spark.read.schema("c_custkey long, c_name string, c_mktsegment string").json(at)


@query("src_export_markdown", "SELECT '| ' || n_nationkey || ' | ' || n_name || ' |' AS line FROM nation")
def src_export_markdown(spark, d):
    at = _fresh(spark, "md")
    files.export(KG(spark, d).table("nation").select("n_nationkey", "n_name"), at, "md")
    return spark.read.text(at).withColumnRenamed("value", "line")


def _graph(spark, d):
    kg = KG(spark, d)
    nodes = kg.cte("nodes").selectExpr("id", "entity_type", "name AS description", "array(id) AS source_ids")
    edges = kg.cte("edges").selectExpr("least(src, tgt) AS src", "greatest(src, tgt) AS tgt", "cast(weight AS double) AS weight", "array(src, tgt) AS source_ids")
    # two sections are made of edges, which are grouped once
    return exchange.graph_sections(nodes, materialise(edges, "edges"))


@query(
    "src_export_graph",
    """SELECT 'entities' AS section, id AS a, '' AS b, entity_type AS value FROM nodes UNION ALL SELECT 'relations', node, other, least(node, other) || '<SEP>' || greatest(node, other) FROM ends
        UNION ALL SELECT 'relationships', 'rel-' || md5(src || tgt), '', CAST(weight::DOUBLE AS VARCHAR) FROM edges""",
    "nodes", "ends",
)
def src_export_graph(spark, d):
    at = _fresh(spark, "sections")
    exchange.export_sections(_graph(spark, d), at, compression="gzip")
    read = lambda name: spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(f"{at}/{name}")
    part = lambda name, *c: read(name).select(F.lit(name).alias("section"), *[F.expr(e).alias(n) for n, e in zip(("a", "b", "value"), c)])
    out = part("entities", "entity_name", "''", "get_json_object(graph_data, '$.entity_type')").unionByName(part("relations", "src_entity", "tgt_entity", "source_id"))
    return out.unionByName(part("relationships", "relationship_id", "''", "get_json_object(data, '$.weight')"))


@query("src_export_sheets", "SELECT p_partkey::VARCHAR AS a, p_name AS b, p_type AS c FROM part")
def src_export_sheets(spark, d):
    at = _fresh(spark, "sheets")
    exchange.export_sections({"parts": KG(spark, d).table("part").select("p_partkey", "p_name", "p_type")}, at, "excel")
    cells = "Cell array<struct<Data:struct<_VALUE:string>>>"
    rows = spark.read.format("xml").option("rowTag", "Row").schema(cells).load(f"{at}/parts")
    return rows.select(*[F.col("Cell")[i]["Data"]["_VALUE"].alias(n) for i, n in enumerate("abc")]).where("a <> 'p_partkey'")


@query(
    "src_json_repaired",
    "SELECT c_custkey AS id, c_name || CASE WHEN c_custkey % 3 = 0 THEN '!' ELSE '' END AS name, c_mktsegment || CASE WHEN c_custkey % 3 = 0 THEN '!' ELSE '' END AS deep, (SELECT count(*) FROM customer WHERE c_custkey % 3 = 0) AS n_repaired FROM customer",
)
def src_json_repaired(spark, d):
    at = _fresh(spark, "json")
    bad = lambda c: F.when(F.col("c_custkey") % 3 == 0, F.concat(F.col(c).cast("binary"), F.lit(b"\xff!")).cast("string")).otherwise(F.col(c))
    rows = KG(spark, d).table("customer").select(F.col("c_custkey").alias("id"), bad("c_name").alias("name"), F.array(F.struct(bad("c_mktsegment").alias("s"))).alias("deep"))
    n = exchange.write_json(rows, at)
    back = exchange.load_json(spark, at, "id long, name string, deep array<struct<s:string>>")
    return back.select("id", "name", F.col("deep")[0]["s"].alias("deep"), F.lit(n).cast("long").alias("n_repaired"))


@query(
    "src_copy_cache",
    "SELECT 'default:' || CASE o_orderkey % 3 WHEN 0 THEN 'extract' ELSE 'summary' END || ':h' || o_orderkey AS id, o_comment AS answer FROM (SELECT DISTINCT o_orderkey, o_orderstatus AS o_comment FROM orders) WHERE o_orderkey % 3 < 2",
)
def src_copy_cache(spark, d):
    source, target = Store(spark, _fresh(spark, "kv")), Store(spark, _fresh(spark, "kv"))
    none, time = F.lit(None).cast("string"), F.lit(1).cast("long")
    kind = "CASE o_orderkey % 3 WHEN 0 THEN 'default:extract' WHEN 1 THEN 'default:summary' ELSE 'mix:query' END"
    orders = KG(spark, d).table("orders").select("o_orderkey", "o_orderstatus").distinct()
    rows = orders.select(F.expr(f"concat({kind}, ':h', o_orderkey)").alias("id"), F.col("o_orderstatus").alias("return"), none.alias("cache_type"), none.alias("chunk_id"), none.alias("original_prompt"), none.alias("queryparam"), time.alias("create_time"), time.alias("update_time"))
    source.commit("llm_response_cache", rows)
    exchange.copy_cache(source, target)
    return target.read("llm_response_cache").select("id", F.col("return").alias("answer"))


@query("src_directory", "SELECT c_custkey AS n, c_name AS text FROM customer")
def src_directory(spark, d):
    at = _fresh(spark, "texts")
    c = KG(spark, d).table("customer")
    c.select(F.concat_ws("\t", F.col("c_custkey").cast("string"), "c_name").alias("value")).write.text(at)
    lines = files.read_directory(spark, at).where("text is not null").select(F.explode(F.split("text", "\n")).alias("line")).where("line <> ''")
    parts = F.split("line", "\t")
    return lines.select(parts[0].cast("long").alias("n"), parts[1].alias("text"))


@query("src_cache_layout", "SELECT CASE o_orderkey % 2 WHEN 0 THEN 'mix' ELSE 'local' END || ':query:h' || o_orderkey AS id FROM orders")
def src_cache_layout(spark, d):
    o = KG(spark, d).table("orders").selectExpr("CASE o_orderkey % 2 WHEN 0 THEN 'mix' ELSE 'local' END AS mode", "concat('h', o_orderkey) AS hash", "o_custkey AS part")
    nested = o.groupBy("mode", "part").agg(F.map_from_entries(F.collect_list(F.struct("hash", F.struct(F.lit("query").alias("cache_type"), F.lit("x").alias("return"))))).alias("entries"))
    return flatten_cache(nested).select("id")


@query("str_enqueue", "WITH c AS (SELECT DISTINCT md5(o_orderpriority) AS h FROM orders) SELECT 'doc-' || h AS id, 'pending' AS status FROM c")
def str_enqueue(spark, d):
    from tessera.streaming.ingest import enqueue_stream

    source, store = _fresh(spark, "stream"), Store(spark, _fresh(spark, "kv"))
    schema = "pos long, text string, file_path string"
    KG(spark, d).table("orders").select(F.col("o_orderkey").cast("long").alias("pos"), F.col("o_orderpriority").alias("text"), F.lit("f").alias("file_path")).write.parquet(source)
    enqueue_stream(spark, source, schema, store, _fresh(spark, "checkpoint")).awaitTermination()
    return store.read("doc_status").where("status = 'pending'").select("id", "status")


@query("str_event_counts", "SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def str_event_counts(spark, d):
    from tessera.streaming.ingest import event_counts

    e = KG(spark, d).table("events")
    return event_counts(e).select(F.col("start").cast(dict(e.dtypes)["ts"]).alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


@query("fn_sort_key", "SELECT p_partkey AS id, lower(p_name) AS key FROM part")
def fn_sort_key(spark, d):
    return KG(spark, d).table("part").select(F.col("p_partkey").alias("id"), text.sort_key("p_name").alias("key"))


def _knowledge(spark, d):
    """Documents as chunks, suppliers and parts as nodes, sales as edges.

    Nodes and edges have the embedding of a number out of their md5 and one dimension more, so no two are equally near.
    """
    kg = KG(spark, d)
    e = kg.table("embeddings").select(F.col("vec_id").alias("k"), F.col("embedding").cast("array<double>").alias("vector"))
    n = F.lit(e.count())

    def with_vector(df, *key):
        number = F.conv(F.substring(F.md5(F.concat_ws(">", *key).cast("binary")), 1, 8), 16, 10).cast("long")
        near = df.withColumn("number", number).withColumn("k", F.col("number") % n).join(e, "k")
        return near.withColumn("vector", F.concat("vector", F.array(F.col("number") / F.lit(2.0**32)))).drop("k", "number")

    chunks = kg.table("documents").select(F.col("doc_id").alias("k"), F.col("doc_id").cast("string").alias("chunk_id"), F.col("text").alias("content"), F.col("source").alias("file_path")).join(e, "k").drop("k")
    frag = kg.cte("frag")
    sources = F.array_sort(F.collect_set(F.substring("source_id", 7, 20))).alias("source_ids")
    of = frag.groupBy(F.col("src").alias("id")).agg(sources)
    nodes = kg.cte("nodes").join(of, "id", "left").select("id", "entity_type", F.col("name").alias("description"), F.coalesce("source_ids", F.array().cast("array<string>")).alias("source_ids"))
    edges = frag.groupBy("src", "tgt").agg(F.sum("weight").cast("double").alias("weight"), sources).withColumn("description", F.lit("sold"))
    return KnowledgeBase(chunks.withColumn("vector", F.array_append("vector", F.lit(0.0))), with_vector(nodes, "id"), with_vector(edges, "src", "tgt"))


def _question(spark, d):
    return [*map(float, KG(spark, d).table("embeddings").where("vec_id = 0").first()["embedding"]), 0.0]


@query(
    "qry_naive",
    """WITH q AS (SELECT embedding FROM embeddings WHERE vec_id = 0), s AS (SELECT CAST(doc_id AS VARCHAR) AS chunk_id, len(list_filter(string_split_regex(text, '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '')) AS tokens,
            list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]) AS sim FROM documents JOIN embeddings e ON e.vec_id = doc_id, q),
        r AS (SELECT *, row_number() OVER (ORDER BY sim DESC, chunk_id) AS pos FROM s WHERE sim >= 0.2), c AS (SELECT chunk_id, pos, sum(tokens) OVER (ORDER BY pos) AS running FROM r WHERE pos <= 20)
        SELECT chunk_id, pos FROM c WHERE running <= 30000""",
)
def qry_naive(spark, d):
    found = retrieve(_knowledge(spark, d), _question(spark, d), QueryParam(mode="naive"))
    return found["chunks"].select("chunk_id", F.col("pos").cast("long").alias("pos"))


_WORDS = "len(list_filter(string_split_regex({}, '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> ''))"
_NUMBER = "('0x' || substr(md5({}), 1, 8))::BIGINT"


def _near(name, rows, key, k):
    """The rows of a table nearest to the question, as (key columns, pos)."""
    near = f"(SELECT {key}, list_cosine_similarity(r.vector, q.vector) AS sim FROM {rows} r, question q)"
    return f"{name} AS (SELECT {key}, row_number() OVER (ORDER BY sim DESC, {key}) AS pos FROM {near} WHERE sim >= 0.2 QUALIFY pos <= {k})"


def _owned(name, owners, taken):
    """Chunks that a list of owners (owner, pos, source_ids) refers to, as (chunk_id, pos): few an owner, at their first one."""
    return f"""{name}_refs AS (SELECT owner, o.pos AS owner_pos, unnest(range(1, len(source_ids) + 1)) AS place, unnest(source_ids) AS chunk_id FROM {owners} o),
        {name}_all AS (SELECT *, count(*) OVER (PARTITION BY chunk_id) AS n FROM {name}_refs QUALIFY row_number() OVER (PARTITION BY chunk_id ORDER BY owner_pos, place) = 1),
        {name}_own AS (SELECT * FROM {name}_all WHERE chunk_id IN (SELECT chunk_id FROM texts){taken}),
        {name}_few AS (SELECT * FROM {name}_own QUALIFY row_number() OVER (PARTITION BY owner ORDER BY n DESC, place) <= 5),
        {name} AS (SELECT chunk_id, row_number() OVER (ORDER BY owner_pos, n DESC, place) AS pos FROM {name}_few QUALIFY pos <= 20)"""


def _in_turns(name, key, *lists):
    every = " UNION ALL ".join(f"SELECT {key}, pos, {i} AS source FROM {x}" for i, x in enumerate(lists))
    return f"""{name}_once AS (SELECT * FROM ({every}) QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY pos, source) = 1),
        {name} AS (SELECT {key}, row_number() OVER (ORDER BY pos, source) AS pos FROM {name}_once)"""


def _cut(name, rows, most):
    return f"{name} AS (SELECT * FROM (SELECT *, sum(tokens) OVER (ORDER BY pos) AS running FROM {rows}) WHERE running <= {most})"


def _mode_sql(mode):
    local, far = mode != "global", mode != "local"
    found = "list_sort(list(DISTINCT substr(source_id, 7)))"
    vector = f"list_append(e.embedding::DOUBLE[], {_NUMBER.format('x.key')} / 4294967296.0)"
    embedded = f"JOIN embeddings e ON e.vec_id = {_NUMBER.format('x.key')} % (SELECT count(*) FROM embeddings)"
    parts = [
        "+ question AS (SELECT list_append(embedding::DOUBLE[], 0.0) AS vector FROM embeddings WHERE vec_id = 0)",
        "texts AS (SELECT CAST(doc_id AS VARCHAR) AS chunk_id, text, list_append(embedding::DOUBLE[], 0.0) AS vector FROM documents JOIN embeddings ON vec_id = doc_id)",
        f"held AS (SELECT src AS id, {found} AS source_ids FROM frag GROUP BY 1)",
        f"node AS (SELECT id, entity_type, name, coalesce(source_ids, []) AS source_ids, {vector} AS vector FROM (SELECT *, id AS key FROM nodes) x LEFT JOIN held USING (id) {embedded})",
        f"edge AS (SELECT src, tgt, weight, source_ids, {vector} AS vector FROM (SELECT src, tgt, src || '>' || tgt AS key, sum(weight) AS weight, {found} AS source_ids FROM frag GROUP BY 1, 2) x {embedded})",
    ]
    if local:
        parts += [
            _near("node_hits", "node", "id", 10),
            """edge_order AS (SELECT src, tgt, row_number() OVER (ORDER BY a.degree + b.degree DESC, weight DESC, src, tgt) AS pos FROM edge JOIN deg a ON a.node = src JOIN deg b ON b.node = tgt
            WHERE src IN (SELECT id FROM node_hits) OR tgt IN (SELECT id FROM node_hits))""",
        ]
    if far:
        parts += [
            _near("edge_hits", "edge", "src, tgt", 10),
            """sides AS (SELECT src AS id, pos * 2 AS place FROM edge_hits UNION ALL SELECT tgt, pos * 2 + 1 FROM edge_hits),
            ends_order AS (SELECT id, row_number() OVER (ORDER BY min(place)) AS pos FROM sides GROUP BY id)""",
        ]
    parts += [
        _in_turns("entity_turns", "id", *["node_hits"] * local, *["ends_order"] * far), _in_turns("relation_turns", "src, tgt", *["edge_order"] * local, *["edge_hits"] * far),
        f"entity_sizes AS (SELECT id AS owner, id, pos, source_ids, {_WORDS.format("concat_ws(' ', id, entity_type, name)")} AS tokens FROM entity_turns JOIN node USING (id))",
        "relation_sizes AS (SELECT src || '>' || tgt AS owner, src, tgt, pos, source_ids, 3 AS tokens FROM relation_turns JOIN edge USING (src, tgt))",
        _cut("entities", "entity_sizes", 6000), _cut("relations", "relation_sizes", 8000),
        _owned("by_entity", "entities", ""), _owned("by_edge", "relations", " AND chunk_id NOT IN (SELECT chunk_id FROM by_entity_own)"),
    ]
    if mode == "mix":
        parts.append(_near("text_hits", "texts", "chunk_id", 20))
    parts += [
        _in_turns("chunk_turns", "chunk_id", *["text_hits"] * (mode == "mix"), "by_entity", "by_edge"),
        f"chunk_sizes AS (SELECT chunk_id, pos, {_WORDS.format('text')} AS tokens FROM chunk_turns JOIN texts USING (chunk_id) WHERE pos <= 20)", _cut("chunks", "chunk_sizes", 30000),
    ]
    return ", ".join(parts) + " SELECT 'entities' AS part, id AS key, pos FROM entities UNION ALL SELECT 'relations', owner, pos FROM relations UNION ALL SELECT 'chunks', chunk_id, pos FROM chunks"


for _mode in ("local", "global", "hybrid", "mix"):

    def _retrieve(spark, d, mode=_mode):
        found = retrieve(_knowledge(spark, d), _question(spark, d), QueryParam(mode=mode, top_k=10))
        part = lambda name, *key: found[name].select(F.lit(name).alias("part"), F.concat_ws(">", *key).alias("key"), F.col("pos").cast("long").alias("pos"))
        return part("entities", "id").unionByName(part("relations", "src", "tgt")).unionByName(part("chunks", "chunk_id"))

    query(f"qry_{_mode}", _mode_sql(_mode), "frag", "nodes", "deg")(_retrieve)


@query("vec_upsert", "SELECT id FROM (SELECT CAST(vec_id AS VARCHAR) AS id FROM embeddings UNION SELECT 'new-' || n_nationkey FROM nation)")
def vec_upsert(spark, d):
    import numpy as np

    kg = KG(spark, d)
    old = kg.table("embeddings").select(F.col("vec_id").cast("string").alias("id"), F.lit("").alias("content"), F.array(F.lit(1.0), F.lit(2.0)).cast("array<float>").alias("vector"))
    new = kg.table("nation").select(F.concat(F.lit("new-"), F.col("n_nationkey").cast("string")).alias("id"), F.col("n_name").alias("content"))
    return vectors.upsert(old, new, lambda texts: np.array([[len(t), 1.0] for t in texts], np.float32).reshape(-1, 2), 2).where("size(vector) = 2").select("id")


@query("txt_caller_chunks", "SELECT doc_id, CAST(i AS INTEGER) AS chunk_order_index, substr(text, i * 1000 + 1, 1000) AS content FROM (SELECT doc_id, text, unnest(range(0, (length(text) + 999) // 1000)) AS i FROM documents)")
def txt_caller_chunks(spark, d):
    docs = KG(spark, d).table("documents").select("doc_id", "text")
    return chunking.chunks_by(docs, "text", lambda t: [t[i : i + 1000] for i in range(0, len(t), 1000)]).drop("text")
