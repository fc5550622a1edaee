"""Queries over gates, versions, issues, contexts and measures."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.text import SEP
from tessera.operators import aggregates, gates, graph, joins, lookups, ranking, versions
from tessera.plans.queries_text import CANDIDATES, _candidates, _versions
from tessera.plans.registry import KG, query

ITEMS = """SELECT l_orderkey AS answer_id, l_partkey AS object_id, CASE l_linenumber WHEN 1 THEN 'FACT' WHEN 2 THEN 'ISSUE' WHEN 3 THEN 'CANDIDATE' WHEN 4 THEN 'INFO_ONLY' WHEN 5 THEN 'GENERIC_ONLY' WHEN 6 THEN 'GENERIC_NER' ELSE 'VERSION_REVIEW_REQUIRED' END AS kind,
    CASE l_returnflag WHEN 'A' THEN 'CONFIRMED' WHEN 'R' THEN 'SUPPORTED' ELSE 'TENTATIVE' END AS certainty, l_linestatus = 'F' AS is_impact, 'D' || (l_suppkey % 6) AS domain_code, 'dim' || (l_partkey % 4) AS dimension,
    CASE l_suppkey % 3 WHEN 0 THEN 'direct' WHEN 1 THEN 'indirect' ELSE 'tentative' END AS scope, l_quantity > 5 AS has_evidence FROM lineitem"""


def _items(spark, d):
    KG(spark, d).table("lineitem").createOrReplaceTempView("lineitem")
    return spark.sql(ITEMS)


@query(
    "gate_fact_promotion",
    f"""WITH i AS ({ITEMS}), s AS (SELECT answer_id, count(*) FILTER (WHERE kind = 'ISSUE' AND (NOT is_impact OR certainty <> 'TENTATIVE')) AS issue_as_fact,
        count(*) FILTER (WHERE (kind = 'CANDIDATE' OR (kind = 'VERSION_REVIEW_REQUIRED' AND NOT is_impact)) AND certainty = 'CONFIRMED') AS candidate_as_confirmed,
        count(*) FILTER (WHERE kind = 'INFO_ONLY' AND (NOT is_impact OR certainty <> 'TENTATIVE')) AS info_only_as_fact, count(*) FILTER (WHERE kind = 'GENERIC_ONLY' AND certainty = 'CONFIRMED') AS generic_only_as_confirmed,
        count(*) FILTER (WHERE kind = 'GENERIC_NER' AND certainty = 'CONFIRMED') AS generic_ner_fact_hit FROM i GROUP BY 1)
        SELECT *, issue_as_fact + candidate_as_confirmed + info_only_as_fact + generic_only_as_confirmed + generic_ner_fact_hit = 0 AS passed FROM s""",
)
def gate_fact_promotion(spark, d):
    return gates.fact_promotion(_items(spark, d), "answer_id")


@query(
    "gate_impact_breadth",
    f"""WITH i AS ({ITEMS}), r AS (SELECT DISTINCT o_orderkey AS answer_id, 'dim' || (o_custkey % 4) AS dimension FROM orders),
        c AS (SELECT answer_id, count(*) - count(DISTINCT object_id) AS n_duplicates, count(*) FILTER (WHERE domain_code NOT IN ('D1', 'D2', 'D3') OR (kind <> 'FACT' AND certainty = 'CONFIRMED')) AS n_false,
            count(*) FILTER (WHERE scope <> 'tentative') AS m, count(*) FILTER (WHERE scope <> 'tentative' AND has_evidence) AS b FROM i GROUP BY 1),
        v AS (SELECT r.answer_id, avg(CASE WHEN f.dimension IS NULL THEN 0.0 ELSE 1.0 END) AS coverage FROM r LEFT JOIN (SELECT DISTINCT answer_id, dimension FROM i WHERE kind = 'FACT') f ON f.answer_id = r.answer_id AND f.dimension = r.dimension GROUP BY 1)
        SELECT c.answer_id, n_duplicates, n_false, round(CASE WHEN m = 0 THEN 1.0 ELSE b / m END, 6)::DOUBLE AS evidence_ratio, coalesce(coverage, 1.0)::DOUBLE AS coverage FROM c LEFT JOIN v ON v.answer_id = c.answer_id""",
)
def gate_impact_breadth(spark, d):
    required = KG(spark, d).table("orders").select(F.col("o_orderkey").alias("answer_id"), F.concat(F.lit("dim"), (F.col("o_custkey") % 4).cast("string")).alias("dimension")).distinct()
    return gates.impact_breadth(_items(spark, d), required, "answer_id", ["D1", "D2", "D3"]).withColumn("evidence_ratio", F.round("evidence_ratio", 6)).drop("passed")


ANSWERED = """SELECT o_orderkey AS answer_id, o_custkey % 3 AS n_citations, o_custkey % 2 AS n_unsafe_warnings, o_custkey % 2 AS n_warnings, CASE o_orderkey % 3 WHEN 0 THEN 'CONFIRMED_CURRENT' WHEN 1 THEN 'MULTIPLE_CURRENT_CONFLICT' END AS resolution,
    CASE o_orderkey % 5 WHEN 0 THEN 'INSUFFICIENT_EVIDENCE' WHEN 1 THEN 'ANSWERED_WITH_VERSION_WARNING' ELSE 'ANSWERED' END AS status, o_orderstatus = 'O' AS safe, o_custkey % 5 = 0 AS supersedes, o_custkey % 4 AS n_supersedes_evidence FROM orders"""


def _answered(spark, d):
    KG(spark, d).table("orders").createOrReplaceTempView("orders")
    return spark.sql(ANSWERED)


@query(
    "gate_insufficient_evidence",
    f"""WITH a AS ({ANSWERED}) SELECT answer_id, concat_ws(',', CASE WHEN n_citations = 0 AND status NOT IN ('INSUFFICIENT_EVIDENCE', 'CONFLICTING_EVIDENCE') THEN 'INSUFFICIENT_EVIDENCE_NOT_REPORTED' END,
        CASE WHEN n_unsafe_warnings > 0 AND safe THEN 'UNSAFE_CONTEXT_MARKED_SAFE' END, CASE WHEN resolution <> 'CONFIRMED_CURRENT' AND status <> 'ANSWERED_WITH_VERSION_WARNING' THEN 'MISSING_VERSION_WARNING' END) AS errors FROM a""",
)
def gate_insufficient_evidence(spark, d):
    return gates.insufficient_evidence(_answered(spark, d)).select("answer_id", F.array_join("errors", ",").alias("errors"))


@query(
    "gate_version_safety",
    f"""WITH a AS ({ANSWERED}), f AS (SELECT DISTINCT l_orderkey AS answer_id FROM lineitem WHERE l_linenumber IN (2, 3) AND l_returnflag = 'A') SELECT a.answer_id, concat_ws(',',
        CASE WHEN coalesce(resolution, 'CONFIRMED_CURRENT') <> 'CONFIRMED_CURRENT' AND n_warnings = 0 AND safe THEN 'VERSION_HARD_JUDGMENT' END, CASE WHEN f.answer_id IS NOT NULL THEN 'HISTORICAL_AS_CURRENT' END,
        CASE WHEN supersedes AND n_supersedes_evidence = 0 THEN 'UNSUPPORTED_SUPERSEDES' END) AS errors FROM a LEFT JOIN f ON f.answer_id = a.answer_id""",
)
def gate_version_safety(spark, d):
    facts = KG(spark, d).table("lineitem").selectExpr("l_orderkey AS answer_id", "CASE l_linenumber WHEN 2 THEN 'HISTORICAL' WHEN 3 THEN 'SUPERSEDED' ELSE 'CURRENT' END AS version_status", "CASE l_returnflag WHEN 'A' THEN 'CONFIRMED' ELSE 'SUPPORTED' END AS certainty")
    return gates.version_safety(_answered(spark, d), facts, "answer_id").select("answer_id", F.array_join("errors", ",").alias("errors"))


@query(
    "gate_repair_plan",
    f"""WITH a AS ({ANSWERED}), e AS (SELECT answer_id, 'EVIDENCE' AS gate, 1 AS pos, 'MISSING_CITATION' AS error FROM a WHERE n_citations = 0 UNION ALL SELECT answer_id, 'EVIDENCE', 2, 'INVALID_CITATION' FROM a WHERE safe
        UNION ALL SELECT answer_id, 'VERSION', 3, 'HISTORICAL_AS_CURRENT' FROM a WHERE supersedes UNION ALL SELECT answer_id, 'VERSION', 4, 'SOMETHING_ELSE' FROM a WHERE n_warnings = 0)
        SELECT answer_id, gate, CASE WHEN error LIKE '%CITATION' THEN 'FIX_CITATION' WHEN error LIKE 'HIST%' THEN 'ADD_VERSION_WARNING' ELSE 'RETURN_INSUFFICIENT_EVIDENCE' END AS action, arg_min(error, pos) AS reason FROM e GROUP BY ALL""",
)
def gate_repair_plan(spark, d):
    a = _answered(spark, d)
    one = lambda where, gate, pos, error: a.where(where).select("answer_id", F.lit(gate).alias("gate"), F.lit(pos).alias("pos"), F.lit(error).alias("error"))
    errors = one("n_citations = 0", "EVIDENCE", 1, "MISSING_CITATION").unionByName(one("safe", "EVIDENCE", 2, "INVALID_CITATION"))
    errors = errors.unionByName(one("supersedes", "VERSION", 3, "HISTORICAL_AS_CURRENT")).unionByName(one("n_warnings = 0", "VERSION", 4, "SOMETHING_ELSE"))
    return gates.repair_plan(errors, "answer_id", 1)


@query(
    "gate_candidates",
    """SELECT p_partkey AS id, CASE WHEN p_size % 7 = 0 THEN 'MISSING_EVIDENCE' WHEN p_size % 5 = 0 THEN 'REVIEW_REQUIRED' WHEN p_size % 3 = 0 THEN 'INVALID_TYPE' ELSE 'VALID' END AS status,
        CASE WHEN p_size % 7 = 0 THEN 0.1 WHEN p_size % 5 = 0 THEN 0.5 WHEN p_size % 3 = 0 THEN 0.2 ELSE 0.9 END::DOUBLE AS confidence,
        concat_ws(',', CASE WHEN p_size % 7 = 0 THEN 'MISSING_EVIDENCE' END, CASE WHEN p_size % 7 <> 0 AND p_size % 5 <> 0 AND p_size % 3 = 0 THEN 'INVALID_ENTITY_TYPE' END, CASE WHEN p_size % 2 = 0 THEN 'SOURCE_SPAN_MISSING' END, CASE WHEN p_size % 11 = 0 THEN 'MISSING_FEATURE_KEY' END, 'MISSING_DOMAIN_CODE') AS issues FROM part""",
)
def gate_candidates(spark, d):
    p = KG(spark, d).table("part").selectExpr(
        "p_partkey AS id", "CASE WHEN p_size % 5 = 0 THEN 'CandidateEntity' WHEN p_size % 3 = 0 THEN 'Odd' ELSE 'Part' END AS entity_type", "p_size % 7 <> 0 AS has_evidence", "p_size % 2 <> 0 AS has_span",
        "CASE WHEN p_size % 11 <> 0 THEN 'f' ELSE '' END AS feature_key", "cast(null AS string) AS domain_code",
    )
    return gates.validate_candidates(p, ["Part", "Supplier"]).select("id", "status", "confidence", F.array_join("issues", ",").alias("issues"))


@query(
    "gate_relation_candidates",
    """WITH c AS (SELECT *, CASE l_suppkey % 5 WHEN 0 THEN 'SELLS' WHEN 1 THEN 'SELLS' WHEN 2 THEN 'CandidateRelation' ELSE CASE l_partkey % 3 WHEN 0 THEN 'MADE_OF' WHEN 1 THEN 'CandidateRelation' END END AS t,
            l_suppkey % 5 IN (1, 3) AS snake, l_quantity <= 5 AS bare FROM lineitem),
        s AS (SELECT *, CASE WHEN bare THEN 'MISSING_EVIDENCE' WHEN t = 'CandidateRelation' THEN 'REVIEW_REQUIRED' WHEN t IS NULL THEN CASE WHEN snake THEN 'INVALID_TYPE' ELSE 'REVIEW_REQUIRED' END
            WHEN snake THEN 'INVALID_TYPE' ELSE 'VALID' END AS status FROM c)
        SELECT l_orderkey AS id, l_linenumber AS line, coalesce(t, '') AS type, status, CASE status WHEN 'MISSING_EVIDENCE' THEN 0.1 WHEN 'REVIEW_REQUIRED' THEN 0.5 WHEN 'INVALID_TYPE' THEN 0.2 ELSE 0.9 END::DOUBLE AS confidence,
            concat_ws(',', CASE WHEN bare THEN 'MISSING_EVIDENCE' END, CASE WHEN NOT bare AND t IS NULL THEN 'INVALID_RELATION_TYPE' END, CASE WHEN snake THEN 'SNAKE_CASE_RELATION' END,
            CASE WHEN l_linenumber % 2 = 0 THEN 'SOURCE_SPAN_MISSING' END, 'MISSING_DOMAIN_CODE') AS issues FROM s""",
)
def gate_relation_candidates(spark, d):
    c = KG(spark, d).table("lineitem").selectExpr(
        "l_orderkey AS id", "l_linenumber AS line", "CASE l_suppkey % 5 WHEN 0 THEN 'odd, SELLS' WHEN 1 THEN 'has_child；SELLS/MADE_OF' WHEN 2 THEN 'CandidateRelation ' WHEN 3 THEN 'it,contains' ELSE 'free words' END AS keywords",
        "CASE l_partkey % 3 WHEN 0 THEN 'MADE_OF' WHEN 1 THEN 'CandidateRelation' ELSE 'other' END AS relation_type", "l_quantity > 5 AS has_evidence", "l_linenumber % 2 = 1 AS has_span", "'f' AS feature_key", "cast(null AS string) AS domain_code",
    )
    return gates.validate_relations(c, ["SELLS", "MADE_OF"]).select("id", "line", F.coalesce("relation_type", F.lit("")).alias("type"), "status", "confidence", F.array_join("issues", ",").alias("issues"))


@query(
    "agg_benchmark",
    """WITH r AS (SELECT CASE WHEN l_linenumber < 7 THEN CASE WHEN l_suppkey % 4 = 0 THEN 0 ELSE l_discount::DOUBLE END END AS a, l_suppkey % 4 = 1 AS nan FROM lineitem)
        SELECT count(*) AS n_total, count(a) AS n_successful, count(*) - count(a) AS n_failed, round(100.0 * count(a) / count(*), 2) AS success_rate, coalesce(round(avg(a) FILTER (NOT nan), 4), 0) AS mean_faithfulness,
            coalesce(round(avg(1 - a) FILTER (NOT nan), 4), 0) AS mean_score, coalesce(round(min(1 - a) FILTER (NOT nan), 4), 0) AS min_score, coalesce(round(max(1 - a) FILTER (NOT nan), 4), 0) AS max_score, coalesce(round(avg(a), 4), 0) AS mean_recall FROM r""",
)
def agg_benchmark(spark, d):
    r = KG(spark, d).table("lineitem").selectExpr(
        "l_linenumber < 7 AS ok", "l_suppkey % 4 AS kind", "cast(l_discount AS double) AS a"
    ).selectExpr(
        "CASE WHEN ok THEN CASE kind WHEN 0 THEN null WHEN 1 THEN double('NaN') ELSE a END END AS faithfulness", "CASE WHEN ok THEN CASE kind WHEN 0 THEN double(0) ELSE a END END AS recall",
        "CASE kind WHEN 0 THEN double(1) WHEN 1 THEN double('NaN') ELSE 1 - a END AS score",
    )
    return aggregates.benchmark_statistics(r, ["faithfulness", "recall"])


@query(
    "graph_path_validation",
    """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 13 = 0 THEN 'DANGLING_PATH' WHEN o_custkey % 8 > 4 THEN 'INVALID_HOP_LIMIT' WHEN o_orderkey % 7 = 0 THEN 'NOT_FACTUAL_ISSUE_EDGE' WHEN o_orderkey % 5 = 0 THEN 'BACKGROUND_ONLY'
        WHEN o_orderkey % 3 = 0 THEN 'TENTATIVE_VERSION_CONFLICT' WHEN o_custkey % 2 = 0 THEN 'NOT_FACTUAL_MISSING_EVIDENCE' ELSE 'FACTUAL' END AS status FROM orders""",
)
def graph_path_validation(spark, d):
    p = KG(spark, d).table("orders").selectExpr(
        "o_orderkey AS id", "o_orderkey % 13 = 0 AS dangling", "o_custkey % 8 AS hops", "o_orderkey % 7 = 0 AS issue_edge", "o_orderkey % 5 = 0 AS generic_only", "o_orderkey % 3 = 0 AS version_conflict", "o_custkey % 2 AS n_evidence"
    )
    return gates.validate_paths(p, "TRACEABILITY").select("id", "status")


@query("gate_performance", "WITH p AS (SELECT event_type, value, user_id % 2 AS side FROM events) SELECT round(quantile_cont(value, 0.95) FILTER (WHERE side = 1) / quantile_cont(value, 0.95) FILTER (WHERE side = 0), 6) AS query_p95_ratio, round(sum(value) FILTER (WHERE side = 1) / sum(value) FILTER (WHERE side = 0), 4) AS ingest_ratio FROM p")
def gate_performance(spark, d):
    e = KG(spark, d).table("events").select("value", F.col("value").alias("ingest_ms"), (F.col("user_id") % 2).alias("side"))
    return gates.performance(e.where("side = 0"), e.where("side = 1")).select(F.round("query_p95_ratio", 6).alias("query_p95_ratio"), F.round("ingest_ratio", 4).alias("ingest_ratio"))


PLAIN = f"""SELECT *, round(raw_score / 1000.0, 6)::DOUBLE AS fused_score FROM ({CANDIDATES})"""


@query("topk_evidence_first", f"WITH c AS ({PLAIN}) SELECT candidate_id, has_evidence, fused_score FROM c ORDER BY has_evidence DESC, fused_score DESC, candidate_id LIMIT 40")
def topk_evidence_first(spark, d):
    c = _candidates(spark, d).withColumn("fused_score", F.round(F.col("raw_score") / 1000.0, 6).cast("double"))
    return ranking.evidence_first(c, 40).select("candidate_id", "has_evidence", "fused_score")


@query(
    "qry_context_pack",
    f"""WITH c AS ({PLAIN}), f AS (SELECT candidate_id FROM c WHERE channel IN ('RAW_TEXT', 'PFSS_ENTITY', 'PFSS_RELATION', 'PFSS_PATH') ORDER BY has_evidence DESC, fused_score DESC, candidate_id LIMIT 25)
        SELECT candidate_id, CASE WHEN channel IN ('ISSUE_SIDECAR', 'VERSION_CONTEXT') THEN 'issue' WHEN channel = 'GENERIC_GRAPH' THEN 'generic' WHEN candidate_id IN (SELECT candidate_id FROM f) THEN 'factual' ELSE 'dropped' END AS part FROM c""",
)
def qry_context_pack(spark, d):
    c = _candidates(spark, d).withColumn("fused_score", F.round(F.col("raw_score") / 1000.0, 6).cast("double"))
    return ranking.context_pack(c, 25).select("candidate_id", "part")


for _channel, _where in {"RAW_TEXT": "channel = 'RAW_TEXT' AND factual_path", "TRUSTED": "channel IN ('PFSS_ENTITY', 'PFSS_RELATION', 'PFSS_PATH')", "ISSUES": "channel IN ('ISSUE_SIDECAR', 'VERSION_CONTEXT')"}.items():

    def _channel_of(spark, d, name=_channel):
        c = _candidates(spark, d).withColumn("deleted", F.lit(False)).withColumn("active", F.col("factual_path")).withColumn("text", F.lit("t"))
        return lookups.channel(c, name).select("candidate_id")

    query(f"flt_channel_{_channel.lower()}", f"WITH c AS ({CANDIDATES}) SELECT candidate_id FROM c WHERE {_where}")(_channel_of)


@query("win_sequence_ids", "SELECT 'DC' || row_number() OVER (ORDER BY p_partkey) AS id, p_partkey FROM (SELECT p_partkey FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 30)")
def win_sequence_ids(spark, d):
    top = KG(spark, d).table("part").orderBy(F.desc("p_retailprice"), "p_partkey").limit(30).select("p_partkey")
    return ranking.sequence_ids(top, "p_partkey")


DESCRIBED = "SELECT l_partkey AS k, repeat('x', CAST(l_quantity AS INTEGER) % 5) || l_returnflag AS description, CAST(l_quantity AS INTEGER) % 3 AS ts, l_orderkey * 10 + l_linenumber AS pos FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity) AS one FROM lineitem) WHERE one = 1"


@query(
    "win_description_order",
    f"WITH f AS ({DESCRIBED}), u AS (SELECT k, description, arg_min(ts, pos) AS ts, min(pos) AS pos FROM f GROUP BY ALL) SELECT k, string_agg(description, '<SEP>' ORDER BY ts, -length(description), pos) AS descriptions FROM u GROUP BY k",
)
def win_description_order(spark, d):
    KG(spark, d).table("lineitem").createOrReplaceTempView("lineitem")
    return aggregates.description_order(spark.sql(DESCRIBED).withColumnRenamed("ts", "at"), "k").select("k", F.array_join("descriptions", SEP).alias("descriptions"))


@query(
    "win_longest_description",
    "SELECT coalesce(p_partkey, k) AS k, CASE WHEN k IS NULL OR length(b) <= length(p_name) THEN p_name ELSE b END AS description FROM part FULL JOIN (SELECT p_partkey + 50 AS k, p_type AS b FROM part) x ON k = p_partkey",
)
def win_longest_description(spark, d):
    p = KG(spark, d).table("part")
    return aggregates.longest_description(p.select(F.col("p_partkey").alias("k"), F.col("p_name").alias("description")), p.select((F.col("p_partkey") + 50).alias("k"), F.col("p_type").alias("description")), "k")


ISSUES = "SELECT o_orderkey AS issue_id, 'doc-' || o_custkey AS document_id, 'us-' || (o_custkey % 40) AS source_us_id, 'obj-' || (o_orderkey % 100) AS semantic_object_id, CASE o_orderkey % 4 WHEN 0 THEN 'VERSION_CONFLICT' WHEN 1 THEN 'MISSING_EVIDENCE' WHEN 2 THEN 'TERM_AMBIGUITY' ELSE 'INFO_ONLY' END AS issue_type FROM orders"


def _issues(spark, d):
    KG(spark, d).table("orders").createOrReplaceTempView("orders")
    return spark.sql(ISSUES)


@query("flt_issues", f"WITH i AS ({ISSUES}) SELECT issue_id FROM i WHERE source_us_id = 'us-7' AND issue_type = 'MISSING_EVIDENCE'")
def flt_issues(spark, d):
    return lookups.issues(_issues(spark, d), source_us_id="us-7", issue_type="MISSING_EVIDENCE").select("issue_id")


@query("agg_issue_summary", f"WITH i AS ({ISSUES}) SELECT issue_type, count(*) AS n FROM i GROUP BY 1 UNION ALL SELECT 'all', count(*) FROM i")
def agg_issue_summary(spark, d):
    return aggregates.counts(_issues(spark, d), "issue_type", "all")


@query("agg_inventory", "SELECT o_orderpriority AS role, o_orderstatus AS status, count(*) AS n FROM orders GROUP BY ALL")
def agg_inventory(spark, d):
    o = KG(spark, d).table("orders").select(F.col("o_orderpriority").alias("role"), F.col("o_orderstatus").alias("status"))
    return o.groupBy("role", "status").agg(F.count(F.lit(1)).alias("n"))


@query("agg_version_snapshot", "SELECT count(DISTINCT o_custkey) AS n_groups, count(*) AS n_members, count(*) FILTER (WHERE o_orderkey % 9 <> 0) AS n_active, 0::BIGINT AS n_deleted FROM orders")
def agg_version_snapshot(spark, d):
    return aggregates.version_snapshot(_versions(spark, d))


@query("agg_payload_quality", "SELECT p_type, count(*) AS n, round(count(*)::DOUBLE / (SELECT count(*) FROM part), 6) AS share, round(avg(CASE WHEN p_size > 10 THEN 1.0 ELSE 0.0 END), 6)::DOUBLE AS with_evidence, round(avg(p_size), 6) AS mean_score FROM part GROUP BY 1")
def agg_payload_quality(spark, d):
    p = KG(spark, d).table("part").withColumn("evidence", F.col("p_size") > 10)
    return aggregates.payload_quality(p, "p_type", "evidence", "p_size").select("p_type", "n", *[F.round(c, 6).alias(c) for c in ("share", "with_evidence", "mean_score")])


@query(
    "agg_metrics",
    """SELECT event_type AS name, 'u' || (user_id % 3) AS labels, round(sum(value) FILTER (WHERE event_id % 3 = 0), 4) AS counter, round(arg_max(value, event_id) FILTER (WHERE event_id % 3 = 1), 4) AS gauge, count(*) FILTER (WHERE event_id % 3 = 2) AS n_samples FROM events GROUP BY ALL""",
)
def agg_metrics(spark, d):
    e = KG(spark, d).table("events").selectExpr("event_type AS name", "concat('u', user_id % 3) AS labels", "CASE event_id % 3 WHEN 0 THEN 'counter' WHEN 1 THEN 'gauge' ELSE 'sample' END AS kind", "value", "event_id AS at")
    return aggregates.metrics(e).select("name", "labels", F.round("counter", 4).alias("counter"), F.round("gauge", 4).alias("gauge"), "n_samples")


@query(
    "agg_effectiveness",
    """WITH g AS (SELECT l_orderkey AS k, list(DISTINCT l_partkey) AS gold FROM lineitem GROUP BY 1), f AS (SELECT l_orderkey AS k, list(DISTINCT l_partkey) AS found FROM lineitem WHERE l_linenumber <= 2 AND l_returnflag <> 'A' GROUP BY 1),
        h AS (SELECT len(list_intersect(gold, coalesce(found, []))) AS n, len(gold) AS g, coalesce(len(found), 0) AS f FROM g LEFT JOIN f USING (k))
        SELECT round(avg(n / g), 6) AS recall_at_k, round(avg(CASE WHEN f = 0 THEN 0.0 ELSE n / f END), 6) AS precision_at_k, round(avg(CASE WHEN n > 0 THEN 1.0 ELSE 0.0 END), 6)::DOUBLE AS hit_rate FROM h""",
)
def agg_effectiveness(spark, d):
    li = KG(spark, d).table("lineitem")
    cases = li.groupBy(F.col("l_orderkey").alias("k")).agg(F.collect_set("l_partkey").alias("gold"))
    results = li.where("l_returnflag <> 'A'").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("rank"), F.col("l_partkey").alias("item"))
    m = aggregates.effectiveness(cases, results, "k", 2)
    return m.select(*[F.round(c, 6).alias(c) for c in m.columns])


@query(
    "join_trace",
    """SELECT s_suppkey AS object_id, l_orderkey AS evidence_id, o_orderkey AS text_unit_id, c_custkey AS version_id, n_name AS document FROM supplier JOIN lineitem ON l_suppkey = s_suppkey JOIN orders ON o_orderkey = l_orderkey
        JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey WHERE s_suppkey = 3""",
)
def join_trace(spark, d):
    kg = KG(spark, d)
    objects = kg.table("supplier").where("s_suppkey = 3").select(F.col("s_suppkey").alias("object_id"))
    evidence = kg.table("lineitem").select(F.col("l_suppkey").alias("object_id"), F.col("l_orderkey").alias("evidence_id"))
    units = kg.table("orders").select(F.col("o_orderkey").alias("evidence_id"), F.col("o_orderkey").alias("text_unit_id"), F.col("o_custkey").alias("version_id"))
    of_version = kg.table("customer").select(F.col("c_custkey").alias("version_id"), F.col("c_nationkey").alias("document_id"))
    docs = kg.table("nation").select(F.col("n_nationkey").alias("document_id"), F.col("n_name").alias("document"))
    found = joins.trace(objects, [("object_id", evidence), ("evidence_id", units), ("version_id", of_version), ("document_id", docs)])
    return found.select("object_id", "evidence_id", "text_unit_id", "version_id", "document")


@query(
    "qry_text_only",
    """WITH t AS (SELECT doc_id, len(list_filter(list_distinct(regexp_extract_all(lower(text), '[a-z0-9]+')), lambda x: x IN ('tion', 'the', 'ing', 'ander'))) AS score FROM documents)
        SELECT doc_id, score::INTEGER AS score FROM t WHERE score > 0 ORDER BY t.score DESC, doc_id LIMIT 30""",
)
def qry_text_only(spark, d):
    from tessera.plans.retrieval import text_only

    docs = KG(spark, d).table("documents").select(F.col("doc_id"), "text")
    return text_only(docs, ["tion", "the", "ing", "ander"], 30)


@query("qry_user_format", "SELECT 'part' AS kind, count(*) AS n, min(src) AS first FROM edges UNION ALL SELECT 'pair', count(*), min(src || '-' || tgt) FROM edges", "edges")
def qry_user_format(spark, d):
    from tessera.plans.retrieval import user_format

    e = KG(spark, d).cte("edges").withColumn("description", F.lit("d"))
    shaped = user_format(entities=e.select(F.col("src").alias("id"), F.lit("part").alias("entity_type"), "description"), relations=e.select("src", "tgt", "description", "weight"))
    a = shaped["entities"].agg(F.count(F.lit(1)).alias("n"), F.min("entity_name").alias("first")).select(F.lit("part").alias("kind"), "n", "first")
    return a.unionByName(shaped["relationships"].agg(F.count(F.lit(1)).alias("n"), F.min(F.concat("src_id", F.lit("-"), "tgt_id")).alias("first")).select(F.lit("pair").alias("kind"), "n", "first"))


@query("graph_all_edges", "SELECT src, tgt, weight FROM edges UNION ALL SELECT id, id, 0 FROM nodes", "edges", "nodes")
def graph_all_edges(spark, d):
    kg = KG(spark, d)
    e = kg.cte("edges").select("src", "tgt", "weight")
    loops = kg.cte("nodes").select(F.col("id").alias("src"), F.col("id").alias("tgt"), F.lit(0).cast(dict(e.dtypes)["weight"]).alias("weight"))
    return graph.canonical(e.unionByName(loops)).select("src", "tgt", "weight")


@query("qry_selected_versions", "SELECT o_custkey AS version_group_key, max(o_orderkey) AS version_member_id FROM orders GROUP BY 1")
def qry_selected_versions(spark, d):
    v = _versions(spark, d).withColumn("score", F.col("version_member_id").cast("double"))
    return versions.select_by_intent(v, "CURRENT").select("version_group_key", "version_member_id")
