"""Queries that cut documents with their places kept, bring known objects to them, and judge candidates by rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import chunking, review, versions
from tessera.plans.registry import KG, query


@query(
    "txt_offsets",
    r"""WITH p AS (SELECT doc_id, text, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+') AS p FROM documents),
        w AS (SELECT doc_id, text, p, unnest(range(0, len(p), 250)) AS s FROM p),
        o AS (SELECT *, (s // 250)::INTEGER AS chunk_order_index, least(300, len(p) - s)::INTEGER AS tokens, length(array_to_string(p[1:s], '')) + length(p[s + 1]) - length(regexp_extract(p[s + 1], '[^\x20\x09-\x0D]+')) AS start,
            length(array_to_string(p[1:s + 300], '')) AS stop FROM w)
        SELECT doc_id, chunk_order_index, tokens, start::BIGINT AS start, (stop - start)::BIGINT AS length, md5(text[start + 1:stop]) AS content FROM o""",
)
def txt_offsets(spark, d):
    docs = KG(spark, d).table("documents").select("doc_id", "text")
    return chunking.windows_with_offsets(docs, "text", 300, 50).select("doc_id", "chunk_order_index", "tokens", "start", "length", F.md5(F.col("content").cast("binary")).alias("content"))


SECTIONS = r"""WITH l AS (SELECT doc_id, text, unnest(string_split(text, E'\n')) AS line, unnest(range(0, len(string_split(text, E'\n')))) AS i FROM documents),
    m AS (SELECT *, length(line) < 40 AS t, regexp_matches(line, '^[A-L]') AS h, sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY i) - length(line) - 1 AS start FROM l),
    c AS (SELECT *, sum(t::INT) OVER w AS block, sum((t OR h)::INT) OVER w AS cut FROM m WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
    g AS (SELECT doc_id, block, cut, min(start) AS start, max(start + length(line) + 1) AS stop, min(text) AS text, min(i) AS line_start, max(i) AS line_end, max(CASE WHEN t THEN line END) AS title FROM c GROUP BY ALL),
    k AS (SELECT *, row_number() OVER b - 1 AS section, max(block) OVER (PARTITION BY doc_id) AS last, first_value(title IGNORE NULLS) OVER (PARTITION BY doc_id, block ORDER BY cut ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS title_of, text[start + 1:stop] AS content FROM g WINDOW b AS (PARTITION BY doc_id, block ORDER BY cut)),
    u AS (SELECT * FROM k WHERE (block > 0 OR last = 0) AND trim(translate(content, E'\n\t\r', '   ')) <> '')"""


def _sections(spark, d):
    docs = KG(spark, d).table("documents").select("doc_id", "text")
    kinds = {"license": F.contains(F.lower("content"), F.lit("license")), "contact": F.contains("content", F.lit("@")), "long": F.char_length("content") > 500}
    return chunking.section_units(docs, "doc_id", "text", F.char_length("line") < 40, F.col("line").rlike("^[A-L]"), kinds)


@query(
    "txt_sections",
    SECTIONS + r""" SELECT doc_id, block::BIGINT AS block, section::INTEGER AS section, md5(title_of) AS title, CASE WHEN contains(lower(content), 'license') THEN 'license' WHEN contains(content, '@') THEN 'contact' WHEN length(content) > 500 THEN 'long' ELSE 'unknown' END AS kind,
        start::BIGINT AS start, length(content)::BIGINT AS length, line_start::INTEGER AS line_start, line_end::INTEGER AS line_end, 'unit-' || md5(doc_id || ':' || start::BIGINT || ':' || content) AS unit_id FROM u""",
)
def txt_sections(spark, d):
    return _sections(spark, d).drop("content").withColumn("title", F.md5(F.col("title").cast("binary")))


@query(
    "txt_enriched",
    SECTIONS + r""", o AS (SELECT DISTINCT lower(unnest(regexp_extract_all(text, '[A-Za-z]{7,}'))) AS term FROM benchmark),
        n AS (SELECT doc_id, start, unnest(list_distinct(regexp_extract_all(lower(content), '[^\x20\x09-\x0D.,;:!?()]+'))) AS run FROM u)
        SELECT doc_id, start::BIGINT AS start, count(term)::INTEGER AS n_known, coalesce(string_agg(term, ',' ORDER BY term), '') AS terms FROM u LEFT JOIN (SELECT * FROM n JOIN o ON run = term) USING (doc_id, start) GROUP BY ALL""",
)
def txt_enriched(spark, d):
    terms = KG(spark, d).table("benchmark").select(F.explode(F.regexp_extract_all("text", F.lit("([A-Za-z]{7,})"), F.lit(1))).alias("term"))
    objects = terms.select(F.lower("term").alias("term")).distinct().select(F.concat(F.lit("term-"), "term").alias("object_id"), F.lit("word").alias("object_type"), "term")
    found = chunking.enrich_units(_sections(spark, d), objects, most_words=1)
    known = F.from_json("context", "knownObjects array<struct<term:string>>")["knownObjects"]
    return found.select("doc_id", "start", "n_known", F.array_join(F.array_sort(F.transform(known, lambda x: x["term"])), ",").alias("terms"))


RULES = """SELECT 'g' || o_custkey AS group_key, 'obj-' || o_orderkey AS object_key, 'v' || o_orderkey AS version, CASE o_orderkey % 5 WHEN 0 THEN 'the field is editable' WHEN 1 THEN 'the field is readonly' WHEN 2 THEN 'shown' END AS rule_text,
    CASE o_orderkey % 7 WHEN 0 THEN 'This replaces an older rule' WHEN 1 THEN 'a changed text' ELSE 'plain' END AS evidence_text, o_orderkey % 11 <> 0 AS has_evidence, o_orderkey % 4 = 0 AS latest,
    CASE o_orderkey % 3 WHEN 0 THEN 'CURRENT' ELSE 'UNKNOWN' END AS status, o_orderkey % 6 = 0 AS replaces FROM orders"""
RULES_SQL = f"""i AS ({RULES}), f AS (SELECT *, contains(lower(evidence_text), 'replace') AS explicit FROM i WHERE has_evidence),
    s AS (SELECT *, contains(evidence_text, 'changed') AND NOT explicit AS weak, min(CASE WHEN rule_text LIKE '%editable%' THEN object_key END) OVER g AS pos, min(CASE WHEN rule_text LIKE '%readonly%' THEN object_key END) OVER g AS neg,
        count(*) OVER g AS n, count(*) FILTER (latest) OVER g AS n_latest, count(*) FILTER (replaces) OVER g AS n_super FROM f WINDOW g AS (PARTITION BY group_key)),
    r AS (SELECT *, CASE WHEN rule_text LIKE '%editable%' THEN neg WHEN rule_text LIKE '%readonly%' THEN pos END AS opponent, group_key || '@' || version AS id FROM s)"""


def _rules(spark, d):
    KG(spark, d).table("orders").createOrReplaceTempView("orders")
    rows = spark.sql(RULES)
    none = F.array().cast("array<string>")
    return rows.withColumn("supersedes", F.when(F.col("replaces"), F.array(F.lit("v0"))).otherwise(none)).drop("replaces")


@query(
    "mut_version_relations",
    f"""WITH {RULES_SQL} SELECT object_key AS src, id AS tgt, 'HAS_VERSION' AS relation, 'VERSION' AS reason FROM r UNION ALL SELECT id, group_key || '@v0', 'SUPERSEDES', 'EXPLICIT_SUPERSEDES_EVIDENCE' FROM r WHERE replaces AND explicit
        UNION ALL SELECT object_key, opponent, 'VERSION_CONFLICT', 'CONFLICT_WITHOUT_SUPERSEDES' FROM r WHERE opponent IS NOT NULL
        UNION ALL SELECT * FROM (SELECT object_key, id, 'VERSION_REVIEW_REQUIRED', CASE WHEN n_latest > 1 THEN 'MULTIPLE_LATEST_FLAGS' WHEN weak THEN 'WEAK_VERSION_KEYWORD_ONLY' WHEN n > 1 AND n_latest = 0 AND n_super = 0 THEN 'MULTI_VERSION_UNKNOWN'
            WHEN opponent IS NOT NULL THEN 'CONFLICT_WITHOUT_SUPERSEDES' WHEN status = 'UNKNOWN' AND NOT replaces AND n > 1 THEN 'MISSING_EXPLICIT_VERSION_STATUS' END AS why FROM r) WHERE why IS NOT NULL""",
)
def mut_version_relations(spark, d):
    return versions.version_relations(_rules(spark, d))[0]


@query(
    "agg_version_coverage",
    f"""WITH {RULES_SQL} SELECT (SELECT count(*) FROM i) AS n_objects, count(*) AS n_has_version, count(*) FILTER (replaces AND explicit) AS n_supersedes, count(opponent) AS n_version_conflict,
        count(*) FILTER (n_latest > 1 OR weak OR (n > 1 AND n_latest = 0 AND n_super = 0) OR opponent IS NOT NULL OR (status = 'UNKNOWN' AND NOT replaces AND n > 1)) AS n_version_review_required, 0::BIGINT AS n_missing_version_group_key,
        (SELECT count(*) FROM i WHERE NOT has_evidence) AS n_missing_version_evidence, count(*) FILTER (replaces AND NOT explicit) AS n_unsafe_supersedes_blocked, (SELECT count(*) FROM i WHERE NOT has_evidence) = 0 AS passed FROM r""",
)
def agg_version_coverage(spark, d):
    return versions.version_relations(_rules(spark, d))[2]


@query(
    "gate_triage",
    f"""WITH i AS ({RULES}), e AS (SELECT *, contains(lower(evidence_text), 'replace') AS explicit FROM i), s AS (SELECT *, contains(evidence_text, 'changed') AND NOT explicit AS weak,
            (rule_text LIKE '%editable%' AND count(*) FILTER (rule_text LIKE '%readonly%') OVER g > 0) OR (rule_text LIKE '%readonly%' AND count(*) FILTER (rule_text LIKE '%editable%') OVER g > 0) AS conflicting FROM e WINDOW g AS (PARTITION BY group_key)),
        t AS (SELECT group_key, CASE WHEN bool_or(NOT has_evidence) THEN 'MISSING_EVIDENCE' WHEN bool_or(replaces AND NOT explicit) THEN 'UNSAFE_SUPERSEDES_BLOCKED' WHEN bool_or(explicit) THEN 'EXPLICIT_SUPERSEDES' WHEN bool_or(coalesce(conflicting, false)) THEN 'CONFLICT_WITHOUT_SUPERSEDES'
            WHEN count(*) FILTER (latest) > 1 THEN 'TRUE_REVIEW_REQUIRED' WHEN bool_or(weak) THEN 'WEAK_VERSION_KEYWORD_ONLY' WHEN count(*) > 1 AND count(*) FILTER (latest) = 0 THEN 'MULTI_VERSION_UNKNOWN'
            WHEN count(*) FILTER (latest) = 1 OR bool_or(status = 'CURRENT') THEN 'EXPLICIT_CURRENT' ELSE 'SINGLETON_NO_CONFLICT' END AS category, bool_or(status = 'UNKNOWN') AS was, bool_or(status = 'UNKNOWN') AND count(*) > 1 AS now FROM s GROUP BY 1)
        SELECT coalesce(category, 'all') AS category, count(*) AS n, count(*) FILTER (was) AS n_before, count(*) FILTER (now) AS n_after FROM t GROUP BY ROLLUP (category)""",
)
def gate_triage(spark, d):
    items = versions.version_signals(_rules(spark, d))
    unknown = items.where("status = 'UNKNOWN'").select("group_key")
    several = items.groupBy("group_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return review.triage(items, unknown, unknown.join(several, "group_key", "left_semi"))[1]


@query(
    "gate_entity_types",
    """WITH c AS (SELECT l_orderkey AS item_id, 'T' || (l_partkey % 6) AS t, CASE l_linenumber % 4 WHEN 0 THEN 3 WHEN 1 THEN 2 WHEN 2 THEN 5 ELSE 7 END AS p, ['', 'CONFIG_RESOLVED', 'STRUCTURE_RESOLVED', '', 'HEURISTIC_RESOLVED', '', 'HEURISTIC_RESOLVED'][p] AS accepted, (l_suppkey % 5) / 5.0E0 + 0.2E0 AS score FROM lineitem),
        b AS (SELECT item_id, min(p) AS p FROM c GROUP BY 1), m AS (SELECT c.item_id, c.p, max(score) AS score FROM c JOIN b ON b.item_id = c.item_id AND b.p = c.p GROUP BY ALL),
        t AS (SELECT c.item_id, list_sort(list_distinct(list(t))) AS types, min(accepted) AS accepted, min(c.score) AS confidence FROM c JOIN m ON m.item_id = c.item_id AND m.p = c.p AND m.score = c.score GROUP BY 1),
        d AS (SELECT o_orderkey AS item_id, types, coalesce(confidence, 0) AS confidence, CASE WHEN types IS NULL THEN 'NO_SAFE_TYPE' WHEN len(types) > 1 THEN 'CONFLICT' WHEN types[1] = 'T1' THEN 'BLOCKED_GENERIC_TYPE' WHEN types[1] = 'T5' THEN 'NO_SAFE_TYPE'
            WHEN confidence >= 0.9 AND o_orderkey % 2 = 0 THEN accepted WHEN confidence >= 0.65 THEN 'CANDIDATE_REVIEW' ELSE 'NO_SAFE_TYPE' END AS decision FROM orders LEFT JOIN t ON item_id = o_orderkey)
        SELECT item_id, CASE WHEN decision NOT IN ('NO_SAFE_TYPE', 'CONFLICT', 'BLOCKED_GENERIC_TYPE') THEN types[1] END AS resolved_type, decision, confidence, CASE WHEN len(types) > 1 THEN array_to_string(types, ',') ELSE '' END AS conflict_types FROM d""",
)
def gate_entity_types(spark, d):
    kg = KG(spark, d)
    source = "CASE l_linenumber % 4 WHEN 0 THEN 'STRUCTURAL_PARSER' WHEN 1 THEN 'CONFIRMED_CONFIG' WHEN 2 THEN 'SECTION_DOMAIN_HEURISTIC' ELSE 'MODEL_CANDIDATE' END AS source"
    candidates = kg.table("lineitem").selectExpr("l_orderkey AS item_id", "concat('T', l_partkey % 6) AS candidate_type", source, "(l_suppkey % 5) / 5.0D + 0.2D AS score")
    registry = kg.table("nation").where("n_nationkey < 5").selectExpr("concat('T', n_nationkey) AS type", "n_nationkey = 1 AS generic")
    items = kg.table("orders").selectExpr("o_orderkey AS item_id", "o_orderkey % 2 = 0 AS evidence_complete")
    return review.resolve_types(items, candidates, registry).withColumn("conflict_types", F.array_join("conflict_types", ","))


@query(
    "gate_eligibility",
    """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 7 = 0 OR o_custkey % 5 = 0 THEN 'BLOCKED' WHEN o_orderstatus = 'P' OR o_orderkey % 3 = 0 THEN 'NEEDS_REVIEW' ELSE 'ELIGIBLE' END AS status,
        concat_ws(',', CASE WHEN o_orderstatus = 'P' THEN 'MISSING_REVIEW_DECISION' END, CASE WHEN o_orderkey % 7 = 0 THEN 'MISSING_EVIDENCE' END, CASE WHEN o_custkey % 5 = 0 THEN 'FORBIDDEN_RELATION_TYPE' END, CASE WHEN o_orderkey % 3 = 0 THEN 'VERSION_STATUS_UNCERTAIN' END) AS reasons,
        CASE WHEN o_orderkey % 7 = 0 OR o_custkey % 5 = 0 THEN 'FIX_BLOCKERS_BEFORE_REVIEW' WHEN o_orderkey % 3 = 0 THEN 'VERSION_REVIEW_REQUIRED' ELSE 'REVIEWER_APPROVAL_REQUIRED' END AS reviewer_action FROM orders""",
)
def gate_eligibility(spark, d):
    rules = {
        "MISSING_REVIEW_DECISION": F.col("o_orderstatus") == "P",
        "MISSING_EVIDENCE": F.col("o_orderkey") % 7 == 0,
        "FORBIDDEN_RELATION_TYPE": F.col("o_custkey") % 5 == 0,
        "VERSION_STATUS_UNCERTAIN": F.col("o_orderkey") % 3 == 0,
    }
    found = review.eligibility(KG(spark, d).table("orders"), rules)
    return found.select(F.col("o_orderkey").alias("id"), "status", F.array_join("blocking_reasons", ",").alias("reasons"), "reviewer_action")


@query(
    "gate_json_faults",
    """WITH o AS (SELECT o_orderkey AS id, o_orderkey % 4 AS m, o_orderstatus AS s FROM orders), l AS (SELECT l_orderkey AS id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS i, l_returnflag AS f, l_partkey % 3 = 0 AS b FROM lineitem)
        SELECT id, '$.version' AS path, 'REQUIRED_KEY' AS code FROM o WHERE m = 0 UNION ALL SELECT id, '$', 'NOT_JSON' FROM o WHERE m = 3 UNION ALL SELECT id, '$.status', 'VALUE_NOT_ALLOWED' FROM o WHERE m <> 3 AND s = 'P'
        UNION ALL SELECT l.id, '$.confirmed.lines[' || i || '].priority', 'BANNED_FIELD' FROM l JOIN o ON o.id = l.id WHERE m <> 3 AND b
        UNION ALL SELECT l.id, '$.confirmed.lines[' || i || '].flag', 'VALUE_NOT_ALLOWED' FROM l JOIN o ON o.id = l.id WHERE m <> 3 AND f = 'R'
        UNION ALL SELECT id, '$.status', 'WRONG_KIND' FROM o WHERE false""",
)
def gate_json_faults(spark, d):
    kg = KG(spark, d)
    line = F.struct("l_linenumber", "l_partkey", "l_suppkey", F.struct(F.col("l_returnflag").alias("flag"), F.when(F.col("l_partkey") % 3 == 0, F.lit("high")).alias("priority")).alias("x"))
    lines = kg.table("lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.transform(F.array_sort(F.collect_list(line)), lambda v: v["x"]).alias("lines"))
    o = kg.table("orders").join(lines, F.col("id") == F.col("o_orderkey"), "left")
    made = F.to_json(F.struct(F.when(F.col("o_orderkey") % 4 != 0, F.lit("1")).alias("version"), F.col("o_orderstatus").alias("status"), F.struct("lines").alias("confirmed")))
    docs = o.select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 4 == 3, F.lit("{broken")).otherwise(made).alias("body"))
    return review.json_faults(
        docs, "id", "body", {"$": ["version", "confirmed"]}, {"$.status": ["O", "F"], "$.confirmed.lines[].flag": ["A", "N"]}, {"$.confirmed": ["priority", "effort"]}, {"$.status": "string", "$.confirmed.lines": "array"}
    )


@query(
    "gate_route",
    """WITH p AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 50 = 0 THEN 'ONE_TO_MANY' END AS ov, o_custkey % 10 / 10.0E0 AS ev, o_orderkey % 10 / 10.0E0 AS nov, o_orderkey % 5 / 5.0E0 AS obj, o_custkey % 7 / 7.0E0 AS fc, o_custkey % 3 / 3.0E0 AS oc, o_orderkey % 4 / 4.0E0 AS cc, o_orderkey % 3 / 3.0E0 AS lc, o_custkey % 4 AS nt, o_orderkey % 3 AS nf, o_custkey % 3 AS nd, o_orderkey % 6 AS ni, o_custkey % 5 AS np FROM orders),
        s AS (SELECT *, nov >= 0.7 AND obj >= 0.6 AS new, new AND greatest(fc, oc, cc) <= 0.35 AS z, nt BETWEEN 1 AND 2 AND oc >= 0.45 AND (nf > 1 OR nd > 1) AND (ni >= 3 OR np >= 2) AS m, nt BETWEEN 1 AND 2 AND fc >= 0.7 AND cc >= 0.65 AND nf <= 1 AND nd <= 1 AND ni <= 2 AND lc >= 0.65 AS x FROM p),
        a AS (SELECT *, z::INT + m::INT + x::INT AS k, CASE WHEN z THEN 'ZERO_TO_ONE' WHEN m THEN 'ONE_TO_MANY' WHEN x THEN 'ONE_TO_ONE_X' END AS first FROM s)
        SELECT id, CASE WHEN ov IS NOT NULL THEN 'MANUAL_OVERRIDE' WHEN ev < 0.35 THEN 'INSUFFICIENT_EVIDENCE' WHEN new AND m THEN 'MIXED' WHEN k = 1 THEN 'CONFIDENT' ELSE 'AMBIGUOUS' END AS status,
            CASE WHEN ov IS NOT NULL THEN ov WHEN ev < 0.35 OR new AND m THEN NULL WHEN k = 1 THEN first END AS scenario,
            CASE WHEN ov IS NOT NULL THEN 'manual_override_recorded' WHEN ev < 0.35 THEN 'insufficient_evidence' WHEN new AND m THEN 'new_capability_and_broad_impact' WHEN k = 1 THEN lower(first) || '_signals_matched' WHEN k > 1 THEN 'multiple_non_exclusive_signals' ELSE 'no_confident_signal' END AS reason FROM a""",
)
def gate_route(spark, d):
    profiles = KG(spark, d).table("orders").selectExpr(
        "o_orderkey AS id", "CASE WHEN o_orderkey % 50 = 0 THEN 'ONE_TO_MANY' END AS override", "o_custkey % 10 / 10.0D AS evidence", "o_orderkey % 10 / 10.0D AS novelty", "o_orderkey % 5 / 5.0D AS new_objects", "o_custkey % 7 / 7.0D AS feature_coverage",
        "o_custkey % 3 / 3.0D AS object_coverage", "o_orderkey % 4 / 4.0D AS code_coverage", "o_orderkey % 3 / 3.0D AS local_change", "o_custkey % 4 AS n_targets", "o_orderkey % 3 AS n_features", "o_custkey % 3 AS n_domains", "o_orderkey % 6 AS n_impacts", "o_custkey % 5 AS n_paths",
    )
    return review.route(profiles).select("id", "status", "scenario", "reason")
