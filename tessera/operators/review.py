"""Decisions on candidates by rule tables: types, eligibility for promotion, faults of nested documents, routes, triage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.sources.scratch import materialise

#: The order in which sources of a type count, the decision that each leads to, and the scores that accept or ask.
TYPE_PRIORITY = {
    "EXPLICIT_DSL": 1,
    "CONFIRMED_CONFIG": 2,
    "STRUCTURAL_PARSER": 3,
    "RELATION_SIGNATURE": 4,
    "SECTION_DOMAIN_HEURISTIC": 5,
    "GENERIC_NER": 6,
    "MODEL_CANDIDATE": 7,
}
TYPE_DECISION = {
    "EXPLICIT_DSL": "EXPLICIT_ACCEPTED",
    "CONFIRMED_CONFIG": "CONFIG_RESOLVED",
    "STRUCTURAL_PARSER": "STRUCTURE_RESOLVED",
    "RELATION_SIGNATURE": "RELATION_RESOLVED",
    "SECTION_DOMAIN_HEURISTIC": "HEURISTIC_RESOLVED",
}
ACCEPT, ASK = 0.90, 0.65
#: Reasons that block a promotion rather than ask for a review.
HARD_REASONS = (
    "MISSING_EVIDENCE",
    "INVALID_TYPE",
    "INVALID_RELATION",
    "FORBIDDEN_RELATION_TYPE",
    "SUPERSEDES_REQUIRES_EXPLICIT_EVIDENCE",
    "INFO_ONLY_BLOCKED",
    "REVIEW_REQUIRED_BLOCKED",
    "VERSION_REVIEW_REQUIRED_BLOCKED",
    "VERSION_RELATION_REQUIRES_REVIEW",
)


def _of(column: str, table: dict, default) -> Column:
    return F.coalesce(F.create_map(*[F.lit(x) for kv in table.items() for x in kv])[F.col(column)], F.lit(default))


def resolve_types(items: DataFrame, candidates: DataFrame, registry: DataFrame) -> DataFrame:
    """(item_id, resolved_type, decision, confidence, conflict_types) of items (item_id, evidence_complete).

    Candidates (item_id, candidate_type, source, score) count by the priority of their source, then by score.  Different types
    that share the first place are a conflict.  A type of ``registry`` (type, generic) is resolved at :data:`ACCEPT` with
    complete evidence, a candidate for review at :data:`ASK`, and unsafe below; generic types and unknown ones are blocked.
    """
    rows = candidates.withColumn("priority", _of("source", TYPE_PRIORITY, 99))
    place = F.struct("priority", (-F.col("score")).alias("neg"))
    best = rows.groupBy("item_id").agg(F.min(place).alias("best"))
    top = rows.join(best, "item_id").where((F.col("priority") == F.col("best.priority")) & (-F.col("score") == F.col("best.neg")))
    top = top.groupBy("item_id").agg(F.array_sort(F.collect_set("candidate_type")).alias("types"), F.min("source").alias("source"), F.max("score").alias("confidence"))
    rows = items.join(top, "item_id", "left").withColumn("type", F.try_element_at("types", F.lit(1)))
    rows = rows.join(registry.select("type", "generic", F.lit(True).alias("known")), "type", "left")
    several = F.size("types") > 1
    decision = (
        F.when(F.col("types").isNull(), "NO_SAFE_TYPE").when(several, "CONFLICT").when(F.col("generic"), "BLOCKED_GENERIC_TYPE").when(F.col("known").isNull(), "NO_SAFE_TYPE")
        .when((F.col("confidence") >= ACCEPT) & F.col("evidence_complete"), _of("source", TYPE_DECISION, "HEURISTIC_RESOLVED")).when(F.col("confidence") >= ASK, "CANDIDATE_REVIEW").otherwise("NO_SAFE_TYPE")
    )
    rows = rows.withColumn("decision", decision)
    resolved = F.when(~F.col("decision").isin("NO_SAFE_TYPE", "CONFLICT", "BLOCKED_GENERIC_TYPE"), F.col("type"))
    none = F.array().cast("array<string>")
    return rows.select("item_id", resolved.alias("resolved_type"), "decision", F.coalesce("confidence", F.lit(0.0)).alias("confidence"), F.when(several, F.col("types")).otherwise(none).alias("conflict_types"))


def eligibility(candidates: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Candidates with status (ELIGIBLE, NEEDS_REVIEW or BLOCKED), blocking_reasons in the order of ``rules`` (reason: where it
    holds) and the action that a reviewer has to take; a condition that is null does not hold."""
    reasons = F.array_compact(F.array(*[F.when(holds, F.lit(reason)) for reason, holds in rules.items()]))
    rows = candidates.withColumn("blocking_reasons", F.array_distinct(reasons))
    hard = F.exists("blocking_reasons", lambda r: r.isin(*HARD_REASONS))
    status = F.when(F.size("blocking_reasons") == 0, "ELIGIBLE").when(hard, "BLOCKED").otherwise("NEEDS_REVIEW")
    versions = F.exists("blocking_reasons", lambda r: r.startswith("VERSION"))
    action = F.when(status == "BLOCKED", "FIX_BLOCKERS_BEFORE_REVIEW").when(versions, "VERSION_REVIEW_REQUIRED").otherwise("REVIEWER_APPROVAL_REQUIRED")
    return rows.withColumn("status", status).withColumn("reviewer_action", action)


def json_nodes(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, path, place, name, value, kind) of every value inside JSON texts, the whole one at ``$``.

    ``path`` names array places (``$.a[0].b``), ``place`` leaves them out (``$.a[].b``); ``value`` is JSON text.  Texts that
    are no JSON have no nodes.  One round a level of nesting, each written before the next reads it.
    """
    return _nodes(_roots(docs, key, text).where("value is not null"), key)


def _roots(docs: DataFrame, key: str, text: str) -> DataFrame:
    """The node at ``$`` of each text, written; its value is null where the text is no JSON."""
    rows = docs.select(F.col(key).alias("key"), F.lit("$").alias("path"), F.lit("$").alias("place"), F.lit(None).cast("string").alias("name"), F.to_json(F.try_parse_json(text)).alias("value"))
    return materialise(rows, "json-level")


def _nodes(level: DataFrame, key: str) -> DataFrame:
    spark, found = level.sparkSession, level
    while True:
        open_ = level.where(F.substring("value", 1, 1).isin("{", "[")).withColumn("v", F.parse_json("value"))
        open_.createOrReplaceTempView("tessera_json_level")
        inner = spark.sql("SELECT t.key, t.path, t.place, e.pos, e.key AS name, to_json(e.value) AS value FROM tessera_json_level t, LATERAL variant_explode(t.v) AS e")
        step = lambda c, at: F.when(F.col("name").isNull(), F.concat(c, F.lit("["), at, F.lit("]"))).otherwise(F.concat(F.col(c), F.lit("."), "name"))
        level = inner.select("key", step("path", F.col("pos").cast("string")).alias("path"), step("place", F.lit("")).alias("place"), "name", "value")
        level = materialise(level, "json-level")
        if level.isEmpty():
            break
        found = found.unionByName(level)
    first = F.substring("value", 1, 1)
    kind = F.when(first == "{", "object").when(first == "[", "array").when(first == '"', "string").when(first.isin("t", "f"), "boolean").when(first == "n", "null").otherwise("number")
    return found.withColumn("kind", kind).withColumnRenamed("key", key)


def json_faults(
    docs: DataFrame, key: str, text: str, required: dict[str, list[str]] | None = None, allowed: dict[str, list[str]] | None = None, banned: dict[str, list[str]] | None = None, kinds: dict[str, str] | None = None
) -> DataFrame:
    """(key, path, code): one row a fault of JSON texts against rules over places (see :func:`json_nodes`).

    ``required`` names the fields that each object at a place has (REQUIRED_KEY), ``allowed`` the values there
    (VALUE_NOT_ALLOWED), ``banned`` fields that appear nowhere below a place (BANNED_FIELD), ``kinds`` the kind of value there
    (WRONG_KIND).  A text that is no JSON has the one fault NOT_JSON.
    """
    roots = _roots(docs, key, text)
    nodes = _nodes(roots.where("value is not null"), key)
    row = lambda df, path, code: df.select(key, path.alias("path"), F.lit(code).alias("code"))
    bad = row(roots.where("value is null").withColumnRenamed("key", key), F.lit("$"), "NOT_JSON")
    for place, names in (required or {}).items():
        whole = nodes.where((F.col("place") == place) & (F.col("kind") == "object")).select(key, "path", F.explode(F.array(*map(F.lit, names))).alias("name"))
        path = F.concat("path", F.lit("."), "name").alias("path")
        wanted = whole.select(key, path)
        bad = bad.unionByName(row(wanted.join(nodes.where(F.col("name").isin(*names)).select(key, "path"), [key, "path"], "left_anti"), F.col("path"), "REQUIRED_KEY"))
    for place, values in (allowed or {}).items():
        text_of = F.btrim(F.col("value"), F.lit('"'))
        bad = bad.unionByName(row(nodes.where((F.col("place") == place) & ~text_of.isin(*values)), F.col("path"), "VALUE_NOT_ALLOWED"))
    for place, names in (banned or {}).items():
        bad = bad.unionByName(row(nodes.where(F.startswith("place", F.lit(place)) & F.col("name").isin(*names)), F.col("path"), "BANNED_FIELD"))
    for place, kind in (kinds or {}).items():
        bad = bad.unionByName(row(nodes.where((F.col("place") == place) & (F.col("kind") != kind)), F.col("path"), "WRONG_KIND"))
    return bad


def route(profiles: DataFrame) -> DataFrame:
    """Requirements with status, scenario, alternatives and reason, by the measures of their profile.

    Profiles have override (or null), evidence, novelty, new_objects, feature_coverage, object_coverage, code_coverage,
    local_change (0 to 1), n_targets, n_features, n_domains, n_impacts and n_paths.
    """
    c = F.col
    some = c("n_targets").between(1, 2)
    new = (c("novelty") >= 0.7) & (c("new_objects") >= 0.6)
    zero = new & (F.greatest("feature_coverage", "object_coverage", "code_coverage") <= 0.35)
    many = some & (c("object_coverage") >= 0.45) & ((c("n_features") > 1) | (c("n_domains") > 1)) & ((c("n_impacts") >= 3) | (c("n_paths") >= 2))
    local = some & (c("feature_coverage") >= 0.7) & (c("code_coverage") >= 0.65) & (c("n_features") <= 1) & (c("n_domains") <= 1) & (c("n_impacts") <= 2) & (c("local_change") >= 0.65)
    names = ("ZERO_TO_ONE", "ONE_TO_MANY", "ONE_TO_ONE_X")
    active = F.array_compact(F.array(*[F.when(s, F.lit(n)) for s, n in zip((zero, many, local), names)]))
    listed = lambda *n: F.array(*map(F.lit, n))
    rows = profiles.withColumn("active", active)
    one = F.size("active") == 1
    cases = [
        (c("override").isNotNull(), "MANUAL_OVERRIDE", c("override"), listed(), F.lit("manual_override_recorded")),
        (c("evidence") < 0.35, "INSUFFICIENT_EVIDENCE", None, listed(), F.lit("insufficient_evidence")),
        (new & many, "MIXED", None, listed(*names[:2]), F.lit("new_capability_and_broad_impact")),
        (one, "CONFIDENT", c("active")[0], listed(), F.concat(F.lower(c("active")[0]), F.lit("_signals_matched"))),
        (F.size("active") > 1, "AMBIGUOUS", None, c("active"), F.lit("multiple_non_exclusive_signals")),
        (F.lit(True), "AMBIGUOUS", None, listed(*names), F.lit("no_confident_signal")),
    ]
    found = F.lit(None)
    for holds, status, scenario, others, reason in reversed(cases):
        made = F.struct(F.lit(status).alias("status"), (scenario if scenario is not None else F.lit(None).cast("string")).alias("scenario"), others.cast("array<string>").alias("alternatives"), reason.alias("reason"))
        found = F.when(holds, made).otherwise(found)
    return rows.withColumn("r", found).select(*[x for x in profiles.columns], "r.*")


def triage(items: DataFrame, before: DataFrame, after: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Groups of versions with their category, and counts a category and in all.

    Items have group_key, object_key, has_evidence, supersedes (array), explicit, conflicting, latest, weak and status;
    ``before`` and ``after`` (group_key) are the groups under review by the old policy and the new one.
    """
    some = lambda c: F.bool_or(F.coalesce(c, F.lit(False)))
    g = items.groupBy("group_key").agg(
        F.count(F.lit(1)).alias("n_versions"), some(~F.col("has_evidence")).alias("bare"), some((F.size("supersedes") > 0) & ~F.col("explicit")).alias("unsafe"), some(F.col("explicit")).alias("explicit"),
        some(F.col("conflicting")).alias("conflicting"), F.count_if(F.col("latest")).alias("n_latest"), some(F.col("weak")).alias("weak"), some(F.col("status") == "CURRENT").alias("current"),
    )
    category = (
        F.when(F.col("bare"), "MISSING_EVIDENCE").when(F.col("unsafe"), "UNSAFE_SUPERSEDES_BLOCKED").when(F.col("explicit"), "EXPLICIT_SUPERSEDES").when(F.col("conflicting"), "CONFLICT_WITHOUT_SUPERSEDES")
        .when(F.col("n_latest") > 1, "TRUE_REVIEW_REQUIRED").when(F.col("weak"), "WEAK_VERSION_KEYWORD_ONLY").when((F.col("n_versions") > 1) & (F.col("n_latest") == 0), "MULTI_VERSION_UNKNOWN")
        .when((F.col("n_latest") == 1) | F.col("current"), "EXPLICIT_CURRENT").otherwise("SINGLETON_NO_CONFLICT")
    )
    mark = lambda df, name: df.select("group_key").distinct().withColumn(name, F.lit(True))
    g = g.withColumn("category", category).join(mark(before, "was"), "group_key", "left").join(mark(after, "is"), "group_key", "left")
    was, is_ = F.coalesce("was", F.lit(False)), F.coalesce("is", F.lit(False))
    safe = was & ~is_ & F.col("category").isin("SINGLETON_NO_CONFLICT", "EXPLICIT_CURRENT")
    rows = g.select("group_key", "n_versions", "category", was.alias("review_before"), is_.alias("review_after"), safe.alias("safe_to_reduce"))
    counts = rows.rollup("category").agg(F.count(F.lit(1)).alias("n"), F.count_if("review_before").alias("n_before"), F.count_if("review_after").alias("n_after"))
    return rows, counts.withColumn("category", F.coalesce("category", F.lit("all")))
