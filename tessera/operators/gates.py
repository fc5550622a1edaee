"""Quality gates as counts over rows of answers, citations and results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The largest ratios and the largest loss of recall that a release may have.
POLICY = {"query_p95_ratio": 2.5, "ingest_ratio": 4.0, "recall_regression": 0.02}


def counters(rows: DataFrame, **conditions: Column) -> DataFrame:
    """One row: how often each condition holds."""
    return rows.agg(*[F.count_if(c).alias(n) for n, c in conditions.items()])


def citations(claims: DataFrame, evidence: DataFrame) -> DataFrame:
    """One row: claims (evidence_id, supported), those whose evidence is not there, and those it does not support."""
    known = evidence.select("evidence_id").distinct().withColumn("__known", F.lit(True))
    rows = claims.join(known, "evidence_id", "left")
    return rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("__known").isNull()).alias("invalid"), F.count_if(~F.col("supported")).alias("unsupported"))


def term_identity(terms: DataFrame) -> DataFrame:
    """Aliases that stand for more than one identity."""
    return terms.groupBy("alias").agg(F.countDistinct("identity").alias("n_identities")).where("n_identities > 1")


def ab_comparison(results: DataFrame, margin: float) -> DataFrame:
    """(module, baseline, candidate, delta, label) of scores in two arms; without one arm the label is INCONCLUSIVE."""
    mean = lambda arm: F.avg(F.when(F.col("arm") == arm, F.col("score")))
    g = results.groupBy("module").agg(mean("baseline").alias("baseline"), mean("candidate").alias("candidate"))
    delta = F.col("candidate") - F.col("baseline")
    label = F.when(delta.isNull(), "INCONCLUSIVE").when(delta > margin, "IMPROVED").when(delta < -margin, "DEGRADED").otherwise("SAME")
    return g.select("module", "baseline", "candidate", delta.alias("delta"), label.alias("label"))


def coverage(wanted: DataFrame, present: DataFrame, by: str, key: str = "object_id") -> DataFrame:
    """(by, ratio, label): the share of wanted objects that are present."""
    known = present.select(key).distinct().withColumn("__known", F.lit(1))
    g = wanted.join(known, key, "left").groupBy(by).agg(F.avg(F.coalesce("__known", F.lit(0))).alias("ratio"))
    return g.withColumn("label", F.when(F.col("ratio") == 1, "FULL").when(F.col("ratio") == 0, "NONE").otherwise("PARTIAL"))


def performance(baseline: DataFrame, candidate: DataFrame) -> DataFrame:
    """One row: ratios of 95th percentiles and ingestion times (value, ingest_ms), and whether both keep to the policy."""
    one = lambda df, side: df.agg(F.percentile("value", 0.95).alias(f"p95_{side}"), F.sum("ingest_ms").alias(f"ingest_{side}"))
    both = one(baseline, "a").crossJoin(one(candidate, "b"))  # one row each
    p95, ingest = F.col("p95_b") / F.col("p95_a"), F.col("ingest_b") / F.col("ingest_a")
    return both.select(p95.alias("query_p95_ratio"), ingest.alias("ingest_ratio"), ((p95 <= POLICY["query_p95_ratio"]) & (ingest <= POLICY["ingest_ratio"])).alias("passed"))


#: Hop limits of path tasks, and the repair of each gate error.
HOP_LIMITS = {"FACT_QA": 2, "TRACEABILITY": 4, "IMPACT_ANALYSIS": 5, "VERSION_COMPARE": 3, "BACKGROUND": 2}
REPAIRS = {
    "MISSING_CITATION": "FIX_CITATION",
    "INVALID_CITATION": "FIX_CITATION",
    "UNSUPPORTED_FACT": "REMOVE_UNSUPPORTED_CLAIM",
    "UNSUPPORTED_PATH": "DOWNGRADE_TO_TENTATIVE",
    "VERSION_HARD_JUDGMENT": "ADD_VERSION_WARNING",
    "HISTORICAL_AS_CURRENT": "ADD_VERSION_WARNING",
    "UNSAFE_FACT_PROMOTION": "REMOVE_UNSUPPORTED_CLAIM",
    "MISSING_RELEVANT_DIMENSION": "ADD_MISSING_RELEVANT_DIMENSION",
    "DUPLICATE_IMPACT": "MERGE_DUPLICATE_IMPACT",
    "FALSE_POSITIVE_IMPACT": "REMOVE_IRRELEVANT_IMPACT",
    "INSUFFICIENT_EVIDENCE_NOT_REPORTED": "RETURN_INSUFFICIENT_EVIDENCE",
}


def fact_promotion(items: DataFrame, by: str) -> DataFrame:
    """Per answer: how many items (kind, certainty, is_impact) count as facts that must not, and whether none does.

    Issues and information are unsafe as facts of an answer whatever their certainty, and as impacts when confirmed or
    supported; candidates (in answers also versions under review) and generic finds are unsafe when confirmed.
    """
    kind, sure = F.col("kind"), F.col("certainty") == "CONFIRMED"
    stated = ~F.col("is_impact") | F.col("certainty").isin("CONFIRMED", "SUPPORTED")
    review = ~F.col("is_impact") & (kind == "VERSION_REVIEW_REQUIRED")
    rules = {
        "issue_as_fact": (kind == "ISSUE") & stated, "candidate_as_confirmed": ((kind == "CANDIDATE") | review) & sure, "info_only_as_fact": (kind == "INFO_ONLY") & stated,
        "generic_only_as_confirmed": (kind == "GENERIC_ONLY") & sure, "generic_ner_fact_hit": (kind == "GENERIC_NER") & sure,
    }
    out = items.groupBy(by).agg(*[F.count_if(c).alias(n) for n, c in rules.items()])
    return out.withColumn("passed", sum((F.col(n) for n in rules), F.lit(0)) == 0)


def impact_breadth(impacts: DataFrame, required: DataFrame, by: str, domains: list[str]) -> DataFrame:
    """Per result: repeated and false impacts (object_id, domain_code, kind, certainty, dimension, scope, has_evidence), the
    share of required dimensions (by, dimension) that factual impacts cover, and the share of impacts with evidence.
    An impact outside ``domains`` is false, and so is a confirmed one that is no fact."""
    false = ~F.coalesce(F.col("domain_code").isin(*domains), F.lit(False)) | ((F.col("kind") != "FACT") & (F.col("certainty") == "CONFIRMED"))
    main = F.col("scope").isin("direct", "indirect")
    counted = impacts.groupBy(by).agg(
        (F.count(F.lit(1)) - F.countDistinct("object_id")).alias("n_duplicates"), F.count_if(false).alias("n_false"), F.count_if(main).alias("__main"), F.count_if(main & F.col("has_evidence")).alias("__backed"),
    )
    seen = impacts.where("kind = 'FACT'").select(by, "dimension", F.lit(True).alias("__seen")).distinct()
    cover = required.join(seen, [by, "dimension"], "left").groupBy(by).agg(F.avg(F.col("__seen").isNotNull().cast("double")).alias("coverage"))
    ratio = F.when(F.col("__main") == 0, F.lit(1.0)).otherwise(F.col("__backed") / F.col("__main"))
    out = counted.join(cover, by, "left").select(by, "n_duplicates", "n_false", ratio.alias("evidence_ratio"), F.coalesce("coverage", F.lit(1.0)).alias("coverage"))
    return out.withColumn("passed", (F.col("n_duplicates") == 0) & (F.col("n_false") == 0) & (F.col("evidence_ratio") == 1) & (F.col("coverage") == 1))


def insufficient_evidence(answers: DataFrame) -> DataFrame:
    """Answers (n_citations, n_unsafe_warnings, resolution, status, safe) with the errors of a lack of evidence."""
    forced = (F.col("n_citations") == 0) & ~F.col("status").isin("INSUFFICIENT_EVIDENCE", "CONFLICTING_EVIDENCE")
    unsafe = (F.col("n_unsafe_warnings") > 0) & F.col("safe")
    unknown = F.coalesce(F.col("resolution") != "CONFIRMED_CURRENT", F.lit(False)) & (F.col("status") != "ANSWERED_WITH_VERSION_WARNING")
    return _with_errors(answers, INSUFFICIENT_EVIDENCE_NOT_REPORTED=forced, UNSAFE_CONTEXT_MARKED_SAFE=unsafe, MISSING_VERSION_WARNING=unknown)


def version_safety(answers: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    """Answers (resolution, n_warnings, safe, supersedes, n_supersedes_evidence) with errors of judgement about versions; facts
    (key, version_status, certainty) of former versions must not be confirmed."""
    former = facts.where(F.col("version_status").isin("HISTORICAL", "SUPERSEDED") & (F.col("certainty") == "CONFIRMED")).groupBy(key).agg(F.count(F.lit(1)).alias("n_former"))
    rows = answers.join(former, key, "left").withColumn("n_former", F.coalesce("n_former", F.lit(0)))
    hard = (F.coalesce("resolution", F.lit("CONFIRMED_CURRENT")) != "CONFIRMED_CURRENT") & (F.col("n_warnings") == 0) & F.col("safe")
    return _with_errors(rows, VERSION_HARD_JUDGMENT=hard, HISTORICAL_AS_CURRENT=F.col("n_former") > 0, UNSUPPORTED_SUPERSEDES=F.col("supersedes") & (F.col("n_supersedes_evidence") == 0))


def _with_errors(rows: DataFrame, **rules: Column) -> DataFrame:
    found = F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()])
    return rows.withColumn("errors", F.filter(found, lambda x: x.isNotNull())).withColumn("passed", F.size("errors") == 0)


def validate_paths(paths: DataFrame, task: str, max_hops: int | None = None) -> DataFrame:
    """Paths (dangling, hops, issue_edge, generic_only, version_conflict, n_evidence) with the first status that applies."""
    limit = HOP_LIMITS.get(task, 2) if max_hops is None else max_hops
    status = (
        F.when(F.col("dangling"), "DANGLING_PATH").when(F.col("hops") > limit, "INVALID_HOP_LIMIT").when(F.col("issue_edge"), "NOT_FACTUAL_ISSUE_EDGE")
        .when(F.col("generic_only"), "BACKGROUND_ONLY").when(F.col("version_conflict"), "TENTATIVE_VERSION_CONFLICT").when(F.col("n_evidence") == 0, "NOT_FACTUAL_MISSING_EVIDENCE").otherwise("FACTUAL")
    )
    return paths.withColumn("status", status)


def validate_candidates(candidates: DataFrame, allowed: list[str]) -> DataFrame:
    """Candidates (entity_type, has_evidence, has_span, feature_key, domain_code) with a status, a confidence and issues."""
    known = F.coalesce(F.col("entity_type").isin(*allowed), F.lit(False))
    review = F.col("entity_type") == "CandidateEntity"
    status = F.when(~F.col("has_evidence"), "MISSING_EVIDENCE").when(review, "REVIEW_REQUIRED").when(~known, "INVALID_TYPE").otherwise("VALID")
    confidence = F.when(~F.col("has_evidence"), 0.1).when(review, 0.5).when(~known, 0.2).otherwise(0.9)
    blank = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    issues = F.array(
        F.when(~F.col("has_evidence"), "MISSING_EVIDENCE"), F.when(F.col("has_evidence") & ~review & ~known, "INVALID_ENTITY_TYPE"), F.when(~F.col("has_span"), "SOURCE_SPAN_MISSING"),
        F.when(blank("feature_key"), "MISSING_FEATURE_KEY"), F.when(blank("domain_code"), "MISSING_DOMAIN_CODE"),
    )
    return candidates.withColumn("status", status).withColumn("confidence", confidence).withColumn("issues", F.filter(issues, lambda x: x.isNotNull()))


#: A keyword that names no relation type though it looks like one; others are lower-case words with underscores.
BARE_RELATIONS = ("contains",)
SNAKE_CASE = "^[a-z]+(_[a-z]+)+$"


def validate_relations(candidates: DataFrame, allowed: list[str], evidence_required: bool = True) -> DataFrame:
    """Candidates (keywords, relation_type, has_evidence, has_span, feature_key, domain_code) with their type, a status, a
    confidence and issues.

    The type is the first allowed one among the keywords, else ``CandidateRelation`` where they name it, else the candidate's
    own if that is one of these, else null.  Keywords are parted by white space, commas, semicolons and slashes, also wide ones.
    """
    words = F.split(F.coalesce("keywords", F.lit("")), r"[,，;；/\s]+")
    own = F.col("relation_type")
    named = F.get(F.filter(F.array(*map(F.lit, [*allowed, "CandidateRelation"])), lambda t: F.array_contains(words, t)), 0)
    rows = candidates.withColumn("relation_type", F.coalesce(named, F.when(own.isin(*allowed, "CandidateRelation"), own)))
    snake = F.exists(words, lambda w: w.rlike(SNAKE_CASE) | w.isin(*BARE_RELATIONS))
    bare = ~F.col("has_evidence") & F.lit(evidence_required)
    unsure = F.coalesce(own == "CandidateRelation", F.lit(False))
    status = F.when(bare, "MISSING_EVIDENCE").when(unsure | (own.isNull() & ~snake), "REVIEW_REQUIRED").when(own.isNull() | snake, "INVALID_TYPE").otherwise("VALID")
    confidence = F.element_at(F.create_map(*[F.lit(x) for pair in (("MISSING_EVIDENCE", 0.1), ("REVIEW_REQUIRED", 0.5), ("INVALID_TYPE", 0.2), ("VALID", 0.9)) for x in pair]), F.col("status"))
    blank = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    issues = F.array(
        F.when(bare, "MISSING_EVIDENCE"), F.when(~bare & own.isNull(), "INVALID_RELATION_TYPE"), F.when(snake, "SNAKE_CASE_RELATION"), F.when(~F.col("has_span"), "SOURCE_SPAN_MISSING"),
        F.when(blank("feature_key"), "MISSING_FEATURE_KEY"), F.when(blank("domain_code"), "MISSING_DOMAIN_CODE"),
    )
    return rows.withColumn("status", status).withColumn("confidence", confidence).withColumn("issues", F.filter(issues, lambda x: x.isNotNull()))


def repair_plan(errors: DataFrame, key: str, attempt: int, most: int = 2) -> DataFrame:
    """(key, gate, action, reason): one action for the errors (key, pos, gate, error) of each gate, the first of them as the
    reason; nothing once the attempts are used up."""
    known = F.create_map(*[F.lit(x) for pair in REPAIRS.items() for x in pair])
    rows = errors.where(F.lit(attempt < most)).withColumn("action", F.coalesce(known[F.col("error")], F.lit("RETURN_INSUFFICIENT_EVIDENCE")))
    return rows.groupBy(key, "gate", "action").agg(F.min_by("error", "pos").alias("reason"))
