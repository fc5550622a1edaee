"""Version-aware retrieval: which member of a version group is current, and how candidates rank."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.joins import valid_at

#: What each fact adds to a version candidate's score, or takes from it.
WEIGHTS = {
    "semantic": 1.0, "evidence": 1.0, "active": 0.5, "current_intent": 3.0, "latest": 1.5, "valid_time": 2.0, "issue": -1.5, "missing_evidence": -2.0,
    "unknown": -0.75, "historical_current": -0.75, "historical_intent": 2.0, "compare": 1.0, "migration": 1.0, "deleted": -2.0,
}
STATUS_WEIGHTS = {"CURRENT": 2.0, "HISTORICAL": 0.2, "SUPERSEDED": 0.2, "UNKNOWN": -0.2, "REVIEWREQUIRED": -1.0}


def status() -> Column:
    return F.upper(F.replace(F.coalesce("version_status", F.lit("UNKNOWN")), F.lit("_"), F.lit("")))


def resolve_current(candidates: DataFrame) -> DataFrame:
    """(version_group_key, resolution, current_member): a ladder of decisions for each group.

    Members must be active and not deleted; then missing evidence, open issues, several or one explicit current, several or
    one latest, and at last the end of a confirmed chain of replacements decide.
    """
    c = candidates.withColumn("status", status()).withColumn("usable", F.col("active") & ~F.col("deleted"))
    member = F.col("version_member_id")
    u = F.col("usable")
    g = c.groupBy("version_group_key").agg(
        F.count_if(u).alias("n"),
        F.count_if(u & ~F.col("has_evidence")).alias("bare"),
        F.count_if(u & (F.col("n_issues") > 0)).alias("issues"),
        F.count_if(u & (F.col("status") == "CURRENT")).alias("n_current"),
        F.min(F.when(u & (F.col("status") == "CURRENT"), member)).alias("the_current"),
        F.count_if(u & F.col("latest_flag")).alias("n_latest"),
        F.min(F.when(u & F.col("latest_flag"), member)).alias("the_latest"),
    )
    use = c.where("usable")
    links = use.where("supersedes_member_id is not null").select("version_group_key", F.col("supersedes_member_id").alias("old"), "review_decision")
    known = use.select("version_group_key", F.col("version_member_id").alias("old"), F.lit(True).alias("known"))
    chain = links.join(known, ["version_group_key", "old"], "left").groupBy("version_group_key").agg(
        F.count(F.lit(1)).alias("n_links"), F.count_if(F.col("known").isNull()).alias("n_lost"), F.count_if(~F.coalesce(F.col("review_decision").isin("CONFIRMED", "CONFIRMED_SUPERSEDES"), F.lit(False))).alias("n_open")
    )
    ends = use.join(links.select("version_group_key", F.col("old").alias("version_member_id")).distinct(), ["version_group_key", "version_member_id"], "left_anti")
    ends = ends.groupBy("version_group_key").agg(F.count(F.lit(1)).alias("n_ends"), F.min("version_member_id").alias("the_end"))
    g = g.join(chain, "version_group_key", "left").join(ends, "version_group_key", "left")
    has_chain = F.coalesce(F.col("n_links"), F.lit(0)) > 0
    sound = has_chain & (F.col("n_lost") == 0) & (F.col("n_open") == 0) & (F.coalesce("n_ends", F.lit(0)) == 1)
    resolution = (
        F.when(F.col("n") == 0, "NO_CONFIRMED_CURRENT").when(F.col("bare") > 0, "NO_CONFIRMED_CURRENT").when(F.col("issues") > 0, "VERSION_REVIEW_REQUIRED")
        .when(F.col("n_current") > 1, "MULTIPLE_CURRENT_CONFLICT").when(F.col("n_current") == 1, "CONFIRMED_CURRENT")
        .when(F.col("n_latest") > 1, "MULTIPLE_LATEST_CONFLICT").when(F.col("n_latest") == 1, "CONFIRMED_CURRENT")
        .when(sound, "CONFIRMED_CURRENT").when(has_chain, "SUPERSEDES_CHAIN_CONFLICT").otherwise("NO_CONFIRMED_CURRENT")
    )
    chosen = F.when(F.col("n_current") == 1, F.col("the_current")).when(F.col("n_latest") == 1, F.col("the_latest")).otherwise(F.col("the_end"))
    return g.select("version_group_key", resolution.alias("resolution"), chosen.alias("chosen")).select(
        "version_group_key", "resolution", F.when(F.col("resolution") == "CONFIRMED_CURRENT", F.col("chosen")).alias("current_member")
    )


def resolve_as_of(candidates: DataFrame, at: str) -> DataFrame:
    """(version_group_key, resolution, member): the one active member whose validity holds a time."""
    c = candidates.withColumn("hit", F.col("active") & ~F.col("deleted") & valid_at(F.lit(at)))
    g = c.groupBy("version_group_key").agg(F.count_if("hit").alias("n"), F.min(F.when(F.col("hit"), F.col("version_member_id"))).alias("m"), F.bool_and(F.col("has_evidence") | ~F.col("hit")).alias("ok"))
    resolution = F.when(F.col("n") > 1, "VALID_TIME_OVERLAP").when((F.col("n") == 1) & F.col("ok"), "AS_OF_MATCH").otherwise("AS_OF_NO_MATCH")
    return g.select("version_group_key", resolution.alias("resolution"), F.when((F.col("n") == 1) & F.col("ok"), F.col("m")).alias("member"))


def rank(candidates: DataFrame, intent: str, current: DataFrame, at: str | None = None) -> DataFrame:
    """Add score (six decimals): relevance and evidence, then what the intent and the state of each candidate add."""
    w = WEIGHTS
    c = candidates.join(current.select("version_group_key", "current_member"), "version_group_key", "left").withColumn("status", status())
    add = lambda cond, v: F.when(F.coalesce(cond, F.lit(False)), F.lit(v)).otherwise(0.0)
    score = F.col("semantic_relevance_score") * w["semantic"] + F.col("evidence_quality_score") * w["evidence"] + add(F.col("active"), w["active"])
    by_status = F.lit(STATUS_WEIGHTS["UNKNOWN"])
    for k, v in STATUS_WEIGHTS.items():
        by_status = F.when(F.col("status") == k, F.lit(v)).otherwise(by_status)
    old = F.col("status").isin("HISTORICAL", "SUPERSEDED", "DEPRECATED")
    score = score + by_status + add(F.col("latest_flag"), w["latest"])
    if intent in ("CURRENT", "UNSPECIFIED", "AS_OF_TIME"):
        score = score + add(F.col("current_member") == F.col("version_member_id"), w["current_intent"])
    if intent == "HISTORICAL":
        score = score + add(old, w["historical_intent"])
    if intent == "CURRENT":
        score = score + add(old, w["historical_current"])
    if intent in ("COMPARE", "MIGRATION"):
        score = score + F.lit(w["compare"])
    if intent == "AS_OF_TIME" and at:
        score = score + add(valid_at(F.lit(at)), w["valid_time"])
    score = score + add(~F.col("has_evidence"), w["missing_evidence"]) + add(F.col("n_issues") > 0, w["issue"])
    score = score + add(F.col("status").isin("UNKNOWN", "REVIEWREQUIRED"), w["unknown"]) + add(F.col("document_deleted"), w["deleted"])
    return c.withColumn("score", F.round(score, 6)).drop("current_member")


def select_by_intent(ranked: DataFrame, intent: str) -> DataFrame:
    """The candidates of each group that an intent is answered with, best first."""
    from pyspark.sql import Window

    w = Window.partitionBy("version_group_key").orderBy(F.desc("score"), "version_member_id")
    rows = ranked.withColumn("place", F.row_number().over(w))
    if intent == "MIGRATION":
        bucket = F.when(F.col("status") == "CURRENT", "current").when(F.col("status").isin("HISTORICAL", "SUPERSEDED", "DEPRECATED"), "historical").otherwise("uncertain")
        v = Window.partitionBy("version_group_key", "bucket").orderBy("place")
        rows = rows.withColumn("bucket", bucket).withColumn("nth", F.row_number().over(v))
        return rows.where("nth <= if(bucket = 'current', 1, 2)").drop("bucket", "nth")
    return rows.where(F.col("place") <= {"CURRENT": 1, "COMPARE": 3}.get(intent, 2))


#: Terms of evidence that says what a version replaces, terms that say no more than that something changed, and
#: terms that contradict each other between two versions.
REPLACING = (
    "supersedes",
    "replaces",
    "replace",
    "替代",
    "替换",
    "废弃旧规则",
    "覆盖旧规则",
    "本规则覆盖",
)
CHANGED = (
    "新增",
    "优化",
    "调整",
    "变更",
    "更新",
    "废弃",
    "new",
    "optimize",
    "adjust",
    "changed",
    "update",
    "updated",
    "deprecated",
)
OPPOSITES = (
    ("editable", "readonly"),
    ("editable", "read-only"),
    ("can edit", "cannot edit"),
    ("generate", "not generate"),
    ("生成", "不生成"),
    ("可修改", "不可修改"),
    ("只读", "可编辑"),
    ("yes", "no"),
)


def version_signals(items: DataFrame) -> DataFrame:
    """Items (group_key, object_key, evidence_text, rule_text, supersedes, ...) with ``explicit``, ``weak``, ``conflicting``
    and ``opponent``.

    Items of a group conflict where one rule text has a term and another, different one has its opposite.  For each pair of
    terms a group keeps the first and the last text on either side with its key, so an item finds an opponent without meeting
    the others; the opponent is the item with the smallest text, or with the largest where that is the item's own.
    """
    has = lambda c, words: F.coalesce(F.exists(F.array(*map(F.lit, words)), lambda t: F.contains(F.lower(c), t)), F.lit(False))
    rows = items.withColumn("explicit", has("evidence_text", REPLACING)).withColumn("weak", has("evidence_text", CHANGED) & ~F.col("explicit"))
    rule = F.lower(F.coalesce("rule_text", F.lit("")))
    own = F.struct(rule.alias("text"), F.col("object_key").alias("key"))
    sides = []
    for i, (a, b) in enumerate(OPPOSITES):
        for side, term in ((0, a), (1, b)):
            held = F.when(F.contains(rule, F.lit(term)), own)
            sides += [F.min(held).alias(f"lo_{i}_{side}"), F.max(held).alias(f"hi_{i}_{side}")]
    rows = rows.join(rows.groupBy("group_key").agg(*sides), "group_key")
    found = []
    for i, (a, b) in enumerate(OPPOSITES):
        for side, term in ((0, a), (1, b)):
            low, high = F.col(f"lo_{i}_{1 - side}"), F.col(f"hi_{i}_{1 - side}")
            other = F.when(low["text"] != rule, low["key"]).when(high["text"] != rule, high["key"])
            found.append(F.when(F.contains(rule, F.lit(term)), other))
    rows = rows.withColumn("opponent", F.coalesce(*found))
    return rows.select(*items.columns, "explicit", "weak", F.col("opponent").isNotNull().alias("conflicting"), "opponent")


def version_relations(items: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Relations (src, tgt, relation, reason), issues (object_key, code) and coverage (one row) of versioned objects.

    Items have group_key, object_key, version, rule_text, evidence_text, has_evidence, latest, status and supersedes (array of
    versions of the group).  Items without a group or evidence are issues and nothing else.  HAS_VERSION joins every other
    object to its version; SUPERSEDES needs evidence that says so, else it is an issue; VERSION_CONFLICT joins a version to
    one that contradicts it (see :func:`version_signals`); VERSION_REVIEW_REQUIRED marks versions of groups with several
    latest ones or none, with weak terms alone, or of unknown status, and those that conflict.  Everything is counted in
    groups, so a group costs as much as it has rows.
    """
    code = F.when(F.coalesce("group_key", F.lit("")) == "", "MISSING_VERSION_GROUP_KEY").when(~F.coalesce("has_evidence", F.lit(False)), "MISSING_VERSION_EVIDENCE")
    marked = items.withColumn("code", code)
    fit = version_signals(marked.where("code is null").drop("code"))
    n_super = F.size(F.coalesce("supersedes", F.array().cast("array<string>")))
    g = fit.groupBy("group_key").agg(F.count(F.lit(1)).alias("n"), F.count_if("latest").alias("n_latest"), F.sum(n_super).alias("n_super"))
    rows = fit.join(g, "group_key").withColumn("id", F.concat_ws("@", "group_key", "version"))
    one = lambda df, src, tgt, relation, reason: df.select(src.alias("src"), tgt.alias("tgt"), F.lit(relation).alias("relation"), reason.alias("reason"))
    own, at = F.col("object_key"), F.col("id")
    out = one(rows, own, at, "HAS_VERSION", F.lit("VERSION"))
    replaced = rows.withColumn("old", F.explode("supersedes"))
    out = out.unionByName(one(replaced.where("explicit"), at, F.concat_ws("@", "group_key", "old"), "SUPERSEDES", F.lit("EXPLICIT_SUPERSEDES_EVIDENCE")))
    status = F.coalesce("status", F.lit("UNKNOWN"))
    unknown = status.isin("UNKNOWN", "REVIEW_REQUIRED") & (n_super == 0) & ~((F.col("n") == 1) & (status == "UNKNOWN"))
    reason = (
        F.when(F.col("n_latest") > 1, "MULTIPLE_LATEST_FLAGS").when(F.col("weak"), "WEAK_VERSION_KEYWORD_ONLY").when((F.col("n") > 1) & (F.col("n_latest") == 0) & (F.col("n_super") == 0), "MULTI_VERSION_UNKNOWN")
        .when(F.col("conflicting"), "CONFLICT_WITHOUT_SUPERSEDES").when(unknown, "MISSING_EXPLICIT_VERSION_STATUS")
    )
    out = out.unionByName(one(rows.withColumn("why", reason).where("why is not null"), own, at, "VERSION_REVIEW_REQUIRED", F.col("why")))
    out = out.unionByName(one(rows.where("conflicting"), own, F.col("opponent"), "VERSION_CONFLICT", F.lit("CONFLICT_WITHOUT_SUPERSEDES"))).distinct()
    issues = marked.where("code is not null").select("object_key", "code").unionByName(replaced.where("not explicit").select("object_key", F.lit("UNSAFE_SUPERSEDES_BLOCKED").alias("code")))
    n_items = items.agg(F.count(F.lit(1)).alias("n_objects"))
    counts = out.agg(*[F.count_if(F.col("relation") == r).alias(f"n_{r.lower()}") for r in ("HAS_VERSION", "SUPERSEDES", "VERSION_CONFLICT", "VERSION_REVIEW_REQUIRED")])
    faults = issues.agg(*[F.count_if(F.col("code") == c).alias(f"n_{c.lower()}") for c in ("MISSING_VERSION_GROUP_KEY", "MISSING_VERSION_EVIDENCE", "UNSAFE_SUPERSEDES_BLOCKED")])
    coverage = n_items.crossJoin(counts).crossJoin(faults)  # one row each
    passed = (F.col("n_missing_version_group_key") == 0) & (F.col("n_missing_version_evidence") == 0)
    return out, issues, coverage.withColumn("passed", passed)
