"""Ordered operators: first-of-group, interleaving, budgets, quotas and score fusion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.sources.scratch import materialise

#: How much each retrieval channel counts in fusion, and its priority when duplicates meet.
CHANNEL_WEIGHTS = {
    "RAW_TEXT": 1.15,
    "PFSS_ENTITY": 1.25,
    "PFSS_RELATION": 1.35,
    "PFSS_PATH": 1.45,
    "GENERIC_GRAPH": 0.35,
    "ISSUE_SIDECAR": 0.0,
    "VERSION_CONTEXT": 0.0,
}
CHANNEL_PRIORITY = {
    "PFSS_PATH": 0,
    "PFSS_RELATION": 1,
    "PFSS_ENTITY": 2,
    "RAW_TEXT": 3,
    "VERSION_CONTEXT": 4,
    "ISSUE_SIDECAR": 5,
    "GENERIC_GRAPH": 6,
}
RANK_CONSTANT = 60.0
#: The rank of unranked candidates, points for hinted scopes, for doubtful versions and for missing evidence.
LAST_RANK, BONUS, DOUBT, BARE = 999, 0.002, 0.003, 0.004
SILENT_CHANNELS = ("ISSUE_SIDECAR", "VERSION_CONTEXT")
TRUSTED_CHANNELS = ("PFSS_ENTITY", "PFSS_RELATION", "PFSS_PATH")
DOUBTFUL_VERSIONS = ("CONFLICT", "UNKNOWN_CURRENT", "MULTIPLE_CURRENT_CONFLICT")


def _lookup(column: str, table: dict, default) -> Column:
    out = F.lit(default)
    for k, v in table.items():
        out = F.when(F.col(column) == k, F.lit(v)).otherwise(out)
    return out


def first_of(rows: DataFrame, keys: list[str], *order: Column | str) -> DataFrame:
    """The first row of each key in an order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def numbered(rows: DataFrame, name: str, *order: Column | str) -> DataFrame:
    """Rows with their number from 1 in an order, of any size: they are range-sorted and written once, so that each part's
    rows are counted and numbered by themselves."""
    parts = rows.orderBy(*order).withColumn("__part", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id())
    parts = materialise(parts, "sorted")
    counts = parts.groupBy("__part").agg(F.count(F.lit(1)).alias("n"), F.min("__at").alias("__low"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("__part", "__low", before.alias("__before"))  # a row for each part
    out = parts.join(F.broadcast(starts), "__part")
    return out.withColumn(name, F.col("__before") + F.col("__at") - F.col("__low") + 1).drop("__part", "__at", "__low", "__before")


def last_write(rows: DataFrame, keys: list[str], pos: str = "pos", *ties: Column | str) -> DataFrame:
    """The row of each key with the largest position; ``ties`` order rows of one position, of which the first counts."""
    return first_of(rows, keys, F.desc(pos), *ties)


def merge_ids(old: Column, new: Column) -> Column:
    """Ordered union of two id lists without blanks; the first occurrence counts."""
    return F.array_distinct(F.filter(F.concat(old, new), lambda x: x.isNotNull() & (x != "")))


def limit_ids(ids: Column, limit: int, method: str = "FIFO") -> Column:
    """The head of a list with KEEP, else its tail; nothing at a limit of 0 or less."""
    if limit <= 0:
        return F.array().cast("array<string>")
    tail = F.slice(ids, F.greatest(F.size(ids) - limit, F.lit(0)) + 1, F.lit(limit))
    return F.slice(ids, 1, limit) if method == "KEEP" else tail


def subtract_ids(ids: Column, gone: Column) -> Column:
    """A list without some ids and without blanks; repeated ids stay repeated."""
    return F.filter(ids, lambda x: (x != "") & ~F.array_contains(gone, x))


def id_delta(full: Column, old: Column, new: Column) -> Column:
    """A list less what left a source's ids, then what came to them in its order."""
    left = F.array_except(old, new)
    kept = F.filter(full, lambda x: ~F.array_contains(left, x))
    return F.array_distinct(F.concat(kept, F.array_except(new, old)))


def interleave(sources: list[DataFrame], key: str, pos: str = "pos") -> DataFrame:
    """Lists dealt in turns by position; a key counts where it comes first.  Adds ``turn``, the place in the result."""
    rows = None
    for i, s in enumerate(sources):
        one = s.withColumn("__source", F.lit(i))
        rows = one if rows is None else rows.unionByName(one, allowMissingColumns=True)
    once = first_of(rows, [key], pos, "__source")
    return once.withColumn("turn", F.row_number().over(Window.orderBy(pos, "__source"))).drop("__source")


def token_budget(rows: DataFrame, most: int, tokens: str = "tokens", order: str = "pos", by: list[str] | None = None) -> DataFrame:
    """The longest prefix whose tokens fit a budget; rows after the first that does not fit never come back in."""
    w = Window.partitionBy(*(by or [])).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("running", F.sum(tokens).over(w)).where(F.col("running") <= most)


def polled_quota(n: DataFrame, most: int, least: int, pos: str = "pos") -> DataFrame:
    """How many chunks each of a ranked list of items may give: from ``most`` down to ``least``, halves to even."""
    w = Window.partitionBy()
    total = F.count(F.lit(1)).over(w)
    rank = F.row_number().over(Window.orderBy(pos)) - 1
    share = F.lit(float(most)) - rank * (F.lit(float(most - least)) / F.greatest(total - 1, F.lit(1)))
    return n.withColumn("quota", F.when(total == 1, F.lit(most)).otherwise(F.bround(share)).cast("int"))


def scale_channels(candidates: DataFrame) -> DataFrame:
    """Add normalized_score: the min-max score within each channel (1 without a span).

    Spans are aggregated, a row a channel, and joined: no task holds a whole channel.
    """
    spans = candidates.groupBy(F.col("channel").alias("__channel")).agg(F.min("raw_score").alias("__least"), F.max("raw_score").alias("__most"))
    rows = candidates.join(F.broadcast(spans), F.col("channel").eqNullSafe(F.col("__channel")))  # one row a channel
    score = F.when(F.col("__most") == F.col("__least"), F.lit(1.0)).otherwise((F.col("raw_score") - F.col("__least")) / (F.col("__most") - F.col("__least")))
    return rows.withColumn("normalized_score", score).drop("__channel", "__least", "__most")


def normalize_channels(candidates: DataFrame) -> DataFrame:
    """Add channel_rank and normalized_score: the place and the min-max score within each channel.

    Places come from one range sort over all channels, less the rows of the channels before, so a channel of any size is
    sorted in parts.
    """
    rows = numbered(candidates, "__place", "channel", F.desc("raw_score"), "candidate_id")
    spans = rows.groupBy(F.col("channel").alias("__channel")).agg(F.min("__place").alias("__first"), F.min("raw_score").alias("__least"), F.max("raw_score").alias("__most"))
    rows = rows.join(F.broadcast(spans), F.col("channel").eqNullSafe(F.col("__channel")))  # one row a channel
    rows = rows.withColumn("channel_rank", (F.col("__place") - F.col("__first") + 1).cast("int"))
    score = F.when(F.col("__most") == F.col("__least"), F.lit(1.0)).otherwise((F.col("raw_score") - F.col("__least")) / (F.col("__most") - F.col("__least")))
    return rows.withColumn("normalized_score", score).drop("__place", "__first", "__channel", "__least", "__most")


def deduplicate_channels(candidates: DataFrame, key: str = "dedup_key") -> DataFrame:
    """One candidate a key: by the channel's priority, then the higher score, then the id."""
    return first_of(candidates, [key], _lookup("channel", CHANNEL_PRIORITY, 99), F.desc("normalized_score"), "candidate_id")


def fuse(candidates: DataFrame, domains: list[str], features: list[str]) -> DataFrame:
    """Add fused_score: weighted reciprocal rank with small bonuses for hinted scopes and penalties for doubt."""
    channel, status = F.col("channel"), F.col("version_status")
    weight = F.when(channel.isin(*SILENT_CHANNELS), F.lit(0.0)).otherwise(F.col("factual_weight"))
    score = _lookup("channel", CHANNEL_WEIGHTS, 0.1) * weight * (1.0 / (F.lit(RANK_CONSTANT) + F.coalesce("channel_rank", F.lit(LAST_RANK))))
    rules = (
        (F.col("domain_code").isin(domains), BONUS), (F.col("feature_key").isin(features), BONUS), (status.isin(*DOUBTFUL_VERSIONS), -DOUBT),
        (~F.col("has_evidence") & channel.isin(*TRUSTED_CHANNELS), -BARE),
    )
    for holds, points in rules:
        score = score + F.when(F.coalesce(holds, F.lit(False)), points).otherwise(0.0)
    return candidates.withColumn("fused_score", F.round(score, 9))


def fallback(candidates: DataFrame, strict: bool = False) -> DataFrame:
    """One row: which kind of answer the candidates (channel, has_evidence, version_status, factual_path) allow."""
    any_ = lambda c: F.coalesce(F.bool_or(c), F.lit(False))
    raw = F.col("channel") == "RAW_TEXT"
    flags = candidates.agg(
        F.count(F.lit(1)).alias("n"), any_(raw).alias("raw"), any_(raw | F.col("has_evidence")).alias("evidence"), any_(F.col("channel").startswith("PFSS")).alias("trusted"),
        any_(F.col("channel") == "GENERIC_GRAPH").alias("generic"), any_(F.col("channel").isin("ISSUE_SIDECAR", "VERSION_CONTEXT")).alias("issue"),
        any_(F.col("factual_path")).alias("path"), any_(F.col("version_status").isin("CONFLICT", "UNKNOWN_CURRENT", "MULTIPLE_CURRENT_CONFLICT")).alias("warned"),
    )
    status = (
        F.when(F.col("n") == 0, F.lit("STRICT_SCOPE_EMPTY" if strict else "INSUFFICIENT_EVIDENCE"))
        .when(F.expr("trusted and evidence and path and not warned"), "HYBRID_EVIDENCE_READY")
        .when(F.expr("trusted and warned"), "PFSS_WITH_VERSION_WARNING")
        .when(F.expr("raw and not trusted"), "TEXT_ONLY_FALLBACK")
        .when(F.expr("issue and not trusted and not raw"), "ISSUE_ONLY")
        .when(F.expr("generic and not trusted and not raw"), "GENERIC_ONLY_LOW_TRUST")
        .otherwise("INSUFFICIENT_EVIDENCE")
    )
    return flags.select(status.alias("status"), "n")


def evidence_first(candidates: DataFrame, most: int) -> DataFrame:
    """The first ``most`` candidates: those with evidence before those without, by score, then id."""
    return candidates.orderBy(F.desc("has_evidence"), F.desc("fused_score"), "candidate_id").limit(most)


def context_pack(candidates: DataFrame, most: int) -> DataFrame:
    """Candidates with the part of a trusted context that they go to: factual, dropped, generic or issue.

    The factual part is cut by :func:`evidence_first`.
    """
    part = F.when(F.col("channel").isin("ISSUE_SIDECAR", "VERSION_CONTEXT"), "issue").when(F.col("channel") == "GENERIC_GRAPH", "generic").otherwise("factual")
    rows = candidates.withColumn("part", part)
    kept = evidence_first(rows.where("part = 'factual'"), most).select("candidate_id", F.lit(True).alias("__kept"))
    rows = rows.join(F.broadcast(kept), "candidate_id", "left")  # at most ``most`` rows
    return rows.withColumn("part", F.when((F.col("part") == "factual") & F.col("__kept").isNull(), "dropped").otherwise(F.col("part"))).drop("__kept")


def sequence_ids(rows: DataFrame, order: str, prefix: str = "DC") -> DataFrame:
    """Rows of a result list with the id ``prefix`` and their place from 1."""
    place = F.row_number().over(Window.orderBy(order))  # a list that a limit has cut
    return rows.withColumn("id", F.concat(F.lit(prefix), place.cast("string")))
