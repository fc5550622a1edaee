"""Grouped summaries: merges of entities and relations, counts, references, retrieval measures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.ids import high, low
from tessera.operators.lookups import STATUSES


def status_counts(docs: DataFrame, total: bool = False) -> DataFrame:
    """(status, n) for every status, also those without rows; with ``total`` also a row ``all``."""
    spark = docs.sparkSession
    names = spark.createDataFrame([(s,) for s in STATUSES], "status string")
    found = docs.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    out = F.broadcast(names).join(found, "status", "left").select("status", F.coalesce("n", F.lit(0)).alias("n"))
    return out.unionByName(docs.agg(F.count(F.lit(1)).alias("n")).select(F.lit("all").alias("status"), "n")) if total else out


def majority(fragments: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """(key, value) with the commonest value of each key; of equally common ones the one seen first."""
    counted = fragments.groupBy(key, value).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("seen"))
    return counted.groupBy(key).agg(F.min_by(value, F.struct(-F.col("n"), F.col("seen"))).alias(value))


def ordered_distinct(value: Column, order: Column) -> Column:
    """An aggregate: different values in the order in which they were first seen."""
    return F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), value.alias("v")))), lambda x: x["v"])


def merge_entities(fragments: DataFrame, cap: int = 300, keep: str = "FIFO") -> DataFrame:
    """Entity fragments (entity, entity_type, description, source_id, pos) as one row an entity.

    The commonest type counts (first seen wins ties); different descriptions are kept in order; source ids are capped: the
    head with KEEP, else the tail, none at a cap of 0 or less.
    """
    types = majority(fragments, "entity", "entity_type", "pos")
    ids = fragments.groupBy("entity", "source_id").agg(F.min("pos").alias("pos"))
    ids = capped_ids(ids, "entity", cap, keep)
    texts = fragments.where(F.col("description") != "").groupBy("entity", "description").agg(F.min("pos").alias("pos"))
    texts = texts.groupBy("entity").agg(ordered_distinct(F.col("description"), F.col("pos")).alias("descriptions"))
    sources = ids.groupBy("entity").agg(ordered_distinct(F.col("source_id"), F.col("pos")).alias("source_ids"))
    return types.join(sources, "entity", "left").join(texts, "entity", "left")


def capped_ids(ids: DataFrame, key: str, cap: int, keep: str = "FIFO") -> DataFrame:
    """The first (KEEP) or last (otherwise) ``cap`` rows of each key in the order of ``pos``, then of ``source_id``."""
    w = Window.partitionBy(key).orderBy(*([F.asc("pos"), F.asc("source_id")] if keep == "KEEP" else [F.desc("pos"), F.desc("source_id")]))
    return ids.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= cap).drop("__n")


def merge_relations(fragments: DataFrame) -> DataFrame:
    """Relation fragments (src, tgt, weight, keywords, source_id) as one row an undirected pair.

    Weights add up, keywords are split at commas, sorted and joined once each; fragments are counted.
    """
    pairs = fragments.select(low("src", "tgt").alias("src"), high("src", "tgt").alias("tgt"), "weight", "keywords")
    # equal keyword texts fall together before they are split, so one grouping does
    merged = pairs.groupBy("src", "tgt").agg(F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("n_fragments"), F.collect_set("keywords").alias("k"))
    words = F.filter(F.flatten(F.transform("k", lambda x: F.transform(F.split(x, ","), lambda y: F.trim(y)))), lambda x: x != "")
    return merged.select("src", "tgt", "weight", F.array_join(F.array_sort(F.array_distinct(words)), ",").alias("keywords"), "n_fragments")


def merge_attributes(rows: DataFrame, key: str, column: str, strategy: str, order: str, sep: str = "<SEP>") -> DataFrame:
    """One value a key by a strategy: concatenate, keep_first, keep_last, join_unique, join_unique_comma or max."""
    c = F.col(column)
    some = rows.where(c.isNotNull() & (c.cast("string") != ""))
    if strategy == "max":
        return some.groupBy(key).agg(F.max(c.cast("double")).alias(column))
    if strategy == "keep_first":
        return some.groupBy(key).agg(F.min_by(column, order).alias(column))
    if strategy == "keep_last":
        return some.groupBy(key).agg(F.max_by(column, order).alias(column))
    if strategy == "concatenate":
        return some.groupBy(key).agg(F.array_join(ordered_distinct(c, F.col(order)), "\n\n").alias(column))
    mark = "," if strategy == "join_unique_comma" else sep
    parts = some.select(key, order, F.posexplode(F.split(c, mark)).alias("p", "v")).withColumn("v", F.trim("v")).where("v <> ''")
    once = parts.groupBy(key, "v").agg(F.min(F.struct(order, "p")).alias("o"))
    if strategy == "join_unique_comma":
        return once.groupBy(key).agg(F.array_join(F.array_sort(F.collect_list("v")), ",").alias(column))
    return once.groupBy(key).agg(F.array_join(ordered_distinct(F.col("v"), F.col("o")), sep).alias(column))


def merged_value(column: str, kind: str, strategy: str, order: Column, sep: str = "<SEP>") -> Column:
    """An aggregate: one value by a strategy of :func:`merge_attributes`; arrays become the union of their entries in order.

    Meant for groups of a few rows, whose values it holds.
    """
    c = F.col(column)
    some = F.when(c.isNotNull() & ((c.cast("string") != "") if not kind.startswith("array") else F.lit(True)), F.struct(order.alias("o"), c.alias("v")))
    values = F.transform(F.array_sort(F.collect_list(some)), lambda x: x["v"])
    if kind.startswith("array<string"):
        return F.array_distinct(F.flatten(values))
    if strategy == "max" and kind not in ("string", "boolean") and not kind.startswith("array"):
        return F.max(c)
    if kind != "string" or strategy in ("keep_first", "keep_last"):
        return F.try_element_at(values, F.lit(-1 if strategy == "keep_last" else 1))
    if strategy == "concatenate":
        return F.array_join(F.array_distinct(values), "\n\n")
    mark = "," if strategy == "join_unique_comma" else sep
    parts = F.filter(F.flatten(F.transform(values, lambda v: F.transform(F.split(v, mark), lambda y: F.trim(y)))), lambda x: x != "")
    return F.array_join(F.array_sort(F.array_distinct(parts)), ",") if strategy == "join_unique_comma" else F.array_join(F.array_distinct(parts), sep)


def references(chunks: DataFrame, path: str = "file_path", pos: str = "pos") -> DataFrame:
    """(file_path, reference_id): paths by frequency, then by where they come first; empty and unknown ones have none."""
    known = chunks.where(F.col(path).isNotNull() & ~F.col(path).isin("", "unknown_source"))
    counted = known.groupBy(path).agg(F.count(F.lit(1)).alias("n"), F.min(pos).alias("first"))
    w = Window.orderBy(F.desc("n"), "first")  # as many rows as a result list has files
    return counted.withColumn("reference_id", F.row_number().over(w).cast("string")).select(path, "reference_id", "n")


def rerank_documents(scores: DataFrame, how: str = "max") -> DataFrame:
    """(doc, score): the chunk scores (doc, pos, score) of each document as one; unknown ways count as max."""
    agg = {"mean": F.avg("score"), "first": F.min_by("score", "pos")}.get(how, F.max("score"))
    return scores.where("score is not null").groupBy("doc").agg(agg.alias("score"))


def document_frequencies(tokens: DataFrame, n_docs: int) -> DataFrame:
    """(token, idf) of rows (doc, token): ln((n + 1) / (df + 1)) + 1."""
    df = tokens.groupBy("token").agg(F.countDistinct("doc").alias("df"))
    return df.select("token", (F.log((F.lit(float(n_docs)) + 1) / (F.col("df") + 1)) + 1).alias("idf"))


def retrieval_summary(results: DataFrame, k: int) -> DataFrame:
    """Mean recall at k and reciprocal rank, and counts of full recall and of none, of rows (expected, ranked)."""
    hit = F.size(F.array_intersect("expected", F.slice("ranked", 1, k)))
    recall = hit / F.size("expected")
    first = F.expr("array_min(filter(transform(ranked, (x, i) -> if(array_contains(expected, x), i + 1, null)), x -> x is not null))")
    rows = results.select(recall.alias("recall"), F.coalesce(1 / first, F.lit(0.0)).alias("rr"))
    return rows.agg(
        F.avg("recall").alias("recall_at_k"), F.avg("rr").alias("mrr"), F.count_if(F.col("recall") == 1).alias("n_full"), F.count_if(F.col("rr") == 0).alias("n_none")
    )


def benchmark_statistics(results: DataFrame, metrics: list[str], score: str = "score") -> DataFrame:
    """One row: counts of results with metrics and without, their share in percent, the mean of each metric and of the score,
    least and highest score.

    A result has metrics where one of them is not null; a null among them counts as 0, one that is no number does not count.
    What has no values at all is 0.
    """
    good = reduce(lambda a, b: a | b, [F.col(m).isNotNull() for m in metrics])
    value = lambda c: F.when(good & ~F.isnan(F.coalesce(c, F.lit(0.0))), F.coalesce(c, F.lit(0.0)))
    rounded = lambda c, n=4: F.coalesce(F.round(c, n), F.lit(0.0))
    n, ok = F.count(F.lit(1)), F.count_if(good)
    means = [rounded(F.avg(value(F.col(m)))).alias(f"mean_{m}") for m in (*metrics, score)]
    own = value(F.col(score))
    return results.agg(
        n.alias("n_total"), ok.alias("n_successful"), (n - ok).alias("n_failed"), rounded(F.lit(100.0) * ok / n, 2).alias("success_rate"), *means,
        rounded(F.min(own)).alias("min_score"), rounded(F.max(own)).alias("max_score"),
    )


def set_recall(gold: Column, observed: Column) -> Column:
    """Share of a set of gold items that was observed; 1 for an empty set."""
    gold = F.array_distinct(F.filter(gold, lambda x: x.isNotNull() & (x != "")))
    return F.when(F.size(gold) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(gold, observed)) / F.size(gold))


def latency(rows: DataFrame, value: str, *by: str) -> DataFrame:
    """Exact median and 95th percentile with linear interpolation, least and most."""
    return rows.groupBy(*by).agg(
        F.percentile(value, 0.5).alias("median_ms"), F.percentile(value, 0.95).alias("p95_ms"), F.min(value).alias("min_ms"), F.max(value).alias("max_ms")
    )


def covered(intervals: DataFrame, key: str, start: str = "start", end: str = "end") -> DataFrame:
    """(key, covered): how much the union of a key's half-open intervals covers."""
    w = Window.partitionBy(key).orderBy(start, end)
    before = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    gain = F.greatest(F.col(end) - F.greatest(F.col(start), F.coalesce(before, F.col(start))), F.lit(0))
    return intervals.withColumn("__gain", gain).groupBy(key).agg(F.sum("__gain").cast("long").alias("covered"))


def usage(rows: DataFrame) -> DataFrame:
    """Token totals; a missing total is the sum of its parts."""
    total = F.coalesce("total_tokens", F.coalesce("prompt_tokens", F.lit(0)) + F.coalesce("completion_tokens", F.lit(0)))
    return rows.agg(F.sum("prompt_tokens").alias("prompt_tokens"), F.sum("completion_tokens").alias("completion_tokens"), F.sum(total).alias("total_tokens"), F.count(F.lit(1)).alias("calls"))


def description_order(fragments: DataFrame, key: str) -> DataFrame:
    """(key, descriptions): different descriptions of rows (key, description, at, pos): each as it came first, by time, then the
    longer ones, then as they came."""
    first = fragments.where("description <> ''").groupBy(key, "description").agg(F.min_by(F.struct("at", "pos"), "pos").alias("f"))
    row = F.struct(F.col("f.at"), -F.char_length("description"), F.col("f.pos"), F.col("description").alias("d"))
    return first.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(row)), lambda x: x["d"]).alias("descriptions"))


def longest_description(first: DataFrame, later: DataFrame, key: str) -> DataFrame:
    """(key, description): that of the first pass, unless the later one has a strictly longer one or the first has none."""
    rows = first.select(key, "description", F.lit(0).alias("later")).unionByName(later.select(key, "description", F.lit(1).alias("later")))
    best = F.struct(F.coalesce(F.char_length("description"), F.lit(0)), -F.col("later"))
    return rows.groupBy(key).agg(F.max_by("description", best).alias("description"))


def effectiveness(cases: DataFrame, results: DataFrame, key: str, k: int) -> DataFrame:
    """One row: mean recall and precision at ``k`` over cases (key, gold) of results (key, rank, item), and the share of cases
    with any hit.  Cases without gold items count as recalled, cases without results have a precision of 0."""
    wanted = cases.select(key, F.array_distinct("gold").alias("gold"))
    found = results.where(F.col("rank") <= k).groupBy(key).agg(F.collect_set("item").alias("found"))
    rows = wanted.join(found, key, "left").withColumn("found", F.coalesce("found", F.array_except("gold", "gold")))
    hits = F.size(F.array_intersect("gold", "found"))
    recall = F.when(F.size("gold") == 0, F.lit(1.0)).otherwise(hits / F.size("gold"))
    precision = F.when(F.size("found") == 0, F.lit(0.0)).otherwise(hits / F.size("found"))
    return rows.agg(F.avg(recall).alias("recall_at_k"), F.avg(precision).alias("precision_at_k"), F.avg((hits > 0).cast("double")).alias("hit_rate"))


def version_snapshot(members: DataFrame) -> DataFrame:
    """One row: groups, members, active and deleted members of version candidates."""
    return members.agg(F.countDistinct("version_group_key").alias("n_groups"), F.count(F.lit(1)).alias("n_members"), F.count_if("active").alias("n_active"), F.count_if("deleted").alias("n_deleted"))


def payload_quality(objects: DataFrame, kind: str, evidence: str, score: str) -> DataFrame:
    """(kind, n, share, with_evidence, mean_score): distribution of a payload's objects over a column."""
    total = objects.agg(F.count(F.lit(1)).alias("__total"))
    g = objects.groupBy(kind).agg(F.count(F.lit(1)).alias("n"), F.avg(F.col(evidence).cast("double")).alias("with_evidence"), F.avg(score).alias("mean_score"))
    return g.crossJoin(F.broadcast(total)).withColumn("share", F.col("n") / F.col("__total")).drop("__total")  # one row


def metrics(samples: DataFrame) -> DataFrame:
    """(name, labels, counter, gauge, n_samples): sums of counters, last gauges and numbers of samples (name, labels, kind, value, at)."""
    of = lambda k: F.when(F.col("kind") == k, F.col("value"))
    return samples.groupBy("name", "labels").agg(F.sum(of("counter")).alias("counter"), F.max_by(of("gauge"), F.when(F.col("kind") == "gauge", F.col("at"))).alias("gauge"), F.count(of("sample")).alias("n_samples"))


def counts(rows: DataFrame, by: str, total: str | None = None) -> DataFrame:
    """(by, n) of each value, and with ``total`` a row of that name for all."""
    out = rows.groupBy(by).agg(F.count(F.lit(1)).alias("n"))
    return out if total is None else out.unionByName(rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(total).alias(by), "n"))
