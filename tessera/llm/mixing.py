"""Mixing sources to target weights by Efraimidis-Spirakis sampling, with DataFrame functions alone.

A source gets a budget of words.  It takes all its documents as often as they fit as a whole (complete epochs); what is left
of the budget goes to a weighted sample without replacement: a document of weight w draws the exponential key -ln(u) / w,
and documents are taken in the order of their keys until their summed sizes reach the budget, the last one in part.

The sums run over keys in two levels, so no source is sorted in one task: a source with n documents has about sqrt(n) ranges
of keys, whose sizes are summed first; the budget ends in one of them, and this range alone is sorted and summed row by row.
All other documents compare their key with where the budget ends.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import materialise

WORDS = "[^\\x20\\x09-\\x0D]+"
#: Weights of sources in the order of their names, over and over.
WEIGHTS = (3, 1, 2)
#: All sources together take this many halves of all words, and no source more than this many times its own.
TOTAL_HALVES, MOST = 3, 2
_BITS = 52


def _sums_before(rows: DataFrame, order: list[Column], values: dict[str, str]) -> DataFrame:
    """Rows with the sums of columns over all rows up to them in an order (new name: column), and their number ``n_th``.

    Rows are range-sorted and written once; each part is summed by itself, after the totals of the parts before it, of which
    there is one row a part.
    """
    part = materialise(rows.orderBy(*order).withColumn("__part", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id()), "mix-sorted")
    part = part.withColumn("__one", F.lit(1).cast("long"))
    values = values | {"n_th": "__one"}
    totals = part.groupBy("__part").agg(*[F.sum(c).alias(f"__{n}") for n, c in values.items()])
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("__part", *[F.coalesce(F.sum(f"__{n}").over(earlier), F.lit(0)).alias(f"__{n}") for n in values])
    own = Window.partitionBy("__part").orderBy("__at").rowsBetween(Window.unboundedPreceding, 0)
    found = part.join(F.broadcast(starts), "__part")  # a row for each part
    return found.select(*rows.columns, *[(F.col(f"__{n}") + F.sum(c).over(own)).alias(n) for n, c in values.items()])


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Sources (source, source_size) with their ``target`` and whole ``budget`` in words.

    By code point of ``source``, null last, sources weigh ``weights`` over and over and share 150 % of all sizes; a share
    above twice a source's size is cut to it and the rest shared again.  Where this ends is found at once: sources are
    ordered by the level (share by weight) at which they are full; the ones that are full at their level take twice their
    size, and the others share the rest.  Whole numbers throughout, so it does not depend on the order of sums.
    """
    named = _sums_before(sources, [F.col("source").isNull(), F.col("source")], {})
    turn = F.array(*[F.lit(w).cast("long") for w in weights])
    named = named.withColumn("w", F.element_at(turn, (F.pmod(F.col("n_th") - 1, F.lit(len(weights))) + 1).cast("int"))).drop("n_th")
    named = _sums_before(named, [F.col("source_size") / F.col("w"), F.col("w"), F.col("source")], {"below": "source_size", "w_below": "w"})
    named = materialise(named, "mix-levels")
    whole = named.agg(F.sum("source_size").alias("all"), F.sum("w").alias("w_all"))
    d = lambda c: F.col(c).cast("decimal(19,0)")
    full = d("w") * d("below") * (2 * MOST) + d("source_size") * (d("w_all") - d("w_below")) * (2 * MOST) <= d("w") * d("all") * TOTAL_HALVES
    rows = named.crossJoin(F.broadcast(whole)).withColumn("full", full)  # one row
    left = rows.where(~F.col("full")).agg(F.sum("w").alias("w_open"))
    cut = rows.where("full").agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("cut"))
    rows = rows.crossJoin(F.broadcast(left)).crossJoin(F.broadcast(cut))  # one row each
    # twice the words that full sources leave, by weight; two halves are one
    words = (F.col("w") * (F.col("all") * TOTAL_HALVES - F.col("cut") * (2 * MOST))).alias("words")
    rows = rows.select("source", "source_size", "full", words, (F.col("w_open") * 2).alias("parts"))
    return rows.select(
        "source", "source_size",
        F.when(F.col("full"), F.col("source_size") * float(MOST)).otherwise(F.col("words") / F.col("parts")).alias("target"),
        F.when(F.col("full"), F.col("source_size") * MOST).otherwise(F.expr("words div parts")).alias("budget"),
    )


def sizes(text: Column) -> Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def exponential_key(name: Column, weight: Column) -> Column:
    """-ln(u) / weight with u in (0, 1) from the md5 of a name."""
    bits = F.conv(F.substring(F.md5(name.cast("binary")), 1, _BITS // 4), 16, 10).cast("long")
    return -F.log((bits + F.lit(0.5)) / F.lit(float(1 << _BITS))) / weight


def mix(docs: DataFrame, quality: DataFrame | None = None, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every document (doc_id, text, source); ``quality`` has (doc_id, weight).

    ``size`` counts words, ``target`` is the source's of :func:`targets`, ``taken`` says how many words of the document the
    mix takes, repeats counted: its source's whole budget is taken, at most twice a document.  Larger weights are taken
    sooner; documents without a weight, or with one that is not positive and finite, weigh 1, of several weights the largest
    counts.  Null texts have no words, null sources are one source, null ids draw one key.  Rows that are equal in id, source
    and size are treated alike: where the budget ends among them each gives the same part, rounded down.  Keys come from ids
    alone, so reruns agree.  An empty table gives no rows; other columns do not pass.
    """
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = docs.select("doc_id", "source", sizes(F.col("text")).alias("size"))
    if quality is not None:
        fit = F.col("weight").isNotNull() & ~F.isnan("weight") & (F.col("weight") > 0) & (F.col("weight") < float("inf"))
        known = quality.where(fit & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("weight").cast("double").alias("weight"))
        rows = rows.join(known, "doc_id", "left")
    else:
        rows = rows.withColumn("weight", F.lit(1.0))
    rows = rows.withColumn("weight", F.coalesce("weight", F.lit(1.0)))
    # null as a name of its own, so that joins need no null-safe comparison
    rows = rows.withColumn("at", F.when(F.col("source").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("source").cast("string"))))
    rows = materialise(rows.select("doc_id", name.alias("name"), "source", "at", "size", "weight", exponential_key(name, F.col("weight")).alias("key")), "mix-rows")

    sources = rows.groupBy("at").agg(
        F.first("source", ignorenulls=True).alias("source"), F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"), F.min("weight").alias("least")
    )
    sources = materialise(sources, "mix-sources")
    aims = targets(sources.select("source", "source_size"), weights)
    same = F.when(F.col("source").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("source").cast("string")))
    aims = aims.select(same.alias("at"), "target", "budget").join(sources, "at")
    epochs = F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(F.lit(0))
    aims = aims.withColumn("epochs", epochs).withColumn("rest", F.col("budget") - F.col("epochs") * F.col("source_size"))
    aims = materialise(aims.select("at", "source_size", "n", "least", "target", "epochs", "rest"), "mix-aims")

    # keys of the least weight spread evenly over the ranges, so none of them holds more than weight / least of its share
    n_ranges = F.ceil(F.sqrt("n"))
    ranged = lambda df: df.withColumn("range", F.least(F.floor((1 - F.exp(-F.col("key") * F.col("least"))) * n_ranges), n_ranges - 1).cast("long"))
    open_ = aims.where("rest > 0").select("at", "n", "least", "rest")
    totals = ranged(rows.join(open_, "at")).groupBy("at", "range", "rest").agg(F.sum("size").alias("words"))
    ordered = Window.partitionBy("at").orderBy("range").rowsBetween(Window.unboundedPreceding, 0)
    totals = totals.withColumn("upto", F.sum("words").over(ordered))
    ends = totals.where("upto >= rest and upto - words < rest").select("at", F.col("range").alias("end_range"), (F.col("rest") - F.col("upto") + F.col("words")).alias("rest"))
    ends = materialise(ends.groupBy("at").agg(F.min(F.struct("end_range", "rest")).alias("e")).select("at", "e.*"), "mix-ranges")

    near = ranged(rows.join(open_.drop("rest"), "at")).join(ends, "at").where("range = end_range")
    near = near.groupBy("at", "rest", "key", "name", "size").agg(F.count(F.lit(1)).alias("copies"))
    ordered = Window.partitionBy("at").orderBy("key", "name", "size").rowsBetween(Window.unboundedPreceding, 0)
    near = near.withColumn("upto", F.sum(F.col("size") * F.col("copies")).over(ordered))
    before = F.col("upto") - F.col("size") * F.col("copies")
    last = near.where((F.col("upto") >= F.col("rest")) & (before < F.col("rest")))
    part = F.floor((F.col("rest") - before) / F.col("copies")).cast("long")
    last = last.select("at", F.struct("key", "name", "size").alias("last"), part.alias("part"))

    aims = materialise(aims.join(last, "at", "left").select("at", "source_size", "target", "epochs", "last", "part"), "mix-ends")
    own = F.struct("key", "name", "size")
    more = F.when(own < F.col("last"), F.col("size")).when(own == F.col("last"), F.col("part")).otherwise(F.lit(0))
    found = rows.join(aims, "at")
    return found.select("doc_id", "size", "source_size", "target", (F.col("epochs") * F.col("size") + more).cast("long").alias("taken"))
