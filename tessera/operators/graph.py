"""The property graph: nodes (id, ...) and undirected edges (src < tgt, ...)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.ids import high, low
from tessera.operators import aggregates
from tessera.sources.scratch import materialise


def canonical(edges: DataFrame, src: str = "src", tgt: str = "tgt") -> DataFrame:
    return edges.withColumn("__s", low(src, tgt)).withColumn(tgt, high(src, tgt)).withColumn(src, F.col("__s")).drop("__s")


def endpoints(edges: DataFrame) -> DataFrame:
    """(node, other) of every edge from both ends."""
    return edges.select(F.col("src").alias("node"), F.col("tgt").alias("other")).unionAll(edges.select(F.col("tgt").alias("node"), F.col("src").alias("other")))


def degrees(edges: DataFrame) -> DataFrame:
    """(node, degree); a self-loop counts twice.  Partial counts are made before the exchange."""
    return endpoints(edges).groupBy("node").agg(F.count(F.lit(1)).alias("degree"))


def degrees_of(wanted: DataFrame, edges: DataFrame) -> DataFrame:
    """Degrees of wanted nodes (node), 0 for those without edges."""
    return wanted.join(degrees(edges), "node", "left").withColumn("degree", F.coalesce("degree", F.lit(0)))


def edge_degrees(edges: DataFrame) -> DataFrame:
    """Edges with the sum of both ends' degrees."""
    d = degrees(edges)
    a, b = d.select(F.col("node").alias("src"), F.col("degree").alias("d1")), d.select(F.col("node").alias("tgt"), F.col("degree").alias("d2"))
    return edges.join(a, "src").join(b, "tgt").withColumn("degree", F.col("d1") + F.col("d2")).drop("d1", "d2")


def popular(edges: DataFrame, limit: int = 300) -> DataFrame:
    return degrees(edges).orderBy(F.desc("degree"), "node").limit(limit)


def adjacency(wanted: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, src, tgt) of every edge at wanted nodes: two equi-joins, so that no OR condition makes a nested loop."""
    a = wanted.join(edges.select("src", "tgt"), F.col("node") == F.col("src"))
    b = wanted.join(edges.where("src <> tgt").select("src", "tgt"), F.col("node") == F.col("tgt"))
    return a.unionByName(b)


def edges_of_pairs(pairs: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges of pairs (a, b) in either order; pairs without an edge are left out."""
    return pairs.withColumn("src", low("a", "b")).withColumn("tgt", high("a", "b")).join(edges, ["src", "tgt"])


def missing_endpoints(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Placeholder nodes for ends of edges that have none."""
    ends = endpoints(edges).select(F.col("node").alias("id")).distinct()
    return ends.join(nodes.select("id"), "id", "left_anti").withColumn("entity_type", F.lit("UNKNOWN"))


def top_degree_subgraph(nodes: DataFrame, edges: DataFrame, most: int) -> tuple[DataFrame, DataFrame, bool]:
    """The ``most`` nodes of highest degree (ties by id), the edges among them, and whether nodes were left out."""
    d = degrees_of(nodes.select(F.col("id").alias("node")), edges)
    top = d.orderBy(F.desc("degree"), "node").limit(most)
    keep = top.select(F.col("node"))
    inner = edges.join(keep.withColumnRenamed("node", "src"), "src", "left_semi").join(keep.withColumnRenamed("node", "tgt"), "tgt", "left_semi")
    return top, inner, nodes.count() > most


def neighbourhood(edges: DataFrame, start: str, depth: int = 3, most: int = 1000) -> tuple[DataFrame, bool]:
    """(node, depth) around a node, level by level, nodes of a level by degree descending, then id; and whether ``most`` cut it.

    Each level is written, joins the adjacency list with the level before, and drops nodes of earlier levels by an
    anti-join, so a level costs one scan.  Levels beyond ``most`` nodes are not entered: they could add none.
    """
    edges = materialise(edges.select("src", "tgt"), "edges")
    both = endpoints(edges).where("node <> other")
    spark = edges.sparkSession
    first = both.union(edges.where("src = tgt")).where(F.col("node") == start).select("node").limit(1).withColumn("depth", F.lit(0))
    levels = [materialise(first, "level")]
    n = levels[0].count()
    while n and n <= most and len(levels) <= depth:
        seen = reduce(DataFrame.unionByName, levels)
        step = both.join(levels[-1].select("node"), "node", "left_semi").select(F.col("other").alias("node")).distinct()
        step = step.join(seen.select("node"), "node", "left_anti").withColumn("depth", F.lit(len(levels)))
        levels.append(materialise(step, "level"))
        more = levels[-1].count()
        if not more:
            break
        n += more
    seen = reduce(DataFrame.unionByName, levels)
    deg = degrees_of(seen.select("node"), edges)
    return seen.join(deg, "node").orderBy("depth", F.desc("degree"), "node").limit(most), n > most


def induced(edges: DataFrame, keep: DataFrame) -> DataFrame:
    """Edges whose both ends are among ``keep`` (node), each with its sorted ``a-b`` id."""
    a, b = keep.select(F.col("node").alias("src")), keep.select(F.col("node").alias("tgt"))
    return edges.join(a, "src", "left_semi").join(b, "tgt", "left_semi").withColumn("edge_id", F.concat("src", F.lit("-"), "tgt"))


def paths(edges: DataFrame, seeds: DataFrame, most: int = 100) -> DataFrame:
    """One- and two-hop paths from seeds (node): nodes joined by ``>``, edges by ``|``; shorter first, then by name."""
    both = endpoints(edges).where("node <> other")
    key = F.concat(low("node", "other"), F.lit("-"), high("node", "other"))
    one = both.join(seeds, "node", "left_semi").select(F.col("node").alias("a"), F.col("other").alias("b"), key.alias("e1"))
    two = one.join(both.select(F.col("node").alias("b"), F.col("other").alias("c"), key.alias("e2")), "b").where("c <> a")
    rows = one.select(F.lit(1).alias("hops"), F.concat_ws(">", "a", "b").alias("path"), F.col("e1").alias("edges")).unionByName(
        two.select(F.lit(2).alias("hops"), F.concat_ws(">", "a", "b", "c").alias("path"), F.concat_ws("|", F.least("e1", "e2"), F.greatest("e1", "e2")).alias("edges"))
    )
    one_each = rows.groupBy("hops", "edges").agg(F.min("path").alias("path"))
    return one_each.orderBy("hops", "path").limit(most)


def upsert(old: DataFrame, new: DataFrame, keys: list[str], order: str = "pos") -> DataFrame:
    """Property-wise merge: a new value replaces an old one unless it is null; of several new rows the last counts."""
    w = Window.partitionBy(*keys).orderBy(F.desc(order))
    new = new.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n", order)
    rest = [c for c in old.columns if c not in keys]
    joined = old.alias("o").join(new.alias("n"), keys, "full_outer")
    return joined.select(*keys, *[F.coalesce(F.col(f"n.{c}") if c in new.columns else F.lit(None), F.col(f"o.{c}")).alias(c) for c in rest])


def delete_nodes(nodes: DataFrame, edges: DataFrame, gone: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges without some nodes (id); ids that are not there change nothing."""
    ids = gone.select("id")
    kept = edges.join(ids.withColumnRenamed("id", "src"), "src", "left_anti").join(ids.withColumnRenamed("id", "tgt"), "tgt", "left_anti")
    return nodes.join(ids, "id", "left_anti"), kept


#: How attributes of edges that fall together become one; other attributes keep the first value.
EDGE_STRATEGIES = {"weight": "max", "description": "concatenate", "keywords": "join_unique_comma", "source_id": "join_unique", "source_ids": "join_unique", "file_path": "join_unique"}


def merge_nodes(edges: DataFrame, sources: list[str], target: str, strategies: dict[str, str] | None = None) -> DataFrame:
    """Edges with some nodes renamed to ``target``: loops drop out; edges that fall together become one, attribute by attribute.

    ``strategies`` names a way of :func:`aggregates.merge_attributes` for each column and comes before
    :data:`EDGE_STRATEGIES`; values come in the order of the old ends.  Columns keep their names and types, and edges at
    other nodes are passed on without a shuffle.
    """
    names = [target, *sources]
    ways = EDGE_STRATEGIES | (strategies or {})
    kinds = dict(edges.dtypes)
    to = lambda c: F.when(F.col(c).isin(*names), F.lit(target)).otherwise(F.col(c))
    hit = F.coalesce(F.col("src").isin(*names) | F.col("tgt").isin(*names), F.lit(False))
    moved = edges.where(hit).withColumn("__old", F.struct("src", "tgt")).withColumn("src", to("src")).withColumn("tgt", to("tgt"))
    moved = canonical(moved).where("src <> tgt")
    rest = [c for c in edges.columns if c not in ("src", "tgt")]
    merged = moved.groupBy("src", "tgt").agg(*[aggregates.merged_value(c, kinds[c], ways.get(c, "keep_first"), F.col("__old")).cast(kinds[c]).alias(c) for c in rest])
    return edges.where(~hit).unionByName(merged.select(*edges.columns))


def has_cycle(edges: DataFrame) -> bool:
    """Whether directed edges (src, tgt) hold a cycle; edges with a null end are none.

    Each round, written before the next reads it, peels edges from nodes that none leads to and to nodes that none leaves;
    where nothing peels, every way goes on for ever, which is a cycle.  Then nodes with one edge in and one out are bridged,
    of neighbours those that a hash of the round puts first, so a chain shrinks by a factor and not by its ends alone.
    """
    left = materialise(edges.select("src", "tgt").where("src is not null and tgt is not null").distinct(), "edges")
    n, turn = left.count(), 0
    while n:
        if not left.where("src = tgt").isEmpty():
            return True
        ins, outs = left.select(F.col("tgt").alias("src")).distinct(), left.select(F.col("src").alias("tgt")).distinct()
        peeled = materialise(left.join(ins, "src", "left_semi").join(outs, "tgt", "left_semi").select("src", "tgt"), "peeled")
        before, n, turn = n, peeled.count(), turn + 1
        if n == before:
            return True
        one_in = peeled.groupBy(F.col("tgt").alias("mid")).agg(F.count(F.lit(1)).alias("n"), F.min("src").alias("a")).where("n = 1").drop("n")
        one_out = peeled.groupBy(F.col("src").alias("mid")).agg(F.count(F.lit(1)).alias("n"), F.min("tgt").alias("b")).where("n = 1").drop("n")
        mids = one_in.join(one_out, "mid").withColumn("p", F.xxhash64("mid", F.lit(turn)))
        near = lambda c: mids.select(F.col("mid").alias(c), F.col("p").alias(f"p_{c}"))
        first = mids.join(near("a"), "a", "left").join(near("b"), "b", "left")
        first = materialise(first.where("(p_a is null or p > p_a) and (p_b is null or p > p_b)").select("mid", "a", "b"), "bridged")
        rest = peeled.join(first.select(F.col("mid").alias("src")), "src", "left_anti").join(first.select(F.col("mid").alias("tgt")), "tgt", "left_anti")
        left = materialise(rest.select("src", "tgt").union(first.select("a", "b")).distinct(), "edges")
        n = left.count()
    return False
