"""Queries that write versions of documents, break and undo it, and derive relations between versions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.plans.lifecycle import Lifecycle
from tessera.plans.queries_sources import _fresh
from tessera.plans.registry import KG, query
from tessera.sources.tables import Store


def _bundle(spark, d, version):
    """An order as a document, its parts as objects; in the second version some lines are gone and some parts have changed."""
    rows = KG(spark, d).table("lineitem").where("true" if version == 1 else "l_orderkey % 3 = 0 AND l_linenumber <= 2")
    text = "concat('p', l_partkey % 5)" if version == 1 else "CASE WHEN l_partkey % 7 = 0 THEN 'q' ELSE concat('p', l_partkey % 5) END"
    rows = rows.selectExpr("concat('o-', l_orderkey) AS document_id", f"concat('o-', l_orderkey, '@', {version}) AS version_id", "'node' AS kind", "concat('part-', l_partkey) AS object_id", f"{text} AS payload")
    return rows.withColumn("hash", F.md5("payload"))


def _length(texts):
    return [[float(len(t))] for t in texts]


def _lifecycle(spark):
    return Lifecycle(Store(spark, _fresh(spark, "lifecycle"), buckets=8), _length)


@query(
    "mut_lifecycle",
    """WITH two AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_orderkey % 3 = 0 AND l_linenumber <= 2), new AS (SELECT DISTINCT l_partkey FROM lineitem WHERE l_orderkey % 3 = 0 AND l_linenumber <= 2),
        active AS (SELECT l_partkey, l_orderkey FROM lineitem WHERE l_orderkey NOT IN (SELECT l_orderkey FROM two) UNION SELECT l_partkey, l_orderkey FROM lineitem WHERE l_orderkey % 3 = 0 AND l_linenumber <= 2)
        SELECT 'part-' || l_partkey AS object_id, CASE WHEN l_partkey % 7 = 0 AND l_partkey IN (SELECT l_partkey FROM new) THEN 'q' ELSE 'p' || (l_partkey % 5) END AS payload, count(*) AS n_documents
        FROM active WHERE l_orderkey % 5 <> 0 GROUP BY l_partkey""",
)
def mut_lifecycle(spark, d):
    life = _lifecycle(spark)
    life.register(_bundle(spark, d, 1), "one")
    life.upsert(_bundle(spark, d, 2), "two")
    life.delete_documents(KG(spark, d).table("orders").where("o_orderkey % 5 = 0").selectExpr("concat('o-', o_orderkey) AS document_id"), "three")
    n = life.store.read("lc_contributions").where("active").groupBy("object_id").agg(F.count(F.lit(1)).alias("n_documents"))
    return life.store.read("lc_objects").select("object_id", "payload").join(n, "object_id", "left")


@query(
    "mut_compensation",
    "SELECT DISTINCT w AS after, 'part-' || l_partkey AS object_id, 'p' || (l_partkey % 5) AS payload FROM lineitem, (VALUES ('written'), ('deleted'), ('undone')) AS v(w)",
)
def mut_compensation(spark, d):
    life = _lifecycle(spark)
    life.register(_bundle(spark, d, 1), "one")
    out = None
    for after, run in (
        ("written", lambda: life.upsert(_bundle(spark, d, 2), "two", fail_after="UPSERT_OBJECTS")),
        ("deleted", lambda: life.upsert(_bundle(spark, d, 2), "three", fail_after="DELETE_OBJECTS")),
        ("undone", lambda: (life.upsert(_bundle(spark, d, 2), "four"), life.compensate("UPSERT_NEW_VERSION:four"))),
    ):
        run()
        rows = life.store.read("lc_objects").select(F.lit(after).alias("after"), "object_id", "payload")
        out = rows if out is None else out.unionByName(rows)
    return out
