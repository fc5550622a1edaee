"""Names of queries, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

#: Shared tables of the knowledge graph that the queries build from the driver's tables.
CTES = {
    "frag": """SELECT 'part-' || l_partkey AS src, 'supp-' || l_suppkey AS tgt, l_quantity AS weight, l_returnflag || ',' || l_linestatus AS keywords,
        'chunk-' || l_orderkey AS source_id, l_orderkey * 10 + l_linenumber AS pos FROM lineitem""",
    "edges": "SELECT src, tgt, sum(weight) AS weight, count(*) AS n FROM frag GROUP BY src, tgt",
    "nodes": """SELECT 'part-' || p_partkey AS id, p_type AS entity_type, p_name AS name FROM part
        UNION ALL SELECT 'supp-' || s_suppkey, 'SUPPLIER', s_name FROM supplier""",
    "ends": "SELECT src AS node, tgt AS other FROM edges UNION ALL SELECT tgt, src FROM edges",
    "deg": "SELECT node, count(*) AS degree FROM ends GROUP BY node",
    "docs": """SELECT 'doc-' || o_orderkey AS id, CASE o_orderstatus WHEN 'O' THEN 'pending' WHEN 'F' THEN 'processed' ELSE 'failed' END AS status,
        o_orderdate AS created_at, o_orderdate AS updated_at, CASE WHEN o_custkey % 7 = 0 THEN ' ' ELSE 'file-' || o_custkey END AS file_path,
        o_orderpriority AS content, o_custkey AS owner FROM orders""",
}
_NEEDS = {"edges": ("frag",), "ends": ("frag", "edges"), "deg": ("frag", "edges", "ends")}


def sql_with(body: str, *names: str) -> str:
    """A body with the shared tables that it names, each after those that it needs."""
    order: list[str] = []
    for n in names:
        for x in (*_NEEDS.get(n, ()), n):
            if x not in order:
                order.append(x)
    return "WITH " + ", ".join(f"{n} AS ({CTES[n]})" for n in order) + (", " if body.lstrip().startswith("+") else " ") + body.lstrip().lstrip("+")


def query(name: str, sql: str | None = None, *ctes: str):
    """Register a query under a name, with its SQL and the shared tables that the SQL reads."""

    def add(f: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"two queries are named {name}")
        QUERIES[name] = f
        if sql is not None:
            ORACLE_SQL[name] = sql_with(sql, *ctes) if ctes else sql
        return f

    return add


class KG:
    """The same shared tables as frames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def cte(self, name: str) -> DataFrame:
        import re

        needs = [*_NEEDS.get(name, ()), name]
        views = {t: self.table(t) for n in needs for t in re.findall(r"FROM (lineitem|part|supplier|orders)\b", CTES[n])}
        for t, df in views.items():
            df.createOrReplaceTempView(t)
        with_ = ", ".join(f"{n} AS ({CTES[n]})" for n in needs)
        return self.spark.sql(f"WITH {with_} SELECT * FROM {name}")
