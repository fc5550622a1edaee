from tessera.operators import editing


def test_ends_of_edges_are_moved_before_they_are_sorted(spark):
    edges = spark.createDataFrame([("a", "hub", "x"), ("b", "hub", "x"), ("c", "hub", "y"), ("d", "hub", "")], "src string, tgt string, description string")
    nodes = spark.createDataFrame([(i, f"own {i}") for i in ("a", "d", "hub")], "id string, description string")
    got = editing.describe_by_relations(nodes, edges, nodes)
    assert {(r.id, r.description) for r in got.collect()} == {("a", "x"), ("d", "own d"), ("hub", "x<SEP>y")}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(id" in plan and "REPARTITION_BY_COL" in plan
