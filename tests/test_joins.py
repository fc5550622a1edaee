"""Joins whose groups may be large."""

import random

from tessera.operators import joins


def test_terms_of_one_key_meet_few_entries(spark):
    """Each term gets what a loop over all entries finds, without all pairs of terms and entries of a key."""
    rnd = random.Random(3)
    terms = [(i, rnd.choice("ab"), rnd.choice([None, 0, 1, 2]), rnd.choice([None, 0, 1])) for i in range(300)]
    entries = [(i, rnd.choice("ab"), rnd.choice([None, 0, 1]), rnd.choice([None, 0, 1]), f"c{i}", rnd.choice(["CONFIRMED", "CANDIDATE"]), rnd.random()) for i in range(400)]
    expected = {}
    for i, key, *own in terms:
        fits = [e for e in entries if e[1] == key and all(r is None or r == o for r, o in zip(e[2:4], own))]
        if fits:
            expected[i] = min(fits, key=lambda e: (-sum(r is not None for r in e[2:4]), e[5] != "CONFIRMED", -e[6], e[0]))[0]
    t = spark.createDataFrame(terms, "term_id int, key string, module int, domain int")
    r = spark.createDataFrame(entries, "entry_id int, key string, module int, domain int, canonical string, status string, confidence double")
    found = joins.resolve_terms(t, r, ["module", "domain"])
    assert {x["term_id"]: x["entry_id"] for x in found.collect()} == expected
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    join = next(line for line in plan.splitlines() if "Join Inner" in line)
    assert "__named" in join and "<=>" in join  # scopes are keys of the join and no filter after it


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_rows_that_do_not_count_are_not_joined_with_chunks(spark):
    from tessera.operators import editing

    chunks = spark.createDataFrame([("one", "s1"), ("two", "s2")], "content string, source_id string")
    entities = spark.createDataFrame([(1, "a", "t", "old", "s1"), (2, "a", None, None, "s2"), (None, "b", "t", "d", "lost")], "pos long, name string, entity_type string, description string, source_id string")
    relations = spark.createDataFrame([(1, "b", "a", "old", "k", 1.0, "s2"), (2, "a", "b", "new", "k", None, "s1"), (1, "c", "a", "d", "k", 2.0, None)], "pos long, src string, tgt string, description string, keywords string, weight double, source_id string")
    cut, nodes, edges = editing.import_graph(chunks, entities, relations)
    of = {r.source_id: r.id for r in cut.collect()}
    assert sorted(map(tuple, nodes.collect())) == [("a", "UNKNOWN", "", of["s2"]), ("b", "t", "d", "UNKNOWN"), ("c", "UNKNOWN", "UNKNOWN", "UNKNOWN")]
    assert sorted((r.src, r.tgt, r.description, r.weight, r.chunk_id) for r in edges.collect()) == [("a", "b", "new", 1.0, of["s1"]), ("a", "c", "d", 2.0, "UNKNOWN")]
    plan = plan_of(edges)
    assert plan.index("Join LeftOuter") < plan.index("Window")


def test_relation_ids_move_as_bytes(spark):
    from tessera.functions.ids import relation_ids
    from tessera.operators import lookups

    pairs = spark.createDataFrame([("a", "b"), ("b", "a"), ("c", "c"), ("d", "e"), ("f", "g"), ("x", None)], "a string, b string")
    ids = {(r.a, r.b): r.ids for r in pairs.select("a", "b", relation_ids("a", "b").alias("ids")).collect()}
    stored = [ids["a", "b"][0], ids["a", "b"][1], ids["c", "c"][0], ids["d", "e"][1], ids["d", "e"][1], ids["f", "g"][0].upper(), "rel-" + ids["f", "g"][0][4:].upper(), "other", None]
    found = lookups.relation_info(spark.createDataFrame([(x,) for x in stored], "id string"), pairs)
    assert sorted(map(tuple, found.collect())) == [("a", "b", ids["a", "b"][0]), ("b", "a", ids["a", "b"][0]), ("c", "c", ids["c", "c"][0]), ("d", "e", ids["d", "e"][1])]
    assert "unhex" in plan_of(found).lower()
