"""Orders with ties, and ranks and spans within channels."""

from tessera.operators import ranking


def test_ties_of_a_last_write(spark):
    rows = spark.createDataFrame([("a", 1, 5, "x"), ("a", 2, 3, "y"), ("a", 2, 2, "z"), ("b", 1, 1, "w")], "id string, pos int, at int, value string").repartition(3)
    assert {(r["id"], r["value"]) for r in ranking.last_write(rows, ["id"], "pos", "at").collect()} == {("a", "z"), ("b", "w")}


def test_last_write_takes_the_first_of_equal_lines(spark, tmp_path):
    from tessera.plans import all_queries

    values = [(i % 7, 1, "ANR"[i % 3]) for i in range(300)]
    spark.createDataFrame(values, "l_orderkey long, l_linenumber int, l_returnflag string").coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    found = all_queries()[0]["win_last_write"](spark, str(tmp_path)).collect()
    assert {r["id"]: r["value"] for r in found} == {k: next(f + "1" for i, _, f in values if i == k) for k in range(7)}


def test_last_write_passes_over_nulls_as_its_sql_does(spark, tmp_path):
    import duckdb

    from tessera.plans import all_queries

    values = [(1, 2, None), (1, 1, "A"), (2, None, "N"), (2, 1, "R"), (3, None, "A"), (4, 1, None), (5, 1, "N"), (5, 1, None)]
    spark.createDataFrame(values, "l_orderkey long, l_linenumber int, l_returnflag string").coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    con = duckdb.connect(config={"threads": 1})
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet/*.parquet'")
    queries, sql = all_queries()
    found = {r["id"]: r["value"] for r in queries["win_last_write"](spark, str(tmp_path)).collect()}
    assert found == dict(con.execute(sql["win_last_write"]).fetchall()) == {1: "A1", 2: "R1", 3: None, 4: None, 5: "N1"}


def test_channels_are_not_held_by_one_task(spark):
    rows = [(i, "ab"[i % 2], float(i * 7 % 13)) for i in range(200)] + [(900, "c", 1.0), (901, None, 2.0), (902, None, 4.0)]
    df = spark.createDataFrame(rows, "candidate_id int, channel string, raw_score double").repartition(5)
    found = {r.candidate_id: r for r in ranking.normalize_channels(df).collect()}
    scaled = {r.candidate_id: r.normalized_score for r in ranking.scale_channels(df).collect()}
    for c in ("a", "b", "c", None):
        own = sorted((r for r in rows if r[1] == c), key=lambda r: (-r[2], r[0]))
        low, high = own[-1][2], own[0][2]
        for i, r in enumerate(own, 1):
            assert (found[r[0]].channel_rank, found[r[0]].normalized_score) == (i, 1.0 if low == high else (r[2] - low) / (high - low))
            assert scaled[r[0]] == found[r[0]].normalized_score
    for out in (ranking.scale_channels(df), ranking.normalize_channels(df)):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert not any("Window" in line and "channel" in line for line in plan.splitlines())


def test_a_task_scores_a_bounded_number_of_pairs(spark, monkeypatch):
    from tessera.plans import retrieval

    monkeypatch.setattr(retrieval, "PAIRS_A_TASK", 8, raising=False)
    docs = spark.createDataFrame([(i, "red fox" if i % 3 else "blue dog blue") for i in range(20)], "doc long, text string")
    questions = spark.createDataFrame([("a", "Red fox?"), ("b", "blue")], "q string, text string")
    found = retrieval.lexical_ranking(docs, questions, "q", 2, decimals=4)
    assert sorted((r.q, r.doc, r.rank) for r in found.collect()) == [("a", 1, 1), ("a", 2, 2), ("b", 0, 1), ("b", 3, 2)]
    assert "RepartitionByExpression [doc" in found._jdf.queryExecution().analyzed().toString()
