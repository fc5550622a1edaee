import io
import zipfile

import pytest

from tessera.operators import vectors
from tessera.sources import files
from tessera.sources.tables import Conflict, Store
from tessera.streaming.ingest import enqueue_stream, event_counts


def test_snapshots_follow_the_pointer(spark, tmp_path):
    s = Store(spark, str(tmp_path))
    assert s.read("full_docs").count() == 0
    rows = spark.createDataFrame([("a", "x", "p", 1, 1)], s.read("full_docs").schema)
    assert s.commit("full_docs", rows) == 1
    assert s.commit("full_docs", s.read("full_docs").unionByName(rows)) == 2
    assert (s.read("full_docs").count(), s.read("full_docs", 1).count()) == (2, 1)
    s.drop("full_docs")
    assert s.read("full_docs").count() == 0
    assert Store(spark, str(tmp_path), "other").read("full_docs").count() == 0


def test_directory_reader(spark, tmp_path):
    (tmp_path / "a.txt").write_text("hello é")
    (tmp_path / "b.bin").write_bytes(b"\x00")
    (tmp_path / "c.md").write_bytes(b"\xff\xfe")
    word = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"[1:-1]
    body = f'<w:document xmlns:w="{word}"><w:body><w:p><w:r><w:t>one</w:t></w:r></w:p><w:tbl><w:tr><w:tc><w:p><w:r><w:t>x</w:t></w:r></w:p></w:tc><w:tc><w:p><w:r><w:t>y</w:t></w:r></w:p></w:tc></w:tr></w:tbl></w:body></w:document>'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", body)
    (tmp_path / "d.docx").write_bytes(out.getvalue())
    got = {r.file_path.rsplit("/", 1)[1]: (r.text, r.error) for r in files.read_directory(spark, str(tmp_path)).collect()}
    assert got["a.txt"] == ("hello é", None) and got["d.docx"] == ("one\nx\ty", None)
    assert got["b.bin"][1].startswith("unsupported") and got["c.md"][0] is None


def test_graphml(spark, tmp_path):
    (tmp_path / "g.graphml").write_text('<graphml><graph edgedefault="undirected"><node id="b"><data key="d0">B</data></node><node id="a"></node><edge source="b" target="a"><data key="d1">2</data></edge></graph></graphml>')
    nodes, edges = files.read_graphml(spark, str(tmp_path / "g.graphml"))
    assert {(r.id, r.properties.get("d0")) for r in nodes.collect()} == {("a", None), ("b", "B")}
    assert [(r.src, r.tgt, r.properties) for r in edges.collect()] == [("a", "b", {"d1": "2"})]


def test_stream_runs_twice_without_change(spark, tmp_path):
    store = Store(spark, str(tmp_path / "kb"))
    spark.createDataFrame([(0, "one text", "a"), (1, "one text", "b"), (2, "another", "c")], "pos long, text string, file_path string").write.parquet(str(tmp_path / "in"))
    for n in range(2):
        enqueue_stream(spark, str(tmp_path / "in"), "pos long, text string, file_path string", store, str(tmp_path / f"ck{n}")).awaitTermination()
    assert store.read("full_docs").count() == 2
    events = spark.createDataFrame([("a", 1.0)], "event_type string, value double").selectExpr("timestamp'2024-01-01 00:10:00' AS ts", "*")
    assert event_counts(events).first().n == 1


def test_vector_upsert_replaces(spark):
    old = spark.createDataFrame([("a", "x", [1.0]), ("b", "y", [2.0])], "id string, content string, vector array<float>")
    new = spark.createDataFrame([("b", "zz"), ("c", "w")], "id string, content string")
    got = {r.id: r.vector for r in vectors.upsert(old, new, lambda texts: [[float(len(t))] for t in texts], 1).collect()}
    assert got == {"a": [1.0], "b": [2.0], "c": [1.0]}


def _rows(spark, store, ids, content="x"):
    return spark.createDataFrame([(i, content, "p", 1, 1) for i in ids], store.read("full_docs").schema)


def _ids(df):
    return {(r.id, r.content) for r in df.collect()}


def test_a_small_change_rewrites_the_buckets_of_its_keys_alone(spark, tmp_path):
    s = Store(spark, str(tmp_path))
    s.commit("full_docs", _rows(spark, s, [f"d{i}" for i in range(200)]))
    before = s.manifest()["tables"]["full_docs"]["folders"]
    s.change("full_docs", _rows(spark, s, ["d1", "new"], "y"), _rows(spark, s, ["d2"]).select("id"))
    after = s.manifest()["tables"]["full_docs"]["folders"]
    assert 1 <= sum(before[b] != after[b] for b in before) <= 3
    got = _ids(s.read("full_docs"))
    assert len(got) == 200 and ("d1", "y") in got and ("new", "y") in got and ("d2", "x") not in got
    assert len(_ids(s.read("full_docs", 1))) == 200 and ("d2", "x") in _ids(s.read("full_docs", 1))


def test_tables_of_a_transaction_change_together(spark, tmp_path):
    s = Store(spark, str(tmp_path))
    s.commit("full_docs", _rows(spark, s, ["a"]))
    t = s.begin("both")
    t.stage("one", lambda: t.change("full_docs", _rows(spark, s, ["b"])))
    with pytest.raises(ZeroDivisionError):
        t.stage("two", lambda: (t.change("full_docs", _rows(spark, s, ["c"])), 1 / 0))
    assert _ids(s.read("full_docs")) == {("a", "x")} and _ids(t.read("full_docs")) == {("a", "x"), ("b", "x")}
    again = s.begin("both")  # the job was lost; the finished stage is not done again
    again.stage("one", lambda: 1 / 0)
    again.stage("two", lambda: again.change("full_docs", _rows(spark, s, ["d"])))
    again.publish()
    assert _ids(s.read("full_docs")) == {("a", "x"), ("b", "x"), ("d", "x")}
    # a note from before another commit is not gone on with
    lost = s.begin("other")
    lost.stage("one", lambda: lost.change("full_docs", _rows(spark, s, ["z"])))
    s.change("full_docs", _rows(spark, s, ["e"]))
    assert s.begin("other").state["stages"] == []
    with pytest.raises(Conflict):
        lost.publish()


def test_undo_restores_rows_and_keeps_what_others_did(spark, tmp_path):
    s = Store(spark, str(tmp_path))
    s.commit("full_docs", _rows(spark, s, [f"d{i}" for i in range(20)]))
    n = s.change("full_docs", _rows(spark, s, ["d1", "new"], "y"), _rows(spark, s, ["d2"]).select("id"))
    s.change("full_docs", _rows(spark, s, ["d7"], "other"))
    s.undo(n)
    assert _ids(s.read("full_docs")) == {(f"d{i}", "other" if i == 7 else "x") for i in range(20)}
    m = s.change("full_docs", _rows(spark, s, ["d3"], "y"))
    k = s.change("full_docs", _rows(spark, s, ["d3"], "z"))
    with pytest.raises(Conflict):
        s.undo(m)
    s.undo(k)
    s.undo(m)
    assert ("d3", "x") in _ids(s.read("full_docs"))


def test_layers_meet_in_place_are_written_as_one_and_undone(spark, tmp_path):
    s = Store(spark, str(tmp_path), buckets=2)
    rows = lambda ids, by: spark.createDataFrame([(i, f"{i}@1", by) for i in ids], s.schema("lc_documents"))
    read = lambda: {(r.id, r.updated_by) for r in s.read("lc_documents").collect()}
    s.change("lc_documents", rows("abcdef", "0"))
    s.change("lc_documents", rows("ab", "1"), spark.createDataFrame([("c",)], "id string"))
    plan = s.read("lc_documents")._jdf.queryExecution().executedPlan().toString()
    assert "Join" in plan and "Exchange" not in plan
    want = {("a", "1"), ("b", "1"), ("d", "0"), ("e", "0"), ("f", "0")}
    assert read() == want
    for t in spark.catalog.listTables(pattern="dealt_*"):  # as in another session
        spark.sql(f"DROP TABLE {t.name}")
    assert read() == want
    last = [s.change("lc_documents", rows("d", str(k))) for k in range(2, 10)]
    assert len(s.manifest()["tables"]["lc_documents"]["layers"]) <= 8 and read() == want - {("d", "0")} | {("d", "9")}
    with pytest.raises(Conflict):
        s.undo(last[-2])
    s.undo(last[-1])
    assert read() == want - {("d", "0")} | {("d", "8")}
    s.undo(2)  # others came on top, of other rows
    assert read() == {(i, "0") for i in "abcef"} | {("d", "8")}
