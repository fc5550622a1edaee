import re
import shutil

import pyarrow as pa
import pytest

from tessera.operators import gates
from tessera.sources import exchange
from tessera.sources.tables import Store

SECTION = [("a", "x|y"), ("b", None), ("c", "<&>\n2")]


@pytest.fixture
def section(spark):
    return {"entities": spark.createDataFrame(SECTION, "name string, data string").coalesce(1), "relations": spark.createDataFrame([], "a string, b string")}


def _text(spark, path):
    return [r.value for r in spark.read.text(path).collect()]


def test_markdown_and_text(spark, tmp_path, section):
    exchange.export_sections(section, str(tmp_path / "md"), "md")
    assert _text(spark, str(tmp_path / "md" / "entities")) == ["## Entities", "", "| name | data |", "| --- | --- |", "| a | x\\|y |", "| b |  |", "| c | <&> 2 |", ""]
    assert _text(spark, str(tmp_path / "md" / "relations")) == []
    exchange.export_sections(section, str(tmp_path / "txt"), "txt")
    assert _text(spark, str(tmp_path / "txt" / "entities"))[:6] == ["name: a", "data: x|y", "", "name: b", "data: ", ""]
    with pytest.raises(ValueError):
        exchange.export_sections(section, str(tmp_path / "pdf"), "pdf")


def test_a_sheet_that_is_full_opens_the_next(monkeypatch):
    monkeypatch.setattr(exchange, "SHEET_ROWS", 3)
    batch = pa.RecordBatch.from_arrays([pa.array([str(i) for i in range(5)])], ["n"])
    out = "\n".join(v for b in exchange._table(["n"], "Parts", "excel")(iter([batch, batch])) for v in b.column(0).to_pylist())
    from xml.etree import ElementTree

    ns = "{urn:schemas-microsoft-com:office:spreadsheet}"
    sheets = ElementTree.fromstring(out.split("?>", 1)[1]).findall(f"{ns}Worksheet")
    values = [[d.text for d in s.iter(f"{ns}Data")] for s in sheets]
    assert [s.get(f"{ns}Name") for s in sheets] == ["Parts", "Parts 2", "Parts 3", "Parts 4", "Parts 5"]
    assert all(v[0] == "n" and len(v) == 3 for v in values) and [x for v in values for x in v[1:]] == [str(i) for i in range(5)] * 2


def test_graph_sections_with_vectors(spark):
    nodes = spark.createDataFrame([("a", "T", ["c1", "c2"], [1.0]), ("b", "T", None, [2.0])], "id string, entity_type string, source_ids array<string>, vector array<float>")
    edges = spark.createDataFrame([("a", "b", 2.0, ["c1"], [3.0]), ("a", "a", 1.0, [], [4.0])], "src string, tgt string, weight double, source_ids array<string>, vector array<float>")
    got = exchange.graph_sections(nodes, edges, vectors=True)
    entities = {r.entity_name: r for r in got["entities"].collect()}
    assert entities["a"].source_id == "c1<SEP>c2" and "vector" not in entities["a"].graph_data and '"vector":[1.0]' in entities["a"].vector_data
    assert {(r.src_entity, r.tgt_entity, r.source_id) for r in got["relations"].collect()} == {("a", "b", "c1"), ("b", "a", "c1")}
    assert all(re.fullmatch("rel-[0-9a-f]{32}", r.relationship_id) for r in got["relationships"].collect())


def test_json_is_repaired_and_counted(spark, tmp_path):
    at = str(tmp_path / "out")
    rows = spark.sql("SELECT 1 AS id, cast(X'61FF62' AS string) AS t, map('k', array('fine')) AS m UNION ALL SELECT 2, '�', map('k', array(cast(X'FE' AS string))) UNION ALL SELECT 3, null, null")
    assert exchange.write_json(rows, at) == 2
    back = {r.id: (r.t, r.m and r.m["k"]) for r in exchange.load_json(spark, at, "id int, t string, m map<string,array<string>>").collect()}
    assert back == {1: ("ab", ["fine"]), 2: ("�", [""]), 3: (None, None)}
    assert exchange.write_json(rows.where("id = 3"), at) == 0
    assert exchange.load_json(spark, str(tmp_path / "none")) is None


def test_a_batch_that_cannot_be_read_is_noted_and_the_others_are_copied(spark, tmp_path):
    source, target = Store(spark, str(tmp_path / "a")), Store(spark, str(tmp_path / "b"))
    rows = [(f"default:{k}:{i}", "r", k, None, None, None, 1, 1) for k in ("extract", "summary", "query") for i in range(20)]
    source.commit("llm_response_cache", spark.createDataFrame(rows, source.read("llm_response_cache").schema))
    assert [r.error for r in exchange.copy_cache(Store(spark, str(tmp_path / "c")), target).collect()] == []
    entry = source.manifest()["tables"]["llm_response_cache"]
    lost = sorted(map(int, entry["folders"]))[0]
    gone = {r.id for r in source.load("llm_response_cache", entry, set(sorted(map(int, entry["folders"]))[0::4])).collect()}
    kept, away = source.at("llm_response_cache", entry["folders"][str(lost)], f"__bucket={lost}"), str(tmp_path / "away")
    shutil.move(kept, away)
    log = {r.batch: r for r in exchange.copy_cache(source, target).collect()}
    assert log[0].error and log[0].n == 0 and all(log[b].error is None for b in (1, 2, 3))
    wanted = {r[0] for r in rows if r[2] != "query"}
    assert {r.id for r in target.read("llm_response_cache").collect()} == wanted - gone
    shutil.move(away, kept)
    assert all(r.error is None for r in exchange.copy_cache(source, target).collect())
    assert {r.id for r in target.read("llm_response_cache").collect()} == wanted


def test_relations_without_need_of_evidence(spark):
    rows = [("SELLS,x", None, False), ("sold_by", "SELLS", True), (None, "CandidateRelation", True), ("MADE_OF SELLS", "SELLS", True), ("plain", "odd", True)]
    c = spark.createDataFrame([(i, *r, True, "f", "d") for i, r in enumerate(rows)], "id int, keywords string, relation_type string, has_evidence boolean, has_span boolean, feature_key string, domain_code string")
    got = {r.id: (r.relation_type, r.status, r.confidence, r.issues) for r in gates.validate_relations(c, ["SELLS", "MADE_OF"], evidence_required=False).collect()}
    assert got == {
        0: ("SELLS", "VALID", 0.9, []), 1: ("SELLS", "INVALID_TYPE", 0.2, ["SNAKE_CASE_RELATION"]), 2: ("CandidateRelation", "REVIEW_REQUIRED", 0.5, []),
        3: ("SELLS", "VALID", 0.9, []), 4: (None, "REVIEW_REQUIRED", 0.5, ["INVALID_RELATION_TYPE"]),
    }


def test_csv_files_hold_a_bounded_number_of_rows(spark, tmp_path, monkeypatch):
    """One task that writes many rows writes several files, so that no reader has them all."""
    import os

    monkeypatch.setattr(exchange, "CSV_ROWS", 100)
    exchange.export_sections({"s": spark.range(950).selectExpr("id", "concat('a\n', id) AS t").coalesce(1)}, f"{tmp_path}/out")
    assert len([f for f in os.listdir(f"{tmp_path}/out/s") if f.endswith(".csv")]) == 10
    back = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(f"{tmp_path}/out/s")
    assert {(r.id, r.t) for r in back.collect()} == {(str(i), f"a\n{i}") for i in range(950)}


def test_an_exported_graph_takes_a_part_of_its_text_and_groups_edges_once(spark, monkeypatch):
    import os

    from tessera.plans import all_queries
    from tessera.sources.scratch import scratch_dir

    at = []
    write = exchange.export_sections
    monkeypatch.setattr(exchange, "export_sections", lambda sections, path, *a, **k: (at.append((sections, path)), write(sections, path, *a, **k)))
    found = all_queries()[0]["src_export_graph"](spark, "/root/testdata/sf0.001")
    ((sections, path),) = at
    assert path.startswith(scratch_dir(spark))
    folder = path.removeprefix("file://")
    held = sum(os.path.getsize(os.path.join(a, f)) for a, _, names in os.walk(folder) for f in names if f.startswith("part-"))
    texts = sum(spark.read.text(f"{path}/{name}").selectExpr("sum(length(value))").first()[0] for name in sections)
    assert held < texts / 3
    assert {name: found.where(f"section = '{name}'").count() for name in sections} == {name: rows.count() for name, rows in sections.items()}
    assert all("lineitem" not in f for name in ("relations", "relationships") for f in sections[name].inputFiles())
