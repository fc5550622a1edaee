import json
import re

from pyspark.sql import functions as F

from tessera.operators import chunking, review, versions


def test_offsets_name_the_place_of_every_chunk(spark):
    rows = [(1, "  a b\tc  a b\n\nc a b c "), (2, "x"), (3, ""), (4, None), (5, "same same " * 7)]
    df = spark.createDataFrame(rows, "doc long, body string")
    got = chunking.windows_with_offsets(df, "body", 4, 1).collect()
    texts = dict(rows)
    for r in got:
        text = texts[r.doc]
        spans = [m.span() for m in re.finditer(r"[^\x20\x09-\x0d]+", text)][3 * r.chunk_order_index :][:4]
        assert (r.start, r.start + r.length, r.tokens) == (spans[0][0], spans[-1][1], len(spans))
        assert r.content == text[r.start : r.start + r.length]
    assert {r.doc for r in got} == {1, 2, 5}


def test_sections_cover_blocks_without_overlap(spark):
    body = "before\nUS1 first\nintro\n# one\na@b\n\n# two\n  \nUS2 second\nend"
    df = spark.createDataFrame([(1, body), (2, "no title\n# here"), (3, None), (4, "US3 only")], "id long, text string")
    units = chunking.section_units(df, "id", "text", F.col("line").rlike("^US"), F.col("line").startswith("#"), {"mail": F.contains("content", F.lit("@"))})
    got = sorted(units.collect(), key=lambda r: (r.id, r.start))
    assert [(r.id, r.block, r.section, r.title, r.kind) for r in got] == [
        (1, 1, 0, "US1 first", "unknown"), (1, 1, 1, "US1 first", "mail"), (1, 1, 2, "US1 first", "unknown"), (1, 2, 0, "US2 second", "unknown"), (2, 0, 0, None, "unknown"), (2, 0, 1, None, "unknown"), (4, 1, 0, "US3 only", "unknown"),
    ]
    own = [r for r in got if r.id == 1]
    assert all(a.start + a.length == b.start for a, b in zip(own, own[1:])) and own[-1].start + own[-1].length == len(body)
    assert all(r.content == body[r.start : r.start + r.length] for r in own) and len({r.unit_id for r in got}) == len(got)


def test_units_name_terms_of_several_words(spark):
    units = spark.createDataFrame([("u1", "The Big Red dog, big red. Dog"), ("u2", "nothing"), ("u3", None)], "unit_id string, content string")
    objects = spark.createDataFrame([("o1", "T", "big red"), ("o2", "T", "dog"), ("o3", "T", "red big"), ("o4", "T", "THE")], "object_id string, object_type string, term string")
    got = {r.unit_id: (r.n_known, [x["object_id"] for x in json.loads(r.context)["knownObjects"]]) for r in chunking.enrich_units(units, objects).collect()}
    assert got == {"u1": (3, ["o1", "o2", "o4"]), "u2": (0, []), "u3": (0, [])}


def test_faults_of_nested_json(spark):
    docs = [(1, '{"a": 1, "list": [{"kind": "x", "bad": {"bad": 2}}, {"kind": "q"}, []], "deep": {"a": null}}'), (2, "[1, 2"), (3, "{}"), (4, None), (5, '"text"')]
    df = spark.createDataFrame(docs, "id long, body string")
    got = review.json_faults(df, "id", "body", {"$": ["a", "list"]}, {"$.list[].kind": ["x", "y"]}, {"$.list": ["bad"]}, {"$.a": "string", "$.deep.a": "null"}).collect()
    assert sorted(map(tuple, got)) == [
        (1, "$.a", "WRONG_KIND"), (1, "$.list[0].bad", "BANNED_FIELD"), (1, "$.list[0].bad.bad", "BANNED_FIELD"), (1, "$.list[1].kind", "VALUE_NOT_ALLOWED"), (2, "$", "NOT_JSON"),
        (3, "$.a", "REQUIRED_KEY"), (3, "$.list", "REQUIRED_KEY"), (4, "$", "NOT_JSON"),
    ]


def test_version_relations_of_a_large_group_are_linear(spark):
    n = 3000
    rows = [("g", f"o{i:05d}", f"v{i}", "it is editable" if i % 2 else "it is readonly", "replaces" if i == 7 else "", True, False, "UNKNOWN", ["v0"] if i in (7, 9) else []) for i in range(n)]
    rows += [("", "lost", "v1", "", "", True, False, None, None), ("h", "bare", "v1", "", "", None, None, None, None), ("h", "alone", "v2", "yes", "", True, True, "CURRENT", None)]
    df = spark.createDataFrame(rows, "group_key string, object_key string, version string, rule_text string, evidence_text string, has_evidence boolean, latest boolean, status string, supersedes array<string>")
    relations, issues, coverage = versions.version_relations(df)
    counts = {r.relation: r["count"] for r in relations.groupBy("relation").count().collect()}
    assert counts == {"HAS_VERSION": n + 1, "SUPERSEDES": 1, "VERSION_CONFLICT": n, "VERSION_REVIEW_REQUIRED": n}
    assert {(r.object_key, r.code) for r in issues.collect()} == {("lost", "MISSING_VERSION_GROUP_KEY"), ("bare", "MISSING_VERSION_EVIDENCE"), ("o00009", "UNSAFE_SUPERSEDES_BLOCKED")}
    assert coverage.first().passed is False and coverage.first().n_version_conflict == n


def test_a_field_is_not_present_because_of_another_whose_name_has_a_dot(spark):
    df = spark.createDataFrame([(1, '{"x": {}, "x.version": 1}'), (2, '{"x": {"version": 1}}')], "id long, body string")
    assert sorted(map(tuple, review.json_faults(df, "id", "body", {"$.x": ["version"]}).collect())) == [(1, "$.x.version", "REQUIRED_KEY")]
