import re
import shutil
import zlib

import numpy as np
import pytest

from tessera.plans.engine import Engine
from tessera.plans.retrieval import MODES, QueryParam
from tessera.sources.tables import Store, Transaction


def embed(texts):
    out = np.zeros((len(texts), 16), np.float32)
    for i, t in enumerate(texts):
        for w in re.findall(r"\w+", t.lower()):
            out[i, zlib.crc32(w.encode()) % 16] += 1
    return out


def extract(texts):
    answers = []
    for t in texts:
        names = re.findall(r"[A-Z]\w+", t)
        lines = [f"entity<|#|>{n}<|#|>Person<|#|>{n} appears" for n in names]
        lines += [f"relation<|##|>{a}<|#|>{b}<|#|>near,next<|#|>{a} with {b}<|#|>2" for a, b in zip(names, names[1:])]
        answers.append("\n".join([*lines, "<|COMPLETE|>"]))
    return answers


@pytest.fixture
def engine(spark, tmp_path):
    e = Engine(Store(spark, str(tmp_path)), embed, extract, 8, 2)
    texts = [(0, "Alice met Bob near the river", "a.txt"), (1, "Carol met Bob", "b.txt"), (2, "Carol met Bob", "c.txt")]
    e.insert(spark.createDataFrame(texts, "pos long, text string, file_path string"))
    return e


def test_insert_query_and_delete(spark, engine):
    store = engine.store
    status = {(r.status, r.file_path) for r in store.read("doc_status").collect()}
    assert status == {("processed", "a.txt"), ("processed", "b.txt"), ("failed", "c.txt")}
    assert {r.id for r in store.read("nodes").collect()} == {"Alice", "Bob", "Carol"}
    assert {(r.src, r.tgt, r.weight) for r in store.read("edges").collect()} == {("Alice", "Bob", 2.0), ("Bob", "Carol", 2.0)}
    for mode in MODES:
        got = engine.query("Alice met Bob", QueryParam(mode=mode))
        if mode not in ("bypass",):
            assert got["chunks"].count() > 0
            assert {r.file_path for r in got["references"].collect()} <= {"a.txt", "b.txt"}
        if mode in ("local", "global", "hybrid", "mix"):
            assert got["entities"].count() and got["relations"].count()
    doc = store.read("doc_status").where("file_path = 'a.txt'").first()
    impact = {r.entity: r.action for r in engine.delete(doc.id).collect()}
    assert impact == {"Alice": "delete", "Bob": "rebuild", "Carol": "keep"}
    assert {r.id for r in store.read("nodes").collect()} == {"Bob", "Carol"}
    assert store.read("full_docs").count() == 1


def test_unknown_mode(engine):
    with pytest.raises(ValueError):
        engine.query("x", QueryParam(mode="other"))


def test_entities_of_more_chunks_than_nodes_keep(spark, tmp_path):
    """A document whose chunk the node's capped list has lost still counts when it goes, and what is left is built again."""

    def told(texts):
        return [f"entity<|#|>Alice<|#|>Person<|#|>says {t}\nentity<|#|>Bob<|#|>Person<|#|>hears {t}\nrelation<|#|>Alice<|#|>Bob<|#|>talk<|#|>on {t}<|#|>2\n<|COMPLETE|>" for t in texts]

    e = Engine(Store(spark, str(tmp_path)), embed, told, 8, 2)
    e.insert(spark.createDataFrame([(i, f"topic{i} word", f"{i}.txt") for i in range(305)], "pos long, text string, file_path string"))
    alice = e.store.read("nodes").where("id = 'Alice'").first()
    assert len(alice.source_ids) == 300
    assert e.store.read("entity_chunks").where("id = 'Alice'").first()["count"] == 305
    lost = next(r for r in e.store.read("doc_status").collect() if r.chunks_list[0] not in alice.source_ids)
    topic = lost.content_summary
    assert {r.entity: (r.action, r.n_left) for r in e.delete(lost.id).collect()} == {"Alice": ("rebuild", 304), "Bob": ("rebuild", 304)}
    alice, edge = e.store.read("nodes").where("id = 'Alice'").first(), e.store.read("edges").first()
    assert f"says {topic}" not in alice.description.split("<SEP>") and len(alice.description.split("<SEP>")) == 304
    assert edge.weight == 608 and len(edge.source_ids) == 304 and f"on {topic}" not in edge.description.split("<SEP>")
    assert e.store.read("relation_chunks").first()["count"] == 304


NOTES = [(0, "Alice met Bob", "a.txt"), (0, "Bob met Carol by Alice", "b.txt"), (0, "Bob met Carol by Alice", "c.txt"), (7, "Carol left &amp; Dave stayed", "d.txt")]
COLUMNS = "pos long, text string, file_path string"
TABLES = ("doc_status", "full_docs", "chunks", "text_chunks", "nodes", "edges", "entity_chunks", "relation_chunks", "full_entities", "full_relations", "llm_response_cache", "extractions")


def tables(store):
    drop = ("created_at", "updated_at")
    return {name: sorted(map(str, store.read(name).drop(*drop).collect())) for name in TABLES}


class Lost(BaseException):
    """The job is gone."""


def broken_at(m, stage):
    """Transactions stop when a stage has been done but not noted."""
    whole = Transaction.stage

    def run(self, name, work):
        def then():
            work()
            if name == stage:
                raise Lost

        return whole(self, name, then)

    m.setattr(Transaction, "stage", run)


@pytest.fixture(scope="module")
def taken_in(spark, tmp_path_factory):
    """A store with four texts at overlapping positions, taken in after a loss at each stage."""
    at = tmp_path_factory.mktemp("taken")
    e = Engine(Store(spark, str(at), buckets=4), embed, extract, 8, 2)
    rows = spark.createDataFrame(NOTES, COLUMNS)
    for stage in ("chunks", "entities", "status"):
        with pytest.MonkeyPatch.context() as m, pytest.raises(Lost):
            broken_at(m, stage)
            e.insert(rows) if stage == "chunks" else e.process()
        assert {r.status for r in e.store.read("doc_status").collect()} == {"pending", "failed"}
        assert e.store.read("nodes").count() == 0
    e.process()
    return e


def copied(e, tmp_path):
    """The same store in a folder of its own."""
    shutil.copytree(e.store.root, tmp_path / "copy")
    return Engine(Store(e.store.spark, str(tmp_path / "copy"), buckets=4), e.embed, e.extract, e.chunk_tokens, e.chunk_overlap)


def test_an_insert_that_is_lost_goes_on_and_contents_go_by_hash(spark, taken_in, tmp_path):
    store = taken_in.store
    assert {(r.file_path, r.content) for r in store.read("full_docs").collect()} == {("a.txt", "Alice met Bob"), ("b.txt", "Bob met Carol by Alice"), ("d.txt", "Carol left & Dave stayed")}
    assert sorted(r.status for r in store.read("doc_status").collect()) == ["failed"] + ["processed"] * 3
    whole = Engine(Store(spark, str(tmp_path / "whole")), embed, extract, 8, 2)
    whole.insert(spark.createDataFrame(NOTES, COLUMNS))
    assert tables(store) == tables(whole.store)
    names = {r.id: set(r.entity_names) for r in store.read("full_entities").collect()}
    assert sorted(map(sorted, names.values())) == [["Alice", "Bob"], ["Alice", "Bob", "Carol"], ["Carol", "Dave"]]
    assert taken_in.process() == 0


def test_a_deletion_broken_at_any_stage_goes_on(taken_in, tmp_path):
    doc = next(r.id for r in taken_in.store.read("doc_status").collect() if r.file_path == "b.txt" and r.status == "processed")
    (tmp_path / "a").mkdir()
    (tmp_path / "b").mkdir()
    plain, other = copied(taken_in, tmp_path / "a"), copied(taken_in, tmp_path / "b")
    before = tables(other.store)
    plain.delete(doc)
    for stage in ("plan", "chunks", "relations", "entities", "cache", "documents"):
        with pytest.MonkeyPatch.context() as m, pytest.raises(Lost):
            broken_at(m, stage)
            other.delete(doc)
        assert other.store.latest() == taken_in.store.latest()
    assert tables(other.store) == before
    done = []
    with pytest.MonkeyPatch.context() as m:
        whole = Transaction.stage
        m.setattr(Transaction, "stage", lambda self, name, work: whole(self, name, lambda: (done.append(name), work())))
        impact = {r.entity: r.action for r in other.delete(doc).collect()}
    assert done == ["documents"]  # the others had been noted
    assert impact == {"Alice": "rebuild", "Bob": "rebuild", "Carol": "rebuild", "Dave": "keep"}
    assert tables(other.store) == tables(plain.store)
    assert {(r.src, r.tgt) for r in other.store.read("edges").collect()} == {("Alice", "Bob"), ("Carol", "Dave")}


def test_a_bad_chunk_fails_its_document_alone_and_is_tried_again(spark, tmp_path):
    def picky(texts):
        if any("Zed" in t for t in texts):
            raise ValueError("no Zed")
        return extract(texts)

    e = Engine(Store(spark, str(tmp_path), buckets=4), embed, picky, 8, 2)
    e.insert(spark.createDataFrame([(0, "Alice met Bob", "a.txt"), (1, "Zed met Bob", "z.txt")], COLUMNS))
    got = {r.file_path: (r.status, r.error_msg) for r in e.store.read("doc_status").collect()}
    assert got == {"a.txt": ("processed", None), "z.txt": ("failed", "ValueError: no Zed")}
    assert {r.id for r in e.store.read("nodes").collect()} == {"Alice", "Bob"}
    well = Engine(e.store, embed, extract, 8, 2)
    assert well.process() == 1
    assert {r.status for r in e.store.read("doc_status").collect()} == {"processed"}
    assert {r.id for r in e.store.read("nodes").collect()} == {"Alice", "Bob", "Zed"}


def test_a_second_pass_adds_what_was_missed_within_its_budget(spark, tmp_path):
    asked = []

    def glean(texts, answers):
        asked.extend(texts)
        return ["entity<|#|>Alice<|#|>Person<|#|>Alice appears at length\nentity<|#|>Bob<|#|>Person<|#|>B\nentity<|#|>Eve<|#|>Person<|#|>missed\n<|COMPLETE|>" for _ in texts]

    e = Engine(Store(spark, str(tmp_path), buckets=4), embed, extract, 8, 2, glean, 13)
    e.insert(spark.createDataFrame([(0, "Alice met Bob", "a.txt"), (1, "Fay met Gus by the mill", "b.txt")], COLUMNS))
    got = {r.id: r.description for r in e.store.read("nodes").collect()}
    assert got == {"Alice": "Alice appears at length", "Bob": "Bob appears", "Eve": "missed", "Fay": "Fay appears", "Gus": "Gus appears"}


def test_edits_bring_vectors_and_lists_along(taken_in, tmp_path):
    e = copied(taken_in, tmp_path)
    store = e.store
    old = {r.id: r for r in store.read("nodes").collect()}
    e.edit_entity("Bob", {"description": "the builder"}, "Robert")
    nodes = {r.id: r for r in store.read("nodes").collect()}
    assert set(nodes) == {"Alice", "Robert", "Carol", "Dave"} and nodes["Robert"].description == "the builder"
    assert nodes["Robert"].vector == embed(["Robert\nthe builder"])[0].tolist() and nodes["Alice"] == old["Alice"]
    edges = {(r.src, r.tgt): r for r in store.read("edges").collect()}
    assert set(edges) == {("Alice", "Robert"), ("Carol", "Robert"), ("Alice", "Carol"), ("Carol", "Dave")}
    assert {r.id for r in store.read("relation_chunks").collect()} == {f"{a}<SEP>{b}" for a, b in edges}
    assert {r.id for r in store.read("entity_chunks").collect()} == set(nodes)
    with pytest.raises(ValueError):
        e.edit_entity("Robert", new_name="Carol")
    e.edit_entity("Robert", new_name="Carol", allow_merge=True)
    edges = {(r.src, r.tgt): r for r in store.read("edges").collect()}
    assert set(edges) == {("Alice", "Carol"), ("Carol", "Dave")} and len(edges["Alice", "Carol"].source_ids) == 2
    assert edges["Alice", "Carol"].keywords == "near,next" and "Alice with Bob" in edges["Alice", "Carol"].description
    e.edit_relation("Dave", "Carol", {"weight": 9.0})
    assert store.read("edges").where("src = 'Carol' and tgt = 'Dave'").first().weight == 9.0
    assert [e.create_entity("Fay", "Person", "new"), e.create_entity("Fay", "Person", "new"), e.create_relation("Fay", "Alice", "knows"), e.create_relation("Fay", "Nobody", "x")] == ["created", "exists", "created", "no_end"]
    e.delete_relation("Dave", "Carol")
    e.delete_entity("Alice")
    assert {(r.src, r.tgt) for r in store.read("edges").collect()} == set() and {r.id for r in store.read("nodes").collect()} == {"Carol", "Dave", "Fay"}
    assert {r.id for r in store.read("relation_chunks").collect()} == set()


def test_untouched_rows_are_not_embedded_again(spark, tmp_path):
    e = Engine(Store(spark, str(tmp_path)), embed, extract, 8, 2)
    e.insert(spark.createDataFrame([(0, "Alice met Bob", "a.txt")], "pos long, text string, file_path string"))
    before = {r.id: r for r in e.store.read("nodes").collect()}
    e.insert(spark.createDataFrame([(0, "Bob met Carol", "b.txt")], "pos long, text string, file_path string"))
    after = {r.id: r for r in e.store.read("nodes").collect()}
    assert after["Alice"] == before["Alice"] and set(after) == {"Alice", "Bob", "Carol"}
    assert {(r.src, r.tgt, r.weight) for r in e.store.read("edges").collect()} == {("Alice", "Bob", 2.0), ("Bob", "Carol", 2.0)}
