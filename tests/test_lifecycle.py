import pytest

from tessera.plans.lifecycle import Lifecycle
from tessera.sources.tables import Conflict, Store

COLUMNS = "document_id string, version_id string, kind string, object_id string, payload string, hash string"
DATA = ("lc_documents", "lc_versions", "lc_contributions", "lc_objects", "lc_tombstones")
STEPS = ["STAGE_VERSION", "UPSERT_OBJECTS", "VALIDATE", "ACTIVATE", "DEACTIVATE_OLD", "DELETE_OBJECTS"]


def bundle(spark, *rows):
    return spark.createDataFrame([(d, f"{d}@{v}", kind, o, p, f"h{p}") for d, v, kind, o, p in rows], COLUMNS)


def tables(store):
    return {t: sorted(map(str, store.read(t).collect())) for t in DATA}


@pytest.fixture
def life(spark, tmp_path):
    made = Lifecycle(Store(spark, str(tmp_path), buckets=2), lambda texts: [[float(len(t))] for t in texts])
    first = bundle(spark, ("a", 1, "node", "x", "one"), ("a", 1, "node", "y", "two"), ("a", 1, "edge", "x-y", "e"), ("b", 1, "node", "y", "two"), ("b", 1, "node", "y", "two"))
    got = made.register(first, "r")
    assert (got.status, got.n_applied, got.embedded, got.reused) == ("APPLIED", 6, 3, 0)
    return made


def test_every_step_can_fail_and_leaves_the_tables_as_before(spark, life):
    before = tables(life.store)
    new = bundle(spark, ("a", 2, "node", "x", "changed"), ("a", 2, "node", "z", "new"))
    for i, step in enumerate(STEPS):
        if i in (1, 4):
            continue  # each takes a while
        got = life.upsert(new, f"u{i}", fail_after=step)
        assert (got.status, got.n_applied, got.n_compensated) == ("COMPENSATED", i + 1, i + 1) and step in got.error
        assert tables(life.store) == before
    log = {r.id: r.status for r in life.store.read("lc_mutations").collect()}
    assert log.pop("REGISTER:r") == "APPLIED" and set(log.values()) == {"COMPENSATED"}
    steps = {r.action: r.status for r in life.store.read("lc_steps").where("mutation_id = 'UPSERT_NEW_VERSION:u2'").collect()}
    assert steps == dict.fromkeys(STEPS[:3], "COMPENSATED") | dict.fromkeys(STEPS[3:], "PENDING")
    got = life.upsert(new, "bad", fail_after="ACTIVATE", fail_compensation="VALIDATE")
    assert (got.status, got.n_compensated) == ("FAILED", 1)
    assert {r.id: r.status for r in life.store.read("lc_versions").collect()} == {"a@1": "ACTIVE", "b@1": "ACTIVE", "a@2": "REBUILD_REQUIRED"}


def test_replace_delete_rebuild_and_undo(spark, life):
    store = life.store
    before = tables(store)
    got = life.upsert(bundle(spark, ("a", 2, "node", "x", "one"), ("a", 2, "node", "z", "new")), "u")
    assert (got.status, got.embedded, got.reused) == ("APPLIED", 1, 1)
    assert {(r.object_id, r.payload) for r in store.read("lc_objects").collect()} == {("x", "one"), ("y", "two"), ("z", "new")}  # y is b's too
    assert {r.id: r.active_version for r in store.read("lc_documents").collect()} == {"a": "a@2", "b": "b@1"}
    life.delete_versions(spark.createDataFrame([("b@1",)], "version_id string"), "d")
    assert {r.object_id for r in store.read("lc_objects").collect()} == {"x", "z"}
    assert {(r.document_id, r.version_id, r.scope) for r in store.read("lc_tombstones").collect()} == {("b", "b@1", "DOCUMENT_VERSION")}
    whole = tables(store)
    store.change("lc_objects", None, spark.createDataFrame([("node:z",)], "id string"))
    store.change("lc_objects", store.read("lc_objects").limit(1).selectExpr("'node:stray' AS id", "'node' AS kind", "'stray' AS object_id", "payload", "hash", "vector"))
    assert life.rebuild(spark.createDataFrame([("a@2",)], "version_id string"), "again").status == "APPLIED"
    assert tables(store)["lc_objects"] == whole["lc_objects"]
    with pytest.raises(Conflict):
        life.compensate("UPSERT_NEW_VERSION:u")
    assert life.delete_documents(spark.createDataFrame([("a",)], "document_id string"), "all").status == "APPLIED"
    assert store.read("lc_objects").count() == 0
    for m in ("DELETE_DOCUMENT:all", "REBUILD:again"):
        life.compensate(m)
    with pytest.raises(ValueError):
        life.compensate("REBUILD:again")
    assert before["lc_tombstones"] == []


def test_a_new_version_writes_its_own_rows_alone(spark, tmp_path):
    life = Lifecycle(Store(spark, str(tmp_path), buckets=2), lambda texts: [[float(len(t))] for t in texts])
    store = life.store
    life.register(bundle(spark, *[(f"d{i}", 1, "node", f"x{i % 7}", "one") for i in range(60)]), "r")
    known = set(store.names(store.at("lc_contributions")))
    life.upsert(bundle(spark, ("d1", 2, "node", "x1", "two"), ("d1", 2, "node", "y", "two")), "u")
    new = [f for f in store.names(store.at("lc_contributions")) if f not in known]
    written = sum(spark.read.parquet(store.at("lc_contributions", f)).count() for f in new)
    assert written == 3  # two rows of the new version, one of the old that is not active any more
    assert store.read("lc_contributions").where("active").count() == 61
    # a version that is put again keeps what else it contributed
    life.upsert(bundle(spark, ("d1", 2, "node", "y", "three")), "again")
    got = {(r.object_id, r.payload) for r in store.read("lc_contributions").where("version_id = 'd1@2' and active").collect()}
    assert got == {("x1", "two"), ("y", "three")}
    life.compensate("UPSERT_NEW_VERSION:again")
    life.compensate("UPSERT_NEW_VERSION:u")
    assert {(r.id, r.active_version) for r in store.read("lc_documents").where("id = 'd1'").collect()} == {("d1", "d1@1")}
    assert store.read("lc_contributions").where("active").count() == 60


def test_a_deletion_writes_its_own_rows_alone(spark, tmp_path):
    life = Lifecycle(Store(spark, str(tmp_path), buckets=2), lambda texts: [[float(len(t))] for t in texts])
    store = life.store
    life.register(bundle(spark, *[(f"d{i}", 1, "node", f"x{i % 7}", "one") for i in range(60)], ("d7", 1, "node", "own", "one")), "r")
    known = set(store.names(store.at("lc_contributions")))
    life.delete_documents(spark.createDataFrame([("d7",)], "document_id string"), "d")
    new = [f for f in store.names(store.at("lc_contributions")) if f not in known]
    assert sum(spark.read.parquet(store.at("lc_contributions", f)).count() for f in new) == 2
    assert store.read("lc_contributions").where("not active").count() == 2
    assert {r.object_id for r in store.read("lc_objects").collect()} == {f"x{i}" for i in range(7)}


def test_rows_are_deactivated_where_they_are(spark, tmp_path, monkeypatch):
    from tessera.sources import tables as module

    life = Lifecycle(Store(spark, str(tmp_path), buckets=2), lambda texts: [[float(len(t))] for t in texts])
    store = life.store
    life.register(bundle(spark, *[(f"d{i}", 1, "node", f"x{i % 7}", "one") for i in range(60)]), "r")
    assert [len(store.manifest()["tables"][x]["layers"]) for x in ("lc_objects", "lc_contributions")] == [1, 1]  # nothing to look for
    life.upsert(bundle(spark, *[(f"d{i}", 2, "node", f"x{i % 5}", "two") for i in range(30)]), "u")
    deal, plans = module.deal, []

    def seen(rows, path, n, by, aligned=False):
        if "lc_contributions" in path or "lc_versions" in path:
            plans.append((rows if aligned else rows.repartition(n, by))._jdf.queryExecution().executedPlan().toString())
        deal(rows, path, n, by, aligned)

    monkeypatch.setattr(module, "deal", seen)
    life.delete_documents(spark.createDataFrame([(f"d{i}",) for i in range(20, 40)], "document_id string"), "d")
    assert len(plans) == 2 and not any("Exchange" in p for p in plans)
    got = store.read("lc_contributions").where("active").select("version_id").collect()
    assert sorted(r.version_id for r in got) == sorted([f"d{i}@2" for i in range(20)] + [f"d{i}@1" for i in range(40, 60)])
    assert store.read("lc_contributions").count() == 90
    assert {(r.object_id, r.payload) for r in store.read("lc_objects").collect()} == {(f"x{i}", "two") for i in range(5)} | {("x5", "one"), ("x6", "one")}
