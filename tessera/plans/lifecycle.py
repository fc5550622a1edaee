"""Versions of documents and what they contribute to the knowledge base: registered, replaced, deleted, rebuilt, undone.

A call takes any number of documents at once and is a plan of steps, each a change of whole tables.  Steps run in one
transaction of the store, so readers see a mutation as a whole or not at all; what each table was before a step is kept, and
when a step fails the applied ones are reversed from there, last first.  A mutation that was published can be undone later
from the commit before it (:meth:`Lifecycle.compensate`).  The log of mutations and steps is committed on its own and stays.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.ranking import first_of
from tessera.sources.scratch import dealt, materialise, materialise_dealt
from tessera.sources.tables import LAYERED, Store, Transaction

Step = tuple[str, Callable[[Transaction], None]]


@dataclass(frozen=True)
class Outcome:
    """What came of a mutation: APPLIED, COMPENSATED or FAILED; ``embedded`` objects had a new hash, ``reused`` ones had not."""

    mutation_id: str
    status: str
    n_applied: int
    n_compensated: int
    error: str | None = None
    embedded: int = 0
    reused: int = 0


def contributions(bundle: DataFrame) -> DataFrame:
    """Rows of lc_contributions for a bundle (document_id, version_id, kind, object_id, payload, hash); repeated rows count once."""
    rows = first_of(bundle, ["version_id", "kind", "object_id"], "hash", "payload")
    return rows.select(F.concat_ws("|", "version_id", "kind", "object_id").alias("id"), "document_id", "version_id", "kind", "object_id", "payload", "hash", F.lit(True).alias("active"))


def projection(rows: DataFrame) -> DataFrame:
    """The objects of contributions, one row each; where documents differ the one with the smallest id counts."""
    return first_of(rows, ["kind", "object_id"], "document_id", "version_id").select(F.concat_ws(":", "kind", "object_id").alias("id"), "kind", "object_id", "payload", "hash")


@dataclass(frozen=True)
class Lifecycle:
    """``embed`` maps payloads to rows of vectors."""

    store: Store
    embed: Callable[[list[str]], np.ndarray]

    # --- the five operations ---

    def register(self, bundle: DataFrame, batch: str, **stop: str) -> Outcome:
        """First versions of documents."""
        return self._put("REGISTER", bundle, batch, **stop)

    def upsert(self, bundle: DataFrame, batch: str, **stop: str) -> Outcome:
        """New versions of documents: objects of a new hash are written and embedded, the new versions become active, the old
        ones are superseded, and objects that no active version contributes any more go."""
        return self._put("UPSERT_NEW_VERSION", bundle, batch, **stop)

    def delete_versions(self, versions: DataFrame, batch: str, **stop: str) -> Outcome:
        """Take versions (version_id) out; documents whose active version goes have none then."""
        gone = self.store.read("lc_versions").join(versions.select(F.col("version_id").alias("id")).distinct(), "id", "left_semi")
        return self._drop("DELETE_VERSION", gone, "DOCUMENT_VERSION", batch, **stop)

    def delete_documents(self, documents: DataFrame, batch: str, **stop: str) -> Outcome:
        """Take all versions of documents (document_id) out."""
        gone = self.store.read("lc_versions").join(documents.select("document_id").distinct(), "document_id", "left_semi")
        return self._drop("DELETE_DOCUMENT", gone, "LOGICAL_DOCUMENT", batch, **stop)

    def rebuild(self, versions: DataFrame, batch: str, **stop: str) -> Outcome:
        """Write the objects of versions (version_id) anew from what they contributed, and drop objects nobody contributes."""
        ids = self._dealt(versions.select("version_id").distinct(), "rebuild")
        rows = self.store.read("lc_contributions").join(ids, "version_id", "left_semi")
        counts, wanted = [0, 0], []
        steps: list[Step] = [
            ("MARK_REBUILDING", lambda t: self._state(t, ids, "REBUILDING", batch)),
            ("UPSERT_OBJECTS", lambda t: wanted.append(self._write(t, rows, counts))),
            ("REMOVE_EXTRA", lambda t: t.change("lc_objects", None, self._orphans(t, t.read("lc_objects")))),
            ("VALIDATE", lambda t: self._validate(t, wanted[-1])),
            ("ACTIVATE", lambda t: self._state(t, ids, "ACTIVE", batch)),
        ]
        return self._run("REBUILD", batch, steps, counts, ids, **stop)

    def _put(self, operation: str, bundle: DataFrame, batch: str, **stop: str) -> Outcome:
        store, spark = self.store, self.store.spark
        known = store.manifest()["tables"]
        size = bundle.count() if not any(t in known for t in LAYERED) else 0
        n = {t: store.width(t, lambda: size, known) for t in ("lc_contributions", "lc_documents", "lc_versions")}
        at = lambda table, folder: dealt(spark, store.at(table, folder), n[table], LAYERED[table], store.schema(table))

        # written once, where steps make them layers: rows are moved to the bucket of their version and are counted once there
        told = store.prepare("lc_contributions", contributions(bundle.repartition(n["lc_contributions"], "version_id")), n["lc_contributions"], aligned=True)
        rows = at("lc_contributions", told)
        pairs = rows.select("document_id", "version_id").distinct().repartition(n["lc_documents"], "document_id")
        newest = pairs.groupBy(F.col("document_id").alias("id")).agg(F.max("version_id").alias("active_version")).withColumn("updated_by", F.lit(batch))
        named = store.prepare("lc_documents", newest, n["lc_documents"], aligned=True)
        docs = at("lc_documents", named).select("id", F.col("active_version").alias("new"))
        staged = store.prepare("lc_versions", docs.select(F.col("new").alias("id"), F.col("id").alias("document_id"), F.lit("STAGED").alias("status"), F.lit(batch).alias("updated_by")), n["lc_versions"])
        ids = at("lc_versions", staged).select(F.col("id").alias("version_id"))
        active = store.read("lc_documents").join(docs, "id").where("active_version is not null and active_version <> new")
        old = self._dealt(active.select(F.col("active_version").alias("version_id")), "superseded")
        counts, wanted = [0, 0], []

        def activate(t: Transaction) -> None:
            again = t.read("lc_contributions").join(rows.select("version_id").hint("shuffle_hash"), "version_id", "left_semi")
            if again.isEmpty():
                t.attach("lc_contributions", told, n["lc_contributions"])
            else:  # versions that are put again keep what they contribute beside these rows
                t.change("lc_contributions", rows)
            t.attach("lc_documents", named, n["lc_documents"])
            self._state(t, ids, "ACTIVE", batch)

        steps: list[Step] = [
            ("STAGE_VERSION", lambda t: t.attach("lc_versions", staged, n["lc_versions"])),
            ("UPSERT_OBJECTS", lambda t: wanted.append(self._write(t, rows, counts))),
            ("VALIDATE", lambda t: self._validate(t, wanted[-1])),
            ("ACTIVATE", activate),
            ("DEACTIVATE_OLD", lambda t: self._deactivate(t, old, "SUPERSEDED", batch)),
            ("DELETE_OBJECTS", lambda t: self._delete_objects(t, old)),
        ]
        return self._run(operation, batch, steps, counts, ids, **stop)

    def _drop(self, operation: str, gone: DataFrame, scope: str, batch: str, **stop: str) -> Outcome:
        gone = self._dealt(gone.select(F.col("id").alias("version_id"), "document_id"), "gone")
        ids = gone.select("version_id")

        def activate(t: Transaction) -> None:
            docs = t.read("lc_documents").join(ids.withColumnRenamed("version_id", "active_version"), "active_version", "left_semi")
            t.change("lc_documents", docs.select("id", F.lit(None).cast("string").alias("active_version"), F.lit(batch).alias("updated_by")))

        def bury(t: Transaction) -> None:
            whole = scope == "LOGICAL_DOCUMENT"
            names = gone.select("document_id").distinct().withColumn("version_id", F.lit(None).cast("string")) if whole else gone
            of = F.concat_ws(":", F.lit("tomb"), F.coalesce("version_id", "document_id"), F.lit(batch))
            t.change("lc_tombstones", names.select(of.alias("id"), "document_id", "version_id", F.lit(scope).alias("scope"), F.lit("deleted").alias("reason"), F.lit(batch).alias("deleted_by")))

        steps: list[Step] = [
            ("DEACTIVATE", lambda t: self._deactivate(t, ids, "DELETED", batch)),
            ("ACTIVATE", activate),
            ("DELETE_OBJECTS", lambda t: self._delete_objects(t, ids)),
            ("TOMBSTONE", bury),
        ]
        return self._run(operation, batch, steps, [0, 0], ids, **stop)

    # --- steps ---

    def _dealt(self, versions: DataFrame, name: str) -> DataFrame:
        """Versions (version_id, ...) written once, dealt as contributions are, so that these are found in place."""
        return materialise_dealt(versions, name, self.store.width("lc_contributions"), "version_id")

    @staticmethod
    def _state(t: Transaction, ids: DataFrame, status: str, batch: str) -> None:
        rows = t.read("lc_versions").join(ids.select(F.col("version_id").alias("id")).hint("shuffle_hash"), "id", "left_semi")
        alike = t.width("lc_versions") == t.width("lc_contributions")  # ids are dealt as one of them
        t.put_whole("lc_versions", rows.withColumn("status", F.lit(status)).withColumn("updated_by", F.lit(batch)), aligned=alike)

    def _write(self, t: Transaction, rows: DataFrame, counts: list[int]) -> DataFrame:
        """Put objects in; only those whose hash is new are written and embedded.  Returns all that are wanted."""
        wanted = materialise(projection(rows), "objects")
        same = t.read("lc_objects").select("id", "hash")
        changed = materialise(wanted.join(same, ["id", "hash"], "left_anti"), "changed")
        n = changed.count()
        counts[:] = [n, wanted.count() - n]
        embed = self.embed

        @F.arrow_udf("array<float>")
        def made(texts: pa.Array) -> pa.Array:
            return pa.array(np.asarray(embed([x or "" for x in texts.to_pylist()]), np.float32).tolist(), pa.list_(pa.float32()))

        t.change("lc_objects", changed.withColumn("vector", made("payload")))
        return wanted

    @staticmethod
    def _validate(t: Transaction, wanted: DataFrame) -> None:
        lacking = wanted.join(t.read("lc_objects"), ["id", "hash"], "left_anti")
        n = lacking.count()
        if n:
            raise ValueError(f"{n} objects were not written")

    @staticmethod
    def _contributed(t: Transaction, ids: DataFrame) -> DataFrame:
        """What versions (version_id) contribute, found bucket by bucket."""
        return t.read("lc_contributions").join(ids.select("version_id").hint("shuffle_hash"), "version_id", "left_semi")

    @staticmethod
    def _deactivate(t: Transaction, ids: DataFrame, status: str, batch: str) -> None:
        if ids.isEmpty():  # first versions supersede none
            return
        t.put_whole("lc_contributions", Lifecycle._contributed(t, ids).withColumn("active", F.lit(False)), aligned=True)
        Lifecycle._state(t, ids, status, batch)

    @staticmethod
    def _orphans(t: Transaction, objects: DataFrame) -> DataFrame:
        """Ids among objects (id) that no active version contributes: one count over both, so no list of objects is sorted or joined."""
        held = t.read("lc_contributions").where("active").select(F.concat_ws(":", "kind", "object_id").alias("id"), F.lit(True).alias("held"))
        both = held.unionByName(objects.select("id", F.lit(False).alias("held")))
        return both.groupBy("id").agg(F.max("held").alias("held")).where("not held").select("id")

    def _delete_objects(self, t: Transaction, ids: DataFrame) -> None:
        if ids.isEmpty():
            return
        own = self._contributed(t, ids).select(F.concat_ws(":", "kind", "object_id").alias("id"))
        t.change("lc_objects", None, self._orphans(t, own))

    # --- running, reversing, logging ---

    def _log(self, mutation: str, operation: str, outcome: Outcome | None, states: list[tuple[str, str]], commit: int | None = None) -> None:
        spark, t = self.store.spark, Transaction(self.store, None)
        o = outcome or Outcome(mutation, "PLANNED", 0, 0)
        t.change("lc_mutations", spark.createDataFrame([(mutation, operation, o.status, o.n_applied, o.n_compensated, commit, o.error)], self.store.schema("lc_mutations")))
        t.change("lc_steps", spark.createDataFrame([(f"{mutation}:{i}", mutation, i, a, s) for i, (a, s) in enumerate(states)], self.store.schema("lc_steps")))
        t.publish(f"log {mutation}")

    def _run(self, operation: str, batch: str, steps: list[Step], counts: list[int], versions: DataFrame, fail_after: str = "", fail_compensation: str = "") -> Outcome:
        """Apply steps and publish them together; reverse the applied ones where one fails.

        ``fail_after`` and ``fail_compensation`` name steps after which, or at whose reversal, an error is raised, for tests.
        """
        mutation = f"{operation}:{batch}"
        names = [a for a, _ in steps]
        self._log(mutation, operation, None, [(a, "PENDING") for a in names])
        t = Transaction(self.store, None)
        applied: list[tuple[str, dict]] = []
        try:
            for action, work in steps:
                before = t.preimage()
                work(t)
                applied.append((action, before))
                if action == fail_after:
                    raise RuntimeError(f"stopped after {action}")
            commit = t.publish(mutation)
        except Exception as e:  # whatever went wrong in a step
            return self._reverse(mutation, operation, batch, t, applied, names, f"{type(e).__name__}: {e}", versions, fail_compensation)
        done = Outcome(mutation, "APPLIED", len(applied), 0, None, *counts)
        self._log(mutation, operation, done, [(a, "APPLIED") for a in names], commit)
        return done

    def _reverse(self, mutation: str, operation: str, batch: str, t: Transaction, applied: list, names: list[str], error: str, versions: DataFrame, fail: str) -> Outcome:
        states = dict.fromkeys(names, "PENDING") | {a: "APPLIED" for a, _ in applied}
        status, n = "COMPENSATED", 0
        for action, before in reversed(applied):
            if action == fail:
                # nothing was published, so tables are as before all the same; the versions have to be built again
                status, error = "FAILED", f"{error}; reversal stopped at {action}"
                mark = Transaction(self.store, None)
                rows = versions.select(F.col("version_id").alias("id"), F.split("version_id", "@")[0].alias("document_id"), F.lit("REBUILD_REQUIRED").alias("status"), F.lit(batch).alias("updated_by"))
                known = mark.read("lc_versions").join(rows.select("id"), "id", "left_semi").withColumn("status", F.lit("REBUILD_REQUIRED")).withColumn("updated_by", F.lit(batch))
                mark.change("lc_versions", known.unionByName(rows.join(known.select("id"), "id", "left_anti")))
                mark.publish(f"rebuild required by {mutation}")
                break
            t.restore(before)
            states[action] = "COMPENSATED"
            n += 1
        found = Outcome(mutation, status, len(applied), n, error)
        self._log(mutation, operation, found, [(a, states[a]) for a in names])
        return found

    def compensate(self, mutation: str) -> int:
        """Undo a mutation that was published, from what its rows were before it; returns the number of the new commit.

        Rows that a later mutation changed are a :class:`~tessera.sources.tables.Conflict`: undo that one first.
        """
        row = self.store.read("lc_mutations").where(F.col("id") == mutation).first()
        if row is None or row["status"] != "APPLIED":
            raise ValueError(f"no applied mutation {mutation}")
        n = self.store.undo(row["commit"])
        steps = self.store.read("lc_steps").where(F.col("mutation_id") == mutation).orderBy("step").collect()  # a handful
        done = Outcome(mutation, "COMPENSATED", row["n_applied"], row["n_applied"])
        self._log(mutation, row["operation"], done, [(s["action"], "COMPENSATED") for s in steps], row["commit"])
        return n
