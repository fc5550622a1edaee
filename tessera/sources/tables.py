"""The tables of a workspace: bucketed Parquet snapshots behind one manifest for all of them.

A commit is one small file that names, for every table, the folder of each of its buckets.  Folders are never changed once
written, so readers of a commit see all tables as of one moment, a job that is lost before its commit leaves nothing to see,
and what was there before is still there: that is what undoing reads.  A change of few rows rewrites the buckets of their
keys alone.  Tables of versions of documents are not rewritten: each change is a layer over what was there, dealt alike, so
that layers meet bucket by bucket when they are read and only what changes is moved.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.scratch import deal, dealt, materialise

#: The tables of a workspace and their columns.
SCHEMAS = {
    "full_docs": "id string, content string, file_path string, create_time long, update_time long",
    "doc_status": "id string, status string, content_summary string, content_length int, chunks_count int, chunks_list array<string>, created_at timestamp, updated_at timestamp, file_path string, track_id string, error_msg string, metadata map<string,string>",
    "text_chunks": "id string, tokens int, content string, chunk_order_index int, full_doc_id string, file_path string, llm_cache_list array<string>, create_time long, update_time long",
    "llm_response_cache": "id string, `return` string, cache_type string, chunk_id string, original_prompt string, queryparam string, create_time long, update_time long",
    "extractions": "id string, entities array<struct<turn:int,pos:int,name:string,entity_type:string,description:string>>, relations array<struct<turn:int,pos:int,src:string,tgt:string,keywords:string,description:string,weight:double>>",
    "full_entities": "id string, entity_names array<string>, count int",
    "full_relations": "id string, relation_pairs array<struct<src:string,tgt:string>>, count int",
    "entity_chunks": "id string, chunk_ids array<string>, count int",
    "relation_chunks": "id string, chunk_ids array<string>, count int",
    "nodes": "id string, entity_type string, description string, source_ids array<string>, file_path string, vector array<float>",
    "edges": "src string, tgt string, weight double, keywords string, description string, source_ids array<string>, file_path string, vector array<float>",
    "chunks": "id string, content string, full_doc_id string, file_path string, vector array<float>",
    "lc_documents": "id string, active_version string, updated_by string",
    "lc_versions": "id string, document_id string, status string, updated_by string",
    "lc_contributions": "id string, document_id string, version_id string, kind string, object_id string, payload string, hash string, active boolean",
    "lc_objects": "id string, kind string, object_id string, payload string, hash string, vector array<float>",
    "lc_tombstones": "id string, document_id string, version_id string, scope string, reason string, deleted_by string",
    "lc_mutations": "id string, operation string, status string, n_applied int, n_compensated int, commit long, error string",
    "lc_steps": "id string, mutation_id string, step int, action string, status string",
}
#: The columns that tell rows of a table apart, where it is not ``id``.
KEYS = {"edges": ["src", "tgt"]}
#: Tables whose changes are layers, and the column by whose hash they are dealt; a layer replaces all rows of its values of it.
LAYERED = {"lc_documents": "id", "lc_versions": "id", "lc_contributions": "version_id", "lc_objects": "id", "lc_tombstones": "id"}
BUCKETS = 16
#: Rows of a bucket of a layered table when it is written first, and layers beyond which it is written as one.
BUCKET_ROWS = 500_000
LAYERS = 8


class Conflict(RuntimeError):
    """Another job has committed to the same tables, or to the same rows, in between."""


class Store:
    """Tables under ``root/workspace=<name>``; rows are dealt into buckets by a hash of their keys.

    ``buckets`` holds for tables that are written as a whole from now on: a change rewrites whole buckets, so a table of
    many TB wants thousands of them.
    """

    def __init__(self, spark: SparkSession, root: str, workspace: str = "default", buckets: int = BUCKETS):
        self.spark, self.root, self.workspace, self.buckets = spark, root.rstrip("/"), workspace, buckets

    # --- files ---

    def at(self, *parts: str) -> str:
        return "/".join([f"{self.root}/workspace={self.workspace}", *parts])

    def _fs(self, path: str):
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), hadoop

    def names(self, path: str) -> list[str]:
        """Names in a folder; none where it is not there."""
        fs, at = self._fs(path)
        return sorted(f.getPath().getName() for f in fs.listStatus(at)) if fs.exists(at) else []

    def get(self, path: str) -> dict | None:
        fs, at = self._fs(path)
        if not fs.exists(at):
            return None
        stream = fs.open(at)
        try:
            return json.loads(bytes(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())
        finally:
            stream.close()

    def put(self, path: str, value: dict, replace: bool = False) -> None:
        """Write a small file so that it is there as a whole or not at all."""
        fs, at = self._fs(path)
        _, draft = self._fs(f"{path.rpartition('/')[0]}/_{uuid.uuid4().hex}")
        stream = fs.create(draft, False)
        try:
            stream.write(bytearray(json.dumps(value).encode()))
        finally:
            stream.close()
        if fs.exists(at):
            if not replace:
                fs.delete(draft, False)
                raise Conflict(f"{path} is there already")
            fs.delete(at, False)
        if not fs.rename(draft, at):
            raise Conflict(f"{path} could not be put in place")

    def remove(self, path: str) -> None:
        fs, at = self._fs(path)
        fs.delete(at, True)

    # --- commits ---

    def latest(self) -> int:
        """The number of the newest commit; 0 before the first."""
        return max((int(n[:-5]) for n in self.names(self.at("_commits")) if n.endswith(".json") and n[0] != "_"), default=0)

    def manifest(self, commit: int | None = None) -> dict:
        """{commit, note, tables: {name: {buckets, folders}}, keys: {table: folder of changed keys, null for all}}."""
        commit = self.latest() if commit is None else commit
        if not commit:
            return {"commit": 0, "note": "", "tables": {}, "keys": {}}
        found = self.get(self.at("_commits", f"{commit:012d}.json"))
        if found is None:
            raise ValueError(f"no such commit: {commit}")
        return found

    def schema(self, table: str) -> str:
        if table not in SCHEMAS:
            raise ValueError(f"no such table: {table}")
        return SCHEMAS[table]

    def load(self, table: str, entry: dict | None, buckets: set[int] | None = None) -> DataFrame:
        """The rows of a table behind an entry of a manifest, of some of its buckets or, of layered ones always, of all."""
        if table in LAYERED:
            return self._layered(table, entry)
        folders = {int(b): f for b, f in (entry or {}).get("folders", {}).items() if buckets is None or int(b) in buckets}
        if not folders:
            return self.spark.createDataFrame([], self.schema(table))
        return self.spark.read.schema(self.schema(table)).parquet(*[self.at(table, f, f"__bucket={b}") for b, f in sorted(folders.items())])

    def _layered(self, table: str, entry: dict | None) -> DataFrame:
        schema, by, parts = self.schema(table), LAYERED[table], []
        layers = (entry or {}).get("layers", [])
        for i, layer in enumerate(layers):
            if not layer["rows"]:
                continue
            rows = dealt(self.spark, self.at(table, layer["rows"]), entry["buckets"], by, schema)
            columns = rows.columns
            for later in layers[i + 1 :]:
                for folder, kept in ((later["rows"], schema), (later["gone"], f"{by} string")):
                    if folder:
                        over = dealt(self.spark, self.at(table, folder), entry["buckets"], by, kept).select(by)
                        rows = rows.join(over.hint("shuffle_hash"), by, "left_anti")
            parts.append(rows.select(*columns))
        return reduce(DataFrame.union, parts) if parts else self.spark.createDataFrame([], schema)

    def width(self, table: str, rows: Callable[[], int] | None = None, tables: dict | None = None) -> int:
        """Into how many buckets a layered table is dealt: as it is, else as others of the workspace, else by its number of rows."""
        tables = self.manifest()["tables"] if tables is None else tables
        known = {t: e["buckets"] for t, e in tables.items() if t in LAYERED and e}
        if known:
            return known.get(table, max(known.values()))
        return max(self.buckets, ceil(rows() / BUCKET_ROWS) if rows else 1)

    def prepare(self, table: str, rows: DataFrame, n: int, aligned: bool = False) -> str:
        """Write rows of a layered table as a folder that :meth:`Transaction.attach` makes a layer."""
        folder = f"w-{uuid.uuid4().hex}"
        deal(rows.select(*[c.name for c in self.load(table, None).schema]), self.at(table, folder), n, LAYERED[table], aligned)
        return folder

    def read(self, table: str, commit: int | None = None) -> DataFrame:
        """A table as of a commit, the newest by default."""
        self.schema(table)
        return self.load(table, self.manifest(commit)["tables"].get(table))

    def begin(self, name: str = "commit") -> Transaction:
        """A transaction; one of this name that was lost goes on after its last finished stage, unless others committed since."""
        return Transaction(self, name)

    def commit(self, table: str, rows: DataFrame) -> int:
        """Replace a table; returns the number of the commit."""
        t = Transaction(self, None)
        t.replace(table, rows)
        return t.publish(f"replace {table}")

    def change(self, table: str, new: DataFrame | None = None, gone: DataFrame | None = None) -> int:
        """Put rows in and take rows out by their keys; returns the number of the commit."""
        t = Transaction(self, None)
        t.change(table, new, gone)
        return t.publish(f"change {table}")

    def drop(self, table: str) -> None:
        """Empty a table; its snapshots stay for readers that hold them."""
        self.commit(table, self.spark.createDataFrame([], self.schema(table)))

    def undo(self, commit: int) -> int:
        """Bring the rows that a commit changed back to what they were before it; returns the number of the new commit.

        Rows are told by the keys that the commit has kept, their earlier values read from the commit before.  A later
        commit on one of these rows is a :class:`Conflict`, unless it has been undone before.
        """
        own, before = self.manifest(commit), self.manifest(commit - 1)
        later = [m for m in map(self.manifest, range(commit + 1, self.latest() + 1))]
        settled = {m["undoes"] for m in later if "undoes" in m} | {m["commit"] for m in later if "undoes" in m}
        t = Transaction(self, None)
        for table, folder in own["keys"].items():
            for m in later:
                if table in m["keys"] and m["commit"] not in settled:
                    if folder is None or m["keys"][table] is None or not self.keys(table, folder).join(self.keys(table, m["keys"][table]), self.key(table)).isEmpty():
                        raise Conflict(f"commit {m['commit']} has changed rows of commit {commit} since")
            if folder is None or own["tables"].get(table) == t.base["tables"].get(table):  # nothing came on top
                t.point(table, before["tables"].get(table))
                t.state["keys"][table] = folder
            else:
                keys = self.keys(table, folder).distinct()
                t.change(table, self.load(table, before["tables"].get(table)).join(keys, self.key(table), "left_semi"), keys)
        return t.publish(f"undo {commit}", undoes=commit)

    def key(self, table: str) -> list[str]:
        return KEYS.get(table, ["id"])

    def keys(self, table: str, folder: str | list[str]) -> DataFrame:
        """Keys that a commit has kept; those of layered tables are in several folders, and may repeat."""
        folders = [folder] if isinstance(folder, str) else folder
        return self.spark.read.schema(", ".join(f"{k} string" for k in self.key(table))).parquet(*[self.at(table, f) for f in folders])


class Transaction:
    """Changes of several tables that readers see together or never.

    Work is done in named stages (:meth:`stage`); after each, what it has written is noted, so that the same transaction,
    begun again after its job was lost, skips the stages that are done.  Reads see the changes so far.
    """

    def __init__(self, store: Store, name: str | None):
        self.store, self.name = store, name
        self.state = {"base": store.latest(), "tables": {}, "keys": {}, "kept": {}, "stages": []}
        found = store.get(self._note) if name else None
        if found and found["base"] == self.state["base"]:
            self.state = found
        self.base = store.manifest(self.state["base"])

    @property
    def _note(self) -> str:
        return self.store.at("_open", f"{self.name}.json")

    def _entry(self, table: str) -> dict | None:
        own = self.state["tables"]
        return own[table] if table in own else self.base["tables"].get(table)

    def read(self, table: str) -> DataFrame:
        self.store.schema(table)
        return self.store.load(table, self._entry(table))

    def point(self, table: str, entry: dict | None) -> None:
        """Let a table be what an entry of an earlier manifest says."""
        self.state["tables"][table], self.state["keys"][table] = entry, None

    def _bucket(self, table: str, n: int) -> Column:
        return F.pmod(F.xxhash64(*self.store.key(table)), F.lit(n)).cast("int")

    def _write(self, table: str, rows: DataFrame, n: int) -> dict[str, str]:
        columns = self.store.spark.createDataFrame([], self.store.schema(table)).columns
        folder = f"w-{uuid.uuid4().hex}"
        dealt = rows.select(*columns, self._bucket(table, n).alias("__bucket"))
        # large buckets are split over tasks, small ones share a task
        dealt.hint("rebalance", "__bucket").write.partitionBy("__bucket").parquet(self.store.at(table, folder))
        return {name.partition("=")[2]: folder for name in self.store.names(self.store.at(table, folder)) if name.startswith("__bucket=")}

    def replace(self, table: str, rows: DataFrame) -> None:
        if table in LAYERED:
            n = max(self.store.buckets, ceil(rows.count() / BUCKET_ROWS))
            self.point(table, {"buckets": n, "layers": [{"rows": self.store.prepare(table, rows, n), "gone": None}]})
            return
        n = self.store.buckets
        self.point(table, {"buckets": n, "folders": self._write(table, rows, n)})

    def change(self, table: str, new: DataFrame | None = None, gone: DataFrame | None = None) -> None:
        """Rows of ``new`` replace those of their keys, keys of ``gone`` go; buckets of other keys are not read or written.

        The keys are kept with the commit, for :meth:`Store.undo`.  ``new`` has one row a key.
        """
        if table in LAYERED:
            self._change_layered(table, new, gone)
            return
        key, spark = self.store.key(table), self.store.spark
        entry = self._entry(table) or {"buckets": self.store.buckets, "folders": {}}
        n = entry["buckets"]
        columns = spark.createDataFrame([], self.store.schema(table)).columns
        fresh = materialise((new if new is not None else spark.createDataFrame([], self.store.schema(table))).select(*columns), "fresh")
        keys = fresh.select(*key) if gone is None else fresh.select(*key).union(gone.select(*key)).distinct()
        folder = f"k-{uuid.uuid4().hex}"
        keys.write.parquet(self.store.at(table, folder))
        keys = self.store.keys(table, folder)
        touched = {r[0] for r in keys.select(self._bucket(table, n)).distinct().collect()}  # at most as many as buckets
        earlier = self.state["keys"].get(table, "none")
        if earlier not in ("none", None):  # changed before in this transaction: both sets of keys
            both = f"k-{uuid.uuid4().hex}"
            keys.union(self.store.keys(table, earlier)).distinct().write.parquet(self.store.at(table, both))
            folder = both
        if touched:
            left = self.store.load(table, entry, touched).join(keys, key, "left_anti")
            written = self._write(table, left.unionByName(fresh), n)
            folders = {b: f for b, f in entry["folders"].items() if int(b) not in touched} | written
        else:
            folders = entry["folders"]
        self.state["tables"][table] = {"buckets": n, "folders": folders}
        self.state["keys"][table] = None if earlier is None else folder

    def _change_layered(self, table: str, new: DataFrame | None, gone: DataFrame | None) -> None:
        key, by = self.store.key(table), LAYERED[table]
        if key == [by]:
            self.put_whole(table, new, gone)
            return
        # the other rows of values that are hit go along, and the keys are kept by themselves
        now = self.read(table)
        fresh = materialise((new if new is not None else now.limit(0)).select(*now.columns), "fresh")
        keys = fresh.select(*key) if gone is None else fresh.select(*key).union(gone.select(*key)).distinct()
        folder = f"k-{uuid.uuid4().hex}"
        keys.write.parquet(self.store.at(table, folder))
        keys = self.store.keys(table, folder)
        hit = materialise(now.join(keys, key, "left_semi").select(by).union(fresh.select(by)).distinct(), "hit")
        self.put_whole(table, now.join(hit, by, "left_semi").join(keys, key, "left_anti").select(*now.columns).unionByName(fresh), hit, [folder])

    def put_whole(self, table: str, rows: DataFrame | None = None, gone: DataFrame | None = None, keys: list[str] | None = None, aligned: bool = False) -> None:
        """Put a layer over a layered table: all rows with its values of the column it is dealt by go, and ``rows`` come.

        ``gone`` names values without a row in ``rows``.  Keys that change are those of ``rows`` and ``gone`` unless ``keys``
        has folders of them.  ``aligned`` rows come from the table bucket by bucket and are written by the tasks that read them:
        a bucket then has a file for each layer that they come from.
        """
        by, n = LAYERED[table], self.width(table)
        out = None
        if gone is not None:
            out = f"g-{uuid.uuid4().hex}"
            deal(gone.select(by), self.store.at(table, out), n, by)
        self._lay(table, n, None if rows is None else self.store.prepare(table, rows, n, aligned), out, keys)

    def attach(self, table: str, folder: str, n: int) -> None:
        """Make a prepared folder a layer; no row outside it has its values of the column it is dealt by, or those rows go."""
        if self._entry(table) and n != self._entry(table)["buckets"]:
            raise Conflict(f"{table} is dealt otherwise since")
        self._lay(table, n, folder, None, None)

    def width(self, table: str) -> int:
        """Into how many buckets a layered table is dealt, with the changes so far."""
        return self.store.width(table, None, self.base["tables"] | self.state["tables"])

    def _lay(self, table: str, n: int, rows: str | None, gone: str | None, keys: list[str] | None) -> None:
        entry = self._entry(table) or {"buckets": n, "layers": []}
        entry = {"buckets": n, "layers": [*entry["layers"], {"rows": rows, "gone": gone}]}
        if len(entry["layers"]) > LAYERS:
            entry["layers"] = [{"rows": self.store.prepare(table, self.store.load(table, entry), n), "gone": None}]
        earlier = self.state["keys"].get(table, [])
        self.state["tables"][table] = entry
        self.state["keys"][table] = None if earlier is None else [*earlier, *(keys or [f for f in (rows, gone) if f])]

    def stage(self, name: str, work: Callable[[], None]) -> None:
        """Do ``work`` unless it is done; if it fails, tables are as before the stage."""
        if name in self.state["stages"]:
            return
        before = json.dumps(self.state)
        try:
            work()
        except BaseException:
            self.state = json.loads(before)
            raise
        self.state["stages"].append(name)
        if self.name:
            self.store.put(self._note, self.state, replace=True)

    def preimage(self) -> dict:
        """What the tables are now, as folders: enough to bring them back."""
        return json.loads(json.dumps(self.state))

    def restore(self, before: dict) -> None:
        """Bring the tables back to a :meth:`preimage`."""
        self.state = json.loads(json.dumps(before))

    def keep(self, name: str, rows: DataFrame) -> DataFrame:
        """Rows that later stages need, written once."""
        folder = f"{name}-{uuid.uuid4().hex}"
        rows.write.parquet(self.store.at("_open", folder))
        self.state["kept"][name] = [folder, rows.schema.json()]
        return self.kept(name)

    def kept(self, name: str) -> DataFrame:
        from pyspark.sql.types import StructType

        folder, schema = self.state["kept"][name]
        return self.store.spark.read.schema(StructType.fromJson(json.loads(schema))).parquet(self.store.at("_open", folder))

    def publish(self, note: str = "", **more: int) -> int:
        """Make all changes visible at once; returns the number of the commit.

        Commits of others to other tables meanwhile are no matter; to the same tables they are a :class:`Conflict`.
        """
        store, latest = self.store, self.store.manifest()
        for m in map(store.manifest, range(self.state["base"] + 1, latest["commit"] + 1)):
            if set(m["keys"]) & set(self.state["tables"]):
                raise Conflict(f"commit {m['commit']} has changed {sorted(set(m['keys']) & set(self.state['tables']))} since")
        number = latest["commit"] + 1
        tables = latest["tables"] | self.state["tables"]
        value = {"commit": number, "note": note, "tables": {t: e for t, e in tables.items() if e}, "keys": self.state["keys"]} | more
        store.put(store.at("_commits", f"{number:012d}.json"), value)
        if self.name:
            store.remove(self._note)
        return number


def flatten_cache(nested: DataFrame) -> DataFrame:
    """Rows (mode, entries map<hash, struct<cache_type, ...>>) of the old cache layout as rows under ``mode:type:hash``."""
    rows = nested.select("mode", F.explode("entries").alias("hash", "entry"))
    return rows.select(F.concat_ws(":", "mode", F.coalesce("entry.cache_type", F.lit("extract")), "hash").alias("id"), "entry.*")
