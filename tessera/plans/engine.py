"""The facade: a workspace into which documents go and from which answers come.

Language models, embeddings and extraction are callables of the caller; all else is plans over the store's tables.  Every
call that changes the knowledge base is one transaction of the store: readers see all of it or nothing, and one that was
lost goes on after its last finished stage when it is called again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.ids import content_id
from tessera.functions.text import SEP, sanitize
from tessera.operators import aggregates, chunking, editing, graph, lookups, mutations
from tessera.operators.ranking import first_of
from tessera.plans.progress import Cancelled, Run, cancel
from tessera.plans.retrieval import KnowledgeBase, QueryParam, retrieve
from tessera.sources.exchange import export_sections, graph_sections
from tessera.sources.scratch import materialise
from tessera.sources.tables import Store, Transaction



def _pair() -> Column:
    return F.concat_ws(SEP, "src", "tgt")


@dataclass(frozen=True)
class Engine:
    """``embed`` maps texts to rows of vectors; ``extract`` maps chunk texts to extraction answers.

    ``glean`` maps chunk texts and their first answers to second ones that add what was missed; chunks whose text and answer
    hold more than ``glean_tokens`` tokens have no second pass.
    """

    store: Store
    embed: Callable[[list[str]], np.ndarray]
    extract: Callable[[list[str]], list[str]]
    chunk_tokens: int = 1_200
    chunk_overlap: int = 100
    glean: Callable[[list[str], list[str]], list[str]] | None = None
    glean_tokens: int = 20_000

    def _vectors(self, df: DataFrame, text: str) -> DataFrame:
        embed = self.embed

        @F.arrow_udf("array<float>")
        def made(texts: pa.Array) -> pa.Array:
            return pa.array(np.asarray(embed([t or "" for t in texts.to_pylist()]), np.float32).tolist(), pa.list_(pa.float32()))

        return df.withColumn("vector", made(text))

    def _put_nodes(self, t: Transaction, nodes: DataFrame, gone: DataFrame | None = None) -> None:
        """Put nodes in, embedded by name and description."""
        rows = nodes.withColumn("__text", F.concat_ws("\n", "id", "description"))
        t.change("nodes", self._vectors(rows, "__text").drop("__text"), gone)

    def _put_edges(self, t: Transaction, edges: DataFrame, gone: DataFrame | None = None) -> None:
        rows = edges.withColumn("__text", F.concat_ws("\t", "keywords", "src", "tgt", "description"))
        t.change("edges", self._vectors(rows, "__text").drop("__text"), gone)

    # --- documents in ---

    def insert(self, texts: DataFrame, now: int = 0) -> DataFrame:
        """Take in texts (pos, text, file_path): queue, chunk, extract, merge.  Returns the status rows.

        Texts and status rows are committed as pending before anything else, and only documents that were processed count as
        stored; so after a lost job the same call, or :meth:`process`, goes on where it stopped, and no document is taken for
        a copy of itself.  Contents go by their own hash, so positions may repeat.
        """
        queued = self.enqueue(texts, now)
        self.process(now)
        return lookups.existing_keys(queued, self.store.read("doc_status")).join(self.store.read("doc_status"), "id")

    def enqueue(self, texts: DataFrame, now: int = 0) -> DataFrame:
        """Status rows and contents of offered texts, in one commit; returns the rows of :func:`mutations.enqueue`."""
        t = self.store.begin("enqueue")
        done = t.read("doc_status").where("status = 'processed'").select("id")
        queued = materialise(mutations.enqueue(texts, done), "queued")
        t.change("doc_status", self._status(queued, now))
        t.change("full_docs", contents(texts, queued, now))
        t.publish("enqueue")
        return queued

    def process(self, now: int = 0) -> int:
        """Chunk, extract and merge all documents that wait, failed before or were left half done; returns how many there were.

        Answers are committed before they are used, and a chunk that has one is not asked about again.  A document with a
        chunk whose extraction failed is marked as failed with the reason and leaves no trace in the knowledge base; the
        others are not held up, and the next call tries it again.
        """
        store = self.store
        waiting = store.read("doc_status").where(F.col("status").isin("pending", "processing", "failed"))
        docs = store.read("full_docs").join(waiting.select("id"), "id", "left_semi")
        ids = materialise(docs.select("id"), "processing")
        n = ids.count()
        if not n:
            return 0
        with Run(store, "process", n) as run:
            try:
                self._process(run, ids, now)
            except Exception as e:
                if not run.cancelled():
                    raise
                bad = ids.withColumn("error_msg", F.lit("cancelled"))
                t = Transaction(store, None)
                self._mark(t, ids, None, bad, now)
                t.publish("cancelled")
                raise Cancelled(run.name) from e
        return n

    def cancel(self) -> bool:
        """Stop the processing that runs on this workspace, from any thread of the application: its Spark jobs end, and its
        documents are marked as failed with the reason; the next call tries them again.  False if nothing runs."""
        return cancel(self.store, "process")

    def _process(self, run: Run, ids: DataFrame, now: int) -> None:
        store = self.store
        run.at("chunks")
        cut = materialise(chunking.with_chunk_ids(self._chunks(store.read("full_docs").join(ids, "id", "left_semi")), "full_doc_id"), "cut")
        run.at("answers")
        errors = self._ask(cut, now)
        bad = errors.join(cut.select("chunk_id", "full_doc_id").distinct(), "chunk_id").groupBy(F.col("full_doc_id").alias("id")).agg(F.min("error").alias("error_msg"))
        bad = materialise(bad, "failed")
        good = materialise(cut.join(bad.select(F.col("id").alias("full_doc_id")), "full_doc_id", "left_anti"), "good")
        t = store.begin("process")
        stages = {
            "chunks": lambda: self._put_chunks(t, good, now),
            "relations": lambda: self._put_relations(t, good),
            "entities": lambda: self._put_entities(t, good),
            "index": lambda: self._put_index(t, good),
            "status": lambda: self._mark(t, ids, good, bad, now),
        }
        for name, work in stages.items():
            run.at(name)
            t.stage(name, work)
        run.at("publish")
        t.publish("process")

    def _ask(self, cut: DataFrame, now: int) -> DataFrame:
        """Put the answers of chunks that have none into the cache; returns (chunk_id, error) of those that failed.

        Chunks are asked about in batches; where a batch fails, each of its chunks is asked about alone.
        """
        extract, glean, store = self.extract, self.glean, self.store

        def safely(ask: Callable[[list[int]], list[str]], n: int) -> list[tuple[str | None, str | None]]:
            try:
                found = ask(list(range(n)))
                if len(found) != n:
                    raise ValueError(f"{len(found)} answers to {n} texts")
                return [(a, None) for a in found]
            except Exception as e:  # whatever a model raises is that chunk's error
                if n == 1:
                    return [(None, f"{type(e).__name__}: {e}")]
            return [x for i in range(n) for x in safely(lambda own, i=i: ask([i]), 1)]

        def answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids, texts, firsts = (c.to_pylist() for c in batch.columns)
                if glean is not None and any(f is not None for f in firsts):
                    found = safely(lambda own: glean([texts[i] for i in own], [firsts[i] for i in own]), len(ids))
                else:
                    found = safely(lambda own: extract([texts[i] for i in own]), len(ids))
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array([a for a, _ in found], pa.string()), pa.array([e for _, e in found], pa.string())], ["chunk_id", "answer", "error"])

        def ask(rows: DataFrame, kind: str) -> DataFrame:
            said = materialise(rows.mapInArrow(answers, "chunk_id string, answer string, error string"), f"said-{kind}")
            time = F.lit(now).cast("long")
            kept = said.where("error is null").select(
                F.concat(F.lit(f"default:{kind}:"), "chunk_id").alias("id"), F.coalesce("answer", F.lit("")).alias("return"), F.lit(kind).alias("cache_type"), "chunk_id",
                F.lit("").alias("original_prompt"), F.lit("").alias("queryparam"), time.alias("create_time"), time.alias("update_time"),
            )
            if not kept.isEmpty():
                store.change("llm_response_cache", kept)
                fresh.append(kept.select("chunk_id"))
            return said.where("error is not null").select("chunk_id", "error")

        fresh: list[DataFrame] = []
        texts = cut.select("chunk_id", "content").dropDuplicates(["chunk_id"])
        have = lambda kind: store.read("llm_response_cache").where(F.col("cache_type") == kind).select("chunk_id", F.col("return").alias("first"))
        errors = ask(texts.join(have("extract").select("chunk_id"), "chunk_id", "left_anti").withColumn("first", F.lit(None).cast("string")), "extract")
        if glean is not None:
            tokens = F.size(chunking.words("content")) + F.size(chunking.words("first"))
            rows = texts.join(have("extract"), "chunk_id").join(have("glean").select("chunk_id"), "chunk_id", "left_anti").where(tokens <= self.glean_tokens)
            errors = errors.unionByName(ask(rows, "glean"))
        t = store.begin("parse")
        told = t.read("extractions").select(F.col("id").alias("chunk_id"))
        lacking = texts.select("chunk_id").join(told, "chunk_id", "left_anti").join(have("extract"), "chunk_id", "left_semi")
        chunks = materialise(reduce(DataFrame.union, fresh, lacking).distinct(), "unparsed")
        if not chunks.isEmpty():
            self._parse(t, chunks)
            t.publish("parse")
        return errors

    def _put_chunks(self, t: Transaction, cut: DataFrame, now: int) -> None:
        one = first_of(cut, ["chunk_id"], "full_doc_id", "chunk_order_index")
        t.change("chunks", self._vectors(one.select(F.col("chunk_id").alias("id"), "content", "full_doc_id", "file_path"), "content"))
        time = F.lit(now).cast("long")
        keys = t.read("llm_response_cache").groupBy("chunk_id").agg(F.array_sort(F.collect_set("id")).alias("llm_cache_list"))
        rows = one.join(keys, "chunk_id", "left").select(
            F.col("chunk_id").alias("id"), "tokens", "content", "chunk_order_index", "full_doc_id", "file_path", F.coalesce("llm_cache_list", F.array().cast("array<string>")).alias("llm_cache_list"),
            time.alias("create_time"), time.alias("update_time"),
        )
        t.change("text_chunks", rows)

    def _mark(self, t: Transaction, ids: DataFrame, good: DataFrame | None, bad: DataFrame, now: int) -> None:
        lists = ids.limit(0).withColumn("chunks_list", F.array().cast("array<string>")) if good is None else self._chunk_lists(good)
        rows = t.read("doc_status").join(ids, "id", "left_semi").drop("chunks_list", "error_msg").join(lists, "id", "left").join(bad, "id", "left")
        rows = rows.withColumn("status", F.when(F.col("error_msg").isNull(), "processed").otherwise("failed")).withColumn("updated_at", F.timestamp_seconds(F.lit(now)))
        rows = rows.withColumn("chunks_list", F.coalesce("chunks_list", F.array().cast("array<string>"))).withColumn("chunks_count", F.size("chunks_list"))
        t.change("doc_status", rows)

    @staticmethod
    def _chunk_lists(cut: DataFrame) -> DataFrame:
        return cut.groupBy(F.col("full_doc_id").alias("id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("chunk_order_index", "chunk_id"))), lambda x: x["chunk_id"]).alias("chunks_list"))

    def _chunks(self, docs: DataFrame) -> DataFrame:
        named = docs.select(F.col("id").alias("full_doc_id"), "file_path", F.col("content").alias("whole"))
        return chunking.windows(named, chunking.words("whole"), self.chunk_tokens, self.chunk_overlap).drop("whole")

    # --- what answers say ---

    @staticmethod
    def _best_turn(rows: DataFrame, *key: str) -> DataFrame:
        """Of what both passes over a chunk say of one thing, the pass with the longer description, the first among equals."""
        turns = rows.groupBy("chunk_id", *key, "turn").agg(F.max(F.char_length("description")).alias("n"))
        best = turns.groupBy("chunk_id", *key).agg(F.min(F.struct(-F.col("n"), "turn")).getField("turn").alias("turn"))
        return rows.join(best, ["chunk_id", *key, "turn"], "left_semi")

    def _parse(self, t: Transaction, chunks: DataFrame) -> None:
        """Parse the kept answers of chunks (chunk_id), of both passes, once and for all."""
        kept = t.read("llm_response_cache").where(F.col("cache_type").isin("extract", "glean")).join(chunks, "chunk_id", "left_semi")
        said = kept.select(F.struct("chunk_id", (F.col("cache_type") == "glean").cast("int").alias("turn")).alias("key"), F.col("return").alias("answer"))
        records = materialise(chunking.extraction_records(said, "key").select("key.chunk_id", "key.turn", "pos", "kind", "fields"), "records")
        entities, relations = chunking.entity_records(records), graph.canonical(chunking.relation_records(records))
        if self.glean is not None:
            entities, relations = self._best_turn(entities, "name"), self._best_turn(relations, "src", "tgt")
        listed = lambda df, name, *c: df.groupBy(F.col("chunk_id").alias("id")).agg(F.array_sort(F.collect_list(F.struct("turn", "pos", *c))).alias(name))
        rows = chunks.select(F.col("chunk_id").alias("id")).join(listed(entities, "entities", "name", "entity_type", "description"), "id", "left")
        rows = rows.join(listed(relations, "relations", "src", "tgt", "keywords", "description", "weight"), "id", "left")
        kinds = {f.name: f.dataType for f in t.read("extractions").schema}
        t.change("extractions", rows.select("id", *[F.coalesce(F.col(c).cast(kinds[c]), F.array().cast(kinds[c])).alias(c) for c in ("entities", "relations")]))

    @staticmethod
    def _entities(t: Transaction, chunks: DataFrame) -> DataFrame:
        """Entity fragments (id, ...) of chunks (chunk_id)."""
        found = t.read("extractions").join(chunks.select(F.col("chunk_id").alias("id")).distinct(), "id", "left_semi").select(F.col("id").alias("source_id"), F.explode("entities").alias("e"))
        return found.select(F.col("e.name").alias("id"), "e.entity_type", "e.description", "source_id", F.concat_ws(":", "source_id", "e.turn", F.lpad(F.col("e.pos").cast("string"), 9, "0")).alias("pos"))

    @staticmethod
    def _relations(t: Transaction, chunks: DataFrame) -> DataFrame:
        """Relation fragments (src, tgt, ...) of chunks (chunk_id)."""
        found = t.read("extractions").join(chunks.select(F.col("chunk_id").alias("id")).distinct(), "id", "left_semi").select(F.col("id").alias("source_id"), F.explode("relations").alias("e"))
        return found.select("e.src", "e.tgt", "e.weight", "e.keywords", "e.description", "source_id")

    @staticmethod
    def _supports(t: Transaction, table: str, objects: DataFrame, ids: DataFrame) -> DataFrame:
        """(id, source_id): all chunks of some objects (id), from ``table`` and from what ``objects`` (id, source_ids) keep themselves."""
        listed = t.read(table).join(ids, "id", "left_semi").select("id", F.explode("chunk_ids").alias("source_id"))
        return listed.unionByName(objects.join(ids, "id", "left_semi").select("id", F.explode("source_ids").alias("source_id"))).distinct()

    @staticmethod
    def _list(t: Transaction, table: str, rows: DataFrame, ids: DataFrame) -> None:
        """The chunk lists of some objects (id); those without a chunk have none."""
        lists = rows.groupBy("id").agg(F.array_sort(F.collect_set("source_id")).alias("chunk_ids"))
        t.change(table, lists.withColumn("count", F.size("chunk_ids")), ids)

    def _merged_edges(self, t: Transaction, held: DataFrame, touched: DataFrame) -> DataFrame:
        """Edges (id) from all kept answers on them, and from what chunks without kept answers gave before."""
        said = self._relations(t, held.select(F.col("source_id").alias("chunk_id"))).withColumn("id", _pair()).join(touched, "id", "left_semi")
        told = t.read("extractions").select(F.col("id").alias("left"))
        old = t.read("edges").withColumn("id", _pair()).join(touched, "id", "left_semi").withColumn("left", F.explode("source_ids"))
        bare = old.join(told, "left", "left_anti").join(held.select("id", F.col("source_id").alias("left")), ["id", "left"], "left_semi").drop("left").distinct()
        one = lambda df, ids: df.select("src", "tgt", "weight", F.split("keywords", ",").alias("k"), F.split("description", SEP).alias("d"), ids.alias("s"))
        rows = one(said, F.array("source_id")).unionByName(one(bare, F.col("source_ids")))
        merged = rows.groupBy("src", "tgt").agg(F.sum("weight").alias("weight"), *[F.array_sort(F.array_distinct(F.flatten(F.collect_set(c)))).alias(c) for c in "kds"])
        return merged.select("src", "tgt", "weight", F.array_join("k", ",").alias("keywords"), F.array_join("d", SEP).alias("description"), F.col("s").alias("source_ids"), F.lit("").alias("file_path"))

    def _merged_nodes(self, t: Transaction, held: DataFrame, touched: DataFrame) -> DataFrame:
        said = self._entities(t, held.select(F.col("source_id").alias("chunk_id"))).join(touched, "id", "left_semi")
        told = t.read("extractions").select(F.col("id").alias("source_id"))
        old = t.read("nodes").join(touched, "id", "left_semi").select("id", "entity_type", F.explode(F.split("description", SEP)).alias("description"), "source_ids")
        bare = old.select("id", "entity_type", "description", F.explode("source_ids").alias("source_id")).join(told, "source_id", "left_anti").join(held, ["id", "source_id"], "left_semi").withColumn("pos", F.col("source_id"))
        fragments = materialise(said.unionByName(bare.select(*said.columns)).withColumnRenamed("id", "entity"), "fragments")
        merged = aggregates.merge_entities(fragments)
        return merged.select(F.col("entity").alias("id"), "entity_type", F.coalesce(F.array_join("descriptions", SEP), F.lit("")).alias("description"), "source_ids", F.lit("").alias("file_path"))

    def _put_relations(self, t: Transaction, cut: DataFrame) -> None:
        new = materialise(self._relations(t, cut).select(_pair().alias("id"), "source_id").distinct(), "pairs")
        touched = new.select("id").distinct()
        held = materialise(self._supports(t, "relation_chunks", t.read("edges").withColumn("id", _pair()), touched).union(new).distinct(), "held")
        self._list(t, "relation_chunks", held, touched)
        self._put_edges(t, self._merged_edges(t, held, touched))

    def _put_entities(self, t: Transaction, cut: DataFrame) -> None:
        new = materialise(self._entities(t, cut).select("id", "source_id").distinct(), "names")
        touched = new.select("id").distinct()
        held = materialise(self._supports(t, "entity_chunks", t.read("nodes"), touched).union(new).distinct(), "held")
        self._list(t, "entity_chunks", held, touched)
        ends = self._relations(t, cut).select(F.explode(F.array("src", "tgt")).alias("id")).distinct()
        unknown = ends.join(t.read("nodes").select("id").union(touched), "id", "left_anti")
        self._put_nodes(t, self._merged_nodes(t, held, touched).unionByName(self._unknown(unknown)))

    @staticmethod
    def _unknown(ids: DataFrame) -> DataFrame:
        """Nodes for ends of edges that nothing describes."""
        return ids.select("id", F.lit("UNKNOWN").alias("entity_type"), F.lit("").alias("description"), F.array().cast("array<string>").alias("source_ids"), F.lit("").alias("file_path"))

    def _put_index(self, t: Transaction, cut: DataFrame) -> None:
        """Which entities and relations each document names."""
        owner = cut.select(F.col("chunk_id").alias("source_id"), F.col("full_doc_id").alias("doc")).distinct()
        names = self._entities(t, cut).select("id", "source_id").join(owner, "source_id").groupBy(F.col("doc").alias("d")).agg(F.array_sort(F.collect_set("id")).alias("entity_names"))
        t.change("full_entities", names.withColumnRenamed("d", "id").withColumn("count", F.size("entity_names")))
        pairs = self._relations(t, cut).select("src", "tgt", "source_id").join(owner, "source_id").groupBy(F.col("doc").alias("id")).agg(F.array_sort(F.collect_set(F.struct("src", "tgt"))).alias("relation_pairs"))
        t.change("full_relations", pairs.withColumn("count", F.size("relation_pairs")))

    def _status(self, queued: DataFrame, now: int) -> DataFrame:
        at = F.timestamp_seconds(F.lit(now))
        return queued.withColumn("chunks_list", F.array().cast("array<string>")).select(
            "id", "status", "content_summary", F.col("content_length").cast("int").alias("content_length"),
            F.size("chunks_list").alias("chunks_count"), "chunks_list", at.alias("created_at"), at.alias("updated_at"), "file_path", F.lit(None).cast("string").alias("track_id"),
            F.when(F.col("status") == "failed", F.concat(F.lit("duplicate of "), "original_id")).alias("error_msg"), F.create_map().cast("map<string,string>").alias("metadata"),
        )

    # --- answers out ---

    def knowledge(self) -> KnowledgeBase:
        """The tables of one commit."""
        s, at = self.store, self.store.latest()
        return KnowledgeBase(s.read("chunks", at).withColumnRenamed("id", "chunk_id"), s.read("nodes", at), s.read("edges", at))

    def query(self, question: str, param: QueryParam = QueryParam()) -> dict[str, DataFrame]:
        """Frames that a question is answered from, in the mode that the parameters name."""
        return retrieve(self.knowledge(), list(map(float, np.asarray(self.embed([question]))[0])), param, question=question)

    def export(self, path: str, kind: str = "csv", vectors: bool = False, compression: str = "none") -> None:
        """Write entities, relations and the relation index under a path as csv, excel, md or txt."""
        export_sections(graph_sections(self.store.read("nodes"), self.store.read("edges"), vectors), path, kind, compression)

    def clear_cache(self) -> None:
        """Empty the cache of answers and what was read from them; deletions of documents that were there before can then
        rebuild nothing from it."""
        t = self.store.begin("clear-cache")
        for table in ("llm_response_cache", "extractions"):
            t.replace(table, t.read(table).limit(0))
        t.publish("clear cache")

    # --- documents out ---

    def delete(self, doc_id: str, keep_cache: bool = False) -> DataFrame:
        """Take a document out: its own chunks, what they alone support, and its share of what others support too.  Returns the
        impact on entities.

        The stages (plan, chunks, relations, entities, cache, documents) are noted as they finish and published together:
        broken anywhere, the tables are as before, and the same call goes on after the last finished stage.  A document that
        is not there changes nothing.
        """
        t = self.store.begin(f"delete-{doc_id}")
        t.stage("plan", lambda: self._plan_deletion(t, doc_id))
        chunks = t.kept("chunks")
        t.stage("chunks", lambda: self._drop_chunks(t, doc_id, chunks))
        t.stage("relations", lambda: self._drop_relations(t, chunks))
        t.stage("entities", lambda: self._drop_entities(t, chunks))
        if not keep_cache:
            lost = t.read("llm_response_cache").join(chunks.withColumnRenamed("source_id", "chunk_id"), "chunk_id", "left_semi").select("id")
            t.stage("cache", lambda: [t.change("llm_response_cache", None, lost), t.change("extractions", None, chunks.select(F.col("source_id").alias("id")))] and None)
        one = t.read("doc_status").where(F.col("id") == doc_id).select("id")
        t.stage("documents", lambda: [t.change(table, None, one) for table in ("full_docs", "full_entities", "full_relations", "doc_status")] and None)
        impact = materialise(t.kept("impact"), "impact")
        t.publish(f"delete {doc_id}")
        return impact

    def _plan_deletion(self, t: Transaction, doc_id: str) -> None:
        status = t.read("doc_status")
        own = status.where(F.col("id") == doc_id).select(F.explode("chunks_list").alias("source_id")).distinct()
        shared = status.where(F.col("id") != doc_id).select(F.explode("chunks_list").alias("source_id"))
        chunks = t.keep("chunks", own.join(shared, "source_id", "left_anti"))
        nodes, edges = t.read("nodes"), t.read("edges").withColumn("id", _pair())
        for name, table, objects in (("entities", "entity_chunks", nodes), ("pairs", "relation_chunks", edges)):
            held = self._supports(t, table, objects, objects.select("id"))
            hit = held.join(chunks, "source_id", "left_semi").select("id").distinct()
            t.keep(name, held.join(hit, "id", "left_semi"))
        held = self._supports(t, "entity_chunks", nodes, nodes.select("id"))
        t.keep("impact", mutations.deletion_impact(held.withColumnRenamed("id", "entity"), chunks))

    def _drop_chunks(self, t: Transaction, doc_id: str, chunks: DataFrame) -> None:
        """The document's own chunks go; those that another one has too become that one's."""
        gone = chunks.select(F.col("source_id").alias("id"))
        heirs = t.read("doc_status").where(F.col("id") != doc_id).select(F.explode("chunks_list").alias("id"), F.col("id").alias("heir"))
        for table in ("chunks", "text_chunks"):
            mine = t.read(table).where(F.col("full_doc_id") == doc_id).join(gone, "id", "left_anti")
            left = mine.join(heirs.groupBy("id").agg(F.min("heir").alias("heir")), "id").withColumn("full_doc_id", F.col("heir")).drop("heir")
            t.change(table, left, gone)

    def _rebuild(self, t: Transaction, kept: str, chunks: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Of objects that lose chunks: the chunks left; the ids whose chunks left all have kept answers; the other ids."""
        left = materialise(t.kept(kept).join(chunks, "source_id", "left_anti"), "left")
        told = t.read("extractions").select(F.col("id").alias("source_id"))
        bare = left.join(told, "source_id", "left_anti").select("id").distinct()
        ids = left.select("id").distinct()
        return left, ids.join(bare, "id", "left_anti"), bare

    @staticmethod
    def _less(rows: DataFrame, bare: DataFrame, chunks: DataFrame) -> DataFrame:
        """Rows that cannot be merged anew keep what they have but for the chunks."""
        gone = chunks.agg(F.collect_list("source_id").alias("gone"))  # chunks of one document
        return rows.join(bare, "id", "left_semi").crossJoin(F.broadcast(gone)).withColumn("source_ids", F.array_except("source_ids", "gone")).drop("gone")

    def _drop_relations(self, t: Transaction, chunks: DataFrame) -> None:
        hit = t.kept("pairs").select("id").distinct()
        left, ids, bare = self._rebuild(t, "pairs", chunks)
        edges = t.read("edges").withColumn("id", _pair()).join(hit, "id", "left_semi")
        rows = self._merged_edges(t, left, ids).unionByName(self._less(edges, bare, chunks).drop("id", "vector"))
        self._put_edges(t, rows, edges.select("src", "tgt"))
        self._list(t, "relation_chunks", left, hit)

    def _drop_entities(self, t: Transaction, chunks: DataFrame) -> None:
        """Entities without chunks go, unless an edge still ends there."""
        hit = t.kept("entities").select("id").distinct()
        left, ids, bare = self._rebuild(t, "entities", chunks)
        old = t.read("nodes").join(hit, "id", "left_semi")
        ends = graph.endpoints(t.read("edges")).select(F.col("node").alias("id")).distinct()
        held = old.join(left.select("id"), "id", "left_anti").join(ends, "id", "left_semi").withColumn("source_ids", F.array().cast("array<string>"))
        rows = self._merged_nodes(t, left, ids).unionByName(self._less(old, bare, chunks).drop("vector")).unionByName(held.drop("vector"))
        self._put_nodes(t, rows, hit)
        self._list(t, "entity_chunks", left, hit)

    # --- edits ---

    def create_entity(self, name: str, entity_type: str, description: str) -> str:
        """Add a node; returns what came of it: created, exists, no_name or no_description."""
        t = self.store.begin("create-entity")
        new = self.store.spark.createDataFrame([(0, name, entity_type, description, [], "")], "pos int, id string, entity_type string, description string, source_ids array<string>, file_path string")
        outcome = editing.create_entities(t.read("nodes").where(F.col("id") == name), new)[1].first()["outcome"]
        if outcome == "created":
            self._put_nodes(t, new.drop("pos"))
            t.publish(f"create {name}")
        return outcome

    def create_relation(self, a: str, b: str, description: str, keywords: str = "", weight: float = 1.0) -> str:
        """Add an edge; returns what came of it: created, exists, no_end or loop."""
        t = self.store.begin("create-relation")
        columns = "pos int, a string, b string, weight double, keywords string, description string, source_ids array<string>, file_path string"
        new = self.store.spark.createDataFrame([(0, a, b, weight, keywords, description, [], "")], columns)
        outcome = editing.create_relations(self._at(t, [a, b]), t.read("nodes").where(F.col("id").isin(a, b)), new)[1].first()["outcome"]
        if outcome == "created":
            self._put_edges(t, graph.canonical(new, "a", "b").withColumnsRenamed({"a": "src", "b": "tgt"}).drop("pos"))
            t.publish(f"create {a} - {b}")
        return outcome

    def _at(self, t: Transaction, names: list[str]) -> DataFrame:
        """Edges at some nodes."""
        return t.read("edges").where(F.col("src").isin(*names) | F.col("tgt").isin(*names))

    def edit_entity(self, name: str, changes: dict[str, str] | None = None, new_name: str | None = None, allow_merge: bool = False) -> None:
        """Change attributes of a node, or its name: edges, chunk lists and vectors follow.

        A name that another node has is an error, or with ``allow_merge`` both become one.  A node that is not there is an
        error too.
        """
        t = self.store.begin("edit-entity")
        if t.read("nodes").where(F.col("id") == name).isEmpty():
            raise ValueError(f"there is no entity named {name}")
        if changes:
            put = self.store.spark.createDataFrame([(name, *changes.values())], ", ".join(f"{c} string" for c in ("id", *changes)))
            self._put_nodes(t, editing.edit_rows(t.read("nodes").where(F.col("id") == name).drop("vector"), put, ["id"]))
        if new_name and new_name != name:
            self._rename(t, [name], new_name, lambda nodes, edges: editing.rename_entity(nodes, edges, name, new_name, allow_merge))
        t.publish(f"edit {name}")

    def merge_entities(self, sources: list[str], target: str, strategies: dict[str, str] | None = None) -> None:
        """Make nodes one: edges, chunk lists and vectors follow (see :func:`editing.merge_entities`)."""
        t = self.store.begin("merge-entities")
        self._rename(t, sources, target, lambda nodes, edges: editing.merge_entities(nodes, edges, sources, target, strategies))
        t.publish(f"merge into {target}")

    def _rename(self, t: Transaction, old: list[str], target: str, plan: Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]]) -> None:
        """Apply a plan to the nodes named and to the edges there, and bring their chunk lists along."""
        names = [*old, target]
        nodes, edges = t.read("nodes").where(F.col("id").isin(*names)).drop("vector"), self._at(t, names).drop("vector")
        to = lambda c: F.when(F.col(c).isin(*names), F.lit(target)).otherwise(F.col(c))
        moved = edges.select(_pair().alias("id"), F.least(to("src"), to("tgt")).alias("src"), F.greatest(to("src"), to("tgt")).alias("tgt"))
        pairs = moved.where("src <> tgt").select("id", _pair().alias("new"))
        lists = t.read("relation_chunks").join(pairs, "id").select(F.col("new").alias("id"), F.explode("chunk_ids").alias("source_id"))
        own = t.read("entity_chunks").where(F.col("id").isin(*names)).select(F.lit(target).alias("id"), F.explode("chunk_ids").alias("source_id"))
        new_nodes, new_edges = plan(nodes, edges)
        put = materialise(new_edges, "edges")
        ids, keys = nodes.select("id"), edges.select("src", "tgt")
        self._list(t, "relation_chunks", materialise(lists, "lists"), moved.select("id").union(pairs.select("new")).distinct())
        self._list(t, "entity_chunks", materialise(own, "lists"), ids)
        self._put_nodes(t, materialise(new_nodes, "nodes"), ids)
        self._put_edges(t, put, keys)

    def edit_relation(self, a: str, b: str, changes: dict) -> None:
        """Change attributes of an edge; one that is not there is an error."""
        t = self.store.begin("edit-relation")
        edge = t.read("edges").where((F.col("src") == min(a, b)) & (F.col("tgt") == max(a, b))).drop("vector")
        if edge.isEmpty():
            raise ValueError(f"there is no relation between {a} and {b}")
        kinds = dict(edge.dtypes)
        put = self.store.spark.createDataFrame([(a, b, *changes.values())], ", ".join(["a string", "b string", *(f"{c} {kinds[c]}" for c in changes)]))
        self._put_edges(t, editing.edit_relations(edge, put))
        t.publish(f"edit {a} - {b}")

    def delete_entity(self, name: str) -> None:
        """Take a node out with its edges and chunk lists; one that is not there changes nothing."""
        t = self.store.begin("delete-entity")
        edges, one = self._at(t, [name]), t.read("nodes").where(F.col("id") == name).select("id")
        t.change("relation_chunks", None, edges.select(_pair().alias("id")))
        t.change("edges", None, edges.select("src", "tgt"))
        t.change("entity_chunks", None, one)
        t.change("nodes", None, one)
        t.publish(f"delete {name}")

    def delete_relation(self, a: str, b: str) -> None:
        """Take an edge out with its chunk list; one that is not there changes nothing."""
        t = self.store.begin("delete-relation")
        edge = t.read("edges").where((F.col("src") == min(a, b)) & (F.col("tgt") == max(a, b)))
        t.change("relation_chunks", None, edge.select(_pair().alias("id")))
        t.change("edges", None, edge.select("src", "tgt"))
        t.publish(f"delete {a} - {b}")

    def import_graph(self, chunks: DataFrame, entities: DataFrame, relations: DataFrame) -> None:
        """Put in a graph that the caller made (see :func:`editing.import_graph`), with vectors and chunk lists."""
        t = self.store.begin("import-graph")
        cut, nodes, edges = (materialise(df, "import") for df in editing.import_graph(chunks, entities, relations))
        rows = cut.dropDuplicates(["id"]).select("id", "content", F.col("source_id").alias("full_doc_id"), F.lit("custom_kg").alias("file_path"))
        t.change("chunks", self._vectors(rows, "content"))
        one = F.array("chunk_id").alias("source_ids")
        path = F.lit("custom_kg").alias("file_path")
        self._put_nodes(t, nodes.select("id", "entity_type", "description", one, path))
        self._put_edges(t, edges.select("src", "tgt", F.col("weight").cast("double").alias("weight"), "keywords", "description", one, path))
        lists = lambda ids: ids.where("source_id <> 'UNKNOWN'")
        for table, found in (("entity_chunks", nodes.select("id", F.col("chunk_id").alias("source_id"))), ("relation_chunks", edges.select(_pair().alias("id"), F.col("chunk_id").alias("source_id")))):
            self._list(t, table, lists(found), found.select("id").distinct())
        t.publish("import")


def contents(texts: DataFrame, queued: DataFrame, now: int = 0) -> DataFrame:
    """Rows of full_docs for the pending ones among queued texts: contents go by their hash, whatever their positions are."""
    time = F.lit(now).cast("long")
    fresh = queued.where("status = 'pending'").select("id", "file_path")
    clean = texts.select(sanitize("text").alias("content")).withColumn("id", content_id("content", "doc-"))
    found = clean.join(fresh, "id").groupBy("id").agg(F.first("content").alias("content"), F.first("file_path").alias("file_path"))
    return found.select("id", "content", "file_path", time.alias("create_time"), time.alias("update_time"))
