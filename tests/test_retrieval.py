"""Retrieval modes against the same rules written as loops over lists."""

import random
from collections import Counter

import numpy as np
import pytest

from tessera.plans.retrieval import KnowledgeBase, QueryParam, retrieve

RND = random.Random(21)
WORDS = "ash birch cedar elm fir".split()


def vector():
    return [RND.uniform(-1, 1) for _ in range(4)]


def said(n):
    return " ".join(RND.choice(WORDS) for _ in range(RND.randint(1, n)))


CHUNKS = [(f"c{i:02d}", said(12), f"f{i % 5}", vector()) for i in range(40)]
NODES = [(f"n{i:02d}", "kind", said(6), RND.sample([c[0] for c in CHUNKS], RND.randint(0, 6)), vector()) for i in range(25)]
PAIRS = sorted({tuple(sorted(RND.sample([n[0] for n in NODES], 2))) for _ in range(60)} | {("n00", n[0]) for n in NODES[1:]})
EDGES = [(a, b, said(6), float(RND.randint(1, 3)), RND.sample([c[0] for c in CHUNKS], RND.randint(0, 4)), vector()) for a, b in PAIRS]


def near(rows, q, k, least):
    """(key) by falling cosine, ties by key."""
    cos = lambda v: float(np.dot(v, q) / np.linalg.norm(v) / np.linalg.norm(q))
    found = sorted(((-cos(v), key) for key, v in rows if cos(v) >= least))
    return [key for _, key in found[:k]]


def in_turns(*lists):
    out = []
    for place in range(max(map(len, lists), default=0)):
        for own in lists:
            if place < len(own) and own[place] not in out:
                out.append(own[place])
    return out


def within(keys, tokens, most):
    out, total = [], 0
    for k in keys:
        total += tokens(k)
        if total > most:
            break
        out.append(k)
    return out


def owned(owners, sources, taken=()):
    """Chunks by owner: (owner's place, owner, place in its list, chunk, how many owners name it), each at its first owner."""
    seen = Counter(c for o in owners for c in sources[o])
    out = {}
    for at, o in enumerate(owners):
        for i, c in enumerate(sources[o]):
            out.setdefault(c, (at, o, i, c, seen[c]))
    return [x for x in out.values() if x[3] not in taken]


def few(rows, each, most):
    out = []
    for at in sorted({r[0] for r in rows}):
        out += sorted((r for r in rows if r[0] == at), key=lambda r: (-r[4], r[2]))[:each]
    return [r[3] for r in out][:most]


def plain(q, p):
    node, edge, chunk = {n[0]: n for n in NODES}, {e[:2]: e for e in EDGES}, {c[0]: c for c in CHUNKS}
    degree = Counter(x for e in EDGES for x in e[:2])
    entities, relations = [], []
    if p.mode in ("local", "hybrid", "mix"):
        hits = near([(n[0], n[4]) for n in NODES], q, p.top_k, p.cosine_threshold)
        at = [e for e in edge if set(e) & set(hits)]
        entities.append(hits)
        relations.append(sorted(at, key=lambda e: (-degree[e[0]] - degree[e[1]], -edge[e][3], e)))
    if p.mode in ("global", "hybrid", "mix"):
        hits = near([(e[:2], e[5]) for e in EDGES], q, p.top_k, p.cosine_threshold)
        entities.append(list(dict.fromkeys(x for e in hits for x in e)))
        relations.append(hits)
    entities, relations = in_turns(*entities), in_turns(*relations)
    words = lambda *texts: sum(len(t.split()) for t in texts)
    entities = within(entities, lambda k: words(k, *node[k][1:3]), p.max_entity_tokens)
    relations = within(relations, lambda k: words(*k, edge[k][2]), p.max_relation_tokens)
    lists = [near([(c[0], c[3]) for c in CHUNKS], q, p.chunk_top_k, p.cosine_threshold)] if p.mode == "mix" else []
    by_node = owned(entities, {k: n[3] for k, n in node.items()})
    by_edge = owned(relations, {k: e[4] for k, e in edge.items()}, {r[3] for r in by_node})
    lists += [few(by_node, p.related_chunks, p.chunk_top_k), few(by_edge, p.related_chunks, p.chunk_top_k)]
    chunks = within(in_turns(*lists)[: p.chunk_top_k], lambda c: words(chunk[c][1]), p.max_total_tokens)
    return entities, relations, chunks


@pytest.mark.parametrize("mode", ["local", "global", "hybrid", "mix"])
def test_modes_as_loops_have_them(spark, mode):
    kb = KnowledgeBase(
        spark.createDataFrame(CHUNKS, "chunk_id string, content string, file_path string, vector array<double>"),
        spark.createDataFrame(NODES, "id string, entity_type string, description string, source_ids array<string>, vector array<double>"),
        spark.createDataFrame(EDGES, "src string, tgt string, description string, weight double, source_ids array<string>, vector array<double>"),
    )
    for p in (QueryParam(mode=mode, top_k=6, chunk_top_k=9, related_chunks=2, cosine_threshold=0.1), QueryParam(mode=mode, top_k=9, max_entity_tokens=25, max_relation_tokens=40, max_total_tokens=45)):
        q = vector()
        got = retrieve(kb, q, p)
        entities, relations, chunks = plain(q, p)
        by_pos = lambda df: sorted(df.collect(), key=lambda r: r.pos)
        assert [r.id for r in by_pos(got["entities"])] == entities
        assert [(r.src, r.tgt) for r in by_pos(got["relations"])] == relations
        assert [r.chunk_id for r in by_pos(got["chunks"])] == chunks
        assert entities and relations and chunks


def moved(spark, first):
    """Rows that the stages from a number on wrote for others, and the next stage's number."""
    sc = spark.sparkContext
    sc._jsc.sc().listenerBus().waitUntilEmpty()
    found = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), None)
    stages = [found.apply(i) for i in range(found.size())]
    return sum(s.shuffleWriteRecords() for s in stages if s.stageId() >= first), max((s.stageId() for s in stages), default=-1) + 1


@pytest.mark.parametrize("mode", ["local", "global", "hybrid", "mix"])
def test_tables_that_are_plans_are_moved_once_at_most(spark, tmp_path, mode):
    """Nodes and edges grouped from what chunks say of them: lists of few rows are looked up below the groups."""
    from pyspark.sql import functions as F

    n = 4000
    said = spark.range(n).selectExpr("concat('n', id % 400) AS src", "concat('m', id % 1000) AS tgt", "concat('c', id) AS chunk_id", "array(id % 7, id % 11, id % 13 + 1.0D) AS at")
    said.write.parquet(f"{tmp_path}/said")
    said = spark.read.parquet(f"{tmp_path}/said")
    sources = F.array_sort(F.collect_set("chunk_id")).alias("source_ids")
    edges = said.groupBy("src", "tgt").agg(F.count(F.lit(1)).cast("double").alias("weight"), sources).withColumn("description", F.lit("said"))
    edges = edges.withColumn("vector", F.array(F.ascii("src") * 1.0, F.length("tgt") * 1.0, F.crc32("tgt") / 2.0**32))
    names = spark.range(400).selectExpr("concat('n', id) AS id", "'kind' AS entity_type", "'who' AS description", "array(id % 3 * 1.0D, 1.0D, id / 400) AS vector")
    nodes = names.join(said.groupBy(F.col("src").alias("id")).agg(sources), "id", "left")
    chunks = said.where("crc32(chunk_id) % 2 = 0").selectExpr("chunk_id", "chunk_id AS content", "'f' AS file_path", "at AS vector")
    _, first = moved(spark, 0)
    got = retrieve(KnowledgeBase(chunks, nodes, edges), [1.0, 1.0, 0.5], QueryParam(mode=mode, top_k=3, chunk_top_k=5))
    rows = {name: got[name].count() for name in ("entities", "relations", "chunks")}
    assert all(rows.values())
    whole = 0 if mode == "local" else n
    assert moved(spark, first)[0] < whole + n / 2
