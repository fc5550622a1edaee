"""Each stage of the pipeline on all that its predecessor kept, against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import packing, quality_model, toxicity

RND = random.Random(21)
WORDS = ["".join(RND.choice("abcdefgh") for _ in range(RND.randint(2, 7))) for _ in range(300)]
BAD = ["vornik", "plugosh", "dratzel", "smegwit"]
PASSAGE = " ".join(RND.choice(WORDS) for _ in range(70))


def document(i):
    words = [RND.choice(WORDS) for _ in range(RND.randint(40, 90))]
    if i % 7 == 0:
        words = [w.upper() + "###" for w in words]
    if i % 5 == 1:
        for _ in range(6):
            words[RND.randrange(len(words))] = RND.choice(BAD)
    if i % 6 == 2:
        words += PASSAGE.split()
    return " ".join(words)


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    texts = {i: document(i) for i in range(220)}
    texts |= {1000: texts[3], 1001: texts[3] + " one", 1002: None, 1003: "", 1004: texts[4]}
    rows = [(i, t, "en", "s", len(t or "")) for i, t in texts.items()] + [(1004, texts[4], "en", "s", 0)]
    at = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{at}/documents.parquet")
    labels = [(i, int(i % 7 != 0), int(i % 5 == 1)) for i in range(220)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return at


def test_stages_match_brute_force(spark, sf_dir):
    import test_near_dup
    import test_suffix_dedup

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    before = docs.collect()
    model = quality_model.fit(docs, labels)
    score = lambda t: model.score(np.array([quality_model.statistics(t or "")]))[0]
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["quality"](spark, docs, sf_dir)
    assert tuple(kept.columns) == corpus_pipeline.COLUMNS
    rows = kept.collect()
    assert sorted(map(str, rows)) == sorted(str(r) for r in before if score(r.text) >= 0.3)
    clean = [r for r in before if r.doc_id < 220 and r.doc_id % 7]
    assert {r.doc_id for r in clean} <= {r.doc_id for r in rows}

    model = toxicity.fit(kept, labels)
    gains = toxicity.Gains(model)
    toxic = lambda t: np.interp(toxicity._strength(np.array([gains.histogram(t or "")], float), model.evidence), model.knots, model.values)[0]
    less = stages["toxicity"](spark, kept, sf_dir)
    after = less.collect()
    assert sorted(map(str, after)) == sorted(str(r) for r in rows if toxic(r.text) < 0.5)
    assert sum(r.doc_id % 5 == 1 for r in after if r.doc_id < 220) <= 4 and len(after) < len(rows)

    unique = stages["near duplicates"](spark, less, sf_dir)
    left = unique.collect()
    classes = test_near_dup.brute([(r.doc_id, r.text) for r in after])
    assert sorted(r.doc_id for r in left) == sorted(set(classes.values()))

    cut = {r.doc_id: r for r in stages["repeats"](spark, unique, sf_dir).collect()}
    for r, (own, *_) in zip(left, test_suffix_dedup.brute([(r.doc_id, r.text) for r in left])):
        own = own.decode("utf-8", "ignore")
        assert cut[r.doc_id].text == own and cut[r.doc_id].n_chars == len(own)
    assert sum(len(r.text or "") for r in left) > sum(r.n_chars for r in cut.values())

    packed = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in packed if r.piece == 0) == sorted(cut)
    held = {}
    for r in packed:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in held.values():
        assert [a for a, _ in sorted(own)] == list(np.cumsum([0, *(n for _, n in sorted(own))])[:-1])
        assert sum(n for _, n in own) <= packing.CAPACITY


def test_empty_tables_and_no_labels(spark, sf_dir, tmp_path):
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    labels.limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    stages = dict(corpus_pipeline.STAGES)
    few = docs.where(F.col("doc_id") < 30)
    assert stages["quality"](spark, few, str(tmp_path)).count() == stages["toxicity"](spark, few, str(tmp_path)).count() == few.count()
