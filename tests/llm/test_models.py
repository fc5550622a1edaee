import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import labelled, quality_model, quality_rules, toxicity

RND = random.Random(2)
SYLLABLES = "th er on an re he in ed nd ha".split()
BAD = ["vornik", "plugosh", "dratzel", "smegwit"]


def word():
    return "".join(RND.choice(SYLLABLES) for _ in range(RND.randint(1, 4)))


def document(toxic, good):
    words = [word() for _ in range(RND.randint(30, 120))]
    if toxic:
        for _ in range(RND.randint(3, 6)):
            words[RND.randrange(len(words))] = RND.choice(BAD)
    if not good:
        words = [w.upper() + RND.choice(["###", "&&&", "!!", "%%%"]) for w in words]
    return " ".join(words)


@pytest.fixture(scope="module")
def tables(spark):
    rows = [(i, document(i % 4 == 0, i % 3 != 0), "x") for i in range(600)] + [(1000, None, None), (1001, "", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, int(i % 3 != 0), int(i % 4 == 0)) for i in range(600)] + [(None, 1, 1), (5000, 1, None)], "doc_id long, quality int, toxic int")
    return docs, labels


def accuracy(rows, wanted):
    held = [r for r in rows if r.doc_id is not None and r.doc_id < 1000 and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(held) > 80
    return sum(r.predicted == wanted(r.doc_id) for r in held) / len(held)


def test_toxicity_of_held_out_documents(tables):
    docs, labels = tables
    rows = toxicity.classify(docs, toxicity.fit(docs, labels)).collect()
    assert len(rows) == 602 and all(0 <= r.score <= 1 for r in rows)
    assert accuracy(rows, lambda i: int(i % 4 == 0)) > 0.85


def test_quality_of_held_out_documents(tables):
    docs, labels = tables
    rows = quality_model.classify(docs, quality_model.fit(docs, labels)).collect()
    assert len(rows) == 602 and all(0 <= r.score <= 1 for r in rows)
    assert accuracy(rows, lambda i: int(i % 3 != 0)) > 0.95


def test_models_without_labels(spark, tables):
    docs, labels = tables
    none = labels.limit(0)
    assert {r.score for r in quality_model.classify(docs, quality_model.fit(docs, none)).collect()} == {0.0}
    assert {r.score for r in toxicity.classify(docs, toxicity.fit(docs, none)).collect()} == {0.0}
    assert quality_model.classify(docs.limit(0), quality_model.fit(docs.limit(0), none)).count() == 0


def test_held_out_rows_are_never_learned_from(tables):
    docs, labels = tables
    seen = {r.doc_id for r in labelled.labelled_sample(docs, labels, "quality").collect()}
    assert seen and not any(zlib.crc32(str(i).encode()) % 5 == 0 for i in seen)
    assert labelled.labelled_sample(docs, labels, "quality", 50).count() <= 50


def test_isotonic_is_the_best_rising_fit():
    x, y = np.array([3.0, 1.0, 2.0, 2.0, 5.0, 4.0]), np.array([1.0, 0.0, 1.0, 0.0, 1.0, 0.0])
    knots, values = labelled.isotonic(x, y)
    assert (np.diff(values) >= 0).all() and np.interp(1.0, knots, values) == 0 and np.interp(5.0, knots, values) == 1


def brute(text):
    """Base counts, word by word."""
    text = text or ""
    words = [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", text)]
    lines, dup = [], 0
    for line in text.split("\n"):
        if __import__("re").search(r"[^\x20\x09-\x0D]", line):
            dup += line in lines
            lines.append(line)
    at = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(at)
    covered = {i + k for i, w in enumerate(at) if times[w] > 1 for k in range(5)}
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered)


def test_rules_match_plain_counts(spark, tables):
    docs, labels = tables
    odd = ["a b c d e " * 4, "x\nx\n\nx y\n \n \nx", "é\x0bñ\x85\xa0# |", "🙂 " * 12, "a b c d e f a b c d e"]
    more = spark.createDataFrame([(2000 + i, t, "k") for i, t in enumerate(odd)], docs.schema)
    every = docs.unionByName(more)
    trusted = labels.where("quality = 1").select("doc_id")
    rows = quality_rules.judge(every, trusted).collect()
    assert len(rows) == 607
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(r.text), r.text
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.kept and r.base_failed)
    clean = [r for r in rows if r.doc_id < 600]
    assert np.mean([r.kept for r in clean if r.doc_id % 3 != 0]) > 0.97
    assert np.mean([r.kept for r in clean if r.doc_id % 3 == 0]) < 0.1


def test_counts_are_over_all_rows(spark, tables):
    docs, _ = tables
    counts = quality_rules.corpus_counts(docs.select("text", F.lit(True).alias("trusted"))).collect()
    grams = sum(max(0, len((r.text or "").encode()) - 3) for r in docs.collect())
    assert sum(r.n_raw for r in counts) == grams == sum(r.n_trusted for r in counts)


def plain_ratio(text, trusted, raw):
    """Mean log ratio of one text's byte n-grams, gram by gram."""
    total_t, total_r = sum(trusted.values()), sum(raw.values())
    at = quality_rules.grams(text.encode()).tolist()
    out = 0.0
    for b in at:
        share = (raw[b] + 1) / (total_r + quality_rules.BUCKETS)
        lean = quality_rules.LEAN * total_t
        out += np.log((trusted[b] + lean * share) / (total_t + lean) / share)
    return out / len(at) if at else 0.0


def test_ratio_and_verdict_match_plain_counts(spark):
    """Two languages, one of which has few trusted texts: ratios and verdicts as counted gram by gram."""
    other = "zo ka mi tu pe wu xa".split()
    texts = {i: document(False, i % 3 != 0) for i in range(120)}
    texts |= {200 + i: " ".join(RND.choice(other) + RND.choice(other) for _ in range(60)) for i in range(24)}
    trusted_ids = [i for i in texts if (i < 200 and i % 3 and i % 2) or (i >= 200 and i % 4 == 0)]
    docs = spark.createDataFrame([(i, t) for i, t in texts.items()] + [(900, None), (901, "")], "doc_id long, text string")
    rows = quality_rules.judge(docs, spark.createDataFrame([(i,) for i in trusted_ids], "doc_id long")).collect()
    raw, trusted = Counter(), Counter()
    for i, t in texts.items():
        g = Counter(quality_rules.grams(t.encode()).tolist())
        raw += g
        trusted += g if i in trusted_ids else Counter()
    loo = []
    for i in trusted_ids:
        if brute(texts[i])[0] >= 10 and 100 * brute(texts[i])[4] <= 20 * brute(texts[i])[0]:
            loo.append(plain_ratio(texts[i], trusted - Counter(quality_rules.grams(texts[i].encode()).tolist()), raw))
    least = np.percentile(loo, 100 * quality_rules.LEAST_SHARE)
    for r in rows:
        ratio = plain_ratio(r.text or "", trusted, raw)
        assert abs(r.ratio - ratio) < 1e-9
        if abs(ratio - least) > 1e-9:
            assert r.kept == (not r.base_failed and ratio >= least)
    good = [r for r in rows if r.doc_id < 900 and (r.doc_id >= 200 or r.doc_id % 3) and not r.base_failed]
    for of in (lambda i: i < 200, lambda i: i >= 200):
        assert np.mean([r.kept for r in good if of(r.doc_id)]) > 0.9


def test_toxicity_scores_match_plain_compression(tables):
    """Gains, histograms and scores computed text by text with zstandard alone, nulls and repeated ids included."""
    import zstandard

    docs, labels = tables
    model = toxicity.fit(docs.union(docs.where("doc_id < 40")), labels)
    parameters = zstandard.ZstdCompressionParameters.from_level(toxicity.LEVEL, min_match=3, write_content_size=False)
    raw = lambda d: zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    size = lambda d, w: len(zstandard.ZstdCompressor(dict_data=raw(d), compression_params=parameters).compress(w))
    for r in toxicity.classify(docs.where("doc_id % 9 = 0 or doc_id >= 1000"), model).collect():
        total, n = 0.0, 0
        for w in (r.text or "").lower().encode().translate(None, toxicity._PUNCTUATION).split():
            framed = model.context + b" " + w + b" " + model.context[:16]
            gain = min(max(size(model.ordinary, framed) - size(model.toxic, framed), 0), toxicity.GAINS - 1)
            total, n = total + model.evidence[gain], n + 1
        score = np.clip(np.interp(total / max(n, 1) ** 0.5, model.knots, model.values), 0, 1)
        assert abs(r.score - score) < 1e-9 and r.predicted == int(r.score >= 0.5)


def test_repeated_ids_stay_within_the_bound(tables):
    docs, labels = tables
    many = docs.union(docs).union(docs)
    rows = labelled.labelled_sample(many, labels, "quality", 60).collect()
    assert 0 < len(rows) <= 60 and len({r.doc_id for r in rows}) == len(rows)


def test_quality_scores_match_plain_features(tables):
    docs, labels = tables
    model = quality_model.fit(docs, labels)
    for r in quality_model.classify(docs.where("doc_id % 25 = 0 or doc_id >= 1000"), model).collect():
        x = np.array([quality_model.statistics(r.text or "")])
        raw = quality_model.fourier(x)[0] @ model.weights
        assert abs(r.score - np.clip(np.interp(raw, model.knots, model.values), 0, 1)) < 1e-9


def test_all_trusted_documents_count(spark, tmp_path, monkeypatch):
    """op5 counts every labelled document outside the held-out fold, however many there are."""
    from tessera.llm import queries

    n = 40_000
    spark.range(n).selectExpr("id AS doc_id", "'some text' AS text").write.parquet(f"{tmp_path}/documents.parquet")
    spark.range(n).selectExpr("id AS doc_id", "CAST(id % 10 < 9 AS int) AS quality", "0 AS toxic").write.parquet(f"{tmp_path}/labels.parquet")
    seen = []
    judge = quality_rules.judge
    monkeypatch.setattr(quality_rules, "judge", lambda docs, trusted: seen.append(trusted.count()) or judge(docs, trusted))
    assert queries.op5_quality_rules(spark, str(tmp_path)).count() == n
    learned = spark.range(n).where("id % 10 < 9 and crc32(cast(cast(id as string) as binary)) % 5 <> 0").count()
    assert seen == [learned] and learned > 24_000
