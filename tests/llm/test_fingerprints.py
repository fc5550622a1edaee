import hashlib
import random
import re

from pyspark.sql import functions as F

from tessera.llm import fingerprints as fp


def units(text):
    """Units character by character: a cut after each one but between letters, unless the first of them ends a unit and the other does not."""
    kind = lambda c: "v" if re.match(f"[{fp.ENDS}]", c) else "c" if re.match(f"[{fp.LETTERS}]", c) else " " if c in " \t\n\v\f\r" else "x"
    out, before = [], " "
    for c in text or "":
        now = kind(c)
        if before + now in ("cc", "cv", "vv"):
            out[-1] += c
        elif now != " ":
            out.append(c)
        before = now
    return out


def brute_next(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    return {id(r): order[(i + 1) % len(order)][1] or "" for i, r in enumerate(order)}, order


ROWS = [
    (7, "the quick brown fox jumps over the lazy dog and runs far away from the other quick brown dogs today"),
    (3, None), (9, ""), (5, "short"), (4, "abcdefghijklmnop" * 40), (11, "🙂 é ñ " * 30), (12, "🙂é" * 40 + " x"),
    (2, "the quick brown fox jumps over the lazy dog and runs far away from the other quick brown dogs today"),
]


def run(spark, rows, blocks):
    df = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, fingerprint string")
    return {r.doc_id: r for r in fp.compare_with_next(df, blocks=blocks).collect()}


def test_edits_follow_the_next_document(spark):
    after, order = brute_next(ROWS)
    for blocks in (1, 3, 50):
        got = run(spark, ROWS, blocks)
        assert len(got) == len(ROWS)
        for r in order:
            text = r[1] or ""
            n = len(text) // 3
            edited = text[: len(text) - n] + after[id(r)][:n]
            assert got[r[0]].n_chars == len(text)
            assert got[r[0]].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
            assert 0 <= got[r[0]].near_edited <= 1 and 0 <= got[r[0]].near_next <= 1
    assert got[7].fingerprint == got[2].fingerprint != ""
    assert got[3].fingerprint == got[9].fingerprint == ""


def test_windows_keep_the_rightmost_minimum(spark):
    """Every window of hashes has its rightmost minimum among the kept ones, and nothing else is kept."""
    k, window = fp.K, fp.WINDOW
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    gram = F.expr("transform(sequence(0, greatest(size(u) - 4, 0)), i -> xxhash64(xxhash64(xxhash64(u[i]), xxhash64(u[i + 1])), xxhash64(xxhash64(u[i + 2]), xxhash64(u[i + 3]))))")
    marks = fp.with_fingerprint(df, "text", "m", k, window)
    rows = marks.withColumn("u", fp._units(F.col("text"))).withColumn("g", F.when(F.size("u") >= k, gram)).select(
        "doc_id", "text", "u", "g", fp.hashes_of("m").alias("h"), fp.positions_of("m").alias("p")).collect()
    for r in rows:
        assert list(r.u) == units(r.text)
        if not r.g:
            assert len(r.p) == (1 if r.u else 0)
            continue
        low = [x & 0xFFFFFFFF for x in r.g]
        windows = [range(i, i + window) for i in range(max(1, len(low) - window + 1))]
        wanted = {max((i for i in w if i < len(low)), key=lambda i: (-low[i], i)) for w in windows}
        assert set(r.p) == wanted
        assert set(r.h) == {low[i] for i in wanted}


def test_empty_tables_and_null_or_repeated_keys(spark):
    assert fp.compare_with_next(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    df = spark.createDataFrame([(None, "a b"), (None, "c"), (1, "x"), (1, "x"), (1, None)], "doc_id long, text string")
    assert fp.compare_with_next(df, blocks=3).count() == 5


def test_passages_without_spaces_share_hashes_at_any_offset(spark):
    passage = "".join(chr(0x4E00 + (i * i * 31 + 7 * i) % 4000) for i in range(60))
    texts = [passage, "x" + passage, "abc" + passage + "def", passage[5:18] + "zz" * 30]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = fp.with_fingerprint(df).select("doc_id", fp.hashes_of("marks").alias("h")).collect()
    own = {r.doc_id: set(r.h) for r in rows}
    assert all(len(own[0] & own[i]) >= 0.7 * len(own[0]) for i in (1, 2))
    assert own[0] & own[3]  # 13 characters in a row guarantee one


def test_shared_units_share_a_hash_whatever_the_length_of_runs(spark):
    """Passages of 11 whole units inside runs of 1 to 100 characters more on either side, with and without spaces."""
    rnd = random.Random(1)
    draw = {
        "han": lambda n: "".join(chr(0x4E00 + rnd.randrange(3000)) for _ in range(n)),
        "kana": lambda n: "".join(chr(0x3041 + rnd.randrange(80)) for _ in range(n)),
        "letters": lambda n: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyzäé") for _ in range(n)),
        "code": lambda n: "".join(rnd.choice("ABCDEFabcdef0123456789+/=") for _ in range(n)),
        "cyrillic": lambda n: "".join(chr(0x0410 + rnd.randrange(64)) for _ in range(n)),
        "words": lambda n: "".join(rnd.choice("aeioutnrslc  ") for _ in range(n)),
    }
    rows, pairs = [], []
    for kind, made in draw.items():
        for n in range(1, 101):
            shared = made(400)
            inner = units(shared)[1:-1]  # the first and the last may go on outside
            both = [made(n) + shared, made(101 - n) + shared + made(n)]
            if len(inner) >= fp.K + fp.WINDOW - 1:
                pairs.append((kind, n, len(rows)))
                rows += [(len(rows), both[0]), (len(rows) + 1, both[1])]
    got = {r.doc_id: set(r.h) for r in fp.with_fingerprint(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", fp.hashes_of("marks").alias("h")).collect()}
    assert len(pairs) > 500
    assert [(kind, n) for kind, n, i in pairs if not got[i] & got[i + 1]] == []


def test_likeness_is_the_jaccard_share_of_hashes(spark):
    got = run(spark, ROWS, 2)
    after, order = brute_next(ROWS)
    hashes = lambda s: {x.split(":")[1] for x in s.split()}
    share = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    for i, r in enumerate(order):
        own = got[r[0]]
        assert abs(own.near_edited - share(hashes(own.fingerprint), hashes(own.edited_fingerprint))) < 1e-12
        assert abs(own.near_next - share(hashes(own.fingerprint), hashes(got[order[(i + 1) % len(order)][0]].fingerprint))) < 1e-12


def test_very_long_texts(spark):
    rows = [(1, "word " * 200_000), (2, "x1y2" * 100_000)]
    got = run(spark, rows, 2)
    assert got[1].n_chars == 1_000_000 and got[2].n_chars == 400_000 and got[1].fingerprint and got[2].fingerprint


def test_units_of_all_characters(spark):
    """Classes that list characters one by one hold what the ranges hold."""
    chars = [chr(i) for i in range(1, 0x2100)]
    rows = spark.createDataFrame([(c, f"b{c}b{c}o{c}") for c in chars], "c string, t string").select("t", fp._units(F.col("t")).alias("u")).collect()
    assert all(r.u == units(r.t) for r in rows)
    assert "\\x41-" not in fp._class(fp.LETTERS) and "\\x61\\x62" in fp._class(fp.LETTERS, fp.ENDS)
