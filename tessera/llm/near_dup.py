"""Near-duplicate groups by improved consistent weighted sampling over TF-IDF shingles.

A text's shingles are its runs of five words (of all its words, if it has fewer).  A shingle weighs its count times the
mean inverse document frequency of its words; document frequencies are counted over all rows in a fixed table of hashed
words.  (Its own document frequency would weigh down what a group of copies shares and so part the group: see the README.)  Consistent weighted samples (Ioffe 2010) of these weights are banded: two texts meet in a band with the
probability of their weighted Jaccard similarity to the power of the band's rows.

Texts that meet are compared exactly.  A band's bucket is never expanded into all pairs: its members are compared with
the bucket's first text.  Those that are too unlike are few in most buckets, and one task links them up.
Jaccard distance is a metric, so a text that its first text is too unlike can only be linked to a member of that group whose
own distance to the first text comes within 0.2 of the text's; such members, all of them, stay with the rest.
Where the rest is large, more first texts join up what they can; then members that are still in different groups are
compared in pairs of blocks, one task a pair, so that every link of the bucket that could join two groups is looked at.
Copies of a text count once in all of this and come back as members of its class.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import drop_path, materialise, reach_workers
from tessera.llm.components import connected

WORDS = 5
SIMILARITY = 0.8
BANDS = 16
ROWS = 5
WORD_BUCKETS = 1 << 18
GROUP = 1_024  # members of a bucket that one task compares at once, about
GROUP_BYTES = 8 << 20  # and bytes of their texts; a longer text is alone in its block
FIRSTS = 32  # first texts at once in buckets that are larger
_SLACK = 1e-9  # of the metric's bound, for rounding
_DRAWS = 1 << 16
_CHUNK = 1 << 18  # bytes of text that are hashed at once
_AT = ["band", "bucket"]
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_SPACES = np.zeros(256, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(30))
    h *= _M2
    h ^= h >> np.uint64(27)
    h *= _M3
    h ^= h >> np.uint64(31)
    return h


@lru_cache(maxsize=1)
def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, _M1)]), dtype=np.uint64)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word of some texts, and how many words each has; words are runs without ASCII white space."""
    raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    solid = ~_SPACES[raw]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], solid, [False]])))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    at = np.flatnonzero(solid)
    lengths = ends - starts
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    place = np.arange(len(at)) - np.repeat(first, lengths)
    most = 1 << int(max(6, int(lengths.max()).bit_length()))
    hashes = np.add.reduceat((raw[at].astype(np.uint64) + np.uint64(1)) * _powers(most)[place], first)
    hashes = _mix(hashes + lengths.astype(np.uint64) * _M2)
    bounds = np.cumsum([len(t) + 1 for t in texts])
    return hashes, np.diff(np.concatenate([[0], np.searchsorted(starts, bounds)]))


def shingles(texts: list[bytes], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingle hashes and weights of some texts, sorted within each, and where each text's begin (one more at the end)."""
    words, n_words = word_hashes(texts)
    if not len(words):
        return np.zeros(0, np.uint64), np.zeros(0), np.zeros(len(texts) + 1, np.int64)
    rare = idf[(words >> np.uint64(64 - 18)).astype(np.int64)]
    begin = np.concatenate([[0], np.cumsum(n_words)])
    span = np.minimum(n_words, WORDS)
    n_shingles = np.where(n_words > 0, n_words - span + 1, 0)
    owner = np.repeat(np.arange(len(texts)), n_shingles)
    ends = np.cumsum(n_shingles)
    start = np.arange(ends[-1]) - np.repeat(ends - n_shingles, n_shingles) + begin[owner]
    width = span[owner]
    h = np.zeros(len(start), np.uint64)
    weight = np.zeros(len(start))
    for j in range(WORDS):
        on = width > j
        at = start[on] + j
        h[on] = _mix(h[on] * _M1 + words[at])
        weight[on] += rare[at]
    weight /= width
    order = np.lexsort((h, owner))
    h, owner, weight = h[order], owner[order], weight[order]
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])])
    heads = np.flatnonzero(new)
    weight = np.add.reduceat(weight, heads)
    return h[heads], weight, np.searchsorted(owner[heads], np.arange(len(texts) + 1))


@lru_cache(maxsize=1)
def _draws() -> tuple[np.ndarray, ...]:
    """Tables of r and ln c (gamma of shape 2) and beta (uniform), and a multiplier for each sample."""
    rng = np.random.default_rng(2010)
    r = rng.gamma(2.0, 1.0, _DRAWS).astype(np.float32)
    c = np.log(rng.gamma(2.0, 1.0, _DRAWS)).astype(np.float32)
    beta = rng.random(_DRAWS).astype(np.float32)
    return r, (1 / r).astype(np.float32), c - r, beta, rng.integers(1, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)


def samples(h: np.ndarray, weight: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """One row of consistent weighted samples for each text that has shingles."""
    r, inverse, c_less_r, beta, multipliers = _draws()
    log_w = np.log(weight).astype(np.float32)
    heads = begin[:-1][begin[1:] > begin[:-1]]
    place = np.arange(len(h), dtype=np.uint64)
    out = np.zeros((len(heads), BANDS * ROWS), np.uint64)
    for i, multiplier in enumerate(multipliers):
        at = ((h * multiplier) >> np.uint64(48)).astype(np.int64)
        own = r[at]
        b = beta[at]
        t = np.floor(log_w * inverse[at] + b)
        log_a = c_less_r[at] - own * (t - b)
        bits = log_a.view(np.uint32)
        bits = np.where(bits >> np.uint32(31), ~bits, bits | np.uint32(1 << 31))  # sorts as the floats do
        least = np.minimum.reduceat(bits.astype(np.uint64) << np.uint64(32) | place, heads)
        pick = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
        out[:, i] = h[pick] + t[pick].astype(np.int64).astype(np.uint64) * _M1
    return out


def band_keys(h: np.ndarray, weight: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """One row of band keys for each text that has shingles."""
    drawn = samples(h, weight, begin)
    keys = np.zeros((len(drawn), BANDS), np.uint64)
    for i in range(BANDS * ROWS):
        band = i // ROWS
        keys[:, band] = _mix(keys[:, band] * _M1 + drawn[:, i] + np.uint64(i))
    return keys


def _spanning(
    texts: list[bytes], idf: np.ndarray, similarity: float, owners: list[bytes | None], sides: list[int] | None = None
) -> list[tuple[int, int]]:
    """Pairs of texts that are alike, as few as join all that are: pairs in one group already are not looked at.

    Texts of one owner are one group from the start.  With ``sides``, only texts of different sides are compared.  Each
    text meets all that share a shingle with it at once, over lists of the texts that hold each shingle, so the
    similarities are exact and no pair is passed over.
    """
    n = len(texts)
    parts = [shingles(texts[p], idf) for p in _chunks(texts)]
    held = np.concatenate([np.diff(begin) for _, _, begin in parts] or [np.zeros(0, np.int64)])
    begin = np.concatenate([[0], np.cumsum(held)])
    h, w = (np.concatenate([p[k] for p in parts] or [np.zeros(0)]) for k in (0, 1))
    owner = np.repeat(np.arange(n), held)
    # shingles that one text alone holds count for its total only
    kinds, number, times = np.unique(h, return_inverse=True, return_counts=True)
    del h
    total = np.bincount(owner, w, n)
    order = np.argsort(number, kind="stable")
    holders, weights = owner[order], w[order]
    first = np.concatenate([[0], np.cumsum(times)])
    first_of: dict[bytes, int] = {}
    parent = np.array([i if o is None else first_of.setdefault(o, i) for i, o in enumerate(owners)])
    side = np.arange(n) if sides is None else np.array(sides)
    out = []
    for i in range(n):
        own = np.arange(begin[i], begin[i + 1])
        own = own[times[number[own]] > 1]
        if not len(own):
            continue
        open_ = (side != side[i]) & (parent != parent[i])
        open_[: i + 1] = False
        if not open_.any():
            continue
        shared = np.zeros(n)
        for part in np.array_split(own, max(1, int(times[number[own]].sum()) >> 20)):
            count = times[number[part]]
            at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first[number[part]], count)
            at_own = np.repeat(w[part], count)
            shared += np.bincount(holders[at], np.minimum(at_own, weights[at]), n)
        for j in np.flatnonzero(open_ & (shared >= similarity * (total[i] + total - shared))):
            if parent[j] != parent[i]:
                parent[parent == parent[j]] = parent[i]
                out.append((i, int(j)))
    return out


def _overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two sorted shingle vectors."""
    _, left, right = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = np.minimum(a[1][left], b[1][right]).sum()
    return float(shared / (a[1].sum() + b[1].sum() - shared))


def _chunks(texts: list[bytes]) -> Iterator[slice]:
    first = size = 0
    for i, t in enumerate(texts):
        size += len(t) + 1
        if size >= _CHUNK:
            yield slice(first, i + 1)
            first, size = i + 1, 0
    if first < len(texts):
        yield slice(first, len(texts))


def _raw(texts: pa.Array) -> list[bytes]:
    return [(s or "").encode() for s in texts.to_pylist()]


def inverse_frequencies(docs: DataFrame, text: str = "text") -> np.ndarray:
    """ln((n + 1) / (df + 1)) + 1 for each bucket of hashed words, over all rows; at most a fixed number of rows return."""
    reach_workers(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(WORD_BUCKETS, np.int64)
        n = 0
        for batch in batches:
            raw = _raw(batch.column(0))
            n += len(raw)
            for part in _chunks(raw):
                words, n_words = word_hashes(raw[part])
                bucket = (words >> np.uint64(64 - 18)).astype(np.int64)
                owner = np.repeat(np.arange(len(n_words)), n_words)
                once = np.unique(owner * WORD_BUCKETS + bucket) % WORD_BUCKETS
                df += np.bincount(once, minlength=WORD_BUCKETS)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array([-1, *at]), pa.array([n, *df[at]])], ["bucket", "n"])

    total = docs.select(text).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    found = {r["bucket"]: r["n"] for r in total.collect()}
    df = np.zeros(WORD_BUCKETS)
    n = found.pop(-1, 0)
    df[list(found)] = list(found.values())
    return np.log((n + 1) / (df + 1)) + 1


def _similarity(a: bytes, b: bytes, idf: np.ndarray) -> float:
    """Weighted Jaccard similarity of two texts; 0 if either has no words."""
    h, w, begin = shingles([a, b], idf)
    cut = begin[1]
    if not cut or cut == len(h):
        return 0.0
    return _overlap((h[:cut], w[:cut]), (h[cut:], w[cut:]))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, keep_text: bool = True) -> DataFrame:
    """Add class_id and is_first to each row: the smallest key of its near-duplicate group, and whether the row has it.

    Groups are the connected components of links of at least ``similarity``; equal texts (null counts as empty) are one.
    Texts without words are only like their copies.  Exactly one row of a group is first, also where rows are repeated; a
    null key is first only in a group without others.  Other columns pass (the text only with ``keep_text``); clashing ones
    are replaced.
    """
    spark = docs.sparkSession
    reach_workers(spark)
    docs = docs.drop("class_id", "is_first")
    node = F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))).alias("node")
    table = spark.sparkContext.broadcast(inverse_frequencies(docs, text))  # of fixed size

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def bands(texts: pa.Array) -> pa.Array:
        raw = _raw(texts)
        out: list = []
        for part in _chunks(raw):
            h, w, begin = shingles(raw[part], table.value)
            has = np.diff(begin) > 0
            rows = iter(band_keys(h, w, begin).view(np.int64).tolist() if len(h) else [])
            out.extend(next(rows) if x else [] for x in has)
        return pa.array(out, pa.list_(pa.int64()))

    @F.arrow_udf(T.DoubleType())
    def likeness(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array([_similarity(x, y, table.value) for x, y in zip(_raw(a), _raw(b))], pa.float64())

    # one row a different text: its bands, which copies share
    n_bytes = F.octet_length(F.coalesce(F.col(text), F.lit(""))).alias("n_bytes")
    sketches = docs.select(node, n_bytes, bands(F.col(text)).alias("bands")).groupBy("node").agg(F.first("bands").alias("bands"), F.first("n_bytes").alias("n_bytes"))
    met = materialise(sketches.select("node", "n_bytes", F.posexplode("bands").alias("band", "bucket")), "bands")
    leaders = met.groupBy(*_AT).agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("n")).where("n > 1")
    open_ = materialise(met.join(leaders.select(*_AT, "leader"), _AT), "buckets")
    drop_path(met)
    # texts of candidates alone, once for each node
    wanted = open_.select("node").distinct()
    # copies fall together before anything moves
    one = docs.select(node, F.coalesce(F.col(text), F.lit("")).alias("text")).groupBy("node").agg(F.first("text").alias("text"))
    texts = materialise(one.join(wanted, "node", "left_semi"), "texts")

    def compare(pairs: DataFrame) -> DataFrame:
        """(a, b, sim) of pairs of nodes."""
        b = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
        a = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
        return materialise(pairs.join(b, "b").join(a, "a").select("a", "b", likeness("text_a", "text_b").alias("sim")), "compared")

    def link_up(group: pa.Table) -> pa.Table:
        """Links that join the alike members of one bucket, or of two of its blocks, as few as do."""
        nodes, raw, sides = group.column("node").to_pylist(), _raw(group.column("text")), group.column("block").to_pylist()
        found = _spanning(raw, table.value, similarity, group.column("owner").to_pylist(), sides if len(set(sides)) > 1 else None)
        return pa.table({"a": pa.array([nodes[i] for i, _ in found], pa.binary()), "b": pa.array([nodes[j] for _, j in found], pa.binary())})

    def linked(blocks: DataFrame) -> DataFrame:
        """Links within the blocks (band, bucket, pair, node, owner, block) of buckets."""
        rows = blocks.join(texts, "node").select(*_AT, "pair", "node", "owner", "block", "text")
        return materialise(rows.groupBy(*_AT, "pair").applyInArrow(link_up, "a binary, b binary").distinct(), "links")

    far = 1 - similarity
    pairs = open_.where("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    all_sims = compare(pairs)
    sims = all_sims.select(F.col("a").alias("leader"), F.col("b").alias("node"), "sim")
    judged = open_.where("node <> leader").join(sims, ["leader", "node"])
    # members that the first text of their bucket is not like, and those that it is but that may also be like one of them
    judged = judged.select(*_AT, "node", "n_bytes", "sim", (F.col("sim") >= similarity).alias("tied"), F.col("leader").alias("owner"))
    judged = materialise(judged, "judged")
    drop_path(open_)
    state = judged.groupBy(*_AT).agg(F.count_if(~F.col("tied")).alias("n_rest"), F.max(F.when(~F.col("tied"), F.col("sim"))).alias("odd"))
    bound = 1 - 2 * far - _SLACK
    state = state.where((F.col("n_rest") > 1) | (F.col("odd") >= bound))
    near = (F.col("odd") >= bound) & (F.col("sim") <= F.col("odd") + far + _SLACK)
    left = judged.join(state, _AT).where(~F.col("tied") | near)
    left = left.select(*_AT, "node", "n_bytes", "tied", "sim", "n_rest", F.when(F.col("tied"), F.col("owner")).alias("owner"))
    sizes = left.groupBy(*_AT).agg(F.count(F.lit(1)).alias("n"), F.sum("n_bytes").alias("bytes"))
    sizes = sizes.select(*_AT, ((F.col("n") <= GROUP) & (F.col("bytes") <= GROUP_BYTES)).alias("is_few"))
    rest = materialise(left.join(sizes, _AT), "rest")
    drop_path(judged)
    links = linked(rest.where("is_few").select(*_AT, F.lit(0).alias("pair"), "node", "owner", F.lit(0).alias("block")))
    large = rest.where("not is_few")
    if not large.isEmpty():
        # more first texts, as long as each round ties half of what is left: that saves work, the blocks below see to the rest
        many = large.where(~F.col("tied") & (F.col("n_rest") > GROUP)).select(*_AT, "node")
        n_many = many.count()
        while n_many:
            part = F.pmod(F.xxhash64("node"), F.lit(FIRSTS))
            firsts = many.groupBy(*_AT, part).agg(F.min("node").alias("leader")).select(*_AT, "leader")
            open_ = materialise(many.join(firsts, _AT), "buckets")
            pairs = open_.where("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
            all_sims = all_sims.unionByName(compare(pairs.join(all_sims.select("a", "b"), ["a", "b"], "left_anti")))
            sims = all_sims.where(F.col("sim") >= similarity).select(F.col("a").alias("leader"), F.col("b").alias("node"))
            tied = open_.join(sims, ["leader", "node"]).select(*_AT, "node")
            done = tied.union(firsts.select(*_AT, F.col("leader").alias("node"))).distinct()
            many = materialise(many.join(done, [*_AT, "node"], "left_anti"), "many")
            drop_path(open_)
            before, n_many = n_many, many.count()
            if 2 * n_many > before:
                break
        so_far = connected(links.union(all_sims.where(F.col("sim") >= similarity).select("a", "b")))
        links = links.union(linked(_block_pairs(large, so_far, far)))
    links = links.union(all_sims.where(F.col("sim") >= similarity).select("a", "b"))
    return _classes(docs.withColumn("__node", node), links, key, [] if keep_text else [text])


def _block_pairs(large: DataFrame, roots: DataFrame, far: float) -> DataFrame:
    """(band, bucket, pair, node, owner, block): members of buckets dealt into blocks that meet in pairs.

    The largest group of a bucket is not compared with itself: its blocks meet the blocks of the others, and those also each
    other and themselves.  Members of the largest group whose similarity to the bucket's first text is further than ``far``
    from that of all others are left out, since no link can reach them.  Buckets of one group have no rows.
    """
    half, half_bytes = max(1, GROUP // 2), max(1, GROUP_BYTES // 2)
    rows = large.select(*_AT, "node", "n_bytes", "sim").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rows = materialise(rows, "large")
    groups = rows.groupBy(*_AT, "root").agg(F.count(F.lit(1)).alias("n"), F.sum("n_bytes").alias("bytes"), F.min("sim").alias("low"), F.max("sim").alias("high"))
    main = groups.groupBy(*_AT).agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    others = groups.join(main, _AT).where("root <> main").groupBy(*_AT, "main")
    others = others.agg(F.sum("n").alias("n_others"), F.sum("bytes").alias("b_others"), F.min("low").alias("low"), F.max("high").alias("high"))
    others = materialise(others, "others")  # so that a hot bucket's rows can be split where they join
    is_main = F.col("root") == F.col("main")
    reached = F.col("sim").between(F.col("low") - far - _SLACK, F.col("high") + far + _SLACK)
    rows = materialise(rows.join(others, _AT).where(~is_main | reached).withColumn("is_main", is_main), "reached")
    n_main = rows.where("is_main").groupBy(*_AT).agg(F.count(F.lit(1)).alias("n_main"), F.sum("n_bytes").alias("b_main"))
    rows = rows.join(materialise(n_main, "main"), _AT, "left")
    zero = F.lit(0)
    p = F.ceil(F.greatest(F.coalesce("n_main", zero) / half, F.coalesce("b_main", zero) / half_bytes))
    q = F.ceil(F.greatest(F.col("n_others") / half, F.col("b_others") / half_bytes, F.lit(1)))
    block = F.when(F.col("is_main"), F.pmod(F.xxhash64("node"), p)).otherwise(p + F.pmod(F.xxhash64("node"), q))
    rows = rows.select(*_AT, "node", F.col("root").alias("owner"), "is_main", p.alias("p"), q.alias("q"), block.alias("block"))
    own, first_other, last = F.col("block"), F.col("p"), F.col("p") + F.col("q") - 1
    met = F.when(F.col("is_main"), F.sequence(first_other, last)).otherwise(F.sequence(F.lit(0).cast("long"), last))
    pair = lambda b: F.struct(F.least(b, own).alias("low"), F.greatest(b, own).alias("high"))
    return rows.select(*_AT, F.explode(F.transform(met, pair)).alias("pair"), "node", "owner", "block")


def _classes(docs: DataFrame, links: DataFrame, key: str, without: list[str]) -> DataFrame:
    """Rows with the smallest key of their component, one of them marked as first.

    A text's number in the components is its smallest key (null as the largest) before its hash, so the root itself tells
    the class and no rows meet by root.
    """
    least = docs.groupBy("__node").agg(F.min(key).alias("least")).select("__node", F.struct(F.col("least").isNull().alias("none"), "least", F.col("__node").alias("hash")).alias("id"))
    least = materialise(least, "least")
    named = lambda c: least.select(F.col("__node").alias(c), F.col("id").alias(f"id_{c}"))
    edges = links.join(named("a"), "a").join(named("b"), "b").select(F.col("id_a").alias("a"), F.col("id_b").alias("b"))
    roots = connected(edges).select(F.col("node.hash").alias("__node"), "root")
    known = least.join(roots, "__node", "left").withColumn("root", F.coalesce("root", "id"))
    # a table of its own, so that the rows of a hot text can be split where they join
    known = materialise(known.select("__node", F.col("root.least").alias("class_id"), F.col("root.hash").alias("__root")), "known")
    out = materialise(docs.drop(*without).join(known, "__node").withColumn("__row", F.monotonically_increasing_id()), "classes")
    # of the rows that have the smallest key, the first by a number is the one that stays
    at_least = out.where(F.col(key).eqNullSafe(F.col("class_id")))
    firsts = at_least.groupBy("__root").agg(F.min("__row").alias("__row")).select("__row", F.lit(True).alias("is_first"))
    out = out.join(firsts, "__row", "left").withColumn("is_first", F.coalesce("is_first", F.lit(False)))
    return out.drop("__node", "__row", "__root")
