import random
from collections import defaultdict

from tessera.llm import sharding


def test_every_shard_fits_and_only_large_buckets_split(spark):
    rnd = random.Random(3)
    rows = [(i, "x" * rnd.choice([0, 5, 50, 400]), "shard?") for i in range(2000)] + [(9999, "y" * 5000, None), (None, None, "n"), (5, "dup", "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard string")
    got = sharding.shard(df, 3000, stride=3).collect()
    assert len(got) == len(rows)
    held = defaultdict(list)
    for r in got:
        held[(r.shard, r.overflow)].append(r)
    for (name, _), own in held.items():
        total = sum(r.n_bytes for r in own)
        assert total == own[0].shard_bytes and len(name) == own[0].depth
        assert total <= 3000 or len(own) == 1
    names = {r.shard for r in got}
    assert not any(a != b and b.startswith(a) for a in names for b in names)  # prefix-free
    for name in names:  # the parent bucket was too large
        assert sum(r.n_bytes for r in got if r.shard.startswith(name[:-1])) > 3000


def test_rows_of_one_key_overflow_within_the_limit(spark):
    df = spark.createDataFrame([(1, "z" * 100)] * 500 + [(1, "w" * 900)] * 3 + [(2, "a")], "doc_id long, text string")
    got = sharding.shard(df, 1000).collect()
    assert len(got) == 504
    held = defaultdict(int)
    for r in got:
        held[(r.shard, r.overflow)] += r.n_bytes
    assert max(held.values()) <= 1000 and sum(held.values()) == 500 * 100 + 2700 + 1


def test_empty_table(spark):
    assert sharding.shard(spark.createDataFrame([], "doc_id long, text string"), 10).count() == 0
