"""Extendible hashing of rows into shards under a byte limit.

Rows carry a 60-bit hash of their key.  The directory starts with one bucket; only buckets over the limit split on
another bit, until each fits.  Sizes come from one partial aggregation a round: a round looks ``stride`` bits ahead, so
it gives the sizes of all buckets between two depths, and only rows of buckets that are still too large take part in the
next.  Rows of one hash cannot be told apart by more bits; what then exceeds the limit goes to numbered overflow shards
in the order of a second hash and the row's bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import materialise

BITS = 60
INDEX_BITS = 20


def hash_bits(key: Column) -> Column:
    """The first 60 bits of the md5 of a key's text, as a long; null keys hash as an empty text."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("bigint")


def _prefix(bits: Column, depth: Column) -> Column:
    return F.call_function("shiftright", bits, F.lit(BITS) - depth)


def directory(sizes: DataFrame, limit: int, stride: int = 4) -> DataFrame:
    """Leaves (prefix, depth, n_rows, n_bytes) of the extendible directory over rows (bits, n_bytes, rows).

    The first round looks as deep as buckets of a quarter of the limit would lie if hashes were even; each later one
    ``stride`` bits deeper.
    A bucket splits while its bytes exceed ``limit`` and it has more than one row, up to all 60 bits.  An empty input has
    no leaves.
    """
    spark = sizes.sparkSession
    schema = T.StructType([T.StructField("prefix", T.LongType()), T.StructField("depth", T.IntegerType()), T.StructField("n_rows", T.LongType()), T.StructField("n_bytes", T.LongType())])
    leaves = spark.createDataFrame([], schema)
    rows, base = sizes, 0
    total = sizes.agg(F.sum("n_bytes")).first()[0] or 0
    top = min(max(stride, (int(total) // max(limit, 1)).bit_length() + 2), BITS)
    while base <= BITS:
        fine = rows.groupBy(_prefix(F.col("bits"), F.lit(top)).alias("fine")).agg(
            F.sum("rows").cast("long").alias("n_rows"), F.sum("n_bytes").cast("long").alias("n_bytes")
        )
        fine = materialise(fine, "sizes")
        levels = fine.select("*", F.explode(F.sequence(F.lit(base), F.lit(top))).alias("depth"))
        levels = levels.groupBy(F.call_function("shiftright", F.col("fine"), F.lit(top) - F.col("depth")).alias("prefix"), "depth").agg(
            F.sum("n_rows").alias("n_rows"), F.sum("n_bytes").alias("n_bytes")
        )
        levels = levels.withColumn("fits", (F.col("n_bytes") <= limit) | (F.col("n_rows") == 1))
        # a bucket is a leaf where it fits (or has no bit left) and its parent does not fit
        parent = levels.select(F.col("prefix").alias("parent"), (F.col("depth") + 1).alias("depth"), F.col("fits").alias("parent_fits"))
        levels = levels.withColumn("parent", F.call_function("shiftright", F.col("prefix"), F.lit(1)))
        levels = levels.join(parent, ["parent", "depth"], "left")
        open_parent = ~F.coalesce("parent_fits", F.lit(False))
        found = levels.where(open_parent & (F.col("fits") | (F.col("depth") == BITS))).select("prefix", "depth", "n_rows", "n_bytes")
        if base:  # buckets at this depth were already judged in the round before
            found = found.where(F.col("depth") > base)
        leaves = leaves.unionByName(found.select("prefix", F.col("depth").cast("int"), "n_rows", "n_bytes"))
        if top == BITS:
            break
        over = levels.where(~F.col("fits") & (F.col("depth") == top)).select(F.col("prefix").alias("over"))
        if over.isEmpty():
            break
        rows = rows.join(over, _prefix(F.col("bits"), F.lit(top)) == F.col("over"), "left_semi")
        base, top = top, min(top + stride, BITS)
    return materialise(leaves, "directory")


def slots(leaves: DataFrame, index_bits: int) -> DataFrame:
    """The directory as a table: for each prefix of ``index_bits`` bits, the leaves below or above it."""
    g = F.lit(index_bits)
    near = F.expr(f"sequence(shiftleft(prefix, {index_bits} - depth), shiftleft(prefix + 1, {index_bits} - depth) - 1)")
    deep = F.array(F.call_function("shiftright", F.col("prefix"), F.col("depth") - g))
    at = leaves.withColumn("slot", F.explode(F.when(F.col("depth") <= g, near).otherwise(deep)))
    return at.groupBy("slot").agg(F.collect_list(F.struct("depth", "prefix", "n_rows", "n_bytes")).alias("leaves"))


def _overflow(df: DataFrame, limit: int) -> DataFrame:
    """Number the rows of one hash that exceed the limit, in chunks of about a quarter of it.

    A row of over half the limit gets a number of its own; the others of a chunk are numbered by halves of the limit in
    a running sum, so no number holds more than the limit.  Rows are dealt to chunks at random, then written.
    """
    parts = F.ceil(F.col("__leaf.n_bytes") / F.lit(max(limit, 4) / 4)).cast("long")
    df = materialise(df.withColumn("__chunk", F.floor(F.rand(7) * parts)), "overflow")
    half = max(limit // 2, 1)
    large = F.col("n_bytes") > half
    w = Window.partitionBy("__bits", "__chunk").orderBy(large.asc(), "n_bytes")
    before = F.sum(F.when(~large, F.col("n_bytes")).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, -1))
    local = F.when(large, F.row_number().over(w) + (1 << 20)).otherwise(F.floor(F.coalesce(before, F.lit(0)) / half))
    df = df.withColumn("overflow", (F.col("__chunk") * (1 << 32) + local).cast("long"))
    of = Window.partitionBy("__bits", "overflow")
    return df.withColumn("shard_bytes", F.sum("n_bytes").over(of).cast("long")).drop("__chunk")


def shard(df: DataFrame, limit: int, key: str = "doc_id", text: str = "text", stride: int = 4) -> DataFrame:
    """Add n_bytes, shard (prefix bits as text), depth, overflow and shard_bytes to each row.

    ``n_bytes`` is the UTF-8 length of ``text`` (null: 0).  A shard is a pair of ``shard`` and ``overflow``; each holds at
    most ``limit`` bytes unless it is a lone row over the limit.  ``overflow`` is 0 but for rows of one hash that exceed
    the limit together: those are split by number.  Null keys hash as empty texts.  Other columns pass; clashing ones are
    replaced.  An empty table gives no rows.
    """
    df = df.drop("n_bytes", "shard", "depth", "overflow", "shard_bytes")
    df = df.withColumn("n_bytes", F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long")).withColumn("__bits", hash_bits(F.col(key)))
    sizes = df.groupBy(F.col("__bits").alias("bits")).agg(F.sum("n_bytes").alias("n_bytes"), F.count(F.lit(1)).alias("rows"))
    leaves = directory(sizes, limit, stride)
    deepest, n = leaves.agg(F.max("depth"), F.count(F.lit(1))).first()
    deepest = deepest or 0
    index_bits = min(deepest, n.bit_length() + 1, INDEX_BITS)  # about as many slots as leaves
    found = df.withColumn("__slot", _prefix(F.col("__bits"), F.lit(index_bits))).join(
        slots(leaves, index_bits).withColumnRenamed("slot", "__slot").withColumnRenamed("leaves", "__leaves"), "__slot"
    )
    found = found.withColumn(
        "__leaf", F.element_at(F.filter("__leaves", lambda x: _prefix(F.col("__bits"), x["depth"]) == x["prefix"]), 1)
    ).drop("__slot", "__leaves")
    found = found.withColumn("shard", F.expr(f"substring(lpad(bin(__bits), {BITS}, '0'), 1, __leaf.depth)")).withColumn("depth", F.col("__leaf.depth"))
    whole = found.withColumn("overflow", F.lit(0).cast("long")).withColumn("shard_bytes", F.col("__leaf.n_bytes"))
    if not deepest or leaves.where((F.col("depth") == BITS) & (F.col("n_bytes") > limit)).isEmpty():
        return whole.drop("__bits", "__leaf")
    over = (F.col("__leaf.depth") == BITS) & (F.col("__leaf.n_bytes") > limit) & (F.col("__leaf.n_rows") > 1)
    return whole.where(~over).unionByName(_overflow(found.where(over), limit)).drop("__bits", "__leaf")
