"""Small helpers that several operators of this subpackage share."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.scratch import materialise, scratch_dir

__all__ = ["drop_path", "drop_scratch", "held_out", "materialise", "n_tasks", "reach_workers", "scratch_dir", "worker_slot"]

BATCH_ROWS = 1_000
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def reach_workers(spark: SparkSession) -> None:
    """Let Python workers import this package when it is run from a source tree, and share one pool of them.

    Plan nodes that shorten tracebacks and nodes that don't start workers of their own, so executors hold twice as many;
    with the setting off all of them use the same ones.  Batches hold at most ``BATCH_ROWS`` rows, since texts can be long.
    """
    spark.conf.set("spark.sql.execution.pyspark.udf.simplifiedTraceback.enabled", "false")
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "")
    if ROOT not in have.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, have) if x)


_kept: dict[str, tuple[object, object]] = {}


def worker_slot(name: str, key: object, make: Callable[[], object]) -> object:
    """What ``make`` gives, kept in this Python worker until the operator ``name`` asks with another key or another operator asks.

    A worker runs tasks of one operator after the other; so it holds the tables and caches of the latest alone.
    """
    if name not in _kept or _kept[name][0] != key:
        _kept.clear()
        _kept[name] = (key, make())
    return _kept[name][1]


def drop_path(df: DataFrame) -> None:
    """Remove the files behind a frame made by :func:`materialise` that no later step reads."""
    spark = df.sparkSession
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = hadoop.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop_scratch(spark: SparkSession) -> None:
    """Remove all that the operators of this session have written to the shared folder, and their tables.

    Results that have not been written or collected read from there, so this comes last.
    """
    for name in [t.name for t in spark.catalog.listTables() if t.name.startswith("tessera_runs_")]:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def n_tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def held_out(doc_id: Column) -> Column:
    """Whether a row belongs to the fold that no model learns from: crc32(doc_id as text) mod 5 is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))
