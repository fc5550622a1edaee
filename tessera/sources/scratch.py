"""Tables that a plan writes on its way: they cut the lineage and survive lost executors."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    On one machine a session that names none (a test) gets one; on a cluster that is an error, since a folder of one
    machine would lose rows.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        import tempfile

        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="tessera-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def scratch_dir(spark: SparkSession) -> str:
    """The part of the shared folder that belongs to this application."""
    return f"{shared_dir(spark)}/tessera/{spark.sparkContext.applicationId}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back."""
    path = f"{scratch_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def deal(rows: DataFrame, path: str, n: int, by: str, aligned: bool = False) -> None:
    """Write rows under ``path``, dealt into ``n`` buckets by the hash of a column; ``aligned`` ones are dealt so already."""
    dealing = rows if aligned else rows.repartition(n, by)
    dealing.write.format("parquet").option("path", path).option("compression", "zstd").bucketBy(n, by).saveAsTable(_table(path))


def dealt(spark: SparkSession, path: str, n: int, by: str, schema: str) -> DataFrame:
    """Rows that :func:`deal` wrote, in this session or another; tables dealt alike are joined by that column in place."""
    if not spark.catalog.tableExists(_table(path)):
        spark.sql(f"CREATE TABLE {_table(path)} ({schema}) USING parquet CLUSTERED BY ({by}) INTO {n} BUCKETS LOCATION '{path}'")
    return spark.table(_table(path))


def _table(path: str) -> str:
    """The name under which a session knows a dealt folder: files of a path never change, so one name holds for ever."""
    return f"dealt_{hashlib.md5(path.encode()).hexdigest()}"


def materialise_dealt(df: DataFrame, name: str, n: int, by: str) -> DataFrame:
    """:func:`materialise`, dealt into ``n`` buckets by the hash of a column."""
    path = f"{scratch_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    deal(df, path, n, by)
    return df.sparkSession.table(_table(path))
