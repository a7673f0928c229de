"""Scratch tables in the folder the cluster shares."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
# For copies that are mostly text: zstd takes half their disk, and smaller row groups let a scan be split as finely as before.
# At its first level it takes no longer than snappy; dictionaries of texts that differ are built only to be dropped.
TEXT = {
    "compression": "zstd",
    "parquet.compression.codec.zstd.level": "1",
    "parquet.enable.dictionary": "false",
    "parquet.block.size": str(32 << 20),
}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where the setting is missing, as in tests, a folder inside the warehouse is taken, which the executors
    share as well; it is recorded in the session, so that every later call agrees on it.
    """
    root = spark.conf.get(_SETTING, None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
        spark.conf.set(_SETTING, root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; two runs never write to the same one."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str, partition_by: list[str] | None = None, **options: str) -> str:
    """Write to a fresh scratch path and return it; ``options`` are those of the Parquet writer, such as ``TEXT``."""
    path = scratch_path(df.sparkSession, name)
    writer = df.write.mode("errorifexists").options(**options)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return path


def materialise(df: DataFrame, name: str, partition_by: list[str] | None = None, **options: str) -> DataFrame:
    """Write once, read back: cuts the lineage, survives executor loss, feeds several consumers."""
    return df.sparkSession.read.schema(df.schema).parquet(store(df, name, partition_by, **options))


def release(spark: SparkSession, *paths: str) -> None:
    """Delete scratch tables that nothing reads any more."""
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
