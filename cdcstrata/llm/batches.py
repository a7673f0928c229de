"""What Python workers need from the session: this package on their path, and batches of bounded size."""

from __future__ import annotations

import ctypes
import gc
import os
from pathlib import Path

import pyarrow as pa
from pyspark.sql import SparkSession

#: Spark's own limit is 64 MB a batch, of which a task holds a few copies in either process.
BATCH_BYTES = "8m"
_ROOT = str(Path(__file__).resolve().parents[2])


def give_back() -> None:
    """Return what Python, Arrow and the C library have freed to the system, where that can be done."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def bound_batches(spark: SparkSession, batch_bytes: str = BATCH_BYTES) -> SparkSession:
    """Limit the batches that go to Python by bytes, whatever the length of the texts, and let workers find this package.

    Workers start in a folder of their own, so the driver's path does not hold there; on a cluster the package lies
    at the same place on every node, or comes with ``--py-files``.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", batch_bytes)
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([_ROOT, *paths])
    return spark
