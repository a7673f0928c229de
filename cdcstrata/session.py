"""Session settings the library's plans are made for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime settings; each can be changed on a running session.
SETTINGS = {
    # Skewed joins are split and small partitions merged at run time. A hot join key on the report side of a
    # mart is handled by this; aggregates and rankings reduce on the map side before they shuffle.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Wide typed projections make methods that the JVM does not compile (it stops at 8000 bytes of
    # bytecode). Such a stage is faster split into its operators than fused into one interpreted method.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Dates are cut from timestamps; results must not depend on where the driver runs.
    "spark.sql.session.timeZone": "UTC",
}


# Scratch copies of change logs unfold to some twenty times their size, and map tasks sort what they read of them; so the
# default size of a scan task is halved. A size that the cluster chose stays.
_SCAN, _SCAN_DEFAULT, _SCAN_SIZE = "spark.sql.files.maxPartitionBytes", "134217728b", "64m"


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings. Memory, shuffle partitions and the shared folder stay with the cluster."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    if spark.conf.get(_SCAN) == _SCAN_DEFAULT:
        spark.conf.set(_SCAN, _SCAN_SIZE)
    return spark
