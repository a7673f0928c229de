"""Applying a change stream to a table of current rows.

Each micro-batch keeps its newest version per key and appends that to a change table in a folder of its
own, deletes included. The current rows are the newest version per key over that table, which a compaction
keeps from growing for ever. So a batch never rewrites what is there, a repeated batch replaces its own folder, and an older version that
arrives late loses by its timestamp, whatever the order of arrival.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cdcstrata.operators.versions import latest

_COMPRESSION = "zstd"  # a change table is mostly payload text, and compactions write it again


def read_changes(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """A folder of Parquet change files as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def drop_replays_within(
    stream: DataFrame, delay: str, keys: Sequence[str] = ("id", "updated_ts"), event_time: str = "updated_ts"
) -> DataFrame:
    """Drop redeliveries that come within ``delay`` of each other; state older than that is let go."""
    # Watermarks are on instants; a time without a zone is read in the session's.
    timed = stream.withColumn("__time", F.col(event_time).cast("timestamp")).withWatermark("__time", delay)
    return timed.dropDuplicatesWithinWatermark(list(keys)).drop("__time")


def append_once(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    delay: str,
    keys: Sequence[str] = ("id", "updated_ts", "op"),
    event_time: str = "updated_ts",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start the stream into a Parquet folder, redeliveries taken out in the stream's own state.

    A change that comes again within ``delay`` of event time is known by its key. One that comes later is older than the
    watermark and is dropped as late, first delivery or not; so choose a delay longer than changes are ever late. State is
    let go as the watermark passes it. The file sink takes a repeated batch once, so a restart from the checkpoint neither
    loses nor repeats a row.
    """
    return (
        drop_replays_within(stream, delay, keys, event_time)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def late_rows(query: StreamingQuery) -> int:
    """Rows that came after the watermark had passed them, by the progress reports of a query."""
    return sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])


def apply_cdc_stream(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    keys: Sequence[str] = ("id",),
    order_by: Sequence[str] = ("updated_ts",),
    *,
    require_payload: bool = False,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start the stream into the change table at ``target``.

    ``trigger`` is passed on, e.g. ``{"processingTime": "1 minute"}``; by default everything available is
    read and the query ends. Use one checkpoint per target: batch numbers name the folders.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        newest = latest(batch, keys, order_by, tombstones="keep", require_payload=require_payload)
        newest.write.mode("overwrite").parquet(f"{target}/batch={batch_id}", compression=_COMPRESSION)

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def _folders(spark: SparkSession, target: str) -> list[str]:
    """Names of the table's batch folders."""
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(path) if s.isDirectory() and "batch=" in s.getPath().getName())


def _live_folders(spark: SparkSession, target: str) -> list[str]:
    """The folders that make up the table: the newest finished compaction and the batches it does not hold.

    A compaction names the last batch in it, and is finished when Spark's mark of success is there. What it holds
    may still lie about for readers that began earlier.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    names = _folders(spark, target)
    done = [n for n in names if n.startswith("upto_batch=") and files.exists(path(f"{target}/{n}/_SUCCESS"))]
    upto = max((int(n.split("=")[1]) for n in done), default=None)
    live = [n for n in names if n.startswith("batch=") and (upto is None or int(n.split("=")[1]) > upto)]
    return live if upto is None else [f"upto_batch={upto}", *live]


def read_change_table(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """All rows of the change table as it stands."""
    folders = _live_folders(spark, target)
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{target}/{n}" for n in folders])


def current_rows(
    spark: SparkSession,
    target: str,
    schema: T.StructType,
    keys: Sequence[str] = ("id",),
    order_by: Sequence[str] = ("updated_ts",),
) -> DataFrame:
    """The table as of the last batch: newest version per key, deleted keys left out."""
    return latest(read_change_table(spark, target, schema), keys, order_by, tombstones="after")


def compact(
    spark: SparkSession,
    target: str,
    schema: T.StructType,
    keys: Sequence[str] = ("id",),
    order_by: Sequence[str] = ("updated_ts",),
) -> None:
    """Fold the batches so far into one folder with the newest version per key, deletes kept.

    Call it between batches. The fold counts from its mark of success on; readers that plan their read later take it
    in place of what it holds, earlier ones still find their folders. Those go with the next compaction.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    live = _live_folders(spark, target)
    stale = [n for n in _folders(spark, target) if n not in live]
    last = max((int(n.split("=")[1]) for n in live), default=None)
    if last is None or live == [f"upto_batch={last}"]:
        return
    newest = latest(read_change_table(spark, target, schema), keys, order_by, tombstones="keep")
    newest.write.mode("overwrite").parquet(f"{target}/upto_batch={last}", compression=_COMPRESSION)
    for name in stale:
        files.delete(path(f"{target}/{name}"), True)
