"""Sharding by Karmarkar-Karp differencing: near-equal bytes for groups that must stay together.

Equal texts (null counts as empty) form a group, and a group stays whole. The items that are differenced are the
groups of at least 1/8192 of all bytes, of which there are 8192 at most, and 8192 bins of the smaller groups, dealt by
their hash. So at most 16,384 items are known in the driver, however many groups there are, while a shard's size
can be off by no more than the last differences of items a ten-thousandth of the whole each. A group that is larger
than a shard's share has a shard alone, and the others come out equal.

Nulls: a null text has no bytes; a null doc_id is numbered first. Repeated rows are rows of their own, in the same shard.
An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cdcstrata.sources.scratch import materialise, store

BINS = 8192  # bins for small groups; also the least share of all bytes that makes a group an item of its own
CHUNKS = 1024  # a shard's rows are numbered in so many independent chunks


def spread_out(sizes: dict[str, int], shards: int) -> dict[str, int]:
    """Items to shards. An item that fills an even share by itself has a shard alone; the rest is differenced."""
    found, left = {}, sum(sizes.values())
    for name in sorted(sizes, key=lambda n: (-sizes[n], n))[: shards - 1]:
        open_shards = shards - len(found)
        if sizes[name] * open_shards < left:
            break
        left -= sizes[name]
        found[name] = open_shards - 1
    return found | karmarkar_karp({n: v for n, v in sizes.items() if n not in found}, shards - len(found))


def karmarkar_karp(sizes: dict[str, int], shards: int) -> dict[str, int]:
    """Items to shards: the two partial partitions of largest spread are combined, oppositely ordered, until one is left.

    A partial partition holds its sums in ascending order; joining adds the largest of one to the smallest of the
    other. Which side went where is kept as a tree and resolved from the root. Ties go by the items' names.
    """
    if not sizes:
        return {}
    heap: list[tuple[int, int, list[int]]] = []
    leaves = sorted(sizes)
    tree: list[tuple] = [(name,) for name in leaves]
    for node, name in enumerate(leaves):
        heap.append((-sizes[name], node, [0] * (shards - 1) + [sizes[name]]))
    heapq.heapify(heap)
    while len(heap) > 1:
        (_, a, first), (_, b, second) = heapq.heappop(heap), heapq.heappop(heap)
        sums = [x + y for x, y in zip(first, reversed(second), strict=True)]
        order = sorted(range(shards), key=sums.__getitem__)  # slot i of the result is slot order[i] of the sum
        tree.append((a, b, order))
        sums = [sums[i] for i in order]
        heapq.heappush(heap, (sums[0] - sums[-1], len(tree) - 1, sums))
    found: dict[str, int] = {}
    stack = [(heap[0][1], list(range(shards)))]  # a node, and the shard of each of its slots
    while stack:
        node, shard_of = stack.pop()
        if len(tree[node]) == 1:
            found[tree[node][0]] = shard_of[-1]
            continue
        a, b, order = tree[node]
        before = [0] * shards
        for slot, old in enumerate(order):
            before[old] = shard_of[slot]
        stack += [(a, before), (b, before[::-1])]
    return found


def _small(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def sized(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id``, bytes, checksum and group of each row."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.octet_length(whole).cast("bigint") + 1).alias("size"),
        F.crc32(whole.cast("binary")).alias("text_crc32"),
        F.sha2(whole, 256).alias("group"),
    )


def balance(rows: DataFrame, shards: int = 8) -> DataFrame:
    """Adds ``shard`` to rows that have a ``size`` and a ``group``: groups stay whole, sums come out near equal."""
    spark = rows.sparkSession
    groups = rows.groupBy("group").agg(F.sum("size").alias("bytes"))
    binned = groups.withColumn("bin", F.pmod(F.xxhash64("group"), F.lit(BINS)).cast("int"))
    binned = materialise(binned, "shard-groups")
    least = (binned.agg(F.sum("bytes")).first()[0] or 0) / BINS
    large = F.col("bytes") >= F.lit(float(least))
    # At most BINS groups reach 1/BINS of the whole, and there are at most BINS bins: both results are bounded.
    own = {r["group"]: r["bytes"] for r in binned.filter(large).select("group", "bytes").collect()}
    bins = binned.filter(~large).groupBy("bin").agg(F.sum("bytes").alias("bytes")).collect()
    shard_of = spread_out({**own, **{f"bin {r['bin']}": r["bytes"] for r in bins}}, shards)
    by_group = _small(spark, ((g, shard_of[g]) for g in own), "group string, own int")
    by_bin = _small(spark, ((r["bin"], shard_of[f"bin {r['bin']}"]) for r in bins), "bin int, shared int")
    return (
        rows.withColumn("bin", F.pmod(F.xxhash64("group"), F.lit(BINS)).cast("int"))
        .join(F.broadcast(by_group), "group", "left")
        .join(F.broadcast(by_bin), "bin", "left")
        .withColumn("shard", F.coalesce("own", "shared"))
        .drop("bin", "own", "shared")
    )


def numbered(rows: DataFrame) -> DataFrame:
    """Adds ``slot``, gapless from 0 in each ``shard``: rows are counted by chunk, then numbered within theirs."""
    chunked = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id"), F.lit(CHUNKS)).cast("int"))
    before = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = chunked.groupBy("shard", "chunk").agg(F.count(F.lit(1)).alias("rows"))
    offsets = counts.select("shard", "chunk", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("shard", "chunk").orderBy("doc_id", "size", "text_crc32", "group")
    return (
        chunked.withColumn("rank", F.row_number().over(within))
        .join(F.broadcast(offsets), ["shard", "chunk"])  # shards times CHUNKS rows
        .withColumn("slot", F.col("offset") + F.col("rank") - 1)
        .drop("chunk", "rank", "offset")
    )


def assign(docs: DataFrame, shards: int = 8, text: str = "text") -> DataFrame:
    """One row per row of ``docs``: where it goes, under the law of near-equal bytes."""
    rows = materialise(sized(docs, text), "shard-sizes")
    return numbered(balance(rows, shards)).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot").cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, path: str, shards: int = 8, text: str = "text") -> str:
    """The documents themselves, one folder a shard. A shard that is large is written by several tasks."""
    rows = docs.withColumn("__group", F.sha2(F.coalesce(F.col(text).cast("string"), F.lit("")), 256))
    size = F.octet_length(F.coalesce(F.col(text).cast("string"), F.lit(""))).cast("bigint") + 1
    placed = balance(rows.select(F.col("__group").alias("group"), size.alias("size")), shards)
    homes = store(placed.groupBy("group").agg(F.first("shard").alias("__shard")), "shard-homes")
    homes = docs.sparkSession.read.parquet(homes).withColumnRenamed("group", "__group")
    rows.join(homes, "__group").drop("__group").write.partitionBy("__shard").parquet(path)
    return path
