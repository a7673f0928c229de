"""A Merkle manifest of a table: every row's leaf, the root of each source, the root of all, and a proof for each row.

The leaf of a row is the SHA-256 of its columns, each ``-`` if null and else its UTF-8 byte count, a colon and its value. The
leaves of a source ascend by id; runs of 16 become the digest of their digests until one is left, the subroot (a
lone leaf is its own). Subroots in order of source, null first, give the root in the same way. A proof is the list of
the siblings of each step, those on the left and those on the right put together; ``folded`` computes a root from it.

Leaves get their rank in their source from stored ranges. Its base-16 digits are grouped away one by one: the rows of a run
nest in one row, then the runs of a block of 256. Block rows are stored; their digests are the leaves of the next round,
256 times fewer. From the top down, each block's nested rows are transformed and exploded into nodes with their
siblings; inside a block that takes no join. A nested row of a whole source would grow with the data, so blocks meet the
path above them by their number, once a round.

Ties and repeated rows: rows with one id are ordered by leaf; equal rows have equal leaves, each its own proof. A null id comes
first. An empty table has no rows. Nulls, empty and long texts go into the leaf as they are; columns beyond those
named do not, and their names may be anything.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdcstrata.llm.ranges import lower_ascii, ranked
from cdcstrata.sources.scratch import materialise, release, store

FANOUT = 16
BLOCK = FANOUT * FANOUT
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<left:string,right:string>>"


def encoded(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(*values: Column) -> Column:
    return F.sha2(F.concat(*[encoded(v) for v in values]), 256)


def _hashed(digests: Column) -> Column:
    return F.sha2(F.array_join(digests, ""), 256)


def _rolled(nodes: DataFrame) -> DataFrame:
    """Nodes (``tree``, ``rank``, ``n`` of the tree, ``hash``, ``item``) as blocks, each with its nested runs and its digest.

    One exchange, by block. A lone node is not hashed, and stands alone in its tree.
    """
    rank = F.col("rank")
    digits = nodes.select(
        "tree",
        "n",
        F.floor(rank / BLOCK).cast("bigint").alias("block"),
        (F.floor(rank / FANOUT) % FANOUT).cast("int").alias("d1"),
        (rank % FANOUT).cast("int").alias("d0"),
        "hash",
        "item",
    ).repartition("tree", "block")

    def grouped(rows: DataFrame, digit: str, least: int, *keys: str) -> DataFrame:
        held = [c for c in rows.columns if c not in (digit, *keys)]
        nested = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(digit, *held))).alias("kids"))
        hashes = F.transform("kids", lambda k: k["hash"])
        return nested.withColumn("hash", F.when(F.col("n") > least, _hashed(hashes)).otherwise(hashes[0]))

    runs = grouped(digits, "d0", 1, "tree", "block", "n", "d1")
    return grouped(runs, "d1", FANOUT, "tree", "block", "n")


def _climbed(nodes: DataFrame, name: str) -> tuple[list[str], DataFrame]:
    """The stored blocks of every round, bottom first, and the ``tree`` and ``hash`` of each top."""
    spark = nodes.sparkSession
    paths = []
    while True:
        paths.append(store(_rolled(nodes), f"{name}-{len(paths)}"))
        blocks = spark.read.parquet(paths[-1])
        above = blocks.select(
            "tree",
            F.col("block").alias("rank"),
            F.ceil(F.col("n") / BLOCK).cast("bigint").alias("n"),
            "hash",
            F.lit(None).cast("int").alias("item"),
        )
        if (above.agg(F.max("n")).first()[0] or 1) == 1:
            return paths, above.select("tree", "hash")
        nodes = above


def _sided(hashes: Column, at: Column, taken: Column) -> Column:
    """What stands left and right of one of a run's digests, as a path of one step, or none for a node that is not hashed."""
    step = F.struct(
        F.array_join(F.slice(hashes, F.lit(1), at), "").alias("left"),
        F.array_join(F.slice(hashes, at + 2, F.lit(FANOUT)), "").alias("right"),
    )
    return F.when(taken, F.array(step)).otherwise(F.array().cast(_PATH))


def _opened(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """The nodes of blocks: ``tree``, ``rank``, ``hash``, ``item``, the columns of ``above`` and the path from each to the root.

    ``above`` has a row for each block: ``tree``, ``rank`` (the block's number), ``path`` and columns to hand down.
    """
    handed = [c for c in above.columns if c not in ("tree", "rank", "path")]
    up = above.select(F.col("tree").alias("__tree"), F.col("rank").alias("__rank"), F.col("path").alias("__path"), *handed)
    same = F.col("tree").eqNullSafe(F.col("__tree")) & (F.col("block") == F.col("__rank"))
    hashes = lambda kids: F.transform(kids, lambda k: k["hash"])
    runs = (
        blocks.join(up, same)
        .withColumn("__runs", hashes(F.col("kids")))
        .select("tree", "block", "n", "__path", "__runs", *handed, F.posexplode("kids").alias("__i", "__run"))
        .withColumn("__path", F.concat(_sided(F.col("__runs"), F.col("__i"), F.col("n") > FANOUT), "__path"))
        .withColumn("__nodes", hashes(F.col("__run.kids")))
    )
    nodes = runs.select(
        "tree", "block", "n", "__path", "__nodes", "__i", *handed, F.posexplode("__run.kids").alias("__j", "__node")
    )
    return nodes.select(
        "tree",
        (F.col("block") * BLOCK + F.col("__i") * FANOUT + F.col("__j")).alias("rank"),
        F.col("__node.hash").alias("hash"),
        F.col("__node.item").alias("item"),
        F.concat(_sided(F.col("__nodes"), F.col("__j"), F.col("n") > 1), "__path").alias("path"),
        *handed,
    )


def _descended(paths: Sequence[str], tops: DataFrame, name: str) -> DataFrame:
    """Nodes of the lowest round with their whole path. ``tops`` has a ``tree``, its ``path`` and columns to hand down."""
    spark = tops.sparkSession
    above = tops.withColumn("rank", F.lit(0).cast("bigint"))
    for k in reversed(range(len(paths))):
        above = _opened(spark.read.parquet(paths[k]), above)
        if k:
            above = materialise(above.drop("hash", "item"), f"{name}-above-{k}")
    return above


def manifest(leaves: DataFrame, name: str = "merkle") -> DataFrame:
    """Roots and proofs for leaves (``source``, ``doc_id``, ``leaf`` and ``item``, a struct that is carried along).

    Returns ``source``, ``leaf``, ``item``, ``subroot``, ``root`` and ``path``, an array of ``left`` and ``right`` siblings from
    the leaf's run to the root's.
    """
    spark = leaves.sparkSession
    rows = leaves.select(F.col("source").alias("tree"), "doc_id", F.col("leaf").alias("hash"), "item")
    nodes = ranked(rows, "tree", ["doc_id", "hash"], f"{name}-leaves").drop("doc_id")
    low, subroots = _climbed(nodes, f"{name}-blocks")
    listed = subroots.select(F.lit(0).alias("tree"), F.struct("tree", "hash").alias("item"), "hash")
    listed = ranked(listed, "tree", ["item.tree"], f"{name}-sources")
    high, roots = _climbed(listed, f"{name}-roots")
    tops = roots.select("tree", F.array().cast(_PATH).alias("path"), F.col("hash").alias("root"))
    sources = _descended(high, tops, f"{name}-sources")
    sources = materialise(
        sources.select("item.tree", "path", "root", F.col("item.hash").alias("subroot")), f"{name}-source-paths"
    )
    release(spark, *high)
    out = _descended(low, sources, f"{name}-blocks")
    return out.select(F.col("tree").alias("source"), F.col("hash").alias("leaf"), "item", "subroot", "root", "path")


def folded(leaf: Column, path: str) -> Column:
    """The root that a leaf gives with the siblings of a path."""
    return F.aggregate(path, leaf, lambda h, p: F.sha2(F.concat(p["left"], h, p["right"]), 256))


def proof_digest(path: str) -> Column:
    return _hashed(F.transform(path, lambda p: F.concat(p["left"], p["right"])))


def tampered(doc_id: Column, text: Column) -> tuple[Column, Column]:
    """Which rows are tampered with, and their text then."""
    hit = F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return hit, lower_ascii(text)


def verified(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: its leaf, roots and proof, and whether its tampered text still gives the root."""
    by = {c: F.col(c) for c in COLUMNS}
    hit, changed = tampered(by["doc_id"], by["text"].cast("string"))
    leaves = docs.select(
        by["source"].cast("string").alias("source"),
        by["doc_id"].cast("bigint").alias("doc_id"),
        digest(*by.values()).alias("leaf"),
        F.when(hit, digest(*(by | {"text": changed}).values())).alias("changed"),
    )
    rows = manifest(leaves.withColumn("item", F.struct("doc_id", "changed")))
    root = folded(F.coalesce("item.changed", "leaf"), "path")
    return rows.select(
        F.col("item.doc_id").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        proof_digest("path").alias("proof_sha256"),
        root.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
