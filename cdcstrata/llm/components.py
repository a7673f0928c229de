"""Connected components of a link table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcstrata.sources.scratch import materialise, release, store


def connected_components(links: DataFrame) -> DataFrame:
    """Links ``a``, ``b`` (bigint) to one row per linked ``node`` with its ``component``, the least node it reaches.

    A round points each root at its least neighbour, follows the pointers to their ends and contracts the links to
    those. All links of a node are reduced to one value on the map side, so a node of any degree is no hot spot, and
    every round is stored in the shared folder, which cuts the lineage. Nodes without links are not listed; an empty table
    gives an empty result. Nulls and self-links link nothing.
    """
    spark = links.sparkSession
    clean = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct()
    edges_path = store(clean, "links")
    edges = spark.read.schema("a bigint, b bigint").parquet(edges_path)
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    labels_path = store(nodes.select("node", F.col("node").alias("component")), "labels")
    labels = spark.read.schema("node bigint, component bigint").parquet(labels_path)
    while not edges.isEmpty():
        # Only the greater end has a smaller neighbour to point at; least ends are roots of this round.
        pointers = edges.groupBy(F.col("b").alias("root")).agg(F.min("a").alias("to"))
        pointers = _followed(pointers)
        moved = labels.join(pointers, F.col("component") == F.col("root"), "left")
        moved = moved.select("node", F.coalesce("to", "component").alias("component"))
        new_labels = store(moved, "labels")
        ends = edges
        for name in ("a", "b"):
            hop = pointers.select(F.col("root").alias("r"), F.col("to").alias("t"))
            ends = ends.join(hop, F.col(name) == F.col("r"), "left").withColumn(name, F.coalesce("t", name)).drop("r", "t")
        left = ends.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct()
        new_edges = store(left, "links")
        release(spark, edges_path, labels_path)
        edges_path, labels_path = new_edges, new_labels
        edges = spark.read.schema("a bigint, b bigint").parquet(edges_path)
        labels = spark.read.schema("node bigint, component bigint").parquet(labels_path)
    release(spark, edges_path)
    return labels


def _followed(pointers: DataFrame) -> DataFrame:
    """Each pointer moved to the end of its chain, by doubling: pointers lead to ever smaller nodes."""
    pointers = materialise(pointers, "pointers")
    while True:
        onward = pointers.select(F.col("root").alias("at"), F.col("to").alias("next"))
        longer = pointers.join(onward, F.col("to") == F.col("at"), "left")
        stepped = longer.select("root", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved"))
        stepped = materialise(stepped, "pointers")
        if stepped.filter("moved").isEmpty():
            return stepped.select("root", "to")
        pointers = stepped.select("root", "to")
