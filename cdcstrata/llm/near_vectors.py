"""Embedding near-duplicates: small-world graphs per shard, audited recall, verified cosines, united components.

Vectors are compared only under equal labels (and of equal length). Equal vectors are one class and counted by their
number. The classes of a label are dealt by hash to shards of about ``SHARD`` classes, and each shard gets a graph. Every
two shards of a label, a shard and itself included, are one task: all vectors of either query the graph of the other, so
every vector queries every shard. A task compares a sample of its queries with brute force and doubles its beam until,
among the queries of every degree (by powers of two), at least ``AUDIT`` of a query's links are found on average, itself
left out; so a large group does not hide what others lose. It samples until ``AUDITED`` queries of less than the greatest
degree are seen, ``MOST_AUDITED`` at most, in random order; a beam as wide as the shard is brute force itself. Cosines are
computed in double precision, so no pair below the threshold is linked. A task gives counts and a spanning forest of
its links, not the pairs, which it holds as bits; pairs of shards are disjoint, so counts add up.

Vectors that are null, empty, zero, or hold a null or non-finite component, and vectors without a label, link with
nothing and are components of their own. Rows that repeat a vec_id are rows with their own links. An empty table gives
an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcstrata.llm.components import connected_components
from cdcstrata.llm.hnsw import Graph
from cdcstrata.sources.scratch import materialise

LEAST = 0.93
SHARD = 8192
BEAM, AUDIT, AUDITED = 32, 0.995, 96
MOST_AUDITED = 2048  # queries compared by brute force, drawn at random: a degree that one in 400 has is seen with 99.4 %

_INDEX = (
    "label string, dim int, shard int, n int, entry int, ids array<bigint>, copies array<bigint>, vectors binary, "
    "layers array<binary>"
)
_INDEX_ARROW = pa.schema(
    [
        ("label", pa.string()),
        ("dim", pa.int32()),
        ("shard", pa.int32()),
        ("n", pa.int32()),
        ("entry", pa.int32()),
        ("ids", pa.list_(pa.int64())),
        ("copies", pa.list_(pa.int64())),
        ("vectors", pa.binary()),
        ("layers", pa.list_(pa.binary())),
    ]
)


def usable(vectors: DataFrame) -> DataFrame:
    """The rows that can link, as ``vec_id``, ``label``, ``dim``, ``vector`` and ``key``, equal for equal vectors."""
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("label").cast("string").alias("label"),
        F.col("embedding").cast("array<double>").alias("vector"),
    )
    rows = rows.filter(F.col("label").isNotNull() & F.col("vector").isNotNull() & (F.size("vector") > 0) & ~bad)
    rows = rows.filter(F.exists("vector", lambda x: x != 0.0)).withColumn("dim", F.size("vector"))
    text = F.array_join(F.transform("vector", lambda x: (x + 0.0).cast("string")), ",")
    return rows.withColumn("key", F.sha2(F.concat_ws(":", F.length("label").cast("string"), "label", text), 256))


def _unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, first by their largest component so that no square overflows or vanishes."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _indexed(classes: DataFrame) -> DataFrame:
    """One row a shard: its graph, as bytes."""
    total = classes.groupBy("label", "dim").agg(F.ceil(F.count(F.lit(1)) / SHARD).cast("int").alias("shards"))
    dealt = classes.join(total, ["label", "dim"])
    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64("key"), F.col("shards")).cast("int")).drop("shards", "key")

    def build(table):
        table = table.sort_by("class_id")
        vectors = _unit(np.array(table["vector"].to_pylist(), np.float64))
        graph = Graph.build(vectors).parts()
        row = {name: table[name][0].as_py() for name in ("label", "dim", "shard")}
        row |= graph | {"ids": table["class_id"].to_pylist(), "copies": table["copies"].to_pylist()}
        return pa.Table.from_pylist([row], _INDEX_ARROW)

    return materialise(dealt.groupBy("label", "dim", "shard").applyInArrow(build, _INDEX), "vector-graphs")


class Links:
    """Which vectors of two shards are linked, a bit each: at most 8 MB for two shards of 8,192, however near they all are."""

    def __init__(self, rows: int, columns: int):
        self.bits, self.columns = np.zeros((rows, -(-columns // 8)), np.uint8), columns

    def add(self, row: int, columns: np.ndarray) -> None:
        np.bitwise_or.at(self.bits[row], columns >> 3, (128 >> (columns & 7)).astype(np.uint8))

    def add_to_column(self, rows: np.ndarray, column: int) -> None:
        self.bits[rows, column >> 3] |= np.uint8(128 >> (column & 7))

    def rows(self, some: np.ndarray | slice) -> np.ndarray:
        return np.unpackbits(self.bits[some], axis=1, count=self.columns).astype(bool)

    def without_self(self) -> None:
        k = np.arange(len(self.bits))
        self.bits[k, k >> 3] &= ~(128 >> (k & 7)).astype(np.uint8)

    def __eq__(self, other: object) -> bool:
        return isinstance(other, Links) and np.array_equal(self.bits, other.bits)

    def counts(self, left: np.ndarray, right: np.ndarray, rows: int = 512) -> tuple[np.ndarray, np.ndarray]:
        """For each row the sum of ``right`` over its links, for each column that of ``left``."""
        by_row, by_column = np.zeros(len(self.bits), np.int64), np.zeros(self.columns, np.int64)
        for at in range(0, len(self.bits), rows):
            part = self.rows(slice(at, at + rows))
            by_row[at : at + rows] = part @ right
            by_column += left[at : at + rows] @ part
        return by_row, by_column

    def forest(self, same: bool) -> tuple[np.ndarray, np.ndarray]:
        """Rows and columns of links that connect what all of them connect, found a frontier at a time.

        With ``same`` a row and the column of its number are one vector.
        """
        row_left, column_left = np.ones(len(self.bits), bool), np.ones(self.columns, bool)
        xs, ys = [], []
        for begin in np.flatnonzero(self.bits.any(axis=1)).tolist():
            if not row_left[begin]:
                continue
            row_left[begin] = False
            if same:
                column_left[begin] = False
            frontier = np.array([begin])
            while len(frontier):
                reached = []
                for at in range(0, len(frontier), 512):
                    part = frontier[at : at + 512]
                    linked = self.rows(part) & column_left
                    new = np.flatnonzero(linked.any(axis=0))
                    column_left[new] = False
                    xs.append(part[linked[:, new].argmax(axis=0)])
                    ys.append(new)
                    reached.append(new)
                new = np.concatenate(reached)
                if same:
                    row_left[new] = False
                    frontier = new
                else:
                    frontier = self._rows_of(new, row_left, xs, ys)
        none = np.empty(0, np.int64)
        return np.concatenate([none, *xs]), np.concatenate([none, *ys])

    def _rows_of(self, columns: np.ndarray, row_left: np.ndarray, xs: list, ys: list) -> np.ndarray:
        """Rows that are left and link with one of the columns; their links are added to the lists."""
        if not len(columns):
            return columns
        mask = np.zeros(self.columns, bool)
        mask[columns] = True
        packed, left, found = np.packbits(mask), np.flatnonzero(row_left), []
        for at in range(0, len(left), 512):
            part = left[at : at + 512]
            hit = self.bits[part] & packed
            some = hit.any(axis=1)
            linked = np.unpackbits(hit[some], axis=1, count=self.columns)
            xs.append(part[some])
            ys.append(linked.argmax(axis=1))
            found.append(part[some])
        new = np.concatenate(found) if found else left
        row_left[new] = False
        return new


def _links(a: Graph, b: Graph, beam: int) -> Links:
    """Pairs (place in a, place in b) that either graph's queries find."""
    found = Links(len(a.vectors), len(b.vectors))
    for k in range(len(a.vectors)):
        near = np.asarray(b.within(a.vectors[k], LEAST, beam), np.int64)
        found.add(k, near)
        if a is b:
            found.add_to_column(near, k)
    if a is not b:
        for j in range(len(b.vectors)):
            found.add_to_column(np.asarray(a.within(b.vectors[j], LEAST, beam), np.int64), j)
    return found


def _sampled(graph: Graph, queries: np.ndarray, same: bool, rows: int = 512) -> list[list[tuple[int, np.ndarray]]]:
    """Queries with their links by brute force, those to themselves left out: lists by degree, the least one first."""
    order = np.random.default_rng(7).permutation(len(queries))
    by_degree: dict[int, list[tuple[int, np.ndarray]]] = {}
    for at in range(0, len(order), rows):
        part = order[at : at + rows]
        near = queries[part] @ graph.vectors.T >= LEAST
        if same:
            near[np.arange(len(part)), part] = False
        for k, row in zip(part.tolist(), near, strict=True):
            links = np.nonzero(row)[0]
            some = by_degree.setdefault(len(links).bit_length(), []) if len(links) else []
            if len(some) < AUDITED:
                some.append((k, links))
        if sum(len(some) for degree, some in by_degree.items() if degree < max(by_degree)) >= AUDITED:
            break
        if at + rows >= MOST_AUDITED:
            break
    return [by_degree[degree] for degree in sorted(by_degree)]


def _passes(graph: Graph, queries: np.ndarray, sampled: list[list[tuple[int, np.ndarray]]], beam: int) -> bool:
    """Whether the graph finds enough of the links of every degree's queries, each query counted alike."""
    for some in sampled:
        lost = 0.0
        for k, links in some:
            lost += 1 - np.isin(links, graph.within(queries[k], LEAST, beam)).mean()
            if lost > (1 - AUDIT) * len(some):
                return False
    return True


def _brute(a: Graph, b: Graph, rows: int = 512) -> Links:
    found = Links(len(a.vectors), len(b.vectors))
    for at in range(0, len(a.vectors), rows):
        found.bits[at : at + rows] = np.packbits(a.vectors[at : at + rows] @ b.vectors.T >= LEAST, axis=1)
    return found


def audited_links(a: Graph, b: Graph) -> tuple[Links, int]:
    """The links between two shards, and the beam at which the audit passed."""
    beam = BEAM
    size = max(len(a.vectors), len(b.vectors))
    ways = [(b, a.vectors, _sampled(b, a.vectors, a is b))]
    if a is not b:
        ways.append((a, b.vectors, _sampled(a, b.vectors, False)))
    while beam < size:
        if all(_passes(*way, beam) for way in ways):
            return _links(a, b, beam), beam
        beam *= 2
    return _brute(a, b), beam


def _compared(index: DataFrame) -> DataFrame:
    """Rows ``class_id``, ``links`` (vectors linked, by pair of shards), and ``a``, ``b`` (links of a spanning forest)."""
    named = ["shard", "n", "entry", "ids", "copies", "vectors", "layers"]
    left = index.select("label", "dim", *(F.col(c).alias(f"a_{c}") for c in named))
    right = index.select("label", "dim", *(F.col(c).alias(f"b_{c}") for c in named))
    pairs = left.join(right, ["label", "dim"]).filter("a_shard <= b_shard")
    pairs = pairs.repartition("label", "dim", "a_shard", "b_shard")

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                a = Graph.of(row["a_n"], row["a_entry"], row["a_vectors"], row["a_layers"])
                same = row["a_shard"] == row["b_shard"]
                b = a if same else Graph.of(row["b_n"], row["b_entry"], row["b_vectors"], row["b_layers"])
                found, _ = audited_links(a, b)
                if same:
                    found.without_self()
                a_ids, b_ids, a_copies, b_copies = (
                    np.array(row[name], np.int64) for name in ("a_ids", "b_ids", "a_copies", "b_copies")
                )
                of_a, of_b = found.counts(a_copies, b_copies)
                ids, links = (a_ids, of_a) if same else (np.concatenate(x) for x in ((a_ids, b_ids), (of_a, of_b)))
                ids, links = ids[links > 0], links[links > 0]
                x, y = found.forest(same)
                n, m = len(ids), len(x)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.concat_arrays([pa.array(ids), pa.nulls(m, pa.int64())]),
                        pa.concat_arrays([pa.array(links), pa.nulls(m, pa.int64())]),
                        pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(a_ids[x])]),
                        pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(b_ids[y])]),
                    ],
                    names=["class_id", "links", "a", "b"],
                )

    return materialise(pairs.mapInArrow(run, "class_id bigint, links bigint, a bigint, b bigint"), "vector-links")


def near_duplicates(vectors: DataFrame) -> DataFrame:
    """One row per row: ``vec_id``, ``n_links``, ``component_id``, ``kept``, as registered."""
    rows = usable(vectors)
    classes = rows.groupBy("key", "label", "dim").agg(
        F.min("vec_id").alias("class_id"), F.count(F.lit(1)).alias("copies"), F.first("vector").alias("vector")
    )
    classes = materialise(classes, "vector-classes")
    compared = _compared(_indexed(classes.select("key", "label", "dim", "class_id", "copies", "vector")))
    links = compared.filter("class_id IS NOT NULL").groupBy("class_id").agg(F.sum("links").alias("links"))
    components = connected_components(compared.filter("a IS NOT NULL").select("a", "b"))
    found = (
        classes.select("key", "class_id", "copies")
        .join(links, "class_id", "left")
        .join(components, F.col("class_id") == F.col("node"), "left")
        .select(
            "key",
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "class_id").alias("component_id"),
        )
    )
    every = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"))
    linked = rows.select("vec_id", "key").join(found, "key").select("vec_id", "n_links", "component_id")
    # Rows that cannot link are those that the usable ones leave over, repeated ids counted.
    order = linked.select("vec_id").withColumn("usable", F.lit(1)).groupBy("vec_id").agg(F.sum("usable").alias("used"))
    rest = every.groupBy("vec_id").agg(F.count(F.lit(1)).alias("n")).join(order, "vec_id", "left")
    rest = rest.filter(F.col("n") > F.coalesce("used", F.lit(0))).select(
        "vec_id", F.explode(F.sequence(F.coalesce("used", F.lit(0)) + 1, F.col("n"))).alias("k")
    )
    alone = rest.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))
