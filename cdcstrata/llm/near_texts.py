"""N-gram Jaccard join by chosen paths: similar sets meet by choosing the same tokens, level after level.

Every text is its set of word shingles; equal sets are one class, compared once. On each level of a run a set chooses
``BRANCHES`` of its shingles, each the one of least hash under a hash function of its own, so that two sets choose the same
one with the probability of their Jaccard index. A bucket is the path of choices made so far, and as sets that share
little part at every level, common passages do not hold a bucket together. A bucket of up to ``SMALL`` sets is
compared by brute force, one of up to ``MEDIUM`` in pairs of blocks. A larger one is first compared with a few pivots: a
set that is very near a pivot is tied to it and stops there, since whatever it links with is near the pivot, too, and tied
to it as well. The rest goes on to the next level. A bucket of near copies, nearly all tied to one pivot, ends there: its
few other sets are compared with all of it. What is still in a large bucket after the last level is brute-forced in pairs of blocks. A level misses
a link of the least similarity with probability (1 - LEAST) ** BRANCHES and runs repeat, with other hashes, until
the target recall is met: two of them for 0.999.

All this compares sketches (64 one-permutation minima, 128 bytes) and finds which sets may be linked at all. The sets of
each such candidate group are then compared exactly, all with all, in pairs of bounded blocks, which give counts and a
spanning forest of the links, never the pairs themselves.

A text without words links with nothing. A row without a doc_id is compared with nothing and has a null class. Rows that
share a doc_id are one document: they are united. Texts of any length are read whole; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcstrata.llm.components import connected_components
from cdcstrata.llm.shingles import mixed, portions, shingle_sets
from cdcstrata.sources.scratch import materialise, release, store

LEAST = 0.8
TARGET = 0.999
BRANCHES, LEVELS = 3, 3
SMALL, MEDIUM, PIVOTS = 64, 4096, 4
BINS = 64
MAYBE = 0.6  # the least estimate that makes two sets candidates
STOPS = 0.85  # an estimate at which a set stops at its pivot
BLOCK, BLOCK_SHINGLES, SKETCH_BLOCK = 256, 2_000_000, 1024

_LINKED = "set_key string, links bigint, a bigint, b bigint"


def runs(target: float = TARGET) -> int:
    """How many runs miss a link with probability 1 - target at most."""
    return max(1, math.ceil(math.log(1 - target) / math.log(LEVELS * (1 - LEAST) ** BRANCHES)))


# --- features -------------------------------------------------------------------------------------


def sketch(shingles: np.ndarray) -> np.ndarray:
    """The least hash in each of 64 bins, 16 bits of it; 0 for an empty bin."""
    hashes = np.sort(mixed(shingles, salt=101))
    bins = (hashes >> np.uint64(58)).astype(np.int64)
    first = np.flatnonzero(np.diff(bins, prepend=-1))
    out = np.zeros(BINS, np.uint16)
    out[bins[first]] = np.maximum(mixed(hashes[first]) & np.uint64(0xFFFF), 1).astype(np.uint16)
    return out


def choices(sets: list[np.ndarray], n_runs: int) -> np.ndarray:
    """The shingles that each set takes as branches: a row a set, a column a run, level and branch."""
    out = np.zeros((len(sets), n_runs * LEVELS * BRANCHES), np.uint64)
    filled = [k for k, s in enumerate(sets) if len(s)]
    if filled:
        flat = np.concatenate([sets[k] for k in filled])
        starts = np.cumsum([0, *(len(sets[k]) for k in filled[:-1])])
        for way in range(out.shape[1]):
            out[filled, way] = np.minimum.reduceat(mixed(flat, salt=1 + way), starts)
    return out


def key_of(shingles: np.ndarray) -> str | None:
    return xxhash.xxh3_128_hexdigest(shingles.tobytes()) if len(shingles) else None


def _features(docs: DataFrame, n_runs: int, text: str) -> DataFrame:
    """``doc_id``, ``set_key`` (null without words), ``n``, ``sketch``, ``choices``: by run, level and branch."""

    def run(batches):
        for batch in batches:
            for a, b in portions(batch.column(1)):
                sets = shingle_sets(batch.column(1).slice(a, b - a))
                taken = choices(sets, n_runs).view(np.int64)
                offsets = np.arange(len(sets) + 1, dtype=np.int32) * taken.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array([key_of(s) for s in sets], pa.string()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([sketch(s).tobytes() if len(s) else None for s in sets], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(taken.ravel())),
                    ],
                    names=["doc_id", "set_key", "n", "sketch", "choices"],
                )

    rows = docs.filter(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text")
    )
    return rows.mapInArrow(
        run, "doc_id bigint, set_key string, n bigint, sketch binary, choices array<bigint>"
    )


# --- candidates -----------------------------------------------------------------------------------


def estimates(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Jaccard estimates of sketches, row by row."""
    filled = ((a != 0) | (b != 0)).sum(axis=-1)
    return ((a == b) & (a != 0)).sum(axis=-1) / np.maximum(filled, 1)


def _least_label(n: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """For each of n rows the least row that the links x, y connect it with."""
    label = np.arange(n)
    while len(x):
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Sorted batches as tables that hold whole groups."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([held, table]) if held is not None else table
        if not len(table):
            continue
        same = np.ones(len(table), bool)
        for key in keys:
            column = table[key].to_numpy()
            same &= column == column[-1]
        cut = len(table) - int(np.argmin(same[::-1])) if not same.all() else 0
        if cut:
            yield table.slice(0, cut)
        held = table.slice(cut).combine_chunks()
    if held is not None and len(held):
        yield held


def _sketches(table: pa.Table, name: str = "sketch") -> np.ndarray:
    return np.frombuffer(b"".join(table[name].to_pylist()), np.uint16).reshape(len(table), -1)


def _small_pairs(buckets: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of one bucket that may be linked; every bucket has its rows together."""
    xs, ys = [], []
    for step in range(1, len(buckets)):
        x = np.flatnonzero(buckets[:-step] == buckets[step:])
        if not len(x):
            break
        x = x[estimates(rows[x], rows[x + step]) >= MAYBE]
        xs.append(x)
        ys.append(x + step)
    none = np.empty(0, np.int64)
    return np.concatenate([none, *xs]), np.concatenate([none, *ys])


def _edges(class_ids: np.ndarray, x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
    """Links between classes that connect what the pairs of rows connect."""
    label = _least_label(len(class_ids), x, y)
    moved = np.flatnonzero(label != np.arange(len(label)))
    found = np.unique(np.stack([class_ids[label[moved]], class_ids[moved]], axis=1), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])


def _small_buckets(members: DataFrame) -> DataFrame:
    """Candidate links within buckets of at most ``SMALL`` sets."""

    def run(batches):
        for table in _groups(batches, ["bucket"]):
            x, y = _small_pairs(table["bucket"].to_numpy(), _sketches(table))
            yield _edges(table["class_id"].to_numpy(), x, y)

    dealt = members.select("bucket", "class_id", "sketch").repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, "a bigint, b bigint")


def _pivots(large: DataFrame) -> DataFrame:
    """A few sets of each bucket, those of least hash in as many parts, and their sketches."""
    part = F.pmod(F.xxhash64("bucket", "class_id"), F.lit(PIVOTS))
    least = F.min(F.struct(F.xxhash64("class_id", "bucket").alias("h"), "class_id", "sketch"))
    return (
        large.groupBy("bucket", part.alias("part"))
        .agg(least.alias("p"))
        .groupBy("bucket")
        .agg(F.collect_list("p.class_id").alias("pivots"), F.collect_list("p.sketch").alias("pivot_sketches"))
    )


def _tied(large: DataFrame) -> DataFrame:
    """Members of large buckets with the pivots they are tied to and whether they ``stay`` for the next level."""

    def run(batches):
        for batch in batches:
            own = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint16).reshape(len(batch), -1)
            pivots, texts = batch.column("pivots").to_pylist(), batch.column("pivot_sketches").to_pylist()
            row = np.repeat(np.arange(len(batch)), [len(p) for p in pivots])
            flat = np.frombuffer(b"".join(s for some in texts for s in some), np.uint16).reshape(len(row), -1)
            likeness = estimates(own[row], flat)
            ids = np.array([i for some in pivots for i in some], np.int64)
            best = np.zeros(len(batch))
            np.maximum.at(best, row, likeness)
            tied = likeness >= MAYBE
            ends = np.cumsum(np.bincount(row[tied], minlength=len(batch)))[:-1]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("run"),
                    batch.column("bucket"),
                    batch.column("class_id"),
                    pa.array([x.tolist() for x in np.split(ids[tied], ends)], pa.list_(pa.int64())),
                    pa.array(best < STOPS),
                ],
                names=["run", "bucket", "class_id", "pivots", "stays"],
            )

    rows = large.join(_pivots(large), "bucket").select("run", "bucket", "class_id", "sketch", "pivots", "pivot_sketches")
    return rows.mapInArrow(run, "run int, bucket bigint, class_id bigint, pivots array<bigint>, stays boolean")


def _ties(tied: DataFrame) -> DataFrame:
    """Links that connect every set with all of its pivots: with the first, and the first with the others.

    The latter are links between a bucket's few pivots, the same for many sets.
    """
    first = F.get("pivots", F.lit(0))
    own = tied.filter(F.size("pivots") > 0).select(F.col("class_id").alias("a"), first.alias("b"))
    sets = tied.filter(F.size("pivots") > 1).select("pivots").distinct()
    return own.unionByName(sets.select(first.alias("a"), F.explode("pivots").alias("b")).distinct())


def _nearly_tied(tied: DataFrame) -> DataFrame:
    """Large buckets all but ``SMALL`` of whose sets are tied to one pivot, their ``main``: groups of near copies.

    The tied ones are connected already, so such a bucket is done when the others are compared with all of it.
    """
    votes = tied.select("bucket", F.explode("pivots").alias("pivot")).groupBy("bucket", "pivot")
    votes = votes.agg(F.count(F.lit(1)).alias("near"))
    best = votes.groupBy("bucket").agg(
        F.max_by("pivot", F.struct("near", "pivot")).alias("main"), F.max("near").alias("near")
    )
    sizes = tied.groupBy("bucket").agg(F.count(F.lit(1)).alias("members"))
    blocks = F.ceil(F.col("members") / SKETCH_BLOCK).cast("int").alias("blocks")
    return sizes.join(best, "bucket").filter(F.col("members") - F.col("near") <= SMALL).select("bucket", "main", blocks)


def _closed(rows: DataFrame) -> DataFrame:
    """Candidate links of the sets that are not tied to their bucket's main pivot, with all sets of the bucket."""
    far = ~F.array_contains("pivots", F.col("main"))
    own = F.pmod(F.xxhash64("class_id", F.lit(5)), F.col("blocks")).cast("int")
    places = F.when(F.col("far"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(own))
    dealt = rows.withColumn("far", far).select("bucket", "class_id", "sketch", "far", F.explode(places).alias("block"))
    dealt = dealt.repartition("bucket", "block").sortWithinPartitions("bucket", "block")

    def one(key: tuple, table: pa.Table) -> pa.RecordBatch:
        sketches, xs, ys = _sketches(table), [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for k in np.flatnonzero(table["far"].to_numpy()).tolist():
            hit = np.flatnonzero(estimates(sketches[k], sketches) >= MAYBE)
            xs.append(np.full(len(hit), k))
            ys.append(hit)
        return _edges(table["class_id"].to_numpy(), np.concatenate(xs), np.concatenate(ys))

    return _by_group(dealt, ["bucket", "block"], one, "a bigint, b bigint")


def _thinned(links: DataFrame, most: int = 1 << 20) -> DataFrame:
    """Links that connect what the given ones connect, with few rounds in them.

    All links of a set come to one task, which replaces up to ``most`` links at a time by a spanning forest.
    """

    def forest(x: list[np.ndarray], y: list[np.ndarray]) -> pa.RecordBatch:
        ids, ends = np.unique(np.concatenate([*x, *y]), return_inverse=True)
        return _edges(ids, *np.split(ends, 2))

    def run(batches):
        x, y, size = [], [], 0
        for batch in batches:
            x.append(batch.column(0).to_numpy())
            y.append(batch.column(1).to_numpy())
            size += len(batch)
            if size >= most:
                yield forest(x, y)
                x, y, size = [], [], 0
        if size:
            yield forest(x, y)

    return links.repartition("a").mapInArrow(run, "a bigint, b bigint")


def _block_pairs(rows: DataFrame, keys: list[str], blocks: str) -> DataFrame:
    """Each row once for every pair of blocks that its own is part of: as many rows as its group has blocks."""
    own = F.pmod(F.xxhash64("class_id", F.lit(3)), F.col(blocks)).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col(blocks).cast("int") - 1))
    paired = rows.withColumn("own", own).withColumn("other", other)
    paired = paired.withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other"))
    return paired.repartition(*keys, "low", "high").sortWithinPartitions(*keys, "low", "high")


def _in_blocks(left: DataFrame) -> DataFrame:
    """Candidate links within buckets, by pairs of blocks: the medium ones and those that no level has split."""
    counts = left.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / SKETCH_BLOCK).cast("int").alias("blocks"))
    dealt = _block_pairs(left.join(counts, "bucket").select("bucket", "class_id", "sketch", "blocks"), ["bucket"], "blocks")

    def one(key: tuple, table: pa.Table) -> pa.RecordBatch:
        sketches, own = _sketches(table), table["own"].to_numpy()
        xs, ys = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        others = np.flatnonzero(own == key[2])
        for k in np.flatnonzero(own == key[1]).tolist():
            against = others[others > k] if key[1] == key[2] else others
            hit = against[estimates(sketches[k], sketches[against]) >= MAYBE]
            xs.append(np.full(len(hit), k))
            ys.append(hit)
        return _edges(table["class_id"].to_numpy(), np.concatenate(xs), np.concatenate(ys))

    columns = ["bucket", "low", "high", "own", "class_id", "sketch"]
    return _by_group(dealt.select(*columns), ["bucket", "low", "high"], one, "a bigint, b bigint")


def _candidates(classes: DataFrame, n_runs: int) -> DataFrame:
    """Links between classes that the exact comparison looks into."""
    spark = classes.sparkSession
    paths: list[str] = []

    def kept(df: DataFrame, name: str) -> DataFrame:
        paths.append(store(df, name))
        return spark.read.schema(df.schema).parquet(paths[-1])

    def branched(rows: DataFrame, level: int) -> DataFrame:
        """Rows with ``bucket`` and ``choices`` once for every branch that the set takes on the level."""
        first = (F.col("run") * LEVELS + level) * BRANCHES
        branches = F.posexplode(F.slice("choices", first + 1, BRANCHES)).alias("branch", "token")
        split = rows.select("run", "class_id", "bucket", branches)
        return split.select("run", "class_id", F.xxhash64("bucket", "branch", "token").alias("bucket"))

    each = classes.select("class_id", "choices", F.explode(F.sequence(F.lit(0), F.lit(n_runs - 1))).alias("run"))
    rows = branched(each.withColumn("bucket", F.col("run").cast("bigint")), 0)
    sketches = classes.select("class_id", "sketch")
    small, medium, found = [], [], []
    for level in range(LEVELS):
        rows = kept(rows, "paths")
        counts = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
        shared = kept(rows.join(counts, "bucket").join(sketches, "class_id"), "shared-paths")
        small.append(shared.filter(F.col("members") <= SMALL).select("bucket", "class_id", "sketch"))
        medium.append(shared.filter(F.col("members").between(SMALL + 1, MEDIUM)).select("bucket", "class_id", "sketch"))
        tied = kept(_tied(shared.filter(F.col("members") > MEDIUM)), "tied-paths")
        closing = kept(_nearly_tied(tied), "closing-paths")
        found += [_ties(tied), _closed(tied.join(closing, "bucket").join(sketches, "class_id"))]
        staying = tied.filter("stays").join(closing, "bucket", "left_anti").select("run", "bucket", "class_id")
        if level + 1 < LEVELS:
            rows = branched(staying.join(classes.select("class_id", "choices"), "class_id"), level + 1)
    found += [_small_buckets(s) for s in small]
    found += [_in_blocks(m) for m in (*medium, staying.join(sketches, "class_id"))]
    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)
    links = materialise(_thinned(links.filter("a <> b")), "candidates")
    release(spark, *paths)
    return links


# --- exact links ----------------------------------------------------------------------------------


def exact_links(sets: list[np.ndarray], sides: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of sets with a Jaccard index of at least ``LEAST``; with ``sides``, between the two sides alone.

    Intersections are counted by products of slices of the incidence matrix.
    """
    sizes = np.array([len(s) for s in sets])
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    _, token, often = np.unique(flat, return_inverse=True, return_counts=True)
    shared = often[token] > 1
    token, owner = np.unique(token[shared], return_inverse=True)[1], owner[shared]
    order = np.argsort(token, kind="stable")
    token, owner = token[order], owner[order]
    common = np.zeros((len(sets), len(sets)), np.float64)
    width, top = 4096, int(token[-1]) + 1 if len(token) else 0
    for at in range(0, top, width):
        a, b = np.searchsorted(token, [at, at + width])
        cells = np.zeros((len(sets), min(width, top - at)), np.float32)
        cells[owner[a:b], token[a:b] - at] = 1
        common += cells @ cells.T
    # At least 0.8 of the union, in whole numbers.
    union = sizes[:, None] + sizes[None, :] - common
    hit = np.triu((10 * common >= round(10 * LEAST) * union) & (common > 0), 1)
    if sides is not None:
        hit &= sides[:, None] != sides[None, :]
    return np.nonzero(hit)


def _compared(members: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """Exact links of candidate groups: rows of counts by set, and rows of a spanning forest by class."""
    groups = members.groupBy("group").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks")
    )
    source = docs.select(F.col("doc_id").cast("bigint").alias("class_id"), F.col(text).cast("string").alias("text"))
    rows = members.join(groups, "group").join(source, "class_id")
    dealt = _block_pairs(rows, ["group"], "blocks").select(
        "group", "low", "high", "own", "class_id", "set_key", "copies", "text"
    )

    def one(key: tuple, table: pa.Table) -> pa.RecordBatch | None:
        sets = [s for a, b in portions(table["text"].combine_chunks()) for s in shingle_sets(table["text"].combine_chunks().slice(a, b - a))]
        keys = table["set_key"].to_pylist()
        # A repeated doc_id brings other texts along, a repeated row its own again.
        place = {k: i for i, (k, s) in enumerate(zip(keys, sets, strict=True)) if key_of(s) == k}
        keep = sorted(place.values())
        if len(keep) < 2:
            return None
        classes, copies = table["class_id"].to_numpy()[keep], table["copies"].to_numpy()[keep]
        sides = table["own"].to_numpy()[keep] if key[1] != key[2] else None
        x, y = exact_links([sets[i] for i in keep], sides)
        if not len(x):
            return None
        links = np.bincount(x, copies[y], len(keep)) + np.bincount(y, copies[x], len(keep))
        linked = np.flatnonzero(links)
        label = _least_label(len(keep), x, y)
        moved = np.flatnonzero(label != np.arange(len(keep)))
        n, m = len(linked), len(moved)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([keys[keep[i]] for i in linked] + [None] * m, pa.string()),
                pa.array(links[linked].astype(np.int64).tolist() + [None] * m, pa.int64()),
                pa.array([None] * n + classes[label[moved]].tolist(), pa.int64()),
                pa.array([None] * n + classes[moved].tolist(), pa.int64()),
            ],
            names=["set_key", "links", "a", "b"],
        )

    return materialise(_by_group(dealt, ["group", "low", "high"], one, _LINKED), "exact-links")


def _by_group(rows: DataFrame, keys: list[str], one: Callable, schema: str) -> DataFrame:
    """``one`` on each group of rows that come sorted, many groups a task."""

    def run(batches):
        for table in _groups(batches, keys):
            values = np.stack([table[k].to_numpy() for k in keys], axis=1)
            starts = np.flatnonzero(np.any(np.diff(values, axis=0, prepend=values[:1] - 1), axis=1)).tolist()
            for a, b in zip(starts, [*starts[1:], len(table)], strict=True):
                if (found := one(tuple(values[a].tolist()), table.slice(a, b - a))) is not None:
                    yield found

    return rows.mapInArrow(run, schema)


def jaccard_join(docs: DataFrame, text: str = "text", target: float = TARGET) -> DataFrame:
    """One row per row: ``doc_id``, ``class_id``, ``copy_id``, ``n_links``.

    ``class_id`` is the least doc_id that links lead to, ``copy_id`` the least one with the same shingles, ``n_links``
    the number of other documents that are linked directly.
    """
    n_runs = runs(target)
    features = materialise(_features(docs, n_runs, text), "text-features")
    classes = (
        features.filter("set_key IS NOT NULL")
        .groupBy("set_key")
        .agg(
            F.min("doc_id").alias("class_id"),
            F.count(F.lit(1)).alias("copies"),
            F.first("n").alias("n"),
            F.first("sketch").alias("sketch"),
            F.first("choices").alias("choices"),
        )
    )
    classes = materialise(classes, "text-classes")
    groups = connected_components(_candidates(classes, n_runs))
    members = classes.select("class_id", "set_key", "copies", "n").join(
        groups.select(F.col("node").alias("class_id"), F.col("component").alias("group")), "class_id"
    )
    compared = _compared(members, docs, text)
    links = compared.filter("set_key IS NOT NULL").groupBy("set_key").agg(F.sum("links").alias("links"))
    same_id = features.filter("set_key IS NOT NULL").groupBy("doc_id").agg(
        F.min("set_key").alias("x"), F.max("set_key").alias("y")
    )
    first = classes.select("set_key", "class_id")
    repeated = (
        same_id.filter("x <> y")
        .join(features.select("doc_id", "set_key"), "doc_id")
        .join(first, "set_key")
        .groupBy("doc_id")
        .agg(F.collect_set("class_id").alias("ids"))
        .select(F.array_min("ids").alias("a"), F.explode("ids").alias("b"))
    )
    united = connected_components(compared.filter("a IS NOT NULL").select("a", "b").unionByName(repeated))
    known = (
        classes.select("set_key", "class_id", "copies")
        .join(links, "set_key", "left")
        .join(united, F.col("class_id") == F.col("node"), "left")
        .select(
            "set_key",
            F.coalesce("component", "class_id").alias("class_id"),
            F.col("class_id").alias("copy_id"),
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        )
    )
    named = features.select("doc_id", "set_key").join(known, "set_key", "left")
    named = named.select(
        "doc_id",
        F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("copy_id", "doc_id").alias("copy_id"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
    )
    nameless = docs.filter(F.col("doc_id").isNull()).select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        *(F.lit(None).cast("bigint").alias(c) for c in ("class_id", "copy_id")),
        F.lit(0).cast("bigint").alias("n_links"),
    )
    return named.unionByName(nameless)
