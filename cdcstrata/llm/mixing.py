"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree, in built-in functions only.

Every source has a target in words. Its documents are dealt by hash into blocks, which are its random permutation; a
target takes blocks in that order, going round again where it exceeds the source, and the document that the target
ends in is cut, so a source's words come out exact. The blocks that are taken are then shared out among the output
shards by a binary tree: a node halves its shards, and how many of each source's blocks go left is drawn from the
multivariate hypergeometric law, one univariate draw a source given those before it, so that every node has its exact
number of blocks and every shard a fair mix. Quotas turn into disjoint ranges of each source's permuted blocks. Within a
shard rows are ordered by another hash.

One row stands for each source in the tree, so sources must be a dimension (thousands, not billions); documents, blocks
and words may grow without limit. Prefix sums run over blocks of ``BLOCK_DOCS`` documents in groups of ``FAN``, so
no window holds a large source. All draws come from hashes of fixed seeds: reruns agree.

Nulls: a null source is one of its own and comes last; a null text has no words and is never drawn. Rows that repeat
a doc_id are rows of their own, whatever column they differ in. An empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cdcstrata.sources.scratch import materialise

WORD = r"[^\x20\x09-\x0D]+"  # fixed value: what counts as a word
WEIGHTS = (3, 1, 2)  # of the sources by code point, repeating
SHARE = 1.5  # of all words
LIMIT = 2  # times a source at most
BLOCK_DOCS = 256
FAN = 1024
SEED = 7


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def unit(*parts: Column) -> Column:
    """A number in [0, 1) from a hash."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(2**53))


# --- targets --------------------------------------------------------------------------------------


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, limit: float = LIMIT) -> DataFrame:
    """``source``, ``source_size``, ``target``: water is poured by weight until a source is full at ``limit`` times its size.

    Sources fill up in the order of their limit per weight. So the level is found in one pass over that order:
    the first source that is not full at the level that the rest would share.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.orderBy(F.col("source").asc_nulls_last())
    number = F.row_number().over(everything) - 1
    weighed = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.pmod(number, F.lit(len(weights))) + 1))
    weighed = weighed.withColumn("most", F.col("source_size") * F.lit(float(limit)))
    fill = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    after = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    left = F.sum("source_size").over(whole) * F.lit(float(share)) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    level = left / F.sum("weight").over(after)
    return (
        weighed.withColumn("level", level)
        .withColumn("open", F.col("most") > F.col("level") * F.col("weight"))
        .withColumn("water", F.max(F.when(F.col("open"), F.col("level"))).over(whole))  # it falls from there on
        .select(
            "source",
            "source_size",
            F.least(F.col("most"), F.coalesce(F.col("water") * F.col("weight"), F.col("most"))).alias("target"),
        )
    )


# --- the tree -------------------------------------------------------------------------------------


def hypergeometric(total: str, marked: str, drawn: str, u: str) -> str:
    """SQL for how many marked ones are among ``drawn`` of ``total``: the inverse of the law at ``u``.

    The law is summed by its ratio of neighbours over ten standard deviations to either side of the mean.
    """
    mean = f"({drawn} * {marked} / greatest({total}, 1D))"
    spread = f"(10D * sqrt({mean} * greatest({total} - {marked}, 0D) / greatest({total}, 1D)) + 10D)"
    low = f"cast(greatest(0D, {drawn} + {marked} - {total}, floor({mean} - {spread})) AS BIGINT)"
    high = f"cast(greatest({low}, least({drawn}, {marked}, ceil({mean} + {spread}))) AS BIGINT)"
    ratio = f"(({marked} - k) * ({drawn} - k) / ((k + 1D) * greatest({total} - {marked} - {drawn} + k + 1D, 1D)))"
    start = "named_struct('w', 1D, 'sum', 0D)"
    step = f"named_struct('w', a.w * {ratio}, 'sum', a.sum + a.w)"
    law = f"aggregate(sequence({low}, {high}), {start}, (a, k) -> {step}, a -> a.sum)"
    pick = (
        f"aggregate(sequence({low}, {high}), named_struct('w', 1D, 'sum', 0D, 'n', -1L), (a, k) -> "
        f"named_struct('w', a.w * {ratio}, 'sum', a.sum + a.w, 'n', a.n + if(a.sum <= {u} * s.law, 1L, 0L)), a -> a.n)"
    )
    return f"aggregate(array(named_struct('law', {law})), 0L, (z, s) -> {low} + greatest({pick}, 0L), z -> z)"


def split_tree(counts: DataFrame, shards: int, seed: int = SEED) -> DataFrame:
    """``source``, ``blocks`` to (``shard``, ``source``, ``quota``): quotas of a source sum to its blocks.

    Level by level, each node draws what goes left of every source. Both children together have what the node has.
    """
    item = F.struct("source", F.col("blocks").cast("bigint").alias("n"))
    nodes = counts.agg(F.array_sort(F.collect_list(item)).alias("has")).select(
        F.lit(0).alias("low"), F.lit(shards).alias("high"), "has"
    )
    draw = hypergeometric("acc.total", "cast(x.n AS DOUBLE)", "acc.drawn", "u.u")
    uniform = f"shiftrightunsigned(xxhash64({seed}, low, high, x.source), 11) / {float(2**53)}D"
    drawn = f"""
        aggregate(has,
          named_struct('total', total, 'drawn', drawn, 'takes', cast(array() AS ARRAY<BIGINT>)),
          (acc, x) -> aggregate(
            array(named_struct('u', {uniform})), acc,
            (same, u) -> aggregate(
              array({draw}), same,
              (old, got) -> named_struct(
                'total', old.total - x.n, 'drawn', old.drawn - got, 'takes', concat(old.takes, array(got))))),
          acc -> acc.takes)
    """
    while shards > 1:
        middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
        total = F.aggregate("has", F.lit(0.0), lambda a, x: a + x["n"])
        share = (middle - F.col("low")) / (F.col("high") - F.col("low"))
        nodes = nodes.withColumn("total", total).withColumn("drawn", F.floor(F.col("total") * share).cast("double"))
        nodes = nodes.withColumn("takes", F.when(F.col("high") - F.col("low") > 1, F.expr(drawn)))
        left = F.struct(
            F.col("low").alias("low"),
            middle.alias("high"),
            F.zip_with("has", "takes", lambda x, t: F.struct(x["source"].alias("source"), t.alias("n"))).alias("has"),
        )
        right = F.struct(
            middle.alias("low"),
            F.col("high").alias("high"),
            F.zip_with("has", "takes", lambda x, t: F.struct(x["source"].alias("source"), (x["n"] - t).alias("n"))).alias("has"),
        )
        same = F.array(F.struct("low", "high", "has"))
        nodes = nodes.select(F.explode(F.when(F.col("takes").isNull(), same).otherwise(F.array(left, right))).alias("node"))
        nodes = nodes.select("node.*")
        shards = -(-shards // 2)
    return nodes.select(F.col("low").alias("shard"), F.explode("has").alias("x")).select(
        "shard", F.col("x.source").alias("source"), F.col("x.n").alias("quota")
    )


# --- the mix --------------------------------------------------------------------------------------


def _blocked(rows: DataFrame) -> DataFrame:
    """Adds ``block``: a source's documents, dealt by hash to as many blocks as its number of documents asks for."""
    counts = rows.groupBy("source").agg(F.ceil(F.count(F.lit(1)) / BLOCK_DOCS).alias("n_blocks"))
    joined = rows.withColumn("__s", F.col("source")).join(
        counts.withColumnRenamed("source", "__t"), F.expr("__s <=> __t")
    )
    place = F.floor(unit(F.lit(SEED), F.col("row_key")) * F.col("n_blocks")).cast("bigint")
    return joined.withColumn("block", place).drop("__s", "__t", "n_blocks")


def _block_starts(blocks: DataFrame) -> DataFrame:
    """Words of a source before each of its blocks: summed by groups of blocks, then within them."""
    grouped = blocks.withColumn("fan", F.floor(F.col("block") / FAN))
    sums = grouped.groupBy("source", "fan").agg(F.sum("words").alias("fan_words"))
    over = Window.partitionBy("source").orderBy("fan").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("fan_start", F.coalesce(F.sum("fan_words").over(over), F.lit(0))).drop("fan_words")
    inside = Window.partitionBy("source", "fan").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    within = grouped.withColumn("inside", F.coalesce(F.sum("words").over(inside), F.lit(0)))
    sums = sums.withColumnRenamed("source", "__t").withColumnRenamed("fan", "__f")
    return within.join(sums, F.expr("source <=> __t AND fan = __f")).select(
        "source", "block", "words", (F.col("fan_start") + F.col("inside")).alias("block_start")
    )


def row_id(docs: DataFrame) -> Column:
    """128 bits of all columns of a row, nulls marked: rows that share it are equal in every column."""
    columns = [F.to_json(F.col(f"`{c}`")) if kind.startswith("map") else F.col(f"`{c}`") for c, kind in docs.dtypes]
    marked = [x for c in columns for x in (c.isNull(), c)]
    return F.struct(F.xxhash64(F.lit(SEED), *marked).alias("a"), F.xxhash64(F.lit(SEED + 2), *marked).alias("b"))


def sized(docs: DataFrame, text: str = "text") -> DataFrame:
    """The narrow rows that the mix is computed from, stored once: ``doc_id``, ``source``, ``size``, ``row_key``, ``row_id``."""
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        word_count(text).alias("size"),
        F.xxhash64(F.lit(SEED), "doc_id", "source", text).alias("row_key"),
        row_id(docs).alias("row_id"),
    )
    return materialise(rows, "mix-sizes")


def planned(rows: DataFrame, shards: int = 8, **rules) -> tuple[DataFrame, DataFrame]:
    """Rows with their place in the source's permutation, and blocks drawn: (``placed``, ``pieces`` of blocks by shard)."""
    goal = materialise(targets(rows, **rules), "mix-targets")
    blocked = _blocked(rows)
    blocks = blocked.groupBy("source", "block").agg(F.sum("size").alias("words"))
    starts = materialise(_block_starts(blocks), "mix-blocks")
    aims = goal.withColumnRenamed("source", "__t")
    passes = F.explode(F.sequence(F.lit(0), F.lit(int(rules.get("limit", LIMIT)) - 1))).alias("round")
    drawn = (
        starts.join(aims, F.expr("source <=> __t"))
        .select("source", "block", "words", "block_start", "source_size", F.round("target").alias("aim"), passes)
        .withColumn("from_word", F.col("round") * F.col("source_size") + F.col("block_start"))
        .filter("words > 0 AND from_word < aim")
    )
    counts = drawn.groupBy("source").agg(F.count(F.lit(1)).alias("blocks"))
    quotas = materialise(split_tree(counts, shards), "mix-quotas")
    order = Window.partitionBy("source").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    ends = quotas.withColumn("end", F.sum("quota").over(order)).groupBy("source").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("shard", "end"))), lambda x: x["end"]).alias("ends")
    )
    # Blocks of a source are numbered in their drawn order, again by groups.
    ranked = drawn.withColumn("fan", F.floor(F.col("block") / FAN))
    fans = ranked.groupBy("source", "round", "fan").agg(F.count(F.lit(1)).alias("n"))
    over = Window.partitionBy("source").orderBy("round", "fan").rowsBetween(Window.unboundedPreceding, -1)
    fans = fans.withColumn("base", F.coalesce(F.sum("n").over(over), F.lit(0))).select(
        F.col("source").alias("__t"), F.col("round").alias("__r"), F.col("fan").alias("__f"), "base"
    )
    inside = Window.partitionBy("source", "round", "fan").orderBy("block")
    ranked = (
        ranked.withColumn("rank", F.row_number().over(inside) - 1)
        .join(fans, F.expr("source <=> __t AND round = __r AND fan = __f"))
        .withColumn("rank", F.col("rank") + F.col("base"))
        .drop("__t", "__r", "__f", "base", "fan")
        .join(ends.withColumnRenamed("source", "__t"), F.expr("source <=> __t"))
        .withColumn("shard", F.size(F.filter("ends", lambda e: e <= F.col("rank"))))
        .groupBy("source", "block")
        .agg(F.first("block_start").alias("block_start"), F.collect_list(F.struct("round", "shard")).alias("draws"))
    )
    keys = [F.col("source").alias("__t"), F.col("block").alias("__b"), "block_start", "draws"]
    before = Window.partitionBy("source", "block").orderBy("row_key", "doc_id", "row_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        blocked.withColumn("ahead", F.coalesce(F.sum("size").over(before), F.lit(0)))
        .join(ranked.select(*keys), F.expr("source <=> __t AND block = __b"), "left")
        .drop("__t", "__b")
        .join(aims, F.expr("source <=> __t"))
        .drop("__t")
        .withColumn("place", F.col("block_start") + F.col("ahead"))
    )
    return placed, goal


def _words_drawn(round_number: Column) -> Column:
    """Words of a row that a round takes: the part of it that lies before the target."""
    left = F.round("target") - round_number * F.col("source_size") - F.col("place")
    return F.greatest(F.lit(0), F.least(F.col("size"), left)).cast("bigint")


def taken(docs: DataFrame, shards: int = 8, text: str = "text", **rules) -> DataFrame:
    """One row per row: ``doc_id``, ``size``, ``source_size``, ``target`` and ``taken``, as registered, and ``shards``.

    ``shards`` names the output shard of each draw, in the order of the rounds, as the tree has dealt them.
    """
    placed, _ = planned(sized(docs, text), shards, **rules)
    total = F.aggregate(
        F.coalesce(F.col("draws"), F.array().cast("array<struct<round:int,shard:int>>")),
        F.lit(0).cast("bigint"),
        lambda a, d: a + _words_drawn(d["round"]),
    )
    drawn = F.filter("draws", lambda d: _words_drawn(d["round"]) > 0)
    shard = F.transform(F.array_sort(drawn), lambda d: d["shard"].cast("string"))
    named = F.coalesce(F.array_join(shard, ","), F.lit(""))
    return placed.select("doc_id", "size", "source_size", "target", total.alias("taken"), named.alias("shards"))


def mix(docs: DataFrame, shards: int = 8, text: str = "text", **rules) -> DataFrame:
    """The mix: a row for every draw of a document, with all columns of ``docs``, ``shard``, ``position_key`` and ``words``.

    Columns of ``docs`` of those three names are replaced.

    A document that the target ends in is cut after its ``words`` first words; its text keeps what stands
    between and after them. Sorting a shard by ``position_key`` shuffles it locally.
    """
    docs = docs.drop("shard", "position_key", "words")
    key = row_id(docs)
    keyed = docs.withColumn("__a", key["a"]).withColumn("__b", key["b"])
    placed, _ = planned(sized(docs, text), shards, **rules)
    draws = (
        placed.select("row_id", "row_key", "size", "source_size", "target", "place", F.explode("draws").alias("draw"))
        .withColumn("words", _words_drawn(F.col("draw.round")))
        .filter("words > 0")
        .select(
            F.col("row_id.a").alias("__row_a"),
            F.col("row_id.b").alias("__row_b"),
            F.col("size").alias("__size"),
            "words",
            F.col("draw.shard").alias("shard"),
            F.xxhash64(F.lit(SEED + 1), "row_id", "draw.round").alias("position_key"),
        )
    )
    # Rows that are equal in every column have one key; each of their draws is one of theirs, so a row stands for them.
    # The key is two plain columns, so that the join meets the rows where they lie already.
    unique = keyed.dropDuplicates(["__a", "__b"])
    cut = F.array_join(F.slice(F.regexp_extract_all(F.col(text), F.lit(rf"^[\x20\x09-\x0D]*{WORD}|[\x20\x09-\x0D]+{WORD}"), F.lit(0)), 1, F.col("words").cast("int")), "")
    joined = unique.join(draws, (F.col("__a") == F.col("__row_a")) & (F.col("__b") == F.col("__row_b")))
    return joined.withColumn(text, F.when(F.col("words") < F.col("__size"), cut).otherwise(F.col(text))).drop(
        "__a", "__b", "__row_a", "__row_b", "__size"
    )
