"""Lines that many documents hold are kept in one of them only, in built-in functions only.

A text is split at line feeds; a null or empty one is one empty line. A line's key is the line without white space at both ends
and with A-Z in lower case. Keys of at least 40 code points in at least 5 documents stay in the document of the largest id
that holds them, with all their lines there, and go from all others. Lines are matched by the MD5 of their key.

Lines are put in order of hash, document (largest first) and position, cut into ranges of equal size, and stored. Inside a
range the lines of a hash stream by: those of the first document are the first occurrence. A hash that fills more than
a range, however common it is, lies at the edge of each of its ranges; those few hashes, two a range at most, are
summed up apart. What comes back is no text: a bitmap of the kept lines a document, packed as run lengths.

Documents are told apart by id; a null id is an id of its own and the smallest. Rows that share an id are held to the same
rule: those of the largest id keep the line, each row by its own text, and equal rows give equal results. Lines repeated in
one document count as one document. An empty table has no rows; further columns, whatever their names, are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cdcstrata.llm.ranges import BLANKS, lower_ascii, ranged
from cdcstrata.sources.scratch import materialise

MIN_CHARS, MIN_DOCS = 40, 5


def lines(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(BLANKS)))


def _text_id(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary")))


def long_lines(docs: DataFrame, text: str, min_chars: int) -> DataFrame:
    """``hash``, ``doc_id``, ``text_id``, ``n_lines`` and ``position`` of each line with a long key."""
    # Text ids are made below the generator, once a text.
    whole = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), _text_id(F.col(text)).alias("text_id"), lines(F.col(text)).alias("lines")
    ).withColumn("n_lines", F.size("lines"))
    at = whole.select("doc_id", "text_id", "n_lines", F.posexplode("lines").alias("position", "line"))
    # What is shorter than the limit with its white space is so without it as well.
    keyed = at.filter(F.char_length("line") >= min_chars).withColumn("key", line_key(F.col("line")))
    return keyed.filter(F.char_length("key") >= min_chars).select(
        F.unhex(F.md5(F.col("key").cast("binary"))).alias("hash"), "doc_id", "text_id", "n_lines", "position"
    )


def dropped_lines(docs: DataFrame, text: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``doc_id``, ``text_id``, ``n_lines`` and ``position`` of each line that goes."""
    order = [F.col("hash"), F.col("doc_id").desc_nulls_last(), F.col("position")]
    placed = ranged(long_lines(docs, text, min_chars), order, "lines")
    # At most two hashes a range reach over its edge; there are as many ranges as shuffle partitions.
    edges = placed.groupBy("part").agg(F.array(F.min("hash"), F.max("hash")).alias("hash"))
    edges = edges.select(F.explode("hash").alias("hash")).distinct()
    each = placed.join(F.broadcast(edges), "hash", "left_semi").groupBy("hash", "doc_id").agg(F.lit(1).alias("one"))
    wide = each.groupBy("hash").agg(F.count(F.lit(1)).alias("__all"), F.max("doc_id").alias("__largest"))
    wide = materialise(wide, "lines-edges")
    in_range = Window.partitionBy("part", "hash")
    stream = in_range.orderBy(F.col("doc_id").desc_nulls_last())
    seen = (
        placed.withColumn("__doc", F.dense_rank().over(stream))
        .withColumn("__here", F.max("__doc").over(in_range))
        .withColumn("__first", F.first("doc_id").over(stream))
        .join(F.broadcast(wide), "hash", "left")
    )
    over = F.col("__all").isNotNull()
    keeper = F.when(over, F.col("__largest")).otherwise(F.col("__first"))
    common = F.coalesce("__all", "__here") >= min_docs
    return seen.filter(common & ~F.col("doc_id").eqNullSafe(keeper)).select("doc_id", "text_id", "n_lines", "position")


def keep_bitmaps(docs: DataFrame, text: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """A row for each document that loses a line: ``doc_id``, ``text_id``, ``n_dropped`` and ``kept``, stored.

    ``kept`` is the bitmap of the lines that stay, packed as its runs of ones, each with its ``first`` and ``last`` line.
    """
    gone = dropped_lines(docs, text, min_chars, min_docs)
    each = gone.groupBy("doc_id", "text_id", "n_lines").agg(F.array_sort(F.collect_set("position")).alias("__dropped"))
    # Between two dropped lines, and between them and the ends, lies a run of kept ones or nothing.
    bounds = each.withColumn("__at", F.concat(F.array(F.lit(-1)), "__dropped", F.array("n_lines")))
    runs = F.transform(
        F.sequence(F.lit(1), F.size("__at") - 1),
        lambda i: F.struct((F.get("__at", i - 1) + 1).alias("first"), (F.get("__at", i) - 1).alias("last")),
    )
    kept = F.filter(runs, lambda r: r["first"] <= r["last"])
    out = bounds.select("doc_id", "text_id", F.size("__dropped").alias("n_dropped"), kept.alias("kept"))
    return materialise(out, "lines-kept")


def deduped(docs: DataFrame, text: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Adds ``n_lines``, ``n_dropped`` and ``kept_text`` to every row; of its own columns it reads ``doc_id`` and the text.

    Columns of these names, and of names that begin with ``__``, give way to them.
    """
    added = ("n_lines", "n_dropped", "kept_text")
    own = [c for c in docs.columns if c not in added and not c.startswith("__")]
    bits = keep_bitmaps(docs, text, min_chars, min_docs).select(
        F.col("doc_id").alias("__id"), F.col("text_id").alias("__text_id"), F.col("n_dropped").alias("__n"), F.col("kept").alias("__kept")
    )
    rows = docs.select(*[F.col(f"`{c}`") for c in own], lines(F.col(text)).alias("__lines"), _text_id(F.col(text)).alias("__own"))
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__text_id"))
    joined = rows.join(bits, same, "left")
    kept = F.flatten(F.transform("__kept", lambda r: F.slice("__lines", r["first"] + 1, r["last"] - r["first"] + 1)))
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return joined.select(
        *[F.col(f"`{c}`") for c in own],
        F.size("__lines").cast("bigint").alias("n_lines"),
        F.coalesce("__n", F.lit(0)).cast("bigint").alias("n_dropped"),
        F.when(F.col("__n").isNull(), whole).otherwise(F.array_join(kept, "\n")).alias("kept_text"),
    )


def digest(docs: DataFrame) -> DataFrame:
    """The registered query's columns: counts and the hash of what is left of each document."""
    rows = deduped(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))
