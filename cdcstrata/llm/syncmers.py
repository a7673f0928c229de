"""Document fingerprints from closed syncmers, in built-in functions only.

A text is a run of pieces: words, cut where longer than 24 characters, and single ideographs or kana. A k-mer is five
consecutive pieces. It is a closed syncmer if the least hash of its four inner substrings of two pieces is that of the
first or the last. Whether a k-mer is chosen depends on itself alone, so equal passages choose equal anchors
wherever they stand. The fingerprint is the 64 least distinct hashes of the anchors; the likeness of two is the share of
the 64 least of both that both hold, an estimate of the Jaccard index of the anchor sets.

A text without an anchor but with pieces has one: the hash of all its pieces. A null or empty text, or one of white
space, has an empty fingerprint; two empty ones have likeness 1, an empty and another 0. Equal texts have equal
fingerprints. Texts of any length are fingerprinted whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K, S = 5, 2
KEEP = 64
_WIDE = r"\p{IsIdeographic}\p{IsHiragana}\p{IsKatakana}"
PIECE = rf"[{_WIDE}]|[^\s{_WIDE}]{{1,24}}"
#: Sorts before all ids; stands for a null one.
_NO_ID = -(2**63)


def with_anchors(docs: DataFrame, text: str, name: str = "anchors", placed: str = "placed") -> DataFrame:
    """Adds the distinct anchor hashes of a text column, and under ``placed`` hashes of each with its piece number.

    Two texts share a placed one where they hold the same anchor at the same piece. Nothing is dropped.

    The steps are columns of their own, each read several times by the next, so that Catalyst keeps them apart and
    an array is made once a row.
    """
    at = F.lit(0)
    pieces = F.regexp_extract_all(F.coalesce(F.col(text).cast("string"), F.lit("")), F.lit(PIECE), at)
    first, last = F.lit(0), K - S
    inner = [lambda i, j=j: F.get("__inner", i + j) for j in range(last + 1)]
    return (
        docs.withColumn("__pieces", pieces)
        .withColumn("__n", F.size("__pieces"))
        .withColumn("__hashes", F.transform("__pieces", lambda p: F.xxhash64(p)))
        .withColumn(
            "__inner",
            F.when(
                F.col("__n") >= K,
                F.transform(
                    F.sequence(first, F.col("__n") - S),
                    lambda i: F.xxhash64(F.get("__hashes", i), F.get("__hashes", i + 1)),
                ),
            ),
        )
        .withColumn(
            "__chosen",
            F.when(
                F.col("__n") >= K,
                F.filter(
                    F.sequence(first, F.col("__n") - K),
                    lambda i: F.least(inner[0](i), inner[last](i)) <= F.least(*(f(i) for f in inner[1:last])),
                ),
            ),
        )
        .withColumn(
            name,
            F.when(F.col("__n") == 0, F.array().cast("array<bigint>"))
            .when(
                F.coalesce(F.size("__chosen"), F.lit(0)) > 0,
                F.array_distinct(
                    F.transform(
                        "__chosen",
                        lambda i: F.shiftrightunsigned(
                            F.xxhash64(F.get("__inner", i), F.get("__inner", i + 2), F.get("__hashes", i + K - 1)), 32
                        ),
                    )
                ),
            )
            .otherwise(F.array(F.shiftrightunsigned(F.xxhash64("__hashes"), 32))),
        )
        .withColumn(
            placed,
            F.transform(
                F.coalesce("__chosen", F.array().cast("array<int>")),
                lambda i: F.xxhash64(i, F.get("__inner", i), F.get("__inner", i + 2), F.get("__hashes", i + K - 1)),
            ),
        )
        .drop("__pieces", "__n", "__hashes", "__inner", "__chosen")
    )


def anchor_positions(docs: DataFrame, text: str = "text") -> DataFrame:
    """For positional matching: ``doc_id``, ``hash`` and ``position`` (piece number) of each anchor."""
    pieces = F.regexp_extract_all(F.coalesce(F.col(text).cast("string"), F.lit("")), F.lit(PIECE), F.lit(0))
    hashed = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.transform(pieces, lambda p: F.xxhash64(p)).alias("h")
    ).filter(F.size("h") >= K)
    mers = hashed.select("doc_id", F.posexplode(_windows("h")).alias("position", "mer"))
    inner = [F.xxhash64(*(F.get("mer", F.lit(j + k)) for k in range(S))) for j in range(K - S + 1)]
    code = F.shiftrightunsigned(F.xxhash64(inner[0], inner[2], F.get("mer", F.lit(K - 1))), 32)
    return mers.filter(F.least(inner[0], inner[-1]) <= F.least(*inner[1:-1])).select(
        "doc_id", code.alias("hash"), "position"
    )


def _windows(hashes: str) -> Column:
    return F.transform(F.sequence(F.lit(0), F.size(hashes) - K), lambda i: F.slice(hashes, i + 1, K))


def sketch(anchors: str) -> Column:
    return F.slice(F.array_sort(anchors), 1, KEEP)


def printed(kept: str) -> Column:
    """The fingerprint as text: eight hexadecimal digits for each hash."""
    return F.array_join(F.transform(kept, lambda x: F.lower(F.lpad(F.hex(x), 8, "0"))), "")


def likeness(a: str, b: str) -> Column:
    least = F.slice(F.array_sort(F.array_union(a, b)), 1, KEEP)
    shared = F.size(F.array_intersect(F.array_intersect(a, b), least))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(
        F.try_divide(shared.cast("double"), F.size(least).cast("double"))
    )


def _bounds(ids: DataFrame, parts: int) -> tuple[int | None, list[int]]:
    """The least id, and ids that cut all rows in about equal parts: ``parts`` numbers at most."""
    cuts = [k / parts for k in range(1, parts)] or [0.5]
    row = ids.agg(F.min("key"), F.percentile_approx("key", cuts, 10 * parts)).first()
    return row[0], sorted(set(row[1] or []) - {row[0]})


def with_next(docs: DataFrame, text: str = "text", parts: int | None = None) -> DataFrame:
    """Adds to each text its fingerprint and the text and fingerprint of the next document by ascending doc_id.

    Rows are dealt by ranges of ids, and the first row of a range also visits the one before it, the very first the last.
    So the order is found within ranges, with one shuffle of the texts. Rows with a null doc_id come first; rows that
    repeat a doc_id follow each other by text.
    """
    parts = parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_NO_ID))
    first, bounds = _bounds(docs.select(key.alias("key")), parts)
    cuts = F.array(*(F.lit(b).cast("bigint") for b in bounds)).cast("array<bigint>")
    home = F.size(F.filter(cuts, lambda b: b <= F.col("key")))
    visits = (
        F.when(F.col("key") == F.lit(first), F.lit(len(bounds)))
        .when(F.array_contains(cuts, F.col("key")), F.col("home") - 1)
        .otherwise(F.lit(None).cast("int"))
    )
    places = F.array(
        F.struct(F.col("home").alias("range"), F.lit(False).alias("guest")),
        F.struct(F.col("visits").alias("range"), F.lit(True).alias("guest")),
    )
    dealt = (
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), key.alias("key"), F.col(text).alias("text"))
        .withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit("")))
        .withColumn("home", home)
        .withColumn("visits", visits)
        .select("doc_id", "key", "text", F.explode(places).alias("at"))
        .filter("at.range IS NOT NULL")
        .select("doc_id", "key", "text", F.col("at.range").alias("range"), F.col("at.guest").alias("guest"))
        .repartitionByRange(parts, "range")  # by hash, several ranges would fall together and other tasks stay empty
    )
    order = Window.partitionBy("range").orderBy("guest", "key", "text")
    kept = with_anchors(dealt, "text").withColumn("kept", sketch("anchors")).withColumn("n_anchors", F.size("anchors")).drop("anchors")
    return (
        kept.withColumn("next_text", F.lead("text").over(order))
        .withColumn("next_kept", F.lead("kept").over(order))
        .filter(~F.col("guest"))
        .select("doc_id", "text", "kept", "placed", "n_anchors", "next_text", "next_kept")
    )


def compared(docs: DataFrame, text: str = "text") -> DataFrame:
    """Each document's fingerprint beside that of its edited text and that of the next document, as registered.

    The edited text has its last half replaced by as many of the next document's first characters, or all of them.
    ``n_anchors`` counts the text's distinct anchors, whole, and ``placed_edited`` the anchors that the edited text holds at
    the same piece. The likenesses are estimates from at most 64 hashes, with a standard error of 0.06 at most.
    """
    rows = with_next(docs, text).withColumn("n_chars", F.char_length("text").cast("bigint"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - half),
        F.substring(F.col("next_text"), F.lit(1), half),
    )
    rows = rows.withColumn("edited", edited).drop("text", "next_text")
    rows = rows.withColumn("edited_sha256", F.sha2("edited", 256))
    rows = with_anchors(rows, "edited", "edited_anchors", "edited_placed").withColumn("edited_kept", sketch("edited_anchors"))
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        printed("kept").alias("fingerprint"),
        printed("edited_kept").alias("edited_fingerprint"),
        likeness("kept", "edited_kept").alias("near_edited"),
        likeness("kept", "next_kept").alias("near_next"),
        F.col("n_anchors").cast("bigint").alias("n_anchors"),
        F.size(F.array_intersect("placed", "edited_placed")).cast("bigint").alias("placed_edited"),
    )
