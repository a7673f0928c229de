"""Resolving a change log: latest version per key, stitching, replays and duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cdcstrata.operators.predicates import DELETE, has_payload, not_deleted

_RANK = "__version_rank"


def _op_order() -> Column:
    """Life-cycle order of operations, for versions that carry the same timestamp."""
    return (
        F.when(F.col("op") == DELETE, 3)
        .when(F.col("op") == "u", 2)
        .when(F.col("op") == "c", 1)
        .otherwise(0)
    )


def _newest_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> list[Column]:
    """The wanted order, then ties: the other change time, the entity id, the operation."""
    columns = df.columns
    ties = [c for c in ("updated_ts", "updated_at", "id") if c in columns and c not in (*order_by, *keys)]
    order = [F.col(c).desc_nulls_last() for c in (*order_by, *ties)]
    return [*order, _op_order().desc()] if "op" in columns else order


def latest(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] = ("updated_ts",),
    *,
    tombstones: str | None = "after",
    require_payload: bool = False,
    payload: str = "data",
) -> DataFrame:
    """Newest version of every key.

    ``tombstones="after"`` ranks first and then drops keys whose newest version is a delete;
    ``"before"`` drops deletes first, so the version before a delete comes back; ``"keep"`` leaves
    deletes in. ``require_payload`` passes over versions without payload, but never over deletes
    (they carry none, and skipping them would bring the row back).

    Spark turns rank-and-keep-first into a group limit on both sides of the one exchange: every map
    task ships at most one row per key, so a key that holds a third of the log is not a hot spot.
    """
    if tombstones not in ("after", "before", "keep"):
        raise ValueError(f"tombstones must be 'after', 'before' or 'keep', not {tombstones!r}")
    if tombstones == "before":
        df = not_deleted(df)
    if require_payload:
        df = df.filter(has_payload(payload) | (F.col("op") == DELETE))
    newest = Window.partitionBy(*keys).orderBy(*_newest_first(df, keys, order_by))
    out = df.withColumn(_RANK, F.row_number().over(newest)).filter(F.col(_RANK) == 1)
    if tombstones == "after":
        out = not_deleted(out)
    return out.drop(_RANK)


def stitch_versions(
    cdc: DataFrame,
    keys: Sequence[str] = ("id",),
    order_by: Sequence[str] = ("updated_ts",),
    *,
    snapshot_ops: Sequence[str] = ("r",),
    update_ops: Sequence[str] = ("u",),
    payload: str = "data",
    snapshot_columns: Sequence[str] | None = None,
    update_columns: Sequence[str] | None = None,
    tombstones: str = "before",
) -> DataFrame:
    """One row per key with two structs: ``snapshot`` (newest with payload) and ``update`` (newest).

    ``update`` is NULL where there was none; keys without a snapshot vanish. Name the columns that each side
    needs: structs are not pruned, and what is left out is not shipped. By default the snapshot has all and the
    update all but the payload. ``tombstones="after"`` drops keys whose newest version is a delete,
    ``"before"`` passes over deletes.

    Versions of one time are told apart by the other change time, the operation, the version label and a
    hash of the whole row, so the outcome does not hang on the order of the input. Both structs come out of one
    scan and one exchange, and partial aggregation leaves one row per key and map task to ship.
    """
    if tombstones not in ("after", "before"):
        raise ValueError(f"tombstones must be 'after' or 'before', not {tombstones!r}")
    is_snapshot = F.col("op").isin(*snapshot_ops) & has_payload(payload)
    is_update = F.col("op").isin(*update_ops)
    columns = cdc.columns
    rest = [c for c in columns if c not in keys]
    ties = [F.col(c) for c in ("updated_at",) if c in columns and c not in order_by]
    label = [F.col("version")] if "version" in columns else []
    age = F.struct(*[F.col(c) for c in order_by], *ties, _op_order(), *label, F.xxhash64(*sorted(rest)))

    snapshot = list(rest if snapshot_columns is None else snapshot_columns)
    update = list([c for c in rest if c != payload] if update_columns is None else update_columns)
    # What is compared is made ahead of the aggregate, which sorts its rows: so they come without the texts.
    shipped = list(dict.fromkeys([*keys, *snapshot, *update]))
    flags = [is_snapshot.alias("__snapshot"), is_update.alias("__update"), (F.col("op") == DELETE).alias("__delete")]
    made = cdc.select(*shipped, *flags, age.alias("__age"))

    def newest(flag: str, columns: list[str], name: str) -> Column:
        return F.max_by(F.struct(*columns), F.when(F.col(flag), F.col("__age"))).alias(name)

    sides = [newest("__snapshot", snapshot, "snapshot"), newest("__update", update, "update")]
    if tombstones == "before":
        out = made.filter("__snapshot OR __update").groupBy(*keys).agg(*sides)
    else:
        last = F.max_by(F.col("__delete"), F.col("__age")).alias("__deleted")
        out = made.filter("__snapshot OR __update OR __delete").groupBy(*keys).agg(*sides, last)
        out = out.filter(~F.col("__deleted")).drop("__deleted")
    return out.filter(F.col("snapshot").isNotNull())


def drop_replays(cdc: DataFrame, keys: Sequence[str] = ("id", "updated_ts")) -> DataFrame:
    """Drop exact redeliveries of a change.

    Rows that agree on ``keys`` are the same change, so any of them will do. It is an aggregate, not a
    window: copies are folded on the map side.
    """
    return cdc.dropDuplicates(list(keys))


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count ``cnt``.

    The map side pre-counts; a window over the groups would ship every row.
    """
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt")).filter(F.col("cnt") > 1)


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys).distinct()
