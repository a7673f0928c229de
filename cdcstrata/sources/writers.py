"""Sinks and table maintenance.

Two families of tables are served. Formats with row-level operations (pass their name as ``fmt``) go
through ``writeTo`` and ``mergeInto``. Plain file formats go through ``saveAsTable``/``insertInto``, and
changes rewrite just the partitions they touch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcstrata.sources.scratch import TEXT, release, store

FILE_FORMATS = ("parquet", "orc")


def with_load_time(df: DataFrame, name: str = "etl_loaded_at") -> DataFrame:
    return df.withColumn(name, F.current_timestamp())


def write_jdbc(df: DataFrame, url: str, table: str, driver: str, mode: str = "overwrite", **options: str) -> None:
    """Write over JDBC, one connection per partition."""
    df.write.format("jdbc").options(url=url, dbtable=table, driver=driver, **options).mode(mode).save()


def create_or_replace(
    df: DataFrame,
    name: str,
    fmt: str = "parquet",
    props: Mapping[str, str] | None = None,
    partition_by: Sequence[str] = (),
) -> None:
    """Create the table or replace it whole, with its properties."""
    if fmt in FILE_FORMATS:
        writer = df.write.format(fmt).mode("overwrite").options(**(props or {}))
        (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(name)
        return
    target = df.writeTo(name).using(fmt)
    for key, value in (props or {}).items():
        target = target.tableProperty(key, value)
    if partition_by:
        target = target.partitionedBy(*[F.col(c) for c in partition_by])
    target.createOrReplace()


def write_bucketed(
    df: DataFrame, name: str, keys: Sequence[str], buckets: int, fmt: str = "parquet", partition_by: Sequence[str] = ()
) -> None:
    """Create or replace a file table whose rows lie in buckets by ``keys``, sorted in each.

    Tables with as many buckets on the same keys join without an exchange on either side. A bucket is written by one task, so
    it is a file (one a table partition), and takes all rows of its keys: choose the number so that one fits an
    executor, and bucket by a key that no large part of the rows shares, as a join of buckets cannot be split.
    """
    dealt = df.repartition(buckets, *keys)
    writer = dealt.write.format(fmt).mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(name)


def overwrite(df: DataFrame, name: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """Replace all rows of a table."""
    create_or_replace(df, name, fmt, partition_by=partition_by)


def append(df: DataFrame, name: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    writer = df.write.format(fmt).mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(name)


def full_refresh(df: DataFrame, spec, spark: SparkSession | None = None) -> None:
    """Rebuild a table from its definition, laid out as that says.

    A new table is filled under another name and takes the place of the old one at the end. So a frame that fails,
    or that reads the very table, leaves the old rows where they are.
    """
    session = spark or df.sparkSession
    fresh = f"{spec.name}__new"
    session.sql(f"DROP TABLE IF EXISTS {fresh}")
    session.sql(replace(spec, name=fresh).ddl())
    try:
        _overwrite_all(df, session, fresh)
    except BaseException:
        session.sql(f"DROP TABLE IF EXISTS {fresh}")
        raise
    session.sql(f"DROP TABLE IF EXISTS {spec.name}")
    session.sql(f"ALTER TABLE {fresh} RENAME TO {spec.name}")


@contextmanager
def _overwrite_mode(spark: SparkSession, mode: str) -> Iterator[None]:
    """Set the overwrite mode for one write; ``insertInto`` takes it from the session only."""
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, mode)
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def _overwrite_all(df: DataFrame, spark: SparkSession, name: str) -> None:
    """Static overwrite: partitions that no longer occur go away, whatever the session default is."""
    rows = _by_position(df, spark, name)
    with _overwrite_mode(spark, "static"):
        rows.write.insertInto(name, overwrite=True)


def _by_position(df: DataFrame, spark: SparkSession, table: str, laid_out: bool = False) -> DataFrame:
    """Columns in table order, since ``insertInto`` goes by position, clustered by table partition unless they are ``laid_out``."""
    columns = spark.catalog.listColumns(table)
    ordered = df.select(*[c.name for c in columns])
    parts = [c.name for c in columns if c.isPartition]
    return clustered(ordered, parts) if parts and not laid_out else ordered


def clustered(df: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Rows of a table partition together, so that a task does not open a file in every partition.

    It is a rebalance: AQE cuts a large partition into tasks of the advisory size and merges small ones,
    whatever the spread over the years.
    """
    return df.hint("rebalance", *parts)


def overwrite_partitions(df: DataFrame, name: str, fmt: str = "parquet", laid_out: bool = False) -> None:
    """Replace just the partitions that occur in ``df``; a rerun leaves the same table behind.

    Rows that are read from files which are partitioned like the table are ``laid_out`` and not shuffled again.
    """
    if fmt not in FILE_FORMATS:
        df.writeTo(name).overwritePartitions()
        return
    spark = df.sparkSession
    rows = _by_position(df, spark, name, laid_out)
    with _overwrite_mode(spark, "dynamic"):
        rows.write.insertInto(name, overwrite=True)


@contextmanager
def staged(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """The frame stored in shared scratch, to be swapped in from there; the copy goes when the swap is done.

    If the swap fails the copy stays, so that it can be run again.
    """
    path = store(df, name, **TEXT)
    yield df.sparkSession.read.schema(df.schema).parquet(path)
    release(df.sparkSession, path)


def swap_partitions(
    spark: SparkSession, name: str, rows: DataFrame, hit: DataFrame, fmt: str = "parquet", laid_out: bool = False
) -> None:
    """Replace the partitions listed in ``hit`` by ``rows``; those that no row is left for go away.

    ``hit`` has the table's partition columns; its distinct values, a few a partition column, reach the driver.
    """
    columns = hit.columns
    overwrite_partitions(rows, name, fmt, laid_out)
    left = rows.select(*columns).distinct().withColumn("__left", F.lit(True))
    same = [F.col(f"h.{c}").eqNullSafe(F.col(f"l.{c}")) for c in columns]
    gone = hit.distinct().alias("h").join(left.alias("l"), same, "left_anti")
    drop_partitions(spark, name, gone, fmt)


def drop_partitions(spark: SparkSession, name: str, gone: DataFrame, fmt: str = "parquet") -> None:
    """Drop the partitions listed in ``gone``, which has all partition columns; they reach the driver."""
    for row in gone.distinct().collect():
        if fmt in FILE_FORMATS:
            values = ", ".join(f"`{c}` = {_literal(row[c])}" for c in gone.columns)
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({values})")
        else:
            values = " AND ".join(f"`{c}` <=> {_literal(row[c])}" for c in gone.columns)
            spark.sql(f"DELETE FROM {name} WHERE {values}")


def _literal(value) -> str:
    if value is None:
        return "NULL"
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return text if isinstance(value, int) else f"'{text}'"


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def refresh_years(
    build: Callable[[DataFrame], DataFrame],
    source: DataFrame,
    name: str,
    years: Iterable[int] | None = None,
    fmt: str = "parquet",
) -> None:
    """Backfill any number of years in one job: one shuffle over all of them, partitions swapped at the end.

    A year that is asked for and has no row any more is emptied. Without ``years`` the whole table is replaced.
    """
    spark = source.sparkSession
    if years is None:
        with staged(build(source), "years") as rows:
            _overwrite_all(rows, spark, name) if fmt in FILE_FORMATS else rows.writeTo(name).overwrite(F.lit(True))
        return
    wanted = list(dict.fromkeys(years))
    with staged(build(source.filter(F.col("year").isin(*wanted))), "years") as rows:
        hit = spark.createDataFrame([(y,) for y in wanted], "year int")
        swap_partitions(spark, name, rows.filter(F.col("year").isin(*wanted)), hit, fmt)


def merged(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    newer_by: Sequence[str] = (),
) -> DataFrame:
    """Target with source rows put in by key, as MERGE (update all, insert all) leaves it.

    With ``newer_by`` the row with the larger value wins, so a late, older version does not undo a newer
    one; ties go to the source. One exchange: both sides are stacked and the better row per key kept,
    with partial aggregation, instead of an anti join plus union.
    """
    rank = F.struct(*[F.col(c) for c in newer_by], F.col("__from_source"))
    stacked = target.withColumn("__from_source", F.lit(0)).unionByName(source.withColumn("__from_source", F.lit(1)))
    rest = [c for c in target.columns if c not in keys]
    best = stacked.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("__row"))
    return best.select(*keys, "__row.*").select(*target.columns)


def upsert(
    spark: SparkSession,
    name: str,
    source: DataFrame,
    keys: Sequence[str],
    partition_by: Sequence[str] = (),
    newer_by: Sequence[str] = (),
    fmt: str = "parquet",
) -> None:
    """MERGE ``source`` into a table on ``keys``; source keys must be unique.

    File tables: with ``partition_by``, partition columns that are part of the key, only partitions that occur in the
    source are read and rewritten. Of another partitioned table those are rewritten that hold a key of the source, or
    take one; to find them, its keys are read and nothing else, and a row that moved leaves nothing behind. The merged
    rows are first written to shared scratch and swapped in from there: if the swap is cut off, running it again from
    the scratch copy mends it.
    """
    if fmt not in FILE_FORMATS:
        on = " AND ".join(f"t.`{k}` <=> s.`{k}`" for k in keys)
        newer = None
        if newer_by:
            newer = F.struct(*[F.col(f"s.{c}") for c in newer_by]) >= F.struct(*[F.col(f"t.{c}") for c in newer_by])
        merge = source.alias("s").mergeInto(f"{name} AS t", F.expr(on))
        (merge.whenMatched(newer) if newer is not None else merge.whenMatched()).updateAll().whenNotMatched().insertAll().merge()
        return
    if not set(partition_by) <= set(keys):
        raise ValueError("partition columns must be part of the key, or a moved row would stay behind")
    target = spark.table(name)
    parts = partition_columns(spark, name)
    if parts and not partition_by:
        _upsert_where_keys_lie(spark, name, source, keys, newer_by, parts, fmt)
        return
    if partition_by:
        touched = source.select(*partition_by).distinct()
        target = target.join(touched, list(partition_by), "left_semi")
    with staged(merged(target, source, keys, newer_by), "upsert") as rows:
        if partition_by:
            overwrite_partitions(rows, name, fmt)
        else:
            _overwrite_all(rows, spark, name)


def _upsert_where_keys_lie(
    spark: SparkSession,
    name: str,
    source: DataFrame,
    keys: Sequence[str],
    newer_by: Sequence[str],
    parts: Sequence[str],
    fmt: str,
) -> None:
    """The partitions that hold a key of the source, joined by the source's own, are merged as one and replaced."""
    target = spark.table(name)
    with staged(source.select(*target.columns), "upsert-source") as source:
        held = _among(target.select(*keys, *parts), source.select(*keys), keys).select(*parts)
        with staged(held.unionByName(source.select(*parts)).distinct(), "upsert-partitions") as hit:
            near = _among(target, hit, parts)
            with staged(merged(near, source, keys, newer_by), "upsert") as rows:
                swap_partitions(spark, name, rows, hit, fmt)


def _among(rows: DataFrame, others: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows whose columns are those of one of the others, NULL equal to NULL."""
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"o.{c}")) for c in columns]
    return rows.alias("r").join(others.alias("o"), same, "left_semi")


def delete_where(spark: SparkSession, name: str, predicate: str, fmt: str = "parquet") -> None:
    """Delete the rows an SQL predicate matches; a predicate that is NULL keeps the row.

    File tables: only the partitions that hold a matching row are rewritten, by way of shared scratch.
    """
    if fmt not in FILE_FORMATS:
        spark.sql(f"DELETE FROM {name} WHERE {predicate}")
        return
    matches = F.coalesce(F.expr(predicate), F.lit(False))
    table, parts = spark.table(name), partition_columns(spark, name)
    if not parts:
        with staged(table.filter(~matches), "delete") as rows:
            _overwrite_all(rows, spark, name)
        return
    with staged(table.filter(matches).select(*parts).distinct(), "delete-partitions") as hit:
        same = [F.col(f"t.{c}").eqNullSafe(F.col(f"h.{c}")) for c in parts]
        keep = table.filter(~matches).alias("t").join(hit.alias("h"), same, "left_semi")
        with staged(keep, "delete") as rows:
            swap_partitions(spark, name, rows, hit, fmt)


def truncate(spark: SparkSession, name: str) -> None:
    spark.sql(f"TRUNCATE TABLE {name}")


def export_csv(
    df: DataFrame,
    path: str,
    order: Sequence[Column | str] = (),
    files: int | None = None,
) -> None:
    """CSV folder with headers, UTF-8. With ``order`` the part files are globally sorted, in name order.

    ``files`` caps the number of part files. One file means one task, so ask for that just where the
    result is known to be small (a summary, one company).
    """
    out = df.orderBy(*order) if order else df
    if files is not None:
        out = out.coalesce(files)
    out.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """First n rows, for a dry run. Spark stops scanning once it has them."""
    return df.limit(n)
