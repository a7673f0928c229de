"""Sources: catalog tables, Parquet paths, JDBC, parameterised SQL and rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcstrata.operators.numbering import numbered


def read_table(spark: SparkSession, name: str, schema: T.StructType | None = None) -> DataFrame:
    """A catalog table by one- to three-part name, or a Parquet folder where ``name`` holds a slash."""
    if "/" in name:
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(name)
    return spark.table(name)


@dataclass(frozen=True)
class JdbcPartitioning:
    """How to split a JDBC read: a numeric, date or timestamp column, its bounds and the task count."""

    column: str
    lower: str | int
    upper: str | int
    partitions: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.partitions),
        }


def jdbc_options(
    url: str, query: str, driver: str, partitioning: JdbcPartitioning | None = None, fetch_size: int = 10000
) -> dict[str, str]:
    """Reader options. Spark cannot split the ``query`` option, so a partitioned read wraps it as a table."""
    base = {"url": url, "driver": driver, "fetchsize": str(fetch_size)}
    if partitioning is None:
        return {**base, "query": query}
    return {**base, "dbtable": f"({query}) q", **partitioning.options()}


def read_jdbc(
    spark: SparkSession,
    url: str,
    query: str,
    driver: str,
    partitioning: JdbcPartitioning | None = None,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """Run a query in a remote database. Without ``partitioning`` the result comes over one connection."""
    options = {**jdbc_options(url, query, driver, partitioning), **(properties or {})}
    return spark.read.format("jdbc").options(**options).load()


def sql(spark: SparkSession, text: str, **params: Any) -> DataFrame:
    """SQL with named markers (``:year``); values are bound, never pasted into the text."""
    return spark.sql(text, args=params)


def from_rows(spark: SparkSession, rows: Sequence[Any], schema: T.StructType | str) -> DataFrame:
    """A handful of driver-side rows with an explicit schema. Bulk data belongs in :func:`read_jdbc`."""
    return spark.createDataFrame(rows, schema)


def read_csv_in_order(spark: SparkSession, path: str, schema: T.StructType, number: str = "line") -> DataFrame:
    """A folder of CSV files with headers, each row with its line number through all files, in the order of their names.

    A file is read in pieces, which carry where they begin; so the number follows from name, piece and place in it.
    """
    rows = spark.read.schema(schema).option("header", True).csv(path)
    placed = rows.select(
        *schema.names,
        F.col("_metadata.file_name").alias("__file"),
        F.col("_metadata.file_block_start").alias("__start"),
        F.monotonically_increasing_id().alias("__place"),
    )
    lined = numbered(placed, ["__file", "__start", "__place"], number)
    return lined.drop("__file", "__start", "__place")


def describe(spark: SparkSession, table: str) -> DataFrame:
    """(name, type, nullable, partition) of a table's columns."""
    cols = [(c.name, c.dataType, c.nullable, c.isPartition) for c in spark.catalog.listColumns(table)]
    return spark.createDataFrame(cols, "name string, type string, nullable boolean, partition boolean")


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    names = [(t.name, t.tableType, t.isTemporary) for t in spark.catalog.listTables(database)]
    return spark.createDataFrame(names, "name string, kind string, temporary boolean")
