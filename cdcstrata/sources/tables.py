"""Table definitions: column names, types, comments, partitioning, and the DDL made from them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql import types as T


@dataclass(frozen=True)
class TableSpec:
    """One table. Partition columns come last in the schema of file tables, so the DDL puts them there."""

    name: str
    schema: T.StructType
    partition_by: tuple[str, ...] = ()
    comment: str = ""
    fmt: str = "parquet"
    props: Mapping[str, str] = field(default_factory=dict)
    bucket_by: tuple[str, ...] = ()
    buckets: int = 0

    def ddl(self, if_not_exists: bool = False) -> str:
        def column(f: T.StructField) -> str:
            note = (f.metadata or {}).get("comment")
            return f"`{f.name}` {f.dataType.simpleString()}" + (f" COMMENT '{_quoted(note)}'" if note else "")

        fields = [f for f in self.schema if f.name not in self.partition_by]
        fields += [self.schema[c] for c in self.partition_by]
        parts = [
            f"CREATE TABLE {'IF NOT EXISTS ' if if_not_exists else ''}{self.name} (",
            ",\n".join("  " + column(f) for f in fields),
            f") USING {self.fmt}",
        ]
        if self.partition_by:
            parts.append(f"PARTITIONED BY ({', '.join(self.partition_by)})")
        if self.bucket_by:
            keys = ", ".join(f"`{c}`" for c in self.bucket_by)
            parts.append(f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {self.buckets} BUCKETS")
        if self.comment:
            parts.append(f"COMMENT '{_quoted(self.comment)}'")
        if self.props:
            pairs = ", ".join(f"'{k}' = '{_quoted(v)}'" for k, v in self.props.items())
            parts.append(f"TBLPROPERTIES ({pairs})")
        return "\n".join(parts)


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def create_table(spark: SparkSession, spec: TableSpec, if_not_exists: bool = True) -> None:
    spark.sql(spec.ddl(if_not_exists))


def spec_of(name: str, schema: T.StructType, **kwargs) -> TableSpec:
    """A definition for a computed result, with the audit column that writes add."""
    if "etl_loaded_at" not in schema.names:
        schema = T.StructType([*schema.fields, T.StructField("etl_loaded_at", T.TimestampType())])
    return TableSpec(name, schema, **kwargs)
