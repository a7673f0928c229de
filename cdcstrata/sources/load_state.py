"""What a source was loaded up to: a table of high-water marks, each written after the data it stands for.

A load reads the mark of its entity, takes what changed since, writes it, and then commits the new mark with the id of its run.
A load that is cut off before the commit leaves the old mark, so the next one reads the same changes again; what it had
written already must be taken out or overwritten then, by key. A commit appends one row and so is there or not.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from cdcstrata.sources import writers

SCHEMA = "entity string, mark bigint, run_id string, committed_at timestamp"


@dataclass(frozen=True)
class LoadState:
    """Marks in epoch seconds, in one table for all entities."""

    spark: SparkSession
    table: str = "load_state"

    def _rows(self, entity: str):
        if not self.spark.catalog.tableExists(self.table):
            writers.create_or_replace(self.spark.createDataFrame([], SCHEMA), self.table)
        return self.spark.table(self.table).filter(F.col("entity") == entity)

    def mark(self, entity: str) -> int | None:
        """The greatest committed mark, None before the first load."""
        return self._rows(entity).agg(F.max("mark")).first()[0]

    def is_done(self, entity: str, run_id: str) -> bool:
        return not self._rows(entity).filter(F.col("run_id") == run_id).isEmpty()

    def commit(self, entity: str, mark: int | None, run_id: str) -> None:
        row = self.spark.createDataFrame([(entity, mark, run_id)], "entity string, mark bigint, run_id string")
        self._rows(entity)
        writers.append(row.withColumn("committed_at", F.current_timestamp()).coalesce(1), self.table)
