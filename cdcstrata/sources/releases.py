"""Several tables refreshed as one: readers see the old state of all of them or the new state of all.

Each table keeps the rows of a run in partitions of that run, in a table beside the name that readers use. What readers
use is a view on the rows of the run that was released last. Which one that is stands in one place for all tables, the
journal, as one row that is appended when every table of the run is filled; there is no moment between two tables. The
journal also has what each run filled, so a run that is cut off goes on from there. A fill replaces its own partitions
and can be repeated.

Sessions that keep file lists of their own see a release after ``REFRESH TABLE`` on the journal.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcstrata.sources import writers

_JOURNAL = "seq bigint, run_id string, step string, table_name string, at timestamp"
RUN = "release_run"


@dataclass(frozen=True)
class Releases:
    """Runs over a fixed set of tables. ``name`` is that of the journal; ``partition_by`` is each table's own, if any."""

    spark: SparkSession
    name: str
    partition_by: Mapping[str, Sequence[str]]
    fmt: str = "parquet"

    def rows_of(self, table: str) -> str:
        """Where the rows of all runs of a table lie."""
        return f"{table}__runs"

    def journal(self) -> DataFrame:
        if not self.spark.catalog.tableExists(self.name):
            writers.create_or_replace(self.spark.createDataFrame([], _JOURNAL), self.name, self.fmt)
        return self.spark.table(self.name)

    def _note(self, run_id: str, step: str, table: str | None = None) -> None:
        """Append one row, which is there or is not."""
        seq = (self.journal().agg(F.max("seq")).first()[0] or 0) + 1
        row = self.spark.createDataFrame([(seq, run_id, step, table)], "seq bigint, run_id string, step string, table_name string")
        writers.append(row.withColumn("at", F.current_timestamp()).coalesce(1), self.name, self.fmt)

    def _runs(self, step: str) -> list[str]:
        return [r["run_id"] for r in self.journal().filter(F.col("step") == step).orderBy("seq").collect()]

    @property
    def released(self) -> str | None:
        """The run that readers see."""
        return (self._runs("released") or [None])[-1]

    def open_run(self) -> str | None:
        """The run that was begun last and is not released."""
        done, begun = set(self._runs("released")), self._runs("begun")
        return begun[-1] if begun and begun[-1] not in done else None

    def refresh(self, run_id: str, build: Mapping[str, Callable[[Callable[[str], DataFrame]], DataFrame]]) -> str:
        """Fill every table and release them; goes on with an open run, whose id it then returns in place of ``run_id``.

        ``build`` has a function for each table, in order; what it is called with gives the rows of this run of a table
        filled before. A table that the journal has as filled is left as it is.
        """
        if set(build) != set(self.partition_by):
            raise ValueError("a release is of all its tables")
        if (left := self.open_run()) is not None:
            run_id = left
        elif run_id in self._runs("begun"):
            return run_id
        else:
            self._note(run_id, "begun")
        filled = {
            r["table_name"] for r in self.journal().filter((F.col("run_id") == run_id) & (F.col("step") == "filled")).collect()
        }
        for table, make in build.items():
            if table not in filled:
                self._fill(run_id, table, make(lambda name: self.of_run(name, run_id)))
                self._note(run_id, "filled", table)
        for table in build:
            self._view(table)
        self._note(run_id, "released")
        return run_id

    def of_run(self, table: str, run_id: str) -> DataFrame:
        return self.spark.table(self.rows_of(table)).filter(F.col(RUN) == run_id).drop(RUN)

    def _fill(self, run_id: str, table: str, rows: DataFrame) -> None:
        target, parts = self.rows_of(table), [RUN, *self.partition_by[table]]
        if not self.spark.catalog.tableExists(target):
            empty = self.spark.createDataFrame([], rows.schema).withColumn(RUN, F.lit(run_id))
            writers.create_or_replace(empty, target, self.fmt, partition_by=parts)
        with writers.staged(rows.withColumn(RUN, F.lit(run_id)), "release") as staged:
            # A repeated fill may have fewer partitions than the one that was cut off.
            hit = self.spark.createDataFrame([(run_id,)], f"{RUN} string")
            old = self.spark.table(target).filter(F.col(RUN) == run_id).select(*parts).distinct()
            writers.swap_partitions(self.spark, target, staged, old if self.partition_by[table] else hit, self.fmt)

    def _view(self, table: str) -> None:
        """A view on the rows of the run that the journal has as released last. It stays the same from run to run."""
        columns = [c for c in self.spark.table(self.rows_of(table)).columns if c != RUN]
        listed = ", ".join(f"`{c}`" for c in columns)
        last = f"SELECT max_by(run_id, seq) FROM {self.name} WHERE step = 'released'"
        text = f"SELECT {listed} FROM {self.rows_of(table)} WHERE {RUN} = ({last})"
        if not self.spark.catalog.tableExists(table):
            self.spark.sql(f"CREATE VIEW {table} AS {text}")
        elif self.spark.table(table).columns != columns:
            self.spark.sql(f"ALTER VIEW {table} AS {text}")

    def drop_old(self, keep: int = 2) -> None:
        """Delete the rows of all but the last released runs. Call it when nobody reads an older one any more."""
        done = self._runs("released")
        stale = [r for r in self._runs("begun") if r not in done[-keep:] and r != self.open_run()]
        for table, parts in self.partition_by.items():
            gone = self.spark.table(self.rows_of(table)).filter(F.col(RUN).isin(*stale)).select(RUN, *parts)
            writers.drop_partitions(self.spark, self.rows_of(table), gone, self.fmt)

    def drop(self) -> None:
        """Views, rows and journal."""
        for table in self.partition_by:
            self.spark.sql(f"DROP VIEW IF EXISTS {table}")
            self.spark.sql(f"DROP TABLE IF EXISTS {self.rows_of(table)}")
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
