"""Refreshing the layered tables: everything, a set of years, or what changed."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from contextlib import ExitStack
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcstrata.operators import quality
from cdcstrata.operators.predicates import FIRST_YEAR, changed_since, signed
from cdcstrata.plans import deltas, gold, silver
from cdcstrata.sources import pending, writers
from cdcstrata.sources.scratch import materialise


@dataclass(frozen=True)
class Bronze:
    """The change logs a refresh starts from."""

    reports: DataFrame
    requests: DataFrame
    companies: DataFrame | None = None


def refresh_tables(
    bronze: Bronze,
    save: Callable[[DataFrame, str], DataFrame],
    start_year: int | None = FIRST_YEAR,
    cert_fallback: int = 3,
    marts: Sequence[str] = (*gold.MARTS, "export_by_country"),
) -> dict[str, DataFrame]:
    """Build silver once, resolve certificates once, then project the marts from what was written.

    ``marts`` names those that are wanted. ``save(df, name)`` writes a table and returns it as read back; every mart reads that copy, so the logs
    are scanned and parsed once however many marts there are. Marts write with their load time.
    """
    reports = save(silver.silver_reports(bronze.reports, "masked_first", start_year=start_year), "silver_reports")
    participants = save(silver.silver_participants(bronze.requests), "silver_participants")
    out = {"silver_reports": reports, "silver_participants": participants}
    if bronze.companies is not None:
        out["silver_companies"] = save(silver.silver_companies(bronze.companies), "silver_companies")
    if not marts:
        return out
    resolved = save(
        gold.certificate_for(
            signed(reports),
            participants if cert_fallback >= 2 else None,
            bronze.requests if cert_fallback == 3 else None,
            check_unique=True,
        ),
        "report_certificates",
    )
    for name, mart in gold.MARTS.items():
        if name in marts:
            out[name] = save(mart(resolved), name)
    if "export_by_country" in marts:
        by_country = gold.export_by_country(resolved, bronze.reports, start_year=start_year)
        out["export_by_country"] = save(by_country, "export_by_country")
    return out


def to_scratch(df: DataFrame, name: str) -> DataFrame:
    """Save for trial runs: a scratch copy partitioned by year where there is one."""
    return materialise(df, name, ["year"] if "year" in df.columns else None)


def counted(save: Callable[[DataFrame, str], DataFrame], rows: quality.WrittenRows) -> Callable[[DataFrame, str], DataFrame]:
    """The same way of saving, each table counted as it is written."""
    return lambda df, name: save(rows.of(df, name), name)


def to_catalog(
    database: str, fmt: str = "parquet", counts: quality.WrittenRows | None = None
) -> Callable[[DataFrame, str], DataFrame]:
    """Save as catalog tables partitioned by year, load time added, and with ``counts`` counted as they are written."""

    def save(df: DataFrame, name: str) -> DataFrame:
        table = f"{database}.{name}"
        parts = ["year"] if "year" in df.columns else []
        rows = writers.with_load_time(df)
        if parts:
            rows = writers.clustered(rows, parts)
        if counts is not None:
            rows = counts.of(rows, name)
        writers.create_or_replace(rows, table, fmt, partition_by=parts)
        return df.sparkSession.table(table).drop("etl_loaded_at")

    return save


def refresh(
    spark: SparkSession,
    build: Callable[[DataFrame], DataFrame],
    log: DataFrame,
    table: str,
    mode: str = "full",
    *,
    years: Sequence[int] | None = None,
    since: str | None = None,
    keys: Mapping[str, str] | Sequence[str] = ("service_request_id", "report_type", "year"),
    entity: str = "id",
    changed_by: str = "updated_at",
    fmt: str = "parquet",
    summaries: Mapping[str, deltas.Additive] | None = None,
) -> None:
    """Refresh one table, partitioned by year, that ``build`` makes from a change log, and the summaries of it.

    ``full`` replaces the table. ``years`` replaces the partitions of those years. ``incremental`` takes the entities
    that changed from ``since`` on and rebuilds every key that any of their versions ever had; ``keys`` names what
    the table has one row of, as log column -> table column where they differ (``{"id": "report_id"}`` for the canonical
    table). Rebuilding reads all versions of those keys, so late and out-of-order versions resolve as in a full
    run. The keys' old rows are taken out wherever they were, so a row whose year or key moved leaves nothing behind, and
    a key whose newest version is a delete is gone. NULL is a key like any other. Of the table, only years that a
    version of such a key ever had are read.

    ``summaries`` (table -> what it sums) follow the table: a full refresh builds them from it, the other modes give them
    the signed contributions of the rows that left and came. Table and summaries change by one written plan, so a run
    that is cut off is brought to its end by the next one, and nothing is counted twice.
    """
    summaries = summaries or {}
    pending.resume(spark, table)
    if mode == "full":
        writers.create_or_replace(build(log), table, fmt, partition_by=["year"])
        for name, spec in summaries.items():
            _build_summary(spark, name, spec, spark.table(table), fmt)
    elif mode == "years" and not summaries:
        writers.refresh_years(build, log, table, years, fmt)
    elif mode == "years":
        wanted = list(dict.fromkeys(years))
        with writers.staged(deltas.of_years(build(deltas.of_years(log, wanted)), wanted), "years") as rows:
            old = deltas.of_years(spark.table(table), wanted)
            hit = spark.createDataFrame([(y,) for y in wanted], "year int")
            _replace(spark, table, old, rows, rows, hit, fmt, summaries)
    elif mode == "incremental":
        if since is None:
            raise ValueError("incremental refresh needs the moment to start from")
        named = dict(keys) if isinstance(keys, Mapping) else {k: k for k in keys}
        changed = changed_since(log, since, changed_by).select(entity).distinct()
        touched = _matching(log, changed, {entity: entity}).select(*named).distinct()
        with writers.staged(touched, "touched") as touched:
            versions = _matching(log, touched, {k: k for k in named})
            by_table = {t: k for k, t in named.items()}
            seen = [r["year"] for r in versions.select("year").distinct().collect()]  # a few years
            near = deltas.of_years(spark.table(table), seen)
            with writers.staged(build(versions).select(*near.columns), "rebuilt") as rebuilt:
                old = _matching(near, touched, by_table)
                with writers.staged(old.select("year").unionByName(rebuilt.select("year")).distinct(), "years") as hit:
                    kept = deltas.of_years(near, [r["year"] for r in hit.collect()])
                    rows = _matching(kept, touched, by_table, "left_anti").unionByName(rebuilt)
                    _replace(spark, table, old, rebuilt, rows, hit, fmt, summaries)
    else:
        raise ValueError(f"mode must be 'full', 'years' or 'incremental', not {mode!r}")


def _replace(
    spark: SparkSession,
    table: str,
    old: DataFrame,
    new: DataFrame,
    rows: DataFrame,
    hit: DataFrame,
    fmt: str,
    summaries: Mapping[str, deltas.Additive],
) -> None:
    """Put ``rows`` into the table's partitions ``hit``, and what ``new`` has over ``old`` into the summaries."""
    swaps = [pending.Swap(table, rows, hit, fmt)]
    with ExitStack() as open_copies:
        for name, spec in summaries.items():
            delta = open_copies.enter_context(writers.staged(spec.delta(old, new), "delta"))
            swaps += deltas.swaps(spark, name, spec, delta)
        pending.swap_all(spark, table, swaps)


def _build_summary(spark: SparkSession, name: str, spec: deltas.Additive, rows: DataFrame, fmt: str) -> None:
    writers.create_or_replace(spec.full(rows), name, fmt, partition_by=["year"])
    for other, roll in spec.rollups.items():
        writers.create_or_replace(roll(spark.table(name)), other, fmt, partition_by=["year"])


def _matching(rows: DataFrame, keys: DataFrame, columns: Mapping[str, str], how: str = "left_semi") -> DataFrame:
    """Rows whose columns are among the keys (row column -> key column), NULL equal to NULL."""
    same = [F.col(f"r.{r}").eqNullSafe(F.col(f"k.{k}")) for r, k in columns.items()]
    return rows.alias("r").join(keys.alias("k"), same, how)
