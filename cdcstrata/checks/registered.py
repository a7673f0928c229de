"""The registered queries: every operator over logs derived from the whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcstrata.checks.bronze import Tables, tables
from cdcstrata.checks.rules import START_YEAR
from cdcstrata.functions.payload import json_str, parse_payload, parse_variant
from cdcstrata.functions.periods import days_before, previous_quarter
from cdcstrata.functions.scalars import labelled_digits
from cdcstrata.operators import aggregates, bitmaps, predicates, quality, versions
from cdcstrata.plans import bi, crm, deltas, fields, gold, refresh, registry, silver, summary, visits
from cdcstrata.sources import readers, releases, writers
from cdcstrata.sources.load_state import LoadState
from cdcstrata.sources.scratch import TEXT, materialise, release, scratch_path
from cdcstrata.sources.tables import TableSpec, create_table
from cdcstrata.streaming import changes

Build = Callable[[Tables], DataFrame]


class _CutShort(LoadState):
    """Marks that are not committed, as when a run ends between its data and its last mark."""

    class Cut(Exception):
        pass

    def commit(self, entity: str, mark: int | None, run_id: str) -> None:
        if entity in ("leads", "events"):
            raise self.Cut
        super().commit(entity, mark, run_id)


TIN = "777777000007"  # the company that the one-company report is about
NATURAL = list(silver.NATURAL_KEY)


# Payload fields that the checks of the version operators carry along, as the report table types them.
CARRIED = ("company_tin", "certificate_number", "residents_count", "income_total")


def _cut(log: DataFrame, *more: str) -> DataFrame:
    """The log with the carried fields in place of payload and signature, so that ranking ships no text."""
    parsed = parse_payload(log, CARRIED)
    columns = ("id", "service_request_id", "year", "report_type", "status", "op", "updated_ts", "updated_at", *more)
    has_data = F.coalesce(predicates.has_payload("data"), F.lit(False)).alias("has_data")
    return parsed.select(*columns, has_data, *[fields.typed("doc", c).alias(c) for c in CARRIED])


def _carried(df: DataFrame) -> DataFrame:
    return df.select("id", "service_request_id", "year", "report_type", "status", "op", "updated_ts", "has_data", *CARRIED)


def _silver(t: Tables, identity: str = "masked_first", **options) -> DataFrame:
    return silver.silver_reports(t.report_cdc(), identity, start_year=START_YEAR, **options)


def _participants(t: Tables) -> DataFrame:
    return silver.silver_participants(t.request_cdc)


def _mart(name: str, level: int = 3, **options) -> Build:
    return lambda t: gold.MARTS[name](
        _silver(t, columns=gold.NEEDED[name]), _participants(t), t.request_cdc, level, **options
    )


def _resolved(t: Tables, *marts: str) -> DataFrame:
    """Signed reports with their certificates, as far as the named marts read them."""
    reports = _silver(t, columns=gold.needed_by(*marts))
    return gold.certificate_for(predicates.signed(reports), _participants(t), t.request_cdc)


def _marts(t: Tables, *names: str) -> list[DataFrame]:
    """Marts of one plan; Spark reuses the exchange that the shared rows come out of."""
    rows = _resolved(t, *names)
    return [gold.MARTS[name](rows) for name in names]


def _export_by_country(t: Tables, reports: DataFrame | None = None) -> DataFrame:
    """Reports may come with their certificates resolved already."""
    log = t.report_cdc(exports=True)
    if reports is not None:
        return gold.export_by_country(reports, log, start_year=START_YEAR)
    return gold.export_by_country(_silver(t, columns=("certificate_number",)), log, _participants(t), t.request_cdc, start_year=START_YEAR)


def _export_stitched(t: Tables) -> DataFrame:
    rows = silver.silver_reports(
        t.report_cdc(exports=True),
        start_year=START_YEAR,
        columns=("certificate_number", fields.EXPORT_CURRENT),
    )
    return gold.export_by_country_stitched(rows, _participants(t), t.request_cdc)


def _registry(name: str, **options) -> Build:
    def build(t: Tables) -> DataFrame:
        return registry.run_registry(name, t.service_report(name), t.service_request, t.company, t.hub_form, **options)

    return build


def _registry_summary(t: Tables) -> DataFrame:
    return registry.run_registry("summary", t.service_report(), t.service_request, t.company, year=1998)


def _versions() -> dict[str, Build]:
    def replayed(t: Tables) -> DataFrame:
        log = _cut(t.report_cdc())
        return _carried(versions.drop_replays(log.unionByName(log), ("id", "updated_ts", "op")))

    def stitched(t: Tables) -> DataFrame:
        log = t.report_cdc().withColumn("update_name", json_str("signature", "full_name"))
        log = parse_payload(log, CARRIED).select(
            "id", "op", "updated_ts", "updated_at", "data", "update_name", *[fields.typed("doc", c).alias(c) for c in CARRIED]
        )
        rows = versions.stitch_versions(
            log, snapshot_columns=("updated_ts", *CARRIED), update_columns=("updated_ts", "update_name")
        )
        return rows.select(
            "id",
            F.col("snapshot.updated_ts").alias("snapshot_ts"),
            *[F.col(f"snapshot.{c}").alias(c) for c in CARRIED],
            F.col("update.updated_ts").alias("update_ts"),
            "update.update_name",
        )

    def percent(t: Tables) -> DataFrame:
        groups = t.report_cdc().groupBy("status", "report_type").agg(F.count(F.lit(1)).alias("cnt"))
        return aggregates.with_percent(groups)

    snapshots = ("r", "c")
    return {
        "win_latest_by_id": lambda t: _carried(versions.latest(_cut(t.report_cdc()), ["id"])),
        "win_latest_by_natural_key": lambda t: _carried(
            versions.latest(_cut(t.report_cdc(), "data"), NATURAL, ["updated_at"], require_payload=True)
        ),
        "win_tombstone_before": lambda t: _carried(
            versions.latest(_cut(t.report_cdc()), NATURAL, ["updated_at"], tombstones="before")
        ),
        "win_tombstone_after": lambda t: _carried(versions.latest(_cut(t.report_cdc()), NATURAL, ["updated_at"])),
        "win_duplicate_groups": lambda t: versions.duplicate_groups(
            predicates.with_op(t.report_cdc(), *snapshots), NATURAL
        ),
        "win_distinct_keys": lambda t: versions.distinct_keys(t.report_cdc(), NATURAL),
        "win_percent_of_total": percent,
        "win_drop_replays": replayed,
        "win_stitch_versions": stitched,
    }


def _marked_up(log: DataFrame) -> DataFrame:
    """Signatures whose names hold an entity and whose company has attributes, one of them with an entity as well."""
    signed = F.replace("signature", F.lit("<company>"), F.lit(r'<company id=\"7\" kind=\"a&amp;b\">'))
    for name in ("Signed", "Masked"):
        signed = F.replace(signed, F.lit(f"<name>{name} "), F.lit(f"<name>{name} &amp; "))
    return log.withColumn("signature", signed)


def _silver_tables() -> dict[str, Build]:
    def variant(t: Tables) -> DataFrame:
        """The canonical table from a log stored with VARIANT payloads, every 31st snapshot's being cut off."""
        spoiled = F.when(F.expr("id % 31 = 0 AND op = 'r'"), F.substring("data", 1, 40)).otherwise(F.col("data"))
        log = t.report_cdc().withColumn("data", spoiled)
        return silver.silver_reports(materialise(parse_variant(log), "variant-log", **TEXT), start_year=START_YEAR)

    return {
        "silver_reports_basic": lambda t: silver.silver_reports_basic(t.report_cdc(), START_YEAR),
        "silver_reports_natural_key": lambda t: silver.silver_reports_natural_key(t.report_cdc(exports=True)),
        "silver_reports_data_first": lambda t: _silver(t, "data_first"),
        "silver_reports_data_first_payload": lambda t: _silver(
            t, "data_first", tombstones="after", require_payload=True
        ),
        "silver_reports_signature_fields": lambda t: _silver(t, "signature_fields"),
        "silver_reports_masked_first": _silver,
        "silver_reports_snapshot_attributes": lambda t: _silver(
            t, attributes="snapshot", columns=(*fields.SILVER_REPORT, "country")
        ),
        "silver_reports_xml_last": lambda t: _silver(t, xml_mode="last"),
        "silver_reports_xml_parsed": lambda t: silver.silver_reports(
            _marked_up(t.report_cdc()), start_year=START_YEAR, xml_mode="parsed"
        ),
        "silver_reports_variant": variant,
        "silver_reports_tombstones_after": lambda t: _silver(t, tombstones="after"),
        "silver_reports_by_id": lambda t: silver.silver_reports_by_id(t.report_cdc()),
        "silver_preview": lambda t: silver.silver_preview(t.report_cdc()),
        "silver_participants": _participants,
        "silver_companies": lambda t: silver.silver_companies(t.company_cdc),
        "silver_export_details": lambda t: silver.export_details(t.report_cdc(exports=True), START_YEAR),
    }


def _gold_tables() -> dict[str, Build]:
    out: dict[str, Build] = {}
    for name in gold.MARTS:
        out[f"gold_{name}"] = _mart(name)
        out[f"gold_{name}_cert2"] = _mart(name, 2)
        out[f"gold_{name}_cert0"] = _mart(name, 0)
        out[f"gold_{name}_unsigned"] = _mart(name, signed_only=False)
    def bucketed(t: Tables) -> DataFrame:
        """The headline mart from reports and lookup that lie in buckets by request."""
        base, key = f"check_{uuid.uuid4().hex}", ["service_request_id"]
        tables = {
            "reports": predicates.signed(_silver(t, columns=gold.NEEDED["general_indicators"])),
            "lookup": gold.certificate_lookup(_participants(t), t.request_cdc),
        }
        try:
            for name, rows in tables.items():
                writers.write_bucketed(rows, f"{base}_{name}", key, buckets=8)
            reports, lookup = (t.spark.table(f"{base}_{name}") for name in tables)
            return materialise(gold.general_indicators(gold.with_certificates(reports, lookup)), "bucketed")
        finally:
            for name in tables:
                t.spark.sql(f"DROP TABLE IF EXISTS {base}_{name}")

    return out | {
        "gold_general_indicators_bucketed": bucketed,
        "gold_export_by_country": _export_by_country,
        "gold_export_by_country_stitched": _export_stitched,
        "gold_export_by_country_natural_key": lambda t: gold.export_by_country_natural_key(
            t.report_cdc(exports=True), _participants(t), start_year=START_YEAR
        ),
        "gold_export_details": lambda t: gold.gold_export_details(
            silver.silver_reports_natural_key(t.report_cdc(exports=True))
        ),
        "gold_report_mart": lambda t: gold.report_mart(t.report_cdc(), start_year=START_YEAR),
        "gold_report_mart_reduced": lambda t: gold.report_mart(
            t.report_cdc(), year=1998, columns=(*fields.REPORT_MART_25, "cdc_operation")
        ),
        "gold_report_mart_27": lambda t: gold.report_mart(
            t.report_cdc(), columns=fields.REPORT_MART_27, start_year=START_YEAR
        ),
        "gold_report_mart_28": lambda t: gold.report_mart(
            t.report_cdc(), columns=fields.REPORT_MART_28, start_year=START_YEAR
        ),
        "gold_report_mart_quarter": lambda t: gold.report_mart(t.report_cdc(), 1998, "quarter2"),
        "gold_deduped_report_mart": lambda t: gold.deduped_report_mart(t.report_cdc(), start_year=START_YEAR),
    }


def _summaries() -> dict[str, Build]:
    def annual(t: Tables) -> DataFrame:
        return summary.annual_summary(silver.silver_reports_basic(t.report_cdc(), START_YEAR))

    def mart(t: Tables) -> DataFrame:
        return gold.report_mart(t.report_cdc(), start_year=START_YEAR)

    return {
        "sum_registry": _registry_summary,
        "sum_period": lambda t: summary.period_summary(t.report_cdc(), start_year=START_YEAR),
        "sum_period_ru": lambda t: summary.period_summary(t.report_cdc(), "ru", start_year=START_YEAR),
        "sum_quarter": lambda t: summary.quarter_summary(_silver(t)),
        "sum_annual": annual,
        "sum_annual_saved_first": lambda t: summary.annual_summary(_silver(t, "data_first"), taxes="saved_first"),
        "sum_annual_totals": lambda t: summary.annual_totals(annual(t)),
        "sum_year_total": lambda t: summary.year_total(t.report_cdc(), 1998),
        "sum_tax_by_year": lambda t: summary.tax_by_year(_mart("tax_benefits")(t)),
        "sum_staff_by_year": lambda t: summary.staff_by_year(_mart("employees")(t)),
        "sum_mart_totals": lambda t: summary.mart_totals(mart(t)),
        "sum_mart_totals_by_year": lambda t: summary.mart_totals(mart(t), "year"),
        "sum_mart_totals_by_type": lambda t: summary.mart_totals(mart(t), "report_type"),
    }


def _quality() -> dict[str, Build]:
    indicators = _mart("general_indicators")

    def counts(t: Tables) -> DataFrame:
        rows = _resolved(t, *gold.MARTS)
        tables = {name: mart(rows) for name, mart in gold.MARTS.items()}
        return quality.table_counts({**tables, "export_by_country": _export_by_country(t, rows)})

    def value_counts(t: Tables) -> DataFrame:
        log = t.report_cdc()
        profiles = [
            aggregates.value_counts(log, c).select(F.lit(c).alias("field"), F.col(c).cast("string").alias("val"), "cnt")
            for c in ("op", "status", "report_type", "year")
        ]
        return reduce(DataFrame.unionByName, profiles)

    def profile(t: Tables) -> DataFrame:
        mart = gold.report_mart(t.report_cdc(), start_year=START_YEAR)
        columns = ["residents_count", "nonresidents_count", "income_total", "tax_incentives"]
        return aggregates.numeric_profile(mart, columns).withColumn("stddev", F.round("stddev", 4))

    def reduction(t: Tables) -> DataFrame:
        before = t.report_cdc().filter(predicates.report_filter(start_year=START_YEAR))
        return quality.row_reduction(before, gold.deduped_report_mart(t.report_cdc(), start_year=START_YEAR))

    return {
        "dq_table_counts": counts,
        "dq_masking_coverage": lambda t: quality.masking_coverage(
            indicators(t), income="income_total_current_quarter"
        ),
        "dq_blank_bin": lambda t: quality.blank_audit(indicators(t), "bin", "bin_status"),
        "dq_blank_certificate": lambda t: quality.blank_audit(indicators(t), "certificate_number", "cert_status"),
        "dq_blank_certificate_detail": lambda t: quality.blank_audit(
            indicators(t), "certificate_number", detail=True
        ),
        "dq_certificate_sources": lambda t: gold.certificate_sources(
            _silver(t, columns=("certificate_number",), with_identity=False), _participants(t), t.request_cdc
        ),
        "dq_field_coverage": lambda t: aggregates.field_coverage(indicators(t), ["tax_saved", "government_support"]),
        "dq_value_counts": value_counts,
        "dq_numeric_profile": profile,
        "dq_rows_by_year": lambda t: aggregates.rows_by_year(_silver(t, columns=(), with_identity=False)),
        "dq_row_reduction": reduction,
    }


def _bi() -> dict[str, Build]:
    def shares(t: Tables) -> DataFrame:
        rows = _resolved(t, "general_indicators")
        return bi.export_share(_export_by_country(t, rows), gold.general_indicators(rows))

    per_company = ("general_indicators", "tax_benefits", "employees")
    def merged(t: Tables) -> DataFrame:
        """All ranges of years, answered from bitmaps of single years; ids of late years are counted on from earlier ones."""
        rows = materialise(_export_by_country(t), "exports")
        ids = bitmaps.extended_ids(rows.filter("year < 1998"), "bin")
        ids = materialise(bitmaps.extended_ids(rows, "bin", ids), "companies")
        stored = materialise(bi.exporter_bitmaps(rows, ids), "exporters", ["year"])
        years = stored.agg(F.array_sort(F.collect_set("year")).alias("years"))  # a few
        begun = years.select("years", F.explode("years").alias("first_year"))
        later = F.filter("years", lambda y: y >= F.col("first_year"))
        ranges = begun.select("first_year", F.explode(later).alias("last_year"))
        return bi.exporters_of_ranges(stored, ranges)

    return {
        "bi_countries_merged": merged,
        "bi_yearly_dashboard": lambda t: bi.yearly_dashboard(*_marts(t, *per_company)),
        "bi_company_detail": lambda t: bi.company_detail(*_marts(t, *per_company)),
        "bi_company_detail_tin": lambda t: bi.company_detail(*_marts(t, *per_company), tin=TIN),
        "bi_export_share": shares,
        "bi_top_countries": lambda t: bi.top_countries(_export_by_country(t)),
        "bi_countries_by_year": lambda t: bi.export_countries_by_year(_export_by_country(t)),
        "bi_top_funding": lambda t: bi.top_funding(_mart("financing")(t)),
        "bi_top_identities": lambda t: bi.top_identities(_silver(t, columns=())),
    }


def _visits() -> dict[str, Build]:
    def events(t: Tables) -> DataFrame:
        return visits.visits_silver(visits.visits_bronze(t.visit_responses))

    def loaded(t: Tables) -> DataFrame:
        """All days in a first load, one of them in part; then that day by itself, twice."""

        def work(name: str) -> None:
            part = F.expr("visit_date <> DATE'2024-01-07' OR raw_json LIKE '%entry%'")
            visits.load_days(t.spark, t.visit_responses.filter(part), name, "2024-01-01", "2024-02-15")
            for _ in range(2):
                visits.load_days(t.spark, t.visit_responses, name, "2024-01-07")

        return _through_table(t, work)

    return {
        "visits_load": loaded,
        "visits_silver": events,
        "visits_of_days": lambda t: visits.visits_of_days(t.visit_responses, "2024-01-05", "2024-01-09"),
        "visits_company": lambda t: visits.link_to_company(visits.daily_attendance(events(t)), t.people),
        "visits_daily": lambda t: visits.daily_attendance(events(t)),
        "visits_monthly": lambda t: visits.monthly_attendance(visits.daily_attendance(events(t))),
    }


def _crm() -> dict[str, Build]:
    def statuses(t: Tables) -> DataFrame:
        return crm.crm_pipeline_statuses(t.crm_pipelines)

    def leads(t: Tables) -> DataFrame:
        return crm.crm_leads_silver(t.crm_leads, statuses(t), t.crm_users)

    def companies(t: Tables) -> DataFrame:
        return crm.crm_companies_silver(t.crm_companies, t.crm_users)

    def joined_ids(df: DataFrame, *columns: str) -> DataFrame:
        """Arrays as comma-separated text, which every engine compares alike."""
        return df.withColumns({c: F.array_join(F.col(c).cast("array<string>"), ",") for c in columns})

    def linked(t: Tables) -> DataFrame:
        rows = companies(t).drop("created_at", "updated_at", "responsible_user_name")
        return crm.link_by_bin(rows, _silver(t, columns=("income_total",)))

    def loaded(runs: Callable[[Tables], list[tuple[str, dict[str, DataFrame], bool]]], finish: Callable[[Tables, Callable], DataFrame]) -> Build:
        """Tables after load runs (id, sources, whether it is cut off before its last mark), each cut one repeated."""

        def build(t: Tables) -> DataFrame:
            base = f"check_{uuid.uuid4().hex}"
            table_of = lambda name: f"{base}_{name}"
            state, names = LoadState(t.spark, f"{base}_state"), ["state"]
            try:
                for run_id, sources, cut in runs(t):
                    names = list(dict.fromkeys([*names, *sources]))
                    if cut:
                        try:
                            crm.load_run(t.spark, sources, table_of, _CutShort(t.spark, state.table), run_id)
                        except _CutShort.Cut:
                            pass
                    crm.load_run(t.spark, sources, table_of, state, run_id)
                return finish(t, lambda name: materialise(t.spark.table(table_of(name)), name))
            finally:
                for name in names:
                    t.spark.sql(f"DROP TABLE IF EXISTS {table_of(name)}")

        return build

    def lead_runs(t: Tables) -> list:
        """Leads in their older versions, then as they are, in a run that is cut off and repeated."""
        older = t.crm_leads.filter(F.col("status_id") == 10)
        parts = {"pipelines": t.crm_pipelines, "users": t.crm_users}
        return [("first", {**parts, "leads": older}, False), ("second", {**parts, "leads": _moved_on(t)}, True)]

    def _moved_on(t: Tables) -> DataFrame:
        """All leads, changed after the first load: its mark is the latest change of then."""
        return t.crm_leads.withColumn("updated_at", F.col("updated_at") + F.lit(10**9))

    def leads_after(t: Tables, table: Callable[[str], DataFrame]) -> DataFrame:
        changed = table("leads").withColumn(
            "updated_at", F.col("updated_at") - F.when(F.col("updated_at") > 10**9 + 10**8, 10**9).otherwise(0)
        )
        rows = crm.crm_leads_silver(changed, crm.crm_pipeline_statuses(table("pipelines")), table("users"))
        return joined_ids(rows, "contact_ids", "company_ids", "tags")

    def event_runs(t: Tables) -> list:
        """Two loads of the journal as it grows, the second cut off and repeated, and a third with the rest.

        Every seventh event comes twice, and those of the hour before a load end again with the next.
        """
        events = t.crm_events.unionByName(t.crm_events.filter("id % 7 = 0"))
        upto = lambda day: events.filter(F.col("created_at") < F.unix_timestamp(F.lit(f"{day} 12:00:00").cast("timestamp")))
        return [
            ("first", {"events": upto("2024-01-10")}, False),
            ("second", {"events": upto("2024-01-20")}, True),
            ("third", {"events": events}, False),
        ]

    return {
        "crm_pipeline_statuses": statuses,
        "crm_leads_silver": lambda t: joined_ids(leads(t), "contact_ids", "company_ids", "tags"),
        "crm_contacts_silver": lambda t: joined_ids(
            crm.crm_contacts_silver(t.crm_contacts, t.crm_users), "company_ids", "lead_ids"
        ),
        "crm_companies_silver": companies,
        "crm_funnel": lambda t: crm.sales_funnel(leads(t)),
        "crm_manager_activity": lambda t: crm.manager_activity(leads(t), t.crm_tasks, t.crm_users),
        "crm_client_analytics": lambda t: crm.client_analytics(leads(t), companies(t)),
        "crm_companies_with_reports": linked,
        "crm_incremental_load": loaded(lead_runs, leads_after),
        "crm_events_load": loaded(event_runs, lambda t, table: crm.crm_events_silver(table("events"))),
    }


def _incremental() -> dict[str, Build]:
    columns = ["id", "service_request_id", "year", "report_type", "status", "op", "updated_ts"]
    before, since = "updated_ts < DATE'1999-06-01'", "updated_ts >= DATE'1999-06-01'"

    def upserted(t: Tables) -> DataFrame:
        """A table of the state of the first years; then the later changes merged in by time, deletes last."""
        log = _cut(t.report_cdc())
        newest = lambda rows: versions.latest(rows, ["id"], tombstones="keep")

        def work(name: str) -> None:
            writers.create_or_replace(newest(log.filter(before)), name)
            writers.upsert(t.spark, name, newest(log.filter(since)), ["id"], newer_by=["updated_ts"])

        return _carried(predicates.not_deleted(_through_table(t, work)))

    def streamed(t: Tables) -> DataFrame:
        """The log as files, read back as a stream in six batches, compacted twice on the way."""
        source, target, progress = (scratch_path(t.spark, n) for n in ("changes", "current", "progress"))
        log, known = t.report_cdc().select(*columns, "updated_at", "data"), 0
        for part in range(3):
            log.filter(F.pmod("id", F.lit(3)) == part).write.mode("append").parquet(source, compression="zstd")
            files = len(t.spark.read.schema(log.schema).parquet(source).inputFiles())
            half, known = max(1, (files - known + 1) // 2), files
            stream = changes.read_changes(t.spark, source, log.schema, files_per_batch=half)
            changes.apply_cdc_stream(stream, target, progress).awaitTermination()
            if part < 2:
                changes.compact(t.spark, target, log.schema)
        rows = materialise(_carried(_cut(changes.current_rows(t.spark, target, log.schema))), "streamed")
        release(t.spark, source, target, progress)
        return rows

    def once(t: Tables) -> DataFrame:
        """The log as it comes year by year, with redeliveries soon after and two years late, a run of the stream for each.

        A run takes a year's files as one batch, since the watermark moves on with every batch; so a year may be as many files
        as tasks that write it.
        """
        source, target, progress = (scratch_path(t.spark, n) for n in ("deliveries", "once", "progress"))
        log = materialise(_cut(t.report_cdc()).withColumn("came", F.year("updated_ts")), "deliveries", ["came"])
        years = [r["came"] for r in log.select("came").distinct().orderBy("came").collect()]  # a batch for each
        schema = log.drop("came").schema
        for year in years:
            soon = log.filter((F.col("came") == year) & (F.col("id") % 3 == 0))
            late = log.filter((F.col("came") == year - 2) & (F.col("id") % 5 == 0))
            files = log.filter(F.col("came") == year).unionByName(soon).unionByName(late).drop("came")
            files.write.mode("append").parquet(source)
            stream = changes.read_changes(t.spark, source, schema)
            changes.append_once(stream, target, progress, "40 days").awaitTermination()
        rows = materialise(_carried(t.spark.read.schema(schema).parquet(target)), "once")
        release(t.spark, source, target, progress)
        return rows

    def released(t: Tables) -> DataFrame:
        """A mart as readers see it after two runs over three tables, the second cut off and gone on with."""
        base = f"check_{uuid.uuid4().hex}"
        tables = {f"{base}_reports": ["year"], f"{base}_resolved": ["year"], f"{base}_financing": ["year"]}
        runs = releases.Releases(t.spark, base, tables)

        def build(log: DataFrame, cut: bool = False) -> dict:
            def mart(of):
                if cut:
                    raise RuntimeError("cut off")
                return gold.financing(of(f"{base}_resolved"))

            columns = gold.NEEDED["financing"]
            return {
                f"{base}_reports": lambda of: silver.silver_reports(log, start_year=START_YEAR, columns=columns),
                f"{base}_resolved": lambda of: gold.certificate_for(
                    predicates.signed(of(f"{base}_reports")), _participants(t), t.request_cdc
                ),
                f"{base}_financing": mart,
            }

        try:
            runs.refresh("first", build(t.report_cdc().filter(before)))
            try:
                runs.refresh("second", build(t.report_cdc(), cut=True))
            except RuntimeError:
                pass
            runs.refresh("third", build(t.report_cdc()))
            return materialise(t.spark.table(f"{base}_financing"), "released")
        finally:
            runs.drop()

    def refreshed(table: str) -> Build:
        marts = () if table.startswith("silver") else (table,)

        def build(t: Tables) -> DataFrame:
            bronze = refresh.Bronze(t.report_cdc(exports=True), t.request_cdc)
            return refresh.refresh_tables(bronze, refresh.to_scratch, START_YEAR, marts=marts)[table]

        return build

    def observed(t: Tables) -> DataFrame:
        """Rows of every table of a refresh, as the jobs that wrote them counted."""
        rows = quality.WrittenRows()
        bronze = refresh.Bronze(t.report_cdc(exports=True), t.request_cdc, t.company_cdc)
        refresh.refresh_tables(bronze, refresh.counted(refresh.to_scratch, rows), START_YEAR)
        return rows.counts(t.spark)

    def incremental(t: Tables) -> DataFrame:
        """The canonical table as of an early log, then refreshed by what changed since."""

        def make(log: DataFrame) -> DataFrame:
            return silver.silver_reports(log, start_year=START_YEAR, tombstones="after")

        def work(name: str) -> None:
            log = t.report_cdc()
            refresh.refresh(t.spark, make, log.filter(before), name)
            refresh.refresh(t.spark, make, log, name, "incremental", since="1999-06-01", keys={"id": "report_id"})

        return _through_table(t, work)

    def summed(pick: Callable[[str], tuple[dict[str, deltas.Additive], str]]) -> Build:
        """A summary of the early table, then kept up by what changed since: deletes, moved years, late versions."""

        def make(log: DataFrame) -> DataFrame:
            return silver.silver_reports(log, start_year=START_YEAR, tombstones="after")

        def build(t: Tables) -> DataFrame:
            names: list[str] = []

            def work(name: str) -> None:
                summaries, _ = pick(name)
                names.extend(n for table, spec in summaries.items() for n in (table, *spec.rollups))
                log = _reshuffled(t.report_cdc())
                early = log.filter("updated_at < DATE'1999-06-01'")
                refresh.refresh(t.spark, make, early, name, summaries=summaries)
                later = {"since": "1999-06-01", "keys": {"id": "report_id"}, "summaries": summaries}
                refresh.refresh(t.spark, make, log, name, "incremental", **later)

            name = f"check_{uuid.uuid4().hex}"
            try:
                work(name)
                return materialise(readers.read_table(t.spark, pick(name)[1]), "summary")
            finally:
                for table in (name, *names):
                    t.spark.sql(f"DROP TABLE IF EXISTS {table}")

        return build

    def quarters(t: Tables) -> DataFrame:
        year, report_type = previous_quarter("o_orderdate")
        return t.table("orders").select(
            F.col("o_orderkey").alias("id"), year.alias("year"), report_type.alias("report_type")
        )

    def cutoffs(t: Tables) -> DataFrame:
        return t.table("orders").select(F.col("o_orderkey").alias("id"), days_before("o_orderdate", 45).alias("cutoff"))

    def labelled(t: Tables) -> DataFrame:
        text = F.concat(F.lit("ИИН: 1 "), F.when(F.col("c_custkey") % 4 > 0, F.lit("БИН: ")), F.col("c_custkey").cast("string"))
        return t.table("customer").select(F.col("c_custkey").alias("id"), labelled_digits(text, "БИН").alias("digits"))

    def bound(t: Tables) -> DataFrame:
        t.table("orders").createOrReplaceTempView("bound_orders")
        text = (
            "SELECT o_orderkey AS id, o_orderstatus AS status FROM bound_orders "
            "WHERE o_orderstatus = :status AND o_orderdate >= CAST(:since AS DATE)"
        )
        return readers.sql(t.spark, text, status="F", since="1994-06-01")

    def named(t: Tables) -> DataFrame:
        """A handful of rows from the driver beside a table: what statuses are called."""
        labels = readers.from_rows(t.spark, [("draft", "Черновик"), ("signed", "Подписан")], "status string, label string")
        groups = t.report_cdc().groupBy("year", "status").agg(F.count(F.lit(1)).alias("cnt"))
        return groups.join(labels, "status", "left")

    return {
        "inc_changed_since": lambda t: predicates.changed_since(t.report_cdc(), "1999-06-01 00:00:00").select(*columns),
        "inc_upsert_equals_full": upserted,
        "inc_refresh_equals_full": incremental,
        "inc_summary_equals_full": summed(lambda n: ({f"{n}_a": deltas.annual()}, f"{n}_a")),
        "inc_summary_totals_equals_full": summed(lambda n: ({f"{n}_a": deltas.annual(totals=f"{n}_t")}, f"{n}_t")),
        "inc_summary_quarter_equals_full": lambda t: deltas.quarter_labels(
            summed(lambda n: ({f"{n}_q": deltas.QUARTER}, f"{n}_q"))(t)
        ),
        "stream_cdc_equals_batch": streamed,
        "stream_replays_dropped": once,
        "refresh_released_marts": released,
        "refresh_observed_counts": observed,
        **{f"refresh_{name}": refreshed(name) for name in ("silver_reports", "silver_participants", "financing", "export_by_country")},
        "expr_previous_quarter": quarters,
        "expr_days_before": cutoffs,
        "expr_labelled_digits": labelled,
        "src_bound_sql": bound,
        "src_rows": named,
    }


def _reshuffled(log: DataFrame) -> DataFrame:
    """The log with the same outcome by another way: some reports began in the year before, some updates come late.

    Every fifth snapshot has an older version of the year before; updates of the second day that belong to reports with a
    newer update were changed when the log was loaded the second time.
    """
    early = F.col("updated_ts") - F.expr("INTERVAL 40 DAYS")
    before = log.filter("op = 'r' AND id % 5 = 0").withColumns(
        {"year": (F.col("year") - 1).cast("int"), "updated_ts": early, "updated_at": early}
    )
    late = F.expr("op = 'u' AND id % 9 = 0 AND updated_ts < signed_at + INTERVAL 2 DAYS")
    arrived = F.greatest("updated_at", F.lit("1999-07-01").cast("timestamp_ntz"))
    return log.withColumn("updated_at", F.when(late, arrived).otherwise(F.col("updated_at"))).unionByName(before)


def _through_table(t: Tables, work: Callable[[str], None]) -> DataFrame:
    """What a table holds after the work, kept apart so that the table itself can go."""
    name = f"check_{uuid.uuid4().hex}"
    try:
        work(name)
        return materialise(readers.read_table(t.spark, name), "table")
    finally:
        t.spark.sql(f"DROP TABLE IF EXISTS {name}")


def _written_in_order(t: Tables, df: DataFrame, order=()) -> DataFrame:
    """A CSV folder and what it holds, with line numbers."""
    path = scratch_path(t.spark, "export")
    writers.export_csv(df, path, order)
    lines = materialise(readers.read_csv_in_order(t.spark, path, df.schema), "lines")
    release(t.spark, path)
    return lines


def _sinks() -> dict[str, Build]:
    def rows(t: Tables) -> DataFrame:
        kept = _cut(predicates.with_op(t.report_cdc(), "r", "c"))
        return kept.select("id", "service_request_id", "report_type", "status", "updated_ts", *CARRIED, "year")

    def sink(work: Callable[[Tables, DataFrame, str], None]) -> Build:
        return lambda t: _through_table(t, lambda name: work(t, rows(t), name))

    def replaced(t: Tables, df: DataFrame, name: str) -> None:
        writers.create_or_replace(df, name)
        writers.create_or_replace(df.filter("year >= 1998"), name, partition_by=["year"])

    def overwritten(t: Tables, df: DataFrame, name: str) -> None:
        writers.create_or_replace(df, name, partition_by=["year"])
        writers.overwrite(df.filter("year < 1998"), name, partition_by=["year"])

    def appended(t: Tables, df: DataFrame, name: str) -> None:
        writers.create_or_replace(df.filter("year < 1998"), name, partition_by=["year"])
        writers.append(df.filter("year >= 1998"), name, partition_by=["year"])

    def partitions(t: Tables, df: DataFrame, name: str) -> None:
        writers.create_or_replace(df, name, partition_by=["year"])
        writers.overwrite_partitions(df.filter("year = 1997").withColumn("status", F.lit("kept")), name)

    def full(t: Tables, df: DataFrame, name: str) -> None:
        spec = TableSpec(name, df.schema, ("year",), "reports", props={"layer": "checks"})
        create_table(t.spark, spec)
        writers.full_refresh(df, spec)
        writers.full_refresh(t.spark.table(name).filter("year <> 1996"), spec)

    def backfilled(t: Tables, df: DataFrame, name: str) -> None:
        writers.create_or_replace(df.withColumn("status", F.lit("old")), name, partition_by=["year"])
        writers.refresh_years(lambda d: d.filter("year <> 1997"), df, name, [1996, 1997])

    def deleted(t: Tables, df: DataFrame, name: str) -> None:
        writers.create_or_replace(df, name, partition_by=["year"])
        writers.delete_where(t.spark, name, "status = 'draft' AND year IN (1996, 1998) OR year = 1997")

    def truncated(t: Tables, df: DataFrame, name: str) -> None:
        writers.create_or_replace(df, name)
        writers.truncate(t.spark, name)
        writers.append(df.filter("year = 1998"), name)

    def timed(t: Tables, df: DataFrame, name: str) -> None:
        writers.create_or_replace(writers.with_load_time(df), name)

    def exported(t: Tables) -> DataFrame:
        """A sorted CSV export, read back with the line numbers that the order gives."""
        order = (F.desc("year"), F.asc("report_type"), F.desc("id"))
        return _written_in_order(t, rows(t).drop("updated_ts"), order)

    def sorted_summary(t: Tables) -> DataFrame:
        """The quarter summary as people read it: newest year first, quarters in order, the yearly figures last."""
        summed = summary.quarter_summary(_silver(t)).select("year", "report_type", "total_reports", "income_total", "period")
        return _written_in_order(t, aggregates.sort_for_export(summed, F.desc("year"), F.asc("report_type")))

    def previewed(t: Tables) -> DataFrame:
        """The first rows of an order, as a dry run shows them."""
        return writers.preview(aggregates.sort_for_export(rows(t).drop("updated_ts"), F.desc("year"), F.asc("report_type"), F.desc("id")))

    def upserted_by_key(t: Tables, df: DataFrame, name: str) -> None:
        """Rows of two years change, a part of them into another year; the key does not hold the year."""
        once = df.withColumn("status", F.lit("old"))
        writers.create_or_replace(once, name, partition_by=["year"])
        moved = F.when(F.expr("id % 2 = 0"), F.lit(1999)).otherwise(F.col("year")).cast("int")
        changes_ = df.filter("year IN (1996, 1997)").withColumn("year", moved)
        writers.upsert(t.spark, name, changes_, ["id"])

    return {
        "sink_create_or_replace": sink(replaced),
        "sink_overwrite": sink(overwritten),
        "sink_append": sink(appended),
        "sink_overwrite_partitions": sink(partitions),
        "sink_full_refresh": sink(full),
        "sink_years_backfill": sink(backfilled),
        "sink_delete_where": sink(deleted),
        "sink_truncate": sink(truncated),
        "sink_load_time": lambda t: sink(timed)(t).filter("etl_loaded_at IS NOT NULL").drop("etl_loaded_at"),
        "sink_sorted_csv": exported,
        "sink_sorted_summary": sorted_summary,
        "sink_preview": previewed,
        "sink_upsert_by_key": sink(upserted_by_key),
    }


def builds() -> dict[str, Build]:
    out: dict[str, Build] = {}
    for family in (_versions, _silver_tables, _gold_tables, _summaries, _quality, _bi, _visits, _crm, _incremental, _sinks):
        out |= family()
    out |= {f"reg_{name}": _registry(name) for name in ("residents", *registry.REGISTRIES)}
    return out | {
        "reg_nonresidents_quarter": _registry("nonresidents", year=1998, report_type="quarter2"),
        "reg_residents_year": _registry("residents", year=1997),
        "reg_family_renamed": _registry("nonresidents_family", rename_keys={registry.HOST_KEY: "documents"}),
    }


def _on(build: Build) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: build(tables(spark, folder))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _on(build) for name, build in builds().items()}
