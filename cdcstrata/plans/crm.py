"""CRM entities: raw JSON-bearing rows to typed tables and sales marts."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcstrata.operators.aggregates import sum_or_zero
from cdcstrata.operators.versions import latest
from cdcstrata.sources import writers
from cdcstrata.sources.load_state import LoadState
from cdcstrata.sources.writers import merged

# Fixed values that decide results.
WON = "Успешно реализовано"
LOST = "Закрыто и не реализовано"
FIELD_BIN = "БИН"
FIELD_SOURCE = "Источник"
FIELD_PHONE = "Телефон"
FIELD_EMAIL = "Email"
FIELD_INDUSTRY = "Сфера"

_CUSTOM_FIELDS = "array<struct<field_id:int,field_name:string,values:array<struct<value:string>>>>"
_REFERENCES = "array<struct<id:bigint,name:string>>"
_STATUSES = "array<struct<id:int,name:string,sort:int,color:string>>"


def custom_field(fields: Column, name: str) -> Column:
    """First value of the custom field with this name, NULL where it is missing."""
    match = F.get(F.filter(fields, lambda f: f["field_name"] == name), F.lit(0))
    return F.get(match["values"], F.lit(0))["value"]


def _with_custom_fields(df: DataFrame) -> DataFrame:
    """The custom fields as a column of their own: lambdas share no parse, so each field that is asked for would repeat it."""
    return df.withColumn("__custom", F.from_json("custom_fields_values", _CUSTOM_FIELDS))


def _references(column: str, field: str = "id") -> Column:
    return F.transform(F.from_json(column, _REFERENCES), lambda r: r[field])


def _newest(df: DataFrame) -> DataFrame:
    return latest(df, ["id"], ["updated_at"], tombstones="keep")


def _moment(column: str) -> Column:
    """Seconds since the epoch to a UTC timestamp, whatever the session time zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("SECOND", F.col(column), epoch).alias(column)


def _names(df: DataFrame, key: str, name: str) -> DataFrame:
    return df.select(F.col("id").alias(key), F.col("name").alias(name))


def crm_pipeline_statuses(pipelines: DataFrame) -> DataFrame:
    """One row per pipeline and status."""
    return pipelines.select(
        F.col("id").alias("pipeline_id"),
        F.col("name").alias("pipeline_name"),
        F.col("is_main").alias("is_main_pipeline"),
        F.explode(F.from_json("statuses_json", _STATUSES)).alias("s"),
    ).select(
        "pipeline_id",
        "pipeline_name",
        "is_main_pipeline",
        F.col("s.id").alias("status_id"),
        F.col("s.name").alias("status_name"),
        F.col("s.sort").alias("status_sort"),
        F.col("s.color").alias("status_color"),
    )


def crm_leads_silver(leads: DataFrame, statuses: DataFrame, users: DataFrame) -> DataFrame:
    """Newest version of every lead with names, outcome, custom fields and linked ids.

    ``loss_reason_id`` is passed through as text: there is no directory of reasons.
    """
    cf = F.col("__custom")
    rows = _with_custom_fields(_newest(leads)).select(
        F.col("id").alias("lead_id"),
        F.col("name").alias("lead_name"),
        "price",
        "responsible_user_id",
        "status_id",
        "pipeline_id",
        F.col("loss_reason_id").cast("string").alias("loss_reason"),
        _moment("created_at"),
        _moment("updated_at"),
        _moment("closed_at"),
        "is_deleted",
        custom_field(cf, FIELD_BIN).alias("cf_bin"),
        custom_field(cf, FIELD_SOURCE).alias("cf_source"),
        _references("contacts_json").alias("contact_ids"),
        _references("companies_json").alias("company_ids"),
        _references("tags_json", "name").alias("tags"),
    )
    status = statuses.select("pipeline_id", "pipeline_name", "status_id", "status_name", "status_sort")
    named = rows.join(status, ["pipeline_id", "status_id"], "left").join(
        _names(users, "responsible_user_id", "responsible_user_name"), "responsible_user_id", "left"
    )
    return named.withColumns(
        {
            "is_won": F.coalesce(F.col("status_name") == WON, F.lit(False)),
            "is_lost": F.coalesce(F.col("status_name") == LOST, F.lit(False)),
            "year": F.year("created_at"),
        }
    )


def mask_tail(c: Column, keep: int) -> Column:
    """All but the last ``keep`` characters starred out."""
    length = F.length(c)
    return F.when(length <= keep, F.repeat(F.lit("*"), length)).otherwise(
        F.concat(F.repeat(F.lit("*"), length - keep), F.right(c, F.lit(keep)))
    )


def mask_email(c: Column) -> Column:
    """First letter and domain stay."""
    return F.regexp_replace(c, "^(.)[^@]*", "$1***")


def crm_contacts_silver(contacts: DataFrame, users: DataFrame) -> DataFrame:
    """Newest version of every contact; phone and e-mail leave here masked."""
    cf = F.col("__custom")
    rows = _with_custom_fields(_newest(contacts)).select(
        F.col("id").alias("contact_id"),
        F.col("name").alias("full_name"),
        "first_name",
        "last_name",
        "responsible_user_id",
        mask_tail(custom_field(cf, FIELD_PHONE), 4).alias("phone"),
        mask_email(custom_field(cf, FIELD_EMAIL)).alias("email"),
        _moment("created_at"),
        _moment("updated_at"),
        "is_deleted",
        _references("companies_json").alias("company_ids"),
        _references("leads_json").alias("lead_ids"),
    )
    users = _names(users, "responsible_user_id", "responsible_user_name")
    return rows.join(users, "responsible_user_id", "left").drop("responsible_user_id")


def crm_companies_silver(companies: DataFrame, users: DataFrame) -> DataFrame:
    """Newest version of every company with its number and industry."""
    cf = F.col("__custom")
    rows = _with_custom_fields(_newest(companies)).select(
        F.col("id").alias("company_id"),
        F.col("name").alias("company_name"),
        "responsible_user_id",
        custom_field(cf, FIELD_BIN).alias("bin"),
        custom_field(cf, FIELD_INDUSTRY).alias("industry"),
        _moment("created_at"),
        _moment("updated_at"),
        "is_deleted",
    )
    users = _names(users, "responsible_user_id", "responsible_user_name")
    return rows.join(users, "responsible_user_id", "left").drop("responsible_user_id")


def _live(leads: DataFrame) -> DataFrame:
    return leads.filter(~F.coalesce("is_deleted", F.lit(False)))


def sales_funnel(leads: DataFrame) -> DataFrame:
    """Per month, pipeline and status: leads, money, outcome; conversion is won leads in percent."""
    out = (
        _live(leads)
        .groupBy("year", F.month("created_at").alias("month"), "pipeline_name", "status_name", "status_sort")
        .agg(
            F.count(F.lit(1)).alias("leads_count"),
            sum_or_zero("price").alias("total_price"),
            F.count_if("is_won").alias("won_count"),
            F.count_if("is_lost").alias("lost_count"),
        )
    )
    share = F.col("won_count").cast("decimal(20,0)") * 100 / F.col("leads_count").cast("decimal(20,0)")
    return out.withColumns(
        {
            "avg_price": F.expr("total_price div leads_count"),
            "conversion_rate": F.round(share, 2).cast("decimal(5,2)"),
        }
    )


def manager_activity(leads: DataFrame, tasks: DataFrame, users: DataFrame) -> DataFrame:
    """Per month and manager: leads created, won, lost, revenue, tasks done, mean deal length in days.

    Every lead becomes a 'created' row in its creation month and, once closed, a 'closed' row in its
    closing month; finished tasks are a third kind. One aggregate over the stack does the rest, where
    separate aggregates would need a full join.
    """
    zero = F.lit(0).cast("bigint")

    def row(moment: Column, created=zero, won=zero, lost=zero, revenue=zero, done=zero, days=zero) -> Column:
        return F.struct(
            moment.cast("timestamp_ntz").alias("moment"),
            created.alias("created"),
            won.alias("won"),
            lost.alias("lost"),
            revenue.alias("revenue"),
            done.alias("done"),
            days.alias("days"),
        )

    one = F.lit(1).cast("bigint")
    is_won, is_lost = F.col("is_won").cast("bigint"), F.col("is_lost").cast("bigint")
    closed = row(
        F.when(F.col("is_won") | F.col("is_lost"), F.col("closed_at")),
        won=is_won,
        lost=is_lost,
        revenue=F.when(F.col("is_won"), F.coalesce("price", zero)).otherwise(zero),
        days=F.when(
            F.col("is_won"), F.datediff(F.col("closed_at").cast("date"), F.col("created_at").cast("date")).cast("bigint")
        ).otherwise(zero),
    )
    lead_rows = _live(leads).select(
        "responsible_user_name", F.inline(F.array(row(F.col("created_at"), created=one), closed))
    )
    task_rows = (
        latest(tasks, ["id"], ["updated_at"], tombstones="keep")
        .filter("is_completed")
        .join(_names(users, "responsible_user_id", "responsible_user_name"), "responsible_user_id", "left")
        .select("responsible_user_name", _moment("updated_at"))
        .select("responsible_user_name", F.inline(F.array(row(F.col("updated_at"), done=one))))
    )
    stacked = lead_rows.unionByName(task_rows).filter(F.col("moment").isNotNull())
    out = stacked.groupBy(
        F.year("moment").alias("year"), F.month("moment").alias("month"), "responsible_user_name"
    ).agg(
        F.sum("created").alias("leads_created"),
        F.sum("won").alias("leads_closed_won"),
        F.sum("lost").alias("leads_closed_lost"),
        F.sum("revenue").alias("total_revenue"),
        F.sum("done").alias("tasks_completed"),
        F.sum("days").alias("days"),
    )
    mean = F.expr("days div nullif(leads_closed_won, 0L)")
    return out.withColumn("avg_deal_cycle_days", mean).drop("days")


def client_analytics(leads: DataFrame, companies: DataFrame) -> DataFrame:
    """Per company: leads, outcomes, revenue, first and last deal, and its tags as sorted text.

    Leads are summed per company before the company table is joined, tags in the same aggregate: what is gathered for
    one company is the different sets of tags that its leads carry, made distinct on the map side, not its leads.
    """
    linked = _live(leads).select(
        F.explode("company_ids").alias("company_id"), "price", "is_won", "is_lost", "created_at", "tags"
    )
    totals = linked.groupBy("company_id").agg(
        F.count(F.lit(1)).alias("total_leads"),
        F.count_if("is_won").alias("won_leads"),
        F.count_if("is_lost").alias("lost_leads"),
        F.sum(F.when(F.col("is_won"), F.col("price")).otherwise(0)).alias("total_revenue"),
        F.min(F.col("created_at").cast("date")).alias("first_deal_date"),
        F.max(F.col("created_at").cast("date")).alias("last_deal_date"),
        sum_or_zero("price").alias("total_price"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("tags")))).alias("tags"),
    )
    totals = totals.withColumn("tags", F.when(F.size("tags") > 0, F.array_join("tags", ", ")))
    company = companies.select("company_id", "company_name", "bin")
    return (
        totals.join(company, "company_id", "left")
        .withColumn("avg_deal_price", F.expr("total_price div total_leads"))
        .drop("total_price")
    )


def link_by_bin(crm: DataFrame, silver: DataFrame, column: str = "bin") -> DataFrame:
    """CRM rows with the yearly report figures of the same company; unmatched rows stay.

    Reports are summed per company and year first, so a CRM row gains one row per year and no more.
    """
    figures = silver.groupBy(F.col("company_tin").alias(column), "year").agg(
        F.count(F.lit(1)).alias("reports"), sum_or_zero("income_total").alias("income_total")
    )
    return crm.join(figures, column, "left")


def crm_events_silver(events: DataFrame) -> DataFrame:
    """The journal of events, typed: what happened to which entity when."""
    return events.select(
        F.col("id").alias("event_id"),
        F.col("type").alias("event_type"),
        "entity_type",
        "entity_id",
        _moment("created_at"),
    ).withColumn("year", F.year("created_at"))


def entity_changes_since(df: DataFrame, since_epoch: int) -> DataFrame:
    """Incremental slice of an entity by its change time in epoch seconds."""
    return df.filter(F.col("updated_at") >= F.lit(since_epoch))


# Load order of the entities: directories first, then what refers to them.
LOAD_ORDER = ("pipelines", "users", "companies", "contacts", "leads", "tasks")


def load_entities(
    changes: Mapping[str, DataFrame],
    save: Callable[[DataFrame, str], DataFrame],
    before: Mapping[str, DataFrame] | None = None,
    since_epoch: int | None = None,
) -> dict[str, DataFrame]:
    """Load the entities in dependency order; returns the tables as ``save`` hands them back.

    With ``before``, the tables of an earlier load, only rows changed ``since_epoch`` are taken and merged in by id, the
    later change winning. Directories without a change time (pipelines, users) are taken whole.
    """
    out: dict[str, DataFrame] = {}
    for name in LOAD_ORDER:
        if name not in changes:
            continue
        rows = changes[name]
        if before and name in before and "updated_at" in rows.columns:
            if since_epoch is not None:
                rows = entity_changes_since(rows, since_epoch)
            rows = merged(before[name], _newest(rows), ["id"], ["updated_at"])
        elif "updated_at" in rows.columns:
            rows = _newest(rows)
        out[name] = save(rows, name)
    return out


# What tells when a row of an entity came to be as it is; directories have none and are taken whole.
CHANGE_TIME = {
    "companies": "updated_at",
    "contacts": "updated_at",
    "leads": "updated_at",
    "tasks": "updated_at",
    "events": "created_at",
}
#: Seconds before the mark that a load reads again, for rows that the source made visible late.
OVERLAP = 3600


def load_run(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    table_of: Callable[[str], str],
    state: LoadState,
    run_id: str,
    overlap: int = OVERLAP,
) -> None:
    """One run of the load: every entity from its own stored mark on, directories whole, in order of dependency.

    Entities with a change time are merged into their table by id, the later change winning. Events are never changed:
    they are appended, less those that the table has already. Each entity's mark is committed once its rows are in
    the table, so a run that is cut off goes on, under the same id, with what it had not committed, and reads that again.
    """
    for name in (*LOAD_ORDER, "events"):
        if name not in sources or state.is_done(name, run_id):
            continue
        time, table, mark = CHANGE_TIME.get(name), table_of(name), state.mark(name)
        if time is None:
            with writers.staged(sources[name], name) as rows:
                writers.create_or_replace(rows, table)
            state.commit(name, None, run_id)
            continue
        since = None if mark is None else mark - overlap
        changed = sources[name] if since is None else sources[name].filter(F.col(time) >= since)
        # Stored once, so that the mark is that of the rows that were loaded and not of later ones.
        with writers.staged(changed, name) as rows:
            if name == "events":
                append_events(spark, rows, table, since)
            elif spark.catalog.tableExists(table):
                writers.upsert(spark, table, _newest(rows), ["id"], newer_by=[time])
            else:
                writers.create_or_replace(_newest(rows), table)
            newest = rows.agg(F.max(time)).first()[0]
        state.commit(name, max((m for m in (mark, newest) if m is not None), default=None), run_id)


def append_events(spark: SparkSession, rows: DataFrame, table: str, since: int | None = None) -> None:
    """Append the events that the table does not have, by id. It is partitioned by day of creation.

    ``since`` is where the rows begin: of the table, only days from then on are read to find what is there already.
    """
    day = F.to_date(F.timestamp_seconds("created_at"))
    new = rows.dropDuplicates(["id"]).withColumn("day", day)
    if spark.catalog.tableExists(table):
        there = spark.table(table)
        if since is not None:
            there = there.filter(F.col("day") >= F.to_date(F.timestamp_seconds(F.lit(since))))
        new = new.join(there.select("id"), "id", "left_anti").select(*there.columns)
        with writers.staged(new, "new-events") as new:
            writers.append(writers.clustered(new, ["day"]), table, partition_by=["day"])
    else:
        writers.create_or_replace(writers.clustered(new, ["day"]), table, partition_by=["day"])
