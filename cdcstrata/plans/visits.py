"""Access-control visits: event JSON to daily and monthly attendance."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcstrata.sources import writers

# Fixed values that decide results.
ENTRY, EXIT = "entry", "exit"
PERSON_ID = "^[0-9]{12}$"

_EVENTS = T.MapType(
    T.StringType(),
    T.ArrayType(T.StructType([T.StructField("event", T.StringType()), T.StructField("time", T.StringType())])),
)


def visits_bronze(responses: DataFrame) -> DataFrame:
    """Responses (visit_date, raw_json ``{person: [{event, time}]}``) to one row per event."""
    people = responses.select(
        "visit_date", F.explode(F.from_json("raw_json", _EVENTS)).alias("iin", "events")
    )
    return people.select("visit_date", "iin", F.explode("events").alias("e")).select(
        "visit_date", "iin", F.col("e.event").alias("event"), F.col("e.time").alias("event_time")
    )


def visits_silver(bronze: DataFrame) -> DataFrame:
    """Valid events once each: 12-digit person id, known event, readable time.

    The time of day stays text, ``event_datetime`` carries it as a timestamp.
    """
    moment = F.concat_ws(" ", F.col("visit_date").cast("string"), F.col("event_time"))
    rows = bronze.filter(F.col("iin").rlike(PERSON_ID) & F.col("event").isin(ENTRY, EXIT)).withColumn(
        "event_datetime", moment.try_cast("timestamp_ntz")
    )
    return rows.filter(F.col("event_datetime").isNotNull()).dropDuplicates(
        ["visit_date", "iin", "event", "event_time"]
    )


def daily_attendance(silver: DataFrame) -> DataFrame:
    """Per day and person: first entry, last exit, counts, and the hours between the two.

    Hours are NULL without both ends, or where the last exit lies before the first entry.
    """
    is_entry, is_exit = F.col("event") == ENTRY, F.col("event") == EXIT
    days = silver.groupBy("visit_date", "iin").agg(
        F.min(F.when(is_entry, F.col("event_datetime"))).alias("first_entry"),
        F.max(F.when(is_exit, F.col("event_datetime"))).alias("last_exit"),
        F.count_if(is_entry).cast("int").alias("total_entries"),
        F.count_if(is_exit).cast("int").alias("total_exits"),
    )
    seconds = F.timestamp_diff("SECOND", F.col("first_entry"), F.col("last_exit"))
    hours = F.round(F.when(seconds >= 0, seconds).cast("decimal(10,0)") / F.lit(3600), 2)
    return days.withColumn("hours_on_site", hours.cast("decimal(5,2)")).withColumn("year", F.year("visit_date"))


def monthly_attendance(daily: DataFrame) -> DataFrame:
    """Per month and person: days, hours (average over days with known hours), first and last visit."""
    out = daily.groupBy("year", F.month("visit_date").alias("month"), "iin").agg(
        F.count(F.lit(1)).cast("int").alias("total_days_visited"),
        F.sum("hours_on_site").alias("hours"),
        F.count("hours_on_site").alias("days_with_hours"),
        F.min("visit_date").alias("first_visit_date"),
        F.max("visit_date").alias("last_visit_date"),
    )
    average = F.col("hours") / F.nullif(F.col("days_with_hours"), F.lit(0).cast("bigint"))
    return out.select(
        "year",
        "month",
        "iin",
        "total_days_visited",
        F.round(average, 2).cast("decimal(5,2)").alias("avg_hours_per_day"),
        F.col("hours").cast("decimal(7,2)").alias("total_hours"),
        "first_visit_date",
        "last_visit_date",
    )


def visits_of_days(responses: DataFrame, first: str, last: str | None = None) -> DataFrame:
    """The slice of one daily load, or of a range of days for the first load."""
    day = F.col("visit_date")
    return responses.filter((day >= F.lit(first).cast("date")) & (day <= F.lit(last or first).cast("date")))


def load_days(
    spark: SparkSession, responses: DataFrame, table: str, first: str, last: str | None = None
) -> None:
    """Load a day, or for the first load a range of days, into the table of valid events, partitioned by ``visit_date``.

    Each day that is asked for is replaced as a whole and one without events is emptied, so a day can be loaded again,
    after a cut or when its responses were mended. Of the responses, the days' slice is read once.
    """
    rows = visits_silver(visits_bronze(visits_of_days(responses, first, last)))
    if not spark.catalog.tableExists(table):
        writers.create_or_replace(rows.limit(0), table, partition_by=["visit_date"])
    days = f"explode(sequence(DATE'{first}', DATE'{last or first}')) AS visit_date"
    with writers.staged(writers.clustered(rows, ["visit_date"]), "visits") as rows:
        writers.swap_partitions(spark, table, rows, spark.range(1).selectExpr(days))


def link_to_company(daily: DataFrame, people: DataFrame) -> DataFrame:
    """Attendance with the company number of the person, where the directory (iin, bin) knows one."""
    return daily.join(people.select("iin", "bin"), "iin", "left")
