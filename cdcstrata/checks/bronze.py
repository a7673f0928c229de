"""Change logs derived from the test tables, by the rules in :mod:`cdcstrata.checks.rules`.

The logs that many queries read are stored once per application, as the change tables of a lakehouse are; what
single queries need is derived in place. Everything but the export array is a narrow, shuffle-free projection: a
report row becomes its versions where it is. The export array sums line items per order and nation first, so what is gathered for one order is
bounded by the number of nations, however many line items it has.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcstrata.checks import rules as r
from cdcstrata.functions.payload import UNAVAILABLE_PAYLOAD
from cdcstrata.plans.fields import EXPORT_CURRENT, EXPORT_PREVIOUS
from cdcstrata.plans.registry import REGISTRIES
from cdcstrata.session import tune
from cdcstrata.sources.scratch import TEXT, store

EPOCH = "CAST(datediff(CAST(d AS DATE), DATE'1970-01-01') AS BIGINT) * 86400"
LEAD_STATUS = "CASE WHEN s = 'F' THEN 142 WHEN s = 'P' THEN 143 WHEN k % 2 = 0 THEN 10 ELSE 20 END"
LEAD_CLOSED = f"CASE WHEN s IN ('F', 'P') THEN {EPOCH} + k % 30 * 86400 END"
LOG_START = "TIMESTAMP_NTZ'1995-01-01 00:00:00'"


# --- SQL text builders ------------------------------------------------------------------------


def _struct(fields: dict[str, str]) -> str:
    return "named_struct(" + ", ".join(f"'{name}', {rule}" for name, rule in fields.items()) + ")"


def _json(fields: dict[str, str]) -> str:
    return f"to_json({_struct(fields)})"


def _select(fields: dict[str, str]) -> list[str]:
    return [f"{rule} AS `{name}`" for name, rule in fields.items()]


def _member(name: str, raw: str) -> str:
    """``"name":raw``, or NULL where raw is NULL."""
    return f"'\"{name}\":' || ({raw})"


def _plain_text(name: str, rule: str) -> str:
    """A member of a text that needs no escapes: the rule makes it of its own constants and of numbers."""
    return f"'\"{name}\":\"' || ({rule}) || '\"'"


def _object(members: list[str]) -> str:
    """JSON object text of the members that are not NULL, put together without a writer's detour over a struct."""
    return f"concat('{{', concat_ws(',', {', '.join(members)}), '}}')"


def _items(count: str, item: dict[str, str]) -> str:
    """JSON array text of up to ITEMS objects, their values rules over the row and the item number i."""
    objects = []
    for i in range(1, r.ITEMS + 1):
        bound = {key: r.bound(rule, "i", i) for key, rule in item.items()}
        objects.append(f"CASE WHEN {i} <= {count} THEN {_json(bound)} END")
    return f"'[' || concat_ws(',', {', '.join(objects)}) || ']'"


def _versions(versions) -> str:
    """Generator of the (op, lag) pairs a row has; everything else of a version is computed after it,
    so that columns nobody asks for are never made."""
    cases = [
        f"CASE WHEN {where} THEN named_struct('op', '{op}', 'lag', {lag}) END" for op, lag, where in versions
    ]
    return f"inline(filter(array({', '.join(cases)}), x -> x IS NOT NULL))"


def _signature(tin: str, name: str, full_name: str) -> str:
    """JSON with the two plain fields and a signed XML document that also names a signer.

    Some documents break the line inside the company element; one in fifteen updates lacks the number.
    """
    gap = "CASE WHEN k % 6 = 0 THEN chr(10) ELSE '' END"
    company = f"'<company>' || {gap} || coalesce('<tin>' || {tin} || '</tin>', '') || '<name>' || {name} || '</name></company>'"
    xml = f"'<?xml version=\"1.0\"?><doc>' || {company} || '<signer><tin>999999999999</tin></signer></doc>'"
    return _json({"signed_xml": xml, "tin": tin, "full_name": full_name})


def _custom_fields(fields: list[tuple[str, str]]) -> str:
    entries = [
        _struct({"field_id": str(500 + n), "field_name": f"'{name}'", "values": f"array(named_struct('value', {rule}))"})
        for n, (name, rule) in enumerate(fields)
    ]
    return f"to_json(array({', '.join(entries)}))"


def item_rules(position: int, spec) -> dict[str, str]:
    """Item key -> rule. With two amount keys, the second item uses the older key and the rest the newer."""
    out = {key: r.item_text(key) for key in spec.text.values()}
    amount = r.item_amount(position)
    for keys in spec.amounts.values():
        if len(keys) == 1:
            out[keys[0]] = amount
        else:
            out[keys[0]] = f"CASE WHEN i <> 2 THEN {amount} END"
            out[keys[1]] = f"CASE WHEN i = 2 THEN {amount} END"
    return out


class Tables:
    """The test tables of one folder and the logs derived from them, each defined on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._stored: dict[str, tuple[str, T.StructType]] = {}

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def _base(self, name: str, columns: dict[str, str]) -> DataFrame:
        return self.table(name).selectExpr(*_select(columns))

    @cached_property
    def order_base(self) -> DataFrame:
        return self._base("orders", r.ORDER_COLUMNS)

    @cached_property
    def customer_base(self) -> DataFrame:
        return self._base("customer", r.CUSTOMER_COLUMNS)

    def stored(self, name: str, log: DataFrame) -> DataFrame:
        """The log from the shared folder, written there on first use or if the copy has gone."""
        if name in self._stored:
            path, schema = self._stored[name]
            try:
                return self.spark.read.schema(schema).parquet(path)
            except AnalysisException:
                del self._stored[name]
        self._stored[name] = (store(log, name, **TEXT), log.schema)
        return self.stored(name, log)

    # --- report log ---------------------------------------------------------------------------

    @cached_property
    def export_arrays(self) -> DataFrame:
        """Per order key: JSON array of {country, current_sum}, one object per supplier nation.

        Line items are laid out by order once; sums, arrays and the join with the orders all take that layout.
        """
        lines = self.table("lineitem").selectExpr(
            "l_orderkey AS k", "l_suppkey AS s_suppkey", "CAST(floor(l_extendedprice) AS BIGINT) AS amount"
        )
        suppliers = self.table("supplier").selectExpr("s_suppkey", "s_nationkey AS n_nationkey")
        nations = self.table("nation").selectExpr("n_nationkey", f"{r.EXPORT_COUNTRY} AS country")
        sums = (
            lines.join(suppliers, "s_suppkey")
            .select("k", "n_nationkey", "amount")
            .repartition("k")
            .groupBy("k", "n_nationkey")
            .agg(F.sum("amount").alias("current_sum"))
            .join(nations, "n_nationkey")
        )
        item = _struct({"n": "n_nationkey", "json": _json({"country": "country", "current_sum": "current_sum"})})
        packed = sums.groupBy("k").agg(F.expr(f"array_sort(collect_list({item}))").alias("items"))
        return packed.selectExpr("k", "'[' || array_join(items.json, ',') || ']' AS export_array")

    def report_cdc(self, exports: bool = False) -> DataFrame:
        """The report change log, on request with the export arrays in its payloads."""
        if exports:
            return self.stored("report_cdc_exports", self._export_log)
        return self.stored("report_cdc", self._plain_log)

    @cached_property
    def _plain_log(self) -> DataFrame:
        return self._report_log()

    @cached_property
    def _export_log(self) -> DataFrame:
        return self._report_log(exports=True)

    def _report_log(self, exports: bool = False, registries: tuple[str, ...] = ()) -> DataFrame:
        base = self.order_base
        texts = [_plain_text(name, rule) for name, rule in r.TEXT_RULES.items()]
        numbers = [_member(name, f"CAST({rule} AS STRING)") for name, rule in r.NUMBER_RULES.items()]
        flags = []
        members = [_member("income_total", r.INCOME_RAW), _member("activity_fields", r.ACTIVITY)]
        if exports:
            base = base.join(self.export_arrays, "k", "left")
            array = "coalesce(export_array, '[]')"
            number = f"CAST({r.EXPORT_NUMBER} AS STRING)"
            members.append(_member(EXPORT_CURRENT, f"CASE WHEN {r.EXPORT_IS_NUMBER} THEN {number} ELSE {array} END"))
            previous = {"country": r.PREVIOUS_COUNTRY, "sum": r.PREVIOUS_SUM}
            members.append(_member(EXPORT_PREVIOUS, f"({_items(r.PREVIOUS_COUNT, previous)})"))
        for position, (name, spec) in enumerate(REGISTRIES.items(), start=1):
            is_export = spec.array in (EXPORT_CURRENT, EXPORT_PREVIOUS)
            if name in registries or spec.flag in r.MART_FLAGS or (exports and is_export):
                flags.append(_plain_text(spec.flag, r.flag_rule(position)))
            if name in registries:
                members.append(_member(spec.array, f"({_items(r.ITEM_COUNT, item_rules(position, spec))})"))
        changed = "d + make_interval(0, 0, 0, lag)"
        masked_name = f"({r.MASKED_NAME})"
        return base.select("*", F.expr(_versions(r.VERSIONS))).selectExpr(
            *_select(r.ENVELOPE),
            "op",
            f"{changed} AS updated_ts",
            f"{changed} AS updated_at",
            f"CASE WHEN op IN ('r', 'c') THEN {_object([*texts, *numbers, *flags, *members])} "
            f"WHEN op = 'u' AND k % 2 = 0 THEN '{UNAVAILABLE_PAYLOAD}' END AS data",
            f"CASE WHEN op IN ('r', 'c') THEN {_signature(r.SIGNED_TIN, r.SIGNED_NAME, r.FULL_NAME)} "
            f"WHEN op = 'u' THEN {_signature(r.MASKED_TIN, masked_name, masked_name)} END AS signature",
            "array(CAST(k % 10 AS INT)) AS viewed",
        )

    # --- request and company logs -------------------------------------------------------------

    @staticmethod
    def _request_payload() -> str:
        """JSON of a request; ``v`` is the age of the version."""
        activation = {
            "certificate_number": r.REQUEST_CERTIFICATE,
            "issue_date": r.REQUEST_ISSUE,
            "end_date": r.REQUEST_END,
        }
        return _json(
            {
                "activation_info": _struct(activation),
                "deactivation_info": _struct({"reason": r.REQUEST_REASON, "exit_date": r.REQUEST_EXIT}),
                "protocol": _struct({"info": _struct({"name": r.REQUEST_NAME})}),
                "registration_date": "'2019-01-' || lpad(CAST(1 + c % 28 AS STRING), 2, '0')",
            }
        )

    @property
    def request_cdc(self) -> DataFrame:
        return self.stored("request_cdc", self._request_log)

    @cached_property
    def _request_log(self) -> DataFrame:
        rows = self.customer_base.select("*", F.expr(_versions(r.REQUEST_VERSIONS))).withColumnRenamed("lag", "v")
        return rows.selectExpr(
            "c AS id",
            f"{r.REQUEST_SERVICE} AS service_id",
            "c AS company_id",
            f"{r.REQUEST_STATUS} AS bp_status",
            f"CASE WHEN op <> 'd' THEN {self._request_payload()} END AS data",
            f"{r.REQUEST_SEARCH} AS search_field",
            f"{LOG_START} + make_interval(0, 0, 0, v) AS updated_at",
            "op",
        )

    @cached_property
    def company_cdc(self) -> DataFrame:
        rows = self.customer_base.select("*", F.expr(_versions(r.COMPANY_VERSIONS))).withColumnRenamed("lag", "v")
        return rows.selectExpr(
            "c AS id",
            f"{r.COMPANY_NAME} AS name",
            "'C' || CAST(c AS STRING) AS short_name",
            "lpad(CAST(c AS STRING), 12, '0') AS tin",
            f"{LOG_START} + make_interval(0, 0, 0, v) AS updated_at",
            "op",
        )

    # --- tables behind the registries ---------------------------------------------------------

    def service_report(self, registry: str | None = None) -> DataFrame:
        """Reports as the operational database has them, with the array of one registry."""
        if registry in ("export_current", "export_previous", "residents"):
            log = self.report_cdc(exports=True)
        elif registry is None:
            log = self.report_cdc()
        else:
            log = self._report_log(registries=(registry,))
        rows = log.filter("op IN ('r', 'c')")
        return rows.select(
            "id", "year", "status", "report_type", "data", "version", "signed_at", "service_request_id"
        )

    @cached_property
    def service_request(self) -> DataFrame:
        return self.customer_base.selectExpr(
            "c AS id",
            "'R' || CAST(c AS STRING) AS number",
            f"{r.bound(self._request_payload(), 'v', 0)} AS data",
            "c AS company_id",
            "c AS hub_form_id",
        )

    @cached_property
    def company(self) -> DataFrame:
        return self.customer_base.selectExpr("c AS id", "name", "lpad(CAST(c AS STRING), 12, '0') AS tin")

    @cached_property
    def hub_form(self) -> DataFrame:
        return self.customer_base.selectExpr(
            "c AS id", "to_json(named_struct('heads_full_name', 'Head ' || CAST(c AS STRING))) AS data"
        )

    # --- visits -------------------------------------------------------------------------------

    @cached_property
    def visit_responses(self) -> DataFrame:
        """One response document per event: narrow, so a busy person is not gathered anywhere."""
        event = {
            "event": "CASE WHEN event_type IN ('click', 'view') THEN 'entry' ELSE 'exit' END",
            "time": "date_format(ts, 'HH:mm:ss')",
        }
        person = "lpad(CAST(user_id AS STRING), 12, '0')"
        return self.table("events").select("ts", "user_id", "event_type").selectExpr(
            "CAST(ts AS DATE) AS visit_date", f"to_json(map({person}, array({_struct(event)}))) AS raw_json"
        )

    @cached_property
    def people(self) -> DataFrame:
        """Directory of persons: every third is not in it."""
        return self.table("customer").filter("c_custkey % 3 <> 0").selectExpr(
            "lpad(CAST(c_custkey AS STRING), 12, '0') AS iin", "lpad(CAST(c_nationkey AS STRING), 12, '9') AS bin"
        )

    # --- CRM ----------------------------------------------------------------------------------

    @cached_property
    def crm_pipelines(self) -> DataFrame:
        statuses = (
            '[{"id":10,"name":"New","sort":10,"color":"#fff"},{"id":20,"name":"In work","sort":20,"color":"#eee"},'
            '{"id":142,"name":"Успешно реализовано","sort":1000,"color":"#0f0"},'
            '{"id":143,"name":"Закрыто и не реализовано","sort":1100,"color":"#f00"}]'
        )
        return self.table("region").selectExpr(
            "r_regionkey AS id", "r_name AS name", "r_regionkey = 0 AS is_main", f"'{statuses}' AS statuses_json"
        )

    @cached_property
    def crm_users(self) -> DataFrame:
        return self.table("nation").selectExpr("n_nationkey AS id", "n_name AS name")

    @cached_property
    def crm_leads(self) -> DataFrame:
        """Every fourth lead also has an older version, in another status."""
        versions = _versions((("new", 0, "TRUE"), ("old", 1, "k % 4 = 0")))
        fields = [("БИН", "lpad(CAST(c AS STRING), 12, '0')"), ("Источник", "'source ' || CAST(k % 3 AS STRING)")]
        return self.order_base.select("*", F.expr(versions)).selectExpr(
            "k AS id",
            "'Lead ' || CAST(k AS STRING) AS name",
            "p AS price",
            "CAST(k % 25 AS INT) AS responsible_user_id",
            f"CASE WHEN op = 'new' THEN {LEAD_STATUS} ELSE 10 END AS status_id",
            "CAST(k % 5 AS INT) AS pipeline_id",
            "CASE WHEN s = 'P' THEN CAST(k % 4 AS INT) END AS loss_reason_id",
            f"{EPOCH} AS created_at",
            f"{EPOCH} + 86400 - lag * 43200 AS updated_at",
            f"CASE WHEN op = 'new' THEN {LEAD_CLOSED} END AS closed_at",
            "k % 50 = 0 AS is_deleted",
            f"{_custom_fields(fields)} AS custom_fields_values",
            "to_json(array(named_struct('id', 1, 'name', 'T' || CAST(k % 5 AS STRING)))) AS tags_json",
            "to_json(array(named_struct('id', c), named_struct('id', c + 1000000))) AS contacts_json",
            "to_json(array(named_struct('id', c))) AS companies_json",
        )

    @cached_property
    def crm_companies(self) -> DataFrame:
        fields = [("БИН", "lpad(CAST(c AS STRING), 12, '0')"), ("Сфера", "segment")]
        return self._crm_parties(fields, "name")

    @cached_property
    def crm_contacts(self) -> DataFrame:
        fields = [
            ("Телефон", "'+7' || lpad(CAST(c AS STRING), 10, '0')"),
            ("Email", "'user' || CAST(c AS STRING) || '@mail.example'"),
        ]
        parties = self._crm_parties(fields, "'First' || CAST(c AS STRING) || ' Last' || CAST(c AS STRING)")
        return parties.selectExpr(
            "*",
            "split_part(name, ' ', 1) AS first_name",
            "split_part(name, ' ', 2) AS last_name",
            "to_json(array(named_struct('id', id))) AS companies_json",
            "to_json(array(named_struct('id', id * 3), named_struct('id', id * 3 + 1))) AS leads_json",
        )

    def _crm_parties(self, fields: list[tuple[str, str]], name: str) -> DataFrame:
        return self.customer_base.selectExpr(
            "c AS id",
            f"{name} AS name",
            "CAST(c % 25 AS INT) AS responsible_user_id",
            "1000000000L + c % 1000 * 86400 AS created_at",
            "1100000000L + c % 1000 * 86400 AS updated_at",
            "c % 40 = 0 AS is_deleted",
            f"{_custom_fields(fields)} AS custom_fields_values",
        )

    @cached_property
    def crm_tasks(self) -> DataFrame:
        """One task per order: done where the order is finished."""
        return self.order_base.selectExpr(
            "k AS id",
            "CAST(c % 25 AS INT) AS responsible_user_id",
            "k AS entity_id",
            "'leads' AS entity_type",
            "s = 'F' AS is_completed",
            f"{EPOCH} AS created_at",
            f"{EPOCH} + 5 * 86400 AS updated_at",
        )

    @cached_property
    def crm_events(self) -> DataFrame:
        """The journal of events, as what users did on their leads."""
        return self.table("events").selectExpr(
            "event_id AS id",
            "event_type AS type",
            "'leads' AS entity_type",
            "user_id AS entity_id",
            "CAST(timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', CAST(ts AS TIMESTAMP_NTZ)) AS BIGINT) AS created_at",
        )


_OPEN: dict[tuple, Tables] = {}


def _state(spark: SparkSession, folder: str) -> tuple:
    """Names, sizes and times of what lies in a folder, so that logs derived from older tables are not taken."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in files))


def tables(spark: SparkSession, folder: str) -> Tables:
    """The tables of a folder; within one application the plans are made once and reused while the tables stay."""
    key = (spark.sparkContext.applicationId, folder, _state(spark, folder))
    if key not in _OPEN:
        _OPEN[key] = Tables(tune(spark), folder)
    return _OPEN[key]
