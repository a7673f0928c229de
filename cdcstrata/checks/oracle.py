"""SQL counterparts of the registered queries, for any engine that reads the test tables.

They compute from the typed columns by the rules and never build or parse JSON or XML.
"""

from __future__ import annotations

from cdcstrata.checks import expected as fl
from cdcstrata.checks import rules as r

PAYLOAD = {**r.TEXT_RULES, **r.NUMBER_RULES, "income_total": r.INCOME_VALUE, "activity_fields": r.ACTIVITY}


def _select(columns: dict[str, str], table: str) -> str:
    return f"SELECT {', '.join(f'{rule} AS {name}' for name, rule in columns.items())} FROM {table}"


def _stack(versions, table: str, age: str) -> str:
    return "\nUNION ALL ".join(
        f"SELECT *, '{op}' AS op, {lag} AS {age} FROM {table} WHERE {where}" for op, lag, where in versions
    )


def _rep() -> str:
    has_data = "op IN ('r', 'c')"
    fields = ", ".join(f"CASE WHEN {has_data} THEN {rule} END AS {name}" for name, rule in PAYLOAD.items())
    envelope = ", ".join(f"{rule} AS {name}" for name, rule in r.ENVELOPE.items())
    return f"""
SELECT {envelope}, op, d + to_days(lag) AS updated_ts, d + to_days(lag) AS updated_at, k, p, {has_data} AS has_data,
  {fields},
  CASE WHEN {has_data} THEN {r.SIGNED_TIN} WHEN op = 'u' THEN {r.MASKED_TIN} END AS sig_tin,
  CASE WHEN {has_data} THEN {r.SIGNED_NAME} WHEN op = 'u' THEN {r.MASKED_NAME} END AS sig_name,
  CASE WHEN {has_data} THEN {r.FULL_NAME} WHEN op = 'u' THEN {r.MASKED_NAME} END AS sig_full_name
FROM versions"""


def _req() -> str:
    return f"""
SELECT c AS id, c, v, op, name, {r.REQUEST_SERVICE} AS service_id, {r.REQUEST_STATUS} AS bp_status, c AS company_id,
  {r.REQUEST_CERTIFICATE} AS certificate_number, {r.REQUEST_ISSUE_VALUE} AS issue_date, CAST({r.REQUEST_END} AS DATE) AS end_date,
  {r.REQUEST_NAME} AS company_name, {r.REQUEST_TIN} AS company_tin, {r.REQUEST_REASON} AS reason,
  CAST({r.REQUEST_EXIT} AS DATE) AS exit_date, {r.REQUEST_SEARCH} AS search_field
FROM req_versions"""


NATURAL = "service_request_id, report_type, year"
_NEWEST = "updated_at DESC, updated_ts DESC, id DESC"


def _ranked(source: str, keys: str, order: str, where: str = "TRUE") -> str:
    return (
        f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn "
        f"FROM {source} WHERE {where}) ranked WHERE rn = 1"
    )


def _blank(c: str) -> str:
    return f"NULLIF({c}, '')"


YEARS = f"year >= {r.START_YEAR}"
CARRIED = "company_tin, certificate_number, residents_count, income_total"


def _masked(columns=fl.SILVER_REPORT) -> str:
    envelope = ", ".join(f"COALESCE(u.{c}, s.{c}) AS {c}" for c in fl.ENVELOPE)
    return f"""
SELECT s.id AS report_id, {envelope},
  COALESCE(u.sig_tin, {_blank('s.company_tin')}, s.sig_tin) AS company_tin,
  COALESCE(u.sig_name, {_blank('s.company_name')}, s.sig_name) AS company_name,
  {', '.join('s.' + c for c in columns)}
FROM ({_ranked('rep', 'id', 'updated_ts DESC', f"op = 'r' AND {YEARS}")}) s
LEFT JOIN ({_ranked('rep', 'id', 'updated_ts DESC', f"op = 'u' AND {YEARS}")}) u ON s.id = u.id"""


# The canonical table without reports whose newest version is a delete.
AFTER_DELETES = (
    "SELECT * FROM silver WHERE report_id NOT IN "
    f"(SELECT id FROM ({_ranked('rep', 'id', 'updated_ts DESC')}) newest WHERE op = 'd')"
)

# Named pieces; a query lists the ones it needs and gets what those need as well.
CTES: dict[str, tuple[str, tuple[str, ...]]] = {
    "o": (_select(r.ORDER_COLUMNS, "orders"), ()),
    "versions": (_stack(r.VERSIONS, "o", "lag"), ("o",)),
    "rep": (_rep(), ("versions",)),
    "cust": (_select(r.CUSTOMER_COLUMNS, "customer"), ()),
    "req_versions": (_stack(r.REQUEST_VERSIONS, "cust", "v"), ("cust",)),
    "req": (_req(), ("req_versions",)),
    "participants": (
        "SELECT id AS service_request_id, company_id, bp_status, certificate_number, issue_date AS certificate_issue_date, "
        "end_date AS certificate_end_date, company_name, company_tin, reason AS deactivation_reason, "
        f"exit_date AS deactivation_date, search_field FROM ("
        + _ranked("req", "id", "v DESC", "service_id = 'techpark' AND bp_status IN ('deactivated', 'registered') AND op <> 'd'")
        + ") t",
        ("req",),
    ),
    "certs": (
        "SELECT id, certificate_number AS cert_number, issue_date AS cert_issue_date, end_date AS cert_end_date FROM ("
        + _ranked("req", "id", "v DESC", "service_id = 'techpark' AND op <> 'd'")
        + ") t",
        ("req",),
    ),
    "silver": (_masked(), ("rep",)),
    "exp": (
        "SELECT l_orderkey AS k, n_nationkey, CAST(SUM(CAST(floor(l_extendedprice) AS BIGINT)) AS BIGINT) AS current_sum, "
        f"ANY_VALUE({r.EXPORT_COUNTRY}) AS country FROM lineitem JOIN supplier ON l_suppkey = s_suppkey "
        "JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2",
        (),
    ),
    "exports": (f"SELECT * FROM exp WHERE NOT ({r.EXPORT_IS_NUMBER})", ("exp",)),
    "valid_exports": ("SELECT * FROM exports WHERE country IS NOT NULL AND country NOT IN ('', 'None')", ("exports",)),
    "previous": (
        f"SELECT k, {r.PREVIOUS_COUNTRY} AS country, {r.PREVIOUS_SUM} AS previous_sum "
        f"FROM o CROSS JOIN (VALUES (1), (2), (3)) items(i) WHERE i <= {r.PREVIOUS_COUNT}",
        ("o",),
    ),
    # Three places a certificate may come from, the first that has one counts; '' and '-1' are none.
    "places": (
        "SELECT report_id, CASE WHEN silver.certificate_number <> '' THEN silver.certificate_number END AS own, "
        "listed.certificate_number AS listed, CASE WHEN asked.cert_number <> '-1' THEN asked.cert_number END AS asked, "
        "listed.certificate_issue_date AS listed_issue, listed.certificate_end_date AS listed_end, "
        "asked.cert_issue_date AS asked_issue, asked.cert_end_date AS asked_end, asked.cert_number, "
        "listed.company_tin AS p_tin, listed.company_name AS p_name FROM silver "
        "LEFT JOIN participants AS listed USING (service_request_id) "
        "LEFT JOIN certs AS asked ON asked.id = silver.service_request_id",
        ("silver", "participants", "certs"),
    ),
    "resolved_all": (
        "SELECT silver.*, own AS cert0, CASE WHEN own IS NULL THEN listed ELSE own END AS cert2, "
        "CASE WHEN own IS NOT NULL THEN own WHEN listed IS NOT NULL THEN listed ELSE asked END AS cert3, "
        "listed AS p_number, cert_number, CAST(NULL AS DATE) AS issue0, listed_issue AS issue2, "
        "CASE WHEN listed_issue IS NULL THEN asked_issue ELSE listed_issue END AS issue3, CAST(NULL AS DATE) AS end0, "
        "listed_end AS end2, CASE WHEN listed_end IS NULL THEN asked_end ELSE listed_end END AS end3, p_tin, p_name "
        "FROM silver JOIN places USING (report_id)",
        ("places",),
    ),
    "resolved": ("SELECT * FROM resolved_all WHERE status = 'signed'", ("resolved_all",)),
    "base": (
        "SELECT k, id, year, status, report_type, version, signed_at, name AS company_name, lpad(CAST(c AS STRING), 12, '0') AS company_tin, c, "
        + ", ".join(PAYLOAD_COLUMNS := [n for n in PAYLOAD if n not in ("company_tin", "company_name")])
        + ", p FROM rep LEFT JOIN cust ON service_request_id = c WHERE op IN ('r', 'c') AND status = 'signed'",
        ("rep", "cust"),
    ),
}


def _sum(c: str, name: str | None = None) -> str:
    return f"CAST(SUM(COALESCE({c}, 0)) AS BIGINT) AS {name or c}"


def _raw_sum(c: str, name: str | None = None) -> str:
    return f"CAST(SUM({c}) AS BIGINT) AS {name or c}"


def _percent(part: str, whole: str) -> str:
    """Half-up to two digits in whole-number arithmetic, so no rounding of doubles is involved."""
    n, m = f"CAST({part} AS HUGEINT)", f"CAST({whole} AS HUGEINT)"
    return f"CASE WHEN {whole} <> 0 THEN CAST(({n} * 20000 + {m}) // (2 * {m}) AS DOUBLE) / 100 END"


def _period(style: str, year: str = "year") -> str:
    text = {
        "en": ("'Q{n} '", "''", "'Year '"),
        "ru": ("'{n} кв. '", "''", "'Итого '"),
        "ru_long": ("'{n} кв. '", "' г.'", "'Итого '"),
        "ru_short": ("'{n}кв.'", "'г.'", "'итого.'"),
    }[style]
    y = f"CAST({year} AS STRING)"
    cases = " ".join(f"WHEN 'quarter{n}' THEN {text[0].format(n=n)} || {y} || {text[1]}" for n in range(1, 5))
    return f"CASE report_type {cases} ELSE {text[2]} || {y} || {text[1]} END AS period"


def _with(body: str, *needed: str, **extra: str) -> str:
    """The query with the pieces it needs in front, each after the pieces it is made of."""
    order: list[str] = []

    def add(name: str) -> None:
        if name in order:
            return
        for other in CTES[name][1]:
            add(other)
        order.append(name)

    for name in needed:
        add(name)
    pieces = [f"{n} AS ({CTES[n][0].strip()})" for n in order] + [f"{n} AS ({t.strip()})" for n, t in extra.items()]
    return f"WITH {', '.join(pieces)}\n{body.strip()}"


# --- families ---------------------------------------------------------------------------------


def _versions() -> dict[str, str]:
    columns = f"id, service_request_id, year, report_type, status, op, updated_ts, has_data, {CARRIED}"
    by_id = "updated_ts DESC, id DESC"
    no_data_or_delete = "(has_data OR op = 'd')"
    return {
        "win_latest_by_id": _with(f"SELECT {columns} FROM ({_ranked('rep', 'id', by_id)}) WHERE op <> 'd'", "rep"),
        "win_latest_by_natural_key": _with(
            f"SELECT {columns} FROM ({_ranked('rep', NATURAL, _NEWEST, no_data_or_delete)}) WHERE op <> 'd'", "rep"
        ),
        "win_tombstone_before": _with(
            f"SELECT {columns} FROM ({_ranked('rep', NATURAL, _NEWEST, chr(111) + 'p <> ' + repr('d'))})", "rep"
        ),
        "win_tombstone_after": _with(
            f"SELECT {columns} FROM ({_ranked('rep', NATURAL, _NEWEST)}) WHERE op <> 'd'", "rep"
        ),
        "win_duplicate_groups": _with(
            f"SELECT {NATURAL}, COUNT(*) AS cnt FROM rep WHERE op IN ('r', 'c') GROUP BY ALL HAVING COUNT(*) > 1", "rep"
        ),
        "win_distinct_keys": _with(f"SELECT DISTINCT {NATURAL} FROM rep", "rep"),
        "win_percent_of_total": _with(
            f"SELECT status, report_type, cnt, {_percent('cnt', 'total')} AS percent FROM "
            "(SELECT *, SUM(cnt) OVER () AS total FROM (SELECT status, report_type, COUNT(*) AS cnt FROM rep GROUP BY ALL))",
            "rep",
        ),
        "win_drop_replays": _with(f"SELECT {columns} FROM rep", "rep"),
        "win_stitch_versions": _with(
            f"SELECT s.id, s.updated_ts AS snapshot_ts, {', '.join('s.' + c.strip() for c in CARRIED.split(','))}, "
            "u.updated_ts AS update_ts, u.sig_name AS update_name FROM "
            f"({_ranked('rep', 'id', by_id, chr(111) + 'p = ' + repr('r'))}) s LEFT JOIN "
            f"({_ranked('rep', 'id', by_id, chr(111) + 'p = ' + repr('u'))}) u ON s.id = u.id",
            "rep",
        ),
    }


def _silver() -> dict[str, str]:
    data_tin = f"COALESCE({_blank('company_tin')}, sig_tin) AS company_tin"
    data_name = f"COALESCE({_blank('company_name')}, sig_name) AS company_name"
    head = "id AS report_id, " + ", ".join(fl.ENVELOPE)
    natural_before = _ranked("rep", NATURAL, _NEWEST, f"op <> 'd' AND {YEARS}")
    natural_after = f"SELECT * FROM ({_ranked('rep', NATURAL, _NEWEST)}) WHERE op <> 'd'"
    columns = ", ".join(fl.SILVER_REPORT)
    basic = ", ".join(f"{c} AS {fl.SUPPORT_OLD}" if c == fl.SUPPORT_NEW else c for c in fl.SILVER_BASIC)
    item = (
        "'{' || CASE WHEN country IS NOT NULL THEN '\"country\":\"' || country || '\",' ELSE '' END || "
        "'\"current_sum\":' || CAST(current_sum AS STRING) || '}'"
    )
    arrays = f"SELECT k AS ak, '[' || string_agg({item}, ',' ORDER BY n_nationkey) || ']' AS arr FROM exp GROUP BY k"
    previous_item = (
        "'{' || CASE WHEN country IS NOT NULL THEN '\"country\":\"' || country || '\",' ELSE '' END || "
        "'\"sum\":' || CAST(previous_sum AS STRING) || '}'"
    )
    previous_arrays = f"SELECT k AS pk, '[' || string_agg({previous_item}, ',' ORDER BY previous_sum, country NULLS FIRST) || ']' AS parr FROM (SELECT *, row_number() OVER () AS z FROM previous) GROUP BY k"
    plain = ", ".join(c for c in fl.SILVER_NATURAL_KEY if c not in (fl.EXPORT_CURRENT, fl.EXPORT_PREVIOUS))
    masked_extra = _masked((*fl.SILVER_REPORT, "country"))
    return {
        "silver_reports_basic": _with(f"SELECT {head}, company_tin, company_name, {basic} FROM ({natural_before})", "rep"),
        "silver_reports_natural_key": _with(
            f"SELECT {head}, company_tin, company_name, {plain}, "
            f"CASE WHEN has_data THEN CASE WHEN {r.EXPORT_IS_NUMBER} THEN CAST({r.EXPORT_NUMBER} AS STRING) ELSE COALESCE(arr, '[]') END END AS {fl.EXPORT_CURRENT}, "
            f"CASE WHEN has_data THEN COALESCE(parr, '[]') END AS {fl.EXPORT_PREVIOUS} "
            f"FROM ({natural_after}) LEFT JOIN arrays ON k = ak LEFT JOIN previous_arrays ON k = pk",
            "rep",
            "exp",
            "previous",
            arrays=arrays,
            previous_arrays=previous_arrays,
        ),
        "silver_reports_data_first": _with(f"SELECT {head}, {data_tin}, {data_name}, {columns} FROM ({natural_before})", "rep"),
        "silver_reports_data_first_payload": _with(
            f"SELECT {head}, {data_tin}, {data_name}, {columns} FROM ({_ranked('rep', NATURAL, _NEWEST, f'(has_data OR op = {chr(39)}d{chr(39)}) AND {YEARS}')}) WHERE op <> 'd'",
            "rep",
        ),
        "silver_reports_signature_fields": _with(
            f"SELECT {head}, {data_tin}, COALESCE({_blank('company_name')}, sig_full_name) AS company_name, {columns} FROM ({natural_before})",
            "rep",
        ),
        "silver_reports_masked_first": _with("SELECT * FROM silver", "silver"),
        "silver_reports_snapshot_attributes": _with(
            masked_extra.replace("COALESCE(u.", "COALESCE(s.", len(fl.ENVELOPE)), "rep"
        ),
        # The last number of a signature is the signer's, whoever that is.
        "silver_reports_xml_last": _with(
            "SELECT * REPLACE (CASE WHEN report_id IN (SELECT id FROM rep WHERE op = 'u' AND " + YEARS + ") THEN '999999999999' "
            "ELSE (SELECT ANY_VALUE(COALESCE(NULLIF(company_tin, ''), CASE WHEN sig_name <> '' THEN '999999999999' END)) "
            "FROM rep WHERE op = 'r' AND rep.id = report_id) END AS company_tin) FROM silver",
            "silver",
            "rep",
        ),
        "silver_reports_xml_parsed": _with(
            "SELECT * REPLACE (replace(replace(company_name, 'Signed ', 'Signed & '), 'Masked ', 'Masked & ') AS company_name) FROM silver",
            "silver",
        ),
        "silver_reports_variant": _with(
            _masked().replace("FROM rep ", "FROM spoiled "),
            "rep",
            spoiled="SELECT * REPLACE ("
            + ", ".join(f"CASE WHEN id % 31 = 0 AND op = 'r' THEN NULL ELSE {c} END AS {c}" for c in PAYLOAD)
            + ") FROM rep",
        ),
        "silver_reports_tombstones_after": _with(AFTER_DELETES, "silver", "rep"),
        "silver_reports_by_id": _with(
            f"SELECT id AS report_id, service_request_id, year, report_type, status, {data_tin}, {data_name}, {', '.join(fl.SILVER_BY_ID)} "
            f"FROM ({_ranked('rep', 'id', 'updated_ts DESC', 'has_data')})",
            "rep",
        ),
        "silver_preview": _with(
            f"SELECT id AS report_id, {', '.join('op AS cdc_operation' if c == 'op' else c for c in fl.ENVELOPE)}, company_tin, company_name, "
            f"{', '.join(fl.SILVER_PREVIEW)} FROM rep WHERE op <> 'd'",
            "rep",
        ),
        "silver_participants": _with("SELECT * FROM participants", "participants"),
        "silver_companies": _with(
            "SELECT c AS company_id, CASE WHEN v = 1 THEN name || ' v2' ELSE name END AS name, 'C' || CAST(c AS STRING) AS short_name, "
            f"lpad(CAST(c AS STRING), 12, '0') AS tin FROM ({_ranked('company_versions', 'c', 'v DESC', chr(111) + 'p <> ' + repr('d'))})",
            "cust",
            company_versions=_stack(r.COMPANY_VERSIONS, "cust", "v"),
        ),
        "silver_export_details": _with(
            f"""
SELECT id AS report_id, service_request_id, year, report_type, company_tin, company_name, certificate_number, exports.country,
  current_sum AS export_amount, 'current' AS quarter_type FROM live JOIN exports USING (k) WHERE exports.country IS NOT NULL
UNION ALL
SELECT id, service_request_id, year, report_type, company_tin, company_name, certificate_number, previous.country, previous_sum, 'previous'
FROM live JOIN previous USING (k) WHERE previous.country IS NOT NULL""",
            "rep",
            "exports",
            "previous",
            live=f"SELECT * FROM rep WHERE has_data AND {YEARS}",
        ),
    }


def mart_sql(name: str, level: int, source: str = "resolved") -> str:
    """Body of a mart over ``resolved``."""
    head = f"year, report_type, cert{level} AS certificate_number, company_tin AS bin"
    renamed = {
        "general_indicators": fl.INDICATORS,
        "financing": fl.FINANCING,
        "tax_benefits": fl.TAX_BENEFITS,
        "employees": {c: c for c in fl.STAFF},
        "exports": {"export_income": "income_international"},
    }[name]
    columns = ", ".join(f"{src} AS {out}" for out, src in renamed.items())
    extra = {
        "general_indicators": f", company_name, issue{level} AS certificate_issue_date, end{level} AS certificate_end_date, "
        f"COALESCE(NULLIF(investor_country_company, ''), '{r.HOME}') = '{r.HOME}' AS is_resident, "
        "NULLIF(investor_country_company, '') AS country",
        "financing": ", COALESCE(finance_source_increase_authorized_capital, 0) + COALESCE(finance_source_investment, 0) AS attracted_investments",
        "exports": ", company_name",
    }.get(name, "")
    where = " WHERE op <> 'd'" if level == 0 else ""
    return f"SELECT {head}, {columns}{extra} FROM {source}{where}"


def _gold() -> dict[str, str]:
    out = {}
    for name in fl.MARTS:
        for level, suffix in ((3, ""), (2, "_cert2"), (0, "_cert0")):
            out[f"gold_{name}{suffix}"] = _with(mart_sql(name, level), "resolved")
        out[f"gold_{name}_unsigned"] = _with(mart_sql(name, 3, "resolved_all"), "resolved_all")
    country_head = "year, report_type, {cert} AS certificate_number, {tin} AS bin, {name} AS company_name, country"
    natural = _ranked(
        "(SELECT rep.* FROM rep WHERE has_data AND status = 'signed' AND NOT (" + r.EXPORT_IS_NUMBER + "))",
        NATURAL,
        _NEWEST,
        YEARS,
    )
    report = {n: n for n in (*fl.REPORT_MART,) if n not in fl.FLAGS}
    flags = {f"has_{array}": r.flag_rule(i) for i, (array, _, _) in enumerate(fl.REGISTRIES.values(), start=1)}
    mart_columns = ", ".join(
        [
            "id AS report_id",
            "year, report_type, status, signed_at, version, created_at, updated_at, service_request_id, author_id",
            *[
                "TRY_CAST(certificate_number AS INTEGER) AS certificate_number"
                if c == "certificate_number"
                else f"CAST({c} AS INTEGER) AS {c}"
                if c in fl.STAFF
                else c
                for c in report
            ],
            *[f"CASE WHEN has_data THEN {flags[f]} END AS {f}" for f in fl.FLAGS],
        ]
    )
    live = f"op <> 'd' AND status = 'signed' AND {YEARS}"
    out["gold_general_indicators_bucketed"] = out["gold_general_indicators"]
    out |= {
        "gold_export_by_country": _with(
            f"SELECT {country_head.format(cert='cert3', tin='company_tin', name='company_name')}, current_sum AS export_income "
            "FROM resolved JOIN valid_exports ON report_id = k",
            "resolved",
            "valid_exports",
        ),
        "gold_export_by_country_stitched": _with(
            f"SELECT {country_head.format(cert='cert3', tin='COALESCE(company_tin, NULLIF(p_tin, {0}))', name='COALESCE(company_name, NULLIF(p_name, {0}))').format(repr(''))}, "
            "current_sum AS export_income FROM resolved JOIN valid_exports ON report_id = k",
            "resolved",
            "valid_exports",
        ),
        "gold_export_by_country_natural_key": _with(
            "SELECT b.year, b.report_type, COALESCE(NULLIF(b.certificate_number, ''), p.certificate_number) AS certificate_number, "
            "COALESCE(NULLIF(b.company_tin, ''), b.sig_tin, p.company_tin) AS bin, "
            "COALESCE(NULLIF(b.company_name, ''), b.sig_name, p.company_name) AS company_name, e.country, current_sum AS export_amount "
            f"FROM ({natural}) b LEFT JOIN participants p ON b.service_request_id = p.service_request_id JOIN valid_exports e ON b.k = e.k",
            "rep",
            "participants",
            "valid_exports",
        ),
        "gold_export_details": _with(
            "SELECT year, report_type, certificate_number, company_tin AS bin, company_name, exports.country, current_sum AS export_amount "
            f"FROM ({_ranked('rep', NATURAL, _NEWEST)}) t JOIN exports USING (k) WHERE op <> 'd' AND has_data AND exports.country IS NOT NULL",
            "rep",
            "exports",
        ),
        "gold_report_mart": _with(f"SELECT {mart_columns} FROM rep WHERE {live}", "rep"),
        "gold_report_mart_reduced": _with(
            f"SELECT cdc_operation, {', '.join(fl.REPORT_MART_25)} FROM (SELECT {mart_columns}, op AS cdc_operation FROM rep WHERE {live} AND year = 1998)",
            "rep",
        ),
        "gold_report_mart_27": _with(
            f"SELECT {', '.join(fl.REPORT_MART_27)} FROM (SELECT {mart_columns} FROM rep WHERE {live})", "rep"
        ),
        "gold_report_mart_28": _with(
            f"SELECT {', '.join(fl.REPORT_MART_28)} FROM (SELECT {mart_columns}, op AS cdc_operation FROM rep WHERE {live})", "rep"
        ),
        "gold_report_mart_quarter": _with(
            f"SELECT {mart_columns} FROM rep WHERE {live} AND year = 1998 AND report_type = 'quarter2'", "rep"
        ),
        "gold_deduped_report_mart": _with(
            f"SELECT id AS report_id, {', '.join(fl.ENVELOPE)}, {', '.join(fl.DEDUPED_MART)} FROM ({_ranked('rep', NATURAL, _NEWEST, live)})",
            "rep",
        ),
    }
    return out


def _summaries() -> dict[str, str]:
    silver_cte = {"quarterly": f"SELECT * FROM ({_ranked('rep', NATURAL, _NEWEST, chr(111) + 'p <> ' + repr('d') + ' AND ' + YEARS)})"}
    annual_sums = ", ".join(_sum(c) for c in (*fl.ANNUAL_SUMS, *fl.ANNUAL_TAX_SUMS))
    quarters = "status = 'signed' AND report_type IN ('quarter1', 'quarter2', 'quarter3', 'quarter4')"

    def annual(taxes: str, old_support: str) -> str:
        sums = annual_sums.replace(f"COALESCE({fl.SUPPORT_OLD}, 0)", f"COALESCE({old_support}, 0)")
        return (
            f"SELECT service_request_id, year, COUNT(*) AS signed_quarters, {sums}, {_sum(taxes, 'taxes_saved')} "
            f"FROM quarterly WHERE {quarters} GROUP BY service_request_id, year"
        )

    period_sums = ", ".join(_sum(src, out) for out, src in fl.PERIOD_SUMS.items())
    registry_sums = ", ".join(_sum(c) for c in fl.REGISTRY_SUMS)
    quarter_sums = ", ".join(
        _sum("CAST(NULL AS BIGINT)", c) if c == fl.SUPPORT_OLD else _sum(c) for c in fl.QUARTER_SUMS
    )
    live = f"op <> 'd' AND status = 'signed' AND {YEARS}"
    totals = (
        "COUNT(*) AS reports, "
        + ", ".join(_sum(c) for c in ("income_total", "income_international", "tax_incentives", "residents_count"))
    )
    annual_basic = annual("tax_incentives", fl.SUPPORT_NEW)
    out = {
        "sum_quarter": _with(
            f"SELECT year, report_type, COUNT(*) AS total_reports, {quarter_sums}, {_period('ru_short').replace('ELSE', 'ELSE')} "
            "FROM silver WHERE status = 'signed' AND op <> 'd' GROUP BY year, report_type",
            "silver",
        ),
        "sum_annual": _with(annual_basic, "rep", **silver_cte),
        "sum_annual_saved_first": _with(
            annual("COALESCE(total_tax_saved, tax_incentives)", "CAST(NULL AS BIGINT)"), "rep", **silver_cte
        ),
        "sum_annual_totals": _with(
            "SELECT year, COUNT(*) AS companies_count, "
            + ", ".join(
                [
                    _raw_sum("signed_quarters", "total_signed_quarters"),
                    _raw_sum("income_total", "total_income"),
                    _raw_sum("income_international", "total_export"),
                    _raw_sum("taxes_saved", "total_taxes_saved"),
                ]
            )
            + f" FROM ({annual_basic}) GROUP BY year",
            "rep",
            **silver_cte,
        ),
        "sum_registry": _with(
            f"SELECT report_type, COUNT(*) AS total, {registry_sums}, CAST(1998 AS INTEGER) AS year, {_period('ru_long', '1998')} "
            "FROM base WHERE year = 1998 GROUP BY report_type",
            "base",
        ),
        "sum_year_total": _with(
            f"SELECT COUNT(*) AS total_reports, {_raw_sum('income_total')} FROM rep WHERE status = 'signed' AND year = 1998", "rep"
        ),
        "sum_tax_by_year": _with(
            "SELECT year, "
            + ", ".join(
                _raw_sum(c, n)
                for c, n in (("kpn", "total_kpn"), ("nds", "total_nds"), ("ipn", "total_ipn"), ("sn", "total_sn"), ("total_tax_saved", "total_saved"))
            )
            + f" FROM ({mart_sql('tax_benefits', 3)}) GROUP BY year",
            "resolved",
        ),
        "sum_staff_by_year": _with(
            "SELECT year, "
            + ", ".join(
                _raw_sum(c, n)
                for c, n in (
                    ("residents_count", "total_residents"),
                    ("nonresidents_count", "total_non_residents"),
                    ("gph_count", "total_civil_contracts"),
                )
            )
            + f" FROM ({mart_sql('employees', 3)}) GROUP BY year",
            "resolved",
        ),
        "sum_mart_totals": _with(f"SELECT {totals} FROM rep WHERE {live}", "rep"),
        "sum_mart_totals_by_year": _with(f"SELECT year, {totals} FROM rep WHERE {live} GROUP BY year", "rep"),
        "sum_mart_totals_by_type": _with(f"SELECT report_type, {totals} FROM rep WHERE {live} GROUP BY report_type", "rep"),
    }
    for style, suffix in (("en", ""), ("ru", "_ru")):
        out[f"sum_period{suffix}"] = _with(
            f"SELECT year, report_type, COUNT(*) AS reports_count, {period_sums}, {_period(style)} FROM rep WHERE {live} GROUP BY year, report_type",
            "rep",
        )
    return out


def _registries() -> dict[str, str]:
    out = {}
    for position, (name, (_, text, amounts)) in enumerate(fl.REGISTRIES.items(), start=1):
        flagged = f"{r.flag_rule(position)} = 'true'"
        head = "id, company_name, company_tin"
        if name == "export_previous":
            body = f"SELECT {head}, previous.country AS country_previous, previous_sum AS sum_previous FROM base JOIN previous USING (k) WHERE {flagged}"
            out[f"reg_{name}"] = _with(body, "base", "previous")
        elif name == "export_current":
            body = f"SELECT {head}, exports.country AS country_current, current_sum AS sum_current FROM base JOIN exports USING (k) WHERE {flagged}"
            out[f"reg_{name}"] = _with(body, "base", "exports")
        else:
            columns = [f"{r.item_text(key)} AS {column}" for column, key in text.items()]
            columns += [f'{r.item_amount(position)} AS "{column}"' for column in amounts]
            body = (
                f"SELECT {head}, {', '.join(columns)} FROM base CROSS JOIN (VALUES (1), (2), (3)) items(i) "
                f"WHERE i <= {r.ITEM_COUNT} AND {flagged}"
            )
            out[f"reg_{name}"] = _with(body, "base")
    fields = [
        f"CAST({c} AS INTEGER) AS {c}" if c in fl.STAFF else c
        for c in fl.RESIDENT_FIELDS
        if c not in (fl.EXPORT_CURRENT, fl.EXPORT_PREVIOUS)
    ]
    number = f"CASE WHEN {r.EXPORT_IS_NUMBER} THEN {r.EXPORT_NUMBER} END AS {fl.EXPORT_CURRENT}"
    cert = r.bound(r.REQUEST_CERTIFICATE, "v", 0)
    out["reg_residents"] = _with(
        f"""
SELECT id, company_name, 'R' || CAST(c AS STRING) AS request_number, {cert} AS certificate_number, {r.REQUEST_ISSUE} AS issue_date,
  '2019-01-' || lpad(CAST(1 + c % 28 AS STRING), 2, '0') AS registration_date, 'Head ' || CAST(c AS STRING) AS heads_full_name,
  company_tin, {', '.join(fields)}, {number}, CAST(NULL AS BIGINT) AS {fl.EXPORT_PREVIOUS}, signed_at
FROM base""".replace("certificate_number AS certificate_number", "certificate_number"),
        "base",
    )
    out["reg_residents_year"] = out["reg_residents"] + " WHERE year = 1997"
    out["reg_nonresidents_quarter"] = out["reg_nonresidents"] + " AND year = 1998 AND report_type = 'quarter2'"
    host, documents = r.item_text("fullname_host"), r.item_text("documents")
    out["reg_family_renamed"] = out["reg_nonresidents_family"].replace(f"{host} AS", f"{documents} AS")
    return out


def _quality() -> dict[str, str]:
    def buckets(case: str, name: str, income: bool = False) -> str:
        extra = f", {_raw_sum('income_total_current_quarter', 'total_income')}" if income else ""
        inner = f"SELECT {case} AS {name}, COUNT(*) AS cnt{extra} FROM marts GROUP BY 1"
        more = ", total_income" if income else ""
        return f"SELECT {name}, cnt{more}, {_percent('cnt', 'total')} AS percent FROM (SELECT *, SUM(cnt) OVER () AS total FROM ({inner}))"

    marts = {"marts": mart_sql("general_indicators", 3)}
    blank_cert = "certificate_number IS NULL OR certificate_number = ''"
    counts = " UNION ALL ".join(f"SELECT '{m}' AS table_name, COUNT(*) AS cnt FROM resolved" for m in fl.MARTS)
    return {
        "dq_table_counts": _with(
            counts + " UNION ALL SELECT 'export_by_country', COUNT(*) FROM resolved JOIN valid_exports ON report_id = k",
            "resolved",
            "valid_exports",
        ),
        "dq_masking_coverage": _with(
            buckets("CASE WHEN bin LIKE '777777%' THEN 'MASKED' ELSE 'REAL' END", "bin_status", True), "resolved", **marts
        ),
        "dq_blank_bin": _with(
            buckets("CASE WHEN bin IS NULL OR bin = '' THEN 'EMPTY' ELSE 'FILLED' END", "bin_status"), "resolved", **marts
        ),
        "dq_blank_certificate": _with(
            buckets(f"CASE WHEN {blank_cert} THEN 'EMPTY' ELSE 'FILLED' END", "cert_status"), "resolved", **marts
        ),
        "dq_blank_certificate_detail": _with(
            f"SELECT year, bin, company_name FROM marts WHERE {blank_cert}", "resolved", **marts
        ),
        "dq_certificate_sources": _with(
            "SELECT CASE WHEN certificate_number IS NOT NULL AND certificate_number <> '' THEN 'from_report' "
            "WHEN p_number IS NOT NULL THEN 'from_participants' "
            "WHEN cert_number IS NOT NULL AND cert_number <> '-1' THEN 'from_servicerequest' ELSE 'missing' END AS source, "
            "COUNT(*) AS cnt FROM resolved GROUP BY 1",
            "resolved",
        ),
        "dq_field_coverage": _with(
            "SELECT year, COUNT(*) AS total, COUNT(tax_saved) AS has_tax_saved, COUNT(government_support) AS has_government_support "
            "FROM marts GROUP BY year",
            "resolved",
            **marts,
        ),
        "dq_value_counts": _with(
            " UNION ALL ".join(
                f"SELECT '{c}' AS field, CAST({c} AS STRING) AS val, COUNT(*) AS cnt FROM rep GROUP BY {c}"
                for c in ("op", "status", "report_type", "year")
            ),
            "rep",
        ),
        "dq_numeric_profile": _with(
            " UNION ALL ".join(
                f"SELECT '{c}' AS \"column\", COUNT({c}) AS \"count\", AVG({c}) AS mean, round(STDDEV_SAMP({c}), 4) AS stddev, "
                f"CAST(MIN({c}) AS BIGINT) AS \"min\", quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS p50, "
                f"quantile_cont({c}, 0.75) AS p75, CAST(MAX({c}) AS BIGINT) AS \"max\" FROM rep WHERE op <> 'd' AND status = 'signed' AND {YEARS}"
                for c in ("residents_count", "nonresidents_count", "income_total", "tax_incentives")
            ),
            "rep",
        ),
        "dq_rows_by_year": _with("SELECT year, COUNT(*) AS cnt FROM silver GROUP BY year", "silver"),
        "dq_row_reduction": _with(
            f"SELECT b AS rows_before, a AS rows_after, b - a AS removed FROM (SELECT (SELECT COUNT(*) FROM rep WHERE op <> 'd' AND status = 'signed' AND {YEARS}) AS b, "
            f"(SELECT COUNT(*) FROM (SELECT DISTINCT {NATURAL} FROM rep WHERE op <> 'd' AND status = 'signed' AND {YEARS})) AS a)",
            "rep",
        ),
    }


def _bi() -> dict[str, str]:
    marts = {
        "g": mart_sql("general_indicators", 3),
        "t": mart_sql("tax_benefits", 3),
        "e": mart_sql("employees", 3),
        "f": mart_sql("financing", 3),
        "x": "SELECT year, report_type, cert3 AS certificate_number, company_tin AS bin, company_name, country, current_sum AS export_income "
        "FROM resolved JOIN valid_exports ON report_id = k",
        "gy": f"SELECT bin, year, MAX(company_name) AS company_name, {_raw_sum('income_total')}, {_raw_sum('export_income')}, {_raw_sum('total_funding')} FROM g GROUP BY bin, year",
        "ty": f"SELECT bin, year, {_raw_sum('total_tax_saved')} FROM t GROUP BY bin, year",
        "ey": f"SELECT bin, year, {_raw_sum('residents_count')}, {_raw_sum('nonresidents_count')} FROM e GROUP BY bin, year",
    }
    needs = ("resolved", "valid_exports")
    joined = "gy LEFT JOIN ty ON gy.bin = ty.bin AND gy.year = ty.year LEFT JOIN ey ON gy.bin = ey.bin AND gy.year = ey.year"
    return {
        "bi_yearly_dashboard": _with(
            "SELECT gy.year, COUNT(gy.bin) AS companies_count, "
            + ", ".join(
                [
                    _raw_sum("total_funding", "total_investments"),
                    _raw_sum("export_income", "total_exports"),
                    _raw_sum("total_tax_saved", "total_tax_saved"),
                    _raw_sum("residents_count", "total_employees"),
                ]
            )
            + f" FROM {joined} GROUP BY gy.year",
            *needs,
            **marts,
        ),
        "bi_company_detail": _with(
            "SELECT gy.bin, gy.year, company_name, income_total, export_income, total_funding, total_tax_saved, residents_count, "
            f"nonresidents_count FROM {joined}",
            *needs,
            **marts,
        ),
        "bi_company_detail_tin": _with(
            "SELECT gy.bin, gy.year, company_name, income_total, export_income, total_funding, total_tax_saved, residents_count, "
            f"nonresidents_count FROM {joined} WHERE gy.bin = '777777000007'",
            *needs,
            **marts,
        ),
        "bi_export_share": _with(
            f"SELECT xs.*, income_total, {_percent('export_income', 'income_total')} AS export_share_percent FROM "
            f"(SELECT bin, year, report_type, country, MAX(company_name) AS company_name, {_raw_sum('export_income')} FROM x GROUP BY bin, year, report_type, country) xs "
            f"JOIN (SELECT bin, year, report_type, {_raw_sum('income_total')} FROM g GROUP BY bin, year, report_type) gs USING (bin, year, report_type)",
            *needs,
            **marts,
        ),
        "bi_top_countries": _with(
            f"SELECT country, {_raw_sum('export_income', 'total_export')}, COUNT(DISTINCT bin) AS companies_count FROM x "
            "GROUP BY country ORDER BY total_export DESC, country LIMIT 10",
            *needs,
            **marts,
        ),
        "bi_countries_merged": _with(
            "SELECT a.year AS first_year, b.year AS last_year, country, COUNT(DISTINCT bin) AS companies_count "
            "FROM (SELECT DISTINCT year FROM x) a JOIN (SELECT DISTINCT year FROM x) b ON a.year <= b.year "
            "JOIN x ON x.year BETWEEN a.year AND b.year WHERE bin IS NOT NULL GROUP BY 1, 2, 3",
            *needs,
            **marts,
        ),
        "bi_countries_by_year": _with(
            "SELECT year, COUNT(*) AS cnt, COUNT(DISTINCT country) AS countries FROM x GROUP BY year", *needs, **marts
        ),
        "bi_top_funding": _with(
            "SELECT year, report_type, certificate_number, bin, total_funding, attracted_investments, loan_funds FROM f WHERE total_funding > 0 "
            "ORDER BY total_funding DESC, year NULLS LAST, report_type NULLS LAST, certificate_number NULLS LAST, bin NULLS LAST, "
            "attracted_investments NULLS LAST, loan_funds NULLS LAST LIMIT 10",
            *needs,
            **marts,
        ),
        "bi_top_identities": _with(
            "SELECT company_tin, company_name, COUNT(*) AS cnt FROM silver GROUP BY company_tin, company_name "
            "ORDER BY cnt DESC, company_tin NULLS LAST, company_name NULLS LAST LIMIT 10",
            "silver",
        ),
    }


def _visits() -> dict[str, str]:
    events = """
SELECT DISTINCT CAST(ts AS DATE) AS visit_date, lpad(CAST(user_id AS STRING), 12, '0') AS iin,
  CASE WHEN event_type IN ('click', 'view') THEN 'entry' ELSE 'exit' END AS event, strftime(ts, '%H:%M:%S') AS event_time,
  date_trunc('second', ts) AS event_datetime FROM events"""
    hours = "CASE WHEN last_exit >= first_entry THEN CAST((date_diff('second', first_entry, last_exit) * 200 + 3600) // 7200 AS DECIMAL(10,0)) / 100 END"
    daily = f"""
SELECT *, CAST({hours} AS DECIMAL(5,2)) AS hours_on_site, CAST(year(visit_date) AS INTEGER) AS year FROM (
  SELECT visit_date, iin, MIN(CASE WHEN event = 'entry' THEN event_datetime END) AS first_entry,
    MAX(CASE WHEN event = 'exit' THEN event_datetime END) AS last_exit,
    CAST(COUNT(*) FILTER (WHERE event = 'entry') AS INTEGER) AS total_entries,
    CAST(COUNT(*) FILTER (WHERE event = 'exit') AS INTEGER) AS total_exits
  FROM visits GROUP BY visit_date, iin)"""
    cents = "CAST(SUM(CAST(hours_on_site * 100 AS BIGINT)) AS BIGINT)"
    monthly = f"""
SELECT year, CAST(month(visit_date) AS INTEGER) AS month, iin, CAST(COUNT(*) AS INTEGER) AS total_days_visited,
  CAST(CAST(({cents} * 2 + COUNT(hours_on_site)) // (2 * NULLIF(COUNT(hours_on_site), 0)) AS DECIMAL(10,0)) / 100 AS DECIMAL(5,2)) AS avg_hours_per_day,
  CAST(SUM(hours_on_site) AS DECIMAL(7,2)) AS total_hours, MIN(visit_date) AS first_visit_date, MAX(visit_date) AS last_visit_date
FROM daily GROUP BY 1, 2, 3"""
    return {
        "visits_silver": _with("SELECT * FROM visits", visits=events),
        "visits_load": _with("SELECT * FROM visits", visits=events),
        "visits_daily": _with("SELECT * FROM daily", visits=events, daily=daily),
        "visits_of_days": (
            "SELECT CAST(ts AS DATE) AS visit_date, '{\"' || lpad(CAST(user_id AS STRING), 12, '0') || '\":[{\"event\":\"' || "
            "CASE WHEN event_type IN ('click', 'view') THEN 'entry' ELSE 'exit' END || '\",\"time\":\"' || strftime(ts, '%H:%M:%S') || "
            "'\"}]}' AS raw_json FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-09'"
        ),
        "visits_company": _with(
            "SELECT daily.*, CASE WHEN c_custkey % 3 <> 0 THEN lpad(CAST(c_nationkey AS STRING), 12, '9') END AS bin "
            "FROM daily LEFT JOIN customer ON lpad(CAST(c_custkey AS STRING), 12, '0') = iin",
            visits=events,
            daily=daily,
        ),
        "visits_monthly": _with(monthly, visits=events, daily=daily),
    }


def _crm() -> dict[str, str]:
    status = "CASE WHEN s = 'F' THEN 142 WHEN s = 'P' THEN 143 WHEN k % 2 = 0 THEN 10 ELSE 20 END"
    leads = f"""
SELECT k, c, p, d, CAST(k % 25 AS INTEGER) AS manager, CAST(k % 5 AS INTEGER) AS pipeline_id, {status} AS status_id,
  CASE WHEN s IN ('F', 'P') THEN d + to_days(CAST(k % 30 AS INTEGER)) END AS closed, s = 'F' AS is_won, s = 'P' AS is_lost, k % 50 = 0 AS is_deleted, s
FROM o"""
    statuses = """
SELECT r_regionkey AS pipeline_id, r_name AS pipeline_name, r_regionkey = 0 AS is_main_pipeline, x.* FROM region CROSS JOIN
  (VALUES (10, 'New', 10, '#fff'), (20, 'In work', 20, '#eee'), (142, 'Успешно реализовано', 1000, '#0f0'),
          (143, 'Закрыто и не реализовано', 1100, '#f00')) x(status_id, status_name, status_sort, status_color)"""
    named = """
SELECT l.*, pipeline_name, status_name, status_sort, n_name AS responsible_user_name FROM leads l
LEFT JOIN statuses USING (pipeline_id, status_id) LEFT JOIN nation ON manager = n_nationkey"""
    pieces = {"leads": leads, "statuses": statuses, "named": named}
    conversion = "CAST(CAST((won_count * 20000 + leads_count) // (2 * leads_count) AS DECIMAL(10,0)) / 100 AS DECIMAL(5,2))"
    activity = """
SELECT responsible_user_name, d AS m, 1 AS created, 0 AS won, 0 AS lost, 0 AS revenue, 0 AS done, 0 AS days FROM live
UNION ALL
SELECT responsible_user_name, closed, 0, CAST(is_won AS INTEGER), CAST(is_lost AS INTEGER), CASE WHEN is_won THEN p ELSE 0 END, 0,
  CASE WHEN is_won THEN date_diff('day', CAST(d AS DATE), CAST(closed AS DATE)) ELSE 0 END FROM live WHERE closed IS NOT NULL
UNION ALL
SELECT n_name, d + to_days(5), 0, 0, 0, 0, 1, 0 FROM o LEFT JOIN nation ON CAST(c % 25 AS INTEGER) = n_nationkey WHERE s = 'F'"""
    live = "SELECT * FROM named WHERE NOT is_deleted"
    created = "TIMESTAMP '1970-01-01 00:00:00' + to_seconds(1000000000 + c % 1000 * 86400) AS created_at"
    updated = "TIMESTAMP '1970-01-01 00:00:00' + to_seconds(1100000000 + c % 1000 * 86400) AS updated_at"
    manager = "LEFT JOIN nation ON CAST(c % 25 AS INTEGER) = n_nationkey"
    out = {
        "crm_pipeline_statuses": _with("SELECT * FROM statuses", statuses=statuses),
        "crm_leads_silver": _with(
            """
SELECT k AS lead_id, 'Lead ' || CAST(k AS STRING) AS lead_name, p AS price, manager AS responsible_user_id, responsible_user_name,
  status_id, status_name, status_sort, pipeline_id, pipeline_name, is_won, is_lost,
  CASE WHEN s = 'P' THEN CAST(k % 4 AS STRING) END AS loss_reason, d AS created_at, d + to_days(1) AS updated_at, closed AS closed_at,
  is_deleted, lpad(CAST(c AS STRING), 12, '0') AS cf_bin, 'source ' || CAST(k % 3 AS STRING) AS cf_source,
  CAST(c AS STRING) || ',' || CAST(c + 1000000 AS STRING) AS contact_ids, CAST(c AS STRING) AS company_ids, 'T' || CAST(k % 5 AS STRING) AS tags,
  CAST(year(d) AS INTEGER) AS year FROM named""",
            "o",
            **pieces,
        ),
        "crm_contacts_silver": _with(
            f"""
SELECT c AS contact_id, 'First' || CAST(c AS STRING) || ' Last' || CAST(c AS STRING) AS full_name, 'First' || CAST(c AS STRING) AS first_name,
  'Last' || CAST(c AS STRING) AS last_name, '********' || right(lpad(CAST(c AS STRING), 10, '0'), 4) AS phone, 'u***@mail.example' AS email,
  {created}, {updated}, c % 40 = 0 AS is_deleted, CAST(c AS STRING) AS company_ids,
  CAST(c * 3 AS STRING) || ',' || CAST(c * 3 + 1 AS STRING) AS lead_ids, n_name AS responsible_user_name FROM cust {manager}""",
            "cust",
        ),
        "crm_companies_silver": _with(
            f"""
SELECT c AS company_id, name AS company_name, lpad(CAST(c AS STRING), 12, '0') AS bin, segment AS industry, {created}, {updated},
  c % 40 = 0 AS is_deleted, n_name AS responsible_user_name FROM cust {manager}""",
            "cust",
        ),
        "crm_funnel": _with(
            f"""
SELECT *, total_price // leads_count AS avg_price, {conversion} AS conversion_rate FROM (
  SELECT CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, pipeline_name, status_name, status_sort, COUNT(*) AS leads_count,
    {_sum('p', 'total_price')}, COUNT(*) FILTER (WHERE is_won) AS won_count, COUNT(*) FILTER (WHERE is_lost) AS lost_count
  FROM named WHERE NOT is_deleted GROUP BY 1, 2, 3, 4, 5)""",
            "o",
            **pieces,
        ),
        "crm_manager_activity": _with(
            f"""
SELECT CAST(year(m) AS INTEGER) AS year, CAST(month(m) AS INTEGER) AS month, responsible_user_name, {_raw_sum('created', 'leads_created')},
  {_raw_sum('won', 'leads_closed_won')}, {_raw_sum('lost', 'leads_closed_lost')}, {_raw_sum('revenue', 'total_revenue')},
  {_raw_sum('done', 'tasks_completed')}, CAST(SUM(days) // NULLIF(SUM(won), 0) AS BIGINT) AS avg_deal_cycle_days
FROM activity GROUP BY 1, 2, 3""",
            "o",
            **pieces,
            live=live,
            activity=activity,
        ),
        "crm_client_analytics": _with(
            f"""
SELECT c AS company_id, c_name AS company_name, lpad(CAST(c AS STRING), 12, '0') AS bin, COUNT(*) AS total_leads,
  COUNT(*) FILTER (WHERE is_won) AS won_leads, COUNT(*) FILTER (WHERE is_lost) AS lost_leads,
  CAST(SUM(CASE WHEN is_won THEN p ELSE 0 END) AS BIGINT) AS total_revenue, MIN(CAST(d AS DATE)) AS first_deal_date,
  MAX(CAST(d AS DATE)) AS last_deal_date, CAST(SUM(p) // COUNT(*) AS BIGINT) AS avg_deal_price,
  string_agg(DISTINCT 'T' || CAST(k % 5 AS STRING), ', ' ORDER BY 'T' || CAST(k % 5 AS STRING)) AS tags
FROM leads JOIN customer ON c = c_custkey WHERE NOT is_deleted GROUP BY 1, 2, 3""",
            "o",
            leads=leads,
        ),
        "crm_companies_with_reports": _with(
            f"""
SELECT c AS company_id, name AS company_name, lpad(CAST(c AS STRING), 12, '0') AS bin, segment AS industry, c % 40 = 0 AS is_deleted, year, reports, income_total
FROM cust LEFT JOIN (SELECT company_tin, year, COUNT(*) AS reports, {_sum('income_total')} FROM silver GROUP BY 1, 2) f
ON lpad(CAST(c AS STRING), 12, '0') = company_tin""",
            "cust",
            "silver",
        ),
    }
    out["crm_incremental_load"] = out["crm_leads_silver"]
    out["crm_events_load"] = (
        "SELECT event_id, event_type, 'leads' AS entity_type, user_id AS entity_id, date_trunc('second', ts) AS created_at, "
        "CAST(year(ts) AS INTEGER) AS year FROM events"
    )
    return out


def _kept_up() -> dict[str, str]:
    """Summaries of the canonical table without deleted reports."""
    none = "CAST(NULL AS BIGINT)"
    sums = ", ".join(
        _sum(none if c == fl.SUPPORT_OLD else c, c) for c in (*fl.ANNUAL_SUMS, *fl.ANNUAL_TAX_SUMS)
    )
    annual = (
        f"SELECT service_request_id, year, COUNT(*) AS signed_quarters, {sums}, {_sum('tax_incentives', 'taxes_saved')} FROM live "
        "WHERE status = 'signed' AND report_type IN ('quarter1', 'quarter2', 'quarter3', 'quarter4') GROUP BY service_request_id, year"
    )
    totals = ", ".join(
        _raw_sum(c, n)
        for c, n in (
            ("signed_quarters", "total_signed_quarters"),
            ("income_total", "total_income"),
            ("income_international", "total_export"),
            ("taxes_saved", "total_taxes_saved"),
        )
    )
    quarter = ", ".join(_sum(none if c == fl.SUPPORT_OLD else c, c) for c in fl.QUARTER_SUMS)
    needs, live = ("silver", "rep"), {"live": AFTER_DELETES}
    return {
        "inc_summary_equals_full": _with(annual, *needs, **live),
        "inc_summary_totals_equals_full": _with(
            f"SELECT year, COUNT(*) AS companies_count, {totals} FROM ({annual}) GROUP BY year", *needs, **live
        ),
        "inc_summary_quarter_equals_full": _with(
            f"SELECT year, report_type, COUNT(*) AS total_reports, {quarter}, {_period('ru_short')} FROM live "
            "WHERE status = 'signed' AND op <> 'd' GROUP BY year, report_type",
            *needs,
            **live,
        ),
    }


def _incremental() -> dict[str, str]:
    columns = "id, service_request_id, year, report_type, status, op, updated_ts"
    newest = f"SELECT {columns}, has_data, {CARRIED} FROM ({_ranked('rep', 'id', 'updated_ts DESC, id DESC')}) WHERE op <> 'd'"
    return {
        "inc_changed_since": _with(f"SELECT {columns} FROM rep WHERE updated_at >= TIMESTAMP '1999-06-01 00:00:00'", "rep"),
        "inc_upsert_equals_full": _with(newest, "rep"),
        "inc_refresh_equals_full": _with(AFTER_DELETES, "silver", "rep"),
        **_kept_up(),
        "refresh_observed_counts": _with(
            "SELECT 'silver_reports' AS table_name, COUNT(*) AS cnt FROM silver UNION ALL SELECT 'silver_participants', COUNT(*) FROM participants "
            f"UNION ALL SELECT 'silver_companies', COUNT(*) FROM ({_silver()['silver_companies']}) UNION ALL SELECT 'report_certificates', COUNT(*) FROM resolved "
            + "".join(f"UNION ALL SELECT '{m}', COUNT(*) FROM resolved " for m in fl.MARTS)
            + "UNION ALL SELECT 'export_by_country', COUNT(*) FROM resolved JOIN valid_exports ON report_id = k",
            "resolved",
            "valid_exports",
        ),
        "stream_cdc_equals_batch": _with(newest, "rep"),
        "stream_replays_dropped": _versions()["win_drop_replays"],
        "refresh_released_marts": _gold()["gold_financing"],
        "refresh_silver_reports": _silver()["silver_reports_masked_first"],
        "refresh_silver_participants": _silver()["silver_participants"],
        "refresh_financing": _gold()["gold_financing"],
        "refresh_export_by_country": _gold()["gold_export_by_country"],
        "expr_previous_quarter": "SELECT o_orderkey AS id, CAST(year(o_orderdate - INTERVAL 3 MONTH) AS INTEGER) AS year, "
        "'quarter' || CAST(quarter(o_orderdate - INTERVAL 3 MONTH) AS STRING) AS report_type FROM orders",
        "expr_days_before": "SELECT o_orderkey AS id, CAST(CAST(o_orderdate AS DATE) - 45 AS DATE) AS cutoff FROM orders",
        "expr_labelled_digits": "SELECT c_custkey AS id, CASE WHEN c_custkey % 4 > 0 THEN CAST(c_custkey AS STRING) END AS digits FROM customer",
        "src_bound_sql": "SELECT o_orderkey AS id, o_orderstatus AS status FROM orders WHERE o_orderstatus = 'F' AND o_orderdate >= DATE '1994-06-01'",
        "src_rows": _with(
            "SELECT status, year, COUNT(*) AS cnt, CASE status WHEN 'draft' THEN 'Черновик' WHEN 'signed' THEN 'Подписан' END AS label "
            "FROM rep GROUP BY status, year",
            "rep",
        ),
    }


def _sinks() -> dict[str, str]:
    columns = ("id", "service_request_id", "report_type", "status", "updated_ts", *CARRIED.split(", "), "year")

    def rows(where: str = "TRUE", **instead: str) -> str:
        named = ", ".join(f"{instead[c]} AS {c}" if c in instead else c for c in columns)
        return _with(f"SELECT {named} FROM rep WHERE op IN ('r', 'c') AND ({where})", "rep")

    return {
        "sink_create_or_replace": rows("year >= 1998"),
        "sink_overwrite": rows("year < 1998"),
        "sink_append": rows(),
        "sink_overwrite_partitions": rows(status="CASE WHEN year = 1997 THEN 'kept' ELSE status END"),
        "sink_full_refresh": rows("year <> 1996"),
        "sink_years_backfill": rows("year <> 1997", status="CASE WHEN year = 1996 THEN status ELSE 'old' END"),
        "sink_delete_where": rows("NOT (status = 'draft' AND year IN (1996, 1998) OR year = 1997)"),
        "sink_truncate": rows("year = 1998"),
        "sink_load_time": rows(),
        # CSV does not tell an empty text from none.
        "sink_sorted_csv": _with(
            "SELECT " + ", ".join(c if c != "certificate_number" and c != "company_tin" else f"NULLIF({c}, '') AS {c}" for c in columns if c != "updated_ts")
            + ", row_number() OVER (ORDER BY year DESC, report_type, id DESC) AS line FROM rep WHERE op IN ('r', 'c')",
            "rep",
        ),
        "sink_sorted_summary": (
            "SELECT year, report_type, total_reports, income_total, period, row_number() OVER (ORDER BY year DESC, report_type) AS line "
            f"FROM ({_summaries()['sum_quarter']})"
        ),
        "sink_preview": _with(
            f"SELECT {', '.join(c for c in columns if c != 'updated_ts')} FROM rep WHERE op IN ('r', 'c') ORDER BY year DESC, report_type, id DESC LIMIT 10",
            "rep",
        ),
        "sink_upsert_by_key": rows(
            status="CASE WHEN year IN (1996, 1997) THEN status ELSE 'old' END",
            year="CAST(CASE WHEN year IN (1996, 1997) AND id % 2 = 0 THEN 1999 ELSE year END AS INTEGER)",
        ),
    }


def oracle_sql() -> dict[str, str]:
    families = (_versions, _silver, _gold, _summaries, _registries, _quality, _bi, _visits, _crm, _incremental, _sinks)
    out: dict[str, str] = {}
    for family in families:
        out |= family()
    return out
