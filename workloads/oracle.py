"""SQL for the checking engine, one text per registered query.

Written rule by rule in the plain form (one query per rule, window functions, self-joins), so
that it shares no structure with the fused plans it checks. Sums of fractions go through
decimals on both sides because their order differs.
"""

from __future__ import annotations

from gaugeframe import defaults
from workloads import views
from workloads.queries import AS_OF, BASELINE, DATASET, DECLARED, DRIFT_TABLES, PROFILED, RUN_ID, RUN_TS

ORACLE: dict[str, str] = {}
NOW = f"TIMESTAMP '{AS_OF}'"


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# ---------------------------------------------------------------- cleaned tables


def _case(column: str, aliases: dict[str, str], fallback: str) -> str:
    arms = " ".join(
        f"WHEN lower(trim({column})) = {quote(a)} THEN {quote(v)}" for a, v in aliases.items()
    )
    return f"NULLIF(CASE {arms} ELSE {fallback} END, '')"


# The spellings of states, grade bands and districts.
_STATES = {
    "ca": "CA", "cax": "CA", "nyc": "NY", "texas": "TX", "al": "AL", "alabama": "AL",
    "ak": "AK", "alaska": "AK", "az": "AZ", "arizona": "AZ", "california": "CA", "ny": "NY",
    "new york": "NY",
}
_GRADES = {
    "prek-2": "PreK-2", "k-2": "PreK-2", "grades pre k to 2": "PreK-2", "3-5": "3-5",
    "grades 3-5": "3-5", "third to fifth": "3-5", "6-8": "6-8", "grades 6-8": "6-8",
    "middle school": "6-8", "9-12": "9-12", "grades 9-12": "9-12", "high school": "9-12",
}
_DISTRICTS = {"nyc": "NYC Public Schools"}
_FORMATS = (
    "%Y-%m-%d %H:%M:%S", "%Y-%m-%d %H:%M", "%Y-%m-%d %I:%M %p", "%Y-%m-%dT%H:%M:%S%z",
    "%Y-%m-%dT%H:%M:%SZ", "%m/%d/%Y %H:%M:%S", "%m/%d/%Y %H:%M", "%B %d %Y %H:%M", "%Y-%m-%d",
)


def _text(c: str) -> str:
    return f"NULLIF(trim({c}), '') AS {c}"


def _lower(c: str) -> str:
    return f"NULLIF(lower(trim({c})), '') AS {c}"


def _time(c: str) -> str:
    formats = ", ".join(quote(f) for f in _FORMATS)
    return f"CAST(try_strptime(trim({c}), [{formats}]) AS TIMESTAMP) AS {c}"


_STATE = _case("state", _STATES, "upper(trim(state))") + " AS state"
_CLEAN = {
    "users": [_text("user_id"), _lower("email"), _text("org_id"), _lower("role"), _STATE,
              _text("district_id")],
    "districts": [_text("district_id"),
                  _case("district_name", _DISTRICTS, "trim(district_name)") + " AS district_name",
                  _STATE],
    "resources": [_text("resource_id"), _lower("type"), _text("subject"),
                  _case("grade_band", _GRADES, "trim(grade_band)") + " AS grade_band"],
    "events": [_text("event_id"), _text("user_id"), _text("resource_id"), _lower("event_type"),
               _time("event_ts")],
    "newsletter": [_lower("email"), _time("subscribed_at"), _time("opened_at"),
                   _time("clicked_at")],
}


def clean_select(name: str, extra: str = "") -> str:
    return f"SELECT {', '.join(_CLEAN[name])}{extra} FROM ({views.RAW[name]}) raw_{name}"


for _name in _CLEAN:
    ORACLE[f"clean_{_name}"] = clean_select(_name)

_EXTRA = {"resources": ", view_count"}


def staged(*names: str, more: str = "") -> str:
    """CTEs of the cleaned tables, named as the tables are."""
    ctes = [
        f"c_{n} AS MATERIALIZED ({clean_select(n, _EXTRA.get(n, '') + more)})" for n in names or _CLEAN
    ]
    return "WITH " + ",\n".join(ctes)


ORACLE["stable_ids"] = """
WITH d AS (
  SELECT o_orderkey, sha1(unhex('3c2f0d465df04c889a5ddcbf6f3d43e9') ||
         encode(concat('phase1-42-order-', cast(o_orderkey AS varchar)))) AS h FROM orders
)
SELECT o_orderkey, concat_ws('-', h[1:8], h[9:12], concat('5', h[14:16]),
  concat(CASE WHEN h[17] IN ('0','4','8','c') THEN '8' WHEN h[17] IN ('1','5','9','d') THEN '9'
              WHEN h[17] IN ('2','6','a','e') THEN 'a' ELSE 'b' END, h[18:20]), h[21:32]) AS stable_id
FROM d
"""

# ---------------------------------------------------------------- single rules


def null_rows(t: str, c: str) -> str:
    return f"SELECT * FROM {t} WHERE {c} IS NULL"


def pattern_rows(t: str, c: str, regex: str) -> str:
    return f"SELECT * FROM {t} WHERE {c} IS NOT NULL AND NOT regexp_matches(trim({c}), {quote(regex)})"


def range_rows(t: str, c: str, start: str, end: str) -> str:
    return f"SELECT * FROM {t} WHERE {c} IS NOT NULL AND ({c} < {start} OR {c} > {end})"


def order_rows(t: str, *columns: str) -> str:
    steps = [f"({b} IS NOT NULL AND ({a} IS NULL OR {a} > {b}))" for a, b in zip(columns, columns[1:])]
    return f"SELECT * FROM {t} WHERE {' OR '.join(steps)}"


def enum_rows(t: str, c: str, *values: str) -> str:
    allowed = ", ".join(quote(v.lower()) for v in values)
    return f"SELECT * FROM {t} WHERE {c} IS NOT NULL AND lower(trim({c})) NOT IN ({allowed})"


def mapping_rows(t: str, key: str, value: str) -> str:
    return (
        f"SELECT * FROM {t} WHERE {key} IN (SELECT {key} FROM {t} WHERE {key} IS NOT NULL "
        f"GROUP BY {key} HAVING count(DISTINCT {value}) > 1)"
    )


def duplicate_rows(t: str, *columns: str) -> str:
    keys = ", ".join(columns)
    return (
        f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {columns[0]}) "
        f"AS dq_rank FROM {t}) WHERE dq_rank > 1"
    )


def orphan_rows(t: str, c: str, ref: str, key: str) -> str:
    return (
        f"SELECT s.* FROM {t} s LEFT JOIN {ref} r ON s.{c} = r.{key} "
        f"WHERE s.{c} IS NOT NULL AND r.{key} IS NULL"
    )


def negative_count(*columns: tuple[str, str]) -> tuple[str, str]:
    if not columns:
        return "0", "0"
    failures = " + ".join(f"(SELECT count(*) FROM {t} WHERE {c} < 0)" for t, c in columns)
    totals = " + ".join(f"(SELECT count(*) FROM {t})" for t, _ in columns)
    return failures, totals


def counted(failing: str, t: str) -> tuple[str, str]:
    return f"(SELECT count(*) FROM ({failing}) f)", f"(SELECT count(*) FROM {t})"


def _test_query(ctes: str, *checks: tuple[str, str, tuple[str, str]]) -> str:
    rows = " UNION ALL ".join(
        f"SELECT {quote(i)} AS check_id, {quote(kind)} AS issue_type, "
        f"CAST({f} AS BIGINT) AS failure_count, CAST({n} AS BIGINT) AS total_rows"
        for i, kind, (f, n) in checks
    )
    head = f"{ctes}," if ctes else "WITH"
    return f"""{head} n AS ({rows}),
r AS (SELECT *, CASE WHEN total_rows > 0 THEN failure_count::DOUBLE / total_rows::DOUBLE
                     ELSE 0.0::DOUBLE END AS failure_rate FROM n)
SELECT check_id, issue_type, failure_count, total_rows, failure_rate,
  CASE WHEN failure_rate >= 0.05::DOUBLE THEN 'fail' WHEN failure_rate >= 0.01::DOUBLE THEN 'warn'
       ELSE 'pass' END AS status,
  failure_rate * (3::DOUBLE / 5::DOUBLE) * 1.5::DOUBLE AS penalty
FROM r"""


EMAIL = r"^[^\s@]+@[^\s@]+\.[^\s@]+$"

ORACLE["rule_null_percentage"] = _test_query(
    staged("users", "events"),
    ("users_email", "missing", counted(null_rows("c_users", "email"), "c_users")),
    ("users_state", "missing", counted(null_rows("c_users", "state"), "c_users")),
    ("events_ts", "missing", counted(null_rows("c_events", "event_ts"), "c_events")),
)
ORACLE["rule_pattern"] = _test_query(
    staged("users"),
    ("email_format", "invalid", counted(pattern_rows("c_users", "email", EMAIL), "c_users")),
    ("state_code", "invalid", counted(pattern_rows("c_users", "state", "^[A-Z]{2}$"), "c_users")),
    ("has_digit", "invalid", counted(pattern_rows("documents", "text", "[0-9]"), "documents")),
)
ORACLE["rule_date_range"] = _test_query(
    "",
    ("orders", "invalid", counted(range_rows("orders", "o_orderdate",
        "TIMESTAMP '1996-01-01'", "TIMESTAMP '2000-12-31'"), "orders")),
    ("shipped", "invalid", counted(range_rows("lineitem", "l_shipdate",
        "TIMESTAMP '1995-06-01'", NOW), "lineitem")),
    ("events", "invalid", counted(range_rows("events", "ts", "TIMESTAMP '1900-01-01'", NOW), "events")),
)
ORACLE["rule_non_negative"] = _test_query(
    "",
    ("balances", "invalid", negative_count(("customer", "c_acctbal"), ("supplier", "s_acctbal"))),
    ("quantities", "invalid", negative_count(("part", "p_size"), ("part", "p_retailprice"),
        ("lineitem", "l_quantity"), ("lineitem", "l_extendedprice"))),
    ("nothing", "invalid", negative_count()),
)
ORACLE["rule_timestamp_order"] = _test_query(
    staged("newsletter"),
    ("order", "inconsistency", counted(
        order_rows("c_newsletter", "subscribed_at", "opened_at", "clicked_at"), "c_newsletter")),
)
ORACLE["rule_enum"] = _test_query(
    staged("users", "resources"),
    ("role", "invalid", counted(enum_rows("c_users", "role", "student", "teacher", "admin",
        "district_admin", "other"), "c_users")),
    ("grade", "invalid", counted(enum_rows("c_resources", "grade_band", "PreK-2", "3-5", "6-8",
        "9-12"), "c_resources")),
    ("priority", "invalid", counted(enum_rows("orders", "o_orderpriority", "1-URGENT", "2-HIGH",
        "3-MEDIUM"), "orders")),
)
ORACLE["rule_unique_mapping"] = _test_query(
    staged("districts"),
    ("district_names", "inconsistency", counted(
        mapping_rows("c_districts", "district_name", "district_id"), "c_districts")),
    ("part_supplier", "inconsistency", counted(
        mapping_rows("lineitem", "l_partkey", "l_suppkey"), "lineitem")),
    ("line_flag", "inconsistency", counted(
        mapping_rows("lineitem", "l_returnflag", "l_linestatus"), "lineitem")),
    ("event_user", "inconsistency", counted(mapping_rows("events", "event_id", "user_id"), "events")),
)
ORACLE["rule_duplicate"] = _test_query(
    staged("users", "events"),
    ("email", "duplicate", counted(duplicate_rows("c_users", "email"), "c_users")),
    ("event_id", "duplicate", counted(duplicate_rows("c_events", "event_id"), "c_events")),
    ("text", "duplicate", counted(duplicate_rows("documents", "text"), "documents")),
)
ORACLE["rule_duplicate_compound"] = _test_query(
    staged("users"),
    ("lines", "duplicate", counted(duplicate_rows("lineitem", "l_orderkey", "l_linenumber"), "lineitem")),
    ("flags", "duplicate", counted(duplicate_rows("lineitem", "l_returnflag"), "lineitem")),
    ("supplied", "inconsistency", counted(mapping_rows("lineitem", "l_orderkey", "l_linenumber"), "lineitem")),
    ("email_org", "duplicate", counted(duplicate_rows("c_users", "email", "org_id"), "c_users")),
)
ORACLE["rule_foreign_key"] = _test_query(
    staged("users", "districts", "resources", "events"),
    ("event_user", "orphan", counted(orphan_rows("c_events", "user_id", "c_users", "user_id"), "c_events")),
    ("event_resource", "orphan", counted(
        orphan_rows("c_events", "resource_id", "c_resources", "resource_id"), "c_events")),
    ("user_district", "orphan", counted(
        orphan_rows("c_users", "district_id", "c_districts", "district_id"), "c_users")),
    ("line_order", "orphan", counted(orphan_rows("lineitem", "l_orderkey", "orders", "o_orderkey"), "lineitem")),
    ("document_label", "orphan", counted(orphan_rows("documents", "doc_id", "labels", "doc_id"), "documents")),
)

# ---------------------------------------------------------------- failing rows

ORACLE["rule_pattern_rows"] = f"{staged('users')} {pattern_rows('c_users', 'email', EMAIL)}"
ORACLE["rule_unique_mapping_rows_hot_key"] = """
SELECT * FROM lineitem WHERE l_returnflag IN (
  SELECT l_returnflag FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_linestatus) > 1)"""
ORACLE["rule_fk_rows_hot_key"] = """
SELECT * FROM lineitem WHERE l_returnflag NOT IN (
  SELECT l_returnflag FROM lineitem WHERE l_returnflag <> 'N')"""
ORACLE["rule_fk_failing_rows"] = (
    f"{staged('users', 'events')} SELECT * FROM "
    f"({orphan_rows('c_events', 'user_id', 'c_users', 'user_id')})"
)
ORACLE["rule_unique_mapping_rows"] = mapping_rows("lineitem", "l_partkey", "l_suppkey")
ORACLE["rule_duplicate_rows"] = (
    f"SELECT l_orderkey, l_linenumber, dq_rank FROM ({duplicate_rows('lineitem', 'l_orderkey', 'l_linenumber')})"
)
ORACLE["rule_duplicate_rows_hot_key"] = (
    f"SELECT l_returnflag, dq_rank FROM ({duplicate_rows('lineitem', 'l_returnflag')})"
)
ORACLE["rule_negative_rows"] = (
    "SELECT c_custkey, c_acctbal, 'c_acctbal' AS failed_column FROM customer WHERE c_acctbal < 0"
)

# ---------------------------------------------------------------- the built-in checks

# check -> (failing rows, table); the column sweep is counted separately.
_FAILING = {
    "users_email_not_null": (null_rows("c_users", "email"), "users"),
    "events_event_ts_not_null": (null_rows("c_events", "event_ts"), "events"),
    "users_state_not_null": (null_rows("c_users", "state"), "users"),
    "users_district_id_not_null": (null_rows("c_users", "district_id"), "users"),
    "events_resource_id_not_null": (null_rows("c_events", "resource_id"), "events"),
    "resources_resource_id_not_null": (null_rows("c_resources", "resource_id"), "resources"),
    "users_email_format": (pattern_rows("c_users", "email", EMAIL), "users"),
    "users_state_valid": (pattern_rows("c_users", "state", "^[A-Z]{2}$"), "users"),
    "districts_state_valid": (pattern_rows("c_districts", "state", "^[A-Z]{2}$"), "districts"),
    "events_event_ts_date_range": (
        range_rows("c_events", "event_ts", "TIMESTAMP '1900-01-01'", NOW), "events"),
    "newsletter_subscribed_at_date_range": (
        range_rows("c_newsletter", "subscribed_at", "TIMESTAMP '2000-01-01'", NOW), "newsletter"),
    "newsletter_opened_at_date_range": (
        range_rows("c_newsletter", "opened_at", "TIMESTAMP '2000-01-01'", NOW), "newsletter"),
    "newsletter_clicked_at_date_range": (
        range_rows("c_newsletter", "clicked_at", "TIMESTAMP '2000-01-01'", NOW), "newsletter"),
    "newsletter_timestamps_order": (
        order_rows("c_newsletter", "subscribed_at", "opened_at", "clicked_at"), "newsletter"),
    "resource_grade_band_values": (
        enum_rows("c_resources", "grade_band", "PreK-2", "3-5", "6-8", "9-12"), "resources"),
    "resources_type_normalized": (
        enum_rows("c_resources", "type", "lesson", "assessment", "activity", "module", "pathway"),
        "resources"),
    "users_role_normalized": (
        enum_rows("c_users", "role", "student", "teacher", "admin", "district_admin", "other"),
        "users"),
    "districts_name_to_id_unique": (
        mapping_rows("c_districts", "district_name", "district_id"), "districts"),
    "users_email_unique": (duplicate_rows("c_users", "email"), "users"),
    "events_pk_unique": (duplicate_rows("c_events", "event_id"), "events"),
    "resources_resource_id_unique": (duplicate_rows("c_resources", "resource_id"), "resources"),
    "users_user_id_unique": (duplicate_rows("c_users", "user_id"), "users"),
    "users_email_org_unique": (duplicate_rows("c_users", "email", "org_id"), "users"),
    "events_user_fk": (orphan_rows("c_events", "user_id", "c_users", "user_id"), "events"),
    "events_resource_fk": (
        orphan_rows("c_events", "resource_id", "c_resources", "resource_id"), "events"),
    "users_district_fk": (
        orphan_rows("c_users", "district_id", "c_districts", "district_id"), "users"),
}


def _rule_values() -> str:
    """The declared rules. Configuration, the same for both sides."""
    rows = []
    for rule in defaults.RULES:
        known = defaults.RULES.causes_of(rule.id)
        cause = known[0].probable_cause if known else rule.description
        fix = (
            known[0].recommended_fix if known
            else f"Enforce {rule.rule_type} for {rule.table}"
        )
        stage = "*" if rule.table == "*" else f"staging_{rule.table}"
        causes = "[]" if not known else (
            f'[{{"probable_cause":"{cause}","recommended_fix":"{fix}"}}]'
        )
        texts = [rule.id, rule.table, stage, rule.dimension, rule.description, rule.rule_type,
                 ",".join(rule.columns)]
        numbers = [f"{rule.severity}::INTEGER"] + [
            f"{x}::DOUBLE" for x in (rule.weight, rule.warning, rule.fail)
        ]
        regex = "NULL::VARCHAR" if rule.column_regex is None else quote(rule.column_regex)
        rows.append(
            "(" + ", ".join([*map(quote, texts), regex, *numbers,
                             *map(quote, (rule.issue_type, cause, fix, causes))]) + ")"
        )
    return (
        "(VALUES " + ", ".join(rows) + ") v(check_id, table_name, stage_table, dimension, "
        "description, rule_type, columns, column_regex, severity, weight, threshold_warning, "
        "threshold_fail, issue_type, probable_root_cause, recommended_fix, root_cause_candidates)"
    )


_JUDGE = """
rated AS (
  SELECT v.*, n.* EXCLUDE (check_id),
    CASE WHEN n.total_rows > 0 THEN n.failure_count::DOUBLE / n.total_rows::DOUBLE
         ELSE 0.0::DOUBLE END AS failure_rate
  FROM counts n JOIN {rules} ON n.check_id = v.check_id
),
checks AS (
  SELECT *, CASE WHEN failure_rate >= threshold_fail THEN 'fail'
                 WHEN failure_rate >= threshold_warning THEN 'warn' ELSE 'pass' END AS status,
    failure_rate * (severity::DOUBLE / 5::DOUBLE) * weight AS penalty
  FROM rated
)"""


def _checks() -> str:
    rows = [
        f"SELECT {quote(check_id)} AS check_id, CAST({f} AS BIGINT) AS failure_count, "
        f"CAST({n} AS BIGINT) AS total_rows"
        for check_id, (failing, t) in _FAILING.items()
        for f, n in [counted(failing, f"c_{t}")]
    ]
    f, n = negative_count(("c_resources", "view_count"))
    rows.append(
        f"SELECT 'numeric_counts_non_negative', CAST({f} AS BIGINT), CAST({n} AS BIGINT)"
    )
    return f"{staged()}, counts AS ({' UNION ALL '.join(rows)}), {_JUDGE.format(rules=_rule_values())}"


CHECKS = _checks()
_STAMP = f"{quote(RUN_ID)} AS run_id, {quote(DATASET)} AS dataset_name"
_ISSUES = f"""{CHECKS}, issues AS (
  SELECT {_STAMP}, {quote(RUN_TS)} AS run_ts, table_name, check_id AS check_name, dimension,
    issue_type, severity, failure_count AS affected_rows, failure_rate AS affected_pct,
    probable_root_cause, recommended_fix, root_cause_candidates
  FROM checks WHERE failure_count > 0)"""

ORACLE["check_results"] = f"""{CHECKS}
SELECT {_STAMP}, table_name, stage_table, check_id, dimension, description, rule_type, columns,
  column_regex, severity, weight, threshold_warning, threshold_fail, failure_rate, failure_count,
  total_rows, status, penalty FROM checks"""
ORACLE["expectation_stats"] = f"""{CHECKS}
SELECT count(*) AS evaluated_expectations,
  count(*) FILTER (WHERE failure_count = 0) AS successful_expectations,
  count(*) FILTER (WHERE failure_count <> 0) AS unsuccessful_expectations,
  count(*) FILTER (WHERE failure_count = 0)::DOUBLE / count(*)::DOUBLE * 100 AS success_percent,
  bool_and(failure_count = 0) AS success FROM checks"""
ORACLE["expectation_results"] = f"""{CHECKS}
SELECT check_id, table_name, dimension, failure_count = 0 AS success,
  failure_count AS unexpected_count, failure_rate * 100 AS unexpected_percent FROM checks"""
ORACLE["run_row_counts"] = f"""
SELECT {_STAMP}, {quote(RUN_TS)} AS run_ts, concat('{{',
  '"customer":', (SELECT count(*) FROM customer), ',"documents":', (SELECT count(*) FROM documents),
  ',"events":', (SELECT count(*) FROM events), ',"lineitem":', (SELECT count(*) FROM lineitem),
  ',"orders":', (SELECT count(*) FROM orders), ',"pages":', (SELECT count(*) FROM pages),
  '}}') AS total_rows_by_table"""

# ---------------------------------------------------------------- samples


def _iso(c: str) -> str:
    return (
        f"CASE WHEN date_part('us', {c}) % 1000000 = 0 THEN strftime({c}, '%Y-%m-%dT%H:%M:%S') "
        f"ELSE strftime({c}, '%Y-%m-%dT%H:%M:%S.%f') END"
    )


_COLUMNS = {
    "users": ["user_id", "email", "org_id", "role", "state", "district_id"],
    "districts": ["district_id", "district_name", "state"],
    "resources": ["view_count", "resource_id", "type", "subject", "grade_band"],
    "events": ["event_id", "user_id", "resource_id", "event_type", "event_ts"],
    "newsletter": ["email", "subscribed_at", "opened_at", "clicked_at"],
}


def _as_text(c: str) -> str:
    return _iso(c) if c.endswith(("_ts", "_at")) else f"CAST({c} AS VARCHAR)"


def _json(columns: list[str], extra: str = "") -> str:
    fields = ", ".join(f"{c} := {_as_text(c)}" for c in columns)
    return f"CAST(to_json(struct_pack({fields}{extra})) AS VARCHAR)"


def _order(columns: list[str]) -> str:
    return ", ".join(f"{_as_text(c)} NULLS FIRST" for c in columns)


def _first_five(check_id: str, rows: str, table: str, extra: str = "") -> str:
    columns = _COLUMNS[table]
    return (
        f"SELECT {quote(check_id)} AS check_id, place, row FROM (SELECT {_json(columns, extra)} AS row, "
        f"row_number() OVER (ORDER BY {_order(columns)}) AS place FROM ({rows})) WHERE place <= 5"
    )


def _few_keys(keys: str, failing: str) -> str:
    """The first five offending keys."""
    listed = keys.split(", ")
    order = ", ".join(f"{k} NULLS FIRST" for k in listed)
    return f"SELECT {keys} FROM ({failing}) GROUP BY {keys} ORDER BY {order} LIMIT 5"


def _sample_parts() -> list[str]:
    parts = []
    for check_id, (failing, table) in _FAILING.items():
        rule = defaults.RULES.only(check_id).rules[0]
        if rule.kind == "DUPLICATE_PERCENTAGE":
            keys = ", ".join(rule.columns)
            same = " AND ".join(f"t.{k} IS NOT DISTINCT FROM k.{k}" for k in rule.columns)
            order = ", ".join(f"{k} NULLS FIRST" for k in rule.columns)
            columns = _COLUMNS[table]
            parts.append(f"""
SELECT {quote(check_id)} AS check_id, place, row FROM (
  SELECT row_number() OVER (ORDER BY {order}, dq_rank) AS place,
    {_json(columns, ", dq_rank := CAST(dq_rank AS VARCHAR)")} AS row
  FROM (SELECT t.*, row_number() OVER (PARTITION BY {", ".join("t." + k for k in rule.columns)}
          ORDER BY {", ".join(f"{_as_text('t.' + c)} NULLS FIRST" for c in columns)}) AS dq_rank
        FROM c_{table} t JOIN ({_few_keys(keys, failing)}) k ON {same})
  WHERE dq_rank > 1) WHERE place <= 5""")
        elif rule.kind in ("UNIQUE_MAPPING", "FK"):
            key = rule.args[0] if rule.kind == "UNIQUE_MAPPING" else rule.columns[0]
            rows = f"SELECT * FROM c_{table} WHERE {key} IN ({_few_keys(key, failing)})"
            parts.append(_first_five(check_id, rows, table))
        else:
            parts.append(_first_five(check_id, failing, table))
    parts.append(_first_five(
        "numeric_counts_non_negative", "SELECT * FROM c_resources WHERE view_count < 0",
        "resources", ", failed_column := 'view_count'",
    ))
    return parts


_SAMPLES = " UNION ALL ".join(_sample_parts())
ORACLE["rule_samples"] = (
    f"{staged()} SELECT check_id, CAST(place AS INTEGER) AS place, row FROM ({_SAMPLES})"
)
ORACLE["issue_log"] = f"""{_ISSUES}, samples AS (
  SELECT check_id, concat('[', string_agg(row, ',' ORDER BY place), ']') AS sample_bad_rows_json
  FROM ({_SAMPLES}) GROUP BY check_id)
SELECT i.*, s.sample_bad_rows_json FROM issues i JOIN samples s ON s.check_id = i.check_name"""
ORACLE["exceptions_export"] = f"""SELECT check_name, table_name, dimension, issue_type, severity,
  affected_rows, affected_pct, probable_root_cause, recommended_fix, sample_bad_rows_json
FROM ({ORACLE["issue_log"]})"""

# ---------------------------------------------------------------- scores


def _score(group: str) -> str:
    return f"""
SELECT {group} sum(penalty::DECIMAL(38,12))::DOUBLE AS total_penalty,
  sum(weight::DECIMAL(38,12))::DOUBLE AS total_weight, count(*) AS total_checks,
  greatest(0.0::DOUBLE, 100.0::DOUBLE - 100 * (sum(penalty::DECIMAL(38,12))::DOUBLE
    / sum(weight::DECIMAL(38,12))::DOUBLE)) AS score
FROM checks"""


ORACLE["score_overall"] = f"{CHECKS} {_score('')}"
ORACLE["score_dimensions"] = f"""{CHECKS}
SELECT *, CAST(row_number() OVER (ORDER BY score DESC, dimension) AS INTEGER) AS rank
FROM ({_score('dimension,')} GROUP BY dimension)"""
for _way in ("map", "broadcast", "split_join"):
    ORACLE[f"canonical_by_{_way}"] = """
SELECT o_orderkey, coalesce(v.segment, 'unknown') AS customer
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'customer#000000001'
        ELSE concat('customer#', lpad(CAST(o_custkey AS VARCHAR), 9, '0')) END AS name FROM orders) o
LEFT JOIN (SELECT lower(c_name) AS name, min(c_mktsegment) AS segment FROM customer
           WHERE c_custkey % 5 <> 0 GROUP BY 1) v ON v.name = o.name"""
# What each spelling of the query keeps of the time, in its order.
_KEPT = ("day", "second", "minute", "hour", "hour", "day", "second", "minute", "minute", "minute", "second")
ORACLE["parsed_times"] = (
    "SELECT o_orderkey, CASE o_orderkey % 11 "
    + " ".join(f"WHEN {i} THEN date_trunc('{unit}', moment)" for i, unit in enumerate(_KEPT))
    + " END AS parsed FROM (SELECT o_orderkey, date_trunc('day', CAST(o_orderdate AS TIMESTAMP))"
    " + to_seconds(o_orderkey % 86400) AS moment FROM orders)"
)
ORACLE["score_record"] = f"""{CHECKS}
SELECT {_STAMP}, {quote(RUN_TS)} AS run_ts, score, 100.0::DOUBLE AS baseline,
  0.0::DOUBLE AS minimum, total_penalty, total_weight, total_checks,
  (SELECT count(*) FROM checks WHERE failure_count > 0) AS failed_checks,
  (SELECT concat('{{', string_agg(concat('"', dimension, '":', CAST(score AS VARCHAR)), ',' ORDER BY dimension), '}}')
   FROM ({_score('dimension,')} GROUP BY dimension)) AS subscores FROM ({_score('')})"""
ORACLE["check_summary"] = f"""{CHECKS}
SELECT check_id, table_name, dimension, description, status, failure_rate, threshold_warning,
  threshold_fail, severity, weight, penalty, NULL::VARCHAR AS issue_type,
  CAST(row_number() OVER (ORDER BY status, failure_rate DESC, check_id) AS INTEGER) AS rank FROM checks"""
ORACLE["issue_preview"] = f"""{_ISSUES}
SELECT run_id, table_name, check_name, issue_type, severity, affected_pct, probable_root_cause,
  recommended_fix FROM issues ORDER BY severity DESC, affected_pct DESC, check_name LIMIT 12"""
ORACLE["issue_counts"] = (
    f"{_ISSUES} SELECT issue_type, count(*) AS issue_count FROM issues GROUP BY issue_type"
)

# ---------------------------------------------------------------- gate and project metrics

_CRITICAL = "status = 'fail' AND severity >= 5"
ORACLE["gate_verdict"] = f"""{CHECKS}, s AS (SELECT round(score, 2) AS score FROM ({_score('')})),
k AS (SELECT coalesce(string_agg(concat(check_id, ' (', table_name, ')'), ', '
        ORDER BY concat(check_id, ' (', table_name, ')')), '') AS critical_checks
      FROM checks WHERE {_CRITICAL}),
v AS (SELECT *, CASE WHEN score < 90 THEN printf('overall score %.2f is below threshold 90.00', score)
    WHEN critical_checks <> '' THEN concat('critical checks failed: ', critical_checks,
      ' (severity >= 5.0)') END AS reason FROM s, k)
SELECT *, reason IS NULL AS passed FROM v"""
ORACLE["status_counts"] = f"""{CHECKS}
SELECT count(*) FILTER (WHERE status = 'pass') AS passed_checks,
  count(*) FILTER (WHERE status = 'warn') AS warning_checks,
  count(*) FILTER (WHERE status = 'fail') AS failed_checks FROM checks"""
ORACLE["critical_failures"] = (
    f"{CHECKS} SELECT count(*) AS critical_failed_checks FROM checks WHERE {_CRITICAL}"
)
_MEASURES = """SELECT count(*) AS total_issues, CAST(max(severity) AS INTEGER) AS max_severity,
  max(affected_pct) AS max_affected_pct,
  round(count(*) FILTER (WHERE trim(probable_root_cause) <> '' AND trim(recommended_fix) <> '')::DOUBLE
    / count(*)::DOUBLE, 4) AS issue_root_cause_coverage_pct FROM issues"""
ORACLE["root_cause_coverage"] = f"{_ISSUES} {_MEASURES}"
ORACLE["rule_summary"] = f"{CHECKS} " + " UNION ALL ".join(
    f"SELECT {quote(g)} AS grouping, CAST({g} AS VARCHAR) AS value, count(*) AS rules "
    f"FROM checks GROUP BY {g}"
    for g in ("dimension", "table_name", "rule_type", "severity")
)
ORACLE["rule_totals"] = f"""{CHECKS}
SELECT count(*) AS total_rules, round(sum(weight::DECIMAL(38,12))::DOUBLE, 2) AS total_weight,
  round(count(*) FILTER (WHERE description <> '')::DOUBLE / count(*)::DOUBLE, 4)
    AS documentation_coverage_pct FROM checks"""


def _comparison() -> str:
    expected = [("score", "overall", BASELINE["score"]), ("failed_checks", "checks", BASELINE["failed_checks"])]
    expected += [("subscore", k, v) for k, v in BASELINE["subscores"].items()]
    expected += [("issue_count", k, v) for k, v in BASELINE["issue_counts"].items()]
    values = ", ".join(f"({quote(k)}, {quote(n)}, {v}::DOUBLE)" for k, n, v in expected)
    return f"""{_ISSUES}, actual AS (
  SELECT 'score' AS kind, 'overall' AS name, round(score, 2) AS value FROM ({_score('')})
  UNION ALL SELECT 'subscore', dimension, round(score, 2) FROM ({_score('dimension,')} GROUP BY dimension)
  UNION ALL SELECT 'issue_count', issue_type, count(*)::DOUBLE FROM issues GROUP BY issue_type
  UNION ALL SELECT 'failed_checks', 'checks', count(*)::DOUBLE FROM issues),
comparison AS (
  SELECT kind, name, e.value AS expected, a.value AS actual,
    round(coalesce(a.value, 0.0) - coalesce(e.value, 0.0), 4) AS delta,
    CASE WHEN kind = 'subscore' THEN a.value IS NOT NULL AND abs(a.value - e.value) <= 0.01
         WHEN kind = 'score' THEN abs(a.value - e.value) <= 0.01
         ELSE coalesce(a.value, 0.0) = coalesce(e.value, 0.0) END AS matches
  FROM (VALUES {values}) e(kind, name, value) FULL OUTER JOIN actual a USING (kind, name)
  WHERE kind <> 'subscore' OR e.value IS NOT NULL)"""


ORACLE["baseline_compare"] = f"{_comparison()} SELECT * FROM comparison"
ORACLE["baseline_verdict"] = f"""{_comparison()}
SELECT bool_and(matches) AS matched, (SELECT concat(kind, ' ', name, ': expected ',
    coalesce(CAST(expected AS VARCHAR), 'none'), ' vs actual ', coalesce(CAST(actual AS VARCHAR), 'none')) FROM comparison
  WHERE NOT matches ORDER BY CASE kind WHEN 'score' THEN 1 WHEN 'failed_checks' THEN 2
    WHEN 'issue_count' THEN 3 ELSE 4 END, name LIMIT 1) AS reason FROM comparison"""

_DAY = "strftime(ts, '%Y-%m-%d')"
ORACLE["history_upsert"] = f"""
WITH e AS (SELECT *, concat('run-', {_DAY}) AS run_id, concat('w', user_id % 5) AS workflow_run_id
           FROM events),
rows AS (
  SELECT run_id, workflow_run_id, '1' AS workflow_attempt, '2024-02-01T00:00:00' AS generated_at,
    count(*) AS total_events, NULL::BIGINT AS errors, 0 AS attempt FROM e GROUP BY run_id, workflow_run_id
  UNION ALL
  SELECT run_id, workflow_run_id, '1', '2024-02-02T00:00:00', count(*) * 10,
    count(*) FILTER (WHERE event_type = 'error'), 1 FROM e WHERE run_id >= 'run-2024-01-15'
  GROUP BY run_id, workflow_run_id)
SELECT * EXCLUDE (attempt, place) FROM (SELECT *, row_number() OVER (
  PARTITION BY run_id, workflow_run_id, workflow_attempt ORDER BY attempt DESC) AS place FROM rows)
WHERE place = 1"""

# ---------------------------------------------------------------- history: every day is a run


def _daily() -> str:
    """All checks of each day, one aggregate per check."""
    mapped = (
        "SELECT * FROM c_districts d WHERE district_name IS NOT NULL AND (SELECT count(DISTINCT x.district_id) "
        "FROM c_districts x WHERE x.day = d.day AND x.district_name = d.district_name) > 1"
    )
    failing = {**_FAILING, "numeric_counts_non_negative": (
        "SELECT * FROM c_resources WHERE view_count < 0", "resources")}
    parts = []
    for check_id, (rows, t) in failing.items():
        rule = defaults.RULES.only(check_id).rules[0]
        if rule.kind == "DUPLICATE_PERCENTAGE":
            rows = duplicate_rows(f"c_{t}", "day", *rule.columns)
        elif rule.kind == "UNIQUE_MAPPING":
            rows = mapped
        parts.append(
            f"SELECT {quote(check_id)} AS check_id, concat('run-', day) AS run_id, concat(day, 'T00:00:00') "
            f"AS run_ts, {quote(DATASET)} AS dataset_name, CAST(coalesce(f.n, 0) AS BIGINT) AS failure_count, "
            f"t.n AS total_rows FROM (SELECT day, count(*) AS n FROM c_{t} GROUP BY day) t "
            f"LEFT JOIN (SELECT day, count(*) AS n FROM ({rows}) GROUP BY day) f USING (day)"
        )
    return (
        f"{staged(more=', day')}, counts AS ({' UNION ALL '.join(parts)}), "
        f"{_JUDGE.format(rules=_rule_values())}"
    )


_HISTORY = f"""{_daily()}, history AS (
  SELECT run_id, run_ts, dataset_name, table_name, check_id AS check_name, dimension, issue_type,
    severity, failure_count AS affected_rows, failure_rate AS affected_pct, probable_root_cause,
    recommended_fix, root_cause_candidates FROM checks WHERE failure_count > 0)"""
ORACLE["issue_history_daily"] = f"{_HISTORY} SELECT *, '[]' AS sample_bad_rows_json FROM history"
_RECURRENCE = """
SELECT check_name, table_name, issue_type, count(run_id) AS occurrences,
  median(affected_pct) AS median_affected_pct, max(CAST(run_ts AS TIMESTAMP)) AS last_seen,
  arg_max(probable_root_cause, run_ts) AS probable_root_cause,
  arg_max(recommended_fix, run_ts) AS recommended_fix
FROM history GROUP BY check_name, table_name, issue_type
ORDER BY occurrences DESC, last_seen DESC, check_name"""
ORACLE["recurrence_top"] = f"{_HISTORY} {_RECURRENCE} LIMIT 10"
ORACLE["recurring_count"] = (
    f"{_HISTORY} SELECT count(*) AS recurring_issue_count FROM ({_RECURRENCE}) WHERE occurrences > 1"
)
_LIFECYCLE = """
SELECT concat(table_name, '|', check_name, '|', issue_type) AS issue_key,
  min(CAST(run_ts AS TIMESTAMP)) AS first_seen_run_ts, max(CAST(run_ts AS TIMESTAMP)) AS last_seen_run_ts,
  arg_min(run_id, run_ts) AS first_seen_run_id, arg_max(run_id, run_ts) AS last_seen_run_id,
  count(run_id) AS occurrence_count, table_name, check_name, max(dimension) AS dimension, issue_type,
  max(severity) AS severity, max(affected_pct) AS max_affected_pct,
  median(affected_pct) AS median_affected_pct, max(probable_root_cause) AS probable_root_cause,
  max(recommended_fix) AS recommended_fix,
  CASE WHEN max(run_ts) = (SELECT max(run_ts) FROM history) THEN 'open'
       ELSE 'not_seen_in_latest_run' END AS status
FROM history GROUP BY table_name, check_name, issue_type"""
ORACLE["issue_lifecycle"] = f"{_HISTORY} {_LIFECYCLE}"
_STAGES = f"""SELECT count(*) FILTER (WHERE status = 'open') AS open_issue_count,
  count(*) FILTER (WHERE status = 'open' AND occurrence_count = 1) AS new_issue_count,
  count(*) FILTER (WHERE status = 'open' AND occurrence_count > 1) AS recurring_issue_count,
  count(*) FILTER (WHERE status <> 'open') AS resolved_or_not_seen_issue_count FROM ({_LIFECYCLE})"""
ORACLE["lifecycle_counts"] = f"{_HISTORY} {_STAGES}"
_DAYS = """days AS (
  SELECT concat('run-', d) AS run_id, concat(d, 'T0', part, ':00:00') AS run_ts,
    concat('tenant-', part) AS dataset_name, concat('{"events":', n, '}') AS total_rows_by_table
  FROM (SELECT strftime(ts, '%Y-%m-%d') AS d, user_id % 3 AS part, count(*) AS n FROM events GROUP BY ALL))"""
ORACLE["issue_lifecycle_by_run_history"] = f"{_HISTORY}, {_DAYS} " + _LIFECYCLE.replace(
    "SELECT max(run_ts) FROM history", "SELECT max(run_ts) FROM days"
)
ORACLE["last_run_row"] = f"""WITH {_DAYS}
SELECT run_ts, dataset_name FROM days WHERE run_id = 'run-2024-01-05' ORDER BY run_ts DESC LIMIT 1"""
ORACLE["run_time"] = f"""{_HISTORY}, {_DAYS}
SELECT 5 AS day, CAST(max(run_ts) AS TIMESTAMP) AS run_ts FROM days WHERE run_id = 'run-2024-01-05'
UNION ALL
SELECT 6, CAST(min(run_ts) AS TIMESTAMP) FROM history WHERE run_id = 'run-2024-01-06'"""
ORACLE["issue_totals"] = f"""{_HISTORY}
SELECT *, CAST(row_number() OVER (ORDER BY issue_count DESC, issue_type) AS INTEGER) AS rank
FROM (SELECT issue_type, count(*) AS issue_count FROM history GROUP BY issue_type)"""
ORACLE["issue_trend_matrix"] = f"""{_HISTORY},
types AS (SELECT issue_type, row_number() OVER (ORDER BY count(*) DESC, issue_type) AS type_rank
          FROM history GROUP BY issue_type ORDER BY type_rank LIMIT 8),
runs AS (SELECT DISTINCT run_id, CAST(run_ts AS TIMESTAMP) AS run_ts FROM history)
SELECT r.run_id, r.run_ts, CAST(t.type_rank AS INTEGER) AS type_rank, t.issue_type,
  (SELECT count(*) FROM history h WHERE h.run_id = r.run_id AND h.issue_type = t.issue_type) AS issue_count
FROM runs r CROSS JOIN types t"""
ORACLE["score_trend"] = f"""{_daily()}, scores AS ({_score('run_id, run_ts, dataset_name,')}
  GROUP BY run_id, run_ts, dataset_name)
SELECT *, score - lag(score) OVER (PARTITION BY dataset_name ORDER BY run_ts) AS score_change FROM scores"""


def _project_metrics() -> str:
    """Two sets of checks in one query: the daily ones go by another prefix."""
    daily = _HISTORY[_HISTORY.index("counts AS"):]
    for name in ("counts", "rated", "checks"):
        daily = daily.replace(f"{name} AS (", f"d_{name} AS (").replace(f"FROM {name}", f"FROM d_{name}")
    dated = _comparison().replace(staged(), staged(more=", day"), 1)
    return f"""{dated}, {daily}
SELECT {_STAMP}, {quote(RUN_TS)} AS run_ts, s.overall_score, 90.0::DOUBLE AS score_threshold,
  5.0::DOUBLE AS critical_severity,
  CASE WHEN s.overall_score >= 90 AND k.critical_failed_checks = 0 THEN 'pass' ELSE 'fail' END
    AS quality_gate_status,
  s.total_checks, c.passed_checks, c.warning_checks, c.failed_checks,
  round(c.passed_checks::DOUBLE / s.total_checks::DOUBLE, 4) AS check_pass_rate,
  k.critical_failed_checks, m.*,
  l.open_issue_count, l.new_issue_count,
  CASE WHEN l.recurring_issue_count = 0 THEN r.recurring_issue_count ELSE l.recurring_issue_count END
    AS recurring_issue_count, l.resolved_or_not_seen_issue_count,
  CASE WHEN (SELECT bool_and(matches) FROM comparison) THEN 'pass' ELSE 'fail' END AS regression_status,
  (SELECT delta FROM comparison WHERE kind = 'score') AS regression_score_delta
FROM (SELECT round(score, 2) AS overall_score, total_checks FROM ({_score('')})) s,
  (SELECT count(*) FILTER (WHERE status = 'pass') AS passed_checks,
     count(*) FILTER (WHERE status = 'warn') AS warning_checks,
     count(*) FILTER (WHERE status = 'fail') AS failed_checks,
     FROM checks) c,
  (SELECT count(*) AS critical_failed_checks FROM checks WHERE {_CRITICAL}) k,
  ({_MEASURES}) m, ({_STAGES}) l,
  (SELECT count(*) AS recurring_issue_count FROM ({_RECURRENCE}) WHERE occurrences > 1) r"""


ORACLE["project_metrics"] = _project_metrics()

# ---------------------------------------------------------------- anomalies

_METRICS = f"""
WITH tagged AS (SELECT *, concat('run-', {_DAY}) AS run_id, concat({_DAY}, 'T00:00:00') AS run_ts,
  concat('tenant-', user_id % 3) AS dataset_name FROM events),
metrics AS (
  SELECT run_id, run_ts, dataset_name, count(*) AS event_volume,
    count(*) FILTER (WHERE event_type = 'purchase') AS completion_count,
    count(*) FILTER (WHERE event_type = 'purchase')::DOUBLE / count(*)::DOUBLE AS completion_rate
  FROM tagged GROUP BY ALL),
shares AS (
  SELECT t.run_id, t.dataset_name, coalesce(t.event_type, '') AS key, count(*) AS event_count,
    count(*)::DOUBLE / max(m.event_volume)::DOUBLE AS share
  FROM tagged t JOIN metrics m USING (run_id, dataset_name) GROUP BY ALL)"""
ORACLE["run_metrics"] = f"""{_METRICS}
SELECT m.*, counts AS event_type_counts, shown AS event_type_distribution FROM metrics m JOIN (
  SELECT run_id, dataset_name,
    concat('{{', string_agg(concat('"', key, '":', event_count), ',' ORDER BY key), '}}') AS counts,
    concat('{{', string_agg(concat('"', key, '":', CAST(share AS VARCHAR)), ',' ORDER BY key), '}}') AS shown
  FROM shares GROUP BY ALL) USING (run_id, dataset_name)"""
ORACLE["event_distribution"] = (
    f"{_METRICS} SELECT run_id, dataset_name, key AS event_type, event_count, share FROM shares"
)


def _number(c: str) -> str:
    return f"CAST({c} AS VARCHAR)"


def _value_anomalies(metric: str, threshold: float, direction: str, current: str = "true") -> str:
    far = f"abs((value - med) / mad) >= {threshold}"
    if direction == "down":
        far += " AND value <= med"
    still = (f"concat('{{\"median\":', {_number('med')}, ',\"current\":', {_number('value')}, "
             f"',\"mad\":', {_number('mad')}, '}}')")
    moved = (f"concat('{{\"median\":', {_number('med')}, ',\"mad\":', {_number('mad')}, "
             f"',\"z_score\":', {_number('(value - med) / mad')}, '}}')")
    return f"""
SELECT run_id, replace(run_id, 'run-', '') || 'T00:00:00' AS run_ts, dataset_name, {quote(metric)} AS metric,
  value AS metric_value, med AS baseline_value, mad AS baseline_spread,
  CASE WHEN mad <> 0 THEN (value - med) / mad END AS z_score,
  {threshold}::DOUBLE AS threshold, {quote(direction)} AS direction,
  CASE WHEN mad = 0 THEN printf('{metric} deviated from median %.2f without variation.', med)
    ELSE printf('{metric} moved {direction} to %.4f (median %.4f, mad %.4f).', value, med, mad) END AS notes,
  CASE WHEN mad = 0 THEN {still} ELSE {moved} END AS details
FROM (
  SELECT x.run_id, x.dataset_name, x.value, x.med, median(abs(p.{metric}::DOUBLE - x.med)) AS mad
  FROM (SELECT c.run_id, c.dataset_name, c.{metric}::DOUBLE AS value,
          median(p.{metric}::DOUBLE) AS med
        FROM metrics c JOIN metrics p ON p.dataset_name = c.dataset_name AND p.run_id < c.run_id
        WHERE {current} GROUP BY ALL) x
  JOIN metrics p ON p.dataset_name = x.dataset_name AND p.run_id < x.run_id
  GROUP BY x.run_id, x.dataset_name, x.value, x.med)
WHERE CASE WHEN mad = 0 THEN value <> med ELSE {far} END"""


_BASELINES = """
SELECT r.dataset_name, r.run_id, r.run_ts, k.key, coalesce(b.baseline, 0.0::DOUBLE) AS baseline,
  coalesce(s.share, 0.0::DOUBLE) AS current
FROM metrics r
JOIN (SELECT DISTINCT dataset_name, key FROM shares) k ON k.dataset_name = r.dataset_name
LEFT JOIN (
  SELECT c.dataset_name, c.run_id, p.key, median(p.share) AS baseline
  FROM metrics c JOIN shares p ON p.dataset_name = c.dataset_name AND p.run_id < c.run_id
  GROUP BY ALL) b ON b.dataset_name = r.dataset_name AND b.run_id = r.run_id AND b.key = k.key
LEFT JOIN shares s ON s.dataset_name = r.dataset_name AND s.run_id = r.run_id AND s.key = k.key
WHERE (b.baseline IS NOT NULL OR s.share IS NOT NULL)
  AND EXISTS (SELECT 1 FROM metrics p WHERE p.dataset_name = r.dataset_name AND p.run_id < r.run_id)"""


def _shifts(threshold: float, current: str = "true") -> str:
    parts = ", ".join(
        f"',\"{c}\":', {_number(c)}" for c in ("baseline", "current", "delta")
    )
    return f"""
SELECT run_id, run_ts, dataset_name, 'event_type_distribution' AS metric, delta AS metric_value,
  baseline AS baseline_value, {threshold}::DOUBLE AS baseline_spread, NULL::DOUBLE AS z_score,
  {threshold}::DOUBLE AS threshold, 'shift' AS direction,
  printf('Event type ''%s'' shifted by %.2f%% relative to baseline.',
    CASE WHEN key = '' THEN 'missing' ELSE key END, delta * 100) AS notes,
  concat('{{"category":"', key, '"', {parts}, '}}') AS details
FROM (SELECT *, row_number() OVER (PARTITION BY dataset_name, run_id ORDER BY delta DESC, key) AS place
      FROM (SELECT c.*, abs(c.current - c.baseline) AS delta FROM ({_BASELINES}) c WHERE {current}))
WHERE place = 1 AND delta >= {threshold}"""


ORACLE["anomaly_volume"] = f"{_METRICS} {_value_anomalies('event_volume', 3.0, 'both')}"
ORACLE["anomaly_rate"] = f"{_METRICS} {_value_anomalies('completion_rate', 2.0, 'down')}"
ORACLE["distribution_baseline"] = f"{_METRICS} {_BASELINES}"
ORACLE["anomaly_distribution_shift"] = f"{_METRICS} {_shifts(0.05)}"
_LAST = "c.run_id = (SELECT max(run_id) FROM metrics)"
ORACLE["anomaly_current_run"] = f"""{_METRICS}
{_value_anomalies('event_volume', 0.5, 'both', _LAST)}
UNION ALL {_value_anomalies('completion_rate', 0.5, 'down', _LAST)}
UNION ALL {_shifts(0.02, _LAST)}"""

# ---------------------------------------------------------------- schema drift

# Canonical names of declared types and of the checking engine's types.
_DECLARED_TYPES = {
    "uuid": "varchar", "email": "varchar", "enum": "varchar", "state_code": "varchar",
    "string": "varchar", "timestamp": "timestamp", "int": "integer", "integer": "integer",
    "float": "float", "decimal": "float",
}


def _drift() -> str:
    declared = ", ".join(
        f"({quote(t)}, {quote(c)}, {quote(_DECLARED_TYPES.get(k, k))})"
        for t, columns in DECLARED.items() for c, k in columns.items()
    )
    actual = " UNION ALL ".join(
        f"SELECT {quote(t)} AS table_name, column_name, lower(column_type) AS type FROM (DESCRIBE {t})"
        for t in DRIFT_TABLES
    )
    counts = " UNION ALL ".join(
        f"SELECT {quote(t)} AS table_name, count(*) AS row_count FROM {t}" for t in DRIFT_TABLES
    )
    return f"""WITH declared AS (SELECT * FROM (VALUES {declared}) d(table_name, column_name, type)),
actual AS ({actual}), sizes AS ({counts}),
changed AS (SELECT table_name, column_name, d.type AS expected, a.type AS actual
  FROM declared d JOIN actual a USING (table_name, column_name) WHERE d.type <> a.type),
both_sides AS (SELECT table_name, column_name, d.type AS declared_type, a.type AS actual_type
  FROM declared d FULL OUTER JOIN actual a USING (table_name, column_name)),
lists AS (SELECT table_name, bool_or(declared_type IS NOT NULL) AS was_declared,
    bool_or(actual_type IS NOT NULL) AS was_found,
    coalesce(list(column_name ORDER BY column_name) FILTER (WHERE actual_type IS NULL), []) AS gone,
    coalesce(list(column_name ORDER BY column_name) FILTER (WHERE declared_type IS NULL), []) AS fresh
  FROM both_sides GROUP BY table_name),
texts AS (SELECT table_name, string_agg(concat(column_name, ' (', expected, '→', actual, ')'), ', '
    ORDER BY column_name) AS diffs,
  concat('[', string_agg(concat('{{"column":"', column_name, '","expected":"', expected, '","actual":"', actual, '"}}'),
    ',' ORDER BY column_name), ']') AS objects FROM changed GROUP BY table_name)"""


ORACLE["schema_drift"] = f"""{_drift()}
SELECT table_name, CAST(to_json(gone) AS VARCHAR) AS missing_columns,
  CAST(to_json(fresh) AS VARCHAR) AS new_columns, coalesce(objects, '[]') AS type_changes,
  CASE WHEN NOT was_found THEN 'Expected staging table was not created.'
       WHEN NOT was_declared THEN 'Unexpected staging table appeared.'
       ELSE concat_ws('; ',
         CASE WHEN len(gone) > 0 THEN concat('Missing columns: ', array_to_string(gone, ', ')) END,
         CASE WHEN len(fresh) > 0 THEN concat('New columns: ', array_to_string(fresh, ', ')) END,
         CASE WHEN diffs IS NOT NULL THEN concat('Type changes: ', diffs) END) END AS notes,
  coalesce(row_count, 0) AS row_count
FROM lists LEFT JOIN texts USING (table_name) LEFT JOIN sizes USING (table_name)
WHERE len(gone) > 0 OR len(fresh) > 0 OR diffs IS NOT NULL"""
ORACLE["schema_type_changes"] = f"{_drift()} SELECT * FROM changed JOIN sizes USING (table_name)"


def _spark_type(name: str) -> str:
    """The name a type goes by in the results."""
    names = {"VARCHAR": "string", "INTEGER": "int", "TIMESTAMP": "timestamp_ntz"}
    arms = " ".join(f"WHEN {quote(a)} THEN {quote(b)}" for a, b in names.items())
    return f"CASE {name} {arms} ELSE lower({name}) END"


ORACLE["stage_catalogue"] = " UNION ALL ".join(
    f"SELECT {quote(t)} AS table_name, column_name, {_spark_type('column_type')} AS type, "
    f"CAST(row_number() OVER () - 1 AS INTEGER) AS ordinal, (SELECT count(*) FROM {t}) AS row_count "
    f"FROM (DESCRIBE {t})"
    for t in DRIFT_TABLES
)

# ---------------------------------------------------------------- profiles

# Columns of the given tables: name and class (n number, s text, t time).
_TABLE_COLUMNS = {
    "customer": "c_custkey:n c_name:s c_nationkey:n c_acctbal:n c_mktsegment:s",
    "part": "p_partkey:n p_name:s p_brand:s p_type:s p_size:n p_retailprice:n",
    "orders": "o_orderkey:n o_custkey:n o_orderstatus:s o_totalprice:n o_orderdate:t o_orderpriority:s",
    "lineitem": "l_orderkey:n l_partkey:n l_suppkey:n l_linenumber:n l_quantity:n l_extendedprice:n "
                "l_discount:n l_tax:n l_returnflag:s l_linestatus:s l_shipdate:t",
    "events": "event_id:n ts:t user_id:n event_type:s value:n props:s",
    "documents": "doc_id:n text:s lang:s source:s n_chars:n",
    "labels": "doc_id:n quality:n toxic:n",
}


def _columns_of(t: str) -> list[tuple[int, str, str]]:
    pairs = [pair.split(":") for pair in _TABLE_COLUMNS[t].split()]
    return [(i, c, k) for i, (c, k) in enumerate(pairs)]


def _shown(c: str, kind: str) -> str:
    return _iso(c) if kind == "t" else f"CAST({c} AS VARCHAR)"


def _profile_row(source: str, label: str, i: int, c: str, kind: str) -> str:
    low, high = (
        (_shown(f"min({c})", kind), _shown(f"max({c})", kind)) if kind != "s" else ("NULL", "NULL")
    )
    return (
        f"SELECT {quote(label)} AS table_name, {i}::INTEGER AS ordinal, {quote(c)} AS column_name, "
        f"{_spark_type(f'typeof(any_value({c}))')} AS column_type, count(*) AS row_count, count(*) - count({c}) AS null_count, "
        f"(count(*) - count({c}))::DOUBLE / count(*)::DOUBLE AS null_rate, "
        f"count(DISTINCT {c}) AS distinct_count, CAST({low} AS VARCHAR) AS min_value, "
        f"CAST({high} AS VARCHAR) AS max_value FROM {source}"
    )


_PROFILES = " UNION ALL ".join(
    _profile_row(t, t, i, c, k) for t in PROFILED for i, c, k in _columns_of(t)
)
ORACLE["profile_columns"] = _PROFILES
ORACLE["profile_top_values"] = " UNION ALL ".join(
    f"SELECT {quote(t)} AS table_name, {i}::INTEGER AS ordinal, {quote(c)} AS column_name, "
    f"CAST(rank AS INTEGER) AS rank, {_shown('v', k)} AS value, frequency, "
    f"frequency::DOUBLE / (SELECT count(*) FROM {t})::DOUBLE AS relative_frequency FROM ("
    f"SELECT {c} AS v, count(*) AS frequency, row_number() OVER (ORDER BY count(*) DESC, {c} NULLS LAST) "
    f"AS rank FROM {t} GROUP BY {c}) WHERE rank <= 5"
    for t in PROFILED for i, c, k in _columns_of(t)
)
ORACLE["profile_distinct_estimates"] = " UNION ALL ".join(
    f"SELECT 'events' AS table_name, {quote(c)} AS column_name, count(DISTINCT {c}) AS distinct_count, "
    "TRUE AS within_bound FROM events"
    for _, c, _ in _columns_of("events")
)
ORACLE["profile_type_issues"] = """
WITH contacts AS (
  SELECT CASE WHEN c_custkey % 3 = 0 THEN CAST(c_acctbal AS VARCHAR)
              WHEN c_custkey % 7 = 0 THEN concat(' ', c_custkey, ' ') ELSE c_name END AS contact,
    c_mktsegment, CASE WHEN c_custkey % 2 = 0 THEN CAST(c_custkey AS VARCHAR) END AS number
  FROM customer),
tested AS (
  SELECT 'contact' AS column_name, contact AS v FROM contacts
  UNION ALL SELECT 'c_mktsegment', c_mktsegment FROM contacts
  UNION ALL SELECT 'number', number FROM contacts),
tallies AS (
  SELECT column_name, count(v) AS filled,
    count(*) FILTER (WHERE regexp_matches(trim(v), '^[+-]?\\d+(\\.\\d+)?$')) AS numeric_values
  FROM tested GROUP BY column_name)
SELECT 'contacts' AS table_name, column_name, numeric_values, filled - numeric_values AS non_numeric_values,
  concat('Mixed numeric/text values (', filled - numeric_values, ' of ', filled, ' non-numeric rows).') AS issue
FROM tallies WHERE numeric_values > 0 AND filled > numeric_values"""
_CLEAN_PROFILES = " UNION ALL ".join(
    _profile_row(f"c_{t}", f"clean_{t}", i, c, "n" if c == "view_count" else "s")
    for t in ("users", "resources") for i, c in enumerate(_COLUMNS[t])
)
ORACLE["profile_table_summary"] = f"""{staged('users', 'resources')},
p AS ({_PROFILES} UNION ALL {_CLEAN_PROFILES})
SELECT table_name, max(row_count) AS row_count, count(*) AS column_count,
  CASE WHEN max(null_rate) > 0 THEN (SELECT q.column_name FROM p q WHERE q.table_name = p.table_name
    ORDER BY q.null_rate DESC, q.ordinal LIMIT 1) END AS nulliest_column,
  max(null_rate) AS max_null_rate,
  (SELECT q.column_name FROM p q WHERE q.table_name = p.table_name
    ORDER BY q.distinct_count DESC, q.ordinal LIMIT 1) AS high_cardinality_column,
  max(distinct_count) AS max_cardinality
FROM p GROUP BY table_name"""
