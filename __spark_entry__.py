"""

``queries()`` maps each registered query to ``(spark, sf_dir) ->
DataFrame``; ``oracle_sql()`` gives, for the same names, DuckDB SQL over
the raw tables (``lineitem``) that must return the same rows.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from punctuality.plans.catalog import QUERIES  # noqa: E402
from punctuality.plans.reports import delay_report, delay_report_text  # noqa: E402
from punctuality.plans.roundtrips import AWKWARD_TEXT, MIXED_MONTHS, edge_columns  # noqa: E402
from punctuality.schemas import CAUSE_LABELS, FLIGHTS_RAW  # noqa: E402
from punctuality.sources.fixtures import FLIGHT_COLUMNS, flights, flights_raw_sql, flights_sql  # noqa: E402

try:  # the text operators are a part by themselves; without them everything else works
    import corpus_pipeline  # noqa: E402
    from punctuality.llm import queries as llm_queries  # noqa: E402
except ModuleNotFoundError as e:
    if e.name not in ("corpus_pipeline", "punctuality.llm", "punctuality.llm.queries"):
        raise
    corpus_pipeline = llm_queries = None

SMOKE_DIR = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the airport x month delay report as text, sorted."""
    return delay_report_text(delay_report(flights(spark, SMOKE_DIR)), order="global")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = dict(QUERIES)
    if llm_queries:
        out |= llm_queries.QUERIES | {"pipeline": corpus_pipeline.run}
    return out


# ---------------------------------------------------------------------------
# Oracle SQL (DuckDB)
# ---------------------------------------------------------------------------

TIERS = [("low", "LOW"), ("medium", "MEDIUM"), ("high", "HIGH")]
TIER_WORD = {"low": "Low", "medium": "Med", "high": "High"}
CAUSES = list(CAUSE_LABELS.items())
RAW_COLUMNS = FLIGHTS_RAW.fieldNames()


def _r2(x: str) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(38,6)), 2) AS DOUBLE)"


def _txt2(x: str) -> str:
    return f"CAST(CAST({x} AS DECIMAL(38,2)) AS VARCHAR)"


_FLIGHTS = f"flights AS ({flights_sql('lineitem')})"
_RAW_AS_FLIGHTS = f"flights AS ({flights_raw_sql('lineitem')})"
_EDGE = f"flights AS (SELECT {', '.join(edge_columns(FLIGHT_COLUMNS))} FROM ({flights_sql('lineitem')}) t3)"
_RAW = f"flights_raw AS ({flights_raw_sql('lineitem')})"
_CARRIER = (
    "carrier AS (SELECT op_unique_carrier, origin, arr_delay, cancelled, month FROM flights_raw "
    "WHERE op_unique_carrier IS NOT NULL AND origin IS NOT NULL AND month IS NOT NULL AND cancelled IS NOT NULL)"
)
_TIERED = (
    "tiered AS (SELECT *, CASE WHEN coalesce(cancelled, 0) = 1 THEN 'CANCELLED' "
    "WHEN dep_delay > 0 AND dep_delay < 15 THEN 'LOW' WHEN dep_delay >= 15 AND dep_delay <= 60 THEN 'MEDIUM' "
    "WHEN dep_delay > 60 THEN 'HIGH' END AS tier FROM flights)"
)
def _in_tier(t: str, col: str) -> str:
    return f"avg(CASE WHEN tier = '{t}' THEN {col} END)"


_STATS = "stats AS (SELECT origin, month, {cols} FROM tiered GROUP BY origin, month)".format(
    cols=", ".join(
        f"count(CASE WHEN tier = '{t}' THEN 1 END) AS count_{n}, "
        f"{_r2(_in_tier(t, 'dep_delay'))} AS avg_dep_{n}, "
        f"{_r2(_in_tier(t, 'arr_delay'))} AS avg_arr_{n}"
        for n, t in TIERS
    )
)
_CAUSES = "causes AS ({})".format(
    " UNION ALL ".join(
        [
            "SELECT origin, month, 'Cancellazione_' || cancellation_code AS cause FROM flights "
            "WHERE coalesce(cancelled, 0) = 1 AND cancellation_code IS NOT NULL "
            "AND cancellation_code <> 'N' AND cancellation_code <> ''"
        ]
        + [f"SELECT origin, month, '{label}' AS cause FROM flights WHERE {c} > 0" for c, label in CAUSES]
    )
)
_COUNTS = "counts AS (SELECT origin, month, cause, count(*) AS cause_count FROM causes GROUP BY origin, month, cause)"
_RANKED = (
    "ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY origin, month "
    "ORDER BY cause_count DESC, cause ASC) AS INTEGER) AS rnk FROM counts)"
)
_TOP = "top AS (SELECT origin, month, {cols} FROM ranked WHERE rnk <= 3 GROUP BY origin, month)".format(
    cols=", ".join(
        f"max(CASE WHEN rnk = {i} THEN cause END) AS cause_{i}, max(CASE WHEN rnk = {i} THEN cause_count END) AS count_{i}"
        for i in range(1, 4)
    )
)
_REPORT = (
    "report AS (SELECT s.*, t.cause_1, t.count_1, t.cause_2, t.count_2, t.cause_3, t.count_3 "
    "FROM stats s LEFT JOIN top t ON s.origin IS NOT DISTINCT FROM t.origin AND s.month IS NOT DISTINCT FROM t.month)"
)


def _with(*ctes: str) -> str:
    return "WITH " + ", ".join(ctes) + " "


def _label(i: int) -> str:
    return f"cause_{i} || '(' || CAST(count_{i} AS VARCHAR) || ')'"


_TIER_TEXT = ", ".join(
    f"'{TIER_WORD[n]}:' || CAST(coalesce(count_{n}, 0) AS VARCHAR) || ' voli (DepAvg:' || "
    f"{_txt2(f'coalesce(avg_dep_{n}, 0.0)')} || ', ArrAvg:' || {_txt2(f'coalesce(avg_arr_{n}, 0.0)')} || ')' "
    f"AS {TIER_WORD[n].lower()}_str"
    for n, _ in TIERS
)
_CAUSE_TEXT = (
    "'Top3_Cause:[' || CASE WHEN cause_1 IS NULL THEN 'Nessuna_Causa_Rilevata' "
    f"ELSE concat_ws(', ', {_label(1)}, {_label(2)}, {_label(3)}) END || ']' AS cause_str"
)

_CARRIER_PROFILE = (
    _with(_FLIGHTS)
    + "SELECT op_unique_carrier, origin, count(*) AS total_flights, min(arr_delay) AS min_delay, "
    f"max(arr_delay) AS max_delay, {_r2('avg(arr_delay)')} AS avg_delay, "
    f"{_r2('CAST(sum(coalesce(cancelled, 0)) AS DOUBLE) * 100 / count(*)')} AS cancellation_rate, "
    "string_agg(DISTINCT CAST(month AS VARCHAR), '-' ORDER BY CAST(month AS VARCHAR)) AS months_active "
    "FROM flights GROUP BY op_unique_carrier, origin"
)
_CARRIER_PROFILE_TEXT = (
    _with(_FLIGHTS)
    + "SELECT op_unique_carrier, origin, count(*) AS total_flights, min(arr_delay) AS min_delay, "
    f"max(arr_delay) AS max_delay, {_r2('avg(arr_delay)')} AS avg_delay, "
    f"{_txt2(_r2('CAST(sum(coalesce(cancelled, 0)) AS DOUBLE) * 100 / count(*)'))} || '%' AS cancellation_rate, "
    "string_agg(DISTINCT CAST(month AS VARCHAR), '-' ORDER BY CAST(month AS VARCHAR)) AS months_active "
    "FROM flights GROUP BY op_unique_carrier, origin"
)
_CAUSE_ROWS = _with(_FLIGHTS, _CAUSES) + "SELECT origin, month, cause FROM causes"
_REPORT_TEXT = (
    _with(_FLIGHTS, _TIERED, _STATS, _CAUSES, _COUNTS, _RANKED, _TOP, _REPORT)
    + f"SELECT origin, month, {_TIER_TEXT}, {_CAUSE_TEXT} FROM report"
)
_REPORT_TYPED = _with(_FLIGHTS, _TIERED, _STATS, _CAUSES, _COUNTS, _RANKED, _TOP, _REPORT) + "SELECT * FROM report"


def _null_profile() -> str:
    parts = [
        f"SELECT {i} AS position, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
        f"CASE WHEN count(*) > 0 THEN {_r2(f'CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) * 100 / count(*)')} END "
        "AS null_pct FROM flights_raw"
        for i, c in enumerate(RAW_COLUMNS, start=1)
    ]
    return _with(_RAW) + " UNION ALL ".join(parts)


def _distinct_profile() -> str:
    parts = [
        f"SELECT {i} AS position, '{c}' AS column_name, count(DISTINCT {c}) AS distinct_count FROM flights_raw"
        for i, c in enumerate(RAW_COLUMNS, start=1)
    ]
    return _with(_RAW) + " UNION ALL ".join(parts)


def _sample_key() -> str:
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '\\N')" for c in ["op_unique_carrier", "origin", "arr_delay", "cancelled", "month"])
    return f"md5(concat_ws('-', '42', {parts}))"


ORACLE: dict[str, str] = {
    "carrier_profile": _CARRIER_PROFILE,
    "carrier_profile_sql": _CARRIER_PROFILE,
    "carrier_profile_text": _CARRIER_PROFILE_TEXT,
    "carrier_profile_global": _CARRIER_PROFILE,
    "delay_tier": _with(_FLIGHTS, _TIERED) + "SELECT origin, month, dep_delay, cancelled, tier FROM tiered",
    "tier_stats": _with(_FLIGHTS, _TIERED, _STATS) + "SELECT * FROM stats",
    "cause_rows": _CAUSE_ROWS,
    "cause_rows_union": _CAUSE_ROWS,
    "cause_counts": _with(_FLIGHTS, _CAUSES, _COUNTS) + "SELECT * FROM counts",
    "cause_counts_exploded": _with(_FLIGHTS, _CAUSES, _COUNTS) + "SELECT * FROM counts",
    "top_causes_rows": _with(_FLIGHTS, _CAUSES, _COUNTS, _RANKED)
    + "SELECT origin, month, rnk, cause, cause_count FROM ranked WHERE rnk <= 3",
    "top_causes_text": _with(_FLIGHTS, _CAUSES, _COUNTS, _RANKED)
    + "SELECT origin, month, string_agg(cause || '(' || CAST(cause_count AS VARCHAR) || ')', ', ' ORDER BY rnk) "
    "AS top3_str FROM ranked WHERE rnk <= 3 GROUP BY origin, month",
    "delay_report": _REPORT_TYPED,
    "delay_report_from_parts": _REPORT_TYPED,
    "delay_report_text": _REPORT_TEXT,
    "delay_report_clustered": _REPORT_TEXT,
    "prep_carrier": _with(_RAW, _CARRIER) + "SELECT * FROM carrier",
    "prep_causes": _with(_RAW)
    + "SELECT origin, month, dep_delay, arr_delay, cancelled, coalesce(cancellation_code, 'N') AS cancellation_code, "
    + ", ".join(f"coalesce({c}, CAST(0 AS DOUBLE)) AS {c}" for c, _ in CAUSES)
    + " FROM flights_raw WHERE origin IS NOT NULL AND month IS NOT NULL",
    "sample_exact": _with(_RAW, _CARRIER)
    + "SELECT op_unique_carrier, origin, arr_delay, cancelled, month FROM ("
    f"SELECT *, row_number() OVER (ORDER BY {_sample_key()}) AS rn FROM carrier) "
    "WHERE rn <= (SELECT round(count(*) * 0.01) FROM carrier)",
    "sample_exact_check": _with(_RAW, _CARRIER)
    + "SELECT CAST(round_even(count(*) * 0.01, 0) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS not_in_input FROM carrier",
    "replicate": _with(_RAW, _CARRIER) + "SELECT c.* FROM carrier c CROSS JOIN range(10) r",
    "null_profile": _null_profile(),
    "distinct_profile": _distinct_profile(),
    "value_counts": _with(_RAW) + "SELECT cancellation_code, count(*) AS frequency FROM flights_raw "
    "WHERE cancellation_code IS NOT NULL GROUP BY cancellation_code",
    "distinct_values": _with(_RAW) + "SELECT DISTINCT month FROM flights_raw WHERE month IS NOT NULL",
    "null_delay_by_status": _with(_RAW) + "SELECT cancelled, count(*) AS null_delay_flights FROM flights_raw "
    "WHERE arr_delay IS NULL GROUP BY cancelled",
    "cancelled_null_check": _with(_RAW) + "SELECT count(*) FILTER (WHERE cancelled = 1) AS cancelled_flights, "
    "count(*) FILTER (WHERE cancelled = 1 AND arr_delay IS NULL) AS cancelled_null_delay FROM flights_raw",
    "diverted_check": _with(_RAW)
    + "SELECT suspects, diverted, other, CASE WHEN diverted > 0 AND diverted = suspects THEN 'confirmed' "
    "WHEN diverted > 0 THEN 'partial' ELSE 'refuted' END AS verdict FROM ("
    "SELECT count(*) FILTER (WHERE arr_delay IS NULL AND cancelled = 0) AS suspects, "
    "count(*) FILTER (WHERE arr_delay IS NULL AND cancelled = 0 AND diverted = 1) AS diverted, "
    "count(*) FILTER (WHERE arr_delay IS NULL AND cancelled = 0 AND diverted = 0) AS other FROM flights_raw) x",
    "dataset_shape": _with(_RAW) + f"SELECT count(*) AS n_rows, {len(RAW_COLUMNS)} AS n_columns FROM flights_raw",
    "csv_roundtrip": _with(_RAW) + "SELECT * FROM flights_raw",
    "text_good_rows": _with(_RAW) + "SELECT * FROM flights_raw WHERE dep_delay IS NULL OR dep_delay NOT IN (7, 8, 9)",
    "text_rejected_summary": _with(_RAW)
    + "SELECT reason, count(*) AS lines FROM (SELECT CASE WHEN dep_delay IN (7, 8) THEN 'field_count' "
    "ELSE 'bad_value' END AS reason FROM flights_raw WHERE dep_delay IN (7, 8, 9)) x GROUP BY reason",
}

# Round trips and rare cases: what was written, computed again.
_LINE = "low_str || chr(9) || med_str || chr(9) || high_str || chr(9) || cause_str"
ORACLE |= {
    "text_wide_raw": ORACLE["csv_roundtrip"],
    "text_reordered_header": ORACLE["csv_roundtrip"],
    "table_roundtrip": ORACLE["csv_roundtrip"],
    "prep_from_wide_raw": ORACLE["prep_carrier"],
    "tsv_roundtrip": _with(_RAW) + f"SELECT op_unique_carrier, {AWKWARD_TEXT} AS note, month, arr_delay FROM flights_raw",
    "text_lines_roundtrip": f"SELECT origin || chr(9) || CAST(month AS VARCHAR) || chr(9) || {_LINE} AS line FROM ({_REPORT_TEXT}) t4",
    "partitioned_report": _REPORT_TYPED,
    "single_file_report": f"SELECT *, 1 AS n_files FROM ({_REPORT_TEXT.replace(_FLIGHTS, _RAW_AS_FLIGHTS)}) t4",
    "report_order_check": f"SELECT kind, count(*) AS n_rows, 0 AS out_of_order FROM ({_REPORT_TYPED}) t4, "
    "(VALUES ('single'), ('global'), ('clustered'), ('by_month')) k(kind) GROUP BY kind",
    "distinct_approx_check": f"SELECT position, column_name, true AS \"close\" FROM ({ORACLE['distinct_profile']}) t4",
    "carrier_profile_edge": _CARRIER_PROFILE.replace(_FLIGHTS, _EDGE),
    "delay_report_edge": _REPORT_TYPED.replace(_FLIGHTS, _EDGE),
    "delay_report_edge_text": _REPORT_TEXT.replace(_FLIGHTS, _EDGE),
}


_TYPES = {"int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE"}
_ONCE = "CASE WHEN count(*) >= 0 THEN '{}' END"  # one row
_COUNT = "CAST(count(*) FILTER (WHERE {}) AS VARCHAR)"


def _profile_all() -> str:
    rows = [("shape", 1, "rows", "n", "CAST(count(*) AS VARCHAR)"), ("shape", 2, "columns", "n", _ONCE.format(len(RAW_COLUMNS)))]
    for i, f in enumerate(FLIGHTS_RAW.fields, 1):
        nulls = f"count(*) FILTER (WHERE {f.name} IS NULL)"
        pct = f"CASE WHEN count(*) > 0 THEN {_txt2(_r2(f'CAST({nulls} AS DOUBLE) * 100 / count(*)'))} END"
        rows += [("schema", i, f.name, "type", _ONCE.format(f.dataType.simpleString())), ("nulls", i, f.name, "null_count", f"CAST({nulls} AS VARCHAR)"), ("nulls", i, f.name, "null_pct", pct)]
    late = "arr_delay IS NULL AND cancelled "
    by = {"0": "= 0", "1": "= 1", "other": "NOT IN (0, 1)", "null": "IS NULL"}
    rows += [("null_delay", i, n, "flights", _COUNT.format(late + c)) for i, (n, c) in enumerate(by.items(), 1)]
    rows += [("cancelled_null", 1, "cancelled_flights", "flights", _COUNT.format("cancelled = 1")), ("cancelled_null", 2, "cancelled_null_delay", "flights", _COUNT.format(late + "= 1"))]
    suspect = late + "= 0 "
    rows += [("diverted", i, n, "flights", _COUNT.format(suspect + c)) for i, (n, c) in enumerate({"suspects": "", "diverted": "AND diverted = 1", "other": "AND diverted = 0"}.items(), 1)]
    n, all_n = (f"count(*) FILTER (WHERE {suspect} {c})" for c in ("AND diverted = 1", ""))
    rows.append(("diverted", 4, "verdict", "verdict", f"CASE WHEN {n} > 0 AND {n} = {all_n} THEN 'confirmed' WHEN {n} > 0 THEN 'partial' ELSE 'refuted' END"))
    parts = [f"SELECT '{s}' AS section, {i} AS position, '{item}' AS item, '{m}' AS metric, {v} AS value FROM flights_raw" for s, i, item, m, v in rows]
    return _with(_RAW) + " UNION ALL ".join(parts)


_MIXED_GOOD = f"month IN ({', '.join(str(m) for k, v in MIXED_MONTHS.items() if k != 'lacking' for m in v)})"
_MIXED_LACKING = f"month IN ({', '.join(map(str, MIXED_MONTHS['lacking']))})"
_STEP = "SELECT '{}' AS step, count(*) AS n_rows, sum(arr_delay) AS minutes FROM flights_raw WHERE {}"
_VALUES = "SELECT 'values_{c}' AS part, CAST({c} AS VARCHAR) AS item, 'n' AS metric, CAST(count(*) AS VARCHAR) AS value FROM flights_raw WHERE {c} IS NOT NULL GROUP BY {c}"
_RAW_TEXT_REPORT = _REPORT_TEXT.replace(_FLIGHTS, _RAW_AS_FLIGHTS)
ORACLE |= {
    "profile_all": _profile_all(),
    "first_rows": "SELECT CAST(row_number() OVER () AS INTEGER) AS position, l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (SELECT * FROM lineitem LIMIT 20) t",
    "schema_rows": " UNION ALL ".join(
        f"SELECT {i} AS position, '{f.name}' AS column_name, CASE typeof(max({f.name})) WHEN '{_TYPES[f.dataType.simpleString()]}' THEN '{f.dataType.simpleString()}' END AS type "
        f"FROM ({flights_raw_sql('lineitem')}) t4"
        for i, f in enumerate(FLIGHTS_RAW.fields, 1)
    ),
    "text_mixed_headers": _with(_RAW) + f"SELECT * FROM flights_raw WHERE {_MIXED_GOOD}",
    "csv_mixed_headers": _with(_RAW) + f"SELECT * FROM flights_raw WHERE {_MIXED_GOOD}",
    "text_mixed_rejected": _with(_RAW) + f"SELECT 'missing_column:arr_delay' AS reason, count(*) AS lines FROM flights_raw WHERE {_MIXED_LACKING} HAVING count(*) > 0",
    "external_table_scan": _with(_RAW) + " UNION ALL ".join(_STEP.format(*x) for x in (("made", "month <= 6"), ("added", "month IS NOT NULL"), ("moved", "month > 9"), ("files", "month IS NOT NULL"))),
    "distinct_sketch_check": f"SELECT column_name, true AS \"close\" FROM ({ORACLE['distinct_profile']}) t4 WHERE column_name <> 'month'",
    "delay_report_staged": _REPORT_TYPED,
    "job_profile": f"SELECT section AS part, item, metric, value FROM ({_profile_all()}) t4 UNION ALL "
    f"SELECT 'distinct', column_name, 'n', CAST(distinct_count AS VARCHAR) FROM ({_distinct_profile()}) t5 UNION ALL "
    + " UNION ALL ".join(f"SELECT * FROM ({_with(_RAW)}{_VALUES.format(c=c)}) t6" for c in ("cancellation_code", "month")),
    "job_text_lines": f"SELECT coalesce(origin, '') || ';' || CAST(month AS VARCHAR) || ';' || {_LINE.replace('chr(9)', chr(39) + ';' + chr(39))} AS line FROM ({_RAW_TEXT_REPORT}) t4",
    "job_separator": _CARRIER_PROFILE_TEXT.replace(_FLIGHTS, _RAW_AS_FLIGHTS),
    "job_mixed_parquet": _REPORT_TYPED.replace(_FLIGHTS, f"flights AS (SELECT * FROM ({flights_raw_sql('lineitem')}) t4 WHERE {_MIXED_GOOD})"),
}


def oracle_sql() -> dict[str, str]:
    out = {k: v for k, v in ORACLE.items() if k in QUERIES}
    return out | llm_queries.ORACLE_SQL if llm_queries else out
