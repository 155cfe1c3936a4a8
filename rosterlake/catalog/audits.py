"""Audit operators and the monthly audit, on one month of each table.

The stored side lacks the 11th and the 13th to 21st of the month, the source lacks the 17th: a single gap, a run that
needs two windows, and a day that is empty in both.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from rosterlake import specs
from rosterlake.catalog.base import (
    Tables, d_any, d_iso_like, d_loose, d_map, d_repaired, d_strict, d_us, query,
)
from rosterlake.catalog.reports import mapped_columns
from rosterlake.operators import filters as P
from rosterlake.operators import incremental as I
from rosterlake.operators import quality as Q
from rosterlake.plans import audit

START, END, TODAY = date(2000, 3, 1), date(2000, 3, 31), date(2000, 4, 5)
MONTH = f"BETWEEN DATE '{START}' AND DATE '{END}'"
LOST = "(11, 13, 14, 15, 16, 17, 18, 19, 20, 21)"
LOST_DAYS = (11, 13, 14, 15, 16, 17, 18, 19, 20, 21)
EMPTY_DAY = 17

SALES, BOOKED = specs.SALES_TEXT, specs.RESERVATIONS_TEXT
SALES_DAY = d_us("transaction_date")
BOOKED_DAY = d_any("class_start_date")
SALES_COLUMNS = ", ".join(SALES.names)
BOOKED_COLUMNS = ", ".join(BOOKED.names)


def _without_days(df, day, days):
    return df.where(~F.coalesce(F.dayofmonth(day).isin(*days), F.lit(False)))


def sales_stored(t: Tables):
    return _without_days(t.sales_dups, SALES.day(), LOST_DAYS)


def sales_source(t: Tables):
    return _without_days(mapped_columns(t, SALES), SALES.day(), (EMPTY_DAY,))


def booked_stored(t: Tables):
    return _without_days(t.reservations_stored, BOOKED.day(), LOST_DAYS)


def booked_source(t: Tables):
    return _without_days(mapped_columns(t, BOOKED), BOOKED.day(), (EMPTY_DAY,))


SALES_CTES = {
    "stored": f"SELECT * FROM (SELECT *, {SALES_DAY} AS d FROM sales_dups) AS x WHERE NOT coalesce(day(d) IN {LOST}, false)",
    "mapped": f"SELECT {d_map(SALES, SALES.names)} FROM sales_report",
    "source": f"SELECT * FROM (SELECT *, {SALES_DAY} AS d FROM mapped) AS x WHERE NOT coalesce(day(d) = {EMPTY_DAY}, false)",
    "days": f"SELECT cast(unnest(generate_series(DATE '{START}', DATE '{END}', INTERVAL 1 DAY)) AS date) AS d",
    "present": f"SELECT DISTINCT d FROM stored WHERE order_status <> 'Order Status' AND d {MONTH}",
    "missing": "SELECT d FROM days WHERE d NOT IN (SELECT d FROM present)",
}
BOOKED_CTES = {
    "stored": f"SELECT * FROM (SELECT *, {BOOKED_DAY} AS d FROM reservations_stored) AS x WHERE NOT coalesce(day(d) IN {LOST}, false)",
    "mapped": f"SELECT {d_map(BOOKED, BOOKED.names)} FROM reservations_report",
    "source": f"SELECT * FROM (SELECT *, {BOOKED_DAY} AS d FROM mapped) AS x WHERE NOT coalesce(day(d) = {EMPTY_DAY}, false)",
    "days": SALES_CTES["days"],
    "present": f"SELECT DISTINCT d FROM stored WHERE d {MONTH}",
    "missing": SALES_CTES["missing"],
}
SV, BV = ("sales_report", "sales_dups"), ("reservations_report", "reservations_stored")


@query("p01_drop_junk", ("sales_dups",), """
  SELECT order_status, count(*) AS n FROM sales_dups WHERE order_status <> 'Order Status' GROUP BY 1""")
def _junk(t):
    return P.drop_junk(t.sales_dups, SALES).groupBy("order_status").agg(F.count(F.lit(1)).alias("n"))


@query("p01_drop_junk_first_timers", ("first_timers_report",), f"""
  SELECT string_field_1 AS id, count(*) AS n FROM (SELECT {d_map(specs.FIRST_TIMERS_TEXT, ('customer', 'customer_id',
    'customer_email', 'customer_phone_number', 'join_date', 'first_class_date', 'class_start_time', 'class_location',
    'class_type', 'class_category', 'instructor_name', 'guest_reservation', 'pay_with_type'))} FROM first_timers_report) AS m
  WHERE string_field_1 <> 'Customer ID' AND string_field_0 IS NOT NULL AND string_field_0 NOT LIKE '#%' GROUP BY 1""")
def _junk_first(t):
    spec = specs.FIRST_TIMERS_TEXT
    kept = P.drop_junk(mapped_columns(t, spec), spec)
    return kept.groupBy(F.col("string_field_1").alias("id")).agg(F.count(F.lit(1)).alias("n"))


@query("p02_in_month", ("sales_dups",), f"""
  SELECT order_number, product_id, transaction_date FROM sales_dups WHERE {SALES_DAY} {MONTH}""")
def _month(t):
    return P.in_month(t.sales_dups, SALES, START, END).select("order_number", "product_id", "transaction_date")


@query("j06_missing_dates_o02_order_days", SV, "SELECT cast(d AS varchar) AS d FROM missing ORDER BY d", SALES_CTES)
def _missing(t):
    return Q.order_days(Q.missing_dates(sales_stored(t), SALES, START, END))


@query("j06_missing_dates_mixed", BV, "SELECT cast(d AS varchar) AS d FROM missing", BOOKED_CTES)
def _missing_mixed(t):
    return Q.missing_dates(booked_stored(t), BOOKED, START, END)


_RUNS = {
    **SALES_CTES,
    "runs": """SELECT min(d) AS a, max(d) AS b FROM (SELECT d, d - cast(row_number() OVER (ORDER BY d) AS integer) AS g
               FROM missing) AS x GROUP BY g""",
}


@query("w02_date_runs", SV, "SELECT cast(a AS varchar) AS min_date, cast(b AS varchar) AS max_date FROM runs", _RUNS)
def _runs(t):
    return Q.date_runs(Q.missing_dates(sales_stored(t), SALES, START, END))


@query("t02_chunk_range", SV, """
  SELECT cast(cast(s AS date) AS varchar) AS min_date, cast(least(cast(s AS date) + 6, b) AS varchar) AS max_date
  FROM (SELECT b, unnest(generate_series(a, b, INTERVAL 7 DAY)) AS s FROM runs) AS x""", _RUNS)
def _chunks(t):
    return Q.chunk_runs(Q.date_runs(Q.missing_dates(sales_stored(t), SALES, START, END)), 7)


_BAD = " OR ".join(f"NOT coalesce({d_strict(c)}, false)" for c in BOOKED.format_columns)
_FIX = " OR ".join(f"coalesce(({d_loose(c)} OR {d_iso_like(c)}) AND NOT {d_strict(c)} AND {d_repaired(c)} <> {c}, false)" for c in BOOKED.format_columns)
_SBAD = " OR ".join(f"NOT coalesce({d_strict(c)}, false)" for c in SALES.format_columns)
_SFIX = " OR ".join(f"coalesce(({d_loose(c)} OR {d_iso_like(c)}) AND NOT {d_strict(c)} AND {d_repaired(c)} <> {c}, false)" for c in SALES.format_columns)


@query("a11_bad_format", BV, f"""
  SELECT count(*) FILTER (WHERE {_BAD}) AS bad_format, count(*) FILTER (WHERE {_FIX}) AS repairable
  FROM stored WHERE d {MONTH}""", BOOKED_CTES)
def _bad(t):
    return Q.bad_format(booked_stored(t), BOOKED, START, END)


@query("a12_unparseable_by_parse", ("sales_dups",), f"""
  SELECT count(*) AS unparseable FROM sales_dups WHERE order_status <> 'Order Status' AND {SALES_DAY} IS NULL""")
def _unparse(t):
    return Q.unparseable(t.sales_dups, SALES)


@query("a12_unparseable_by_shape", ("reservations_stored",), f"""
  SELECT count(*) AS unparseable FROM reservations_stored
  WHERE NOT ({d_loose('class_start_date')} OR {d_iso_like('class_start_date')})""")
def _unshape(t):
    return Q.unparseable(t.reservations_stored, BOOKED)


def _sales_repaired(source: str) -> str:
    cols = ", ".join(f"{d_repaired(c)} AS {c}" if c in SALES.format_columns else c for c in SALES.names)
    return f"SELECT {cols} FROM {source} WHERE d {MONTH}"


def _booked_repaired(source: str) -> str:
    cols = ", ".join(f"{d_repaired(c)} AS {c}" if c in BOOKED.format_columns else c for c in BOOKED.names)
    return f"SELECT {cols} FROM {source} WHERE d {MONTH}"


_SFIXED = {**SALES_CTES, "fixed": _sales_repaired("stored")}
_BFIXED = {**BOOKED_CTES, "fixed": _booked_repaired("stored")}


@query("f11_repair_formats", BV, f"SELECT reservation_id, {', '.join(BOOKED.format_columns)} FROM fixed", _BFIXED)
def _repair(t):
    month = P.in_month(booked_stored(t), BOOKED, START, END)
    return Q.repair_formats(month, BOOKED).select("reservation_id", *BOOKED.format_columns)


@query("a04_full_row_dups", ("sales_dups",), f"""
  SELECT cast(sum(n) AS bigint) AS total_rows, count(*) AS distinct_rows, cast(sum(n) - count(*) AS bigint) AS duplicate_rows
  FROM (SELECT count(*) AS n FROM sales_dups GROUP BY {SALES_COLUMNS}) AS x""")
def _dups(t):
    return Q.full_row_dups(t.sales_dups)


_KEYS = ", ".join(SALES.keys)


@query("a05_key_collisions", ("sales_dups",), f"""
  SELECT {_KEYS}, cast(sum(n) AS bigint) AS n_rows, count(*) AS n_distinct
  FROM (SELECT {SALES_COLUMNS}, count(*) AS n FROM sales_dups GROUP BY {SALES_COLUMNS}) AS x GROUP BY {_KEYS} HAVING count(*) > 1""")
def _collisions(t):
    return Q.key_collisions(t.sales_dups, list(SALES.keys))


@query("u04_drop_exact_dups", SV, f"SELECT DISTINCT {SALES_COLUMNS} FROM fixed", _SFIXED)
def _exact(t):
    return audit.repaired_month(sales_stored(t), SALES, START, END)


@query("a15_confirmed_empty", SV, """
  SELECT cast(d AS varchar) AS d FROM missing WHERE d NOT IN (SELECT d FROM source WHERE d IS NOT NULL)""", SALES_CTES)
def _empty(t):
    missing = Q.missing_dates(sales_stored(t), SALES, START, END)
    return Q.confirmed_empty(missing, sales_source(t), SALES)


def _key(alias: str, spec) -> str:
    return ", ".join(f"nullif({alias}{c}, '')" for c in spec.keys)


def _filled(spec, columns: str, junk: str) -> dict[str, str]:
    order = ", ".join(f"{c} NULLS FIRST" for c in spec.names)
    same = " AND ".join(f"nullif(h.{c}, '') IS NOT DISTINCT FROM nullif(w.{c}, '')" for c in spec.keys)
    return {
        "span": "SELECT min(d) - 3 AS lo, max(d) + 3 AS hi FROM missing",
        "held": f"SELECT DISTINCT {', '.join(spec.keys)} FROM stored, span WHERE {junk} AND d BETWEEN lo AND hi",
        "wanted": f"""SELECT {columns} FROM source WHERE d IN (SELECT d FROM missing)
            QUALIFY row_number() OVER (PARTITION BY {_key('', spec)} ORDER BY {order}) = 1""",
        "filled": f"SELECT {columns} FROM wanted AS w WHERE NOT EXISTS (SELECT 1 FROM held AS h WHERE {same})",
    }


_SFILL = {**_SFIXED, **_filled(SALES, SALES_COLUMNS, "order_status <> 'Order Status'")}
_BFILL = {**_BFIXED, **_filled(BOOKED, BOOKED_COLUMNS, "true")}


@query("t05_t08_backfill_sales", SV, f"SELECT {SALES_COLUMNS} FROM filled", _SFILL)
def _backfill(t):
    stored = sales_stored(t)
    return audit.backfill(stored, sales_source(t), SALES, audit.find_missing(stored, SALES, START, END))


@query("t05_t08_backfill_reservations", BV, f"SELECT {BOOKED_COLUMNS} FROM filled", _BFILL)
def _backfill_booked(t):
    stored = booked_stored(t)
    return audit.backfill(stored, booked_source(t), BOOKED, audit.find_missing(stored, BOOKED, START, END))


@query("t08_repaired_month_plus_backfill", SV, f"SELECT DISTINCT {SALES_COLUMNS} FROM fixed UNION ALL SELECT {SALES_COLUMNS} FROM filled",
       _SFILL)
def _final(t):
    stored = sales_stored(t)
    found = audit.audit_table(stored, sales_source(t), SALES, START, END)
    return found.repaired.select(*SALES.names).unionByName(found.backfill)


def _summary(spec, bad: str, fix: str, junk: str, unparseable: str, columns: str) -> dict[str, str]:
    keys = ", ".join(spec.keys)
    return {
        "n_days": "SELECT count(*) AS days_present FROM present",
        "n_missing": "SELECT count(*) AS missing_days FROM missing",
        "n_empty": "SELECT count(*) AS confirmed_empty FROM missing WHERE d NOT IN (SELECT d FROM source WHERE d IS NOT NULL)",
        "n_filled": "SELECT count(*) AS backfilled_rows FROM filled",
        "n_unparse": f"SELECT count(*) AS unparseable FROM stored WHERE {junk} AND {unparseable}",
        "n_bad": f"SELECT count(*) FILTER (WHERE {bad}) AS bad_format, count(*) FILTER (WHERE {fix}) AS repairable FROM stored WHERE d {MONTH}",
        "copies": f"SELECT {columns}, count(*) AS n FROM fixed GROUP BY {columns}",
        "per_key": f"SELECT cast(sum(n) AS bigint) AS n, count(*) AS k FROM copies GROUP BY {keys}",
        "n_dup": """SELECT cast(sum(n) AS bigint) AS total_rows, cast(sum(n - k) AS bigint) AS duplicate_rows,
            count(*) FILTER (WHERE k > 1) AS key_collisions FROM per_key""",
    }


_COUNTERS = """days_present, missing_days, missing_days - confirmed_empty AS backfilled_days, backfilled_rows, confirmed_empty,
  unparseable, bad_format, repairable, total_rows, duplicate_rows, key_collisions"""
_JOINED = "n_days, n_missing, n_empty, n_filled, n_unparse, n_bad, n_dup"


def _summary_select(name: str) -> str:
    return f"""SELECT '{name}' AS table_name, {_COUNTERS}, cast(NULL AS varchar) AS error, 31 - confirmed_empty AS days_after,
      CASE WHEN backfilled_rows > 0 OR bad_format > 0 OR duplicate_rows > 0 OR unparseable > 0 OR key_collisions > 0
        THEN 1 ELSE 0 END::bigint AS severity,
      (CASE WHEN backfilled_rows > 0 THEN 1 ELSE 0 END + CASE WHEN bad_format > 0 THEN 1 ELSE 0 END
        + CASE WHEN duplicate_rows > 0 THEN 1 ELSE 0 END)::bigint AS fixes,
      CASE WHEN backfilled_rows > 0 OR bad_format > 0 OR duplicate_rows > 0 OR unparseable > 0 OR key_collisions > 0
        THEN 'attention' ELSE 'clean' END AS status
      FROM {_JOINED}"""


@query("c04_monthly_audit_sales_text", SV, _summary_select("sales_text"),
       {**_SFILL, **_summary(SALES, _SBAD, _SFIX, "order_status <> 'Order Status'", "d IS NULL", SALES_COLUMNS)})
def _audit_sales(t):
    return audit.monthly_audit([(SALES, sales_stored(t), sales_source(t))], "2000-03", TODAY)[1]


@query("c04_monthly_audit_reservations_text", BV, _summary_select("reservations_text"),
       {**_BFILL, **_summary(BOOKED, _BAD, _FIX, "true",
                             f"NOT ({d_loose('class_start_date')} OR {d_iso_like('class_start_date')})", BOOKED_COLUMNS)})
def _audit_booked(t):
    return audit.monthly_audit([(BOOKED, booked_stored(t), booked_source(t))], "2000-03", TODAY)[1]


# the other layouts: stored = mapped report without the lost days


def _other(spec, view: str, cells: tuple[str, ...], junk: str):
    day = f'"{spec.date_column}"' if spec.date_kind == "date" else d_us(spec.date_column)
    quoted = ", ".join(f'"{c}"' for c in spec.names)
    order = ", ".join(f'"{c}" NULLS FIRST' for c in spec.names)
    text = spec.name.endswith("_text")

    def key(c: str, alias: str = "") -> str:
        return f"nullif({alias}\"{c}\", '')" if text else f'cast({alias}"{c}" AS varchar)'

    same = " AND ".join(f'{key(c, "h.")} IS NOT DISTINCT FROM {key(c, "w.")}' for c in spec.keys)
    keys = ", ".join(f'"{c}"' for c in spec.keys)
    ctes = {
        "mapped": f"SELECT {d_map(spec, cells, typed_dates=True)} FROM {view}",
        "dated": f"SELECT *, {day} AS d FROM mapped",
        "stored": f"SELECT * FROM dated WHERE NOT coalesce(day(d) IN {LOST}, false)",
        "source": f"SELECT * FROM dated WHERE NOT coalesce(day(d) = {EMPTY_DAY}, false)",
        "days": SALES_CTES["days"],
        "present": f"SELECT DISTINCT d FROM stored WHERE {junk} AND d {MONTH}",
        "missing": SALES_CTES["missing"],
        "fixed": f"SELECT * FROM stored WHERE d {MONTH}",
        "span": "SELECT min(d) - 3 AS lo, max(d) + 3 AS hi FROM missing",
        "held": f"SELECT DISTINCT {keys} FROM stored, span WHERE {junk} AND d BETWEEN lo AND hi",
        "wanted": f"""SELECT {quoted} FROM source WHERE d IN (SELECT d FROM missing)
            QUALIFY row_number() OVER (PARTITION BY {', '.join(key(c) for c in spec.keys)} ORDER BY {order}) = 1""",
        "filled": f"SELECT {quoted} FROM wanted AS w WHERE NOT EXISTS (SELECT 1 FROM held AS h WHERE {same})",
        **_summary(spec, "false" if not spec.format_columns else " OR ".join(
            f"NOT coalesce({d_strict(c)}, false)" for c in spec.format_columns), "false", junk,
            "d IS NULL" if spec.unparseable_by == "parse" else "false", quoted),
    }
    ctes["per_key"] = f"SELECT cast(sum(n) AS bigint) AS n, count(*) AS k FROM copies GROUP BY {keys}"

    @query(f"c04_monthly_audit_{spec.name}", (view,), _summary_select(spec.name), ctes)
    def _run(t):
        rows = mapped_columns(t, spec)
        return audit.monthly_audit([(spec, _without_days(rows, spec.day(), LOST_DAYS),
                                     _without_days(rows, spec.day(), (EMPTY_DAY,)))], "2000-03", TODAY)[1]


def _register_others():
    from rosterlake.catalog.reports import SOURCES

    junk = {
        "first_timers_text": "string_field_1 <> 'Customer ID' AND string_field_0 IS NOT NULL AND string_field_0 NOT LIKE '#%'",
        "reservations_typed": '"Reservation ID" IS NOT NULL',
    }
    for spec in (specs.SALES_TYPED, specs.FIRST_TIMERS_TEXT, specs.FIRST_TIMERS_TYPED, specs.RESERVATIONS_TYPED):
        view, cells = SOURCES[spec]
        _other(spec, view, cells, junk.get(spec.name, "true"))


_register_others()


@query("a21_overall_status", SV, f"""
  SELECT CASE WHEN severity = 1 AND fixes > 0 THEN cast(fixes AS varchar) || ' issue(s) found and fixed'
    WHEN severity = 1 THEN 'issue(s) found, needs review' ELSE 'all clean' END AS overall, fixes
  FROM ({_summary_select('sales_text')}) AS s""",
       {**_SFILL, **_summary(SALES, _SBAD, _SFIX, "order_status <> 'Order Status'", "d IS NULL", SALES_COLUMNS)})
def _overall(t):
    return Q.overall_status(audit.monthly_audit([(SALES, sales_stored(t), sales_source(t))], "2000-03", TODAY)[1])


@query("t05_buffered_keys", SV, f"""
  SELECT DISTINCT {', '.join(f"coalesce({c}, '') AS k{i}" for i, c in enumerate(SALES.keys))} FROM stored
  WHERE d BETWEEN DATE '{START}' - 3 AND DATE '{END}' + 3""", SALES_CTES)
def _buffered(t):
    lo, hi = I.buffered(START, END, 3, 3)
    keys = I.key_frame(P.in_month(sales_stored(t), SALES, lo, hi), SALES)
    return keys.toDF(*[f"k{i}" for i in range(len(SALES.keys))])
