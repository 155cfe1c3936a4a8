"""High-water marks, windows, anti joins and the six report syncs.

The stored table ends at a cut day; the landed report starts three days before it, so that part of it is known.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from rosterlake import specs
from rosterlake.catalog.base import SALES_DAY, Tables, d_any, d_map, d_us, query
from rosterlake.catalog.reports import SOURCES, mapped_columns
from rosterlake.operators import filters as P
from rosterlake.operators import incremental as I
from rosterlake.operators import keyed as K
from rosterlake.plans import conversions, sync
from rosterlake.surrogates import FIRST_TIMER_CELLS

CUT, AS_OF = date(2001, 6, 18), SALES_DAY
YESTERDAY = date(2001, 6, 29)
SALES = specs.SALES_TEXT


def stored(t: Tables, spec: specs.TableSpec):
    """Stored rows up to the cut day; text sales and reservations with their messy dates."""
    if spec is specs.SALES_TEXT:
        rows = t.sales_stored
    elif spec is specs.RESERVATIONS_TEXT:
        rows = t.reservations_stored
    else:
        rows = mapped_columns(t, spec)
    return rows.where(spec.day() <= F.lit(CUT))


def landed(t: Tables, spec: specs.TableSpec):
    return mapped_columns(t, spec).where(spec.day() >= F.date_sub(F.lit(CUT), 3))


def _ctes(spec: specs.TableSpec, view: str, cells: tuple[str, ...], strict: bool = False) -> dict[str, str]:
    mapped_day = f'"{spec.date_column}"' if spec.date_kind == "date" else d_us(spec.date_column)
    old_view = {"sales_text": "sales_stored", "reservations_text": "reservations_stored"}.get(spec.name)
    old_day = d_any(spec.date_column) if spec.date_kind == "mixed" else mapped_day
    quoted = ", ".join(f'"{c}"' for c in spec.names)
    order = ", ".join(f'"{c}" NULLS FIRST' for c in spec.names)
    text = spec.name.endswith("_text")
    junk = {
        "sales_text": "order_status <> 'Order Status'",
        "first_timers_text": "string_field_1 <> 'Customer ID' AND string_field_0 IS NOT NULL AND string_field_0 NOT LIKE '#%'",
        "reservations_typed": '"Reservation ID" IS NOT NULL',
    }.get(spec.name, "true")

    def key(c: str, alias: str = "") -> str:
        return f"nullif({alias}\"{c}\", '')" if text else f'cast({alias}"{c}" AS varchar)'

    same = " AND ".join(f'{key(c, "h.")} IS NOT DISTINCT FROM {key(c, "w.")}' for c in spec.keys)
    part = ", ".join(key(c) for c in spec.keys)
    pick = (f"rank() OVER (PARTITION BY {part} ORDER BY floor((d - mark) / {spec.window_days}))" if strict
            else f"row_number() OVER (PARTITION BY {part} ORDER BY {order})")
    near = "AND d BETWEEN mark - 3 AND DATE '%s'" % YESTERDAY if spec.date_column in spec.keys else ""
    return {
        "mapped": f"SELECT {d_map(spec, cells, typed_dates=True)} FROM {view}",
        "old": f"SELECT *, {old_day} AS d FROM {old_view or 'mapped'}",
        "stored": f"SELECT * FROM old WHERE d <= DATE '{CUT}'",
        "landed": f"SELECT *, {mapped_day} AS d FROM mapped WHERE {mapped_day} >= DATE '{CUT}' - 3",
        "hw": f"SELECT coalesce(max(d), DATE '{AS_OF}' - 7) AS mark FROM stored WHERE {junk}",
        "held": f"SELECT {', '.join(f'{chr(34)}{c}{chr(34)}' for c in spec.keys)} FROM stored, hw WHERE true {near}",
        "batch": f"""SELECT {quoted} FROM landed, hw WHERE d BETWEEN mark AND DATE '{YESTERDAY}'
            QUALIFY {pick} = 1""",
        "fresh": f"SELECT {quoted} FROM batch AS w WHERE NOT EXISTS (SELECT 1 FROM held AS h WHERE {same})",
    }


def _out(spec: specs.TableSpec) -> str:
    """All columns with days as text."""
    return ", ".join(f'cast("{n}" AS varchar) AS "{n}"' if k == "date" else f'"{n}"'
                     for n, k in zip(spec.names, spec.kinds))


JOBS = {
    specs.SALES_TEXT: ("c01_sync_sales_text", sync.sync_sales),
    specs.SALES_TYPED: ("c01_sync_sales_typed", sync.sync_sales),
    specs.FIRST_TIMERS_TEXT: ("c02_sync_first_timers_text", sync.sync_first_timers),
    specs.FIRST_TIMERS_TYPED: ("c02_sync_first_timers_typed", sync.sync_first_timers),
    specs.RESERVATIONS_TEXT: ("c03_sync_reservations_text", sync.sync_reservations),
    specs.RESERVATIONS_TYPED: ("c03_sync_reservations_typed", sync.sync_reservations),
}
_EXTRA = {"sales_text": ("sales_stored",), "reservations_text": ("reservations_stored",)}

for _spec, (_name, _job) in JOBS.items():
    _view, _cells = SOURCES[_spec]
    query(_name, (_view, *_EXTRA.get(_spec.name, ())), f"SELECT {_out(_spec)} FROM fresh", _ctes(_spec, _view, _cells))(
        lambda t, spec=_spec, job=_job: job(landed(t, spec), stored(t, spec), AS_OF, spec=spec).rows
    )

_FT = specs.FIRST_TIMERS_TYPED


@query("c02_sync_first_timers_strict", ("first_timers_report",), f"SELECT {_out(_FT)} FROM fresh",
       _ctes(_FT, "first_timers_report", FIRST_TIMER_CELLS, strict=True))
def _strict(t):
    return sync.sync_first_timers(landed(t, _FT), stored(t, _FT), AS_OF, spec=_FT, strict_reference=True).rows


@query("a01_high_water_us", ("sales_report", "sales_stored"), "SELECT cast(mark AS varchar) AS mark FROM hw",
       _ctes(SALES, "sales_report", SALES.names))
def _hw(t):
    return I.high_water(stored(t, SALES), SALES, AS_OF)


_RT = specs.RESERVATIONS_TEXT


@query("a02_high_water_mixed", ("reservations_report", "reservations_stored"), "SELECT cast(mark AS varchar) AS mark FROM hw",
       _ctes(_RT, "reservations_report", _RT.names))
def _hw_mixed(t):
    return I.high_water(stored(t, _RT), _RT, AS_OF)


@query("t01_sync_windows", ("sales_report", "sales_stored"), f"""
  SELECT cast(cast(s AS date) AS varchar) AS min_date, cast(least(cast(s AS date) + 6, DATE '{YESTERDAY}') AS varchar) AS max_date,
    (SELECT count(*) FROM landed WHERE d BETWEEN cast(s AS date) AND least(cast(s AS date) + 6, DATE '{YESTERDAY}')) AS n
  FROM (SELECT unnest(generate_series(mark, DATE '{YESTERDAY}', INTERVAL 7 DAY)) AS s FROM hw) AS x""",
       _ctes(SALES, "sales_report", SALES.names))
def _windows(t):
    mark = I.read_mark(stored(t, SALES), SALES, AS_OF)
    start, end = I.sync_span(mark, AS_OF)
    windows = I.chunk_range(t.spark, start, end, SALES.window_days)
    index = I.window_index(SALES, start, SALES.window_days)
    rows = P.in_month(landed(t, SALES), SALES, start, end).groupBy(index.alias("i")).agg(F.count(F.lit(1)).alias("n"))
    numbered = windows.withColumn("i", F.floor(F.datediff("min_date", F.lit(start)) / SALES.window_days))
    return numbered.join(rows, "i", "left").select("min_date", "max_date", F.coalesce("n", F.lit(0)).alias("n"))


@query("j04_anti_join_composite_key", ("sales_report", "sales_stored"), """
  SELECT order_number, product_id, variant_id, transaction_date, line_status, line_quantity FROM mapped AS w
  WHERE NOT EXISTS (SELECT 1 FROM stored AS h WHERE nullif(h.order_number, '') IS NOT DISTINCT FROM nullif(w.order_number, '')
    AND nullif(h.product_id, '') IS NOT DISTINCT FROM nullif(w.product_id, '')
    AND nullif(h.variant_id, '') IS NOT DISTINCT FROM nullif(w.variant_id, '')
    AND nullif(h.transaction_date, '') IS NOT DISTINCT FROM nullif(w.transaction_date, '')
    AND nullif(h.line_status, '') IS NOT DISTINCT FROM nullif(w.line_status, '')
    AND nullif(h.line_quantity, '') IS NOT DISTINCT FROM nullif(w.line_quantity, ''))""",
       _ctes(SALES, "sales_report", SALES.names))
def _anti(t):
    return I.new_rows(mapped_columns(t, SALES), stored(t, SALES), SALES).select(*SALES.keys)


@query("j05_anti_join_id", ("reservations_report", "reservations_stored"), """
  SELECT reservation_id, customer_id FROM mapped WHERE reservation_id NOT IN
    (SELECT reservation_id FROM stored WHERE reservation_id IS NOT NULL)""",
       _ctes(_RT, "reservations_report", _RT.names))
def _anti_id(t):
    return I.new_rows(mapped_columns(t, _RT), stored(t, _RT), _RT).select("reservation_id", "customer_id")


@query("j17_existing_keys", ("reservations_report", "reservations_stored"), """
  SELECT DISTINCT reservation_id AS k0 FROM stored WHERE reservation_id IN (SELECT reservation_id FROM landed)""",
       _ctes(_RT, "reservations_report", _RT.names))
def _existing(t):
    return I.existing_keys(landed(t, _RT), stored(t, _RT), _RT).toDF("k0")


@query("w03_keep_first", ("first_timers_report",), """
  SELECT customer_id, customer, first_class_date FROM first_timers_report
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY first_class_date, class_start_time, customer NULLS FIRST,
    instructor_name, customer_email NULLS FIRST) = 1""")
def _keep_first(t):
    order = [F.col(c) for c in ("first_class_date", "class_start_time", "customer", "instructor_name", "customer_email")]
    return I.keep_first(t.first_timers_report, [F.col("customer_id")], order).select("customer_id", "customer", "first_class_date")


@query("t03_append_twice_adds_nothing", ("sales_report", "sales_stored"), """
  SELECT w.order_number, w.product_id FROM batch AS w WHERE NOT EXISTS (
    SELECT 1 FROM (SELECT * FROM held UNION ALL SELECT order_number, product_id, variant_id, transaction_date, line_status,
      line_quantity FROM fresh) AS h
    WHERE coalesce(h.order_number, '') = coalesce(w.order_number, '') AND coalesce(h.product_id, '') = coalesce(w.product_id, '')
      AND coalesce(h.variant_id, '') = coalesce(w.variant_id, '') AND coalesce(h.transaction_date, '') = coalesce(w.transaction_date, '')
      AND coalesce(h.line_status, '') = coalesce(w.line_status, '') AND coalesce(h.line_quantity, '') = coalesce(w.line_quantity, ''))""",
       _ctes(SALES, "sales_report", SALES.names))
def _twice(t):
    span = (CUT, YESTERDAY)
    first = I.incremental_append(landed(t, SALES), stored(t, SALES), SALES, span)
    after = stored(t, SALES).select(*SALES.names).unionByName(first)
    return I.incremental_append(landed(t, SALES), after, SALES, span).select("order_number", "product_id")


# --- conversions ------------------------------------------------------------------------------------------------------

TYPES = ("('Credits', 'Memberships', 'Email Credit Gift Cards', 'Email Gift Cards', 'Physical Credit Gift Cards', "
         "'Physical Gift Cards')")


@query("p05_qualifies", ("sales_report",), f"""
  SELECT product_type, count(*) AS n FROM sales_report WHERE product_type IN {TYPES} AND line_status = 'Completed' GROUP BY 1""")
def _qualifies(t):
    return P.qualifies(t.sales_report).groupBy("product_type").agg(F.count(F.lit(1)).alias("n"))


_CONV = f"""SELECT s.*, trim(coalesce(nullif(u.email, ''), nullif(s.customer_email, ''), '')) AS email,
    trim(coalesce(u.first_name, '')) AS first_name, trim(coalesce(u.last_name, '')) AS last_name,
    regexp_replace(coalesce(u.phone_number, ''), '\\D', '', 'g') AS phone
  FROM sales_report AS s LEFT JOIN users AS u ON s.customer_id = cast(u.user_id AS varchar)"""


@query("j11_conversion_rows", ("sales_report", "users"), """
  SELECT order_number, product_id, email, first_name, last_name, phone FROM conv""", {"conv": _CONV})
def _conv(t):
    return conversions.conversion_rows(t.sales_report, t.users).select(
        "order_number", "product_id", "email", "first_name", "last_name", "phone")


def _hash(c: str) -> str:
    return f"CASE WHEN lower(trim({c})) <> '' THEN sha256(lower(trim({c}))) END AS"


@query("c07_offline_conversions", ("sales_report", "users"), f"""
  SELECT order_number, 'Purchase' AS event_name, cast(epoch(cast(order_date_utc || ' ' ||
      coalesce(nullif(order_time_utc, ''), '00:00:00') AS timestamp)) AS bigint) AS event_time,
    'physical_store' AS action_source, {_hash('email')} em, {_hash('phone')} ph, {_hash('first_name')} fn,
    {_hash('last_name')} ln, round(cast(line_subtotal AS double), 6) AS value, trim(currency) AS currency
  FROM conv WHERE product_type IN {TYPES} AND line_status = 'Completed'""", {"conv": _CONV})
def _events(t):
    return conversions.offline_conversions(t.sales_report, t.users)


@query("s14_event_payloads", ("sales_report", "users"), f"""
  SELECT order_number, cast(json_merge_patch('{{}}', json_object('event_name', 'Purchase', 'event_time',
      cast(epoch(cast(order_date_utc || ' ' || coalesce(nullif(order_time_utc, ''), '00:00:00') AS timestamp)) AS bigint),
      'action_source', 'physical_store')) AS varchar) AS head,
    CASE WHEN lower(trim(email)) <> '' THEN sha256(lower(trim(email))) END AS em, count(*) AS n
  FROM conv WHERE product_type IN {TYPES} AND line_status = 'Completed' GROUP BY ALL""", {"conv": _CONV})
def _payloads(t):
    body = conversions.event_payloads(conversions.offline_conversions(t.sales_report, t.users))
    parsed = body.select(
        "order_number",
        F.concat(F.regexp_extract("payload", r'^(.*"physical_store")', 1), F.lit("}")).alias("head"),
        F.get_json_object("payload", "$.user_data.em[0]").alias("em"))
    return parsed.groupBy("order_number", "head", "em").agg(F.count(F.lit(1)).alias("n"))


@query("c01_c07_sync_then_conversions", ("sales_report", "sales_stored", "users"), f"""
  SELECT c.order_number, cast(min(epoch(cast(c.order_date_utc || ' ' || coalesce(nullif(c.order_time_utc, ''), '00:00:00')
      AS timestamp))) AS bigint) AS event_time, count(*) AS n FROM conv AS c JOIN fresh AS f ON f.order_number = c.order_number AND f.product_id = c.product_id
    AND f.variant_id = c.variant_id AND f.line_quantity = c.line_quantity AND f.line_status = c.line_status
    AND f.transaction_date = substr(c.transaction_date, 6, 2) || '/' || substr(c.transaction_date, 9, 2) || '/' || substr(c.transaction_date, 1, 4)
  WHERE c.product_type IN {TYPES} AND c.line_status = 'Completed' GROUP BY 1""",
       {**_ctes(SALES, "sales_report", SALES.names), "conv": _CONV})
def _sync_conversions(t):
    source = mapped_columns(t, SALES, conversions.RAW_CELLS).where(SALES.day() >= F.date_sub(F.lit(CUT), 3))
    new = sync.sync_sales(source, stored(t, SALES), AS_OF).rows
    events = conversions.offline_conversions(new, t.users)
    return events.groupBy("order_number").agg(F.min("event_time").alias("event_time"), F.count(F.lit(1)).alias("n"))


@query("a19_outcomes", ("sales_report",), """
  SELECT line_status AS outcome, count(*) AS n FROM sales_report GROUP BY 1""")
def _outcomes(t):
    return K.outcomes(t.sales_report.withColumnRenamed("line_status", "outcome"))
