"""Landing: report envelopes, header contract, positional mapping, entities, payloads, log and run rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlake import specs
from rosterlake.catalog.base import Tables, d_email, d_map, query
from rosterlake.operators.filters import not_cancelled
from rosterlake.plans import lifecycle
from rosterlake.sources import entities, outbox, reports
from rosterlake.surrogates import FIRST_TIMER_CELLS

SOURCES = {
    specs.SALES_TEXT: ("sales_report", specs.SALES_TEXT.names),
    specs.SALES_TYPED: ("sales_report", specs.SALES_TEXT.names),
    specs.FIRST_TIMERS_TEXT: ("first_timers_report", FIRST_TIMER_CELLS),
    specs.FIRST_TIMERS_TYPED: ("first_timers_report", FIRST_TIMER_CELLS),
    specs.RESERVATIONS_TEXT: ("reservations_report", specs.RESERVATIONS_TEXT.names),
    specs.RESERVATIONS_TYPED: ("reservations_report", specs.RESERVATIONS_TEXT.names),
}


def envelope(t: Tables, spec: specs.TableSpec) -> DataFrame:
    """The report of a table as landed envelopes, one row each: checked headers and positional cells."""
    view, cells = SOURCES[spec]
    return getattr(t, view).select(
        F.array(*[F.lit(h) for h in spec.headers]).alias("headers"),
        F.array(F.array(*[F.col(c).cast("string") for c in cells])).alias("rows"),
    )


def mapped(t: Tables, spec: specs.TableSpec) -> DataFrame:
    """Report rows of a table through header contract and positional mapping."""
    return reports.map_report(reports.report_rows(reports.assert_headers(envelope(t, spec), spec)), spec)


def mapped_columns(t: Tables, spec: specs.TableSpec, keep_raw: tuple[str, ...] = ()) -> DataFrame:
    """The same mapping taken straight from named columns, so that unused cells are never built."""
    view, cells = SOURCES[spec]
    raw = [F.col(cells[spec.headers.index(h)]).alias(reports.raw_name(h)) for h in keep_raw]
    return getattr(t, view).select(*[spec.cell(i, F.col(c).cast("string")) for i, c in enumerate(cells)], *raw)


for _spec, (_view, _cells) in SOURCES.items():
    query(f"s03_map_{_spec.name}", (_view,), f"SELECT {d_map(_spec, _cells)} FROM {_view}")(
        lambda t, spec=_spec: mapped(t, spec)
    )


@query("s01_s02_report_rows", ("sales_report",),
       "SELECT cast(35 AS bigint) AS cells, count(*) AS n FROM sales_report")
def _report_rows(t):
    spec = specs.SALES_TEXT
    rows = reports.report_rows(reports.assert_headers(envelope(t, spec), spec))
    return rows.groupBy(F.size("row").alias("cells")).agg(F.count(F.lit(1)).alias("n"))


@query("s01_pick_columns", ("details",), "SELECT customer_id, email, membership_status AS status FROM details")
def _pick(t):
    landed = t.details.select(
        F.array(F.lit("Email"), F.lit("Membership Status"), F.lit("Customer ID")).alias("headers"),
        F.array(F.array("email", "membership_status", "customer_id")).alias("rows"),
    )
    return reports.pick_columns(landed, {"customer_id": "Customer ID", "email": "Email", "status": "Membership Status"})


@query("s04_flatten_entities", ("bookings",), """
  SELECT cast(reservation_id AS varchar) AS id, status, guest_email, cast(class_session_id AS varchar) AS class_session_id,
    cast(user_id AS varchar) AS user_id, cast(spot_id AS varchar) AS spot_id, array_to_string(tags, ',') AS tags
  FROM bookings""")
def _entities(t):
    def one(c):
        return F.struct(F.struct(F.col(c).cast("string").alias("id")).alias("data"))

    known = {"status", "reservation_type", "guest_email", "class_session_min_datetime", "start_date", "start_time"}
    fields = [f.name for f in entities.RESERVATION["attributes"].dataType.fields]
    pages = t.bookings.select(F.array(F.struct(
        F.col("reservation_id").cast("string").alias("id"),
        F.struct(*[(F.col(c) if c in known else F.lit(None).cast("string")).alias(c) for c in fields]).alias("attributes"),
        F.struct(one("class_session_id").alias("class_session"), one("user_id").alias("user"),
                 one("spot_id").alias("spot"),
                 F.struct(F.transform("tags", lambda x: F.struct(x.alias("id"))).alias("data")).alias("tags"),
                 ).alias("relationships"),
    )).alias("data"))
    flat = entities.flatten_entities(pages, entities.RESERVATION)
    return flat.select("id", "status", "guest_email", "class_session_id", "user_id", "spot_id",
                       F.array_join("tags", ",").alias("tags"))


@query("s14_payload_flat", ("bookings",), """
  SELECT reservation_id, cast(json_merge_patch('{}', json_object('class_session_id', class_session_id, 'user_id', user_id,
    'status', status, 'guest_email', guest_email)) AS varchar) AS payload FROM bookings""")
def _payload(t):
    return outbox.to_payload(t.bookings, ["class_session_id", "user_id", "status", "guest_email"], ["reservation_id"])


@query("s14_payload_nested", ("ticks", "bookings"), """
  SELECT user_id, cast(floor((ordinal - 1) / 200) AS bigint) AS page, count(*) AS entries,
    cast(to_json(list({'ordinal': ordinal, 'reservation_id': reservation_id, 'status': status} ORDER BY ordinal)) AS varchar)
      AS payload
  FROM (SELECT user_id, reservation_id, coalesce(status, '') AS status,
          row_number() OVER (PARTITION BY user_id ORDER BY coalesce(class_session_min_datetime, start_date || 'T' || start_time),
            reservation_id) AS ordinal FROM bookings WHERE user_id IS NOT NULL) AS h
  GROUP BY user_id, page""")
def _payload_nested(t):
    from rosterlake.operators import matching as N

    order = N.visit_sort_key(F.col("class_session_min_datetime"), F.col("start_date"), F.col("start_time"))
    history = N.ordinal_in_history(
        t.bookings.where(F.col("user_id").isNotNull()).withColumn("sort_text", order), "user_id", "sort_text",
        "reservation_id")
    pages = N.history_pages(history, "user_id", 200)
    body = F.transform("entries", lambda e: F.struct(e["ordinal"].alias("ordinal"),
                       e["reservation_id"].alias("reservation_id"), e["status"].alias("status")))
    return pages.select("user_id", "page", F.size("entries").alias("entries"), F.to_json(body).alias("payload"))


@query("s15_log_rows", ("users",), """
  SELECT email, 'Birthday email' AS type, count(*) AS n FROM users WHERE email <> '' GROUP BY email""")
def _log(t):
    return lifecycle.count_by(outbox.log_rows(t.users.where("email <> ''"), "Birthday email"), "email", "type")


@query("s16_run_record", ("ratings_upload",), """
  SELECT 'import' AS job, CASE WHEN count(*) FILTER (WHERE trim(contact) = '' OR date_text = 'someday') > 0 THEN 'issue'
      ELSE 'completed' END AS status,
    count(*) FILTER (WHERE NOT (trim(contact) = '' OR date_text = 'someday')) AS imported,
    count(*) FILTER (WHERE trim(contact) = '' OR date_text = 'someday') AS ignored,
    nullif(string_agg(DISTINCT CASE WHEN trim(contact) = '' THEN 'no contact' WHEN date_text = 'someday' THEN 'no date' END,
      chr(10) ORDER BY CASE WHEN trim(contact) = '' THEN 'no contact' WHEN date_text = 'someday' THEN 'no date' END), '') AS issues
  FROM ratings_upload""")
def _run_record(t):
    issue = F.when(F.trim("contact") == "", "no contact").when(F.col("date_text") == "someday", "no date")
    return outbox.run_record(t.ratings_upload, "import", issue.isNull(), issue)


@query("s06_table_scans", ("legacy_sales", "legacy_customers", "legacy_reservations", "recent_sales",
                           "recent_reservations"), f"""
  SELECT 'legacy_sales' AS name, count(*) AS n, count(DISTINCT customer_id) AS people FROM legacy_sales
  UNION ALL SELECT 'legacy_customers', count(*), count(DISTINCT {d_email('emailaddress')}) FROM legacy_customers
  UNION ALL SELECT 'legacy_reservations', count(*), count(DISTINCT {d_email('emailaddress')}) FROM legacy_reservations
  UNION ALL SELECT 'sales', count(*), count(DISTINCT customer_id) FROM recent_sales
  UNION ALL SELECT 'reservations', count(*), count(DISTINCT customer_id) FROM recent_reservations""")
def _scans(t):
    from rosterlake.functions.text import norm_email

    def one(name, df, person):
        return df.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(person).alias("people")).select(
            F.lit(name).alias("name"), "n", "people")

    mail = norm_email(F.col("emailaddress"))
    parts = [one("legacy_sales", t.legacy_sales, F.col("customer_id")), one("legacy_customers", t.legacy_customers, mail),
             one("legacy_reservations", t.legacy_reservations, mail), one("sales", t.recent_sales, F.col("customer_id")),
             one("reservations", t.recent_reservations, F.col("customer_id"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("p03_not_cancelled", ("bookings",), """
  SELECT reservation_id, status FROM bookings WHERE NOT coalesce(lower(status) LIKE '%cancel%', false)""")
def _not_cancelled(t):
    return not_cancelled(t.bookings).select("reservation_id", "status")


@query("p03_live_with_status", ("bookings",), """
  SELECT reservation_id, status FROM bookings WHERE coalesce(status, '') <> '' AND lower(status) NOT LIKE '%cancel%'""")
def _live(t):
    return not_cancelled(t.bookings, need_status=True).select("reservation_id", "status")
