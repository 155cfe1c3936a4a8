"""Column expressions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from rosterlake.catalog.base import (
    BOOKING_NOW, SALES_DAY, d_any, d_email, d_float, d_int, d_is_email, d_iso_like, d_iso_mdy, d_local, d_loose, d_mdy, d_norm,
    d_repaired, d_strict, d_time12, d_us, query,
)
from rosterlake.functions import dates as D
from rosterlake.functions import membership as M
from rosterlake.functions import text as X
from rosterlake.operators import filters as P
from rosterlake.plans import classes, lifecycle, ratings


@query("f01_to_mdy_f02_time12h", ("sales_report",), f"""
  SELECT order_date_utc, order_time_utc, {d_mdy('order_date_utc')} AS mdy, {d_time12('order_time_utc')} AS time12, count(*) AS n
  FROM sales_report GROUP BY ALL""")
def _f01(t):
    df = t.sales_report.select("order_date_utc", "order_time_utc", D.to_mdy(F.col("order_date_utc")).alias("mdy"),
                               D.to_time12h(F.col("order_time_utc")).alias("time12"))
    return lifecycle.count_by(df, *df.columns)


@query("f03_f05_flags", ("reservations_report",), """
  SELECT unconverted_guest AS cell, coalesce(lower(unconverted_guest), '') AS flag_text, coalesce(unconverted_guest, '') AS filled,
    lower(unconverted_guest) = 'true' AS flag,
    CASE WHEN unconverted_guest IS NOT NULL THEN CASE WHEN lower(unconverted_guest) = 'true' THEN 'true' ELSE 'false' END END
      AS flag_word, count(*) AS n FROM reservations_report GROUP BY ALL""")
def _f03(t):
    c = F.col("unconverted_guest")
    df = t.reservations_report.select(c.alias("cell"), X.bool_text(c).alias("flag_text"), X.null_to_empty(c).alias("filled"),
                                      X.to_bool(c).alias("flag"), X.bool_string(c).alias("flag_word"))
    return lifecycle.count_by(df, *df.columns)


@query("f04_f06_numbers", ("sales_report",), f"""
  SELECT product_barcode, line_quantity, {d_float('product_barcode')} AS barcode, {d_int('product_barcode')} AS barcode_int,
    {d_int('line_quantity')} AS quantity, count(*) AS n FROM sales_report GROUP BY ALL""")
def _f06(t):
    b, q = F.col("product_barcode"), F.col("line_quantity")
    df = t.sales_report.select(b, q, X.to_float(b).alias("barcode"), X.to_int(b).alias("barcode_int"),
                               X.to_int(q).alias("quantity"))
    return lifecycle.count_by(df, *df.columns)


@query("f04_date_only", ("reservations_report",), """
  SELECT substr(creation_date, 1, 10) AS day, count(*) AS n FROM reservations_report GROUP BY 1""")
def _f04(t):
    return lifecycle.count_by(t.reservations_report, D.date_only(F.col("creation_date")).alias("day"))


_C = "class_start_date"


@query("f07_f10_date_shapes", ("reservations_stored",), f"""
  SELECT {_C}, coalesce({d_strict(_C)}, false) AS strict, coalesce({d_loose(_C)}, false) AS loose,
    coalesce({d_iso_like(_C)}, false) AS iso, {d_norm(_C)} AS normal, coalesce({d_norm(_C)}, {d_iso_mdy(_C)}) AS normal_any,
    {d_iso_mdy(_C)} AS from_iso, cast({d_us(_C)} AS varchar) AS us_day, cast({d_any(_C)} AS varchar) AS any_day, count(*) AS n
  FROM reservations_stored GROUP BY ALL""")
def _f07(t):
    c = F.col(_C)
    no = F.lit(False)
    df = t.reservations_stored.select(
        c, F.coalesce(D.strict_mdy(c), no).alias("strict"), F.coalesce(D.loose_mdy(c), no).alias("loose"),
        F.coalesce(D.iso_like(c), no).alias("iso"), D.normalize_mdy(c).alias("normal"),
        D.normalize_any(c).alias("normal_any"), D.iso_to_mdy(c).alias("from_iso"), D.tolerant_date(c).alias("us_day"),
        D.tolerant_date_any(c).alias("any_day"))
    return lifecycle.count_by(df, *df.columns)


@query("f11_repaired_text", ("reservations_stored",), f"""
  SELECT reservation_id, {d_repaired(_C)} AS start_text, {d_repaired('cancelled_date')} AS cancelled_text
  FROM reservations_stored""")
def _f11(t):
    return t.reservations_stored.select("reservation_id", D.repaired_text(F.col(_C)).alias("start_text"),
                                        D.repaired_text(F.col("cancelled_date")).alias("cancelled_text"))


@query("f12_norm_email_p15_with_email", ("sales_report",), f"""
  SELECT {d_email('customer_email')} AS email, count(*) AS n FROM sales_report
  WHERE {d_email('customer_email')} <> '' GROUP BY 1""")
def _f12(t):
    return lifecycle.count_by(P.with_email(t.sales_report, "customer_email"), "email")


@query("f13_f14_hash_and_digits", ("users",), """
  SELECT user_id, CASE WHEN lower(trim(email)) <> '' THEN sha256(lower(trim(email))) END AS em,
    CASE WHEN lower(trim(first_name)) <> '' THEN sha256(lower(trim(first_name))) END AS fn,
    regexp_replace(phone_number, '\\D', '', 'g') AS phone FROM users""")
def _f13(t):
    return t.users.select("user_id", X.pii_hash(F.col("email")).alias("em"), X.pii_hash(F.col("first_name")).alias("fn"),
                          X.digits(F.col("phone_number")).alias("phone"))


@query("f15_event_time", ("sales_report",), """
  SELECT order_number, order_time_utc, cast(epoch(cast(order_date_utc || ' ' || coalesce(nullif(order_time_utc, ''), '00:00:00')
    AS timestamp)) AS bigint) AS event_time, count(*) AS n FROM sales_report GROUP BY ALL""")
def _f15(t):
    df = t.sales_report.select("order_number", "order_time_utc",
                               D.event_time(F.col("order_date_utc"), F.col("order_time_utc")).alias("event_time"))
    return lifecycle.count_by(df, *df.columns)


PLAN_DAYS_SQL = """CASE
  WHEN regexp_matches(lower(item), '(\\d+)\\s*(?:year|an\\b|ann[ée]e)') THEN cast(regexp_extract(lower(item), '(\\d+)\\s*(?:year|an\\b|ann[ée]e)', 1) AS bigint) * 365
  WHEN regexp_matches(lower(item), '(\\d+)\\s*(?:month|mois)') THEN cast(regexp_extract(lower(item), '(\\d+)\\s*(?:month|mois)', 1) AS bigint) * 30
  WHEN regexp_matches(lower(item), '(\\d+)\\s*(?:week|semaine)') THEN cast(regexp_extract(lower(item), '(\\d+)\\s*(?:week|semaine)', 1) AS bigint) * 7
  ELSE 30 END"""
RATE_SQL = """CASE WHEN regexp_matches(lower(item), 'unlimit|illimit') THEN 7.0::double
  WHEN regexp_matches(lower(item), '(\\d+)\\s*(?:class|classe|cours).*(?:per week|par semaine)')
    THEN cast(regexp_extract(lower(item), '(\\d+)\\s*(?:class|classe|cours).*(?:per week|par semaine)', 1) AS double)
  WHEN regexp_matches(lower(item), '(\\d+)\\s*(?:class|classe|cours).*(?:per month|par mois)')
    THEN cast(regexp_extract(lower(item), '(\\d+)\\s*(?:class|classe|cours).*(?:per month|par mois)', 1) AS double) / 4.33::double
  ELSE 7.0::double END"""
LEGACY_CATEGORY_SQL = """CASE WHEN regexp_matches(lower(item), 'unlimit|illimit|member|bike.*(commit|month|autorenew)')
  THEN 'membership' ELSE 'credit' END"""
PACK_SQL = "try_cast(nullif(regexp_extract(item, '^(\\d+)', 1), '') AS bigint)"


@query("f16_f19_item_text", ("legacy_sales",), f"""
  SELECT item, {PLAN_DAYS_SQL} AS days, round({RATE_SQL}, 6) AS rate, {LEGACY_CATEGORY_SQL} AS category, {PACK_SQL} AS pack,
    count(*) AS n FROM legacy_sales GROUP BY ALL""")
def _f16(t):
    c = F.col("item")
    df = t.legacy_sales.groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    return df.select("item", M.plan_days(c).alias("days"), M.weekly_rate(c).alias("rate"),
                     M.legacy_category(c).alias("category"), M.pack_size(c).alias("pack"), "n")


@query("f18_product_category", ("sales_report",), """
  SELECT product_type, CASE product_type WHEN 'Memberships' THEN 'membership' WHEN 'Credits' THEN 'credit' END AS category,
    count(*) AS n FROM sales_report GROUP BY ALL""")
def _f18(t):
    df = t.sales_report.select("product_type", M.product_category(F.col("product_type")).alias("category"))
    return lifecycle.count_by(df, *df.columns)


@query("f22_month_cycle", ("legacy_reservations",), f"""
  SELECT month(class_date) AS month, round(sin(2 * acos(-1.0) * month(class_date) / 12), 6) AS s,
    round(cos(2 * acos(-1.0) * month(class_date) / 12), 6) AS c,
    round(sin(2 * acos(-1.0) * {SALES_DAY.month} / 12), 6) AS today_s, count(*) AS n FROM legacy_reservations GROUP BY ALL""")
def _f22(t):
    s, c = D.month_cycle(F.col("class_date"))
    df = t.legacy_reservations.select(F.month("class_date").alias("month"), F.round(s, 6).alias("s"), F.round(c, 6).alias("c"),
                                      F.round(D.month_cycle(F.lit(SALES_DAY))[0], 6).alias("today_s"))
    return lifecycle.count_by(df, *df.columns)


RATING_SQL = f"""coalesce(CASE WHEN {d_float('rating_text')} = floor({d_float('rating_text')})
  THEN cast(cast({d_float('rating_text')} AS bigint) AS varchar) ELSE cast({d_float('rating_text')} AS varchar) END, '')"""
RATING_DAY_SQL = """coalesce(cast(try_strptime(trim(date_text), '%Y-%m-%d') AS date),
  cast(try_strptime(trim(date_text), '%m/%d/%Y') AS date))"""
RATING_KEY_SQL = f"""CASE WHEN coalesce(trim(contact), '') <> '' AND {RATING_DAY_SQL} IS NOT NULL THEN
  CASE WHEN lower(trim(contact)) = 'anonymous user' THEN 'anon|' || cast({RATING_DAY_SQL} AS varchar) || '|' ||
    lower(trim(coalesce(instructor, ''))) || '|' || {RATING_SQL} || '|' || lower(trim(coalesce(class_type, '')))
  ELSE 'named|' || lower(trim(contact)) || '|' || cast({RATING_DAY_SQL} AS varchar) || '|' || lower(trim(coalesce(class_type, ''))) END END"""


@query("f26_rating_key_f28_parse_date", ("ratings_upload",), f"""
  SELECT line, cast({RATING_DAY_SQL} AS varchar) AS day, {RATING_SQL} AS rating, {RATING_KEY_SQL} AS dedupe_key FROM ratings_upload""")
def _f26(t):
    return ratings.prepare_ratings(t.ratings_upload).select("line", "day", "rating", "dedupe_key")


@query("f29_is_email", ("users",), f"SELECT email, {d_is_email('email')} AS valid, count(*) AS n FROM users GROUP BY ALL")
def _f29(t):
    df = t.users.select("email", X.is_email(F.col("email")).alias("valid"))
    return lifecycle.count_by(df, *df.columns)


#: Instant of a request, from the definition of the view rather than from its text.
REQUEST_AT = "make_timestamp(cast((1704067200 + hour * 3600 + room * 420 + (event_id % 7 - 3) * 60) * 1000000 AS bigint))"


@query("f30_local_text_to_utc", ("ticks",), f"""
  SELECT event_id AS request_id, CASE WHEN event_id % 8 < 6 THEN cast({REQUEST_AT} AS varchar) END AS at FROM ticks""")
def _f30(t):
    return t.requests.select("request_id", D.local_text_to_utc(F.col("date_text")).alias("at"))


@query("f31_utc_to_local_f38_lead_instructor", ("sessions",), f"""
  SELECT session_id, strftime({d_local('start_datetime')}, '%Y-%m-%dT%H:%M:%S') AS local_start,
    cast(cast({d_local('start_datetime')} AS date) AS varchar) AS local_day,
    CASE WHEN instructor_names[1] <> '' THEN instructor_names[1] WHEN len(instructor_names) > 0
      THEN array_to_string(instructor_names, ', ') ELSE '' END AS instructor FROM sessions""")
def _f31(t):
    return t.sessions.select("session_id", D.utc_to_local_text(F.col("start_datetime")).alias("local_start"),
                             D.utc_to_local_date(F.col("start_datetime")).alias("local_day"),
                             X.lead_instructor(F.col("instructor_names")).alias("instructor"))


@query("f33_strip_zero_width", ("bookings",), """
  SELECT reservation_id, cast(class_session_id AS varchar) AS clean FROM bookings""")
def _f33(t):
    dirty = F.concat(F.lit("\u200b"), F.col("class_session_id").cast("string"), F.lit("\ufeff "))
    return t.bookings.select("reservation_id", X.strip_zero_width(dirty).alias("clean"))


_MONTHS_FR = ", ".join(f"'{m}'" for m in D.FRENCH_MONTHS)


@query("f34_long_dates", ("credits",), f"""
  SELECT cast(cast(expiration_datetime AS date) AS varchar) AS day, strftime(expiration_datetime, '%B %-d, %Y') AS en,
    cast(day(expiration_datetime) AS varchar) || ' ' || [{_MONTHS_FR}][month(expiration_datetime)] || ' ' ||
      cast(year(expiration_datetime) AS varchar) AS fr, count(*) AS n FROM credits GROUP BY ALL""")
def _f34(t):
    day = F.to_date("expiration_datetime")
    df = t.credits.select(day.alias("day"), D.long_date(day).alias("en"), D.long_date(day, "fr").alias("fr"))
    return lifecycle.count_by(df, *df.columns)


@query("f35_mask_pii", ("users",), r"""
  SELECT user_id, regexp_replace(email, '^(.).*(@.*)$', '\1***\2') AS email,
    '+1 (*14) *55-**' || right(phone_number, 2) AS phone,
    CASE WHEN full_name IS NOT NULL THEN '[redacted name]' END AS name FROM users""")
def _f35(t):
    return t.users.select("user_id", X.mask_pii(F.col("email"), "email").alias("email"),
                          X.mask_pii(F.col("phone_number"), "phone").alias("phone"),
                          X.mask_pii(F.col("full_name"), "name").alias("name"))


@query("f36_note_text_and_names", ("measurements", "details"), """
  SELECT m.row_id, 'Bike Measurements:' || chr(10) || 'Seat Height: ' || coalesce(seat_height, '') || chr(10) ||
    'Seat Position: ' || coalesce(seat_position, '') || chr(10) || 'Handlebar Height: ' || coalesce(handlebar_height, '') || chr(10) ||
    'Handlebar Position: ' || coalesce(handlebar_position, '') || chr(10) || 'Shoe Size: ' || coalesce(shoe_size, '') AS text,
    nullif(concat_ws(' ', nullif(d.first_name, ''), nullif(d.last_name, '')), '') AS name
  FROM measurements AS m JOIN details AS d ON d.customer_id = cast(m.row_id AS varchar)""")
def _f36(t):
    joined = t.measurements.join(
        t.details.select(F.col("customer_id").alias("_id"), "first_name", "last_name"), F.col("_id") == F.col("row_id").cast("string"))
    return joined.select("row_id", X.note_text("Bike Measurements:", [(label, F.col(c)) for label, c in classes.MEASURES]).alias("text"),
                         X.full_name(F.col("first_name"), F.col("last_name")).alias("name"))


@query("f36_first_of", ("sessions",), """
  SELECT session_id, coalesce(instructor_names[1], '') AS first FROM sessions""")
def _first_of(t):
    return t.sessions.select("session_id", X.first_of(F.col("instructor_names")).alias("first"))


@query("f37_month_bounds", ("legacy_sales",), """
  SELECT cast(date_trunc('month', d) AS date)::varchar AS month_start, cast(last_day(d) AS varchar) AS month_end,
    cast(cast(date_trunc('month', d) - interval 1 month AS date) AS varchar) AS previous_start, count(*) AS n
  FROM legacy_sales GROUP BY ALL""")
def _f37(t):
    d = F.col("d")
    df = t.legacy_sales.select(
        F.trunc(d, "month").alias("month_start"), F.last_day(d).alias("month_end"),
        F.add_months(F.trunc(d, "month"), -1).alias("previous_start"))
    return lifecycle.count_by(df, *df.columns)


@query("u05_status_set", ("details",), """
  SELECT customer_id, array_to_string(list_sort(list_distinct(list_filter(
    list_transform(string_split(coalesce(membership_status, ''), ','), lambda x: trim(x)), lambda x: x <> ''))), ',') AS statuses
  FROM details""")
def _u05(t):
    return t.details.select("customer_id", F.array_join(F.array_sort(X.status_set(F.col("membership_status"))), ",").alias("statuses"))


@query("p09_changed_since", ("measurements",), f"""
  SELECT row_id FROM measurements WHERE last_modified > TIMESTAMP '{BOOKING_NOW}' - INTERVAL 1 DAY""")
def _p09(t):
    return P.changed_since(t.measurements, BOOKING_NOW).select("row_id")
