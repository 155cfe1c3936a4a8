"""Second visits, new people, first bookings, reminders, credits, birthdays."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from rosterlake.catalog.base import BOOKING_DAY, BOOKING_NOW, SALES_DAY, d_local, query
from rosterlake.catalog.keyed import booking_dates
from rosterlake.functions.dates import FRENCH_MONTHS
from rosterlake.operators import filters as P
from rosterlake.operators import matching as N
from rosterlake.plans import lifecycle as L

DAY = f"DATE '{BOOKING_DAY}'"
#: Credits and birthdays are looked at a year earlier than the sales end, where every scale has rows.
CREDIT_DAY = SALES_DAY.replace(year=2000)

_FIRST_USER = {"first_user": "SELECT lower(trim(email)) AS e, min(user_id) AS user_id FROM users WHERE email <> '' GROUP BY 1"}
_DUE = {
    **_FIRST_USER,
    "due": """SELECT c.customer_id, c.email, u.user_id FROM op_customers AS c JOIN first_user AS u ON u.e = lower(trim(c.email))
        WHERE first_class_taken = 1 AND second_class_taken = 0 AND c.email <> ''""",
    "history": """SELECT d.customer_id, d.email, d.user_id, b.reservation_id, b.class_session_id, coalesce(b.status, '') AS status,
        row_number() OVER (PARTITION BY d.customer_id ORDER BY coalesce(nullif(b.class_session_min_datetime, ''),
          coalesce(b.start_date, '') || 'T' || coalesce(b.start_time, '')), b.reservation_id) AS ordinal
      FROM due AS d JOIN bookings AS b USING (user_id)""",
}
_DV = ("bookings", "users", "op_customers")


@query("p14_awaiting_second", ("op_customers",), """
  SELECT customer_id, email FROM op_customers WHERE first_class_taken = 1 AND second_class_taken = 0""")
def _awaiting(t):
    return P.awaiting_second(t.op_customers).select("customer_id", "email")


@query("c08_second_visit", _DV, """
  SELECT customer_id, email, user_id, reservation_id AS second_reservation_id, class_session_id AS second_class_session_id,
    status AS second_status FROM history WHERE ordinal = 2 AND class_session_id IS NOT NULL""", _DUE)
def _second(t):
    return L.second_visit(t.op_customers, t.users, t.bookings)


@query("w01_visit_history", _DV, "SELECT customer_id, ordinal, reservation_id, class_session_id, status FROM history", _DUE)
def _history(t):
    return L.visit_history(t.op_customers, t.users, t.bookings)


@query("w01_nth_booking", ("bookings",), """
  SELECT user_id, reservation_id, ordinal FROM (SELECT user_id, reservation_id, row_number() OVER (PARTITION BY user_id ORDER BY
    coalesce(class_session_min_datetime, start_date || 'T' || start_time), reservation_id) AS ordinal FROM bookings
    WHERE user_id IS NOT NULL) AS x WHERE ordinal = 2""")
def _nth(t):
    order = N.visit_sort_key(F.col("class_session_min_datetime"), F.col("start_date"), F.col("start_time"))
    known = t.bookings.where(F.col("user_id").isNotNull()).withColumn("sort_text", order)
    return N.nth_by_time(known, "user_id", [F.col("sort_text"), F.col("reservation_id")], 2).select(
        "user_id", "reservation_id", "ordinal")


# --- new people -------------------------------------------------------------------------------------------------------

_GUEST = "coalesce(b.guest_email, '') <> ''"
_NEW = {
    **_FIRST_USER,
    "classes": "SELECT session_id AS class_session_id, 'class' || cast(session_id AS varchar) AS class_record_id FROM sessions WHERE location_id IS NOT NULL",
    "marked": f"""SELECT b.reservation_id, b.class_session_id, k.class_record_id,
        CASE WHEN {_GUEST} THEN b.guest_email ELSE m.email END AS email,
        CASE WHEN {_GUEST} THEN gu.phone_number ELSE m.phone_number END AS phone_number,
        CASE WHEN {_GUEST} THEN gu.date_joined ELSE m.date_joined END AS date_joined,
        CASE WHEN {_GUEST} THEN gu.marketing_opt_in ELSE m.marketing_opt_in END AS marketing_opt_in,
        b.status, b.start_datetime,
        CASE WHEN NOT coalesce(list_contains(b.tags, '463'), false) THEN 'no-new-people-tag'
          WHEN b.class_session_id IS NULL THEN 'no-class-session-id'
          WHEN {_GUEST} AND g.user_id IS NULL THEN 'no-user-guest-email'
          WHEN NOT {_GUEST} AND b.user_id IS NULL THEN 'no-user-id'
          WHEN NOT {_GUEST} AND m.user_id IS NULL THEN 'user-not-found'
          WHEN NOT {_GUEST} AND coalesce(m.email, '') = '' THEN 'user-has-no-email'
          WHEN k.class_record_id IS NULL THEN 'no-class-record' END AS reason
      FROM bookings AS b LEFT JOIN first_user AS g ON g.e = lower(trim(b.guest_email)) AND {_GUEST}
        LEFT JOIN users AS gu ON gu.user_id = g.user_id LEFT JOIN users AS m ON m.user_id = b.user_id
        LEFT JOIN classes AS k ON k.class_session_id = b.class_session_id""",
    "today": f"SELECT * FROM marked WHERE status = 'pending' AND cast({d_local('start_datetime')} AS date) BETWEEN {DAY} AND {DAY} + 1",
    "good": """SELECT t.*, s.start_datetime AS starts_at FROM today AS t LEFT JOIN sessions AS s ON s.session_id = t.class_session_id
        WHERE reason IS NULL""",
}
_NV = ("bookings", "users", "sessions", "op_customers")


def _classes(t):
    return t.sessions.where(F.col("location_id").isNotNull()).select(
        F.col("session_id").alias("class_session_id"),
        F.concat(F.lit("class"), F.col("session_id").cast("string")).alias("class_record_id"))


@query("p06_has_tag", ("bookings",), """
  SELECT reservation_id FROM bookings WHERE coalesce(list_contains(tags, '463'), false)""")
def _tagged(t):
    return t.bookings.where(P.has_tag(F.col("tags"))).select("reservation_id")


@query("p04_pending_between", ("bookings",), """
  SELECT reservation_id FROM bookings WHERE status = 'pending' AND reservation_type = 'standard'
    AND start_datetime >= TIMESTAMP '2024-01-15 00:00:00' AND start_datetime < TIMESTAMP '2024-01-16 00:00:00'""")
def _pending(t):
    return P.pending_between(t.bookings, datetime(2024, 1, 15), datetime(2024, 1, 16)).select("reservation_id")


@query("j18_new_people", _NV, """
  SELECT reservation_id, class_session_id, class_record_id, email, phone_number, date_joined, marketing_opt_in, reason FROM marked""",
       _NEW)
def _new_people(t):
    return L.new_people(t.bookings, t.users, _classes(t))


@query("p12_new_people_outcomes", _NV, "SELECT coalesce(reason, 'processed') AS outcome, count(*) AS n FROM marked GROUP BY 1", _NEW)
def _new_outcomes(t):
    return L.new_people_outcomes(L.new_people(t.bookings, t.users, _classes(t)))


def _last(c: str) -> str:
    return f"arg_max({c}, reservation_id) FILTER (WHERE {c} IS NOT NULL)"


@query("c09_new_people_today", _NV, f"""
  SELECT g.email, g.phone_number, cast(g.first_class_date AS varchar) AS first_class_date, g.profile_created, g.marketing_opt_in,
    g.first_class_record, k.customer_id, CASE WHEN k.customer_id IS NULL THEN 'create' ELSE 'update' END AS action
  FROM (SELECT email, {_last('phone_number')} AS phone_number, {_last('starts_at')} AS first_class_date,
      {_last('date_joined')} AS profile_created, {_last('marketing_opt_in')} AS marketing_opt_in,
      {_last('class_record_id')} AS first_class_record FROM good GROUP BY email) AS g
  LEFT JOIN (SELECT email, min(customer_id) AS customer_id FROM op_customers GROUP BY email) AS k USING (email)""", _NEW)
def _today(t):
    return L.new_people_today(t.bookings, t.users, t.sessions, _classes(t), t.op_customers, BOOKING_DAY)[0]


@query("c09_new_people_skipped", _NV, "SELECT reservation_id, reason FROM today WHERE reason IS NOT NULL", _NEW)
def _skipped(t):
    return L.new_people_today(t.bookings, t.users, t.sessions, _classes(t), t.op_customers, BOOKING_DAY)[1]


# --- first booking ----------------------------------------------------------------------------------------------------


@query("c10_new_customer_first_booking", ("bookings", "details"), f"""
  SELECT '{BOOKING_DAY}' AS target_date, d.customer_id, nullif(d.email, '') AS email, lower(trim(nullif(d.email, ''))) AS email_lower,
    coalesce(first_name, '') AS first_name, coalesce(last_name, '') AS last_name,
    coalesce(nullif(full_name, ''), nullif(trim(coalesce(first_name, '') || ' ' || coalesce(last_name, '')), ''), nullif(d.email, ''), '') AS full_name,
    join_date, substr(join_date, 1, 10) AS join_date_date_only, nullif(home_location, '') AS home_location, phone_number,
    b.status AS reservation_status, b.class_session_id
  FROM details AS d LEFT JOIN (
    SELECT *, cast(user_id AS varchar) AS uid FROM bookings WHERE coalesce(status, '') <> '' AND lower(status) NOT LIKE '%cancel%'
      AND user_id IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY try_cast(coalesce(nullif(class_session_start_datetime, ''),
      nullif(class_session_start, ''), nullif(created_at, ''), nullif(updated_at, '')) AS timestamptz) NULLS LAST, reservation_id) = 1
  ) AS b ON b.uid = d.customer_id
  WHERE substr(join_date, 1, 10) = '{BOOKING_DAY}'""")
def _first_booking(t):
    return L.new_customer_first_booking(t.details, booking_dates(t), BOOKING_DAY)


# --- reminders --------------------------------------------------------------------------------------------------------

LAST = datetime(2024, 1, 15, 6)
_START, _END = L.due_span(LAST, BOOKING_NOW)
_STUDIO = {"studio": "SELECT trim(cast(location_id AS varchar)) AS loc, arg_max(name, pos) AS name, arg_max(email, pos) AS email "
                     "FROM studios WHERE location_id IS NOT NULL GROUP BY 1"}
_REMIND_SELECT = f"""
  SELECT b.reservation_id, b.class_session_id, coalesce(nullif(b.guest_email, ''), nullif(u.email, '')) AS email,
    coalesce(u.first_name, '') AS first_name,
    CASE WHEN trim(coalesce(s.public_note, '')) = '' THEN coalesce(s.class_type_display, '') ELSE trim(s.public_note) END AS class_label,
    coalesce(array_to_string(s.instructor_names, ', '), '') AS instructor_names, coalesce(st.name, '') AS studio_name,
    coalesce(st.email, '') AS studio_email, CASE WHEN st.email LIKE '%@%' THEN st.email END AS reply_to,
    strftime(cast(coalesce(nullif(s.start_date, ''), nullif(b.start_date, '')) AS date), '%d-%m-%Y') AS class_date,
    substr(coalesce(nullif(s.start_time, ''), nullif(b.start_time, '')), 1, 5) AS class_time
  FROM bookings AS b LEFT JOIN sessions AS s ON s.session_id = b.class_session_id LEFT JOIN users AS u ON u.user_id = b.user_id
    LEFT JOIN studio AS st ON st.loc = cast(s.location_id AS varchar)
  WHERE b.class_session_id IS NOT NULL AND coalesce(nullif(b.guest_email, ''), nullif(u.email, '')) IS NOT NULL"""
_RV = ("bookings", "sessions", "users", "studios")


@query("j10_f32_reminder_rows", _RV, _REMIND_SELECT, _STUDIO)
def _reminder_rows(t):
    return L.reminder_rows(t.bookings, t.sessions, t.users, L.studio_lookup(t.studios))


@query("c11_t06_reminders_due", _RV, f"""{_REMIND_SELECT} AND b.status = 'pending' AND b.reservation_type = 'standard'
    AND b.start_datetime >= TIMESTAMP '{_START}' AND b.start_datetime < TIMESTAMP '{_END}'""", _STUDIO)
def _due(t):
    return L.reminders_due(t.bookings, t.sessions, t.users, t.studios, BOOKING_NOW, LAST)[0]


@query("t06_hourly_load", ("bookings",), """
  SELECT cast(date_trunc('hour', start_datetime) AS varchar) AS hour, count(*) AS n FROM bookings
  WHERE status = 'pending' AND reservation_type = 'standard' GROUP BY 1""")
def _hourly(t):
    return L.hourly_load(t.bookings)


@query("f32_local_display", ("sessions",), f"""
  SELECT session_id, coalesce(CASE WHEN start_date <> '' THEN strftime(cast(start_date AS date), '%d-%m-%Y') END,
      strftime({d_local('start_datetime')}, '%d-%m-%Y')) AS class_date,
    coalesce(nullif(substr(start_time, 1, 5), ''), strftime({d_local('start_datetime')}, '%H:%M')) AS class_time FROM sessions""")
def _display(t):
    rows = t.sessions.withColumns({"guest_email": F.lit(None).cast("string"), "user_email": F.lit("a@example.com")})
    return L.display_fields(rows).select("session_id", "class_date", "class_time")


# --- credits and birthdays --------------------------------------------------------------------------------------------

_FR = ", ".join(f"'{m}'" for m in FRENCH_MONTHS)
_CREDIT_WHERE = f"""cast({d_local('expiration_datetime')} AS date) = DATE '{CREDIT_DAY}' + 30
    AND coalesce(remaining_credits_cache, 0) > 0 AND NOT coalesce(is_expired, false)"""


@query("p07_expiring_credits", ("credits",), f"SELECT transaction_id FROM credits WHERE {_CREDIT_WHERE}")
def _expiring(t):
    return P.expiring_credits(t.credits, CREDIT_DAY).select("transaction_id")


@query("c12_expiring_credit_list", ("credits", "users"), f"""
  SELECT c.transaction_id, c.user_id, nullif(u.email, '') AS email, coalesce(nullif(u.first_name, ''), 'there') AS first_name,
    c.remaining_credits_cache AS credits_remaining, coalesce(nullif(c.credit_name, ''), 'Class Package') AS credit_name,
    strftime(c.expiration_datetime, '%B %-d, %Y') AS expires_en,
    cast(day(c.expiration_datetime) AS varchar) || ' ' || [{_FR}][month(c.expiration_datetime)] || ' ' || cast(year(c.expiration_datetime) AS varchar) AS expires_fr,
    CASE WHEN c.user_id IS NULL THEN 'no-user' WHEN coalesce(u.email, '') = '' THEN 'no-email' ELSE 'ready' END AS outcome
  FROM credits AS c LEFT JOIN users AS u USING (user_id) WHERE {_CREDIT_WHERE}""")
def _credit_list(t):
    return L.expiring_credit_list(t.credits, t.users, CREDIT_DAY)


_BIRTH = {
    "window_days": f"SELECT {DAY} + cast(i AS integer) AS w FROM (SELECT unnest(range(7)) AS i) AS r",
    "due": """SELECT u.user_id, u.email, u.first_name, u.last_name, u.birth_date, d.w AS upcoming_birthday FROM users AS u JOIN window_days AS d
        ON strftime(u.birth_date, '%m-%d') = strftime(d.w, '%m-%d') WHERE year(u.birth_date) BETWEEN 1920 AND 2020
        AND coalesce(u.archived_at, '') = '' AND coalesce(u.email, '') <> ''""",
    "unlimited": """SELECT DISTINCT user_id FROM memberships WHERE status IN ('active', 'frozen')
        AND regexp_matches(lower(membership_name), 'unlimited|illimit')""",
}


@query("p08_birthdays", ("users",), """
  SELECT user_id, cast(upcoming_birthday AS varchar) AS upcoming_birthday FROM due""",
       {n: _BIRTH[n] for n in ("window_days", "due")})
def _birthdays(t):
    return P.birthdays(t.users, BOOKING_DAY).select("user_id", "upcoming_birthday")


@query("j14_membership_segment", ("users", "memberships"), """
  SELECT user_id, CASE WHEN user_id IN (SELECT user_id FROM unlimited) THEN 'unlimited' ELSE 'standard' END AS segment FROM users""",
       {"unlimited": _BIRTH["unlimited"]})
def _segment(t):
    return L.membership_segment(t.users.select("user_id"), t.memberships)


@query("c13_birthday_list", ("users", "memberships"), """
  SELECT user_id, email, first_name, last_name, cast(birth_date AS varchar) AS birth_date,
    cast(upcoming_birthday AS varchar) AS upcoming_birthday,
    CASE WHEN user_id IN (SELECT user_id FROM unlimited) THEN 'unlimited' ELSE 'standard' END AS segment FROM due""", _BIRTH)
def _birthday_list(t):
    return L.birthday_list(t.users, t.memberships, BOOKING_DAY)
