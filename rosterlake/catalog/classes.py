"""Payroll classes, attendance, rosters, class-id resolution, equipment."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from rosterlake.catalog.base import BOOKING_NOW, d_local, query
from rosterlake.catalog.scalars import REQUEST_AT
from rosterlake.operators import filters as P
from rosterlake.operators import matching as N
from rosterlake.plans import classes as C

FROM, TO = date(2024, 1, 8), date(2024, 1, 21)


_DIMS = {
    "inst": "SELECT lower(trim(name)) AS k, arg_max(instructor_id, pos) AS instructor_id FROM instructors WHERE trim(name) <> '' GROUP BY 1",
    "stud": "SELECT cast(location_id AS varchar) AS k, arg_max(studio_id, pos) AS studio_id FROM studios WHERE location_id IS NOT NULL GROUP BY 1",
    "typ": "SELECT lower(trim(name)) AS k, arg_max(class_type_id, pos) AS class_type_id FROM class_types WHERE trim(name) <> '' GROUP BY 1",
    "rows": f"""SELECT session_id, CASE WHEN instructor_names[1] <> '' THEN instructor_names[1] WHEN len(instructor_names) > 0
          THEN array_to_string(instructor_names, ', ') ELSE '' END AS instructor,
        coalesce(class_type_display, '') AS class_type, strftime({d_local('start_datetime')}, '%Y-%m-%dT%H:%M:%S') AS class_date,
        location_id, coalesce(checked_in_user_count, 0) AS attendance FROM sessions
      WHERE cast({d_local('start_datetime')} AS date) BETWEEN DATE '{FROM}' AND DATE '{TO}'""",
    "counted": "SELECT class_session_id, count(*) AS n FROM bookings WHERE status = 'check in' GROUP BY 1",
    "assigned": """SELECT r.*, i.instructor_id, s.studio_id, t.class_type_id FROM rows AS r
        LEFT JOIN inst AS i ON i.k = lower(trim(r.instructor)) LEFT JOIN stud AS s ON s.k = cast(r.location_id AS varchar)
        LEFT JOIN typ AS t ON t.k = lower(trim(r.class_type))""",
}
_CV = ("sessions", "instructors", "studios", "class_types", "bookings")
_OUT = "session_id, instructor, class_type, class_date, cast(location_id AS bigint) AS location_id, instructor_id, studio_id, class_type_id"


@query("c16_j09_payroll_classes", _CV, f"SELECT {_OUT}, attendance FROM assigned", _DIMS)
def _payroll(t):
    out = C.payroll_classes(t.sessions, None, t.instructors, t.studios, t.class_types, FROM, TO)
    return out.select("session_id", "instructor", "class_type", "class_date", "location_id", "instructor_id", "studio_id",
                      "class_type_id", "attendance")


@query("c16_classes_counted_attendance", _CV, f"""
  SELECT {_OUT}, coalesce(c.n, 0) AS attendance FROM assigned LEFT JOIN counted AS c ON c.class_session_id = session_id""", _DIMS)
def _counted(t):
    out = C.payroll_classes(t.sessions, t.bookings, t.instructors, t.studios, t.class_types, FROM, TO)
    return out.select("session_id", "instructor", "class_type", "class_date", "location_id", "instructor_id", "studio_id",
                      "class_type_id", "attendance")


@query("j09_lookup_misses", _CV, """
  SELECT count(*) AS classes, count(*) FILTER (WHERE instructor_id IS NULL) AS instructors_missing,
    count(*) FILTER (WHERE studio_id IS NULL) AS studios_missing, count(*) FILTER (WHERE class_type_id IS NULL) AS types_missing,
    '# of Class found: ' || count(*) || ' | # of Instructors not found: ' || count(*) FILTER (WHERE instructor_id IS NULL) ||
    ' | # of Studios not found: ' || count(*) FILTER (WHERE studio_id IS NULL) || ' | # of Class types not found: ' ||
    count(*) FILTER (WHERE class_type_id IS NULL) AS note FROM assigned""", _DIMS)
def _note(t):
    return C.payroll_note(C.payroll_classes(t.sessions, None, t.instructors, t.studios, t.class_types, FROM, TO))


@query("a13_c17_class_checkins", ("sessions", "bookings"), """
  SELECT s.session_id AS class_session_id, coalesce(c.n, 0) AS check_ins FROM sessions AS s LEFT JOIN
    (SELECT class_session_id, count(*) AS n FROM bookings WHERE status = 'check in' GROUP BY 1) AS c ON c.class_session_id = s.session_id""")
def _checkins(t):
    return C.class_checkins(t.sessions.select(F.col("session_id").alias("class_session_id")), t.bookings)


# --- roster -----------------------------------------------------------------------------------------------------------

_ROSTER = {
    "listed": "SELECT 'class' || cast(session_id AS varchar) AS class_record_id, session_id FROM sessions WHERE public_note IS NOT NULL",
    "fresh": """SELECT l.class_record_id, b.class_session_id, b.reservation_id, coalesce(b.status, '') AS status,
        coalesce(s.name, '') AS spot_name, coalesce(list_contains(b.tags, '463'), false) AS is_new, nullif(u.email, '') AS email,
        lower(nullif(u.email, '')) AS email_lower, coalesce(u.full_name, '') AS name
      FROM bookings AS b JOIN listed AS l ON l.session_id = b.class_session_id LEFT JOIN users AS u USING (user_id)
        LEFT JOIN spots AS s ON s.spot_id = b.spot_id""",
    "ids": """SELECT coalesce(c.customer_id, 'new:' || p.email_lower) AS customer_id, coalesce(p.email_lower, c.email_lower) AS email_lower,
        c.measurement_note_id FROM (SELECT * FROM op_customers WHERE dupe = 'No') AS c FULL JOIN
        (SELECT DISTINCT email_lower FROM fresh WHERE email_lower IS NOT NULL) AS p ON p.email_lower = c.email_lower""",
}
_RV = ("bookings", "sessions", "users", "spots", "op_customers")


def _listed(t):
    return t.sessions.where(F.col("public_note").isNotNull()).select(
        F.concat(F.lit("class"), F.col("session_id").cast("string")).alias("class_record_id"),
        F.col("session_id").cast("string").alias("class_session_id"))


def _refresh(t):
    existing = t.bookings.where(F.col("class_session_id").isNotNull()).select(
        F.concat(F.lit("class"), F.col("class_session_id").cast("string")).alias("class_record_id"),
        "reservation_id", F.lit("stored").alias("status"), F.lit("").alias("spot_name"), F.lit(False).alias("is_new"),
        F.lit(None).cast("string").alias("customer_id"))
    return C.refresh_class_roster(_listed(t), t.bookings, t.users, t.spots, t.op_customers, existing)


@query("c18_refresh_class_roster", _RV, """
  SELECT f.class_record_id, f.reservation_id, f.status, f.spot_name, f.is_new, i.customer_id FROM fresh AS f
    LEFT JOIN ids AS i USING (email_lower)
  UNION ALL SELECT 'class' || cast(class_session_id AS varchar), reservation_id, 'stored', '', false, NULL FROM bookings
    WHERE class_session_id IS NOT NULL AND class_session_id NOT IN (SELECT session_id FROM listed)""", _ROSTER)
def _roster(t):
    return _refresh(t)[0].select("class_record_id", "reservation_id", "status", "spot_name", "is_new", "customer_id")


@query("c18_refresh_payload", _RV, """
  SELECT f.class_record_id, cast(f.class_session_id AS varchar) AS class_session_id, f.reservation_id, f.status AS reservation_status,
    i.customer_id, i.measurement_note_id FROM fresh AS f JOIN ids AS i USING (email_lower)""", _ROSTER)
def _payload(t):
    return _refresh(t)[2]


# --- class ids --------------------------------------------------------------------------------------------------------

_MATCH = {
    "req": f"""SELECT r.*, request_id % 8 AS style, t.instant FROM requests AS r JOIN (SELECT event_id, {REQUEST_AT} AS instant FROM ticks) AS t ON t.event_id = r.request_id""",
    "state": """SELECT *, CASE WHEN coalesce(room, '') = '' OR coalesce(date_text, '') = '' THEN 'missing'
        WHEN coalesce(trim(class_id), '') <> '' THEN 'done' ELSE 'open' END AS state,
        CASE WHEN style < 6 THEN instant END AS target FROM req""",
    "room": "SELECT lower(trim(name)) AS k, min(location_id) AS location_id FROM locations GROUP BY 1",
    "hit": """SELECT q.request_id, s.session_id, abs(epoch(s.start_datetime) - epoch(q.target)) AS delta FROM state AS q
        JOIN room AS l ON l.k = lower(trim(q.room)) JOIN sessions AS s ON s.location_id = l.location_id
          AND s.start_datetime BETWEEN q.target - INTERVAL 2 MINUTE AND q.target + INTERVAL 2 MINUTE
          AND (q.class_name IS NULL OR lower(trim(s.class_type_display)) = lower(trim(q.class_name)))
        WHERE q.state = 'open'
        QUALIFY row_number() OVER (PARTITION BY q.request_id ORDER BY abs(epoch(s.start_datetime) - epoch(q.target)), s.session_id) = 1""",
}
_MV = ("requests", "ticks", "sessions", "locations")


@query("p14_needs_class_id", ("requests",), """
  SELECT request_id FROM requests WHERE coalesce(room, '') <> '' AND coalesce(date_text, '') <> ''
    AND coalesce(trim(class_id), '') = ''""")
def _open(t):
    return P.needs_class_id(t.requests).select("request_id")


def _sessions(t):
    return t.sessions.select("session_id", "location_id", F.col("start_datetime").alias("start_ts"),
                             F.col("class_type_display").alias("class_name"))


@query("c19_resolve_class_ids", _MV, """
  SELECT q.request_id, h.session_id AS class_session_id, cast(h.delta AS bigint) AS delta_seconds,
    CASE WHEN state <> 'open' THEN 'skipped' WHEN target IS NULL THEN 'error' WHEN h.session_id IS NULL THEN 'not_found'
      ELSE 'updated' END AS outcome FROM state AS q LEFT JOIN hit AS h USING (request_id)""", _MATCH)
def _resolve(t):
    return C.resolve_class_ids(t.requests, t.locations, _sessions(t), 2)


_NEAR = """SELECT b.event_id AS request_id, s.session_id, cast(abs(epoch(s.start_datetime) - b.sec) AS bigint) AS delta_seconds
  FROM ticks AS b JOIN sessions AS s ON s.location_id = b.room AND abs(epoch(s.start_datetime) - b.sec) <= 1200
  QUALIFY row_number() OVER (PARTITION BY b.event_id ORDER BY abs(epoch(s.start_datetime) - b.sec), s.session_id) = 1"""


@query("j08_match_sessions", ("ticks", "sessions"), """
  SELECT b.event_id AS request_id, n.session_id, n.delta_seconds FROM ticks AS b LEFT JOIN near AS n ON n.request_id = b.event_id""",
       {"near": _NEAR})
def _near(t):
    asked = t.ticks.select(F.col("event_id").alias("request_id"), F.col("room").alias("location_id"),
                           F.timestamp_seconds("sec").alias("target_ts"), F.lit(None).cast("string").alias("class_name"))
    return N.match_sessions(asked, _sessions(t), 20).select("request_id", "session_id", "delta_seconds")


# --- equipment --------------------------------------------------------------------------------------------------------


@query("c20_measurement_notes", ("measurements", "users"), f"""
  SELECT m.row_id, coalesce(CASE WHEN m.note_id IS NOT NULL THEN m.user_id END, f.user_id) AS user_id, m.note_id,
    'Bike Measurements:' || chr(10) || 'Seat Height: ' || coalesce(seat_height, '') || chr(10) || 'Seat Position: ' || seat_position ||
    chr(10) || 'Handlebar Height: ' || handlebar_height || chr(10) || 'Handlebar Position: ' || handlebar_position || chr(10) ||
    'Shoe Size: ' || shoe_size AS text,
    CASE WHEN m.note_id IS NOT NULL AND m.user_id IS NOT NULL THEN 'update_note' WHEN m.note_id IS NOT NULL THEN 'no-user-id'
      WHEN coalesce(m.email, '') = '' THEN 'no-email' WHEN f.user_id IS NULL THEN 'no-user' ELSE 'create_note' END AS action
  FROM measurements AS m LEFT JOIN (SELECT lower(trim(email)) AS e, min(user_id) AS user_id FROM users WHERE email <> '' GROUP BY 1) AS f
    ON f.e = lower(trim(m.email)) WHERE m.last_modified > TIMESTAMP '{BOOKING_NOW}' - INTERVAL 1 DAY""")
def _notes(t):
    return C.measurement_notes(t.measurements, t.users, BOOKING_NOW)


@query("c20_j19_measurement_sheet", ("bookings", "spots", "measurements"), """
  SELECT cast(s.row_number AS bigint) AS row_number, trim(s.spot) AS spot, b.reservation_id, coalesce(m.seat_height, '') AS seat_height,
    coalesce(m.seat_position, '') AS seat_position, coalesce(m.handlebar_height, '') AS handlebar_height,
    coalesce(m.handlebar_position, '') AS handlebar_position, coalesce(m.shoe_size, '') AS shoe_size
  FROM bookings AS b JOIN spots AS s ON trim(s.spot) = trim(b.spot) LEFT JOIN measurements AS m ON m.row_id = b.user_id
  WHERE NOT coalesce(lower(b.status) LIKE '%cancel%', false)""")
def _sheet(t):
    sized = t.bookings.join(
        t.measurements.select(F.col("row_id").alias("user_id"), *[c for _, c in C.MEASURES]), "user_id", "left")
    return C.class_measurement_sheet(sized, t.spots)
