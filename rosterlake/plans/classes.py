"""Classes: payroll lists, attendance, roster refresh, class-id resolution, equipment sheets."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rosterlake.functions import dates as D
from rosterlake.functions import text as X
from rosterlake.operators import filters as P
from rosterlake.operators import keyed as K
from rosterlake.operators import matching as N

# The labels of the measurement note, in order.
MEASURES = (
    ("Seat Height", "seat_height"), ("Seat Position", "seat_position"), ("Handlebar Height", "handlebar_height"),
    ("Handlebar Position", "handlebar_position"), ("Shoe Size", "shoe_size"),
)


# The texts of the payroll note, in order.
PAYROLL_NOTE = (
    ("# of Class found: ", "classes"), ("# of Instructors not found: ", "instructors_missing"),
    ("# of Studios not found: ", "studios_missing"), ("# of Class types not found: ", "types_missing"),
)


# --- payroll ----------------------------------------------------------------------------------------------------------


def class_rows(sessions: DataFrame, start: date, end: date, tz: str = D.LOCAL_TZ) -> DataFrame:
    """Sessions that start on the local days of the range, with their lead instructor and local start text."""
    local_day = D.utc_to_local_date(F.col("start_datetime"), tz)
    return sessions.where(local_day.between(F.lit(start), F.lit(end))).select(
        "session_id", X.lead_instructor(F.col("instructor_names")).alias("instructor"),
        F.coalesce("class_type_display", F.lit("")).alias("class_type"),
        D.utc_to_local_text(F.col("start_datetime"), tz).alias("class_date"), "location_id",
        F.coalesce("checked_in_user_count", F.lit(0)).cast("bigint").alias("attendance"),
    )


def payroll_classes(sessions: DataFrame, bookings: DataFrame | None, instructors: DataFrame, studios: DataFrame,
                    types: DataFrame, start: date, end: date, tz: str = D.LOCAL_TZ) -> DataFrame:
    """Classes of a period with attendance and dimension ids.

    Attendance is the session's own counter, or counted from check-ins when bookings are given.
    """
    classes = class_rows(sessions, start, end, tz)
    if bookings is not None:
        counted = N.attach_checkins(classes.withColumnRenamed("session_id", "class_session_id"), bookings)
        classes = counted.drop("attendance").withColumnsRenamed(
            {"class_session_id": "session_id", "check_ins": "attendance"})
    return N.assign_dims(classes, instructors, studios, types)


def payroll_note(assigned: DataFrame) -> DataFrame:
    """One row of counts with its note text."""
    m = N.lookup_misses(assigned)
    return m.withColumn("note", F.concat_ws(" | ", *[
        F.concat(F.lit(label), F.col(c).cast("string")) for label, c in PAYROLL_NOTE]))


def class_checkins(classes: DataFrame, bookings: DataFrame) -> DataFrame:
    """Classes that have a session id, with their check-in count."""
    return N.attach_checkins(classes.where(F.col("class_session_id").isNotNull()), bookings)


# --- roster refresh ---------------------------------------------------------------------------------------------------


def fresh_roster(bookings: DataFrame, users: DataFrame, spots: DataFrame, classes: DataFrame) -> DataFrame:
    """Current bookings of the given classes, one row per booking id, with person and spot.

    ``classes``: class_record_id, class_session_id. All classes of a refresh go through one plan.
    """
    listed = classes.select("class_record_id", X.strip_zero_width(F.col("class_session_id")).alias("class_session_id"))
    rank = F.row_number().over(
        Window.partitionBy("class_record_id", "reservation_id").orderBy(F.coalesce("status", F.lit("")), "user_id"))
    ours = bookings.where(F.col("reservation_id").isNotNull()).withColumn(
        "class_session_id", F.col("class_session_id").cast("string")
    ).join(listed, "class_session_id")
    once = ours.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")
    u = users.select("user_id", F.nullif("email", F.lit("")).alias("email"), F.nullif("full_name", F.lit("")).alias("full_name"))
    s = spots.select("spot_id", F.col("name").alias("spot_name"))
    return once.join(u, "user_id", "left").join(s, "spot_id", "left").select(
        "class_record_id", "class_session_id", "reservation_id", F.coalesce("status", F.lit("")).alias("status"),
        F.coalesce("spot_name", F.lit("")).alias("spot_name"), P.has_tag(F.col("tags")).alias("is_new"),
        F.lower("email").alias("email_lower"), F.col("email"), F.coalesce("full_name", F.lit("")).alias("name"),
    )


def refresh_class_roster(classes: DataFrame, bookings: DataFrame, users: DataFrame, spots: DataFrame,
                         customers: DataFrame, existing: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Roster table, customer table and payload rows after the refresh of the given classes."""
    fresh = fresh_roster(bookings, users, spots, classes)
    upserted = K.upsert_customers(customers, fresh.select("email", "name", "reservation_id"))
    ids = upserted.where(F.col("dupe") == "No").select("email_lower", "customer_id", "measurement_note_id")
    linked = fresh.join(ids, "email_lower", "left")
    children = linked.select("class_record_id", "reservation_id", "status", "spot_name", "is_new", "customer_id")
    payload = linked.where(F.col("customer_id").isNotNull()).select(
        "class_record_id", "class_session_id", "reservation_id", F.col("status").alias("reservation_status"),
        "customer_id", "measurement_note_id",
    )
    return K.replace_children(existing, children, classes, "class_record_id"), upserted, payload


# --- class ids --------------------------------------------------------------------------------------------------------


def resolve_class_ids(requests: DataFrame, locations: DataFrame, sessions: DataFrame, minutes: int = 2,
                      default_offset: str = "-05:00") -> DataFrame:
    """Every request with a class id where one is found, and its outcome.

    Skipped: no room or date, or an id already. Error: unreadable date. Not found: unknown room, or no session of the
    class within the window. The room with the smallest id wins when several share a name.
    """
    state = P.class_request_state(F.col("room"), F.col("date_text"), F.col("class_id"))
    at = F.when(state == "open", D.local_text_to_utc(F.col("date_text"), default_offset))
    rooms = locations.groupBy(X.norm_name(F.col("name")).alias("room_key")).agg(F.min("location_id").alias("location_id"))
    marked = requests.withColumns({"state": state, "target_ts": at, "room_key": X.norm_name(F.col("room"))})
    placed = marked.join(rooms.where(F.col("room_key").isNotNull()), "room_key", "left")
    return N.match_sessions(placed, sessions, minutes).select(
        "request_id", F.col("session_id").alias("class_session_id"), "delta_seconds",
        F.when(F.col("state") != "open", "skipped").when(F.col("target_ts").isNull(), "error")
        .when(F.col("session_id").isNull(), "not_found").otherwise("updated").alias("outcome"),
    )


# --- equipment --------------------------------------------------------------------------------------------------------


def measurement_notes(rows: DataFrame, users: DataFrame, now: datetime, days: int = 1) -> DataFrame:
    """Note text of every recently changed measurement row, and what to do with it."""
    from rosterlake.plans.lifecycle import first_user_by_email

    changed = P.changed_since(rows, now, days=days)
    text = X.note_text("Bike Measurements:", [(label, F.col(c)) for label, c in MEASURES])
    known = first_user_by_email(users).withColumnRenamed("user_id", "found_user_id")
    has_note = F.coalesce(F.col("note_id").cast("string"), F.lit("")) != ""
    has_user = F.col("user_id").isNotNull()
    joined = changed.withColumn("email_key", F.lower(F.trim("email"))).join(known, "email_key", "left")
    return joined.select(
        "row_id", F.coalesce(F.when(has_note, F.col("user_id")), F.col("found_user_id")).alias("user_id"), "note_id",
        text.alias("text"),
        F.when(has_note & has_user, "update_note").when(has_note, "no-user-id")
        .when(F.coalesce(F.col("email"), F.lit("")) == "", "no-email")
        .when(F.col("found_user_id").isNull(), "no-user").otherwise("create_note").alias("action"),
    )


def class_measurement_sheet(bookings: DataFrame, spots: DataFrame) -> DataFrame:
    """Sheet rows of a class: one per live booking on a listed spot; missing values are empty."""
    return N.roster(bookings, spots).select(
        "row_number", "spot", "reservation_id", *[X.null_to_empty(F.col(c)).alias(c) for _, c in MEASURES]
    )
