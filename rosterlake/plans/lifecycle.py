"""Lifecycle lists: second visits, new people, first bookings, reminders, expiring credits, birthdays."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rosterlake.functions import dates as D
from rosterlake.functions import text as X
from rosterlake.operators import filters as P
from rosterlake.operators import keyed as K
from rosterlake.operators import matching as N

#: Reminders look this far ahead.
REMINDER_HOURS = 27


def first_user_by_email(users: DataFrame) -> DataFrame:
    """One user per e-mail, the smallest id."""
    return users.where(F.coalesce(F.col("email"), F.lit("")) != "").groupBy(F.lower(F.trim("email")).alias("email_key")).agg(
        F.min("user_id").alias("user_id")
    )


# --- second visit ---------------------------------------------------------------------------------------------------


def _due_bookings(customers: DataFrame, users: DataFrame, bookings: DataFrame) -> DataFrame:
    """Bookings of customers who wait for their second visit, with the text that orders them."""
    due = P.awaiting_second(customers).where(F.coalesce(F.col("email"), F.lit("")) != "")
    known = due.withColumn("email_key", F.lower(F.trim("email"))).join(first_user_by_email(users), "email_key")
    order = N.visit_sort_key(F.col("class_session_min_datetime"), F.col("start_date"), F.col("start_time"))
    return bookings.withColumn("sort_text", order).join(
        known.select("customer_id", "email", "user_id"), "user_id"
    )


def second_visit(customers: DataFrame, users: DataFrame, bookings: DataFrame) -> DataFrame:
    """The second booking, cancelled ones included, of every customer who has taken the first class only.

    Customers with fewer than two bookings, or whose second one has no class session, are left out.
    """
    due = _due_bookings(customers, users, bookings)
    second = N.nth_by_time(due, "customer_id", [F.col("sort_text"), F.col("reservation_id")], 2)
    return second.where(F.col("class_session_id").isNotNull()).select(
        "customer_id", "email", "user_id", F.col("reservation_id").alias("second_reservation_id"),
        F.col("class_session_id").alias("second_class_session_id"),
        F.coalesce("status", F.lit("")).alias("second_status"),
    )


def visit_history(customers: DataFrame, users: DataFrame, bookings: DataFrame) -> DataFrame:
    """All bookings of the same customers, one row each, with their place in time."""
    due = _due_bookings(customers, users, bookings)
    return N.ordinal_in_history(due, "customer_id", "sort_text", "reservation_id").select(
        "customer_id", "ordinal", "reservation_id", "class_session_id", F.coalesce("status", F.lit("")).alias("status")
    )


# --- new people -----------------------------------------------------------------------------------------------------


def new_people(bookings: DataFrame, users: DataFrame, classes: DataFrame) -> DataFrame:
    """Tagged bookings with the person behind them, and the reason for every one that cannot be used.

    A guest is found by the guest e-mail, a member by user id. Both lookups are against unique keys.
    """
    tagged = bookings.withColumn("is_new", P.has_tag(F.col("tags")))
    contact = ["phone_number", "date_joined", "marketing_opt_in"]
    people = users.select("user_id", "email", *contact)
    by_id = people.select(F.col("user_id"), F.col("email").alias("user_email"), *[F.col(c).alias(f"m_{c}") for c in contact])
    ids = first_user_by_email(users).withColumnRenamed("user_id", "guest_user_id")
    guests = ids.join(people.withColumnRenamed("user_id", "guest_user_id").drop("email"), "guest_user_id").select(
        F.col("email_key").alias("guest_key"), "guest_user_id", *[F.col(c).alias(f"g_{c}") for c in contact]
    )
    known = classes.groupBy("class_session_id").agg(F.min("class_record_id").alias("class_record_id"))
    is_guest = F.coalesce(F.col("guest_email"), F.lit("")) != ""
    joined = (
        tagged.withColumn("guest_key", F.when(is_guest, F.lower(F.trim("guest_email"))))
        .join(guests, "guest_key", "left")
        .join(by_id.withColumn("_member", F.lit(True)), "user_id", "left")
        .join(known, "class_session_id", "left")
    )
    rules = [
        ("no-new-people-tag", ~F.col("is_new")),
        ("no-class-session-id", F.col("class_session_id").isNull()),
        ("no-user-guest-email", is_guest & F.col("guest_user_id").isNull()),
        ("no-user-id", ~is_guest & F.col("user_id").isNull()),
        ("user-not-found", ~is_guest & F.col("_member").isNull()),
        ("user-has-no-email", ~is_guest & (F.coalesce(F.col("user_email"), F.lit("")) == "")),
        ("no-class-record", F.col("class_record_id").isNull()),
    ]
    return joined.select(
        "reservation_id", "class_session_id", "class_record_id",
        F.when(is_guest, F.col("guest_email")).otherwise(F.col("user_email")).alias("email"),
        *[F.when(is_guest, F.col(f"g_{c}")).otherwise(F.col(f"m_{c}")).alias(c) for c in contact],
        P.reason_column(rules).alias("reason"),
    )


def new_people_today(bookings: DataFrame, users: DataFrame, sessions: DataFrame, classes: DataFrame,
                     customers: DataFrame, day: date) -> tuple[DataFrame, DataFrame]:
    """Customers to patch or create for the day's new people, and the skipped bookings with their reasons.

    The day's bookings are pending ones that start on the day or the next where the studios are. Non-null values are put over the customer's fields;
    of several bookings of one person the last one wins.
    """
    at = D.utc_to_local_date(F.col("start_datetime"))
    today = bookings.where((F.col("status") == "pending") & at.between(F.lit(day), F.date_add(F.lit(day), 1)))
    marked = new_people(today, users, classes)
    starts = sessions.select(F.col("session_id").alias("class_session_id"), F.col("start_datetime").alias("starts_at"))
    good = marked.where(F.col("reason").isNull()).join(starts, "class_session_id", "left")
    fields = {"phone_number": "phone_number", "first_class_date": "starts_at", "profile_created": "date_joined",
              "marketing_opt_in": "marketing_opt_in", "first_class_record": "class_record_id"}
    changes = good.groupBy("email").agg(*[
        F.max_by(F.col(source), F.when(F.col(source).isNotNull(), F.col("reservation_id"))).alias(name)
        for name, source in fields.items()
    ])
    known = customers.where(F.coalesce(F.col("email"), F.lit("")) != "").groupBy("email").agg(
        F.min("customer_id").alias("customer_id"))
    updates = changes.join(known, "email", "left").withColumn(
        "action", F.when(F.col("customer_id").isNull(), "create").otherwise("update")
    )
    return updates, marked.where(F.col("reason").isNotNull()).select("reservation_id", "reason")


def new_people_outcomes(marked: DataFrame) -> DataFrame:
    return K.outcomes(marked.select(F.coalesce("reason", F.lit("processed")).alias("outcome")))


# --- first booking of new customers -----------------------------------------------------------------------------------


def new_customer_first_booking(details: DataFrame, bookings: DataFrame, day: date) -> DataFrame:
    """Customers who joined on ``day``, all of them, with their oldest live booking if there is one."""
    joined = details.where(D.date_only(F.col("join_date")) == F.lit(day))
    email = F.nullif("email", F.lit(""))
    first, last = X.null_to_empty(F.col("first_name")), X.null_to_empty(F.col("last_name"))
    both = F.nullif(F.trim(F.concat_ws(" ", first, last)), F.lit(""))
    return N.oldest_booking(joined, bookings).select(
        F.lit(day).cast("string").alias("target_date"), "customer_id", email.alias("email"),
        F.lower(F.trim(email)).alias("email_lower"), first.alias("first_name"), last.alias("last_name"),
        F.coalesce(F.nullif("full_name", F.lit("")), both, email, F.lit("")).alias("full_name"),
        F.nullif("join_date", F.lit("")).alias("join_date"),
        F.substring(F.nullif("join_date", F.lit("")), 1, 10).alias("join_date_date_only"),
        F.nullif("home_location", F.lit("")).alias("home_location"),
        F.nullif("phone_number", F.lit("")).alias("phone_number"),
        "reservation_status", "class_session_id",
    )


# --- reminders --------------------------------------------------------------------------------------------------------


def due_span(last: datetime | None, now: datetime) -> tuple[datetime, datetime]:
    """Class starts to remind of in this run: after the last span, up to the end of the hour 27 hours ahead.

    Spans of successive runs touch without gaps, also over midnight. A first run starts with the current target day.
    """
    ahead = (now + timedelta(hours=REMINDER_HOURS)).replace(minute=0, second=0, microsecond=0)
    end = ahead + timedelta(hours=1)
    return (last or ahead.replace(hour=0)), end


def display_fields(df: DataFrame, tz: str = D.LOCAL_TZ) -> DataFrame:
    """Readable class label, instructors, local date and time, and the address to write to."""
    note = F.trim(F.coalesce("public_note", F.lit("")))
    day = F.col("start_date")
    clock = F.col("start_time")
    local = F.from_utc_timestamp("start_datetime", tz)
    shown_day = F.when(day.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.concat_ws(
        "-", F.substring(day, 9, 2), F.substring(day, 6, 2), F.substring(day, 1, 4)))
    shown_time = F.when(clock.rlike(r"^\d{2}:\d{2}"), F.substring(clock, 1, 5))
    return df.withColumns({
        "class_label": F.when(note == "", F.coalesce("class_type_display", F.lit(""))).otherwise(note),
        "instructors": F.coalesce(F.array_join("instructor_names", ", "), F.lit("")),
        "class_date": F.coalesce(shown_day, F.date_format(local, "dd-MM-yyyy"), F.lit("")),
        "class_time": F.coalesce(shown_time, F.date_format(local, "HH:mm"), F.lit("")),
        "email_to": F.coalesce(F.nullif("guest_email", F.lit("")), F.nullif("user_email", F.lit("")), F.lit("")),
    })


def reminder_rows(bookings: DataFrame, sessions: DataFrame, users: DataFrame, studios: DataFrame,
                  tz: str = D.LOCAL_TZ) -> DataFrame:
    """Bookings with class, person and studio put beside them, ready for the message."""
    s = sessions.select(
        F.col("session_id").alias("class_session_id"), "class_type_display", "public_note", "instructor_names",
        F.col("start_date").alias("s_date"), F.col("start_time").alias("s_time"), "location_id",
    )
    u = users.select("user_id", F.col("email").alias("user_email"), "first_name")
    st = N.last_per_key(studios, F.trim(F.col("location_id").cast("string")), "pos", "studio", "place_key")
    joined = (
        bookings.where(F.col("class_session_id").isNotNull())
        .join(s, "class_session_id", "left").join(u, "user_id", "left")
        .withColumn("place_key", F.trim(F.col("location_id").cast("string"))).join(st, "place_key", "left")
        .withColumn("start_date", F.coalesce(F.nullif("s_date", F.lit("")), F.nullif("start_date", F.lit(""))))
        .withColumn("start_time", F.coalesce(F.nullif("s_time", F.lit("")), F.nullif("start_time", F.lit(""))))
    )
    shown = display_fields(joined, tz).where(F.col("email_to") != "")
    studio_email = F.coalesce(F.col("studio.email"), F.lit(""))
    return shown.select(
        "reservation_id", "class_session_id", F.col("email_to").alias("email"),
        F.coalesce("first_name", F.lit("")).alias("first_name"), "class_label",
        F.col("instructors").alias("instructor_names"), F.coalesce("studio.name", F.lit("")).alias("studio_name"),
        studio_email.alias("studio_email"), F.when(studio_email.contains("@"), studio_email).alias("reply_to"),
        "class_date", "class_time",
    )


def studio_lookup(studios: DataFrame) -> DataFrame:
    """Studios as the lookup shape: location, order, and name and e-mail as one value."""
    return studios.select("location_id", "pos", F.struct("name", "email").alias("studio"))


def reminders_due(bookings: DataFrame, sessions: DataFrame, users: DataFrame, studios: DataFrame, now: datetime,
                  last: datetime | None = None, tz: str = D.LOCAL_TZ) -> tuple[DataFrame, datetime]:
    """Messages of this run, and the point the next run starts from."""
    start, end = due_span(last, now)
    if end <= start:
        return reminder_rows(bookings.limit(0), sessions, users, studio_lookup(studios), tz), start
    due = P.pending_between(bookings, start, end)
    return reminder_rows(due, sessions, users, studio_lookup(studios), tz), end


def hourly_load(bookings: DataFrame) -> DataFrame:
    """Pending standard bookings per hour of class start: the windows a reminder run walks through."""
    kept = bookings.where((F.col("status") == "pending") & (F.col("reservation_type") == "standard"))
    return kept.groupBy(F.date_trunc("hour", "start_datetime").alias("hour")).agg(F.count(F.lit(1)).alias("n"))


# --- credits and birthdays --------------------------------------------------------------------------------------------


def expiring_credit_list(transactions: DataFrame, users: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    """One message per expiring credit pack, in English and French dates; packs without an address carry a reason."""
    u = users.select("user_id", F.col("email").alias("user_email"), "first_name")
    due = P.expiring_credits(transactions, as_of, days).join(u, "user_id", "left")
    day = F.to_date("expiration_datetime")
    return due.select(
        "transaction_id", "user_id", F.nullif("user_email", F.lit("")).alias("email"),
        F.coalesce(F.nullif("first_name", F.lit("")), F.lit("there")).alias("first_name"),
        F.col("remaining_credits_cache").cast("bigint").alias("credits_remaining"),
        F.coalesce(F.nullif("credit_name", F.lit("")), F.lit("Class Package")).alias("credit_name"),
        D.long_date(day, "en").alias("expires_en"), D.long_date(day, "fr").alias("expires_fr"),
        F.when(F.col("user_id").isNull(), "no-user").when(F.coalesce(F.col("user_email"), F.lit("")) == "", "no-email")
        .otherwise("ready").alias("outcome"),
    )


def membership_segment(people: DataFrame, instances: DataFrame) -> DataFrame:
    """``unlimited`` for people with an active or frozen unlimited membership, else ``standard``."""
    running = instances.where(F.col("status").isin("active", "frozen")).where(
        F.lower("membership_name").rlike("unlimited|illimit")
    ).select("user_id").distinct().withColumn("_unlimited", F.lit(True))
    return people.join(running, "user_id", "left").withColumn(
        "segment", F.when(F.col("_unlimited"), "unlimited").otherwise("standard")
    ).drop("_unlimited")


def birthday_list(users: DataFrame, instances: DataFrame, as_of: date) -> DataFrame:
    """People with a birthday in the coming week and their membership segment, one row per person."""
    due = P.birthdays(users, as_of).select(
        "user_id", "email", "first_name", "last_name", "birth_date", "upcoming_birthday"
    )
    rank = F.row_number().over(Window.partitionBy("user_id").orderBy("upcoming_birthday", "email"))
    once = due.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")
    return membership_segment(once, instances)


def count_by(df: DataFrame, *columns: str | Column) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
