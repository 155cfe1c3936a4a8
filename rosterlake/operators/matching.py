"""Lookups that pick one partner per row: by time, by name, by dimension, by position in a history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rosterlake.functions import text as X
from rosterlake.operators.ordinals import place_in_order


def match_sessions(requests: DataFrame, sessions: DataFrame, minutes: int = 2) -> DataFrame:
    """Every request with the session at its location nearest in time, within +-``minutes``.

    ``requests``: location_id, target_ts, class_name (null = any class) and whatever else should come along.
    ``sessions``: session_id, location_id, start_ts, class_name. Class names are compared trimmed and in lower case.
    Equal distances go to the smaller id. Added: session_id (null without a match), delta_seconds.

    No pairs are built. Requests become their distinct (place, class, instant); sessions become the smallest id per
    (place, class, instant). Both are laid on one time line per place, class and time slot, and the last session
    before and the first one after an instant are read off it. A slot is as wide as the window, each session is
    copied into the one or two slots its window touches, so a busy place is spread over as many groups as it has
    slots.
    """
    reach = minutes * 60_000_000
    slot = max(2 * reach, 60_000_000)
    line_key = ["location_id", "_class", "_at"]
    want = requests.withColumns({
        "_at": F.unix_micros("target_ts"),
        "_class": F.coalesce(X.norm_name(F.col("class_name")), F.lit("")),
    })
    # rows without a place or an instant make one group here, and no session can meet it
    asked = want.select(*line_key).distinct()
    held = sessions.where(F.col("start_ts").isNotNull()).select(
        "session_id", "location_id", F.unix_micros("start_ts").alias("_at"),
        F.explode(F.array_distinct(F.array(F.lit(""), F.coalesce(X.norm_name(F.col("class_name")), F.lit("")))))
        .alias("_class"),
    ).groupBy(*line_key).agg(F.min("session_id").alias("session_id"))

    def slot_of(at: Column) -> Column:
        return F.floor(at / slot).cast("bigint")

    line = asked.select(
        *line_key, slot_of(F.col("_at")).alias("_slot"), F.lit(True).alias("_asked"),
        F.lit(None).cast(held.schema["session_id"].dataType).alias("session_id"),
    ).unionByName(held.select(
        *line_key, F.explode(F.sequence(slot_of(F.col("_at") - reach), slot_of(F.col("_at") + reach))).alias("_slot"),
        F.lit(False).alias("_asked"), "session_id",
    ))
    here = F.when(~F.col("_asked"), F.struct("_at", "session_id"))
    # sessions sort before a request at the same instant, so an exact hit is the last session before it
    # both frames grow by one row at a time, in rising and in falling order, which keeps the scan linear
    lane = Window.partitionBy("location_id", "_class", "_slot").rowsBetween(Window.unboundedPreceding, 0)
    before = F.last(here, ignorenulls=True).over(lane.orderBy("_at", "_asked"))
    after = F.last(here, ignorenulls=True).over(lane.orderBy(F.desc("_at"), "_asked"))
    near = line.select(*line_key, "_asked", before.alias("b"), after.alias("a")).where("_asked")
    gap_b, gap_a = F.col("_at") - F.col("b._at"), F.col("a._at") - F.col("_at")
    options = F.array(
        F.when(gap_b <= reach, F.struct(gap_b.alias("gap"), F.col("b.session_id").alias("session_id"))),
        F.when(gap_a <= reach, F.struct(gap_a.alias("gap"), F.col("a.session_id").alias("session_id"))),
    )
    best = near.select(*line_key, F.array_min(F.filter(options, lambda o: o.isNotNull())).alias("_best"))
    return want.join(best, line_key, "left").select(
        *[F.col(f"`{c}`") for c in requests.columns], F.col("_best.session_id").alias("session_id"),
        (F.col("_best.gap") / 1_000_000).cast("bigint").alias("delta_seconds"),
    )


def first_valid_email(users: DataFrame) -> DataFrame:
    """Per normalised full name: the valid e-mail of the smallest user id that has one.

    Partial minima are built before the shuffle, so a name that millions share is one row a task.
    """
    named = users.select("user_id", X.norm_name(F.col("full_name")).alias("name_key"), F.trim("email").alias("email"))
    usable = named.where(F.col("name_key").isNotNull() & X.is_email(F.col("email")))
    return usable.groupBy("name_key").agg(F.min_by("email", "user_id").alias("found_email"))


def resolve_email(ratings: DataFrame, users: DataFrame) -> DataFrame:
    """Ratings with ``resolved_email`` and an ``outcome``: skipped, updated or not found.

    A rating with a valid e-mail or without a contact is skipped; a contact that is an e-mail already is used as it
    is; any other contact is looked up by name.
    """
    contact = F.trim(F.coalesce(F.col("contact"), F.lit("")))
    has_email, bare = X.is_email(F.col("email")), contact == ""
    look = ~has_email & ~bare & ~X.is_email(contact)
    keyed = ratings.withColumn("name_key", F.when(look, X.norm_name(contact)))
    joined = keyed.join(first_valid_email(users), "name_key", "left")
    resolved = F.when(has_email | bare, None).when(X.is_email(contact), contact).otherwise(F.col("found_email"))
    return (
        joined.withColumn("resolved_email", resolved)
        .withColumn("outcome", F.when(has_email | bare, "skipped").when(F.col("resolved_email").isNull(), "not_found")
                    .otherwise("updated"))
        .drop("name_key", "found_email")
    )


def last_per_key(dimension: DataFrame, key: Column, order: str, value: str, name: str) -> DataFrame:
    """Lookup table ``key -> value`` where the last duplicate wins; blank keys are dropped."""
    keyed = dimension.select(key.alias(name), order, value).where(F.coalesce(F.col(name), F.lit("")) != "")
    return keyed.groupBy(name).agg(F.max_by(value, order).alias(value))


def assign_dims(classes: DataFrame, instructors: DataFrame, studios: DataFrame, types: DataFrame) -> DataFrame:
    """Classes with instructor, studio and class type ids; misses stay null.

    Dimensions are joined after they are reduced to one row per key. Whether one is broadcast is left to its size.
    """
    by_name = last_per_key(instructors, X.norm_name(F.col("name")), "pos", "instructor_id", "instructor_key")
    by_place = last_per_key(studios, F.trim(F.col("location_id").cast("string")), "pos", "studio_id", "place_key")
    by_type = last_per_key(types, X.norm_name(F.col("name")), "pos", "class_type_id", "type_key")
    return (
        classes.withColumn("instructor_key", X.norm_name(F.col("instructor")))
        .withColumn("place_key", F.trim(F.col("location_id").cast("string")))
        .withColumn("type_key", X.norm_name(F.col("class_type")))
        .join(by_name, "instructor_key", "left")
        .join(by_place, "place_key", "left")
        .join(by_type, "type_key", "left")
        .drop("instructor_key", "place_key", "type_key")
    )


def lookup_misses(assigned: DataFrame) -> DataFrame:
    return assigned.agg(
        F.count(F.lit(1)).alias("classes"),
        F.count_if(F.col("instructor_id").isNull()).alias("instructors_missing"),
        F.count_if(F.col("studio_id").isNull()).alias("studios_missing"),
        F.count_if(F.col("class_type_id").isNull()).alias("types_missing"),
    )


# --- position in a history ------------------------------------------------------------------------------------------


def visit_sort_key(min_datetime: Column, start_date: Column, start_time: Column) -> Column:
    """Text that orders bookings: the class start, or date and time put together."""
    joined = F.concat(F.coalesce(start_date, F.lit("")), F.lit("T"), F.coalesce(start_time, F.lit("")))
    return F.coalesce(F.nullif(min_datetime, F.lit("")), joined)


def nth_by_time(bookings: DataFrame, user: str, order: list[Column], n: int) -> DataFrame:
    """The n-th booking of every user; each map task sends at most n rows per user."""
    pos = F.row_number().over(Window.partitionBy(user).orderBy(*order))
    return bookings.withColumn("ordinal", pos).where(F.col("ordinal") == n)


def ordinal_in_history(bookings: DataFrame, user: str, sort_text: str, tie: str) -> DataFrame:
    """Every booking with its place in the history of its user. A user who holds a third of all bookings, or whose bookings
    have no date, is dealt to as many tasks as anyone's rows."""
    return place_in_order(bookings, [F.col(sort_text), F.col(tie)], user)


def history_pages(history: DataFrame, user: str, size: int = 200) -> DataFrame:
    """Histories as arrays of at most ``size`` entries: complete, but never one unbounded array."""
    entry = F.struct("ordinal", "reservation_id", "class_session_id", F.coalesce("status", F.lit("")).alias("status"))
    page = F.floor((F.col("ordinal") - 1) / size).cast("bigint").alias("page")
    return history.groupBy(user, page).agg(F.sort_array(F.collect_list(entry)).alias("entries"))


def oldest_booking(customers: DataFrame, bookings: DataFrame) -> DataFrame:
    """Every customer with their oldest booking that is not cancelled; dateless bookings come last, none is allowed.

    The date is the first filled of five fields.
    """
    dated = bookings.where(
        (F.coalesce(F.col("status"), F.lit("")) != "") & ~F.lower("status").contains("cancel")
    ).withColumn("_at", F.try_to_timestamp(F.coalesce(
        *[F.nullif(F.col(c), F.lit("")) for c in ("class_session_start_datetime", "class_session_start",
                                                  "start_datetime", "created_at", "updated_at")]
    )))
    pos = F.row_number().over(
        Window.partitionBy("user_id").orderBy(F.col("_at").asc_nulls_last(), F.col("reservation_id"))
    )
    first = dated.withColumn("_pos", pos).where(F.col("_pos") == 1).select(
        F.col("user_id").alias("customer_id"), F.col("status").alias("reservation_status"),
        F.col("class_session_id"),
    )
    return customers.join(first, "customer_id", "left")


def attach_checkins(classes: DataFrame, bookings: DataFrame, key: str = "class_session_id") -> DataFrame:
    """Classes with their number of checked-in bookings, 0 for none. Counts are combined before the shuffle."""
    counted = bookings.where(F.col("status") == "check in").groupBy(key).agg(F.count(F.lit(1)).alias("check_ins"))
    return classes.join(counted, key, "left").withColumn("check_ins", F.coalesce("check_ins", F.lit(0)))


def roster(bookings: DataFrame, spots: DataFrame) -> DataFrame:
    """Bookings that sit on a listed spot; cancelled ones and unknown spots are dropped."""
    listed = spots.select(F.trim("spot").alias("spot"), "row_number").where(F.col("spot") != "")
    listed = listed.groupBy("spot").agg(F.max("row_number").alias("row_number"))
    live = bookings.where(~F.coalesce(F.lower("status").contains("cancel"), F.lit(False)))
    return live.withColumn("spot", F.trim(F.col("spot").cast("string"))).join(listed, "spot")
