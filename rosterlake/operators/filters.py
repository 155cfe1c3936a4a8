"""Row filters, work lists and valid/reject splits."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlake.functions import dates as D
from rosterlake.functions import text as X
from rosterlake.sources.tables import month_bounds
from rosterlake.specs import TableSpec

# What counts as a conversion and which tag marks new people.
CONVERSION_TYPES = (
    "Credits", "Memberships", "Email Credit Gift Cards", "Email Gift Cards", "Physical Credit Gift Cards",
    "Physical Gift Cards",
)
COMPLETED = "Completed"
NEW_PEOPLE_TAG = "463"
BIRTH_YEARS = (1920, 2020)


def drop_junk(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Without leaked header rows, comment rows and rows without a key."""
    return df.where(spec.keep())


def in_month(df: DataFrame, spec: TableSpec, start: date, end: date) -> DataFrame:
    """Rows whose audit day lies in the range; whole partitions are skipped where the table has a month column."""
    return df.where(month_bounds(df, start, end) & spec.within(start, end))


def is_cancelled(status: Column) -> Column:
    return F.coalesce(F.lower(status).contains("cancel"), F.lit(False))


def not_cancelled(df: DataFrame, status: str = "status", need_status: bool = False) -> DataFrame:
    """Without cancelled rows; ``need_status`` also drops rows with an empty or missing status."""
    keep = ~is_cancelled(F.col(status))
    if need_status:
        keep = keep & (F.coalesce(F.col(status), F.lit("")) != "")
    return df.where(keep)


def pending_between(df: DataFrame, start: datetime, end: datetime, at: str = "start_datetime",
                    standard_only: bool = True) -> DataFrame:
    """Pending bookings that start in the half-open range."""
    kept = df.where((F.col("status") == "pending") & (F.col(at) >= F.lit(start)) & (F.col(at) < F.lit(end)))
    return kept.where(F.col("reservation_type") == "standard") if standard_only else kept


def qualifies(df: DataFrame, product_type: str = "product_type", line_status: str = "line_status") -> DataFrame:
    """Sales lines that count as a conversion."""
    return df.where(F.col(product_type).isin(*CONVERSION_TYPES) & (F.col(line_status) == COMPLETED))


def has_tag(tags: Column, tag: str = NEW_PEOPLE_TAG) -> Column:
    return F.coalesce(F.array_contains(tags, tag), F.lit(False))


def expiring_credits(df: DataFrame, as_of: date, days: int = 30, tz: str = D.LOCAL_TZ) -> DataFrame:
    """Credits with something left that run out exactly ``days`` local days after ``as_of``."""
    target = F.date_add(F.lit(as_of), days)
    return df.where(
        (D.utc_to_local_date(F.col("expiration_datetime"), tz) == target)
        & (F.coalesce(F.col("remaining_credits_cache"), F.lit(0)) > 0)
        & ~F.coalesce(F.col("is_expired"), F.lit(False))
    )


def birthdays(users: DataFrame, as_of: date, days: int = 7) -> DataFrame:
    """Reachable people whose birthday falls on ``as_of`` or the next days, with the day it falls on.

    The few window days are matched as literals, so this is one scan without a shuffle. A 29 February
    birthday is met only in a leap year.
    """
    window = [F.date_add(F.lit(as_of), i) for i in range(days)]
    born = F.date_format("birth_date", "MM-dd")
    upcoming = F.coalesce(*[F.when(F.date_format(d, "MM-dd") == born, d) for d in window])
    return (
        users.withColumn("upcoming_birthday", upcoming)
        .where(F.col("upcoming_birthday").isNotNull())
        .where(F.year("birth_date").between(*BIRTH_YEARS))
        .where(F.coalesce(F.col("archived_at").cast("string"), F.lit("")) == "")
        .where(F.coalesce(F.col("email"), F.lit("")) != "")
    )


def changed_since(df: DataFrame, now: datetime, at: str = "last_modified", days: int = 1) -> DataFrame:
    return df.where(F.col(at) > F.lit(now) - F.make_dt_interval(F.lit(days)))


def reachable(df: DataFrame, as_of: date, last_visit: str = "last_visit_date", days: int = 180) -> DataFrame:
    """Seen in the last ``days`` days and not after ``as_of``."""
    return df.where(F.col(last_visit).between(F.date_sub(F.lit(as_of), days), F.lit(as_of)))


def in_credit_population(as_of: date, days: int = 90) -> Column:
    """Credit customers whose last purchase is recent enough to act on."""
    return (F.col("category") == "credit") & (F.col("last_purchase_date") >= F.date_sub(F.lit(as_of), days))


def credit_population(df: DataFrame, as_of: date, days: int = 90) -> DataFrame:
    return df.where(in_credit_population(as_of, days))


def with_email(df: DataFrame, column: str, name: str = "email") -> DataFrame:
    """Normalised e-mail as ``name``; rows without one are dropped before they can pile up on one join key."""
    return df.withColumn(name, X.norm_email(F.col(column))).where(F.col(name) != "")


def reason_column(rules: Sequence[tuple[str, Column]]) -> Column:
    """The name of the first rule that is broken, null for a good row."""
    out = None
    for reason, broken in rules:
        out = F.when(broken, F.lit(reason)) if out is None else out.when(broken, F.lit(reason))
    return out.otherwise(F.lit(None).cast("string"))


def split_valid(df: DataFrame, rules: Sequence[tuple[str, Column]]) -> tuple[DataFrame, DataFrame]:
    """Good rows, and rejected rows with a ``reason``."""
    marked = df.withColumn("reason", reason_column(rules))
    return marked.where(F.col("reason").isNull()).drop("reason"), marked.where(F.col("reason").isNotNull())


def needs_email(ratings: DataFrame, link: str = "email_link") -> DataFrame:
    """Ratings that are not linked to a client yet."""
    return ratings.where(F.coalesce(F.col(link), F.lit("")) == "")


def awaiting_second(customers: DataFrame) -> DataFrame:
    """First class taken, second one not yet."""
    return customers.where((F.col("first_class_taken") == 1) & (F.col("second_class_taken") == 0))


def class_request_state(room: Column, date_text: Column, class_id: Column) -> Column:
    """``missing`` without room or date, ``done`` with an id already, else ``open``."""
    blank = (F.coalesce(room, F.lit("")) == "") | (F.coalesce(date_text, F.lit("")) == "")
    done = F.coalesce(F.trim(class_id.cast("string")), F.lit("")) != ""
    return F.when(blank, "missing").when(done, "done").otherwise("open")


def needs_class_id(requests: DataFrame) -> DataFrame:
    state = class_request_state(F.col("room"), F.col("date_text"), F.col("class_id"))
    return requests.where(state == "open")
