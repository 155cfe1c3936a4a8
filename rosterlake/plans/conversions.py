"""Purchase-conversion events: qualifying sales with hashed contact data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlake.functions import dates as D
from rosterlake.functions import text as X
from rosterlake.operators.filters import qualifies
from rosterlake.sources.reports import raw_name


#: Report cells an event needs as they were sent: the stored text has no seconds.
RAW_CELLS = ("Order Date (UTC)", "Order Time (UTC)")


def conversion_rows(sales: DataFrame, users: DataFrame) -> DataFrame:
    """Sales rows with the buyer's contact data: the user record by id, else the e-mail on the sale itself.

    Users are unique by id, so a buyer with very many sales only
    makes the sales side uneven, which adaptive execution splits.
    """
    u = users.select(
        F.col("user_id").cast("string").alias("_uid"), F.col("email").alias("_email"),
        F.col("first_name").alias("_first"), F.col("last_name").alias("_last"), F.col("phone_number").alias("_phone"),
    )
    joined = sales.join(u, F.col("customer_id").cast("string") == F.col("_uid"), "left")
    return joined.select(
        *sales.columns,
        F.trim(F.coalesce(F.nullif("_email", F.lit("")), F.nullif("customer_email", F.lit("")), F.lit(""))).alias("email"),
        F.trim(F.coalesce("_first", F.lit(""))).alias("first_name"),
        F.trim(F.coalesce("_last", F.lit(""))).alias("last_name"),
        X.digits(F.coalesce("_phone", F.lit(""))).alias("phone"),
    )


def conversion_events(rows: DataFrame) -> DataFrame:
    """One event per row. Contact values leave only as hashes; a value that is missing leaves no key.

    The event time comes from the raw cells of the report where they were kept (``RAW_CELLS``), else from the row,
    which then has to hold ISO dates and 24-hour times.
    """
    raw = [raw_name(h) for h in RAW_CELLS]
    day, clock = raw if set(raw) <= set(rows.columns) else ("order_date_utc", "order_time_utc")

    def hashed(c: str):
        return X.pii_hash(F.col(c))

    return rows.select(
        "order_number", F.lit("Purchase").alias("event_name"),
        D.event_time(F.col(day), F.col(clock)).alias("event_time"),
        F.lit("physical_store").alias("action_source"),
        hashed("email").alias("em"), hashed("phone").alias("ph"), hashed("first_name").alias("fn"),
        hashed("last_name").alias("ln"),
        X.to_float(F.col("line_subtotal")).alias("value"), F.trim(F.coalesce("currency", F.lit(""))).alias("currency"),
    )


def offline_conversions(new_sales: DataFrame, users: DataFrame) -> DataFrame:
    """Events of the qualifying rows among the sales that were just found to be new."""
    return conversion_events(conversion_rows(qualifies(new_sales), users))


def event_payloads(events: DataFrame) -> DataFrame:
    """Events in their nested delivery shape, one JSON text per row."""
    def one(c: str):
        return F.when(F.col(c).isNotNull(), F.array(c)).alias(c)

    body = F.struct(
        "event_name", "event_time", "action_source",
        F.struct(*[one(c) for c in ("em", "ph", "fn", "ln")]).alias("user_data"),
        F.struct("value", "currency").alias("custom_data"),
    )
    return events.select("order_number", F.to_json(body).alias("payload"))
