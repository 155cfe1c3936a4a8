"""Purchases and visits of two booking systems, brought to one shape per person."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlake.functions import dates as D
from rosterlake.functions import membership as M
from rosterlake.functions import text as X
from rosterlake.operators.filters import with_email

PURCHASE_COLUMNS = ("email", "d", "rev", "category", "pack_size", "first_name", "last_name", "booking_customer_id",
                    "item_text")


def sales_with_customer(sales: DataFrame, customers: DataFrame) -> DataFrame:
    """Legacy sales with the customer's fields; both ids are compared as text."""
    s, c = sales.alias("s"), customers.alias("c")
    return s.join(c, F.col("s.customer_id").cast("string") == F.col("c.id").cast("string"), "left").select(
        F.col("s.d").alias("d"), "s.item", "s.type", F.coalesce("s.revenue", F.lit(0.0)).alias("rev"),
        F.col("c.emailaddress").alias("emailaddress"), "c.first_name", "c.last_name",
    )


def legacy_purchases(sales: DataFrame, customers: DataFrame) -> DataFrame:
    """Series sales of the legacy system with a known e-mail and a date."""
    joined = sales_with_customer(sales.where(F.col("type") == "series"), customers)
    return with_email(joined, "emailaddress").where(F.col("d").isNotNull()).select(
        "email", "d", "rev", M.legacy_category(F.col("item")).alias("category"),
        F.coalesce(M.pack_size(F.col("item")), F.lit(1)).alias("pack_size"),
        "first_name", "last_name", F.lit(None).cast("string").alias("booking_customer_id"),
        F.col("item").alias("item_text"),
    )


def new_purchases(sales: DataFrame, dated: bool = True) -> DataFrame:
    """Membership and credit lines of the text sales table. Without ``dated`` lines whose day cannot be read stay in, so that
    texts are read once, where the day is used, and not for a filter as well."""
    kept = sales.where(F.col("product_type").isin(*M.PRODUCT_CATEGORY))
    bought = with_email(kept, "customer_email").withColumn("d", D.tolerant_date(F.col("transaction_date")))
    return (bought.where(F.col("d").isNotNull()) if dated else bought).select(
        "email", "d", F.coalesce(X.to_float(F.col("line_total")), F.lit(0.0)).alias("rev"),
        M.product_category(F.col("product_type")).alias("category"),
        F.coalesce(F.col("line_quantity").try_cast("bigint"), F.lit(1)).alias("pack_size"),
        F.col("customer_name").alias("first_name"), F.lit(None).cast("string").alias("last_name"),
        F.col("customer_id").alias("booking_customer_id"), F.col("product").alias("item_text"),
    )


def either_purchases(legacy: DataFrame, new: DataFrame) -> DataFrame:
    """Both systems as one table."""
    return legacy.select(*PURCHASE_COLUMNS).unionByName(new.select(*PURCHASE_COLUMNS))


def all_purchases(legacy: DataFrame, new: DataFrame) -> DataFrame:
    """Both systems as one table, with plan length and weekly rate for memberships."""
    member = F.col("category") == "membership"
    return either_purchases(legacy, new).withColumns({
        "plan_days": F.when(member, M.plan_days(F.col("item_text"))),
        "weekly_rate": F.when(member, M.weekly_rate(F.col("item_text"))),
    })


def all_visits(legacy: DataFrame, new: DataFrame) -> DataFrame:
    """(e-mail, day) of every booking in both systems; rows without either are dropped."""
    old = with_email(legacy, "emailaddress").select("email", F.to_date("class_date").alias("d"))
    now = with_email(new, "`Customer Email`").select("email", F.col("`Class Start Date`").alias("d"))
    return old.unionByName(now).where(F.col("d").isNotNull())


def visit_days(visits: DataFrame) -> DataFrame:
    """Distinct (e-mail, day)."""
    return visits.select("email", "d").distinct()


def visit_history(visits: DataFrame) -> DataFrame:
    """Per person the distinct visit days, newest first.

    The array is bounded by the days of the calendar, however many bookings a person has, and the distinct days are
    built in the map tasks, so the shuffle carries one small set per person and task.
    """
    return visits.groupBy("email").agg(F.sort_array(F.collect_set("d"), asc=False).alias("days"))


def count_between(days: Column, lo: Column, hi: Column) -> Column:
    """Entries of a day array that lie in the closed range."""
    return F.size(F.filter(days, lambda d: d.between(lo, hi)))


def last_two(history: DataFrame) -> DataFrame:
    """Last and second-last visit day."""
    return history.select("email", F.get("days", F.lit(0)).alias("last_visit_date"),
                          F.get("days", F.lit(1)).alias("previous_visit_date"))


def visit_gap(last: Column, previous: Column) -> Column:
    """Days between the last two visits, 999 when there is only one."""
    return F.coalesce(F.datediff(last, previous), F.lit(999))


def visit_counts(history: DataFrame) -> DataFrame:
    return history.select("email", F.size("days").alias("visit_count"))


def visit_windows(history: DataFrame, as_of: date) -> DataFrame:
    """Visit days in the last 60 days and in the 60 days before."""
    today = F.lit(as_of)
    return history.select(
        "email",
        count_between(F.col("days"), F.date_sub(today, 60), today).alias("visits_trailing60"),
        count_between(F.col("days"), F.date_sub(today, 120), F.date_sub(today, 61)).alias("visits_prior60"),
    )


def visits_since(population: DataFrame, history: DataFrame, as_of: date) -> DataFrame:
    """Distinct visit days between the last purchase and ``as_of``; 0 for people without visits.

    The range is applied to the day array after an equi-join, so no row is multiplied by its matches.
    """
    joined = population.select("email", "last_purchase_date").join(history, "email", "left")
    used = count_between(F.col("days"), F.col("last_purchase_date"), F.lit(as_of))
    return joined.select(
        "email", F.when(F.col("days").isNull() | F.col("last_purchase_date").isNull(), 0).otherwise(used)
        .alias("visits_since_purchase")
    )


#: Which of several purchases of one day is the latest: by revenue, text, pack size, then the other fields.
LATEST_ORDER = ("d", "rev", "item_text", "pack_size", "first_name", "last_name", "booking_customer_id", "category")
PLAN_COLUMNS = {"plan_days": M.plan_days, "weekly_rate": M.weekly_rate}


def purchase_profile(purchases: DataFrame) -> DataFrame:
    """One row per person: latest purchase, latest membership, last credit day, ever a member. Purchases without a day do
    not count.

    All four come from one aggregation with partial results in the map tasks: one shuffle instead of four. Where purchases
    do not say how long a plan runs and what it promises, that is read from the text of the one membership that is kept.
    """
    told = [c for c in PLAN_COLUMNS if c in purchases.columns]
    kept, member = F.struct(*LATEST_ORDER, *told), F.col("category") == "membership"
    dated = F.col("d").isNotNull()
    found = purchases.groupBy("email").agg(
        F.max(F.when(dated, kept)).alias("_latest"),
        F.max(F.when(dated & member, kept)).alias("_plan"),
        F.max(F.when(F.col("category") == "credit", F.col("d"))).alias("last_credit_purchase_date"),
    ).where(F.col("_latest").isNotNull())
    latest = ("d", "category", "pack_size", "rev", "first_name", "last_name", "booking_customer_id")
    plan = [(F.col(f"_plan.{c}") if c in told else read(F.col("_plan.item_text"))).alias(c) for c, read in PLAN_COLUMNS.items()]
    return found.select(
        "email", F.struct(*[F.col(f"_latest.{c}").alias(c) for c in latest]).alias("latest"),
        F.when(F.col("_plan").isNotNull(), F.struct(F.col("_plan.d").alias("d"), *plan)).alias("plan"),
        "last_credit_purchase_date", F.col("_plan").isNotNull().alias("ever_member"))


def downgrade_flag(people: DataFrame, purchases: DataFrame) -> DataFrame:
    """People with a flag: has this person ever bought a membership."""
    members = purchases.where(F.col("category") == "membership").select("email").distinct()
    return people.join(members.withColumn("_member", F.lit(True)), "email", "left").withColumn(
        "is_downgrade", F.col("_member").isNotNull()
    ).drop("_member")


def active_category(plan_date: Column, plan_days: Column, last_credit: Column, as_of: date, grace: int = 7) -> Column:
    """Membership while its cover and grace last, else credit, else a lapsed membership."""
    covered = F.date_add(plan_date, (plan_days + grace).cast("int")) >= F.lit(as_of)
    return (
        F.when(covered, "membership")
        .when(last_credit.isNotNull(), "credit")
        .when(plan_date.isNotNull(), "membership")
    )
