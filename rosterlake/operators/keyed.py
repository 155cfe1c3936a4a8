"""Changes to keyed tables, as rewrites: patch, upsert, merge, replace children, guarded delete."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlake.functions import text as X
from rosterlake.sources.tables import TooManyRows

DELETE_CAP = 50_000


def patch(current: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Current rows with every non-null field of ``changes`` put over them. ``changes`` has one row per key."""
    fields = [c for c in changes.columns if c != key]
    renamed = changes.withColumnsRenamed({c: f"_new_{c}" for c in fields})
    joined = current.join(renamed, key, "left")
    return joined.select(
        *[F.coalesce(F.col(f"_new_{c}"), F.col(c)).alias(c) if c in fields else F.col(c) for c in current.columns]
    )


def latest_names(people: DataFrame, order: str) -> DataFrame:
    """One row per lower-case e-mail with the name that came last; partial maxima are built before the shuffle."""
    keyed = people.where(F.coalesce(F.col("email"), F.lit("")) != "").select(
        F.lower("email").alias("email_lower"), F.coalesce(F.col("name"), F.lit("")).alias("name"), order
    )
    return keyed.groupBy("email_lower").agg(F.max_by("name", F.struct(order, "name")).alias("name"))


def upsert_customers(current: DataFrame, people: DataFrame, order: str = "reservation_id") -> DataFrame:
    """Customers after an upsert on (lower-case e-mail, not a duplicate).

    Matched rows take the new name and the lower-case e-mail, unmatched people become rows, rows marked as
    duplicates are never touched, and neither are rows whose mark is missing. New rows are keyed by their e-mail.
    """
    own = F.col("dupe").eqNullSafe(F.lit("No"))
    fresh = latest_names(people, order).withColumnRenamed("name", "new_name")
    joined = current.where(own).join(fresh, "email_lower", "full_outer")
    merged = joined.select(
        F.coalesce(F.col("customer_id"), F.concat(F.lit("new:"), F.col("email_lower"))).alias("customer_id"),
        F.col("email_lower"),
        F.when(F.col("new_name").isNotNull(), F.col("email_lower")).otherwise(F.col("email")).alias("email"),
        F.coalesce("new_name", "name").alias("name"),
        F.lit("No").alias("dupe"),
        *[c for c in current.columns if c not in ("customer_id", "email_lower", "email", "name", "dupe")],
    )
    return merged.unionByName(current.where(~own).select(*merged.columns))


def replace_children(existing: DataFrame, fresh: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Rows of all other parents, and the new rows of the given parents. A parent without new rows ends up empty."""
    return existing.join(parents.select(key).distinct(), key, "left_anti").unionByName(fresh)


def link_or_create(emails: DataFrame, clients: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Link every row to the client with its e-mail, and the clients to create for e-mails nobody has.

    ``clients`` may hold an e-mail twice; the smallest id is the one found. Returns (linked rows, new clients).
    """
    known = clients.where(F.coalesce(F.col("email"), F.lit("")) != "").groupBy(
        F.lower("email").alias("email_lower")
    ).agg(F.min("client_id").alias("client_id"))
    keyed = emails.withColumn("email_lower", F.lower(F.trim("email")))
    linked = keyed.join(known, "email_lower", "left").withColumn(
        "client_key", F.coalesce(F.col("client_id").cast("string"), F.concat(F.lit("new:"), F.col("email_lower")))
    )
    created = (
        keyed.where(F.col("email_lower") != "").groupBy("email_lower").agg(F.min(F.trim("email")).alias("email"))
        .join(known, "email_lower", "left_anti")
        .withColumn("client_key", F.concat(F.lit("new:"), F.col("email_lower")))
    )
    return linked, created


def merge_scores(current: DataFrame, batch: DataFrame, as_of: date) -> DataFrame:
    """Score table after a run: matched rows keep their old tier as ``previous_tier``, new ones have none, rows that
    are not in the batch stay as they are."""
    key = ["email", "population"]
    taken = ["first_name", "last_name", "booking_customer_id", "last_visit_date", "churn_prob",
             "likely_permanent_prob", "tier", "key_signal"]
    new = batch.select(*key, *[F.col(c).alias(f"_new_{c}") for c in taken], F.lit(True).alias("_hit"))
    joined = current.join(new, key, "full_outer")
    hit = F.coalesce(F.col("_hit"), F.lit(False))

    def pick(c: str) -> Column:
        return F.when(hit, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)

    return joined.select(
        *key, *[pick(c) for c in taken[:7]],
        F.when(hit, F.col("tier")).otherwise(F.col("previous_tier")).alias("previous_tier"),
        pick("key_signal"),
        F.when(hit, F.lit(as_of)).otherwise(F.col("updated_date")).alias("updated_date"),
    )


def changed_tiers(scores: DataFrame, as_of: date) -> DataFrame:
    """Rows of this run in a risk tier that are new or changed, with the wording and the direction of the change."""
    rank = {"OK": 0, "Watch": 1, "Critical": 2}

    def level(c: str) -> Column:
        out = F.lit(None).cast("int")
        for name, value in rank.items():
            out = F.when(F.col(c) == name, F.lit(value)).otherwise(out)
        return out

    before, after = level("previous_tier"), level("tier")
    return (
        scores.where(F.col("updated_date") == F.lit(as_of))
        .where(F.col("tier").isin("Critical", "Watch"))
        .where(F.col("previous_tier").isNull() | (F.col("previous_tier") != F.col("tier")))
        .withColumn("tier_change", F.when(F.col("previous_tier").isNull(), "New").otherwise(
            F.concat_ws(" -> ", "previous_tier", "tier")))
        .withColumn("direction", F.when(before.isNull(), "new").when(after > before, "up").otherwise("down"))
        .withColumn("name", X.full_name(F.col("first_name"), F.col("last_name")))
    )


def guarded_delete(df: DataFrame, doomed: DataFrame, keys: Sequence[str], cap: int = DELETE_CAP, share: float = 0.0) -> DataFrame:
    """``df`` without the doomed keys; refuses when that would delete more than ``cap`` rows, or than ``share`` of all rows
    where that is more.

    The first count looks at no more than ``cap + 1`` rows of ``df``; all are counted only where the share has to decide.
    How the keys are joined is left to their size.
    """
    listed = doomed.select(*keys).distinct()
    held = df.join(listed, list(keys), "left_semi")
    if held.limit(cap + 1).count() > cap:
        allowed = max(cap, int(share * df.count())) if share else cap
        if allowed == cap or held.count() > allowed:
            raise TooManyRows(f"refusing to delete more than {allowed} rows; check what selects them")
    return df.join(listed, list(keys), "left_anti")


def outcomes(df: DataFrame, column: str = "outcome") -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def top_n(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The first n rows by ``order``; each task sends at most n rows."""
    return df.orderBy(*order).limit(n)
