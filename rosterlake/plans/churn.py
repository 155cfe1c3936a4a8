"""Churn scoring: purchases and visits -> features -> probabilities -> tiers -> score history and its changes."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlake.functions import text as X
from rosterlake.operators import activity as A
from rosterlake.operators import keyed as K
from rosterlake.operators import scoring as S
from rosterlake.session import cut_lineage


@dataclass(frozen=True)
class ChurnTables:
    """Inputs of a run: the legacy system's three tables and the new system's two."""

    legacy_sales: DataFrame
    legacy_customers: DataFrame
    legacy_reservations: DataFrame
    sales: DataFrame
    reservations: DataFrame


def people(t: ChurnTables, as_of: date) -> DataFrame:
    """Every reachable person with category, gap, visit days and last purchase: two aggregations and one join."""
    purchases = A.either_purchases(A.legacy_purchases(t.legacy_sales, t.legacy_customers), A.new_purchases(t.sales, dated=False))
    visits = A.all_visits(t.legacy_reservations, t.reservations)
    return S.candidates(A.visit_history(visits), A.purchase_profile(purchases), as_of)


def churn_features(t: ChurnTables, as_of: date) -> tuple[DataFrame, DataFrame]:
    """Membership and credit feature tables. Persist ``people`` and use the two feature operators when both are
    needed in one run."""
    everyone = people(t, as_of)
    return S.member_features(everyone, as_of), S.credit_features(everyone, as_of)


def _batch(df: DataFrame, population: str, prob: Column, permanent: Column, signal: Column) -> DataFrame:
    return df.select(
        "email", F.lit(population).alias("population"),
        F.nullif("first_name", F.lit("")).alias("first_name"), F.nullif("last_name", F.lit("")).alias("last_name"),
        F.nullif("booking_customer_id", F.lit("")).alias("booking_customer_id"), "last_visit_date",
        prob.alias("churn_prob"), permanent.alias("likely_permanent_prob"),
        S.tier_of(population, prob).alias("tier"), signal.alias("key_signal"),
    )


def score_people(members: DataFrame, credits: DataFrame, models: S.Models) -> DataFrame:
    """Scored batch of both populations."""
    scored = S.score(members, models.membership, S.MEMBERSHIP_INPUTS)
    # the second model reads the same rows; its probability rides along instead of being joined back by e-mail
    both = S.score_return(scored, models.permanence)
    member_batch = _batch(both, "membership", F.col("churn_prob"), F.col("likely_permanent_prob"),
                          S.membership_signal())
    credit_batch = _batch(S.score(credits, models.credit, S.CREDIT_INPUTS), "credit", F.col("churn_prob"),
                          F.lit(None).cast("double"), S.credit_signal())
    return member_batch.unionByName(credit_batch)


def churn_scoring(t: ChurnTables, models: S.Models, scores: DataFrame, as_of: date) -> tuple[DataFrame, DataFrame]:
    """Score table after the run, and the rows that are new or changed in a risk tier.

    The people are staged between the two populations, so purchases and visits are read and grouped once.
    """
    return score_and_merge(cut_lineage(people(t, as_of)), models, scores, as_of)


def score_and_merge(everyone: DataFrame, models: S.Models, scores: DataFrame, as_of: date
                    ) -> tuple[DataFrame, DataFrame]:
    members, credits = S.member_features(everyone, as_of), S.credit_features(everyone, as_of)
    merged = K.merge_scores(scores, score_people(members, credits, models), as_of)
    return merged, K.changed_tiers(merged, as_of)


# --- rule-based segments ----------------------------------------------------------------------------------------------


def rule_segment() -> Column:
    """Segment of a customer-details row by its own scores, without a model."""
    statuses = X.status_set(F.col("membership_status"))
    lapsing = F.col("retention_segment").isin("Lapsing", "Lost")
    active = F.array_contains(statuses, "active")
    recency = F.coalesce("recency_score", F.lit(0))  # a missing score counts as 0, a missing credit count as unknown
    frequency, credits = F.col("frequency_score"), F.col("remaining_credits")
    attendance = (
        F.when(F.array_contains(statuses, "frozen"), "excluded_frozen")
        .when(F.array_contains(statuses, "payment_failure"), "excluded_payment_failure")
        .when((recency <= 2) & lapsing, "attendance_critical")
        .when(recency == 3, "attendance_watch")
        .otherwise("attendance_ok")
    )
    credit = (
        F.when((frequency >= 2) & (credits == 0) & lapsing, "credit_critical")
        .when((frequency >= 2) & credits.between(1, 2) & (F.col("retention_segment") == "Lapsing"), "credit_watch")
        .otherwise("no_membership")
    )
    return F.when(active, attendance).when(F.size(statuses) == 0, credit).otherwise("other")


def rule_segments(details: DataFrame) -> DataFrame:
    return details.withColumn("segment", rule_segment())


def segment_counts(details: DataFrame) -> DataFrame:
    """Customers per segment; ``no_membership`` counts everyone without a membership, flagged or not."""
    per = rule_segments(details).groupBy("segment").agg(F.count(F.lit(1)).alias("n"))
    pool = F.when(F.col("segment").isin("credit_critical", "credit_watch", "no_membership"), F.lit("no_membership"))
    named = F.array_distinct(F.array_compact(F.array(F.col("segment"), pool)))
    return per.select(F.explode(named).alias("segment"), "n").groupBy("segment").agg(F.sum("n").alias("n"))


def segment_samples(details: DataFrame, critical: int = 10, watch: int = 5) -> DataFrame:
    """The first customers per flagged segment by id: ten critical ones, five on watch."""
    from pyspark.sql.window import Window

    flagged = rule_segments(details).where(F.col("segment").rlike("_(critical|watch)$"))
    pos = F.row_number().over(Window.partitionBy("segment").orderBy("customer_id"))
    limit = F.when(F.col("segment").endswith("_critical"), critical).otherwise(watch)
    ranked = flagged.withColumn("pos", pos).where(F.col("pos") <= max(critical, watch))
    return ranked.where(F.col("pos") <= limit)
