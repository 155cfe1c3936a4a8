"""Churn features, signals, tiers and model scoring."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rosterlake.functions import dates as D
from rosterlake.operators import activity as A
from rosterlake.operators.filters import credit_population, in_credit_population, reachable
from rosterlake.session import checkpoint_dir

# Tier thresholds per population and the days a credit pack lasts.
THRESHOLDS = {"membership": (0.55, 0.35), "credit": (0.53, 0.35)}
CREDIT_DAYS = 28
UNCAPPED_RATE = 7.0

MEMBERSHIP_INPUTS = ("gap_days", "visit_count", "visits_trailing60", "visits_prior60", "freq_ratio",
                     "is_single_visit", "attendance_ratio", "month_sin", "month_cos")
CREDIT_INPUTS = ("gap_days", "visit_count", "last_pack_size", "days_since_credit_purchase", "credits_remaining_est",
                 "credits_expired", "expired_with_unused_credits", "days_until_expiry_est", "is_downgrade")
RETURN_INPUTS = ("gap_days", "visits_trailing60", "visits_prior60", "freq_ratio", "is_single_visit", "month_sin",
                 "month_cos")


def candidates(history: DataFrame, profile: DataFrame, as_of: date) -> DataFrame:
    """People with visits and purchases who were seen recently, with category, gap and the last relevant purchase.

    Both inputs are grouped by e-mail already, so the join needs no further shuffle.
    """
    c = profile.select(
        "email", "latest", "ever_member", "last_credit_purchase_date",
        F.col("plan.d").alias("plan_date"), F.col("plan.weekly_rate").alias("plan_weekly_rate"),
        A.active_category(F.col("plan.d"), F.col("plan.plan_days"), F.col("last_credit_purchase_date"), as_of)
        .alias("category"),
    )
    people = history.withColumn("last_visit_date", F.get("days", F.lit(0)))
    joined = reachable(people, as_of).join(c, "email")
    return joined.select(
        "email", "last_visit_date", "days",
        A.visit_gap(F.col("last_visit_date"), F.get("days", F.lit(1))).alias("gap_days"),
        F.datediff(F.lit(as_of), "last_visit_date").alias("days_since_last_visit"),
        F.size("days").alias("visit_count"), "category",
        F.when(F.col("category") == "membership", F.col("plan_date")).otherwise(F.col("last_credit_purchase_date"))
        .alias("last_purchase_date"),
        "plan_weekly_rate", F.col("latest.pack_size").alias("last_pack_size"),
        F.col("latest.first_name").alias("first_name"), F.col("latest.last_name").alias("last_name"),
        F.col("latest.booking_customer_id").alias("booking_customer_id"), "ever_member",
    )


def attendance_ratios(df: DataFrame) -> DataFrame:
    """Visits against the prior period, and against what the plan implies; null where there is nothing to divide by."""
    expected = F.coalesce(F.col("plan_weekly_rate"), F.lit(UNCAPPED_RATE)) * 60 / 7
    return df.withColumns({
        "freq_ratio": F.try_divide(F.col("visits_trailing60"), F.nullif(F.col("visits_prior60"), F.lit(0))),
        "attendance_ratio": F.try_divide(F.col("visits_trailing60"), expected),
    })


def with_member_columns(people: DataFrame, as_of: date) -> DataFrame:
    """Visits in the last and the prior 60 days, the ratios made of them, and the month as a point on a circle."""
    today = F.lit(as_of)
    month_sin, month_cos = D.month_cycle(today)
    asof_sin, asof_cos = D.month_cycle(F.col("last_visit_date"))
    days = F.col("days")
    return attendance_ratios(people.withColumns({
        "visits_trailing60": A.count_between(days, F.date_sub(today, 60), today),
        "visits_prior60": A.count_between(days, F.date_sub(today, 120), F.date_sub(today, 61)),
        "is_single_visit": F.col("visit_count") == 1,
        "month_sin": month_sin, "month_cos": month_cos, "asof_month_sin": asof_sin, "asof_month_cos": asof_cos,
    }))


def with_credit_columns(people: DataFrame, as_of: date) -> DataFrame:
    """What is left of the last pack, and when it runs out."""
    since = F.datediff(F.lit(as_of), "last_purchase_date")
    used = A.count_between(F.col("days"), F.col("last_purchase_date"), F.lit(as_of))
    left = F.greatest(F.col("last_pack_size") - used, F.lit(0))
    return people.withColumns({
        "visits_since_purchase": used,
        "days_since_credit_purchase": since,
        "credits_remaining_est": left,
        "credits_expired": since > CREDIT_DAYS,
        "expired_with_unused_credits": (left > 0) & (since > CREDIT_DAYS),
        "days_until_expiry_est": F.greatest(CREDIT_DAYS - since, F.lit(-999)),
        "is_downgrade": F.col("ever_member"),
    })


def member_features(people: DataFrame, as_of: date) -> DataFrame:
    return with_member_columns(people.where(F.col("category") == "membership"), as_of)


def credit_features(people: DataFrame, as_of: date) -> DataFrame:
    """Credit customers who bought recently."""
    return with_credit_columns(credit_population(people, as_of), as_of)


def both_features(people: DataFrame, as_of: date) -> DataFrame:
    """Members and recent credit customers in one frame with the columns of both: one pass over the people."""
    in_scope = (F.col("category") == "membership") | in_credit_population(as_of)
    return with_credit_columns(with_member_columns(people.where(in_scope), as_of), as_of)


def membership_signal() -> Column:
    """Why a member is listed. An undefined ratio counts as -1 here too, as it does for the model, so a member
    without visits in the prior period reads as declining."""
    return (
        F.when(F.col("gap_days") >= 30, F.concat(F.lit("No visits in "), F.col("gap_days").cast("string"), F.lit(" days")))
        .when(F.coalesce(F.col("freq_ratio"), F.lit(-1.0)) < 0.6, "Visit frequency declining vs. prior period")
        .when(F.col("is_single_visit"), "Only ever visited once")
        .otherwise("Attendance pattern")
    )


def credit_signal() -> Column:
    left = F.col("days_until_expiry_est")
    return (
        F.when(F.col("expired_with_unused_credits"), "Credits expired unused")
        .when(~F.col("credits_expired") & (F.col("credits_remaining_est") > 0) & left.between(0, 10),
              F.concat(F.lit("Unused credits expiring in "), left.cast("string"), F.lit(" days")))
        .when(F.col("gap_days") >= 30, F.concat(F.lit("No visits in "), F.col("gap_days").cast("string"), F.lit(" days")))
        .otherwise("Attendance pattern")
    )


def tier(prob: Column, critical: float, watch: float) -> Column:
    return F.when(prob >= critical, "Critical").when(prob >= watch, "Watch").otherwise("OK")


def tier_of(population: str, prob: Column) -> Column:
    return tier(prob, *THRESHOLDS[population])


def tier_counts(scores: DataFrame) -> DataFrame:
    return scores.groupBy("population", "tier").agg(F.count(F.lit(1)).alias("n"))


#: Weight of the penalty on standardised coefficients.
REGULARIZATION = 0.01

# --- models ---------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Models:
    """The three stored classifiers of a scoring run."""

    membership: PipelineModel
    credit: PipelineModel
    permanence: PipelineModel


def model_inputs(df: DataFrame, inputs: tuple[str, ...]) -> DataFrame:
    """Model columns as doubles; an undefined ratio goes in as -1."""
    return df.withColumns({f"in_{c}": F.coalesce(F.col(c).cast("double"), F.lit(-1.0)) for c in inputs})


def fit_churn(training: DataFrame, inputs: tuple[str, ...], label: str = "label") -> PipelineModel:
    """A logistic regression over the feature columns; gradients are summed on executors. It is fitted until it stands still:
    what is scored then does not depend on where the steps began."""
    assembler = VectorAssembler(inputCols=[f"in_{c}" for c in inputs], outputCol="features")
    # the regression is fitted with treeAggregate, so the driver holds only one gradient of the width of the inputs
    fit = LogisticRegression(featuresCol="features", labelCol=label, maxIter=200, tol=1e-9, regParam=REGULARIZATION)
    return without_summary(Pipeline(stages=[assembler, fit]).fit(model_inputs(training, inputs)), training.sparkSession)


def without_summary(model: PipelineModel, spark: SparkSession) -> PipelineModel:
    """The model as it reads back once stored. A fresh one carries a summary that holds on to its session, and a session that
    has observed a count cannot be sent to executors."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/model-{uuid.uuid4().hex}"
    model.write().save(path)
    return PipelineModel.load(path)


def split_by_time(df: DataFrame, at: str, share: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Rows up to the day by which ``share`` of them have come, and the later ones: a model is judged on days it has not seen.
    The day is read off the counts of days, one row each; rows without a day are in neither part."""
    days = df.where(F.col(at).isNotNull()).groupBy(F.col(at).alias("day")).agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.orderBy("day"))
    total = days.agg(F.sum("n")).first()[0] or 0
    cut = days.withColumn("upto", upto).where(F.col("upto") >= share * total).agg(F.min("day")).first()[0]
    return df.where(F.col(at) <= F.lit(cut)), df.where(F.col(at) > F.lit(cut))


def calibrate(scored: DataFrame, prob: str = "churn_prob", label: str = "label", precision: float = 0.6, recall: float = 0.8, bins: int = 1_000
              ) -> tuple[float, float]:
    """Thresholds of the two risk tiers from held-out rows: the smallest probability from which on at least ``precision`` of the
    rows have the label (critical), and the largest, not above it, from which on at least ``recall`` of all labelled rows are
    (watch). Probabilities are counted in ``bins``, so the counts are as many whatever the number of rows."""
    at = F.least(F.floor(F.col(prob) * bins), F.lit(bins - 1)).cast("int")
    counts = {r["bin"]: (r["n"], r["hits"]) for r in scored.where(F.col(prob).isNotNull()).groupBy(at.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(label) == 1).alias("hits")).collect()}  # a row a bin
    total = sum(h for _, h in counts.values())
    critical, watch, n, hits = 1.0, None, 0, 0
    for b in range(bins - 1, -1, -1):
        more, own = counts.get(b, (0, 0))
        n, hits = n + more, hits + own
        if more and hits >= precision * n:
            critical = b / bins
        if watch is None and total and hits >= recall * total:
            watch = b / bins
    return critical, min(critical, watch if watch is not None else critical)


def save_models(models: Models, folder: str) -> None:
    """Store the three classifiers, one folder each; earlier ones are replaced."""
    for name in ("membership", "credit", "permanence"):
        getattr(models, name).write().overwrite().save(f"{folder.rstrip('/')}/{name}")


def load_models(folder: str) -> Models:
    return Models(*[PipelineModel.load(f"{folder.rstrip('/')}/{name}") for name in ("membership", "credit", "permanence")])


def prob_of(df: DataFrame, label: int = 1, name: str = "churn_prob") -> DataFrame:
    """Probability of one label as a plain column; the vectors of the model are dropped."""
    out = df.withColumn(name, F.get(vector_to_array("probability"), F.lit(label)))
    return out.drop("probability", "rawPrediction", "features", "prediction")


def score(df: DataFrame, model: PipelineModel, inputs: tuple[str, ...], name: str = "churn_prob") -> DataFrame:
    """Rows with the probability of label 1; all other columns pass through."""
    scored = prob_of(model.transform(model_inputs(df, inputs)), 1, name)
    return scored.drop(*[f"in_{c}" for c in inputs])


def score_return(members: DataFrame, model: PipelineModel) -> DataFrame:
    """``likely_permanent_prob``: the probability that the gap is permanent; all other columns pass through. The month is
    the one of the last visit, and the two visit counts go in as 0: what this model reads is season and gap."""
    kept = ["visits_trailing60", "visits_prior60", "month_sin", "month_cos"]
    swapped = members.withColumns({f"_kept_{c}": F.col(c) for c in kept}).withColumns({
        "visits_trailing60": F.lit(0), "visits_prior60": F.lit(0),
        "month_sin": F.col("asof_month_sin"), "month_cos": F.col("asof_month_cos"),
    })
    out = score(swapped, model, RETURN_INPUTS, "likely_permanent_prob")
    return out.withColumns({c: F.col(f"_kept_{c}") for c in kept}).drop(*[f"_kept_{c}" for c in kept])
