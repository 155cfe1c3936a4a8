"""Purchases, visits, churn features, scoring, and rule segments."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import Matrices, Vectors
from pyspark.sql import functions as F

from rosterlake import specs
from rosterlake.catalog.base import SALES_DAY, Tables, d_email, d_float, d_us, query
from rosterlake.catalog.scalars import LEGACY_CATEGORY_SQL, PACK_SQL, PLAN_DAYS_SQL, RATE_SQL
from rosterlake.operators import activity as A
from rosterlake.operators import filters as P
from rosterlake.operators import scoring as S
from rosterlake.plans import churn as C
from rosterlake.plans.lifecycle import count_by
from rosterlake.session import cut_lineage

AS_OF = f"DATE '{SALES_DAY}'"
RESERVATIONS = specs.RESERVATIONS_TYPED
PV = ("legacy_sales", "legacy_customers", "recent_sales")
VV = ("legacy_reservations", "recent_reservations")


def typed_reservations(t: Tables):
    """New-system reservations in the typed layout."""
    cells = specs.RESERVATIONS_TEXT.names
    return t.recent_reservations.select(*[RESERVATIONS.cell(i, F.col(c)) for i, c in enumerate(cells)])


def tables(t: Tables) -> C.ChurnTables:
    return C.ChurnTables(t.legacy_sales, t.legacy_customers, t.legacy_reservations, t.recent_sales, typed_reservations(t))


def purchases(t: Tables):
    return A.all_purchases(A.legacy_purchases(t.legacy_sales, t.legacy_customers), A.new_purchases(t.recent_sales))


def profile(t: Tables):
    return A.purchase_profile(A.either_purchases(A.legacy_purchases(t.legacy_sales, t.legacy_customers), A.new_purchases(t.recent_sales, dated=False)))


def visits(t: Tables):
    return A.all_visits(t.legacy_reservations, typed_reservations(t))


CTES = {
    "e1": f"""SELECT {d_email('c.emailaddress')} AS email, s.d, coalesce(s.revenue, 0) AS rev, {LEGACY_CATEGORY_SQL} AS category,
        coalesce({PACK_SQL}, 1) AS pack_size, c.first_name, c.last_name, cast(NULL AS varchar) AS booking_customer_id, item
      FROM legacy_sales AS s LEFT JOIN legacy_customers AS c ON cast(s.customer_id AS varchar) = c.id
      WHERE s.type = 'series' AND {d_email('c.emailaddress')} <> '' AND s.d IS NOT NULL""",
    "e2": f"""SELECT {d_email('customer_email')} AS email, {d_us('transaction_date')} AS d,
        coalesce({d_float('line_total')}, 0) AS rev,
        CASE product_type WHEN 'Memberships' THEN 'membership' ELSE 'credit' END AS category,
        coalesce(try_cast(line_quantity AS bigint), 1) AS pack_size, customer_name AS first_name,
        cast(NULL AS varchar) AS last_name, customer_id AS booking_customer_id, product AS item
      FROM recent_sales WHERE product_type IN ('Memberships', 'Credits') AND {d_email('customer_email')} <> ''
        AND {d_us('transaction_date')} IS NOT NULL""",
    "purchases": f"""SELECT *, CASE WHEN category = 'membership' THEN {PLAN_DAYS_SQL} END AS plan_days,
        CASE WHEN category = 'membership' THEN {RATE_SQL} END AS weekly_rate
      FROM (SELECT * FROM e1 UNION ALL SELECT * FROM e2) AS u""",
    "activity": f"""SELECT {d_email('emailaddress')} AS email, cast(class_date AS date) AS d FROM legacy_reservations
      UNION ALL SELECT {d_email('customer_email')}, cast(class_start_date AS date) FROM recent_reservations""",
    "days": "SELECT DISTINCT email, d FROM activity WHERE email <> '' AND d IS NOT NULL",
    "last_visit": """SELECT email, max(d) AS last_visit_date, count(*) AS visit_count,
        list(d ORDER BY d DESC)[2] AS previous FROM days GROUP BY email""",
    "latest_purchase": """SELECT * FROM purchases QUALIFY row_number() OVER (PARTITION BY email ORDER BY d DESC, rev DESC,
        item DESC, pack_size DESC, first_name DESC NULLS LAST, last_name DESC NULLS LAST, booking_customer_id DESC NULLS LAST) = 1""",
    "latest_membership": """SELECT * FROM purchases WHERE category = 'membership' QUALIFY row_number() OVER (PARTITION BY email
        ORDER BY d DESC, rev DESC, item DESC, pack_size DESC, first_name DESC NULLS LAST, last_name DESC NULLS LAST,
        booking_customer_id DESC NULLS LAST) = 1""",
    "latest_credit": "SELECT email, max(d) AS d FROM purchases WHERE category = 'credit' GROUP BY email",
    "calc": f"""SELECT lv.email, CASE WHEN lm.d + cast(lm.plan_days + 7 AS integer) >= {AS_OF} THEN 'membership'
        WHEN lc.d IS NOT NULL THEN 'credit' WHEN lm.d IS NOT NULL THEN 'membership' END AS category,
        lm.weekly_rate AS plan_weekly_rate, lm.d AS last_membership, lc.d AS last_credit
      FROM last_visit AS lv LEFT JOIN latest_membership AS lm USING (email) LEFT JOIN latest_credit AS lc USING (email)""",
    "candidates": f"""SELECT lv.email, lv.last_visit_date, coalesce(date_diff('day', lv.previous, lv.last_visit_date), 999) AS gap_days,
        lv.visit_count, c.category, CASE WHEN c.category = 'membership' THEN last_membership ELSE last_credit END AS last_purchase_date,
        c.plan_weekly_rate, p.pack_size AS last_pack_size, p.first_name, p.last_name, p.booking_customer_id
      FROM last_visit AS lv JOIN calc AS c USING (email) JOIN latest_purchase AS p USING (email)
      WHERE lv.last_visit_date BETWEEN {AS_OF} - 180 AND {AS_OF}""",
    "freq": f"""SELECT c.email, count(*) FILTER (WHERE a.d BETWEEN {AS_OF} - 60 AND {AS_OF}) AS visits_trailing60,
        count(*) FILTER (WHERE a.d BETWEEN {AS_OF} - 120 AND {AS_OF} - 61) AS visits_prior60
      FROM candidates AS c LEFT JOIN days AS a USING (email) WHERE c.category = 'membership' GROUP BY c.email""",
    "members": f"""SELECT c.*, f.visits_trailing60, f.visits_prior60,
        f.visits_trailing60 / nullif(f.visits_prior60, 0) AS freq_ratio, c.visit_count = 1 AS is_single_visit,
        f.visits_trailing60 / (coalesce(c.plan_weekly_rate, 7.0::double) * 60 / 7) AS attendance_ratio,
        sin(2 * acos(-1.0) * month({AS_OF}) / 12) AS month_sin, cos(2 * acos(-1.0) * month({AS_OF}) / 12) AS month_cos,
        sin(2 * acos(-1.0) * month(c.last_visit_date) / 12) AS asof_month_sin,
        cos(2 * acos(-1.0) * month(c.last_visit_date) / 12) AS asof_month_cos
      FROM candidates AS c JOIN freq AS f USING (email) WHERE c.category = 'membership'""",
    "used": f"""SELECT c.email, count(DISTINCT a.d) AS visits_since_purchase FROM candidates AS c LEFT JOIN days AS a
        ON a.email = c.email AND a.d BETWEEN c.last_purchase_date AND {AS_OF} WHERE c.category = 'credit'
        AND c.last_purchase_date >= {AS_OF} - 90 GROUP BY c.email""",
    "credits_f": f"""SELECT c.*, u.visits_since_purchase, date_diff('day', c.last_purchase_date, {AS_OF}) AS days_since_credit_purchase,
        greatest(c.last_pack_size - u.visits_since_purchase, 0) AS credits_remaining_est,
        date_diff('day', c.last_purchase_date, {AS_OF}) > 28 AS credits_expired,
        greatest(c.last_pack_size - u.visits_since_purchase, 0) > 0 AND date_diff('day', c.last_purchase_date, {AS_OF}) > 28
          AS expired_with_unused_credits,
        greatest(28 - date_diff('day', c.last_purchase_date, {AS_OF}), -999) AS days_until_expiry_est,
        c.email IN (SELECT email FROM purchases WHERE category = 'membership') AS is_downgrade
      FROM candidates AS c JOIN used AS u USING (email)""",
}
ALL = PV + VV


def upto(name: str) -> dict[str, str]:
    """The definitions up to and including one."""
    names = list(CTES)
    return {n: CTES[n] for n in names[:names.index(name) + 1]}


@query("j01_sales_with_customer", ("legacy_sales", "legacy_customers"), """
  SELECT s.item, c.first_name, c.last_name, count(*) AS n FROM legacy_sales AS s
  LEFT JOIN legacy_customers AS c ON cast(s.customer_id AS varchar) = c.id GROUP BY ALL""")
def _j01(t):
    return count_by(A.sales_with_customer(t.legacy_sales, t.legacy_customers), "item", "first_name", "last_name")


@query("u01_all_purchases", PV, """
  SELECT email, category, plan_days, round(weekly_rate, 6) AS weekly_rate, count(*) AS n, cast(sum(pack_size) AS bigint) AS packs,
    cast(min(d) AS varchar) AS first_day, cast(max(d) AS varchar) AS last_day, round(max(rev), 6) AS top
  FROM purchases GROUP BY email, category, plan_days, weekly_rate""", {n: CTES[n] for n in ("e1", "e2", "purchases")})
def _u01(t):
    return purchases(t).groupBy("email", "category", "plan_days", "weekly_rate").agg(
        F.count(F.lit(1)).alias("n"), F.sum("pack_size").alias("packs"), F.min("d").alias("first_day"),
        F.max("d").alias("last_day"), F.max("rev").alias("top"))


_A = {n: CTES[n] for n in ("activity", "days", "last_visit")}


@query("u02_all_visits", VV, """
  SELECT email, count(*) AS n FROM activity WHERE email <> '' AND d IS NOT NULL GROUP BY 1""", {"activity": CTES["activity"]})
def _u02(t):
    return count_by(visits(t), "email")


@query("u03_visit_days", VV, "SELECT email, cast(d AS varchar) AS d FROM days", {n: CTES[n] for n in ("activity", "days")})
def _u03(t):
    return A.visit_days(visits(t))


@query("a09_last_two_w04_visit_gap", VV, """
  SELECT email, cast(last_visit_date AS varchar) AS last_visit_date, cast(previous AS varchar) AS previous_visit_date,
    coalesce(date_diff('day', previous, last_visit_date), 999) AS gap_days FROM last_visit""", _A)
def _a09(t):
    two = A.last_two(A.visit_history(visits(t)))
    return two.withColumn("gap_days", A.visit_gap(F.col("last_visit_date"), F.col("previous_visit_date")))


@query("a03_visit_counts", VV, "SELECT email, visit_count FROM last_visit", _A)
def _a03(t):
    return A.visit_counts(A.visit_history(visits(t)))


@query("a06_visit_windows", VV, f"""
  SELECT email, count(*) FILTER (WHERE d BETWEEN {AS_OF} - 60 AND {AS_OF}) AS visits_trailing60,
    count(*) FILTER (WHERE d BETWEEN {AS_OF} - 120 AND {AS_OF} - 61) AS visits_prior60 FROM days GROUP BY email""", _A)
def _a06(t):
    return A.visit_windows(A.visit_history(visits(t)), SALES_DAY)


_P = {n: CTES[n] for n in ("e1", "e2", "purchases", "latest_purchase", "latest_membership", "latest_credit")}


@query("a08_a10_purchase_profile", PV, """
  SELECT p.email, cast(p.d AS varchar) AS last_purchase, p.category, p.pack_size, round(p.rev, 6) AS rev, p.first_name,
    p.booking_customer_id, cast(m.d AS varchar) AS plan_date, m.plan_days, round(m.weekly_rate, 6) AS weekly_rate,
    cast(c.d AS varchar) AS last_credit_purchase_date, m.email IS NOT NULL AS ever_member
  FROM latest_purchase AS p LEFT JOIN latest_membership AS m USING (email) LEFT JOIN latest_credit AS c USING (email)""", _P)
def _a08(t):
    p = profile(t)
    return p.select("email", F.col("latest.d").alias("last_purchase"), "latest.category", "latest.pack_size", "latest.rev",
                    "latest.first_name", "latest.booking_customer_id", F.col("plan.d").alias("plan_date"), "plan.plan_days",
                    "plan.weekly_rate", "last_credit_purchase_date", "ever_member")


@query("f20_active_category_j03", ALL, """
  SELECT email, category, cast(last_membership AS varchar) AS plan_date, cast(last_credit AS varchar) AS last_credit FROM calc""",
       upto("calc"))
def _f20(t):
    h, p = A.visit_history(visits(t)).select("email"), profile(t)
    joined = h.join(p, "email", "left")
    return joined.select("email", A.active_category(F.col("plan.d"), F.col("plan.plan_days"),
                                                    F.col("last_credit_purchase_date"), SALES_DAY).alias("category"),
                         F.col("plan.d").alias("plan_date"), F.col("last_credit_purchase_date").alias("last_credit"))


@query("j02_p10_candidates", ALL, """
  SELECT email, cast(last_visit_date AS varchar) AS last_visit_date, gap_days, visit_count, category,
    cast(last_purchase_date AS varchar) AS last_purchase_date, round(plan_weekly_rate, 6) AS plan_weekly_rate, last_pack_size,
    first_name, last_name, booking_customer_id FROM candidates""", upto("candidates"))
def _j02(t):
    return C.people(tables(t), SALES_DAY).select(
        "email", "last_visit_date", "gap_days", "visit_count", "category", "last_purchase_date", "plan_weekly_rate",
        "last_pack_size", "first_name", "last_name", "booking_customer_id")


@query("p11_credit_population", ALL, f"""
  SELECT email, cast(last_purchase_date AS varchar) AS last_purchase_date FROM candidates
  WHERE category = 'credit' AND last_purchase_date >= {AS_OF} - 90""", upto("candidates"))
def _p11(t):
    return P.credit_population(C.people(tables(t), SALES_DAY), SALES_DAY).select("email", "last_purchase_date")


@query("j07_visits_since_purchase", ALL, f"""
  SELECT c.email, count(DISTINCT a.d) AS visits_since_purchase FROM candidates AS c LEFT JOIN days AS a
    ON a.email = c.email AND a.d BETWEEN c.last_purchase_date AND {AS_OF} GROUP BY c.email""", upto("candidates"))
def _j07(t):
    history = A.visit_history(visits(t))
    population = S.candidates(history, profile(t), SALES_DAY)
    return A.visits_since(population, history, SALES_DAY)


@query("j15_downgrade_flag", PV, """
  SELECT email, email IN (SELECT email FROM purchases WHERE category = 'membership') AS is_downgrade
  FROM (SELECT DISTINCT email FROM purchases) AS p""", {n: CTES[n] for n in ("e1", "e2", "purchases")})
def _j15(t):
    p = purchases(t)
    return A.downgrade_flag(p.select("email").distinct(), p)


MEMBER_SIGNAL = """CASE WHEN gap_days >= 30 THEN 'No visits in ' || cast(gap_days AS varchar) || ' days'
    WHEN coalesce(freq_ratio, -1) < 0.6 THEN 'Visit frequency declining vs. prior period'
    WHEN is_single_visit THEN 'Only ever visited once' ELSE 'Attendance pattern' END"""
CREDIT_SIGNAL = """CASE WHEN expired_with_unused_credits THEN 'Credits expired unused'
    WHEN NOT credits_expired AND credits_remaining_est > 0 AND days_until_expiry_est BETWEEN 0 AND 10
      THEN 'Unused credits expiring in ' || cast(days_until_expiry_est AS varchar) || ' days'
    WHEN gap_days >= 30 THEN 'No visits in ' || cast(gap_days AS varchar) || ' days' ELSE 'Attendance pattern' END"""


@query("f21_f22_f24_member_features", ALL, f"""
  SELECT email, gap_days, visit_count, visits_trailing60, visits_prior60, round(freq_ratio, 6) AS freq_ratio, is_single_visit,
    round(attendance_ratio, 6) AS attendance_ratio, round(month_sin, 6) AS month_sin, round(month_cos, 6) AS month_cos,
    round(asof_month_sin, 6) AS asof_month_sin, round(asof_month_cos, 6) AS asof_month_cos, {MEMBER_SIGNAL} AS key_signal
  FROM members""", upto("members"))
def _members(t):
    m = C.churn_features(tables(t), SALES_DAY)[0]
    return m.select("email", "gap_days", "visit_count", "visits_trailing60", "visits_prior60", "freq_ratio", "is_single_visit",
                    "attendance_ratio", "month_sin", "month_cos", "asof_month_sin", "asof_month_cos",
                    S.membership_signal().alias("key_signal"))


@query("f23_f24_credit_features", ALL, f"""
  SELECT email, gap_days, visit_count, last_pack_size, visits_since_purchase, days_since_credit_purchase,
    cast(credits_remaining_est AS bigint) AS credits_remaining_est, credits_expired, expired_with_unused_credits,
    days_until_expiry_est, is_downgrade, {CREDIT_SIGNAL} AS key_signal FROM credits_f""", upto("credits_f"))
def _credit_features(t):
    c = C.churn_features(tables(t), SALES_DAY)[1]
    return c.select("email", "gap_days", "visit_count", "last_pack_size", "visits_since_purchase",
                    "days_since_credit_purchase", "credits_remaining_est", "credits_expired", "expired_with_unused_credits",
                    "days_until_expiry_est", "is_downgrade", S.credit_signal().alias("key_signal"))


def flagship(t: Tables):
    """Features of both populations with a transparent risk number, its tier and the signal text; one pass."""
    both = S.both_features(C.people(tables(t), SALES_DAY), SALES_DAY)
    risk = F.least(F.col("gap_days"), F.lit(100)) / 100
    member = F.col("category") == "membership"
    return both.select(
        "email", F.col("category").alias("population"), "last_visit_date", "days_since_last_visit", "gap_days",
        "visit_count", risk.alias("risk"),
        F.when(member, S.tier_of("membership", risk)).otherwise(S.tier_of("credit", risk)).alias("tier"),
        F.when(member, S.membership_signal()).otherwise(S.credit_signal()).alias("key_signal"))


def _tier_sql(critical: str) -> str:
    return f"""CASE WHEN least(gap_days, 100) / 100 >= {critical} THEN 'Critical' WHEN least(gap_days, 100) / 100 >= 0.35::double
      THEN 'Watch' ELSE 'OK' END"""


def _flag_sql(source: str, population: str, critical: str, signal: str) -> str:
    return f"""SELECT email, '{population}' AS population, cast(last_visit_date AS varchar) AS last_visit_date,
      date_diff('day', last_visit_date, {AS_OF}) AS days_since_last_visit, gap_days, visit_count,
      round(least(gap_days, 100) / 100, 6) AS risk, {_tier_sql(critical)} AS tier, {signal} AS key_signal FROM {source}"""


query("c05_churn_features_with_tiers", ALL,
      _flag_sql("members", "membership", "0.55::double", MEMBER_SIGNAL) + " UNION ALL "
      + _flag_sql("credits_f", "credit", "0.53::double", CREDIT_SIGNAL), CTES)(flagship)


# --- models ---------------------------------------------------------------------------------------------------------


def fitted(everyone) -> S.Models:
    """Classifiers trained on the rows themselves: a long gap is the label."""
    late = (F.col("days_since_last_visit") > 60).cast("double")
    stay = (F.col("gap_days") > 90).cast("double")
    members, credits = S.member_features(everyone, SALES_DAY), S.credit_features(everyone, SALES_DAY)
    swapped = members.withColumns({"month_sin": F.col("asof_month_sin"), "month_cos": F.col("asof_month_cos")})
    return S.Models(
        S.fit_churn(members.withColumn("label", late), S.MEMBERSHIP_INPUTS),
        S.fit_churn(credits.withColumn("label", late), S.CREDIT_INPUTS),
        S.fit_churn(swapped.withColumn("label", stay), S.RETURN_INPUTS),
    )


#: Coefficients that the scoring is checked with, by input, and the intercept.
MEMBER_WEIGHTS = ((0.01, -0.02, -0.3, -0.1, -0.4, 0.5, -0.6, 0.2, -0.2), 0.7)
CREDIT_WEIGHTS = ((0.008, -0.03, -0.05, 0.02, 0.04, 0.3, 0.2, -0.01, 0.6), -1.1)
RETURN_WEIGHTS = ((0.02, 0.5, 0.5, -0.3, 0.4, 0.6, -0.5), -2.0)


def _known(spark, inputs: tuple[str, ...], weights: tuple[tuple[float, ...], float]) -> PipelineModel:
    """A classifier with given coefficients: a fit whose bounds leave one answer."""
    rows = spark.createDataFrame([(float(i % 2), *[float(i * (k + 2) % 11) for k in range(len(inputs))]) for i in range(64)],
                                 ", ".join(["label double", *[f"in_{c} double" for c in inputs]]))
    only, base = Matrices.dense(1, len(inputs), list(weights[0])), Vectors.dense([weights[1]])
    fit = LogisticRegression(maxIter=5, standardization=False, lowerBoundsOnCoefficients=only, upperBoundsOnCoefficients=only,
                             lowerBoundsOnIntercepts=base, upperBoundsOnIntercepts=base)
    return S.without_summary(Pipeline(stages=[VectorAssembler(inputCols=[f"in_{c}" for c in inputs], outputCol="features"), fit]).fit(rows), spark)


def known(spark) -> S.Models:
    return S.Models(_known(spark, S.MEMBERSHIP_INPUTS, MEMBER_WEIGHTS), _known(spark, S.CREDIT_INPUTS, CREDIT_WEIGHTS),
                    _known(spark, S.RETURN_INPUTS, RETURN_WEIGHTS))


def _logistic(inputs: tuple[str, ...], weights: tuple[tuple[float, ...], float], **instead: str) -> str:
    parts = [f"{w!r}::double * coalesce(cast({instead.get(c, c)} AS double), -1)" for c, w in zip(inputs, weights[0])]
    return f"1 / (1 + exp(-({weights[1]!r}::double + {' + '.join(parts)})))"


_STAY = dict(visits_trailing60="0", visits_prior60="0", month_sin="asof_month_sin", month_cos="asof_month_cos")


def _tiered(population: str) -> str:
    critical, watch = S.THRESHOLDS[population]
    return f"CASE WHEN p >= {critical}::double THEN 'Critical' WHEN p >= {watch}::double THEN 'Watch' ELSE 'OK' END"


SCORED = {
    **CTES,
    "member_p": f"""SELECT email, {_logistic(S.MEMBERSHIP_INPUTS, MEMBER_WEIGHTS)} AS p,
        {_logistic(S.RETURN_INPUTS, RETURN_WEIGHTS, **_STAY)} AS stay FROM members""",
    "credit_p": f"SELECT email, {_logistic(S.CREDIT_INPUTS, CREDIT_WEIGHTS)} AS p FROM credits_f",
    "batch": f"""SELECT email, 'membership' AS population, p, stay, {_tiered('membership')} AS tier FROM member_p
        UNION ALL SELECT email, 'credit', p, NULL, {_tiered('credit')} FROM credit_p""",
}
_LEVEL = "CASE {} WHEN 'OK' THEN 0 WHEN 'Watch' THEN 1 WHEN 'Critical' THEN 2 END"


def _everyone(t):
    return cut_lineage(C.people(tables(t), SALES_DAY))


@query("m04_fit_and_score")
def _fit(t):
    everyone = _everyone(t)
    models = fitted(everyone)
    return C.score_people(S.member_features(everyone, SALES_DAY), S.credit_features(everyone, SALES_DAY), models)


@query("m01_m02_score", ALL, """
  SELECT email, population, round(p, 6) AS churn_prob, round(stay, 6) AS likely_permanent_prob, tier FROM batch""", SCORED)
def _score(t):
    everyone = _everyone(t)
    batch = C.score_people(S.member_features(everyone, SALES_DAY), S.credit_features(everyone, SALES_DAY), known(t.spark))
    named = batch.withColumn("tier", F.when(F.col("population") == "membership", S.tier_of("membership", F.col("churn_prob")))
                             .otherwise(S.tier_of("credit", F.col("churn_prob"))))
    return named.select("email", "population", "churn_prob", "likely_permanent_prob", "tier")


@query("m03_score_return", ALL, "SELECT email, round(stay, 6) AS likely_permanent_prob FROM member_p", SCORED)
def _score_return(t):
    scored = S.score_return(S.member_features(_everyone(t), SALES_DAY), known(t.spark).permanence)
    return scored.select("email", "likely_permanent_prob")


@query("c05_churn_scoring", (*ALL, "scores"), f"""
  SELECT b.email, b.population, round(b.p, 6) AS churn_prob, round(b.stay, 6) AS likely_permanent_prob, b.tier, s.tier AS previous_tier,
    CASE WHEN s.tier IS NULL THEN 'New' ELSE s.tier || ' -> ' || b.tier END AS tier_change,
    CASE WHEN s.tier IS NULL THEN 'new' WHEN {_LEVEL.format('b.tier')} > {_LEVEL.format('s.tier')} THEN 'up' ELSE 'down' END AS direction
  FROM batch AS b LEFT JOIN scores AS s ON s.email = b.email AND s.population = b.population
  WHERE b.tier IN ('Critical', 'Watch') AND s.tier IS DISTINCT FROM b.tier""", SCORED)
def _scoring(t):
    changed = C.churn_scoring(tables(t), known(t.spark), t.scores, SALES_DAY)[1]
    return changed.select("email", "population", "churn_prob", "likely_permanent_prob", "tier", "previous_tier", "tier_change", "direction")


# --- rule segments ----------------------------------------------------------------------------------------------------

SEGMENT_SQL = """CASE WHEN list_contains(st, 'active') THEN
      CASE WHEN list_contains(st, 'frozen') THEN 'excluded_frozen' WHEN list_contains(st, 'payment_failure') THEN 'excluded_payment_failure'
        WHEN coalesce(recency_score, 0) <= 2 AND retention_segment IN ('Lapsing', 'Lost') THEN 'attendance_critical'
        WHEN coalesce(recency_score, 0) = 3 THEN 'attendance_watch' ELSE 'attendance_ok' END
    WHEN len(st) = 0 THEN
      CASE WHEN frequency_score >= 2 AND remaining_credits = 0 AND retention_segment IN ('Lapsing', 'Lost') THEN 'credit_critical'
        WHEN frequency_score >= 2 AND remaining_credits > 0 AND remaining_credits <= 2 AND retention_segment = 'Lapsing' THEN 'credit_watch'
        ELSE 'no_membership' END
    ELSE 'other' END"""
_SEG = {
    "split": """SELECT *, list_filter(list_transform(string_split(coalesce(membership_status, ''), ','), lambda x: trim(x)),
      lambda x: x <> '') AS st FROM details""",
    "seg": f"SELECT *, {SEGMENT_SQL} AS segment FROM split",
}


@query("a18_rule_segments", ("details",), "SELECT customer_id, segment FROM seg", _SEG)
def _segments(t):
    return C.rule_segments(t.details).select("customer_id", "segment")


@query("c06_segment_counts", ("details",), """
  SELECT segment, count(*) AS n FROM seg WHERE segment <> 'no_membership' GROUP BY 1
  UNION ALL SELECT 'no_membership', count(*) FROM seg WHERE len(st) = 0 HAVING count(*) > 0""", _SEG)
def _segment_counts(t):
    return C.segment_counts(t.details)


@query("c06_segment_samples", ("details",), """
  SELECT segment, customer_id FROM seg WHERE regexp_matches(segment, '_(critical|watch)$')
  QUALIFY row_number() OVER (PARTITION BY segment ORDER BY customer_id) <= CASE WHEN segment LIKE '%critical' THEN 10 ELSE 5 END""",
       _SEG)
def _segment_samples(t):
    return C.segment_samples(t.details).select("segment", "customer_id")
