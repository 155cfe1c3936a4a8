"""Rewrites of keyed tables: patch, upsert, merge, replace, delete, links."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from rosterlake.catalog.base import SALES_DAY, Tables, query
from rosterlake.operators import filters as P
from rosterlake.operators import keyed as K
from rosterlake.operators import matching as N
from rosterlake.operators import scoring as S
from rosterlake.plans import retention

NEW_EMAIL = "'customer#' || lpad(cast(user_id AS varchar), 9, '0') || '@example.com'"


@query("p13_patch", ("op_customers", "users"), """
  SELECT c.customer_id, coalesce(u.full_name, c.name) AS name, c.email FROM op_customers AS c
  LEFT JOIN (SELECT email, max(CASE WHEN marketing_opt_in THEN full_name END) AS full_name FROM users WHERE email <> ''
    GROUP BY email) AS u ON u.email = c.email""")
def _patch(t):
    changes = t.users.where("email <> ''").groupBy("email").agg(F.max(F.when(F.col("marketing_opt_in"), F.col("full_name"))).alias("name"))
    return K.patch(t.op_customers, changes, "email").select("customer_id", "name", "email")


_UPSERT = {
    "people": """SELECT lower(u.email) AS email_lower, arg_max(coalesce(u.full_name, ''), b.reservation_id) AS new_name
        FROM bookings AS b JOIN users AS u USING (user_id) WHERE u.email <> '' GROUP BY 1""",
}


def _booked_people(t: Tables):
    return t.bookings.join(t.users.select("user_id", "email", F.col("full_name").alias("name")), "user_id").select(
        "email", "name", "reservation_id")


@query("s13_upsert_customers", ("bookings", "users", "op_customers"), """
  SELECT coalesce(c.customer_id, 'new:' || p.email_lower) AS customer_id, coalesce(c.email_lower, p.email_lower) AS email_lower,
    coalesce(p.email_lower, c.email) AS email, coalesce(p.new_name, c.name) AS name, 'No' AS dupe, c.measurement_note_id
  FROM (SELECT * FROM op_customers WHERE dupe = 'No') AS c FULL JOIN people AS p ON p.email_lower = c.email_lower
  UNION ALL SELECT customer_id, email_lower, email, name, dupe, measurement_note_id FROM op_customers WHERE dupe <> 'No'""",
       _UPSERT)
def _upsert(t):
    out = K.upsert_customers(t.op_customers, _booked_people(t))
    return out.select("customer_id", "email_lower", "email", "name", "dupe", "measurement_note_id")


@query("s11_replace_children", ("bookings", "sessions"), """
  SELECT class_session_id, reservation_id, 'old' AS source FROM bookings WHERE class_session_id IS NOT NULL
    AND class_session_id NOT IN (SELECT session_id FROM sessions WHERE public_note IS NOT NULL)
  UNION ALL SELECT class_session_id, reservation_id, 'new' FROM bookings WHERE status = 'pending'
    AND class_session_id IN (SELECT session_id FROM sessions WHERE public_note IS NOT NULL)""")
def _replace(t):
    kids = t.bookings.where(F.col("class_session_id").isNotNull()).select("class_session_id", "reservation_id", "status")
    parents = t.sessions.where(F.col("public_note").isNotNull()).select(F.col("session_id").alias("class_session_id"))
    fresh = kids.where("status = 'pending'").join(parents, "class_session_id", "left_semi")
    return K.replace_children(
        kids.select("class_session_id", "reservation_id", F.lit("old").alias("source")),
        fresh.select("class_session_id", "reservation_id", F.lit("new").alias("source")), parents, "class_session_id")


@query("s12_c21_guarded_delete", ("bookings", "sessions"), """
  SELECT reservation_id, class_session_id FROM bookings WHERE class_session_id IS NULL
    OR class_session_id NOT IN (SELECT session_id FROM sessions WHERE location_id IS NULL)""")
def _delete(t):
    # bookings of a session grow with the table, so what may go is a share of it
    doomed = t.sessions.where(F.col("location_id").isNull()).select(F.col("session_id").alias("class_session_id"))
    return retention.purge(t.bookings, doomed, ["class_session_id"], share=0.5).select("reservation_id", "class_session_id")


MERGE_SQL = f"""
  SELECT coalesce(b.email, c.email) AS email, coalesce(b.population, c.population) AS population,
    CASE WHEN b.email IS NOT NULL THEN b.first_name ELSE c.first_name END AS first_name,
    CASE WHEN b.email IS NOT NULL THEN b.last_name ELSE c.last_name END AS last_name,
    coalesce(b.booking_customer_id, c.booking_customer_id) AS booking_customer_id,
    CASE WHEN b.email IS NOT NULL THEN b.last_visit_date ELSE c.last_visit_date END AS last_visit_date,
    CASE WHEN b.email IS NOT NULL THEN b.churn_prob ELSE c.churn_prob END AS churn_prob,
    CASE WHEN b.email IS NOT NULL THEN b.likely_permanent_prob ELSE c.likely_permanent_prob END AS likely_permanent_prob,
    coalesce(b.tier, c.tier) AS tier, CASE WHEN b.email IS NOT NULL THEN c.tier ELSE c.previous_tier END AS previous_tier,
    coalesce(b.key_signal, c.key_signal) AS key_signal,
    CASE WHEN b.email IS NOT NULL THEN DATE '{SALES_DAY}' ELSE c.updated_date END AS updated_date
  FROM scores AS c FULL JOIN batch AS b ON b.email = c.email AND b.population = c.population"""
_BATCH = {"batch": """SELECT *, CASE WHEN population = 'membership' THEN
      CASE WHEN churn_prob >= 0.55 THEN 'Critical' WHEN churn_prob >= 0.35 THEN 'Watch' ELSE 'OK' END
    ELSE CASE WHEN churn_prob >= 0.53 THEN 'Critical' WHEN churn_prob >= 0.35 THEN 'Watch' ELSE 'OK' END END AS tier
  FROM score_batch"""}


def batch(t: Tables):
    p = F.col("churn_prob")
    tier = F.when(F.col("population") == "membership", S.tier_of("membership", p)).otherwise(S.tier_of("credit", p))
    return t.score_batch.withColumn("tier", tier)


@query("f25_tier_a14_tier_counts", ("score_batch",), "SELECT population, tier, count(*) AS n FROM batch GROUP BY ALL", _BATCH)
def _tiers(t):
    return S.tier_counts(batch(t))


@query("j16_merge_scores", ("scores", "score_batch"), f"""
  SELECT email, population, first_name, last_name, booking_customer_id, cast(last_visit_date AS varchar) AS last_visit_date,
    round(churn_prob, 6) AS churn_prob, round(likely_permanent_prob, 6) AS likely_permanent_prob, tier, previous_tier,
    key_signal, cast(updated_date AS varchar) AS updated_date FROM ({MERGE_SQL}) AS m""", _BATCH)
def _merge(t):
    return K.merge_scores(t.scores, batch(t), SALES_DAY)


@query("w05_changed_tiers", ("scores", "score_batch"), f"""
  SELECT email, population, tier, previous_tier, coalesce(previous_tier || ' -> ' || tier, 'New') AS tier_change,
    CASE WHEN previous_tier IS NULL THEN 'new' WHEN previous_tier = 'OK' OR tier = 'Critical' THEN 'up' ELSE 'down' END AS direction,
    nullif(concat_ws(' ', first_name, last_name), '') AS name
  FROM ({MERGE_SQL}) AS m WHERE updated_date = DATE '{SALES_DAY}' AND tier IN ('Critical', 'Watch')
    AND (previous_tier IS NULL OR previous_tier <> tier)""", _BATCH)
def _changed(t):
    out = K.changed_tiers(K.merge_scores(t.scores, batch(t), SALES_DAY), SALES_DAY)
    return out.select("email", "population", "tier", "previous_tier", "tier_change", "direction", "name")


_KNOWN = {"known": "SELECT lower(email) AS e, min(client_id) AS client_id FROM clients GROUP BY 1"}


@query("j13_link_to_client", ("users", "clients"), """
  SELECT u.user_id, coalesce(cast(k.client_id AS varchar), 'new:' || lower(trim(u.email))) AS client_key
  FROM users AS u LEFT JOIN known AS k ON k.e = lower(trim(u.email))""", _KNOWN)
def _link(t):
    return K.link_or_create(t.users, t.clients)[0].select("user_id", "client_key")


@query("j13_clients_to_create", ("users", "clients"), """
  SELECT lower(trim(email)) AS email_lower, min(trim(email)) AS email FROM users WHERE trim(email) <> ''
    AND lower(trim(email)) NOT IN (SELECT e FROM known) GROUP BY 1""", _KNOWN)
def _create(t):
    return K.link_or_create(t.users, t.clients)[1].select("email_lower", "email")


@query("o03_top_n", ("sales_report",), """
  SELECT order_number, product_id, line_quantity FROM sales_report
  ORDER BY transaction_date DESC, cast(order_number AS bigint), cast(product_id AS bigint), variant_id, line_quantity LIMIT 25""")
def _top(t):
    order = [F.col("transaction_date").desc(), F.col("order_number").cast("bigint"), F.col("product_id").cast("bigint"),
             F.col("variant_id"), F.col("line_quantity")]
    return K.top_n(t.sales_report, order, 25).select("order_number", "product_id", "line_quantity")


@query("p12_split_valid_rejects", ("users",), """
  SELECT user_id, CASE WHEN email = '' THEN 'no email' WHEN NOT regexp_matches(email, '^[^\\s@]+@[^\\s@]+\\.[^\\s@]+$')
    THEN 'bad email' WHEN phone_number IS NULL THEN 'no phone' END AS reason FROM users
  WHERE email = '' OR NOT regexp_matches(email, '^[^\\s@]+@[^\\s@]+\\.[^\\s@]+$') OR phone_number IS NULL""")
def _rejects(t):
    from rosterlake.functions.text import is_email

    rules = [("no email", F.col("email") == ""), ("bad email", ~is_email(F.col("email"))),
             ("no phone", F.col("phone_number").isNull())]
    return P.split_valid(t.users, rules)[1].select("user_id", "reason")


@query("a17_oldest_booking", ("bookings", "details"), """
  SELECT d.customer_id, b.status AS reservation_status, b.class_session_id FROM details AS d LEFT JOIN (
    SELECT *, cast(user_id AS varchar) AS uid FROM bookings WHERE coalesce(status, '') <> '' AND lower(status) NOT LIKE '%cancel%'
      AND user_id IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY try_cast(coalesce(nullif(class_session_start_datetime, ''),
      nullif(class_session_start, ''), nullif(created_at, ''), nullif(updated_at, '')) AS timestamptz) NULLS LAST, reservation_id) = 1
  ) AS b ON b.uid = d.customer_id""")
def _oldest(t):
    out = N.oldest_booking(t.details, booking_dates(t))
    return out.select("customer_id", "reservation_status", "class_session_id")


def booking_dates(t: Tables):
    """Bookings with the five date fields of the entity as text."""
    return t.bookings.withColumn("start_datetime", F.lit(None).cast("string")).withColumn(
        "user_id", F.col("user_id").cast("string"))


RUN_DAY = date(2024, 1, 15)
