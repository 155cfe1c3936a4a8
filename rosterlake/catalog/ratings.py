"""Ratings import and the people behind ratings."""

from __future__ import annotations

from pyspark.sql import functions as F

from rosterlake.catalog.base import d_is_email, query
from rosterlake.catalog.scalars import RATING_DAY_SQL, RATING_KEY_SQL, RATING_SQL
from rosterlake.operators import filters as P
from rosterlake.operators import keyed as K
from rosterlake.operators import matching as N
from rosterlake.plans import ratings as R

_IMPORT = {
    "ready": f"SELECT *, {RATING_DAY_SQL} AS day, {RATING_SQL} AS rating, {RATING_KEY_SQL} AS dedupe_key FROM ratings_upload",
    "stored": "SELECT DISTINCT dedupe_key FROM ready WHERE dedupe_key IS NOT NULL AND day < DATE '2024-01-08'",
    "judged": """SELECT *, CASE WHEN trim(contact) = '' OR day IS NULL THEN 'missing contact or date'
        WHEN row_number() OVER (PARTITION BY dedupe_key ORDER BY line) > 1 THEN 'duplicate inside the file'
        WHEN dedupe_key IN (SELECT dedupe_key FROM stored) THEN 'already stored' END AS reason FROM ready""",
}


def _stored(t):
    """Ratings of the first week count as imported before."""
    ready = R.prepare_ratings(t.ratings_upload)
    return ready.where((F.col("day") < "2024-01-08") & F.col("dedupe_key").isNotNull()).select("dedupe_key").distinct()


@query("c14_import_ratings_outcomes", ("ratings_upload",), """
  SELECT coalesce(reason, 'imported') AS outcome, count(*) AS n FROM judged GROUP BY 1""", _IMPORT)
def _outcomes(t):
    marked = R.mark_ratings(t.ratings_upload, _stored(t))
    return K.outcomes(marked.select(F.coalesce("reason", F.lit("imported")).alias("outcome")))


@query("c14_import_ratings", ("ratings_upload",), """
  SELECT dedupe_key, trim(contact) AS contact, cast(day AS varchar) AS day, nullif(trim(instructor), '') AS instructor,
    round(try_cast(nullif(rating, '') AS double), 6) AS rating, nullif(trim(comment), '') AS comment,
    nullif(trim(class_type), '') AS class_type FROM judged WHERE reason IS NULL""", _IMPORT)
def _import(t):
    return R.new_ratings(R.mark_ratings(t.ratings_upload, _stored(t)))


@query("c14_import_ratings_direct", ("ratings_upload",), """
  SELECT dedupe_key, trim(contact) AS contact, cast(day AS varchar) AS day, nullif(trim(instructor), '') AS instructor,
    round(try_cast(nullif(rating, '') AS double), 6) AS rating, nullif(trim(comment), '') AS comment,
    nullif(trim(class_type), '') AS class_type FROM judged WHERE reason IS NULL""", _IMPORT)
def _direct(t):
    return R.new_ratings_direct(t.ratings_upload, _stored(t))


@query("c14_import_rejects", ("ratings_upload",), "SELECT line, reason FROM judged WHERE reason IS NOT NULL", _IMPORT)
def _rejects(t):
    marked = R.mark_ratings(t.ratings_upload, _stored(t))
    return marked.where(F.col("reason").isNotNull()).select("line", "reason")


@query("o01_newest_first", ("ratings_upload",), """
  SELECT cast(day AS varchar) AS day, count(*) AS n FROM ready WHERE day IS NOT NULL GROUP BY 1 ORDER BY 1 DESC""",
       {"ready": _IMPORT["ready"]})
def _newest(t):
    ready = R.prepare_ratings(t.ratings_upload).where(F.col("day").isNotNull())
    return R.newest_first(ready.groupBy("day").agg(F.count(F.lit(1)).alias("n")), "day")


_NAMES = {
    "named": "SELECT lower(trim(full_name)) AS k, trim(email) AS email, user_id FROM users WHERE trim(full_name) <> ''",
    "found": f"SELECT k, arg_min(email, user_id) AS email FROM named WHERE {d_is_email('email')} GROUP BY k",
    "resolved": f"""SELECT r.rating_id, CASE WHEN {d_is_email('r.email')} OR trim(coalesce(r.contact, '')) = '' THEN NULL
          WHEN {d_is_email('r.contact')} THEN trim(r.contact) ELSE f.email END AS resolved_email,
        {d_is_email('r.email')} OR trim(coalesce(r.contact, '')) = '' AS skip
      FROM ratings_stored AS r LEFT JOIN found AS f ON f.k = lower(trim(r.contact))""",
}


@query("j12_resolve_email", ("ratings_stored", "users"), """
  SELECT rating_id, resolved_email, CASE WHEN skip THEN 'skipped' WHEN resolved_email IS NULL THEN 'not_found' ELSE 'updated' END
    AS outcome FROM resolved""", _NAMES)
def _resolve(t):
    return N.resolve_email(t.ratings_stored, t.users).select("rating_id", "resolved_email", "outcome")


@query("p14_needs_email", ("ratings_stored",), "SELECT rating_id FROM ratings_stored WHERE coalesce(email_link, '') = ''")
def _needs(t):
    return P.needs_email(t.ratings_stored).select("rating_id")


@query("c15_resolve_rating_emails", ("ratings_stored", "users", "clients"), """
  SELECT s.rating_id, s.resolved_email AS email, CASE WHEN s.skip THEN 'skipped' WHEN s.resolved_email IS NULL THEN 'not_found'
      ELSE 'updated' END AS outcome,
    coalesce(cast(k.client_id AS varchar), 'new:' || lower(trim(s.resolved_email))) AS client_key
  FROM resolved AS s JOIN ratings_stored AS r USING (rating_id)
    LEFT JOIN (SELECT lower(email) AS e, min(client_id) AS client_id FROM clients GROUP BY 1) AS k ON k.e = lower(trim(s.resolved_email))
  WHERE coalesce(r.email_link, '') = ''""", _NAMES)
def _job(t):
    linked, _ = R.resolve_rating_emails(t.ratings_stored, t.users, t.clients)
    return linked.select("rating_id", "email", "outcome", "client_key")


@query("c15_clients_to_create", ("ratings_stored", "users", "clients"), """
  SELECT lower(trim(s.resolved_email)) AS email_lower, min(trim(s.resolved_email)) AS email FROM resolved AS s
    JOIN ratings_stored AS r USING (rating_id) WHERE coalesce(r.email_link, '') = '' AND s.resolved_email <> ''
    AND lower(trim(s.resolved_email)) NOT IN (SELECT lower(email) FROM clients) GROUP BY 1""", _NAMES)
def _clients(t):
    _, created = R.resolve_rating_emails(t.ratings_stored, t.users, t.clients)
    return created.select("email_lower", "email")
