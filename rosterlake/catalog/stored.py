"""Stored tables that jobs change in place, read back: merges by key, reminders by due time, whole sync runs.

Every query writes its tables under the shared folder with the library's own writers and returns what a reader finds.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from rosterlake import specs
from rosterlake.catalog import audits, syncs
from rosterlake.catalog.base import SALES_DAY, DealtTables, Tables, d_any, d_iso_like, d_loose, query
from rosterlake.catalog.keyed import _BATCH, _UPSERT, MERGE_SQL, _booked_people, batch
from rosterlake.catalog.landed import _home, landed_report
from rosterlake.catalog.ratings import _IMPORT
from rosterlake.catalog.reports import SOURCES, mapped_columns
from rosterlake.operators import keyed as K
from rosterlake.operators import quality as Q
from rosterlake.operators.ordinals import place_in_order
from rosterlake.plans import ratings as R
from rosterlake.plans import sync
from rosterlake.sources import facts, tables
from rosterlake.sources import keyed_tables as KT
from rosterlake.streaming.due_reminders import Reminders, take_stream

# --- merges by key ----------------------------------------------------------------------------------------------------


def _stored_scores(t: Tables) -> KT.KeyedTable:
    table = KT.create(t.scores, f"{_home(t)}/scores", ["email", "population"])
    KT.merge_scores(table, batch(t), SALES_DAY)
    return KT.open_keyed(t.spark, table.path)


@query("j16_stored_merge", ("scores", "score_batch"), f"""
  SELECT email, population, first_name, last_name, booking_customer_id, cast(last_visit_date AS varchar) AS last_visit_date,
    round(churn_prob, 6) AS churn_prob, round(likely_permanent_prob, 6) AS likely_permanent_prob, tier, previous_tier,
    key_signal, cast(updated_date AS varchar) AS updated_date FROM ({MERGE_SQL}) AS m""", _BATCH)
def _merged(t):
    return _stored_scores(t).rows()


@query("w05_stored_changed_tiers", ("scores", "score_batch"), f"""
  SELECT email, population, tier, previous_tier FROM ({MERGE_SQL}) AS m
  WHERE updated_date = DATE '{SALES_DAY}' AND tier IN ('Critical', 'Watch') AND (previous_tier IS NULL OR previous_tier <> tier)""", _BATCH)
def _changed(t):
    return K.changed_tiers(_stored_scores(t).rows(), SALES_DAY).select("email", "population", "tier", "previous_tier")


@query("s13_stored_upsert", ("bookings", "users", "op_customers"), """
  SELECT coalesce(c.customer_id, 'new:' || p.email_lower) AS customer_id, coalesce(c.email_lower, p.email_lower) AS email_lower,
    coalesce(p.email_lower, c.email) AS email, coalesce(p.new_name, c.name) AS name, 'No' AS dupe, c.measurement_note_id
  FROM (SELECT * FROM op_customers WHERE dupe = 'No') AS c FULL JOIN people AS p ON p.email_lower = c.email_lower
  UNION ALL SELECT customer_id, email_lower, email, name, dupe, measurement_note_id FROM op_customers WHERE dupe <> 'No'""", _UPSERT)
def _upserted(t):
    """Twice: the second time every person is known, and nothing changes."""
    people = _booked_people(t)
    table = KT.create(t.op_customers, f"{_home(t)}/customers", ["email_lower"])
    for _ in range(2):
        KT.upsert_customers(table, people)
    return KT.open_keyed(t.spark, table.path).rows().select("customer_id", "email_lower", "email", "name", "dupe", "measurement_note_id")


@query("s11_stored_children", ("bookings", "sessions"), """
  SELECT class_session_id, reservation_id, 'old' AS source FROM bookings WHERE class_session_id IS NOT NULL
    AND class_session_id NOT IN (SELECT session_id FROM sessions WHERE public_note IS NOT NULL)
  UNION ALL SELECT class_session_id, reservation_id, 'new' FROM bookings WHERE status = 'pending'
    AND class_session_id IN (SELECT session_id FROM sessions WHERE public_note IS NOT NULL)""")
def _children(t):
    kids = t.bookings.where(F.col("class_session_id").isNotNull()).select("class_session_id", "reservation_id", "status")
    parents = t.sessions.where(F.col("public_note").isNotNull()).select(F.col("session_id").alias("class_session_id"))
    table = KT.create(kids.select("class_session_id", "reservation_id", F.lit("old").alias("source")), f"{_home(t)}/children", ["class_session_id"])
    fresh = kids.where("status = 'pending'").join(parents, "class_session_id", "left_semi")
    KT.replace_children(table, fresh.select("class_session_id", "reservation_id", F.lit("new").alias("source")), parents)
    return KT.open_keyed(t.spark, table.path).rows()


# --- reminders by due time --------------------------------------------------------------------------------------------

#: Runs of the hourly batch: one before each landing is complete, two within a day, one much later.
NOWS = (datetime(2024, 1, 9, 9, 20), datetime(2024, 1, 15, 9, 20), datetime(2024, 1, 15, 22, 5), datetime(2024, 1, 24, 0, 0))
_ENDS = tuple((n + timedelta(hours=27)).replace(minute=0) + timedelta(hours=1) for n in NOWS)
_LANDED = "reservation_id, status, reservation_type, start_datetime"


@query("t06_due_reminders", ("bookings",), f"""
  SELECT reservation_id, cast(start_datetime AS varchar) AS start, cast(min(now) AS varchar) AS sent_at FROM (
    SELECT r.now, r.ends, l.*, row_number() OVER (PARTITION BY r.now, reservation_id ORDER BY landing DESC) AS nth
    FROM runs AS r JOIN landings AS l ON l.landing <= r.run) AS x
  WHERE nth = 1 AND status = 'pending' AND reservation_type = 'standard' AND start_datetime > now AND start_datetime < ends
  GROUP BY reservation_id, start_datetime""", {
    "runs": " UNION ALL ".join(f"SELECT {i} AS run, TIMESTAMP '{n}' AS now, TIMESTAMP '{e}' AS ends" for i, (n, e) in enumerate(zip(NOWS, _ENDS))),
    "landings": f"""SELECT {_LANDED}, reservation_id % 3 AS landing FROM bookings
      UNION ALL SELECT reservation_id, 'late Cancel', reservation_type, start_datetime, 1 FROM bookings WHERE reservation_id % 3 = 0 AND spot_id IS NULL
      UNION ALL SELECT reservation_id, status, reservation_type, start_datetime + INTERVAL 9 DAY, 3 FROM bookings WHERE user_id IS NULL""",
})
def _reminded(t):
    """Three landings of all bookings, and before each hourly batch the next one: some bookings are cancelled in the second,
    those without a person move by nine days in the last."""
    home, b = _home(t), t.bookings.select("reservation_id", "status", "reservation_type", "start_datetime", "spot_id", "user_id")
    part = F.col("reservation_id") % 3
    cancelled = b.where((part == 0) & F.col("spot_id").isNull()).withColumn("status", F.lit("late Cancel"))
    moved = b.where(F.col("user_id").isNull()).withColumn("start_datetime", F.col("start_datetime") + F.make_dt_interval(F.lit(9)))
    landings = [b.where(part == 0), b.where(part == 1).unionByName(cancelled), b.where(part == 2), moved]
    reminders = Reminders(t.spark, f"{home}/reminders")
    for now, landing in zip(NOWS, landings):
        landing.write.mode("append").parquet(f"{home}/landed")
        stream = t.spark.readStream.schema(b.schema).parquet(f"{home}/landed")
        take_stream(stream, reminders, f"{home}/state").awaitTermination()
        reminders.remind(now)
        reminders.remind(now)
        reminders.forget(now)
    return reminders.sent().select("reservation_id", "start", "sent_at")


# --- whole sync runs on stored tables ---------------------------------------------------------------------------------


def _synced(t: Tables, spec: specs.TableSpec):
    """Land the report, store what was there before, run the sync twice, the second time in vain; read the table."""
    home = _home(t)
    report = landed_report(t, spec, home).where(spec.day() >= F.date_sub(F.lit(syncs.CUT), 3))
    old = syncs.stored(DealtTables(t.spark, t.folder), spec)
    tables.write_table(old.select(*[f"`{c}`" for c in spec.names]), f"{home}/table", spec, dealt=True)
    records = [sync.sync_table(report, f"{home}/table", spec, syncs.AS_OF, spec.name) for _ in range(2)]
    return tables.open_table(t.spark, f"{home}/table"), records


def _register(name: str, spec: specs.TableSpec) -> None:
    view, cells = SOURCES[spec]
    views = (view, *syncs._EXTRA.get(spec.name, ()))
    ctes = syncs._ctes(spec, view, cells)
    query(f"{name}_landed_sync", views, f"SELECT {syncs._out(spec)} FROM stored UNION ALL SELECT {syncs._out(spec)} FROM fresh", ctes)(
        lambda t: _synced(t, spec)[0].select(*[f"`{c}`" for c in spec.names]))


_register("c01", specs.SALES_TEXT)
_register("c03", specs.RESERVATIONS_TYPED)
_RT = specs.RESERVATIONS_TEXT


@query("s16_observed_runs", ("reservations_report", "reservations_stored"), f"""
  SELECT 'first' AS run, 'reservations_text' AS job, 'completed' AS status, (SELECT count(*) FROM fresh) AS imported,
    (SELECT count(*) FROM landed, hw WHERE d BETWEEN mark AND DATE '{syncs.YESTERDAY}') - (SELECT count(*) FROM fresh) AS ignored
  UNION ALL SELECT 'second', 'reservations_text', 'completed', 0,
    (SELECT count(*) FROM landed, hw WHERE d BETWEEN greatest(mark, (SELECT max(d) FROM landed WHERE d <= DATE '{syncs.YESTERDAY}')) AND DATE '{syncs.YESTERDAY}')""",
       syncs._ctes(_RT, *SOURCES[_RT]))
def _recorded(t):
    """The records of two runs, counted while their rows were written. The second starts at the last stored day."""
    first, second = _synced(t, _RT)[1]
    named = first.withColumn("run", F.lit("first")).unionByName(second.withColumn("run", F.lit("second")))
    return named.select("run", "job", "status", "imported", "ignored")


@query("a01_a02_stored_marks", ("sales_report", "sales_stored", "reservations_report", "reservations_stored"), """
  SELECT 'sales_text' AS table_name, (SELECT cast(max(d) AS varchar) FROM s) AS mark
  UNION ALL SELECT 'reservations_text', (SELECT cast(max(d) AS varchar) FROM r)""", {
    "s": f"SELECT {d_any('transaction_date')} AS d FROM sales_stored WHERE {d_any('transaction_date')} <= DATE '{syncs.CUT}' AND order_status <> 'Order Status'",
    "r": f"SELECT {d_any(_RT.date_column)} AS d FROM reservations_stored WHERE {d_any(_RT.date_column)} <= DATE '{syncs.CUT}'",
})
def _marks(t):
    """Marks of stored tables from their newest month; rows without a day lie in a month of their own."""
    home, out, dealt = _home(t), [], DealtTables(t.spark, t.folder)
    for spec, rows in ((specs.SALES_TEXT, dealt.sales_stored), (_RT, dealt.reservations_stored)):
        kept = rows.where((spec.day() <= F.lit(syncs.CUT)) | spec.day().isNull())
        tables.write_table(kept.select(*spec.names), f"{home}/{spec.name}", spec, dealt=True)
        out.append((spec.name, str(sync.stored_mark(t.spark, f"{home}/{spec.name}", spec, syncs.AS_OF))))
    return t.spark.createDataFrame(out, "table_name string, mark string")


# --- facts of a table, declared tables, places in an order --------------------------------------------------------------

_FACTS = f"""SELECT coalesce(strftime(d, '%Y-%m'), 'none') AS audit_month, count(*) AS n, {{columns}}, {{keys}},
    bool_or(d IS NOT NULL AND ({{bad}})) AS bad, bool_or(d IS NOT NULL AND ({{fix}})) AS fix, bool_or({{junk}} AND {{lost}}) AS lost
  FROM stored GROUP BY ALL"""


def _month_facts(spec: specs.TableSpec, columns: str, bad: str, fix: str, junk: str, lost: str) -> dict[str, str]:
    """The recount: different rows of a month, its keys, its counters."""
    keys = ", ".join(f"{k} AS key{i}" for i, k in enumerate(spec.keys))
    names = ", ".join(f"key{i}" for i in range(len(spec.keys)))
    return {
        "each": f"SELECT * FROM ({_FACTS.format(columns=columns, keys=keys, bad=bad, fix=fix, junk=junk, lost=lost)}) AS x",
        "per_key": f"""SELECT audit_month, {names}, sum(n) AS n, count(*) AS k, sum(n) FILTER (bad) AS bad, sum(n) FILTER (fix) AS fix, sum(n) FILTER (lost) AS lost
          FROM each GROUP BY audit_month, {names}""",
        "per_month": """SELECT audit_month, sum(n)::BIGINT AS total_rows, sum(k)::BIGINT AS distinct_rows, (sum(n) - sum(k))::BIGINT AS duplicate_rows,
          count(*) FILTER (k > 1) AS key_collisions, coalesce(sum(bad), 0)::BIGINT AS bad_format, coalesce(sum(fix), 0)::BIGINT AS repairable,
          coalesce(sum(lost), 0)::BIGINT AS unparseable FROM per_key GROUP BY 1""",
    }


_SALES_FACTS = {"stored": f"SELECT *, {audits.SALES_DAY} AS d FROM sales_dups",
                **_month_facts(audits.SALES, audits.SALES_COLUMNS, audits._SBAD, audits._SFIX, "order_status <> 'Order Status'", "d IS NULL")}
_BOOKED_FACTS = {"stored": f"SELECT *, {audits.BOOKED_DAY} AS d FROM reservations_stored",
                 **_month_facts(audits.BOOKED, audits.BOOKED_COLUMNS, audits._BAD, audits._FIX, "true",
                                f"NOT ({d_loose('class_start_date')} OR {d_iso_like('class_start_date')})")}
_SHOWN = "total_rows, distinct_rows, duplicate_rows, key_collisions, bad_format, repairable, unparseable"


def _grown(t: Tables, spec: specs.TableSpec, view: str):
    """A table that is counted, grows by the days it lacked, and is counted again; only the months that grew are read. Its rows
    are derived once: what comes later is written in the same pass, beside the table."""
    home, rows = f"{_home(t)}/rows", getattr(DealtTables(t.spark, t.folder), view)
    lacking = F.coalesce(F.dayofmonth(spec.day()).isin(*audits.LOST_DAYS) & (F.month(spec.day()) == 3), F.lit(False))
    arrived = F.when(lacking, "later").otherwise("first").alias("arrived")
    tables.write_table(rows.select(*spec.names, arrived), home, spec, dealt=True, apart="arrived")
    path, later = f"{home}/arrived=first", t.spark.read.parquet(home).where("arrived = 'later'").select(*spec.names)
    facts.refresh(t.spark, path, spec)
    tables.append(later, path, spec)
    found = facts.refresh(t.spark, path, spec)
    if not all(m.endswith("-03") for m in found.recounted):
        raise AssertionError(f"months that did not change were read: {found.recounted}")
    return found


@query("a04_a05_a11_a12_month_facts", audits.SV, f"SELECT audit_month, {_SHOWN} FROM per_month", _SALES_FACTS)
def _facts(t):
    return _grown(t, audits.SALES, "sales_dups").months.withColumn("duplicate_rows", F.col("total_rows") - F.col("distinct_rows")).select(
        "audit_month", *_SHOWN.split(", "))


@query("a04_a05_table_facts", audits.BV, """
  SELECT (SELECT sum(total_rows) FROM per_month)::BIGINT AS total_rows, (SELECT sum(distinct_rows) FROM per_month)::BIGINT AS distinct_rows,
    (SELECT sum(duplicate_rows) FROM per_month)::BIGINT AS duplicate_rows, (SELECT sum(unparseable) FROM per_month)::BIGINT AS unparseable,
    (SELECT count(*) FROM (SELECT key0 FROM per_key GROUP BY key0 HAVING sum(k) > 1) AS x) AS key_collisions""", _BOOKED_FACTS)
def _table_facts(t):
    return _grown(t, audits.BOOKED, "reservations_stored").table().select("total_rows", "distinct_rows", "duplicate_rows", "unparseable", "key_collisions")


@query("s06_load_tables", ("sales_report", "first_timers_report", "reservations_report", "scores"), """
  SELECT 'sales_typed' AS name, count(*) AS n FROM sales_report UNION ALL SELECT 'first_timers_text', count(*) FROM first_timers_report
  UNION ALL SELECT 'reservations_typed', count(*) FROM reservations_report UNION ALL SELECT 'scores', count(*) FROM scores""")
def _loaded(t):
    """Written tables, loaded by name under their declared columns."""
    home, out, dealt = _home(t), None, DealtTables(t.spark, t.folder)
    for spec in (specs.SALES_TYPED, specs.FIRST_TIMERS_TEXT, specs.RESERVATIONS_TYPED):
        tables.write_table(mapped_columns(dealt, spec).select(*[f"`{c}`" for c in spec.names]), f"{home}/{spec.name}", spec, dealt=True)
    t.scores.select(*specs.SCORE_SCHEMA.names).write.parquet(f"{home}/scores")
    for name in ("sales_typed", "first_timers_text", "reservations_typed", "scores"):
        counted = tables.load(t.spark, home, name, specs.STORED[name]).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        out = counted if out is None else out.unionByName(counted)
    return out


@query("o01_newest_first_places", ("ratings_upload",), """
  SELECT line, cast(day AS varchar) AS day, row_number() OVER (ORDER BY day DESC, line) AS place FROM ready WHERE day IS NOT NULL""",
       {"ready": _IMPORT["ready"]})
def _places(t):
    ready = R.prepare_ratings(t.ratings_upload).where(F.col("day").isNotNull()).select("line", "day")
    return place_in_order(ready, [F.col("day").desc(), F.col("line")], name="place")


@query("o02_missing_days_in_order", audits.SV, "SELECT cast(d AS varchar) AS d, row_number() OVER (ORDER BY d) AS place FROM missing", audits.SALES_CTES)
def _days(t):
    return place_in_order(Q.missing_dates(audits.sales_stored(t), audits.SALES, audits.START, audits.END), [F.col("d")], name="place")
