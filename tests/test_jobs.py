"""Churn, lifecycle, ratings, classes, retention and streams on small hand-made rows."""

import json
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rosterlake import specs
from rosterlake.operators import activity as A
from rosterlake.operators import filters as P
from rosterlake.operators import keyed as K
from rosterlake.operators import matching as N
from rosterlake.operators import scoring as S
from rosterlake.plans import churn, classes, conversions, lifecycle, ratings, retention
from rosterlake.sources.tables import TooManyRows
from rosterlake.streaming import appends, reminders

AS_OF = date(2026, 6, 30)


def ago(days):
    return AS_OF - timedelta(days=days)


# --- churn ------------------------------------------------------------------------------------------------------------


def people(spark):
    visits = spark.createDataFrame([
        ("one@x", ago(10)), ("two@x", ago(10)), ("two@x", ago(50)), ("two@x", ago(10)), ("edge@x", ago(180)),
        ("gone@x", ago(181)), ("future@x", ago(-1)), ("grace@x", ago(3)), ("lapsed@x", ago(3)), ("expired@x", ago(40)),
        ("late@x", ago(1)),
    ], "email string, d date")
    bought = spark.createDataFrame([
        ("one@x", ago(30), "membership", 365, 7.0, 1), ("two@x", ago(200), "membership", 365, 2.0, 1),
        ("two@x", ago(5), "credit", None, None, 10), ("edge@x", ago(30), "credit", None, None, 5),
        ("gone@x", ago(30), "credit", None, None, 5), ("future@x", ago(30), "credit", None, None, 5),
        ("grace@x", ago(37), "membership", 30, 7.0, 1), ("lapsed@x", ago(38), "membership", 30, 7.0, 1),
        ("expired@x", ago(90), "credit", None, None, 5), ("late@x", ago(91), "credit", None, None, 5),
    ], "email string, d date, category string, plan_days long, weekly_rate double, pack_size long")
    bought = bought.withColumns({"rev": F.lit(1.0), "item_text": F.lit("x"), "first_name": F.lit("A"),
                                 "last_name": F.lit(None).cast("string"), "booking_customer_id": F.lit("1")})
    return S.candidates(A.visit_history(visits), A.purchase_profile(bought), AS_OF)


def test_candidates(spark):
    got = {r["email"]: r for r in people(spark).collect()}
    assert set(got) == {"one@x", "two@x", "edge@x", "grace@x", "lapsed@x", "expired@x", "late@x"}
    assert got["one@x"]["gap_days"] == 999 and got["two@x"]["gap_days"] == 40
    assert got["one@x"]["days_since_last_visit"] == 10
    # a member who tops up with credits stays a member; cover ends with its grace; a lapsed member without credits stays one
    assert [got[e]["category"] for e in ("two@x", "grace@x", "lapsed@x", "edge@x")] == ["membership"] * 3 + ["credit"]
    assert got["two@x"]["last_pack_size"] == 10 and got["two@x"]["visit_count"] == 2


def test_features_and_signals(spark):
    everyone = people(spark)
    members = {r["email"]: r for r in S.member_features(everyone, AS_OF).withColumn("s", S.membership_signal()).collect()}
    assert members["two@x"]["visits_trailing60"] == 2 and members["two@x"]["freq_ratio"] is None
    assert members["two@x"]["attendance_ratio"] == pytest.approx(2 / (2 * 60 / 7))
    assert members["one@x"]["s"] == "No visits in 999 days" and members["one@x"]["is_single_visit"]
    credits = {r["email"]: r for r in S.credit_features(everyone, AS_OF).withColumn("s", S.credit_signal()).collect()}
    assert set(credits) == {"edge@x", "expired@x"}  # bought 91 days ago: out of scope
    assert credits["expired@x"]["expired_with_unused_credits"] and credits["expired@x"]["s"] == "Credits expired unused"
    assert credits["expired@x"]["days_until_expiry_est"] == 28 - 90 and credits["expired@x"]["visits_since_purchase"] == 1
    assert S.both_features(everyone, AS_OF).count() == len(members) + len(credits)


def test_tiers_on_the_threshold(spark):
    df = spark.createDataFrame([(0.55,), (0.53,), (0.35,), (0.34,)], "p double")
    assert [r[0] for r in df.select(S.tier_of("membership", F.col("p"))).collect()] == ["Critical", "Watch", "Watch", "OK"]
    assert [r[0] for r in df.select(S.tier_of("credit", F.col("p"))).collect()] == ["Critical", "Critical", "Watch", "OK"]


def test_merge_and_changes(spark):
    def rows(data):
        df = spark.createDataFrame(data, "email string, tier string")
        known = {"population": F.lit("membership"), "churn_prob": F.lit(0.5), "updated_date": F.lit(date(2026, 6, 1))}
        return df.select(*[F.col(f.name) if f.name in df.columns else known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
                           for f in specs.SCORE_SCHEMA.fields])

    stored = rows([("up", "Watch"), ("down", "Critical"), ("same", "Watch"), ("ok", "OK"), ("absent", "Critical")])
    batch = rows([("up", "Critical"), ("down", "Watch"), ("same", "Watch"), ("ok", "OK"), ("new", "Critical")])
    merged = K.merge_scores(stored, batch, AS_OF)
    got = {r["email"]: r for r in merged.collect()}
    assert len(got) == 6 and got["up"]["previous_tier"] == "Watch" and got["new"]["previous_tier"] is None
    assert got["absent"]["updated_date"] == date(2026, 6, 1) and got["up"]["updated_date"] == AS_OF
    changed = {r["email"]: (r["tier_change"], r["direction"]) for r in K.changed_tiers(merged, AS_OF).collect()}
    assert changed == {"up": ("Watch -> Critical", "up"), "down": ("Critical -> Watch", "down"), "new": ("New", "new")}


def test_models_score_both_populations(spark):
    everyone = spark.range(200).select(
        F.concat(F.col("id").cast("string"), F.lit("@x")).alias("email"), F.lit(ago(10)).alias("last_visit_date"),
        F.array(F.lit(ago(10))).alias("days"), (F.col("id") % 100).cast("int").alias("gap_days"), F.lit(5).alias("visit_count"),
        F.when(F.col("id") < 100, "membership").otherwise("credit").alias("category"), F.lit(ago(20)).alias("last_purchase_date"),
        F.lit(7.0).alias("plan_weekly_rate"), F.lit(5).alias("last_pack_size"), F.lit("A").alias("first_name"),
        F.lit("").alias("last_name"), F.lit("1").alias("booking_customer_id"), F.lit(False).alias("ever_member"))
    members, credits = S.member_features(everyone, AS_OF), S.credit_features(everyone, AS_OF)
    label = (F.col("gap_days") > 50).cast("double")
    models = S.Models(S.fit_churn(members.withColumn("label", label), S.MEMBERSHIP_INPUTS),
                      S.fit_churn(credits.withColumn("label", label), S.CREDIT_INPUTS),
                      S.fit_churn(members.withColumn("label", label), S.RETURN_INPUTS))
    scored = churn.score_people(members, credits, models)
    rows = scored.collect()
    assert len(rows) == 200 and all(0 <= r["churn_prob"] <= 1 for r in rows)
    assert {r["population"] for r in rows if r["likely_permanent_prob"] is None} == {"credit"}
    assert {r["last_name"] for r in rows} == {None}
    one = S.score_return(members, models.permanence).collect()
    both = {r["email"]: r["likely_permanent_prob"] for r in rows if r["population"] == "membership"}
    assert {r["email"]: r["likely_permanent_prob"] for r in one} == pytest.approx(both)


def test_rule_segments(spark):
    df = spark.createDataFrame([
        ("1", "active,frozen", 1, 5, "Lost", 0), ("2", "active, payment_failure", 1, 5, "Lost", 0), ("3", "active", 2, 5, "Lapsing", 0),
        ("4", "active", 3, 5, "Loyal", 0), ("5", "active", None, 5, "Lost", 0), ("6", "", 1, 2, "Lost", 0),
        ("7", "", 1, 2, "Lapsing", 2), ("8", "", 1, 2, "Lapsing", 3), ("9", "", 1, 1, "Lost", 0), ("10", None, 1, 2, "Lapsing", None),
        ("11", "cancelled", 1, 2, "Lost", 0)],
        "customer_id string, membership_status string, recency_score int, frequency_score int, retention_segment string, remaining_credits int")
    got = {r["customer_id"]: r["segment"] for r in churn.rule_segments(df).collect()}
    assert [got[str(i)] for i in range(1, 12)] == [
        "excluded_frozen", "excluded_payment_failure", "attendance_critical", "attendance_watch", "attendance_critical",
        "credit_critical", "credit_watch", "no_membership", "no_membership", "no_membership", "other"]
    counts = {r["segment"]: r["n"] for r in churn.segment_counts(df).collect()}
    assert counts["no_membership"] == 5 and counts["credit_critical"] == 1


# --- conversions ------------------------------------------------------------------------------------------------------


def test_conversion_payload(spark):
    sales = spark.createDataFrame([
        ("1", "7", "Credits", "Completed", "own@x.y", "2026-06-01", "", "10.5", " CAD"),
        ("2", "8", "Retail", "Completed", "own@x.y", "2026-06-01", "", "1", "CAD"),
        ("3", "8", "Credits", "Refunded", "own@x.y", "2026-06-01", "", "1", "CAD")],
        "order_number string, customer_id string, product_type string, line_status string, customer_email string, "
        "order_date_utc string, order_time_utc string, line_subtotal string, currency string")
    users = spark.createDataFrame([(7, "", None, "Li", "+1 (514) 555")], "user_id long, email string, first_name string, "
                                  "last_name string, phone_number string")
    rows = conversions.event_payloads(conversions.offline_conversions(sales, users)).collect()
    assert len(rows) == 1
    event = json.loads(rows[0]["payload"])
    assert sorted(event["user_data"]) == ["em", "ln", "ph"] and event["custom_data"] == {"value": 10.5, "currency": "CAD"}


# --- lifecycle --------------------------------------------------------------------------------------------------------


def test_ordinals_and_pages(spark):
    rng = random.Random(3)
    rows = [("hot" if rng.random() < 0.4 else f"u{rng.randrange(30)}", f"2026-06-{1 + rng.randrange(20):02d}T{rng.randrange(24):02d}:00:00", i)
            for i in range(1500)]
    df = spark.createDataFrame(rows, "user string, sort_text string, reservation_id int").withColumns(
        {"class_session_id": F.lit(1), "status": F.lit("x")})
    history = N.ordinal_in_history(df, "user", "sort_text", "reservation_id")
    want = {}
    for user in {r[0] for r in rows}:
        for n, r in enumerate(sorted((r for r in rows if r[0] == user), key=lambda r: (r[1], r[2])), 1):
            want[r[2]] = n
    assert {r["reservation_id"]: r["ordinal"] for r in history.collect()} == want
    pages = N.history_pages(history, "user", 100).collect()
    assert max(len(p["entries"]) for p in pages) == 100 and sum(len(p["entries"]) for p in pages) == 1500
    assert [e["ordinal"] for p in sorted((p for p in pages if p["user"] == "hot"), key=lambda p: p["page"]) for e in p["entries"]] == list(
        range(1, 1 + sum(r[0] == "hot" for r in rows)))


def test_reminder_spans_have_no_gaps():
    first = lifecycle.due_span(None, datetime(2026, 7, 1, 5, 10))
    assert first == (datetime(2026, 7, 2), datetime(2026, 7, 2, 9))
    late = lifecycle.due_span(first[1], datetime(2026, 7, 1, 20, 10))  # hour 23 of the target day
    assert late == (first[1], datetime(2026, 7, 3))
    after = lifecycle.due_span(late[1], datetime(2026, 7, 1, 22, 0))  # over midnight nothing is skipped
    assert after == (late[1], datetime(2026, 7, 3, 2))


def test_birthdays(spark):
    rows = [(1, "1990-07-01", None, "a@x"), (2, "1990-07-07", "", "a@x"), (3, "1990-07-08", None, "a@x"),
            (4, "1990-07-01", "2020-01-01", "a@x"), (5, "1990-07-01", None, ""), (6, "1919-07-01", None, "a@x"), (7, "2000-02-29", None, "a@x")]
    users = spark.createDataFrame(rows, "user_id int, birth string, archived_at string, email string").withColumn(
        "birth_date", F.to_date("birth"))
    assert sorted(r["user_id"] for r in P.birthdays(users, date(2026, 7, 1)).collect()) == [1, 2]
    assert P.birthdays(users, date(2026, 2, 25)).count() == 0 and P.birthdays(users, date(2028, 2, 25)).count() == 1


def test_expiring_credits_by_local_day(spark):
    rows = [(1, "2026-07-31 03:00:00", 1, False), (2, "2026-07-31 05:00:00", 1, False), (3, "2026-08-01 03:59:00", 2, None),
            (4, "2026-07-31 12:00:00", 0, False), (5, "2026-07-31 12:00:00", 2, True), (6, "2026-07-31 12:00:00", None, False)]
    df = spark.createDataFrame(rows, "id int, at string, remaining_credits_cache int, is_expired boolean").withColumn(
        "expiration_datetime", F.to_timestamp("at"))
    assert sorted(r["id"] for r in P.expiring_credits(df, date(2026, 7, 1)).collect()) == [2, 3]


# --- ratings ----------------------------------------------------------------------------------------------------------


def test_ratings_import(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text("Instructor,Contact,Response Date,Rating,Comment,Class\n"
                    "Ann,Anonymous User,2026-07-01,5.0,,Ride\nBo,anonymous user,2026-07-01,5,,Ride\nAnn,Anonymous User,7/1/2026,5,,ride\n"
                    "Ann,Jo,2026-07-01,five,hi,Ride\nBo,jo ,2026-07-01,4,,Ride\nAnn,Old,2026-07-01,4,,Ride\n"
                    "Ann,,2026-07-01,4,,Ride\nAnn,Jo,someday,4,,Ride\n")
    existing = spark.createDataFrame([("named|old|2026-07-01|ride",)], "dedupe_key string")
    new, rejects, run = ratings.import_ratings(spark, str(path), existing)
    assert sorted((r["contact"], r["instructor"], r["rating"]) for r in new.collect() if r["rating"]) == [
        ("Anonymous User", "Ann", 5.0), ("anonymous user", "Bo", 5.0)]
    assert new.count() == 3
    assert sorted(r["reason"] for r in rejects.collect()) == [
        "already stored", "duplicate inside the file", "duplicate inside the file", "missing contact or date", "missing contact or date"]
    record = run.first()
    assert (record["imported"], record["ignored"], record["status"]) == (3, 5, "issue")


def test_names_and_clients(spark):
    users = spark.createDataFrame([(i, "Jo Li", "") for i in range(1, 5)] + [(5, "jo li ", "jo@x.y"), (6, "Jo Li", "late@x.y"),
                                  (7, "Six Deep", "")], "user_id int, full_name string, email string")
    rows = spark.createDataFrame([(1, " JO LI", None, ""), (2, "a@x.y", None, ""), (3, "Nobody", None, ""), (4, "", None, ""),
                                  (5, "Jo Li", "has@x.y", "")], "rating_id int, contact string, email string, email_link string")
    clients = spark.createDataFrame([(9, "JO@x.y"), (8, "jo@x.y")], "client_id int, email string")
    linked, created = ratings.resolve_rating_emails(rows, users, clients)
    got = {r["rating_id"]: (r["email"], r["outcome"], r["client_key"]) for r in linked.collect()}
    assert got == {1: ("jo@x.y", "updated", "8"), 2: ("a@x.y", "updated", "new:a@x.y"), 3: (None, "not_found", None),
                   4: (None, "skipped", None), 5: (None, "skipped", None)}
    assert [r["email"] for r in created.collect()] == ["a@x.y"]


# --- classes ----------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("minutes", [0, 2, 15])
def test_nearest_session_against_brute_force(spark, minutes):
    rng = random.Random(minutes)
    base = datetime(2026, 2, 2, 12)
    names = ["Ride", "Yoga", None]
    sessions = [(i, rng.choice([1, 1, 1, 2]), base + timedelta(seconds=20 * rng.randrange(300)), rng.choice(names)) for i in range(250)]
    asked = [(i, rng.choice([1, 1, 1, 2, 3, None]), rng.choice([None, *[base + timedelta(seconds=20 * rng.randrange(300)) for _ in range(9)]]),
              rng.choice(["ride ", " YOGA", "", None])) for i in range(400)]
    got = N.match_sessions(
        spark.createDataFrame(asked, "request_id int, location_id int, target_ts timestamp, class_name string"),
        spark.createDataFrame(sessions, "session_id int, location_id int, start_ts timestamp, class_name string"), minutes)
    want = {}
    for rid, place, at, name in asked:
        name = (name or "").strip().lower()
        near = [(abs((s[2] - at).total_seconds()), s[0]) for s in sessions if at and s[1] == place
                and abs((s[2] - at).total_seconds()) <= 60 * minutes and (not name or (s[3] or "").lower() == name)]
        want[rid] = min(near)[1] if near else None
    assert {r["request_id"]: r["session_id"] for r in got.collect()} == want


def test_class_requests(spark):
    sessions = spark.createDataFrame([(1, 4, datetime(2026, 2, 2, 12, 15), "Ride"), (2, 4, datetime(2026, 2, 2, 12, 16), "Ride"),
                                      (3, 5, datetime(2026, 2, 2, 12, 15), "Ride")],
                                     "session_id int, location_id int, start_ts timestamp, class_name string")
    rooms = spark.createDataFrame([(4, "Room A"), (5, "Room B")], "location_id int, name string")
    rows = spark.createDataFrame([
        (1, " room a", "2/2/2026 7:15am EST", "ride", None), (2, "Room A", "2/2/2026 7:17 AM", None, ""),
        (3, "Room A", "2/2/2026 7:19 AM", None, None), (4, "Room A", "soon", None, None), (5, "Room C", "2/2/2026 7:15 AM", None, None),
        (6, None, "2/2/2026 7:15 AM", None, None), (7, "Room A", "2/2/2026 7:15 AM", None, "77"), (8, "Room A", "2/2/2026 7:15 AM", "Yoga", None)],
        "request_id int, room string, date_text string, class_name string, class_id string")
    got = {r["request_id"]: (r["class_session_id"], r["outcome"]) for r in classes.resolve_class_ids(rows, rooms, sessions).collect()}
    assert got == {1: (1, "updated"), 2: (2, "updated"), 3: (None, "not_found"), 4: (None, "error"), 5: (None, "not_found"),
                   6: (None, "skipped"), 7: (None, "skipped"), 8: (None, "not_found")}


def test_last_duplicate_of_a_dimension_wins(spark):
    rows = spark.createDataFrame([(1, " Ann ", "1"), (2, "ANN", "1"), (3, "nobody", None)], "session_id int, instructor string, location_id string")
    rows = rows.withColumn("class_type", F.lit("Ride"))
    who = spark.createDataFrame([(1, "ann", "a"), (2, "Ann ", "b"), (3, " ", "c")], "pos int, name string, instructor_id string")
    places = spark.createDataFrame([(1, 1, "s1"), (2, 1, "s2")], "pos int, location_id int, studio_id string")
    kinds = spark.createDataFrame([(1, "Yoga", "y")], "pos int, name string, class_type_id string")
    out = N.assign_dims(rows, who, places, kinds)
    assert {r["session_id"]: (r["instructor_id"], r["studio_id"], r["class_type_id"]) for r in out.collect()} == {
        1: ("b", "s2", None), 2: ("b", "s2", None), 3: (None, None, None)}


def test_children_are_replaced(spark):
    cells = "class_record_id string, reservation_id int"
    old = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], cells)
    out = K.replace_children(old, spark.createDataFrame([("a", 9)], cells), spark.createDataFrame([("a",), ("c",)], "class_record_id string"),
                             "class_record_id")
    assert sorted(tuple(r) for r in out.collect()) == [("a", 9), ("b", 2)]


def test_upsert_takes_the_last_name(spark):
    cells = "customer_id string, email_lower string, email string, name string, dupe string, measurement_note_id string"
    now = spark.createDataFrame([("r1", "a@x", "A@x", "Old", "No", "n1"), ("r2", "a@x", "a@x", "Dupe", "Yes", None)], cells)
    people_in = spark.createDataFrame([("A@X", "First", 1), ("a@x", "Second", 2), ("b@x", None, 3), ("", "None", 4)],
                                      "email string, name string, reservation_id int")
    got = sorted((r["customer_id"], r["email"], r["name"]) for r in K.upsert_customers(now, people_in).collect())
    assert got == [("new:b@x", "b@x", ""), ("r1", "a@x", "Second"), ("r2", "a@x", "Dupe")]


# --- retention and streams --------------------------------------------------------------------------------------------


def test_delete_cap(spark, tmp_path):
    df = spark.range(60_000)
    assert K.guarded_delete(df, spark.range(0), ["id"]).count() == 60_000
    assert K.guarded_delete(df, spark.range(10), ["id"]).count() == 59_990
    with pytest.raises(TooManyRows):
        K.guarded_delete(df, spark.range(50_001), ["id"])
    path = str(tmp_path / "log")
    spark.range(20).write.parquet(path)
    assert retention.apply_purge(spark, path, spark.range(5), ["id"], plan=True).count() == 15
    assert spark.read.parquet(path).count() == 20
    retention.apply_purge(spark, path, spark.range(5), ["id"])
    assert spark.read.parquet(path).count() == 15


def test_stream_appends_each_key_once(spark, tmp_path):
    spec, folder = specs.FIRST_TIMERS_TEXT, tmp_path / "landing"
    folder.mkdir()

    def land(name, ids):
        rows = [[f"C{i}", i, None, None, None, f"2026-07-{d:02d}"] for i, d in ids]
        (folder / name).write_text(json.dumps({"headers": list(spec.headers), "rows": rows}))

    def run():
        stream = appends.landed_stream(spark, str(folder), spec)
        query = appends.stream_append(stream, spec, str(tmp_path / "table"), str(tmp_path / "state"))
        query.awaitTermination()
        return sorted(r["string_field_1"] for r in spark.read.parquet(str(tmp_path / "table")).collect())

    land("a.json", [(1, 1), (2, 1), (1, 2)])
    assert run() == ["1", "2"]
    land("b.json", [(2, 3), (3, 3)])
    assert run() == ["1", "2", "3"]
    land("c.json", [(1, 1), (4, 20)])  # far behind the watermark: held back by the table
    assert run() == ["1", "2", "3", "4"]


def test_reminder_stream(spark, tmp_path):
    rows = [(i, "pending" if i % 2 else "check in", "standard", datetime(2026, 7, 1, i % 5)) for i in range(40)]
    cells = "reservation_id int, status string, reservation_type string, start_datetime timestamp"
    spark.createDataFrame(rows + rows, cells).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(cells).parquet(str(tmp_path / "in"))
    seen = []
    query = (reminders.reminder_stream(stream).writeStream.option("checkpointLocation", str(tmp_path / "s1"))
             .foreachBatch(lambda b, _: seen.extend(r["reservation_id"] for r in b.collect())).trigger(availableNow=True).start())
    query.awaitTermination()
    assert sorted(seen) == list(range(1, 40, 2))
