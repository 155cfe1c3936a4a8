"""Rows that must not be lost: late stream rows, unmarked customers, purged partitions, failing tables, odd dates."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from rosterlake import specs
from rosterlake.functions import dates as D
from rosterlake.operators import keyed as K
from rosterlake.operators import matching as N
from rosterlake.operators import quality as Q
from rosterlake.plans import audit, lifecycle, retention
from rosterlake.sources import tables
from rosterlake.sources.tables import RowCountMismatch, TooManyRows
from rosterlake.streaming import appends, reminders

FT, SALES = specs.FIRST_TIMERS_TEXT, specs.SALES_TEXT


def test_late_new_keys_reach_the_table(spark, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()

    def land(name, ids):
        rows = [[f"C{i}", i, None, None, None, f"2026-07-{d:02d}"] for i, d in ids]
        (folder / name).write_text(json.dumps({"headers": list(FT.headers), "rows": rows}))

    def run():
        stream = appends.landed_stream(spark, str(folder), FT)
        appends.stream_append(stream, FT, str(tmp_path / "table"), str(tmp_path / "state")).awaitTermination()
        return sorted(r["string_field_1"] for r in spark.read.parquet(str(tmp_path / "table")).collect())

    land("a.json", [(1, 20)])
    assert run() == ["1"]
    land("b.json", [(2, 1), (3, 2), (3, 4), (1, 2)])
    assert run() == ["1", "2", "3"]
    assert run() == ["1", "2", "3"]


def test_all_hours_are_written(spark, tmp_path):
    rows = [(i, "pending", "standard", datetime(2026, 7, 1, i % 24)) for i in range(60)]
    cells = "reservation_id int, status string, reservation_type string, start_datetime timestamp"
    spark.createDataFrame(rows, cells).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(cells).parquet(str(tmp_path / "in"))
    reminders.write_hours(stream, str(tmp_path / "hours"), str(tmp_path / "state")).awaitTermination()
    got = {(r["hour"], r["n"]) for r in spark.read.parquet(str(tmp_path / "hours")).collect()}
    want = {(r["hour"], r["n"]) for r in lifecycle.hourly_load(spark.read.parquet(str(tmp_path / "in"))).collect()}
    assert got == want and len(want) == 24


def test_upsert_keeps_unmarked_customers(spark):
    cells = "customer_id string, email_lower string, email string, name string, dupe string, measurement_note_id string"
    now = spark.createDataFrame([("r1", "a@x", "a@x", "Old", None, None), ("r2", "b@x", "b@x", "Old", "No", None)], cells)
    people = spark.createDataFrame([("b@x", "New", 1)], "email string, name string, reservation_id int")
    got = sorted((r["customer_id"], r["name"], r["dupe"]) for r in K.upsert_customers(now, people).collect())
    assert got == [("r1", "Old", None), ("r2", "New", "No")]


def test_the_cap_counts_rows(spark):
    df = spark.range(200).select((F.col("id") % 2).alias("k"))
    one = spark.createDataFrame([(0,)], "k long")
    with pytest.raises(TooManyRows):
        K.guarded_delete(df, one, ["k"], cap=99)
    assert K.guarded_delete(df, one, ["k"], cap=100).count() == 100
    assert K.guarded_delete(df, spark.range(5_000).select((F.col("id") + 10).alias("k")), ["k"], cap=1).count() == 200


def sales(spark, rows):
    df = spark.createDataFrame(rows, "order_number string, transaction_date string")
    return df.select(*[F.col(c) if c in df.columns else F.lit("").alias(c) for c in SALES.names])


def test_purge_keeps_partitions_and_counts(spark, tmp_path):
    path = str(tmp_path / "sales")
    tables.write_table(sales(spark, [("1", "07/01/2026"), ("2", "07/02/2026"), ("3", "08/01/2026"), ("4", "09/01/2026"), ("5", "junk")]), path, SALES)
    untouched = {p.name for p in (tmp_path / "sales" / "audit_month=2026-09").glob("*.parquet")}
    doomed = spark.createDataFrame([("1",), ("3",), ("9",)], "order_number string")
    after = retention.apply_purge(spark, path, doomed, ["order_number"])
    assert sorted(r["order_number"] for r in after.collect()) == ["2", "4", "5"]
    assert sorted(p.name for p in (tmp_path / "sales").glob("audit_month=*")) == ["audit_month=2026-07", "audit_month=2026-09", "audit_month=none"]
    assert {p.name for p in (tmp_path / "sales" / "audit_month=2026-09").glob("*.parquet")} == untouched
    tables.append(sales(spark, [("6", "08/03/2026")]), path, SALES)
    assert spark.read.parquet(path).where("audit_month = '2026-08'").count() == 1
    assert retention.apply_purge(spark, path, doomed, ["order_number"]).count() == 4
    with pytest.raises(RowCountMismatch):
        tables.rewrite_months(spark.read.parquet(path), path, [], 3)
    assert spark.read.parquet(path).count() == 4


def test_a_table_that_fails_while_running_is_reported(spark):
    fine = sales(spark, [("1", "07/01/2026")])
    fails = fine.withColumn("transaction_date", F.when(F.col("order_number") == "1", F.raise_error(F.lit("headers changed"))).otherwise("x"))
    _, summary = audit.monthly_audit([(SALES, fails.withColumn("transaction_date", F.col("transaction_date").cast("string")), fine), (SALES, fine, fine)],
                                     "2026-07", date(2026, 8, 2))
    assert sorted(r["status"] for r in summary.collect()) == ["attention", "failed"]
    assert Q.overall_status(summary).first()["overall"] == "completed with errors"


def test_repair_leaves_what_it_cannot_write(column):
    odd = ["2026-07-21T10:00:00Z", "2026-13-45", "2026-07-21", "7/4/2026", "13/40/2026", "x", "", None]
    assert column(D.repaired_text, odd) == ["2026-07-21T10:00:00Z", "2026-13-45", "07/21/2026", "07/04/2026", "13/40/2026", "x", "", None]
    assert column(D.repairable, odd) == [False, False, True, True, False, False, False, False]


def test_a_seventh_namesake_is_found(spark):
    users = spark.createDataFrame([(i, "Ann Lee", None if i < 7 else "a@x.org") for i in range(1, 8)], "user_id int, full_name string, email string")
    asked = spark.createDataFrame([(1, "ann lee", None)], "rating_id int, contact string, email string")
    assert N.resolve_email(asked, users).first()["resolved_email"] == "a@x.org"


def test_evening_classes_belong_to_the_local_day(spark):
    at = [datetime(2024, 1, 15, 3), datetime(2024, 1, 15, 6), datetime(2024, 1, 17, 3), datetime(2024, 1, 17, 6)]
    bookings = spark.createDataFrame([(i, i, 100 + i, "", "pending", ["463"], t) for i, t in enumerate(at)],
                                     "reservation_id int, user_id int, class_session_id int, guest_email string, status string, tags array<string>, start_datetime timestamp")
    users = spark.createDataFrame([(i, f"u{i}@x", None, None, None) for i in range(4)],
                                  "user_id int, email string, phone_number string, date_joined string, marketing_opt_in boolean")
    sessions = bookings.select(F.col("class_session_id").alias("session_id"), "start_datetime")
    classes = bookings.select("class_session_id", F.lit("c").alias("class_record_id"))
    customers = spark.createDataFrame([], "customer_id string, email string")
    got, _ = lifecycle.new_people_today(bookings, users, sessions, classes, customers, date(2024, 1, 15))
    assert sorted(r["email"] for r in got.collect()) == ["u1@x", "u2@x"]


def test_models_are_stored_and_loaded(spark, tmp_path):
    from rosterlake.catalog.churn import known
    from rosterlake.operators import scoring as S

    models = known(spark)
    S.save_models(models, str(tmp_path / "models"))
    S.save_models(models, str(tmp_path / "models"))
    again = S.load_models(str(tmp_path / "models"))
    rows = spark.range(20).select(*[((F.col("id") * (k + 3)) % 7).cast("double").alias(c) for k, c in enumerate(S.RETURN_INPUTS)])

    def probabilities(m):
        return sorted(r["p"] for r in S.score(rows, m.permanence, S.RETURN_INPUTS, "p").collect())

    assert probabilities(again) == probabilities(models) and len(set(probabilities(models))) > 5


def test_scoring_reads_its_inputs_once(spark, tmp_path):
    from rosterlake.catalog import Tables
    from rosterlake.catalog.churn import known, tables
    from rosterlake.plans import churn

    t = Tables(spark, "/root/testdata/sf0.001")
    merged, _ = churn.churn_scoring(tables(t), known(spark), t.scores, date(2001, 6, 30))
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    assert "lineitem" not in plan and plan.count("Relation [") <= 2
