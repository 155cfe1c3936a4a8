import json
from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rosterlake import specs
from rosterlake.sources import entities, outbox, reports, tables, uploads


def land(path, headers, rows):
    path.write_text(json.dumps({"headers": list(headers), "rows": rows}))
    return str(path)


def first_timer(id_="7", **cells):
    row = {"Customer": "Ann", "Customer ID": id_, "Customer Email": "ann@example.com", "Join Date": "2026-06-30T10:00:00Z",
           "First Class Date": "2026-07-01", "Class Start Time": "13:05:00", "Guest Reservation?": False}
    row.update(cells)
    return [row.get(h) for h in specs.FIRST_TIMER_HEADERS]


def test_report_mapping(spark, tmp_path):
    path = land(tmp_path / "r.json", specs.FIRST_TIMER_HEADERS, [first_timer(7), first_timer(8)[:6]])
    text = {r["string_field_1"]: r for r in reports.read_table_report(spark, path, specs.FIRST_TIMERS_TEXT).collect()}
    assert text["7"]["string_field_5"] == "07/01/2026" and text["7"]["string_field_6"] == "1:05 PM"
    assert text["7"]["string_field_11"] == "false" and text["7"]["string_field_3"] == ""
    assert text["8"]["string_field_6"] == "" and text["8"]["string_field_12"] == ""
    typed = reports.read_table_report(spark, path, specs.FIRST_TIMERS_TYPED)
    assert [(f.name, f.dataType) for f in typed.schema] == [(f.name, f.dataType) for f in specs.FIRST_TIMERS_TYPED.schema]
    row = typed.where("`Customer ID` = 7").first()
    assert row["First Class Date"] == date(2026, 7, 1) and row["Guest Reservation_"] is False


@pytest.mark.parametrize("change", ["rename", "swap", "drop"])
def test_changed_headers_stop_the_run(spark, tmp_path, change):
    headers = list(specs.FIRST_TIMER_HEADERS)
    if change == "rename":
        headers[3] = "Phone"
    elif change == "swap":
        headers[0], headers[1] = headers[1], headers[0]
    else:
        headers.pop()
    path = land(tmp_path / "r.json", headers, [first_timer()])
    with pytest.raises(PySparkException, match="refusing to guess"):
        reports.read_table_report(spark, path, specs.FIRST_TIMERS_TEXT).collect()


def test_free_header_order(spark, tmp_path):
    path = land(tmp_path / "r.json", ["B", "A"], [["1", "2"]])
    landed = reports.read_report(spark, path)
    assert reports.pick_columns(landed, {"x": "A", "y": "B"}).first().asDict() == {"x": "2", "y": "1"}
    with pytest.raises(PySparkException, match="header not found"):
        reports.pick_columns(landed, {"x": "C"}).collect()


def test_spec_names():
    assert specs.SALES_TEXT.names[31] == "order_payment_methods" and specs.SALES_TYPED.names[31] == "Order Payment Method_s_"
    assert "class_duration_minutes" in specs.RESERVATIONS_TEXT.names and "Instructor ID_s_" in specs.RESERVATIONS_TYPED.names
    assert [len(s.names) for s in specs.ALL_SPECS] == [35, 35, 13, 13, 50, 50]


def test_entities(spark, tmp_path):
    page = {"data": [
        {"id": "1", "attributes": {"class_type_display": "Ride", "instructor_names": ["Ann", "Bo"]},
         "relationships": {"location": {"data": {"id": "4"}}}},
        {"id": "2", "attributes": {"instructor_names": "Cy"}, "relationships": {"location": {"data": None}}},
    ]}
    (tmp_path / "p1.json").write_text(json.dumps(page))
    (tmp_path / "p2.json").write_text(json.dumps({"data": [{"id": "3", "attributes": {}}]}))
    rows = {r["id"]: r for r in entities.read_entities(spark, str(tmp_path), entities.CLASS_SESSION).collect()}
    assert rows["1"]["instructor_names"] == ["Ann", "Bo"] and rows["1"]["location_id"] == "4"
    assert rows["2"]["instructor_names"] == ["Cy"] and rows["2"]["location_id"] is None and rows["3"]["location_id"] is None


CSV = ('Response Date,Contact,Rating,Comment,Instructor,Class\r\n'
       '2026-07-01,Jo,5.0,"good, very ""good""\nindeed",Ann,Ride\r\n'
       ',,,,,\r\n'
       '7/2/2026,,4,,Ann,Ride\r\n')


def test_mapped_csv(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text(CSV, newline="")
    mapping = {"contact": " contact", "date_text": "Response Date", "comment": "COMMENT"}
    rows = uploads.read_mapped_csv(spark, str(path), mapping).orderBy("date_text").collect()
    assert len(rows) == 2 and rows[0]["comment"] == 'good, very "good"\nindeed' and rows[1]["contact"] == ""
    with pytest.raises(uploads.MissingHeaders, match="Stars"):
        uploads.read_mapped_csv(spark, str(path), {"rating": "Stars"})


def stored(spark, rows):
    cells = "reservation_id string, class_start_date string, status string"
    df = spark.createDataFrame(rows, cells)
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c)
                       for c in specs.RESERVATIONS_TEXT.names])


def test_month_partitions(spark, tmp_path):
    spec, path = specs.RESERVATIONS_TEXT, str(tmp_path / "t")
    tables.write_table(stored(spark, [("1", "07/01/2026", "a"), ("2", "2026-06-30", "a"), ("3", "n/a", "a")]), path, spec)
    assert sorted(p.name for p in (tmp_path / "t").glob("audit_month=*")) == [
        "audit_month=2026-06", "audit_month=2026-07", "audit_month=none"]
    table = spark.read.parquet(path)
    july = table.where("audit_month = '2026-07'").withColumn("status", F.lit("b"))
    with pytest.raises(tables.RowCountMismatch):
        tables.replace_months(july, path, spec, expected=2)
    assert tables.replace_months(july, path, spec, expected=1) == 1
    got = {r["reservation_id"]: r["status"] for r in spark.read.parquet(path).collect()}
    assert got == {"1": "b", "2": "a", "3": "a"}


def test_ensure_table(spark, tmp_path):
    path = str(tmp_path / "scores")
    assert tables.ensure_table(spark, path, specs.SCORE_SCHEMA).count() == 0
    spark.createDataFrame([("a@example.com",) + (None,) * 11], specs.SCORE_SCHEMA).write.mode("append").parquet(path)
    assert tables.ensure_table(spark, path, specs.SCORE_SCHEMA).count() == 1


def test_outbox(spark, tmp_path):
    df = spark.createDataFrame([(1, None, "x"), (2, "b", None)], "id int, email string, note string")
    rows = [json.loads(r["payload"]) for r in outbox.to_payload(df).collect()]
    assert rows == [{"id": 1, "note": "x"}, {"id": 2, "email": "b"}]
    outbox.write_outbox(outbox.to_payload(df), str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).count() == 2
    assert outbox.log_rows(df, "reminder").first().asDict() == {"email": None, "type": "reminder"}
    run = outbox.run_record(df, "job", F.col("note").isNotNull(), F.when(F.col("note").isNull(), "no note")).first()
    assert (run["status"], run["imported"], run["ignored"], run["issues"]) == ("issue", 1, 1, "no note")
    assert outbox.failed_run(spark, "job", "boom").first()["status"] == "problem"
