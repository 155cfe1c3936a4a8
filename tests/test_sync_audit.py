from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from rosterlake import specs
from rosterlake.operators import incremental as I
from rosterlake.operators import quality as Q
from rosterlake.plans import audit, sync
from rosterlake.sources import tables

SALES = specs.SALES_TEXT


def sales(spark, rows):
    """Rows of (order, product id, day text, status, quantity, total)."""
    df = spark.createDataFrame(rows, "order_number string, product_id string, transaction_date string, line_status string, "
                                     "line_quantity string, line_total string")
    known = {"order_date_utc": F.col("transaction_date"), "order_status": F.lit("Completed")}
    return df.select(*[F.col(c) if c in df.columns else known.get(c, F.lit("")).alias(c) for c in SALES.names])


def keys(df):
    return sorted((r["order_number"], r["line_status"], r["line_quantity"]) for r in df.collect())


def test_sync_window():
    day = date(2026, 7, 10)
    assert I.sync_window(date(2026, 7, 1), 7, day) == (date(2026, 7, 1), date(2026, 7, 7))
    assert I.sync_window(date(2026, 7, 8), 7, day) == (date(2026, 7, 8), date(2026, 7, 9))
    assert I.sync_window(date(2026, 7, 10), 7, day) is None
    assert I.sync_span(date(2026, 7, 1), day) == (date(2026, 7, 1), date(2026, 7, 9))
    assert I.sync_window(day, 7, day, (date(2020, 1, 1), date(2020, 2, 1))) == (date(2020, 1, 1), date(2020, 2, 1))


def test_high_water_reads_every_variant(spark):
    rows = sales(spark, [("1", "a", "07/01/2026", "Completed", "1", "5"), ("2", "a", "07/ 4/2026", "Completed", "1", "5"),
                         ("3", "a", "junk", "Completed", "1", "5")])
    assert I.read_mark(rows, SALES, date(2026, 7, 10)) == date(2026, 7, 4)
    assert I.read_mark(rows.limit(0), SALES, date(2026, 7, 10)) == date(2026, 7, 3)


def test_sync_keeps_refunds_and_drops_known_rows(spark):
    stored = sales(spark, [("1", None, "07/01/2026", "Completed", "1", "5")])
    source = sales(spark, [
        ("1", "", "07/01/2026", "Completed", "1", "5"),  # stored with a null product id: the same key
        ("2", "b", "07/02/2026", "Completed", "1", "5"), ("2", "b", "07/02/2026", "Refunded", "-1", "5"),
        ("3", "c", "07/03/2026", "Completed", "1", "5"), ("3", "c", "07/03/2026", "Completed", "1", "5"),
        ("4", "d", "07/10/2026", "Completed", "1", "5"),  # today: not finished
    ])
    got = sync.sync_sales(source, stored, date(2026, 7, 10))
    assert got.span == (date(2026, 7, 1), date(2026, 7, 9))
    assert keys(got.rows) == [("2", "Completed", "1"), ("2", "Refunded", "-1"), ("3", "Completed", "1")]
    strict = sync.sync_sales(source, stored, date(2026, 7, 10), strict_reference=True)
    assert keys(strict.rows).count(("3", "Completed", "1")) == 2
    again = sync.sync_sales(source, stored.unionByName(got.rows), date(2026, 7, 10))
    assert again.rows.count() == 0
    assert sync.sync_sales(source, sales(spark, [("9", "x", "07/10/2026", "Completed", "1", "1")]), date(2026, 7, 10)).span is None


def test_strict_sync_keeps_only_the_first_window(spark):
    spec = specs.FIRST_TIMERS_TYPED  # windows of two days
    df = spark.createDataFrame([(7, "2026-07-01"), (7, "2026-07-02"), (7, "2026-07-03"), (8, "2026-07-04")], "id long, day string")
    source = df.select(*[{"Customer ID": F.col("id"), "First Class Date": F.to_date("day")}.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name)
                         for f in spec.schema.fields])
    rows = sync.sync_first_timers(source, source.limit(0), date(2026, 7, 8), spec=spec, strict_reference=True,
                                  override=(date(2026, 7, 1), date(2026, 7, 7))).rows
    assert sorted(str(r["First Class Date"]) for r in rows.collect()) == ["2026-07-01", "2026-07-02", "2026-07-04"]


def test_apply_sync_twice(spark, tmp_path):
    path = str(tmp_path / "sales")
    tables.write_table(sales(spark, [("1", "a", "07/01/2026", "Completed", "1", "5")]), path, SALES)
    source = sales(spark, [("2", "b", "07/02/2026", "Completed", "1", "5")])
    for expected in (1, 0):
        found = sync.sync_sales(source, spark.read.parquet(path), date(2026, 7, 10))
        assert sync.apply_sync(found, path, SALES, plan=True).count() == expected
        sync.apply_sync(found, path, SALES)
        assert spark.read.parquet(path).count() == 2


def test_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 700, 1).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    first = I.keep_first(df, [F.col("k")], [F.col("v")])
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert first.count() == 301


def month(spark):
    """July 2026 without the 5th and the 10th to 18th; row 2 twice in two spellings; row 3 with two totals."""
    start = date(2026, 7, 1)
    days = [start + timedelta(days=i) for i in range(31) if i + 1 != 5 and not 10 <= i + 1 <= 18]
    rows = [(f"d{d.day}", "a", d.strftime("%m/%d/%Y"), "Completed", "1", "5") for d in days]
    rows += [("2x", "a", "07/02/2026", "Completed", "1", "5"), ("2x", "a", "7/2/2026", "Completed", "1", "5")]
    rows += [("3x", "a", "07/03/2026", "Completed", "1", "5"), ("3x", "a", "07/03/2026", "Completed", "1", "6")]
    rows += [("bad", "a", "n/a", "Completed", "1", "5"), ("june", "a", "6/30/2026", "Completed", "1", "5")]
    return sales(spark, rows)


def source(spark):
    rows = [(f"d{d}", "a", f"07/{d:02d}/2026", "Completed", "1", "5") for d in range(1, 32) if d != 14]
    return sales(spark, rows)


def test_runs_and_windows(spark):
    missing = Q.missing_dates(month(spark), SALES, date(2026, 7, 1), date(2026, 7, 31))
    runs = Q.date_runs(missing)
    assert sorted((r[0].day, r[1].day) for r in runs.collect()) == [(5, 5), (10, 18)]
    assert sorted((r[0].day, r[1].day) for r in Q.chunk_runs(runs, 7).collect()) == [(5, 5), (10, 16), (17, 18)]


def test_audit_counts(spark):
    audits, summary = audit.monthly_audit([(SALES, month(spark), source(spark))], "2026-07", date(2026, 8, 2))
    row = summary.first().asDict()
    assert {k: row[k] for k in Q.COUNTERS} == {
        "days_present": 21, "missing_days": 10, "backfilled_days": 9, "backfilled_rows": 9, "confirmed_empty": 1,
        "unparseable": 1, "bad_format": 1, "repairable": 1, "total_rows": 25, "duplicate_rows": 1, "key_collisions": 1}
    assert row["status"] == "attention" and row["days_after"] == 30
    assert audits["sales_text"].repaired.count() == 24
    assert Q.overall_status(summary).first()["overall"] == "3 issue(s) found and fixed"


def test_audit_in_place_then_clean(spark, tmp_path):
    path = str(tmp_path / "sales")
    tables.write_table(month(spark), path, SALES)
    today = date(2026, 8, 2)
    audit.apply_audit(SALES, path, source(spark), "2026-07", today, plan=True).collect()
    assert spark.read.parquet(path).count() == 27
    audit.apply_audit(SALES, path, source(spark), "2026-07", today)
    table = spark.read.parquet(path)
    assert table.count() == 27 - 1 + 9
    assert {r["order_number"] for r in table.collect()} >= {"bad", "june", "d10", "2x"}
    again = audit.apply_audit(SALES, path, source(spark), "2026-07", today).first()
    assert (again["duplicate_rows"], again["bad_format"], again["backfilled_rows"], again["missing_days"]) == (0, 0, 0, 1)
    assert again["key_collisions"] == 1  # reported, never removed


def test_failed_table_does_not_stop_the_rest(spark):
    broken = month(spark).drop("transaction_date")
    _, summary = audit.monthly_audit([(specs.SALES_TEXT, broken, source(spark)), (SALES, month(spark), source(spark))],
                                     "2026-07", date(2026, 8, 2))
    assert sorted(r["status"] for r in summary.collect()) == ["attention", "failed"]
    assert Q.overall_status(summary).first()["overall"] == "completed with errors"
    with pytest.raises(ValueError):
        audit.monthly_audit([], "2026-08", date(2026, 8, 2))


def test_row_identity_sees_nulls(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, ""), (1, "x")], "a int, b string")
    row = Q.full_row_dups(df).first()
    assert (row["total_rows"], row["distinct_rows"], row["duplicate_rows"]) == (4, 3, 1)
    assert Q.key_collisions(df, ["a"]).first().asDict() == {"a": 1, "n_rows": 4, "n_distinct": 3}
