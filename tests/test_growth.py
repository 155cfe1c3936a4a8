"""What may not grow faster than a table, on rows made here."""

import contextlib
import io
from datetime import date

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from rosterlake import specs
from rosterlake.catalog import landed
from rosterlake.catalog.base import Tables
from rosterlake.catalog.reports import SOURCES
from rosterlake.functions import dates as D
from rosterlake.operators import keyed as K
from rosterlake.plans import audit
from rosterlake.session import DEFAULTS
from rosterlake.sources import facts, reports, tables


def plan_of(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def test_a_delete_may_take_its_share_of_a_large_table(spark):
    df = spark.range(600).withColumn("k", F.col("id") % 10)
    doomed = spark.range(3).withColumnRenamed("id", "k")
    assert K.guarded_delete(df, doomed, ["k"], cap=50, share=0.5).count() == 420
    for cap, share in ((50, 0.2), (50, 0.0), (179, 0.0)):
        with pytest.raises(tables.TooManyRows):
            K.guarded_delete(df, doomed, ["k"], cap=cap, share=share)


def test_pages_are_cut_without_a_shuffle(spark, tmp_path):
    spec = specs.FIRST_TIMERS_TEXT
    cells = [[str(i), None, "", *["x"] * (len(spec.headers) - 3)] for i in range(1234)]
    rows = spark.createDataFrame([(c,) for c in cells], "row array<string>").coalesce(1)
    pages = reports.paged(rows, F.col("row"), 100)
    assert "Exchange" not in plan_of(pages)
    held = [r["rows"] for r in pages.collect()]
    assert [len(p) for p in held] == [100] * 12 + [34] and [r for p in held for r in p] == cells
    reports.write_report(rows, spec.headers, str(tmp_path / "r"), page=100, compression="snappy")
    assert reports.read_table_report(spark, str(tmp_path / "r"), spec, lines=True).count() == 1234


def test_a_query_settles_a_session_it_did_not_make(spark, monkeypatch):
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
    entry.queries()["s03_map_sales_text"](spark, entry.SMOKE_DIR)
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == DEFAULTS["spark.sql.codegen.hugeMethodLimit"]


def test_an_audit_reads_its_source_once(spark, tmp_path):
    spec = specs.FIRST_TIMERS_TEXT

    def row(key, day):
        return ["Name", str(key), *["x"] * 3, day, *["x"] * (len(spec.names) - 6)]

    rows = [row(i, f"06/{i:02d}/2026") for i in range(1, 31)]
    schema = ", ".join(f"{n} string" for n in spec.names)
    spark.createDataFrame([*rows, rows[4]], schema).write.parquet(str(tmp_path / "whole_source"))
    source = spark.read.parquet(str(tmp_path / "whole_source"))
    stored = spark.createDataFrame(rows[:4] + rows[6:], schema)
    found = audit.audit_table(stored, source, spec, date(2026, 6, 1), date(2026, 6, 30))
    assert "whole_source" not in plan_of(found.backfill) and "whole_source" not in plan_of(found.counters)
    assert sorted(r[spec.keys[0]] for r in found.backfill.collect()) == ["5", "6"]
    counted = found.counters.first()
    assert (counted["missing_days"], counted["backfilled_days"], counted["backfilled_rows"]) == (2, 2, 2)
    whole = audit.audit_table(source, source, spec, date(2026, 6, 1), date(2026, 6, 30))
    assert whole.backfill.count() == 0 and whole.counters.first()["backfilled_days"] == 0


def test_days_are_read_without_a_date_pattern(spark):
    texts = ["1/ 2/2024", "02/30/2024", "=1/2/2024", "2024-01-02", "2024-01-2 ", "2024-01-02T10:00:00Z", "+12024-01-02", "n/a", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(texts)], "i int, v string").repartition(1)
    readers = {"us": D.tolerant_date, "any": D.tolerant_date_any, "iso": D.date_only}
    assert not any("gettimestamp" in plan_of(df.select(readers[n](F.col("v")))) for n in ("us", "iso"))
    held = df.select("i", *[f(F.col("v")).cast("string").alias(n) for n, f in readers.items()]).orderBy("i").collect()
    day = "2024-01-02"
    assert [r["us"] for r in held] == [day, *[None] * 8]
    assert [r["any"] for r in held] == [day, None, None, day, None, None, "+12024-01-02", None, None]
    assert [r["iso"] for r in held] == [*[None] * 3, day, None, day, *[None] * 3]


def test_facts_shuffle_digests_of_keys_that_hold_the_day(spark, tmp_path):
    spec, path = specs.SALES_TEXT, str(tmp_path / "sales")
    plain = dict.fromkeys(spec.names, "x") | {"transaction_date": "06/01/2026", "order_date_utc": "06/01/2026"}
    changes = [{}, {}, {"line_total": "9"}, {"variant_id": ""}, {"variant_id": None}, {"transaction_date": "6/2/2026"}, {"transaction_date": "n/a"}]
    rows = spark.createDataFrame([tuple((plain | c)[n] for n in spec.names) for c in changes], ", ".join(f"{n} string" for n in spec.names))
    tables.write_table(rows, path, spec)
    assert all(".zstd." in f.name for f in (tmp_path / "sales").rglob("part-*.parquet"))
    plan = plan_of(facts._counted(spark.read.parquet(path), spec)[0])
    assert "_key#" in plan and "_key0" not in plan
    found = facts.refresh(spark, path, spec).months.select("audit_month", "total_rows", "distinct_rows", "key_collisions", "repairable", "unparseable")
    assert sorted(tuple(r) for r in found.collect()) == [("2026-06", 6, 5, 1, 1, 0), ("none", 1, 1, 0, 0, 1)]


def test_a_report_is_landed_smaller_than_snappy_makes_it(spark, tmp_path):
    """Rows of a report repeat their words, not in runs: a codec with an entropy coder takes much less of the shared disk."""
    spec, t = specs.SALES_TEXT, Tables(spark, entry.SMOKE_DIR)
    landed.land(t, spec, str(tmp_path / "landed"))
    rows = t.sales_report.select(F.array(*[F.col(c).cast("string") for c in SOURCES[spec][1]]).alias("row"))
    reports.write_report(rows, spec.headers, str(tmp_path / "snappy"), compression="snappy")
    size = {n: sum(f.stat().st_size for f in (tmp_path / n).glob("part-*")) for n in ("landed", "snappy")}
    assert size["landed"] < 0.7 * size["snappy"]
    back = [reports.read_table_report(spark, str(tmp_path / n), spec, lines=True) for n in ("landed", "snappy")]
    assert back[0].count() == rows.count() and back[0].exceptAll(back[1]).count() == 0
