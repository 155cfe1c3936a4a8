"""Rows of a stored table are dealt out by month while they are narrow."""

import contextlib
import io
from datetime import datetime

from pyspark.sql import functions as F

from rosterlake import specs, surrogates
from rosterlake.catalog import audits, landed, stored
from rosterlake.catalog.base import Tables
from rosterlake.sources import tables


def made(spark, folder):
    """Orders and lines with null and repeated keys and days."""
    orders = [(k, c, s, d) for k, c, s, d in [(1, 5, "F", datetime(1998, 1, 31)), (2, 6, "O", datetime(1999, 2, 1)), (2, 6, "O", datetime(1999, 2, 1)),
                                              (5, None, None, None), (None, 7, "P", datetime(1999, 3, 1)), (211 + 5, 8, "P", datetime(2000, 1, 1))]]
    lines = [(k, 10 * k if k else 3, k, 1, 2.0, 3.5, 0.1, "R", day) for k, day in [(1, datetime(1998, 3, 1)), (2, datetime(1999, 4, 30)), (2, None),
                                                                                    (5, datetime(1999, 5, 1)), (None, datetime(1999, 6, 1)), (216, datetime(2000, 1, 2))]]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz").write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_tax double, "
                                 "l_returnflag string, l_shipdate timestamp_ntz").write.parquet(f"{folder}/lineitem.parquet")


def test_dealt_views_hold_the_same_rows_and_shuffle_narrow_ones(spark, tmp_path):
    made(spark, tmp_path)
    for name in surrogates.ROWS_OF:
        plain, dealt = surrogates.view(spark, str(tmp_path), name), surrogates.dealt_view(spark, str(tmp_path), name)
        assert sorted(map(str, dealt.collect())) == sorted(map(str, plain.collect())) and plain.count() > 0
        assert dealt.schema == plain.schema
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            dealt.select(next(c for c in dealt.columns if c in ("purchase_location", "class_location", "location"))).explain()
        above, _, below = out.getvalue().partition("REBALANCE_PARTITIONS")
        assert below and "Studio" in above and "Studio" not in below


def test_dealt_rows_are_written_whole_beyond_the_months_held_open(spark, tmp_path):
    spec = specs.FIRST_TIMERS_TEXT
    days = [f"{m:02d}/05/{y}" for y in (2024, 2025) for m in range(1, 13)] + ["n/a", None]
    rows = spark.createDataFrame([tuple(d if n == spec.date_column else str(i) for n in spec.names) for i, d in enumerate(days * 3)],
                                 ", ".join(f"{n} string" for n in spec.names)).coalesce(1)
    before = {key: spark.conf.get(key) for key in tables.DEALT}
    tables.write_table(rows, str(tmp_path / "t"), spec, dealt=True)
    assert {key: spark.conf.get(key) for key in tables.DEALT} == before and 24 > tables.OPEN_FILES
    back = spark.read.parquet(str(tmp_path / "t"))
    assert sorted(map(str, back.select(*spec.names).collect())) == sorted(map(str, rows.collect()))
    assert {r["audit_month"]: r["count"] for r in back.groupBy("audit_month").count().collect()} == {
        **{f"{y}-{m:02d}": 3 for y in (2024, 2025) for m in range(1, 13)}, "none": 6}
    assert back.where(F.col(spec.date_column).isNull()).count() == 3
    assert all(".zstd." in f.name for f in (tmp_path / "t").rglob("part-*.parquet"))


def rewritten(monkeypatch, run):
    """What ``run`` returns, and the input files and the plan of every frame it writes as a table."""
    seen, write = [], tables.write_table

    def spy(df, *args, **options):
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            df.explain()
        seen.append(({part for f in df.inputFiles() for part in ("lineitem", "orders", "later") if part in f}, out.getvalue()))
        return write(df, *args, **options)

    monkeypatch.setattr(tables, "write_table", spy)
    return run(), seen


def sold(spark, folder, days):
    """The rows above, and a line of order 2, which is there twice, on each day."""
    made(spark, folder)
    lines = [(2, 10 + i, 4, 1, 49.0, 3.5, 0.1, "N", day) for i, day in enumerate(days)]
    spark.createDataFrame(lines, spark.read.parquet(f"{folder}/lineitem.parquet").schema).write.mode("append").parquet(f"{folder}/lineitem.parquet")
    return Tables(spark, str(folder))


def test_a_table_that_grows_derives_its_rows_once_and_shuffles_narrow_ones(spark, tmp_path, monkeypatch):
    late = sold(spark, tmp_path / "a", [datetime(1998, 3, 11), datetime(1998, 3, 12), datetime(1998, 3, 21), datetime(1998, 5, 11)])
    none = sold(spark, tmp_path / "b", [datetime(1998, 3, 12)])
    for t, later in ((late, {"later"}), (none, set())):
        found, seen = rewritten(monkeypatch, lambda t=t: stored._facts(t))
        assert [files for files, _ in seen] == [{"lineitem", "orders"}, later]
        above, _, below = seen[0][1].partition("REBALANCE_PARTITIONS")
        assert "@example.com" in above and "@example.com" not in below
        rows = t.sales_dups.groupBy(tables.month_of(specs.SALES_TEXT.day()).alias("m")).count().collect()
        assert {r["audit_month"]: r["total_rows"] for r in found.collect()} == {r["m"]: r["count"] for r in rows}
        monkeypatch.undo()


def test_a_month_is_replaced_in_a_table_whose_rows_were_shuffled_narrow(spark, tmp_path, monkeypatch):
    t = sold(spark, tmp_path, [datetime(2000, 3, d) for d in (1, 2, 11, 12, 12)] + [datetime(2000, 4, 11), datetime(2000, 4, 12)])
    found, seen = rewritten(monkeypatch, lambda: landed._replaced(t))
    above, _, below = seen[0][1].partition("REBALANCE_PARTITIONS")
    assert "@example.com" in above and "@example.com" not in below

    def outside(rows):
        return sorted(str(r) for r in rows.collect() if r["transaction_date"] is None or "/2000" not in r["transaction_date"] or "3/" not in r["transaction_date"][:3])

    assert outside(found) == outside(audits.sales_stored(t).select(*found.columns))
    held = found.where("transaction_date LIKE '03/%/2000'").groupBy("transaction_date").count().collect()
    assert {r["transaction_date"]: r["count"] for r in held} == {"03/01/2000": 2, "03/02/2000": 2, "03/11/2000": 1, "03/12/2000": 4}
