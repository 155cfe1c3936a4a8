"""What plans read, compute and shuffle, and that rewritten expressions keep their results on odd texts."""

import contextlib
import io

from pyspark.sql import functions as F

from rosterlake import specs
from rosterlake.functions import dates as D
from rosterlake.operators import quality as Q

#: Texts with too few, empty, long and odd parts.
ODD = ["2026-07-21T15:05:02Z", "2026-07-21", "2026-7-2", "", None, "-", "--", "---", "a-b", "a-b-", "-a-b", "a--b", "a-b-/", "a-b-//", "/-/-/",
       "a-b-c-d", "a-b-c-", "1-2-3/4/", "a-//-b", "a\nb-c-d\n", "\n-\n-\n", "a-b-c\nd-e", "2026-07-21\n", " 2026-07-2", "é-ü-😀-", "$1-\\-$2", "07/21/2026"]


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def mdy(text):
    year, month, day = ((text or "")[:10].split("-") + ["", ""])[:3]
    return f"{month}/{day}/{year}" if year and month and day else ""


def test_a_report_date_is_read_once_wherever_it_is_filtered(spark, column, tmp_path):
    assert column(D.to_mdy, ODD) == [mdy(t) for t in ODD]
    spec = specs.SALES_TEXT
    at = spec.names.index(spec.date_column)
    spark.createDataFrame([(t,) for t in ODD], "v string").write.parquet(str(tmp_path / "v"))
    mapped = spark.read.parquet(str(tmp_path / "v")).select(spec.cell(at, F.col("v")))
    conditions = [line for line in plan(mapped.where(spec.day().isin(["2026-07-21"]))).splitlines() if " Filter " in line]
    assert len(conditions) == 1 and conditions[0].count("v#") == 1
    assert [r[0] for r in mapped.where(spec.day().isin(["2026-07-21"])).collect()] == ["07/21/2026"] * 3


def test_duplicates_are_counted_over_digests_of_32_bytes(spark):
    rows = [("a", "1"), ("a", "1"), ("a", "2"), (None, None), (None, None), (None, ""), ("", None), ("", "x"), ("b", "y")]
    df = spark.createDataFrame(rows, "k string, v string")
    found = Q._identities(df, [F.col("k")])
    assert found.schema["row_id"].dataType.simpleString() == "binary"
    assert sorted((str(r["k"]), r["copies"]) for r in found.collect()) == [
        ("", 1), ("", 1), ("None", 1), ("None", 2), ("a", 1), ("a", 2), ("b", 1)]
    assert tuple(Q.duplicate_counts(df, ["k"]).first()) == (9, 2, 3)
    assert tuple(Q.full_row_dups(df).first()) == (9, 7, 2)
    assert {(r["k"], r["n_rows"], r["n_distinct"]) for r in Q.key_collisions(df, ["k"]).collect()} == {("a", 3, 2), (None, 3, 2), ("", 2, 2)}
    assert tuple(Q.duplicate_counts(df.limit(0), ["k"]).first()) == (0, 0, 0)
