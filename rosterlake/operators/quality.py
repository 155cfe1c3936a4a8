"""Audit operators over one stored table: gaps, formats, duplicates, key collisions, roll-up."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rosterlake.functions import dates as D
from rosterlake.functions import text as X
from rosterlake.operators.filters import drop_junk, in_month
from rosterlake.sources.tables import MONTH, NO_MONTH, month_bounds
from rosterlake.specs import TableSpec

#: Columns of an audit report, in order.
COUNTERS = (
    "days_present", "missing_days", "backfilled_days", "backfilled_rows", "confirmed_empty", "unparseable",
    "bad_format", "repairable", "total_rows", "duplicate_rows", "key_collisions",
)


def calendar_days(spark: SparkSession, start: date, end: date) -> DataFrame:
    return spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("d"))


def present_days(df: DataFrame, spec: TableSpec, start: date, end: date) -> DataFrame:
    """Distinct days with data; at most one row per day of the range after the map-side combine."""
    return in_month(drop_junk(df, spec), spec, start, end).select(spec.day().alias("d")).distinct()


def days_frame(spark: SparkSession, days: list[date]) -> DataFrame:
    """A handful of calendar days as rows."""
    return spark.createDataFrame([(d,) for d in days], "d date")


def missing_dates(df: DataFrame, spec: TableSpec, start: date, end: date) -> DataFrame:
    """Days of the range without a row. Both sides are bounded by the days of the range."""
    days = calendar_days(df.sparkSession, start, end)
    return days.join(F.broadcast(present_days(df, spec, start, end)), "d", "left_anti")


def order_days(df: DataFrame) -> DataFrame:
    return df.orderBy("d")


def date_runs(days: DataFrame, by: str | None = None) -> DataFrame:
    """Runs of adjacent days: one row per run with its first and last day.

    The window sees calendar days of one table (``by``), never data rows.
    """
    by_cols = [by] if by else []
    numbered = days.withColumn("run", F.date_sub("d", F.row_number().over(Window.partitionBy(*by_cols).orderBy("d"))))
    runs = numbered.groupBy(*by_cols, "run").agg(F.min("d").alias("min_date"), F.max("d").alias("max_date"))
    return runs.drop("run")


def chunk_runs(runs: DataFrame, days: int = 7) -> DataFrame:
    """Every run cut into windows of at most ``days`` days."""
    starts = F.explode(F.sequence("min_date", "max_date", F.make_dt_interval(F.lit(days))))
    others = [c for c in runs.columns if c not in ("min_date", "max_date")]
    cut = runs.select(*others, starts.alias("start"), "max_date")
    return cut.select(
        *others, F.to_date("start").alias("min_date"),
        F.least(F.date_add(F.to_date("start"), days - 1), F.col("max_date")).alias("max_date"),
    )


# --- format ---------------------------------------------------------------------------------------------------------


def _any(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, parts, F.lit(False))


def is_bad_format(spec: TableSpec) -> Column:
    """Some format column is not strict; null and empty values count."""
    return _any([~F.coalesce(D.strict_mdy(F.col(f"`{c}`")), F.lit(False)) for c in spec.format_columns])


def is_repairable(spec: TableSpec) -> Column:
    """Some format column holds a known variant that a repair would rewrite."""
    return _any([D.repairable(F.col(f"`{c}`")) for c in spec.format_columns])


def is_unparseable(spec: TableSpec) -> Column:
    """Two definitions: ``parse`` (no day can be read) or ``shape`` (neither known shape; null does not count)."""
    stored = F.col(f"`{spec.date_column}`")
    if spec.unparseable_by == "parse":
        return spec.day().isNull()
    if spec.unparseable_by == "shape":
        return F.coalesce(~(D.loose_mdy(stored) | D.iso_like(stored)), F.lit(False))
    return F.lit(False)


def bad_format(df: DataFrame, spec: TableSpec, start: date, end: date) -> DataFrame:
    """Rows of the month with a bad format, and how many a repair would change; one pass."""
    return in_month(df, spec, start, end).agg(
        F.count_if(is_bad_format(spec)).alias("bad_format"), F.count_if(is_repairable(spec)).alias("repairable")
    )


def unparseable(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows of the whole table whose audit day cannot be read."""
    return drop_junk(df, spec).agg(F.count_if(is_unparseable(spec)).alias("unparseable"))


def month_facts(df: DataFrame, spec: TableSpec, start: date, end: date) -> DataFrame:
    """Days present, unparseable, bad and repairable rows of a month: one pass, one row.

    The set of days is bounded by the range. Where the table is partitioned by month, only the month and the rows
    without a readable day are read, and the latter are all that can be unparseable.
    """
    scope = month_bounds(df, start, end)
    if MONTH in df.columns:
        scope = scope | (F.col(MONTH) == NO_MONTH)
    marked = df.where(scope).select(
        spec.day().alias("d"), spec.keep().alias("keep"), is_unparseable(spec).alias("unparseable"),
        is_bad_format(spec).alias("bad"), is_repairable(spec).alias("repairable"),
    ).withColumn("inside", F.coalesce(F.col("d").between(F.lit(start), F.lit(end)), F.lit(False)))
    return marked.agg(
        F.sort_array(F.collect_set(F.when(F.col("keep") & F.col("inside"), F.col("d")))).alias("days"),
        F.count_if(F.col("keep") & F.col("unparseable")).alias("unparseable"),
        F.count_if(F.col("inside") & F.col("bad")).alias("bad_format"),
        F.count_if(F.col("inside") & F.col("repairable")).alias("repairable"),
    )


def repair_formats(df: DataFrame, spec: TableSpec, start: date | None = None, end: date | None = None) -> DataFrame:
    """Rewrite known date variants to the strict text; other values stay. With bounds, only rows of that range."""
    inside = F.lit(True) if start is None else F.coalesce(spec.within(start, end), F.lit(False))
    fixed = {
        c: F.when(inside, D.repaired_text(F.col(f"`{c}`"))).otherwise(F.col(f"`{c}`")) for c in spec.format_columns
    }
    return df.withColumns(fixed) if fixed else df


# --- duplicates -----------------------------------------------------------------------------------------------------


def _identities(df: DataFrame, keys: list[Column]) -> DataFrame:
    """Distinct rows with their number of copies. Copies are merged before the shuffle, so a hot row is one record. The digest
    goes as its 32 bytes; as text it has 64."""
    return df.groupBy(*keys, F.unhex(X.row_digest(df)).alias("row_id")).agg(F.count(F.lit(1)).alias("copies"))


def full_row_dups(df: DataFrame) -> DataFrame:
    """Total rows, distinct rows, and their difference."""
    return _identities(df, []).agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_rows"),
    )


def key_collisions(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that several different rows share, with the number of rows and of different rows."""
    named = [F.col(f"`{k}`") for k in keys]
    grouped = _identities(df, named).groupBy(*named).agg(
        F.sum("copies").alias("n_rows"), F.count(F.lit(1)).alias("n_distinct")
    )
    return grouped.where("n_distinct > 1")


def duplicate_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """Row, duplicate and collision counts in one go: two combined aggregations over 32-byte identities."""
    named = [F.col(f"`{k}`") for k in keys]
    per_key = _identities(df, named).groupBy(*named).agg(
        F.sum("copies").alias("n_rows"), F.count(F.lit(1)).alias("n_distinct")
    )
    return per_key.agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.col("n_rows") - F.col("n_distinct")), F.lit(0)).alias("duplicate_rows"),
        F.count_if(F.col("n_distinct") > 1).alias("key_collisions"),
    )


def drop_exact_dups(df: DataFrame) -> DataFrame:
    """One copy of every row."""
    return df.dropDuplicates()


# --- source comparison and roll-up ------------------------------------------------------------------------------------


def confirmed_empty(missing: DataFrame, source: DataFrame, spec: TableSpec) -> DataFrame:
    """Missing days that the source has no rows for either."""
    days = source.select(spec.day().alias("d")).where(F.col("d").isNotNull()).distinct()
    return missing.join(days, "d", "left_anti")


def audit_summary(results: DataFrame, total_days: int) -> DataFrame:
    """Status text per table from its counters. ``results`` has ``table_name``, ``error`` and the counters."""
    fixed = (F.col("backfilled_rows") > 0) | (F.col("bad_format") > 0) | (F.col("duplicate_rows") > 0)
    warned = (F.col("unparseable") > 0) | (F.col("key_collisions") > 0)
    severity = F.when(F.col("error").isNotNull(), 2).when(fixed | warned, 1).otherwise(0)
    fixes = (
        (F.col("backfilled_rows") > 0).cast("int") + (F.col("bad_format") > 0).cast("int")
        + (F.col("duplicate_rows") > 0).cast("int")
    )
    return (
        results.withColumn("days_after", F.lit(total_days) - F.col("confirmed_empty"))
        .withColumn("severity", severity)
        .withColumn("fixes", fixes)
        .withColumn("status", F.when(F.col("severity") == 2, "failed").when(F.col("severity") == 1, "attention")
                    .otherwise("clean"))
    )


def overall_status(summary: DataFrame) -> DataFrame:
    """One row over all tables: the worst severity and the number of kinds of fixes made."""
    rolled = summary.agg(F.max("severity").alias("worst"), F.sum("fixes").alias("fixes"))
    return rolled.select(
        F.when(F.col("worst") == 2, "completed with errors")
        .when((F.col("worst") == 1) & (F.col("fixes") > 0),
              F.concat(F.col("fixes").cast("string"), F.lit(" issue(s) found and fixed")))
        .when(F.col("worst") == 1, "issue(s) found, needs review")
        .otherwise("all clean").alias("overall"),
        "fixes",
    )
