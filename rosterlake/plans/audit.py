"""Monthly audit of one stored table: gaps, formats, duplicates, backfill, roll-up."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlake.operators import incremental as I
from rosterlake.operators import quality as Q
from rosterlake.operators.filters import drop_junk, in_month
from rosterlake.session import cut_lineage
from rosterlake.sources import tables
from rosterlake.specs import TableSpec


@dataclass(frozen=True)
class Audit:
    """What an audit found and what the month should look like afterwards."""

    repaired: DataFrame
    backfill: DataFrame
    counters: DataFrame


def repaired_month(stored: DataFrame, spec: TableSpec, start: date, end: date) -> DataFrame:
    """The rows of the month with strict dates and without exact duplicates."""
    return Q.drop_exact_dups(Q.repair_formats(in_month(stored, spec, start, end), spec))


def on_days(source: DataFrame, spec: TableSpec, days: list[date]) -> DataFrame:
    """The source rows on some days of a month, staged, since a backfill looks at them more than once. The days are literals,
    so only the months concerned are read."""
    if not days:
        return source.limit(0)
    return cut_lineage(source.where(tables.month_bounds(source, days[0], days[-1]) & spec.day().isin(days)))


def backfill(stored: DataFrame, source: DataFrame, spec: TableSpec, missing: list[date]) -> DataFrame:
    """Source rows on the missing days whose key is not stored near them."""
    return fill(stored, on_days(source, spec, missing), spec, missing)


def fill(stored: DataFrame, wanted: DataFrame, spec: TableSpec, missing: list[date]) -> DataFrame:
    """Rows of the missing days whose key is not stored near them: from three days before the first to three days after the
    last missing day."""
    if not missing:
        return wanted
    held = drop_junk(in_month(stored, spec, *I.buffered(missing[0], missing[-1], after=I.LATE_DAYS)), spec)
    return I.append_rows(wanted, held, spec)


def find_missing(stored: DataFrame, spec: TableSpec, start: date, end: date) -> list[date]:
    """Missing days of the month, on the driver: at most one value per day."""
    return sorted(r["d"] for r in Q.missing_dates(stored, spec, start, end).collect())


def around(stored: DataFrame, spec: TableSpec, start: date, end: date) -> DataFrame:
    """The stored rows that an audit of the range looks at: its days, the days its backfill looks keys up in, and rows whose day
    cannot be read. Of a table that is partitioned by month only these partitions are scanned."""
    near = I.buffered(start, end, after=I.LATE_DAYS)
    scope = tables.month_bounds(stored, *near)
    if tables.MONTH in stored.columns:
        scope = scope | (F.col(tables.MONTH) == tables.NO_MONTH)
    return stored.where(scope & (F.coalesce(spec.within(*near), F.lit(False)) | spec.day().isNull()))


def audit_table(stored: DataFrame, source: DataFrame, spec: TableSpec, start: date, end: date) -> Audit:
    """The ordered repair of one month: read gaps, fix formats, count and remove duplicates, backfill.

    The rows that matter, those of the month and of some days around it and those without a readable day, are read once and
    staged; everything else is taken from them. One pass brings the month's days and format counts to the driver (a single row).
    With the missing days as literals, the backfill is skipped when there are none, and their source rows are read once.
    Duplicates are counted after the repair, since two copies of a row may differ only in how they write a date. Nothing is
    written to the table.
    """
    stored = cut_lineage(around(stored, spec, start, end))
    facts = Q.month_facts(stored, spec, start, end).first()
    calendar = [start + timedelta(days=i) for i in range((end - start).days + 1)]
    missing = [d for d in calendar if d not in set(facts["days"])]
    wanted = on_days(source, spec, missing)
    filled = fill(stored, wanted, spec, missing)
    fixed = Q.repair_formats(in_month(stored, spec, start, end), spec)

    parts = [
        Q.duplicate_counts(fixed, list(spec.keys)),
        filled.agg(F.count(F.lit(1)).alias("backfilled_rows")),
        wanted.agg(F.count_distinct(spec.day()).alias("backfilled_days")),
    ]
    rows = _as_metrics(parts)
    known = {"days_present": len(facts["days"]), "missing_days": len(missing), "unparseable": facts["unparseable"],
             "bad_format": facts["bad_format"], "repairable": facts["repairable"]}
    wide = rows.agg(*[F.max(F.when(F.col("metric") == c, F.col("value"))).alias(c)
                      for part in parts for c in part.columns])
    wide = wide.withColumns({c: F.lit(v).cast("bigint") for c, v in known.items()})
    if not missing:
        wide = wide.withColumn("backfilled_days", F.lit(0).cast("bigint"))
    counters = wide.withColumn("confirmed_empty", F.col("missing_days") - F.col("backfilled_days")).select(
        F.lit(spec.name).alias("table_name"), *Q.COUNTERS, F.lit(None).cast("string").alias("error"))
    return Audit(repaired_month(stored, spec, start, end), filled, counters)


def _as_metrics(parts: list[DataFrame]) -> DataFrame:
    """Single-row aggregates as (metric, value) rows, so that they can be put side by side without a join."""
    out = None
    for part in parts:
        pairs = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("bigint").alias("value"))
                          for c in part.columns])
        rows = part.select(F.explode(pairs).alias("m")).select("m.metric", "m.value")
        out = rows if out is None else out.unionByName(rows)
    return out


def monthly_audit(inputs: list[tuple[TableSpec, DataFrame, DataFrame]], month: str, today: date
                  ) -> tuple[dict[str, Audit], DataFrame]:
    """Audit several tables for one finished month. A table whose audit fails, when it is planned or when it runs, is
    reported as failed and the others go on. The counters of each table, one row, are taken here."""
    from rosterlake.functions.dates import audit_month

    start, end = audit_month(month, today)
    audits, rows = {}, []
    spark = inputs[0][1].sparkSession
    for spec, stored, source in inputs:
        try:
            found = audit_table(stored, source, spec, start, end)
            rows.append(tuple(found.counters.first()))
            audits[spec.name] = found
        except Exception as error:  # a missing column, a changed header or an unreadable file of one table
            rows.append((spec.name, *[0] * len(Q.COUNTERS), str(error).splitlines()[0]))
    cells = ", ".join(f"{c} bigint" for c in Q.COUNTERS)
    results = spark.createDataFrame(rows, f"table_name string, {cells}, error string")
    return audits, Q.audit_summary(results, (end - start).days + 1)


def apply_audit(spec: TableSpec, path: str, source: DataFrame, month: str, today: date, plan: bool = False
                ) -> DataFrame:
    """Audit a month-partitioned table in place; with ``plan`` only report. Returns the counter row.

    The month is replaced from a staged copy whose row count must be the distinct count found, then the backfill is
    appended. The counters are taken before anything changes.
    """
    from rosterlake.functions.dates import audit_month

    start, end = audit_month(month, today)
    spark = source.sparkSession
    stored = tables.open_table(spark, path)
    found = audit_table(stored, source, spec, start, end)
    if plan:
        return found.counters
    counters = cut_lineage(found.counters)
    numbers = counters.first()
    filled = cut_lineage(found.backfill)
    if numbers["repairable"] or numbers["duplicate_rows"]:
        tables.replace_months(found.repaired, path, spec, numbers["total_rows"] - numbers["duplicate_rows"])
    if numbers["backfilled_rows"]:
        tables.append(filled, path, spec)
    return counters
