"""Report sync: stored table and landed report -> rows to append, for all six tables."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rosterlake.operators import incremental as I
from rosterlake.operators.filters import drop_junk
from rosterlake.session import cut_lineage, observed, written
from rosterlake.sources import outbox, tables
from rosterlake.specs import (
    FIRST_TIMERS_TEXT, FIRST_TIMERS_TYPED, RESERVATIONS_TEXT, RESERVATIONS_TYPED, SALES_TEXT, SALES_TYPED, TableSpec,
)
from rosterlake.streaming.appends import key_index


@dataclass(frozen=True)
class Sync:
    """Result of a sync. ``span`` is None when the table was caught up; then ``rows`` is empty."""

    span: tuple[date, date] | None
    rows: DataFrame


def sync(source: DataFrame, stored: DataFrame, spec: TableSpec, as_of: date,
         override: tuple[date, date] | None = None, strict_reference: bool = False) -> Sync:
    """Rows of ``source`` between the high-water mark and the last finished day that are not stored.

    All windows of the run are one span and one plan. Only the mark, a single date, comes to the driver.
    """
    mark = override[0] if override else I.read_mark(stored, spec, as_of)
    span = I.sync_span(mark, as_of, override)
    if span is None:
        return Sync(None, source.limit(0))
    return Sync(span, I.incremental_append(source, stored, spec, span, strict_reference=strict_reference))


def sync_sales(source: DataFrame, stored: DataFrame, as_of: date, spec: TableSpec = SALES_TEXT, **options) -> Sync:
    if spec not in (SALES_TEXT, SALES_TYPED):
        raise ValueError(f"not a sales table: {spec.name}")
    return sync(source, stored, spec, as_of, **options)


def sync_first_timers(source: DataFrame, stored: DataFrame, as_of: date, spec: TableSpec = FIRST_TIMERS_TEXT,
                      **options) -> Sync:
    if spec not in (FIRST_TIMERS_TEXT, FIRST_TIMERS_TYPED):
        raise ValueError(f"not a first-timers table: {spec.name}")
    return sync(source, stored, spec, as_of, **options)


def sync_reservations(source: DataFrame, stored: DataFrame, as_of: date, spec: TableSpec = RESERVATIONS_TYPED,
                      **options) -> Sync:
    if spec not in (RESERVATIONS_TEXT, RESERVATIONS_TYPED):
        raise ValueError(f"not a reservations table: {spec.name}")
    return sync(source, stored, spec, as_of, **options)


def stored_mark(spark: SparkSession, path: str, spec: TableSpec, as_of: date, default_days: int = 7) -> date:
    """The last stored day of a month-partitioned table: the newest month of the folder listing is scanned, and an older
    one only where that one holds nothing but junk. Rows without a readable day lie in a month of their own and are not
    looked at; a table without days is marked ``default_days`` before ``as_of``."""
    stored = tables.open_table(spark, path)
    for month in tables.months(spark, path):
        day = drop_junk(stored.where(F.col(tables.MONTH) == month), spec).agg(F.max(spec.day()).alias("day")).first()["day"]
        if day is not None:
            return day
    return as_of - timedelta(days=default_days)


def sync_table(source: DataFrame, path: str, spec: TableSpec, as_of: date, job: str = "sync", override: tuple[date, date] | None = None,
               ) -> DataFrame:
    """A whole run on a stored table: mark, rows to append, append, run record. Returns the record, one row.

    The mark comes from the newest month, id keys are looked up in the table's list of keys, and what the record tells
    is observed while the rows are written, so nothing is read a second time for it.
    """
    spark = source.sparkSession
    mark = override[0] if override else stored_mark(spark, path, spec, as_of)
    span = I.sync_span(mark, as_of, override)
    if span is None:
        return outbox.counted_run(spark, job, 0, 0)
    dated = spec.date_column in spec.keys
    index = None if dated else key_index(spark, path, spec)
    offered = Observation(f"{job} offered")
    seen = source.where(tables.month_bounds(source, *span) & spec.within(*span)).observe(offered, F.count(F.lit(1)).alias("n"))
    held = written(seen)
    rows = I.incremental_append(held, tables.open_table(spark, path), spec, span, index=index)
    appended = Observation(f"{job} appended")
    if index is not None:
        rows = cut_lineage(rows)
        index.begin()
    tables.append(rows.select(*[f"`{c}`" for c in spec.names]).observe(appended, F.count(F.lit(1)).alias("n")), path, spec)
    if index is not None:
        index.add(I.with_keys(rows, spec))
    imported = observed(appended)
    return outbox.counted_run(spark, job, imported, observed(offered) - imported)


def apply_sync(result: Sync, path: str, spec: TableSpec, plan: bool = False) -> DataFrame:
    """Append the rows; with ``plan`` nothing is written. Returns the rows that were (or would be) appended.

    The rows are cut off from the stored table first: once appended, they would no longer count as new.
    """
    if plan or result.span is None:
        return result.rows
    rows = cut_lineage(result.rows)
    tables.append(rows.select(*[f"`{c}`" for c in spec.names]), path, spec)
    return rows
