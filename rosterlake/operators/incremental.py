"""High-water marks, bounded windows and idempotent appends."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rosterlake.functions.dates import last_finished_day
from rosterlake.operators.filters import drop_junk, in_month
from rosterlake.sources.key_index import KeyIndex
from rosterlake.specs import TableSpec

#: How far the lookup of stored keys reaches beyond the window.
LATE_DAYS = 3


def high_water(df: DataFrame, spec: TableSpec, as_of: date, default_days: int = 7) -> DataFrame:
    """The last stored day, or ``as_of`` minus ``default_days`` for a table without one."""
    default = F.lit(as_of - timedelta(days=default_days))
    return drop_junk(df, spec).agg(F.coalesce(F.max(spec.day()), default).alias("mark"))


def read_mark(df: DataFrame, spec: TableSpec, as_of: date, default_days: int = 7) -> date:
    return high_water(df, spec, as_of, default_days).first()["mark"]


def sync_window(mark: date, days: int, as_of: date, override: tuple[date, date] | None = None
                ) -> tuple[date, date] | None:
    """The next window: from the mark, at most ``days`` days, never past the last finished day; None when caught up."""
    if override:
        return override
    last = last_finished_day(as_of)
    if mark > last:
        return None
    return mark, min(mark + timedelta(days=days - 1), last)


def sync_span(mark: date, as_of: date, override: tuple[date, date] | None = None) -> tuple[date, date] | None:
    """All windows of one run together: Spark takes the whole span in one pass."""
    if override:
        return override
    last = last_finished_day(as_of)
    return None if mark > last else (mark, last)


def chunk_range(spark: SparkSession, start: date, end: date, days: int) -> DataFrame:
    """The windows of a range as rows."""
    step = F.make_dt_interval(F.lit(days))
    starts = spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end), step)).alias("min_date"))
    starts = starts.select(F.to_date("min_date").alias("min_date"))
    return starts.withColumn("max_date", F.least(F.date_add("min_date", days - 1), F.lit(end)))


def buffered(start: date, end: date, before: int = LATE_DAYS, after: int = 0) -> tuple[date, date]:
    return start - timedelta(days=before), end + timedelta(days=after)


def window_index(spec: TableSpec, start: date, days: int) -> Column:
    """Number of the fetch window that a row of the span belongs to."""
    return F.floor(F.datediff(spec.day(), F.lit(start)) / days)


def keep_first(df: DataFrame, keys: list[Column], order: list[Column]) -> DataFrame:
    """One row per key, the first by ``order``.

    Spark limits each key to one row inside every map task before it shuffles, so a key that holds a third of the
    table arrives as one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def key_names(spec: TableSpec) -> list[str]:
    return [f"_key{i}" for i in range(len(spec.keys))]


def with_keys(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The key as plain columns. Ranking, semi join and anti join all partition by them, so one shuffle serves all."""
    return df.withColumns({n: spec.key_value(k) for n, k in zip(key_names(spec), spec.keys)})


def key_frame(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Distinct keys; only the key columns are read, and repeats are merged before the shuffle."""
    return with_keys(df, spec).select(*key_names(spec)).distinct()


def first_fetch(df: DataFrame, spec: TableSpec, start: date) -> DataFrame:
    """All rows of a key from the first window that has it: duplicates inside one fetch stay, later ones go."""
    names = key_names(spec)
    keyed = with_keys(df, spec).withColumn("_window", window_index(spec, start, spec.window_days))
    first = keyed.groupBy(*names).agg(F.min("_window").alias("_window"))
    return keyed.join(first, [*names, "_window"], "left_semi").drop("_window", *names)


def existing_keys(candidates: DataFrame, stored: DataFrame, spec: TableSpec) -> DataFrame:
    """Keys of ``candidates`` that are stored already.

    A semi join against the candidates: the candidates of one run are few, so the large stored side is reduced where
    it is read (broadcast or bloom filter, chosen by size) instead of being shuffled.
    """
    names = key_names(spec)
    held = with_keys(stored, spec).select(*names)
    return held.join(key_frame(candidates, spec), names, "left_semi").distinct()


def new_rows(source: DataFrame, stored: DataFrame, spec: TableSpec, candidates: DataFrame | None = None) -> DataFrame:
    """Rows of ``source`` whose key is not stored, null equal to null in every key column.

    ``candidates`` may name a cheaper frame with the same keys for the lookup.
    """
    held = existing_keys(source if candidates is None else candidates, stored, spec)
    names = key_names(spec)
    return with_keys(source, spec).join(held, names, "left_anti").drop(*names)


def append_rows(batch: DataFrame, stored: DataFrame | None, spec: TableSpec, order: list[Column] | None = None,
                held: DataFrame | None = None) -> DataFrame:
    """First row per key of ``batch`` that is not stored. Ties are broken by the whole row.

    ``held`` are stored keys, as ``key_frame`` names them, where a list of them is at hand; then ``stored`` is not read.
    """
    names = key_names(spec)
    whole_row = [F.col(f"`{c}`") for c in spec.names]
    first = keep_first(with_keys(batch, spec), [F.col(n) for n in names], (order or []) + whole_row)
    known = existing_keys(batch, stored, spec) if held is None else held
    return first.join(known, names, "left_anti").drop(*names)


def incremental_append(source: DataFrame, stored: DataFrame, spec: TableSpec, span: tuple[date, date],
                       order: list[Column] | None = None, strict_reference: bool = False,
                       index: KeyIndex | None = None) -> DataFrame:
    """Rows of the span to append: in the span, first per key, not stored.

    ``strict_reference`` keeps duplicates that arrive in the same fetch window. Keys that hold the date are looked up
    in the stored rows of the buffered span only, id keys in all stored rows, or in the buckets of an ``index``.
    """
    start, end = span
    batch = in_month(source, spec, start, end)
    if spec.date_column in spec.keys:
        stored = in_month(stored, spec, *buffered(start, end))
    elif index is not None and not strict_reference:
        return append_rows(batch, None, spec, order, held=index.held(key_frame(batch, spec)))
    if strict_reference:
        return new_rows(first_fetch(batch, spec, start), stored, spec, candidates=batch)
    return append_rows(batch, stored, spec, order)
