"""Stored tables: parquet folders, partitioned by audit month where a spec says which day counts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterlake.sources import swap
from rosterlake.sources.files import Files
from rosterlake.sources.swap import RowCountMismatch as RowCountMismatch  # noqa: PLC0414 - part of this module's interface
from rosterlake.specs import TableSpec

MONTH = "audit_month"
#: Partition of rows whose audit day cannot be read.
NO_MONTH = "none"
#: Months that a task writes side by side; Spark sorts the rest of its rows by month if there are more.
OPEN_FILES = 16
#: How dealt rows are written: narrow rows of a task (a quarter of Spark's own size, since they are widened afterwards), and files.
DEALT = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16MB", "spark.sql.maxConcurrentOutputFileWriters": str(OPEN_FILES)}


class TooManyRows(RuntimeError):
    """A delete would remove more rows than its cap allows."""


def month_of(day: Column) -> Column:
    return F.coalesce(F.date_format(day, "yyyy-MM"), F.lit(NO_MONTH))


def with_month(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Add the partition column. A date regex cannot be pushed to a scan; a partition value can."""
    return df.withColumn(MONTH, month_of(spec.day()))


def month_bounds(df: DataFrame, start: date, end: date) -> Column:
    """Partition predicate for a range of days; true for tables that are not partitioned by month."""
    if MONTH not in df.columns:
        return F.lit(True)
    return F.col(MONTH).between(start.strftime("%Y-%m"), end.strftime("%Y-%m"))


def deal(rows: DataFrame, day: Column) -> DataFrame:
    """Rows dealt out by the month of a day, a large month to several tasks. For rows that are narrow yet and are widened on
    their way to ``write_table``: what is shuffled is then a fraction of the table."""
    return rows.withColumn("_dealt", month_of(day)).hint("rebalance", "_dealt").drop("_dealt")


def write_table(df: DataFrame, path: str, spec: TableSpec, mode: str = "errorifexists", dealt: bool = False, apart: str | None = None
                ) -> None:
    """Write a table partitioned by month. Rows are dealt out by month first, and a large month to several tasks, so that
    an append writes a few files for each month and not one for each month and task. Files are packed with zstd.

    ``dealt`` rows went through ``deal`` when they were narrow and are not shuffled again; a task then holds a few months (rows
    without a day lie in any) and writes up to ``OPEN_FILES`` of them side by side, so that wide rows are not sorted either.
    A column named by ``apart`` makes several tables in one pass: the rows of each of its values are a table ``<apart>=<value>``
    of their own below the path.
    """
    df = df if MONTH in df.columns else with_month(df, spec)
    parts = [apart, MONTH] if apart else [MONTH]
    conf = df.sparkSession.conf
    before = {key: conf.get(key) for key in DEALT} if dealt else {}
    for key in before:
        conf.set(key, DEALT[key])
    try:
        (df if dealt else df.hint("rebalance", MONTH)).write.mode(mode).option("compression", "zstd").partitionBy(*parts).parquet(path)
    finally:
        for key, value in before.items():
            conf.set(key, value)


def append(df: DataFrame, path: str, spec: TableSpec | None = None) -> None:
    """Append; Spark's partitions are the batches."""
    if spec is None:
        df.write.mode("append").parquet(path)
    else:
        write_table(df, path, spec, mode="append")


def ensure_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Create an empty table with a declared schema unless there is one already; returns the table."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(path)
    return spark.read.schema(schema).parquet(path)


def open_table(spark: SparkSession, path: str) -> DataFrame:
    """A stored table, after finishing or undoing a replacement that an earlier job did not live to end."""
    swap.recover(spark, path)
    return spark.read.parquet(path)


class SchemaChanged(RuntimeError):
    """A stored table does not have the columns it is declared with."""


def load(spark: SparkSession, folder: str, name: str, schema: T.StructType) -> DataFrame:
    """A stored table by name, with its declared columns in their order and its month where it has one.

    The schema is read from the files, not assumed: a column that is missing, new or of another type fails the load, before
    any job can take nulls for values.
    """
    stored = open_table(spark, f"{folder.rstrip('/')}/{name}")
    found = {f.name: f.dataType.simpleString() for f in stored.schema if f.name != MONTH}
    wanted = {f.name: f.dataType.simpleString() for f in schema}
    odd = [f"{c}: {found.get(c, 'missing')} where {wanted.get(c, 'nothing')} is declared" for c in {**wanted, **found} if found.get(c) != wanted.get(c)]
    if odd:
        raise SchemaChanged(f"{name}: " + "; ".join(odd))
    return stored.select(*[F.col(f"`{c}`") for c in wanted], *([MONTH] if MONTH in stored.columns else []))


def months(spark: SparkSession, path: str) -> list[str]:
    """The months a stored table has partitions of, newest first, from the listing of its folder alone."""
    names = Files(spark, path).names(path.rstrip("/"))
    return sorted((n.partition("=")[2] for n in names if n.startswith(f"{MONTH}=") and n != f"{MONTH}={NO_MONTH}"), reverse=True)


def rewrite_months(df: DataFrame, path: str, emptied: list[str], expected: int | None = None) -> int:
    """Replace the months that ``df`` holds and remove the ``emptied`` ones, from a staged copy with a checked count."""
    return swap.replace(df.hint("rebalance", MONTH), path, MONTH, emptied, expected)


def replace_months(df: DataFrame, path: str, spec: TableSpec, expected: int | None = None) -> int:
    """Replace exactly the months that ``df`` holds, from a staged copy with a checked row count.

    The copy is written before anything is replaced, so ``df`` may be computed from the same folder, and a wrong
    count leaves the table as it was.
    """
    return rewrite_months(df if MONTH in df.columns else with_month(df, spec), path, [], expected)


def replace_table(df: DataFrame, path: str, expected: int | None = None) -> None:
    """Rewrite a whole table from a staged copy with a checked row count; ``df`` may read the same folder."""
    swap.replace(df, path, None, expected=expected)
