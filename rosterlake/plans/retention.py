"""Guarded deletes on stored tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlake.operators.keyed import DELETE_CAP, guarded_delete
from rosterlake.sources.tables import MONTH, open_table, replace_table, rewrite_months


def purge(df: DataFrame, doomed: DataFrame, keys: Sequence[str], cap: int = DELETE_CAP, share: float = 0.0) -> DataFrame:
    """Rows that stay."""
    return guarded_delete(df, doomed, keys, cap, share)


def apply_purge(spark: SparkSession, path: str, doomed: DataFrame, keys: Sequence[str], cap: int = DELETE_CAP,
                plan: bool = False) -> DataFrame:
    """Delete in a stored table, or with ``plan`` only return what would stay. Returns the table after the delete.

    A table partitioned by month keeps its partitions, and only those that hold a doomed row are rewritten.
    """
    stored = open_table(spark, path)
    kept = purge(stored, doomed, keys, cap)
    if plan:
        return kept
    held = stored.join(doomed.select(*keys).distinct(), list(keys), "left_semi")
    if MONTH not in stored.columns:
        replace_table(kept, path, expected=stored.count() - held.count())
        return spark.read.parquet(path)
    months = {r[MONTH]: r["n"] for r in held.groupBy(MONTH).agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a month
    touched = F.col(MONTH).isin(list(months))
    if months:
        before = stored.where(touched).groupBy(MONTH).agg(F.count(F.lit(1)).alias("n")).collect()
        emptied = [r[MONTH] for r in before if r["n"] == months[r[MONTH]]]
        rewrite_months(kept.where(touched), path, emptied, sum(r["n"] for r in before) - sum(months.values()))
    return spark.read.parquet(path)
