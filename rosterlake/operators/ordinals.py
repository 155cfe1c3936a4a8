"""Places in an order, over the whole input or inside groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rosterlake.session import cut_lineage


def dealt_in_order(df: DataFrame, order: list[Column], by: str | None = None) -> DataFrame:
    """``df`` in ranges of (``by``, ``order``), written: ``_group``, ``_part`` (the range) and ``_at`` (the place in the order)
    stand beside its columns. The row's number parts rows that are equal in everything, which else would lie in one range."""
    group = F.lit(0) if by is None else F.col(f"`{by}`")
    keyed = df.withColumns({"_group": group, "_number": F.monotonically_increasing_id()})
    ranged = keyed.repartitionByRange("_group", *order, "_number").sortWithinPartitions("_group", *order, "_number")
    return cut_lineage(ranged.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}).drop("_number"))


def place_in_order(df: DataFrame, order: list[Column], by: str | None = None, name: str = "ordinal") -> DataFrame:
    """Every row with its place, from 1, among the rows of the same ``by``, or among all; equal rows in any order.

    No group is ever gathered. Rows are dealt into ranges, so that a group which a third of all rows belong to spans many
    partitions; each partition counts its own rows, and what earlier partitions hold of a group is summed over one row for each
    partition and group. The dealt rows are written once, so that both steps see the same ranges.
    """
    held = dealt_in_order(df, order, by)
    inside = F.row_number().over(Window.partitionBy("_part", "_group").orderBy("_at"))
    counts = held.groupBy("_group", "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(F.col("_group").alias("_of"), F.col("_part").alias("_in"), F.coalesce(before, F.lit(0)).alias("_before"))
    joined = held.withColumn("_inside", inside).join(offsets, (F.col("_part") == F.col("_in")) & F.col("_group").eqNullSafe(F.col("_of")))
    return joined.withColumn(name, (F.col("_before") + F.col("_inside")).cast("bigint")).select(*[F.col(f"`{c}`") for c in df.columns], name)
