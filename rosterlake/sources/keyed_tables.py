"""Tables that are changed by key: parquet folders dealt into buckets by a hash of the key.

A change reads, rewrites and swaps the buckets that its keys fall into; all other files stay as they are. The number of
buckets is written beside the data, so every job deals rows out alike.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterlake.operators import keyed as K
from rosterlake.session import cut_lineage
from rosterlake.sources import swap
from rosterlake.sources.files import Files

BUCKET = "key_bucket"
BUCKETS = 64
#: Spark's readers pass over names that begin with an underscore.
FACTS = "_keyed.json"


@dataclass(frozen=True)
class KeyedTable:
    """Where a table is, its key, into how many buckets it is dealt, and its columns."""

    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    buckets: int
    schema: T.StructType

    def dealt(self, df: DataFrame) -> DataFrame:
        """``df`` with its bucket. Keys are cast as they are stored, since a hash depends on the type."""
        return df.withColumn(BUCKET, bucket(self.keys, self.buckets))

    def touched(self, changes: DataFrame) -> list[int]:
        """Buckets of the keys of ``changes``; no more values than the table has buckets."""
        return sorted(r[0] for r in self.dealt(changes).select(BUCKET).distinct().collect())

    def rows(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """All rows, or those of some buckets by a partition filter."""
        stored = self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())])).parquet(self.path)
        return (stored if buckets is None else stored.where(F.col(BUCKET).isin(list(buckets)))).drop(BUCKET)


def bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(buckets)).cast("int")


def create(df: DataFrame, path: str, keys: Sequence[str], buckets: int = BUCKETS) -> KeyedTable:
    """Write a new keyed table. Rows are dealt out by bucket first, and a large bucket to several tasks."""
    table = KeyedTable(df.sparkSession, path.rstrip("/"), tuple(keys), buckets, df.schema)
    table.dealt(df).hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(table.path)
    Files(df.sparkSession, path).write(f"{table.path}/{FACTS}", json.dumps({"keys": list(keys), "buckets": buckets, "schema": df.schema.jsonValue()}))
    return table


def open_keyed(spark: SparkSession, path: str) -> KeyedTable:
    """A keyed table as it was written, after finishing or undoing what an earlier job left open."""
    swap.recover(spark, path)
    facts = json.loads(Files(spark, path).read(f"{path.rstrip('/')}/{FACTS}"))
    return KeyedTable(spark, path.rstrip("/"), tuple(facts["keys"]), facts["buckets"], T.StructType.fromJson(facts["schema"]))


def change(table: KeyedTable, changes: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame],
           expected: Callable[[DataFrame, DataFrame], int]) -> list[int]:
    """Rewrite the touched buckets with what ``merge`` makes of their rows and the changes; returns these buckets.

    ``changes`` is written once, so that it is the same rows when its buckets are listed, merged and counted. ``expected``
    counts the merged rows in another way; a replacement of another size is refused. A bucket without rows left goes.
    """
    held = cut_lineage(changes)
    touched = table.touched(held)
    if touched:
        current = table.rows(touched)
        merged = table.dealt(merge(current, held)).hint("rebalance", BUCKET)
        swap.replace(merged, table.path, BUCKET, [str(b) for b in touched], expected(current, held))
    return touched


def merge_scores(table: KeyedTable, batch: DataFrame, as_of: date) -> list[int]:
    """Merge a run's scores into the stored history: matched rows keep their old tier, new ones have none, all others stay.
    ``batch`` has one row for each (email, population)."""
    def size(current: DataFrame, new: DataFrame) -> int:
        return current.count() + new.join(current, list(table.keys), "left_anti").count()

    return change(table, batch, lambda current, new: K.merge_scores(current, new, as_of).select(*current.columns), size)


def upsert_customers(table: KeyedTable, people: DataFrame, order: str = "reservation_id") -> list[int]:
    """Upsert people into stored customers, bucketed by ``email_lower``; marked duplicates and unmarked rows stay."""
    keyed = people.where(F.coalesce(F.col("email"), F.lit("")) != "").withColumn("email_lower", F.lower("email"))

    def size(current: DataFrame, new: DataFrame) -> int:
        own = current.where(F.col("dupe").eqNullSafe(F.lit("No")))
        return current.count() + new.select("email_lower").distinct().join(own, "email_lower", "left_anti").count()

    return change(table, keyed, lambda current, new: K.upsert_customers(current, new.drop("email_lower"), order).select(*current.columns), size)


def replace_children(table: KeyedTable, fresh: DataFrame, parents: DataFrame) -> list[int]:
    """Give each of the ``parents`` the ``fresh`` rows as its children, bucketed by the parent's key, in place of those it has; a
    parent without fresh rows ends up with none. Fresh rows of other parents are refused."""
    (key,) = table.keys
    named = parents.select(key).distinct().where(F.col(key).isNotNull())
    if not fresh.join(named, key, "left_anti").isEmpty():
        raise ValueError("fresh rows of a parent that is not replaced")
    marked = named.withColumn("_child", F.lit(None).cast(fresh.schema)).unionByName(fresh.select(key, F.struct(*fresh.columns).alias("_child")))

    def children(new: DataFrame) -> DataFrame:
        return new.where(F.col("_child").isNotNull()).select("_child.*")

    def size(current: DataFrame, new: DataFrame) -> int:
        return current.join(new.select(key).distinct(), key, "left_anti").count() + children(new).count()

    return change(table, marked, lambda current, new: K.replace_children(current, children(new).select(*current.columns), new, key), size)


def compact(table: KeyedTable, most: int = 8) -> list[int]:
    """Rewrite the buckets that appends have left with more than ``most`` files."""
    files = Files(table.spark, table.path)
    many = [int(n.partition("=")[2]) for n in files.names(table.path) if n.startswith(f"{BUCKET}=")
            and sum(f.endswith(".parquet") for f in files.names(f"{table.path}/{n}")) > most]
    if many:
        rows = table.rows(many)
        swap.replace(table.dealt(rows).hint("rebalance", BUCKET), table.path, BUCKET, [], rows.count())
    return many
