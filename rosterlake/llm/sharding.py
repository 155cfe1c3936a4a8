"""A reproducible shuffle into shards: a keyed Feistel permutation with cycle walking over global row numbers.

Everything is a Spark expression. The permutation can be evaluated for one row number alone, so the place of any row is
computed and never looked up; ``place`` and its inverse need only the number of rows, the key and the number of shards.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterlake.llm.common import staged

ROUNDS = 6
#: Steps of the walk that are tried for every row outside; the rare rest takes as many as there can be.
_SHORT_WALK = 8


def _mixed(half: Column, turn: Column, key: int, side: int) -> Column:
    """The round function: a keyed hash of one half, reduced to the other half's range."""
    return F.pmod(F.xxhash64(half, turn, F.lit(key).cast("long")), F.lit(side).cast("long"))


def _permuted(number: Column, side: int, key: int) -> Column:
    """One pass over the square of ``side`` x ``side`` numbers: (a, b) becomes (b, a + mixed(b)) in every round."""
    start = F.struct(F.floor(number / F.lit(side)).cast("long").alias("a"), F.pmod(number, F.lit(side)).cast("long").alias("b"))
    return F.aggregate(
        F.sequence(F.lit(1).cast("long"), F.lit(ROUNDS).cast("long")), start,
        lambda s, turn: F.struct(s["b"].alias("a"), F.pmod(s["a"] + _mixed(s["b"], turn, key, side), F.lit(side).cast("long")).alias("b")),
        lambda s: s["a"] * F.lit(side).cast("long") + s["b"],
    )


def permuted(number: Column, total: int, key: int) -> Column:
    """The permutation of 0 .. total - 1. The square it runs over is at most 2 * sqrt(total) + 1 numbers larger; a number
    that lands outside is permuted again. A walk meets no outside number twice, which bounds it exactly."""
    side = max(1, math.isqrt(max(0, total - 1)) + 1)
    outside = side * side - total

    def walk(value: Column, steps: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(1).cast("long"), steps), value,
                           lambda v, _: F.when(v < F.lit(total), v).otherwise(_permuted(v, side, key)))

    # floor(number / side) goes through a double: exact below 2^53 rows
    first = _permuted(number.cast("long"), side, key)
    if outside <= 0:
        return first
    short = walk(first, F.lit(min(outside, _SHORT_WALK)).cast("long"))
    if outside <= _SHORT_WALK:
        return short
    # the length is tied to the row so that the long sequence is only built for a row that needs it
    return F.transform(F.array(short), lambda v: F.when(v < F.lit(total), v).otherwise(
        walk(v, F.lit(outside).cast("long") + F.least(v, F.lit(0).cast("long")))))[0]


def numbered(df: DataFrame, order: list[str], name: str = "row_number") -> tuple[DataFrame, int]:
    """Global row numbers from 0 without a gap, in the order of ``order``, and how many rows there are.

    Rows are sorted by range, written, counted by partition, and the counts (one row for each partition) are summed up.
    Rows that are equal in ``order`` are interchangeable; a salt lets a hot value fill more than one partition.
    """
    salt = F.monotonically_increasing_id()
    ranged = df.withColumn("_salt", salt).orderBy(*[F.col(c).asc_nulls_first() for c in order], "_salt").drop("_salt")
    placed = staged(ranged.withColumn("_at", F.monotonically_increasing_id()))
    part, within = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    counts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.withColumn("_before", before).drop("_n")
    total = placed.count()
    out = placed.withColumn("_part", part).join(offsets, "_part").withColumn(name, F.col("_before") + within)
    return out.drop("_part", "_before", "_at"), total


def place(number: Column, total: int, shards: int, key: int) -> tuple[Column, Column]:
    """Shard and slot of a row number: the permuted number dealt round, so shards differ by one row at most."""
    at = permuted(number, total, key)
    return F.pmod(at, F.lit(shards)).cast("int"), F.floor(at / F.lit(shards)).cast("long")


def shuffled(docs: DataFrame, shards: int = 8, key: int = 20240115, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row with ``row_number``, ``size`` (UTF-8 bytes of the text, and 1), ``text_crc32``, ``shard`` and ``slot``.

    Only the id, the size and the checksum are moved, not the texts: the result says where a row belongs. Row numbers
    follow (doc_id, checksum, size), nulls first, so the result does not depend on files or partitions. A null text
    counts as empty. Repeated rows are equal in that order and take neighbouring numbers, one each. An empty table gives
    an empty result. Other columns are not read.
    """
    data = F.encode(F.coalesce(F.col(text).cast("string"), F.lit("")), "UTF-8")
    narrow = docs.select(F.col(doc_id).alias("doc_id"), (F.octet_length(data) + 1).cast("long").alias("size"),
                         F.crc32(data).cast("long").alias("text_crc32"))
    rows, total = numbered(narrow, ["doc_id", "text_crc32", "size"])
    at = rows.withColumn("_to", permuted(F.col("row_number"), total, key))
    return at.select("doc_id", "row_number", "size", "text_crc32", F.pmod("_to", F.lit(shards)).cast("int").alias("shard"),
                     F.expr(f"_to div {int(shards)}").alias("slot"))
