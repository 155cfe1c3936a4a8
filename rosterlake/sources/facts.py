"""Counters of a stored table, kept for each month beside it, so that an audit of the whole table reads what has changed.

A month's facts name the files they were counted from. When they are asked for, the listing of the table is compared with that:
months whose files are others, or which have no facts, are counted anew in one pass, months that are gone lose theirs, and all
others stay as they are. Appends, repairs and purges need not know of it. Facts of months add up to those of the table, since
equal rows have equal days; keys that do not hold the day can meet across months, so their counts are kept beside the facts.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlake.functions import text as X
from rosterlake.operators import quality as Q
from rosterlake.sources import swap, tables
from rosterlake.sources.files import Files
from rosterlake.sources.tables import MONTH
from rosterlake.specs import TableSpec

#: Digests are added up modulo a number that leaves a decimal of 38 digits room for any number of rows.
_MODULUS = 1 << 62
COUNTS = "total_rows bigint, distinct_rows bigint, bad_format bigint, repairable bigint, unparseable bigint, digest decimal(38,0)"
SCHEMA = f"files string, key_collisions bigint, {COUNTS}, {MONTH} string"


@dataclass(frozen=True)
class Facts:
    """The facts of a table's months, the keys of months where these can meet, and the months that were counted just now."""

    months: DataFrame
    keys: DataFrame | None
    recounted: list[str]

    def table(self) -> DataFrame:
        """The counters of the whole table, one row; ``digest`` is the same for the same rows in any order and any files."""
        sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("total_rows", "distinct_rows", "bad_format", "repairable", "unparseable")]
        whole = self.months.agg(*sums, F.coalesce(F.sum("key_collisions"), F.lit(0)).alias("key_collisions"),
                                F.coalesce(_added("digest"), F.lit(0).cast("decimal(38,0)")).alias("digest"))
        whole = whole.withColumn("duplicate_rows", F.col("total_rows") - F.col("distinct_rows"))
        if self.keys is None:
            return whole
        names = [c for c in self.keys.columns if c not in (MONTH, "n_distinct")]
        met = self.keys.groupBy(*names).agg(F.sum("n_distinct").alias("n")).agg(F.count_if(F.col("n") > 1)).first()[0]  # one number
        return whole.withColumn("key_collisions", F.lit(met).cast("bigint"))


def _added(digest: str) -> Column:
    return F.pmod(F.sum(digest), F.lit(_MODULUS)).cast("decimal(38,0)")


def _listing(spark: SparkSession, path: str) -> dict[str, str]:
    """For each month a digest of the names of its files; a month's files are bounded by its size."""
    files, out = Files(spark, path), {}
    for name in files.names(path):
        if name.startswith(f"{MONTH}="):
            held = [f for f in files.names(f"{path}/{name}") if not f.startswith(("_", "."))]
            if held:
                out[name.partition("=")[2]] = hashlib.sha256("\n".join(held).encode()).hexdigest()
    return out


def _counted(rows: DataFrame, spec: TableSpec) -> tuple[DataFrame, DataFrame]:
    """Facts of each month in ``rows``, and its keys with the number of different rows that have them. Rows are shuffled as two
    hashes of their digest, which tell the rows of a key apart by 128 bits, and keys that hold the day as digests: no two months
    share one, so nobody asks for them."""
    meet = spec.date_column not in spec.keys
    keys = [f"_key{i}" for i in range(len(spec.keys))] if meet else ["_key"]
    parts = [F.col(f"`{k}`") for k in spec.keys]
    held = [p.alias(n) for p, n in zip(parts, keys)] if meet else [F.unhex(F.md5(F.to_json(F.struct(*parts)))).alias("_key")]
    data = [c for c in rows.columns if c != MONTH]

    dated = spec.day().isNotNull()
    conditions = {"bad": Q.is_bad_format(spec) & dated, "repair": Q.is_repairable(spec) & dated, "lost": spec.keep() & Q.is_unparseable(spec)}
    bits = {name: 1 << i for i, name in enumerate(conditions)}
    flags = reduce(Column.__add__, [F.when(c, bits[name]).otherwise(0) for name, c in conditions.items()])

    def marked_rows(name: str) -> Column:
        return F.when(F.col("flags").bitwiseAND(F.lit(bits[name])) > 0, F.col("copies")).otherwise(0)

    digest = X.row_digest(rows.select(*[f"`{c}`" for c in data]))
    marked = rows.select(MONTH, *held, F.xxhash64(digest).alias("row_id"), F.xxhash64(F.lit(1), digest).alias("row_id2"), flags.alias("flags"))
    each = marked.groupBy(MONTH, *keys, "row_id", "row_id2", "flags").agg(F.count(F.lit(1)).alias("copies"))
    mixed = F.pmod(F.pmod(F.col("row_id"), F.lit(_MODULUS)).cast("decimal(19,0)") * F.col("copies").cast("decimal(18,0)"), F.lit(_MODULUS)).cast("decimal(20,0)")
    per_key = each.groupBy(MONTH, *keys).agg(
        F.sum("copies").alias("n_rows"), F.count(F.lit(1)).alias("n_distinct"),
        *[F.sum(marked_rows(c)).alias(c) for c in bits],
        F.sum(mixed).alias("mixed"))
    facts = per_key.groupBy(MONTH).agg(
        F.count_if(F.col("n_distinct") > 1).alias("key_collisions"), F.sum("n_rows").alias("total_rows"), F.sum("n_distinct").alias("distinct_rows"),
        F.sum("bad").alias("bad_format"), F.sum("repair").alias("repairable"), F.sum("lost").alias("unparseable"),
        _added("mixed").alias("digest"))
    return facts, per_key.select(MONTH, *keys, "n_distinct")


def refresh(spark: SparkSession, path: str, spec: TableSpec) -> Facts:
    """Bring a table's facts up to date; only months whose files have changed are read."""
    path = path.rstrip("/")
    stored, home = tables.open_table(spark, path), f"{path}.facts"
    files, now = Files(spark, path), _listing(spark, path)
    meet = spec.date_column not in spec.keys
    for part in ("months", "keys"):
        swap.recover(spark, f"{home}/{part}")
    known = spark.read.schema(SCHEMA).parquet(f"{home}/months") if files.exists(f"{home}/months") else spark.createDataFrame([], SCHEMA)
    before = {r[MONTH]: r["files"] for r in known.select(MONTH, "files").collect()}  # a row a month
    stale = sorted(m for m in now if before.get(m) != now[m])
    gone = sorted(m for m in before if m not in now)
    if stale or gone:
        facts, keys = _counted(stored.where(F.col(MONTH).isin(stale)), spec)
        if meet:  # first, so that facts never name files whose keys are not there yet
            swap.replace(keys.hint("rebalance", MONTH), f"{home}/keys", MONTH, gone)
        names = spark.createDataFrame([(m, now[m]) for m in stale], f"{MONTH} string, files string")
        counts = ["key_collisions", *[c.split()[0] for c in COUNTS.split(", ")]]
        whole = names.join(facts, MONTH, "left").select("files", *[F.coalesce(F.col(c), F.lit(0).cast(facts.schema[c].dataType)).alias(c) for c in counts], MONTH)
        swap.replace(whole.coalesce(1), f"{home}/months", MONTH, gone, len(stale))
    months = spark.read.schema(SCHEMA).parquet(f"{home}/months") if stale or gone or before else known
    if not meet:
        return Facts(months, None, stale)
    schema = ", ".join([*[f"_key{i} {stored.schema[k].dataType.simpleString()}" for i, k in enumerate(spec.keys)], "n_distinct bigint", f"{MONTH} string"])
    return Facts(months, spark.read.schema(schema).parquet(f"{home}/keys") if files.exists(f"{home}/keys") else spark.createDataFrame([], schema), stale)
