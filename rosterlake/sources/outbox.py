"""What leaves the system: payload files, message log rows, run records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUN_SCHEMA = T.StructType([
    T.StructField("job", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("imported", T.LongType()),
    T.StructField("ignored", T.LongType()),
    T.StructField("issues", T.StringType()),
])


def to_payload(df: DataFrame, columns: Sequence[str | Column] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """One JSON text per row. Null fields are left out; columns in ``keep`` stay beside the payload."""
    body = F.struct(*(columns or df.columns))
    return df.select(*keep, F.to_json(body).alias("payload"))


def write_outbox(payloads: DataFrame, path: str) -> None:
    """Append payload texts as lines; a delivery service reads the folder."""
    payloads.select("payload").write.mode("append").text(path)


def log_rows(delivered: DataFrame, kind: str, email: str = "email") -> DataFrame:
    """One log row per delivered message."""
    return delivered.select(F.col(email).alias("email"), F.lit(kind).alias("type"))


def run_record(df: DataFrame, job: str, imported: Column, issue: Column | None = None) -> DataFrame:
    """One row about a run: counts of imported and ignored rows, and the distinct kinds of issue.

    ``imported`` is a condition on ``df``; ``issue`` is a short reason code, null for rows without one. Reason
    codes are few, so collecting the distinct ones is bounded; the rejected rows themselves stay a table.
    """
    issue = F.lit(None).cast("string") if issue is None else issue
    counted = df.agg(
        F.count_if(imported).alias("imported"),
        F.count_if(~F.coalesce(imported, F.lit(False))).alias("ignored"),
        F.nullif(F.array_join(F.array_sort(F.collect_set(issue)), "\n"), F.lit("")).alias("issues"),
    )
    return counted.select(
        F.lit(job).alias("job"),
        F.when(F.col("issues").isNull(), "completed").otherwise("issue").alias("status"),
        "imported", "ignored", "issues",
    )


def counted_run(spark: SparkSession, job: str, imported: int, ignored: int) -> DataFrame:
    """The record of a run whose counts were taken while its rows were written."""
    return spark.createDataFrame([(job, "completed", imported, ignored, None)], RUN_SCHEMA)


def failed_run(spark: SparkSession, job: str, error: str) -> DataFrame:
    return spark.createDataFrame([(job, "problem", 0, 0, error)], RUN_SCHEMA)
