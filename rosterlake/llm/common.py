"""What the text operators share: row keys, staged tables and guarded names."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlake.session import checkpoint_dir, cut_lineage

#: White space that parts words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\x0c\r"

#: Rows that cross to Python at once; with texts of up to some hundred KB a batch stays within some tens of MB.
BATCH_ROWS = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound what one Arrow batch holds. Texts differ a lot in length, so the row count alone must keep it small."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def with_row(df: DataFrame, name: str = "_row") -> DataFrame:
    """Number the rows, so that repeated or null ids never meet. The numbers are stable for a table scan or a staged
    frame; stage anything else first."""
    return df.withColumn(name, F.monotonically_increasing_id())


def free(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet."""
    while name in df.columns:
        name += "_"
    return name


def numbered(df: DataFrame, name: str = "_row") -> DataFrame:
    """Number the rows and write them, so that every later job reads the same numbers, however the cluster has changed. Whole
    texts are packed by a codec that works through streams: one that keeps a buffer outside the heap for each page it has met
    takes an executor's memory until the heap is next swept."""
    return stored(df.withColumn(name, F.monotonically_increasing_id()), "zstd")


def staged(df: DataFrame) -> DataFrame:
    """Write to the shared checkpoint folder and go on from the written rows."""
    return cut_lineage(df)


def stored(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Write as a table to the shared folder and go on from there. For steps with many rows: columns take a fraction of a
    checkpoint's space. The shuffles behind the table are let go, so that a long job holds those of one step at a time."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/step-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return spark.read.parquet(path)


def texts(batch: pa.RecordBatch, column: str = "text") -> Iterator[str]:
    """The texts of a batch, null as empty."""
    for value in batch.column(column):
        yield value.as_py() or ""
