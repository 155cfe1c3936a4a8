"""Append stream without duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rosterlake.operators import incremental as I
from rosterlake.operators.filters import in_month
from rosterlake.session import cut_lineage
from rosterlake.sources import tables
from rosterlake.sources.files import Files
from rosterlake.sources.key_index import KeyIndex
from rosterlake.specs import TableSpec


def key_index(spark: SparkSession, path: str, spec: TableSpec) -> KeyIndex:
    """The list of keys of a stored table, made or mended if need be."""
    index = KeyIndex(spark, path, I.key_names(spec))
    index.ready(I.with_keys(stored_rows(spark, path, spec), spec))
    return index


def stored_rows(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """The rows of a table, none where there is no table yet. Whatever else keeps a table from being read fails."""
    if not Files(spark, path).exists(path):
        return spark.createDataFrame([], spec.schema)
    return tables.open_table(spark, path)


def append_batch(batch: DataFrame, path: str, spec: TableSpec) -> None:
    """Append the rows of one micro-batch whose key the table does not hold. Running a batch again adds nothing.

    Of equal keys in a batch the first whole row stays. The batch is written once before it is looked at twice. Where
    the key holds the day, only the stored months around the days of the batch are read (its span, one row, comes to
    the driver); a batch with a day that cannot be read looks everywhere. Keys without a day are looked up in a list of
    the stored keys, in the buckets of the batch's own.
    """
    spark = batch.sparkSession
    held = cut_lineage(batch)
    if spec.date_column in spec.keys:
        stored = stored_rows(spark, path, spec)
        span = held.agg(F.min(spec.day()), F.max(spec.day()), F.count_if(spec.day().isNull())).first()
        if span[0] is not None and not span[2]:
            stored = in_month(stored, spec, *I.buffered(span[0], span[1]))
        tables.append(I.append_rows(held, stored, spec), path, spec)
        return
    index = key_index(spark, path, spec)
    new = cut_lineage(I.append_rows(held, None, spec, held=index.held(I.key_frame(held, spec))))
    index.begin()
    tables.append(new, path, spec)
    index.add(I.with_keys(new, spec))


def stream_append(stream: DataFrame, spec: TableSpec, path: str, checkpoint: str) -> StreamingQuery:
    """Start the stream over what has landed, and stop when that is done.

    The table itself says which keys are new, however late they come: a watermark in front of it would drop late rows
    that were never stored. The stream keeps no state of its own.
    """
    return (
        stream.writeStream.foreachBatch(lambda batch, _: append_batch(batch, path, spec))
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def landed_stream(spark: SparkSession, folder: str, spec: TableSpec) -> DataFrame:
    """Stream of mapped rows over a folder that report files land in."""
    from rosterlake.sources.reports import REPORT_SCHEMA, assert_headers, map_report, report_rows

    files = spark.readStream.schema(REPORT_SCHEMA).option("multiLine", True).json(folder)
    return map_report(report_rows(assert_headers(files, spec)), spec)
