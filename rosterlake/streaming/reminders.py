"""Counts of class starts by hour, and reminders on arrival, as streams. Reminders by due time are in ``due_reminders``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rosterlake.session import cut_lineage
from rosterlake.sources.files import Files
from rosterlake.sources.key_index import KeyIndex


def _pending(bookings: DataFrame) -> DataFrame:
    return bookings.where((F.col("status") == "pending") & (F.col("reservation_type") == "standard"))


def write_hours(bookings: DataFrame, path: str, checkpoint: str, at: str = "start_datetime") -> StreamingQuery:
    """Keep a table of all hours up to date, the ones that are still open too. Nothing is ever too late: the state is one
    count for each hour of the calendar, and the table is written anew after each batch."""
    hour = F.window(at, "1 hour")
    counts = _pending(bookings).groupBy(hour).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("hour"), "n")
    return (
        counts.writeStream.outputMode("complete")
        .foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(path))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def reminder_stream(bookings: DataFrame) -> DataFrame:
    """Each pending booking once, however often and however late it is delivered; the checkpoint remembers which ones went
    out. Its state grows with the bookings: for many of them take ``write_reminders``."""
    return _pending(bookings).dropDuplicates(["reservation_id"])


def remind_batch(batch: DataFrame, path: str) -> None:
    """Append the pending bookings of one micro-batch that the table of reminders does not hold. Running a batch again adds
    nothing. Which ones it holds is looked up in the buckets of the batch's own ids."""
    due = cut_lineage(_pending(batch).select("reservation_id").distinct())
    spark, index = due.sparkSession, KeyIndex(due.sparkSession, path, ["reservation_id"])
    index.ready(spark.read.schema(due.schema).parquet(path) if Files(spark, path).exists(path) else due.limit(0))
    sent = index.held(due).select(F.col("reservation_id").alias("_sent"))
    new = cut_lineage(due.join(sent, F.col("reservation_id").eqNullSafe(F.col("_sent")), "left_anti"))
    index.begin()
    new.write.mode("append").parquet(path)
    index.add(new)


def write_reminders(bookings: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keep a table of all bookings that a reminder is owed, as they arrive. The table itself says which ones are new: classes start in
    another order than their bookings come, so a watermark on the start would drop bookings that nobody was reminded of."""
    return (
        bookings.writeStream.foreachBatch(lambda batch, _: remind_batch(batch, path))
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
