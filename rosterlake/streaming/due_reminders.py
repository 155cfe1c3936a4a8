"""Reminders that go out when their hour is due: bookings come as a stream, an hourly batch takes what is due.

Three tables make up the state. ``pending`` holds what may be owed a reminder, partitioned by the day of the class, so that an
hourly batch reads the two or three days ahead and no others, and in them the stretches of files that its hours are in. ``latest`` holds every state a booking has been in, dealt into buckets by its
id: whether a booking is still pending, and for which start, is decided when it is due. ``sent`` holds what went out, dealt alike.
All three only grow by appends, and both lookups read the buckets of the bookings that are due, no more.

A reminder is due from the hour in which the class is ``REMINDER_HOURS`` ahead until the class begins. A booking that comes later
than that is due at once; one whose class has begun is not reminded of, nor one that is no longer pending by then. A booking that
is moved to another start is reminded of at that start. Bookings without an id or a start are never due.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rosterlake.plans.lifecycle import due_span
from rosterlake.session import cut_lineage
from rosterlake.sources import keyed_tables as KT
from rosterlake.sources.files import Files

DAY = "start_day"
ID = "reservation_id"


_DAY = 86_400


def _day(start: Column) -> Column:
    """Days since 1970 in UTC, whatever the session's zone."""
    return F.floor(F.unix_timestamp(start) / _DAY)


def _seconds(at: datetime) -> int:
    """A moment given as UTC without a zone."""
    return int(at.replace(tzinfo=timezone.utc).timestamp())


@dataclass(frozen=True)
class Reminders:
    """The state of the reminders under one folder."""

    spark: SparkSession
    home: str
    buckets: int = KT.BUCKETS

    @property
    def pending(self) -> str:
        return f"{self.home}/pending"

    def _table(self, name: str, like: DataFrame) -> KT.KeyedTable:
        path = f"{self.home}/{name}"
        if not Files(self.spark, path).exists(f"{path}/{KT.FACTS}"):
            Files(self.spark, path).remove(path)
            KT.create(like.limit(0), path, [ID], self.buckets)
        return KT.open_keyed(self.spark, path)

    @staticmethod
    def _append(table: KT.KeyedTable, rows: DataFrame) -> None:
        table.dealt(rows.select(*table.schema.names)).hint("rebalance", KT.BUCKET).write.mode("append").partitionBy(KT.BUCKET).parquet(table.path)

    def take(self, bookings: DataFrame, batch: int, version: Column | None = None) -> None:
        """Take in one micro-batch. Later batches overrule earlier ones; inside a batch the largest ``version`` does, and where
        that is equal, the state that is not pending. Taking a batch again changes nothing."""
        states = bookings.where(F.col(ID).isNotNull()).select(
            ID, F.col("start_datetime").cast("timestamp").alias("start"),
            F.coalesce((F.col("status") == "pending") & (F.col("reservation_type") == "standard"), F.lit(False)).alias("pending"),
            F.lit(batch).cast("bigint").alias("batch"), (F.lit(0) if version is None else version).alias("version"))
        held = cut_lineage(states)
        self._append(self._table("latest", held), held)
        owed = held.where(F.col("pending") & F.col("start").isNotNull()).select(ID, "start").distinct().withColumn(DAY, _day(F.col("start")))
        owed.hint("rebalance", DAY).sortWithinPartitions("start").write.mode("append").partitionBy(DAY).parquet(self.pending)

    def due(self, now: datetime) -> DataFrame:
        """Bookings to remind of at ``now``: ``reservation_id`` and ``start``, each once."""
        if not Files(self.spark, self.home).exists(self.pending):
            raise ValueError(f"no bookings were taken into {self.home}")
        latest = KT.open_keyed(self.spark, f"{self.home}/latest")
        end = _seconds(due_span(None, now)[1])
        schema = f"{ID} {latest.schema[ID].dataType.simpleString()}, start timestamp, {DAY} bigint"
        owed = self.spark.read.schema(schema).parquet(self.pending).where(
            F.col(DAY).between(_seconds(now) // _DAY, end // _DAY) & (F.col("start") > F.timestamp_seconds(F.lit(_seconds(now))))
            & (F.col("start") < F.timestamp_seconds(F.lit(end))))
        asked = cut_lineage(owed.select(ID, "start").distinct())
        order = F.struct("batch", "version", (~F.col("pending")).alias("over"), "start")
        states = latest.rows(latest.touched(asked)).join(asked.select(ID).distinct(), ID, "left_semi")
        current = states.groupBy(ID).agg(F.max_by(F.struct("pending", "start"), order).alias("now"))
        still = current.where("now.pending").select(ID, F.col("now.start").alias("start"))
        return asked.join(still, [ID, "start"], "left_semi")

    def remind(self, now: datetime) -> DataFrame:
        """Record what is due and was not sent yet; returns these rows. Doing it again at the same time sends nothing."""
        due = cut_lineage(self.due(now).withColumn("sent_at", F.timestamp_seconds(F.lit(_seconds(now)))))
        sent = self._table("sent", due)
        gone = sent.rows(sent.touched(due)).select(ID, "start")
        new = cut_lineage(due.join(gone, [ID, "start"], "left_anti"))
        self._append(sent, new)
        return new

    def sent(self) -> DataFrame:
        """Everything that went out."""
        return KT.open_keyed(self.spark, f"{self.home}/sent").rows()

    def forget(self, now: datetime) -> list[int]:
        """Remove the days whose classes have all begun; nothing in them can be due again."""
        files, today = Files(self.spark, self.home), _seconds(now) // _DAY
        days = [n.partition("=")[2] for n in files.names(self.pending) if n.startswith(f"{DAY}=")]
        over = [int(d) for d in days if d.isdigit() and int(d) < today]
        for day in over:
            files.remove(f"{self.pending}/{DAY}={day}")
        return over


def take_stream(bookings: DataFrame, reminders: Reminders, checkpoint: str, version: Column | None = None) -> StreamingQuery:
    """Take in the bookings that have landed, and stop when that is done. The hourly batch is ``reminders.remind``."""
    return (
        bookings.writeStream.foreachBatch(lambda batch, number: reminders.take(batch, number, version))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
