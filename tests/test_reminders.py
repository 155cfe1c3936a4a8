"""Reminders when bookings come in another order than their classes start."""

from datetime import datetime

from rosterlake.streaming import reminders

CELLS = "reservation_id int, status string, reservation_type string, start_datetime timestamp"


def test_reminders_of_earlier_classes_that_come_later(spark, tmp_path):
    folder, table = str(tmp_path / "in"), str(tmp_path / "table")

    def run(*bookings):
        rows = [(i, "pending", "standard", start) for i, start in bookings]
        spark.createDataFrame(rows, CELLS).coalesce(1).write.mode("append").parquet(folder)
        reminders.write_reminders(spark.readStream.schema(CELLS).parquet(folder), table, str(tmp_path / "state")).awaitTermination()
        return sorted(r["reservation_id"] or 0 for r in spark.read.parquet(table).collect())

    assert run((1, datetime(2026, 8, 1)), (1, datetime(2026, 8, 1))) == [1]
    assert run((2, datetime(2026, 7, 2)), (1, datetime(2026, 8, 1))) == [1, 2]
    assert run((2, datetime(2026, 7, 2)), (3, None), (None, datetime(2026, 6, 1))) == [0, 1, 2, 3]
    assert run((None, datetime(2026, 6, 1)), (1, datetime(2026, 8, 1))) == [0, 1, 2, 3]


def test_reminder_stream_over_batches(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    for booking in ((1, datetime(2026, 8, 1)), (2, datetime(2026, 7, 2)), (1, datetime(2026, 8, 1)), (3, datetime(2026, 7, 1))):
        rows = [(booking[0], "pending", "standard", booking[1])]
        spark.createDataFrame(rows, CELLS).coalesce(1).write.mode("append").parquet(folder)
        due = reminders.reminder_stream(spark.readStream.schema(CELLS).parquet(folder))
        due.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "s")).trigger(availableNow=True).start(out).awaitTermination()
    assert sorted(r["reservation_id"] for r in spark.read.parquet(out).collect()) == [1, 2, 3]
