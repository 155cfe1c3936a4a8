"""Streaming forms, run to the end of what has landed."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from rosterlake import specs, surrogates
from rosterlake.catalog.base import d_map, query
from rosterlake.catalog.reports import SOURCES
from rosterlake.session import checkpoint_dir
from rosterlake.streaming import appends, reminders

FT = specs.FIRST_TIMERS_TEXT


def _stream(t, name: str, base: str):
    """A view over a base table that is read as a stream."""
    schema = t.spark.read.parquet(f"{t.folder}/{base}.parquet").schema
    files = t.spark.readStream.schema(schema).option("pathGlobFilter", f"{base}.parquet").parquet(t.folder)
    text = f"{surrogates.with_clause((name,), surrogates.SparkText())} SELECT * FROM {name}"
    return t.spark.sql(text, **{base: files})


def _home(t) -> str:
    return f"{checkpoint_dir(t.spark)}/stream-{uuid.uuid4().hex}"


@query("t04_stream_append", ("first_timers_report",), f"""
  SELECT {', '.join(FT.names)} FROM mapped
  QUALIFY row_number() OVER (PARTITION BY coalesce(string_field_1, '') ORDER BY {', '.join(f'{c} NULLS FIRST' for c in FT.names)}) = 1""",
       {"mapped": f"SELECT {d_map(FT, SOURCES[FT][1])} FROM first_timers_report"})
def _append(t):
    view, cells = SOURCES[FT]
    rows = _stream(t, view, "orders").select(*[FT.cell(i, F.col(c)) for i, c in enumerate(cells)])
    home = _home(t)
    appends.stream_append(rows, FT, f"{home}/table", f"{home}/state").awaitTermination()
    return t.spark.read.parquet(f"{home}/table").select(*FT.names)


@query("t06_hourly_windows_stream", ("bookings",), """
  SELECT cast(date_trunc('hour', start_datetime) AS varchar) AS hour, count(*) AS n FROM bookings
  WHERE status = 'pending' AND reservation_type = 'standard' AND start_datetime IS NOT NULL GROUP BY 1""")
def _hours(t):
    home = _home(t)
    reminders.write_hours(_stream(t, "bookings", "events"), f"{home}/table", f"{home}/state").awaitTermination()
    return t.spark.read.parquet(f"{home}/table")


@query("t06_reminder_stream", ("bookings",), """
  SELECT DISTINCT reservation_id FROM bookings WHERE status = 'pending' AND reservation_type = 'standard'""")
def _reminders(t):
    home = _home(t)
    reminders.write_reminders(_stream(t, "bookings", "events"), f"{home}/table", f"{home}/state").awaitTermination()
    return t.spark.read.parquet(f"{home}/table")
