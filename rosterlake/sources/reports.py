"""Positional report files: one JSON object ``{"headers": [...], "rows": [[...], ...]}`` per landed file."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterlake.specs import TableSpec, snake_name

REPORT_SCHEMA = T.StructType([
    T.StructField("headers", T.ArrayType(T.StringType())),
    T.StructField("rows", T.ArrayType(T.ArrayType(T.StringType()))),
])


#: Rows of one envelope: a page of the report, and envelopes of one landed file.
PAGE = 500
FILE_PAGES = 400


def read_report(spark: SparkSession, path: str | list[str], lines: bool = False) -> DataFrame:
    """One row per envelope, with its headers and its rows; numbers and flags arrive as text. An envelope is a file, or with
    ``lines`` a line of one, so that a file of any size is read by many tasks."""
    return spark.read.schema(REPORT_SCHEMA).option("multiLine", not lines).json(path)


def paged(df: DataFrame, entry: Column, page: int = PAGE, name: str = "rows") -> DataFrame:
    """The entries of ``df`` as arrays of at most ``page``, in order. Each task cuts its own rows into pages as they come by, so
    that nothing is shuffled for it and arrays grow in number with the input and never in size."""
    entries = df.select(entry.alias("entry"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = None
        for batch in batches:
            held = batch.column(0) if left is None else pa.concat_arrays([left, batch.column(0)])
            whole = len(held) // page * page
            if whole:
                yield pages(held.slice(0, whole))
            left = held.slice(whole) if whole < len(held) else None
        if left is not None:
            yield pages(left)

    def pages(held: pa.Array) -> pa.RecordBatch:
        ends = [*range(0, len(held), page), len(held)]
        return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(ends, pa.int32()), held)], [name])

    return entries.mapInArrow(cut, T.StructType([T.StructField(name, T.ArrayType(entries.schema["entry"].dataType))]))


def write_report(rows: DataFrame, headers: tuple[str, ...], path: str, page: int = PAGE, compression: str = "none") -> None:
    """Land rows (one column, an array of cells) as a report: envelopes of at most ``page`` rows, one a line. A file takes
    ``FILE_PAGES`` of them, since compressed files are read by one task each."""
    (cells,) = rows.columns
    out = paged(rows, F.col(cells), page).select(F.array(*[F.lit(h) for h in headers]).alias("headers"), "rows")
    out.write.option("ignoreNullFields", False).option("maxRecordsPerFile", FILE_PAGES).option("compression", compression).json(path)


def assert_headers(reports: DataFrame, spec: TableSpec) -> DataFrame:
    """Every file must have exactly the expected headers; the run fails otherwise.

    The check is a column of the plan, so it runs in the same pass as the rows it guards.
    """
    expected = F.array(*[F.lit(h) for h in spec.headers])
    broken = F.concat(
        F.lit(f"headers of a {spec.name} report changed, refusing to guess: "),
        F.coalesce(F.to_json("headers"), F.lit("none")),
    )
    checked = F.when(F.coalesce(F.col("headers") == expected, F.lit(False)), F.col("rows")).otherwise(
        F.raise_error(broken).cast(REPORT_SCHEMA["rows"].dataType)
    )
    return reports.withColumn("rows", checked)


def report_rows(reports: DataFrame) -> DataFrame:
    """One row per report row, as ``row array<string>``."""
    return reports.select(F.explode("rows").alias("row"))


def map_report(rows: DataFrame, spec: TableSpec, keep_raw: tuple[str, ...] = ()) -> DataFrame:
    """Cell i of every row -> the i-th named, typed column; a short row leaves the rest null.

    Cells named in ``keep_raw`` are carried along unchanged as ``raw_<name>``, for jobs that need what the stored
    spelling drops.
    """
    def cell(i: int) -> Column:
        return F.get("row", F.lit(i))

    raw = [cell(spec.headers.index(h)).alias(raw_name(h)) for h in keep_raw]
    return rows.select(*[spec.cell(i, cell(i)) for i in range(len(spec.headers))], *raw)


def raw_name(header: str) -> str:
    return f"raw_{snake_name(header)}"


def read_table_report(spark: SparkSession, path: str | list[str], spec: TableSpec, keep_raw: tuple[str, ...] = (), lines: bool = False
                      ) -> DataFrame:
    """Landed files -> checked, mapped rows of ``spec``."""
    return map_report(report_rows(assert_headers(read_report(spark, path, lines), spec)), spec, keep_raw)


def pick_columns(reports: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """Rows of a report whose header order is free: ``wanted`` maps output names to header names.

    A header that is not there fails the run.
    """
    def position(header: str) -> Column:
        at = F.array_position("headers", header).cast("int")
        missing = F.raise_error(F.lit(f"header not found: {header}")).cast("int")
        return F.when(at > 0, at - 1).otherwise(missing)

    places = reports.select(F.explode("rows").alias("row"), *[position(h).alias(f"at_{n}") for n, h in wanted.items()])
    return places.select(*[F.get("row", F.col(f"at_{n}")).alias(n) for n in wanted])
