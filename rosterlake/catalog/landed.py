"""From landed files to stored tables: the effects of reading, appending, replacing, creating and dry runs.

Every query writes its files with the library's own writers under the shared folder and returns what a reader finds.
"""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlake import specs
from rosterlake.catalog import audits, syncs
from rosterlake.catalog.base import DealtTables, Tables, d_map, query
from rosterlake.catalog.reports import SOURCES
from rosterlake.plans import audit
from rosterlake.plans import ratings as R
from rosterlake.plans import sync
from rosterlake.session import checkpoint_dir
from rosterlake.sources import entities, reports, tables, uploads

FT, SALES = specs.FIRST_TIMERS_TEXT, specs.SALES_TEXT


def _home(t: Tables) -> str:
    return f"{checkpoint_dir(t.spark)}/landed-{uuid.uuid4().hex}"


def land(t: Tables, spec: specs.TableSpec, path: str) -> None:
    """The report of a table as files of envelopes, each with its headers and a page of rows."""
    view, cells = SOURCES[spec]
    reports.write_report(getattr(t, view).select(F.array(*[F.col(c).cast("string") for c in cells]).alias("row")), spec.headers, path,
                         compression="gzip")


def landed_report(t: Tables, spec: specs.TableSpec, home: str) -> DataFrame:
    land(t, spec, f"{home}/report")
    return reports.read_table_report(t.spark, f"{home}/report", spec, lines=True)


def _sync(t: Tables, spec: specs.TableSpec, plan: bool) -> DataFrame:
    """Land, store what was there before, sync the landed files into it, read the table."""
    home, job = _home(t), syncs.JOBS[spec][1]
    report = landed_report(t, spec, home).where(spec.day() >= F.date_sub(F.lit(syncs.CUT), 3))
    tables.write_table(syncs.stored(t, spec).select(*spec.names), f"{home}/table", spec)
    stored = t.spark.read.parquet(f"{home}/table")
    sync.apply_sync(job(report, stored, syncs.AS_OF, spec=spec), f"{home}/table", spec, plan=plan)
    return t.spark.read.parquet(f"{home}/table").select(*spec.names)


_FT_NAMES = ", ".join(FT.names)
_FT_CTES = syncs._ctes(FT, *SOURCES[FT])
query("s07_c02_landed_sync", ("first_timers_report",), f"SELECT {_FT_NAMES} FROM stored UNION ALL SELECT {_FT_NAMES} FROM fresh",
      _FT_CTES)(lambda t: _sync(t, FT, plan=False))
query("t09_dry_run_sync", ("first_timers_report",), f"SELECT {_FT_NAMES} FROM stored", _FT_CTES)(lambda t: _sync(t, FT, plan=True))


@query("s01_s03_landed_sales", ("sales_report",), f"SELECT {d_map(SALES, SALES.names)} FROM sales_report")
def _landed(t):
    return landed_report(t, SALES, _home(t))


@query("s10_replace_month", audits.SV, f"""
  SELECT {audits.SALES_COLUMNS} FROM stored WHERE d IS NULL OR NOT d {audits.MONTH}
  UNION ALL SELECT DISTINCT {audits.SALES_COLUMNS} FROM fixed UNION ALL SELECT {audits.SALES_COLUMNS} FROM filled""", audits._SFILL)
def _replaced(t):
    """The audit of a stored table in place: its month is replaced under a row count, the backfill appended."""
    path = f"{_home(t)}/table"
    tables.write_table(audits.sales_stored(DealtTables(t.spark, t.folder)), path, SALES, dealt=True)
    audit.apply_audit(SALES, path, audits.sales_source(t), "2000-03", audits.TODAY)
    return t.spark.read.parquet(path).select(*SALES.names)


@query("s08_ensure_table", ("first_timers_report",), f"SELECT {_FT_NAMES} FROM stored", _FT_CTES)
def _ensured(t):
    """Creating a table that is there changes nothing; one that is not there is made empty, and takes an append."""
    path = f"{_home(t)}/table"
    tables.ensure_table(t.spark, path, FT.schema)
    tables.append(syncs.stored(t, FT).select(*FT.names), path)
    return tables.ensure_table(t.spark, path, FT.schema)


@query("s05_read_csv", ("ratings_upload",), """
  SELECT contact, date_text, rating_text, coalesce(comment, '') AS comment, coalesce(class_type, '') AS class_type,
    coalesce(instructor, '') AS instructor FROM ratings_upload""")
def _csv(t):
    """An upload with free header order, quoted commas and blanks, in files of a few rows."""
    path = f"{_home(t)}/upload"
    headers = R.DEFAULT_HEADERS
    named = t.ratings_upload.select(*[F.col(c).alias(f" {h.upper()} ") for c, h in reversed(headers.items())])
    (named.write.option("header", True).option("quoteAll", True).option("escape", '"').option("emptyValue", "")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return uploads.read_mapped_csv(t.spark, path, headers)


@query("s04_read_entities", ("users",), """
  SELECT cast(user_id AS varchar) AS id, email, first_name, full_name, date_joined, marketing_opt_in FROM users""")
def _paged(t):
    """Entity pages as files, read with their schema."""
    path = f"{_home(t)}/pages"
    fields = [f.name for f in entities.USER["attributes"].dataType.fields]
    users = t.users.select(F.col("user_id").cast("string").alias("id"), F.struct(*[
        F.col(c) if c == "marketing_opt_in" else F.col(c).cast("string").alias(c) for c in fields]).alias("attributes"))
    entities.write_entities(users, path)
    return entities.read_entities(t.spark, path, entities.USER, lines=True).select(
        "id", "email", "first_name", "full_name", "date_joined", "marketing_opt_in")


def _two(t: Tables):
    return [(SALES, audits.sales_stored(t), audits.sales_source(t)), (audits.BOOKED, audits.booked_stored(t), audits.booked_source(t))]


@query("c04_two_tables_one_fails", audits.SV, audits._summary_select("sales_text") + """
  UNION ALL SELECT 'reservations_text', 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, NULL, 31, 2, 0, 'failed'""",
       {**audits._SFILL, **audits._summary(SALES, audits._SBAD, audits._SFIX, "order_status <> 'Order Status'", "d IS NULL", audits.SALES_COLUMNS)})
def _isolated(t):
    """One table whose rows cannot be read while the audit runs; the other one is audited all the same."""
    spec, stored, source = _two(t)[1]
    broken = stored.withColumn(spec.date_column, F.raise_error(F.lit("unreadable")).cast("string"))
    return audit.monthly_audit([_two(t)[0], (spec, broken, source)], "2000-03", date(2000, 4, 5))[1].withColumn(
        "error", F.lit(None).cast("string"))
