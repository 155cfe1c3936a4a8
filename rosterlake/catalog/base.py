"""Registration of queries and the plumbing they share."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterlake import surrogates

#: Fixed reference days of the test data, one for sales and one for bookings.
SALES_DAY = date(2001, 6, 30)
BOOKING_DAY = date(2024, 1, 15)
BOOKING_NOW = datetime(2024, 1, 15, 9, 20)


class Tables:
    """The views of one data folder, derived when they are asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in surrogates.VIEWS:
            raise AttributeError(name)
        return surrogates.view(self.spark, self.folder, name)


class DealtTables(Tables):
    """Views whose rows go to a stored table: dealt out by month while they are narrow."""

    def __getattr__(self, name: str) -> DataFrame:
        if name not in surrogates.ROWS_OF:
            raise AttributeError(name)
        return surrogates.dealt_view(self.spark, self.folder, name)


@dataclass(frozen=True)
class Query:
    run: Callable[[Tables], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, views: tuple[str, ...] = (), sql: str | None = None, ctes: dict[str, str] | None = None):
    """Register a query. ``sql`` is the body of its check, over ``views`` and the extra ``ctes``."""

    def register(run: Callable[[Tables], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"registered twice: {name}")
        text = None
        if sql is not None:
            parts = [f"{v} AS ({surrogates.VIEWS[v].text(surrogates.DuckText())})" for v in surrogates.chain(views)]
            parts += [f"{n} AS ({body})" for n, body in (ctes or {}).items()]
            text = ("WITH " + ", ".join(parts) + " " if parts else "") + sql.strip()
        REGISTRY[name] = Query(lambda t: flat(run(t)), text)
        return run

    return register


def flat(df: DataFrame) -> DataFrame:
    """Plain column types for a comparison: days and times as text, whole numbers as 64 bits, doubles to 6 places."""

    def plain(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return c.cast("string").alias(f.name)
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            return c.cast("bigint").alias(f.name)
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            return F.round(c.cast("double"), 6).alias(f.name)
        return c

    return df.select(*[plain(f) for f in df.schema.fields])


# --- spellings of the checking database ---------------------------------------------------------------------------


def d_norm(c: str) -> str:
    """Loose US date text -> strict text, null otherwise."""
    return (
        f"(lpad(nullif(regexp_extract({c}, '^\\s*(\\d{{1,2}})/', 1), ''), 2, '0') || '/' || "
        f"lpad(nullif(regexp_extract({c}, '/\\s*(\\d{{1,2}})/', 1), ''), 2, '0') || '/' || "
        f"nullif(regexp_extract({c}, '/(\\d{{4}})\\s*$', 1), ''))"
    )


def d_us(c: str) -> str:
    return f"cast(try_strptime({d_norm(c)}, '%m/%d/%Y') AS date)"


def d_iso(c: str) -> str:
    return f"cast(try_strptime({c}, '%Y-%m-%d') AS date)"


def d_any(c: str) -> str:
    return f"coalesce({d_us(c)}, {d_iso(c)})"


def d_strict(c: str) -> str:
    return f"regexp_matches({c}, '^\\d{{2}}/\\d{{2}}/\\d{{4}}$')"


def d_loose(c: str) -> str:
    return f"regexp_matches({c}, '^\\s*\\d{{1,2}}/\\s*\\d{{1,2}}/\\d{{4}}\\s*$')"


def d_iso_like(c: str) -> str:
    return f"regexp_matches({c}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}')"


def d_iso_mdy(c: str) -> str:
    return f"strftime(try_strptime({c}, '%Y-%m-%d'), '%m/%d/%Y')"


def d_repaired(c: str) -> str:
    return f"coalesce(CASE WHEN {d_loose(c)} THEN {d_norm(c)} WHEN {d_iso_like(c)} THEN {d_iso_mdy(c)} END, {c})"


def d_local(c: str) -> str:
    """UTC timestamp -> wall clock in the studios' zone."""
    return f"timezone('America/Toronto', timezone('UTC', {c}))"


def d_email(c: str) -> str:
    return f"lower(trim({c}))"


def d_is_email(c: str) -> str:
    return f"coalesce(regexp_matches(trim({c}), '^[^\\s@]+@[^\\s@]+\\.[^\\s@]+$'), false)"


def d_float(c: str) -> str:
    shape = "^\\s*[-+]?(\\d+\\.?\\d*|\\.\\d+)([eE][-+]?\\d+)?\\s*$"
    return f"CASE WHEN regexp_matches({c}, '{shape}') THEN try_cast(trim({c}) AS double) END"


def d_int(c: str) -> str:
    return f"try_cast(nullif(regexp_extract({c}, '^\\s*([-+]?\\d+)', 1), '') AS bigint)"


def d_time12(c: str) -> str:
    hour = f"cast(nullif(regexp_extract(split_part({c}, ':', 1), '^\\s*(\\d+)', 1), '') AS integer)"
    minute = f"coalesce(nullif(split_part({c}, ':', 2), ''), '00')"
    return (
        f"coalesce(cast(CASE WHEN {hour} % 12 = 0 THEN 12 ELSE {hour} % 12 END AS varchar) || ':' || "
        f"lpad({minute}, 2, '0') || CASE WHEN {hour} >= 12 THEN ' PM' ELSE ' AM' END, '')"
    )


def d_mdy(c: str) -> str:
    part = [f"nullif(split_part(substr({c}, 1, 10), '-', {i}), '')" for i in (1, 2, 3)]
    return f"coalesce({part[1]} || '/' || {part[2]} || '/' || {part[0]}, '')"


D_KINDS: dict[str, Callable[[str], str]] = {
    "text": lambda c: c,
    "filled": lambda c: f"coalesce({c}, '')",
    "mdy": d_mdy,
    "time12": d_time12,
    "flag_text": lambda c: f"coalesce(lower({c}), '')",
    "flag_word": lambda c: f"CASE WHEN {c} IS NOT NULL THEN CASE WHEN lower({c}) = 'true' THEN 'true' ELSE 'false' END END",
    "date": lambda c: f"cast({d_iso(f'substr({c}, 1, 10)')} AS varchar)",
    "float": lambda c: f"round({d_float(c)}, 6)",
    "int": d_int,
    "bool": lambda c: f"(lower({c}) = 'true')",
}


def d_map(spec, cells: tuple[str, ...], typed_dates: bool = False) -> str:
    """Select list that maps report cells to the stored columns of ``spec``."""
    out = []
    for name, kind, cell in zip(spec.names, spec.kinds, cells):
        expr = D_KINDS[kind](cell)
        if kind == "date" and typed_dates:
            expr = d_iso(f"substr({cell}, 1, 10)")
        out.append(f'{expr} AS "{name}"')
    return ", ".join(out)
