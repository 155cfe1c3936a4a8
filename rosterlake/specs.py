"""The six landed tables: report headers, column kinds, keys, audit date and junk rule, in one place."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterlake.functions import dates as D
from rosterlake.functions import text as X

# Report headers, in report order.
SALES_HEADERS = (
    "Order Number", "Order Status", "Order Date (UTC)", "Order Time (UTC)", "Order Device", "Processed by System?",
    "Customer ID", "Customer Email", "Customer Name", "Company Name", "Broker ID", "Broker Email", "Broker Name",
    "Product", "Product ID", "Variant ID", "Product Barcode", "Product SKU", "Product Color", "Product Size",
    "Product Type", "Vendor", "Sub Category", "Line Status", "Transaction Date", "Currency", "Line Quantity",
    "Line Subtotal", "Original Price", "Line Tax", "Line Total", "Order Payment Method(s)", "Purchase Location",
    "Fulfillment Location", "Fulfillment Region",
)
FIRST_TIMER_HEADERS = (
    "Customer", "Customer ID", "Customer Email", "Customer Phone Number", "Join Date", "First Class Date",
    "Class Start Time", "Class Location", "Class Type", "Class Category", "Instructor Name", "Guest Reservation?",
    "Pay With Type",
)
RESERVATION_HEADERS = (
    "Reservation ID", "Reservation Type", "Status", "Creation Date", "Updated Date", "Cancelled Date",
    "Unconverted Guest", "Converted Guest", "Guest", "Guest Email", "Credit Payment Origin", "Credit", "Package",
    "Membership", "Contract", "Class ID", "Class Start Date", "Class Start Time", "Class Day of Week",
    "Class Custom Name", "Class Is Public?", "Class Tags", "Class Is Free?", "Class Type", "Class Category",
    "Class Duration (Minutes)", "Layout", "Layout Format", "Layout Capacity", "Class Capacity", "Classroom",
    "Location", "Region", "Instructor ID(s)", "Instructor Employee ID(s)", "Instructor Names",
    "Instructor Schedule Names", "Class Has Substitute?", "Customer ID", "Customer Email", "Customer Name",
    "Company Name", "Payer ID", "Payer Email", "Payer Name", "Broker ID", "Broker Email", "Broker Name", "Spot",
    "Spot Type",
)

#: How a report cell (always text) becomes a stored value, and the stored type.
KINDS: dict[str, tuple[Callable[[Column], Column], T.DataType]] = {
    "text": (lambda c: c.cast("string"), T.StringType()),
    "filled": (X.null_to_empty, T.StringType()),
    "mdy": (D.to_mdy, T.StringType()),
    "time12": (D.to_time12h, T.StringType()),
    "flag_text": (X.bool_text, T.StringType()),
    "flag_word": (X.bool_string, T.StringType()),
    "date": (D.date_only, T.DateType()),
    "float": (X.to_float, T.DoubleType()),
    "int": (X.to_int, T.LongType()),
    "bool": (X.to_bool, T.BooleanType()),
}


def snake_name(header: str) -> str:
    """``Order Payment Method(s)`` -> ``order_payment_methods``."""
    return re.sub(r"[^A-Za-z0-9 ]", "", header).lower().replace(" ", "_")


def spaced_name(header: str) -> str:
    """``Order Payment Method(s)`` -> ``Order Payment Method_s_``."""
    return re.sub(r"[^A-Za-z0-9 ]", "_", header)


@dataclass(frozen=True)
class TableSpec:
    """One landed table. ``date_kind`` says how the audit date is stored: ``date``, ``us`` text or ``mixed`` text."""

    name: str
    headers: tuple[str, ...]
    names: tuple[str, ...]
    kinds: tuple[str, ...]
    keys: tuple[str, ...]
    date_column: str
    date_kind: str
    format_columns: tuple[str, ...] = ()
    junk: Callable[[], Column] | None = None
    window_days: int = 7
    unparseable_by: str = "none"

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, KINDS[k][1]) for n, k in zip(self.names, self.kinds)])

    def cell(self, position: int, value: Column) -> Column:
        """The stored column for the report cell at ``position``."""
        return KINDS[self.kinds[position]][0](value).alias(self.names[position])

    def day(self) -> Column:
        """The audit day of a stored row; the only expression that may be compared with a date."""
        stored = F.col(f"`{self.date_column}`")
        if self.date_kind == "date":
            return stored
        return D.tolerant_date(stored) if self.date_kind == "us" else D.tolerant_date_any(stored)

    def within(self, start: date, end: date) -> Column:
        """Audit day in the closed range: a plain range for a stored date (the scan can use it), else one parse."""
        if self.date_kind == "date":
            return self.day().between(F.lit(start), F.lit(end))
        return D.day_within(self.day(), start, end)

    def keep(self) -> Column:
        """True for rows that are data."""
        return self.junk() if self.junk else F.lit(True)

    def key_value(self, column: str) -> Column:
        """A key column as text that is never null, so that plain equality compares keys and joins can share a shuffle.

        In text layouts an empty value and a null are the same key; in typed layouts a null is a key of its own.
        """
        text_layout = all(isinstance(f.dataType, T.StringType) for f in self.schema.fields)
        return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit("" if text_layout else NO_VALUE))


#: Stands for a null in a key of a typed layout; no stored text holds this character.
NO_VALUE = "\u0000"


def _kinds(headers: tuple[str, ...], default: str, **special: tuple[str, ...]) -> tuple[str, ...]:
    by_header = {h: kind for kind, members in special.items() for h in members}
    unknown = set(by_header) - set(headers)
    if unknown:
        raise ValueError(f"not in the report: {sorted(unknown)}")
    return tuple(by_header.get(h, default) for h in headers)


_SALES_KEY = ("Order Number", "Product ID", "Variant ID", "Transaction Date", "Line Status", "Line Quantity")
_SALES_DATES = ("Order Date (UTC)", "Transaction Date")
_FIRST_TIMER_DATES = ("Join Date", "First Class Date")
_RESERVATION_DATES = ("Creation Date", "Updated Date", "Cancelled Date", "Class Start Date")

SALES_TEXT = TableSpec(
    name="sales_text",
    headers=SALES_HEADERS,
    names=tuple(snake_name(h) for h in SALES_HEADERS),
    kinds=_kinds(SALES_HEADERS, "filled", mdy=_SALES_DATES, time12=("Order Time (UTC)",),
                 flag_text=("Processed by System?",)),
    keys=tuple(snake_name(h) for h in _SALES_KEY),
    date_column="transaction_date",
    date_kind="us",
    format_columns=("order_date_utc", "transaction_date"),
    junk=lambda: F.col("order_status") != "Order Status",
    unparseable_by="parse",
)

SALES_TYPED = TableSpec(
    name="sales_typed",
    headers=SALES_HEADERS,
    names=tuple(spaced_name(h) for h in SALES_HEADERS),
    kinds=_kinds(
        SALES_HEADERS, "text", date=_SALES_DATES, bool=("Processed by System?",),
        float=("Product Barcode", "Line Subtotal", "Original Price", "Line Tax", "Line Total"),
        int=("Customer ID", "Broker ID", "Product ID", "Variant ID", "Line Quantity"),
    ),
    keys=tuple(spaced_name(h) for h in _SALES_KEY),
    date_column="Transaction Date",
    date_kind="date",
    window_days=2,
)

FIRST_TIMERS_TEXT = TableSpec(
    name="first_timers_text",
    headers=FIRST_TIMER_HEADERS,
    names=tuple(f"string_field_{i}" for i in range(len(FIRST_TIMER_HEADERS))),
    kinds=_kinds(FIRST_TIMER_HEADERS, "filled", mdy=_FIRST_TIMER_DATES, time12=("Class Start Time",),
                 flag_text=("Guest Reservation?",)),
    keys=("string_field_1",),
    date_column="string_field_5",
    date_kind="us",
    format_columns=("string_field_4", "string_field_5"),
    junk=lambda: (F.col("string_field_1") != "Customer ID") & F.col("string_field_0").isNotNull()
    & ~F.col("string_field_0").like("#%"),
    unparseable_by="parse",
)

FIRST_TIMERS_TYPED = TableSpec(
    name="first_timers_typed",
    headers=FIRST_TIMER_HEADERS,
    names=tuple(spaced_name(h) for h in FIRST_TIMER_HEADERS),
    kinds=_kinds(FIRST_TIMER_HEADERS, "text", date=_FIRST_TIMER_DATES, time12=("Class Start Time",),
                 int=("Customer ID",), bool=("Guest Reservation?",)),
    keys=("Customer ID",),
    date_column="First Class Date",
    date_kind="date",
    window_days=2,
)

RESERVATIONS_TEXT = TableSpec(
    name="reservations_text",
    headers=RESERVATION_HEADERS,
    names=tuple(snake_name(h) for h in RESERVATION_HEADERS),
    kinds=_kinds(
        RESERVATION_HEADERS, "text", mdy=_RESERVATION_DATES, time12=("Class Start Time",),
        flag_word=("Unconverted Guest", "Converted Guest", "Guest", "Class Is Public?", "Class Is Free?",
                   "Class Has Substitute?"),
    ),
    keys=("reservation_id",),
    date_column="class_start_date",
    date_kind="mixed",
    format_columns=("class_start_date", "creation_date", "updated_date", "cancelled_date"),
    window_days=2,
    unparseable_by="shape",
)

RESERVATIONS_TYPED = TableSpec(
    name="reservations_typed",
    headers=RESERVATION_HEADERS,
    names=tuple(spaced_name(h) for h in RESERVATION_HEADERS),
    kinds=_kinds(RESERVATION_HEADERS, "text", date=_RESERVATION_DATES, int=("Reservation ID",),
                 bool=("Class Is Public?",)),
    keys=("Reservation ID",),
    date_column="Class Start Date",
    date_kind="date",
    junk=lambda: F.col("`Reservation ID`").isNotNull(),
)

ALL_SPECS = (SALES_TEXT, SALES_TYPED, FIRST_TIMERS_TEXT, FIRST_TIMERS_TYPED, RESERVATIONS_TEXT, RESERVATIONS_TYPED)

#: Score history, one row per person and population.
SCORE_SCHEMA = T.StructType([
    T.StructField("email", T.StringType()),
    T.StructField("population", T.StringType()),
    T.StructField("first_name", T.StringType()),
    T.StructField("last_name", T.StringType()),
    T.StructField("booking_customer_id", T.StringType()),
    T.StructField("last_visit_date", T.DateType()),
    T.StructField("churn_prob", T.DoubleType()),
    T.StructField("likely_permanent_prob", T.DoubleType()),
    T.StructField("tier", T.StringType()),
    T.StructField("previous_tier", T.StringType()),
    T.StructField("key_signal", T.StringType()),
    T.StructField("updated_date", T.DateType()),
])

#: Every stored table with the columns it is declared with.
STORED: dict[str, T.StructType] = {**{spec.name: spec.schema for spec in ALL_SPECS}, "scores": SCORE_SCHEMA}
