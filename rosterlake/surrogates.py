"""Reference-shaped views over the generic star-schema test tables.

The driver's tables are orders, line items, customers and events. Each view below derives one business table from all
rows of them (reports, stored tables with messy dates, bookings, sessions, users, ratings, ...), with the flaws that
the operators are there for: date variants, blanks, duplicates, collisions, unknown keys. The text is one SQL
dialect-neutral definition per view, so that Spark and the checking database start from the same rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlake.sources.tables import deal
from rosterlake.specs import RESERVATIONS_TEXT, SALES_TEXT

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


class SparkText:
    """Spellings of Spark SQL."""

    def table(self, name: str) -> str:
        return "{" + name + "}"

    def add_days(self, day: str, n: str) -> str:
        return f"date_add({day}, cast({n} AS int))"

    def stamp(self, seconds: str) -> str:
        return f"timestamp_seconds({seconds})"

    def seconds(self, ts: str) -> str:
        return f"unix_timestamp(cast({ts} AS timestamp))"

    def array(self, *items: str) -> str:
        return f"array({', '.join(items)})"

    def each(self, items: str) -> str:
        return f"explode({items})"

    def empty_array(self) -> str:
        return "cast(array() AS array<string>)"


class DuckText:
    """Spellings of the checking database."""

    def table(self, name: str) -> str:
        return name

    def add_days(self, day: str, n: str) -> str:
        return f"({day} + cast({n} AS integer))"

    def stamp(self, seconds: str) -> str:
        return f"make_timestamp(cast(({seconds}) * 1000000 AS bigint))"

    def seconds(self, ts: str) -> str:
        return f"cast(floor(epoch({ts})) AS bigint)"

    def array(self, *items: str) -> str:
        return f"[{', '.join(items)}]"

    def each(self, items: str) -> str:
        return f"unnest({items})"

    def empty_array(self) -> str:
        return "cast([] AS varchar[])"


@dataclass(frozen=True)
class View:
    needs: tuple[str, ...]
    text: Callable[[SparkText | DuckText], str]


def _case(value: str, options: list[str], default: str = "NULL") -> str:
    arms = " ".join(f"WHEN {i} THEN {o}" for i, o in enumerate(options))
    return f"CASE {value} {arms} ELSE {default} END"


def _text(value: str) -> str:
    return f"cast({value} AS string)"


def _pad(value: str, n: int = 2) -> str:
    return f"lpad({_text(value)}, {n}, '0')"


def _address(key: str) -> str:
    return f"'customer#' || {_pad(key, 9)} || '@example.com'"


def _noisy(key: str, row: str) -> str:
    """An e-mail with case and blank noise, sometimes empty or missing."""
    plain = _address(key)
    return (f"CASE WHEN {row} % 53 = 0 THEN NULL WHEN {row} % 59 = 0 THEN '' WHEN {row} % 7 = 0 THEN upper({plain}) "
            f"WHEN {row} % 7 = 1 THEN '  ' || {plain} || ' ' ELSE {plain} END")


ITEMS = [
    "'Unlimited - 1 year'", "'Illimité 3 mois'", "'2 classes per week - 4 weeks'", "'8 cours par mois - 1 mois'",
    "'Abonnement 3 ans'", "'Member plan'", "'10 class pack'", "'5 class pack'", "'Single class'",
    "'Bike rental month autorenew'", "'Gift card 50'", "'Water bottle'",
]
TYPES = [
    "'Memberships'", "'Memberships'", "'Memberships'", "'Memberships'", "'Memberships'", "'Memberships'", "'Credits'",
    "'Credits'", "'Credits'", "'Memberships'",
    "CASE l_suppkey % 4 WHEN 0 THEN 'Email Credit Gift Cards' WHEN 1 THEN 'Email Gift Cards' "
    "WHEN 2 THEN 'Physical Credit Gift Cards' ELSE 'Physical Gift Cards' END",
    "'Retail'",
]


def _iso(ts: str) -> str:
    return f"substr({_text(ts)}, 1, 10)"


def _sales_report(d) -> str:
    cells = {
        "order_number": _text("l_orderkey"),
        "order_status": "CASE WHEN l_orderkey % 997 = 3 THEN 'Order Status' WHEN o_orderstatus = 'F' THEN 'Completed' "
                        "WHEN o_orderstatus = 'O' THEN 'Open' ELSE 'Pending' END",
        "order_date_utc": _iso("o_orderdate"),
        "order_time_utc": f"CASE WHEN l_orderkey % 31 = 0 THEN '' ELSE {_pad('l_orderkey % 24')} || ':' || "
                          f"{_pad('l_partkey % 60')} || ':00' END",
        "order_device": _case("l_linenumber % 3", ["'web'", "'ios'"]),
        "processed_by_system": _case("l_suppkey % 3", ["'True'", "'False'"]),
        "customer_id": _text("o_custkey"),
        "customer_email": _noisy("o_custkey", "l_orderkey"),
        "customer_name": f"'Customer ' || {_text('o_custkey')}",
        "company_name": f"CASE WHEN o_custkey % 5 = 0 THEN 'Company ' || {_text('o_custkey % 17')} END",
        "broker_id": f"CASE WHEN l_suppkey % 4 = 0 THEN {_text('l_suppkey')} WHEN l_suppkey % 4 = 1 THEN '' END",
        "broker_email": "CASE WHEN l_suppkey % 4 = 0 THEN 'broker@example.com' END",
        "broker_name": f"CASE WHEN l_suppkey % 4 = 0 THEN 'Broker ' || {_text('l_suppkey')} END",
        "product": _case("l_partkey % 12", ITEMS),
        "product_id": _text("l_partkey"),
        "variant_id": _text("l_suppkey"),
        "product_barcode": f"CASE l_partkey % 5 WHEN 0 THEN '' WHEN 1 THEN 'n/a' ELSE {_text('l_partkey * 1000 + 7')} END",
        "product_sku": f"'SKU-' || {_text('l_partkey')}",
        "product_color": _case("l_partkey % 3", ["'black'", "'red'"]),
        "product_size": _case("l_partkey % 4", ["'S'", "'M'", "'L'"]),
        "product_type": _case("l_partkey % 12", TYPES),
        "vendor": f"'Vendor ' || {_text('l_suppkey % 10')}",
        "sub_category": f"'Sub ' || {_text('l_partkey % 6')}",
        "line_status": "CASE WHEN l_returnflag = 'R' THEN 'Refunded' ELSE 'Completed' END",
        "transaction_date": _iso("l_shipdate"),
        "currency": "CASE WHEN l_suppkey % 2 = 0 THEN 'CAD' ELSE ' CAD' END",
        "line_quantity": f"CASE WHEN l_returnflag = 'R' THEN '-' ELSE '' END || {_text('cast(l_quantity AS bigint)')}",
        "line_subtotal": _text("l_extendedprice"),
        "original_price": _text("l_extendedprice"),
        "line_tax": _text("l_tax"),
        "line_total": _text("l_extendedprice"),
        "order_payment_methods": _case("l_linenumber % 2", ["'card'"], "'cash'"),
        "purchase_location": f"'Studio ' || {_text('l_suppkey % 5')}",
        "fulfillment_location": f"'Studio ' || {_text('l_suppkey % 5')}",
        "fulfillment_region": f"'Region ' || {_text('l_suppkey % 3')}",
    }
    assert tuple(cells) == SALES_TEXT.names
    inner = ", ".join(f"{e} AS {n}" for n, e in cells.items())
    return f"SELECT {inner} FROM {d.table('lineitem')} JOIN {d.table('orders')} ON l_orderkey = o_orderkey"


def _messy(iso: str, row: str, iso_share: int) -> str:
    """A date text in one of the stored variants, picked by row: strict, unpadded, space-padded, ISO, unreadable."""
    y, m, dd = f"substr({iso}, 1, 4)", f"substr({iso}, 6, 2)", f"substr({iso}, 9, 2)"
    mi, di = _text(f"cast({m} AS int)"), _text(f"cast({dd} AS int)")
    return (
        f"CASE WHEN {iso} IS NULL THEN NULL WHEN {row} % 211 = 5 THEN 'n/a' WHEN {row} % 223 = 7 THEN '13/40/2026' "
        f"WHEN {row} % {iso_share} = 1 THEN {iso} WHEN {row} % 3 = 0 THEN {m} || '/' || {dd} || '/' || {y} "
        f"WHEN {row} % 3 = 1 THEN {mi} || '/' || {di} || '/' || {y} "
        f"ELSE lpad({mi}, 2, ' ') || '/' || lpad({di}, 2, ' ') || '/' || {y} END"
    )


def _replace(names: tuple[str, ...], **changes: str) -> str:
    return ", ".join(f"{changes[n]} AS {n}" if n in changes else n for n in names)


def _sales_stored(d) -> str:
    row = "cast(order_number AS bigint)"
    cells = _replace(SALES_TEXT.names, order_date_utc=_messy("order_date_utc", row, 16),
                     transaction_date=_messy("transaction_date", row, 16))
    return f"SELECT {cells} FROM sales_report"


def _sales_dups(d) -> str:
    """The stored rows; some twice, some a second time with another total (2), some with another date spelling (3), which
    are duplicates only after a repair. The report is read once."""
    row, day = "cast(order_number AS bigint)", "transaction_date"
    copies = (f"CASE line_quantity WHEN '50' THEN {d.array('0', '1')} WHEN '49' THEN {d.array('0', '2')} "
              f"WHEN '48' THEN {d.array('0', '3')} ELSE {d.array('0')} END")
    other = f"substr({day}, 6, 2) || '/' || substr({day}, 9, 2) || '/' || substr({day}, 1, 4)"
    cells = _replace(
        SALES_TEXT.names, order_date_utc=_messy("order_date_utc", row, 16),
        transaction_date=f"CASE WHEN copy = 3 THEN {other} ELSE {_messy(day, row, 16)} END",
        line_total="CASE WHEN copy = 2 THEN line_total || '9' ELSE line_total END")
    return f"SELECT {cells} FROM (SELECT *, {d.each(copies)} AS copy FROM sales_report) AS copied"


def _first_timers_report(d) -> str:
    o = "o_orderkey"
    return f"""
      SELECT CASE WHEN {o} % 301 = 0 THEN NULL WHEN {o} % 303 = 0 THEN '# exported'
                  ELSE 'Customer ' || {_text('o_custkey')} END AS customer,
        CASE WHEN {o} % 307 = 0 THEN 'Customer ID' ELSE {_text('o_custkey')} END AS customer_id,
        {_noisy('o_custkey', o)} AS customer_email,
        '+1 514 555 ' || {_pad('o_custkey % 10000', 4)} AS customer_phone_number,
        {_iso('o_orderdate')} || 'T08:00:00Z' AS join_date, {_iso('o_orderdate')} AS first_class_date,
        {_pad(f'{o} % 24')} || ':' || {_pad(f'{o} % 60')} || ':00' AS class_start_time,
        'Studio ' || {_text('o_custkey % 5')} AS class_location,
        'Ride ' || {_text(f'{o} % 4')} AS class_type, 'Cycle' AS class_category,
        'Instructor ' || {_text(f'{o} % 40')} AS instructor_name,
        {_case(f'{o} % 3', ["'True'", "'False'"])} AS guest_reservation,
        {_case(f'{o} % 2', ["'credit'"], "'membership'")} AS pay_with_type
      FROM {d.table('orders')}"""


FIRST_TIMER_CELLS = ("customer", "customer_id", "customer_email", "customer_phone_number", "join_date",
                     "first_class_date", "class_start_time", "class_location", "class_type", "class_category",
                     "instructor_name", "guest_reservation", "pay_with_type")


def _reservations_report(d) -> str:
    o, day = "o_orderkey", _iso("o_orderdate")
    cells = {
        "reservation_id": _text(o),
        "reservation_type": _case(f"{o} % 6", ["'waitlist'"], "'standard'"),
        "status": "CASE o_orderstatus WHEN 'F' THEN 'check in' WHEN 'O' THEN 'pending' ELSE 'late cancel' END",
        "creation_date": f"{day} || 'T10:00:00Z'",
        "updated_date": f"{day} || 'T11:00:00Z'",
        "cancelled_date": f"CASE WHEN o_orderstatus = 'P' THEN {day} || 'T12:00:00Z' END",
        "unconverted_guest": _case(f"{o} % 3", ["'True'", "'no'"]),
        "converted_guest": "'False'",
        "guest": _case(f"{o} % 2", ["'TRUE'"]),
        "guest_email": f"CASE WHEN {o} % 13 = 0 THEN 'guest@example.com' END",
        "credit_payment_origin": "CAST(NULL AS string)",
        "credit": f"CASE WHEN {o} % 2 = 0 THEN '10 class pack' END",
        "package": "''",
        "membership": f"CASE WHEN {o} % 2 = 1 THEN 'Unlimited' END",
        "contract": "CAST(NULL AS string)",
        "class_id": _text(f"{o} % 1000"),
        "class_start_date": day,
        "class_start_time": f"{_pad(f'{o} % 24')} || ':30:00'",
        "class_day_of_week": _text(f"{o} % 7"),
        "class_custom_name": "''",
        "class_is_public": _case(f"{o} % 3", ["'True'", "'False'"]),
        "class_tags": "CAST(NULL AS string)",
        "class_is_free": "'False'",
        "class_type": f"'Ride ' || {_text(f'{o} % 4')}",
        "class_category": "'Cycle'",
        "class_duration_minutes": "'45'",
        "layout": "'Main'", "layout_format": "'pick a spot'", "layout_capacity": "'40'", "class_capacity": "'40'",
        "classroom": f"'Room ' || {_text('o_custkey % 5')}",
        "location": f"'Studio ' || {_text('o_custkey % 5')}",
        "region": f"'Region ' || {_text('o_custkey % 3')}",
        "instructor_ids": _text(f"{o} % 40"),
        "instructor_employee_ids": "CAST(NULL AS string)",
        "instructor_names": f"'Instructor ' || {_text(f'{o} % 40')}",
        "instructor_schedule_names": "''",
        "class_has_substitute": "'False'",
        "customer_id": _text("o_custkey"),
        "customer_email": _noisy("o_custkey", o),
        "customer_name": f"'Customer ' || {_text('o_custkey')}",
        "company_name": "CAST(NULL AS string)",
        "payer_id": _text("o_custkey"),
        "payer_email": _address("o_custkey"),
        "payer_name": f"'Customer ' || {_text('o_custkey')}",
        "broker_id": "CAST(NULL AS string)", "broker_email": "CAST(NULL AS string)",
        "broker_name": "CAST(NULL AS string)",
        "spot": _text(f"{o} % 40"), "spot_type": "'bike'",
    }
    assert tuple(cells) == RESERVATIONS_TEXT.names
    return f"SELECT {', '.join(f'{e} AS {n}' for n, e in cells.items())} FROM {d.table('orders')}"


def _reservations_stored(d) -> str:
    row = "cast(reservation_id AS bigint)"
    messy = {
        c: _messy(f"substr({c}, 1, 10)", f"({row} + {shift})", 2)
        for shift, c in enumerate(("class_start_date", "creation_date", "updated_date"))
    }
    # date-times and days that do not exist are left as they are by a repair
    cancelled = _messy('substr(cancelled_date, 1, 10)', row, 2)
    messy["cancelled_date"] = (f"CASE WHEN {row} % 53 = 7 THEN '2024-01-09T10:00:00Z' WHEN {row} % 53 = 8 THEN '2024-13-45' "
                               f"ELSE coalesce({cancelled}, '') END")
    return f"SELECT {_replace(RESERVATIONS_TEXT.names, **messy)} FROM reservations_report"


CUTOVER = "DATE '1999-01-01'"
EVENT_START = 1704067200  # first second of the event tables


def _day(ts: str) -> str:
    return f"cast({ts} AS date)"


def _legacy_sales(d) -> str:
    return f"""
      SELECT {_day('l_shipdate')} AS d, {_case('l_partkey % 12', ITEMS)} AS item,
        CASE WHEN l_partkey % 12 >= 10 THEN 'retail' ELSE 'series' END AS type,
        CASE WHEN l_linenumber = 7 THEN NULL ELSE l_extendedprice END AS revenue, o_custkey AS customer_id
      FROM {d.table('lineitem')} JOIN {d.table('orders')} ON l_orderkey = o_orderkey
      WHERE {_day('l_shipdate')} < {CUTOVER}"""


def _legacy_customers(d) -> str:
    return f"""
      SELECT {_text('c_custkey')} AS id, {_noisy('c_custkey', 'c_custkey')} AS emailaddress,
        'First' || {_text('c_custkey % 100')} AS first_name,
        CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE 'Last' || {_text('c_custkey')} END AS last_name
      FROM {d.table('customer')}"""


def _legacy_reservations(d) -> str:
    return f"""
      SELECT {_noisy('o_custkey', 'o_orderkey')} AS emailaddress, cast(o_orderdate AS timestamp) AS class_date
      FROM {d.table('orders')} WHERE {_day('o_orderdate')} < {CUTOVER}"""


def _recent_sales(d) -> str:
    return f"""SELECT {', '.join(SALES_TEXT.names)} FROM sales_stored_keyed WHERE shipped >= {CUTOVER}"""


def _sales_stored_keyed(d) -> str:
    return f"""
      SELECT {_replace(SALES_TEXT.names, order_date_utc=_messy('order_date_utc', 'cast(order_number AS bigint)', 16),
                       transaction_date=_messy('transaction_date', 'cast(order_number AS bigint)', 16))},
        cast(transaction_date AS date) AS shipped
      FROM sales_report"""


def _recent_reservations(d) -> str:
    return f"""SELECT * FROM reservations_report WHERE cast(class_start_date AS date) >= {CUTOVER}"""


def _ticks(d) -> str:
    """Events with their second, and the class session they belong to: one session per hour and room."""
    s = d.seconds("ts")
    return f"""
      SELECT event_id, user_id, event_type, value, {s} AS sec, event_id % 5 AS room,
        cast(floor(({s} - {EVENT_START}) / 3600) AS bigint) AS hour
      FROM {d.table('events')}"""


def _clock(d, seconds: str) -> str:
    return f"replace(cast({d.stamp(seconds)} AS string), ' ', 'T') || 'Z'"


def _sessions(d) -> str:
    start = f"({EVENT_START} + hour * 3600 + room * 420)"
    return f"""
      SELECT hour * 5 + room AS session_id, {d.stamp(start)} AS start_datetime,
        CASE WHEN hour % 6 = 0 THEN NULL ELSE substr(cast({d.stamp(start)} AS string), 1, 10) END AS start_date,
        CASE WHEN hour % 6 = 0 THEN '' ELSE substr(cast({d.stamp(start)} AS string), 12, 8) END AS start_time,
        {_case('hour % 5', ["'ECONOMY'", "'standard '", "' Promo'", "'LARGE'"], "'Unknown Ride'")} AS class_type_display,
        CASE WHEN hour % 11 = 0 THEN ' Theme night ' WHEN hour % 11 = 1 THEN '  ' END AS public_note,
        CASE WHEN hour % 13 = 0 THEN NULL WHEN hour % 13 = 1 THEN {d.empty_array()}
             WHEN hour % 13 = 2 THEN {d.array("''", "'Instructor 1'")}
             WHEN hour % 2 = 0 THEN {d.array("'Instructor ' || " + _text("hour % 40"), "'Instructor 39'")}
             ELSE {d.array("' INSTRUCTOR ' || " + _text("hour % 60"))} END AS instructor_names,
        CASE WHEN hour % 17 = 0 THEN NULL ELSE room END AS location_id,
        CASE WHEN hour % 7 = 0 THEN NULL ELSE hour % 30 END AS checked_in_user_count
      FROM (SELECT DISTINCT hour, room FROM ticks) AS t"""


def _bookings(d) -> str:
    start = f"({EVENT_START} + hour * 3600 + room * 420)"
    return f"""
      SELECT event_id AS reservation_id, CASE WHEN event_id % 41 = 0 THEN NULL ELSE user_id END AS user_id,
        CASE event_type WHEN 'error' THEN 'late Cancel' WHEN 'click' THEN 'pending' WHEN 'view' THEN 'check in'
             WHEN 'signup' THEN 'pending' ELSE CASE WHEN event_id % 2 = 0 THEN NULL ELSE '' END END AS status,
        CASE WHEN event_id % 6 = 0 THEN 'waitlist' ELSE 'standard' END AS reservation_type,
        CASE WHEN event_id % 26 = 0 THEN 'nobody@example.com' WHEN event_id % 13 = 0 THEN {_address('user_id + 1')}
             WHEN event_id % 13 = 1 THEN '' END AS guest_email,
        CASE WHEN event_id % 37 = 0 THEN NULL ELSE hour * 5 + room END AS class_session_id,
        {d.stamp(start)} AS start_datetime,
        CASE WHEN event_id % 4 = 0 THEN NULL ELSE {_clock(d, start)} END AS class_session_min_datetime,
        substr(cast({d.stamp(start)} AS string), 1, 10) AS start_date,
        substr(cast({d.stamp(start)} AS string), 12, 8) AS start_time,
        CASE WHEN event_id % 3 = 0 THEN {_clock(d, start)} END AS class_session_start_datetime,
        CASE WHEN event_id % 3 = 1 THEN {_clock(d, start)} ELSE '' END AS class_session_start,
        CASE WHEN event_id % 9 = 2 THEN {_clock(d, 'sec')} WHEN event_id % 9 = 5 THEN 'soon' END AS created_at,
        cast(NULL AS string) AS updated_at,
        CASE WHEN event_id % 5 = 0 THEN {d.array("'463'", "'12'")} WHEN event_id % 5 = 1 THEN {d.array("'12'")}
             WHEN event_id % 5 = 2 THEN NULL ELSE {d.empty_array()} END AS tags,
        CASE WHEN event_id % 8 = 0 THEN NULL ELSE event_id % 60 END AS spot_id,
        CASE WHEN event_id % 8 = 0 THEN NULL ELSE ' ' || {_text('event_id % 60')} || ' ' END AS spot
      FROM ticks"""


def _users(d) -> str:
    k = "c_custkey"
    return f"""
      SELECT {k} AS user_id, CASE WHEN {k} % 29 = 0 THEN '' WHEN {k} % 31 = 0 THEN 'not an address'
                                  ELSE {_address(k)} END AS email,
        CASE WHEN {k} % 19 = 0 THEN NULL ELSE ' First' || {_text(f'{k} % 100')} END AS first_name,
        'Last' || {_text(f'{k} % 300')} AS last_name,
        'First' || {_text(f'{k} % 100')} || ' Last' || {_text(f'{k} % 300')} AS full_name,
        CASE WHEN {k} % 7 = 0 THEN NULL ELSE '+1 (514) 555-' || {_pad(f'{k} % 10000', 4)} END AS phone_number,
        {d.add_days("DATE '1910-03-01'", f"({k} * 37) % 40000")} AS birth_date,
        CASE WHEN {k} % 17 = 0 THEN '2023-01-01T00:00:00Z' WHEN {k} % 17 = 1 THEN '' END AS archived_at,
        CASE WHEN {k} % 3 = 0 THEN '2023-05-01' END AS date_joined,
        CASE {k} % 3 WHEN 0 THEN true WHEN 1 THEN false END AS marketing_opt_in
      FROM {d.table('customer')}"""


def _moved(k: str, stays: str) -> str:
    """The address of a key where ``stays`` holds, and one that no other view has elsewhere."""
    return f"CASE WHEN {stays} THEN {_address(k)} ELSE 'moved.' || {_address(k)} END"


def _op_customers(d) -> str:
    k = "c_custkey"
    mail = _moved(k, "c_mktsegment IN ('BUILDING', 'HOUSEHOLD', 'MACHINERY')")
    return f"""
      SELECT 'rec' || {_text(k)} AS customer_id, {mail} AS email, {mail} AS email_lower,
        'Old Name ' || {_text(k)} AS name, CASE WHEN {k} % 10 = 0 THEN 'Yes' ELSE 'No' END AS dupe,
        CASE WHEN {k} % 4 = 0 THEN 'note' || {_text(k)} END AS measurement_note_id,
        CASE WHEN {k} % 3 = 0 THEN 0 ELSE 1 END AS first_class_taken,
        CASE WHEN {k} % 5 = 0 THEN 1 ELSE 0 END AS second_class_taken
      FROM {d.table('customer')}"""


def _credits(d) -> str:
    o = "o_orderkey"
    return f"""
      SELECT {o} AS transaction_id, CASE WHEN {o} % 43 = 0 THEN NULL ELSE o_custkey END AS user_id,
        CASE {o} % 4 WHEN 3 THEN NULL ELSE {o} % 4 END AS remaining_credits_cache,
        CASE {o} % 9 WHEN 0 THEN true WHEN 1 THEN NULL ELSE false END AS is_expired,
        {d.stamp(d.seconds('o_orderdate') + f' + ({o} % 24) * 3600')} AS expiration_datetime,
        CASE WHEN {o} % 5 = 0 THEN '' ELSE '10 class pack' END AS credit_name
      FROM {d.table('orders')}"""


def _memberships(d) -> str:
    o = "o_orderkey"
    return f"""
      SELECT {o} AS instance_id, o_custkey AS user_id,
        {_case(f'{o} % 4', ["'active'", "'frozen'", "'cancelled'"], "'ended'")} AS status,
        {_case(f'{o} % 5', ["'UNLIMITED year'", "'Illimité mois'", "'8 per month'", "'Basic'"])} AS membership_name
      FROM {d.table('orders')}"""


def _ratings_upload(d) -> str:
    e = "event_id"
    iso = f"substr(cast({d.stamp('sec')} AS string), 1, 10)"
    us = f"{_text(f'cast(substr({iso}, 6, 2) AS int)')} || '/' || {_text(f'cast(substr({iso}, 9, 2) AS int)')} || '/' || substr({iso}, 1, 4)"
    return f"""
      SELECT {e} AS line, CASE WHEN {e} % 3 = 0 THEN 'Anonymous User' WHEN {e} % 61 = 0 THEN ' '
          ELSE ' First' || {_text('user_id % 100')} || ' Last' || {_text('user_id % 300')} END AS contact,
        CASE WHEN {e} % 67 = 0 THEN 'someday' WHEN {e} % 2 = 0 THEN {iso} ELSE {us} END AS date_text,
        {_case(f'{e} % 8', ["'5.0'", "'five'", "''", "'4'", "'3.5'", "'5'", "' 2 '"], "'1'")} AS rating_text,
        CASE WHEN {e} % 4 = 0 THEN 'Great, loved it' END AS comment,
        CASE WHEN {e} % 10 = 0 THEN NULL ELSE 'Ride ' || {_text('room')} END AS class_type,
        CASE WHEN {e} % 12 = 0 THEN '' ELSE 'Instructor ' || {_text('hour % 4')} END AS instructor
      FROM ticks"""


def _ratings_stored(d) -> str:
    e = "event_id"
    return f"""
      SELECT {e} AS rating_id,
        CASE WHEN {e} % 6 = 0 THEN 'Anonymous User' WHEN {e} % 6 = 1 THEN {_address('user_id')} WHEN {e} % 43 = 0 THEN ''
          WHEN {e} % 6 = 2 THEN 'Nobody Here' ELSE ' first' || {_text('user_id % 100')} || ' LAST' || {_text('user_id % 300')} END AS contact,
        CASE WHEN {e} % 11 = 0 THEN {_address('user_id')} WHEN {e} % 11 = 1 THEN 'broken' END AS email,
        CASE WHEN {e} % 9 = 0 THEN 'linked' END AS email_link
      FROM ticks"""


def _clients(d) -> str:
    return f"""
      SELECT n AS client_id, CASE WHEN n % 4 = 0 THEN upper(mail) ELSE mail END AS email
      FROM (SELECT {_moved('c_custkey', 'c_acctbal >= 3000')} AS mail, c_custkey AS n FROM {d.table('customer')}
            UNION ALL SELECT {_address('c_custkey')} AS mail, c_custkey + 1000000000 AS n FROM {d.table('customer')} WHERE c_acctbal >= 8000) AS c"""


def _details(d) -> str:
    k = "c_custkey"
    statuses = ["'active'", "'active,frozen'", "'active, payment_failure'", "''", "'cancelled'", "' active , active'"]
    return f"""
      SELECT {_text(k)} AS customer_id, CASE WHEN {k} % 23 = 0 THEN '' ELSE {_address(k)} END AS email,
        CASE WHEN {k} % 8 = 0 THEN NULL ELSE 'First' || {_text(f'{k} % 100')} END AS first_name,
        CASE WHEN {k} % 16 = 0 THEN '' ELSE 'Last' || {_text(f'{k} % 300')} END AS last_name,
        CASE WHEN {k} % 4 = 0 THEN '' ELSE 'First' || {_text(f'{k} % 100')} || ' Last' || {_text(f'{k} % 300')} END AS full_name,
        CASE WHEN {k} % 37 = 0 THEN NULL ELSE substr(cast({d.add_days("DATE '2024-01-01'", f'{k} % 30')} AS string), 1, 10)
             || 'T09:00:00Z' END AS join_date,
        CASE WHEN {k} % 6 = 0 THEN '' ELSE 'Studio ' || {_text(f'{k} % 5')} END AS home_location,
        CASE WHEN {k} % 7 = 0 THEN NULL ELSE '+1 514 555 0100' END AS phone_number,
        {_case(f'{k} % 7', statuses)} AS membership_status,
        CASE WHEN {k} % 41 = 0 THEN NULL ELSE 1 + {k} % 5 END AS recency_score, 1 + ({k} * 3) % 5 AS frequency_score,
        {_case(f'{k} % 11 % 4', ["'Lapsing'", "'Lost'", "'Loyal'"])} AS retention_segment,
        {_case(f'{k} % 13 % 5', ['0', '1', '2', '3'])} AS remaining_credits
      FROM {d.table('customer')}"""


def _measurements(d) -> str:
    k = "c_custkey"
    return f"""
      SELECT {k} AS row_id, CASE WHEN {k} % 21 = 0 THEN NULL ELSE {_address(k)} END AS email,
        CASE WHEN {k} % 2 = 0 THEN {_text(f'{k} % 12')} END AS seat_height, {_text(f'{k} % 7')} AS seat_position,
        {_text(f'{k} % 9')} AS handlebar_height, CASE WHEN {k} % 5 = 0 THEN '' ELSE {_text(f'{k} % 3')} END AS handlebar_position,
        {_text(f'36 + {k} % 10')} AS shoe_size,
        {d.stamp(f'{EVENT_START} + 14 * 86400 - ({k} % 2000) * 97')} AS last_modified,
        CASE WHEN {k} % 4 = 0 THEN 'note' || {_text(k)} END AS note_id,
        CASE WHEN {k} % 8 = 0 THEN NULL ELSE {k} END AS user_id
      FROM {d.table('customer')}"""


def _requests(d) -> str:
    """Requests for a class id: the session start, moved by -3..+3 minutes, written in one of several ways."""
    e = "event_id"
    at = f"({EVENT_START} + hour * 3600 + room * 420 + ({e} % 7 - 3) * 60)"
    utc = f"cast({d.stamp(at)} AS string)"
    est = f"cast({d.stamp(at + ' - 18000')} AS string)"

    def us(text: str, clock: str) -> str:
        month, day = f"cast(substr({text}, 6, 2) AS int)", f"cast(substr({text}, 9, 2) AS int)"
        return f"{_text(month)} || '/' || {_text(day)} || '/' || substr({text}, 1, 4) || ' ' || {clock}"

    hour = f"cast(substr({est}, 12, 2) AS int)"
    twelve = (f"{_text(f'CASE WHEN {hour} % 12 = 0 THEN 12 ELSE {hour} % 12 END')} || ':' || substr({est}, 15, 2) || "
              f"CASE WHEN {hour} >= 12 THEN 'pm' ELSE ' AM' END || ' EST'")
    texts = [
        f"replace({utc}, ' ', 'T') || '.000Z'", f"replace({est}, ' ', 'T') || '-05:00'", us(est, twelve),
        us(est, f"substr({est}, 12, 5)"), us(utc, f"substr({utc}, 12, 5) || ' UTC'"), f"{_text(f'({at}) * 1000')}",
        "'next tuesday'", "''",
    ]
    return f"""
      SELECT {e} AS request_id,
        CASE WHEN {e} % 19 = 0 THEN NULL WHEN {e} % 23 = 0 THEN 'Nowhere' ELSE ' room ' || {_text('room')} END AS room,
        {_case(f'{e} % 8', texts)} AS date_text,
        CASE WHEN {e} % 3 = 0 THEN NULL WHEN {e} % 3 = 1 THEN 'economy' ELSE 'Large' END AS class_name,
        CASE WHEN {e} % 29 = 0 THEN {_text('hour * 5 + room')} WHEN {e} % 29 = 1 THEN ' ' END AS class_id
      FROM ticks"""


def _locations(d) -> str:
    return f"""
      SELECT r_regionkey AS location_id, 'Room ' || {_text('r_regionkey')} AS name FROM {d.table('region')}
      UNION ALL SELECT r_regionkey + 100, 'ROOM ' || {_text('r_regionkey')} FROM {d.table('region')}"""


def _studios(d) -> str:
    return f"""
      SELECT n_nationkey AS pos, CASE WHEN n_nationkey = 7 THEN NULL ELSE n_nationkey % 4 END AS location_id,
        'studio' || {_text('n_nationkey')} AS studio_id, 'Studio ' || n_name AS name,
        CASE WHEN n_nationkey % 4 = 1 THEN 'none' ELSE 'studio' || {_text('n_nationkey')} || '@example.com' END AS email
      FROM {d.table('nation')}"""


def _instructors(d) -> str:
    return f"""
      SELECT s_suppkey AS pos, 'inst' || {_text('s_suppkey')} AS instructor_id,
        CASE WHEN s_suppkey % 50 = 49 THEN ' ' ELSE ' instructor ' || {_text('s_suppkey % 45')} || ' ' END AS name
      FROM {d.table('supplier')}"""


def _class_types(d) -> str:
    return f"""
      SELECT p_partkey AS pos, 'type' || {_text('p_partkey')} AS class_type_id, lower(p_type) AS name
      FROM {d.table('part')}"""


def _spots(d) -> str:
    return f"""
      SELECT n_nationkey * 2 AS spot_id, 'Bike ' || {_text('n_nationkey')} AS name, ' ' || {_text('n_nationkey * 2')} AS spot,
        n_nationkey + 4 AS row_number FROM {d.table('nation')}"""


def _scores(d) -> str:
    k = "c_custkey"
    return f"""
      SELECT {_moved(k, "c_mktsegment <> 'HOUSEHOLD'")} AS email, CASE WHEN {k} % 2 = 0 THEN 'membership' ELSE 'credit' END AS population,
        'First' || {_text(f'{k} % 100')} AS first_name, cast(NULL AS string) AS last_name,
        {_text(k)} AS booking_customer_id, {d.add_days("DATE '2001-01-01'", f'{k} % 150')} AS last_visit_date,
        cast({k} % 100 AS double) / 100 AS churn_prob, cast(NULL AS double) AS likely_permanent_prob,
        CASE WHEN {k} % 100 >= 55 THEN 'Critical' WHEN {k} % 100 >= 35 THEN 'Watch' ELSE 'OK' END AS tier,
        CASE WHEN {k} % 3 = 0 THEN 'OK' END AS previous_tier, 'Attendance pattern' AS key_signal,
        DATE '2001-06-23' AS updated_date
      FROM {d.table('customer')}"""


def _score_batch(d) -> str:
    k = "c_custkey"
    p = f"cast(({k} * 7) % 100 AS double) / 100"
    return f"""
      SELECT CASE WHEN c_mktsegment <> 'BUILDING' THEN {_address(k)} ELSE 'new.' || {_address(k)} END AS email,
        CASE WHEN {k} % 2 = 0 THEN 'membership' ELSE 'credit' END AS population,
        'First' || {_text(f'{k} % 100')} AS first_name, 'Last' || {_text(f'{k} % 300')} AS last_name,
        {_text(k)} AS booking_customer_id, {d.add_days("DATE '2001-01-01'", f'{k} % 180')} AS last_visit_date,
        {p} AS churn_prob, CASE WHEN {k} % 2 = 0 THEN {p} / 2 END AS likely_permanent_prob,
        'No visits in 30 days' AS key_signal
      FROM {d.table('customer')}"""


VIEWS: dict[str, View] = {
    "sales_report": View((), _sales_report),
    "sales_stored": View(("sales_report",), _sales_stored),
    "sales_dups": View(("sales_report",), _sales_dups),
    "sales_stored_keyed": View(("sales_report",), _sales_stored_keyed),
    "recent_sales": View(("sales_report", "sales_stored_keyed"), _recent_sales),
    "first_timers_report": View((), _first_timers_report),
    "reservations_report": View((), _reservations_report),
    "reservations_stored": View(("reservations_report",), _reservations_stored),
    "recent_reservations": View(("reservations_report",), _recent_reservations),
    "legacy_sales": View((), _legacy_sales),
    "legacy_customers": View((), _legacy_customers),
    "legacy_reservations": View((), _legacy_reservations),
    "ticks": View((), _ticks),
    "sessions": View(("ticks",), _sessions),
    "bookings": View(("ticks",), _bookings),
    "users": View((), _users),
    "op_customers": View((), _op_customers),
    "credits": View((), _credits),
    "memberships": View((), _memberships),
    "ratings_upload": View(("ticks",), _ratings_upload),
    "ratings_stored": View(("ticks",), _ratings_stored),
    "clients": View((), _clients),
    "details": View((), _details),
    "measurements": View((), _measurements),
    "requests": View(("ticks",), _requests),
    "locations": View((), _locations),
    "studios": View((), _studios),
    "instructors": View((), _instructors),
    "class_types": View((), _class_types),
    "spots": View((), _spots),
    "scores": View((), _scores),
    "score_batch": View((), _score_batch),
}


def chain(names: tuple[str, ...]) -> list[str]:
    """The views and everything they need, in order."""
    out: list[str] = []

    def visit(name: str) -> None:
        for need in VIEWS[name].needs:
            visit(need)
        if name not in out:
            out.append(name)

    for n in names:
        visit(n)
    return out


def with_clause(names: tuple[str, ...], dialect: SparkText | DuckText) -> str:
    return "WITH " + ", ".join(f"{n} AS ({VIEWS[n].text(dialect)})" for n in chain(names))


def base_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A test table as it lies."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: The rows that business rows are made of one by one, as the views spell them, and the day that tells their month.
LINES, ORDERS = "{lineitem} JOIN {orders} ON l_orderkey = o_orderkey", "{orders}"
ROWS_OF = {"sales_report": (LINES, "l_shipdate"), "sales_stored": (LINES, "l_shipdate"), "sales_dups": (LINES, "l_shipdate"),
           "first_timers_report": (ORDERS, "o_orderdate"), "reservations_report": (ORDERS, "o_orderdate"), "reservations_stored": (ORDERS, "o_orderdate")}


def view(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A view as a DataFrame. Only the columns and rows a query asks for are derived: it is one lazy plan."""
    text = f"{with_clause((name,), SparkText())} SELECT * FROM {name}"
    used = {t: base_table(spark, folder, t) for t in BASE_TABLES if "{" + t + "}" in text}
    return spark.sql(text, **used)


def dealt_view(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The same view, its rows dealt out by month before their cells are built."""
    rows, day = ROWS_OF[name]
    text = f"{with_clause((name,), SparkText())} SELECT * FROM {name}"
    if text.count(rows) != 1:
        raise ValueError(f"{name} is not made of the rows it is said to be")
    used = {t: base_table(spark, folder, t) for t in BASE_TABLES if "{" + t + "}" in rows}
    narrow = spark.sql(f"SELECT * FROM {rows}", **used)
    return spark.sql(text.replace(rows, "{narrow}"), narrow=deal(narrow, F.col(day).cast("date")))
