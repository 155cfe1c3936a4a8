from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from rosterlake.functions import dates as D
from rosterlake.functions import membership as M
from rosterlake.functions import text as X
from rosterlake.plans.ratings import rating_key, rating_number

DATES = ["07/01/2026", "7/1/2026", "07/ 1/2026", "2026-07-01", "13/40/2026", "n/a", None, "", " 7/ 1/2026 ", "7/1/26"]


def test_date_texts(column):
    day = date(2026, 7, 1)
    assert column(D.tolerant_date, DATES) == [day, day, day, None, None, None, None, None, day, None]
    assert column(D.tolerant_date_any, DATES) == [day, day, day, day, None, None, None, None, day, None]
    assert column(D.normalize_mdy, DATES[:5]) == ["07/01/2026"] * 3 + [None, "13/40/2026"]
    assert column(D.repaired_text, DATES[:8]) == ["07/01/2026"] * 4 + ["13/40/2026", "n/a", None, ""]
    assert column(D.strict_mdy, DATES[:5]) == [True, False, False, False, True]


def test_repair_keeps_the_day(column):
    before = column(D.tolerant_date_any, DATES)
    after = column(lambda c: D.tolerant_date_any(D.repaired_text(c)), DATES)
    assert before == after


def test_parts_are_read_independently(column):
    # month from the start, first day part, year from the end
    assert column(D.tolerant_date, ["7/1/x/2026", "7/1/2/2026", "x7/1/2026"]) == [date(2026, 7, 1)] * 2 + [None]


def test_written_dates_and_times(column):
    assert column(D.to_mdy, ["2026-07-21T15:05:02.49+00:00", "2026-07-25", None, "", "2026-07", "x"]) == [
        "07/21/2026", "07/25/2026", "", "", "", ""]
    assert column(D.to_time12h, ["00:15:00", "09:30:00", "12:00:00", "13:05:00", "9", None, ""]) == [
        "12:15 AM", "9:30 AM", "12:00 PM", "1:05 PM", "9:00 AM", "", ""]
    assert column(D.long_date, [date(2026, 7, 1)], "date") == ["July 1, 2026"]
    assert column(lambda c: D.long_date(c, "fr"), [date(2026, 8, 15)], "date") == ["15 août 2026"]


def test_local_text_to_utc(column):
    texts = ["2026-02-02T12:15:00.000Z", "2026-02-02T07:15:00-05:00", "2/2/2026 7:15am EST", "07/02/2026 12:05 AM EDT",
             "2/2/2026 19:15", "2/2/2026 7:15 PM ET", "2/2/2026 12:15 pm utc", "1770034500000", "soon", None,
             "2/2/2026 0:15 am", "2/2/2026  13:15 AM"]
    noon = datetime(2026, 2, 2, 12, 15)
    assert column(lambda c: D.local_text_to_utc(c).cast("timestamp_ntz"), texts) == [
        noon, noon, noon, datetime(2026, 7, 2, 4, 5), datetime(2026, 2, 3, 0, 15), datetime(2026, 2, 3, 0, 15), noon, noon,
        None, None, datetime(2026, 2, 2, 5, 15), datetime(2026, 2, 2, 18, 15)]


def test_event_time(spark):
    df = spark.createDataFrame([("2024-01-01", "00:00:05"), ("2024-01-01", ""), ("bad", None)], "d string, t string")
    assert [r[0] for r in df.select(D.event_time(F.col("d"), F.col("t"))).collect()] == [1704067205, 1704067200, None]


def test_item_texts(column):
    texts = ["Unlimited - 1 year", "Illimité 3 mois", "2 classes per week - 4 weeks", "8 cours par mois - 1 mois",
             "Abonnement 3 ans", "Member plan", "10 class pack", None]
    assert column(M.plan_days, texts) == [365, 90, 28, 30, 30, 30, 30, 30]
    assert column(M.weekly_rate, texts) == pytest.approx([7, 7, 2, 8 / 4.33, 7, 7, 7, 7])
    assert column(M.legacy_category, texts) == ["membership", "membership", "credit", "credit", "credit", "membership",
                                                "credit", "credit"]
    assert column(M.pack_size, ["10 class pack", "class pack 10", None]) == [10, None, None]


def test_numbers_and_flags(column):
    assert column(X.to_float, ["12.5", " 3 ", "1e3", "1.5d", "n/a", "", None]) == [12.5, 3.0, 1000.0, None, None, None, None]
    assert column(X.to_int, ["12abc", " -7.9", "x1", "", None]) == [12, -7, None, None, None]
    assert column(X.bool_string, ["True", "no", None]) == ["true", "false", None]
    assert column(X.bool_text, ["True", None]) == ["true", ""]


def test_private_values(column):
    hashed = column(X.pii_hash, [" A@b.c ", "a@b.c", "", None])
    assert hashed[0] == hashed[1] and len(hashed[0]) == 64 and hashed[2:] == [None, None]
    assert column(lambda c: X.mask_pii(c, "email"), ["jane@example.com"]) == ["j***@example.com"]
    assert column(lambda c: X.mask_pii(c, "phone"), ["5145550100"]) == ["********00"]
    assert column(X.strip_zero_width, ["\u200b12\ufeff "]) == ["12"]
    assert column(X.is_email, ["a@b.c", "a@b", "a b@c.d", None]) == [True, False, False, False]


def test_lists(column):
    assert column(X.status_set, ["active,frozen", "active, payment_failure ,active", "", None]) == [
        ["active", "frozen"], ["active", "payment_failure"], [], []]
    assert column(X.lead_instructor, [["Ann", "Bo"], ["", "Bo"], [], None], "array<string>") == ["Ann", ", Bo", "", ""]


def test_rating_identity(spark, column):
    assert column(rating_number, ["5.0", "five", "4.5", "", None]) == ["5", "", "4.5", "", ""]
    df = spark.createDataFrame([(" Anonymous User", "Ann", "5", "Ride"), ("Jo Li", "Ann", "5", "Ride"), ("", "Ann", "5", "Ride")],
                               "c string, i string, r string, k string").withColumn("d", F.lit(date(2026, 7, 1)))
    keys = [r[0] for r in df.select(rating_key(*[F.col(c) for c in ("c", "d", "i", "r", "k")])).collect()]
    assert keys == ["anon|2026-07-01|ann|5|ride", "named|jo li|2026-07-01|ride", None]


def test_calendar():
    assert D.month_range(2024, 2) == (date(2024, 2, 1), date(2024, 2, 29))
    assert D.previous_month(date(2026, 1, 15)) == (date(2025, 12, 1), date(2025, 12, 31))
    assert D.audit_month("2026-06", date(2026, 7, 1)) == (date(2026, 6, 1), date(2026, 6, 30))
    for bad in ("2026-13", "June", "2026-07"):
        with pytest.raises(ValueError):
            D.audit_month(bad, date(2026, 7, 31))
    assert D.local_today(datetime(2026, 7, 1, 3, 0)) == date(2026, 6, 30)


def test_parse_date_any(column):
    assert column(D.parse_date_any, ["2026-07-01", "7/1/2026", "Jul 1, 2026", "2026-07-01T23:30:00-05:00", "x", None]) == [
        date(2026, 7, 1)] * 3 + [date(2026, 7, 2), None, None]
