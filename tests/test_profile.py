"""What a person bought last, from purchases whose texts are read once."""

import contextlib
import io

from rosterlake.operators import activity as A


def bought(spark, rows):
    return spark.createDataFrame(rows, "email string, d date, rev double, category string, pack_size long, first_name string, "
                                 "last_name string, booking_customer_id string, item_text string")


def test_plans_are_read_from_the_one_membership_kept(spark):
    import datetime as dt

    def row(email, day, category, item, rev=1.0, pack=1):
        return (email, day and dt.date(2026, 1, day), rev, category, pack, None, "L", "7", item)

    rows = [row("a", 3, "membership", "8 cours par mois - 1 mois"), row("a", 5, "membership", "2 classes per week - 4 weeks"),
            row("a", 5, "membership", "Unlimited - 1 year", rev=0.5), row("a", 9, "credit", "5 class pack", pack=5),
            row("a", None, "membership", "Abonnement 3 ans"), row("b", 2, "credit", "x"), row("c", None, "credit", "x"),
            row("d", None, "membership", "Member plan"), row("d", 4, "credit", "y"), row(None, 4, "credit", "z")]
    purchases = bought(spark, rows)
    found = A.purchase_profile(purchases)
    got = {r["email"]: r for r in found.collect()}
    assert set(got) == {"a", "b", "d", None}
    assert got["a"]["plan"].asDict() == {"d": dt.date(2026, 1, 5), "plan_days": 28, "weekly_rate": 2.0}
    assert (got["a"]["latest"]["pack_size"], got["a"]["last_credit_purchase_date"], got["a"]["ever_member"]) == (5, dt.date(2026, 1, 9), True)
    assert got["b"]["plan"] is None and not got["b"]["ever_member"]
    assert got["d"]["plan"] is None and not got["d"]["ever_member"] and got["d"]["latest"]["category"] == "credit"
    told = A.purchase_profile(A.all_purchases(purchases.where("d IS NOT NULL").limit(0), purchases.where("d IS NOT NULL")))
    assert sorted(map(str, told.collect())) == sorted(map(str, found.collect()))


def test_texts_are_not_read_row_by_row(spark):
    sales = spark.createDataFrame([("Memberships", "a@x", "01/02/2026", "5", "1", "N", "7", "Unlimited")],
                                  "product_type string, customer_email string, transaction_date string, line_total string, line_quantity string, "
                                  "customer_name string, customer_id string, product string")
    legacy = spark.createDataFrame([], "d date, item string, type string, revenue double, customer_id long")
    people = spark.createDataFrame([], "id string, emailaddress string, first_name string, last_name string")
    purchases = A.either_purchases(A.legacy_purchases(legacy, people), A.new_purchases(sales, dated=False))
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        A.purchase_profile(purchases).explain()
    plan = out.getvalue()
    before = plan[plan.index("partial_max("):]
    assert "per week" not in before and "max_by" not in plan and "regexp_replace" in before
    assert sum("regexp_replace" in line for line in before.splitlines()) == 1
