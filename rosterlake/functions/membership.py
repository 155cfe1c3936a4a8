"""Expressions over the free text of what was bought: cover, rate, category, pack size."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Wording of item texts in English and French, and days per unit.
PLAN_UNITS = (
    (r"(\d+)\s*(?:year|an\b|ann[ée]e)", 365),
    (r"(\d+)\s*(?:month|mois)", 30),
    (r"(\d+)\s*(?:week|semaine)", 7),
)
DEFAULT_PLAN_DAYS = 30
UNLIMITED = r"unlimit|illimit"
PER_WEEK = r"(\d+)\s*(?:class|classe|cours).*(?:per week|par semaine)"
PER_MONTH = r"(\d+)\s*(?:class|classe|cours).*(?:per month|par mois)"
WEEKS_PER_MONTH = 4.33
UNCAPPED_RATE = 7.0
LEGACY_MEMBERSHIP = r"unlimit|illimit|member|bike.*(commit|month|autorenew)"
PRODUCT_CATEGORY = {"Memberships": "membership", "Credits": "credit"}


def _number(text: Column, pattern: str, kind: str) -> Column:
    return F.regexp_extract(text, pattern, 1).try_cast(kind)


def plan_days(item: Column, units=PLAN_UNITS) -> Column:
    """Commitment length in days read from the text: years before months before weeks, else the default."""
    text = F.lower(item)
    found = None
    for pattern, days in units:
        value = _number(text, pattern, "bigint") * days
        found = F.when(text.rlike(pattern), value) if found is None else found.when(text.rlike(pattern), value)
    return found.otherwise(F.lit(DEFAULT_PLAN_DAYS).cast("bigint"))


def weekly_rate(item: Column) -> Column:
    """Visits per week that the plan text promises."""
    text = F.lower(item)
    return (
        F.when(text.rlike(UNLIMITED), F.lit(UNCAPPED_RATE))
        .when(text.rlike(PER_WEEK), _number(text, PER_WEEK, "double"))
        .when(text.rlike(PER_MONTH), _number(text, PER_MONTH, "double") / WEEKS_PER_MONTH)
        .otherwise(F.lit(UNCAPPED_RATE))
    )


def legacy_category(item: Column) -> Column:
    return F.when(F.lower(item).rlike(LEGACY_MEMBERSHIP), "membership").otherwise("credit")


def product_category(product_type: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, category in PRODUCT_CATEGORY.items():
        out = F.when(product_type == name, F.lit(category)).otherwise(out)
    return out


def pack_size(item: Column) -> Column:
    """Digits the item text starts with; null when there are none."""
    return _number(item, r"^(\d+)", "bigint")
