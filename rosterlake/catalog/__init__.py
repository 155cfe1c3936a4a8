"""Registered queries: every operator and job on the test tables, with the SQL that a checking database runs."""

from rosterlake.catalog import audits, churn, keyed, lifecycle, ratings, reports, scalars, syncs  # noqa: F401
from rosterlake.catalog import classes, landed, stored, streams  # noqa: F401
from rosterlake.catalog.base import REGISTRY, Tables  # noqa: F401
