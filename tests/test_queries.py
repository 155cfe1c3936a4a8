"""Registered queries against their check on the smallest tables; ROSTERLAKE_QUICK=1 runs a few of them."""

import os

import pytest

duckdb = pytest.importorskip("duckdb")
FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")

import __spark_entry__ as entry  # noqa: E402
from rosterlake.catalog import REGISTRY  # noqa: E402
from tools.check_queries import connect, rows_of  # noqa: E402

QUICK = ("s04_flatten_entities", "p08_birthdays", "j08_match_sessions", "j16_merge_scores", "w05_changed_tiers", "c14_import_rejects",
         "f07_f10_date_shapes", "c18_refresh_payload", "c05_churn_features_with_tiers", "c09_new_people_today")
NAMES = QUICK if os.environ.get("ROSTERLAKE_QUICK") else sorted(n for n, q in REGISTRY.items() if q.sql is not None)


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", NAMES)
def test_matches_check(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    got = rows_of(df.columns, df.collect())
    rel = con.execute(entry.oracle_sql()[name])
    assert got == rows_of([d[0] for d in rel.description], rel.fetchall())


def test_contract(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 100
    assert entry.entry(spark).columns[:2] == ["email", "population"]
