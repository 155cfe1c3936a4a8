"""Facts of a table kept by month, places in an order, envelopes, declared tables and fitted models."""

import json
import os
import random
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterlake import specs
from rosterlake.functions import text as X
from rosterlake.operators import matching as N
from rosterlake.operators import ordinals
from rosterlake.operators import quality as Q
from rosterlake.operators import scoring as S
from rosterlake.plans import audit, retention
from rosterlake.sources import entities, facts, reports, tables

BOOKED, SALES = specs.RESERVATIONS_TEXT, specs.SALES_TEXT


def made(spark, spec, cells):
    """Rows of a text table: (key, day, other)."""
    at, day = spec.names.index(spec.keys[0]), spec.names.index(spec.date_column)
    other = next(i for i, n in enumerate(spec.names) if n not in (*spec.keys, *spec.format_columns, spec.date_column))
    rows = [tuple(k if i == at else d if i == day else o if i == other else "01/01/2026" if n in spec.format_columns else "x" for i, n in enumerate(spec.names))
            for k, d, o in cells]
    return spark.createDataFrame(rows, spec.schema)


def recount(spark, path, spec):
    """The same counters from all rows."""
    rows = spark.read.parquet(path)
    whole = Q.full_row_dups(rows.drop(tables.MONTH)).first()
    bad = rows.where(spec.day().isNotNull()).agg(F.count_if(Q.is_bad_format(spec)), F.count_if(Q.is_repairable(spec))).first()
    lost = Q.unparseable(rows, spec).first()[0]
    met = Q.key_collisions(rows.drop(tables.MONTH), list(spec.keys)).count()
    return (whole["total_rows"], whole["distinct_rows"], whole["duplicate_rows"], *bad, lost, met)


def told(found):
    r = found.table().first()
    return tuple(r[c] for c in ("total_rows", "distinct_rows", "duplicate_rows", "bad_format", "repairable", "unparseable", "key_collisions"))


@pytest.mark.parametrize("spec", [BOOKED, SALES])
def test_facts_follow_appends_repairs_and_purges(spark, tmp_path, spec):
    path = str(tmp_path / "t")
    cells = [("1", "05/03/2026", "a"), ("1", "05/03/2026", "a"), ("1", "05/03/2026", "b"), ("2", "6/4/2026", "a"), ("3", "no day", "a"), ("4", "06/05/2026", "a")]
    tables.write_table(made(spark, spec, cells), path, spec)
    first = facts.refresh(spark, path, spec)
    assert first.recounted == ["2026-05", "2026-06", "none"] and told(first) == recount(spark, path, spec)
    assert facts.refresh(spark, path, spec).recounted == []

    tables.append(made(spark, spec, [("1", "06/20/2026", "c"), ("5", "07/01/2026", "a"), ("5", "07/01/2026", "a")]), path, spec)
    grown = facts.refresh(spark, path, spec)
    assert grown.recounted == ["2026-06", "2026-07"] and told(grown) == recount(spark, path, spec)

    audit.apply_audit(spec, path, made(spark, spec, []), "2026-06", date(2026, 7, 3))
    repaired = facts.refresh(spark, path, spec)
    assert repaired.recounted == ["2026-06"] and told(repaired) == recount(spark, path, spec)

    doomed = made(spark, spec, [("5", "", "")]).select(spec.keys[0])
    retention.apply_purge(spark, path, doomed, [spec.keys[0]])
    purged = facts.refresh(spark, path, spec)
    assert purged.recounted == [] and told(purged) == recount(spark, path, spec)
    assert sorted(r[tables.MONTH] for r in purged.months.collect()) == ["2026-05", "2026-06", "none"]


def test_digest_tells_rows_and_not_their_order(spark, tmp_path):
    cells = [(str(i), f"0{1 + i % 5}/0{1 + i % 9}/2026", "a") for i in range(40)] + [("1", "02/02/2026", "a")]

    def digest(name, some, parts):
        tables.write_table(made(spark, BOOKED, some).repartition(parts), str(tmp_path / name), BOOKED)
        return facts.refresh(spark, str(tmp_path / name), BOOKED).table().first()["digest"]

    whole = digest("a", cells, 1)
    assert whole == digest("b", cells[::-1], 5)
    assert len({whole, digest("c", cells[:-1], 1), digest("d", [*cells[:-1], ("1", "02/02/2026", "b")], 1)}) == 3


def test_facts_shuffle_rows_as_two_numbers_and_keep_their_digest(spark, tmp_path):
    """The digest of a month is the one of facts that were stored when rows were shuffled as 32 bytes."""
    cells = [("1", "05/03/2026", "a")] * 3 + [("1", "05/03/2026", "b"), ("2", "5/4/2026", "a"), (None, "05/05/2026", None)]
    for spec in (BOOKED, SALES):
        path = str(tmp_path / spec.name)
        tables.write_table(made(spark, spec, cells), path, spec)
        rows = spark.read.parquet(path)
        shuffled = facts._counted(rows, spec)[0]._jdf.queryExecution().optimizedPlan().toString()
        assert "unhex(sha2(" not in shuffled and "row_id2" in shuffled
        hashes = rows.select(F.xxhash64(X.row_digest(rows.drop(tables.MONTH))).alias("h")).collect()
        month = facts.refresh(spark, path, spec).months.first()
        assert month["digest"] == sum(r["h"] % (1 << 62) for r in hashes) % (1 << 62)
        assert (month["total_rows"], month["distinct_rows"], month["key_collisions"], month["bad_format"], month["repairable"]) == (6, 4, 1, 1, 1)


def test_facts_of_an_empty_month_and_of_an_empty_table(spark, tmp_path):
    path = tmp_path / "t"
    tables.write_table(made(spark, BOOKED, [("1", "05/03/2026", "a")]), str(path), BOOKED)
    made(spark, BOOKED, []).coalesce(1).write.parquet(str(path / "audit_month=2026-04"))
    found = facts.refresh(spark, str(path), BOOKED)
    assert {r["audit_month"]: r["total_rows"] for r in found.months.collect()} == {"2026-04": 0, "2026-05": 1}
    assert told(found)[0] == 1


# places in an order


def test_ordinals_of_a_user_without_dates(spark):
    """A third of all bookings are one user's and have no date: no task gets them all, and every place is right."""
    rng = random.Random(3)
    rows = [("hot", "T", i) for i in range(1000)] + [(f"u{rng.randint(0, 60)}", f"2026-0{rng.randint(1, 9)}-01T0{rng.randint(0, 9)}", 1000 + i) for i in range(2000)]
    rows += [(None, None, 5000 + i) for i in range(20)] + [(None, "T", 6000)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "user string, sort_text string, reservation_id int").repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    try:
        dealt = ordinals.dealt_in_order(df, [F.col("sort_text"), F.col("reservation_id")], "user")
        assert max(r["count"] for r in dealt.groupBy("_part").count().collect()) < 600
        got = N.ordinal_in_history(df, "user", "sort_text", "reservation_id").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    want, counts = {}, {}
    for user, _, reservation in sorted(rows, key=lambda r: (r[0] or "", r[1] or "", r[2])):
        counts[user] = counts.get(user, 0) + 1
        want[reservation] = counts[user]
    assert {r["reservation_id"]: r["ordinal"] for r in got} == want and len(got) == len(rows)


def test_places_of_equal_rows_and_of_none(spark):
    df = spark.createDataFrame([(1, "a")] * 50 + [(2, "b")], "x int, _at string")
    assert sorted(r["place"] for r in ordinals.place_in_order(df.drop("_at"), [F.col("x").desc()], name="place").collect()) == list(range(1, 52))
    assert ordinals.place_in_order(df.drop("_at"), [F.col("x").desc()], name="place").where("x = 2").first()["place"] == 1
    assert ordinals.place_in_order(df.drop("_at").limit(0), [F.col("x")]).count() == 0


# envelopes


def test_no_envelope_holds_more_than_a_page(spark, tmp_path):
    spec = specs.FIRST_TIMERS_TEXT
    cells = [[str(i), str(i % 7), None, *["x"] * (len(spec.headers) - 3)] for i in range(2345)]
    rows = spark.createDataFrame([(c,) for c in cells], "row array<string>").repartition(3)
    reports.write_report(rows, spec.headers, str(tmp_path / "r"), page=100)
    held = reports.read_report(spark, str(tmp_path / "r"), lines=True).collect()
    assert max(len(r["rows"]) for r in held) == 100 and len(held) in (24, 25, 26)
    back = reports.report_rows(reports.read_report(spark, str(tmp_path / "r"), lines=True)).collect()
    assert sorted((r["row"][0], r["row"][2]) for r in back) == sorted((c[0], None) for c in cells)
    assert reports.read_table_report(spark, str(tmp_path / "r"), spec, lines=True).count() == 2345


def test_a_page_is_a_file_or_a_line(spark, tmp_path):
    page = {"data": [{"id": str(i), "attributes": {"name": f"n{i}"}} for i in range(3)]}
    (tmp_path / "one").mkdir()
    (tmp_path / "one" / "a.json").write_text(json.dumps(page, indent=1))
    assert entities.read_entities(spark, str(tmp_path / "one"), entities.LOCATION).count() == 3
    many = spark.range(25).select(F.col("id").cast("string").alias("id"), F.struct(F.concat(F.lit("n"), "id").alias("name")).alias("attributes"))
    entities.write_entities(many, str(tmp_path / "many"), page=10)
    lines = [json.loads(x) for f in os.listdir(tmp_path / "many") if f.endswith(".json") for x in open(tmp_path / "many" / f)]
    assert max(len(x["data"]) for x in lines) <= 10
    assert {r["name"] for r in entities.read_entities(spark, str(tmp_path / "many"), entities.LOCATION, lines=True).collect()} == {f"n{i}" for i in range(25)}


# declared tables


def test_a_changed_table_is_refused(spark, tmp_path):
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    for name, rows in {"same": "1L AS a, 'x' AS b", "moved": "'x' AS b, 1L AS a", "more": "1L AS a, 'x' AS b, 2 AS c", "less": "1L AS a", "other": "'1' AS a, 'x' AS b"}.items():
        spark.sql(f"SELECT {rows}").write.parquet(str(tmp_path / name))
    assert tables.load(spark, str(tmp_path), "same", schema).columns == tables.load(spark, str(tmp_path), "moved", schema).columns == ["a", "b"]
    for name, part in {"more": "c: int where nothing", "less": "b: missing", "other": "a: string where bigint"}.items():
        with pytest.raises(tables.SchemaChanged, match=part):
            tables.load(spark, str(tmp_path), name, schema)


# models


def newton(x, y, penalty):
    """Logistic regression with a penalty on the coefficients of standardised columns, by Newton's steps."""
    scale = x.std(axis=0, ddof=1)
    z = np.c_[x / scale, np.ones(len(x))]
    weight, ridge = np.zeros(z.shape[1]), np.diag([penalty] * x.shape[1] + [0.0])
    for _ in range(60):
        p = 1 / (1 + np.exp(-z @ weight))
        gradient = z.T @ (p - y) / len(y) + ridge @ weight
        hessian = (z * (p * (1 - p))[:, None]).T @ z / len(y) + ridge
        weight -= np.linalg.solve(hessian, gradient)
    return weight[:-1] / scale, weight[-1]


def training(spark, n=1200):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(n, 3)) * [1, 5, 0.2] + [0, 2, 1]
    p = 1 / (1 + np.exp(-(x @ [0.8, -0.3, 2.0] - 1)))
    y = (rng.random(n) < p).astype(float)
    days = [date(2026, 1, 1) + timedelta(days=int(d)) for d in np.sort(rng.integers(0, 100, n))]
    rows = [(float(a), float(b), float(c), float(t), d) for (a, b, c), t, d in zip(x, y, days)]
    return x, y, spark.createDataFrame(rows, "a double, b double, c double, label double, day date")


def test_fit_agrees_with_newton(spark):
    x, y, df = training(spark)
    model = S.fit_churn(df, ("a", "b", "c")).stages[-1]
    weights, intercept = newton(x, y, S.REGULARIZATION)
    assert np.abs(model.coefficients.toArray() - weights).max() < 1e-4 and abs(model.intercept - intercept) < 1e-4


def test_held_out_days_and_thresholds(spark):
    _, _, df = training(spark)
    early, late = S.split_by_time(df, "day")
    assert early.agg(F.max("day")).first()[0] < late.agg(F.min("day")).first()[0] and early.count() + late.count() == df.count()
    assert 0.8 <= early.count() / df.count() < 0.83
    scored = S.score(late, S.fit_churn(early, ("a", "b", "c")), ("a", "b", "c"))
    critical, watch = S.calibrate(scored, precision=0.75, recall=0.8)
    rows = [(r["churn_prob"], r["label"]) for r in scored.collect()]
    above = [t for p, t in rows if p >= critical]
    assert sum(above) >= 0.75 * len(above) > 0 and 0 < watch <= critical
    assert sum(t for p, t in rows if p >= watch) >= 0.8 * sum(t for _, t in rows) or watch == critical
    assert all(sum(t for p, t in rows if p >= c / 1000) < 0.75 * sum(p >= c / 1000 for p, _ in rows) for c in range(int(critical * 1000)) if any(c / 1000 <= p < (c + 1) / 1000 for p, _ in rows))
