"""Merges into stored tables, lookups by key, marks from partitions and reminders by due time."""

import os
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rosterlake import specs
from rosterlake.operators import incremental as I
from rosterlake.plans import sync
from rosterlake.sources import keyed_tables as KT
from rosterlake.sources import tables
from rosterlake.sources.files import Files
from rosterlake.sources.key_index import KeyIndex
from rosterlake.sources.swap import RowCountMismatch
from rosterlake.streaming import appends
from rosterlake.streaming.due_reminders import Reminders, take_stream


def parts(path):
    """Files of each bucket of a table."""
    return {d: sorted(f for f in os.listdir(f"{path}/{d}") if f.endswith(".parquet")) for d in os.listdir(path) if d.startswith(KT.BUCKET)}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# merges by key

SCORES = specs.SCORE_SCHEMA


def score(name, tier, population="credit", previous=None, day=date(2026, 5, 1)):
    return (f"{name}@x.org", population, name, None, "7", date(2026, 4, 1), 0.5, None, tier, previous, "s", day)


def test_merge_rewrites_only_touched_buckets(spark, tmp_path):
    path = str(tmp_path / "scores")
    KT.create(spark.createDataFrame([score(f"p{i}", "OK") for i in range(60)], SCORES), path, ["email", "population"], 16)
    before = parts(path)
    batch = spark.createDataFrame([score("p3", "Critical"), score("new", "Watch"), score("p4", "Watch", "membership")], SCORES)
    table = KT.open_keyed(spark, path)
    touched = KT.merge_scores(table, batch.drop("previous_tier", "updated_date"), date(2026, 6, 1))
    after = parts(path)
    assert 0 < len(touched) <= 3
    for name, files in before.items():
        assert (after.get(name) == files) == (int(name.partition("=")[2]) not in touched)
    rows = {(r["email"], r["population"]): r for r in table.rows().collect()}
    assert len(rows) == 62
    assert (rows["p3@x.org", "credit"]["tier"], rows["p3@x.org", "credit"]["previous_tier"]) == ("Critical", "OK")
    assert rows["new@x.org", "credit"]["previous_tier"] is None and rows["new@x.org", "credit"]["updated_date"] == date(2026, 6, 1)
    assert rows["p4@x.org", "credit"]["updated_date"] == date(2026, 5, 1)


def test_a_merge_of_the_wrong_size_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "scores")
    table = KT.create(spark.createDataFrame([score("a", "OK"), score("b", "OK")], SCORES), path, ["email", "population"], 4)
    twice = spark.createDataFrame([score("a", "Watch"), score("a", "Critical")], SCORES).drop("previous_tier", "updated_date")
    before = parts(path)
    with pytest.raises(RowCountMismatch):
        KT.merge_scores(table, twice, date(2026, 6, 1))
    assert parts(path) == before and table.rows().count() == 2


CUSTOMERS = "customer_id string, email_lower string, email string, name string, dupe string, note string"


def test_stored_upsert(spark, tmp_path):
    rows = [("1", "a@x.org", "A@x.org", "old", "No", "n"), ("2", "a@x.org", "a@x.org", "dup", "Yes", None), ("3", "b@x.org", "b@x.org", "b", None, None), ("4", None, None, "none", "No", None)]
    table = KT.create(spark.createDataFrame(rows, CUSTOMERS), str(tmp_path / "c"), ["email_lower"], 8)
    people = spark.createDataFrame([("A@X.org", "first", 1), ("a@x.org", "last", 2), ("b@x.org", "bee", 3), ("", "no", 4), (None, "no", 5)], "email string, name string, reservation_id int")
    for _ in range(2):
        KT.upsert_customers(table, people)
        got = sorted(tuple(r) for r in table.rows().collect() if r["email_lower"])
        assert got == [("1", "a@x.org", "a@x.org", "last", "No", "n"), ("2", "a@x.org", "a@x.org", "dup", "Yes", None),
                       ("3", "b@x.org", "b@x.org", "b", None, None), ("new:b@x.org", "b@x.org", "b@x.org", "bee", "No", None)]
    assert table.rows().where("customer_id = '4'").count() == 1


def test_stored_children(spark, tmp_path):
    cells = "class_id int, res int"
    table = KT.create(spark.createDataFrame([(1, 10), (1, 11), (2, 20), (3, 30)], cells), str(tmp_path / "c"), ["class_id"], 4)
    fresh = spark.createDataFrame([(1, 12), (4, 40)], cells)
    parents = spark.createDataFrame([(1,), (3,), (4,), (4,), (None,)], "class_id int")
    KT.replace_children(table, fresh, parents)
    assert sorted(map(tuple, table.rows().collect())) == [(1, 12), (2, 20), (4, 40)]
    with pytest.raises(ValueError):
        KT.replace_children(table, fresh, parents.where("class_id = 1"))
    KT.replace_children(table, fresh.limit(0), parents)
    assert sorted(map(tuple, KT.open_keyed(spark, table.path).rows().collect())) == [(2, 20)]


def test_compaction_keeps_rows(spark, tmp_path):
    table = KT.create(spark.range(0).selectExpr("id"), str(tmp_path / "t"), ["id"], 2)
    for i in range(4):
        table.dealt(spark.range(10 * i, 10 * i + 10)).coalesce(1).write.mode("append").partitionBy(KT.BUCKET).parquet(table.path)
    assert KT.compact(table, 3) == [0, 1] and KT.compact(table, 3) == []
    assert sorted(r[0] for r in table.rows().collect()) == list(range(40))


# lookups by key


def test_lookup_reads_only_the_buckets_of_the_batch(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path / "t"), ["_key0"], 32)
    index.ready(spark.createDataFrame([(f"k{i}",) for i in range(500)] + [(None,)], "_key0 string"))
    wanted = spark.createDataFrame([("k3",), ("k3",), ("zz",), (None,)], "_key0 string")
    held = index.held(wanted)
    plan = plan_of(held)
    assert "PartitionFilters: [key_bucket" in plan.replace("isnotnull(key_bucket", "key_bucket") and held.count() < 120
    assert held.where("_key0 = 'k3'").count() == 1 and held.where("_key0 IS NULL").count() == 1


FT = specs.FIRST_TIMERS_TEXT


def first_timers(spark, ids, day="06/05/2026"):
    at, key = FT.names.index(FT.date_column), FT.names.index(FT.keys[0])
    return spark.createDataFrame([tuple(str(i) if n == key else day if n == at else "x" for n in range(len(FT.names))) for i in ids], FT.schema)


def ids_of(spark, path):
    return sorted(int(r[FT.keys[0]]) for r in spark.read.parquet(path).collect())


def test_appends_by_id_survive_a_death_before_the_keys_are_listed(spark, tmp_path):
    path = str(tmp_path / "t")
    appends.append_batch(first_timers(spark, [1, 2, 2]), path, FT)
    assert ids_of(spark, path) == [1, 2]
    with pytest.MonkeyPatch.context() as patch:
        def dies(self, rows):
            raise RuntimeError("lost")
        patch.setattr(KeyIndex, "add", dies)
        with pytest.raises(RuntimeError):
            appends.append_batch(first_timers(spark, [2, 3]), path, FT)
    assert ids_of(spark, path) == [1, 2, 3]
    appends.append_batch(first_timers(spark, [2, 3, 4]), path, FT)  # the batch again, and a new row
    appends.append_batch(first_timers(spark, [4, 1], "07/05/2026"), path, FT)
    assert ids_of(spark, path) == [1, 2, 3, 4]


def test_an_unreadable_table_is_not_an_empty_one(spark, tmp_path):
    path = tmp_path / "t" / "audit_month=2026-06"
    path.mkdir(parents=True)
    (path / "part-0.parquet").write_bytes(b"no parquet at all")
    with pytest.raises(Exception, match="(?i)footer|parquet|schema"):
        appends.append_batch(first_timers(spark, [1]), str(tmp_path / "t"), FT)


# marks and whole runs


def test_mark_comes_from_the_newest_month_that_has_a_day(spark, tmp_path):
    path, as_of = str(tmp_path / "t"), date(2026, 9, 1)
    tables.write_table(first_timers(spark, [1], "06/05/2026").unionByName(first_timers(spark, [2], "07/09/2026"))
                       .unionByName(first_timers(spark, [3], "not a day")), path, FT)
    junk = first_timers(spark, [4], "08/03/2026").withColumn(FT.names[0], F.lit("# note"))
    tables.append(junk, path, FT)
    assert tables.months(spark, path) == ["2026-08", "2026-07", "2026-06"]
    assert sync.stored_mark(spark, path, FT, as_of) == I.read_mark(spark.read.parquet(path), FT, as_of) == date(2026, 7, 9)
    month = spark.read.parquet(path).where(F.col(tables.MONTH) == "2026-07")
    assert "audit_month" in plan_of(month).split("PartitionFilters")[1].split("]")[0]
    tables.write_table(first_timers(spark, [5], "nothing"), str(tmp_path / "n"), FT)
    assert sync.stored_mark(spark, str(tmp_path / "n"), FT, as_of) == as_of - timedelta(days=7)


def test_a_run_counts_while_it_writes(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(first_timers(spark, [1, 2], "06/05/2026"), path, FT)
    source = first_timers(spark, [1, 2, 3, 3, 4], "06/06/2026")
    record = sync.sync_table(source, path, FT, date(2026, 6, 9), "first timers").first()
    assert (record["job"], record["imported"], record["ignored"], record["status"]) == ("first timers", 2, 3, "completed")
    assert ids_of(spark, path) == [1, 2, 3, 4]
    again = sync.sync_table(source, path, FT, date(2026, 6, 9), "first timers").first()
    assert (again["imported"], again["ignored"]) == (0, 5) and ids_of(spark, path) == [1, 2, 3, 4]
    early = sync.sync_table(source, path, FT, date(2026, 6, 2), "first timers").first()
    assert (early["imported"], early["ignored"]) == (0, 0)


# reminders by due time

CELLS = "reservation_id int, status string, reservation_type string, start_datetime timestamp, changed int"


@pytest.fixture
def desk(spark, tmp_path):
    class Desk:
        reminders = Reminders(spark, str(tmp_path / "r"), 4)

        def land(self, *rows):
            made = [(i, status, "standard", start, changed) for i, status, start, changed in rows]
            spark.createDataFrame(made, CELLS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            stream = spark.readStream.schema(CELLS).parquet(str(tmp_path / "in"))
            take_stream(stream, self.reminders, str(tmp_path / "state"), F.col("changed")).awaitTermination()

        def run(self, now):
            return sorted((r["reservation_id"], r["start"]) for r in self.reminders.remind(now).collect())

    return Desk()


NOW = datetime(2026, 8, 3, 9, 20)
SOON, NEXT_MONTH = datetime(2026, 8, 4, 12, 59), datetime(2026, 9, 1, 18, 0)


def test_reminders_go_out_when_their_hour_is_due(desk):
    desk.land((1, "pending", NEXT_MONTH, 0), (2, "pending", SOON, 0), (3, "pending", datetime(2026, 8, 4, 13, 0), 0),
              (4, "pending", NOW, 0), (5, "late Cancel", SOON, 0), (6, "pending", None, 0), (None, "pending", SOON, 0), (7, "pending", datetime(2026, 8, 3, 9, 21), 0))
    assert desk.run(NOW) == [(2, SOON), (7, datetime(2026, 8, 3, 9, 21))]
    assert desk.run(NOW) == []
    desk.land((8, "pending", SOON, 0), (2, "pending", SOON, 5))  # one that comes late, one that comes again
    assert desk.run(NOW + timedelta(minutes=10)) == [(8, SOON)]
    assert desk.run(NOW + timedelta(hours=1)) == [(3, datetime(2026, 8, 4, 13, 0))]
    assert desk.run(datetime(2026, 8, 31, 14, 59)) == []
    assert desk.run(datetime(2026, 8, 31, 15, 0)) == [(1, NEXT_MONTH)]
    assert desk.reminders.sent().count() == 5


def test_what_a_booking_is_when_due_decides(desk):
    late, moved = datetime(2026, 8, 4, 11, 0), datetime(2026, 8, 20, 7, 0)
    desk.land((1, "pending", SOON, 0), (2, "pending", SOON, 0), (3, "pending", SOON, 0), (4, "pending", SOON, 1), (4, "late Cancel", SOON, 1))
    desk.land((1, "late Cancel", SOON, 0), (2, "pending", moved, 0), (3, "pending", late, 1), (3, "pending", SOON, 2))
    assert desk.run(NOW) == [(3, SOON)]
    desk.land((1, "pending", SOON, 0), (3, "pending", moved, 0))
    assert desk.run(NOW) == [(1, SOON)]
    assert desk.run(moved - timedelta(hours=2)) == [(2, moved), (3, moved)]


def test_a_batch_taken_again_and_a_death_between_steps(desk, spark):
    rows = spark.createDataFrame([(1, "pending", "standard", SOON, 0), (2, "pending", "standard", NEXT_MONTH, 0)], CELLS)
    for _ in range(2):
        desk.reminders.take(rows, 0, F.col("changed"))
    desk.reminders.take(rows.where("reservation_id = 2").withColumn("status", F.lit("late Cancel")), 1, F.col("changed"))
    desk.reminders.take(rows, 0, F.col("changed"))
    with pytest.MonkeyPatch.context() as patch:
        def dies(*_):
            raise RuntimeError("lost")
        patch.setattr(Reminders, "_append", dies)
        with pytest.raises(RuntimeError):
            desk.run(NOW)
    assert desk.run(NOW) == [(1, SOON)]
    assert desk.run(NEXT_MONTH - timedelta(hours=5)) == []


def test_only_the_days_ahead_are_read_and_past_ones_go(desk, spark):
    desk.land(*[(i, "pending", datetime(2026, 8, 1) + timedelta(hours=7 * i), 0) for i in range(40)])
    days = Files(spark, desk.reminders.home).names(desk.reminders.pending)
    assert sum(d.startswith("start_day") for d in days) == 12
    due = desk.run(NOW)
    assert [i for i, _ in due] == [i for i in range(40) if NOW < datetime(2026, 8, 1) + timedelta(hours=7 * i) < datetime(2026, 8, 4, 13)]
    seen = []
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr("rosterlake.streaming.due_reminders.cut_lineage", lambda df: seen.append(df) or df.checkpoint())
        desk.reminders.due(NOW)
    plan = plan_of(seen[0])
    assert "start_day" in plan.split("PartitionFilters")[1].split("]")[0] and "start" in plan.split("PushedFilters")[1].split("]")[0]
    assert len(desk.reminders.forget(NOW)) == 2 and desk.reminders.forget(NOW) == []
    assert desk.run(NOW) == [] and len(desk.run(NOW + timedelta(days=1))) == 3
