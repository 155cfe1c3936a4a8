"""A job that dies between any two steps of a replacement leaves a table that is as it was or as it should be."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from rosterlake import specs
from rosterlake.plans import audit, retention
from rosterlake.sources import swap, tables
from rosterlake.sources.files import Files

CELLS = "id int, audit_month string"


class Died(Exception):
    pass


class Mortal:
    """Lets so many file steps happen and then fails, before or after the next one."""

    def __init__(self, monkeypatch, steps, after):
        self.left = steps
        for name in ("move", "remove", "write"):
            def step(own, *args, real=getattr(Files, name)):
                self.left -= 1
                if self.left < 0 and not after:
                    raise Died
                real(own, *args)
                if self.left < 0:
                    raise Died
            monkeypatch.setattr(Files, name, step)


def rows(spark, path):
    return sorted((r["id"], r["audit_month"]) for r in spark.read.schema(CELLS).parquet(path).collect())


BEFORE = [(1, "2026-05"), (2, "2026-06"), (3, "2026-06"), (4, "2026-07"), (5, "none")]
AFTER = [(1, "2026-05"), (5, "none"), (20, "2026-06"), (40, "2026-08")]


@pytest.mark.parametrize("after", [False, True])
@pytest.mark.parametrize("steps", range(8))
def test_dying_between_any_two_steps(spark, tmp_path, steps, after):
    path = str(tmp_path / "table")
    spark.createDataFrame(BEFORE, CELLS).write.partitionBy("audit_month").parquet(path)
    new = spark.createDataFrame([(20, "2026-06"), (40, "2026-08")], CELLS)
    with pytest.MonkeyPatch.context() as patch:
        Mortal(patch, steps, after)
        try:
            swap.replace(new, path, "audit_month", ["2026-07"], expected=2)
        except Died:
            pass
    left = list((tmp_path / "table.swap").iterdir())
    undone = left and not (left[0] / swap.INTENT).exists()
    assert swap.recover(spark, path) == len(left)
    assert rows(spark, path) == (BEFORE if undone else AFTER)
    assert undone or steps or after
    assert not list((tmp_path / "table.swap").iterdir())
    assert swap.recover(spark, path) == 0
    swap.replace(spark.createDataFrame([(9, "2026-05")], CELLS), path, "audit_month")
    assert (9, "2026-05") in rows(spark, path) and (1, "2026-05") not in rows(spark, path)


def test_dying_while_recovering(spark, tmp_path):
    path = str(tmp_path / "table")
    spark.createDataFrame(BEFORE, CELLS).write.partitionBy("audit_month").parquet(path)
    new = spark.createDataFrame([(20, "2026-06"), (40, "2026-08")], CELLS)
    with pytest.MonkeyPatch.context() as patch:
        Mortal(patch, 2, False)
        with pytest.raises(Died):
            swap.replace(new, path, "audit_month", ["2026-07"])
    for _ in range(6):
        with pytest.MonkeyPatch.context() as patch:
            Mortal(patch, 1, True)
            try:
                tables.open_table(spark, path)
                break
            except Died:
                pass
    assert rows(spark, path) == AFTER


def test_a_whole_table_is_replaced_or_left(spark, tmp_path):
    path = str(tmp_path / "table")
    spark.range(3).write.parquet(path)
    for steps in range(6):
        with pytest.MonkeyPatch.context() as patch:
            Mortal(patch, steps, False)
            try:
                tables.replace_table(spark.read.parquet(path).withColumn("id", F.col("id") + 10), path, 3)
            except Died:
                pass
        got = sorted(r["id"] for r in tables.open_table(spark, path).collect())
        assert len(got) == 3 and len({x // 10 for x in got}) == 1
    with pytest.raises(tables.RowCountMismatch):
        tables.replace_table(spark.range(2), path, 3)
    assert tables.open_table(spark, path).count() == 3 and swap.recover(spark, path) == 0


def test_audit_and_purge_finish_what_was_left(spark, tmp_path):
    spec, path = specs.FIRST_TIMERS_TYPED, str(tmp_path / "table")
    key, day = spec.names.index(spec.keys[0]), spec.names.index(spec.date_column)
    made = [tuple(i if at == key else date(2026, 6, 2 + i % 3) if at == day and spec.kinds[at] == "date" else None for at in range(len(spec.names))) for i in range(4)]
    stored = spark.createDataFrame(made + made[:1], spec.schema)
    tables.write_table(stored, path, spec)
    with pytest.MonkeyPatch.context() as patch:
        Mortal(patch, 2, True)  # the old month is out, the new one not in
        with pytest.raises(Died):
            audit.apply_audit(spec, path, stored.limit(0), "2026-06", date(2026, 7, 3))
    assert not (tmp_path / "table" / "audit_month=2026-06").exists()
    doomed = spark.createDataFrame([(1,)], f"`{spec.keys[0]}` bigint")
    left = retention.apply_purge(spark, path, doomed, [spec.keys[0]])
    assert sorted(r[spec.keys[0]] for r in left.collect()) == [0, 2, 3]
