"""Replacing partitions of a stored table so that a job may die anywhere.

A replacement is written whole into a folder beside the table and counted there. Then its plan, an intent record, is written:
which partitions come and which go. Only then are folders moved, each by one rename: the old one out, the new one in. Whoever
opens the table next finishes a replacement that has a plan and throws away one that has none, so a table is as it was before
or as it should be afterwards, never a mixture that stays.

One writer a table at a time, as with any table of files. Between the two renames of a partition it is missing for readers;
the rest of the table is not touched. Renames have to be single steps, as on HDFS and local disks.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from rosterlake.sources.files import Files

INTENT = "intent.json"


class RowCountMismatch(RuntimeError):
    """A staged replacement does not hold the expected number of rows."""


def beside(path: str) -> str:
    """The folder of a table's open replacements; outside the table, so that no reader looks into it."""
    return f"{path.rstrip('/')}.swap"


def _finish(files: Files, path: str, at: str) -> None:
    """Carry out what is left of a plan. Every step looks at what is there, so it may be done again after any of them."""
    plan = json.loads(files.read(f"{at}/{INTENT}"))
    for name in plan["replaced"]:
        new, old, here = f"{at}/new/{name}".rstrip("/"), f"{at}/old/{name}".rstrip("/"), f"{path}/{name}".rstrip("/")
        if files.exists(new):
            if files.exists(here):
                files.move(here, old)
            files.move(new, here)
    for name in plan["removed"]:
        if files.exists(f"{path}/{name}"):
            files.move(f"{path}/{name}", f"{at}/old/{name}")
    files.remove(at)


def recover(spark: SparkSession, path: str) -> int:
    """Finish or undo what earlier jobs left behind; returns how many replacements were open."""
    path = path.rstrip("/")
    files = Files(spark, path)
    left = files.names(beside(path))
    for name in left:
        at = f"{beside(path)}/{name}"
        if files.exists(f"{at}/{INTENT}"):
            _finish(files, path, at)
        else:
            files.remove(at)
    return len(left)


def replace(df: DataFrame, path: str, column: str | None, removed: list[str] = (), expected: int | None = None) -> int:
    """Put the rows of ``df`` in place of the partitions of ``column`` that they belong to, and take the partitions named in
    ``removed`` out; without a column the whole table is replaced. Returns the number of rows written.

    ``df`` may be computed from the same table. A number of rows other than ``expected`` leaves the table as it was.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    recover(spark, path)
    files = Files(spark, path)
    at = f"{beside(path)}/{uuid.uuid4().hex}"
    writer = df.write if column is None else df.write.partitionBy(column)
    writer.parquet(f"{at}/new")
    found = spark.read.schema(df.schema).parquet(f"{at}/new").count()
    if expected is not None and found != expected:
        files.remove(at)
        raise RowCountMismatch(f"{path}: staged {found} rows, expected {expected}; nothing was replaced")
    coming = [""] if column is None else [n for n in files.names(f"{at}/new") if n.startswith(f"{column}=")]
    going = [f"{column}={value}" for value in removed]
    files.write(f"{at}/{INTENT}", json.dumps({"replaced": coming, "removed": [n for n in going if n not in coming]}))
    _finish(files, path, at)
    return found
