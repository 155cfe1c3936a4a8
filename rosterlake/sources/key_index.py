"""Which keys a table holds, without reading the table: a list of them beside it, dealt into buckets by hash.

A batch looks into the buckets of its own keys. The list follows the table: a marker is put down before rows are appended and
taken away once their keys are listed. Where a job died in between, or there is no list yet, it is made anew from the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlake.sources import keyed_tables as KT
from rosterlake.sources.files import Files

OPEN = "_open"


class KeyIndex:
    """The keys of the table at ``path``. ``keys`` are the names of its key columns, null equal to null."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int = KT.BUCKETS):
        self.spark, self.path, self.keys = spark, f"{path.rstrip('/')}.keys", tuple(keys)
        self._buckets, self._files = buckets, Files(spark, path)

    def ready(self, stored: DataFrame) -> None:
        """See that the list holds exactly the keys of ``stored``, a frame with the key columns."""
        if not self._files.exists(f"{self.path}/{KT.FACTS}") or self._files.exists(f"{self.path}/{OPEN}"):
            self._files.remove(self.path)
            KT.create(stored.select(*self.keys).distinct(), self.path, self.keys, self._buckets)

    def held(self, wanted: DataFrame) -> DataFrame:
        """The listed keys in the buckets of ``wanted``. Only those buckets are read."""
        table = KT.open_keyed(self.spark, self.path)
        touched = table.touched(wanted)
        return table.rows(touched).select(*self.keys)

    def begin(self) -> None:
        self._files.write(f"{self.path}/{OPEN}", "")

    def add(self, rows: DataFrame) -> None:
        """List the keys of rows that are in the table now."""
        table = KT.open_keyed(self.spark, self.path)
        table.dealt(rows.select(*self.keys).distinct()).hint("rebalance", KT.BUCKET).write.mode("append").partitionBy(KT.BUCKET).parquet(self.path)
        self._files.remove(f"{self.path}/{OPEN}")
