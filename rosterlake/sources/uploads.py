"""Uploaded CSV files whose header names are chosen by the sender."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class MissingHeaders(ValueError):
    """Mapped headers that the file does not have."""


def _norm(name: str) -> str:
    return name.replace("\ufeff", "").strip().lower()


def read_mapped_csv(spark: SparkSession, path: str, mapping: dict[str, str]) -> DataFrame:
    """Columns named by ``mapping`` (our name -> header in the file), all text; wholly empty rows are dropped.

    Header order, case and surrounding blanks are free. Quoted commas, doubled quotes and line breaks inside
    quotes are read as part of the value.
    """
    raw = (
        spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True)
        .option("mode", "PERMISSIVE").csv(path)
    )
    seen = {}
    for position, column in enumerate(raw.columns):
        seen.setdefault(_norm(column), position)
    missing = [
        f"{name}: (blank mapping)" if not _norm(header) else f'{name}: "{header}"'
        for name, header in mapping.items()
        if not _norm(header) or _norm(header) not in seen
    ]
    if missing:
        raise MissingHeaders(
            "mapped headers not found in the file:\n- " + "\n- ".join(missing)
            + "\nheaders seen:\n- " + "\n- ".join(raw.columns)
        )
    plain = raw.toDF(*[f"c{i}" for i in range(len(raw.columns))])
    filled = F.lit(False)
    for c in plain.columns:
        filled = filled | (F.coalesce(F.trim(c), F.lit("")) != "")
    return plain.where(filled).select(
        *[F.coalesce(F.col(f"c{seen[_norm(h)]}"), F.lit("")).alias(n) for n, h in mapping.items()]
    )
