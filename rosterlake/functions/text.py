"""Text, flag, number and privacy expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What counts as a number, a leading whole number, an e-mail address and an invisible character.
NUMBER = r"^\s*[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?\s*$"
LEADING_INT = r"^\s*([-+]?\d+)"
EMAIL_SHAPE = r"^[^\s@]+@[^\s@]+\.[^\s@]+$"
ZERO_WIDTH = "[\u200b-\u200d\ufeff]"


def blank_to_null(c: Column) -> Column:
    """Trimmed text, null when nothing is left."""
    return F.nullif(F.trim(c), F.lit(""))


def null_to_empty(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def bool_text(c: Column) -> Column:
    """``true`` / ``false`` in lower case, empty for null."""
    return F.coalesce(F.lower(c.cast("string")), F.lit(""))


def bool_string(c: Column) -> Column:
    """``true`` only for the word true in any case, ``false`` for other values, null for null."""
    return F.when(c.isNotNull(), F.when(F.lower(c.cast("string")) == "true", "true").otherwise("false"))


def to_bool(c: Column) -> Column:
    return F.lower(c.cast("string")) == "true"


def to_float(c: Column) -> Column:
    """Double, null for blank or non-numeric text."""
    return F.when(c.rlike(NUMBER), F.trim(c).try_cast("double"))


def to_int(c: Column) -> Column:
    """The leading whole number of the text, null when it has none."""
    return F.nullif(F.regexp_extract(c, LEADING_INT, 1), F.lit("")).try_cast("bigint")


def norm_email(c: Column) -> Column:
    return F.lower(F.trim(c))


def norm_name(c: Column) -> Column:
    """Key of a name lookup: trimmed, lower case, null when empty."""
    return F.nullif(F.lower(F.trim(c)), F.lit(""))


def is_email(c: Column) -> Column:
    return F.coalesce(F.trim(c).rlike(EMAIL_SHAPE), F.lit(False))


def digits(c: Column) -> Column:
    return F.regexp_replace(c, r"\D", "")


def pii_hash(c: Column) -> Column:
    """SHA-256 of the trimmed lower-case value; null when there is nothing to hash."""
    return F.sha2(F.nullif(F.lower(F.trim(c)), F.lit("")), 256)


def strip_zero_width(c: Column) -> Column:
    return F.trim(F.regexp_replace(c.cast("string"), ZERO_WIDTH, ""))


def mask_pii(c: Column, kind: str) -> Column:
    """Masked sample text: e-mails keep the first letter and the domain, phones the last two digits, names nothing."""
    if kind == "email":
        return F.regexp_replace(c, r"^(.).*(@.*)$", "$1***$2")
    if kind == "phone":
        return F.regexp_replace(c, r"\d(?=\d{2})", "*")
    if kind == "name":
        return F.when(c.isNotNull(), F.lit("[redacted name]"))
    raise ValueError(f"unknown kind of personal value: {kind}")


def first_of(c: Column) -> Column:
    """First element of an array, empty when there is none."""
    return F.coalesce(F.get(c, F.lit(0)), F.lit(""))


def lead_instructor(names: Column) -> Column:
    """First named instructor; all names joined when the first is blank; empty for none."""
    return F.coalesce(
        F.nullif(F.get(names, F.lit(0)), F.lit("")),
        F.when(F.size(names) > 0, F.concat_ws(", ", names)),
        F.lit(""),
    )


def full_name(first: Column, last: Column) -> Column:
    """Both parts joined by one space, blank parts left out, null when nothing is left."""
    return F.nullif(F.concat_ws(" ", F.nullif(first, F.lit("")), F.nullif(last, F.lit(""))), F.lit(""))


def status_set(c: Column) -> Column:
    """Distinct trimmed entries of a comma list; an empty array for null."""
    parts = F.transform(F.split(F.coalesce(c, F.lit("")), ","), lambda s: F.trim(s))
    return F.array_distinct(F.filter(parts, lambda s: s != ""))


def note_text(title: str, fields: Sequence[tuple[str, Column]]) -> Column:
    """A title line and one ``label: value`` line per field; missing values stay as an empty value."""
    lines = [F.lit(title)] + [F.concat(F.lit(f"{label}: "), null_to_empty(c)) for label, c in fields]
    return F.concat_ws("\n", *lines)


def row_digest(df: DataFrame) -> Column:
    """A 256-bit identity of a whole row. Nulls take part: a null field and an empty one differ.

    Shuffling this instead of 35 to 50 wide columns is what keeps duplicate counts cheap on a large table.
    """
    return F.sha2(F.to_json(F.struct(*[df[f"`{c}`"] for c in df.columns])), 256)
