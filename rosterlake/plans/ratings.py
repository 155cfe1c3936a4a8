"""Instructor ratings: import of uploaded files without duplicates, and the people behind them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rosterlake.functions import dates as D
from rosterlake.functions import text as X
from rosterlake.operators import filters as P
from rosterlake.operators import keyed as K
from rosterlake.operators import matching as N
from rosterlake.sources.outbox import run_record
from rosterlake.sources.uploads import read_mapped_csv

ANONYMOUS = "anonymous user"
DEFAULT_HEADERS = {
    "contact": "Contact", "date_text": "Response Date", "rating_text": "Rating", "comment": "Comment",
    "class_type": "Class", "instructor": "Instructor",
}


def rating_number(c: Column) -> Column:
    """The rating as text of a plain number (``5.0`` -> ``5``), empty when it is none."""
    value = X.to_float(c)
    whole = F.when(value == F.floor(value), F.floor(value).cast("string")).otherwise(value.cast("string"))
    return F.coalesce(whole, F.lit(""))


def rating_key(contact: Column, day: Column, instructor: Column, rating: Column, class_type: Column) -> Column:
    """Identity of a rating: anonymous ones by day, instructor, rating and class; named ones by person, day, class."""
    who = F.lower(F.trim(contact))
    day_text = F.date_format(day, "yyyy-MM-dd")
    cls = F.coalesce(F.lower(F.trim(class_type)), F.lit(""))
    anon = F.concat_ws("|", F.lit("anon"), day_text, F.coalesce(F.lower(F.trim(instructor)), F.lit("")),
                       F.coalesce(rating, F.lit("")), cls)
    named = F.concat_ws("|", F.lit("named"), who, day_text, cls)
    return F.when((F.coalesce(who, F.lit("")) != "") & day.isNotNull(), F.when(who == ANONYMOUS, anon).otherwise(named))


def prepare_ratings(rows: DataFrame) -> DataFrame:
    """Uploaded rows with trimmed values, a day, a rating number and their key."""
    trimmed = rows.withColumns({c: F.trim(F.coalesce(F.col(c), F.lit(""))) for c in DEFAULT_HEADERS})
    typed = trimmed.withColumns({"day": D.parse_date_any(F.col("date_text")),
                                 "rating": rating_number(F.col("rating_text"))})
    return typed.withColumn("dedupe_key", rating_key(
        F.col("contact"), F.col("day"), F.col("instructor"), F.col("rating"), F.col("class_type")))


def newest_first(df: DataFrame, column: str) -> DataFrame:
    return df.orderBy(F.col(column).desc())


def mark_ratings(rows: DataFrame, existing: DataFrame, line: str = "line") -> DataFrame:
    """Every uploaded row with its outcome: imported, missing contact or date, repeated in the file, already stored.

    ``line`` orders rows that share a key; the first one counts. Stored keys are looked up for the file's keys only.
    The key holds the day, so even anonymous ratings are spread over many keys, and the rank is cut to one row per key
    inside each task.
    """
    ready = prepare_ratings(rows)
    good, bad = P.split_valid(ready, [
        ("missing contact or date", (F.col("contact") == "") | F.col("day").isNull()),
    ])
    # the rank of a repeated row does not matter, so repeats are told apart from the first row by its line only
    first = good.groupBy("dedupe_key").agg(F.min(line).alias("first_line"))
    stored = existing.select("dedupe_key").join(first.select("dedupe_key"), "dedupe_key", "left_semi").distinct()
    known = first.join(stored.withColumn("is_stored", F.lit(True)), "dedupe_key", "left")
    judged = good.join(known, "dedupe_key").withColumn(
        "reason",
        F.when(F.col(line) != F.col("first_line"), "duplicate inside the file")
        .when(F.col("is_stored"), "already stored"),
    ).drop("first_line", "is_stored")
    return judged.unionByName(bad.select(*judged.columns))


def new_ratings(marked: DataFrame) -> DataFrame:
    """The rows to store."""
    return marked.where(F.col("reason").isNull()).select(
        "dedupe_key", "contact", "day", F.nullif("instructor", F.lit("")).alias("instructor"),
        F.nullif("rating", F.lit("")).cast("double").alias("rating"), F.nullif("comment", F.lit("")).alias("comment"),
        F.nullif("class_type", F.lit("")).alias("class_type"),
    )


def new_ratings_direct(rows: DataFrame, existing: DataFrame, line: str = "line") -> DataFrame:
    """The rows to store without the reasons of the others: one ranked pass and one anti join."""
    ready = prepare_ratings(rows).where(F.col("dedupe_key").isNotNull())
    rank = F.row_number().over(Window.partitionBy("dedupe_key").orderBy(line))
    first = ready.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")
    return new_ratings(first.join(existing.select("dedupe_key"), "dedupe_key", "left_anti")
                       .withColumn("reason", F.lit(None).cast("string")))


def import_ratings(spark: SparkSession, path: str, existing: DataFrame, mapping: dict[str, str] | None = None
                   ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Read an uploaded file; returns the rows to store, the rejected rows and the run record."""
    rows = read_mapped_csv(spark, path, mapping or DEFAULT_HEADERS).withColumn("line", F.monotonically_increasing_id())
    marked = mark_ratings(rows, existing)
    issue = F.when(F.col("reason") == "missing contact or date", F.col("reason"))
    return (
        new_ratings(marked), marked.where(F.col("reason").isNotNull()),
        run_record(marked, "import_ratings", F.col("reason").isNull(), issue),
    )


def resolve_rating_emails(ratings: DataFrame, users: DataFrame, clients: DataFrame
                          ) -> tuple[DataFrame, DataFrame]:
    """Unlinked ratings with e-mail, outcome and client, and the clients to create."""
    resolved = N.resolve_email(P.needs_email(ratings), users)
    linked, created = K.link_or_create(
        resolved.drop("email").withColumnRenamed("resolved_email", "email"), clients
    )
    return linked, created
