"""Paged entity files ``{"data": [{"id", "attributes", "relationships"}, ...]}``, one file per page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterlake.sources.reports import PAGE, paged

_REF = T.StructType([T.StructField("id", T.StringType())])
_ONE = T.StructType([T.StructField("data", _REF)])
_MANY = T.StructType([T.StructField("data", T.ArrayType(_REF))])


def _entity(attributes: dict[str, T.DataType], one: tuple[str, ...] = (), many: tuple[str, ...] = ()) -> T.StructType:
    relations = [T.StructField(n, _ONE) for n in one] + [T.StructField(n, _MANY) for n in many]
    fields = [
        T.StructField("id", T.StringType()),
        T.StructField("attributes", T.StructType([T.StructField(n, t) for n, t in attributes.items()])),
    ]
    if relations:
        fields.append(T.StructField("relationships", T.StructType(relations)))
    return T.StructType(fields)


_S, _L, _B = T.StringType(), T.LongType(), T.BooleanType()

RESERVATION = _entity(
    {n: _S for n in ("status", "reservation_type", "guest_email", "class_session_min_datetime",
                     "class_session_start_datetime", "class_session_start", "start_datetime", "start_date",
                     "start_time", "created_at", "updated_at")},
    one=("class_session", "user", "spot"), many=("tags",),
)
USER = _entity({
    **{n: _S for n in ("email", "first_name", "last_name", "full_name", "phone_number", "birth_date", "archived_at",
                       "date_joined")},
    "marketing_opt_in": _B,
})
CLASS_SESSION = _entity(
    {**{n: _S for n in ("class_type_display", "public_note", "start_datetime", "start_date", "start_time",
                        "instructor_names")},
     "checked_in_user_count": _L},
    one=("location",),
)
CREDIT_TRANSACTION = _entity(
    {"remaining_credits_cache": _L, "is_expired": _B, "expiration_datetime": _S, "credit_name": _S}, one=("user",)
)
MEMBERSHIP_INSTANCE = _entity({"status": _S, "membership_name": _S}, one=("user",))
LOCATION = _entity({"name": _S})
SPOT = _entity({"name": _S})


#: Attributes that come as an array or as one text; a text column takes both, and ``name_list`` reads it.
NAME_LISTS = ("instructor_names",)


def name_list(c: Column) -> Column:
    """Array of names from JSON array text or from a single name."""
    return F.when(c.startswith("["), F.from_json(c, "array<string>")).when(c.isNotNull(), F.array(c))


def flatten_entities(pages: DataFrame, schema: T.StructType) -> DataFrame:
    """``id``, every attribute, ``<relation>_id`` for to-one and an id array for to-many relations."""
    item = pages.select(F.explode("data").alias("e"))
    columns: list[Column] = [F.col("e.id").alias("id")]
    for f in schema["attributes"].dataType.fields:
        value = F.col(f"e.attributes.{f.name}")
        columns.append((name_list(value) if f.name in NAME_LISTS else value).alias(f.name))
    if "relationships" in schema.fieldNames():
        for f in schema["relationships"].dataType.fields:
            many = isinstance(f.dataType["data"].dataType, T.ArrayType)
            ids = F.col(f"e.relationships.{f.name}.data.id")
            columns.append(ids.alias(f.name if many else f"{f.name}_id"))
    return item.select(*columns)


def read_entities(spark: SparkSession, path: str | list[str], schema: T.StructType, lines: bool = False) -> DataFrame:
    """Read a folder of pages. Pages are files, or with ``lines`` lines of files, so a folder of any size is spread over tasks."""
    page = T.StructType([T.StructField("data", T.ArrayType(schema))])
    return flatten_entities(spark.read.schema(page).option("multiLine", not lines).json(path), schema)


def write_entities(entities: DataFrame, path: str, page: int = PAGE) -> None:
    """Land entities (``id``, ``attributes`` and what else they have) as pages of at most ``page``, one a line."""
    paged(entities, F.struct(*entities.columns), page, "data").write.json(path)
