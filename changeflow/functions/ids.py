"""Document ids: extraction, inference of their type, ids that transforms return."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
TEXTS = (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)
UUID = r"^(?:urn:uuid:)?[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$|^[0-9a-fA-F]{32}$|^\{[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}\}$"
INTEGER = r"^[+-]?[0-9]+$"


def _id(kind: str, text: Column, number: Column | None = None) -> Column:
    number = F.lit(None) if number is None else number
    return F.struct(F.lit(kind).alias("kind"), text.alias("text"), number.cast("decimal(20,0)").alias("number"))


def extract_id(image: Column, present: Column, id_type: str, dtype: T.DataType | None) -> tuple[Column, Column]:
    """(id, error kind) from the value of the id column.

    ``present``: whether the row image is there; ``dtype`` is None where the
    relation has no such column.  The error is null where there is an id:
    MissingId without an image, MissingColumn without the column, InvalidIdType
    for a value that the id type does not take.
    """
    none = F.lit(None).cast("struct<kind:string,text:string,number:decimal(20,0)>")
    if dtype is None:
        return none, F.when(present, F.lit("MissingColumn")).otherwise("MissingId")
    text = image.cast("string")
    if isinstance(dtype, INTEGERS):
        good = image.isNotNull() if id_type in ("int", "string") else (image >= 0) if id_type == "uint" else F.lit(False)
        made = _id(id_type, text, image if id_type != "string" else None)
    elif isinstance(dtype, TEXTS):
        good = image.isNotNull() if id_type in ("uuid", "string") else F.lit(False)
        made = _id(id_type, text)
    else:
        good, made = F.lit(False), none
    ok = present & F.coalesce(good, F.lit(False))
    return F.when(ok, made), F.when(~present, "MissingId").when(~ok, "InvalidIdType")


def infer_id_type(sample: DataFrame, declared: str, column: str = "value") -> DataFrame:
    """One row (id_type): the id type that a sample of texts and the declared type suggest.

    uuid by declaration; for integer columns uint if all are at least 0, else
    int; without rows string; else uuid, uint or int if all texts are, else string.
    """
    declared = declared.lower()
    if declared == "uuid":
        return sample.sparkSession.range(1).select(F.lit("uuid").alias("id_type"))
    v = F.col(column)
    number = F.when(v.rlike(INTEGER), v.try_cast("long"))
    every = lambda c: F.coalesce(F.every(F.coalesce(c, F.lit(False))), F.lit(True))
    facts = sample.agg(F.count(F.lit(1)).alias("n"), every(v.rlike(UUID)).alias("uuid"), every(number.isNotNull()).alias("integer"), every(number >= 0).alias("natural"))
    if declared in ("integer", "int", "int2", "int4", "int8", "smallint", "bigint", "serial", "bigserial"):
        return facts.select(F.when(F.col("natural"), "uint").otherwise("int").alias("id_type"))
    return facts.select(
        F.when(F.col("n") == 0, "string").when(F.col("uuid"), "uuid").when(F.col("integer") & F.col("natural"), "uint").when(F.col("integer"), "int").otherwise("string").alias("id_type")
    )


def values_match(sample: DataFrame, declared: str, id_type: str, column: str = "value") -> DataFrame:
    """One row (matches): whether a sample agrees with a configured id type; an empty one does."""
    v = F.col(column)
    number = F.when(v.rlike(INTEGER), v.try_cast("long"))
    if id_type == "string" or (id_type == "uuid" and declared.lower() == "uuid"):
        good = F.lit(True)
    elif id_type == "uuid":
        good = v.rlike(UUID)
    else:
        good = number >= 0 if id_type == "uint" else number.isNotNull()
    return sample.agg(F.coalesce(F.every(F.coalesce(good, F.lit(False))), F.lit(True)).alias("matches"))


def id_of_text(text: Column) -> Column:
    """An id that a transform returned as text: a uuid if it has 36 characters and a dash."""
    uuid = (F.length(text) == 36) & text.contains("-")
    return F.when(uuid, _id("uuid", text)).otherwise(_id("string", text))


def id_of_number(number: Column, default: Column) -> Column:
    """An id that a transform returned as a number: uint, int, or the default if it is no integer."""
    whole = number.try_cast("decimal(20,0)")
    exact = whole.isNotNull() & (whole.cast("double") == number.cast("double"))
    return F.when(exact & (whole >= 0), _id("uint", whole.cast("string"), whole)).when(exact, _id("int", whole.cast("string"), whole)).otherwise(default)


def as_unsigned(identity: Column) -> Column:
    """The number of an id where it has one that is at least 0."""
    return F.when(identity["number"] >= 0, identity["number"])
