"""Values: typing of the server's texts, JSON, document texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Type numbers of the server by kind of value.
BOOL_OIDS = (16,)
INT_OIDS = (20, 21, 23)
FLOAT_OIDS = (700, 701, 1700)
JSON_OIDS = (114, 3802)

#: The server's type names by kind of value.
BOOL_TYPES = ("bool", "boolean")
INT_TYPES = ("int2", "int4", "int8", "smallint", "integer", "int", "bigint", "serial", "bigserial")
FLOAT_TYPES = ("float4", "float8", "real", "double precision", "numeric", "decimal")
JSON_TYPES = ("json", "jsonb")

#: Texts that a 64-bit integer and a float may have.
INT_TEXT = r"^[+-]?[0-9]+$"
FLOAT_TEXT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$|^[+-]?(?i:inf|infinity|nan)$"


def kind_of_oid(oid: Column) -> Column:
    """bool, int, float, json or string for a type number."""
    return F.when(oid.isin(*BOOL_OIDS), "bool").when(oid.isin(*INT_OIDS), "int").when(oid.isin(*FLOAT_OIDS), "float").when(oid.isin(*JSON_OIDS), "json").otherwise("string")


def kind_of_type(name: str) -> str:
    name = name.lower()
    for kind, names in (("bool", BOOL_TYPES), ("int", INT_TYPES), ("float", FLOAT_TYPES), ("json", JSON_TYPES)):
        if name in names:
            return kind
    return "string"


def as_bool(text: Column) -> Column:
    return F.when(text.isNotNull(), text.isin("t", "true"))


def as_int(text: Column) -> Column:
    """A long, null where the text is none of 64 bits."""
    return F.when(text.rlike(INT_TEXT), text.try_cast("long"))


def as_float(text: Column) -> Column:
    """A double, null where the text is no number."""
    lowered = F.lower(text)
    return (
        F.when(lowered.rlike(r"^[+]?inf(inity)?$"), F.lit(float("inf")))
        .when(lowered.rlike(r"^-inf(inity)?$"), F.lit(float("-inf")))
        .when(lowered.rlike(r"^[+-]?nan$"), F.lit(float("nan")))
        .when(text.rlike(FLOAT_TEXT), text.try_cast("double"))
    )


def typed(text: Column, kind: str) -> Column:
    """A text of the server as a column of its kind (json stays a text)."""
    return {"bool": as_bool, "int": as_int, "float": as_float}.get(kind, lambda c: c)(text)


def json_of_text(text: Column, kind: Column) -> Column:
    """A text of the server as JSON by kind; what does not parse is a string."""
    as_text = F.to_json(F.array(text))
    as_text = F.substring(as_text, F.lit(2), F.length(as_text) - 2)
    number = as_float(text)
    finite = number.isNotNull() & ~F.isnan(number) & (F.abs(number) != float("inf"))
    parsed = F.to_json(F.try_parse_json(text))
    value = (
        F.when(kind == "bool", as_bool(text).cast("string"))
        .when((kind == "int") & as_int(text).isNotNull(), as_int(text).cast("string"))
        .when((kind == "float") & number.isNotNull(), F.when(finite, F.to_json(F.array(number)).substr(F.lit(2), F.length(F.to_json(F.array(number))) - 2)).otherwise("null"))
        .when((kind == "json") & parsed.isNotNull(), parsed)
        .otherwise(as_text)
    )
    return F.when(text.isNull(), "null").otherwise(value)


def json_value(column: Column, dtype: T.DataType) -> Column:
    """A value that ``to_json`` writes the way documents want it: not-a-number
    and infinite floats are null, decimals and floats are doubles, timestamps
    and dates are texts."""
    if isinstance(dtype, (T.DoubleType, T.FloatType, T.DecimalType)):
        wide = column.cast("double")
        return F.when(~F.isnan(wide) & (F.abs(wide) != float("inf")), wide)
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return column.cast("long")
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return column.cast("string")
    return column


def document(values: list[tuple[str, Column]]) -> Column:
    """The JSON text of an object with these entries, nulls kept."""
    return F.to_json(F.struct(*[v.alias(k) for k, v in values]), {"ignoreNullFields": "false"}) if values else F.lit("{}")


def cursor(column: Column, dtype: T.DataType) -> Column:
    """A value as the text of a resume cursor: null is empty, arrays and structs are JSON."""
    if isinstance(dtype, (T.ArrayType, T.StructType, T.MapType)):
        return F.coalesce(F.to_json(column), F.lit(""))
    return F.coalesce(column.cast("string"), F.lit(""))
