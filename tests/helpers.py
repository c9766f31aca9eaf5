"""Schemas from short texts, without a session."""

from pyspark.sql import types as T

KINDS = {"int": T.IntegerType(), "long": T.LongType(), "double": T.DoubleType(), "string": T.StringType(), "boolean": T.BooleanType(), "timestamp_ntz": T.TimestampNTZType(), "float": T.FloatType(), "decimal": T.DecimalType(5, 2)}


def struct(text: str) -> T.StructType:
    fields = []
    for part in text.split(","):
        name, kind = part.split()
        found = T.ArrayType(KINDS[kind[6:-1]]) if kind.startswith("array<") else KINDS[kind]
        fields.append(T.StructField(name, found))
    return T.StructType(fields)
