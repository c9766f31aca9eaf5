"""Rows for trying a transform, drawn from the declared types of a table.

Each column is a function of the row number, the column's place and a seed, so
the same call gives the same rows, however they are spread.  A value covers
the range of its type: all integers of its width, all decimals of its
precision, texts up to its length.  A type that ends in ``null`` gives a null
in one row of eight; ``[]`` gives arrays of none to three values.  Types that
are not known are texts.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bits of the integer types.
INTEGERS = {"int2": 16, "smallint": 16, "int": 32, "int4": 32, "integer": 32, "serial": 32, "int8": 64, "bigint": 64, "long": 64, "bigserial": 64}
#: Letters for the sixteen digits of a hash; one is a space, so texts have words.
LETTERS = "etaoinsrhldcum p"
PRECISION, SCALE, TEXT_LENGTH, ARRAY_LENGTH = 18, 4, 60, 3
#: Moments lie in the seconds of these years.
FIRST_SECOND, SECONDS = 946_684_800, 1_000_000_000

DECLARED = re.compile(r"^_?(?P<base>[a-z0-9 ]+?)\s*(?:\((?P<size>\d+)(?:\s*,\s*(?P<scale>\d+))?\)[a-z ]*)?(?P<array>\[\])?$")


class Stream:
    """Independent draws for one column."""

    def __init__(self, *names):
        self.names, self.n = names, 0

    def bits(self) -> Column:
        """64 random bits of each row."""
        self.n += 1
        return F.xxhash64("id", *[F.lit(str(x)) for x in self.names], F.lit(self.n))

    def below(self, n: int) -> Column:
        return F.pmod(self.bits(), F.lit(n).cast("long"))

    def digits(self) -> Column:
        """32 random hexadecimal digits."""
        return F.md5(self.bits().cast("string"))


def _text(s: Stream, length: int) -> Column:
    pieces = F.concat(*[F.translate(s.digits(), "0123456789abcdef", LETTERS) for _ in range(-(-length // 32))])
    return F.btrim(F.substring(pieces, 1, length))


def _uuid(s: Stream) -> Column:
    """Version 4, variant 1."""
    h = s.digits()
    variant = F.substring(F.lit("89ab"), F.pmod(s.bits(), F.lit(4)).cast("int") + 1, F.lit(1))
    return F.concat(h.substr(1, 8), F.lit("-"), h.substr(9, 4), F.lit("-4"), h.substr(13, 3), F.lit("-"), variant, h.substr(16, 3), F.lit("-"), h.substr(19, 12))


def _moment(s: Stream, form: str) -> Column:
    return F.date_format(F.timestamp_seconds(s.below(SECONDS) + FIRST_SECOND), form)


def _scalar(s: Stream, base: str, size: int | None, scale: int | None) -> Column:
    if base in INTEGERS:
        width = INTEGERS[base]
        return F.shiftright(s.bits(), 64 - width) if width < 64 else s.bits()
    if base in ("numeric", "decimal"):
        p, q = (size or PRECISION), (scale if scale is not None else 0 if size else SCALE)
        top = 10 ** min(p, 18)
        return (s.below(2 * top - 1) - (top - 1)).cast("decimal(38,0)").cast(f"decimal(38,{q})") / F.lit(10**q)
    if base in ("real", "float", "float4", "float8", "double", "double precision"):
        return s.bits() / F.lit(float(2**40))
    if base in ("bool", "boolean"):
        return s.below(2) == 1
    if base == "uuid":
        return _uuid(s)
    if base == "bytea":
        return F.unhex(s.digits())
    if base in ("json", "jsonb"):
        return F.to_json(F.struct(s.below(1000).alias("n"), _text(s, 20).alias("t")))
    if base.startswith("timestamp"):
        return _moment(s, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    if base == "date":
        return _moment(s, "yyyy-MM-dd")
    if base.startswith("time"):
        return _moment(s, "HH:mm:ss")
    return _text(s, size or TEXT_LENGTH)


def value(declared: str, *stream) -> Column:
    """A value of a declared type; ``stream`` tells columns and seeds apart."""
    kind = declared.strip().lower()
    s = Stream(*stream)
    optional = kind.endswith(" null") and not kind.endswith("not null")
    kind = kind.removesuffix(" null").removesuffix(" not").strip()
    m = DECLARED.match(kind)
    base, size, scale = (m["base"], *(int(x) if x else None for x in (m["size"], m["scale"]))) if m else ("text", None, None)
    if m and (m["array"] or kind.startswith("_")):
        found = F.slice(F.array(*[_scalar(s, base, size, scale) for _ in range(ARRAY_LENGTH)]), F.lit(1), s.below(ARRAY_LENGTH + 1).cast("int"))
    else:
        found = _scalar(s, base, size, scale)
    return F.when(s.below(8) > 0, found) if optional else found


def identity(id_type: str, *stream) -> Column:
    """An id of a mapping's id type, different in each row (but for a hash's chance)."""
    s = Stream(*stream)
    if id_type == "uuid":
        return _uuid(s)
    if id_type in ("int", "uint"):
        return s.bits() if id_type == "int" else F.shiftrightunsigned(s.bits(), 1)
    return s.digits()


def rows(spark: SparkSession, columns: dict[str, str], n: int, id_column: str | None = None, id_type: str = "uint", seed: int = 0) -> DataFrame:
    """``n`` rows with the columns (name to type) given; the same for the same seed."""
    made = [(identity(id_type, seed, i) if c == id_column else value(t, seed, i)).alias(c) for i, (c, t) in enumerate(columns.items())]
    return spark.range(n).select(*made)
