"""The membership predicates: a small two-valued language compiled to columns.

    expression := or;  or := and (OR and)*;  and := not (AND not)*
    not := (NOT | !) not | primary
    primary := TRUE | FALSE | ( expression ) | column comparison
    comparison := (= | !=  | <>) literal | IS [NOT] NULL
    literal := 'text' | integer | float | TRUE | FALSE | NULL

Nothing is ever unknown: on null or without the column ``=`` is false and
``!=`` true.  Literals match values of their own kind only (integers and
floats match each other, within an absolute epsilon as soon as a float takes
part).  ``= NULL`` is true for a null that is there, ``IS NULL`` also without
the column.  Types are compared when the predicate is compiled, so that what
is left are null-safe comparisons, which reach the scan.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPSILON = 2.220446049250313e-16


class PredicateError(ValueError):
    """A text that is no predicate."""


@dataclass(frozen=True)
class Always:
    value: bool


@dataclass(frozen=True)
class Equals:
    column: str
    literal: object
    negated: bool = False


@dataclass(frozen=True)
class IsNull:
    column: str
    negated: bool = False


@dataclass(frozen=True)
class Not:
    inner: object


@dataclass(frozen=True)
class Both:
    parts: tuple


@dataclass(frozen=True)
class Either:
    parts: tuple


Predicate = Always | Equals | IsNull | Not | Both | Either

_TOKENS = re.compile(
    r"(?P<blank>\s+)|(?P<word>[A-Za-z_][A-Za-z0-9_.]*)|(?P<number>-?\d+(?:\.\d+)?(?![A-Za-z0-9_.]))|(?P<text>'[^']*'(?!'))|(?P<sign>!=|<>|=|\(|\)|!)"
)
_LENIENT = re.compile(r"(?P<blank>\s+)|(?P<word>[A-Za-z_][A-Za-z0-9_.]*)|(?P<number>-?\d+(?:\.\d*)?)|(?P<text>'[^']*(?:'|\Z))|(?P<sign>!=|=|\(|\)|!)|(?P<other>.)", re.DOTALL)
_WORDS = {"AND", "OR", "NOT", "IS", "NULL", "TRUE", "FALSE"}
_LONG = range(-(2**63), 2**63)


def _tokens(text: str, compat: bool) -> Iterator[tuple[str, object]]:
    at = 0
    while at < len(text):
        m = (_LENIENT if compat else _TOKENS).match(text, at)
        if not m:
            raise PredicateError(f"unexpected {text[at : at + 10]!r} at {at}")
        at, kind, found = m.end(), m.lastgroup, m[0]
        if kind == "word":
            upper = found.upper()
            yield ("sign", upper) if upper in _WORDS else ("column", found)
        elif kind == "text":
            yield "literal", found[1:].removesuffix("'")
        elif kind == "number":
            value = float(found) if "." in found else int(found)
            if isinstance(value, int) and value not in _LONG:
                if not compat:
                    raise PredicateError(f"integer beyond 64 bits: {found}")
                value = 0
            yield "literal", value
        elif kind == "sign":
            yield "sign", "!=" if found == "<>" else found


class _Reader:
    def __init__(self, text: str, compat: bool):
        self.tokens, self.at = [*_tokens(text, compat), ("end", None)], 0

    def take(self, *signs: str) -> str | None:
        kind, value = self.tokens[self.at]
        if kind == "sign" and value in signs:
            self.at += 1
            return value
        return None

    def either(self) -> Predicate:
        parts = [self.both()]
        while self.take("OR"):
            parts.append(self.both())
        return parts[0] if len(parts) == 1 else Either(tuple(parts))

    def both(self) -> Predicate:
        parts = [self.negation()]
        while self.take("AND"):
            parts.append(self.negation())
        return parts[0] if len(parts) == 1 else Both(tuple(parts))

    def negation(self) -> Predicate:
        return Not(self.negation()) if self.take("NOT", "!") else self.primary()

    def primary(self) -> Predicate:
        if sign := self.take("TRUE", "FALSE"):
            return Always(sign == "TRUE")
        if self.take("("):
            inner = self.either()
            if not self.take(")"):
                raise PredicateError("missing )")
            return inner
        kind, column = self.tokens[self.at]
        if kind != "column":
            raise PredicateError(f"expected a column, found {column!r}")
        self.at += 1
        if self.take("IS"):
            negated = bool(self.take("NOT"))
            if not self.take("NULL"):
                raise PredicateError("expected NULL after IS")
            return IsNull(column, negated)
        sign = self.take("=", "!=")
        if not sign:
            raise PredicateError(f"expected = or != or IS after {column}")
        return Equals(column, self.literal(), sign == "!=")

    def literal(self) -> object:
        kind, value = self.tokens[self.at]
        self.at += 1
        if kind == "literal":
            return value
        if kind == "sign" and value in ("TRUE", "FALSE", "NULL"):
            return {"TRUE": True, "FALSE": False, "NULL": None}[value]
        raise PredicateError(f"expected a literal, found {value!r}")


def parse(text: str, compat: bool = False) -> Predicate:
    """Read a predicate.

    By default anything that is not one is an error.  ``compat`` instead skips
    unknown characters, ignores what follows the expression, closes open texts
    at the end and reads integers beyond 64 bits as 0.
    """
    reader = _Reader(text, compat)
    found = reader.either()
    if not compat and reader.tokens[reader.at][0] != "end":
        raise PredicateError(f"unexpected {reader.tokens[reader.at][1]!r} after the predicate")
    return found


def columns_of(predicate: Predicate) -> set[str]:
    """The columns that a predicate names."""
    if isinstance(predicate, (Equals, IsNull)):
        return {predicate.column}
    if isinstance(predicate, Not):
        return columns_of(predicate.inner)
    if isinstance(predicate, (Both, Either)):
        return set().union(*map(columns_of, predicate.parts))
    return set()


def _kind(dtype: T.DataType) -> str:
    if isinstance(dtype, T.BooleanType):
        return "bool"
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "int"
    if isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        return "float"
    return "string" if isinstance(dtype, (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)) else "other"


def _close(column: Column, literal: float) -> Column:
    """Within the epsilon.  Doubles above 1 are further apart, so equality says it there, and is pushed down."""
    wide = column.cast("double")
    if abs(literal) > 1:
        return wide.eqNullSafe(F.lit(float(literal)))
    return F.coalesce(F.abs(wide - F.lit(float(literal))) < EPSILON, F.lit(False)) & ~F.coalesce(F.isnan(wide), F.lit(False))


def _matches(column: Column, dtype: T.DataType, literal: object) -> Column | bool:
    kind = _kind(dtype)
    if literal is None:
        return column.isNull()
    if isinstance(literal, bool):
        return column.eqNullSafe(F.lit(literal)) if kind == "bool" else False
    if isinstance(literal, int):
        if kind == "int":
            # a literal beyond the column's type would widen the column and stay above the scan
            widest = {T.ByteType: 7, T.ShortType: 15, T.IntegerType: 31, T.LongType: 63}[type(dtype)]
            return column.eqNullSafe(F.lit(literal).cast(dtype)) if -(2**widest) <= literal < 2**widest else False
        return _close(column, literal) if kind == "float" else False
    if isinstance(literal, float):
        return _close(column, literal) if kind in ("int", "float") else False
    return (column if isinstance(dtype, T.StringType) else column.cast("string")).eqNullSafe(F.lit(literal)) if kind == "string" else False


def compile(predicate: Predicate | str, schema: T.StructType, get: Callable[[str], Column] = F.col, missing: Column | None = None) -> Column:  # noqa: A001
    """A predicate as a column that is never null.

    ``get`` gives the column of a field; ``missing`` is the array of fields
    that a row does not carry, where rows can differ in that.
    """
    if isinstance(predicate, str):
        predicate = parse(predicate)
    types = {f.name: f.dataType for f in schema.fields}

    def there(name: str) -> Column | bool:
        return name in types and (True if missing is None else ~F.coalesce(F.array_contains(missing, name), F.lit(False)))

    def both(a: Column | bool, b: Column | bool) -> Column | bool:
        if a is False or b is False:
            return False
        return b if a is True else a if b is True else a & b

    def either(a: Column | bool, b: Column | bool) -> Column | bool:
        if a is True or b is True:
            return True
        return b if a is False else a if b is False else a | b

    def negated(a: Column | bool) -> Column | bool:
        return (not a) if isinstance(a, bool) else ~a

    def made(p: Predicate) -> Column | bool:
        if isinstance(p, Always):
            return p.value
        if isinstance(p, Equals):
            hit = both(there(p.column), _matches(get(p.column), types[p.column], p.literal)) if p.column in types else False
            return negated(hit) if p.negated else hit
        if isinstance(p, IsNull):
            empty = either(negated(there(p.column)), get(p.column).isNull()) if p.column in types else True
            return negated(empty) if p.negated else empty
        if isinstance(p, Not):
            return negated(made(p.inner))
        out = made(p.parts[0])
        for part in p.parts[1:]:
            out = (both if isinstance(p, Both) else either)(out, made(part))
        return out

    found = made(predicate)
    return F.lit(found) if isinstance(found, bool) else found


def compile_mixed(predicate: Predicate | str, row: Column) -> Column:
    """The same for rows of any relation, as maps of column name to JSON text.

    The kind of each value is found row by row: a column that is not in the
    map is missing, ``null`` is a null that is there.
    """
    if isinstance(predicate, str):
        predicate = parse(predicate)
    integer, number = r"^-?[0-9]+$", r"^-?[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?$"

    def equal(raw: Column, literal: object) -> Column:
        if literal is None:
            return raw == "null"
        if isinstance(literal, bool):
            return raw == ("true" if literal else "false")
        if isinstance(literal, str):
            return raw.startswith('"') & (F.get_json_object(F.concat(F.lit('{"v":'), raw, F.lit("}")), "$.v") == literal)
        close = raw.rlike(number) & (F.abs(raw.try_cast("double") - F.lit(float(literal))) < EPSILON)
        if isinstance(literal, int):
            return F.when(raw.rlike(integer), raw.try_cast("decimal(38,0)") == F.lit(literal)).otherwise(close)
        return close

    def made(p: Predicate) -> Column:
        if isinstance(p, Always):
            return F.lit(p.value)
        if isinstance(p, (Equals, IsNull)):
            raw = F.try_element_at(row, F.lit(p.column))
            hit = F.coalesce(equal(raw, p.literal), F.lit(False)) if isinstance(p, Equals) else raw.isNull() | (raw == "null")
            return ~hit if p.negated else hit
        if isinstance(p, Not):
            return ~made(p.inner)
        out = made(p.parts[0])
        for part in p.parts[1:]:
            out = out & made(part) if isinstance(p, Both) else out | made(part)
        return out

    return made(predicate)
