"""The predicate compiler against a row-at-a-time evaluator, and the parser."""

import math
import random

import pytest
from pyspark.sql import Row
from pyspark.sql import types as T

from changeflow.operators import predicate as p

from .helpers import struct

SCHEMA = struct("_n int, a long, b int, f double, s string, t boolean, x array<int>")
LITERALS = [0, 1, 2, -3, 10**12, 0.0, 1.0, 0.3, 2.5, 1e-17, "", "x", "it", "1", True, False, None]


def equal(value, literal):
    """One comparison, for a value that is there."""
    if literal is None:
        return value is None
    if value is None or isinstance(value, list):
        return False
    if isinstance(value, bool) or isinstance(literal, bool):
        return isinstance(value, bool) and isinstance(literal, bool) and value == literal
    if isinstance(value, str) or isinstance(literal, str):
        return isinstance(value, str) and isinstance(literal, str) and value == literal
    if isinstance(value, int) and isinstance(literal, int):
        return value == literal
    return abs(float(value) - float(literal)) < p.EPSILON


def evaluate(node, row, missing):
    if isinstance(node, p.Always):
        return node.value
    if isinstance(node, (p.Both, p.Either)):
        return (all if isinstance(node, p.Both) else any)(evaluate(x, row, missing) for x in node.parts)
    if isinstance(node, p.Not):
        return not evaluate(node.inner, row, missing)
    there = node.column in row and node.column not in missing
    if isinstance(node, p.IsNull):
        return (not there or row[node.column] is None) != node.negated
    return (there and equal(row[node.column], node.literal)) != node.negated


def tree(draw, depth):
    kind = draw.random()
    if depth and kind < 0.5:
        if kind < 0.15:
            return p.Not(tree(draw, depth - 1))
        return (p.Both if kind < 0.32 else p.Either)(tuple(tree(draw, depth - 1) for _ in range(draw.choice((2, 3)))))
    column = draw.choice(["a", "b", "f", "s", "t", "x", "nothing"])
    if kind < 0.55:
        return p.Always(draw.random() < 0.5)
    return p.IsNull(column, draw.random() < 0.5) if kind < 0.65 else p.Equals(column, draw.choice(LITERALS), draw.random() < 0.5)


def test_compiled_equals_evaluated(spark):
    draw = random.Random(5)
    pick = lambda *v: draw.choice([*v, None])
    rows = [
        dict(_n=i, a=pick(0, 1, -3, 10**12), b=pick(0, 1, 2), f=pick(0.0, 1.0, 0.1 + 0.2, 2.5, math.nan, math.inf, 1e-17), s=pick("", "x", "it", "1"), t=pick(True, False), x=pick([1], []))
        for i in range(60)
    ]
    gone = [[] if draw.random() < 0.7 else [draw.choice("abfst")] for _ in rows]
    from pyspark.sql import functions as F

    schema = T.StructType([*SCHEMA.fields, T.StructField("missing", T.ArrayType(T.StringType()))])
    df = spark.createDataFrame([Row(**r, missing=g) for r, g in zip(rows, gone, strict=True)], schema)
    trees = [tree(draw, 3) for _ in range(150)]
    out = df.select("_n", *[p.compile(t, SCHEMA, missing=F.col("missing")).alias(f"p{i}") for i, t in enumerate(trees)]).collect()
    for r in out:
        for i, t in enumerate(trees):
            assert r[f"p{i}"] is evaluate(t, rows[r._n], gone[r._n]), (t, rows[r._n], gone[r._n])


@pytest.mark.parametrize(
    "text", ["a >= 1", "a = 1 b = 2", "a = 1e5", "a = 'it''s'", "a = 99999999999999999999", "a = 'open", "a =", "(a = 1", "a", "", "a IS 1", "a LIKE 'x'", "a = b"]
)
def test_rejected(text):
    with pytest.raises(p.PredicateError):
        p.parse(text)


@pytest.mark.parametrize(
    ("text", "found"),
    [("a >= 1", p.Equals("a", 1)), ("a = 1 b = 2", p.Equals("a", 1)), ("a = 1e5", p.Equals("a", 1)), ("a = 'it''s'", p.Equals("a", "it")), ("a = 99999999999999999999", p.Equals("a", 0)), ("a = 'open", p.Equals("a", "open"))],
)
def test_lenient(text, found):
    assert p.parse(text, compat=True) == found


def test_precedence():
    a, b, c = p.Equals("a", 1), p.Equals("b", 2), p.Equals("c", 4)
    assert p.parse("a = 1 OR b = 2 AND c = 4") == p.Either((a, p.Both((b, c))))
    assert p.parse("(a = 1 or b = 2) and not !c = 4") == p.Both((p.Either((a, b)), p.Not(p.Not(c))))
    assert p.parse("a is not null AND b != -2.5 AND true") == p.Both((p.IsNull("a", True), p.Equals("b", -2.5, True), p.Always(True)))
    assert p.columns_of(p.parse("a = 1 OR NOT b IS NULL")) == {"a", "b"}


def test_reaches_the_scan(spark, data):
    rows = spark.read.parquet(f"{data}/orders.parquet")
    kept = rows.filter(p.compile("o_orderstatus = 'O' AND o_custkey != 7", rows.schema)).select("o_orderkey")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "EqualNullSafe(o_orderstatus,O)" in plan and "Not(EqualNullSafe(o_custkey,7))" in plan
    assert "o_totalprice" not in plan.split("ReadSchema")[1]


def test_mixed_rows_equal_evaluated(spark):
    """Rows of any relation: the kind of a value is found row by row."""
    import json

    from pyspark.sql import functions as F

    draw = random.Random(8)
    options = [0, 1, -3, 10**12, 0.0, 1.0, 0.1 + 0.2, 2.5, "", "x", "it", "1", 'q"', True, False, None]
    rows = [{c: draw.choice(options) for c in draw.sample("abfst", draw.randrange(6))} for _ in range(80)]
    df = spark.createDataFrame([(i, {k: json.dumps(v) for k, v in r.items()}) for i, r in enumerate(rows)], "_n int, m map<string,string>")
    trees = [tree(draw, 2) for _ in range(80)]
    for r in df.select("_n", *[p.compile_mixed(t, F.col("m")).alias(f"p{i}") for i, t in enumerate(trees)]).collect():
        for i, t in enumerate(trees):
            assert r[f"p{i}"] is evaluate(t, rows[r._n], []), (t, rows[r._n])
