"""Routing: which events belong to which mappings.

Updates and inserts are judged by the new image, deletes by the old one, which
may hold the key columns only; a row that leaves a predicate yields nothing.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..model import Mapping
from . import predicate


def image(events: DataFrame) -> Column:
    """The row image that counts: the old one of a delete, else the new one."""
    return F.when(F.col("op") == "delete", F.col("old")).otherwise(F.col("new"))


def source_matches(mapping: Mapping) -> Column:
    return (F.col("schema") == mapping.schema) & (F.col("table") == mapping.table)


def belongs(mapping: Mapping, events: DataFrame, get: str | None = None) -> Column:
    """Whether an event's image is a member; without an image it is not.

    The predicate is written once per image, so that each form names plain
    fields and can reach the scan.
    """
    if mapping.membership.mode != "dsl":
        return F.lit(True)
    row: T.StructType = events.schema["new"].dataType
    missing = F.col("missing") if "missing" in events.columns else None
    parsed = predicate.parse(mapping.membership.predicate)

    def on(side: str) -> Column:
        return F.col(side).isNotNull() & predicate.compile(parsed, row, lambda c: F.col(f"{side}.`{c}`"), missing)

    return ((F.col("op") != "delete") & on("new")) | ((F.col("op") == "delete") & on("old"))


def matches(mapping: Mapping, events: DataFrame) -> Column:
    return source_matches(mapping) & belongs(mapping, events)


def route(events: DataFrame, mappings: Iterable[Mapping]) -> DataFrame:
    """Every event once for each mapping that it matches, with ``mapping`` and
    ``namespace``, in one pass over the events.

    A first filter says that some mapping matches; it can be pushed down,
    which conditions inside the array that is unfolded can not.
    """
    mappings = list(mappings)
    if not mappings:
        return events.withColumn("mapping", F.lit("")).withColumn("namespace", F.lit("")).limit(0)
    tests = [matches(m, events) for m in mappings]
    if len(mappings) == 1:
        return events.filter(tests[0]).withColumn("mapping", F.lit(mappings[0].name)).withColumn("namespace", F.lit(mappings[0].namespace))
    some = tests[0]
    for t in tests[1:]:
        some = some | t
    target = lambda m: F.struct(F.lit(m.name).alias("mapping"), F.lit(m.namespace).alias("namespace"))
    hits = F.filter(F.array(*[F.when(t, target(m)) for t, m in zip(tests, mappings, strict=True)]), lambda x: x.isNotNull())
    return events.filter(some).select("*", F.explode(hits).alias("_hit")).select(*events.columns, "_hit.mapping", "_hit.namespace")


def lookup_members(events: DataFrame, mapping: Mapping, current: DataFrame, key: str) -> DataFrame:
    """Lookup membership: events whose row is now in a relation that holds the
    members (a view or a filtered table), joined by key."""
    value = F.coalesce(F.col(f"new.`{key}`"), F.col(f"old.`{key}`"))
    return events.filter(source_matches(mapping)).withColumn("_key", value).join(current.select(F.col(key).alias("_key")).distinct(), "_key", "left_semi").drop("_key")
