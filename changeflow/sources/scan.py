"""Table scans for backfills: keyset pages, resuming, estimates, progress."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import duration_of
from ..functions.values import cursor
from ..model import Mapping
from . import changelog

#: The frames of the progress line.
FRAMES = "⠋⠙⠹⠸⠼⠴⠦⠧⠇⠏"


class RelationError(ValueError):
    """A relation that is not there or can't be read."""


def needed_columns(mapping: Mapping, table: DataFrame) -> list[str]:
    """The columns that a backfill reads: all for a custom transform or without
    a list, else the mapping's with the id first if it is not among them."""
    if mapping.transform.custom or not mapping.columns:
        return table.columns
    wanted = list(mapping.columns)
    if mapping.id_column not in wanted:
        wanted.insert(0, mapping.id_column)
    return [c for c in wanted if c in table.columns]


def scan(table: DataFrame, mapping: Mapping, after=None) -> DataFrame:
    """Insert events of a table's rows, those with an id above ``after`` only.

    One distributed scan: ids are compared in their own type, so resuming
    neither repeats nor skips rows, and the comparison reaches the source.
    """
    if after is not None:
        table = table.filter(F.col(mapping.id_column) > F.lit(after).cast(table.schema[mapping.id_column].dataType))
    return changelog.inserts(table.select(*needed_columns(mapping, table)), mapping.schema, mapping.table)


def page(table: DataFrame, key: str | list[str], after=None, size: int = 1000) -> DataFrame:
    """The next ``size`` rows by key.

    A key of several columns is compared column by column; ``after`` is then a
    list of as many values, or of the first few: rows above all that begin so.
    """
    keys, values = ([key], [after]) if isinstance(key, str) else (key, list(after or []))
    if after is not None:
        least = [F.lit(x).cast(table.schema[k].dataType) for k, x in zip(keys, values)]
        above, equal = F.lit(False), F.lit(True)
        for k, x in zip(keys, least):
            above, equal = above | (equal & (F.col(k) > x)), equal & (F.col(k) == x)
        # the first column's bound alone reaches the source
        table = table.filter(F.col(keys[0]) >= least[0]).filter(above) if len(least) > 1 else table.filter(F.col(keys[0]) > least[0])
    return table.orderBy(*keys).limit(size)


def last_cursor(rows: DataFrame, key: str) -> str | None:
    """The cursor text of the largest key of some rows."""
    found = rows.agg(F.max(key).alias(key)).select(F.when(F.col(key).isNotNull(), cursor(F.col(key), rows.schema[key].dataType))).first()
    return found[0]


def cursor_of(spark: SparkSession, value, dtype) -> str | None:
    """The cursor text of a key."""
    if value is None:
        return None
    return spark.range(1).select(cursor(F.lit(value).cast(dtype), dtype)).first()[0]


def id_ranges(table: DataFrame, key: str, parts: int, batch_size: int | None = None, rows: int | None = None) -> list[tuple[object, object]]:
    """Bounds (above, up to) that cut a table into about equal parts by key,
    as many as asked for or as hold ``batch_size`` of ``rows`` rows; a backfill
    that records them resumes by part."""
    if batch_size:
        parts = max(parts, -(-(rows or 0) // batch_size))
    if parts < 2:
        return [(None, None)]
    dtype = table.schema[key].dataType
    if dtype.typeName() in ("byte", "short", "integer", "long"):
        low, high = table.agg(F.min(key), F.max(key)).first()
        if low is None:
            return [(None, None)]
        step = -(-(high - low + 1) // parts)
        cuts = [low - 1 + step * i for i in range(1, parts)]
    else:
        ranges = table.select(key).filter(F.col(key).isNotNull()).repartitionByRange(parts, key).groupBy(F.spark_partition_id().alias("part"))
        cuts = sorted(r[0] for r in ranges.agg(F.max(key).alias("m")).select("m").collect())[:-1]
    return list(zip([None, *cuts], [*cuts, None], strict=True))


def estimate(table: DataFrame, counted: int | None = None) -> int | None:
    """The number of rows, from statistics if given or known to the optimizer, else counted; not positive is unknown."""
    n = counted
    if n is None:
        known = table._jdf.queryExecution().optimizedPlan().stats().rowCount()  # of tables that were analysed, and ranges
        n = int(known.get().toString()) if known.isDefined() else table.count()
    return n if n > 0 else None


def exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def readable(spark: SparkSession, name: str) -> bool:
    try:
        spark.table(name).limit(0).collect()
    except Exception:  # any reason that a source gives
        return False
    return True


def validate(spark: SparkSession, names: list[str]) -> None:
    """All relations must be there and readable; the error names each that is not."""
    bad = [f"{n}: {'not readable' if exists(spark, n) else 'not found'}" for n in names if not (exists(spark, n) and readable(spark, n))]
    if bad:
        raise RelationError("; ".join(bad))


def sample_ids(table: DataFrame, column: str, size: int = 5) -> DataFrame:
    """Up to ``size`` values of an id column as texts, without nulls."""
    return table.select(F.col(column).cast("string").alias("value")).limit(size).filter("value IS NOT NULL")


@dataclass(frozen=True)
class Progress:
    """How far a backfill has come."""

    processed: int
    upserted: int
    seconds: float
    total: int | None = None
    last_id: str | None = None

    @property
    def rows_per_second(self) -> float:
        return self.processed / self.seconds if self.seconds > 0 else 0.0

    @property
    def upserts_per_second(self) -> float:
        return self.upserted / self.seconds if self.seconds > 0 else 0.0

    @property
    def percent(self) -> float:
        return 100.0 * self.processed / self.total if self.total and self.total > 0 else 0.0

    @property
    def eta(self) -> float | None:
        if self.total is None or self.rows_per_second <= 0:
            return None
        return max(self.total - self.processed, 0) / self.rows_per_second

    @property
    def complete(self) -> bool:
        return self.total is not None and self.processed >= self.total

    def line(self, frame: int = 0) -> str:
        head = f"{FRAMES[frame % len(FRAMES)]} " + (f"[{self.percent:>5.1f}%] {self.processed}/{self.total}" if self.total is not None else f"{self.processed}")
        times = duration_of(self.seconds) + (f" ETA {duration_of(self.eta)}" if self.eta is not None else "")
        return f"{head} read | {self.upserted} upserted ({self.rows_per_second:.0f} read/s, {self.upserts_per_second:.0f} upsert/s) [{times}]"


def started() -> float:
    return time.monotonic()
