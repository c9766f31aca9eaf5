"""State tables: checkpoints, migrations, failed events, backfills, transforms.

Each table is a folder of Parquet snapshots; a change reads the latest, writes
the next and then names it in one small file, so a reader sees the old or the
new state, never a part.  State is small (rows per mapping), except failed
events, which are appended to a folder of their own.
"""

from __future__ import annotations

import time
import uuid
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import ERROR_KINDS

SCHEMAS = {
    "migrations": "version int, mapping_name string, content_hash string, applied_at timestamp",
    "checkpoints": "mapping_name string, lsn long, events_processed long, updated_at timestamp",
    "dlq": "id string, mapping_name string, lsn long, event_json string, error_message string, error_kind string, retry_count int, created_at timestamp",
    "backfill": "mapping_name string, last_id string, total_rows long, processed_rows long, status string, updated_at timestamp",
    "transforms": "mapping_name string, version int, content string, content_hash string, created_at timestamp",
    "migration_content": "version int, mapping_name string, content string, created_at timestamp",
}
KEYS = {"migrations": ["version", "mapping_name"], "checkpoints": ["mapping_name"], "dlq": ["id"], "backfill": ["mapping_name"], "transforms": ["mapping_name", "version"], "migration_content": ["version", "mapping_name"]}


def error_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(ERROR_KINDS), "error_kind string, description string, retryable boolean")


def with_error_facts(entries: DataFrame) -> DataFrame:
    """Entries with the description of their error kind and whether a retry may help; an unknown kind is ``unknown``."""
    known = F.broadcast(error_table(entries.sparkSession))  # eleven rows
    kind = F.when(F.col("error_kind").isin(*[k for k, _, _ in ERROR_KINDS]), F.col("error_kind")).otherwise("unknown")
    return entries.withColumn("error_kind", kind).join(known, "error_kind")


def newest(entries: DataFrame, limit: int) -> DataFrame:
    """The newest failed events."""
    return entries.orderBy(F.col("created_at").desc(), "id").limit(limit)


def min_checkpoint(checkpoints: DataFrame) -> DataFrame:
    """The position from which all mappings can restart."""
    return checkpoints.agg(F.min("lsn").alias("lsn"))


class State:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path

    # files

    def _fs(self, path: str):
        p = self._path(path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _current(self, table: str) -> str | None:
        p, fs = self._fs(f"{self.root}/{table}")
        if not fs.exists(p):
            return None
        names = sorted(x.getPath().getName() for x in fs.listStatus(p))
        done = [n for n in names if n.endswith(".done")]
        return f"{self.root}/{table}/{done[-1].removesuffix('.done')}" if done else None

    def _read(self, table: str) -> DataFrame:
        at = self._current(table)
        return self.spark.read.schema(SCHEMAS[table]).parquet(at) if at else self.spark.createDataFrame([], SCHEMAS[table])

    def _replace(self, table: str, rows: DataFrame) -> None:
        old = self._current(table)
        name = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        rows.coalesce(1).write.parquet(f"{self.root}/{table}/{name}")
        p, fs = self._fs(f"{self.root}/{table}/{name}.done")
        fs.create(p).close()
        if old:
            for x in (f"{old}.done", old):
                p, fs = self._fs(x)
                fs.delete(p, True)

    def _put(self, table: str, rows: list[tuple], keep_existing: bool = False) -> None:
        """Insert rows, replacing those with the same key or leaving them."""
        new = self.spark.createDataFrame(rows, SCHEMAS[table])
        old = self._read(table)
        if keep_existing:
            self._replace(table, old.unionByName(new.join(old, KEYS[table], "left_anti").select(*new.columns)))
        else:
            self._replace(table, old.join(new, KEYS[table], "left_anti").select(*new.columns).unionByName(new))

    def _remove(self, table: str, which) -> int:
        old = self._read(table)
        n = old.filter(which).count()
        if n:
            self._replace(table, old.filter(~which))
        return n

    @staticmethod
    def _now() -> datetime:
        return datetime.now(UTC).replace(tzinfo=None)

    # checkpoints

    def checkpoint(self, mapping: str) -> tuple[int, int] | None:
        row = self._read("checkpoints").filter(F.col("mapping_name") == mapping).first()
        return (row.lsn, row.events_processed) if row else None

    def save_checkpoints(self, rows: dict[str, tuple[int, int]]) -> None:
        """lsn and number of events by mapping, in one step."""
        if rows:
            self._put("checkpoints", [(m, lsn, n, self._now()) for m, (lsn, n) in rows.items()])

    def checkpoints(self) -> DataFrame:
        return self._read("checkpoints").orderBy("mapping_name")

    def min_lsn(self) -> int | None:
        return min_checkpoint(self._read("checkpoints")).first().lsn

    def clear_checkpoints(self) -> int:
        return self._remove("checkpoints", F.lit(True))

    # migrations

    def migrations(self) -> DataFrame:
        return self._read("migrations").orderBy("version", "mapping_name")

    def migration(self, version: int, mapping: str):
        return self._read("migrations").filter((F.col("version") == version) & (F.col("mapping_name") == mapping)).first()

    def record_migration(self, version: int, mapping: str, content_hash: str) -> None:
        self._put("migrations", [(version, mapping, content_hash, self._now())])

    def store_migration_content(self, version: int, mapping: str, content: str) -> None:
        self._put("migration_content", [(version, mapping, content, self._now())], keep_existing=True)

    def migration_content(self) -> DataFrame:
        return self._read("migration_content").orderBy("version", "mapping_name")

    # transforms

    def store_transform(self, mapping: str, version: int, content: str, content_hash: str) -> None:
        self._put("transforms", [(mapping, version, content, content_hash, self._now())], keep_existing=True)

    def transforms(self) -> DataFrame:
        return self._read("transforms").orderBy("mapping_name", "version")

    def transform(self, mapping: str, version: int):
        return self._read("transforms").filter((F.col("version") == version) & (F.col("mapping_name") == mapping)).first()

    # backfills

    def backfill(self, mapping: str):
        return self._read("backfill").filter(F.col("mapping_name") == mapping).first()

    def save_backfill(self, mapping: str, last_id: str | None, total: int | None, processed: int, status: str) -> None:
        self._put("backfill", [(mapping, last_id, total, processed, status, self._now())])

    def clear_backfill(self, mapping: str) -> int:
        return self._remove("backfill", F.col("mapping_name") == mapping)

    # failed events

    def add_failures(self, failed: DataFrame) -> None:
        """Append (mapping_name, lsn, event_json, error_message, error_kind); any number of rows."""
        rows = failed.select(
            F.expr("uuid()").alias("id"), "mapping_name", F.col("lsn").cast("long"), "event_json", "error_message", "error_kind", F.lit(0).alias("retry_count"), F.current_timestamp().alias("created_at")
        )
        rows.write.mode("append").parquet(f"{self.root}/dlq_new/{time.time_ns():020d}")
        p, fs = self._fs(f"{self.root}/dlq_new")
        parts = sorted(x.getPath().toString() for x in fs.listStatus(p))
        both = self._read("dlq").unionByName(self.spark.read.schema(SCHEMAS["dlq"]).parquet(*parts)).dropDuplicates(["id"])
        self._replace("dlq", both)
        fs.delete(p, True)

    def failures(self, mapping: str | None = None, limit: int = 50) -> DataFrame:
        """Newest first."""
        rows = self._read("dlq")
        if mapping is not None:
            rows = rows.filter(F.col("mapping_name") == mapping)
        return newest(rows, limit)

    def all_failures(self) -> DataFrame:
        return self._read("dlq")

    def failure(self, key: str):
        return self._read("dlq").filter(F.col("id") == key).first()

    def count_retryable(self, mapping: str | None = None) -> int:
        rows = self._read("dlq") if mapping is None else self._read("dlq").filter(F.col("mapping_name") == mapping)
        return with_error_facts(rows).agg(F.count_if("retryable").alias("n")).first().n

    def mark_retried(self, keys: list[str]) -> None:
        rows = self._read("dlq")
        self._replace("dlq", rows.withColumn("retry_count", F.col("retry_count") + F.col("id").isin(*keys).cast("int")))

    def delete_failures(self, keys: list[str]) -> int:
        return self._remove("dlq", F.col("id").isin(*keys))

    def settle_failures(self, outcome: DataFrame) -> int:
        """Of the ids of a table those ``done`` go, the others count a retry; how many went."""
        old = self._read("dlq")
        marked = old.join(outcome.select("id", F.col("done").alias("_done")), "id", "left").persist()
        try:
            gone = marked.filter("_done").count()
            left = marked.filter("NOT coalesce(_done, false)").withColumn("retry_count", F.col("retry_count") + F.col("_done").isNotNull().cast("int"))
            self._replace("dlq", left.select(*old.columns))
            return gone
        finally:
            marked.unpersist()

    def clear_failures(self, mapping: str | None = None) -> int:
        return self._remove("dlq", F.lit(True) if mapping is None else F.col("mapping_name") == mapping)
