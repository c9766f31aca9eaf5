"""Change logs: events from tables, replay of written logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..model import event_schema

EVENT_COLUMNS = ("op", "schema", "table", "new", "old", "lsn", "seq", "txid", "missing")


def inserts(table: DataFrame, schema: str, name: str) -> DataFrame:
    """Every row of a table as an insert at lsn 0, the form that a backfill sees."""
    row = F.struct(*table.columns)
    return table.select(
        F.lit("insert").alias("op"), F.lit(schema).alias("schema"), F.lit(name).alias("table"), row.alias("new"), F.lit(None).cast(_row(table)).alias("old"),
        F.lit(0).cast("long").alias("lsn"), F.lit(0).alias("seq"), F.lit(None).cast("long").alias("txid"), F.array().cast("array<string>").alias("missing"),
    )


def _row(table: DataFrame) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in table.schema.fields])


def log_of_events(events: DataFrame, schema: str = "public", name: str = "users") -> DataFrame:
    """A change log from the ``events`` table: signup inserts, error deletes,
    the rest update; the key is the user; ten events are a transaction.

    Deletes carry the key only in their old image, as a server's default
    replica identity has it.
    """
    row = "struct<user_id:bigint,event_type:string,value:double,k:bigint>"
    full = F.struct("user_id", "event_type", "value", F.get_json_object("props", "$.k").try_cast("long").alias("k"))
    key = F.struct("user_id", F.lit(None).cast("string").alias("event_type"), F.lit(None).cast("double").alias("value"), F.lit(None).cast("long").alias("k"))
    op = F.when(F.col("event_type") == "signup", "insert").when(F.col("event_type") == "error", "delete").otherwise("update")
    gone = op == "delete"
    return events.select(
        op.alias("op"), F.lit(schema).alias("schema"), F.lit(name).alias("table"), F.when(~gone, full).cast(row).alias("new"), F.when(gone, key).cast(row).alias("old"),
        (F.col("event_id") + 1).alias("lsn"), (F.col("event_id") % 10).cast("int").alias("seq"), F.floor(F.col("event_id") / 10).alias("txid"), F.array().cast("array<string>").alias("missing"),
    )


def write_log(events: DataFrame, path: str, files: int = 1, form: str = "parquet") -> None:
    """A log as Parquet or JSON, whole transactions in a file, in partitions by relation."""
    events.repartitionByRange(files, "txid").sortWithinPartitions("lsn", "seq").write.partitionBy("schema", "table").mode("append").format(form).save(path)


def read_log(spark: SparkSession, path: str, row: T.StructType, stream: bool = False, max_files: int | None = None, form: str = "parquet") -> DataFrame:
    """A written log, whole or as a stream in which a file is never split."""
    reader = (spark.readStream if stream else spark.read).schema(event_schema(row)).format(form)
    if stream and max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path).select(*EVENT_COLUMNS)


#: A polled message: one transaction's changes.
POLLED = "xid long, change array<struct<kind:string,schema:string,table:string,columnnames:array<string>,columnvalues:array<variant>,oldkeys:struct<keynames:array<string>,keyvalues:array<variant>>>>"


def polled_events(messages: DataFrame) -> DataFrame:
    """Events of polled JSON messages (lsn, data), rows as maps of JSON values.

    The messages are what the server's JSON output plugin sends: one object
    per transaction with names and values of new rows and of old keys.
    """
    read = messages.select("lsn", F.from_json("data", POLLED).alias("m")).filter("m IS NOT NULL")
    rows = read.select("lsn", "m.xid", F.posexplode("m.change").alias("seq", "c"))

    def pairs(names: str, values: str):
        return F.map_from_arrays(F.col(names), F.transform(values, lambda v: F.coalesce(F.to_json(v), F.lit("null"))))

    return rows.filter(F.col("c.kind").isin("insert", "update", "delete")).select(
        F.col("c.kind").alias("op"), F.col("c.schema").alias("schema"), F.col("c.table").alias("table"), pairs("c.columnnames", "c.columnvalues").alias("new"),
        pairs("c.oldkeys.keynames", "c.oldkeys.keyvalues").alias("old"), F.col("lsn").cast("long").alias("lsn"), "seq", F.col("xid").alias("txid"), F.array().cast("array<string>").alias("missing"),
    )


def between(log: DataFrame, start: int | None = None, stop: int | None = None) -> DataFrame:
    """The events after lsn ``start`` up to ``stop``."""
    if start is not None:
        log = log.filter(F.col("lsn") > start)
    return log if stop is None else log.filter(F.col("lsn") <= stop)
