"""Batches: packing under limits, write requests, upload chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..model import Batching

#: Bytes that count for a delete, for an error besides its message, and for a document that is no JSON.
DELETE_BYTES, ERROR_BYTES, UNKNOWN_BYTES = 50, 50, 100


def action_size(kind: Column, doc: Column, message: Column | None = None) -> Column:
    """Estimated bytes of an action: the JSON of its document."""
    message = F.lit("") if message is None else F.coalesce(message, F.lit(""))
    return (
        F.when(kind == "upsert", F.coalesce(F.octet_length(doc), F.lit(UNKNOWN_BYTES)))
        .when(kind == "delete", F.lit(DELETE_BYTES))
        .when(kind == "error", F.octet_length(message) + ERROR_BYTES)
        .otherwise(F.lit(0))
        .cast("long")
    )


def pack_rows(rows: DataFrame, group: list[str], order: list[str], max_rows: int) -> DataFrame:
    """``batch``: from 0, up to ``max_rows`` rows of a group each, in order."""
    place = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return rows.withColumn("batch", F.floor((place - 1) / max_rows).cast("long"))


def pack(rows: DataFrame, group: list[str], order: list[str], size: Column, limits: Batching = Batching()) -> DataFrame:
    """``batch``: greedy packing under both limits, by an expression for the size.

    A batch is closed before a row that would exceed either limit; a row that
    is too large alone has a batch of its own.
    """
    return pack_groups(rows.withColumn("_size", size.cast("long")), group, order, "_size", limits).drop("_size")


def pack_groups(rows: DataFrame, group: list[str], order: list[str], size_column: str, limits: Batching = Batching()) -> DataFrame:
    """The same by a column of sizes, for groups of any size: greedy cuts
    depend on all rows before, so rows stream through in order, and the state
    is three numbers.  Groups are spread by key and sorted on disk."""
    from pyspark.sql import types as T

    spec = T.StructType([*rows.schema.fields, T.StructField("batch", T.LongType())])

    def run(batches):
        import pyarrow as pa

        key, batch, n, total = None, 0, 0, 0
        for part in batches:
            out = []
            for *k, s in zip(*[part.column(c).to_pylist() for c in [*group, size_column]], strict=True):
                s = s or 0
                if k != key:
                    key, batch, n, total = k, 0, 0, 0
                elif n >= limits.max_rows or total + s > limits.max_bytes:
                    batch, n, total = batch + 1, 0, 0
                n, total = n + 1, total + s
                out.append(batch)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.int64())], names=spec.names)

    return rows.repartition(*group).sortWithinPartitions(*group, *order).mapInArrow(run, spec)


def requests(actions: DataFrame, group: list[str] = ["namespace", "txid", "batch"]) -> DataFrame:  # noqa: B006
    """One write request per batch: upserts and deletes apart and in order,
    the lsn of the batch's first action, the first distance metric that is set."""
    place = F.struct("lsn", "seq")
    up, down = F.col("type") == "upsert", F.col("type") == "delete"
    metric = F.when(up & F.col("distance_metric").isNotNull(), place)
    return actions.groupBy(*group).agg(
        F.array_sort(F.collect_list(F.when(up, F.struct("lsn", "seq", F.col("id.text").alias("id"), "doc")))).alias("upserts"),
        F.array_sort(F.collect_list(F.when(down, F.struct("lsn", "seq", F.col("id.text").alias("id"))))).alias("deletes"),
        F.min("lsn").alias("lsn"),
        F.min_by("distance_metric", metric).alias("distance_metric"),
    )


def request_counts(actions: DataFrame, group: list[str] = ["namespace", "txid", "batch"]) -> DataFrame:  # noqa: B006
    """Sizes of the requests without gathering their documents."""
    return actions.groupBy(*group).agg(
        F.count_if(F.col("type") == "upsert").alias("n_upserts"), F.count_if(F.col("type") == "delete").alias("n_deletes"), F.min("lsn").alias("lsn"),
        F.min_by("distance_metric", F.when((F.col("type") == "upsert") & F.col("distance_metric").isNotNull(), F.struct("lsn", "seq"))).alias("distance_metric"),
    )


def chunks(actions: DataFrame, group: list[str], upload_rows: int) -> DataFrame:
    """``chunk``: upserts of a batch in parts of ``upload_rows``; all deletes go with the first part."""
    kind = F.when(F.col("type") == "delete", 1).otherwise(0)
    place = F.row_number().over(Window.partitionBy(*group, kind).orderBy("lsn", "seq"))
    return actions.withColumn("chunk", F.when(F.col("type") == "delete", F.lit(0)).otherwise(F.floor((place - 1) / upload_rows)).cast("long"))


def stamped(doc: Column, identity: Column, lsn: Column | None) -> Column:
    """The stored attributes: the document's, ``id`` over them, and where it came from.

    Documents of the log carry ``__source_lsn``, the lsn of their batch; those
    of a backfill ``__backfill``.
    """
    number = identity["number"]
    id_json = F.when(number.isNotNull(), number.cast("string")).otherwise(F.to_json(F.struct(identity["text"].alias("id"))).substr(F.lit(7), F.length(F.to_json(F.struct(identity["text"].alias("id")))) - 7))
    mark = F.concat(F.lit('"__source_lsn":'), lsn.cast("string")) if lsn is not None else F.lit('"__backfill":true')
    fields = F.map_filter(F.from_json(doc, "map<string,variant>"), lambda k, _: ~k.isin("id", "__source_lsn", "__backfill"))
    rest = F.array_join(F.transform(F.map_entries(fields), lambda e: F.concat(_quoted(e["key"]), F.lit(":"), F.coalesce(F.to_json(e["value"]), F.lit("null")))), ",")
    return F.concat(F.lit("{"), F.when(rest != "", F.concat(rest, F.lit(","))).otherwise(""), F.lit('"id":'), id_json, F.lit(","), mark, F.lit("}"))


def _quoted(text: Column) -> Column:
    whole = F.to_json(F.array(text))
    return whole.substr(F.lit(2), F.length(whole) - 2)
