"""Net change of a log and versioned merge into a stored namespace."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Columns of a stored namespace.  A deleted document stays as a tombstone, so
#: that an older upsert that comes late does not bring it back.
STORED = "namespace string, id_kind string, id string, version long, deleted boolean, doc string, distance_metric string"

#: A position in the log.
PLACE = "struct<lsn:long,seq:int>"

#: The same with when a row was stored, whether its version counts, and for
#: versions taken from a column where the log had the row (``place``) and the
#: last delete before it (``epoch``); both are null for versions by lsn.
ARRIVED = STORED + f", arrived long, versioned boolean, place {PLACE}, epoch {PLACE}"


def net_change(actions: DataFrame) -> DataFrame:
    """The last action of each document, by (lsn, seq): a partial aggregate
    keyed by (namespace, id), so arrival order does not matter and a document
    with many changes sends one row per task."""
    row = F.struct("type", "id", "doc", "distance_metric", "lsn", "seq", "txid", "mapping")
    last = actions.groupBy("namespace", F.col("id.kind").alias("_k"), F.col("id.text").alias("_t")).agg(F.max_by(row, F.struct("lsn", "seq")).alias("_last"))
    return last.select("namespace", "_last.*")


def net_change_by_version(actions: DataFrame) -> DataFrame:
    """The same where a column gives the versions (``version`` of ``actions``).

    Deletes count in the order of the log whatever the version of what they
    delete; of the upserts behind the last delete of a document the highest
    version stays, of equal ones the first.  ``epoch`` is the place of that
    delete.
    """
    keys = ["namespace", "_k", "_t"]
    place = F.struct(F.col("lsn").cast("long").alias("lsn"), F.col("seq").cast("int").alias("seq"))
    rows = actions.withColumns({"_k": F.col("id.kind"), "_t": F.col("id.text"), "place": place})
    row = F.struct("type", "id", "doc", "distance_metric", "lsn", "seq", "txid", "mapping", "version", "place")
    gone = rows.filter("type = 'delete'").groupBy(*keys).agg(F.max_by(row, "place").alias("_last"))
    epochs = gone.select(*keys, F.col("_last.place").alias("epoch"))
    behind = rows.filter("type = 'upsert'").join(epochs, keys, "left").filter("epoch IS NULL OR place > epoch")
    best = behind.groupBy(*keys).agg(F.max_by(row, F.struct("version", -F.col("lsn"), -F.col("seq"))).alias("_last"), F.max("epoch").alias("epoch"))
    alone = gone.join(best.select(*keys), keys, "left_anti").select(*keys, "_last", F.col("_last.place").alias("epoch"))
    never = F.struct(F.lit(-1).cast("long").alias("lsn"), F.lit(0).alias("seq"))
    return best.unionByName(alone).select("namespace", "_last.*", F.coalesce("epoch", never).alias("epoch"))


def as_stored(changes: DataFrame, version: str = "lsn") -> DataFrame:
    return changes.select(
        "namespace", F.col("id.kind").alias("id_kind"), F.col("id.text").alias("id"), F.col(version).cast("long").alias("version"),
        (F.col("type") == "delete").alias("deleted"), "doc", "distance_metric", *[c for c in ("place", "epoch") if c in changes.columns],
    )


def merge(stored: DataFrame, incoming: DataFrame, versioned: bool = True, preserve_missing: bool = False) -> DataFrame:
    """``stored`` after ``incoming`` (both in the stored form).

    With versions an incoming row replaces a stored one only if it is strictly
    newer; without, always.  ``preserve_missing`` keeps attributes of the
    stored document that the newer one does not have.  One aggregate instead
    of a full join: union, then the best row of each document.
    """
    both = stored.select("*", F.lit(0).alias("_new")).unionByName(incoming.select("*", F.lit(1).alias("_new")))
    order = F.struct("version", -F.col("_new")) if versioned else F.struct("_new", "version")
    row = F.struct("version", "deleted", "doc", "distance_metric", "_new")
    parts = [F.max_by(row, order).alias("_best")]
    if preserve_missing:
        parts.append(F.max(F.when((F.col("_new") == 0) & ~F.col("deleted"), F.col("doc"))).alias("_before"))
    out = both.groupBy("namespace", "id_kind", "id").agg(*parts)
    doc = F.col("_best.doc")
    if preserve_missing:
        pairs = lambda c: F.from_json(c, "map<string,string>")
        merged = F.to_json(F.map_concat(F.map_filter(pairs(F.col("_before")), lambda k, _: ~F.map_contains_key(pairs(doc), k)), pairs(doc)))
        doc = F.when((F.col("_best._new") == 1) & ~F.col("_best.deleted") & F.col("_before").isNotNull(), merged).otherwise(doc)
    return out.select("namespace", "id_kind", "id", "_best.version", "_best.deleted", doc.alias("doc"), "_best.distance_metric")


def best(rows: DataFrame, epochs: bool = False) -> DataFrame:
    """The row that counts of each document, of all that were stored.

    With versions the newest, and of equal versions the one stored first;
    a row stored without versions replaces all that were there before.  With
    ``epochs`` (versions from a column) rows that lie before the last delete of
    their document don't count, and a delete counts if nothing lies behind it.
    """
    keys = ["namespace", "id_kind", "id"]
    order = F.struct(
        F.when(F.col("versioned"), F.col("version")).otherwise(F.lit(2**63 - 1)).alias("v"), F.when(F.col("versioned"), -F.col("arrived")).otherwise(F.col("arrived")).alias("a")
    )
    if epochs:
        last = F.max("epoch").over(Window.partitionBy(*keys))  # a document has a row in each folder at most
        rows = rows.withColumn("_last", last).filter("epoch IS NULL OR epoch = _last OR place > _last").drop("_last")
        # a tombstone of this kind gives way to any row that counts besides it
        order = F.struct((~F.col("deleted") | F.col("epoch").isNull()).alias("there"), *[order[c].alias(c) for c in ("v", "a")])
    names = ["version", "deleted", "doc", "distance_metric", "arrived", "versioned", "place"]
    found = rows.groupBy(*keys).agg(F.max_by(F.struct(*names), order).alias("b"), F.max("epoch").alias("epoch"))
    return found.select(*keys, *[f"b.{c}" for c in names], "epoch")


def exit_deletes(events: DataFrame, was: str, now: str) -> DataFrame:
    """Extension: deletes for updates whose old image belonged and whose new one does not."""
    left = (F.col("op") == "update") & F.expr(was) & ~F.expr(now)
    return events.filter(left).withColumn("op", F.lit("delete"))


def live(stored: DataFrame) -> DataFrame:
    return stored.filter(~F.col("deleted"))
