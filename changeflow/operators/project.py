"""Identity transforms: events become actions whose documents are columns of the row.

An action row has mapping, namespace, type (upsert, delete, error), id, doc
(JSON text), distance_metric, error_kind, error_message, lsn, seq, txid.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import ids, values
from ..model import Mapping
from .route import image

ACTION_COLUMNS = ("mapping", "namespace", "type", "id", "doc", "distance_metric", "error_kind", "error_message", "lsn", "seq", "txid")


def chosen(mapping: Mapping, row: T.StructType) -> list[str]:
    """The columns of a document: those of the mapping that exist, all without any."""
    return [c for c in mapping.columns if c in row.names] if mapping.columns else list(row.names)


def identity_document(mapping: Mapping, row: T.StructType, get, missing: Column | None = None) -> Column:
    """The chosen columns as JSON; columns that a row does not carry are left out."""
    parts = [(c, values.json_value(get(c), row[c].dataType)) for c in chosen(mapping, row)]
    if missing is None or not parts:
        return values.document(parts)
    whole = values.document(parts)
    # unchanged values are rare: only rows that lack some column go through entries
    entries = F.filter(
        F.array(*[F.struct(F.lit(k).alias("k"), values.document([(k, v)]).alias("v")) for k, v in parts]), lambda e: ~F.array_contains(missing, e["k"])
    )
    inner = F.transform(entries, lambda e: e["v"].substr(F.lit(2), F.length(e["v"]) - 2))
    return F.when(F.coalesce(F.size(missing), F.lit(0)) <= 0, whole).otherwise(F.concat(F.lit("{"), F.array_join(inner, ","), F.lit("}")))


def _identity(events: DataFrame, mapping: Mapping) -> tuple[Column, Column]:
    """(id, error) of events under a mapping."""
    row: T.StructType = events.schema["new"].dataType
    whole = image(events)
    dtype = row[mapping.id_column].dataType if mapping.id_column in row.names else None
    value = whole.getField(mapping.id_column) if dtype is not None else F.lit(None)
    found, error = ids.extract_id(value, whole.isNotNull(), mapping.id_type, dtype)
    if "missing" in events.columns and dtype is not None:
        gone = F.coalesce(F.array_contains("missing", mapping.id_column), F.lit(False)) & whole.isNotNull()
        found, error = F.when(~gone, found), F.when(gone, "MissingColumn").otherwise(error)
    return found, error


def identify(events: DataFrame, mapping: Mapping) -> DataFrame:
    """``events`` with ``id`` and ``id_error``."""
    found, error = _identity(events, mapping)
    return events.withColumn("id", found).withColumn("id_error", error)


def _made(events: DataFrame, mapping: Mapping) -> dict[str, Column]:
    """The columns of a mapping's identity actions that depend on the mapping."""
    row: T.StructType = events.schema["new"].dataType
    found, id_error = _identity(events, mapping)
    missing = F.col("missing") if "missing" in events.columns else None
    document = identity_document(mapping, row, lambda c: F.col(f"new.`{c}`"), missing)
    no_row = (F.col("op") != "delete") & F.col("new").isNull()
    bad = id_error.isNotNull() | no_row
    return {
        "namespace": F.lit(mapping.namespace),
        "type": F.when(bad, "error").when(F.col("op") == "delete", "delete").otherwise("upsert"),
        "id": found,
        "doc": F.when(~bad & (F.col("op") != "delete"), document),
        "error_kind": F.when(id_error == "InvalidIdType", "invalid_type").when(id_error.isNotNull(), "missing_column").when(no_row, "invalid_data"),
        "error_message": F.when(id_error.isNotNull(), id_error).when(no_row, "event without a new row"),
    }


def identity_actions(events: DataFrame, *mappings: Mapping) -> DataFrame:
    """The actions of events that were routed to ``mappings``, in one pass.

    With several mappings each event's column ``mapping`` says whose it is.
    """
    made = [(m, _made(events, m)) for m in mappings]
    if len(made) == 1:
        columns = made[0][1] | {"mapping": F.lit(mappings[0].name)}
    else:
        columns = {"mapping": F.col("mapping")}
        for name in made[0][1]:
            chosen_one = F.when(F.col("mapping") == made[0][0].name, made[0][1][name])
            for m, own in made[1:]:
                chosen_one = chosen_one.when(F.col("mapping") == m.name, own[name])
            columns[name] = chosen_one
    columns["distance_metric"] = F.lit(None).cast("string")
    return events.select(*[columns[c].alias(c) if c in columns else F.col(c) for c in ACTION_COLUMNS])


def writes(actions: DataFrame) -> DataFrame:
    """The actions that change a namespace."""
    return actions.filter(F.col("type").isin("upsert", "delete"))


def failures(actions: DataFrame) -> DataFrame:
    return actions.filter(F.col("type") == "error")
