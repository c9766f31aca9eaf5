"""Python transforms: the user function surface.

A transform is a function ``f(rows, context) -> list``.  ``rows`` are dicts
with ``event`` (op, schema, table, new, old, lsn) and ``id``; it returns one
action per row: {"type": "upsert", "doc": {...}, "id"?, "distance_metric"?},
{"type": "delete", "id"?} or {"type": "skip"}.  Rows come in batches of an
Arrow batch, at most ``batch_rows``; a batch whose result breaks the contract
becomes error actions, one per row.
"""

from __future__ import annotations

import importlib
import importlib.util
import json
import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..model import DISTANCE_METRICS, Mapping
from .project import ACTION_COLUMNS, identify, identity_actions

BATCH_ROWS = 500
OUT = "type string, id struct<kind:string,text:string,number:decimal(20,0)>, doc string, distance_metric string, error_kind string, error_message string, lsn long, seq int, txid long"


class TransformError(ValueError):
    """A result that breaks the contract."""


@dataclass(frozen=True)
class Context:
    """What a transform knows of its surroundings."""

    mapping: str = "unknown"
    version: int = 0
    namespace: str = ""
    environment: dict = field(default_factory=dict)
    tables: dict = field(default_factory=dict)

    def lookup(self, table: str, key):
        """A row of a table that was given to the transform, by key.

        Only tables small enough to be sent along can be looked up here;
        others are joined before the transform (``with_lookup``).
        """
        return self.tables.get(table, {}).get(key)

    def fetch(self, url: str, method: str = "GET", body: bytes | str | None = None, headers: dict | None = None, timeout: float = 30.0) -> dict:
        """Ask a service: ``status``, ``headers`` and ``body`` (text) of its answer, whatever the status."""
        from urllib.error import HTTPError
        from urllib.request import Request, urlopen

        data = body.encode() if isinstance(body, str) else body
        try:
            answer = urlopen(Request(url, data, headers or {}, method=method), timeout=timeout)
        except HTTPError as refused:
            answer = refused
        with answer:
            return {"status": answer.status, "headers": dict(answer.headers), "body": answer.read().decode("utf-8", "replace")}


def _identity(value, default: dict) -> dict:
    if isinstance(value, bool) or value is None:
        return default
    if isinstance(value, int):
        if not -(2**63) <= value < 2**64:
            return default
        return {"kind": "uint" if value >= 0 else "int", "text": str(value), "number": Decimal(value)}
    if isinstance(value, str):
        return {"kind": "uuid" if len(value) == 36 and "-" in value else "string", "text": value, "number": None}
    return default


def read_action(result, default: dict) -> dict:
    """One returned action, checked."""
    if not isinstance(result, dict):
        raise TransformError("a transform's result must be an object")
    kind = result.get("type")
    if kind == "skip":
        return {"type": "skip", "id": default, "doc": None, "distance_metric": None}
    if kind == "delete":
        return {"type": "delete", "id": _identity(result.get("id"), default), "doc": None, "distance_metric": None}
    if kind != "upsert":
        raise TransformError(f"unknown action type: {kind}" if isinstance(kind, str) else "a transform's result must have a type")
    doc = result.get("doc")
    if not isinstance(doc, dict):
        raise TransformError("an upsert must have a doc")
    metric = result.get("distance_metric")
    return {"type": "upsert", "id": _identity(result.get("id"), default), "doc": _json(doc), "distance_metric": metric if metric in DISTANCE_METRICS else None}


def _json(value) -> str:
    def clean(x):
        if isinstance(x, float) and (x != x or x in (float("inf"), float("-inf"))):
            return None
        if isinstance(x, Decimal):
            return float(x)
        if isinstance(x, dict):
            return {str(k): clean(v) for k, v in x.items()}
        if isinstance(x, (list, tuple)) or hasattr(x, "tolist") and getattr(x, "ndim", 0):
            return [clean(v) for v in (x.tolist() if hasattr(x, "tolist") else x)]
        return x.item() if hasattr(x, "item") else x

    return json.dumps(clean(value), ensure_ascii=False, separators=(",", ":"), default=str)


def load(path: str, entry: str | None = None) -> Callable:
    """The transform in a file or module: ``entry``, or its ``transform``."""
    if path.endswith(".py"):
        spec = importlib.util.spec_from_file_location("_transform", path)
        if spec is None or not os.path.exists(path):
            raise TransformError(f"no transform at {path}")
        module = importlib.util.module_from_spec(spec)
        spec.loader.exec_module(module)
    else:
        module = importlib.import_module(path)
    found = getattr(module, entry or "transform", None)
    if not callable(found):
        raise TransformError(f"{path} has no function {entry or 'transform'}")
    return found


def row_wise(function: Callable) -> Callable:
    """A transform of one row, as a transform of batches."""
    return lambda rows, context: [function(row, context) for row in rows]


def cut_to_tokens(text: str, most: int, encode: Callable[[str], list], decode: Callable[[list], str]) -> str:
    """A text of at most ``most`` tokens of a tokenizer, unchanged if it has no more."""
    tokens = encode(text)
    return text if len(tokens) <= most else decode(tokens[:most])


def with_lookup(events: DataFrame, table: DataFrame, key: str, event_key: str, name: str) -> DataFrame:
    """Each event with the matching row of another relation as a struct ``name``."""
    right = table.select(F.col(key).alias("_lookup_key"), F.struct(*table.columns).alias(name))
    return events.join(right, F.col(f"new.`{event_key}`") == F.col("_lookup_key"), "left").drop("_lookup_key")


def transform_actions(events: DataFrame, mapping: Mapping, function: Callable, context: Context | None = None, batch_rows: int = BATCH_ROWS) -> DataFrame:
    """The actions that a Python transform makes of events routed to ``mapping``.

    Events without a usable id become errors without meeting the transform.
    """
    context = context or Context(mapping.name, mapping.version, mapping.namespace)
    seen = identify(events, mapping)
    extra = [c for c in events.columns if c not in ("op", "schema", "table", "new", "old", "lsn", "seq", "txid", "missing", "mapping", "namespace")]
    fields = [F.to_json(F.struct(F.col(c).alias("v"))).alias(c) for c in ("new", "old", *extra)]
    usable = seen.filter("id_error IS NULL").select("op", "schema", "table", *fields, "lsn", "seq", "txid", "id")

    def run(frames: Iterator) -> Iterator:
        import pandas as pd

        for pdf in frames:
            for start in range(0, len(pdf), batch_rows):
                part = pdf.iloc[start : start + batch_rows]
                rows, defaults = [], []
                for r in part.to_dict("records"):
                    default = dict(r["id"])
                    number = default["number"]
                    plain = int(number) if number is not None and number == number else default["text"]
                    default["number"] = None if number is None or number != number else Decimal(int(number))
                    event = {"op": r["op"], "schema": r["schema"], "table": r["table"], "lsn": r["lsn"]}
                    for c in ("new", "old", *extra):
                        event[c] = json.loads(r[c]).get("v") if r[c] else None
                    rows.append({"event": event, "id": plain})
                    defaults.append(default)
                try:
                    results = function(rows, context)
                    if not isinstance(results, (list, tuple)) or len(results) != len(rows):
                        raise TransformError("a transform must return one result per row")
                    out = [read_action(x, d) | {"error_kind": None, "error_message": None} for x, d in zip(results, defaults, strict=True)]
                except Exception as problem:  # the user's code: whatever it raises goes to the failed events
                    message = f"{type(problem).__name__}: {problem}"
                    out = [{"type": "error", "id": d, "doc": None, "distance_metric": None, "error_kind": "transform_failed", "error_message": message} for d in defaults]
                made = pd.DataFrame(out, columns=["type", "id", "doc", "distance_metric", "error_kind", "error_message"])
                for c in ("lsn", "seq", "txid"):
                    made[c] = part[c].to_numpy()
                yield made

    made = usable.mapInPandas(run, OUT).withColumn("mapping", F.lit(mapping.name)).withColumn("namespace", F.lit(mapping.namespace))
    failed = identity_actions(events, mapping).filter(F.col("error_message").isin("MissingId", "MissingColumn", "InvalidIdType"))
    return made.select(*ACTION_COLUMNS).unionByName(failed.select(*[F.col(c).cast(made.schema[c].dataType).alias(c) for c in ACTION_COLUMNS]))


def actions(events: DataFrame, mapping: Mapping, function: Callable | None = None, context: Context | None = None) -> DataFrame:
    """The actions of routed events, by the mapping's transform."""
    if function is None and mapping.transform.custom and mapping.transform.path:
        function = load(mapping.transform.path, mapping.transform.entry)
    return transform_actions(events, mapping, function, context) if function else identity_actions(events, mapping)


def schema_of(out: str = OUT) -> T.StructType:
    return T._parse_datatype_string(out)
