"""The data model: events, actions, mappings, error kinds.

A row event is a DataFrame row (op, schema, table, new, old, lsn, seq, txid,
missing).  ``new`` and ``old`` are structs of the relation's columns; the
columns that an event does not carry at all (as opposed to carrying null) are
named in ``missing``.  ``seq`` orders the rows of one lsn.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

OPERATIONS = ("insert", "update", "delete")
ID_TYPES = ("uint", "int", "uuid", "string")
MEMBERSHIP_MODES = ("dsl", "view", "lookup", "all")
TRANSFORM_TYPES = ("identity", "js", "rust")
VERSIONING_MODES = ("source_lsn", "column", "none")
DISTANCE_METRICS = ("cosine_distance", "euclidean_squared")

#: Kind, description, whether a retry may help.
ERROR_KINDS = (
    ("missing_column", "Missing column", False),
    ("invalid_type", "Invalid type", False),
    ("transform_failed", "Transform failed", False),
    ("predicate_failed", "Predicate failed", False),
    ("schema_error", "Schema error", False),
    ("invalid_data", "Invalid data", False),
    ("network_error", "Network error", True),
    ("rate_limited", "Rate limited", True),
    ("service_unavailable", "Service unavailable", True),
    ("timeout", "Timeout", True),
    ("unknown", "Unknown error", False),
)

ID_STRUCT = T.StructType([T.StructField("kind", T.StringType()), T.StructField("text", T.StringType()), T.StructField("number", T.DecimalType(20, 0))])
ERROR_STRUCT = T.StructType([T.StructField("kind", T.StringType()), T.StructField("message", T.StringType())])


class ConfigError(ValueError):
    """A mapping or its file is not valid."""


def event_schema(row: T.StructType) -> T.StructType:
    """The schema of events of a relation whose rows have the schema ``row``."""
    return T.StructType(
        [
            T.StructField("op", T.StringType()), T.StructField("schema", T.StringType()), T.StructField("table", T.StringType()),
            T.StructField("new", row), T.StructField("old", row),
            T.StructField("lsn", T.LongType()), T.StructField("seq", T.IntegerType()), T.StructField("txid", T.LongType()),
            T.StructField("missing", T.ArrayType(T.StringType())),
        ]
    )


@dataclass(frozen=True)
class Batching:
    """Limits of a batch; the interval is a streaming trigger."""

    max_rows: int = 1000
    max_bytes: int = 4 * 1024 * 1024
    flush_interval_ms: int = 100

    def __post_init__(self):
        if self.max_rows < 1 or self.max_bytes < 1:
            raise ConfigError("batch limits must be positive")


@dataclass(frozen=True)
class Membership:
    mode: str = "all"
    predicate: str | None = None


@dataclass(frozen=True)
class Versioning:
    mode: str = "source_lsn"
    column: str | None = None


@dataclass(frozen=True)
class Transform:
    """A Python transform: ``path`` of a file (or a module) and ``entry`` in it."""

    type: str = "identity"
    path: str | None = None
    entry: str | None = None

    @property
    def custom(self) -> bool:
        return self.type != "identity" or self.path is not None


@dataclass(frozen=True)
class Mapping:
    """Which rows of a relation become which documents of a namespace."""

    name: str
    namespace: str
    schema: str
    table: str
    id_column: str
    id_type: str = "uint"
    version: int = 1
    columns: tuple[str, ...] = ()
    membership: Membership = field(default_factory=Membership)
    transform: Transform = field(default_factory=Transform)
    batching: Batching = field(default_factory=Batching)
    versioning: Versioning = field(default_factory=Versioning)

    def __post_init__(self):
        for what in ("name", "namespace", "schema", "table", "id_column"):
            if not getattr(self, what):
                raise ConfigError(f"mapping without {what}")
        if self.id_type not in ID_TYPES:
            raise ConfigError(f"unknown id type: {self.id_type}")

    @property
    def relation(self) -> str:
        return f"{self.schema}.{self.table}"
