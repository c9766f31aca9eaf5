"""Decoding of the server's logical replication messages.

``decode`` reads one message; ``decoded`` decodes a table of messages with an
Arrow function and keeps those it can't read apart; ``events`` turns a decoded
log into row events: rows outside a transaction or before their relation is
known are dropped, transactions are kept whole.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import lsn as lsn_functions
from ..functions import values

#: The first byte of each kind of message.
KINDS = {"B": "begin", "C": "commit", "R": "relation", "Y": "type", "I": "insert", "U": "update", "D": "delete", "T": "truncate", "O": "origin", "M": "message"}
BINARY = "<binary>"
#: What a row's value can be.
TEXT, BYTES, NO_VALUE = ord("t"), ord("b"), b"nu"

COLUMN = "struct<flags:int,name:string,type_oid:long,modifier:int>"
CELL = "struct<kind:string,text:string>"
#: Up to so many relation messages are broadcast.
FEW_RELATIONS = 10_000
SCHEMA = (
    "lsn long, seq int, kind string, error string, xid long, final_lsn long, end_lsn long, time long, flags int, oid long, schema string, table string, identity string, "
    f"columns array<{COLUMN}>, old_kind string, old array<{CELL}>, new array<{CELL}>, relations array<long>, prefix string, content binary"
)


class DecodeError(ValueError):
    """Bytes that are no message."""


class _Bytes:
    """A reading position in a message."""

    def __init__(self, data: bytes):
        self.data, self.at = data, 0

    def number(self, form: str) -> int:
        size = struct.calcsize(form)
        if self.at + size > len(self.data):
            raise DecodeError("message ends early")
        (found,) = struct.unpack_from(form, self.data, self.at)
        self.at += size
        return found

    def take(self, size: int) -> bytes:
        if size < 0 or self.at + size > len(self.data):
            raise DecodeError("message ends early")
        self.at += size
        return self.data[self.at - size : self.at]

    def text(self) -> str:
        end = self.data.find(b"\0", self.at)
        if end < 0:
            raise DecodeError("unterminated text")
        found = self.data[self.at : end].decode("utf-8")
        self.at = end + 1
        return found

    def letter(self) -> str:
        return chr(self.number(">B"))

    def cells(self) -> list[tuple[str, str | None]]:
        """(kind, text) of each value of a row."""
        data, count, out = self.data, self.number(">h"), []
        at, end = self.at, len(self.data)
        for _ in range(count):
            if at >= end:
                raise DecodeError("message ends early")
            kind = data[at]
            at += 1
            if kind == TEXT or kind == BYTES:
                size = int.from_bytes(data[at : at + 4], "big", signed=True)
                if size < 0 or at + 4 + size > end:
                    raise DecodeError("message ends early")
                out.append(("t", data[at + 4 : at + 4 + size].decode("utf-8")) if kind == TEXT else ("b", BINARY))
                at += 4 + size
            elif kind in NO_VALUE:
                out.append((chr(kind), None))
            else:
                raise DecodeError(f"unknown kind of value: {chr(kind)!r}")
        self.at = at
        return out


def _signed(n: int) -> int:
    """An unsigned 64-bit number in a signed column."""
    return n - 2**64 if n >= 2**63 else n


def decode(data: bytes) -> dict:
    """One message as a dict with ``kind`` and the fields of its kind."""
    found = _decode(data)
    return found | {k: [{"kind": kind, "text": text} for kind, text in found[k]] for k in ("old", "new") if k in found}


def _decode(data: bytes) -> dict:
    if not data:
        raise DecodeError("empty message")
    b, out = _Bytes(data[1:]), {}
    kind = KINDS.get(chr(data[0]))
    if kind == "begin":
        out = {"final_lsn": _signed(b.number(">Q")), "time": b.number(">q"), "xid": b.number(">I")}
    elif kind == "commit":
        out = {"flags": b.number(">B"), "final_lsn": _signed(b.number(">Q")), "end_lsn": _signed(b.number(">Q")), "time": b.number(">q")}
    elif kind == "relation":
        out = {"oid": b.number(">I"), "schema": b.text(), "table": b.text(), "identity": b.letter()}
        out["columns"] = [{"flags": b.number(">B"), "name": b.text(), "type_oid": b.number(">I"), "modifier": b.number(">i")} for _ in range(b.number(">h"))]
    elif kind == "type":
        out = {"oid": b.number(">I"), "schema": b.text(), "table": b.text()}
    elif kind == "insert":
        out = {"oid": b.number(">I")}
        if b.letter() != "N":
            raise DecodeError("insert without a new row")
        out["new"] = b.cells()
    elif kind == "update":
        out = {"oid": b.number(">I")}
        mark = b.letter()
        if mark in "KO":
            out |= {"old_kind": mark, "old": b.cells()}
            mark = b.letter()
        if mark != "N":
            raise DecodeError("update without a new row")
        out["new"] = b.cells()
    elif kind == "delete":
        out = {"oid": b.number(">I"), "old_kind": b.letter()}
        if out["old_kind"] not in "KO":
            raise DecodeError("delete without an old row")
        out["old"] = b.cells()
    elif kind == "truncate":
        n, flags = b.number(">i"), b.number(">B")
        out = {"flags": flags, "relations": [b.number(">I") for _ in range(n)]}
    elif kind == "origin":
        out = {"final_lsn": _signed(b.number(">Q")), "prefix": b.text()}
    elif kind == "message":
        out = {"flags": b.number(">B"), "final_lsn": _signed(b.number(">Q")), "prefix": b.text(), "content": b.take(b.number(">i"))}
    else:
        raise DecodeError(f"unknown message: {data[0]:#04x}")
    return {"kind": kind} | out


def decoded(messages: DataFrame) -> DataFrame:
    """(lsn, seq, data) as decoded messages; for bytes that are none, ``error`` says why."""
    schema = T._parse_datatype_string(SCHEMA)
    from pyspark.sql.pandas.types import to_arrow_schema

    names = [f.name for f in schema.fields][2:]

    def rows_of(cells: list, kind: pa.DataType) -> pa.Array:
        """Lists of cells from flat columns; no object per cell."""
        sizes = [len(c) if c is not None else None for c in cells]
        ends = np.cumsum([0, *(n or 0 for n in sizes)], dtype=np.int32)
        flat = [x for c in cells if c is not None for x in c]
        values = pa.StructArray.from_arrays([pa.array([x[k] for x in flat], pa.string()) for k in (0, 1)], fields=list(kind.value_type))
        return pa.ListArray.from_arrays(pa.array(ends), values, type=kind, mask=pa.array([n is None for n in sizes]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = to_arrow_schema(schema)
        for batch in batches:
            found: dict[str, list] = {n: [None] * batch.num_rows for n in names}
            for at, data in enumerate(batch.column(2).to_pylist()):
                try:
                    for name, value in _decode(data or b"").items():
                        found[name][at] = value
                except (DecodeError, UnicodeDecodeError) as bad:
                    found["error"][at] = str(bad)
            columns = [rows_of(found[n], target.field(n).type) if n in ("old", "new") else pa.array(found[n], target.field(n).type) for n in names]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], schema=target)

    return messages.select(F.col("lsn").cast("long"), F.col("seq").cast("int"), "data").mapInArrow(run, schema)


def undecodable(messages: DataFrame) -> DataFrame:
    return messages.filter("error IS NOT NULL").select("lsn", "seq", "error")


def _row_map(cells: Column, columns: Column) -> Column:
    """Column name to JSON value, by position; unchanged values are left out."""
    pairs = F.zip_with(columns, cells, lambda c, v: F.struct(c["name"].alias("name"), c["type_oid"].alias("oid"), v["kind"].alias("kind"), v["text"].alias("text")))
    sent = F.filter(pairs, lambda p: p["kind"].isNotNull() & (p["kind"] != "u") & p["name"].isNotNull())
    entry = lambda p: F.struct(p["name"], F.when(p["kind"] == "b", F.lit(f'"{BINARY}"')).otherwise(values.json_of_text(p["text"], values.kind_of_oid(p["oid"]))))
    return F.map_from_entries(F.transform(sent, entry))


#: Positions of the log within which a running value is carried by one task.
STRETCH = 1 << 24


def _latest(rows: DataFrame, marks: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``rows`` with the ``value`` of the latest of ``marks`` before them, with equal keys.

    An as-of join on the log's order: the log is cut into stretches, a value
    runs on within one, and what earlier ones end with is carried over.  So a
    table or a log of any length is spread over its stretches.
    """
    kind = marks.schema[value].dataType
    pads = [F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in rows.columns if c not in ("lsn", "seq", *keys)]
    both = rows.select("*", F.lit(None).cast(kind).alias(value), F.lit(True).alias("_row")).unionByName(marks.select("lsn", "seq", *keys, *pads, value, F.lit(False).alias("_row")))
    both = both.withColumn("_stretch", F.floor(F.col("lsn") / STRETCH))
    inside = Window.partitionBy(*keys, "_stretch").orderBy("lsn", "seq", F.col("_row").asc()).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*keys).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    ends = both.groupBy(*keys, "_stretch").agg(F.max_by(value, F.when(~F.col("_row"), F.struct("lsn", "seq"))).alias("_end"))
    carried = ends.select(*keys, "_stretch", F.last("_end", ignorenulls=True).over(earlier).alias("_carried"))
    near = both.withColumn("_near", F.last(value, ignorenulls=True).over(inside)).filter("_row")
    return near.join(carried, [*keys, "_stretch"]).withColumn(value, F.coalesce("_near", "_carried")).drop("_near", "_carried", "_stretch", "_row")


def events_of(messages: DataFrame) -> DataFrame:
    """Row events of messages (lsn, seq, data).  The first byte tells what a
    message is, so rows are decoded once and only the few others again."""
    tag = F.substring("data", 1, 1)
    some = lambda tags: decoded(messages.filter(tag.isin(*[F.lit(t.encode()) for t in tags])))
    return _events(some("BCR"), some("IUD"))


def events(messages: DataFrame) -> DataFrame:
    """Row events of decoded messages, ``new`` and ``old`` as maps of JSON values."""
    return _events(messages, messages)


def _events(control: DataFrame, changes: DataFrame) -> DataFrame:
    """Row events of the changes among some messages, by transactions and relations among others.

    The relation of a row is the latest one sent for its number before it; the
    transaction is that of the latest begin.  Relations are few and rows of one
    are many: up to ``FEW_RELATIONS`` are counted and broadcast with the part of
    the log that they hold for, more are joined by stretches of the log.
    """
    order = ["lsn", "seq"]
    log = control.filter("error IS NULL")
    # transactions: begin and commit carry the same final lsn, rows lie between
    begins = log.filter("kind = 'begin'").select(F.struct(*order).alias("from"), "xid", "final_lsn", "time")
    commits = log.filter("kind = 'commit'").select(F.struct(*order).alias("to"), F.col("final_lsn").alias("c_final"))
    whole = begins.join(commits, begins.final_lsn == commits.c_final).select("from", "to", "xid", "time")
    rows = changes.filter("error IS NULL").filter(F.col("kind").isin("insert", "update", "delete")).select(*order, "kind", "oid", "old_kind", "old", "new")
    relations = log.filter("kind = 'relation'").select(*order, "oid", F.struct("schema", "table", "columns").alias("relation"))
    if not control.isStreaming and relations.count() <= FEW_RELATIONS:
        until = F.lead(F.struct(*order)).over(Window.partitionBy("oid").orderBy(*order))
        spans = relations.select(F.col("oid").alias("r_oid"), F.struct(*order).alias("since"), until.alias("until"), "relation")
        place = F.struct(F.col("lsn"), F.col("seq"))
        known = rows.join(F.broadcast(spans), (F.col("oid") == F.col("r_oid")) & (place > F.col("since")) & (F.col("until").isNull() | (place < F.col("until")))).drop("r_oid", "since", "until")
    else:
        known = _latest(rows, relations, ["oid"], "relation").filter("relation IS NOT NULL")
    marks = whole.select(F.col("from.lsn").alias("lsn"), F.col("from.seq").alias("seq"), F.struct("from", "to", "xid", "time").alias("tx"))
    seen = _latest(known, marks, [], "tx").filter(F.col("tx").isNotNull() & (F.struct(*order) < F.col("tx.to")))
    gone = F.filter(F.zip_with(F.col("relation.columns"), F.coalesce("new", "old"), lambda c, v: F.when(v["kind"] == "u", c["name"])), lambda x: x.isNotNull())
    return seen.select(
        F.col("kind").alias("op"), F.col("relation.schema").alias("schema"), F.col("relation.table").alias("table"),
        F.when(F.col("new").isNotNull(), _row_map(F.col("new"), F.col("relation.columns"))).alias("new"),
        F.when(F.col("old").isNotNull(), _row_map(F.col("old"), F.col("relation.columns"))).alias("old"),
        "lsn", "seq", F.col("tx.xid").alias("txid"), lsn_functions.server_timestamp(F.col("tx.time")).alias("ts"), gone.alias("missing"),
    )


def as_rows(mixed: DataFrame, schema: str, table: str, row: T.StructType) -> DataFrame:
    """The events of one relation with typed rows: JSON values by the row's schema.

    A value of another kind than its column becomes null, except that a text
    column takes any value as text.
    """

    def typed(side: str) -> Column:
        def field(f: T.StructField) -> Column:
            raw = F.try_element_at(F.col(side), F.lit(f.name))
            if isinstance(f.dataType, T.StringType):
                text = F.get_json_object(F.concat(F.lit('{"v":'), raw, F.lit("}")), "$.v")
                return text.alias(f.name)
            return F.from_json(F.concat(F.lit('{"v":'), raw, F.lit("}")), T.StructType([T.StructField("v", f.dataType)]))["v"].alias(f.name)

        return F.when(F.col(side).isNotNull(), F.struct(*[field(f) for f in row.fields]))

    own = mixed.filter((F.col("schema") == schema) & (F.col("table") == table))
    return own.withColumns({"new": typed("new"), "old": typed("old")}).select("op", "schema", "table", "new", "old", "lsn", "seq", "txid", "missing")
