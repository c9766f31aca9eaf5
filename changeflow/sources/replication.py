"""Control of replication slots and publications, and the live log as a data source.

The control plane runs outside Spark on a connection object with
``query(sql, params) -> rows`` and ``execute(sql, params)``: ``JdbcClient``, or
any other driver of the database wrapped so.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, InputPartition, SimpleDataSourceStreamReader

from ..functions.text import quoted, quoted_table, table_parts
from .connection import Connection

PLUGIN = "pgoutput"
PARAMETER = re.compile(r"\$([0-9]+)")
#: Messages after which a micro-batch of the live source ends with its transaction.
MAX_MESSAGES = 100_000


class Client(Protocol):
    def query(self, sql: str, params: tuple = ()) -> list[tuple]: ...

    def execute(self, sql: str, params: tuple = ()) -> None: ...


class JdbcClient:
    """The client over JDBC, on the driver's virtual machine: any database that
    Spark can read, encrypted as the URL says.  Parameters are ``$1``, ``$2`` ...;
    each call has a connection of its own, so none goes stale between polls."""

    def __init__(self, spark: SparkSession, url: str, user: str | None = None, password: str | None = None, driver: str | None = None):
        self.jvm, self.url, self.user, self.password = spark._jvm, url, user, password
        if driver:
            self.jvm.java.lang.Class.forName(driver, True, self.jvm.java.lang.Thread.currentThread().getContextClassLoader())

    def _run(self, sql: str, params: tuple, read: Callable):
        properties = self.jvm.java.util.Properties()
        for key, value in (("user", self.user), ("password", self.password)):
            if value is not None:
                properties.setProperty(key, value)
        connection = self.jvm.java.sql.DriverManager.getConnection(self.url, properties)
        try:
            order = [int(n) for n in PARAMETER.findall(sql)]
            statement = connection.prepareStatement(PARAMETER.sub("?", sql))
            for at, n in enumerate(order, 1):
                statement.setObject(at, params[n - 1])
            return read(statement)
        finally:
            connection.close()

    def query(self, sql: str, params: tuple = ()) -> list[tuple]:
        def read(statement) -> list[tuple]:
            found, rows = statement.executeQuery(), []
            width = found.getMetaData().getColumnCount()
            while found.next():
                rows.append(tuple(found.getObject(i) for i in range(1, width + 1)))
            return rows

        return self._run(sql, params, read)

    def execute(self, sql: str, params: tuple = ()) -> None:
        self._run(sql, params, lambda statement: statement.execute())


def client_of(spark: SparkSession, connection: Connection) -> JdbcClient:
    """The client of a connection string (``connection.parse``)."""
    options = connection.jdbc("")
    return JdbcClient(spark, options["url"], options["user"], options["password"], options["driver"])


def pending_messages(spark: SparkSession, connection: Connection, slot_name: str, publication: str, most: int = MAX_MESSAGES) -> DataFrame:
    """The next messages of a slot as (lsn, seq, data), read by Spark's JDBC
    source: about ``most``, whole transactions.  They stay in the slot until
    ``acknowledge`` is called, so a batch that fails is read again."""
    literal = lambda x: "'" + x.replace("'", "''") + "'"
    changes = f"pg_logical_slot_peek_binary_changes({literal(slot_name)}, NULL, {int(most)}, 'proto_version', '1', 'publication_names', {literal(publication)})"
    polled = f"(SELECT (lsn - '0/0'::pg_lsn)::bigint AS lsn, row_number() OVER ()::int AS seq, data FROM {changes}) AS polled"
    return spark.read.format("jdbc").options(**connection.jdbc(polled)).load()


def acknowledge(client: Client, slot_name: str, lsn: int) -> None:
    """Let the server forget what is done."""
    client.execute("SELECT pg_replication_slot_advance($1, $2::pg_lsn)", (slot_name, f"{lsn >> 32:X}/{lsn & 0xFFFFFFFF:X}"))


class ReplicationError(RuntimeError):
    """A slot or publication is not there."""


def slot(client: Client, name: str) -> tuple[str | None, str | None] | None:
    """(plugin, confirmed position) of a slot, None if there is none."""
    rows = client.query("SELECT plugin, confirmed_flush_lsn::text FROM pg_replication_slots WHERE slot_name = $1", (name,))
    return tuple(rows[0]) if rows else None


def create_slot(client: Client, name: str) -> None:
    client.execute(f"SELECT pg_create_logical_replication_slot($1, '{PLUGIN}')", (name,))


def drop_slot(client: Client, name: str) -> None:
    client.execute("SELECT pg_drop_replication_slot($1)", (name,))


def ensure_slot(client: Client, name: str, create: bool = True) -> None:
    """A slot with the right plugin; one with another is made anew."""
    found = slot(client, name)
    if found is None and not create:
        raise ReplicationError(f"replication slot not found: {name}")
    if found is not None and found[0] != PLUGIN:
        drop_slot(client, name)
    if found is None or found[0] != PLUGIN:
        create_slot(client, name)


def publication_exists(client: Client, name: str) -> bool:
    return bool(client.query("SELECT 1 FROM pg_publication WHERE pubname = $1", (name,)))


def publication_tables(client: Client, name: str) -> set[str]:
    return {f"{s}.{t}" for s, t in client.query("SELECT schemaname, tablename FROM pg_publication_tables WHERE pubname = $1", (name,))}


def create_publication(client: Client, name: str, tables: Iterable[str] = ()) -> None:
    """A publication of some tables, of all if none are named."""
    names = ", ".join(quoted_table(t) for t in tables)
    client.execute(f"CREATE PUBLICATION {quoted(name)} FOR " + (f"TABLE {names}" if names else "ALL TABLES"))


def drop_publication(client: Client, name: str) -> None:
    client.execute(f"DROP PUBLICATION IF EXISTS {quoted(name)}")


def missing_tables(required: Iterable[str], current: Iterable[str]) -> list[str]:
    """Required tables that are not among the current ones, names without schema being in ``public``."""
    current = set(current)
    return [t for t in required if ".".join(table_parts(t)) not in current]


def missing_tables_of(required: DataFrame, current: DataFrame) -> DataFrame:
    """The same for tables of names (column ``name``)."""
    full = lambda c: F.when(c.contains("."), c).otherwise(F.concat(F.lit("public."), c))
    return required.select(full(F.col("name")).alias("name")).join(current.select(full(F.col("name")).alias("name")), "name", "left_anti").distinct()


def ensure_publication(client: Client, name: str, tables: list[str], create: bool = True) -> None:
    if publication_exists(client, name):
        absent = missing_tables(tables, publication_tables(client, name)) if tables else []
        if absent:
            client.execute(f"ALTER PUBLICATION {quoted(name)} ADD TABLE " + ", ".join(map(quoted_table, absent)))
    elif create:
        create_publication(client, name, tables)
    else:
        raise ReplicationError(f"publication not found: {name}")


@dataclass(frozen=True)
class Status:
    """``slot``: ready, wrong_plugin or missing."""

    slot: str
    publication: bool
    lsn: str | None = None

    @property
    def ready(self) -> bool:
        return self.slot == "ready" and self.publication

    @property
    def needs_reset(self) -> bool:
        return not self.ready


def check(client: Client, slot_name: str, publication: str) -> Status:
    found = slot(client, slot_name)
    state = "missing" if found is None else "ready" if found[0] == PLUGIN else "wrong_plugin"
    return Status(state, publication_exists(client, publication), found[1] if state == "ready" else None)


def reset(client: Client, slot_name: str, publication: str, tables: list[str]) -> None:
    if slot(client, slot_name):
        drop_slot(client, slot_name)
    drop_publication(client, publication)
    create_publication(client, publication, tables)
    create_slot(client, slot_name)


def start_position(configured: int | None, confirmed: int | None) -> int:
    """Where to begin: the configured position, else the slot's, else 0."""
    return configured if configured is not None else confirmed if confirmed is not None else 0


class Acknowledged:
    """The position up to which everything is done; it never goes back."""

    def __init__(self, lsn: int = 0):
        self.lsn = lsn

    def acknowledge(self, lsn: int) -> bool:
        if lsn <= self.lsn:
            return False
        self.lsn = lsn
        return True


class LogSource(DataSource):
    """Messages of a live log as a stream (lsn, data), format ``change_log``.

    Options: ``feed``, the import path ``module:function`` of a function
    (options, after lsn) -> iterable of (lsn, bytes) of whole transactions,
    ``startingLsn``, and ``maxMessages``: a micro-batch ends with the first
    transaction that reaches so many.  The offset is the last lsn; Spark keeps
    it in its offset log and gives it back after a restart.
    """

    @classmethod
    def name(cls) -> str:
        return "change_log"

    def schema(self) -> str:
        return "lsn long, data binary"

    def simpleStreamReader(self, schema):  # noqa: N802
        return LogReader(dict(self.options))


class LogReader(SimpleDataSourceStreamReader):
    def __init__(self, options: dict):
        self.options = options

    def _feed(self, after: int, until: int | None = None) -> Iterator[tuple[int, bytes]]:
        import importlib

        module, _, function = self.options["feed"].partition(":")
        for lsn, data in getattr(importlib.import_module(module), function)(self.options, after):
            if until is not None and lsn > until:
                return
            yield lsn, bytes(data)

    def initialOffset(self) -> dict:  # noqa: N802
        return {"lsn": int(self.options.get("startinglsn", self.options.get("startingLsn", 0)))}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        most = int(self.options.get("maxmessages", self.options.get("maxMessages", MAX_MESSAGES)))
        rows, open_transaction = [], False
        for lsn, data in self._feed(start["lsn"]):
            # offsets are positions, so a batch may end where the position changes and no transaction is open
            if len(rows) >= most and not open_transaction and lsn != rows[-1][0]:
                break
            open_transaction = {b"B": True, b"C": False}.get(data[:1], open_transaction)
            rows.append((lsn, data))
        return iter(rows), {"lsn": rows[-1][0] if rows else start["lsn"]}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:  # noqa: N802
        return self._feed(start["lsn"], end["lsn"])

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [InputPartition((start["lsn"], end["lsn"]))]
