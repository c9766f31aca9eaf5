"""Namespaces: stored documents by namespace, and writers to other stores.

A namespace store is a set of Parquet folders.  A change is appended as a
folder of its own, so its cost is that of the change and not of the store;
what counts is found when the store is read, by the best row of each document.
When ``FANOUT`` folders of one level are there they are merged into one of the
next level, so a row is rewritten as often as the logarithm of the changes.
A folder counts once its marker file is there; folders whose merge was not
finished are read along with it, which changes nothing.

``Writer`` is what a remote store needs: chunks of write requests, sent from
the executors with retries.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import batch, merge

#: Folders of one level that are merged, and how folders of versions from a column end.
FANOUT, EPOCHS = 8, "-e"


class Writer(Protocol):
    """A remote store; must be picklable.  Writing the same request again must do no harm."""

    def write(self, namespace: str, upserts: list[dict], deletes: list[str], distance_metric: str | None) -> None: ...


def retried(action: Callable[[], None], retries: int = 5, first_delay: float = 0.1, sleep: Callable[[float], None] = time.sleep) -> int:
    """Run until it works, waiting 100 ms and then twice as long each time; returns the failures."""
    for attempt in range(retries + 1):
        try:
            action()
        except Exception:
            if attempt == retries:
                raise
            sleep(first_delay * 2**attempt)
        else:
            return attempt
    return retries


def send(actions: DataFrame, writer: Writer, group: list[str] = ["namespace", "txid", "batch"], upload_rows: int = 500, retries: int = 5, lsn: bool = True) -> DataFrame:  # noqa: B006
    """Send packed actions in chunks; one row per request that was written.

    Each document is stamped with the lsn of its batch's first action, or as a
    backfill's (``lsn=False``).  A chunk has at most ``upload_rows`` upserts
    and is gathered in one task; deletes go with a batch's first chunk.
    """
    first = F.min("lsn").over(_window(group)) if lsn else None
    rows = actions.withColumn("_lsn", first if lsn else F.lit(None).cast("long"))
    rows = rows.withColumn("doc", F.when(F.col("type") == "upsert", batch.stamped(F.col("doc"), F.col("id"), F.col("_lsn") if lsn else None)))
    parts = batch.chunks(rows, group, upload_rows)
    requests = parts.groupBy(*group, "chunk").agg(
        F.transform(F.array_sort(F.collect_list(F.when(F.col("type") == "upsert", F.struct("lsn", "seq", "doc")))), lambda x: x["doc"]).alias("upserts"),
        F.transform(F.array_sort(F.collect_list(F.when(F.col("type") == "delete", F.struct("lsn", "seq", F.col("id.text").alias("t"))))), lambda x: x["t"]).alias("deletes"),
        F.min_by("distance_metric", F.when(F.col("distance_metric").isNotNull(), F.struct("lsn", "seq"))).alias("distance_metric"),
        F.min("_lsn").alias("lsn"),
    )

    def run(frames: Iterator) -> Iterator:
        import json

        import pandas as pd

        for pdf in frames:
            out = []
            for r in pdf.itertuples(index=False):
                upserts, deletes = [json.loads(x) for x in r.upserts], list(r.deletes)
                failures = retried(lambda r=r, u=upserts, d=deletes: writer.write(r.namespace, u, d, r.distance_metric), retries)
                out.append((r.namespace, r.lsn, len(upserts), len(deletes), failures))
            yield pd.DataFrame(out, columns=["namespace", "lsn", "n_upserts", "n_deletes", "n_failures"])

    return requests.select("namespace", "lsn", "upserts", "deletes", "distance_metric").mapInPandas(run, "namespace string, lsn long, n_upserts int, n_deletes int, n_failures int")


def _window(group: list[str]):
    from pyspark.sql import Window

    return Window.partitionBy(*group)


def first_documents(documents: DataFrame, k: int) -> DataFrame:
    """The first ``k`` documents by id, numbers as numbers."""
    number = F.when(F.col("id_kind").isin("uint", "int"), F.col("id").try_cast("decimal(20,0)"))
    return documents.orderBy(number.asc_nulls_last(), "id").limit(k)


@dataclass(frozen=True)
class HttpWriter:
    """Writes requests to a service as JSON: ``upserts`` (documents with their
    ``id``), ``deletes`` (ids) and ``distance_metric``, posted to ``url`` with
    ``{namespace}`` filled in.  Any status but 2xx is an error and is retried."""

    url: str
    token: str | None = None
    timeout: float = 30.0

    def write(self, namespace: str, upserts: list[dict], deletes: list[str], distance_metric: str | None) -> None:
        import json
        from urllib.parse import quote
        from urllib.request import Request, urlopen

        body = {"upserts": upserts, "deletes": deletes} | ({"distance_metric": distance_metric} if distance_metric else {})
        headers = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {self.token}"} if self.token else {})
        request = Request(self.url.replace("{namespace}", quote(namespace, safe="")), json.dumps(body).encode(), headers, method="POST")
        with urlopen(request, timeout=self.timeout) as answer:
            answer.read()


class Remote:
    """A remote store in the place of a ``Store``: ``mirror`` and ``backfill``
    send their net changes to its writer from the executors.

    A document is written once per batch, in requests of up to ``upload_rows``,
    stamped with the lsn it comes from (``__source_lsn``) or as a backfill's.
    Batches that are repeated write the same again; the order of batches is
    kept by the caller, which waits for each.
    """

    def __init__(self, writer: Writer, upload_rows: int = 500, retries: int = 5, first_delay: float = 0.1):
        self.writer, self.upload_rows, self.retries, self.first_delay = writer, upload_rows, retries, first_delay

    def apply(self, changes: DataFrame, versioned: bool = True) -> dict[str, int]:  # noqa: ARG002
        """Send net changes (in the stored form); rows that went, by namespace."""
        writer, most, retries, delay = self.writer, self.upload_rows, self.retries, self.first_delay
        number = F.when(F.col("id_kind").isin("uint", "int"), F.col("id").try_cast("decimal(20,0)"))
        identity = F.struct(F.col("id").alias("text"), number.alias("number"))
        lsn = F.when(F.col("version") > 0, F.col("version"))
        doc = F.when(lsn.isNotNull(), batch.stamped(F.col("doc"), identity, lsn)).otherwise(batch.stamped(F.col("doc"), identity, None))
        id_json = F.when(number.isNotNull(), F.to_json(F.array(number))).otherwise(F.to_json(F.array("id")))
        rows = changes.select("namespace", F.when(F.col("deleted"), id_json).alias("gone"), F.when(~F.col("deleted"), doc).alias("doc"), "distance_metric")

        def run(frames: Iterator) -> Iterator:
            import json

            import pandas as pd

            sent: dict[str, int] = {}
            held: dict[str, list] = {}

            def flush(name: str) -> None:
                own = held.pop(name)
                upserts = [json.loads(d) for _, d, _ in own if d is not None]
                deletes = [json.loads(g)[0] for g, _, _ in own if g is not None]
                metric = next((m for _, _, m in own if m is not None), None)
                retried(lambda: writer.write(name, upserts, deletes, metric), retries, delay)
                sent[name] = sent.get(name, 0) + len(own)

            for pdf in frames:
                for name, *row in zip(*[pdf[c] for c in ("namespace", "gone", "doc", "distance_metric")], strict=True):
                    held.setdefault(name, []).append(row)
                    if len(held[name]) >= most:
                        flush(name)
            for name in list(held):
                flush(name)
            yield pd.DataFrame(list(sent.items()), columns=["namespace", "n"])

        done = rows.mapInPandas(run, "namespace string, n long").groupBy("namespace").agg(F.sum("n").alias("n"))
        return {r.namespace: r.n for r in done.collect()}  # a row per namespace


def distinct_namespaces(rows: DataFrame) -> DataFrame:
    """The namespaces that changes go to: a partial aggregate."""
    return rows.select("namespace").distinct()


class Store:
    """Namespaces as Parquet, with tombstones and versions."""

    def __init__(self, spark: SparkSession, root: str, fanout: int = FANOUT):
        self.spark, self.root, self.fanout = spark, root.rstrip("/"), fanout

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, path: str) -> list[str]:
        p, fs = self._fs(path)
        return sorted(x.getPath().getName() for x in fs.listStatus(p)) if fs.exists(p) else []

    def _folders(self, namespace: str) -> list[str]:
        """Complete folders, named by level and time; those of versions from a column end with ``EPOCHS``."""
        return [n.removesuffix(".done") for n in self._names(f"{self.root}/{namespace}") if n.endswith(".done")]

    def _finish(self, namespace: str, name: str, instead_of: list[str] = []) -> None:  # noqa: B006
        """Mark a folder as complete; then those that it replaces go."""
        p, fs = self._fs(f"{self.root}/{namespace}/{name}.done")
        fs.create(p).close()
        for old in instead_of:
            for path in (f"{self.root}/{namespace}/{old}.done", f"{self.root}/{namespace}/{old}"):
                p, fs = self._fs(path)
                fs.delete(p, True)

    @staticmethod
    def _name(level: int, epochs: bool) -> str:
        return f"{level:03d}-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}{EPOCHS if epochs else ''}"

    def _write(self, namespace: str, level: int, rows: DataFrame, instead_of: list[str]) -> None:
        name = self._name(level, any(f.endswith(EPOCHS) for f in instead_of))
        rows.sortWithinPartitions("id").write.parquet(f"{self.root}/{namespace}/{name}")
        self._finish(namespace, name, instead_of)

    def _read(self, namespace: str, folders: list[str]) -> DataFrame:
        schema = merge.ARRIVED
        paths = [f"{self.root}/{namespace}/{f}" for f in folders]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _best(self, namespace: str, folders: list[str]) -> DataFrame:
        return merge.best(self._read(namespace, folders), any(f.endswith(EPOCHS) for f in folders))

    def namespaces(self) -> list[str]:
        return [n for n in self._names(self.root) if not n.startswith((".", "_"))]

    def rows(self, namespace: str) -> DataFrame:
        """The stored form, tombstones included."""
        return self._best(namespace, self._folders(namespace)).drop("arrived", "versioned", "place", "epoch")

    def documents(self, namespace: str) -> DataFrame:
        return merge.live(self.rows(namespace)).select("id_kind", "id", "version", "doc", "distance_metric")

    def top(self, namespace: str, k: int) -> DataFrame:
        """The first ``k`` documents by id, numbers as numbers."""
        return first_documents(self.documents(namespace), k)

    def attribute_names(self, namespace: str) -> list[str]:
        """All keys that documents have."""
        keys = self.documents(namespace).select(F.explode(F.json_object_keys("doc")).alias("k")).distinct().orderBy("k")
        return [r.k for r in keys.collect()]

    def apply(self, changes: DataFrame, versioned: bool = True, preserve_missing: bool = False) -> dict[str, int]:
        """Append net changes (in the stored form); rows that came, by namespace.

        All namespaces are written by one job, each into a part of its own;
        the parts are then moved to their namespaces and marked.
        ``preserve_missing`` keeps attributes of the stored documents that the
        new ones lack; only the stored rows of changed ids are read for it.
        """
        epochs = "epoch" in changes.columns
        if preserve_missing:
            changes = self._with_missing(changes.persist(), versioned)
        elif not epochs:
            changes = changes.withColumns({c: F.lit(None).cast(merge.PLACE) for c in ("place", "epoch")})
        name = self._name(0, epochs)
        whole = f"{self.root}/_new/{name}"
        rows = changes.withColumn("arrived", F.lit(time.time_ns()).cast("long")).withColumn("versioned", F.lit(versioned)).withColumn("_of", F.col("namespace"))
        rows.sortWithinPartitions("_of", "id").write.partitionBy("_of").parquet(whole)
        if preserve_missing:
            changes.unpersist()
        came = {}
        if any(n.startswith("_of=") for n in self._names(whole)):
            written = self.spark.read.schema(f"{merge.ARRIVED}, _of string").parquet(whole)
            came = {r.namespace: r.n for r in written.groupBy("namespace").agg(F.count(F.lit(1)).alias("n")).collect()}  # from the files' own counts and one column
        for namespace in came:
            source, fs = self._fs(f"{whole}/_of={self._escaped(namespace)}")
            target, _ = self._fs(f"{self.root}/{namespace}/{name}")
            fs.mkdirs(target.getParent())
            if not fs.rename(source, target):
                raise OSError(f"could not move {source} to {target}")
            self._finish(namespace, name)
        p, fs = self._fs(whole)
        fs.delete(p, True)
        for namespace in came:
            self.compact(namespace)
        return came

    def _escaped(self, value: str) -> str:
        """A value as Spark writes it in the name of a partition's folder."""
        return self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)

    def _with_missing(self, changes: DataFrame, versioned: bool) -> DataFrame:
        """The changes with attributes of the stored documents that they lack."""
        out = None
        for row in changes.select("namespace").distinct().toLocalIterator():
            own = changes.filter(F.col("namespace") == row.namespace)
            before = self.rows(row.namespace).join(own.select("id_kind", "id"), ["id_kind", "id"], "left_semi")
            merged = merge.merge(before.select(*own.columns), own, versioned, True)
            out = merged if out is None else out.unionByName(merged)
        out = changes if out is None else out
        return out.withColumns({c: F.lit(None).cast(merge.PLACE) for c in ("place", "epoch")})

    def compact(self, namespace: str) -> None:
        """Merge folders of a level that has enough of them, level by level."""
        level = 0
        while True:
            own = [f for f in self._folders(namespace) if f.startswith(f"{level:03d}-")]
            if len(own) < self.fanout:
                return
            self._write(namespace, level + 1, self._best(namespace, own), own)
            level += 1

    def drop_tombstones(self, namespace: str, before: int) -> None:
        """Merge everything and forget deletes older than an lsn that no late event can precede."""
        folders = self._folders(namespace)
        if folders:
            level = max(int(f[:3]) for f in folders)
            rows = self._best(namespace, folders).filter(~F.col("deleted") | (F.coalesce("epoch.lsn", "version") >= before))
            self._write(namespace, level, rows, folders)

    def delete_namespace(self, namespace: str) -> None:
        p, fs = self._fs(f"{self.root}/{namespace}")
        fs.delete(p, True)
