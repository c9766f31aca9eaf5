"""The two pipelines: mirroring a change log, and backfilling a table.

``mirror`` runs a log through routing, transforms and the net change of each
micro-batch into the store; the position and the failures are written after
the documents, so a batch that is repeated after a crash does no harm: merges
are by version.  ``backfill`` is the same for a scan of a table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..model import Mapping
from ..operators import merge, project, route, transform
from ..plans.state import State
from ..sources import scan
from .namespace import Remote, Store

Functions = dict[str, Callable]


def actions_of(events: DataFrame, mappings: Iterable[Mapping], functions: Functions | None = None) -> DataFrame:
    """The actions of a log under all mappings.

    Mappings without a transform of their own are routed in one pass and get
    their documents by a condition per mapping; only rows of mappings with a
    Python transform cross to Python.
    """
    mappings, functions = list(mappings), functions or {}
    if not mappings:
        raise ValueError("no mappings")
    own = {m.name: functions.get(m.name) or (transform.load(m.transform.path, m.transform.entry) if m.transform.custom and m.transform.path else None) for m in mappings}
    plain = [m for m in mappings if not own[m.name]]
    parts = [project.identity_actions(route.route(events, plain), *plain)] if plain else []
    for m in mappings:
        if own[m.name]:
            parts.append(transform.transform_actions(route.route(events, [m]), m, own[m.name], transform.Context(m.name, m.version, m.namespace)))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def with_versions(changes: DataFrame, mappings: Iterable[Mapping]) -> DataFrame:
    """``version``: the lsn, or the value of the document's version column."""
    version = F.col("lsn")
    for m in mappings:
        if m.versioning.mode == "column":
            own = F.get_json_object("doc", f"$.{m.versioning.column}").try_cast("long")
            version = F.when((F.col("mapping") == m.name) & (F.col("type") == "upsert"), F.coalesce(own, F.col("lsn"))).otherwise(version)
    return changes.withColumn("version", version)


def stored_changes(writes: DataFrame, mappings: list[Mapping]) -> list[tuple[DataFrame, bool]]:
    """Net changes of mappings in the stored form, by how their versions count."""
    out = []
    for mode in ("source_lsn", "column", "none"):
        group = [m for m in mappings if m.versioning.mode == mode]
        if group:
            own = writes.filter(F.col("mapping").isin(*[m.name for m in group])) if len(group) < len(mappings) else writes
            changes = merge.net_change_by_version(with_versions(own, group)) if mode == "column" else with_versions(merge.net_change(own), group)
            out.append((merge.as_stored(changes, "version"), mode != "none"))
    return out


def failures_of(actions: DataFrame) -> DataFrame:
    return project.failures(actions).select(
        F.col("mapping").alias("mapping_name"), "lsn", F.to_json(F.struct("id", "txid", "seq")).alias("event_json"), "error_message", "error_kind"
    )


def apply_batch(events: DataFrame, mappings: list[Mapping], store: Store | Remote, state: State, functions: Functions | None = None) -> dict[str, int]:
    """One micro-batch: documents first, then failures, then checkpoints.

    The actions are computed once (a transform may not give the same result
    twice) and kept until all three are written.
    """
    actions = actions_of(events, mappings, functions).persist()
    try:
        came: dict[str, int] = {}
        for changes, versioned in stored_changes(project.writes(actions), mappings):
            for namespace, n in store.apply(changes, versioned).items():
                came[namespace] = came.get(namespace, 0) + n
        failed = failures_of(actions)
        if failed.limit(1).count():
            state.add_failures(failed)
        seen = actions.groupBy("mapping").agg(F.count_if(F.col("type").isin("upsert", "delete")).alias("n")).collect()
        last = events.agg(F.max("lsn")).first()[0]
        if last is not None:
            counts = {r.mapping: r.n for r in seen}
            rows = {}
            for m in mappings:  # every mapping has now seen these events; files of one moment may come in any order
                lsn, n = state.checkpoint(m.name) or (0, 0)
                rows[m.name] = (max(lsn, last), n + counts.get(m.name, 0))
            state.save_checkpoints(rows)
        return came
    finally:
        actions.unpersist()


def mirror(log: DataFrame, mappings: list[Mapping], store: Store | Remote, state: State, checkpoint: str, functions: Functions | None = None, available_now: bool = True, interval_ms: int | None = None):
    """Start mirroring a streaming log; the query stops by itself with ``available_now``."""
    writer = log.writeStream.option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=f"{interval_ms or min(m.batching.flush_interval_ms for m in mappings)} milliseconds")
    return writer.foreachBatch(lambda batch, _: apply_batch(batch, mappings, store, state, functions)).start()


def backfill(table: DataFrame, mapping: Mapping, store: Store | Remote, state: State, function: Callable | None = None, parts: int = 1, resume: bool = False, apply_membership: bool = False, batch_size: int | None = None, rows: int | None = None) -> scan.Progress:
    """Write a table's documents into the namespace, in ``parts`` ranges of ids,
    or in as many as hold about ``batch_size`` rows.  ``rows`` is the table's
    size where statistics have it; else it is counted.

    After each range the progress is recorded; ``resume`` goes on behind the
    last id recorded.  Rows get version 0, so documents that the log wrote
    since are not overwritten.  Membership is not applied unless asked for.
    """
    begun, after, done = scan.started(), None, 0
    if resume:
        row = state.backfill(mapping.name)
        after, done = (row.last_id, row.processed_rows) if row else (None, 0)
    else:
        state.clear_backfill(mapping.name)
    total = scan.estimate(table, rows)
    dtype = table.schema[mapping.id_column].dataType
    key = F.col(mapping.id_column)
    left = table if after is None else table.filter(key > F.lit(after).cast(dtype))
    upserted, last = 0, after
    for low, high in scan.id_ranges(left, mapping.id_column, parts, batch_size, total):
        part = left
        if low is not None:
            part = part.filter(key > F.lit(low))
        if high is not None:
            # rows without an id are in the first range: they fail, and are recorded, whatever the number of parts
            part = part.filter((key <= F.lit(high)) | key.isNull() if low is None else key <= F.lit(high))
        # rows and the last id are counted while they are read for their documents
        seen = Observation()
        part = part.select(*scan.needed_columns(mapping, part)).observe(seen, F.count(F.lit(1)).alias("n"), F.max(key).alias("last"))
        events = scan.scan(part, mapping)
        if apply_membership:
            events = events.filter(route.belongs(mapping, events))
        made = (transform.transform_actions(events, mapping, function) if function else project.identity_actions(events, mapping)).persist()
        for changes, versioned in stored_changes(made.filter("type = 'upsert'"), [mapping]):
            upserted += sum(store.apply(changes, versioned).values())
        failed = failures_of(made)
        if failed.limit(1).count():
            state.add_failures(failed)
        made.unpersist()
        n, top = seen.get["n"], seen.get["last"]
        done += n
        last = scan.cursor_of(table.sparkSession, top, dtype) or last
        state.save_backfill(mapping.name, last, total, done, "in_progress")
    state.save_backfill(mapping.name, last, total, done, "completed")
    import time

    return scan.Progress(done, upserted, time.monotonic() - begun, total, last)


def retry_failures(log: DataFrame, mappings: list[Mapping], store: Store | Remote, state: State, mapping: str | None = None, functions: Functions | None = None, key: str | None = None) -> int:
    """Put the failed events, found again in the log by lsn, through their mappings once more.

    Those that work are removed, the others count a retry; ``key`` is the id
    of a single one.  Ids stay in tables: no list of them comes to the driver.
    """
    entries = state.all_failures()
    if mapping is not None:
        entries = entries.filter(F.col("mapping_name") == mapping)
    if key is not None:
        entries = entries.filter(F.col("id") == key)
    entries = entries.withColumn("seq", F.get_json_object("event_json", "$.seq").cast("int"))
    retried = 0
    for m in mappings:
        own = entries.filter(F.col("mapping_name") == m.name).select("id", "lsn", "seq")
        again = log.join(own.select("lsn", "seq").distinct(), ["lsn", "seq"], "left_semi")
        made = actions_of(again, [m], functions).persist()
        for changes, versioned in stored_changes(project.writes(made), [m]):
            store.apply(changes, versioned)
        good = project.writes(made).select("lsn", "seq", F.lit(True).alias("done")).distinct()
        retried += state.settle_failures(own.join(good, ["lsn", "seq"], "left").select("id", F.coalesce("done", F.lit(False)).alias("done")))
        made.unpersist()
    return retried
