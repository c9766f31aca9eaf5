"""Commands over a project folder.

Settings come from the environment or ``.env`` files: STORE_PATH and
STATE_PATH (folders for namespaces and state), LOG_PATH (the written change
log), SOURCE_PATH (tables as ``<table>.parquet``; without it tables are looked
up in the catalogue), BASE_NAMESPACE, MAX_RETRIES, UPLOAD_BATCH_SIZE.
"""

from __future__ import annotations

import argparse
import re
import shutil
import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text
from .model import ConfigError, Mapping
from .plans import config, migrations
from .plans.state import State, with_error_facts
from .sources import changelog, fake, scan
from .streaming import run as pipelines
from .streaming.namespace import Store

TEMPLATE = """version = {version}
mapping_name = "{name}"
namespace = "{name}"
columns = ["id"]

[source]
schema = "public"
table = "{name}"

[id]
column = "id"
type = "uint"

[membership]
mode = "all"

[versioning]
mode = "source_lsn"
"""
TRANSFORM = '''"""Transform of {name}: one action per row."""


def transform(rows, context):
    return [{{"type": "delete"}} if r["event"]["op"] == "delete" else {{"type": "upsert", "doc": r["event"]["new"]}} for r in rows]
'''


class Commands:
    def __init__(self, spark: SparkSession, project: config.Project, out=None):
        self.spark, self.project, self.out = spark, project, out or sys.stdout
        root = str(project.root)
        env = project.environment
        self.store = Store(spark, env.get("STORE_PATH", f"{root}/.store"))
        self.state = State(spark, env.get("STATE_PATH", f"{root}/.state"))

    def say(self, *parts) -> None:
        print(*parts, file=self.out)

    def mappings(self) -> list[Mapping]:
        return [m.mapping for m in self.project.load()]

    def mapping(self, name: str) -> Mapping:
        for m in self.mappings():
            if m.name == name:
                return m
        raise ConfigError(f"no mapping named {name}")

    def table(self, m: Mapping) -> DataFrame:
        root = self.project.environment.get("SOURCE_PATH")
        return self.spark.read.parquet(f"{root}/{m.table}.parquet") if root else self.spark.table(m.relation)

    def functions(self) -> dict:
        return {m.mapping.name: pipelines.transform.load(str(p), m.mapping.transform.entry) for m in self.project.load() if (p := migrations.transform_path(self.project.root, m)) and m.mapping.transform.custom}

    def check(self) -> list[config.LocalMigration]:
        """The checks before anything runs: files, transforms, id types."""
        local = self.project.load()
        loose = migrations.unreferenced_files(self.project.root, local)
        if loose:
            raise ConfigError(f"transforms that no mapping refers to: {', '.join(loose)}")
        printing = migrations.prints_to_stdout(self.project.root)
        if printing:
            raise ConfigError(f"transforms that print: {', '.join(printing)}")
        changed = migrations.changed_transforms(self.project.root, self.state, local)
        if changed:
            raise ConfigError(f"transforms that changed after they were applied: {', '.join(changed)}; add a new version")
        return local

    def check_id(self, m: Mapping) -> None:
        from .functions import ids

        table = self.table(m)
        declared = table.schema[m.id_column].dataType.simpleString() if m.id_column in table.columns else None
        if declared is None:
            raise ConfigError(f"{m.relation} has no column {m.id_column}")
        sample = scan.sample_ids(table, m.id_column)
        if not ids.values_match(sample, declared, m.id_type).first().matches:
            raise ConfigError(f"{m.relation}.{m.id_column} does not look like {m.id_type}, rather like {ids.infer_id_type(sample, declared).first().id_type}")

    # commands

    def setup(self) -> None:
        self.say(f"state in {self.state.root}, namespaces in {self.store.root}")

    def new(self, name: str) -> Path:
        clean = text.sanitized_name(name)
        version = migrations.next_version(self.project.load())
        file = self.project.migrations / migrations.file_name(version, clean)
        file.write_text(TEMPLATE.format(version=version, name=clean), encoding="utf-8")
        self.say(f"created {file.name}")
        return file

    def migrate(self, dry_run: bool = False) -> list[str]:
        local = self.check()
        for m in local:
            self.check_id(m.mapping)
        names = migrations.Tracker(self.state).apply(local, dry_run)
        if not dry_run:
            migrations.store_transforms(self.project.root, self.state, local)
        self.say(("would apply: " if dry_run else "applied: ") + (", ".join(names) or "nothing"))
        return names

    def try_transform(self, name: str, rows: int = 5, seed: int = 0) -> list:
        """The actions that a mapping makes of rows drawn from its table's types; nothing is written."""
        m = self.mapping(name)
        fields = self.table(m).schema.fields
        kinds = {f.name: re.sub(r"^array<(.*)>$", r"\1[]", f.dataType.simpleString()) for f in fields}
        made = fake.rows(self.spark, kinds, rows, m.id_column, m.id_type, seed)
        made = made.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in fields])
        function, events = self.functions().get(name), scan.scan(made, m)
        actions = pipelines.transform.transform_actions(events, m, function, pipelines.transform.Context(m.name, m.version, m.namespace)) if function else pipelines.project.identity_actions(events, m)
        found = actions.select("type", F.col("id.text").alias("id"), "doc", "error_message").collect()  # ``rows`` rows
        for r in found:
            self.say(f"{r.type} {r.id}: {r.error_message or r.doc}")
        return found

    def run(self, skip_migrate: bool = False, follow: bool = False) -> None:
        """Mirror what the log has, or with ``follow`` go on until the query is stopped."""
        if skip_migrate:
            migrations.Tracker(self.state).validate_or_fail(self.check(), allow_pending=True)
        else:
            self.migrate()
        root = self.project.environment["LOG_PATH"]
        mappings = self.mappings()
        row = self.spark.read.parquet(root).schema["new"].dataType
        log = changelog.read_log(self.spark, root, row, stream=True)
        query = pipelines.mirror(log, mappings, self.store, self.state, f"{self.state.root}/stream", self.functions(), available_now=not follow)
        try:
            query.awaitTermination()
        except KeyboardInterrupt:  # batches are whole: what was written is acknowledged
            query.stop()
        self.status()

    def status(self) -> list:
        rows = self.state.checkpoints().collect()
        for r in rows:
            self.say(f"{r.mapping_name}: {r.lsn >> 32:X}/{r.lsn & 0xFFFFFFFF:X}, {r.events_processed} events")
        found = migrations.Tracker(self.state).validate(self.project.load())
        self.say(f"migrations: {len(found.applied)} applied, {len(found.pending)} pending, {len(found.mismatched)} mismatched")
        self.say(f"failed events: {self.state.all_failures().count()}")
        return rows

    def backfill(self, name: str, parts: int = 1, resume: bool = False, batch_size: int | None = None) -> scan.Progress:
        m = self.mapping(name)
        self.check()
        done = pipelines.backfill(self.table(m), m, self.store, self.state, self.functions().get(name), parts, resume, batch_size=batch_size)
        self.say(done.line())
        return done

    def dlq_list(self, mapping: str | None = None, limit: int = 50) -> list:
        rows = with_error_facts(self.state.failures(mapping, limit)).orderBy(F.col("created_at").desc(), "id").collect()
        for r in rows:
            message = r.error_message if len(r.error_message) <= 50 else r.error_message[:47] + "..."
            self.say(f"{r.id}  {r.mapping_name}  {r.description}{' (retryable)' if r.retryable else ''}  {message}")
        return rows

    def dlq_show(self, key: str):
        row = self.state.failure(key)
        if row is None:
            raise ConfigError(f"no failed event {key}")
        for k, v in row.asDict().items():
            self.say(f"{k}: {v}")
        return row

    def dlq_retry(self, mapping: str | None = None, key: str | None = None) -> int:
        root = self.project.environment["LOG_PATH"]
        log = self.spark.read.parquet(root)
        mappings = [m for m in self.mappings() if mapping in (None, m.name)]
        done = pipelines.retry_failures(log, mappings, self.store, self.state, mapping, self.functions(), key)
        self.say(f"{done} of the failed events went through")
        return done

    def dlq_clear(self, mapping: str | None = None, everything: bool = False) -> int:
        if mapping is None and not everything:
            raise ConfigError("name a mapping or say --all")
        n = self.state.clear_failures(mapping)
        self.say(f"removed {n}")
        return n

    def reset(self) -> None:
        """Write the local files anew from what was applied."""
        for r in self.state.migration_content().collect():
            (self.project.migrations / migrations.file_name(r.version, r.mapping_name)).write_text(r.content, encoding="utf-8")
        self.project.transforms.mkdir(exist_ok=True)
        for r in self.state.transforms().collect():
            (self.project.transforms / f"{r.mapping_name}.py").write_text(r.content, encoding="utf-8")

    def delete_config(self) -> None:
        for folder in (self.project.migrations, self.project.transforms):
            shutil.rmtree(folder, ignore_errors=True)

    def reset_namespaces(self) -> list[str]:
        """Delete every namespace that a mapping writes to, with progress and checkpoints."""
        names = sorted({m.namespace for m in self.mappings()})
        for n in names:
            self.store.delete_namespace(n)
        for m in self.mappings():
            self.state.clear_backfill(m.name)
        self.state.clear_checkpoints()
        return names


def init(root: str | Path) -> None:
    """A project folder with the files that it needs, existing ones left alone."""
    root = Path(root)
    for folder in ("migrations", "transforms"):
        (root / folder).mkdir(parents=True, exist_ok=True)
    for name, content in ((".env", "STORE_PATH=\nSTATE_PATH=\nLOG_PATH=\nSOURCE_PATH=\n"), ("transforms/__init__.py", ""), (".gitignore", ".env\n.store/\n.state/\n")):
        if not (root / name).exists():
            (root / name).write_text(content, encoding="utf-8")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="changeflow")
    p.add_argument("--project", default=".")
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("init", "setup", "status", "reset", "dangerously-delete-config", "dangerously-reset-namespaces"):
        sub.add_parser(name)
    sub.add_parser("new").add_argument("name")
    sub.add_parser("migrate").add_argument("--dry-run", action="store_true")
    r = sub.add_parser("run")
    r.add_argument("--skip-migrate", action="store_true")
    r.add_argument("--follow", action="store_true")
    t = sub.add_parser("try")
    t.add_argument("mapping")
    t.add_argument("--rows", type=int, default=5)
    t.add_argument("--seed", type=int, default=0)
    b = sub.add_parser("backfill")
    b.add_argument("mapping")
    b.add_argument("--parts", type=int, default=1)
    b.add_argument("--batch-size", type=int)
    b.add_argument("--resume", action="store_true")
    d = sub.add_parser("dlq").add_subparsers(dest="action", required=True)
    one = d.add_parser("list")
    one.add_argument("--mapping")
    one.add_argument("--limit", type=int, default=50)
    d.add_parser("show").add_argument("id")
    one = d.add_parser("retry")
    one.add_argument("--mapping")
    one.add_argument("--id")
    one = d.add_parser("clear")
    one.add_argument("--mapping")
    one.add_argument("--all", action="store_true")
    return p


def main(args: list[str] | None = None, spark: SparkSession | None = None, environment: dict | None = None) -> int:
    a = parser().parse_args(args)
    if a.command == "init":
        init(a.project)
        return 0
    try:
        project = config.project(a.project, environment)
        c = Commands(spark or SparkSession.builder.appName("changeflow").getOrCreate(), project)
        if a.command == "dlq":
            {"list": lambda: c.dlq_list(a.mapping, a.limit), "show": lambda: c.dlq_show(a.id), "retry": lambda: c.dlq_retry(a.mapping, a.id), "clear": lambda: c.dlq_clear(a.mapping, a.all)}[a.action]()
        else:
            {
                "setup": c.setup, "status": c.status, "reset": c.reset, "dangerously-delete-config": c.delete_config, "dangerously-reset-namespaces": c.reset_namespaces,
                "new": lambda: c.new(a.name), "migrate": lambda: c.migrate(a.dry_run), "run": lambda: c.run(a.skip_migrate, a.follow), "try": lambda: c.try_transform(a.mapping, a.rows, a.seed), "backfill": lambda: c.backfill(a.mapping, a.parts, a.resume, a.batch_size),
            }[a.command]()
    except (ConfigError, migrations.MigrationError, scan.RelationError, KeyError) as problem:
        print(f"error: {problem}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
