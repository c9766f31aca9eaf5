"""Mapping files, state tables, migrations, commands."""

import io
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from changeflow import cli
from changeflow.model import ConfigError
from changeflow.plans import config, migrations
from changeflow.plans.state import State
from changeflow.sources import changelog

MINIMAL = """version = 1
mapping_name = "users"
namespace = "users"
[source]
schema = "public"
table = "users"
[id]
column = "user_id"
type = "uint"
"""
FULL = """version = 2
mapping_name = "full"
namespace = "ns"
columns = ["user_id", "event_type"]
[source]
schema = "public"
view = "v"
[id]
column = "user_id"
type = "uuid"
[membership]
mode = "dsl"
predicate = "status = 'active' AND deleted_at IS NULL"
[transform]
type = "js"
path = "transforms/x.py"
entry = "go"
[batching]
batch_max_rows = 10
[versioning]
mode = "column"
column = "updated_at"
"""


def test_parse():
    m = config.parse(MINIMAL, "dev")
    assert (m.name, m.namespace, m.relation, m.id_type, m.membership.mode, m.batching.max_rows, m.batching.max_bytes, m.batching.flush_interval_ms, m.versioning.mode) == ("users", "dev_users", "public.users", "uint", "all", 1000, 4194304, 100, "source_lsn")
    f = config.parse(FULL)
    assert (f.table, f.columns, f.transform.entry, f.transform.custom, f.batching.max_rows, f.versioning.column) == ("v", ("user_id", "event_type"), "go", True, 10, "updated_at")


@pytest.mark.parametrize(
    ("old", "new", "message"),
    [
        ("version = 2", "version = 0", "version"), ('predicate = "status = \'active\' AND deleted_at IS NULL"', "", "needs a predicate"), ("status = 'active' AND", "status >=", "invalid predicate"),
        ('column = "updated_at"', "", "needs a column"), ('type = "uuid"', 'type = "float"', "id.type"), ('mode = "dsl"', 'mode = "x"', "membership.mode"), ('view = "v"', "", "source.view"),
        ('namespace = "ns"', "", "namespace"), ("[id]", "[id]\ncolumns = []", "columns stands inside"), ("version = 2", "version =", "not TOML"), ('mapping_name = "full"', 'mapping_name = ""', "mapping_name"),
    ],
)
def test_invalid(old, new, message):
    with pytest.raises(ConfigError, match=message):
        config.parse(FULL.replace(old, new))


def test_layered_env(tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "a" / ".env").write_text("A=1\nexport B='two'\n# C=3\nD=4 # note\n")
    (tmp_path / "a" / ".env.local").write_text("A=9\n")
    assert config.layered_env(tmp_path / "a" / "b", None, {"B": "own"}) == {"A": "9", "B": "own", "D": "4"}


def test_state(spark, tmp_path):
    s = State(spark, str(tmp_path))
    assert s.min_lsn() is None and s.checkpoint("a") is None
    s.save_checkpoints({"a": (300, 1), "b": (100, 2)})
    s.save_checkpoints({"b": (200, 5)})
    assert s.min_lsn() == 200 and s.checkpoint("b") == (200, 5) and [r.mapping_name for r in s.checkpoints().collect()] == ["a", "b"]
    s.record_migration(1, "a", "h")
    assert s.migration(1, "a").content_hash == "h"
    s.store_migration_content(1, "a", "x")
    s.store_migration_content(1, "a", "y")
    assert s.migration_content().first().content == "x"
    s.store_transform("a", 1, "c", "h")
    assert s.transform("a", 1).content == "c"
    s.save_backfill("a", "5", 10, 5, "in_progress")
    assert s.backfill("a").last_id == "5" and s.clear_backfill("a") == 1 and s.backfill("a") is None
    failed = spark.createDataFrame([("a", 1, "{}", "m", "timeout"), ("a", 2, "{}", "m", "odd"), ("b", 3, "{}", "m", "rate_limited")], "mapping_name string, lsn long, event_json string, error_message string, error_kind string")
    s.add_failures(failed)
    s.add_failures(failed.limit(1))
    assert s.failures().count() == 4 and s.failures("b").count() == 1 and s.failures(limit=2).count() == 2
    assert s.count_retryable() == 3 and s.count_retryable("a") == 2
    key = s.failures("b").first().id
    s.mark_retried([key])
    assert s.failure(key).retry_count == 1 and s.delete_failures([key]) == 1
    assert s.clear_failures("a") == 3 and s.clear_checkpoints() == 2


@pytest.fixture
def project(spark, tmp_path, data):
    root = tmp_path / "project"
    cli.init(root)
    assert cli.main(["--project", str(tmp_path), "status"], spark, {}) == 1
    events = spark.read.parquet(f"{data}/events.parquet")
    log = changelog.log_of_events(events)
    changelog.write_log(log, str(tmp_path / "log"), 3)
    users = events.groupBy("user_id").agg(F.max("event_type").alias("event_type"), F.max("value").alias("value"))
    users.write.parquet(str(tmp_path / "source" / "users.parquet"))
    env = {"STORE_PATH": str(tmp_path / "store"), "STATE_PATH": str(tmp_path / "state"), "LOG_PATH": str(tmp_path / "log"), "SOURCE_PATH": str(tmp_path / "source")}
    (root / "migrations" / "0001_users.toml").write_text(MINIMAL)
    return cli.Commands(spark, config.project(root, env), io.StringIO())


def test_commands(project, spark):
    file = project.new("My Buyers!")
    assert file.name == "0002_my_buyers.toml"
    file.write_text(MINIMAL.replace('"users"\nnamespace', '"buyers"\nnamespace').replace("version = 1", "version = 2").replace('namespace = "users"', 'namespace = "buyers"') + "[membership]\nmode = \"dsl\"\npredicate = \"event_type = 'purchase'\"\n")
    assert project.migrate(dry_run=True) == ["1 users", "2 buyers"]
    project.run()
    assert [r.mapping_name for r in project.status()] == ["buyers", "users"] and "2 applied" in project.out.getvalue()
    live = project.store.documents("users").count()
    assert live > 5 and project.store.documents("buyers").count() > 0
    done = project.backfill("users", parts=3)
    assert done.complete and project.state.backfill("users").status == "completed"
    # documents of the log stay, users that the log deleted stay deleted
    assert project.store.documents("users").count() == live
    assert "event_type" in project.store.attribute_names("users")
    ids = [int(r.id) for r in project.store.top("users", 10).collect()]
    assert ids == sorted(ids)
    (project.project.migrations / "0001_users.toml").write_text(MINIMAL.replace('schema = "public"', 'schema = "other"'))
    with pytest.raises(migrations.MigrationError, match="1 users"):
        project.migrate()
    project.reset()
    assert project.project.load()[0].mapping.schema == "public"
    assert project.reset_namespaces() == ["buyers", "users"] and project.store.namespaces() == []
    project.delete_config()
    assert not project.project.migrations.exists()


def test_try_a_transform(project):
    """On rows drawn from the table's types; nothing is written."""
    got = project.try_transform("users", rows=4)
    assert [r.type for r in got] == ["upsert"] * 4 and all("event_type" in r.doc for r in got) and len({r.id for r in got}) == 4
    assert [tuple(r) for r in project.try_transform("users", rows=4)] == [tuple(r) for r in got]
    toml = MINIMAL + '[transform]\ntype = "js"\npath = "transforms/users.py"\n'
    (project.project.migrations / "0001_users.toml").write_text(toml)
    Path(project.project.transforms / "users.py").write_text("def transform(rows, context):\n    return [{'type': 'skip'} if i % 2 else {'type': 'oops'} for i in range(len(rows))]\n")
    assert {r.type for r in project.try_transform("users", rows=2)} == {"error"} and project.store.namespaces() == []


def test_fetch():
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    from changeflow.operators.transform import Context

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):  # noqa: N802
            body = self.rfile.read(int(self.headers["Content-Length"]))
            self.send_response(200 if self.headers["X-Key"] == "k" else 403)
            self.end_headers()
            self.wfile.write(body.upper())

        def log_message(self, *args):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    url = f"http://127.0.0.1:{server.server_port}/embed"
    assert {k: v for k, v in Context().fetch(url, "POST", "text", {"X-Key": "k"}).items() if k != "headers"} == {"status": 200, "body": "TEXT"}
    assert Context().fetch(url, "POST", b"x")["status"] == 403
    server.shutdown()


def test_checks(project):
    (project.project.transforms / "loose.py").write_text("x = 1\n")
    with pytest.raises(ConfigError, match="loose"):
        project.migrate()
    (project.project.transforms / "loose.py").unlink()
    (project.project.migrations / "0001_users.toml").write_text(MINIMAL.replace('"uint"', '"uuid"'))
    with pytest.raises(ConfigError, match="rather like uint"):
        project.migrate()
    toml = MINIMAL + '[transform]\ntype = "js"\npath = "transforms/users.py"\n'
    (project.project.migrations / "0001_users.toml").write_text(toml)
    file = Path(project.project.transforms / "users.py")
    file.write_text(cli.TRANSFORM.format(name="users"))
    project.migrate()
    file.write_text("def transform(rows, context):\n    return [{'type': 'what'} for r in rows]\n")
    with pytest.raises(ConfigError, match="changed after"):
        project.migrate()


def test_failures_are_kept_and_retried(project):
    toml = MINIMAL + '[transform]\ntype = "js"\npath = "transforms/users.py"\n'
    (project.project.migrations / "0001_users.toml").write_text(toml)
    file = Path(project.project.transforms / "users.py")
    file.write_text("def transform(rows, context):\n    raise ValueError('down')\n")
    project.run()
    n = project.state.all_failures().count()
    assert n > 0 and project.store.namespaces() == [] and len(project.dlq_list(limit=3)) == 3
    assert project.dlq_show(project.state.failures(limit=1).first().id).error_kind == "transform_failed"
    file.write_text(cli.TRANSFORM.format(name="users"))
    assert project.dlq_retry("users") == n and project.state.all_failures().count() == 0
    assert project.store.documents("users").count() > 5
    with pytest.raises(ConfigError):
        project.dlq_clear()
    assert project.dlq_clear(everything=True) == 0
