"""The same log in any number of micro-batches, in any order, gives the same namespace."""

import pytest
from pyspark.sql import functions as F

from changeflow.model import Mapping, Versioning
from changeflow.operators import batch, project
from changeflow.plans.state import State
from changeflow.sources import changelog
from changeflow.streaming import namespace, run

USERS = Mapping("users", "users", "public", "users", "user_id", columns=("user_id", "event_type"))


@pytest.fixture(scope="module")
def log(spark, data):
    return changelog.log_of_events(spark.read.parquet(f"{data}/events.parquet"))


def contents(store):
    return sorted((r.id, r.version, r.doc) for r in store.documents("users").collect())


@pytest.fixture(scope="module")
def expected(spark, log):
    last = log.withColumn("k", F.coalesce("new.user_id", "old.user_id")).groupBy("k").agg(F.max_by(F.struct("op", "new", "lsn"), "lsn").alias("x")).filter("x.op <> 'delete'")
    return sorted((str(r.k), r.x.lsn, '{"user_id":%d,"event_type":"%s"}' % (r.k, r.x.new.event_type)) for r in last.collect())


@pytest.mark.parametrize("files", [1, 3])
def test_mirror(spark, log, expected, tmp_path, files):
    changelog.write_log(log, str(tmp_path / "log"), files)
    store, state = namespace.Store(spark, str(tmp_path / "store"), fanout=2), State(spark, str(tmp_path / "state"))
    row = log.schema["new"].dataType
    for _ in range(2):  # the second start finds nothing new
        stream = changelog.read_log(spark, str(tmp_path / "log"), row, stream=True, max_files=1)
        run.mirror(stream, [USERS], store, state, str(tmp_path / "stream")).awaitTermination()
        assert contents(store) == expected
    assert state.checkpoint("users") == (log.count(), log.count())


def test_redelivery_and_disorder(spark, log, expected, tmp_path):
    store, state = namespace.Store(spark, str(tmp_path / "store"), fanout=2), State(spark, str(tmp_path / "state"))
    parts = [log.filter((F.col("txid") % 3) == i) for i in (2, 0, 1, 0)]  # one part twice, late parts first
    for p in parts:
        run.apply_batch(p, [USERS], store, state)
    assert contents(store) == expected
    run.apply_batch(log.limit(0), [USERS], store, state)
    assert contents(store) == expected
    store.drop_tombstones("users", 10**9)
    assert contents(store) == expected and store.rows("users").filter("deleted").count() == 0


def test_several_mappings_one_scan(spark, log):
    from changeflow.model import Membership

    buyers = Mapping("buyers", "b", "public", "users", "user_id", id_type="string", columns=("value",), membership=Membership("dsl", "event_type = 'purchase'"))
    both = run.actions_of(log, [USERS, buyers])
    assert both._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    apart = run.actions_of(log, [USERS]).unionByName(run.actions_of(log, [buyers]))
    assert both.exceptAll(apart).count() == 0 and both.count() == apart.count()


def test_interrupted_backfill(spark, tmp_path):
    table = spark.range(1, 1201).select(F.col("id").alias("user_id"), F.lit("x").alias("event_type"))
    whole, parted = (namespace.Store(spark, str(tmp_path / n)) for n in ("whole", "parted"))
    state = State(spark, str(tmp_path / "state"))
    assert run.backfill(table, USERS, whole, state).upserted == 1200
    state.save_backfill("users", None, None, 0, "in_progress")
    run.backfill(table.filter("user_id <= 999"), USERS, parted, state)
    done = run.backfill(table, USERS, parted, state, parts=2, resume=True)
    assert done.processed == 1200 and contents(parted) == contents(whole)


@pytest.mark.parametrize("kind", ["long", "string"])
def test_backfill_null_ids_fail_in_any_number_of_parts(spark, tmp_path, kind):
    table = spark.range(1, 101).select(F.when(F.col("id") % 10 != 0, F.col("id")).cast(kind).alias("user_id"), F.lit("x").alias("event_type"))
    mapping = Mapping("users", "users", "public", "users", "user_id", id_type="string" if kind == "string" else "uint", columns=("user_id", "event_type"))
    seen = []
    for parts in (1, 4):
        store, state = namespace.Store(spark, str(tmp_path / f"store{parts}")), State(spark, str(tmp_path / f"state{parts}"))
        done = run.backfill(table, mapping, store, state, parts=parts)
        failed = sorted((r.mapping_name, r.lsn, r.error_message, r.error_kind) for r in state.all_failures().collect())
        seen.append((done.processed, done.upserted, failed, contents(store), state.backfill("users").status, state.backfill("users").processed_rows))
    assert seen[0] == seen[1] and seen[0][0] == 100 and len(seen[0][2]) == 10 and len(seen[0][3]) == 90


def test_column_versions(spark, tmp_path):
    m = Mapping("users", "users", "public", "users", "user_id", columns=("user_id", "value"), versioning=Versioning("column", "value"))
    row = "user_id long, value long"
    table = spark.createDataFrame([(1, 9), (2, 1)], row)
    store, state = namespace.Store(spark, str(tmp_path / "s")), State(spark, str(tmp_path / "t"))
    for df in (table, spark.createDataFrame([(1, 5), (2, 2)], row)):
        run.apply_batch(changelog.inserts(df, "public", "users"), [m], store, state)
    assert [(r.id, r.version) for r in store.documents("users").orderBy("id").collect()] == [("1", 9), ("2", 2)]


def test_column_versions_and_deletes(spark, tmp_path):
    """Whatever batches the log comes in, and again, a delete counts where it stands."""
    m = Mapping("users", "users", "public", "users", "user_id", columns=("user_id", "value"), versioning=Versioning("column", "value"))
    row = "struct<user_id:bigint,value:bigint>"
    steps = [  # op, id, value, lsn
        ("insert", 1, 3, 1000), ("delete", 1, None, 1010), ("insert", 1, 4, 1020),  # back with a higher version
        ("insert", 2, 9, 1030), ("delete", 2, None, 1040), ("insert", 2, 1, 1050), ("update", 2, 0, 1055),  # with a lower one; a still lower one is late
        ("insert", 3, 5, 1060), ("update", 3, 2, 1070), ("insert", 4, 1, 1080), ("delete", 4, None, 1090),
    ]
    rows = [(op, "public", "users", (i, v) if op != "delete" else None, (i, None), lsn, 0, lsn, []) for op, i, v, lsn in steps]
    events = spark.createDataFrame(rows, f"op string, schema string, table string, new {row}, old {row}, lsn long, seq int, txid long, missing array<string>")
    for size in (1, 2, 3, 11):
        store, state = namespace.Store(spark, str(tmp_path / f"s{size}"), fanout=3), State(spark, str(tmp_path / f"t{size}"))
        parts = [events.filter(F.col("lsn").isin(*[s[3] for s in steps[k : k + size]])) for k in range(0, len(steps), size)]
        for part in [*parts, parts[0], parts[-1]]:
            run.apply_batch(part, [m], store, state)
        assert [(r.id, r.version) for r in store.documents("users").orderBy("id").collect()] == [("1", 4), ("2", 1), ("3", 5)], size
        store.drop_tombstones("users", 10**9)
        assert store.rows("users").count() == 3


def test_one_write_for_all_namespaces(spark, tmp_path):
    schema = "namespace string, id_kind string, id string, version long, deleted boolean, doc string, distance_metric string"
    store = namespace.Store(spark, str(tmp_path / "s"))
    names = ["a", "b c", "d=e", "ü%"]
    came = store.apply(spark.createDataFrame([(n, "string", str(i), 1, False, "{}", None) for i, n in enumerate(names * 3)], schema))
    assert came == {n: 3 for n in names} and sorted(store.namespaces()) == sorted(names)
    assert all(store.documents(n).count() == 3 for n in names) and store.apply(spark.createDataFrame([], schema)) == {}


def test_retry_of_one_failure(spark, tmp_path):
    state, store = State(spark, str(tmp_path / "t")), namespace.Store(spark, str(tmp_path / "s"))
    row = "struct<user_id:bigint,event_type:string>"
    rows = [("insert", "public", "users", (x, "e"), None, i + 1, 0, i, []) for i, x in enumerate([1, None, 3])]
    events = spark.createDataFrame(rows, f"op string, schema string, table string, new {row}, old {row}, lsn long, seq int, txid long, missing array<string>")
    failed = events.select(F.lit("users").alias("mapping_name"), "lsn", F.to_json(F.struct("txid", "seq")).alias("event_json"), F.lit("m").alias("error_message"), F.lit("timeout").alias("error_kind"))
    state.add_failures(failed)
    mapping = Mapping("users", "users", "public", "users", "user_id", id_type="uint", columns=("user_id", "event_type"))
    one = state.all_failures().filter("lsn = 1").first().id
    assert run.retry_failures(events, [mapping], store, state, key=one) == 1
    assert sorted((r.lsn, r.retry_count) for r in state.all_failures().collect()) == [(2, 0), (3, 0)]
    assert run.retry_failures(events, [mapping], store, state) == 1
    assert [(r.lsn, r.retry_count) for r in state.all_failures().collect()] == [(2, 1)] and store.documents("users").count() == 2


def test_backfill_by_batch_size(spark, tmp_path):
    table = spark.range(1, 1001).select(F.col("id").alias("user_id"), F.lit("x").alias("event_type"), F.lit("not read").alias("other"))
    store, state = namespace.Store(spark, str(tmp_path / "s")), State(spark, str(tmp_path / "t"))
    done = run.backfill(table, USERS, store, state, batch_size=300)
    assert (done.processed, done.upserted, done.last_id, done.total) == (1000, 1000, "1000", 1000) and store.documents("users").count() == 1000
    assert len([f for f in store._folders("users")]) == 4


def test_store_levels(spark, tmp_path):
    """Changes are appended and merged by level; reading gives the same at any time."""
    store = namespace.Store(spark, str(tmp_path / "s"), fanout=3)
    row = lambda i, v, doc, d=False: ("n", "uint", str(i), v, d, doc, None)
    schema = "namespace string, id_kind string, id string, version long, deleted boolean, doc string, distance_metric string"
    for v in range(1, 11):
        store.apply(spark.createDataFrame([row(1, v, f'{{"v":"{v}"}}'), row(2, 20 - v, f'{{"v":"{v}"}}'), row(3, 5, f'{{"v":"{v}"}}')], schema))
        got = {r.id: r.doc for r in store.documents("n").collect()}
        assert got == {"1": f'{{"v":"{v}"}}', "2": '{"v":"1"}', "3": '{"v":"1"}'}
    assert len(store._folders("n")) <= 4
    store.apply(spark.createDataFrame([row(1, 99, None, True), row(2, 99, '{"w":"x"}')], schema), preserve_missing=True)
    assert {r.id: r.doc for r in store.documents("n").collect()} == {"2": '{"v":"1","w":"x"}', "3": '{"v":"1"}'}
    store.apply(spark.createDataFrame([row(3, 0, '{"v":"last"}')], schema), versioned=False)
    assert {r.id: r.doc for r in store.documents("n").collect()}["3"] == '{"v":"last"}'


class Recorder:
    """A remote store that fails at first, on files so that workers share it."""

    def __init__(self, root):
        self.root = root

    def write(self, name, upserts, deletes, metric):
        import json
        import os
        import uuid

        flag = f"{self.root}/failed"
        if not os.path.exists(flag):
            open(flag, "w").close()
            raise ConnectionError("down")
        with open(f"{self.root}/{uuid.uuid4().hex}.json", "w") as f:
            json.dump([name, upserts, deletes, metric], f)


def test_remote_writer(spark, log, tmp_path):
    import json

    packed = batch.pack_rows(project.identity_actions(log.limit(200), USERS), ["namespace", "txid"], ["lsn", "seq"], 6)
    sent = namespace.send(packed, Recorder(str(tmp_path)), upload_rows=4).collect()
    assert sum(r.n_upserts + r.n_deletes for r in sent) == 200 and sum(r.n_failures for r in sent) >= 1 and max(r.n_upserts for r in sent) <= 4
    found = [json.loads(p.read_text()) for p in tmp_path.glob("*.json")]
    docs = [d for f in found for d in f[1]]
    assert all(set(d) == {"user_id", "event_type", "id", "__source_lsn"} for d in docs) and sum(len(f[2]) for f in found) == sum(r.n_deletes for r in sent)


class Service:
    """A vector service on this machine that turns away what lacks the token and fails at first."""

    def __enter__(self):
        import json
        import threading
        from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

        service, self.documents, self.failed, self.requests = self, {}, 0, 0

        class Handler(BaseHTTPRequestHandler):
            def do_POST(self):  # noqa: N802
                body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
                service.requests += 1
                ok = self.headers["Authorization"] == "Bearer t0ken"
                if ok and service.failed < 2:
                    service.failed, ok = service.failed + 1, None
                if ok:
                    own = service.documents.setdefault(self.path, {})
                    own.update({d["id"]: d for d in body.get("upserts", [])})
                    for i in body.get("deletes", []):
                        own.pop(i, None)
                self.send_response(200 if ok else 401 if ok is False else 503)
                self.end_headers()

            def log_message(self, *args):
                pass

        self.server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        threading.Thread(target=self.server.serve_forever, daemon=True).start()
        return self

    def __exit__(self, *error):
        self.server.shutdown()


def test_mirror_and_backfill_into_a_service(spark, log, expected, tmp_path):
    import json

    with Service() as service:
        writer = namespace.HttpWriter(f"http://127.0.0.1:{service.server.server_port}/v1/{{namespace}}", "t0ken")
        remote, state = namespace.Remote(writer, upload_rows=7), State(spark, str(tmp_path / "state"))
        changelog.write_log(log, str(tmp_path / "log"), 2)
        stream = changelog.read_log(spark, str(tmp_path / "log"), log.schema["new"].dataType, stream=True, max_files=1)
        run.mirror(stream, [USERS], remote, state, str(tmp_path / "stream")).awaitTermination()
        got = service.documents["/v1/users"]
        assert sorted((str(i), d["__source_lsn"], d["event_type"]) for i, d in got.items()) == [(i, v, json.loads(doc)["event_type"]) for i, v, doc in expected]
        assert service.failed == 2 and service.requests > len(got) / 7 and state.checkpoint("users")[0] == log.count()
        service.documents.clear()
        table = spark.range(1, 51).select(F.col("id").alias("user_id"), F.lit("x").alias("event_type"))
        assert run.backfill(table, USERS, remote, state).upserted == 50
        assert len(service.documents["/v1/users"]) == 50 and all(d["__backfill"] for d in service.documents["/v1/users"].values())
        with pytest.raises(Exception, match="401"):
            namespace.Remote(namespace.HttpWriter(writer.url, "wrong"), retries=1, first_delay=0.01).apply(spark.createDataFrame([("users", "uint", "1", 1, False, "{}", None)], "namespace string, id_kind string, id string, version long, deleted boolean, doc string, distance_metric string"))


def test_retries():
    waits, tries = [], []

    def action():
        tries.append(1)
        if len(tries) < 4:
            raise OSError

    assert namespace.retried(action, 5, sleep=waits.append) == 3 and waits == [0.1, 0.2, 0.4]
    with pytest.raises(ZeroDivisionError):
        namespace.retried(lambda: 1 / 0, 2, sleep=waits.append)
