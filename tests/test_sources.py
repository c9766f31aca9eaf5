"""Replication messages, scans, connections, control of slots."""

import struct

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.functions import lsn
from changeflow.model import Mapping, Transform
from changeflow.sources import changelog, connection, fake, pgoutput, replication, scan


def cells(*values):
    out = struct.pack(">h", len(values))
    for v in values:
        out += v if isinstance(v, bytes) else b"t" + struct.pack(">i", len(v.encode())) + v.encode()
    return out


RELATION = b"R" + struct.pack(">I", 7) + b"public\0users\0d" + struct.pack(">h", 2) + struct.pack(">B", 1) + b"id\0" + struct.pack(">Ii", 20, -1) + struct.pack(">B", 0) + b"note\0" + struct.pack(">Ii", 3802, -1)
BEGIN = b"B" + struct.pack(">QqI", 100, 5_000_000, 9)
COMMIT = b"C" + struct.pack(">BQQq", 0, 100, 101, 0)
INSERT = b"I" + struct.pack(">I", 7) + b"N" + cells("1", '{"a": [1, 2.5]}')
UPDATE = b"U" + struct.pack(">I", 7) + b"K" + cells("1", b"n") + b"N" + cells("2", b"u")
DELETE = b"D" + struct.pack(">I", 7) + b"K" + cells("2", b"n")


def test_decode():
    assert pgoutput.decode(BEGIN) == {"kind": "begin", "final_lsn": 100, "time": 5_000_000, "xid": 9}
    assert pgoutput.decode(COMMIT)["end_lsn"] == 101
    relation = pgoutput.decode(RELATION)
    assert (relation["schema"], relation["table"], [c["name"] for c in relation["columns"]], relation["identity"]) == ("public", "users", ["id", "note"], "d")
    assert pgoutput.decode(INSERT)["new"][0] == {"kind": "t", "text": "1"}
    update = pgoutput.decode(UPDATE)
    assert update["old_kind"] == "K" and update["new"][1]["kind"] == "u"
    assert pgoutput.decode(DELETE)["old"][0]["text"] == "2"
    assert pgoutput.decode(b"T" + struct.pack(">iBII", 2, 1, 7, 8))["relations"] == [7, 8]
    assert pgoutput.decode(b"O" + struct.pack(">Q", 2**63 + 5) + b"src\0")["final_lsn"] == -(2**63) + 5
    assert pgoutput.decode(b"M" + struct.pack(">BQ", 1, 3) + b"p\0" + struct.pack(">i", 2) + b"hi")["content"] == b"hi"
    assert pgoutput.decode(b"Y" + struct.pack(">I", 1) + b"s\0t\0")["kind"] == "type"
    assert pgoutput.decode(b"I" + struct.pack(">I", 7) + b"N" + cells(b"b" + struct.pack(">i", 1) + b"\xff"))["new"][0]["text"] == pgoutput.BINARY
    for bad in (b"", b"?", INSERT[:-1], b"I" + struct.pack(">I", 7) + b"X", b"U" + struct.pack(">I", 7) + b"K" + cells("1"), b"R" + struct.pack(">I", 1) + b"open"):
        with pytest.raises(pgoutput.DecodeError):
            pgoutput.decode(bad)


def test_events_of_messages(spark):
    rows = [(1, 0, INSERT), (2, 0, BEGIN), (2, 1, INSERT), (3, 0, RELATION), (4, 0, INSERT), (5, 0, UPDATE), (6, 0, DELETE), (7, 0, COMMIT), (8, 0, INSERT), (9, 0, BEGIN[:1] + struct.pack(">QqI", 200, 0, 10)), (10, 0, INSERT), (11, 0, b"junk")]
    decoded = pgoutput.decoded(spark.createDataFrame(rows, "lsn long, seq int, data binary"))
    assert [r.lsn for r in pgoutput.undecodable(decoded).collect()] == [11]
    mixed = pgoutput.events(decoded).orderBy("lsn").collect()
    # outside a transaction, before the relation, or in an open transaction: dropped
    assert [(r.lsn, r.op, r.txid, r.missing) for r in mixed] == [(4, "insert", 9, []), (5, "update", 9, ["note"]), (6, "delete", 9, [])]
    assert mixed[0].new == {"id": "1", "note": '{"a":[1,2.5]}'} and mixed[1].new == {"id": "2"} and mixed[0].ts == "2000-01-01T00:00:05.000000Z"
    typed = pgoutput.as_rows(pgoutput.events(decoded), "public", "users", T._parse_datatype_string("id long, note string")).orderBy("lsn").collect()
    assert typed[0].new.id == 1 and typed[0].new.note == '{"a":[1,2.5]}' and typed[2].old.id == 2


def test_lsn(spark):
    df = spark.createDataFrame([("0/16B3748",), ("1/16B3748",), ("x",), ("1",), (None,)], "t string").select(lsn.parse_lsn(F.col("t")).alias("n"))
    assert [r.n for r in df.collect()] == [0x16B3748, 0x100000000 + 0x16B3748, None, None, None]
    shown = spark.createDataFrame([(0,), (2**40,), (-1,)], "n long").select(lsn.format_lsn(F.col("n")).alias("t")).collect()
    assert [r.t for r in shown] == ["0/0", "100/0", "FFFFFFFF/FFFFFFFF"]
    times = spark.createDataFrame([(0,), (1,), (-1,), (-1_000_000,), (2**62,)], "n long").select(lsn.server_timestamp(F.col("n")).alias("t")).collect()
    assert [r.t for r in times] == ["2000-01-01T00:00:00.000000Z", "2000-01-01T00:00:00.000001Z", "-1us", "1999-12-31T23:59:59.000000Z", f"{2**62}us"]


def test_scan_crosses_digit_boundaries(spark):
    table = spark.range(990, 1010).withColumnRenamed("id", "k").withColumn("v", F.lit("x")).withColumn("w", F.lit(1))
    m = Mapping("m", "n", "public", "t", "k", columns=("v",))
    assert scan.needed_columns(m, table) == ["k", "v"]
    assert scan.needed_columns(Mapping("m", "n", "public", "t", "k", columns=("v",), transform=Transform("js", "t.py")), table) == ["k", "v", "w"]
    seen, after = [], None
    while rows := scan.page(table, "k", after, 7).collect():
        seen += [r.k for r in rows]
        after = str(rows[-1].k)
    assert seen == list(range(990, 1010))
    assert scan.scan(table, m, after="999").count() == 10
    ranges = scan.id_ranges(table, "k", 3)
    assert ranges[0][0] is None and ranges[-1][1] is None and len(ranges) == 3
    names = scan.id_ranges(table.select(F.concat(F.lit("n"), "k").alias("k")), "k", 3)
    assert names[0][0] is None and names[-1][1] is None
    assert scan.last_cursor(table, "k") == "1009" and scan.last_cursor(table.limit(0), "k") is None
    assert scan.estimate(table) == 20 and scan.estimate(table, -1) is None
    assert scan.sample_ids(table, "k", 3).count() == 3


def test_pages_by_several_columns(spark):
    rows = [(a, b, b * a) for a in range(5) for b in ("x", "y", "z")]
    table = spark.createDataFrame(rows, "a int, b string, c string")
    seen, after = [], None
    while found := scan.page(table, ["a", "b"], after, 4).collect():
        seen += [tuple(r) for r in found]
        after = [found[-1].a, found[-1].b]
    assert seen == rows
    assert [tuple(r) for r in scan.page(table, ["a", "b"], [3], 2).collect()] == [(4, "x", "xxxx"), (4, "y", "yyyy")]


def test_progress():
    p = scan.Progress(50, 40, 10.0, 200)
    assert (p.percent, p.eta, p.complete) == (25.0, 30.0, False)
    assert p.line() == "⠋ [ 25.0%] 50/200 read | 40 upserted (5 read/s, 4 upsert/s) [10s ETA 30s]"
    assert scan.Progress(5, 5, 0.0).line(1) == "⠙ 5 read | 5 upserted (0 read/s, 0 upsert/s) [0s]"


def test_validation(spark):
    spark.range(1).createOrReplaceTempView("there")
    scan.validate(spark, ["there"])
    with pytest.raises(scan.RelationError, match="nowhere: not found"):
        scan.validate(spark, ["there", "nowhere"])


def test_connection():
    c = connection.parse("postgres://us%40er:p%2Fw@db-pooler.host:5433/name?sslmode=require")
    assert (c.user, c.password, c.host, c.port, c.database, c.tls, c.pooled) == ("us@er", "p/w", "db-pooler.host", 5433, "name", True, True)
    assert connection.parse("host=h dbname=d password=x").jdbc("t")["url"] == "jdbc:postgresql://h:5432/d"
    with pytest.raises(ValueError, match="port"):
        connection.parse("port=x")


class FakeClient:
    def __init__(self, answers):
        self.answers, self.done = answers, []

    def query(self, sql, params=()):
        return next((v for k, v in self.answers.items() if k in sql), [])

    def execute(self, sql, params=()):
        self.done.append(sql)


def test_replication_control():
    wrong = FakeClient({"pg_replication_slots": [("wal2json", None)], "pg_publication ": [(1,)], "pg_publication_tables": [("public", "a")]})
    replication.ensure_slot(wrong, "s")
    replication.ensure_publication(wrong, "p", ["a", "b.c"])
    assert wrong.done == ["SELECT pg_drop_replication_slot($1)", "SELECT pg_create_logical_replication_slot($1, 'pgoutput')", 'ALTER PUBLICATION "p" ADD TABLE "b"."c"']
    assert replication.check(wrong, "s", "p").needs_reset
    none = FakeClient({})
    with pytest.raises(replication.ReplicationError):
        replication.ensure_slot(none, "s", create=False)
    with pytest.raises(replication.ReplicationError):
        replication.ensure_publication(none, "p", [], create=False)
    replication.ensure_publication(none, "p", [])
    assert none.done == ['CREATE PUBLICATION "p" FOR ALL TABLES'] and replication.check(none, "s", "p").slot == "missing"
    ready = FakeClient({"pg_replication_slots": [("pgoutput", "0/5")], "pg_publication ": [(1,)]})
    assert replication.check(ready, "s", "p").ready
    replication.reset(ready, "s", "p", ["t"])
    assert ready.done[-2:] == ['CREATE PUBLICATION "p" FOR TABLE "t"', "SELECT pg_create_logical_replication_slot($1, 'pgoutput')"]
    assert replication.start_position(None, 5) == 5 and replication.start_position(0, 5) == 0 and replication.start_position(None, None) == 0
    a = replication.Acknowledged()
    assert a.acknowledge(5) and not a.acknowledge(3) and a.lsn == 5


def feed(options, after):
    return [(n, b"x%d" % n) for n in range(after + 1, 6)]


def test_live_source(spark, tmp_path):
    spark.dataSource.register(replication.LogSource)
    stream = spark.readStream.format("change_log").option("feed", "tests.test_sources:feed").option("startingLsn", 2).load()
    q = stream.writeStream.format("memory").queryName("live").option("checkpointLocation", str(tmp_path)).start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert [(r.lsn, bytes(r.data)) for r in spark.table("live").orderBy("lsn").collect()] == [(3, b"x3"), (4, b"x4"), (5, b"x5")]


def test_jdbc_client(spark):
    """On the embedded database that comes with Spark."""
    client = replication.JdbcClient(spark, "jdbc:derby:memory:slots;create=true", driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")
    client.execute("CREATE TABLE pg_publication (pubname VARCHAR(20))")
    assert not replication.publication_exists(client, "p")
    client.execute("INSERT INTO pg_publication VALUES ($1), ($2)", ("p", "q"))
    assert replication.publication_exists(client, "p") and client.query("SELECT pubname FROM pg_publication WHERE pubname <> $2 OR pubname = $1 ORDER BY 1", ("q", "p")) == [("q",)]
    with pytest.raises(Exception, match="NOT_THERE"):
        client.query("SELECT * FROM not_there")


def test_acknowledge_and_pending_messages(spark):
    calls = []

    class Recorder:
        def execute(self, sql, params=()):
            calls.append((sql, params))

    replication.acknowledge(Recorder(), "s", 0x1_0000_00FF)
    assert calls == [("SELECT pg_replication_slot_advance($1, $2::pg_lsn)", ("s", "1/FF"))]
    with pytest.raises(Exception):  # no server here: the driver's class is asked for
        replication.pending_messages(spark, connection.parse("postgres://u:p@localhost:1/d?sslmode=require"), "s", "p")


def test_live_batches_end_with_transactions():
    log = [(1, b"B"), (1, b"I1"), (2, b"I2"), (3, b"C"), (4, b"B"), (5, b"I3"), (6, b"C"), (7, b"B")]
    reader = replication.LogReader({"feed": "x:y", "maxMessages": "2"})
    reader._feed = lambda after, until=None: ((n, d) for n, d in log if n > after and (until is None or n <= until))
    at, seen = {"lsn": 0}, []
    for _ in range(3):
        rows, at = reader.read(at)
        seen.append((list(rows), at["lsn"]))
    assert [x for _, x in seen] == [3, 6, 7] and [r for rows, _ in seen for r in rows] == log


def test_fake_rows(spark):
    columns = {"k": "int", "small": "smallint not null", "u": "uuid", "t": "varchar(9) null", "long": "char(70)", "d": "numeric(6,2)", "n": "numeric", "f": "double precision", "b": "bool", "at": "timestamptz", "day": "date", "j": "jsonb", "a": "_int4", "x": "text[]", "raw": "bytea", "odd": "some_type?"}
    made = lambda seed, parts=1: fake.rows(spark, columns, 400, "k", "int", seed).repartition(parts).orderBy("k")
    r = made(3).persist()
    assert made(3, 4).collect() == r.collect() and made(4).collect() != r.collect()
    assert r.select("k").distinct().count() == 400 and r.filter("k < 0").count() > 50
    good = (
        "small BETWEEN -32768 AND 32767 AND u RLIKE '^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$' AND (t IS NULL OR length(t) <= 9) AND length(long) BETWEEN 33 AND 70 AND abs(d) < 10000 AND "
        "b IS NOT NULL AND to_timestamp(at) IS NOT NULL AND to_date(day) IS NOT NULL AND get_json_object(j, '$.n') IS NOT NULL AND size(a) <= 3 AND size(x) <= 3 AND length(raw) = 16 AND odd IS NOT NULL AND f IS NOT NULL AND n IS NOT NULL"
    )
    assert r.filter(good).count() == 400 and 20 < r.filter("t IS NULL").count() < 90 and r.filter("small < -16384").count() > 50
    assert dict(r.dtypes)["a"] == "array<bigint>" or dict(r.dtypes)["a"] == "array<int>"


def test_log_between(spark, data):
    log = changelog.log_of_events(spark.read.parquet(f"{data}/events.parquet"))
    assert changelog.between(log, 10, 20).count() == 10


def test_log_as_json(spark, data, tmp_path):
    log = changelog.log_of_events(spark.read.parquet(f"{data}/events.parquet"))
    changelog.write_log(log, str(tmp_path), 2, "json")
    back = changelog.read_log(spark, str(tmp_path), log.schema["new"].dataType, form="json")
    assert back.exceptAll(log).count() == 0 and back.count() == log.count()


def test_polled_messages(spark):
    import json

    new = {"kind": "insert", "schema": "public", "table": "users", "columnnames": ["id", "note"], "columnvalues": [1, None]}
    gone = {"kind": "delete", "schema": "public", "table": "users", "oldkeys": {"keynames": ["id"], "keyvalues": ["x"]}}
    rows = [(5, json.dumps({"xid": 3, "change": [new, gone, {"kind": "truncate"}]})), (6, "not json"), (7, json.dumps({"xid": 4, "change": []}))]
    got = changelog.polled_events(spark.createDataFrame(rows, "lsn long, data string")).orderBy("lsn", "seq").collect()
    assert [(r.op, r.lsn, r.seq, r.txid, r.new, r.old) for r in got] == [("insert", 5, 0, 3, {"id": "1", "note": "null"}, None), ("delete", 5, 1, 3, None, {"id": '"x"'})]


def test_cut_to_tokens():
    from changeflow.operators.transform import cut_to_tokens

    assert cut_to_tokens("a b c", 2, str.split, " ".join) == "a b" and cut_to_tokens("a  b", 2, str.split, " ".join) == "a  b"
