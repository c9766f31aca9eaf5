"""Golden cases of routing, ids, documents, transforms, batches."""

import json

import pytest
from pyspark.sql import functions as F


from changeflow.functions import ids, text
from changeflow.model import Batching, ConfigError, Mapping, Membership, event_schema
from changeflow.operators import batch, merge, project, route, transform

from .helpers import struct

USER = struct("id long, name string, email string, status string")


def events(spark, rows, schema=USER):
    made = []
    for i, r in enumerate(rows):
        side = lambda k, r=r: tuple(r[k].get(f) for f in schema.names) if r.get(k) is not None else None
        made.append((r["op"], "public", r.get("table", "users"), side("new"), side("old"), r.get("lsn", 100 + i), i, r.get("txid", 1), r.get("missing", [])))
    return spark.createDataFrame(made, event_schema(schema))


def mapping(**more):
    return Mapping(**({"name": "users_public", "namespace": "users", "schema": "public", "table": "users", "id_column": "id"} | more))


def acted(df, m):
    return project.identity_actions(route.route(df, [m]), m).orderBy("lsn", "seq").collect()


def test_basic_insert(spark):
    row = {"id": 1, "name": "Alice", "email": "alice@example.com"}
    (found,) = acted(events(spark, [{"op": "insert", "new": row}]), mapping(columns=("id", "name", "email")))
    assert (found.type, found.id.kind, int(found.id.number), json.loads(found.doc)) == ("upsert", "uint", 1, row)


def test_membership(spark):
    rows = [{"op": "insert", "new": {"id": i, "name": n, "status": s}} for i, n, s in ((1, "Alice", "active"), (2, "Bob", "inactive"), (3, "Charlie", "active"))]
    m = mapping(columns=("id", "name", "status"), membership=Membership("dsl", "status = 'active'"))
    assert [int(a.id.number) for a in acted(events(spark, rows), m)] == [1, 3]


def test_images(spark):
    m = mapping(membership=Membership("dsl", "status = 'active'"))
    rows = [
        {"op": "update", "new": {"id": 1, "status": "gone"}, "old": {"id": 1, "status": "active"}},  # leaves: nothing
        {"op": "delete", "old": {"id": 2}},  # key only: the predicate fails
        {"op": "delete", "old": {"id": 3, "status": "active"}},
        {"op": "delete"}, {"op": "insert"},
        {"op": "insert", "table": "posts", "new": {"id": 4, "status": "active"}},
    ]
    df = events(spark, rows)
    assert [(a.type, a.id.text) for a in acted(df, m)] == [("delete", "3")]
    assert [(a.type, a.error_message) for a in acted(df, mapping())] == [("upsert", None), ("delete", None), ("delete", None), ("error", "MissingId"), ("error", "MissingId")]
    assert route.route(df, []).count() == 0
    left = merge.exit_deletes(df, "old.status <=> 'active'", "new.status <=> 'active'").collect()
    assert [(x.op, x.old.id) for x in left] == [("delete", 1)]


def test_two_mappings_one_pass(spark):
    a = mapping(name="a", membership=Membership("dsl", "status = 'active'"))
    b = mapping(name="b", namespace="other", membership=Membership("dsl", "email IS NULL"))
    df = events(spark, [{"op": "insert", "new": {"id": 1, "status": "active"}}, {"op": "insert", "new": {"id": 2, "status": "x", "email": "e"}}, {"op": "insert", "new": {"id": 3, "status": "active", "email": "e"}}])
    assert sorted((r.mapping, r.namespace, r.new.id) for r in route.route(df, [a, b]).collect()) == [("a", "users", 1), ("a", "users", 3), ("b", "other", 1)]


def test_missing_columns(spark):
    m = mapping(columns=("id", "name", "nothing"))
    rows = [{"op": "update", "new": {"id": 1}, "missing": ["name"]}, {"op": "update", "new": {"id": 1}}, {"op": "update", "new": {}, "missing": ["id"]}]
    found = acted(events(spark, rows), m)
    assert [f.doc for f in found] == ['{"id":1}', '{"id":1,"name":null}', None]
    assert found[2].error_kind == "missing_column"


def test_document_values(spark):
    row = struct("id long, f double, d decimal, t timestamp_ntz, a array<float>, b boolean")
    import datetime
    from decimal import Decimal

    df = events(spark, [{"op": "insert", "new": {"id": 1, "f": float("nan"), "d": Decimal("1.50"), "t": datetime.datetime(2020, 1, 2), "a": [1.5], "b": True}}], row)
    (found,) = acted(df, mapping())
    assert json.loads(found.doc) == {"id": 1, "f": None, "d": 1.5, "t": "2020-01-02 00:00:00", "a": [1.5], "b": True}


def test_transform_contract(spark):
    df = events(spark, [{"op": "insert", "new": {"id": i, "name": "n"}} for i in range(1, 5)] + [{"op": "delete", "old": {"id": 9}}])
    m = mapping()

    def good(rows, context):
        kinds = {1: {"type": "skip"}, 2: {"type": "delete", "id": 42}, 3: {"type": "upsert", "id": "abc-123", "doc": {"v": [1.5, float("nan")]}, "distance_metric": "other"}, 4: {"type": "upsert", "id": "0" * 8 + "-" + "0" * 27, "doc": {}, "distance_metric": "euclidean_squared"}}
        return [kinds.get(r["id"], {"type": "delete"}) for r in rows]

    out = transform.transform_actions(df, m, good).orderBy("lsn").collect()
    assert [(a.type, a.id.kind, a.id.text) for a in out] == [("skip", "uint", "1"), ("delete", "uint", "42"), ("upsert", "string", "abc-123"), ("upsert", "uuid", "0" * 8 + "-" + "0" * 27), ("delete", "uint", "9")]
    assert json.loads(out[2].doc) == {"v": [1.5, None]} and out[2].distance_metric is None and out[3].distance_metric == "euclidean_squared"
    for bad in (lambda r, c: r[:1], lambda r, c: 1 / 0, lambda r, c: [{"type": "upsert"}] * len(r), lambda r, c: ["x"] * len(r), lambda r, c: [{"type": "what"}] * len(r)):
        failed = transform.transform_actions(df, m, bad).collect()
        assert len(failed) == 5 and {(a.type, a.error_kind) for a in failed} == {("error", "transform_failed")}
    assert transform.Context(tables={"t": {1: "x"}}).lookup("t", 1) == "x"


def test_transform_file(spark, tmp_path):
    (tmp_path / "t.py").write_text("def mine(rows, ctx):\n    return [{'type': 'upsert', 'doc': {'m': ctx.mapping}} for r in rows]\n")
    f = transform.load(str(tmp_path / "t.py"), "mine")
    assert f([{}], transform.Context("x")) == [{"type": "upsert", "doc": {"m": "x"}}]
    with pytest.raises(transform.TransformError):
        transform.load(str(tmp_path / "t.py"))
    assert transform.row_wise(lambda r, c: r)([1, 2], None) == [1, 2]


def test_packing(spark):
    sizes = [3, 3, 5, 9, 1, 1]
    df = spark.createDataFrame([("a", i, s) for i, s in enumerate(sizes)] + [("b", 0, 99)], "g string, i int, s long")
    limits = Batching(max_rows=2, max_bytes=8)
    for found in (batch.pack(df, ["g"], ["i"], F.col("s"), limits), batch.pack_groups(df, ["g"], ["i"], "s", limits)):
        assert [r.batch for r in found.orderBy("g", "i").collect()] == [0, 0, 1, 2, 3, 3, 0]
    with pytest.raises(ConfigError):
        Batching(max_rows=0)


def test_requests(spark):
    row = "namespace string, txid long, batch long, type string, id struct<text:string>, doc string, distance_metric string, lsn long, seq int"
    df = spark.createDataFrame([("n", 1, 0, "upsert", ("1",), "{}", None, 100, 0), ("n", 1, 0, "delete", ("2",), None, None, 101, 0), ("n", 1, 0, "upsert", ("3",), "{}", "cosine_distance", 102, 0), ("n", 1, 0, "skip", ("4",), None, None, 103, 0)], row)
    (r,) = batch.requests(df).collect()
    assert ([x.id for x in r.upserts], [x.id for x in r.deletes], r.lsn, r.distance_metric) == (["1", "3"], ["2"], 100, "cosine_distance")
    (c,) = batch.request_counts(df).collect()
    assert (c.n_upserts, c.n_deletes, c.lsn) == (2, 1, 100)
    sizes = df.select(batch.action_size(F.col("type"), F.col("doc")).alias("s")).collect()
    assert [x.s for x in sizes] == [2, 50, 2, 0]


def test_preserve_missing(spark):
    row = lambda v, doc, d=False: ("n", "uint", "1", v, d, doc, None)
    old = spark.createDataFrame([row(1, '{"a":"1","b":"2"}')], merge.STORED)
    new = spark.createDataFrame([row(2, '{"b":"3"}')], merge.STORED)
    assert json.loads(merge.merge(old, new).first().doc) == {"b": "3"}
    assert json.loads(merge.merge(old, new, preserve_missing=True).first().doc) == {"a": "1", "b": "3"}
    dead = spark.createDataFrame([row(5, None, True)], merge.STORED)
    assert merge.live(merge.merge(dead, new)).count() == 0
    assert merge.live(merge.merge(dead, new, versioned=False)).count() == 1


@pytest.mark.parametrize(
    ("values", "declared", "expected"),
    [
        (["1", "2"], "bigint", "uint"), (["-1", "2"], "integer", "int"), ([], "int8", "uint"), ([], "text", "string"), (["x"], "uuid", "uuid"), (["1", "2"], "text", "uint"),
        (["-1"], "text", "int"), (["550e8400-e29b-41d4-a716-446655440000"], "text", "uuid"), (["a", "1"], "text", "string"), (["1", "99999999999999999999"], "text", "string"),
    ],
)
def test_id_inference(spark, values, declared, expected):
    assert ids.infer_id_type(spark.createDataFrame([(v,) for v in values], "value string"), declared).first().id_type == expected


def test_text_helpers():
    env = {"A": "1"}
    assert text.resolve("x${A}${B}", env) == "x1" and text.resolve_required("${A}", env) == "1"
    with pytest.raises(KeyError, match="B, C"):
        text.resolve_required("${B}${C}${A}${B}", env)
    assert text.content_hash_of("a\r\nb") == text.content_hash_of("a\nb") != text.raw_hash_of("a\r\nb")
    assert text.quoted_table('pub"lic.users') == '"pub""lic"."users"' and text.table_parts("t") == ("public", "t")
    assert [text.duration_of(x) for x in (3.9, 62, 3723)] == ["3s", "1m2s", "1h2m3s"]
    assert text.sanitized_name("My New-Table é") == "my_newtable_é" and text.prefixed_name("n", None) == "n"
