"""The engine's queries over the test tables, each with the SQL that checks it.

``QUERIES`` maps a name to a function (spark, folder) -> DataFrame; ``ORACLES``
maps names to SQL over the same tables.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import ids, lsn, text, values
from ..model import Batching, Mapping, Membership, Versioning
from ..operators import batch, merge, predicate, project, route, transform
from ..sources import changelog, fake, pgoutput, replication, scan
from ..streaming import namespace, run
from . import migrations, state

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def log(spark: SparkSession, folder: str) -> DataFrame:
    return changelog.log_of_events(table(spark, folder, "events"))


#: The change log that ``changelog.log_of_events`` makes, in SQL.
LOG = """log AS (SELECT CASE event_type WHEN 'signup' THEN 'insert' WHEN 'error' THEN 'delete' ELSE 'update' END AS op, event_id + 1 AS lsn,
  (event_id % 10)::INT AS seq, event_id // 10 AS txid, user_id, CASE WHEN event_type <> 'error' THEN event_type END AS event_type,
  CASE WHEN event_type <> 'error' THEN value END AS value, CASE WHEN event_type <> 'error' THEN json_extract_string(props, '$.k')::BIGINT END AS k FROM events)"""

ORDERS = Mapping("open_orders", "orders_ns", "public", "orders", "o_orderkey", columns=("o_orderkey", "o_orderstatus", "o_totalprice"), membership=Membership("dsl", "o_orderstatus = 'O' AND o_orderpriority != '5-LOW'"))
USERS = Mapping("users", "users_ns", "public", "users", "user_id", columns=("user_id", "event_type", "value"))
BUYERS = Mapping("buyers", "buyers_ns", "public", "users", "user_id", membership=Membership("dsl", "event_type = 'purchase'"))
VIEWERS = Mapping("viewers", "viewers_ns", "public", "users", "user_id", membership=Membership("dsl", "event_type = 'view' OR event_type = 'click'"))
OTHERS = Mapping("posts", "posts_ns", "public", "posts", "user_id")


# Filters and predicates


@query("""SELECT o_orderkey::BIGINT AS id, o_orderstatus, o_totalprice, 'orders_ns' AS namespace FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority <> '5-LOW'""")
def flagship_orders(spark: SparkSession, folder: str) -> DataFrame:
    """A mapping with a predicate over a table scan: the documents of its namespace."""
    events = scan.scan(table(spark, folder, "orders"), Mapping(**{**ORDERS.__dict__, "columns": ()}))
    events = events.filter(route.belongs(ORDERS, events))
    made = project.identity_actions(events, ORDERS)
    doc = F.from_json("doc", "o_orderkey long, o_orderstatus string, o_totalprice double")
    return made.select(F.col("id.number").cast("long").alias("id"), doc["o_orderstatus"].alias("o_orderstatus"), doc["o_totalprice"].alias("o_totalprice"), "namespace")


PREDICATE = "l_returnflag = 'R' AND NOT (l_discount = 0.05 OR l_linenumber = 1) AND l_quantity != 10 AND l_shipdate IS NOT NULL"


@query("""SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_returnflag IS NOT DISTINCT FROM 'R'
  AND NOT (abs(l_discount - 0.05) < 2.220446049250313e-16 OR l_linenumber IS NOT DISTINCT FROM 1) AND l_quantity IS DISTINCT FROM 10.0 AND l_shipdate IS NOT NULL""")
def predicate_filter_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem")
    return rows.filter(predicate.compile(PREDICATE, rows.schema)).select("l_orderkey", "l_linenumber", "l_quantity")


NULL_TESTS = {
    "eq": "o_orderstatus = 'F'", "ne": "o_orderstatus != 'F'", "is_null": "o_orderstatus IS NULL", "not_null": "o_orderstatus IS NOT NULL",
    "eq_null": "o_orderstatus = NULL", "ne_null": "o_orderstatus != NULL", "negated": "NOT o_orderstatus = 'F'", "absent_null": "nothing IS NULL",
    "absent_eq": "nothing = 1", "absent_ne": "nothing != 1", "absent_eq_null": "nothing = NULL", "absent_ne_null": "nothing != NULL",
}


@query("""SELECT c_custkey, o_orderkey, o_orderstatus IS NOT DISTINCT FROM 'F' AS eq, o_orderstatus IS DISTINCT FROM 'F' AS ne, o_orderstatus IS NULL AS is_null,
  o_orderstatus IS NOT NULL AS not_null, o_orderstatus IS NULL AS eq_null, o_orderstatus IS NOT NULL AS ne_null, o_orderstatus IS DISTINCT FROM 'F' AS negated,
  true AS absent_null, false AS absent_eq, true AS absent_ne, false AS absent_eq_null, true AS absent_ne_null FROM customer LEFT JOIN orders ON c_custkey = o_custkey""")
def predicate_null_semantics(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "customer").join(table(spark, folder, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left")
    return rows.select("c_custkey", "o_orderkey", *[predicate.compile(p, rows.schema).alias(n) for n, p in NULL_TESTS.items()])


TYPE_TESTS = {
    "text_int": "o_orderstatus = 1", "text_int_ne": "o_orderstatus != 1", "int_text": "o_custkey = '7'", "int_float": "o_custkey = 7.0", "int_bool": "o_custkey = TRUE",
    "float_int": "o_totalprice = 1000", "date_text": "o_orderdate = '1995-01-01 00:00:00'", "date_int_ne": "o_orderdate != 19950101",
}


@query("""SELECT o_orderkey, false AS text_int, true AS text_int_ne, false AS int_text, o_custkey = 7 AS int_float, false AS int_bool,
  o_totalprice = 1000 AS float_int, o_orderdate = TIMESTAMP '1995-01-01' AS date_text, true AS date_int_ne FROM orders""")
def predicate_type_mismatch(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders")
    return rows.select("o_orderkey", *[predicate.compile(p, rows.schema).alias(n) for n, p in TYPE_TESTS.items()])


@query("SELECT count(*) AS n, count(*) FILTER (WHERE l_linestatus = 'O' OR l_linestatus = 'F' AND l_tax = 0) AS n_kept FROM lineitem")
def predicate_precedence(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem")
    test = predicate.compile("l_linestatus = 'O' OR l_linestatus = 'F' AND l_tax = 0", rows.schema)
    return rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(test).alias("n_kept"))


# Change log, routing, ids, documents


@query(f"WITH {LOG} SELECT op, lsn, seq, txid, user_id, event_type, value, k FROM log")
def changelog_events(spark: SparkSession, folder: str) -> DataFrame:
    row = route.image(log(spark, folder))
    return log(spark, folder).select("op", "lsn", "seq", "txid", *[row.getField(c).alias(c) for c in ("user_id", "event_type", "value", "k")])


@query(f"""WITH {LOG} SELECT mapping, namespace, lsn, op, user_id FROM (
  SELECT 'users' AS mapping, 'users_ns' AS namespace, * FROM log UNION ALL SELECT 'buyers', 'buyers_ns', * FROM log WHERE event_type IS NOT DISTINCT FROM 'purchase'
  UNION ALL SELECT 'viewers', 'viewers_ns', * FROM log WHERE event_type IN ('view', 'click'))""")
def route_multi_mapping(spark: SparkSession, folder: str) -> DataFrame:
    routed = route.route(log(spark, folder), [USERS, BUYERS, VIEWERS, OTHERS])
    return routed.select("mapping", "namespace", "lsn", "op", F.coalesce("new.user_id", "old.user_id").alias("user_id"))


@query(f"""WITH {LOG} SELECT user_id, lsn FROM log WHERE op = 'delete' AND user_id IS NOT DISTINCT FROM 7
  UNION ALL SELECT user_id, lsn FROM log WHERE op <> 'delete' AND user_id = 7 AND event_type IS DISTINCT FROM 'view'""")
def membership_delete_old_image(spark: SparkSession, folder: str) -> DataFrame:
    """Deletes are judged by their old image, which holds the key only."""
    m = Mapping("seven", "seven_ns", "public", "users", "user_id", membership=Membership("dsl", "user_id = 7 AND event_type != 'view'"))
    return route.route(log(spark, folder), [m]).select(F.coalesce("new.user_id", "old.user_id").alias("user_id"), "lsn")


@query("""SELECT e.event_id, e.event_type FROM events e WHERE e.user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000) AND e.event_type <> 'error'""")
def lookup_membership(spark: SparkSession, folder: str) -> DataFrame:
    events = log(spark, folder).filter("op <> 'delete'")
    members = table(spark, folder, "customer").filter("c_acctbal > 5000").withColumnRenamed("c_custkey", "user_id")
    found = route.lookup_members(events, USERS, members, "user_id")
    return found.select((F.col("lsn") - 1).alias("event_id"), F.col("new.event_type").alias("event_type"))


@query("""WITH rows AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 3 = 1 THEN c_custkey ELSE -c_custkey END AS num, CASE WHEN c_custkey % 5 > 0 THEN c_name END AS name, c_acctbal FROM customer)
  SELECT c_custkey, CASE WHEN num >= 0 THEN 'uint' END AS uint_kind, CASE WHEN num >= 0 THEN num::VARCHAR END AS uint_text, CASE WHEN num IS NULL OR num < 0 THEN 'InvalidIdType' END AS uint_error,
  CASE WHEN num IS NOT NULL THEN num::BIGINT END AS int_number, CASE WHEN num IS NULL THEN 'InvalidIdType' END AS int_error, name AS uuid_text, CASE WHEN name IS NULL THEN 'InvalidIdType' END AS uuid_error,
  num::VARCHAR AS string_text, 'InvalidIdType' AS float_error, 'MissingColumn' AS absent_error FROM rows""")
def extract_ids_and_errors(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    rows = table(spark, folder, "customer").select(
        key, F.when(key % 3 == 1, key).when(key % 3 == 2, -key).alias("num"), F.when(key % 5 > 0, F.col("c_name")).alias("name"), "c_acctbal"
    )
    there = F.lit(True)
    get = lambda c, kind: ids.extract_id(F.col(c), there, kind, rows.schema[c].dataType)
    uint, whole, uuid, string, number = get("num", "uint"), get("num", "int"), get("name", "uuid"), get("num", "string"), get("c_acctbal", "string")
    absent = ids.extract_id(F.lit(None), there, "uint", None)
    return rows.select(
        "c_custkey", uint[0]["kind"].alias("uint_kind"), uint[0]["text"].alias("uint_text"), uint[1].alias("uint_error"), whole[0]["number"].cast("long").alias("int_number"), whole[1].alias("int_error"),
        uuid[0]["text"].alias("uuid_text"), uuid[1].alias("uuid_error"), string[0]["text"].alias("string_text"), number[1].alias("float_error"), absent[1].alias("absent_error"),
    )


@query(f"WITH {LOG} SELECT lsn, CASE op WHEN 'delete' THEN 'delete' ELSE 'upsert' END AS type, user_id::VARCHAR AS id, event_type, value FROM log")
def identity_projection(spark: SparkSession, folder: str) -> DataFrame:
    made = project.identity_actions(log(spark, folder), USERS)
    doc = F.from_json("doc", "user_id long, event_type string, value double")
    return made.select("lsn", "type", F.col("id.text").alias("id"), doc["event_type"].alias("event_type"), doc["value"].alias("value"))


@query("""SELECT c_custkey, '{' || CASE WHEN c_custkey % 2 = 0 THEN '' ELSE '"c_mktsegment":"' || c_mktsegment || '",' END || '"c_custkey":' || c_custkey || '}' AS doc FROM customer""")
def unchanged_columns_left_out(spark: SparkSession, folder: str) -> DataFrame:
    """Columns that an update does not carry are not in its document."""
    rows = table(spark, folder, "customer").select("c_mktsegment", "c_custkey")
    m = Mapping("c", "c", "public", "customer", "c_custkey", columns=("c_mktsegment", "c_custkey"))
    gone = F.when(F.col("new.c_custkey") % 2 == 0, F.array(F.lit("c_mktsegment"))).otherwise(F.array().cast("array<string>"))
    events = changelog.inserts(rows, "public", "customer").withColumn("missing", gone)
    return project.identity_actions(events, m).select(F.col("id.number").cast("long").alias("c_custkey"), "doc")


@query(f"""WITH {LOG} SELECT lsn, user_id, '{{"event_type":"' || event_type || '","id":' || user_id || ',"__source_lsn":' || lsn || '}}' AS doc FROM log WHERE op <> 'delete'""")
def stamped_documents(spark: SparkSession, folder: str) -> DataFrame:
    m = Mapping("u", "u", "public", "users", "user_id", columns=("event_type",))
    made = project.identity_actions(log(spark, folder), m).filter("type = 'upsert'")
    return made.select("lsn", F.col("id.number").cast("long").alias("user_id"), batch.stamped(F.col("doc"), F.col("id"), F.col("lsn")).alias("doc"))


@query("""SELECT c_custkey, c_name || ' ' || c_mktsegment AS text, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""")
def lookup_join(spark: SparkSession, folder: str) -> DataFrame:
    """A dimension joined to events before the transform."""
    events = changelog.inserts(table(spark, folder, "customer"), "public", "customer")
    joined = transform.with_lookup(events, table(spark, folder, "nation"), "n_nationkey", "c_nationkey", "nation")
    return joined.select(F.col("new.c_custkey").alias("c_custkey"), text.present_joined(F.col("new.c_name"), F.col("new.c_mktsegment")).alias("text"), F.col("nation.n_name").alias("n_name"))


def compose(rows: list[dict], context) -> list[dict]:
    """A transform: name and segment as text, customers in debt are deleted."""
    out = []
    for row in rows:
        new = row["event"]["new"]
        if new["c_acctbal"] < 0:
            out.append({"type": "delete"})
        elif new["c_custkey"] % 10 == 0:
            out.append({"type": "skip"})
        else:
            out.append({"type": "upsert", "doc": {"text": " ".join(filter(None, [new["c_name"], new["c_mktsegment"]])), "mapping": context.mapping}, "distance_metric": "cosine_distance"})
    return out


@query("""SELECT c_custkey AS id, CASE WHEN c_acctbal < 0 THEN 'delete' WHEN c_custkey % 10 = 0 THEN 'skip' ELSE 'upsert' END AS type,
  CASE WHEN c_acctbal >= 0 AND c_custkey % 10 > 0 THEN c_name || ' ' || c_mktsegment END AS text, CASE WHEN c_acctbal >= 0 AND c_custkey % 10 > 0 THEN 'cosine_distance' END AS distance_metric FROM customer""")
def python_transform(spark: SparkSession, folder: str) -> DataFrame:
    m = Mapping("customers", "customers_ns", "public", "customer", "c_custkey")
    made = transform.transform_actions(changelog.inserts(table(spark, folder, "customer"), "public", "customer"), m, compose)
    return made.select(F.col("id.number").cast("long").alias("id"), "type", F.get_json_object("doc", "$.text").alias("text"), "distance_metric")


@query("SELECT vec_id, len(embedding)::INT AS n, embedding[1]::DOUBLE AS first, label::BIGINT AS label FROM embeddings WHERE label <> 3")
def vector_documents(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings").select("vec_id", F.col("embedding").alias("vector"), "label")
    m = Mapping("v", "v", "public", "embeddings", "vec_id", membership=Membership("dsl", "label != 3"))
    events = changelog.inserts(rows, "public", "embeddings")
    made = project.identity_actions(route.route(events, [m]), m)
    doc = F.from_json("doc", "vec_id long, vector array<float>, label long")
    return made.select(doc["vec_id"].alias("vec_id"), F.size(doc["vector"]).alias("n"), doc["vector"][0].cast("double").alias("first"), doc["label"].alias("label"))


# Net change and merge


@query(f"WITH {LOG} SELECT user_id::VARCHAR AS id, CASE arg_max(op, lsn) WHEN 'delete' THEN 'delete' ELSE 'upsert' END AS type, max(lsn) AS lsn FROM log GROUP BY user_id")
def net_change(spark: SparkSession, folder: str) -> DataFrame:
    last = merge.net_change(project.identity_actions(log(spark, folder), USERS))
    return last.select(F.col("id.text").alias("id"), "type", "lsn")


@query(f"WITH {LOG} SELECT user_id::VARCHAR AS id, max(lsn) AS version, arg_max(event_type, lsn) AS event_type FROM log GROUP BY user_id HAVING arg_max(op, lsn) <> 'delete'")
def snapshot_after_log(spark: SparkSession, folder: str) -> DataFrame:
    """The namespace after the log came in two parts, the later one first."""
    made = project.identity_actions(log(spark, folder), USERS)
    late, early = (merge.as_stored(merge.net_change(made.filter(c))) for c in ("lsn > 400", "lsn <= 400"))
    stored = merge.live(merge.merge(late, early))
    return stored.select("id", "version", F.get_json_object("doc", "$.event_type").alias("event_type"))


@query("""WITH s AS (SELECT o_orderkey, o_custkey % 7 AS version, o_orderstatus AS doc FROM orders WHERE o_orderstatus <> 'O'), i AS (SELECT o_orderkey, 3 AS version, 'new' AS doc FROM orders WHERE o_orderstatus <> 'F')
  SELECT coalesce(s.o_orderkey, i.o_orderkey)::VARCHAR AS id, CASE WHEN s.version IS NULL OR i.version > s.version THEN i.version ELSE s.version END::BIGINT AS version,
  CASE WHEN s.version IS NULL OR i.version > s.version THEN i.doc ELSE s.doc END AS doc FROM s FULL JOIN i USING (o_orderkey)""")
def versioned_merge(spark: SparkSession, folder: str) -> DataFrame:
    """Incoming rows replace stored ones only if they are strictly newer."""
    rows = table(spark, folder, "orders")

    def stored(df: DataFrame, version, doc) -> DataFrame:
        return df.select(F.lit("ns").alias("namespace"), F.lit("uint").alias("id_kind"), F.col("o_orderkey").cast("string").alias("id"), version.cast("long").alias("version"), F.lit(False).alias("deleted"), doc.alias("doc"), F.lit(None).cast("string").alias("distance_metric"))

    old = stored(rows.filter("o_orderstatus <> 'O'"), F.col("o_custkey") % 7, F.col("o_orderstatus"))
    new = stored(rows.filter("o_orderstatus <> 'F'"), F.lit(3), F.lit("new"))
    return merge.merge(old, new).select("id", "version", "doc")


@query(f"""WITH {LOG}, gone AS (SELECT user_id, max(lsn) AS lsn FROM log WHERE op = 'delete' GROUP BY user_id),
  behind AS (SELECT l.* FROM log l LEFT JOIN gone g USING (user_id) WHERE op <> 'delete' AND (g.lsn IS NULL OR l.lsn > g.lsn))
  SELECT user_id::VARCHAR AS id, max(k) AS version, first(event_type ORDER BY k DESC, lsn) AS event_type FROM behind GROUP BY user_id""")
def column_versions(spark: SparkSession, folder: str) -> DataFrame:
    """The namespace of a mapping whose versions are a column's values, after three batches: deletes
    count in the order of the log, and what comes behind one starts anew."""
    versioned = replace(USERS, name="versioned", columns=("event_type", "k"), versioning=Versioning("column", "k"))
    made = project.writes(project.identity_actions(log(spark, folder), versioned))
    parts = None
    for at, part in enumerate(("lsn <= 150", "lsn > 150 AND lsn <= 400", "lsn > 400")):
        ((rows, _),) = run.stored_changes(made.filter(part), [versioned])
        rows = rows.withColumn("arrived", F.lit(at).cast("long")).withColumn("versioned", F.lit(True))
        parts = rows if parts is None else parts.unionByName(rows)
    stored = merge.live(merge.best(parts, epochs=True))
    return stored.select("id", "version", F.get_json_object("doc", "$.event_type").alias("event_type"))


@query(f"WITH {LOG} SELECT count(DISTINCT user_id) AS n_ids, count(*) FILTER (WHERE op = 'delete') AS n_deletes FROM log")
def action_counts(spark: SparkSession, folder: str) -> DataFrame:
    made = project.writes(project.identity_actions(log(spark, folder), USERS))
    return made.agg(F.count_distinct("id.text").alias("n_ids"), F.count_if(F.col("type") == "delete").alias("n_deletes"))


# Batches


@query("SELECT o_orderkey, o_orderpriority, (row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) - 1) // 100 AS batch FROM orders")
def pack_rows(spark: SparkSession, folder: str) -> DataFrame:
    return batch.pack_rows(table(spark, folder, "orders"), ["o_orderpriority"], ["o_orderkey"], 100).select("o_orderkey", "o_orderpriority", "batch")


PACKING = """WITH RECURSIVE d AS (SELECT doc_id, source, n_chars AS size, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents),
p AS (SELECT doc_id, source, rn, 0::BIGINT AS batch, 1::BIGINT AS n, size::BIGINT AS bytes FROM d WHERE rn = 1 UNION ALL
  SELECT d.doc_id, d.source, d.rn, CASE WHEN p.n >= 5 OR p.bytes + d.size > 8000 THEN p.batch + 1 ELSE p.batch END,
  CASE WHEN p.n >= 5 OR p.bytes + d.size > 8000 THEN 1 ELSE p.n + 1 END, CASE WHEN p.n >= 5 OR p.bytes + d.size > 8000 THEN d.size ELSE p.bytes + d.size END
  FROM p JOIN d ON d.source = p.source AND d.rn = p.rn + 1) SELECT doc_id, source, batch FROM p"""
LIMITS = Batching(max_rows=5, max_bytes=8000)


@query(PACKING)
def pack_rows_bytes(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").select("doc_id", "source", "n_chars")
    return batch.pack(rows, ["source"], ["doc_id"], F.col("n_chars"), LIMITS).select("doc_id", "source", "batch")


@query(PACKING)
def pack_groups_streamed(spark: SparkSession, folder: str) -> DataFrame:
    """The same cuts for groups of any size."""
    rows = table(spark, folder, "documents").select("doc_id", "source", "n_chars")
    return batch.pack_groups(rows, ["source"], ["doc_id"], "n_chars", LIMITS).select("doc_id", "source", "batch")


BATCHES = f"""{LOG}, packed AS (SELECT *, (row_number() OVER (PARTITION BY txid ORDER BY lsn, seq) - 1) // 4 AS batch FROM log)"""


def _packed(spark: SparkSession, folder: str) -> DataFrame:
    return batch.pack_rows(project.identity_actions(log(spark, folder), USERS), ["namespace", "txid"], ["lsn", "seq"], 4)


@query(f"WITH {BATCHES} SELECT txid, batch, count(*) FILTER (WHERE op <> 'delete') AS n_upserts, count(*) FILTER (WHERE op = 'delete') AS n_deletes, min(lsn) AS lsn FROM packed GROUP BY txid, batch")
def batch_requests(spark: SparkSession, folder: str) -> DataFrame:
    requests = batch.requests(_packed(spark, folder))
    return requests.select("txid", "batch", F.size("upserts").cast("long").alias("n_upserts"), F.size("deletes").cast("long").alias("n_deletes"), "lsn")


@query(f"""WITH {BATCHES}, p AS (SELECT *, row_number() OVER (PARTITION BY txid, batch, op = 'delete' ORDER BY lsn, seq) AS rn FROM packed)
  SELECT txid, batch, lsn, CASE WHEN op = 'delete' THEN 0 ELSE (rn - 1) // 2 END AS chunk FROM p""")
def upload_chunks(spark: SparkSession, folder: str) -> DataFrame:
    return batch.chunks(_packed(spark, folder), ["namespace", "txid", "batch"], 2).select("txid", "batch", "lsn", "chunk")


@query("""SELECT doc_id, strlen('{"doc_id":' || doc_id || ',"lang":"' || lang || '"}') AS size, 50::BIGINT AS delete_size FROM documents""")
def doc_size(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents")
    doc = values.document([("doc_id", F.col("doc_id")), ("lang", F.col("lang"))])
    return rows.select("doc_id", batch.action_size(F.lit("upsert"), doc).alias("size"), batch.action_size(F.lit("delete"), F.lit(None).cast("string")).alias("delete_size"))


# Scans


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey > 1000 ORDER BY l_orderkey, l_linenumber, l_quantity LIMIT 500")
def keyset_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return scan.page(rows, ["l_orderkey", "l_linenumber", "l_quantity"], after=[1000], size=500)


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey > 999 ORDER BY o_orderkey LIMIT 1000")
def keyset_page(spark: SparkSession, folder: str) -> DataFrame:
    return scan.page(table(spark, folder, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", after=999, size=1000)


@query("SELECT l_orderkey::VARCHAR AS id, l_quantity, l_returnflag FROM lineitem")
def backfill_documents(spark: SparkSession, folder: str) -> DataFrame:
    m = Mapping("lines", "lines_ns", "public", "lineitem", "l_orderkey", columns=("l_quantity", "l_returnflag"))
    made = project.identity_actions(scan.scan(table(spark, folder, "lineitem"), m), m)
    doc = F.from_json("doc", "l_quantity double, l_returnflag string")
    return made.select(F.col("id.text").alias("id"), doc["l_quantity"].alias("l_quantity"), doc["l_returnflag"].alias("l_returnflag"))


@query("SELECT c_custkey FROM customer WHERE c_custkey > 100")
def resumed_scan(spark: SparkSession, folder: str) -> DataFrame:
    m = Mapping("c", "c", "public", "customer", "c_custkey", columns=("c_custkey",))
    return scan.scan(table(spark, folder, "customer"), m, after="100").select(F.col("new.c_custkey").alias("c_custkey"))


@query("SELECT namespace, id, doc FROM (SELECT 'users_ns' AS namespace, c_custkey AS id, c_name AS doc FROM customer) ORDER BY id LIMIT 20")
def readback_topk(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "customer").select(F.lit("users_ns").alias("namespace"), F.lit("uint").alias("id_kind"), F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("doc"))
    return namespace.first_documents(rows, 20).select("namespace", F.col("id").cast("long").alias("id"), "doc")


@query()
def fake_rows(spark: SparkSession, folder: str) -> DataFrame:
    return fake.rows(spark, {"key": "bigint", "small": "smallint", "code": "varchar(12)", "note": "text null", "weight": "numeric(10,2)", "made": "timestamptz", "flag": "boolean", "parts": "uuid[]"}, 1000, "key", "uint", seed=7)


# The server's messages


def _messages(frames: Iterator) -> Iterator:
    """Events as the server's messages, one transaction per ten events."""
    import pandas as pd

    def cell(x) -> bytes:
        if x is None or x != x:
            return b"n"
        raw = str(x).encode()
        return b"t" + struct.pack(">i", len(raw)) + raw

    relation = b"R" + struct.pack(">I", 1) + b"public\0users\0d" + struct.pack(">h", 3)
    for flags, name, oid in ((1, b"user_id", 20), (0, b"event_type", 25), (0, b"value", 701)):
        relation += struct.pack(">B", flags) + name + b"\0" + struct.pack(">Ii", oid, -1)
    for pdf in frames:
        out = []
        for r in pdf.itertuples(index=False):
            at = int(r.event_id) + 1
            if r.event_id % 10 == 0:
                out.append((at, -2, b"B" + struct.pack(">QqI", r.event_id // 10 + 1, int(r.event_id) * 1000, int(r.event_id // 10))))
            if r.event_id == 0:
                out.append((at, -1, relation))
            full = struct.pack(">h", 3) + cell(int(r.user_id)) + cell(r.event_type) + cell(repr(float(r.value)))
            key = struct.pack(">h", 3) + cell(int(r.user_id)) + b"n" + b"n"
            before = b"K" + key if r.event_type == "click" else b""  # some updates send what they replace
            body = {"signup": b"I" + struct.pack(">I", 1) + b"N" + full, "error": b"D" + struct.pack(">I", 1) + b"K" + key}.get(r.event_type, b"U" + struct.pack(">I", 1) + before + b"N" + full)
            out.append((at, int(r.event_id % 10), body))
            if r.event_id % 10 == 9:
                out.append((at, 10, b"C" + struct.pack(">BQQq", 0, r.event_id // 10 + 1, at, int(r.event_id) * 1000)))
        out.append((10**12 + int(pdf.event_id.min()), 0, b"?"))  # no message at all
        yield pd.DataFrame(out, columns=["lsn", "seq", "data"])


@query(f"WITH {LOG} SELECT op, lsn, seq, txid, user_id, event_type, value, CASE WHEN op = 'delete' OR event_type = 'click' THEN user_id END AS old_user FROM log WHERE txid < (SELECT count(*) // 10 FROM events)")
def replication_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Encoded, decoded, put into transactions and typed; an open transaction is left out."""
    messages = table(spark, folder, "events").select("event_id", "user_id", "event_type", "value").repartition(F.floor(F.col("event_id") / 1000)).mapInPandas(_messages, "lsn long, seq int, data binary")
    rows = pgoutput.as_rows(pgoutput.events_of(messages), "public", "users", T._parse_datatype_string("user_id long, event_type string, value double"))
    row = F.coalesce("new", "old")
    return rows.select("op", "lsn", "seq", "txid", *[row.getField(c).alias(c) for c in ("user_id", "event_type", "value")], F.col("old.user_id").alias("old_user"))


@query("""SELECT event_id, 'int' AS k20, CASE event_type WHEN 'view' THEN true ELSE false END AS as_bool, user_id AS as_int, value AS as_float, NULL::BIGINT AS not_int FROM events""")
def typed_texts(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events")
    flag = F.when(F.col("event_type") == "view", "t").otherwise("f")
    return rows.select(
        "event_id", values.kind_of_oid(F.lit(20)).alias("k20"), values.typed(flag, "bool").alias("as_bool"), values.typed(F.col("user_id").cast("string"), "int").alias("as_int"),
        values.typed(F.col("value").cast("string"), "float").alias("as_float"), values.typed(F.col("event_type"), "int").alias("not_int"),
    )


# Scalar functions


@query("SELECT event_id, printf('%X/%X', (event_id * 1000003) >> 32, (event_id * 1000003) & 4294967295) AS shown, event_id * 1000003 AS back FROM events")
def lsn_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    n = F.col("event_id") * 1000003
    return table(spark, folder, "events").select("event_id", lsn.format_lsn(n).alias("shown"), lsn.parse_lsn(lsn.format_lsn(n)).alias("back"))


@query("SELECT event_id, strftime(make_timestamp(event_id * 86400123 + 946684800000000), '%Y-%m-%dT%H:%M:%S.%fZ') AS shown FROM events")
def server_timestamps(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select("event_id", lsn.server_timestamp(F.col("event_id") * 86400123).alias("shown"))


@query("SELECT doc_id, sha256(replace(text, chr(13) || chr(10), chr(10))) AS hash FROM documents")
def content_hash(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", text.content_hash(F.col("text")).alias("hash"))


@query("""SELECT p_partkey, CASE WHEN length(p_name) > 10 THEN left(p_name, 7) || '...' ELSE p_name END AS short, regexp_replace(regexp_replace(lower(p_type), '\\s', '_', 'g'), '[^a-z0-9_]', '', 'g') AS clean,
  p_name || ' ' || p_brand AS joined, 'dev_' || p_brand AS namespace, CASE WHEN p_size >= 60 THEN (p_size // 60) || 'h' || (p_size % 60) || 'm' || 7 || 's' WHEN p_size > 0 THEN p_size || 'm' || 7 || 's' ELSE '7s' END AS duration FROM part""")
def text_functions(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        "p_partkey", text.truncated(F.col("p_name"), 10).alias("short"), text.sanitized(F.col("p_type")).alias("clean"), text.present_joined(F.col("p_name"), F.lit(""), F.lit(None), F.col("p_brand")).alias("joined"),
        text.prefixed(F.col("p_brand"), "dev").alias("namespace"), text.duration(F.col("p_size") * 60 + 7.5).alias("duration"),
    )


@query("""SELECT c_custkey, 'uint' AS number_kind, CASE WHEN c_custkey % 2 = 0 THEN 'uuid' ELSE 'string' END AS text_kind, c_custkey::BIGINT AS unsigned FROM customer""")
def returned_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Ids that transforms return."""
    key = F.col("c_custkey")
    number = ids.id_of_number(key, ids.id_of_text(F.lit("x")))
    uuid = F.when(key % 2 == 0, F.concat(F.lit("00000000-0000-0000-0000-"), F.lpad(key.cast("string"), 12, "0"))).otherwise(F.col("c_name"))
    return table(spark, folder, "customer").select("c_custkey", number["kind"].alias("number_kind"), ids.id_of_text(uuid)["kind"].alias("text_kind"), ids.as_unsigned(number).cast("long").alias("unsigned"))


# State


@query(f"WITH {LOG}, c AS (SELECT 'users' AS mapping, max(lsn) AS lsn FROM log UNION ALL SELECT 'buyers', max(lsn) FROM log WHERE event_type = 'purchase') SELECT min(lsn) AS lsn FROM c")
def checkpoint_min(spark: SparkSession, folder: str) -> DataFrame:
    routed = route.route(log(spark, folder), [USERS, BUYERS])
    return state.min_checkpoint(routed.groupBy("mapping").agg(F.max("lsn").alias("lsn")))


KINDS = ["missing_column", "timeout", "network_error", "rate_limited", "no_such_kind"]


@query("""WITH e AS (SELECT event_id, ['missing_column', 'timeout', 'network_error', 'rate_limited', 'no_such_kind'][(event_id % 5 + 1)::INT] AS kind FROM events)
  SELECT CASE kind WHEN 'no_such_kind' THEN 'unknown' ELSE kind END AS error_kind, kind IN ('timeout', 'network_error', 'rate_limited') AS retryable, count(*) AS n FROM e GROUP BY 1, 2""")
def dlq_summary(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.element_at(F.array(*map(F.lit, KINDS)), (F.col("event_id") % 5 + 1).cast("int"))
    entries = table(spark, folder, "events").select("event_id", kind.alias("error_kind"))
    return state.with_error_facts(entries).groupBy("error_kind", "retryable").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_id, event_type FROM events WHERE event_type = 'error' ORDER BY ts DESC, event_id LIMIT 50")
def dlq_newest(spark: SparkSession, folder: str) -> DataFrame:
    entries = table(spark, folder, "events").filter("event_type = 'error'").select(F.col("event_id").alias("id"), "event_type", F.col("ts").alias("created_at"))
    return state.newest(entries, 50).select(F.col("id").alias("event_id"), "event_type")


@query("""SELECT s_suppkey::INT AS version, s_name AS mapping_name, CASE WHEN s_acctbal < 0 THEN 'pending' WHEN s_nationkey < 12 THEN 'applied' ELSE 'mismatched' END AS state FROM supplier""")
def migration_status(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "supplier").select(F.col("s_suppkey").cast("int").alias("version"), F.col("s_name").alias("mapping_name"), F.sha2("s_name", 256).alias("content_hash"), "s_acctbal", "s_nationkey")
    applied = rows.filter("s_acctbal >= 0").withColumn("content_hash", F.when(F.col("s_nationkey") < 12, F.col("content_hash")).otherwise("changed"))
    return migrations.status(rows, applied)


@query("SELECT 'public.' || n_name AS name FROM nation WHERE n_regionkey <> 1 UNION SELECT 'public.' || r_name FROM region")
def missing_tables(spark: SparkSession, folder: str) -> DataFrame:
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    required = nation.select(F.col("n_name").alias("name")).unionByName(region.select(F.concat(F.lit("public."), "r_name").alias("name")))
    current = nation.filter("n_regionkey = 1").select(F.concat(F.lit("public."), "n_name").alias("name"))
    return replication.missing_tables_of(required, current)


@query("SELECT DISTINCT 'ns_' || source AS namespace FROM documents")
def distinct_namespaces(spark: SparkSession, folder: str) -> DataFrame:
    made = table(spark, folder, "documents").select(F.concat(F.lit("ns_"), "source").alias("namespace"))
    return namespace.distinct_namespaces(made)


@query("SELECT n_name AS path FROM nation WHERE n_nationkey NOT IN (SELECT c_nationkey FROM customer WHERE c_acctbal > 9900)")
def unreferenced_transforms(spark: SparkSession, folder: str) -> DataFrame:
    nation = table(spark, folder, "nation")
    used = table(spark, folder, "customer").filter("c_acctbal > 9900").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("path"))
    return migrations.unreferenced(nation.select(F.col("n_name").alias("path")), used)


@query("""SELECT 'uint' AS declared_int, CASE WHEN min(c_acctbal::INT) >= 0 THEN 'uint' ELSE 'int' END AS undeclared, 'string' AS names, true AS matches_uint, false AS names_match_int FROM customer""")
def id_type_inference(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "customer")
    keys, whole, names = (rows.select(c.cast("string").alias("value")) for c in (F.col("c_custkey"), F.round("c_acctbal").cast("int"), F.col("c_name")))
    one = ids.infer_id_type(keys, "bigint").withColumnRenamed("id_type", "declared_int").withColumn("j", F.lit(1))
    for df, name in (
        (ids.infer_id_type(whole, "text"), "undeclared"), (ids.infer_id_type(names, "text"), "names"), (ids.values_match(keys, "bigint", "uint"), "matches_uint"), (ids.values_match(names, "text", "int"), "names_match_int"),
    ):
        one = one.join(df.toDF(name).withColumn("j", F.lit(1)), "j")  # tables of one row each
    return one.drop("j")
