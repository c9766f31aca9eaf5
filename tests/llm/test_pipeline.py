"""The queries against their SQL, and the pipeline against its parts."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from changeflow.llm import ngram_join, quality_rules, queries, store

from ..test_catalogue import TABLES, plain


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_equals_sql(spark, data, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    ours, theirs = queries.QUERIES[name](spark, data).toPandas(), con.execute(queries.ORACLES[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert plain(ours) == plain(theirs)


def test_registered():
    names = set(entry.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 11)} and "pipeline" in names
    assert corpus_pipeline.ORACLE_SQL is None and 4 <= len(corpus_pipeline.STAGES) <= 5


def test_pipeline(spark, data, tmp_path):
    docs = first = spark.read.parquet(f"{data}/documents.parquet")
    columns = docs.columns
    seen = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        out = stage(spark, docs, data)
        if i < 4:
            assert out.columns == columns
        out.write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        seen.append((before, docs))
    # rules: exactly what is judged good
    good = {r.doc_id for r in quality_rules.judge(first).filter("kept").collect()}
    assert {r.doc_id for r in seen[0][1].collect()} == good
    # copies: one of each component
    found = ngram_join.join(seen[2][0])
    assert seen[2][1].count() == found.select("component_id").distinct().count() == seen[2][1].join(found, "doc_id").select("component_id").distinct().count()
    # mixing: whole documents, at most twice
    texts = {r.doc_id: r.text for r in seen[3][0].collect()}
    mixed = seen[3][1].collect()
    assert all(texts[r.doc_id] == r.text for r in mixed) and seen[3][1].groupBy("doc_id").count().agg(F.max("count")).first()[0] == 2
    # encoding: a row per document, decoded as it was
    import hashlib

    last = seen[4][1].collect()
    assert len(last) == len(mixed) and all(r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() and r.n_tokens == len(r.ids) for r in last)
    ran = corpus_pipeline.run(spark, data)
    assert sorted((r.doc_id, r.ids_sha256) for r in ran.collect()) == sorted((r.doc_id, r.ids_sha256) for r in last)
    # only the last table is left
    folder = os.path.dirname(os.path.dirname(ran.inputFiles()[0].removeprefix("file://")))
    assert [n for n in os.listdir(folder) if not n.startswith(".")] == ["bpe"]


def test_tables_are_dropped(spark):
    keep = store.Scratch(spark, "keep")
    with store.dropped():
        inner = store.Scratch(spark, "inner")
        kept = keep.save(inner.save(spark.range(9).toDF("x"), "a").filter("x > 3"), "b")
        with pytest.raises(ZeroDivisionError), store.dropped():
            deeper = store.Scratch(spark, "deeper")
            deeper.save(spark.range(1).toDF("x"), "c")
            1 / 0
        assert not os.path.exists(deeper.root.removeprefix("file://")) and os.path.exists(inner.path("a").removeprefix("file://"))
    assert kept.count() == 5 and not os.path.exists(inner.root.removeprefix("file://"))


def test_settings_stay(spark):
    """Nothing of the user's session is changed for good."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before, cleanup = spark.conf.get(key), spark.conf.get(store.CLEANUP)
    spark.conf.set(key, "64MB")
    store.Scratch(spark, "x").save(spark.range(1).toDF("x"), "a")
    assert spark.conf.get(key) == "64MB" and spark.conf.get(store.CLEANUP) == cleanup
    spark.conf.set(key, before)


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://host:7077"

        def getConf(self):  # noqa: N802
            return {}

    class Session:
        sparkContext = Context()  # noqa: N815
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        store.shared_folder(Session())


def test_stages_on_nothing(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, data).count() == 0
