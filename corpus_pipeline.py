"""A corpus pipeline of five stages over ``documents``.

Each stage works on what its predecessor kept; all but the last return the
columns of ``documents``.  Rules and classifier drop documents, the join keeps
one of each group of near copies, mixing drops and repeats whole documents,
and the last stage encodes every text: ``doc_id``, ``n_tokens``, ``ids`` and
the digests of ids and decoded text.

In every stage a null text counts as empty (and falls to the rules), a null
source is a source of its own, texts are read whole whatever their length, and
other columns than those a stage reads pass through.  Rows that repeat are near
copies of each other: the first stays.  Ties go to the smaller id.  An empty
table gives an empty result; labels that are missing or of one class only give
every text one score, their share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.llm import bpe, fitting, mixing, ngram_join, quality_model, quality_rules
from changeflow.llm.queries import byte_bpe
from changeflow.llm.store import Scratch, dropped, read

#: SQL can't train the classifier or merge by rank.
ORACLE_SQL = None


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither their text nor their host's rate of failures rejects."""
    return quality_rules.filter_documents(docs)


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts to be good; it learns
    from the labelled ones that the query on held-out rows learns from."""
    return quality_model.keep_good(docs, read(spark, sf_dir, "labels"), usable=lambda i: fitting.fold(i, 3) != 1)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return ngram_join.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the targets of their sources take them."""
    return mixing.mix_rows(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of ids and decoded text."""
    coded = bpe.transcode(docs, byte_bpe())
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality rules", rules), ("quality classifier", classifier), ("n-gram join", near_copies), ("mixing", mix), ("bpe", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage.  What a stage reads and what it writes
    besides its result is deleted when the result is written."""
    scratch = Scratch(spark, "pipeline")
    docs, before = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        table = name.replace(" ", "_")
        with dropped():
            docs = scratch.save(stage(spark, docs, sf_dir), table)
        if before:
            scratch.drop(before)
        before = table
    return docs
