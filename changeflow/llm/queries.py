"""The operators applied to the whole test tables, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, fitting, html_extract, licenses, mixing, ngram_join, quality_model, quality_rules, toxicity, vafile
from .store import read


def byte_bpe() -> str:
    """The path of the byte-level vocabulary; its package is on the machine, not in the repository."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.transcode(read(spark, sf_dir, "documents"), byte_bpe()))


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.link(read(spark, sf_dir, "conversations"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.judge(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html_extract.extract(read(spark, sf_dir, "pages"))
    return out.withColumn("n_chars", F.length("text").cast("long"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(read(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vafile.top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    held_out = lambda i: fitting.fold(i, 3) == 1
    out = quality_model.score(docs, labels, usable=lambda i: ~held_out(i))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    held_out = lambda i: fitting.fold(i, 5) == 0
    out = toxicity.score(docs, labels, usable=lambda i: ~held_out(i))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_bpe, op2_chat_formatting, op3_quality_rules, op4_license_scan, op5_html_extraction, op6_ngram_join, op7_mixing, op8_top_k, op9_quality_classifier, op10_toxicity)
}

OP3_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rn, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT rn, doc_id, source, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
win AS (SELECT rn, i, list_slice(ws, i, i + 7) AS g FROM (SELECT rn, ws, unnest(range(1, len(ws) - 6)) AS i FROM w)),
twice AS (SELECT rn, i FROM (SELECT rn, i, count(*) OVER (PARTITION BY rn, g) AS n FROM win) WHERE n > 1),
steps AS (SELECT rn, least(8, coalesce(lead(i) OVER (PARTITION BY rn ORDER BY i) - i, 8)) AS step FROM twice),
rep AS (SELECT rn, sum(step) AS n FROM steps GROUP BY rn),
base AS (SELECT doc_id, source, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
        FROM w LEFT JOIN rep USING (rn)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM base),
hosts AS (SELECT source, count(*) AS n, sum(base_failed::INT) AS f FROM b GROUP BY source),
mv AS (SELECT avg(f / n) AS m, var_pop(f / n) AS v FROM hosts),
prior AS (SELECT m, CASE WHEN v > 1e-12 AND m * (1 - m) / v - 1 > 0 THEN m * (1 - m) / v - 1 ELSE 1.0 END AS k FROM mv),
verdict AS (SELECT source, (f + k * m) / (n + k) > 0.5 AS rejected FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT rejected AS kept
FROM b JOIN verdict v ON b.source IS NOT DISTINCT FROM v.source"""

OP6_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM shared JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 75 * (p.n + q.n - c)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT reach.x, edges.y FROM reach JOIN edges ON reach.y = edges.x)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id FROM d LEFT JOIN n USING (doc_id)
JOIN (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x) c USING (doc_id)"""

OP7_SQL = r"""
WITH d AS (SELECT doc_id, source, CAST(len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
o AS (SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w FROM s),
r AS (SELECT *, row_number() OVER (ORDER BY 2 * source_size / w, source NULLS LAST) AS k FROM o),
c AS (SELECT *, (1.5 * sum(source_size) OVER () - coalesce(sum(2 * source_size) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
        / (sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS level FROM r),
l AS (SELECT level FROM c WHERE level < 2 * source_size / w ORDER BY k LIMIT 1),
t AS (SELECT source, source_size, least((2 * source_size)::DOUBLE, (SELECT level FROM l) * w) AS target FROM r),
e AS (SELECT d.*, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole,
        coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY md5(coalesce(doc_id::VARCHAR, '')), doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  CAST(whole * size + least(size, greatest(0, floor(target)::BIGINT - whole * source_size - before)) AS BIGINT) AS taken FROM e"""

OP8_SQL = r"""
WITH v AS (SELECT row_number() OVER () AS rn, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.rn, c.vec_id, max(list_inner_product(q.v, c.v)::BIGINT) AS score FROM (SELECT DISTINCT vec_id, v FROM v WHERE vec_id % 20 = 0) q
  JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) GROUP BY ALL),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 20"""

ORACLES: dict[str, str] = {"op2_chat_formatting": chat.oracle(), "op3_quality_rules": OP3_SQL, "op4_license_scan": licenses.oracle(), "op6_ngram_join": OP6_SQL, "op7_mixing": OP7_SQL, "op8_top_k": OP8_SQL}
