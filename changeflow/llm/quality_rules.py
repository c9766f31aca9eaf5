r"""Host-level quality rules, in DataFrame expressions only.

Each document gets base figures and a base verdict; the failures are counted
by host, each host's failure rate is shrunk towards the rate of all hosts by
an empirical beta prior, and the verdict on the host is joined back to its
documents.

Words are runs of ``[^\x20\x09-\x0D]``.  A null text counts as empty: no
words, so it fails.  A text of any length is judged whole, in the memory of its
row.  A rate that equals the limit does not turn a host down.  A null host is a
host of its own.  Other columns of the
input are ignored, whatever their names; repeated rows are kept, each with its
figures.  An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import Scratch

BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"
NOT_BLANK = r"[^\x20\x09-\x0D]"
#: Rows of one host are dealt to so many groups where they meet its verdict.
SALTS = 64
#: Bytes of the documents whose figures make a file: of a small table, while there are fewer files than cores, and of a large one.
SMALL_BYTES, LARGE_BYTES = 16 << 20, 256 << 20
#: Spark's estimate of what it knows nothing about.
UNKNOWN_BYTES = 2**63 - 1


@dataclass(frozen=True)
class Rules:
    """``window`` words make a window; a document fails under ``min_words`` or
    above ``max_repeat_percent`` of its words in repeated windows; a host is
    turned down when its shrunk failure rate exceeds ``max_host_rate``."""

    window: int = 8
    min_words: int = 20
    max_repeat_percent: int = 30
    max_host_rate: float = 0.5


def words(text: Column) -> Column:
    """The words of a text, an empty array for null."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANK_RUN))


def _let(value: Column, body) -> Column:
    """``body`` of ``value`` computed once: a name inside an expression."""
    return F.transform(F.array(value), body)[0]


def _repeated_words(ws: Column, window: int) -> Column:
    """Words that lie in a window that occurs at least twice in the text."""
    n = F.size(ws)

    def of_hashes(h: Column) -> Column:
        at = F.transform(F.slice(h, 1, F.size(h) - (window - 1)), lambda _, i: F.xxhash64(*[h[i + k] for k in range(window)]))
        return _let(at, lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(covered(g)))

    def covered(g: Column) -> Column:
        pairs = F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
        again = _let(
            pairs,
            lambda s: F.sort_array(
                F.transform(
                    F.filter(
                        s,
                        lambda p, j: F.when(j > 0, s[F.greatest(j - 1, F.lit(0))]["x"] == p["x"]).otherwise(False)
                        | F.when(j < F.size(s) - 1, s[F.least(j + 1, F.size(s) - 1)]["x"] == p["x"]).otherwise(False),
                    ),
                    lambda p: p["i"],
                )
            ),
        )
        steps = _let(again, lambda q: F.transform(q, lambda x, k: F.when(k < F.size(q) - 1, F.least(F.lit(window), q[F.least(k + 1, F.size(q) - 1)] - x)).otherwise(window)))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    return F.when(n <= window, F.lit(0)).otherwise(_let(F.transform(ws, lambda w: F.xxhash64(w)), of_hashes))


def base_figures(docs: DataFrame, rules: Rules = Rules(), text: str = "text", keep: tuple[str, ...] = ("doc_id", "source")) -> DataFrame:
    """The columns ``keep`` with the figures of each text and ``base_failed``."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(NOT_BLANK))
    figures = _let(
        words(F.col(text)),
        lambda ws: F.struct(
            F.size(ws).cast("long").alias("n_words"),
            F.length(F.array_join(ws, "")).cast("long").alias("word_chars"),
            F.length(F.regexp_replace(t, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
            _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            _repeated_words(ws, rules.window).cast("long").alias("n_repeat_words"),
        ),
    )
    kept = [F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)]
    # inline() makes one row of each, computed once however many of its fields are read
    out = docs.select(*kept, F.inline(F.array(figures)))
    failed = (F.col("n_words") < rules.min_words) | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words"))
    return out.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"))


def host_rates(figures: DataFrame, host: str = "source") -> DataFrame:
    """Per host: documents, failures and the failure rate shrunk by a beta prior.

    The prior's mean m and variance v are those of the hosts' rates; with
    k = m(1-m)/v - 1 the shrunk rate is (failures + k*m) / (documents + k).
    Where the rates do not vary (v = 0) or vary more than a beta law can
    (k <= 0) the prior is worth one document at the mean rate.
    """
    return shrunk(figures.groupBy(F.col(host).alias("host")).agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("base_failed").cast("long")).alias("n_failed")))


def shrunk(hosts: DataFrame) -> DataFrame:
    """``hosts`` (host, n_docs, n_failed) with ``shrunk_rate``."""
    rate = F.col("n_failed") / F.col("n_docs")
    m, v = hosts.agg(F.avg(rate), F.var_pop(rate)).first()  # two numbers, however many hosts
    m, v = m or 0.0, v or 0.0
    k = m * (1 - m) / v - 1 if v > 1e-12 else 1.0
    k = k if k > 0 else 1.0
    return hosts.withColumn("shrunk_rate", (F.col("n_failed") + F.lit(k * m)) / (F.col("n_docs") + F.lit(k)))


def gathered(figures: DataFrame, docs: DataFrame) -> DataFrame:
    """The figures of ``docs``, dealt evenly to few partitions to be written.

    Figures are a hundredth of their texts, so a file for each split of these
    is a small one.  What a file costs is the same for any size: buffers, and
    on a local file system three processes that the executor starts.  The size
    is Spark's estimate; where it has none, each split keeps its own file.
    """
    spark = docs.sparkSession
    size = docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    if size >= UNKNOWN_BYTES:
        return figures
    cores = spark.sparkContext.defaultParallelism
    most = max(cores, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return figures.repartition(min(most, max(min(cores, 1 + size // SMALL_BYTES), size // LARGE_BYTES)))


def judge(docs: DataFrame, rules: Rules = Rules(), text: str = "text", host: str = "source", keep: tuple[str, ...] = ("doc_id", "source")) -> DataFrame:
    """One row per row of ``docs``: ``keep``, the figures, ``base_failed``,
    ``host_rejected`` and ``kept`` (neither of them).

    The figures are computed once, split by split, dealt to few files and
    written; hosts are few beside documents and counted with a partial sum in
    each task.  The verdict comes back by a join on host and a salt, so a host
    with a third of all rows is spread over ``SALTS`` groups.
    """
    if host not in keep:
        keep = (*keep, host)
    scratch = Scratch(docs.sparkSession, "quality_rules")
    figures = scratch.save(gathered(base_figures(docs, rules, text, keep), docs), "figures")
    verdict = host_rates(figures, host).select("host", (F.col("shrunk_rate") > rules.max_host_rate).alias("host_rejected"))
    verdict = verdict.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = figures.withColumn("_salt", F.pmod(F.hash(keep[0], "word_chars", "n_words", "n_symbols"), F.lit(SALTS)).cast("int"))
    joined = salted.join(verdict, F.col(host).eqNullSafe(verdict.host) & (F.col("_salt") == verdict.salt), "left")
    rejected = F.coalesce(F.col("host_rejected"), F.lit(False))
    return joined.select(*figures.columns, rejected.alias("host_rejected"), (~F.col("base_failed") & ~rejected).alias("kept"))


#: Up to so many rejected hosts are broadcast to the documents; beyond, hosts and documents are shuffled together.
BROADCAST_HOSTS = 100_000


def base_failed(text: Column, rules: Rules = Rules()) -> Column:
    """The base verdict on a text, as one expression."""
    return _let(words(text), lambda ws: (F.size(ws) < rules.min_words) | (100 * _repeated_words(ws, rules.window) > rules.max_repeat_percent * F.size(ws)))


def filter_documents(docs: DataFrame, rules: Rules = Rules(), text: str = "text", host: str = "source") -> DataFrame:
    """The rows of ``docs`` whose base verdict and host verdict are both good,
    with their columns as they were.

    The base rules see each text once: what they keep is written whole, of what
    they turn down only the host.  Hosts are counted from that table, and those
    that are turned down are broadcast where they are few; no text is shuffled.
    """
    scratch = Scratch(docs.sparkSession, "quality_filter")
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    judged = docs.select(F.col(f"`{host}`").alias("host"), F.inline(F.array(F.struct(base_failed(F.col(f"`{text}`"), rules).alias("failed")))), row.alias("row"))
    judged = scratch.save(judged.select("host", "failed", F.when(~F.col("failed"), F.col("row")).alias("row")), "judged")
    figures = judged.groupBy("host").agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("failed").cast("long")).alias("n_failed"))
    rejected = scratch.save(shrunk(scratch.save(figures, "hosts")).filter(F.col("shrunk_rate") > rules.max_host_rate).select(F.col("host").alias("bad")), "rejected")
    few = rejected.count() <= BROADCAST_HOSTS
    good = judged.filter("NOT failed").join(F.broadcast(rejected) if few else rejected, F.col("host").eqNullSafe(F.col("bad")), "left_anti")
    return good.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns)])
