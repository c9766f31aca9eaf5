r"""Mixing sources to target weights, in DataFrame expressions only.

Each row gets a key that a hash of its id makes random; the key orders the
rows of its source; a prefix sum of sizes in that order is cut where the
source's budget is spent, after as many whole epochs as the budget holds.

The prefix sum is distributed: the key's range is divided evenly into as many
bins per source as its rows fill at ``ROWS_PER_BIN``, bins are summed, the
sums (few beside the rows) are accumulated over each source's bins, and rows
accumulate within their bin only.  So a source with a third of all rows is
spread over many tasks, and reruns cut at the same row.

A size is the number of words ``[^\x20\x09-\x0D]+`` of a whole text, however
long (null text: 0); only sizes are shuffled.  A null
source is a source, the last in order.  Rows with the same id and size are
interchangeable: ties of the key fall to id, then size.  A null id has a key
like any other.  Other columns are ignored; an empty table gives an empty
result, and sources of size 0 get target 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .quality_rules import words
from .store import Scratch

#: Weights of the sources in code point order, null last, repeating.
WEIGHTS = (3, 1, 2)
#: What all sources share, as a part of all sizes, and the most epochs of one.
SHARE, EPOCHS = 1.5, 2
ROWS_PER_BIN = 2000
SALTS = 64


def random_key(row_id: Column) -> Column:
    """A text whose order is random beside that of the ids, the same in every run."""
    return F.md5(F.coalesce(row_id.cast("string"), F.lit("")))


def sized(docs: DataFrame, row_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    return docs.select(F.col(row_id).alias("doc_id"), F.col(source).alias("source"), F.size(words(F.col(text))).cast("long").alias("size"))


def _numbered(sources: DataFrame, scratch: Scratch) -> DataFrame:
    """``sources`` with ``at``, the place from 0 in code point order, null last.

    Places come from the sums of ranges of the sorted table, so no task sees
    more sources than its range holds.
    """
    ranges = scratch.save(
        sources.orderBy(F.col("source").asc_nulls_last()).select("*", F.spark_partition_id().alias("part")), "ranges"
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())
    return ranges.join(starts, "part").select("source", "source_size", "n_rows", (F.col("start") + F.row_number().over(within) - 1).alias("at"))


def _level(numbered: DataFrame, cap: Column, share: float, scratch: Scratch) -> float:
    """What a weight of 1 gets: with sources in the order of cap over weight,
    those before some place are at their cap, the rest share what is left.

    One sort; spent caps and weights accumulate over the ranges of the sorted
    table, then within them, so no task sees more sources than its range holds.
    """
    ratio = cap / F.col("weight")
    rows = numbered.select("at", "source_size", "weight", cap.alias("cap"), ratio.alias("ratio")).orderBy("ratio", "at").select("*", F.spark_partition_id().alias("part"))
    rows = scratch.save(rows, "by-ratio")
    total, weights = rows.agg(F.sum("source_size"), F.sum("weight")).first()
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy("part").orderBy("ratio", "at").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("part").agg(F.sum("cap").alias("c"), F.sum("weight").alias("w"))
    starts = sums.select("part", *[F.coalesce(F.sum(x).over(earlier), F.lit(0)).alias(f"{x}0") for x in ("c", "w")])
    rows = rows.join(starts, "part")
    spent, gone = (F.col(f"{x}0") + F.coalesce(F.sum(y).over(within), F.lit(0)) for x, y in (("c", "cap"), ("w", "weight")))
    level = (F.lit(share) * F.lit(total or 0) - spent) / (F.lit(weights or 0.0) - gone)
    found = rows.select("ratio", "at", level.alias("level")).filter("level < ratio").agg(F.min_by("level", F.struct("ratio", "at"))).first()[0]
    return float("inf") if found is None else found


def targets(sizes: DataFrame, scratch: Scratch, weights=WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """Per source: ``source_size``, ``n_rows`` and ``target``.

    A source's target is the smaller of ``epochs`` times its size and its
    weight times a level that all share.  Sources at their cap leave the rest
    to the others, which raises the level, until no more reach their cap.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_rows"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("at") % len(weights) + 1).cast("int"))
    numbered = scratch.save(_numbered(sources, scratch).withColumn("weight", weight), "sources")
    cap = F.lit(epochs) * F.col("source_size")
    target = F.least(cap.cast("double"), F.lit(_level(numbered, cap, share, scratch)) * F.col("weight"))
    return numbered.select("source", "source_size", "n_rows", target.alias("target"))


def mix(docs: DataFrame, row_id: str = "doc_id", source: str = "source", text: str = "text", weights=WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """Per row: doc_id, source, size, source_size, target and ``taken``, the
    words that the mix takes of it: its size times the whole epochs, and what
    the last, partial epoch takes.  The row at the cut gives what is left of
    the budget, so a source's sum is its target rounded down.
    """
    return _mixed(docs, row_id, source, text, weights, share, epochs).select("doc_id", "source", "size", "source_size", "target", (F.col("whole") * F.col("size") + F.col("part")).alias("taken"))


def _mixed(docs: DataFrame, row_id: str, source: str, text: str, weights, share: float, epochs: int) -> DataFrame:
    """Per row its ``whole`` epochs and the words ``part`` of the last one."""
    scratch = Scratch(docs.sparkSession, "mixing")
    sizes = scratch.save(sized(docs, row_id, source, text), "sizes")
    goal = scratch.save(targets(sizes, scratch, weights, share, epochs), "goal")
    goal = goal.select(F.col("source").alias("g_source"), "source_size", "target", F.ceil(F.col("n_rows") / ROWS_PER_BIN).alias("n_bins"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    keyed = sizes.withColumn("key", random_key(F.col("doc_id")))
    keyed = keyed.withColumn("point", F.conv(F.substring("key", 1, 8), 16, 10).cast("long"))
    keyed = keyed.join(goal, F.col("source").eqNullSafe(F.col("g_source")) & ((F.col("point") % SALTS) == F.col("salt")))
    keyed = keyed.select("doc_id", "source", "size", "source_size", "target", "key", F.floor(F.col("point") * F.col("n_bins") / F.lit(2**32)).alias("bin"))
    keyed = scratch.save(keyed, "keyed")
    # rows of a bin accumulate among themselves, bins among those of their source
    before = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = keyed.groupBy("source", "bin").agg(F.sum("size").alias("n")).select(F.col("source").alias("b_source"), F.col("bin").alias("b_bin"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("source", "bin").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = keyed.withColumn("inner", F.coalesce(F.sum("size").over(within), F.lit(0)))
    rows = rows.join(bins, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("bin") == F.col("b_bin")))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    rest = F.floor(F.col("target")).cast("long") - whole * F.col("source_size")
    part = F.least(F.col("size"), F.greatest(F.lit(0).cast("long"), rest - (F.col("start") + F.col("inner"))))
    return rows.select("doc_id", "source", "size", "source_size", "target", "key", whole.alias("whole"), part.cast("long").alias("part"))


#: Up to so many sources are broadcast to the documents; beyond, both are shuffled together.
BROADCAST_SOURCES = 100_000


def mix_rows(docs: DataFrame, row_id: str = "doc_id", source: str = "source", text: str = "text", weights=WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, whole.

    The row at a source's cut is taken when at least half of it fits the
    budget; rows alike in id and size share its fate.  Texts are not shuffled:
    the cut of each source is compared with the keys of its rows.
    """
    scratch = Scratch(docs.sparkSession, "mix_rows")
    mixed = _mixed(docs, row_id, source, text, weights, share, epochs)
    taken = (F.col("part") > 0) & (2 * F.col("part") >= F.col("size"))
    place = F.struct("key", F.col("doc_id"), "size")
    cuts = mixed.groupBy(F.col("source").alias("_s")).agg(F.max("whole").alias("_whole"), F.max(F.when(taken, place)).alias("_cut"))
    cuts = scratch.save(cuts, "cuts")
    few = cuts.count() <= BROADCAST_SOURCES
    mine = F.struct(random_key(F.col(row_id)).alias("key"), F.col(row_id).alias("doc_id"), F.size(words(F.col(text))).cast("long").alias("size"))
    rows = docs.join(F.broadcast(cuts) if few else cuts, docs[source].eqNullSafe(cuts["_s"]))
    copies = cuts["_whole"] + F.when(mine <= cuts["_cut"], 1).otherwise(0)
    row = F.struct(*[docs[c] for c in docs.columns])
    return rows.select(F.explode(F.array_repeat(row, copies.cast("int"))).alias("row")).select("row.*")
