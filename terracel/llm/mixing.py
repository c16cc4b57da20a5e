"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks."""

from __future__ import annotations

from fractions import Fraction
from math import isqrt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import hot_join, read_table, running_sum, slice_rows, slices_for, stage, word_count
from .registry import query

#: Fractional part of the golden ratio: slot i draws the point frac(i * GOLDEN).
GOLDEN = Fraction(isqrt(5 * 10**60) - 10**30, 2 * 10**30)
BLOCK_WORDS = 64
MAX_REPEATS = 3


def golden_point(slot: Column, low_bits: int = 20) -> Column:
    """frac(slot * GOLDEN), from the slot number's high and low bits so that large numbers lose no digits."""
    step = 1 << low_bits
    high, low = F.floor(slot / step), slot % step
    return (low * F.lit(float(GOLDEN)) + high * F.lit(float(GOLDEN * step % 1))) % 1.0


def source_targets(sources: DataFrame, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Targets of ``sources`` (source, source_size): weights 1, 2, 3, 1, ... by source, nulls last, sharing all sizes.

    A target stops at ``max_repeats`` times its source's size and the excess goes to the others by weight.
    That fixed point is ``least(max_repeats * size, level * weight)``: sources are taken in the order in
    which they reach their stop, and the level is what remains over the weights that remain.  One row per
    source enters the window, whatever the number of documents.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = sources.withColumn("weight", (F.row_number().over(by_name) - 1) % 3 + 1).withColumn(
        "stop", (F.col("source_size") * max_repeats).cast("long")
    )
    full = Window.orderBy(F.col("stop") / F.col("weight"), F.col("source").asc_nulls_last())
    past = full.rowsBetween(Window.unboundedPreceding, -1)
    rest = full.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("stop").over(past), F.lit(0))
    w = w.withColumn("at", left.cast("double") / F.sum("weight").over(rest))
    level = F.min(F.when(F.col("at") * F.col("weight") <= F.col("stop"), F.struct(F.col("stop") / F.col("weight"), "at"))).over(everything)
    w = w.withColumn("level", level["at"])
    return w.select(
        *sources.columns, "weight",
        F.when(F.col("level").isNull(), F.col("stop").cast("double"))
        .otherwise(F.least(F.col("stop").cast("double"), F.col("level") * F.col("weight"))).alias("target"),
    )


def mix_plan(
    docs: DataFrame, block_words: int = BLOCK_WORDS, max_repeats: int = MAX_REPEATS, seed: int = 17
) -> tuple[DataFrame, DataFrame]:
    """(documents with their places, scheduled segments) of a mix of all ``docs`` (doc_id, text, source).

    Every source is a stream of its documents in a hashed order, repeated up to ``max_repeats`` times and
    cut into blocks of ``block_words`` words.  Slot i of the schedule goes to the source whose share of
    the cumulated targets holds frac(i * golden ratio); the r-th slot of a source takes its block r.  A
    segment is the part of a document in a block: row, slot, block, pass, start, words.
    Documents carry row, doc_id, text_hash, source, size, source_size, target.

    Null text has size 0 and is never taken; very long texts count whole; null is a source of its own, last in order; repeated rows
    are separate documents; a table without words gives no segments; other columns are ignored.
    """
    spark = docs.sparkSession
    d = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("text_hash"))
    d = d.withColumn("_h", F.xxhash64(F.lit(seed), "doc_id", "text_hash")).withColumn("row", F.monotonically_increasing_id())
    d = stage(d, "sizes")
    n_docs = d.count()
    sources = stage(source_targets(d.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs")), max_repeats), "targets")
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    # one row per source: shares of the unit interval, in source order
    order = Window.orderBy(F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    shares = sources.filter("target > 0").select(
        "source", F.coalesce(F.col("source"), F.lit("")).alias("name"), F.col("source").isNull().alias("nameless"),
        "source_size", (F.sum("target").over(order) / F.lit(float(total or 1))).alias("upto"), (F.col("target") / F.lit(float(total or 1))).alias("share"),
    )
    # narrow cells of the unit interval meet only the sources that overlap them, so slots find theirs by an equi-join
    cells = 4096
    lo, hi = F.floor((F.col("upto") - F.col("share")) * cells - 1), F.floor(F.col("upto") * cells + 1)
    spread = shares.withColumn("cell", F.explode(F.sequence(lo, hi))).withColumn("after", F.lag("upto", 1, 0.0).over(Window.partitionBy("cell").orderBy("upto")))
    n_slots = int(total // block_words) + bool(total % block_words)
    slots = spark.range(n_slots).withColumn("u", golden_point(F.col("id"))).withColumn("cell", F.floor(F.col("u") * cells))
    # a source's reach inside a cell starts where the one before ends; the last source takes what rounding leaves
    top = Window.partitionBy("cell").orderBy(F.desc("upto"))
    spread = spread.withColumn("until", F.when(F.row_number().over(top) == 1, F.lit(2.0)).otherwise(F.col("upto")))
    slots = slots.join(
        spread.select("cell", "name", "nameless", "source_size", "after", "until"), "cell"
    ).filter("u >= after and u < until").select("id", "name", "nameless", "source_size", F.lit(1).alias("one"), F.floor(F.col("id") / slice_rows(n_slots)).alias("run"))
    slots = running_sum(stage(slots, "slots"), ["name", "nameless"], "run", ["id"], "one", "block")
    # the repeated stream ends after max_repeats passes
    slots = slots.filter(F.col("block") * block_words < F.col("source_size") * max_repeats)
    slots = stage(slots.select("id", "name", "nameless", "block"), "schedule")
    taken_blocks = slots.groupBy("name", "nameless").agg(F.count(F.lit(1)).alias("n_blocks"))

    n_slices = slices_for(n_docs)
    placed = d.withColumn("name", F.coalesce("source", F.lit(""))).withColumn("nameless", F.col("source").isNull())
    placed = placed.withColumn("slice", F.floor((F.col("_h").cast("double") / float(2**64) + 0.5) * n_slices).cast("int"))
    placed = running_sum(placed, ["name", "nameless"], "slice", ["_h", "doc_id", "row"], "size", "at")
    facts = sources.select(
        F.coalesce("source", F.lit("")).alias("name"), F.col("source").isNull().alias("nameless"), "source_size", "target", "n_docs"
    ).join(taken_blocks, ["name", "nameless"], "left")
    placed = hot_join(placed, stage(facts, "facts"), ["name", "nameless"], "n_docs", n_docs, ["row"])
    end = F.least(F.coalesce("n_blocks", F.lit(0)) * block_words, F.col("source_size") * max_repeats)
    passes = placed.filter("size > 0").withColumn("end", end).withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1))))
    passes = passes.withColumn("lo", F.col("at") + F.col("pass") * F.col("source_size")).filter("lo < end")
    passes = passes.withColumn("hi", F.least(F.col("lo") + F.col("size"), F.col("end")))
    pieces = passes.withColumn(
        "block", F.explode(F.sequence(F.floor(F.col("lo") / block_words), F.floor((F.col("hi") - 1) / block_words)))
    )
    start = F.greatest(F.col("lo"), F.col("block") * block_words)
    stop = F.least(F.col("hi"), (F.col("block") + 1) * block_words)
    segments = pieces.select(
        "name", "nameless", "row", "block", "pass", (start - F.col("lo")).alias("start"), (stop - start).alias("words")
    ).join(slots, ["name", "nameless", "block"]).select("row", F.col("id").alias("slot"), "block", "pass", "start", "words")
    return placed.select("row", "doc_id", "text_hash", "source", "size", "source_size", "target"), segments


def mix_sizes(docs: DataFrame, **options) -> DataFrame:
    """One row per document of the mix: doc_id, size, source_size, target, taken (words, repeats counted)."""
    placed, segments = mix_plan(docs, **options)
    taken = segments.groupBy("row").agg(F.sum("words").alias("taken"))
    return placed.join(taken, "row", "left").select(
        "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: a row of ``docs``, unchanged, for each pass that takes it.

    Blocks of a source are taken from its first on, so at most one text of a source is taken in part; it stays whole
    if at least half of its words are taken, else it goes, so that a source is off by half a text at most.  Null
    and empty texts are never taken.  Rows equal in doc_id, text and source are interchangeable; ids may be
    null or of any type; an empty table gives no rows; every column of ``docs`` is returned as it was.
    """
    placed, segments = mix_plan(docs, **options)
    taken = segments.groupBy("row", "pass").agg(F.sum("words").alias("words"))
    keys = ["id", "hash", "source"]
    parts = placed.join(taken, "row").filter(F.col("words") * 2 >= F.col("size")).select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.col("text_hash").alias("hash"), F.coalesce("source", F.lit("")).alias("source"),
    ).groupBy(*keys).agg(F.count(F.lit(1)).alias("times"))
    # the given columns travel inside one, so no name of theirs is touched
    given = docs.select(
        F.struct("*").alias("doc"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.xxhash64("text").alias("hash"),
        F.coalesce("source", F.lit("")).alias("source"),
    )
    # partitioned like the join, so texts move once
    first = F.row_number().over(Window.partitionBy(*keys).orderBy("doc.doc_id"))
    rows = given.join(parts, keys).withColumn("nth", first).filter("nth = 1")
    return rows.select("doc", F.explode(F.array_repeat(F.lit(0), F.col("times").cast("int")))).select("doc.*")


@query("op6_mixing")
def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """The mix of all documents."""
    return mix_sizes(read_table(spark, folder, "documents"))
