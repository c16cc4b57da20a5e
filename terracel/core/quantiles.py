"""Exact quantiles per group that survive a group holding most of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lineage import cut
from .skew import HOT_ROWS, hot_keys

SKETCH = 10_000
BUCKETS = 200
#: Rows of a value range that one task sorts.
OPENED_ROWS = 100_000


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Sequence[float],
    out: str = "q",
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """``keys..., n, out ARRAY<DOUBLE>``: linearly interpolated quantiles of ``value``.

    ``hot_rows=None`` says that no group is large (the caller has counted them).

    Ordinary groups use the built-in exact percentile.  Groups with more than
    ``hot_rows`` rows are cut in ranges by a quantile sketch, again and again where a range that holds a
    wanted rank is large; everything else is counted map-side.
    """
    keys, probs = list(keys), [float(p) for p in probs]
    whole = not keys
    if whole:
        keys = ["_all"]
        df = df.withColumn("_all", F.lit(1))
    base = df.select(*keys, F.col(value).cast("double").alias("_v")).filter(
        F.col("_v").isNotNull() & ~F.isnan("_v")
    )
    exact = (
        F.count(F.lit(1)).alias("n"),
        F.percentile("_v", F.array(*[F.lit(p) for p in probs])).alias(out),
    )
    if hot_rows is None:
        result = base.groupBy(*keys).agg(*exact)
        return result.drop("_all") if whole else result
    hot = cut(hot_keys(base, keys, hot_rows))  # at most HOT_TOP rows, counted once
    if hot.isEmpty():
        result = base.groupBy(*keys).agg(*exact)
        return result.drop("_all") if whole else result
    small = base.join(F.broadcast(hot), keys, "left_anti").groupBy(*keys).agg(*exact)
    result = small.unionByName(_hot_quantiles(base, hot, keys, probs, out))
    return result.drop("_all") if whole else result


def _place(value: Column, marks: Column) -> Column:
    """2 for every one of the sorted ``marks`` below ``value``, 1 more if one is equal; halves the marks still open at each step."""
    halves = F.array(*[F.lit(2**i) for i in range(BUCKETS.bit_length() - 1, -1, -1)])
    below = F.aggregate(halves, F.lit(0), lambda k, step: k + F.when(F.get(marks, k + step - 1) < value, step).otherwise(0))
    return F.aggregate(F.array(below), F.lit(0), lambda none, k: 2 * k + F.when(F.get(marks, k) == value, 1).otherwise(0))


def _hot_quantiles(base, hot, keys, probs, out, bound: int = OPENED_ROWS):
    """Quantiles of hot groups by refining the value ranges that hold a wanted rank.

    A sketch of a range gives cut values; rows between two of them, and rows equal to one, are counted map-side, and
    only the parts that hold a wanted rank stay.  A part of one value is settled, one of at most ``bound`` rows is
    opened, others are cut again, so a task never sorts more than ``bound`` rows.  The sketch decides the size of
    parts, never the answer; the number of rounds is the logarithm of the largest group to the base BUCKETS.
    """
    steps = F.array(*[F.lit(i / BUCKETS) for i in range(1, BUCKETS)])
    n = F.col("n")
    wanted = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(F.lit(p) * (n - 1)), F.ceil(F.lit(p) * (n - 1))) for p in probs])))
    ranges = hot.select(*keys, F.col("_hot_n").alias("n")).select(
        *keys, "n", F.lit(0).cast("long").alias("_id"), F.lit(float("-inf")).alias("_lo"), F.lit(float("inf")).alias("_hi"), F.lit(0).cast("long").alias("_b"),
        wanted.cast("array<bigint>").alias("_r"))
    ranges, settled = cut(ranges), None
    within = (F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi"))
    while True:
        # ranges number at most HOT_TOP times two for each probability
        rows = base.join(F.broadcast(ranges.select(*keys, "_id", "_lo", "_hi")), keys).filter(within).select(*keys, "_id", "_v")
        marks = rows.groupBy(*keys, "_id").agg(F.array_distinct(F.percentile_approx("_v", steps, SKETCH)).alias("_m"))
        placed = rows.join(F.broadcast(marks), [*keys, "_id"])
        # even parts lie between two cut values, odd ones are equal to one
        at = _place(F.col("_v"), F.col("_m"))
        counts = placed.groupBy(*keys, "_id", at.alias("_at")).agg(F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        order = Window.partitionBy(*keys, "_id").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)  # at most 2 * BUCKETS rows
        parts = counts.join(F.broadcast(ranges.select(*keys, "n", "_id", "_r", F.col("_b").alias("_from"))), [*keys, "_id"])
        parts = parts.withColumn("_b", F.col("_from") + F.coalesce(F.sum("_c").over(order), F.lit(0)))
        parts = parts.withColumn("_r", F.filter("_r", lambda r: (r >= F.col("_b")) & (r < F.col("_b") + F.col("_c")))).filter(F.size("_r") > 0)
        parts = cut(parts.select(*keys, "n", F.xxhash64("_id", "_at").alias("_id"), "_lo", "_hi", "_b", "_r", "_c"))
        done = parts.filter("_lo = _hi").select(*keys, "n", F.explode("_r").alias("_rank"), F.col("_lo").alias("_v"))
        settled = done if settled is None else settled.unionByName(done)
        open_ = parts.filter("_lo < _hi")
        most = open_.agg(F.max("_c")).first()[0]
        if most is None or most <= bound:
            break
        ranges = open_.drop("_c")
    values = base.join(F.broadcast(open_), keys).filter(within)
    same = values.groupBy(*keys, "n", "_id", "_b", "_r", "_v").agg(F.count(F.lit(1)).alias("_c"))
    inside = Window.partitionBy(*keys, "_id").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    same = same.withColumn("_top", F.col("_b") + F.sum("_c").over(inside)).withColumn("_from", F.col("_top") - F.col("_c"))
    hits = F.filter("_r", lambda r: (r >= F.col("_from")) & (r < F.col("_top")))
    settled = settled.unionByName(same.select(*keys, "n", F.explode(hits).alias("_rank"), "_v"))
    found = settled.groupBy(*keys, "n").agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_v"))).alias("_at"))
    qs = []
    for p in probs:
        pos = F.lit(p) * (n - 1)
        low, high = F.try_element_at("_at", F.floor(pos)), F.try_element_at("_at", F.ceil(pos))
        qs.append(low + (high - low) * (pos - F.floor(pos)))
    return found.select(*keys, "n", F.array(*qs).alias(out))


def group_median(
    df: DataFrame, keys: Sequence[str], value: str, out: str, hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """``keys..., out``: the exact median of ``value`` in each group."""
    q = exact_quantiles(df, keys, value, [0.5], "_q", hot_rows)
    return q.select(*keys, F.col("_q")[0].alias(out))
