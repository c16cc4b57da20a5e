"""Row numbers without sorting a whole group (or table) in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from .lineage import cut
from .skew import HOT_ROWS, hot_keys


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    ties: Sequence[str] = (),
    out: str = "rn",
    slices: int = 1024,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """1-based position of each row inside its group by numeric ``order`` then ``ties``, nulls first.

    Hot groups are cut in equal-width slices of ``order``, after one slice for null; where all
    orders are equal they are cut by the first of ``ties`` if that is a number.  Rows are numbered
    inside their slice and shifted by the number of rows in the slices before it.  With no
    keys the whole table is one group.
    """
    keys = list(keys)
    whole = not keys
    if whole:
        keys = ["_all"]
        df = df.withColumn("_all", F.lit(1))
    tie = next((c for c in ties[:1] if isinstance(df.schema[c].dataType, NumericType)), order)
    spans = hot_keys(
        df,
        keys,
        hot_rows,
        aggs=[f(c).cast("double").alias(f"_{n}{i}") for n, c in (("o", order), ("t", tie)) for i, f in enumerate((F.min, F.max))],
    ).drop("_hot_n").withColumn("_hot", F.lit(True))

    def slice_of(column, lo, hi):
        """0 for null, then 1 to ``slices`` by equal widths."""
        at = (F.col(column).cast("double") - F.col(lo)) / F.nullif(F.col(hi) - F.col(lo), F.lit(0.0)) * slices
        within = F.when(at.isNull() | (at < 0), 0).when(at < slices, F.floor(at)).otherwise(slices - 1)
        return F.when(F.col(column).isNull(), 0).otherwise(1 + within)

    by_tie = F.when(F.col(order).isNull(), 0).otherwise(1 + slice_of(tie, "_t0", "_t1"))
    slice_no = F.when(F.col("_o0") < F.col("_o1"), slice_of(order, "_o0", "_o1")).otherwise(by_tie)
    sliced = (
        df.join(F.broadcast(spans), keys, "left")
        .withColumn("_slice", F.when(F.col("_hot"), slice_no).otherwise(-1).cast("int"))
        .drop("_o0", "_o1", "_t0", "_t1", "_hot")
    )
    # only hot groups have slices >= 0: at most HOT_TOP * (slices + 2) rows
    counts = sliced.filter("_slice >= 0").groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_c"))
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(
        *keys, "_slice", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_shift")
    )
    inner = Window.partitionBy(*keys, "_slice").orderBy(order, *ties)
    ranked = (
        sliced.withColumn("_rn", F.row_number().over(inner))
        .join(shifts, [*keys, "_slice"], "left")
        .withColumn(out, (F.col("_rn") + F.coalesce("_shift", F.lit(0))).cast("long"))
        .drop("_rn", "_shift", "_slice")
    )
    return ranked.drop("_all") if whole else ranked


def range_slices(df: DataFrame, order: Sequence[str], out: str = "_slice") -> DataFrame:
    """Adds the number of a row's range of ``order`` (nulls first, any type); ranges hold about equally many rows.

    Rows equal in ``order`` may lie in neighbouring ranges.  Ranges come from a sample, so the rows are written once with them.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(n, *order, "_tie")
    return cut(dealt.withColumn(out, F.spark_partition_id()).drop("_tie"))


def number_sorted(df: DataFrame, order: Sequence[str], out: str = "rn") -> DataFrame:
    """1-based position of each row of the whole table by ``order``, nulls first, whatever its distribution."""
    sliced = range_slices(df, order)
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    counts = sliced.groupBy("_slice").agg(F.count(F.lit(1)).alias("_c"))  # one row per slice
    shifts = counts.select("_slice", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_shift"))
    inside = sliced.withColumn("_rn", F.row_number().over(Window.partitionBy("_slice").orderBy(*order)))
    numbered = inside.join(F.broadcast(shifts), "_slice").withColumn(out, (F.col("_rn") + F.col("_shift")).cast("long"))
    return numbered.drop("_slice", "_rn", "_shift")
