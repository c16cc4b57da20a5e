"""Hot keys: finding them and joining around them.

A hot-key table never has more than ``top`` rows, so broadcasting it is safe
at any data size.  Keys beyond the top ones hold less than ``1/top`` of the rows
each and fit one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_TOP = 512
HOT_ROWS = 250_000


def hot_keys(
    df: DataFrame, keys: Sequence[str], min_rows: int = HOT_ROWS, top: int = HOT_TOP, aggs=()
) -> DataFrame:
    """At most ``top`` key groups with more than ``min_rows`` rows: keys, ``_hot_n`` and ``aggs``."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_hot_n"), *aggs)
    # ordering by the keys as well makes the cut repeatable when counts tie
    return (
        counts.filter(F.col("_hot_n") > min_rows)
        .orderBy(F.desc("_hot_n"), *keys)
        .limit(top)
    )


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    spread: Sequence[str],
    how: str = "inner",
    rows_per_salt: int = HOT_ROWS,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Equi-join; skewed keys are split at run time, or salted where the caller knows them.

    Without ``hot`` this is the plain join, read once, whose skewed partitions adaptive execution
    splits.  ``hot`` holds hot keys that the caller has counted on the key columns of its base
    frame (``hot_keys``): left rows of a hot key then get a salt from a hash of the ``spread``
    columns, and right rows of that key are repeated once per salt.  Works for inner, left,
    left_semi and left_anti.
    """
    keys = list(keys)
    if hot is None:
        return left.join(right, keys, how)
    hot = hot.select(
        *keys, F.ceil(F.col("_hot_n") / F.lit(rows_per_salt)).cast("int").alias("_salts")
    )
    salts = F.coalesce(F.col("_salts"), F.lit(1))
    salted_left = (
        left.join(F.broadcast(hot), keys, "left")
        .withColumn("_salt", F.pmod(F.xxhash64(*spread), salts).cast("int"))
        .drop("_salts")
    )
    salted_right = (
        right.join(F.broadcast(hot), keys, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
        .drop("_salts")
    )
    return salted_left.join(salted_right, [*keys, "_salt"], how).drop("_salt")


def exploded(df: DataFrame) -> DataFrame:
    """Marks rows that an explode has multiplied: the next join with them, or with groups of them, sorts and merges.

    Sizes are estimated as if a row stayed one row, so such a side would be broadcast through the driver at any size.
    So would plain tables that pack well: they are taken for as large as their files.
    """
    return df.hint("merge")


def exploded_if_many(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """``exploded`` unless ``df`` has at most ``rows`` rows (reads no more than it needs to tell); few may be broadcast."""
    return df if df.limit(rows + 1).count() <= rows else exploded(df)


def group_shape(df: DataFrame, keys: Sequence[str]) -> tuple[int, int]:
    """Number of key groups and rows in the largest one (runs a job)."""
    row = (
        df.groupBy(*keys).count()
        .agg(F.count(F.lit(1)).alias("groups"), F.coalesce(F.max("count"), F.lit(0)).alias("most"))
        .first()
    )
    return row["groups"], row["most"]


BROADCAST_ROWS = 200_000


def checked_join(
    left: DataFrame, right: DataFrame, right_rows: int, keys: Sequence[str], spread: Sequence[str],
    how: str = "inner",
) -> DataFrame:
    """Broadcast ``right`` when its counted size allows it, otherwise a salted join."""
    if right_rows <= BROADCAST_ROWS:
        return left.join(F.broadcast(right), list(keys), how)
    return salted_join(left, right, keys, spread, how)
