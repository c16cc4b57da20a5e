"""Helpers shared by the corpus operators: scratch tables, word rules, hot-key joins, running sums, components."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from math import isqrt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terracel.core.lineage import ensure_checkpoint_dir

#: The six white-space characters that separate words and trim lines.
SPACE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: A key with more than 1/HOT_SHARE of all rows is hot, so there are never more than HOT_SHARE hot keys.
HOT_SHARE = 1024


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a folder of this session's own only where it is unset."""
    return spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: computed once, lineage cut, safe from lost executors.

    ``by`` names columns whose values get folders of their own.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table of a data folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z lower-cased and every other character as it was."""
    ascii_only = F.length(text) == F.octet_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def words_of(text: Column) -> Column:
    """Array of words ``[^\\x20\\x09-\\x0D]+`` of ``text``; empty for null."""
    whole = F.coalesce(text, F.lit(""))
    # white space becomes blanks, mostly line breaks only, as splitting at one character needs no pattern
    blanks = F.when(F.regexp_like(whole, F.lit("[\\t\\x0b-\\r]")), F.translate(whole, SPACE[1:], " " * 5)).otherwise(F.replace(whole, F.lit("\n"), F.lit(" ")))
    return F.array_remove(F.split(blanks, " "), "")


def word_count(text: Column) -> Column:
    """Number of words of ``text``; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit("[^ \\t-\\r]+")), F.lit(0)).cast("long")


def hot_join(
    rows: DataFrame, groups: DataFrame, key: Sequence[str], n: str, n_rows: int, spread: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join many ``rows`` to ``groups`` (one row per key, ``n`` its number of rows) without a task of one key's rows.

    Keys with more than ``n_rows / HOT_SHARE`` rows number at most HOT_SHARE, as counts add up to ``n_rows``:
    they are broadcast, and their rows take a salt from ``spread`` into the shuffle join of the other keys, in
    which no key is large.  ``groups`` should be staged, since it is read twice.  ``how`` is inner or left.
    """
    key, least = list(key), n_rows / HOT_SHARE
    others = [c for c in groups.columns if c not in key]
    hot = groups.filter(F.col(n) > least).select(*key, F.struct(*others).alias("_hot"))
    cold = groups.filter(~(F.col(n) > least)).select(*key, F.struct(*others).alias("_cold"), F.lit(0).alias("_salt"))
    marked = rows.join(F.broadcast(hot), key, "left")
    salt = F.when(F.col("_hot").isNull(), 0).otherwise(1 + F.pmod(F.xxhash64(*spread), F.lit(1 << 20)))
    joined = marked.withColumn("_salt", salt.cast("int")).join(cold, [*key, "_salt"], "left")
    joined = joined.withColumn("_found", F.coalesce("_hot", "_cold"))
    if how == "inner":
        joined = joined.filter(F.col("_found").isNotNull())
    return joined.select(*rows.columns, *[F.col("_found")[c].alias(c) for c in others])


def running_sums(
    df: DataFrame, group: Sequence[str], slice_col: str, order: Sequence[str], sums: dict[str, str]
) -> DataFrame:
    """For each ``out: value`` of ``sums``, the sum of ``value`` over the rows before this one in its group.

    Rows go by (``slice_col``, ``order``).  They are summed inside their slice, and slices are added up from
    one row each, so a group that holds most rows is spread over as many tasks as it has slices.
    ``df`` should be staged, since it is read twice.
    """
    group = list(group)
    before = Window.partitionBy(*group).orderBy(slice_col).rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(*group, slice_col).agg(*[F.sum(v).alias(f"_s_{out}") for out, v in sums.items()])
    starts = totals.select(
        *[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)], F.col(slice_col).alias("_k"),
        *[F.coalesce(F.sum(f"_s_{out}").over(before), F.lit(0)).alias(f"_from_{out}") for out in sums],
    )
    inner = Window.partitionBy(*group, slice_col).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = df.withColumns({f"_in_{out}": F.coalesce(F.sum(v).over(inner), F.lit(0)) for out, v in sums.items()})
    on = F.col(slice_col).eqNullSafe(F.col("_k"))
    for i, c in enumerate(group):
        on = on & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    return inside.join(starts, on, "left").select(
        *df.columns, *[(F.col(f"_in_{out}") + F.col(f"_from_{out}")).cast("long").alias(out) for out in sums]
    )


def running_sum(
    df: DataFrame, group: Sequence[str], slice_col: str, order: Sequence[str], value: str, out: str
) -> DataFrame:
    """``running_sums`` of one column."""
    return running_sums(df, group, slice_col, order, {out: value})


def slice_rows(n_rows: int) -> int:
    """Rows of a slice: the square root of all rows, so that neither a slice nor the number of slices grows faster."""
    return max(1_000, isqrt(n_rows))


def slices_for(n_rows: int) -> int:
    """Number of slices of ``slice_rows`` rows, even if all rows are one group."""
    return max(1, -(-n_rows // slice_rows(n_rows)))


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """Connected components of undirected ``edges``: one row per node of an edge, (node, component), its smallest node.

    Alternating large-star and small-star steps; the state is one row per node once it has settled, and
    the number of rounds grows with the logarithm of the longest chain.  Raises if it has not settled in ``max_rounds``.
    """
    now = stage(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(), "edges"
    )
    mark = None
    for _ in range(max_rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        large = stage(large.distinct(), "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")
        ).select("e.u", "e.v").filter("u <> v")
        now = stage(small.distinct(), "small")
        told = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if told == mark:
            break
        mark = told
    else:
        raise RuntimeError(f"components have not settled in {max_rounds} rounds")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
