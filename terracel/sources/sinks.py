"""Writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def xyz_text(decimals: int = 3) -> Column:
    """``x y z`` with fixed decimals (rounded half up)."""
    return F.format_string(" ".join([f"%.{decimals}f"] * 3), "x", "y", "z")


def write_xyz(points: DataFrame, path: str, tile: str = "tile_id") -> None:
    """One text line per point or cell, a folder per tile."""
    points.select(tile, xyz_text().alias("value")).write.partitionBy(tile).mode("overwrite").text(path)


def control_text(extra1: float = 0.0, extra2: float = 0.0, decimals: int = 3) -> Column:
    """``X Y C1 C2 DZ`` line."""
    return F.format_string(" ".join([f"%.{decimals}f"] * 5), "x", "y", F.lit(float(extra1)), F.lit(float(extra2)), "dz")


def write_control(points: DataFrame, path: str, strip: str = "strip_id", **layout) -> None:
    points.select(strip, control_text(**layout).alias("value")).write.partitionBy(strip).mode("overwrite").text(path)


def write_report(rows: DataFrame, path: str, fields: Sequence[str]) -> None:
    """CSV with a fixed field order; missing fields stay empty."""
    have = set(rows.columns)
    cols = [F.col(f) if f in have else F.lit(None).cast("string").alias(f) for f in fields]
    rows.select(*cols).write.option("header", True).mode("overwrite").csv(path)


def side_by_side(left: DataFrame, right: DataFrame, name: str, labels: Sequence[str]) -> DataFrame:
    """Two name lists of different length as two columns in name order."""
    from ..core.numbering import number_sorted

    def ranked(df, label):
        return number_sorted(df.select(F.col(name).alias(label)), [label], "row")

    return ranked(left, labels[0]).join(ranked(right, labels[1]), "row", "full")


def write_metrics_json(metrics: DataFrame, path: str) -> None:
    """Each row as one JSON object."""
    metrics.select(F.to_json(F.struct(*metrics.columns)).alias("value")).write.mode("overwrite").text(path)


def confusion_table(conf: DataFrame, names: Sequence[str]) -> DataFrame:
    """Confusion counts as a table: a row per target name, a column per predicted name."""
    wide = conf.groupBy("target").pivot("pred", list(range(len(names)))).agg(F.sum("n"))
    label = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("target") + 1)
    return wide.select("target", label.alias("gt/pred"), *[F.col(str(i)).alias(n) for i, n in enumerate(names)])


def write_products(points: DataFrame, path: str, keys: Sequence[str] = ("product", "lote", "bloco")) -> None:
    """Parquet laid out by product, lot and block; numeric keys padded to two digits."""
    pad = lambda c: F.when(F.col(c).cast("string").rlike(r"^\d$"), F.lpad(F.col(c).cast("string"), 2, "0")).otherwise(F.col(c).cast("string"))
    points.withColumns({k: pad(k) for k in keys[1:]}).write.partitionBy(*keys).mode("overwrite").parquet(path)


def append_experiment(row: DataFrame, path: str, template: Sequence[str]) -> None:
    """Append result rows with the template's columns; other keys are ignored."""
    have = set(row.columns)
    cols = [F.col(f).cast("string") if f in have else F.lit("").alias(f) for f in template]
    row.select(*cols).write.option("header", True).option("sep", ";").mode("append").csv(path)
