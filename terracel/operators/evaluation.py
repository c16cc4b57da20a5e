"""Label statistics, evaluation, intensity curves and data splits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..core.numbering import number_rows, number_sorted
from ..core.quantiles import exact_quantiles
from ..core.skew import salted_join
from ..functions.color import clip, piecewise
from .points import map_labels

# fixed values: intensity curve percentiles and LAS classes preferred for output
CURVE = (0.05, 0.25, 0.50, 0.75, 0.95)
PREFERRED_CLASSES = (2, 6, 3, 4, 5, 13)


def class_histogram(points: DataFrame, mapping: Mapping[int, int], ignore: Sequence[int] = (), keys: Sequence[str] = ()) -> DataFrame:
    """Counts per mapped label (unmapped left out), overall or per file."""
    lab = map_labels(points, mapping, ignore).filter(F.col("label") >= 0)
    return lab.groupBy(*keys, "label").agg(F.count(F.lit(1)).alias("n"))


def target_score(points: DataFrame, mapping: Mapping[int, int], ignore: Sequence[int], target: int, file: str) -> DataFrame:
    """Points of the target label per file, 0 included."""
    lab = map_labels(points, mapping, ignore)
    hits = lab.groupBy(file).agg(F.count_if(F.col("label") == target).alias("score"))
    return points.select(file).distinct().join(hits, file, "left").withColumn("score", F.coalesce("score", F.lit(0)))


def class_weights(hist: DataFrame, n_classes: int) -> DataFrame:
    """Inverse frequency over its mean, counts floored at 1: one row per class."""
    classes = hist.sparkSession.range(n_classes).select(F.col("id").cast("int").alias("label"))
    inv = classes.join(hist, "label", "left").select("label", (1.0 / F.greatest(F.coalesce("n", F.lit(0)), F.lit(1))).alias("_w"))
    mean = inv.agg(F.avg("_w").alias("_m"))  # one row
    return inv.crossJoin(F.broadcast(mean)).select("label", (F.col("_w") / F.col("_m")).alias("weight"))


def confusion(pred: DataFrame, n_classes: int, target: str = "target", label: str = "pred") -> DataFrame:
    """Counts per (target, pred); targets outside 0..n-1 ignored, all combinations present."""
    seen = pred.filter(F.col(target).between(0, n_classes - 1)).groupBy(F.col(target).alias("target"), F.col(label).alias("pred")).agg(F.count(F.lit(1)).alias("n"))
    ids = F.sequence(F.lit(0), F.lit(n_classes - 1))
    full = pred.sparkSession.range(1).select(F.explode(ids).alias("target")).withColumn("pred", F.explode(ids))
    return full.join(seen, ["target", "pred"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(0.0)


def class_metrics(conf: DataFrame) -> DataFrame:
    """IoU, precision, recall and F1 per class, 0 where undefined."""
    gt = conf.groupBy(F.col("target").alias("label")).agg(F.sum("n").alias("gt"), F.sum(F.when(F.col("target") == F.col("pred"), F.col("n")).otherwise(0)).alias("tp"))
    pr = conf.groupBy(F.col("pred").alias("label")).agg(F.sum("n").alias("pr"))
    m = gt.join(pr, "label").withColumn("precision", _ratio(F.col("tp"), F.col("pr"))).withColumn("recall", _ratio(F.col("tp"), F.col("gt")))
    p, r = F.col("precision"), F.col("recall")
    return m.select("label", _ratio(F.col("tp"), F.col("gt") + F.col("pr") - F.col("tp")).alias("iou"), "precision", "recall", _ratio(2 * p * r, p + r).alias("f1"))


def overall_metrics(conf: DataFrame) -> DataFrame:
    """Accuracy and mean IoU in one row."""
    acc = conf.agg(_ratio(F.sum(F.when(F.col("target") == F.col("pred"), F.col("n")).otherwise(0)), F.sum("n")).alias("accuracy"))
    return acc.crossJoin(class_metrics(conf).agg(F.avg("iou").alias("miou")))  # one row each


def confusion_rates(conf: DataFrame) -> DataFrame:
    """Share of each target class predicted as every class."""
    total = conf.groupBy("target").agg(F.sum("n").alias("_t"))
    return conf.join(total, "target").select("target", "pred", _ratio(F.col("n"), F.col("_t")).alias("rate"))


def training_hours(history: DataFrame, seconds: str) -> DataFrame:
    return history.agg((F.sum(seconds) / 3600).alias("hours"))


# --- intensity curves --------------------------------------------------------

def quantile_curves(points: DataFrame, keys: Sequence[str], value: str = "intensity", min_n: int = 500) -> DataFrame:
    """Quantile curve per bin (class, return, returns) with at least ``min_n`` points; no keys = global."""
    q = exact_quantiles(points, keys, value, CURVE, "curve")
    return q.filter(F.col("n") >= min_n) if keys else q


def build_transforms(reference: DataFrame, patch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bins present on both sides whose patch curve rises: ``keys, src, dst``."""
    r = reference.select(*keys, F.col("curve").alias("dst"))
    p = patch.select(*keys, F.col("curve").alias("src"))
    return p.join(r, list(keys)).filter(F.element_at("src", -1) > F.element_at("src", 1))


def correct_intensity(points: DataFrame, transforms: DataFrame, global_src: DataFrame, global_dst: DataFrame, keys: Sequence[str], value: str = "intensity") -> DataFrame:
    """Patch points through the curve of their bin, else the global curve; result 0..65535 truncated."""
    g = global_src.select(F.col("curve").alias("_gs")).crossJoin(global_dst.select(F.col("curve").alias("_gd")))  # one row each
    j = salted_join(points, transforms, list(keys), ["pid"], "left").crossJoin(F.broadcast(g))
    mapped = piecewise(F.col(value).cast("double"), F.coalesce("src", "_gs"), F.coalesce("dst", "_gd"))
    return j.withColumn("corrected", F.floor(clip(mapped, 0.0, 65535.0)).cast("int")).drop("src", "dst", "_gs", "_gd")


# --- output classes ----------------------------------------------------------

def train_to_las(mapping: Mapping[int, int], n_classes: int) -> dict[int, int]:
    """LAS class written for each training class: first preferred one, else the lowest."""
    out = {}
    for c in range(n_classes):
        options = sorted(k for k, v in mapping.items() if v == c)
        if options:
            out[c] = next((p for p in PREFERRED_CLASSES if p in options), options[0])
    return out


def to_las_classes(points: DataFrame, mapping: Mapping[int, int], n_classes: int, label: str = "label", binary_target: int | None = None) -> DataFrame:
    """Adds ``las_class`` (or 0/1 for one target class); labels without a class keep the original."""
    if binary_target is not None:
        return points.withColumn("las_class", F.when(F.col(label) == binary_target, 1).otherwise(0))
    pairs = F.create_map(*[F.lit(v) for kv in train_to_las(mapping, n_classes).items() for v in kv])
    return points.withColumn("las_class", F.coalesce(F.try_element_at(pairs, F.col(label).cast("int")), F.col("classification")))


# --- sampling and splits -----------------------------------------------------

def _uniform(seed: int, *cols: str) -> Column:
    """A repeatable uniform draw in (0, 1) per row."""
    h = F.pmod(F.xxhash64(*cols, F.lit(seed)), F.lit(2**52))
    return (h + 0.5) / float(2**52)


def weighted_sample(rows: DataFrame, weight: str, n: int, key: str, alpha: float = 1.0, seed: int = 42) -> DataFrame:
    """``n`` rows without replacement, odds by weight plus ``alpha`` (equal when none is positive).

    Each row draws ``u ** (1 / w)`` and the highest draws win.
    """
    w = F.col(weight) + alpha
    top = rows.agg(F.max(w).alias("_top"))  # one row
    eff = F.when(F.col("_top") <= 0, 1.0).otherwise(F.greatest(w, F.lit(0.0)))
    # log(u) / w keeps its order at any weight; zero weights go last
    draw = F.when(F.col("_w") > 0, -F.log(_uniform(seed, key)) / F.col("_w")).otherwise(float("inf"))
    # numbered over ranges of the draw, so a large sample is never gathered in one task
    drawn = rows.crossJoin(F.broadcast(top)).withColumn("_w", eff).withColumn("_o", draw)
    return number_sorted(drawn, ["_o", key], "_n").filter(F.col("_n") <= n).drop("_top", "_w", "_o", "_n")


def split_sizes(n: int, train: float, val: float, test: float) -> tuple[int, int, int]:
    """Rounded sizes, the rest to test; ratios must sum to one and every part be filled."""
    if abs(train + val + test - 1) > 1e-6:
        raise ValueError("split ratios must sum to 1")
    a, b = int(round(n * train)), int(round(n * val))
    if min(a, b, n - a - b) <= 0:
        raise ValueError(f"cannot split {n} files")
    return a, b, n - a - b


def split_files(files: DataFrame, key: str, ratios=(0.7, 0.15, 0.15), seed: int = 42) -> DataFrame:
    """Random split: adds ``split`` (train, val, test) in exact sizes."""
    a, b, _ = split_sizes(files.count(), *ratios)
    drawn = number_rows(files.withColumn("_u", _uniform(seed, key)), [], "_u", [key], "_n")
    return drawn.withColumn("split", F.when(F.col("_n") <= a, "train").when(F.col("_n") <= a + b, "val").otherwise("test")).drop("_u", "_n")


def split_files_balanced(files: DataFrame, key: str, score: str, ratios=(0.7, 0.15, 0.15), min_positive: int = 1, alpha: float = 1.0, seed: int = 42) -> DataFrame:
    """Split with positive files seeded into val and test, the rest of both drawn by score.

    Seeding needs twice ``min_positive`` files with a positive score.
    """
    _, n_val, n_test = split_sizes(files.count(), *ratios)
    k = min(max(min_positive, 0), n_val, n_test)
    pos = files.filter(F.col(score) > 0)
    seeds = None
    if k > 0 and pos.count() >= 2 * k:
        drawn = number_rows(pos.withColumn("_u", _uniform(seed, key)), [], "_u", [key], "_n").filter(F.col("_n") <= 2 * k)
        seeds = drawn.select(key, F.when(F.col("_n") <= k, "val").otherwise("test").alias("split"))
    have = k if seeds is not None else 0
    rest = files if seeds is None else files.join(seeds, key, "left_anti")
    val = weighted_sample(rest, score, n_val - have, key, alpha, seed + 1).select(key, F.lit("val").alias("split"))
    rest = rest.join(val, key, "left_anti")
    test = weighted_sample(rest, score, n_test - have, key, alpha, seed + 2).select(key, F.lit("test").alias("split"))
    chosen = val.unionByName(test) if seeds is None else seeds.unionByName(val).unionByName(test)
    return files.join(chosen, key, "left").withColumn("split", F.coalesce("split", F.lit("train")))
