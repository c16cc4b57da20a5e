"""Label, evaluation, intensity and ground-filter queries."""

from pyspark.sql import functions as F

from ..operators import evaluation as E
from ..operators import ground as D
from .registry import query, rounded

MAP = {2: 0, 6: 1, 3: 2, 4: 2, 5: 2}
_MAPPED = "CASE classification WHEN 2 THEN 0 WHEN 6 THEN 1 ELSE 2 END"
_CONF = """s AS (SELECT target, pred, count(*) AS n FROM {predictions} WHERE target BETWEEN 0 AND 2 GROUP BY 1, 2),
c AS (SELECT t.i AS target, p.i AS pred, coalesce(n, 0) AS n FROM (SELECT unnest([0,1,2]) AS i) t CROSS JOIN (SELECT unnest([0,1,2]) AS i) p LEFT JOIN s ON s.target = t.i AND s.pred = p.i),
m AS (SELECT g.label, tp, gt, pr FROM (SELECT target AS label, sum(n) AS gt, sum(CASE WHEN target = pred THEN n ELSE 0 END) AS tp FROM c GROUP BY 1) g JOIN (SELECT pred AS label, sum(n) AS pr FROM c GROUP BY 1) p USING (label))"""


@query("class_histogram", f"SELECT tile_id, CAST({_MAPPED} AS INT) AS label, count(*) AS n FROM {{points}} WHERE classification IN (2, 3, 5, 6) GROUP BY 1, 2")
def _(t):
    return E.class_histogram(t.points, MAP, [7, 13], ["tile_id"])


@query("target_score", "SELECT tile_id, count(*) FILTER (classification = 6) AS score FROM {points} GROUP BY 1")
def _(t):
    return E.target_score(t.points, MAP, [7, 13], 1, "tile_id")


@query("class_weights", f"""WITH h AS (SELECT {_MAPPED} AS label, count(*) AS n FROM {{points}} WHERE classification IN (2, 3, 5, 6) GROUP BY 1), w AS (SELECT i AS label, 1.0/greatest(coalesce(n, 0), 1) AS w FROM (SELECT unnest([0,1,2,3]) AS i) q LEFT JOIN h ON h.label = i)
SELECT CAST(label AS INT) AS label, round(w/avg(w) OVER (), 9) AS weight FROM w""")
def _(t):
    return rounded(E.class_weights(E.class_histogram(t.points, MAP, [7, 13]), 4), weight=9)


@query("confusion", f"WITH {_CONF} SELECT CAST(target AS INT) AS target, CAST(pred AS INT) AS pred, n FROM c")
def _(t):
    return E.confusion(t.predictions, 3)


@query("class_metrics", f"WITH {_CONF} SELECT CAST(label AS INT) AS label, round(tp/(gt+pr-tp), 9) AS iou, round(tp/pr, 9) AS precision, round(tp/gt, 9) AS recall, round(2*(tp/pr)*(tp/gt)/(tp/pr+tp/gt), 9) AS f1 FROM m")
def _(t):
    return rounded(E.class_metrics(E.confusion(t.predictions, 3)), iou=9, precision=9, recall=9, f1=9)


@query("overall_metrics", f"WITH {_CONF} SELECT round(sum(tp)/sum(gt), 9) AS accuracy, round(avg(tp/(gt+pr-tp)), 9) AS miou FROM m")
def _(t):
    return rounded(E.overall_metrics(E.confusion(t.predictions, 3)), accuracy=9, miou=9)


@query("confusion_rates", f"WITH {_CONF} SELECT CAST(target AS INT) AS target, CAST(pred AS INT) AS pred, round(n/gt, 9) AS rate FROM c JOIN m ON m.label = c.target")
def _(t):
    return rounded(E.confusion_rates(E.confusion(t.predictions, 3)), rate=9)


@query("training_hours", "SELECT round(sum(value)/3600, 9) AS hours FROM events")
def _(t):
    return rounded(E.training_hours(t.events, "value"), hours=9)


_CURVES = """b AS (SELECT classification, return_number, number_of_returns, point_source_id IN (1, 2) AS patch, intensity FROM {points}),
q AS (SELECT classification, return_number, number_of_returns, patch, count(*) AS n, quantile_cont(intensity, [0.05, 0.25, 0.5, 0.75, 0.95]) AS c FROM b GROUP BY 1, 2, 3, 4)"""


@query("quantile_curves", f"WITH {_CURVES} SELECT classification, return_number, number_of_returns, n, round(c[1], 6) AS q05, round(c[3], 6) AS q50, round(c[5], 6) AS q95 FROM q WHERE NOT patch AND n >= 500")
def _(t):
    ref = t.points.filter(~F.col("point_source_id").isin(1, 2))
    q = E.quantile_curves(ref, ["classification", "return_number", "number_of_returns"])
    out = q.select("classification", "return_number", "number_of_returns", "n", *[F.col("curve")[i].alias(a) for i, a in ((0, "q05"), (2, "q50"), (4, "q95"))])
    return rounded(out, q05=6, q50=6, q95=6)


@query("correct_intensity", f"""WITH {_CURVES}, g AS (SELECT patch, quantile_cont(intensity, [0.05, 0.25, 0.5, 0.75, 0.95]) AS c FROM b GROUP BY 1),
p AS (SELECT pid, intensity, coalesce(s.c, (SELECT c FROM g WHERE patch)) AS src, CASE WHEN s.c IS NULL THEN (SELECT c FROM g WHERE NOT patch) ELSE r.c END AS dst
FROM {{points}} k LEFT JOIN (q s JOIN q r ON s.patch AND NOT r.patch AND s.n >= 200 AND r.n >= 200 AND s.classification = r.classification AND s.return_number = r.return_number AND s.number_of_returns = r.number_of_returns)
ON s.classification = k.classification AND s.return_number = k.return_number AND s.number_of_returns = k.number_of_returns WHERE k.point_source_id IN (1, 2))
SELECT pid, CAST(floor(greatest(least(CASE WHEN intensity < src[1] THEN dst[1] + (intensity - src[1])*(dst[2]-dst[1])/(src[2]-src[1]) WHEN intensity > src[5] THEN dst[5] + (intensity-src[5])*(dst[5]-dst[4])/(src[5]-src[4])
WHEN intensity = src[5] THEN dst[5] WHEN intensity >= src[4] THEN dst[4] + (intensity-src[4])*((dst[5]-dst[4])/(src[5]-src[4])) WHEN intensity >= src[3] THEN dst[3] + (intensity-src[3])*((dst[4]-dst[3])/(src[4]-src[3]))
WHEN intensity >= src[2] THEN dst[2] + (intensity-src[2])*((dst[3]-dst[2])/(src[3]-src[2])) ELSE dst[1] + (intensity-src[1])*((dst[2]-dst[1])/(src[2]-src[1])) END, 65535), 0)) AS INT) AS corrected FROM p""")
def _(t):
    keys = ["classification", "return_number", "number_of_returns"]
    patch, ref = t.points.filter(F.col("point_source_id").isin(1, 2)), t.points.filter(~F.col("point_source_id").isin(1, 2))
    tr = E.build_transforms(E.quantile_curves(ref, keys, min_n=200), E.quantile_curves(patch, keys, min_n=200), keys)
    return E.correct_intensity(patch, tr, E.quantile_curves(patch, []), E.quantile_curves(ref, []), keys).select("pid", "corrected")


@query("to_las_classes", "SELECT pid, CAST(CASE target WHEN 0 THEN 2 WHEN 1 THEN 6 WHEN 2 THEN 3 ELSE classification END AS INT) AS las_class, CASE WHEN target = 1 THEN 1 ELSE 0 END AS building FROM {predictions} JOIN {points} USING (pid)")
def _(t):
    p = t.predictions.join(t.points.select("pid", "classification"), "pid")
    out = E.to_las_classes(p, MAP, 3, "target").withColumnRenamed("las_class", "c")
    return E.to_las_classes(out, MAP, 3, "target", 1).select("pid", F.col("c").alias("las_class"), F.col("las_class").alias("building"))


@query("split_files", "SELECT CASE i WHEN 0 THEN 'train' WHEN 1 THEN 'val' ELSE 'test' END AS split, CASE i WHEN 0 THEN CAST(round_even(n*0.7, 0) AS BIGINT) WHEN 1 THEN CAST(round_even(n*0.15, 0) AS BIGINT) ELSE n - CAST(round_even(n*0.7, 0) AS BIGINT) - CAST(round_even(n*0.15, 0) AS BIGINT) END AS files FROM (SELECT count(*) AS n FROM {product_files}) c, (SELECT unnest([0,1,2]) AS i) q")
def _(t):
    return E.split_files(t.product_files, "file_id").groupBy("split").agg(F.count(F.lit(1)).alias("files"))


@query("split_files_balanced", "SELECT CASE i WHEN 0 THEN 'train' WHEN 1 THEN 'val' ELSE 'test' END AS split, CASE i WHEN 0 THEN n - 2*CAST(round_even(n*0.15, 0) AS BIGINT) WHEN 1 THEN CAST(round_even(n*0.15, 0) AS BIGINT) ELSE CAST(round_even(n*0.15, 0) AS BIGINT) END AS files FROM (SELECT count(*) AS n FROM {product_files}) c, (SELECT unnest([0,1,2]) AS i) q")
def _(t):
    f = t.product_files.withColumn("score", F.when(F.col("file_id") % 20 == 0, F.col("file_id")).otherwise(0))
    return E.split_files_balanced(f, "file_id", "score", min_positive=10).groupBy("split").agg(F.count(F.lit(1)).alias("files"))


@query("weighted_sample")
def _(t):
    return E.weighted_sample(t.product_files, "length", 100, "file_id").select("file_id", "length")


# --- ground ------------------------------------------------------------------

@query("low_noise", """WITH r AS (SELECT pid, z, row_number() OVER w AS k, lead(z) OVER w AS nz FROM {points} WINDOW w AS (PARTITION BY tile_id, floor(x/50), floor(y/50) ORDER BY z, pid))
SELECT pid, coalesce(k = 1 AND nz - z > 5, false) AS noise FROM r""")
def _(t):
    return D.low_noise(t.points, 50.0, 5.0).select("pid", "noise")


@query("statistical_outliers")
def _(t):
    return D.statistical_outliers(t.points, 6, 2.0).select("pid", "noise")


@query("ground_pmf")
def _(t):
    p = D.pmf_parameters(10.0, 90.0, 8.0, 30.0)
    return D.ground_pmf(t.points.withColumn("tile_id", F.lit(0)), **p).select("pid", "ground")


@query("ground_smrf")
def _(t):
    return D.ground_smrf(t.points.withColumn("tile_id", F.lit(0)), 20.0, 0.2, 1.2, 10.0, 60.0).select("pid", "ground")
