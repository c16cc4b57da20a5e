"""Queries over text and JSON derived from the tables, through the readers' parsers."""

from pyspark.sql import functions as F

from ..operators import flight as L
from ..sources import sinks as W
from ..sources import tables as R
from ..streaming import incremental as I
from .registry import query, rounded


@query("parse_xydz", """SELECT cid, x, y, dz FROM {control_points} WHERE cid % 7 <> 0""")
def _(t):
    line = F.when(F.col("cid") % 14 == 0, "10.0 abc 1").when(F.col("cid") % 7 == 0, "1.0 NaN 2.0").otherwise(
        F.concat_ws("  ", F.lit(""), F.col("x").cast("string"), F.col("y").cast("string"), F.lit("0"), F.lit("0"), F.col("dz").cast("string")))
    lines = t.control_points.select(F.lit("a").alias("path"), F.col("cid").alias("seq"), line.alias("value"))
    return R.parse_xydz(lines, 5).select(F.col("seq").alias("cid"), "x", "y", "dz")


@query("parse_survey_points", """SELECT pid AS seq, tile_id % 3 AS file, CASE pid % 3 WHEN 0 THEN 'PVE' WHEN 1 THEN 'ARVORE' ELSE '1 PV 12' END AS type, round(x + 300000, 2) AS e, round(y + 7000000, 2) AS n, round(z, 5) AS z FROM {points}""")
def _(t):
    p = t.points.withColumn("file", F.col("tile_id") % 3)
    e, n, z = (F.format_string("%.5f", c) for c in (F.col("x") + 300000, F.col("y") + 7000000, F.col("z")))
    kind = F.when(F.col("pid") % 3 == 0, "PVE").when(F.col("pid") % 3 == 1, "arvore").otherwise("1 PV 12")
    # three layouts: header with ';' and decimal comma, no header with an index column, header with swapped E/N
    value = F.when(F.col("file") == 0, F.translate(F.concat_ws(";", kind, e, n, z), ".", ",")).when(
        F.col("file") == 1, F.concat_ws(";", F.col("pid").cast("string"), kind, e, n, z)).otherwise(F.concat_ws("\t", n, e, z, kind))
    body = p.select(F.col("file").cast("string").alias("path"), F.col("pid").alias("seq"), value.alias("value"))
    heads = p.select("file").distinct().filter("file <> 1").select(F.col("file").cast("string").alias("path"), F.lit(-1).cast("long").alias("seq"),
                                                                  F.when(F.col("file") == 0, "TIPO;E;N;Cota").otherwise("X\tY\tH\tTipo").alias("value"))
    out = R.parse_survey_points(body.unionByName(heads))
    return rounded(out.select("seq", F.col("path").cast("long").alias("file"), "type", "e", "n", "z"), e=5, n=5, z=5).withColumn("e", F.round("e", 2)).withColumn("n", F.round("n", 2))


@query("rinex_spans", """SELECT CAST(user_id AS VARCHAR) AS path, strftime(min(ts), '%H:%M:%S') AS first_obs, strftime(max(ts), '%H:%M:%S') AS last_obs FROM events GROUP BY 1""")
def _(t):
    e = t.events.groupBy(F.col("user_id").cast("string").alias("path")).agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    head = lambda c, tag: F.concat(F.date_format(c, "  yyyy  MM  dd  HH  mm  ss"), F.lit(f".0000000  GPS  TIME OF {tag} OBS"))
    lines = e.select("path", F.explode(F.array(head("a", "FIRST"), F.lit("COMMENT"), head("b", "LAST"))).alias("value"))
    return L.rinex_spans(lines)


@query("parse_registry", """SELECT CAST(c_custkey AS VARCHAR) AS property_id, CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE c_mktsegment END AS property_name,
CASE c_custkey % 3 WHEN 0 THEN 'B' WHEN 1 THEN 'A' END AS owner_name FROM customer""")
def _(t):
    k = F.col("c_custkey")
    owner = lambda kind, name: F.struct(F.lit(kind).alias("tipo"), F.lit(name).alias("nome"), F.lit("0").alias("cpf"))
    owners = F.when(k % 3 == 0, F.array(owner("conjuge", "A"), owner("Proprietario", "B"))).when(k % 3 == 1, F.array(owner("conjuge", "A"), owner("outro", "B")))
    item = F.struct(k.cast("string").alias("_id"), F.when(k % 2 == 0, F.col("c_name")).alias("nomepropriedade"), F.col("c_mktsegment").alias("nome"), owners.alias("proprietarios"))
    return R.parse_registry(t.customer.select(F.array(item).alias("results"))).select("property_id", "property_name", "owner_name")


@query("xyz_text", """SELECT pid, printf('%.2f %.2f %.2f', x, y, CAST(round(CAST(z AS DECIMAL(18, 6)), 2) AS DOUBLE)) AS line FROM {points}""")
def _(t):
    return t.points.select("pid", W.xyz_text(2).alias("line"))


@query("control_text", """SELECT cid, printf('%.2f %.2f 1.00 0.00 %.2f', x, y, dz) AS line FROM {control_points}""")
def _(t):
    return t.control_points.select("cid", W.control_text(1.0, 0.0, 2).alias("line"))


@query("confusion_table", """WITH p AS (SELECT * FROM {predictions} WHERE target BETWEEN 0 AND 2)
SELECT CASE target WHEN 0 THEN 'terreno' WHEN 1 THEN 'edificacao' ELSE 'vegetacao' END AS "gt/pred", count(*) FILTER (pred = 0) AS terreno, count(*) FILTER (pred = 1) AS edificacao, count(*) FILTER (pred = 2) AS vegetacao FROM p GROUP BY target""")
def _(t):
    from ..operators.evaluation import confusion
    return W.confusion_table(confusion(t.predictions, 3), ["terreno", "edificacao", "vegetacao"]).drop("target")


@query("side_by_side", """WITH a AS (SELECT stem, row_number() OVER (ORDER BY stem) AS r FROM (SELECT DISTINCT stem FROM {product_files} WHERE file_id % 3 = 0) q), b AS (SELECT stem, row_number() OVER (ORDER BY stem) AS r FROM (SELECT DISTINCT stem FROM {product_files} WHERE file_id % 3 <> 0) q)
SELECT coalesce(a.r, b.r) AS row, a.stem AS only_a, b.stem AS only_b FROM a FULL JOIN b ON a.r = b.r""")
def _(t):
    f = t.product_files
    return W.side_by_side(f.filter("file_id % 3 = 0").select("stem").distinct(), f.filter("file_id % 3 <> 0").select("stem").distinct(), "stem", ["only_a", "only_b"])


@query("pending_inputs", """SELECT stem FROM (SELECT DISTINCT stem FROM {product_files}) s WHERE stem NOT IN (SELECT stem FROM {product_files} WHERE file_id % 3 = 1 GROUP BY 1 HAVING count(*) >= 2)""")
def _(t):
    done = t.product_files.filter("file_id % 3 = 1").select("stem")
    return I.pending(t.product_files.select("stem").distinct(), done, "stem", products=2)


@query("upsert_days", """SELECT day, arg_max(seq, {'f': f, 's': seq}) AS seq FROM (SELECT o_custkey % 400 AS day, o_orderkey AS seq, CASE WHEN o_orderkey % 10 = 0 THEN 1 ELSE 0 END AS f FROM orders) q GROUP BY 1""")
def _(t):
    rows = t.orders.select((F.col("o_custkey") % 400).alias("day"), F.col("o_orderkey").alias("seq"))
    return I.upsert_days(rows.filter("seq % 10 <> 0"), rows.filter("seq % 10 = 0"))
