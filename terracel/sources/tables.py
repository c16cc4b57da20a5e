"""Text, JSON and file-catalog readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..core.lineage import cut
from ..core.quantiles import exact_quantiles
from ..core.skew import checked_join
from ..functions import geometry as G

# fixed values: column names accepted in survey files
SYNONYMS = {
    "type": ("type", "tipo", "tp", "classe", "feature", "feat"),
    "e": ("e", "x", "east", "este", "utme", "easting", "coorde", "coordx"),
    "n": ("n", "y", "north", "norte", "utmn", "northing", "coordn", "coordy"),
    "z": ("z", "alt", "altitude", "cota", "elev", "elevacao", "elevation", "h"),
}


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """``path, seq, value`` of text files; ``seq`` grows with the line inside a file."""
    lines = spark.read.text(path, recursiveFileLookup=True)
    return lines.select(F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("seq"), "value")


def parse_xydz(lines: DataFrame, dz_col: int = 3, strict: bool = False) -> DataFrame:
    """Control rows ``path, seq, x, y, dz`` from text lines; ``dz_col`` counts columns from 1.

    Lenient: short, non-numeric and non-finite lines drop out.  Strict: they raise, blanks pass.
    """
    parts = F.split(F.trim("value"), r"\s+")
    num = lambda i: F.get(parts, F.lit(i)).try_cast("double")
    out = lines.filter(F.trim("value") != "").select("path", "seq", "value", num(0).alias("x"), num(1).alias("y"), num(dz_col - 1).alias("dz"))
    good = F.lit(True)
    for c in ("x", "y", "dz"):
        good = good & F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))
    if strict:
        bad = F.raise_error(F.concat(F.lit("bad control line: "), "value")).cast("double")
        return out.select("path", "seq", F.when(good, F.col("x")).otherwise(bad).alias("x"), "y", "dz")
    return out.filter(good).select("path", "seq", "x", "y", "dz")


def read_xydz(spark: SparkSession, path: str, dz_col: int = 3, strict: bool = False) -> DataFrame:
    return parse_xydz(text_lines(spark, path), dz_col, strict)


def parse_survey_points(lines: DataFrame) -> DataFrame:
    """Survey rows ``path, seq, type, e, n, z`` from text lines of files with their own layouts.

    Per file: separator from its first line, header by known column names (two or more),
    otherwise type, e, n, z with a leading index column when there are five.  An index column
    stays only when at most 80 % of it is numeric.  East and north swap when only the east
    median is above one million.
    """
    body = lines.filter((F.trim("value") != "") & ~F.startswith(F.ltrim("value"), F.lit("#")))
    first = body.groupBy("path").agg(F.min_by("value", "seq").alias("_head"), F.min("seq").alias("_s0"))
    head = F.col("_head")
    sep = F.lit(r"\s+")
    for mark, pattern in (("|", r"\|"), (",", ","), ("\t", "\t"), (";", ";")):
        sep = F.when(head.contains(mark), pattern).otherwise(sep)
    names = F.transform(F.split(F.trim(head), F.col("_sep")), lambda t: F.regexp_replace(F.lower(t), r"[\s\-_.]", ""))
    place = lambda c: F.array_position(F.transform("_names", lambda t: t.isin(*SYNONYMS[c])), True) - 1
    known = sum((F.when(F.arrays_overlap("_names", F.array(*[F.lit(s) for s in v])), 1).otherwise(0) for v in SYNONYMS.values()), F.lit(0))
    layout = first.withColumn("_sep", sep).withColumn("_names", names).withColumn("_header", known >= 2)
    layout = layout.withColumn("_lead", F.when(~F.col("_header") & (F.size("_names") >= 5), 1).otherwise(0))
    for i, c in enumerate(("type", "e", "n", "z")):
        layout = layout.withColumn(f"_{c}", F.when(F.col("_header"), place(c)).otherwise(F.lit(i) + F.col("_lead")).cast("int"))
    layout = cut(layout.drop("_head", "_names"))  # one row per file
    files = layout.count()
    parts = checked_join(body, layout, files, ["path"], ["seq"]).filter(~(F.col("_header") & (F.col("seq") == F.col("_s0")))).withColumn(
        "_p", F.split(F.trim("value"), F.col("_sep")))
    at = lambda c: F.when(F.col(f"_{c}") >= 0, F.trim(F.get("_p", F.col(f"_{c}"))))
    num = lambda c: F.replace(at(c), F.lit(","), F.lit(".")).try_cast("double")
    # parsed once: the medians read the numbers several times
    rows = cut(parts.select("path", "seq", F.upper(at("type")).alias("type"), num("e").alias("e"), num("n").alias("n"), num("z").alias("z")))
    med = exact_quantiles(rows.select("path", F.lit("e").alias("a"), F.col("e").alias("v")).unionByName(rows.select("path", F.lit("n").alias("a"), F.col("n").alias("v"))), ["path", "a"], "v", [0.5], "_q")
    swap = med.groupBy("path").agg(
        (F.max(F.when(F.col("a") == "e", F.col("_q")[0])) >= 1e6).alias("_em"), (F.max(F.when(F.col("a") == "n", F.col("_q")[0])) >= 1e6).alias("_nm"))
    out = checked_join(rows, swap, files, ["path"], ["seq"], "left").withColumn("_swap", F.coalesce(F.col("_em") & ~F.coalesce("_nm", F.lit(False)), F.lit(False)))
    return out.filter("e IS NOT NULL AND n IS NOT NULL").select(
        "path", "seq", "type", F.when(F.col("_swap"), F.col("n")).otherwise(F.col("e")).alias("e"),
        F.when(F.col("_swap"), F.col("e")).otherwise(F.col("n")).alias("n"), "z")


def read_survey_points(spark: SparkSession, path: str) -> DataFrame:
    return parse_survey_points(text_lines(spark, path))


def read_rinex_spans(spark: SparkSession, path: str) -> DataFrame:
    """First and last observation clock time of each observation file."""
    from ..operators.flight import rinex_spans

    return rinex_spans(text_lines(spark, path))


def read_antenna_height(spark: SparkSession, path: str) -> DataFrame:
    """``folder, height``: note files whose name has a keyword first, then name order, first value found."""
    from ..functions.text import antenna_height, strip_accents

    notes = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.txt").select(F.col("_metadata.file_path").alias("path"), "value")
    name = F.replace(F.lower(strip_accents(F.element_at(F.split("path", "/"), -1))), F.lit(" "), F.lit(""))
    named = F.regexp_like(name, F.lit("antena|antea|altura"))
    h = notes.withColumn("folder", F.regexp_replace("path", "/[^/]*$", "")).withColumn("_named", named).withColumn("_h", antenna_height(F.col("value")))
    any_named = h.groupBy("folder").agg(F.max("_named").alias("_any"))
    pick = h.join(any_named, "folder").filter(F.col("_named") | ~F.col("_any"))
    return pick.groupBy("folder").agg(F.min_by("_h", F.when(F.col("_h").isNotNull(), F.col("path"))).alias("height"))


def parse_registry(docs: DataFrame) -> DataFrame:
    """One row per property from documents with ``results``: id, name (with fallback) and main owner.

    The main owner is the first of type "proprietario", else the first listed.
    """
    items = docs.select(F.explode("results").alias("r"))
    owners = F.filter("r.proprietarios", lambda p: F.lower(F.coalesce(p["tipo"], F.lit(""))) == "proprietario")
    main = F.coalesce(F.get(owners, F.lit(0)), F.get("r.proprietarios", F.lit(0)))
    some = lambda c: F.nullif(F.col(c), F.lit(""))
    return items.select(
        F.col("r._id").alias("property_id"), F.coalesce(some("r.nomepropriedade"), some("r.nome")).alias("property_name"),
        main["nome"].alias("owner_name"), main["cpf"].alias("owner_document"))


REGISTRY = "results array<struct<_id:string,nomepropriedade:string,nome:string,proprietarios:array<struct<tipo:string,nome:string,cpf:string>>>>"


def read_registry_json(spark: SparkSession, path: str) -> DataFrame:
    return parse_registry(spark.read.schema(REGISTRY).json(path, multiLine=True))


def read_class_map(spark: SparkSession, path: str) -> DataFrame:
    """``las_class, label`` from a small JSON map; a byte-order mark is ignored."""
    text = spark.read.text(path, wholetext=True).select(F.regexp_replace("value", "^\\uFEFF", "").alias("v"))
    return text.select(F.explode(F.from_json("v", "map<string,int>")).alias("k", "label")).select(F.col("k").cast("int").alias("las_class"), "label")


def read_class_list(spark: SparkSession, path: str) -> DataFrame:
    """``las_class`` rows from a small JSON list."""
    text = spark.read.text(path, wholetext=True).select(F.regexp_replace("value", "^\\uFEFF", "").alias("v"))
    return text.select(F.explode(F.from_json("v", "array<int>")).alias("las_class"))


FEATURE = "type string, properties map<string,string>, geometry struct<type:string,coordinates:string>"


def read_features(
    spark: SparkSession, path: str, kinds: tuple[str, ...] = ("Polygon", "MultiPolygon"), multiline: bool = False
) -> DataFrame:
    """``properties, kind, ring, parts, area`` (or ``line, lines, length``) from GeoJSON features and FeatureCollections.

    One document per line, or with ``multiline`` one per file.  ``parts`` holds every polygon as its outer ring and
    its holes, ``ring`` the outer ring of the largest one, and ``area`` is that of all parts without their holes.
    Other geometry types, empty and null geometries drop out; a document that is no feature raises.
    """
    found = spark.read.schema(f"{FEATURE}, features array<struct<{FEATURE.replace(' string', ':string').replace(' map', ':map').replace(' struct', ':struct')}>>").json(path, multiLine=multiline)
    one = F.array(F.struct("type", "properties", "geometry"))
    unknown = F.raise_error(F.lit("a document is neither a Feature nor a FeatureCollection (several lines need multiline=True)"))
    items = F.when(F.col("type") == "FeatureCollection", F.col("features")).when(F.col("type") == "Feature", one).otherwise(unknown)
    raw = found.select(F.explode(items).alias("f")).select("f.*").filter(F.col("geometry.type").isin(*kinds))
    kind, text = F.col("geometry.type"), F.col("geometry.coordinates")
    pts = lambda c: F.transform(c, lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))
    if not any("Polygon" in k for k in kinds):
        line = F.when(kind == "LineString", F.array(F.from_json(text, "array<array<double>>"))).otherwise(F.from_json(text, "array<array<array<double>>>"))
        lines = F.filter(F.transform(line, pts), lambda r: F.size(r) >= 2)
        out = raw.select("properties", kind.alias("kind"), lines.alias("lines")).filter(F.size("lines") > 0)
        length = F.aggregate("lines", F.lit(0.0), lambda n, r: n + G.line_length(r))
        return out.select("properties", "kind", _largest("lines", G.line_length).alias("line"), "lines", length.alias("length"))
    poly = F.when(kind == "Polygon", F.array(F.from_json(text, "array<array<array<double>>>"))).otherwise(F.from_json(text, "array<array<array<array<double>>>>"))
    rings = F.transform(poly, lambda p: F.transform(p, lambda r: G.open_ring(pts(r))))
    parts = F.transform(
        F.filter(rings, lambda p: F.size(F.get(p, F.lit(0))) >= 3),
        lambda p: F.struct(p[0].alias("ring"), F.filter(F.slice(p, 2, F.greatest(F.size(p), F.lit(1))), lambda h: F.size(h) >= 3).alias("holes")),
    )
    out = raw.select("properties", kind.alias("kind"), parts.alias("parts")).filter(F.size("parts") > 0)
    net = F.aggregate("parts", F.lit(0.0), lambda n, p: n + part_area(p))
    outer = _largest(F.transform("parts", lambda p: p["ring"]), G.ring_area)
    return out.select("properties", "kind", outer.alias("ring"), "parts", net.alias("area"))


def _largest(shapes, measure) -> Column:
    """The shape of the largest measure, the first of equal ones."""
    ranked = F.transform(shapes, lambda r, i: F.struct(measure(r).alias("s"), (-i).alias("i"), r.alias("r")))
    return F.array_max(ranked)["r"]


def part_area(part: Column) -> Column:
    """Area of a polygon part without its holes."""
    return G.ring_area(part["ring"]) - F.aggregate(part["holes"], F.lit(0.0), lambda n, h: n + G.ring_area(h))


def feature_parts(features: DataFrame, feature_id: str) -> DataFrame:
    """One row per polygon part of features: ``feature_id, part, ring, holes, area``."""
    rows = features.select(feature_id, F.posexplode("parts").alias("part", "_p"))
    return rows.select(feature_id, "part", F.col("_p.ring").alias("ring"), F.col("_p.holes").alias("holes"), part_area(F.col("_p")).alias("area"))


def split_roads(features: DataFrame, name: Column) -> tuple[DataFrame, DataFrame]:
    """Features and roads, roads by a name with ESTRADA."""
    from ..functions.text import strip_accents

    road = F.coalesce(F.upper(strip_accents(name)).contains("ESTRADA"), F.lit(False))
    return features.filter(~road), features.filter(road)


def list_files(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """``path, length, modificationTime`` of all files below ``root``; contents are never read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(root).select("path", "length", "modificationTime")


def read_log_table(spark: SparkSession, path: str, date_column: str, header_row: int = 4) -> DataFrame:
    """Crew log CSV with its header on row 4 of each file: trimmed column names, bad dates become null.

    Every file has its own header; a column that a file does not have is null there.
    """
    lines = text_lines(spark, path)
    # the first rows of a file only: ranks are cut at the header row before the shuffle
    rank = F.row_number().over(Window.partitionBy("path").orderBy("seq"))
    top = lines.withColumn("_r", rank).filter(F.col("_r") <= header_row).filter(F.col("_r") == header_row)
    width = (top.agg(F.max(F.size(F.split("value", ",")))).first()[0] or 0) + 1
    columns = ", ".join(f"`c{i}` string" for i in range(width))
    fields = lambda c: F.array(*[F.trim(F.from_csv(c, F.lit(columns))[f"c{i}"]) for i in range(width)])
    head = top.select("path", fields("value").alias("_h"), F.col("seq").alias("_s"))
    named = head.select(F.explode("_h").alias("n")).filter("n <> ''").distinct()
    names = sorted(r["n"] for r in named.collect())  # column names only
    body = lines.join(head, "path").filter(F.col("seq") > F.col("_s")).withColumn("_v", fields("value"))
    value = lambda n: F.get("_v", F.array_position("_h", n).cast("int") - 1)
    out = body.select("seq", *[value(n).alias(n) for n in names])
    day = F.coalesce(F.col(date_column).try_cast("date"), F.try_to_timestamp(F.col(date_column), F.lit("dd/MM/yyyy")).cast("date"))
    return out.withColumn(date_column, day)
