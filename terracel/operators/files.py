"""File and folder operators: rules, counts, sizes, counterparts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..core.skew import salted_join
from ..functions import text as X
from ..functions.numbers import size_text

# fixed values: sheets expected per lot and block
EXPECTED_SHEETS = {
    ("LOTE_09", "BLOCO_A"): 216, ("LOTE_09", "BLOCO_B"): 192, ("LOTE_09", "BLOCO_C"): 216,
    ("LOTE_09", "BLOCO_D"): 192, ("LOTE_09", "BLOCO_E"): 216, ("LOTE_09", "BLOCO_F"): 216,
    ("LOTE_09", "BLOCO_G"): 216, ("LOTE_09", "BLOCO_H"): 192, ("LOTE_09", "BLOCO_I"): 255,
    ("LOTE_09", "BLOCO_J"): 192, ("LOTE_09", "BLOCO_K"): 128, ("LOTE_10", "BLOCO_I"): 240,
    ("LOTE_10", "BLOCO_J"): 199, ("LOTE_10", "BLOCO_M"): 143, ("LOTE_10", "BLOCO_N"): 149,
}

# fixed values: where files of a product may lie (top folder, folders below the block, extensions)
PATH_RULES = (
    ("5_NUVEM_PONTOS", "1_NP/1_1_LAS", "las laz prj"),
    ("5_NUVEM_PONTOS", "2_NPC_COMPLETO/2_1_LAS", "las laz prj"),
    ("5_NUVEM_PONTOS", "2_NPC_COMPLETO/2_2_LASDATASET", "lasd prj"),
    ("6_MDS", "1_GEOTIFF", "tif tiff prj"),
    ("7_MDT", "1_LAS", "las laz prj"),
    ("7_MDT", "2_LASDATASET", "lasd prj"),
    ("7_MDT", "3_ASCII", "txt asc xyz csv prj"),
    ("7_MDT", "4_GEOTIFF", "tif tiff prj"),
    ("8_IMG_HIPSOMETRICA_COMPOSTA", "1_GEOTIFF", "tif tiff prj"),
    ("8_IMG_HIPSOMETRICA_COMPOSTA", "2_METADADOS", "txt"),
    ("9_IMG_INTENSIDADE", "1_GEOTIFF", "tif tiff prj"),
    ("9_IMG_INTENSIDADE", "2_METADADOS", "txt"),
)

# fixed values: folder words that raise an alert, in order
ALERT_WORDS = (
    "stripalign", "lms", "temp", "out_area", "out area", "trj", "mms_panoramica", "mms panoramica", "develop",
)

# fixed values: side-file extensions by image extension
SIDE_EXTENSIONS = {
    "tif": ("tfw", "tifw", "wld"), "tiff": ("tfw", "tifw", "wld"),
    "jpg": ("jgw", "jgwx", "wld"), "jpeg": ("jgw", "jgwx", "wld"), "jpe": ("jgw", "jgwx", "wld"),
    "jfif": ("jgw", "jgwx", "wld"), "png": ("pgw", "wld"), "jp2": ("j2w", "wld"),
    "j2k": ("j2w", "wld"), "j2c": ("j2w", "wld"), "bmp": ("bpw", "wld"),
}

MB, GB = 1024**2, 1024**3


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def file_stem(path: Column) -> Column:
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]*$", "")


def file_ext(path: Column) -> Column:
    return F.lower(F.regexp_extract(file_name(path), r"(?<=.)\.([^.]*)$", 1))


def folder_of(path: Column) -> Column:
    return F.regexp_replace(path, "/[^/]*$", "")


def filter_files(
    files: DataFrame, extensions: Sequence[str] = (), ignored_folders: Sequence[str] = (),
    ignored_names: Sequence[str] = (),
) -> DataFrame:
    """Catalog rows by extension, without ignored folders (any level) and names."""
    out = files
    if extensions:
        out = out.filter(file_ext(F.col("path")).isin(*[e.lower() for e in extensions]))
    if ignored_folders:
        bad = F.array(*[F.lit(f.upper()) for f in ignored_folders])
        folders = F.transform(F.split(folder_of(F.col("path")), "/"), F.upper)
        out = out.filter(~F.arrays_overlap(folders, bad))
    if ignored_names:
        out = out.filter(~F.lower(file_name(F.col("path"))).isin(*[n.lower() for n in ignored_names]))
    return out


def date_folders(folders: DataFrame, name: str = "folder", dates: Sequence[str] | None = None) -> DataFrame:
    """Folders called ``yyyyMMdd_...`` with their ``day``; other names and unwanted days drop out."""
    from ..functions.dates import folder_date

    out = folders.withColumn("day", folder_date(F.col(name))).filter(F.col("day").isNotNull())
    return out if dates is None else out.filter(F.col("day").isin(*[F.lit(d).cast("date") for d in dates]))


def match_ids(files: DataFrame, ids: DataFrame, name: str, wanted: str, strict: bool = True) -> DataFrame:
    """Files whose name holds one of the ids; strict ids touch no other digit.

    Strict digit ids join on the digit runs of the name.  Loose ids join on every stretch of the
    name that has the length of some id, so no file meets ids it cannot hold.
    """
    ids = ids.select(F.col(wanted).cast("string").alias("_id")).distinct()
    if strict:
        runs = F.regexp_extract_all(F.col(name), F.lit(r"(\d+)"), 1)
        keyed = files.withColumn("_id", F.explode(F.array_distinct(runs)))
    else:
        # one bounded array: the distinct id lengths
        lengths = ids.agg(F.collect_set(F.length("_id")).alias("_lens"))
        starts = lambda n: F.transform(
            F.sequence(F.lit(1), F.greatest(F.length(name) - n + 1, F.lit(1))), lambda i: F.substr(F.col(name), i, n)
        )
        keyed = (
            files.crossJoin(F.broadcast(lengths))  # one row
            .withColumn("_id", F.explode(F.array_distinct(F.flatten(F.transform("_lens", starts)))))
            .drop("_lens")
        )
    return salted_join(keyed, ids, ["_id"], [name]).withColumnRenamed("_id", "matched_id")


def check_paths(files: DataFrame, base: str) -> DataFrame:
    """Files under ``base`` whose path breaks the product/lot/block/folder/extension rules."""
    rel = X.normal_part(F.regexp_replace("path", f"^{base}/*", ""))
    shapes = [
        rf"{top}/LOTE_[^/]*/BLOCO_[A-Z]/{below}/(?:[^/]+/)*[^/]+\.(?:{extensions.upper().replace(' ', '|')})"
        for top, below, extensions in PATH_RULES
    ]
    return files.filter(~F.regexp_like(rel, F.lit("^(?:" + "|".join(shapes) + ")$")))


def folder_sizes(files: DataFrame, depth_from: int = 1) -> DataFrame:
    """Bytes and file counts of every folder over all descendants.

    Each file names its ancestors; sums are combined map-side before the shuffle.
    """
    parts = F.split(folder_of(F.col("path")), "/")
    ancestors = F.transform(
        F.sequence(F.lit(depth_from + 1), F.greatest(F.size(parts), F.lit(depth_from + 1))),
        lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"),
    )
    ext = file_ext(F.col("path"))
    return (
        files.withColumn("folder", F.explode(F.array_distinct(ancestors)))
        .groupBy("folder")
        .agg(
            F.sum("length").alias("bytes"), F.count(F.lit(1)).alias("n_files"),
            F.count_if(ext.isin("las", "laz")).alias("n_points"),
            F.count_if(ext.isin("tif", "tiff")).alias("n_rasters"),
        )
    )


def folder_alerts(files: DataFrame, root: str) -> DataFrame:
    """Folders at least two levels below ``root`` with alert text, bytes and size text.

    Alerts: first alert word in the name, an "rt" folder of 100 MB or more, point files
    directly inside.  Alerting folders below 1 MB drop out; only alerting folders of 1 GB or more
    are for the report (``in_report``).
    """
    sizes = folder_sizes(files).select("folder", "bytes")
    direct = files.groupBy(folder_of(F.col("path")).alias("folder")).agg(
        F.max(file_ext(F.col("path")).isin("las", "laz")).alias("_points")
    )
    rel = F.split(F.regexp_replace("folder", f"^{root}/*", ""), "/")
    name = F.lower(F.trim(F.element_at(rel, -1)))
    word = F.lit(None).cast("string")
    for w in reversed(ALERT_WORDS):
        word = F.when(name.contains(w), F.lit(f"palavra-chave: {w}")).otherwise(word)
    big_rt = F.when((name == "rt") & (F.col("bytes") >= 100 * MB), "pasta rt >= 100MB")
    points = F.when(F.col("_points"), "contém LAS/LAZ")
    alerts = F.array_sort(F.array_compact(F.array(word, big_rt, points)))
    return (
        sizes.filter(F.startswith("folder", F.lit(root + "/")))
        .join(direct, "folder", "left")
        .filter(F.size(rel) >= 2)
        .withColumn("project", F.get(rel, F.lit(0)))
        .withColumn("alert", F.array_join(alerts, ", "))
        .filter((F.col("alert") == "") | (F.col("bytes") >= MB))
        .select("folder", "project", "alert", "bytes", size_text(F.col("bytes")).alias("size"),
                ((F.col("alert") != "") & (F.col("bytes") >= GB)).alias("in_report"))
    )


def folder_name_overlap(files: DataFrame, root: str) -> DataFrame:
    """Pairs of point folders of one project that share file stems, with the shared count.

    A pair needs one row per shared stem, which is the answer's own size.
    """
    rel = F.split(F.regexp_replace("path", f"^{root}/*", ""), "/")
    stems = (
        filter_files(files, ["las", "laz"])
        .select(F.get(rel, F.lit(0)).alias("project"), folder_of(F.col("path")).alias("folder"),
                F.lower(file_stem(F.col("path"))).alias("stem"))
        .distinct()
    )
    # folders sharing one stem: pairs of folders, not of files
    a, b = (stems.withColumnRenamed("folder", f"folder_{s}").alias(s) for s in "ab")
    # null project or stem is a group of its own
    same = F.col("a.project").eqNullSafe(F.col("b.project")) & F.col("a.stem").eqNullSafe(F.col("b.stem"))
    return (
        a.join(b, same & (F.col("folder_a") < F.col("folder_b")))
        .groupBy("a.project", "folder_a", "folder_b")
        .agg(F.count(F.lit(1)).alias("shared"))
    )


def count_check(files: DataFrame, expected: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Actual against expected file counts; groups without files count 0."""
    actual = files.groupBy(*keys).agg(F.count(F.lit(1)).alias("actual"))
    return (
        expected.join(actual, list(keys), "left")
        .withColumn("actual", F.coalesce("actual", F.lit(0)))
        .withColumn("delta", F.col("actual") - F.col("expected"))
    )


def expected_sheets(spark) -> DataFrame:
    """The fixed expected counts as a table."""
    rows = [(lote, bloco, n) for (lote, bloco), n in EXPECTED_SHEETS.items()]
    return spark.createDataFrame(rows, "lote string, bloco string, expected int")


def expected_dataset_name(lote: Column, bloco: Column) -> Column:
    yy = F.coalesce(F.lpad(X.found(lote, r"(\d{1,2})"), 2, "0"), F.lit("00"))
    bx = F.coalesce(X.found(X.normal_part(bloco), r"BLOCO_([A-Z])"), F.lit("X"))
    return F.concat(F.lit("ES_L"), yy, F.lit("_"), bx, F.lit("_NPc_C_R0.lasd"))


def dataset_check(files: DataFrame, groups: DataFrame) -> DataFrame:
    """Exactly one dataset file per lot and block, with the expected name."""
    sets = filter_files(files, ["lasd"]).groupBy("lote", "bloco").agg(
        F.count(F.lit(1)).alias("n"), F.min(file_name(F.col("path"))).alias("name")
    )
    want = expected_dataset_name(F.col("lote"), F.col("bloco"))
    n = F.coalesce("n", F.lit(0))
    return (
        groups.join(sets, ["lote", "bloco"], "left")
        .withColumn("n", n)
        .withColumn("status", F.when(F.col("n") != 1, "count").when(F.col("name") != want, "name").otherwise("ok"))
    )


def status_summary(log: DataFrame, status: str = "status") -> DataFrame:
    """Rows per status and the overall ok, skipped and error counts are one group-by away."""
    return log.groupBy(status).agg(F.count(F.lit(1)).alias("n"))


def missing_names(a: DataFrame, b: DataFrame, name: str = "stem", direction: str = "auto") -> DataFrame:
    """Names without a counterpart after normalising: ``side, key, name``.

    ``a`` or ``b`` names the reference side whose names are looked for in the other;
    ``auto`` takes the side with fewer keys, ``both`` reports both sides.
    """
    key = X.compare_key(F.col(name))
    ka = a.groupBy(key.alias("key")).agg(F.min(name).alias("name"))
    kb = b.groupBy(key.alias("key")).agg(F.min(name).alias("name"))
    if direction == "auto":
        direction = "a" if ka.count() <= kb.count() else "b"
    parts = []
    if direction in ("a", "both"):
        parts.append(ka.join(kb, "key", "left_anti").select(F.lit("a").alias("side"), "key", "name"))
    if direction in ("b", "both"):
        parts.append(kb.join(ka, "key", "left_anti").select(F.lit("b").alias("side"), "key", "name"))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def match_by_sheet(products: DataFrame, las: DataFrame) -> DataFrame:
    """Best point file for each product by sheet id: ``stem, lote, bloco, las_path``.

    Several files of one sheet are ranked by lot (+20) and block (+20) in their path, then by
    path.  Each distinct (sheet, lot, block) question is asked once, so a sheet with many
    products does not multiply its files.
    """
    asked = products.withColumn("_sheet", X.sheet_id(F.col("stem")))
    questions = asked.filter(F.col("_sheet").isNotNull()).select("_sheet", "lote", "bloco").distinct()
    files = las.select(X.sheet_id(file_stem(F.col("path"))).alias("_sheet"), "path").filter(F.col("_sheet").isNotNull())
    where = X.letters_digits(F.col("path"))
    points = lambda c: F.when(
        (X.letters_digits(F.col(c)) != "") & F.contains(where, X.letters_digits(F.col(c))), 20).otherwise(0)
    best = (
        salted_join(files, questions, ["_sheet"], ["path"])
        .groupBy("_sheet", "lote", "bloco")
        .agg(F.max(F.struct((points("lote") + points("bloco")).alias("s"), "path")).alias("_b"))
        .select("_sheet", "lote", "bloco", F.col("_b.path").alias("las_path"))
    )
    return salted_join(asked, best, ["_sheet", "lote", "bloco"], ["stem"], "left").drop("_sheet")


def find_sidecar(images: DataFrame, files: DataFrame, path: str = "path") -> DataFrame:
    """First existing side file of each image in priority order: ``path, side_path``."""
    p = F.col(path)
    base = F.regexp_replace(p, r"\.[^./]*$", "")
    ext = file_ext(p)
    exts = F.array(F.lit("wld"))
    for e, names in SIDE_EXTENSIONS.items():
        exts = F.when(ext == e, F.array(*[F.lit(n) for n in names])).otherwise(exts)
    names = F.flatten(F.transform(exts, lambda e: F.array(
        F.concat(base, F.lit("."), e), F.concat(base, F.lit("0."), e), F.concat(base, F.lit("."), e, F.lit("0")))))
    asked = images.select(path, F.posexplode(names).alias("_rank", "_side"))
    have = files.select(F.col("path").alias("_side")).distinct()
    found = asked.join(have, "_side").groupBy(path).agg(F.min_by("_side", "_rank").alias("side_path"))
    return images.join(found, path, "left")


def route_by_membership(
    files: DataFrame, listed: DataFrame, key: Column, listed_key: str, small_below: float, size: str = "area"
) -> DataFrame:
    """Route of each file: ``other`` (not listed), ``small`` (listed, small area) or ``main``."""
    known = listed.groupBy(F.col(listed_key).alias("_k")).agg(F.max(size).alias("_size"))
    return (
        files.withColumn("_k", key)
        .transform(lambda d: salted_join(d, known, ["_k"], ["path"], "left"))
        .withColumn("route", F.when(F.col("_size").isNull(), "other").when(F.col("_size") < small_below, "small").otherwise("main"))
        .drop("_k", "_size")
    )


def first_of(rows: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """First row of each key in input order (paths, unordered segments)."""
    rest = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.col(order)).alias("_r"))
    return best.select(*keys, "_r.*")


def reference_pool(patches: DataFrame, refs: DataFrame, path: str = "path") -> DataFrame:
    """Patches followed by references, each path once."""
    cols = [path, "seq"]
    both = patches.select(*cols, F.lit(0).alias("_s")).unionByName(refs.select(*cols, F.lit(1).alias("_s")))
    best = both.groupBy(path).agg(F.min(F.struct("_s", "seq")).alias("_o"))
    return best.select(path, F.col("_o._s").alias("source"), F.col("_o.seq").alias("seq"))
