"""Flight operators: plans, strips, logs, tracks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..core.grid import cell, cover
from ..core.lineage import cut
from ..core.numbering import number_rows
from ..core.skew import exploded, salted_join
from ..functions.geometry import segment_distance
from ..functions.numbers import knots_to_ms, metres_to_feet, ms_to_knots


def plan_columns(plan: DataFrame) -> DataFrame:
    """Flight plan sheet: "lat lon" text into two columns, metres into kilometres."""
    start, end = F.split(F.trim("first_event"), r"\s+"), F.split(F.trim("last_event"), r"\s+")
    num = lambda c, i: F.get(c, F.lit(i)).try_cast("double")
    return plan.select(
        "line", num(start, 0).alias("start_lat"), num(start, 1).alias("start_lon"),
        num(end, 0).alias("end_lat"), num(end, 1).alias("end_lon"),
        (F.col("length_m") / 1000).alias("length_km"),
    )


def strip_report(strips: DataFrame) -> DataFrame:
    """GPS start and stop as text, altitude in feet and speed in knots, one decimal."""
    from ..functions.dates import gps_text

    return strips.select(
        "*",
        gps_text(F.col("gps_week"), F.col("gps_start")).alias("start_text"),
        gps_text(F.col("gps_week"), F.col("gps_stop")).alias("stop_text"),
        F.round(metres_to_feet(F.col("altitude_m")), 1).alias("altitude_ft"),
        F.round(ms_to_knots(F.col("speed_ms")), 1).alias("speed_kn"),
    )


def nearest_line(
    points: DataFrame, lines: DataFrame, reach: float | None, point_id: str, line_id: str,
    xy=("x", "y"), ends=("x1", "y1", "x2", "y2"), start: float = 100.0, grow: float = 8.0,
) -> DataFrame:
    """Closest segment of each point: ``point_id, line_id, dist``, lowest id on ties; within ``reach`` if it is given.

    Segments are laid over grid cells of side ``reach`` around their box; long ones are cut
    to the cells near the segment itself.  Without a limit the reach grows from ``start`` for the points still open.
    """
    if reach is None:
        fits = lambda c: F.col(c).isNotNull() & ~F.isnan(c)
        open_, reach, done = points.filter(fits(xy[0]) & fits(xy[1])), start, None
        some = not lines.isEmpty()
        while True:
            found = cut(nearest_line(open_, lines, reach, point_id, line_id, xy, ends))
            done = found if done is None else done.unionByName(found)
            open_ = cut(open_.join(found.select(point_id), point_id, "left_anti"))
            if not some or open_.isEmpty():
                return done
            reach *= grow
    px, py = (F.col(c) for c in xy)
    x1, y1, x2, y2 = (F.col(c) for c in ends)
    # of lines along the same segment the lowest id is the one to find
    single = lines.groupBy(*ends).agg(F.min(F.struct(line_id)).alias("_id")).select(*ends, F.col(f"_id.{line_id}").alias(line_id))
    laid = cells_along(single, reach, ends)
    keyed = points.withColumn("_cx", cell(px, reach)).withColumn("_cy", cell(py, reach))
    d = segment_distance(px, py, x1, y1, x2, y2)
    near = salted_join(keyed, laid, ["_cx", "_cy"], [point_id]).withColumn("_d", d).filter(F.col("_d") <= reach)
    best = near.groupBy(point_id).agg(F.min(F.struct("_d", line_id)).alias("_b"))
    return best.select(point_id, F.col(f"_b.{line_id}").alias(line_id), F.col("_b._d").alias("dist"))


def cells_along(lines: DataFrame, reach: float, ends=("x1", "y1", "x2", "y2")) -> DataFrame:
    """Segments repeated over every cell of side ``reach`` within ``reach`` of them.

    Column by column of the grid, only the rows the segment passes (plus the reach) are kept, so
    a long diagonal costs its length and not its box.
    """
    x1, y1, x2, y2 = (F.col(c) for c in ends)
    lox, hix = F.least(x1, x2), F.greatest(x1, x2)
    cols = lines.withColumn("_cx", F.explode(F.sequence(cell(lox - reach, reach), cell(hix + reach, reach))))
    # part of the segment within one reach of this column
    a = F.greatest(lox, (F.col("_cx") - 1) * reach)
    b = F.least(hix, (F.col("_cx") + 2) * reach)
    slope = (y2 - y1) / F.nullif(x2 - x1, F.lit(0.0))
    ya, yb = y1 + (a - x1) * slope, y1 + (b - x1) * slope
    lo = F.when(slope.isNull(), F.least(y1, y2)).otherwise(F.least(ya, yb))
    hi = F.when(slope.isNull(), F.greatest(y1, y2)).otherwise(F.greatest(ya, yb))
    return exploded(cols.withColumn("_cy", F.explode(F.sequence(cell(lo - reach, reach), cell(hi + reach, reach)))))


def crew_for_day(strips: DataFrame, log: DataFrame, day: str = "day") -> DataFrame:
    """First log row of the strip's day; blanks when there is none."""
    first = log.groupBy(day).agg(F.min_by(F.struct("pilot", "operator", "note"), "seq").alias("_c"))
    blank = lambda c: F.coalesce(F.col(f"_c.{c}"), F.lit(""))
    joined = salted_join(strips, first, [day], ["strip_no"], "left")
    return joined.select("*", *[blank(c).alias(c) for c in ("pilot", "operator", "note")]).drop("_c")


def agl_profile(
    lines: DataFrame, cells: DataFrame, size: float, line_id: str, n: int = 100, height: float = 1400.0,
    nodata: float | None = None, speed_kn: float = 120.0,
) -> DataFrame:
    """Terrain profile of planned lines: flying height, min and max height above ground, length, minutes.

    ``n`` evenly spaced samples; flying height is the first valid terrain value plus ``height``.
    """
    from .vertical import sample_raster

    t = F.col("_i") / F.lit(n - 1.0)
    pts = lines.withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).select(
        line_id, "_i", (F.col("x1") + t * (F.col("x2") - F.col("x1"))).alias("x"),
        (F.col("y1") + t * (F.col("y2") - F.col("y1"))).alias("y"),
        F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")).alias("_len"),
    )
    prof = sample_raster(pts, cells, size, "_e", nodata)
    agg = prof.groupBy(line_id).agg(
        F.min_by("_e", F.when(F.col("_e").isNotNull(), F.col("_i"))).alias("_first"),
        F.min("_e").alias("_lo"), F.max("_e").alias("_hi"), F.first("_len").alias("length_m"),
    )
    alt = F.col("_first") + height
    return agg.select(
        line_id, alt.alias("alt_msl"), (alt - F.col("_hi")).alias("min_agl"), (alt - F.col("_lo")).alias("max_agl"),
        "length_m", (F.col("length_m") / knots_to_ms(F.lit(speed_kn)) / 60).alias("minutes"),
    )


def day_summary(strips: DataFrame, day: str = "day") -> DataFrame:
    """Strip count, mean speed in knots, mean terrain height and lowest block name per day."""
    return strips.groupBy(day).agg(
        F.count(F.lit(1)).alias("strips"), F.avg(ms_to_knots(F.col("speed_ms"))).alias("speed_kn"),
        F.avg("terrain").alias("terrain"), F.min("block").alias("first_block"),
    )


def number_flight_lines(lines: DataFrame, block: str, y: str, line_id: str, prefix: str = "L") -> DataFrame:
    """Running line numbers: blocks in name order, inside a block from north to south.

    Rows are numbered inside their block and shifted by the lines of the blocks before it.
    """
    inner = number_rows(lines.withColumn("_o", -F.col(y)), [block], "_o", [line_id], "_n").drop("_o")
    counts = lines.groupBy(block).agg(F.count(F.lit(1)).alias("_c"))
    before = Window.orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.withColumn("_s", F.coalesce(F.sum("_c").over(before), F.lit(0))).drop("_c")
    return (
        salted_join(inner, shift, [block], [line_id])
        .withColumn("line_no", F.col("_n") + F.col("_s"))
        .withColumn("code", F.format_string(f"{prefix}%03d", F.col("line_no")))
        .drop("_n", "_s")
    )


def sheet_grid_ids(features: DataFrame, x: str, y: str, step: float = 1000.0) -> DataFrame:
    """Sheet ids 100000 + 1000 * row + column from centroids rounded to ``step``.

    Columns rank by x, rows by y from the north; ranks come from the distinct values only.
    """
    rx, ry = F.round(F.col(x) / step).cast("long"), F.round(F.col(y) / step).cast("long")
    keyed = features.withColumn("_gx", rx).withColumn("_gy", ry)
    cols = keyed.select("_gx").distinct().withColumn("_col", F.row_number().over(Window.orderBy("_gx")))
    rows = keyed.select("_gy").distinct().withColumn("_row", F.row_number().over(Window.orderBy(F.desc("_gy"))))
    return (
        keyed.join(cols, "_gx").join(rows, "_gy")
        .withColumn("sheet_no", F.lit(100000) + F.col("_row") * 1000 + F.col("_col"))
        .drop("_gx", "_gy", "_col", "_row")
    )


def union_tracks(a: DataFrame, b: DataFrame, epsg: int) -> DataFrame:
    """Two track tables as one in one projection; a missing EPSG code is assigned, another zone is moved."""
    from ..functions.crs import rezone

    def aligned(df):
        code = F.coalesce("epsg", F.lit(epsg))
        xy = rezone(F.col("x"), F.col("y"), code, epsg)
        moved = code != epsg
        return df.withColumn("_p", xy).withColumn("x", F.when(moved, F.col("_p.x")).otherwise(F.col("x"))).withColumn(
            "y", F.when(moved, F.col("_p.y")).otherwise(F.col("y"))
        ).drop("_p").withColumn("epsg", F.lit(epsg))

    return aligned(a).unionByName(aligned(b), allowMissingColumns=True)


def rinex_spans(lines: DataFrame) -> DataFrame:
    """First and last observation clock time per file from ``path, value`` header lines."""
    p = F.split(F.trim("value"), r"\s+")
    clock = F.format_string(
        "%02d:%02d:%02d", p[3].cast("int"), p[4].cast("int"), F.floor(p[5].cast("double"))
    )
    hits = lines.filter(F.col("value").rlike("TIME OF (FIRST|LAST) OBS")).withColumn("_t", clock)
    first = F.col("value").contains("FIRST OBS")
    return hits.groupBy("path").agg(
        F.max(F.when(first, F.col("_t"))).alias("first_obs"), F.max(F.when(~first, F.col("_t"))).alias("last_obs")
    )
