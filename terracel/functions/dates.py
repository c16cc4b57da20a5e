"""Date and time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed value: 1980-01-06 in Unix seconds (no leap seconds)
GPS_EPOCH = 315964800

# fixed values: date texts accepted, with and without a year
DATE_FORMATS = ("dd/MM/yyyy", "yyyy-MM-dd", "dd-MM-yyyy", "dd.MM.yyyy", "dd/MM/yy", "dd-MM-yy", "dd.MM.yy")
SHORT_DATE = r"^(\d{1,2})[/.-](\d{1,2})$"


def gps_timestamp(week: Column, seconds: Column) -> Column:
    """GPS week and seconds of week as a timestamp."""
    return F.timestamp_seconds(F.lit(GPS_EPOCH) + week.cast("long") * 604800 + seconds)


def gps_text(week: Column, seconds: Column) -> Column:
    """``yyyy-MM-ddTHH:mm:ss`` of a GPS time, empty where a part is missing."""
    return F.coalesce(F.date_format(gps_timestamp(week, seconds), "yyyy-MM-dd'T'HH:mm:ss"), F.lit(""))


def spreadsheet_date(serial: Column) -> Column:
    """Date of a spreadsheet serial (day 0 is 1899-12-30)."""
    return F.date_add(F.lit("1899-12-30").cast("date"), F.floor(serial).cast("int"))


def parse_date(text: Column, year: int) -> Column:
    """Date from the accepted text forms; ``dd/MM`` gets ``year``."""
    t = F.trim(text)
    shapes = {
        "dd/MM/yyyy": r"^\d{1,2}/\d{1,2}/\d{4}$", "yyyy-MM-dd": r"^\d{4}-\d{1,2}-\d{1,2}$",
        "dd-MM-yyyy": r"^\d{1,2}-\d{1,2}-\d{4}$", "dd.MM.yyyy": r"^\d{1,2}\.\d{1,2}\.\d{4}$",
        "dd/MM/yy": r"^\d{1,2}/\d{1,2}/\d{2}$", "dd-MM-yy": r"^\d{1,2}-\d{1,2}-\d{2}$",
        "dd.MM.yy": r"^\d{1,2}\.\d{1,2}\.\d{2}$",
    }
    tries = [
        F.try_to_timestamp(F.when(F.regexp_like(t, F.lit(shapes[f])), t), F.lit(f.replace("dd", "d").replace("MM", "M"))).cast("date")
        for f in DATE_FORMATS
    ]
    short = F.concat_ws(
        "-", F.lit(str(year)),
        F.when(F.regexp_like(t, F.lit(SHORT_DATE)), F.lpad(F.regexp_extract(t, SHORT_DATE, 2), 2, "0")),
        F.lpad(F.regexp_extract(t, SHORT_DATE, 1), 2, "0"),
    )
    return F.coalesce(*tries, short.try_cast("date"))


def day_of_year_text(day: Column, year: int | None = None) -> Column:
    """``DDD_YYYY``; a forced year moves the date there first."""
    if year is not None:
        moved = F.concat(F.lit(f"{year}-"), F.date_format(day, "MM-dd")).try_cast("date")
        return F.concat(F.lpad(F.dayofyear(moved).cast("string"), 3, "0"), F.lit(f"_{year}"))
    return F.concat(F.lpad(F.dayofyear(day).cast("string"), 3, "0"), F.lit("_"), F.year(day).cast("string"))


def shift_clock(text: Column, hours: int = -3) -> Column:
    """``HH:mm:ss`` moved by whole hours, wrapping at midnight."""
    p = F.split(text, ":")
    sec = F.pmod(p[0].cast("int") * 3600 + p[1].cast("int") * 60 + p[2].cast("int") + hours * 3600, F.lit(86400))
    return F.format_string("%02d:%02d:%02d", F.floor(sec / 3600), F.floor(sec % 3600 / 60), sec % 60)


def folder_date(name: Column) -> Column:
    """Date of a folder called ``yyyyMMdd_...``; null for other names."""
    digits = F.regexp_extract(name, r"^(\d{8})_", 1)
    return F.try_to_timestamp(F.nullif(digits, F.lit("")), F.lit("yyyyMMdd")).cast("date")
