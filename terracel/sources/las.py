"""Uncompressed LAS files as a Spark data source (``spark.read.format("las")``).

Files are read where all executors see them (a mounted shared folder).  One partition covers
a range of point records; with ``headerOnly`` each file gives one row without reading points.
"""

from __future__ import annotations

import glob
import math
import os
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

POINTS = (
    "tile_id string, pid long, x double, y double, z double, intensity int, classification int, return_number int, "
    "number_of_returns int, scan_angle float, point_source_id int, gps_time double"
)
HEADERS = "path string, n long, minx double, miny double, minz double, maxx double, maxy double, maxz double, record_bytes int"

# fixed values: place of the GPS time in point formats that have one
GPS_TIME_AT = {1: 20, 3: 20, 4: 20, 5: 20, 6: 22, 7: 22, 8: 22, 9: 22, 10: 22}


def read_header(path: str) -> dict:
    """Counts, scales and box from the public header block."""
    with open(path, "rb") as f:
        h = f.read(375)
    if h[:4] != b"LASF":
        raise ValueError(f"{path} is not a LAS file")
    minor, fmt = h[25], h[104]
    if fmt & 0x80:
        raise ValueError(f"{path} is compressed; convert it to LAS first")
    count = struct.unpack_from("<I", h, 107)[0]
    if minor >= 4:
        count = struct.unpack_from("<Q", h, 247)[0] or count
    nums = struct.unpack_from("<12d", h, 131)
    maxx, minx, maxy, miny, maxz, minz = nums[6:]
    return {
        "offset": struct.unpack_from("<I", h, 96)[0], "format": fmt & 0x3F, "record": struct.unpack_from("<H", h, 105)[0],
        "count": count, "scale": nums[:3], "shift": nums[3:6], "box": (minx, miny, minz, maxx, maxy, maxz),
    }


def decode(raw: bytes, head: dict) -> dict[str, np.ndarray]:
    """Point columns of raw records; dimensions a format lacks get their defaults."""
    size, fmt = head["record"], head["format"]
    rec = np.frombuffer(raw, np.uint8).reshape(-1, size)
    n = len(rec)
    take = lambda at, kind: np.ascontiguousarray(rec[:, at : at + np.dtype(kind).itemsize]).view(kind)[:, 0]
    out = {c: take(4 * i, "<i4") * head["scale"][i] + head["shift"][i] for i, c in enumerate("xyz")}
    out["intensity"] = take(12, "<u2").astype(np.int32)
    flags = rec[:, 14]
    if fmt >= 6:
        out["return_number"], out["number_of_returns"] = flags & 15, flags >> 4
        out["classification"] = rec[:, 16]
        out["scan_angle"] = take(18, "<i2") * np.float32(0.006)
        out["point_source_id"] = take(20, "<u2")
    else:
        out["return_number"], out["number_of_returns"] = flags & 7, (flags >> 3) & 7
        out["classification"] = rec[:, 15] & 31
        out["scan_angle"] = rec[:, 16].view(np.int8)
        out["point_source_id"] = take(18, "<u2")
    at = GPS_TIME_AT.get(fmt)
    out["gps_time"] = take(at, "<f8") if at else np.full(n, np.nan)
    for c in ("return_number", "number_of_returns"):
        out[c] = np.where(out[c] == 0, 1, out[c])
    return out


#: Point ids hold the number of the file, in path order, above so many bits of record number.
RECORD_BITS = 40
#: A partition is cut at bytes; records of common formats take about this many.
RECORD_BYTES = 34


class Records(InputPartition):
    """The point records that start in a byte range of one file (or its header)."""

    def __init__(self, path: str, file_no: int, lo: int, hi: int):
        super().__init__((path, file_no, lo, hi))
        self.path, self.file_no, self.lo, self.hi = path, file_no, lo, hi

    def records(self, head: dict) -> tuple[int, int]:
        """First record and number of records."""
        at = lambda byte: min(max(-(-(byte - head["offset"]) // head["record"]), 0), head["count"])
        return at(self.lo), at(self.hi) - at(self.lo)


class LasReader(DataSourceReader):
    def __init__(self, options, schema):
        self.header_only = options.get("headeronly", options.get("headerOnly", "false")).lower() == "true"
        self.chunk = int(options.get("recordsperpartition", options.get("recordsPerPartition", "2000000")))
        path = options["path"]
        self.paths = sorted(glob.glob(os.path.join(path, "**", "*.las"), recursive=True)) if os.path.isdir(path) else sorted(glob.glob(path))
        self.bounds = {a: [-math.inf, math.inf] for a in "xyz"}

    def pushFilters(self, filters):
        """Bounds of x, y and z that the filters set; they skip files and records, and Spark still applies every filter."""
        for f in [] if self.header_only else filters:
            axis = f.attribute[0] if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)) else None
            if axis in self.bounds and isinstance(f.value, (int, float)) and f.value == f.value:
                low, high = self.bounds[axis]
                if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
                    low = max(low, f.value)
                if isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
                    high = min(high, f.value)
                self.bounds[axis] = [low, high]
        yield from filters

    def misses(self, head: dict) -> bool:
        """Whether the box of a file lies outside the bounds, by more than the step of its coordinates."""
        lo, hi, step = head["box"][:3], head["box"][3:], head["scale"]
        return any(hi[i] + step[i] < low or lo[i] - step[i] > high for i, (low, high) in enumerate(self.bounds.values()))

    def partitions(self):
        if self.header_only:
            return [Records(p, i, 0, 0) for i, p in enumerate(self.paths)] or [Records("", 0, 0, 0)]
        # file lengths only: headers are read by the tasks
        step = self.chunk * RECORD_BYTES
        out = [Records(p, i, lo, lo + step) for i, p in enumerate(self.paths) for lo in range(0, os.path.getsize(p), step)]
        return out or [Records("", 0, 0, 0)]

    def read(self, part):
        if not part.path:
            return
        head = read_header(part.path)
        if self.header_only:
            yield (part.path, head["count"], *head["box"], head["record"])
            return
        if self.misses(head):
            return  # no record is read
        step, (first, count) = 262_144, part.records(head)
        with open(part.path, "rb") as f:
            f.seek(head["offset"] + first * head["record"])
            for done in range(0, count, step):
                n = min(step, count - done)
                cols = decode(f.read(n * head["record"]), head)
                batch = self._batch(part.path, (part.file_no << RECORD_BITS) + first + done, n, cols)
                held = np.ones(n, bool)
                for axis, (low, high) in self.bounds.items():
                    if low > -math.inf or high < math.inf:
                        held &= (cols[axis] >= low) & (cols[axis] <= high)
                yield batch if held.all() else batch.filter(pa.array(held))

    @staticmethod
    def _batch(path, first, n, cols):
        i32 = lambda c: pa.array(cols[c].astype(np.int32))
        f64 = lambda c: pa.array(cols[c].astype(np.float64))
        data = {
            "tile_id": pa.array([os.path.basename(path)] * n), "pid": pa.array(np.arange(first, first + n)),
            "x": f64("x"), "y": f64("y"), "z": f64("z"), "intensity": i32("intensity"), "classification": i32("classification"),
            "return_number": i32("return_number"), "number_of_returns": i32("number_of_returns"),
            "scan_angle": pa.array(cols["scan_angle"].astype(np.float32)), "point_source_id": i32("point_source_id"), "gps_time": f64("gps_time"),
        }
        return pa.RecordBatch.from_pydict(data)


class LasSource(DataSource):
    @classmethod
    def name(cls):
        return "las"

    def schema(self):
        flag = self.options.get("headeronly", self.options.get("headerOnly", "false"))
        return HEADERS if flag.lower() == "true" else POINTS

    def reader(self, schema):
        return LasReader(self.options, schema)


def read_points(spark: SparkSession, path: str, records_per_partition: int = 2_000_000) -> DataFrame:
    """Point records of all ``.las`` files below ``path``; ``pid`` is unique over the files: file number in path order, then record.

    Bounds that filters set on x, y and z reach the scan (this switches ``spark.sql.python.filterPushdown.enabled`` on):
    of files whose header box lies outside only the header is read, and other records outside are not handed to Spark.
    """
    spark.dataSource.register(LasSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("las").option("recordsPerPartition", records_per_partition).load(path)


def read_point_headers(spark: SparkSession, path: str) -> DataFrame:
    """Box and count per file, points untouched."""
    spark.dataSource.register(LasSource)
    return spark.read.format("las").option("headerOnly", "true").load(path)
