"""Tables of points, cells, features and files derived from the given tables.

Each view is one SQL text that Spark and the SQL twin share; ``{name}`` stands for the
table or view it reads.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

VIEWS = {
    "points": """
SELECT CAST(l_orderkey AS BIGINT)*10000000000 + l_partkey*100000 + l_suppkey*10 + l_linenumber AS pid,
       l_orderkey % 16 AS tile_id,
       ((l_orderkey*7919 + l_linenumber*104729) % 100000) / CAST(100 AS DOUBLE) AS x,
       ((l_partkey*6007 + l_orderkey*31 + l_linenumber*613) % 100000) / CAST(100 AS DOUBLE) AS y,
       l_extendedprice / CAST(1000 AS DOUBLE) AS z,
       CAST(l_quantity*1000 AS INT) AS intensity,
       CASE l_partkey % 7 WHEN 0 THEN 2 WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 3 THEN 5 WHEN 4 THEN 6 WHEN 5 THEN 7 ELSE 1 END AS classification,
       1 + l_linenumber % 3 AS return_number,
       3 AS number_of_returns,
       l_suppkey % 20 AS point_source_id,
       CAST((l_partkey % 181) - 90 AS DOUBLE) AS scan_angle
FROM {lineitem}""",
    "control_points": """
SELECT o_orderkey AS cid, o_orderkey % 20 AS strip_id,
       ((o_orderkey*7919 + 17) % 100000) / CAST(100 AS DOUBLE) AS x,
       ((o_custkey*6007 + o_orderkey*31) % 100000) / CAST(100 AS DOUBLE) AS y,
       (o_custkey % 200) / CAST(100 AS DOUBLE) - 1 AS dz
FROM {orders}""",
    # 10 m terrain grid under the occupied part of the point extent, with holes
    "dtm_cells": """
SELECT row_i, col_i,
       CASE WHEN (row_i*31 + col_i*17) % 97 = 0 THEN CAST(-9999 AS DOUBLE)
            ELSE 50 + row_i/CAST(10 AS DOUBLE) + col_i/CAST(20 AS DOUBLE) END AS v
FROM (SELECT DISTINCT CAST(FLOOR(y/CAST(10 AS DOUBLE)) AS INT) AS row_i,
                      CAST(FLOOR(x/CAST(10 AS DOUBLE)) AS INT) AS col_i FROM {points}) t""",
    # 20 m surface: highest point of each cell
    "dem": """
SELECT 0 AS tile_id, CAST(FLOOR(y/CAST(20 AS DOUBLE)) AS INT) AS row_i,
       CAST(FLOOR(x/CAST(20 AS DOUBLE)) AS INT) AS col_i, MAX(z) AS v
FROM {points} GROUP BY 1, 2, 3""",
    # four tiles with four 8-bit bands, 25 m cells
    "band_cells": """
SELECT tile_id % 4 AS tile_id, CAST(1 + point_source_id % 4 AS INT) AS band,
       CAST(FLOOR(y/CAST(25 AS DOUBLE)) AS INT) AS row_i, CAST(FLOOR(x/CAST(25 AS DOUBLE)) AS INT) AS col_i,
       CAST(SUM(pid % 1009) % 256 AS DOUBLE) AS v
FROM {points} GROUP BY 1, 2, 3, 4""",
    # colour triples, one per 10 m cell of a tile
    "pixels": """
SELECT tile_id % 4 AS tile_id, CAST(FLOOR(y/CAST(10 AS DOUBLE)) AS INT) AS row_i,
       CAST(FLOOR(x/CAST(10 AS DOUBLE)) AS INT) AS col_i,
       CAST(SUM(pid % 1009) % 256 AS INT) AS r, CAST(SUM(pid % 2003) % 256 AS INT) AS g,
       CAST(SUM(pid % 3001) % 256 AS INT) AS b, CAST(SUM(pid % 4001) % 256 AS INT) AS ir
FROM {points} GROUP BY 1, 2, 3""",
    "sheets": """
SELECT n_nationkey AS sheet_id, n_name AS code, n_regionkey AS lote,
       (n_nationkey % 5)*CAST(200 AS DOUBLE) AS minx, (n_nationkey % 5)*CAST(200 AS DOUBLE) + 200 AS maxx,
       FLOOR(n_nationkey/CAST(5 AS DOUBLE))*CAST(200 AS DOUBLE) AS miny,
       FLOOR(n_nationkey/CAST(5 AS DOUBLE))*CAST(200 AS DOUBLE) + 200 AS maxy
FROM {nation}""",
    # parts of every sheet and of every lot that leave gaps between them, and belts over the whole width
    "clips": """
SELECT sheet_id, minx + 30 AS minx, maxx - 50 AS maxx, miny + 20 AS miny, maxy - 40 AS maxy FROM {sheets}""",
    "plots": """
SELECT lot_id, minx + 2 AS minx, maxx - 3 AS maxx, miny + 5 AS miny, maxy - 10 AS maxy FROM {lots}""",
    "belts": """
SELECT sheet_id, minx, maxx, miny + 40 AS miny, maxy - 60 AS maxy FROM {sheets}""",
    "roads": """
SELECT s_suppkey AS road_id, s_name AS road_name, CAST(0 AS DOUBLE) AS x1, CAST(1000 AS DOUBLE) AS x2,
       (s_suppkey % 100)*CAST(10 AS DOUBLE) + 3 AS y1, (s_suppkey % 100)*CAST(10 AS DOUBLE) + 3 AS y2
FROM {supplier}""",
    # one lot per customer: axis-parallel rectangles on a 100-wide lattice
    "lots": """
SELECT c_custkey AS lot_id, c_nationkey AS block_id, c_name AS lot_name,
       (c_custkey % 100)*CAST(10 AS DOUBLE) AS minx, (c_custkey % 100)*CAST(10 AS DOUBLE) + 10 AS maxx,
       FLOOR(c_custkey/CAST(100 AS DOUBLE))*CAST(25 AS DOUBLE) AS miny,
       FLOOR(c_custkey/CAST(100 AS DOUBLE))*CAST(25 AS DOUBLE) + 25 AS maxy
FROM {customer}""",
    # one land-use rectangle per part, of mixed sizes and overlapping
    "uses": """
SELECT p_partkey AS use_id, p_type AS use_type, p_brand AS use_class,
       (p_partkey*37 % 9900)/CAST(10 AS DOUBLE) AS minx,
       (p_partkey*37 % 9900)/CAST(10 AS DOUBLE) + 4 + p_size % 9 AS maxx,
       (p_partkey*91 % 3600)/CAST(10 AS DOUBLE) AS miny,
       (p_partkey*91 % 3600)/CAST(10 AS DOUBLE) + 6 + p_size % 7 AS maxy
FROM {part}""",
    "footprints": """
SELECT o_orderkey AS fid, (o_orderkey*7919 % 100000)/CAST(100 AS DOUBLE) AS minx,
       (o_orderkey*7919 % 100000)/CAST(100 AS DOUBLE) + 5 AS maxx,
       (o_custkey*6007 % 100000)/CAST(100 AS DOUBLE) AS miny,
       (o_custkey*6007 % 100000)/CAST(100 AS DOUBLE) + 4 AS maxy
FROM {orders}""",
    "product_files": """
SELECT p_partkey AS file_id,
       CONCAT('ES_L', CASE WHEN p_partkey % 2 = 0 THEN '09' ELSE '10' END, '_', SUBSTR('ABCDEFGHIJK', CAST(1 + p_partkey % 11 AS INT), 1), '_',
              CASE p_partkey % 3 WHEN 0 THEN 'MDS' WHEN 1 THEN 'MDT' ELSE 'NPc_C' END, '_',
              CAST(2800 + p_partkey % 90 AS VARCHAR(8)), CASE WHEN p_partkey % 4 = 0 THEN '-' ELSE '_' END, CAST(1 + p_partkey % 4 AS VARCHAR(8)),
              '_SE_A_I', CASE WHEN p_partkey % 5 = 0 THEN '' ELSE '_R0' END) AS stem,
       CAST(p_retailprice*1000 AS BIGINT) AS length
FROM {part}""",
    # a folder tree of product files
    "file_paths": """
SELECT file_id, stem, length,
       CONCAT('/data/', CASE file_id % 3 WHEN 0 THEN 'MDS' WHEN 1 THEN 'MDT' ELSE 'NPC' END,
              '/LOTE_', CASE WHEN file_id % 2 = 0 THEN '09' ELSE '10' END,
              '/BLOCO_', SUBSTR('ABCDEFGHIJK', CAST(1 + file_id % 11 AS INT), 1), '/', stem,
              CASE file_id % 4 WHEN 0 THEN '.laz' WHEN 1 THEN '.tif' WHEN 2 THEN '.las' ELSE '.xml' END) AS path
FROM {product_files}""",
    "predictions": """
SELECT pid, CASE classification WHEN 2 THEN 0 WHEN 6 THEN 1 WHEN 3 THEN 2 WHEN 5 THEN 2 ELSE -1 END AS target,
       CASE WHEN pid % 10 < 8 THEN CASE classification WHEN 2 THEN 0 WHEN 6 THEN 1 ELSE 2 END ELSE CAST(pid % 3 AS INT) END AS pred
FROM {points}""",
    "track_points": """
SELECT event_id, user_id AS track_id, ts, (event_id*37 % 100000)/CAST(100 AS DOUBLE) AS x, value AS y
FROM {events}""",
    # flight strips: one per order, GPS week and seconds of the order
    "strips": """
SELECT o_orderkey AS strip_no, CAST(o_custkey % 16 AS INT) AS block_no,
       CAST(2200 + o_orderkey % 20 AS INT) AS gps_week, CAST(o_custkey*60 + o_orderkey % 60 AS DOUBLE) AS gps_start,
       CAST(o_custkey*60 + 300 + o_orderkey % 60 AS DOUBLE) AS gps_stop,
       CAST(o_totalprice / 1000 AS DOUBLE) AS altitude_m, CAST(50 + o_orderkey % 40 AS DOUBLE) AS speed_ms,
       ((o_orderkey*7919 + 17) % 100000) / CAST(100 AS DOUBLE) AS cx,
       ((o_custkey*6007 + o_orderkey*31) % 100000) / CAST(100 AS DOUBLE) AS cy
FROM {orders}""",
}

# rows of these views are few bytes but much work: a file of millions of them would be read by a few tasks
SPREAD = ("lots", "uses", "footprints")
SPREAD_ROWS = 20_000

_REF = re.compile(r"\{(\w+)\}")


class Tables:
    """Tables and derived views of one data folder, by attribute."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self._frames = spark, folder, {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._frames:
            if name in TABLES:
                frame = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
            elif name in VIEWS:
                refs = set(_REF.findall(VIEWS[name]))
                frame = self.spark.sql(VIEWS[name], **{r: getattr(self, r) for r in refs})
                if name in SPREAD and (tasks := frame.count() // SPREAD_ROWS) > 1:
                    frame = frame.repartition(tasks)
            else:
                raise AttributeError(name)
            self._frames[name] = frame
        return self._frames[name]


def with_views(sql: str) -> str:
    """SQL text whose ``{view}`` references are resolved by a WITH list in front."""
    order: list[str] = []

    def visit(text: str) -> None:
        for ref in _REF.findall(text):
            if ref in VIEWS and ref not in order:
                visit(VIEWS[ref])
                order.append(ref)

    visit(sql)
    plain = lambda text: _REF.sub(lambda m: m.group(1), text)
    if not order:
        return plain(sql)
    heads = ",\n".join(f"{name} AS ({plain(VIEWS[name])})" for name in order)
    body = plain(sql).strip()
    if body[:15].upper() == "WITH RECURSIVE ":
        return f"WITH RECURSIVE {heads},\n{body[15:]}"
    if body[:5].upper() == "WITH ":
        return f"WITH {heads},\n{body[5:]}"
    return f"WITH {heads}\n{body}"
