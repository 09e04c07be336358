"""Catalogs, pixels and detections derived from the driver's tables.

The texts run unchanged in Spark and DuckDB. ``{name}`` stands for a table of
the driver; ``sql(name)`` fills in the plain names, ``read`` the files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

VIEWS = {
    "fx_scenes": """
SELECT concat('SC_', lpad(CAST(o_orderkey AS STRING), 8, '0')) AS item_id, o_orderkey AS scene_no,
       CASE WHEN o_orderkey % 2 = 0 THEN 'sentinel-2-l2a' ELSE 'landsat-c2-l2' END AS collection,
       CASE WHEN o_orderkey % 2 = 0 THEN 'Sentinel-2A' WHEN o_orderkey % 3 = 0 THEN 'landsat-9'
            WHEN o_orderkey % 5 = 0 THEN 'landsat-7' ELSE 'Landsat-8' END AS platform,
       o_orderdate AS acquired,
       CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE CAST((o_orderkey * 7919) % 10000 AS DOUBLE) / 100e0 END AS cloud_cover,
       CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN '02.14' WHEN '2' THEN '03.01'
            WHEN '3' THEN '04.00' WHEN '4' THEN '05.09' ELSE '' END AS processing_baseline,
       CAST((o_orderkey * 31) % 360 AS DOUBLE) AS sun_azimuth,
       CASE WHEN o_orderkey % 4 = 0 THEN CAST(o_orderkey % 80 AS DOUBLE) END AS sun_zenith,
       CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderkey % 70 AS DOUBLE) END AS sun_elevation,
       130e0 + CAST(o_custkey % 200 AS DOUBLE) / 100e0 AS west,
       32e0 + CAST(o_orderkey % 150 AS DOUBLE) / 100e0 AS south,
       130e0 + CAST(o_custkey % 200 AS DOUBLE) / 100e0 + 0.1e0 AS east,
       32e0 + CAST(o_orderkey % 150 AS DOUBLE) / 100e0 + 0.1e0 AS north
FROM {orders}""",
    "fx_granules": """
SELECT o_orderkey AS granule_id,
       CASE WHEN o_orderkey % 101 = 0 THEN 'browse.jpg' ELSE
       concat(CASE o_orderkey % 3 WHEN 0 THEN 'MOD09GA' WHEN 1 THEN 'MYD09GA' ELSE 'VNP09GA' END,
              '.A', CAST(year(o_orderdate) * 1000 + dayofyear(o_orderdate) AS STRING),
              '.h', lpad(CAST(o_custkey % 36 AS STRING), 2, '0'), 'v', lpad(CAST(o_orderkey % 18 AS STRING), 2, '0'),
              '.061.', CAST(o_orderkey AS STRING), CASE WHEN o_orderkey % 3 = 2 THEN '.h5' ELSE '.hdf' END) END AS filename
FROM {orders}""",
    "fx_detections": """
SELECT event_id,
       CASE event_id % 4 WHEN 0 THEN 'MODIS_SP' WHEN 1 THEN 'VIIRS_SNPP_SP' WHEN 2 THEN 'VIIRS_NOAA20_SP' ELSE 'VIIRS_NOAA21_NRT' END AS source,
       CASE WHEN event_id % 89 = 0 THEN '' ELSE
       concat('32.', lpad(CAST(6000 + (event_id * 7919) % 4000 AS STRING), 4, '0')) END AS latitude,
       CASE WHEN event_id % 83 = 0 THEN 'bad' ELSE
       concat(CAST(CAST(floor((1308000 + (user_id * 6007 + event_id * 13) % 4000) / 10000e0) AS BIGINT) AS STRING), '.',
              lpad(CAST((1308000 + (user_id * 6007 + event_id * 13) % 4000) % 10000 AS STRING), 4, '0')) END AS longitude,
       CASE WHEN event_id % 53 = 0 THEN '' ELSE concat('0.', CAST(3 + user_id % 7 AS STRING)) END AS scan,
       CASE WHEN event_id % 59 = 0 THEN '' ELSE concat('0.', CAST(3 + event_id % 7 AS STRING)) END AS track,
       CASE WHEN event_id % 97 = 0 THEN 'n/a' ELSE CAST(CAST(ts AS DATE) AS STRING) END AS acq_date,
       lpad(CAST(hour(ts) * 100 + minute(ts) AS STRING), 4, '0') AS acq_time,
       event_type AS confidence, value AS frp, ts
FROM {events}""",
    "fx_pixels": """
SELECT CAST(l_orderkey % 6 AS INT) AS scene_no, 'S2C' AS prefix,
       CASE WHEN l_orderkey % 6 < 3 THEN '20240116' ELSE '20240126' END AS date_token,
       CAST(l_partkey AS INT) AS row_idx, CAST(l_linenumber - 1 AS INT) AS col_idx,
       min(CASE WHEN (l_orderkey + l_suppkey) % 11 = 0 OR (l_partkey + l_linenumber) % 29 = 0 THEN 0 ELSE (l_orderkey * 31 + l_partkey * 17) % 9973 END) AS b01,
       min(CASE WHEN (l_partkey + l_linenumber) % 29 = 0 THEN 0 ELSE (l_orderkey * 37 + l_suppkey * 101 + l_partkey) % 9941 END) AS b03,
       min(CASE WHEN (l_partkey + l_linenumber) % 29 = 0 THEN 0 ELSE (l_orderkey * 41 + l_suppkey * 7 + l_partkey) % 9929 END) AS b04,
       min(CASE WHEN (l_partkey + l_linenumber) % 29 = 0 THEN 0 ELSE (l_orderkey * 43 + l_suppkey * 13 + l_partkey) % 9923 END) AS b08,
       min(CASE WHEN (l_partkey + l_linenumber) % 29 = 0 THEN 0 ELSE (l_orderkey * 47 + l_suppkey * 5 + l_partkey) % 6007 END) AS b11,
       CAST(min((l_suppkey + l_orderkey) % 4) AS INT) AS cloud_class
FROM {lineitem}
GROUP BY l_orderkey % 6, CASE WHEN l_orderkey % 6 < 3 THEN '20240116' ELSE '20240126' END, l_partkey, l_linenumber""",
    "fx_tile_pixels": """
SELECT CASE WHEN l_orderkey % 3 = 0 THEN 'terra' WHEN l_orderkey % 3 = 1 THEN 'aqua' ELSE 'snpp' END AS platform,
       CAST(28 + l_suppkey % 2 AS INT) AS h, CAST(5 AS INT) AS v,
       CAST(l_linenumber AS INT) AS granule_ord,
       CAST(l_partkey % 1200 AS INT) AS row_idx, CAST((l_orderkey * 7) % 1200 AS INT) AS col_idx,
       CAST(min(CASE WHEN (l_orderkey + l_partkey) % 13 = 0 THEN -28672 ELSE (l_orderkey * 29 + l_partkey * 3) % 16000 - 100 END) AS INT) AS sr_dn,
       CAST(min((l_orderkey * 11 + l_partkey) % 65536) AS INT) AS qa_raw
FROM {lineitem}
GROUP BY l_orderkey % 3, l_suppkey % 2, l_linenumber, l_partkey % 1200, (l_orderkey * 7) % 1200""",
    # Areas of interest in hundredths of a degree: squares, every second one
    # with a triangular hole, every third one with a second square.
    "fx_areas": """
SELECT s_suppkey AS aoi_id, 13000 + s_suppkey % 200 AS x, 3200 + s_suppkey % 150 AS y, 10 + s_suppkey % 5 * 5 AS side,
       s_suppkey % 2 = 0 AS holed, s_suppkey % 3 = 0 AS twofold
FROM {supplier}""",
    "fx_edges": """
SELECT aoi_id, part, ring, edge, CAST(x1 AS DOUBLE) / 100e0 AS x1, CAST(y1 AS DOUBLE) / 100e0 AS y1, CAST(x2 AS DOUBLE) / 100e0 AS x2, CAST(y2 AS DOUBLE) / 100e0 AS y2
FROM (
  SELECT aoi_id, p.part, r.ring, r.edge, x + p.part * 50 + side * r.fx1 / 10 AS x1, y + side * r.fy1 / 10 AS y1, x + p.part * 50 + side * r.fx2 / 10 AS x2, y + side * r.fy2 / 10 AS y2
  FROM ({fx_areas}) a
  CROSS JOIN (VALUES (0), (1)) AS p(part)
  CROSS JOIN (VALUES (0, 0, 0, 0, 0, 10), (0, 1, 0, 10, 10, 10), (0, 2, 10, 10, 10, 0), (0, 3, 10, 0, 0, 0),
                     (1, 0, 2, 2, 6, 2), (1, 1, 6, 2, 6, 6), (1, 2, 6, 6, 2, 2)) AS r(ring, edge, fx1, fy1, fx2, fy2)
  WHERE (p.part = 0 OR twofold) AND (r.ring = 0 OR holed)) q""",
    # Regions of one to some dozen tiles; no bound lies on a tile's or a cell's.
    "fx_regions": """
SELECT s_suppkey AS aoi_id, CAST(10 + s_suppkey % 140 AS DOUBLE) + 0.37e0 AS west, CAST(s_suppkey * 7 % 60 AS DOUBLE) + 0.37e0 AS south,
       CAST(13 + s_suppkey % 140 + s_suppkey % 25 AS DOUBLE) + 0.37e0 AS east, CAST(s_suppkey * 7 % 60 + 2 + s_suppkey % 20 AS DOUBLE) + 0.58e0 AS north
FROM {supplier}""",
    "fx_windows": """
SELECT o_orderkey AS window_id, 1 + o_custkey % (SELECT count(*) FROM {supplier}) AS aoi_id,
       CAST(o_orderdate AS DATE) AS first_day, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 40 AS INT) AS last_day
FROM {orders}""",
    # A granule's cells, of three layers on grids of 24, 24 and 12 cells a tile.
    "fx_granule_cells": """
SELECT l_orderkey AS granule_id, CASE l_linenumber % 3 WHEN 0 THEN 'refl' WHEN 1 THEN 'qc' ELSE 'state' END AS field,
       l_partkey % CASE WHEN l_linenumber % 3 = 2 THEN 12 ELSE 24 END AS row_idx, l_suppkey % CASE WHEN l_linenumber % 3 = 2 THEN 12 ELSE 24 END AS col_idx,
       CASE l_linenumber % 3 WHEN 0 THEN CASE WHEN (l_orderkey + l_partkey) % 13 = 0 THEN -28672 ELSE (l_orderkey * 29 + l_partkey * 3) % 16000 - 100 END
            WHEN 1 THEN 4294967295 - l_partkey % 7 ELSE (l_orderkey * 11 + l_partkey) % 65536 END AS dn
FROM {lineitem}""",
    "fx_scene_cells": """
SELECT concat('SC_', lpad(CAST(l_orderkey AS STRING), 8, '0')) AS item_id, CAST(l_partkey % 40 AS INT) AS row_idx, CAST(l_suppkey % 30 AS INT) AS col_idx, CAST((l_suppkey + l_orderkey) % 4 AS INT) AS cloud_class,
       CASE WHEN l_partkey % 29 = 0 THEN 0 ELSE (l_orderkey * 37 + l_suppkey * 101 + l_partkey) % 19941 END AS b03, CASE WHEN l_partkey % 29 = 0 THEN 0 ELSE (l_orderkey * 41 + l_suppkey * 7 + l_partkey) % 19929 END AS b04,
       CASE WHEN l_partkey % 29 = 0 THEN 0 ELSE (l_orderkey * 47 + l_suppkey * 5 + l_partkey) % 12007 END AS b11
FROM {lineitem}""",
    "fx_footprints": """
SELECT item_id, edge, west + size * fx1 // 100 AS x1, south + size * fy1 // 100 AS y1, west + size * fx2 // 100 AS x2, south + size * fy2 // 100 AS y2
FROM (SELECT concat('SC_', lpad(CAST(o_orderkey AS STRING), 8, '0')) AS item_id, 130000 + o_custkey % 200 * 10 AS west, 32000 + o_orderkey % 150 * 10 AS south, 60 + o_orderkey % 50 AS size FROM {orders}) q
CROSS JOIN (VALUES (0, 30, 0, 100, 20), (1, 100, 20, 70, 100), (2, 70, 100, 0, 80), (3, 0, 80, 30, 0)) AS r(edge, fx1, fy1, fx2, fy2)""".replace("//", "{div}"),
    "fx_grids": """
SELECT p_partkey AS grid_id, 500000e0 + CAST(p_partkey % 977 AS DOUBLE) * 10e0 AS left_x, 3600000e0 + CAST(p_partkey % 1013 AS DOUBLE) * 10e0 AS top_y,
       10e0 AS res, CAST(50 + p_size * 3 AS INT) AS width, CAST(40 + p_size * 2 AS INT) AS height
FROM {part}""",
}


class _Names(dict):
    """Names of tables and views, and what the two engines write differently."""

    def __init__(self, table, **words: str):
        super().__init__(words)
        self.table = table

    def __missing__(self, name: str) -> str:
        return VIEWS[name].format_map(self) if name in VIEWS else self.table(name)


def sql(*names: str) -> str:
    """A WITH clause that defines the views over plainly named tables."""
    plain = _Names(lambda t: t, div="//")
    return "WITH " + ", ".join(f"{n} AS ({VIEWS[n].format_map(plain)})" for n in names) + " "


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spark.sql(VIEWS[name].format_map(_Names(lambda t: f"parquet.`{sf_dir}/{t}.parquet`", div="DIV")))


def read_in_order(spark: SparkSession, sf_dir: str, name: str, table: str, order: str) -> DataFrame:
    """A view with the place of each row of ``table`` in its file as ``order``:
    the view must take the table's rows one by one."""
    rows = spark.read.parquet(f"{sf_dir}/{table}.parquet").select("*", F.struct(F.col("_metadata.file_name"), F.col("_metadata.row_index")).alias(order))
    text = VIEWS[name].replace("\nFROM {" + table + "}", f", {order}\nFROM {{rows}}")
    return spark.sql(text, rows=rows)
