"""Scans: areas, catalogs, detections, stacks, layers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import radiometry
from ..operators.catalog import typed_scenes
from ..operators.sizes import small
from ..operators.tiles import missing_layers

DETECTION_COLUMNS = ("latitude", "longitude", "brightness", "scan", "track", "acq_date", "acq_time", "satellite", "instrument", "confidence", "version", "bright_t31", "frp", "daynight")
SCENE_SCHEMA = "item_id string, collection string, geometry string, props map<string,string>, assets map<string,struct<href:string,media_type:string,epsg:int>>"


def read_areas(spark: SparkSession, path: str) -> DataFrame:
    """aoi_id (the file's name) and geojson, one row per file."""
    return spark.read.text(path, wholetext=True).select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("aoi_id"), F.col("value").alias("geojson"))


def read_scenes(spark: SparkSession, path: str, fmt: str = "json", strict: bool = True) -> DataFrame:
    """An exported catalog, one item a row, ready for searches and metadata."""
    return typed_scenes(spark.read.schema(SCENE_SCHEMA).format(fmt).load(path), strict)


def read_detections(spark: SparkSession, path: str, columns=DETECTION_COLUMNS) -> DataFrame:
    """CSV files under source=.../window=...; every column is text, named by
    the files' header; files with a header only give no rows."""
    schema = ", ".join(f"{c} string" for c in columns)
    return spark.read.option("header", True).option("enforceSchema", False).schema(schema).option("basePath", path).csv(path)


def nodata_to_null(pixels: DataFrame, bands: list[str], nodata=0) -> DataFrame:
    return pixels.withColumns({b: radiometry.nodata_to_null(F.col(b), nodata) for b in bands})


def layer_scan(cells: DataFrame, layers: DataFrame, complete: bool = False) -> DataFrame:
    """Cells of the known layers with their attributes (scale, offset, fill,
    valid range, ...); other fields are left out. A null valid bound is open.
    ``complete`` makes a layer without cells an error, found by a pass over
    the fields."""
    if complete:
        absent = [r["field"] for r in missing_layers(layers, cells).select("field").limit(10).collect()]
        if absent:
            raise ValueError(f"layers without cells: {', '.join(sorted(absent))}")
    return cells.join(small(layers), "field")


def in_valid_range(value: Column, low: Column, high: Column) -> Column:
    """Whether a stored number lies in its layer's valid range."""
    return value.between(F.coalesce(low, value), F.coalesce(high, value))


def read_window(spark: SparkSession, path: str, rows: tuple[int, int], cols: tuple[int, int], size: int, where: Column | None = None) -> DataFrame:
    """Chips of ``sinks.write_chips`` that a window (first and last row, first
    and last column of cells) meets. The window goes down to the files as
    ranges of chips, so most row groups are never read; cells beside it, in
    chips on its bounds, are left to ``tiles.crop_chips``."""
    c = spark.read.parquet(path)
    if where is not None:
        c = c.where(where)
    return c.where(F.col("chip_row").between(rows[0] // size, rows[1] // size) & F.col("chip_col").between(cols[0] // size, cols[1] // size))


def read_windows(spark: SparkSession, path: str, windows: DataFrame, key: Sequence[str], size: int) -> DataFrame:
    """The same for a table of windows: key, row_off, col_off, n_rows, n_cols,
    one a key. Windows become chips and meet the stored ones by an equi-join;
    the ranges that hold them all go down to the files."""
    last_row, last_col = F.col("row_off") + F.col("n_rows") - 1, F.col("col_off") + F.col("n_cols") - 1
    w = windows.where((F.col("n_rows") > 0) & (F.col("n_cols") > 0)).withColumns({"r0": F.floor(F.col("row_off") / size), "r1": F.floor(last_row / size), "c0": F.floor(F.col("col_off") / size), "c1": F.floor(last_col / size)})
    r = w.agg(F.min("r0"), F.max("r1"), F.min("c0"), F.max("c1")).first()
    stored = spark.read.parquet(path)
    if r[0] is None:
        return stored.limit(0)
    stored = stored.where(F.col("chip_row").between(r[0], r[1]) & F.col("chip_col").between(r[2], r[3]))
    met = w.select(*key, F.explode(F.sequence("r0", "r1")).alias("chip_row"), "c0", "c1").select(*key, "chip_row", F.explode(F.sequence("c0", "c1")).alias("chip_col"))
    return stored.join(met, [*key, "chip_row", "chip_col"], "left_semi")
