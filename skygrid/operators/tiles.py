"""Tiled surface reflectance: mosaic, crop, mask by area, scale, group layers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo, radiometry
from .aoi import FEW_EDGES, holds_written_out, points_in_areas
from .sizes import small


def tile_affine(tiles: DataFrame, pixels: int) -> DataFrame:
    """Adds x_min, y_max, pixel size and its label; a bad tile id is an error
    (null h or v)."""
    x, y = geo.tile_origin("h", "v")
    bad = F.raise_error(F.concat(F.lit("bad tile id "), F.coalesce("tile", F.lit("null"))))
    ok = F.when(F.col("h").isNull() | F.col("v").isNull(), bad.cast("double"))
    size = geo.TILE_SIZE / pixels
    return tiles.withColumns({"x_min": F.coalesce(ok, F.expr(x)), "y_max": F.expr(y), "pixel_m": F.lit(size), "label": geo.resolution_label(F.lit(size))})


def global_cells(cells: DataFrame, pixels: int | Column) -> DataFrame:
    """Row and column counted from the upper left of the tile grid."""
    return cells.withColumns({"grow": F.col("v") * pixels + F.col("row_idx"), "gcol": F.col("h") * pixels + F.col("col_idx")})


def crop_window(grid: DataFrame, res: float, strict: bool = True) -> DataFrame:
    """``crop_windows`` of grids of one resolution."""
    return crop_windows(grid.withColumn("res", F.lit(float(res))), strict).drop(*(["res"] if "res" not in grid.columns else []))


def crop_windows(grid: DataFrame, strict: bool = False) -> DataFrame:
    """Row and column offsets and lengths of an area's box (ax0, ay0, ax1,
    ay1) on a grid (left_x, top_y, res, width, height): offsets rounded down,
    lengths up, cut to the grid. Without overlap it is an error if ``strict``,
    else the area gets no row."""
    res = F.col("res")
    g = grid.withColumns({"right_x": F.col("left_x") + F.col("width") * res, "bottom_y": F.col("top_y") - F.col("height") * res})
    x0, x1 = F.greatest("ax0", "left_x"), F.least("ax1", "right_x")
    y0, y1 = F.greatest("ay0", "bottom_y"), F.least("ay1", "top_y")
    g = g.withColumns({"ox0": x0, "ox1": x1, "oy0": y0, "oy1": y1})
    meet = (F.col("ox0") < F.col("ox1")) & (F.col("oy0") < F.col("oy1"))
    if strict:
        g = g.withColumn("ox0", F.when(meet, F.col("ox0")).otherwise(F.raise_error(F.lit("an area does not overlap its grid")).cast("double")))
    else:
        g = g.where(meet)
    c0, r0 = F.floor((F.col("ox0") - F.col("left_x")) / res), F.floor((F.col("top_y") - F.col("oy1")) / res)
    n_c, n_r = F.ceil((F.col("ox1") - F.col("ox0")) / res), F.ceil((F.col("oy1") - F.col("oy0")) / res)
    return g.select(*grid.columns, c0.alias("col_off"), r0.alias("row_off"), F.least(n_c, F.col("width") - c0).alias("n_cols"), F.least(n_r, F.col("height") - r0).alias("n_rows"))


def crop_cells(cells: DataFrame, windows: DataFrame, key: list[str]) -> DataFrame:
    """The cells in their grid's window, counted from its upper left corner.
    windows: key, row_off, col_off, n_rows, n_cols; a grid has one."""
    w = windows.select(*key, "row_off", "col_off", "n_rows", "n_cols").alias("w")
    j = cells.alias("c").join(w, [F.col(f"c.{k}") == F.col(f"w.{k}") for k in key])
    row, col = F.col("c.row_idx") - F.col("w.row_off"), F.col("c.col_idx") - F.col("w.col_off")
    inside = (row >= 0) & (row < F.col("w.n_rows")) & (col >= 0) & (col < F.col("w.n_cols"))
    moved = {"row_idx": row.cast("int").alias("row_idx"), "col_idx": col.cast("int").alias("col_idx")}
    return j.where(inside).select(*[moved.get(n, F.col(f"c.`{n}`")) for n in cells.columns])


def crop_chips(chips: DataFrame, windows: DataFrame, bands: list[str], key: list[str], size: int) -> DataFrame:
    """Chips with the cells outside their key's window set to missing. windows:
    key, row_off, col_off, n_rows, n_cols; a key has one. Works inside the
    arrays: no cell becomes a row."""
    w = windows.select(*key, "row_off", "col_off", "n_rows", "n_cols")
    j = chips.join(w, key)
    r0, c0 = F.col("chip_row") * size, F.col("chip_col") * size

    def inside(i: Column) -> Column:
        row, col = r0 + F.floor(i / size), c0 + i % size
        return (row >= F.col("row_off")) & (row < F.col("row_off") + F.col("n_rows")) & (col >= F.col("col_off")) & (col < F.col("col_off") + F.col("n_cols"))

    whole = (r0 >= F.col("row_off")) & (r0 + size <= F.col("row_off") + F.col("n_rows")) & (c0 >= F.col("col_off")) & (c0 + size <= F.col("col_off") + F.col("n_cols"))
    cut = {b: F.when(whole, F.col(b)).otherwise(F.transform(b, lambda v, i: F.when(inside(i), v))) for b in bands}
    return j.withColumns(cut).select(*chips.columns)


def in_areas(cells: DataFrame, edges: DataFrame, key: list[str], x: str = "cx_m", y: str = "cy_m", most: int = FEW_EDGES) -> DataFrame:
    """Adds ``in_area``: whether a cell's centre, in the edges' projection,
    lies in some area. The edges of a few areas are written out as one
    expression; others meet the cells by ``points_in_areas``."""
    written = holds_written_out(edges, F.col(x), F.col(y), most)
    if written is not None:
        return cells.withColumn("in_area", written)
    inside = points_in_areas(cells, edges, key, x, y).select(*key).distinct().withColumn("in_area", F.lit(True)).alias("i")
    j = cells.alias("c").join(inside, [F.col(f"c.{k}").eqNullSafe(F.col(f"i.{k}")) for k in key], "left")
    return j.select("c.*", F.coalesce("i.in_area", F.lit(False)).alias("in_area"))


def mask_outside(cells: DataFrame, sr: list[str], qa: dict[str, int | None]) -> DataFrame:
    """cells with in_area. Surface reflectance outside is missing; QA outside
    gets its fill value, or stays if it has none."""
    new: dict[str, Column] = {b: F.when(F.col("in_area"), F.col(b)) for b in sr}
    new |= {b: F.when(F.col("in_area"), F.col(b)).otherwise(F.lit(fill)) for b, fill in qa.items() if fill is not None}
    return cells.withColumns(new)


def scale_layers(cells: DataFrame, layers: DataFrame) -> DataFrame:
    """cells: field, dn. layers: field, kind, scale, offset, fill. SR layers
    are scaled, QA passes; an SR layer without scale is an error."""
    j = cells.join(small(layers.select("field", "kind", "scale", "offset", "fill")), "field")
    missing = F.raise_error(F.concat(F.lit("no scale for "), F.col("field"))).cast("float")
    sr = F.when(F.col("scale").isNull(), missing).otherwise(radiometry.scale_offset(F.col("dn"), F.col("scale"), F.col("offset"), F.col("fill")))
    return j.withColumn("value", F.when(F.col("kind") == "sr", sr)).withColumn("qa", F.when(F.col("kind") == "qa", F.col("dn").cast("long")))


def layer_groups(layers: DataFrame, key: Sequence[str] = ()) -> DataFrame:
    """Layers by kind and resolution (and ``key``, such as a product): output
    suffix, common fill value (null unless all share it), members in order."""
    g = layers.groupBy(*key, "kind", "resolution").agg(
        F.count("*").alias("n_layers"), F.sort_array(F.collect_list("field")).alias("fields"), F.count_distinct("fill").alias("n_fills"),
        F.count_if(F.col("fill").isNull()).alias("n_without"), F.min("fill").alias("any_fill"), F.max("bits").alias("bits"),
    )
    suffix = F.when(F.col("n_layers") == 1, F.col("fields")[0]).when(F.col("kind") == "qa", F.concat(F.lit("QA_"), "resolution")).otherwise(F.col("resolution"))
    common = F.when((F.col("n_fills") == 1) & (F.col("n_without") == 0), F.col("any_fill"))
    return g.select(*key, "kind", "resolution", "n_layers", F.array_join("fields", ",").alias("fields"), suffix.alias("suffix"), common.alias("fill"), F.when(F.col("kind") == "qa", radiometry.widest_integer(F.col("bits"))).otherwise("float").alias("dtype"))


TAGS = ("field", "scale", "offset", "fill", "sds_path")


def _bands(layers: DataFrame, key: Sequence[str]) -> DataFrame:
    return layers.groupBy(*key, "kind", "resolution").agg(F.sort_array(F.collect_list(F.struct(*TAGS))).alias("bands"))


def layer_tags(layers: DataFrame, key: Sequence[str] = ()) -> DataFrame:
    """Tags of each output: band order and the attributes of its bands."""
    g = _bands(layers, key)
    return g.select(*key, "kind", "resolution", F.posexplode("bands").alias("i", "b")).select(*key, "kind", "resolution", (F.col("i") + 1).alias("band_index"), "b.*")


def layer_sidecars(layers: DataFrame, key: Sequence[str] = ()) -> DataFrame:
    """Key, kind, resolution and ``sidecar``: a JSON text of an output's bands
    in order, with nulls for what they lack."""
    body = F.struct("kind", "resolution", F.transform("bands", lambda b, i: F.struct((i + 1).alias("band_index"), *[b[c].alias(c) for c in TAGS])).alias("bands"))
    return _bands(layers, key).select(*key, "kind", "resolution", F.to_json(body, {"ignoreNullFields": "false"}).alias("sidecar"))


def missing_layers(layers: DataFrame, found: DataFrame) -> DataFrame:
    """Layers without any cell: an error for the caller."""
    return layers.join(found.select("field").distinct(), "field", "left_anti")


def shape_violations(grids: DataFrame, key: list[str]) -> DataFrame:
    """Groups whose members differ in shape."""
    return grids.groupBy(*key).agg(F.count_distinct("width", "height").alias("n_shapes"), F.count("*").alias("n_members")).where(F.col("n_shapes") > 1)


def unmatched_cells(pixels: DataFrame, mask: DataFrame, key: list[str]) -> DataFrame:
    """Cells that only one of image and mask has."""
    a = pixels.select(*key).join(mask.select(*key), key, "left_anti").withColumn("only_in", F.lit("image"))
    return a.unionByName(mask.select(*key).join(pixels.select(*key), key, "left_anti").withColumn("only_in", F.lit("mask")))
