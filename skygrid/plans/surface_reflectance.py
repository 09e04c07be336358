"""From tiled granules to scaled, clipped daily grids and layers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..operators import aoi, catalog, spans, tiles
from ..operators.sizes import small, spread
from .scratch import cut

FIRST = ["product", "acq_date", "field", "h", "v", "row_idx", "col_idx"]


def _first(cells: DataFrame) -> Column:
    """A cell's first number that is not its fill, in order of granules; of a
    granule that has the cell more than once, in order of ``cell_ord``, if the
    cells have that column, and of the numbers. So no tie is left open."""
    order = ["granule_id", *[c for c in ("cell_ord",) if c in cells.columns], "dn"]
    return F.min_by("dn", F.when(F.col("fill").isNull() | (F.col("dn") != F.col("fill")), F.struct(*order)))


def mosaic(cells: DataFrame, layers: DataFrame, key: list[str]) -> DataFrame:
    """The first granule with data wins, in order of ids. Raw numbers are
    BIGINT, as fills of unsigned 32-bit layers are beyond INT."""
    c = cells.join(small(layers.select("field", F.col("fill").cast("long").alias("fill"))), "field").withColumn("dn", F.col("dn").cast("long"))
    return c.groupBy(*key).agg(F.coalesce(_first(cells), F.min("fill")).alias("dn"))


def process_days(granules: DataFrame, cells: DataFrame, layers: DataFrame, windows: DataFrame, done: DataFrame | None = None, expected: int = 1) -> tuple[DataFrame, DataFrame]:
    """(values, report) of whole tiles. granules: granule_id, filename; cells:
    granule_id, field, row_idx, col_idx, dn and, if a granule may have a cell
    more than once, cell_ord; windows: window_id, start, end and, if a window
    is one product's, product.

    Days whose outputs are all there are left out. Where tiles of a day
    overlap, the first granule with data wins. Platforms are never merged.
    """
    g = catalog.parse_granules(granules)
    if done is not None:
        g = catalog.skip_existing(g, done, ["product", "acq_date"], expected)
    by = ["product"] if "product" in windows.columns else []
    days = windows.select(*by, F.explode(F.sequence("start", "end")).alias("acq_date")).distinct()
    g = g.join(days, [*by, "acq_date"], "left_semi")
    c = cells.join(g.select("granule_id", "product", "acq_date", "h", "v"), "granule_id")
    return tiles.scale_layers(mosaic(c, layers, FIRST), layers), catalog.calendar_coverage(windows, g, by)


@dataclass
class Layers:
    """What an area's days come to. values: aoi_id, product, acq_date, kind,
    resolution, field, row_idx, col_idx (in the area's window), value, qa.
    windows: each output's place on its mosaic. groups, sidecars: one row an
    output, as ``tiles.layer_groups`` and ``layer_sidecars`` give them.
    report: each day of each window with what becomes of it."""

    values: DataFrame
    windows: DataFrame
    groups: DataFrame
    sidecars: DataFrame
    report: DataFrame


def _grid_of_days(days: DataFrame, layers: DataFrame) -> DataFrame:
    """The mosaic of each shape's day: the rectangle of tiles that its granules
    span, once a pixel count of the layers."""
    span = {n: f(c).alias(n) for n, f, c in (("h0", F.min, "h"), ("h1", F.max, "h"), ("v0", F.min, "v"), ("v1", F.max, "v"))}
    m = days.groupBy("shape", "product", "acq_date").agg(*span.values())
    m = m.join(small(layers.select("product", "pixels").distinct()), "product")
    x, y = geo.tile_origin("h0", "v0")
    return m.select(
        "shape", "product", "acq_date", "pixels", "h0", "v0", F.expr(x).alias("left_x"), F.expr(y).alias("top_y"), (F.lit(geo.TILE_SIZE) / F.col("pixels")).alias("res"),
        ((F.col("h1") - F.col("h0") + 1) * F.col("pixels")).alias("width"), ((F.col("v1") - F.col("v0") + 1) * F.col("pixels")).alias("height"),
    )


def process_areas(granules: DataFrame, cells: DataFrame, layers: DataFrame, windows: DataFrame, areas: DataFrame, done: DataFrame | None = None, clip: bool = True, tolerance: float = aoi.TOLERANCE) -> Layers:
    """From GeoJSON in degrees to layers, for all areas, windows and products in
    one job. granules and cells as for process_days; layers: product, field,
    kind, resolution, pixels (a tile's side), bits, scale, offset, fill,
    sds_path; windows: aoi_id, window_id, start, end; areas: aoi_id, geojson.

    An area's tiles follow from its shape on the sinusoidal grid. A day's
    granules of these tiles are mosaicked, cut to the window of the area's box
    on that mosaic, scaled, and masked outside the area: reflectance is missing
    there and QA has its fill. ``done`` (aoi_id, product, acq_date) is left out.
    """
    # Shapes and days are small beside cells and used several times, so they
    # are written once. Areas of the same edges are one shape until the end.
    few, members = aoi.alike(cut(aoi.aoi_edges(areas), "area-edges"))
    on_grid = cut(aoi.project_edges(few, "sinusoidal", tolerance), "projected-edges").withColumnRenamed("aoi_id", "shape")
    # Names are a few bytes that take long to parse.
    granules = cut(catalog.parse_granules(spread(granules, "granule_id")), "parsed-granules")
    covered = cut(aoi.tiles_of_shapes(few), "shape-tiles")
    # Tiles of a day stay together, so that shapes' days are found without
    # another shuffle.
    tile_days = spread(granules.select("product", "acq_date", "h", "v"), "product", "acq_date").distinct().join(small(covered, aoi.MEMBER_ROWS), ["h", "v"])
    grid = cut(_grid_of_days(tile_days, layers), "shape-days")
    asked_days = windows.where(F.col("start") <= F.col("end")).join(members, "aoi_id").select("aoi_id", "shape", F.explode(F.sequence("start", "end")).alias("acq_date")).distinct()
    wanted = grid.select("shape", "product", "acq_date").distinct().join(asked_days, ["shape", "acq_date"])
    days = cut(wanted if done is None else catalog.skip_existing(wanted, done, ["aoi_id", "product", "acq_date"]), "area-days")
    if clip:
        box = aoi.aoi_bbox(on_grid.withColumnRenamed("shape", "aoi_id")).select(F.col("aoi_id").alias("shape"), F.col("west").alias("ax0"), F.col("south").alias("ay0"), F.col("east").alias("ax1"), F.col("north").alias("ay1"))
        # An area that only touches a tile has no window on it, and no row.
        window = tiles.crop_windows(grid.join(box, "shape"))
    else:
        window = grid.withColumns({"col_off": F.lit(0), "row_off": F.lit(0), "n_cols": F.col("width"), "n_rows": F.col("height")})
    # Cells are counted from the upper left of the whole tile grid, so that all
    # days of an area share one raster, and its rows' spans.
    p = F.col("pixels")
    window = window.withColumns({"first_row": F.col("v0") * p + F.col("row_off"), "first_col": F.col("h0") * p + F.col("col_off")})
    window = window.select("shape", "product", "acq_date", "pixels", "left_x", "top_y", "res", "row_off", "col_off", "n_rows", "n_cols", "first_row", "first_col")
    place = small(layers.select("product", "field", "kind", "resolution", "pixels"))
    c = cells.join(granules.select("granule_id", "product", "acq_date", "h", "v"), "granule_id").join(place, ["product", "field"])
    # A tile's day is one mosaic, whatever areas look at it; what they take of
    # it is not shuffled again.
    m = tiles.global_cells(_mosaic_of_products(c, layers, ["product", "acq_date", "h", "v", "kind", "resolution", "pixels", "field", "row_idx", "col_idx"]), p).drop("row_idx", "col_idx")
    views = tile_days.join(_area_lists(days, members), ["shape", "product", "acq_date"]).join(window.drop("left_x", "top_y", "res", "row_off", "col_off"), ["shape", "product", "acq_date"])
    m = m.join(views, ["product", "acq_date", "h", "v", "pixels"])
    m = m.where((F.col("grow") - F.col("first_row")).between(0, F.col("n_rows") - 1) & (F.col("gcol") - F.col("first_col")).between(0, F.col("n_cols") - 1))
    if clip:
        raster = {"left_x": F.lit(geo.SINU_X_MIN), "top_y": F.lit(geo.SINU_Y_MAX), "res": F.lit(geo.TILE_SIZE) / p, "width": 36 * p, "height": 18 * p}
        rasters = grid.select(F.col("shape").alias("aoi_id"), "pixels").distinct().withColumns(raster)
        rows = cut(spans.row_spans(on_grid.withColumnRenamed("shape", "aoi_id"), rasters, ["pixels"]).withColumnRenamed("aoi_id", "shape"), "row-spans")
        m = spans.in_spans(m, small(rows, aoi.MEMBER_ROWS), ["shape", "pixels"], "grow", "gcol")
    else:
        m = m.withColumn("in_area", F.lit(True))
    m = m.withColumns({"row_idx": (F.col("grow") - F.col("first_row")).cast("long"), "col_idx": (F.col("gcol") - F.col("first_col")).cast("long")})
    scaled = _scaled(m, layers).drop("in_area", "pixels")
    values = scaled.select(F.explode("aoi_ids").alias("aoi_id"), *[n for n in scaled.columns if n != "aoi_ids"])
    used = days.select("product").distinct().join(small(layers), "product")
    products = sorted(r["product"] for r in layers.select("product").distinct().collect())
    asked = windows if "product" in windows.columns else windows.withColumn("product", F.explode(F.array(*map(F.lit, products))))
    found = granules.join(covered, ["h", "v"]).join(days, ["shape", "product", "acq_date"])
    coverage = catalog.calendar_coverage(asked, found, ["aoi_id", "product"])
    of_areas = days.join(window, ["shape", "product", "acq_date"]).drop("shape")
    return Layers(values, of_areas, tiles.layer_groups(used, ["product"]), tiles.layer_sidecars(used, ["product"]), coverage)


#: Areas of one shape that a row names.
AREAS_A_ROW = 64


def _area_lists(days: DataFrame, members: DataFrame) -> DataFrame:
    """shape, product, acq_date, aoi_ids: areas that have the day, in lists of
    about AREAS_A_ROW."""
    slots = members.groupBy("shape").agg(F.ceil(F.count("*") / AREAS_A_ROW).alias("slots"))
    slot = F.pmod(F.xxhash64("aoi_id"), F.col("slots"))
    return days.join(slots, "shape").groupBy("shape", "product", "acq_date", slot.alias("slot")).agg(F.collect_list("aoi_id").alias("aoi_ids")).drop("slot")


def _mosaic_of_products(cells: DataFrame, layers: DataFrame, key: list[str]) -> DataFrame:
    c = cells.join(small(layers.select("product", "field", F.col("fill").cast("long").alias("fill"))), ["product", "field"]).withColumn("dn", F.col("dn").cast("long"))
    return c.groupBy(*key).agg(F.coalesce(_first(cells), F.min("fill")).alias("dn"))


def _scaled(cells: DataFrame, layers: DataFrame) -> DataFrame:
    """Scaled reflectance inside the area; QA, with its fill outside."""
    keyed = layers.withColumn("layer", F.concat_ws("/", "product", "field")).select(F.col("layer").alias("field"), "kind", "scale", "offset", "fill")
    c = cells.withColumn("name", F.col("field")).withColumn("field", F.concat_ws("/", "product", "field")).drop("kind")
    s = tiles.scale_layers(c, keyed)
    value = F.when(F.col("in_area"), F.col("value"))
    qa = F.when(F.col("in_area") | F.col("fill").isNull(), F.col("qa")).when(F.col("kind") == "qa", F.col("fill").cast("long"))
    return s.select("aoi_ids", "product", "acq_date", "kind", "resolution", "pixels", F.col("name").alias("field"), "row_idx", "col_idx", "in_area", value.alias("value"), qa.alias("qa"))
