"""Scene and granule catalogs: search, naming, metadata, work lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import parsing, radiometry
from .aoi import GEOJSON, aoi_edges, boxes_meet, geometry, rings
from .sizes import small

# Asset and label of each band number, and bands masks need.
SENTINEL_BANDS = tuple((i, a) for i, a in enumerate("B01 B02 B03 B04 B05 B06 B07 B08 B8A B09 B11 B12".split(), 1))
LANDSAT_BANDS = tuple(enumerate("coastal blue green red nir08 swir16 swir22 qa_aerosol qa_pixel lwir11 lwir12".split(), 1))
CLOUD_BANDS = {"sentinel2": (3, 4, 8), "landsat89": (3, 4, 5)}
SNOW_BANDS = {"sentinel2": (3, 4, 11), "landsat89": (3, 4, 6)}
BAND_COUNT = {"sentinel2": 12, "landsat89": 11}
LANDSAT = ("landsat-8", "landsat-9")


def scene_search(scenes: DataFrame, start: str, end: str, bbox: tuple[float, float, float, float] | None = None, collection: str | None = None, max_cloud: float | None = 80.0) -> DataFrame:
    """Scenes of inclusive dates, below the cloud limit (a scene without the
    property fails it; no limit for None), whose box meets ``bbox``."""
    day = F.to_date("acquired")
    s = scenes.where(day.between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    if collection:
        s = s.where(F.col("collection") == collection)
    if max_cloud is not None:
        s = s.where(F.col("cloud_cover") < max_cloud)
    if bbox:
        names = ("west", "south", "east", "north")
        s = s.where(boxes_meet({n: F.col(n) for n in names}, {n: F.lit(float(v)) for n, v in zip(names, bbox)}))
    return s


def in_time_order(scenes: DataFrame) -> DataFrame:
    """Scenes by time, then id; for what is shown or written, as it shuffles."""
    return scenes.orderBy("acquired", "item_id")


def scene_groups(named: DataFrame) -> DataFrame:
    """Scenes by prefix and date, which are composited together: their ids in
    order of time, and how many there are."""
    held = F.array_sort(F.collect_list(F.struct("acquired", "item_id")))
    g = named.groupBy("prefix", "date_token").agg(held.alias("held"))
    return g.select("prefix", "date_token", F.col("held.item_id").alias("item_ids"), F.size("held").alias("n_scenes"))


def landsat_only(scenes: DataFrame) -> DataFrame:
    return scenes.where(F.lower("platform").isin(*LANDSAT))


def with_names(scenes: DataFrame) -> DataFrame:
    """Adds prefix, preset, date_token, tag and stem."""
    s = scenes.withColumns({
        "prefix": parsing.platform_prefix(F.col("collection"), F.col("platform")),
        "preset": parsing.platform_preset(F.col("collection"), F.col("platform")),
        "date_token": F.date_format("acquired", "yyyyMMdd"),
        "tag": parsing.scene_tag(F.col("item_id")),
    })
    return s.withColumn("stem", F.concat_ws("_", "prefix", "date_token", "tag"))


def with_offset(scenes: DataFrame, *baselines: str) -> DataFrame:
    """Adds baseline and dn_offset; only Sentinel-2 has one."""
    b = radiometry.parse_baseline(*[F.col(c) for c in baselines])
    offset = F.when(F.col("collection") == "sentinel-2-l2a", radiometry.dn_offset(b)).otherwise(F.lit(0.0))
    return scenes.withColumn("baseline", b).withColumn("dn_offset", offset)


# Properties that may hold a sun angle, the first number wins.
SUN_AZIMUTH = ("view:sun_azimuth", "s2:mean_solar_azimuth", "solar_azimuth", "sun_azimuth")
SUN_ZENITH = ("view:sun_zenith", "s2:mean_solar_zenith", "solar_zenith", "sun_zenith")
SUN_ELEVATION = ("view:sun_elevation", "sun_elevation", "solar_elevation")


def typed_scenes(items: DataFrame, strict: bool = True) -> DataFrame:
    """Adds to catalog items (geometry: GeoJSON text, props: map) what searches
    and metadata read: acquired, platform, cloud_cover, processing_baseline,
    sun angles, and the geometry's box (null without polygon)."""
    props = F.col("props")
    typed = items.withColumns({
        "acquired": parsing.scene_datetime(props, strict), "platform": F.try_element_at(props, F.lit("platform")),
        "cloud_cover": F.try_element_at(props, F.lit("eo:cloud_cover")).try_cast("double"),
        "processing_baseline": F.coalesce(F.try_element_at(props, F.lit("s2:processing_baseline")), F.try_element_at(props, F.lit("processing_baseline"))),
        "sun_azimuth": parsing.first_number(props, SUN_AZIMUTH), "sun_zenith": parsing.first_number(props, SUN_ZENITH), "sun_elevation": parsing.first_number(props, SUN_ELEVATION),
    })
    # Expanding a list of one keeps a text from being parsed once a bound and
    # filter; filters on what was typed above go below it.
    steps = (F.from_json("geometry", GEOJSON), geometry(F.col("g")), rings(F.col("g")), F.flatten(F.flatten("g")))
    for step in steps:
        typed = typed.withColumn("g", F.explode(F.array(step)))
    x, y = F.transform("g", lambda p: p[0]), F.transform("g", lambda p: p[1])
    return typed.withColumns({"west": F.array_min(x), "south": F.array_min(y), "east": F.array_max(x), "north": F.array_max(y)}).drop("g")


def footprint_edges(items: DataFrame, strict: bool = False) -> DataFrame:
    """Edges of catalog items' geometries, for ``polygons_in_areas``: their
    ``aoi_id`` is the item_id. Items without polygon have none, or are an error
    if ``strict``."""
    return aoi_edges(items.select(F.col("item_id").alias("aoi_id"), "geometry"), "geometry", strict)


def scene_metadata(scenes: DataFrame, *more: str) -> DataFrame:
    """Acquisition time, image id, sun angles (zenith else 90 - elevation),
    baseline and offset of scenes that have a geometry, and ``more`` columns."""
    s = with_offset(scenes, "processing_baseline").where(F.col("west").isNotNull())
    return s.select(
        F.date_format("acquired", "yyyy-MM-dd HH:mm:ss").alias("acquisition_date"), F.col("item_id").alias("image_id"),
        F.col("sun_azimuth").alias("solar_azimuth"), F.coalesce("sun_zenith", 90.0 - F.col("sun_elevation")).alias("solar_zenith"),
        "processing_baseline", "baseline", F.when(F.col("collection") == "sentinel-2-l2a", F.col("dn_offset")).alias("dn_offset"), "west", "south", "east", "north", *more,
    )


def feature_json(metadata: DataFrame) -> DataFrame:
    """image_id and a GeoJSON feature per row: unknown sun angles are null, an
    unknown baseline or offset is left out."""
    ring = [("west", "south"), ("east", "south"), ("east", "north"), ("west", "north"), ("west", "south")]
    shape = F.struct(F.lit("Polygon").alias("type"), F.array(F.array(*[F.array(x, y) for x, y in ring])).alias("coordinates"))
    known = F.to_json(F.struct(F.col("acquisition_date").alias("Acquisition_Date"), F.col("image_id").alias("Image_ID"), F.col("solar_azimuth").alias("Solar_Azimuth_Angle"), F.col("solar_zenith").alias("Solar_Zenith_Angle")), {"ignoreNullFields": "false"})
    more = F.to_json(F.struct(F.col("processing_baseline").alias("Processing_Baseline"), F.col("dn_offset").alias("DN_Add_Offset")))
    props = F.concat(F.rtrim(known, F.lit("}")), F.when(more == "{}", "").otherwise(F.lit(",")), F.ltrim(more, F.lit("{")))
    head = F.to_json(F.struct(F.lit("Feature").alias("type"), shape.alias("geometry"), F.col("image_id").alias("id")))
    return metadata.select("image_id", F.concat(F.substring(head, F.lit(1), F.length(head) - 1), F.lit(',"properties":'), props, F.lit("}")).alias("feature"))


def item_crs(scenes: DataFrame) -> DataFrame:
    """item_id, epsg: from the properties, else the first asset, in the order
    of the map, that has one. Needs ``props`` (map) and ``assets`` (map of structs with epsg)."""
    from_assets = F.try_element_at(F.filter(F.transform(F.map_values("assets"), lambda a: a["epsg"]), lambda e: e.isNotNull()), F.lit(1))
    return scenes.select("item_id", F.coalesce(F.try_element_at("props", F.lit("proj:epsg")).try_cast("int"), from_assets).alias("epsg"))


def first_by(df: DataFrame, value: str, order: list[str], key: list[str] | None = None) -> DataFrame:
    """The first value that is not null in a stated order."""
    first = F.min_by(value, F.when(F.col(value).isNotNull(), F.struct(*order))).alias(value)
    return df.groupBy(*(key or [])).agg(first)


def scene_bands(satellite: Column, requested: Column, cloud: Column, snow: Column) -> tuple[Column, Column]:
    """Bands to read (requested and mask-required, ascending) and requested
    numbers that the satellite does not have."""
    def pick(table: dict) -> Column:
        return F.when(satellite == "sentinel2", F.array(*map(F.lit, table["sentinel2"]))).otherwise(F.array(*map(F.lit, table["landsat89"])))

    none = F.array().cast("array<int>")
    most = F.when(satellite == "sentinel2", BAND_COUNT["sentinel2"]).otherwise(BAND_COUNT["landsat89"])
    bands = F.array_union(F.array_union(requested, F.when(cloud, pick(CLOUD_BANDS)).otherwise(none)), F.when(snow, pick(SNOW_BANDS)).otherwise(none))
    known = F.sequence(F.lit(1), most)
    return F.array_sort(F.array_intersect(bands, known)), F.array_sort(F.array_except(requested, known))


def band_assets(scenes: DataFrame, bands: DataFrame, assets: DataFrame, strict: bool = True) -> DataFrame:
    """Each scene's requested bands with their asset's href. Where the scene
    has none it is an error, or null if not ``strict``. scenes: item_id, collection, bands; bands: collection,
    band_no, asset; assets: item_id, asset, href."""
    want = scenes.select("item_id", "collection", F.explode("bands").alias("band_no")).join(small(bands), ["collection", "band_no"])
    href = F.col("href")
    if strict:
        href = F.coalesce(href, F.raise_error(F.concat_ws(" ", F.lit("no asset"), "asset", F.lit("in scene"), "item_id")).cast("string"))
    return want.join(assets, ["item_id", "asset"], "left").select("item_id", "band_no", "asset", href.alias("href"))


def work_actions(scenes: DataFrame, images: DataFrame, composites: DataFrame) -> DataFrame:
    """What is to do per scene: skip (its day's composite is there), mask (its
    image is, the composite not) or download."""
    img = images.select("stem").distinct().withColumn("has_image", F.lit(True))
    comp = composites.select("prefix", "date_token").distinct().withColumn("has_composite", F.lit(True))
    j = scenes.join(img, "stem", "left").join(comp, ["prefix", "date_token"], "left")
    return j.withColumn("action", F.when(F.col("has_composite"), "skip").when(F.col("has_image"), "mask").otherwise("download")).drop("has_image", "has_composite")


def skip_existing(wanted: DataFrame, done: DataFrame, key: list[str], expected: int = 1, mode: str = "skip") -> DataFrame:
    """Wanted rows whose key has fewer than ``expected`` outputs; all of them
    in mode overwrite."""
    if mode == "overwrite":
        return wanted
    if mode != "skip":
        raise ValueError("mode is skip or overwrite")
    full = done.groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") >= expected)
    return wanted.join(full, key, "left_anti")


def parse_granules(granules: DataFrame, strict: bool = True) -> DataFrame:
    """Adds product, acq_date, tile, h, v; drops unparsable names if strict."""
    # Expanding a list of one keeps a name from being parsed once a use: filters
    # and joins on what it holds stay above.
    g = granules
    for parsed in (
        {"product": F.split("filename", "\\.")[0], "acq_date": parsing.granule_date(F.col("filename")), "tile": parsing.granule_tile(F.col("filename"))},
        {"h": parsing.tile_index(F.col("tile"), "h"), "v": parsing.tile_index(F.col("tile"), "v")},
    ):
        g = g.withColumn("parsed_name", F.explode(F.array(F.struct(*[c.alias(n) for n, c in parsed.items()]))))
        g = g.withColumns({n: F.col("parsed_name")[n] for n in parsed}).drop("parsed_name")
    return g.where(F.col("acq_date").isNotNull() & F.col("tile").isNotNull()) if strict else g


def granule_search(granules: DataFrame, tiles: DataFrame, start: str, end: str) -> DataFrame:
    """Parsed granules from ``start`` up to the end of day ``end`` on the
    given (h, v) tiles."""
    day = F.col("acq_date")
    return granules.where((day >= F.lit(start).cast("date")) & (day < F.date_add(F.lit(end).cast("date"), 1))).join(tiles.select("h", "v").distinct(), ["h", "v"], "left_semi")


def granules_by_date(granules: DataFrame) -> DataFrame:
    return granules.groupBy("product", "acq_date").agg(F.sort_array(F.collect_set("tile")).alias("tiles"), F.count("*").alias("n_granules"))


def calendar_coverage(windows: DataFrame, granules: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Each day of the windows with its granules; days without are skipped.
    ``key`` names what windows and granules must agree in, such as a product:
    another platform's granules don't make a day one to process."""
    key = ["product"] if key is None else key
    days = windows.select("window_id", *key, F.explode(F.sequence("start", "end")).alias("acq_date"))
    n = granules.groupBy(*key, "acq_date").agg(F.count("*").alias("n"))
    j = days.join(n, [*key, "acq_date"], "left").withColumn("n_granules", F.coalesce("n", F.lit(0)))
    return j.select("window_id", *key, "acq_date", "n_granules", F.when(F.col("n_granules") > 0, "process").otherwise("skip").alias("action"))
