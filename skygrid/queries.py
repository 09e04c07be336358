"""Registered queries, each with the SQL that gives the same rows.

All read the driver's tables, through the views of ``sources.views``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import geo, parsing, radiometry
from .operators import aoi, catalog, chips, composite, detections, grids, intervals, pixels, report, spans, tiles
from .operators.sizes import spread
from .plans import imagery, surface_reflectance
from .plans.scratch import cut, shared_dir
from .sources import outputs, readers, sinks, views
from .sources.views import read
from .streaming import detections as stream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, *fx: str):
    """Register a query; ``fx`` are the views that its SQL reads."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = (views.sql(*fx) if fx else "") + sql
        return f

    return add


def _with(text: str) -> str:
    """Further named steps after the views."""
    return ", " + text


# --- pixels ---------------------------------------------------------------

BANDS = ["b01", "b03", "b04", "b08", "b11"]
_REF = "least(greatest(CAST({b} AS FLOAT) * CAST(0.0001 AS FLOAT), CAST(0 AS FLOAT)), CAST(1 AS FLOAT))"
_R = "r AS (SELECT scene_no, prefix, date_token, row_idx, col_idx, cloud_class, " + ", ".join(f"{_REF.format(b=b)} AS {b}" for b in BANDS) + " FROM fx_pixels)"
_SNOW = "CASE WHEN b03 + b11 = CAST(0 AS FLOAT) THEN 255 WHEN CAST((b03 - b11) / nullif(b03 + b11, CAST(0 AS FLOAT)) AS FLOAT) > CAST(0.4 AS FLOAT) AND b04 > CAST(0.2 AS FLOAT) THEN 1 ELSE 0 END"
_S = f"s AS (SELECT *, {_SNOW} AS snow FROM r)"
_MASK = "(cloud_class IN (1, 3) OR {snow}b01 = 0 OR (greatest(b01, b03, b04, b08, b11) = 0 AND least(b01, b03, b04, b08, b11) = 0))"
_M = f"m AS (SELECT *, {_MASK.format(snow='snow = 1 OR ')} AS masked FROM s)"


def _reflect(spark: SparkSession, d: str) -> DataFrame:
    return pixels.to_reflectance(read(spark, d, "fx_pixels"), BANDS)


def _snow(spark: SparkSession, d: str) -> DataFrame:
    return pixels.snow_mask(_reflect(spark, d), "b03", "b04", "b11")


def _masked(spark: SparkSession, d: str) -> DataFrame:
    return pixels.apply_mask(_snow(spark, d), BANDS, classes=(1, 3), snow="snow", first_band="b01")


@query(_with(f"{_R}, {_S}, {_M}") + """ SELECT prefix, date_token, row_idx, col_idx, min(CASE WHEN NOT masked THEN b03 END) AS b03, min(CASE WHEN NOT masked THEN b04 END) AS b04,
 coalesce(min(cloud_class), 0) AS cloud, coalesce(max(nullif(snow, 255)), 255) AS snow, count(*) AS n_scenes FROM m GROUP BY ALL""".replace("GROUP BY ALL", "GROUP BY prefix, date_token, row_idx, col_idx"), "fx_pixels")
def masked_composite(spark, d):
    return imagery.masked_composite(read(spark, d, "fx_pixels"), ["b03", "b04"], BANDS, classes=(1, 3))


@query(" SELECT scene_no, row_idx, col_idx, " + ", ".join(f"nullif({b}, 0) AS {b}" for b in BANDS) + " FROM fx_pixels", "fx_pixels")
def stack_nodata_to_null(spark, d):
    return readers.nodata_to_null(read(spark, d, "fx_pixels"), BANDS).select("scene_no", "row_idx", "col_idx", *BANDS)


@query(" SELECT scene_no, row_idx, col_idx, " + ", ".join(f"CASE WHEN {b} = 0 THEN 0e0 ELSE greatest({b} - 1000e0, 0e0) END AS {b}" for b in BANDS) + " FROM fx_pixels", "fx_pixels")
def dn_correct(spark, d):
    p = read(spark, d, "fx_pixels")
    return p.select("scene_no", "row_idx", "col_idx", *[radiometry.dn_correct(F.col(b), F.lit(1000.0)).alias(b) for b in BANDS])


@query(_with(_R) + " SELECT scene_no, row_idx, col_idx, b01, b03, b04, b08, b11 FROM r", "fx_pixels")
def reflectance(spark, d):
    return _reflect(spark, d).select("scene_no", "row_idx", "col_idx", *BANDS)


@query(" SELECT scene_no, row_idx, col_idx, least(greatest(CAST(b04 AS FLOAT) * CAST(0.0000275 AS FLOAT) + CAST(-0.2 AS FLOAT), CAST(0 AS FLOAT)), CAST(1 AS FLOAT)) AS b04 FROM fx_pixels", "fx_pixels")
def reflectance_landsat(spark, d):
    return pixels.to_reflectance(read(spark, d, "fx_pixels"), ["b04"], "landsat8").select("scene_no", "row_idx", "col_idx", "b04")


@query(_with(f"{_R}, {_S}") + " SELECT scene_no, row_idx, col_idx, snow FROM s", "fx_pixels")
def snow_mask(spark, d):
    return _snow(spark, d).select("scene_no", "row_idx", "col_idx", "snow")


@query(_with(f"{_R}, {_S}, {_M}") + " SELECT scene_no, row_idx, col_idx, masked, " + ", ".join(f"CASE WHEN NOT masked THEN {b} END AS {b}" for b in BANDS) + " FROM m", "fx_pixels")
def mask_apply(spark, d):
    return _masked(spark, d).select("scene_no", "row_idx", "col_idx", "masked", *BANDS)


@query(_with("cloud AS (SELECT scene_no, row_idx, col_idx, cloud_class FROM fx_pixels), sn AS (SELECT scene_no, row_idx, col_idx, 1 AS snow FROM fx_pixels WHERE row_idx % 5 = 0)") + " SELECT p.scene_no, p.row_idx, p.col_idx, p.b03, c.cloud_class, s.snow FROM fx_pixels p JOIN cloud c ON p.scene_no = c.scene_no AND p.row_idx = c.row_idx AND p.col_idx = c.col_idx LEFT JOIN sn s ON p.scene_no = s.scene_no AND p.row_idx = s.row_idx AND p.col_idx = s.col_idx", "fx_pixels")
def mask_join(spark, d):
    """A cloud mask of all cells, a snow mask of every fifth row of cells."""
    p = read(spark, d, "fx_pixels")
    cloud = p.select(*pixels.CELL, "cloud_class")
    snow = p.where("row_idx % 5 = 0").select(*pixels.CELL, F.lit(1).alias("snow"))
    return pixels.join_masks(p.drop("cloud_class"), cloud, snow).select(*pixels.CELL, "b03", "cloud_class", "snow")


@query(" SELECT scene_no, row_idx, col_idx, 'b03' AS band, CAST(b03 AS DOUBLE) AS value FROM fx_pixels UNION ALL SELECT scene_no, row_idx, col_idx, 'b08', CAST(b08 AS DOUBLE) FROM fx_pixels", "fx_pixels")
def bands_unpivot(spark, d):
    return pixels.split_bands(read(spark, d, "fx_pixels"), ["b03", "b08"], pixels.CELL)


_CELLS = "prefix, date_token, row_idx, col_idx"


@query(_with(f"{_R}, {_S}, {_M}") + f" SELECT {_CELLS}, " + ", ".join(f"min(CASE WHEN NOT masked THEN {b} END) AS {b}" for b in BANDS) + f", count(*) AS n_scenes FROM m GROUP BY {_CELLS}", "fx_pixels")
def composite_min(spark, d):
    return composite.composite_min(_masked(spark, d), BANDS)


@query(f" SELECT {_CELLS}, coalesce(min(nullif(cloud_class, 2)), 0) AS cloud FROM fx_pixels GROUP BY {_CELLS}", "fx_pixels")
def composite_cloud(spark, d):
    p = read(spark, d, "fx_pixels").withColumn("cloud_class", F.nullif("cloud_class", F.lit(2))).withColumn("snow", F.lit(255))
    return composite.composite_layers(p, []).select("prefix", "date_token", "row_idx", "col_idx", "cloud")


@query(_with(f"{_R}, {_S}") + f" SELECT {_CELLS}, coalesce(max(nullif(snow, 255)), 255) AS snow FROM s GROUP BY {_CELLS}", "fx_pixels")
def composite_snow(spark, d):
    return composite.composite_layers(_snow(spark, d), []).select("prefix", "date_token", "row_idx", "col_idx", "snow")


@query(_with(f"{_R}, {_S}") + f" SELECT {_CELLS}, min(CASE WHEN snow <> 1 THEN b03 END) AS b03, count(*) AS n_scenes FROM s GROUP BY {_CELLS}", "fx_pixels")
def composite_snowmasked(spark, d):
    s = _snow(spark, d).withColumn("b03", F.when(F.col("snow") != 1, F.col("b03")))
    return composite.composite_min(s, ["b03"])


_OUT = ["b03", "b04", "b11"]


@query(_with(f"{_R}, {_S}, {_M}, c AS (SELECT {_CELLS}, " + ", ".join(f"min(CASE WHEN NOT masked THEN {b} END) AS m_{b}, min(CASE WHEN snow <> 1 THEN {b} END) AS s_{b}" for b in _OUT) + f", CAST(coalesce(min(cloud_class), 0) AS FLOAT) AS class, CAST(coalesce(max(nullif(snow, 255)), 255) AS FLOAT) AS snow FROM m GROUP BY {_CELLS})".replace("class, CAST", "class, CAST")).replace("greatest(b01, b03, b04, b08, b11) = 0 AND least(b01, b03, b04, b08, b11) = 0", "greatest(b03, b04, b11) = 0 AND least(b03, b04, b11) = 0").replace("b01 = 0 OR", "b03 = 0 OR") + " SELECT prefix AS satellite, CAST(date_token AS INT) AS date_token, row_idx, col_idx, layer, band, value FROM (" + " UNION ALL ".join(f"SELECT {_CELLS}, '{layer}' AS layer, '{band}' AS band, {c} AS value FROM c" for layer, band, c in [*[("masked", b, f"m_{b}") for b in _OUT], ("cloudmask", "class", "class"), *[("snowmasked", b, f"s_{b}") for b in _OUT], ("snowmask", "snow", "snow")]) + ") q WHERE value IS NOT NULL", "fx_pixels")
def composite_outputs(spark, d):
    """All layers of each day as chips, written by satellite, layer and day,
    read back and unpacked."""
    path = shared_dir(spark, "layers")
    sinks.write_layers(imagery.composite_outputs(read(spark, d, "fx_pixels"), _OUT, classes=(1, 3)), path)
    back = chips.unpack_chips(spark.read.parquet(path), ["values"], ["satellite", "date_token", "layer", "band"])
    return back.withColumnRenamed("values", "value").select("satellite", "date_token", "row_idx", "col_idx", "layer", "band", "value")


@query("SELECT label, CAST(i AS INT) AS place, min(v) AS v FROM (SELECT label, unnest(embedding) AS v, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings) q GROUP BY label, i")
def composite_min_chips(spark, d):
    c = composite.composite_chips(read(spark, d, "embeddings"), "embedding", ["label"])
    return c.select("label", F.posexplode("embedding").alias("place", "v"))


@query("SELECT vec_id, CAST((i // 8) AS INT) AS row_idx, CAST(i % 8 AS INT) AS col_idx, v FROM (SELECT vec_id, unnest(embedding) AS v, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings) q")
def chips_unpack(spark, d):
    c = read(spark, d, "embeddings").select("vec_id", F.lit(0).alias("chip_row"), F.lit(0).alias("chip_col"), F.col("embedding").alias("v"))
    return chips.unpack_chips(c, ["v"], ["vec_id"], 8)


@query(" SELECT scene_no, row_idx, col_idx, b03, b04 FROM fx_pixels", "fx_pixels")
def chips_pack(spark, d):
    """Packs and unpacks again: the cells come back."""
    packed = chips.pack_chips(read(spark, d, "fx_pixels"), ["b03", "b04"], ["scene_no"])
    return chips.unpack_chips(packed, ["b03", "b04"], ["scene_no"])


@query(" SELECT scene_no, row_idx, col_idx, CASE WHEN b03 > 5000 THEN 1 ELSE 0 END AS cloud_class FROM fx_pixels", "fx_pixels")
def mask_model(spark, d):
    """A stub in the network's place: bright cells are cloud."""
    p = read(spark, d, "fx_pixels")
    return chips.mask_model(p, ["b03", "b04", "b08"], ["scene_no"], lambda x: (x[0] > 5000).astype("int32"), patch=256, overlap=64)


# --- scenes ---------------------------------------------------------------

BBOX = (130.5, 32.4, 131.2, 33.0)


@query(" SELECT item_id, collection, cloud_cover FROM fx_scenes WHERE CAST(acquired AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1997-12-31' AND cloud_cover < 80 AND west <= 131.2e0 AND east >= 130.5e0 AND south <= 33e0 AND north >= 32.4e0", "fx_scenes")
def scene_search(spark, d):
    return catalog.scene_search(read(spark, d, "fx_scenes"), "1996-01-01", "1997-12-31", BBOX).select("item_id", "collection", "cloud_cover")


@query(" SELECT item_id, platform FROM fx_scenes WHERE lower(platform) IN ('landsat-8', 'landsat-9')", "fx_scenes")
def scene_platform_filter(spark, d):
    return catalog.landsat_only(read(spark, d, "fx_scenes")).select("item_id", "platform")


_OFFSET = "CASE WHEN collection = 'sentinel-2-l2a' AND try_cast(nullif(trim(processing_baseline), '') AS DOUBLE) >= 4 THEN 1000e0 ELSE 0e0 END"


@query(f" SELECT item_id, try_cast(nullif(trim(processing_baseline), '') AS DOUBLE) AS baseline, {_OFFSET} AS dn_offset FROM fx_scenes", "fx_scenes")
def scene_dn_offset(spark, d):
    return catalog.with_offset(read(spark, d, "fx_scenes"), "processing_baseline").select("item_id", "baseline", "dn_offset")


@query(" SELECT item_id, CAST(acquired AS DATE) AS day FROM fx_scenes", "fx_scenes")
def scene_day(spark, d):
    s = read(spark, d, "fx_scenes").withColumn("stamp", F.concat(F.date_format("acquired", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")))
    first = F.col("scene_no") % 2 == 0
    props = F.create_map(F.lit("datetime"), F.when(first, F.col("stamp")), F.lit("start_datetime"), F.when(~first, F.col("stamp")))
    return s.select("item_id", F.to_date(parsing.scene_datetime(props)).alias("day"))


_PREFIX = "CASE WHEN collection = 'sentinel-2-l2a' THEN 'S2C' WHEN contains(lower(platform), 'landsat-9') THEN 'L9C' ELSE 'L8C' END"
_STEM = f"concat({_PREFIX}, '_', strftime(acquired, '%Y%m%d'), '_', right(replace(item_id, '_', ''), 24))"


@query(f" SELECT item_id, {_PREFIX} AS prefix, {_STEM} AS stem FROM fx_scenes", "fx_scenes")
def scene_stem(spark, d):
    return catalog.with_names(read(spark, d, "fx_scenes")).select("item_id", "prefix", "stem")


@query(f" SELECT strftime(acquired, '%Y-%m-%d %H:%M:%S') AS acquisition_date, item_id AS image_id, sun_azimuth AS solar_azimuth, coalesce(sun_zenith, 90e0 - sun_elevation) AS solar_zenith, processing_baseline, try_cast(nullif(trim(processing_baseline), '') AS DOUBLE) AS baseline, CASE WHEN collection = 'sentinel-2-l2a' THEN {_OFFSET} END AS dn_offset, west, south, east, north FROM fx_scenes", "fx_scenes")
def scene_metadata(spark, d):
    return catalog.scene_metadata(read(spark, d, "fx_scenes"))


_META = f"strftime(acquired, '%Y-%m-%d %H:%M:%S') AS acquired, sun_azimuth AS azimuth, coalesce(sun_zenith, 90e0 - sun_elevation) AS zenith, processing_baseline AS baseline, CASE WHEN collection = 'sentinel-2-l2a' THEN {_OFFSET} END AS dn_offset"
_FEATURE = "type string, id string, geometry struct<type:string,coordinates:array<array<array<double>>>>, properties struct<Acquisition_Date:string,Image_ID:string,Solar_Azimuth_Angle:double,Solar_Zenith_Angle:double,Processing_Baseline:string,DN_Add_Offset:double>"


@query(f" SELECT item_id AS image_id, 'Feature' AS kind, item_id AS id, {_META}, west AS x0, north AS y2, 5 AS n_points, sun_zenith IS NULL AND sun_elevation IS NULL AS null_zenith FROM fx_scenes", "fx_scenes")
def scene_features_json(spark, d):
    """Features as text lines, written, and read back from their JSON."""
    path = shared_dir(spark, "features")
    sinks.write_features(catalog.feature_json(catalog.scene_metadata(read(spark, d, "fx_scenes"))), path)
    f = spark.read.text(path).select("value", F.from_json("value", _FEATURE).alias("f")).select("value", "f.*")
    p, ring = F.col("properties"), F.col("geometry")["coordinates"][0]
    return f.select(
        p["Image_ID"].alias("image_id"), F.col("type").alias("kind"), "id", p["Acquisition_Date"].alias("acquired"), p["Solar_Azimuth_Angle"].alias("azimuth"), p["Solar_Zenith_Angle"].alias("zenith"),
        p["Processing_Baseline"].alias("baseline"), p["DN_Add_Offset"].alias("dn_offset"), ring[0][0].alias("x0"), ring[2][1].alias("y2"), F.size(ring).alias("n_points"), F.col("value").contains('"Solar_Zenith_Angle":null').alias("null_zenith"),
    )


@query(f" SELECT item_id, {_META}, round(cloud_cover, 6) AS cloud_cover, round(west, 6) AS west, round(north, 6) AS north FROM fx_scenes WHERE CAST(acquired AS DATE) BETWEEN DATE '1993-01-01' AND DATE '1997-12-31' AND cloud_cover < 80 AND west <= 131.2e0 AND east >= 130.5e0 AND south <= 33e0 AND north >= 32.4e0", "fx_scenes")
def scene_catalog(spark, d):
    """The catalog written as items (a geometry, a map of properties, assets),
    read back, searched and described. Sun angles stand under various keys."""
    s = read(spark, d, "fx_scenes")
    number = lambda c: F.col(c).cast("string")
    even = F.col("scene_no") % 2 == 0
    props = F.map_filter(F.create_map(
        F.when(F.col("scene_no") % 3 == 0, "datetime").otherwise("start_datetime"), F.concat(F.date_format("acquired", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")), F.lit("platform"), F.col("platform"), F.lit("eo:cloud_cover"), number("cloud_cover"),
        F.when(even, "s2:processing_baseline").otherwise("processing_baseline"), F.col("processing_baseline"), F.lit("view:sun_azimuth"), F.when(even, number("sun_azimuth")).otherwise("none"), F.lit("sun_azimuth"), number("sun_azimuth"),
        F.when(even, "s2:mean_solar_zenith").otherwise("solar_zenith"), number("sun_zenith"), F.when(even, "view:sun_elevation").otherwise("solar_elevation"), number("sun_elevation"),
    ), lambda k, v: v.isNotNull())
    corners = F.array(*[F.array(F.col(x), F.col(y)) for x, y in (("west", "south"), ("east", "south"), ("east", "north"), ("west", "north"), ("west", "south"))])
    shape = F.to_json(F.struct(F.lit("Polygon").alias("type"), F.array(corners).alias("coordinates")))
    path = shared_dir(spark, "catalog")
    # Items are far longer as text than as rows of the table.
    spread(s, "item_id").select("item_id", "collection", shape.alias("geometry"), props.alias("props")).write.json(path)
    found = catalog.scene_search(readers.read_scenes(spark, path), "1993-01-01", "1997-12-31", BBOX)
    return catalog.scene_metadata(found, "cloud_cover").select(
        F.col("image_id").alias("item_id"), F.col("acquisition_date").alias("acquired"), F.col("solar_azimuth").alias("azimuth"), F.col("solar_zenith").alias("zenith"), F.col("processing_baseline").alias("baseline"), "dn_offset",
        *[F.round(c, 6).alias(c) for c in ("cloud_cover", "west", "north")],
    )


@query(f" SELECT {_PREFIX} AS prefix, strftime(acquired, '%Y%m%d') AS date_token, string_agg(item_id, ',' ORDER BY acquired, item_id) AS item_ids, CAST(count(*) AS INT) AS n_scenes FROM fx_scenes GROUP BY 1, 2", "fx_scenes")
def scene_groups(spark, d):
    g = catalog.scene_groups(catalog.with_names(read(spark, d, "fx_scenes")))
    return g.withColumn("item_ids", F.array_join("item_ids", ","))


@query(" SELECT item_id, CAST(CASE WHEN scene_no % 3 = 0 THEN 32652 WHEN scene_no % 3 = 1 THEN 32653 WHEN scene_no % 2 = 0 THEN 32651 END AS INT) AS epsg FROM fx_scenes", "fx_scenes")
def scene_crs(spark, d):
    """From the properties, if they hold a number, else from the first asset
    in the item's order (not in that of names) that has one."""
    s = read(spark, d, "fx_scenes")
    n = F.col("scene_no") % 3
    epsgs = (("visual", F.lit(None).cast("int")), ("B08", F.when(n == 1, F.lit(32653))), ("B02", F.when(F.col("scene_no") % 2 == 0, F.lit(32651))))
    assets = F.create_map(*[x for name, e in epsgs for x in (F.lit(name), F.struct(F.lit("x").alias("href"), e.alias("epsg")))])
    props = F.create_map(F.lit("proj:epsg"), F.when(n == 0, F.lit("32652")).otherwise("unknown"))
    return catalog.item_crs(s.select("item_id", props.alias("props"), assets.alias("assets")))


@query(" SELECT collection, platform, min_by(item_id, (acquired, item_id)) AS item_id FROM fx_scenes GROUP BY collection, platform", "fx_scenes")
def first_scene(spark, d):
    return catalog.first_by(read(spark, d, "fx_scenes"), "item_id", ["acquired", "item_id"], ["collection", "platform"])


@query(" SELECT collection, min_by(cloud_cover, (acquired, item_id)) AS cloud_cover FROM fx_scenes WHERE cloud_cover IS NOT NULL GROUP BY collection", "fx_scenes")
def first_crs(spark, d):
    """The first known value in order of time, as the CRS of a run is chosen."""
    return catalog.first_by(read(spark, d, "fx_scenes"), "cloud_cover", ["acquired", "item_id"], ["collection"])


@query(""" SELECT item_id, list_aggregate(list_sort(list_distinct(list_filter([CAST(scene_no % 14 AS INT) + 1] || CASE WHEN scene_no % 3 = 0 THEN CASE WHEN s2 THEN [3, 4, 8] ELSE [3, 4, 5] END ELSE CAST([] AS INT[]) END
 || CASE WHEN scene_no % 5 = 0 THEN CASE WHEN s2 THEN [3, 4, 11] ELSE [3, 4, 6] END ELSE CAST([] AS INT[]) END, lambda b : b <= CASE WHEN s2 THEN 12 ELSE 11 END))), 'string_agg', ',') AS bands,
 scene_no % 14 + 1 > CASE WHEN s2 THEN 12 ELSE 11 END AS unknown FROM (SELECT *, scene_no % 2 = 0 AS s2 FROM fx_scenes) q""", "fx_scenes")
def band_request(spark, d):
    s = read(spark, d, "fx_scenes").withColumn("satellite", F.when(F.col("collection") == "sentinel-2-l2a", "sentinel2").otherwise("landsat89"))
    bands, unknown = catalog.scene_bands(F.col("satellite"), F.array((F.col("scene_no") % 14 + 1).cast("int")), F.col("scene_no") % 3 == 0, F.col("scene_no") % 5 == 0)
    return s.select("item_id", F.nullif(F.array_join(bands, ","), F.lit("")).alias("bands"), (F.size(unknown) > 0).alias("unknown"))


@query(" SELECT item_id, band_no, asset, CASE WHEN (scene_no + band_no) % 6 <> 0 THEN concat(item_id, '/', asset) END AS href FROM fx_scenes CROSS JOIN (VALUES ('sentinel-2-l2a', 3, 'B03'), ('sentinel-2-l2a', 8, 'B08'), ('landsat-c2-l2', 3, 'green'), ('landsat-c2-l2', 8, 'qa_aerosol')) AS b(c, band_no, asset) WHERE c = collection", "fx_scenes")
def band_assets(spark, d):
    s = read(spark, d, "fx_scenes")
    table = [("sentinel-2-l2a", i, a) for i, a in catalog.SENTINEL_BANDS] + [("landsat-c2-l2", i, a) for i, a in catalog.LANDSAT_BANDS]
    bands = spark.createDataFrame(table, "collection string, band_no int, asset string")
    want = s.select("item_id", "collection", F.array(F.lit(3), F.lit(8)).alias("bands"))
    assets = s.join(F.broadcast(bands), "collection").where("(scene_no + band_no) % 6 <> 0").select("item_id", "asset", F.concat_ws("/", "item_id", "asset").alias("href"))
    return catalog.band_assets(want, bands, assets, strict=False)


@query(f" SELECT item_id, CASE WHEN day % 3 = 0 THEN 'skip' WHEN scene_no % 4 = 0 THEN 'mask' ELSE 'download' END AS action FROM (SELECT *, CAST(day(acquired) AS INT) AS day, {_STEM} AS stem FROM fx_scenes) q", "fx_scenes")
def work_actions(spark, d):
    s = catalog.with_names(read(spark, d, "fx_scenes"))
    return catalog.work_actions(s, s.where("scene_no % 4 = 0"), s.where("day(acquired) % 3 = 0")).select("item_id", "action")


@query(" SELECT item_id FROM fx_scenes WHERE scene_no % 4 <> 0", "fx_scenes")
def skip_existing(spark, d):
    """Two outputs are expected of each scene; every fourth has both."""
    s = read(spark, d, "fx_scenes").select("item_id", "scene_no")
    done = s.where("scene_no % 2 = 0").unionByName(s.where("scene_no % 4 = 0"))
    return catalog.skip_existing(s, done, ["item_id"], expected=2).select("item_id")


@query(" SELECT region, CAST(year AS INT) AS year, day, count(*) AS n FROM (SELECT r_name AS region, year(l_shipdate) AS year, CAST(l_shipdate AS DATE) AS day FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2, 3) q GROUP BY region, year, day".lstrip())
def batch_plan(spark, d):
    l, s, n, r = (read(spark, d, t) for t in ("lineitem", "supplier", "nation", "region"))
    days = l.join(s, l.l_suppkey == s.s_suppkey).join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey).select(F.col("r_name").alias("region"), F.year("l_shipdate").alias("year"), F.to_date("l_shipdate").alias("day")).distinct()
    years = days.groupBy("region", "year").agg(F.sort_array(F.collect_list("day")).alias("dates"))
    regions = years.groupBy("region").agg(F.map_from_entries(F.collect_list(F.struct("year", "dates"))).alias("years"))
    return report.batch_plan(regions).groupBy("region", "year", "day").agg(F.count("*").alias("n"))


@query(" SELECT collection, min(CAST(acquired AS DATE)) AS first_day, max(CAST(acquired AS DATE) + 5) AS last_day FROM fx_scenes GROUP BY collection", "fx_scenes")
def window_range(spark, d):
    w = read(spark, d, "fx_scenes").select("collection", F.to_date("acquired").alias("start"), F.date_add(F.to_date("acquired"), 5).alias("end"))
    return report.window_range(w, ["collection"])


@query(""" SELECT *, CASE WHEN n_failed = 0 THEN 'success' WHEN n_failed = n_items THEN 'failed' ELSE 'partial' END AS status FROM (
 SELECT platform, CAST(year(acquired) AS INT) AS year, count(*) AS n_items, count(*) FILTER (scene_no % 97 <> 0 AND scene_no % 5 <> 0) AS n_processed, count(*) FILTER (scene_no % 97 <> 0 AND scene_no % 5 = 0) AS n_skipped, count(*) FILTER (scene_no % 97 = 0) AS n_failed
 FROM fx_scenes GROUP BY platform, year(acquired)) q""", "fx_scenes")
def run_report(spark, d):
    status = F.when(F.col("scene_no") % 97 == 0, "failed").when(F.col("scene_no") % 5 == 0, "skipped").otherwise("processed")
    return report.run_report(read(spark, d, "fx_scenes").select("platform", F.year("acquired").alias("year"), status.alias("status")), ["platform", "year"])


# --- areas ----------------------------------------------------------------


def _area_texts(spark: SparkSession, d: str) -> DataFrame:
    """The areas of fx_areas as GeoJSON texts: collections, features and bare
    geometries, with rings that are closed."""
    a = read(spark, d, "fx_areas")

    def point(x, y):
        deg = lambda v: F.concat(F.floor(v / 100).cast("string"), F.lit("."), F.lpad((v % 100).cast("string"), 2, "0"))
        return F.concat(F.lit("["), deg(x), F.lit(","), deg(y), F.lit(",7.5]"))

    def ring(dx, pts):
        return F.concat(F.lit("["), F.concat_ws(",", *[point(F.col("x") + dx + F.floor(F.col("side") * u / 10), F.col("y") + F.floor(F.col("side") * v / 10)) for u, v in [*pts, pts[0]]]), F.lit("]"))

    def part(dx):
        outer, hole = ring(dx, [(0, 0), (0, 10), (10, 10), (10, 0)]), ring(dx, [(2, 2), (6, 2), (6, 6)])
        return F.concat(F.lit("["), outer, F.when(F.col("holed"), F.concat(F.lit(","), hole)).otherwise(""), F.lit("]"))

    multi = F.concat(F.lit('{"type":"MultiPolygon","coordinates":['), part(0), F.lit(","), part(50), F.lit("]}"))
    g = F.when(F.col("twofold"), multi).otherwise(F.concat(F.lit('{"type":"Polygon","coordinates":'), part(0), F.lit("}")))
    kind = F.col("aoi_id") % 3
    text = F.when(kind == 0, F.concat(F.lit('{"type":"FeatureCollection","features":[{"type":"Feature","geometry":'), g, F.lit("}]}"))).when(kind == 1, F.concat(F.lit('{"type":"Feature","geometry":'), g, F.lit("}"))).otherwise(g)
    # Texts are few bytes that take long to parse.
    return spread(a.select("aoi_id", text.alias("geojson")), "aoi_id")


def _edges(spark: SparkSession, d: str) -> DataFrame:
    return aoi.aoi_edges(cut(_area_texts(spark, d), "areas"))


@query(" SELECT aoi_id, CAST(part AS INT) AS part, CAST(ring AS INT) AS ring, CAST(edge AS INT) AS edge, x1, y1, x2, y2 FROM fx_edges", "fx_edges")
def aoi_edges(spark, d):
    return _edges(spark, d)


@query(" SELECT aoi_id, min(x1) AS west, min(y1) AS south, max(x1) AS east, max(y1) AS north FROM fx_edges GROUP BY aoi_id", "fx_edges")
def aoi_bbox(spark, d):
    return aoi.aoi_bbox(_edges(spark, d))


_INSIDE = """x AS (SELECT p.event_id, e.aoi_id, e.part, e.ring,
   max(CASE WHEN abs((lon - x1) * (y2 - y1) - (lat - y1) * (x2 - x1)) <= 1e-12 AND lon >= least(x1, x2) - 1e-12 AND lon <= greatest(x1, x2) + 1e-12 AND lat >= least(y1, y2) - 1e-12 AND lat <= greatest(y1, y2) + 1e-12 THEN 1 ELSE 0 END) AS on_edge,
   sum(CASE WHEN (y1 > lat) <> (y2 > lat) AND lon - x1 < (x2 - x1) * ((lat - y1) / nullif(y2 - y1, 0)) THEN 1 ELSE 0 END) % 2 AS odd
  FROM p JOIN b ON p.lon BETWEEN b.w AND b.e AND p.lat BETWEEN b.s AND b.n JOIN fx_edges e ON e.aoi_id = b.aoi_id GROUP BY p.event_id, e.aoi_id, e.part, e.ring),
 y AS (SELECT event_id, aoi_id, part, max(CASE WHEN ring = 0 AND (on_edge = 1 OR odd = 1) THEN 1 ELSE 0 END) AS o, max(CASE WHEN ring > 0 AND (on_edge = 1 OR odd = 1) THEN 1 ELSE 0 END) AS h FROM x GROUP BY event_id, aoi_id, part)"""
_BOXES = "b AS (SELECT aoi_id, min(x1) AS w, min(y1) AS s, max(x1) AS e, max(y1) AS n FROM fx_edges GROUP BY aoi_id)"


@query(_with("p AS (SELECT event_id, try_cast(longitude AS DOUBLE) AS lon, try_cast(latitude AS DOUBLE) AS lat FROM fx_detections), " + _BOXES + ", " + _INSIDE) + " SELECT DISTINCT event_id, aoi_id FROM y WHERE o = 1 AND h = 0", "fx_detections", "fx_edges")
def detections_in_aoi(spark, d):
    t = detections.typed(read(spark, d, "fx_detections"))
    return aoi.points_in_areas(t, _edges(spark, d), ["event_id"])


@query(_with(_BOXES) + " SELECT item_id, aoi_id FROM fx_scenes JOIN b ON west <= b.e AND east >= b.w AND south <= b.n AND north >= b.s", "fx_scenes", "fx_edges")
def scene_intersects(spark, d):
    return aoi.boxes_in_areas(read(spark, d, "fx_scenes"), _edges(spark, d), exact=False)


_CORNERS = "p AS (SELECT item_id AS event_id, unnest([west, west, east, east]) AS lon, unnest([south, north, south, north]) AS lat, unnest([1, 2, 3, 4]) AS corner FROM fx_scenes)"
# An edge meets a box if its part inside the box's west and east, then inside
# its south and north, is not empty (cut step by step, with a small margin).
_MEETS = """k AS (SELECT item_id, aoi_id, west, east, south, north, x1, y1, x2, y2, x2 - x1 AS dx, y2 - y1 AS dy FROM fx_scenes JOIN b ON west <= b.e AND east >= b.w AND south <= b.n AND north >= b.s JOIN fx_edges USING (aoi_id)),
 z AS (SELECT item_id, aoi_id FROM k WHERE least(x1, x2) <= east + 1e-9 AND greatest(x1, x2) >= west - 1e-9 AND least(y1, y2) <= north + 1e-9 AND greatest(y1, y2) >= south - 1e-9
   AND greatest(0e0, CASE WHEN dx > 0 THEN (west - 1e-9 - x1) / dx WHEN dx < 0 THEN (east + 1e-9 - x1) / dx ELSE 0e0 END, CASE WHEN dy > 0 THEN (south - 1e-9 - y1) / dy WHEN dy < 0 THEN (north + 1e-9 - y1) / dy ELSE 0e0 END)
    <= least(1e0, CASE WHEN dx > 0 THEN (east + 1e-9 - x1) / dx WHEN dx < 0 THEN (west - 1e-9 - x1) / dx ELSE 1e0 END, CASE WHEN dy > 0 THEN (north + 1e-9 - y1) / dy WHEN dy < 0 THEN (south - 1e-9 - y1) / dy ELSE 1e0 END))"""


@query(_with(", ".join([_CORNERS, _BOXES, _INSIDE.replace("p.event_id", "concat(p.event_id, '|', p.corner)", 1).replace("SELECT concat(p.event_id, '|', p.corner), ", "SELECT concat(p.event_id, '|', p.corner) AS event_id, ").replace("GROUP BY p.event_id", "GROUP BY p.event_id, p.corner"), _MEETS])) + " SELECT split_part(event_id, '|', 1) AS item_id, aoi_id FROM y WHERE o = 1 AND h = 0 UNION SELECT item_id, aoi_id FROM z", "fx_scenes", "fx_edges")
def scene_intersects_exact(spark, d):
    return aoi.boxes_in_areas(read(spark, d, "fx_scenes"), _edges(spark, d))


# Whole thousandths of a degree, so that touching is exact.
_POLYGONS = """a AS (SELECT aoi_id, part, ring, edge, CAST(round(x1 * 1000) AS BIGINT) AS x1, CAST(round(y1 * 1000) AS BIGINT) AS y1, CAST(round(x2 * 1000) AS BIGINT) AS x2, CAST(round(y2 * 1000) AS BIGINT) AS y2 FROM fx_edges),
 fb AS (SELECT item_id, min(x1) AS w, min(y1) AS s, max(x1) AS e, max(y1) AS n FROM fx_footprints GROUP BY item_id), ab AS (SELECT aoi_id, min(x1) AS w, min(y1) AS s, max(x1) AS e, max(y1) AS n FROM a GROUP BY aoi_id),
 k AS (SELECT item_id, aoi_id FROM fb JOIN ab ON fb.w <= ab.e AND fb.e >= ab.w AND fb.s <= ab.n AND fb.n >= ab.s),
 o AS (SELECT k.item_id, k.aoi_id, (f.x2 - f.x1) * (a.y1 - f.y1) - (f.y2 - f.y1) * (a.x1 - f.x1) AS s1, (f.x2 - f.x1) * (a.y2 - f.y1) - (f.y2 - f.y1) * (a.x2 - f.x1) AS s2, (a.x2 - a.x1) * (f.y1 - a.y1) - (a.y2 - a.y1) * (f.x1 - a.x1) AS s3, (a.x2 - a.x1) * (f.y2 - a.y1) - (a.y2 - a.y1) * (f.x2 - a.x1) AS s4
   FROM k JOIN fx_footprints f ON f.item_id = k.item_id JOIN a ON a.aoi_id = k.aoi_id WHERE least(f.x1, f.x2) <= greatest(a.x1, a.x2) AND greatest(f.x1, f.x2) >= least(a.x1, a.x2) AND least(f.y1, f.y2) <= greatest(a.y1, a.y2) AND greatest(f.y1, f.y2) >= least(a.y1, a.y2)),
 fi AS (SELECT k.item_id, k.aoi_id, a.part, a.ring, sum(CASE WHEN (a.y1 > f.y1) <> (a.y2 > f.y1) AND (f.x1 - a.x1) * abs(a.y2 - a.y1) < (a.x2 - a.x1) * (f.y1 - a.y1) * sign(a.y2 - a.y1) THEN 1 ELSE 0 END) % 2 AS odd FROM k JOIN fx_footprints f ON f.item_id = k.item_id AND f.edge = 0 JOIN a ON a.aoi_id = k.aoi_id GROUP BY k.item_id, k.aoi_id, a.part, a.ring),
 ai AS (SELECT k.item_id, k.aoi_id, a.part, sum(CASE WHEN (f.y1 > a.y1) <> (f.y2 > a.y1) AND (a.x1 - f.x1) * abs(f.y2 - f.y1) < (f.x2 - f.x1) * (a.y1 - f.y1) * sign(f.y2 - f.y1) THEN 1 ELSE 0 END) % 2 AS odd FROM k JOIN a ON a.aoi_id = k.aoi_id AND a.ring = 0 AND a.edge = 0 JOIN fx_footprints f ON f.item_id = k.item_id GROUP BY k.item_id, k.aoi_id, a.part)
 SELECT item_id, aoi_id FROM o WHERE sign(s1) * sign(s2) <= 0 AND sign(s3) * sign(s4) <= 0 UNION SELECT item_id, aoi_id FROM ai WHERE odd = 1
 UNION SELECT item_id, aoi_id FROM (SELECT item_id, aoi_id, part, max(CASE WHEN ring = 0 THEN odd ELSE 0 END) AS outer_odd, max(CASE WHEN ring > 0 THEN odd ELSE 0 END) AS hole_odd FROM fi GROUP BY item_id, aoi_id, part) q WHERE outer_odd = 1 AND hole_odd = 0"""


@query(_with(_POLYGONS), "fx_footprints", "fx_edges")
def scene_intersects_polygons(spark, d):
    """Scenes whose tilted footprints share a point with an area."""
    f = read(spark, d, "fx_footprints").select(F.col("item_id").alias("aoi_id"), F.lit(0).alias("part"), F.lit(0).alias("ring"), "edge", *[(F.col(c) / 1000).alias(c) for c in aoi.EDGE])
    return aoi.polygons_in_areas(f, _edges(spark, d))


def _windows(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "fx_windows").withColumnsRenamed({"first_day": "start", "last_day": "end"})


@query(f" SELECT w.aoi_id, w.window_id, s.item_id FROM ({SQL['scene_intersects_exact']}) m JOIN fx_scenes s ON s.item_id = m.item_id JOIN fx_windows w ON w.aoi_id = m.aoi_id AND CAST(s.acquired AS DATE) BETWEEN first_day AND last_day WHERE s.cloud_cover < 80", "fx_scenes", "fx_windows")
def scenes_in_windows(spark, d):
    """All areas' searches, with all their windows, in one job."""
    return intervals.scenes_in_windows(read(spark, d, "fx_scenes"), _windows(spark, d), _edges(spark, d))


def _region_texts(spark: SparkSession, d: str) -> DataFrame:
    ring = F.array(*[F.array(x, y) for x, y in (("west", "south"), ("east", "south"), ("east", "north"), ("west", "north"), ("west", "south"))])
    return spread(read(spark, d, "fx_regions").select("aoi_id", F.to_json(F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates"))).alias("geojson")), "aoi_id")


# A rectangle of positive degrees meets, in a row of tiles, those from its west
# at the row's northmost latitude to its east at the southmost one.
_TILES = """z AS (SELECT r.*, CAST(v AS INT) AS v, greatest(south, 80e0 - v * 10) AS lo, least(north, 90e0 - v * 10) AS hi FROM fx_regions r CROSS JOIN (SELECT unnest(generate_series(0, 17)) AS v) q),
 t AS (SELECT aoi_id, v, CAST(unnest(generate_series(CAST(floor(18 + west * cos(hi * pi() / 180e0) / 10) AS BIGINT), CAST(floor(18 + east * cos(lo * pi() / 180e0) / 10) AS BIGINT))) AS INT) AS h FROM z WHERE lo <= hi)"""


@query(_with(_TILES) + " SELECT aoi_id, h, v FROM t", "fx_regions")
def area_tiles(spark, d):
    """From GeoJSON to the tiles that cover it."""
    return aoi.covering_tiles(aoi.aoi_edges(_region_texts(spark, d)))


_CENTRE = ("((west + east) / 2e0)", "((south + north) / 2e0)")


@query(" SELECT item_id, CAST((CASE WHEN south + north < 0 THEN 32701 ELSE 32601 END) + least(59, floor(((west + east) / 2e0 + 180e0) / 6e0)) AS INT) AS epsg FROM fx_scenes", "fx_scenes")
def utm_zone(spark, d):
    return aoi.utm_of_areas(read(spark, d, "fx_scenes")).select("item_id", F.col("epsg").cast("int").alias("epsg"))


@query(_with("c AS (SELECT *, 5000e0 / 111320e0 AS up, 5000e0 / (111320e0 * cos((south + north) / 2e0 * pi() / 180e0)) AS side FROM fx_scenes)") + " SELECT item_id, round(west - side, 9) AS west, round(south - up, 9) AS south, round(east + side, 9) AS east, round(north + up, 9) AS north FROM c", "fx_scenes")
def bbox_expand(spark, d):
    s = read(spark, d, "fx_scenes")
    return s.select("item_id", *[F.round(F.expr(e), 9).alias(c) for c, e in geo.expand_bbox(5000.0).items()])


def _utm_sql(source: str, out: str, lon: str = "lon", lat: str = "lat") -> str:
    """SQL steps from degrees to metres of zone 52 north, by tangents: the
    conformal latitude's from the latitude's, then the series of order three
    in their usual form, with its coefficients for WGS84 as numbers."""
    return f"""{out}_1 AS (SELECT *, tan({lat} * pi() / 180e0) AS t, ({lon} - 129e0) * pi() / 180e0 AS dl, 0.08181919084262149e0 AS ecc FROM {source}),
 {out}_2 AS (SELECT *, sinh(ecc * atanh(ecc * t / sqrt(1e0 + t * t))) AS sigma FROM {out}_1), {out}_3 AS (SELECT *, t * sqrt(1e0 + sigma * sigma) - sigma * sqrt(1e0 + t * t) AS tc FROM {out}_2),
 {out}_4 AS (SELECT *, atan2(tc, cos(dl)) AS xi, asinh(sin(dl) / sqrt(tc * tc + cos(dl) * cos(dl))) AS eta FROM {out}_3),
 {out} AS (SELECT *, 5e5 + 6364902.166165086e0 * (eta + 0.0008377318188192541e0 * cos(2e0 * xi) * sinh(2e0 * eta) + 7.608496958699166e-07 * cos(4e0 * xi) * sinh(4e0 * eta) + 1.2034877875966646e-09 * cos(6e0 * xi) * sinh(6e0 * eta)) AS ux,
  6364902.166165086e0 * (xi + 0.0008377318188192541e0 * sin(2e0 * xi) * cosh(2e0 * eta) + 7.608496958699166e-07 * sin(4e0 * xi) * cosh(4e0 * eta) + 1.2034877875966646e-09 * sin(6e0 * xi) * cosh(6e0 * eta)) AS uy FROM {out}_4)"""


_XY = geo.to_utm("west", "south", "32652")


@query(_with(_utm_sql("fx_scenes", "u", "west", "south")) + " SELECT item_id, round(ux, 3) AS x, round(uy, 3) AS y FROM u", "fx_scenes")
def project_utm(spark, d):
    return read(spark, d, "fx_scenes").select("item_id", *[F.round(F.expr(e), 3).alias(n) for n, e in zip("xy", _XY)])


@query(" SELECT item_id, round(west, 7) AS lon, round(south, 7) AS lat FROM fx_scenes", "fx_scenes")
def unproject_utm(spark, d):
    """Forward and back: the corner returns."""
    s = read(spark, d, "fx_scenes").withColumns(geo.pair(_XY, "x", "y"))
    return s.select("item_id", *[F.round(F.expr(e), 7).alias(n) for n, e in zip(("lon", "lat"), geo.from_utm("x", "y", "32652"))])


_SINU = geo.to_sinusoidal("west", "south")


@query(" SELECT item_id, round(6371007.181e0 * west * pi() / 180e0 * sin((90e0 - south) * pi() / 180e0), 3) AS x, round(6371007.181e0 * pi() * south / 180e0, 3) AS y FROM fx_scenes", "fx_scenes")
def project_sinusoidal(spark, d):
    return read(spark, d, "fx_scenes").select("item_id", *[F.round(F.expr(e), 3).alias(n) for n, e in zip("xy", _SINU)])


# --- grids ----------------------------------------------------------------

_CORNER_ROWS = "c AS (SELECT item_id, unnest([west, east, east, west]) AS lon, unnest([south, south, north, north]) AS lat FROM fx_scenes)"


@query(_with(f"{_CORNER_ROWS}, {_utm_sql('c', 'u')}, q AS (SELECT item_id, floor(round(min(ux), 6) / 30e0) AS a, floor(round(min(uy), 6) / 30e0) AS b, ceil(round(max(ux), 6) / 30e0) AS c, ceil(round(max(uy), 6) / 30e0) AS d FROM u GROUP BY item_id)") + " SELECT item_id, CAST(a * 30 AS DOUBLE) AS left_x, CAST(d * 30 AS DOUBLE) AS top_y, CAST(c - a AS INT) AS width, CAST(d - b AS INT) AS height FROM q", "fx_scenes")
def scene_grid(spark, d):
    return grids.scene_grid(read(spark, d, "fx_scenes"), 30.0, snap=True, epsg="32652").select("item_id", "left_x", "top_y", "width", "height")


@query(" SELECT grid_id AS aoi_id, 32652 AS epsg, CASE WHEN grid_id % 2 = 0 THEN left_x + 5e0 ELSE left_x END AS left_x, CASE WHEN grid_id % 2 = 0 THEN top_y - 5e0 ELSE top_y END AS top_y, CASE WHEN grid_id % 2 = 0 THEN 20e0 ELSE res END AS res, width, height, grid_id % 2 = 0 AS from_reference FROM fx_grids", "fx_grids")
def detection_grid(spark, d):
    g = read(spark, d, "fx_grids").withColumnRenamed("grid_id", "aoi_id")
    ref = g.select("aoi_id", F.when(F.col("aoi_id") % 2 == 0, 32652).otherwise(32653).alias("epsg"), (F.col("left_x") + 5).alias("left_x"), (F.col("top_y") - 5).alias("top_y"), F.lit(20.0).alias("res"), "width", "height")
    return grids.detection_grid(g.withColumn("epsg", F.lit(32652)), ref)


_XP = "greatest(0, ceil((left_x - x0) / res))"
_NP = "greatest(0, ceil((y1 - top_y) / res))"


@query(_with("q AS (SELECT *, left_x - grid_id % 57 AS x0, left_x + width * res + grid_id % 31 AS x1, top_y - height * res - grid_id % 43 AS y0, top_y + grid_id % 29 AS y1 FROM fx_grids)") + f" SELECT grid_id, left_x - {_XP} * res AS new_left, top_y + {_NP} * res AS new_top, CAST(width + {_XP} + greatest(0, ceil((x1 - left_x - width * res) / res)) AS INT) AS new_width, CAST(height + {_NP} + greatest(0, ceil((top_y - height * res - y0) / res)) AS INT) AS new_height FROM q", "fx_grids")
def grid_expand(spark, d):
    g = read(spark, d, "fx_grids").selectExpr("*", "left_x - grid_id % 57 AS x0", "left_x + width * res + grid_id % 31 AS x1", "top_y - height * res - grid_id % 43 AS y0", "top_y + grid_id % 29 AS y1")
    return grids.expand_grid(g).select("grid_id", "new_left", "new_top", "new_width", "new_height")


_CROP = "SELECT *, left_x - 35e0 + grid_id % 400 AS ax0, left_x + 205e0 + grid_id % 400 AS ax1, top_y - 310e0 - grid_id % 300 AS ay0, top_y + 35e0 - grid_id % 300 AS ay1 FROM {t}"


@query(_with(f"q AS ({_CROP.format(t='fx_grids')}), o AS (SELECT *, greatest(ax0, left_x) AS ox0, least(ax1, left_x + width * 10e0) AS ox1, greatest(ay0, top_y - height * 10e0) AS oy0, least(ay1, top_y) AS oy1 FROM q)") + " SELECT grid_id, CAST(floor((ox0 - left_x) / 10e0) AS BIGINT) AS col_off, CAST(floor((top_y - oy1) / 10e0) AS BIGINT) AS row_off, CAST(least(ceil((ox1 - ox0) / 10e0), width - floor((ox0 - left_x) / 10e0)) AS BIGINT) AS n_cols, CAST(least(ceil((oy1 - oy0) / 10e0), height - floor((top_y - oy1) / 10e0)) AS BIGINT) AS n_rows FROM o WHERE ox0 < ox1 AND oy0 < oy1", "fx_grids")
def crop_window(spark, d):
    g = read(spark, d, "fx_grids").selectExpr("*", "left_x - 35e0 + grid_id % 400 AS ax0", "left_x + 205e0 + grid_id % 400 AS ax1", "top_y - 310e0 - grid_id % 300 AS ay0", "top_y + 35e0 - grid_id % 300 AS ay1")
    c = tiles.crop_window(g, 10.0, strict=False)
    return c.select("grid_id", *[F.col(x).cast("long").alias(x) for x in ("col_off", "row_off", "n_cols", "n_rows")])


_SOURCE = {"left_x": 500000.0, "top_y": 3600000.0, "res": 20.0, "epsg": 32652}
_TARGET = {"left_x": 500003.0, "top_y": 3599991.0, "res": 15.0, "epsg": 32652}
_SX = "((500003e0 + (t.col_idx + 0.5e0) * 15e0) - 500000e0) / 20e0"
_SY = "(3600000e0 - (3599991e0 - (t.row_idx + 0.5e0) * 15e0)) / 20e0"


def _source_cells(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "fx_pixels").select(*pixels.CELL, "b03")


@query(_with("s AS (SELECT scene_no, row_idx, col_idx, b03 FROM fx_pixels)") + f" SELECT t.scene_no, t.row_idx, t.col_idx, s.b03 FROM s AS t LEFT JOIN s ON s.scene_no = t.scene_no AND s.row_idx = floor({_SY}) AND s.col_idx = floor({_SX})", "fx_pixels")
def regrid_nearest(spark, d):
    s = _source_cells(spark, d)
    return grids.regrid_nearest(s, s.select(*pixels.CELL), _SOURCE, _TARGET, "b03", ["scene_no"]).select(*pixels.CELL, "b03")


@query(_with(f"""s AS (SELECT scene_no, row_idx, col_idx, b03 FROM fx_pixels), f AS (SELECT scene_no, row_idx, col_idx, {_SY.replace('t.', '')} - 0.5e0 AS fr, {_SX.replace('t.', '')} - 0.5e0 AS fc FROM s),
 n AS (SELECT scene_no, row_idx, col_idx, floor(fr) + i AS sr, floor(fc) + j AS sc, (CASE WHEN i = 1 THEN fr - floor(fr) ELSE 1 - (fr - floor(fr)) END) * (CASE WHEN j = 1 THEN fc - floor(fc) ELSE 1 - (fc - floor(fc)) END) AS w FROM f CROSS JOIN (VALUES (0), (1)) AS a(i) CROSS JOIN (VALUES (0), (1)) AS b(j))""") + " SELECT n.scene_no, n.row_idx, n.col_idx, round(sum(w * s.b03) / nullif(sum(CASE WHEN s.b03 IS NOT NULL THEN w END), 0), 6) AS b03 FROM n LEFT JOIN s ON s.scene_no = n.scene_no AND s.row_idx = sr AND s.col_idx = sc GROUP BY n.scene_no, n.row_idx, n.col_idx", "fx_pixels")
def regrid_bilinear(spark, d):
    s = _source_cells(spark, d)
    return grids.regrid_bilinear(s, s.select(*pixels.CELL), _SOURCE, _TARGET, "b03", ["scene_no"]).select(*pixels.CELL, F.round("b03", 6).alias("b03"))


# --- detections -----------------------------------------------------------

_TYPED = "t AS (SELECT event_id, source, scan, track, acq_time, try_cast(nullif(longitude, '') AS DOUBLE) AS lon, try_cast(nullif(latitude, '') AS DOUBLE) AS lat, try_cast(acq_date AS DATE) AS day FROM fx_detections)"
_FAMILY = "CASE WHEN starts_with(source, 'MODIS') THEN 'modis' ELSE 'viirs' END"


def _typed(spark: SparkSession, d: str) -> DataFrame:
    return detections.typed(read(spark, d, "fx_detections"))


@query(" SELECT event_id, source, latitude, longitude, scan, track, acq_date, acq_time FROM fx_detections", "fx_detections")
def detections_scan(spark, d):
    """The table written as CSV files by source, and read back as text."""
    cols = ["event_id", "latitude", "longitude", "scan", "track", "acq_date", "acq_time"]
    path = shared_dir(spark, "detections-csv")
    raw = read(spark, d, "fx_detections").select("source", *[F.col(c).cast("string").alias(c) for c in cols])
    raw.write.partitionBy("source").option("header", True).option("emptyValue", "").csv(path)
    back = readers.read_detections(spark, path, cols)
    return back.select(F.col("event_id").cast("long").alias("event_id"), "source", *[F.coalesce(c, F.lit("")).alias(c) for c in cols[1:]])


@query(_with(_TYPED) + " SELECT event_id, lon, lat, day FROM t WHERE lon IS NOT NULL AND lat IS NOT NULL AND day IS NOT NULL", "fx_detections")
def detections_typed(spark, d):
    return detections.located(_typed(spark, d)).select("event_id", "lon", "lat", "day")


_MAP = "m(level, family, platform, source) AS (VALUES ('sp', 'modis', 'modis', 'MODIS_SP'), ('sp', 'viirs', 'snpp', 'VIIRS_SNPP_SP'), ('sp', 'viirs', 'noaa20', 'VIIRS_NOAA20_SP'))"


@query(_with(_MAP) + " SELECT d.source, m.family, m.platform, count(*) AS n FROM fx_detections d JOIN m ON d.source = m.source GROUP BY d.source, m.family, m.platform", "fx_detections")
def source_map(spark, d):
    t = detections.sources_of_level(read(spark, d, "fx_detections"), "sp")
    return t.groupBy("source", "family", "platform").agg(F.count("*").alias("n"))


_PERIODS = "p AS (SELECT source AS period_id, min(day) AS a, max(day) AS b FROM t GROUP BY source)"


@query(_with(f"{_TYPED}, {_PERIODS}, n AS (SELECT unnest(generate_series(0, 1000)) AS i)") + " SELECT period_id, CAST(i AS INT) AS window_no, CAST(a + CAST(i * 4 AS INT) AS DATE) AS w_start, CAST(least(a + CAST(i * 4 + 3 AS INT), b) AS DATE) AS w_end FROM p JOIN n ON a + CAST(i * 4 AS INT) <= b", "fx_detections")
def request_windows(spark, d):
    t = _typed(spark, d).where("day IS NOT NULL")
    periods = t.groupBy(F.col("source").alias("period_id")).agg(F.min("day").alias("start"), F.max("day").alias("end"))
    return detections.request_windows(periods, 4)


@query(" SELECT event_id, source, CASE WHEN starts_with(source, 'MODIS') THEN confidence END AS confidence, scan FROM fx_detections", "fx_detections")
def detections_union(spark, d):
    """Two products with different headers, all rows."""
    t = read(spark, d, "fx_detections")
    modis = t.where("source LIKE 'MODIS%'").select("event_id", "source", "confidence", "scan")
    viirs = t.where("source NOT LIKE 'MODIS%'").select("event_id", "source", "scan")
    return detections.union_all([modis, viirs])


@query(_with(_TYPED) + f" SELECT {_FAMILY} AS family, day, count(*) AS n_rows, count(CASE WHEN lon IS NOT NULL AND lat IS NOT NULL THEN 1 END) AS n_placed FROM t WHERE day BETWEEN DATE '2024-01-05' AND DATE '2024-01-25' GROUP BY 1, 2", "fx_detections")
def detections_by_day(spark, d):
    return detections.by_day(detections.in_period(_typed(spark, d), "2024-01-05", "2024-01-25"))


@query(_with(_TYPED) + f" SELECT {_FAMILY} AS family, count(DISTINCT day) AS n_days, count(*) AS n_rows FROM t WHERE day IS NOT NULL GROUP BY 1", "fx_detections")
def detection_summary(spark, d):
    return detections.summary(_typed(spark, d))


@query(_with(_TYPED) + f" SELECT event_id, {_FAMILY} AS family, day FROM t WHERE day IS NOT NULL AND lon IS NOT NULL AND lat IS NOT NULL", "fx_detections")
def detections_period(spark, d):
    t = detections.located(_typed(spark, d))
    return t.select("event_id", detections.family(F.col("source")).alias("family"), "day").orderBy("day", "event_id")


_HALF_KM = "CASE WHEN try_cast({c} AS DOUBLE) > 0.375e0 THEN try_cast({c} AS DOUBLE) ELSE 0.375e0 END / 2e0"
_DX = f"{_HALF_KM.format(c='scan')} / (111.32e0 * cos(lat * pi() / 180e0))"
_DY = f"{_HALF_KM.format(c='track')} / 111.32e0"
_FOOT = f"f AS (SELECT *, lon - {_DX} AS x0, lat - {_DY} AS y0, lon + {_DX} AS x1, lat + {_DY} AS y1 FROM t WHERE lon IS NOT NULL AND lat IS NOT NULL AND day IS NOT NULL)"


@query(_with(f"{_TYPED}, {_FOOT}") + " SELECT event_id, round(x0, 9) AS x0, round(y0, 9) AS y0, round(x1, 9) AS x1, round(y1, 9) AS y1 FROM f", "fx_detections")
def detection_footprint(spark, d):
    f = detections.footprints(_typed(spark, d), 375.0)
    return f.select("event_id", *[F.round(c, 9).alias(c) for c in ("x0", "y0", "x1", "y1")])


@query(_with(f"{_TYPED}, {_FOOT}") + " SELECT day, round(min(x0), 9) AS x0, round(min(y0), 9) AS y0, round(max(x1), 9) AS x1, round(max(y1), 9) AS y1 FROM f GROUP BY day", "fx_detections")
def detection_bounds(spark, d):
    b = detections.bounds(detections.footprints(_typed(spark, d), 375.0), ["day"])
    return b.select("day", *[F.round(c, 9).alias(c) for c in ("x0", "y0", "x1", "y1")])


_SIDE = "CASE WHEN try_cast({c} AS DOUBLE) > 1 THEN try_cast({c} AS DOUBLE) ELSE 1e0 END * 500e0"


@query(_with(f"""{_TYPED}, o AS (SELECT * FROM t WHERE lon IS NOT NULL AND lat IS NOT NULL AND day IS NOT NULL), {_utm_sql('o', 'p')}, u AS (SELECT day, ux AS px, uy AS py, {_SIDE.format(c='scan')} AS dx, {_SIDE.format(c='track')} AS dy FROM p),
 w AS (SELECT day, greatest(CAST(floor((px - dx - 668000e0) / 1000e0) AS BIGINT), 0) AS c0, least(CAST(ceil((px + dx - 668000e0) / 1000e0) AS BIGINT) - 1, 39) AS c1, greatest(CAST(floor((3652000e0 - (py + dy)) / 1000e0) AS BIGINT), 0) AS r0, least(CAST(ceil((3652000e0 - (py - dy)) / 1000e0) AS BIGINT) - 1, 44) AS r1 FROM u),
 g AS (SELECT a.i AS row_idx, b.j AS col_idx FROM (SELECT unnest(generate_series(0, 44)) AS i) a CROSS JOIN (SELECT unnest(generate_series(0, 39)) AS j) b)""") + " SELECT day, row_idx, col_idx, count(*) AS n FROM w JOIN g ON row_idx BETWEEN r0 AND r1 AND col_idx BETWEEN c0 AND c1 GROUP BY day, row_idx, col_idx", "fx_detections")
def detection_raster(spark, d):
    f = detections.footprints(_typed(spark, d), 1000.0, "32652")
    return detections.count_on_grid(f, 668000.0, 3652000.0, 1000.0, 40, 45, ["day"])


@query(" SELECT day, source, count(DISTINCT (latitude, longitude, acq_date, acq_time)) AS n FROM (SELECT *, try_cast(acq_date AS DATE) AS day FROM fx_detections) q WHERE day IS NOT NULL AND try_cast(nullif(latitude, '') AS DOUBLE) IS NOT NULL AND try_cast(nullif(longitude, '') AS DOUBLE) IS NOT NULL GROUP BY day, source", "fx_detections")
def detections_stream(spark, d):
    """The table as it would arrive in polls, in order of time. The last polls
    bring half of the last day again, which counts once, and rows of the first
    day at places that no row has, which are weeks late and dropped."""
    raw = read(spark, d, "fx_detections").drop("frp")
    day = F.to_date("ts")
    a, b = raw.agg(F.min(day), F.max(day)).first()
    span = max(1, -(-((b - a).days + 1) // 4)) if a else 1
    late = raw.where(day == F.lit(a)).withColumn("latitude", F.concat("latitude", F.lit("5")))
    polls = [raw.where(F.floor(F.date_diff(day, F.lit(a)) / span) == i) for i in range(4)] + [raw.where(day == F.lit(b)).where("event_id % 2 = 0"), late]
    path = shared_dir(spark, "detections-stream")
    for i, p in enumerate(polls):
        p.drop("ts").write.parquet(f"{path}/in/{i}")
        stream.poll(spark, f"{path}/in", p.drop("ts").schema, f"{path}/out", f"{path}/state")
    return stream.latest(spark.read.parquet(f"{path}/out"))


# --- granules and tiles ---------------------------------------------------

_GDATE = "CAST(strptime(regexp_extract(filename, '\\.A(\\d{7})\\.', 1), '%Y%j') AS DATE)"
_GRAN = f"g AS (SELECT granule_id, split_part(filename, '.', 1) AS product, {_GDATE} AS acq_date, regexp_extract(filename, '\\.(h\\d\\dv\\d\\d)\\.', 1) AS tile, CAST(substr(regexp_extract(filename, '\\.(h\\d\\dv\\d\\d)\\.', 1), 2, 2) AS INT) AS h, CAST(substr(regexp_extract(filename, '\\.(h\\d\\dv\\d\\d)\\.', 1), 5, 2) AS INT) AS v FROM fx_granules WHERE filename <> 'browse.jpg')"


def _granules(spark: SparkSession, d: str) -> DataFrame:
    return catalog.parse_granules(read(spark, d, "fx_granules"))


@query(_with(_GRAN) + " SELECT granule_id, product, acq_date, tile, h, v FROM g", "fx_granules")
def granule_parse(spark, d):
    return _granules(spark, d).select("granule_id", "product", "acq_date", "tile", "h", "v")


@query(" SELECT granule_id, CASE WHEN filename = 'browse.jpg' THEN 'thumb.png' ELSE filename END AS link FROM fx_granules", "fx_granules")
def granule_pick_link(spark, d):
    return read(spark, d, "fx_granules").select("granule_id", parsing.pick_link(F.array(F.lit("thumb.png"), "filename")).alias("link"))


_SEARCHED = '{"type":"Polygon","coordinates":[[[115.2,22.37],[140.6,22.37],[140.6,48.58],[115.2,48.58],[115.2,22.37]]]}'


@query(_with(_GRAN + ", fx_regions AS (SELECT 1 AS aoi_id, 115.2e0 AS west, 22.37e0 AS south, 140.6e0 AS east, 48.58e0 AS north), " + _TILES) + " SELECT granule_id FROM g JOIN t ON g.h = t.h AND g.v = t.v WHERE acq_date >= DATE '1996-03-01' AND acq_date < DATE '1996-09-01'", "fx_granules")
def granule_search(spark, d):
    """Granules of a period on the tiles that cover an area."""
    edges = aoi.aoi_edges(spark.createDataFrame([(1, _SEARCHED)], "aoi_id int, geojson string"))
    return catalog.granule_search(_granules(spark, d), aoi.covering_tiles(edges), "1996-03-01", "1996-08-31").select("granule_id")


@query(_with(f"{_GRAN}, {_TILES}") + " SELECT w.aoi_id, w.window_id, g.granule_id FROM g JOIN t ON g.h = t.h AND g.v = t.v JOIN fx_windows w ON w.aoi_id = t.aoi_id AND g.acq_date BETWEEN first_day AND last_day", "fx_granules", "fx_regions", "fx_windows")
def granules_in_windows(spark, d):
    """Granules on the tiles that cover each region, in each of its windows."""
    found = intervals.granules_in_windows(_granules(spark, d), _windows(spark, d), aoi.aoi_edges(_region_texts(spark, d)))
    return found.select("aoi_id", "window_id", "granule_id")


@query(_with(_GRAN) + " SELECT product, acq_date, string_agg(DISTINCT tile, ',' ORDER BY tile) AS tiles, count(*) AS n_granules FROM g GROUP BY product, acq_date", "fx_granules")
def granules_by_date(spark, d):
    return catalog.granules_by_date(_granules(spark, d)).withColumn("tiles", F.array_join("tiles", ","))


@query(_with(f"{_GRAN}, m AS (SELECT product, acq_date, count(*) AS n FROM g GROUP BY product, acq_date), w AS (SELECT product AS window_id, product, CAST(unnest(generate_series(CAST(min(acq_date) AS TIMESTAMP), CAST(max(acq_date) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS acq_date FROM g GROUP BY product)") + " SELECT window_id, w.product, w.acq_date, coalesce(n, 0) AS n_granules, CASE WHEN n IS NULL THEN 'skip' ELSE 'process' END AS action FROM w LEFT JOIN m ON w.product = m.product AND w.acq_date = m.acq_date", "fx_granules")
def calendar_coverage(spark, d):
    """A product's days from its first to its last; another product's granules
    don't make a day one to process."""
    g = _granules(spark, d)
    windows = g.groupBy(F.col("product").alias("window_id"), "product").agg(F.min("acq_date").alias("start"), F.max("acq_date").alias("end"))
    return catalog.calendar_coverage(windows, g)


@query(_with(_GRAN) + " SELECT granule_id, round((h - 18) * 1111950.5196666667e0, 6) AS x_min, round((9 - v) * 1111950.5196666667e0, 6) AS y_max, 463.312717e0 AS pixel_m, '500m' AS label FROM g", "fx_granules")
def tile_affine(spark, d):
    t = tiles.tile_affine(_granules(spark, d), 2400)
    return t.select("granule_id", *[F.round(c, 6).alias(c) for c in ("x_min", "y_max", "pixel_m")], "label")


_TCELL = "platform, h, v, row_idx, col_idx"


@query(f" SELECT {_TCELL}, coalesce(min_by(sr_dn, granule_ord) FILTER (sr_dn <> -28672), -28672) AS sr_dn, count(*) AS n_granules FROM fx_tile_pixels GROUP BY {_TCELL}", "fx_tile_pixels")
def mosaic_first(spark, d):
    return composite.mosaic_first(read(spark, d, "fx_tile_pixels"), "sr_dn", "granule_ord", -28672, _TCELL.split(", "))


@query(f" SELECT {_TCELL}, granule_ord, CASE WHEN sr_dn <> -28672 THEN CAST(CAST(CAST(sr_dn AS FLOAT) AS DOUBLE) * 0.0001e0 + 0e0 AS FLOAT) END AS value FROM fx_tile_pixels", "fx_tile_pixels")
def sr_scale(spark, d):
    t = read(spark, d, "fx_tile_pixels")
    return t.select(*_TCELL.split(", "), "granule_ord", radiometry.scale_offset(F.col("sr_dn"), F.lit(0.0001), F.lit(None).cast("double"), F.lit(-28672)).alias("value"))


LAYERS = (
    ("sur_refl_b01", "sr", "500m", 16, 0.0001, 0.0, -28672.0, -100.0, 16000.0, "sur_refl_b01_1"), ("sur_refl_b02", "sr", "500m", 16, 0.0001, None, -28672.0, -100.0, 16000.0, "sur_refl_b02_1"),
    ("QC_500m", "qa", "500m", 32, None, None, 787410671.0, None, None, "QC_500m_1"), ("state_1km", "qa", "1km", 16, None, None, 65535.0, 0.0, 57335.0, "state_1km_1"),
)
_LAYERS = "layers(field, kind, resolution, bits, scale, \"offset\", fill, valid_min, valid_max, sds_path) AS (VALUES ('sur_refl_b01', 'sr', '500m', 16, 0.0001e0, 0e0, -28672e0, -100e0, 16000e0, 'sur_refl_b01_1'), ('sur_refl_b02', 'sr', '500m', 16, 0.0001e0, NULL, -28672e0, -100e0, 16000e0, 'sur_refl_b02_1'), ('QC_500m', 'qa', '500m', 32, NULL, NULL, 787410671e0, NULL, NULL, 'QC_500m_1'), ('state_1km', 'qa', '1km', 16, NULL, NULL, 65535e0, 0e0, 57335e0, 'state_1km_1'))"
_LONG = "c AS (SELECT platform, h, v, granule_ord, row_idx, col_idx, CASE (row_idx + col_idx) % 5 WHEN 0 THEN 'sur_refl_b01' WHEN 1 THEN 'sur_refl_b02' WHEN 2 THEN 'QC_500m' WHEN 3 THEN 'state_1km' ELSE 'other' END AS field, CASE WHEN (row_idx + col_idx) % 5 IN (0, 1) THEN sr_dn ELSE qa_raw END AS dn FROM fx_tile_pixels)"


def _layers(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LAYERS, "field string, kind string, resolution string, bits int, scale double, offset double, fill double, valid_min double, valid_max double, sds_path string")


def _long(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "fx_tile_pixels").selectExpr("platform", "h", "v", "granule_ord", "row_idx", "col_idx", "CASE (row_idx + col_idx) % 5 WHEN 0 THEN 'sur_refl_b01' WHEN 1 THEN 'sur_refl_b02' WHEN 2 THEN 'QC_500m' WHEN 3 THEN 'state_1km' ELSE 'other' END AS field", "CASE WHEN (row_idx + col_idx) % 5 IN (0, 1) THEN sr_dn ELSE qa_raw END AS dn")


@query(_with(f"{_LAYERS}, {_LONG}") + " SELECT platform, h, v, granule_ord, row_idx, col_idx, c.field, dn, resolution, fill, dn >= coalesce(valid_min, dn) AND dn <= coalesce(valid_max, dn) AS is_valid FROM c JOIN layers ON c.field = layers.field", "fx_tile_pixels")
def layer_scan(spark, d):
    c = readers.layer_scan(_long(spark, d), _layers(spark), complete=True)
    valid = readers.in_valid_range(F.col("dn"), F.col("valid_min"), F.col("valid_max"))
    return c.select("platform", "h", "v", "granule_ord", "row_idx", "col_idx", "field", "dn", "resolution", "fill", valid.alias("is_valid"))


@query(_with(f"{_LAYERS}, {_LONG}") + " SELECT platform, h, v, granule_ord, row_idx, col_idx, c.field, CASE WHEN kind = 'qa' THEN CAST(dn AS BIGINT) END AS qa FROM c JOIN layers ON c.field = layers.field WHERE kind = 'qa'", "fx_tile_pixels")
def qa_passthrough(spark, d):
    return tiles.scale_layers(_long(spark, d), _layers(spark)).where("kind = 'qa'").select("platform", "h", "v", "granule_ord", "row_idx", "col_idx", "field", "qa")


# Layers of products, eight each, out of the parts table.
_PRODUCT_LAYERS = """SELECT p_partkey // 8 AS product, concat('band_', CAST(p_partkey AS STRING)) AS field, CASE WHEN p_partkey % 3 = 0 THEN 'qa' ELSE 'sr' END AS kind, CASE WHEN p_size < 25 THEN '500m' ELSE '1km' END AS resolution,
 CAST(CASE WHEN p_size % 3 = 0 THEN 8 WHEN p_size % 3 = 1 THEN 16 ELSE 32 END AS INT) AS bits, CASE WHEN p_partkey % 3 <> 0 THEN CAST(p_retailprice AS DOUBLE) END AS scale, CASE WHEN p_partkey % 5 = 0 THEN 0.5e0 END AS "offset",
 CASE WHEN p_partkey % 4 = 0 THEN NULL WHEN p_size < 10 THEN 255e0 ELSE 65535e0 END AS fill, p_name AS sds_path FROM part"""


def _product_layers(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "part").selectExpr(
        "p_partkey DIV 8 AS product", "concat('band_', p_partkey) AS field", "CASE WHEN p_partkey % 3 = 0 THEN 'qa' ELSE 'sr' END AS kind", "CASE WHEN p_size < 25 THEN '500m' ELSE '1km' END AS resolution",
        "CASE p_size % 3 WHEN 0 THEN 8 WHEN 1 THEN 16 ELSE 32 END AS bits", "CASE WHEN p_partkey % 3 <> 0 THEN CAST(p_retailprice AS DOUBLE) END AS scale", "CASE WHEN p_partkey % 5 = 0 THEN 0.5e0 END AS offset",
        "CASE WHEN p_partkey % 4 = 0 THEN NULL WHEN p_size < 10 THEN 255e0 ELSE 65535e0 END AS fill", "p_name AS sds_path",
    )


@query(f"WITH k AS ({_PRODUCT_LAYERS}) SELECT product, kind, resolution, count(*) AS n_layers, string_agg(field, ',' ORDER BY field) AS fields, CASE WHEN count(*) = 1 THEN min(field) WHEN kind = 'qa' THEN concat('QA_', resolution) ELSE resolution END AS suffix, CASE WHEN count(DISTINCT fill) = 1 AND count(fill) = count(*) THEN min(fill) END AS fill, CASE WHEN kind = 'qa' THEN CASE WHEN max(bits) <= 8 THEN 'smallint' WHEN max(bits) <= 16 THEN 'int' ELSE 'bigint' END ELSE 'float' END AS dtype FROM k GROUP BY product, kind, resolution")
def layer_groups(spark, d):
    return tiles.layer_groups(_product_layers(spark, d), ["product"])


@query(f"WITH k AS ({_PRODUCT_LAYERS}) SELECT product, kind, resolution, CAST(row_number() OVER (PARTITION BY product, kind, resolution ORDER BY field) AS INT) AS band_index, field, scale, \"offset\", fill, sds_path FROM k")
def layer_tags(spark, d):
    return tiles.layer_tags(_product_layers(spark, d), ["product"])


@query(f"WITH k AS ({_PRODUCT_LAYERS}) SELECT product, kind, resolution, count(*) AS n_bands, min(field) AS first_field, count(*) FILTER (fill IS NULL) AS n_null_fill FROM k GROUP BY product, kind, resolution")
def layer_sidecars(spark, d):
    """The JSON texts, read again."""
    bands = "struct<bands:array<struct<band_index:int,field:string,scale:double,offset:double,fill:double,sds_path:string>>>"
    t = tiles.layer_sidecars(_product_layers(spark, d), ["product"]).withColumn("b", F.from_json("sidecar", bands)["bands"])
    return t.select("product", "kind", "resolution", F.size("b").cast("long").alias("n_bands"), F.col("b")[0]["field"].alias("first_field"), F.size(F.filter("b", lambda x: x["fill"].isNull())).cast("long").alias("n_null_fill"))


@query(f"WITH k AS ({_PRODUCT_LAYERS}) SELECT k.field FROM k WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE concat('band_', CAST(l_partkey AS STRING)) = k.field AND l_linenumber = 1 AND l_quantity > 30)")
def missing_layers(spark, d):
    """Layers that no cell has: parts that no order asks for first and much."""
    found = read(spark, d, "lineitem").where("l_linenumber = 1 AND l_quantity > 30").select(F.concat(F.lit("band_"), "l_partkey").alias("field"))
    return tiles.missing_layers(_product_layers(spark, d), found).select("field")


_ODD = "SELECT scene_no, row_idx, col_idx FROM fx_pixels WHERE {c}"


@query(_with("a AS (" + _ODD.format(c="b01 > 0") + "), b AS (" + _ODD.format(c="b08 > 0") + ")") + " SELECT *, 'image' AS only_in FROM (SELECT * FROM a EXCEPT SELECT * FROM b) q UNION ALL SELECT *, 'mask' AS only_in FROM (SELECT * FROM b EXCEPT SELECT * FROM a) q", "fx_pixels")
def unmatched_cells(spark, d):
    """Cells with data in the first band against cells with data in another."""
    p = read(spark, d, "fx_pixels")
    return tiles.unmatched_cells(p.where("b01 > 0"), p.where("b08 > 0"), pixels.CELL)


@query(" SELECT grid_id % 50 AS grp, count(DISTINCT (width, height)) AS n_shapes, count(*) AS n_members FROM fx_grids GROUP BY grid_id % 50 HAVING count(DISTINCT (width, height)) > 1", "fx_grids")
def shape_violations(spark, d):
    return tiles.shape_violations(read(spark, d, "fx_grids").withColumn("grp", F.col("grid_id") % 50), ["grp"])


_AREA = [(11119505.2, 4000000.0), (11119505.2, 4447000.0), (11900000.0, 4447000.0), (11500000.0, 4000000.0)]
_AREA_SQL = ", ".join(f"({geo.num(a[0])}, {geo.num(a[1])}, {geo.num(b[0])}, {geo.num(b[1])})" for a, b in zip(_AREA, [*_AREA[1:], _AREA[0]]))
_CX, _CY = ("(" + geo.tile_origin("h", "v")[i] + f" {sign} ({c} + 0.5e0) * {geo.num(geo.TILE_SIZE / 1200)})" for i, (sign, c) in enumerate((("+", "col_idx"), ("-", "row_idx"))))
_CENTRES = "p AS (SELECT *, (h - 18 + (col_idx + 0.5e0) / 1200) * 1111950.5196666667e0 AS x, (9 - v - (row_idx + 0.5e0) / 1200) * 1111950.5196666667e0 AS y FROM fx_tile_pixels)"


@query(_with(f"""{_CENTRES}, e(x1, y1, x2, y2) AS (VALUES {_AREA_SQL}),
 i AS (SELECT platform, h, v, granule_ord, row_idx, col_idx, any_value(sr_dn) AS sr_dn, any_value(qa_raw) AS qa_raw, sum(CASE WHEN (y1 > y) <> (y2 > y) AND (x - x1) / (x2 - x1) < (y - y1) / (y2 - y1) THEN CASE WHEN x2 > x1 THEN 1 ELSE 0 END WHEN (y1 > y) <> (y2 > y) AND x2 = x1 AND x < x1 THEN 1 WHEN (y1 > y) <> (y2 > y) AND x2 < x1 THEN 1 ELSE 0 END) % 2 = 1 AS inside FROM p CROSS JOIN e GROUP BY platform, h, v, granule_ord, row_idx, col_idx)""") + " SELECT platform, h, v, granule_ord, row_idx, col_idx, CASE WHEN inside THEN sr_dn END AS sr_dn, CASE WHEN inside THEN qa_raw ELSE 65535 END AS qa_raw FROM i", "fx_tile_pixels")
def aoi_pixel_mask(spark, d):
    cells = read(spark, d, "fx_tile_pixels").withColumns({"cx_m": F.expr(_CX), "cy_m": F.expr(_CY)})
    rows = [(0, 0, 0, i, *a, *b) for i, (a, b) in enumerate(zip(_AREA, [*_AREA[1:], _AREA[0]]))]
    edges = spark.createDataFrame(rows, "aoi_id int, part int, ring int, edge int, x1 double, y1 double, x2 double, y2 double")
    key = ["platform", "h", "v", "granule_ord", "row_idx", "col_idx"]
    return tiles.mask_outside(tiles.in_areas(cells, edges, key), ["sr_dn"], {"qa_raw": 65535}).select(*key, "sr_dn", "qa_raw")


@query(_with("w AS (SELECT *, row_idx - 100 AS r, col_idx - CASE h WHEN 28 THEN 300 ELSE 0 END AS c FROM fx_tile_pixels)") + " SELECT platform, h, v, granule_ord, CAST(r AS INT) AS row_idx, CAST(c AS INT) AS col_idx, sr_dn FROM w WHERE r BETWEEN 0 AND 799 AND c BETWEEN 0 AND CASE h WHEN 28 THEN 899 ELSE 599 END", "fx_tile_pixels")
def crop_cells(spark, d):
    """Each tile's cells in the window of one area on it, which lies across
    both: from a quarter of the left tile to half of the right one."""
    size, res = 1200, geo.TILE_SIZE / 1200
    t = read(spark, d, "fx_tile_pixels")
    x, y = geo.tile_origin("h", "v")
    left, top = geo.SINU_X_MIN + 28 * geo.TILE_SIZE, geo.SINU_Y_MAX - 5 * geo.TILE_SIZE
    # A tenth of a cell inside, so that rounding does not move the window.
    box = {"ax0": left + 300.1 * res, "ax1": left + (1800 - 0.1) * res, "ay0": top - (900 - 0.1) * res, "ay1": top - 100.1 * res}
    grid = t.select("h", "v").distinct().select("h", "v", F.expr(x).alias("left_x"), F.expr(y).alias("top_y"), F.lit(size).alias("width"), F.lit(size).alias("height"), *[F.lit(b).alias(n) for n, b in box.items()])
    return tiles.crop_cells(t, tiles.crop_window(grid, res), ["h", "v"]).select("platform", "h", "v", "granule_ord", "row_idx", "col_idx", "sr_dn")


_DEGREES = '{"type":"Feature","geometry":{"type":"Polygon","coordinates":[[[121.03,30.41],[131.52,31.07],[128.55,38.21],[123.31,39.13],[121.03,30.41]],[[125.2,33.1],[127.9,33.4],[126.4,36.2],[125.2,33.1]]]}}'
_DEGREE_EDGES = "e(ring, x1, y1, x2, y2) AS (VALUES (0, 121.03e0, 30.41e0, 131.52e0, 31.07e0), (0, 131.52e0, 31.07e0, 128.55e0, 38.21e0), (0, 128.55e0, 38.21e0, 123.31e0, 39.13e0), (0, 123.31e0, 39.13e0, 121.03e0, 30.41e0), (1, 125.2e0, 33.1e0, 127.9e0, 33.4e0), (1, 127.9e0, 33.4e0, 126.4e0, 36.2e0), (1, 126.4e0, 36.2e0, 125.2e0, 33.1e0))"
# Cells' centres are taken back to degrees, where the area's edges are straight.
_IN_DEGREES = """c AS (SELECT *, (9 - v - (row_idx + 0.5e0) / 1200) * 10e0 AS lat FROM fx_tile_pixels), l AS (SELECT *, (h - 18 + (col_idx + 0.5e0) / 1200) * 10e0 / cos(lat * pi() / 180e0) AS lon FROM c),
 i AS (SELECT platform, h, v, granule_ord, row_idx, col_idx, any_value(sr_dn) AS sr_dn, any_value(qa_raw) AS qa_raw, sum(CASE WHEN ring = 0 AND (y1 > lat) <> (y2 > lat) AND lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1 THEN 1 ELSE 0 END) % 2 = 1 AND sum(CASE WHEN ring = 1 AND (y1 > lat) <> (y2 > lat) AND lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1 THEN 1 ELSE 0 END) % 2 = 0 AS inside
  FROM l CROSS JOIN e GROUP BY platform, h, v, granule_ord, row_idx, col_idx)"""
_MASKED = " SELECT platform, h, v, granule_ord, row_idx, col_idx, CASE WHEN inside THEN sr_dn END AS sr_dn, CASE WHEN inside THEN qa_raw ELSE 65535 END AS qa_raw FROM i"
_PIXEL = ["platform", "h", "v", "granule_ord", "row_idx", "col_idx"]


@query(_with(f"{_DEGREE_EDGES}, {_IN_DEGREES}") + _MASKED, "fx_tile_pixels")
def aoi_pixel_mask_degrees(spark, d):
    """From GeoJSON in degrees, projected to the tiles' grid, to a mask."""
    edges = aoi.project_edges(aoi.aoi_edges(spark.createDataFrame([(1, _DEGREES)], "aoi_id int, geojson string")), "sinusoidal")
    cells = read(spark, d, "fx_tile_pixels").withColumns({"cx_m": F.expr(_CX), "cy_m": F.expr(_CY)})
    return tiles.mask_outside(tiles.in_areas(cells, edges, _PIXEL), ["sr_dn"], {"qa_raw": 65535}).select(*_PIXEL, "sr_dn", "qa_raw")


@query(_with(f"{_DEGREE_EDGES}, {_IN_DEGREES}") + _MASKED, "fx_tile_pixels")
def aoi_row_spans(spark, d):
    """The same mask by runs of columns, worked out once a row of each tile."""
    edges = aoi.project_edges(aoi.aoi_edges(spark.createDataFrame([(1, _DEGREES)], "aoi_id int, geojson string")), "sinusoidal")
    cells = read(spark, d, "fx_tile_pixels").withColumn("aoi_id", F.lit(1))
    x, y = geo.tile_origin("h", "v")
    of_tiles = cells.select("aoi_id", "h", "v").distinct().select("aoi_id", "h", "v", F.expr(x).alias("left_x"), F.expr(y).alias("top_y"), F.lit(geo.TILE_SIZE / 1200).alias("res"), F.lit(1200).alias("width"), F.lit(1200).alias("height"))
    masked = spans.in_spans(cells, spans.row_spans(edges, of_tiles, ["h", "v"]), ["aoi_id", "h", "v"])
    return tiles.mask_outside(masked, ["sr_dn"], {"qa_raw": 65535}).select(*_PIXEL, "sr_dn", "qa_raw")


_AREA_LAYERS = (("refl", "sr", "500m", 24, 16, 0.0001, None, -28672.0, "refl_1"), ("qc", "qa", "500m", 24, 32, None, None, 4294967295.0, "qc_1"), ("state", "qa", "1km", 12, 16, None, None, 65535.0, "state_1"))
_AREA_SQL_STEPS = f"""{_GRAN}, {_TILES}, days AS (SELECT DISTINCT t.aoi_id, g.product, g.acq_date, g.granule_id, g.h, g.v FROM g JOIN t ON g.h = t.h AND g.v = t.v JOIN fx_windows w ON w.aoi_id = t.aoi_id AND g.acq_date BETWEEN first_day AND last_day),
 ext AS (SELECT aoi_id, product, acq_date, min(h) AS h0, max(h) AS h1, min(v) AS v0, max(v) AS v1 FROM days GROUP BY aoi_id, product, acq_date),
 box AS (SELECT x.*, p, 18 + west * cos(north * pi() / 180e0) / 10e0 AS ax0, 18 + east * cos(south * pi() / 180e0) / 10e0 AS ax1, 9 - north / 10e0 AS ay0, 9 - south / 10e0 AS ay1, west, south, east, north FROM ext x JOIN fx_regions r USING (aoi_id) CROSS JOIN (VALUES (12), (24)) AS s(p)),
 win AS (SELECT *, CAST(floor((greatest(ax0, h0) - h0) * p) AS BIGINT) AS c0, CAST(floor((greatest(ay0, v0) - v0) * p) AS BIGINT) AS r0, CAST(ceil((least(ax1, h1 + 1) - greatest(ax0, h0)) * p) AS BIGINT) AS nc, CAST(ceil((least(ay1, v1 + 1) - greatest(ay0, v0)) * p) AS BIGINT) AS nr FROM box WHERE greatest(ax0, h0) < least(ax1, h1 + 1) AND greatest(ay0, v0) < least(ay1, v1 + 1)),
 k AS (SELECT *, CASE field WHEN 'state' THEN 12 ELSE 24 END AS p, CASE field WHEN 'refl' THEN -28672 WHEN 'qc' THEN 4294967295 ELSE 65535 END AS fill FROM fx_granule_cells),
 j AS (SELECT d.aoi_id, d.product, d.acq_date, k.granule_id, k.field, k.dn, k.fill, (d.v - w.v0) * w.p + k.row_idx AS gr, (d.h - w.h0) * w.p + k.col_idx AS gc, w.* EXCLUDE (aoi_id, product, acq_date) FROM k JOIN days d ON d.granule_id = k.granule_id JOIN win w ON w.aoi_id = d.aoi_id AND w.product = d.product AND w.acq_date = d.acq_date AND w.p = k.p),
 m AS (SELECT aoi_id, product, acq_date, field, gr, gc, coalesce(min_by(dn, granule_id) FILTER (dn <> fill), any_value(fill)) AS dn, any_value(fill) AS fill, any_value(c0) AS c0, any_value(r0) AS r0, any_value(h0) AS h0, any_value(v0) AS v0, any_value(p) AS p, any_value(west) AS west, any_value(south) AS south, any_value(east) AS east, any_value(north) AS north
   FROM j WHERE gr BETWEEN r0 AND r0 + least(nr, (v1 - v0 + 1) * p - r0) - 1 AND gc BETWEEN c0 AND c0 + least(nc, (h1 - h0 + 1) * p - c0) - 1 GROUP BY aoi_id, product, acq_date, field, gr, gc),
 n AS (SELECT *, (9 - v0 - (gr + 0.5e0) / p) * 10e0 AS lat FROM m), q AS (SELECT *, (h0 - 18 + (gc + 0.5e0) / p) * 10e0 / cos(lat * pi() / 180e0) AS lon FROM n), i AS (SELECT *, lat BETWEEN south AND north AND lon BETWEEN west AND east AS inside FROM q)"""


@query(_with(_AREA_SQL_STEPS) + """ SELECT aoi_id, product, acq_date, CASE field WHEN 'refl' THEN 'sr' ELSE 'qa' END AS kind, CASE field WHEN 'state' THEN '1km' ELSE '500m' END AS resolution, field, gr - r0 AS row_idx, gc - c0 AS col_idx,
 CASE WHEN field = 'refl' AND inside AND dn <> fill THEN CAST(CAST(CAST(dn AS FLOAT) AS DOUBLE) * 0.0001e0 AS FLOAT) END AS value, CASE WHEN field <> 'refl' THEN CASE WHEN inside THEN dn ELSE fill END END AS qa FROM i""", "fx_granules", "fx_regions", "fx_windows", "fx_granule_cells")
def area_layers(spark, d):
    """The whole tiled plan: from GeoJSON and windows to the cropped, masked and
    scaled layers of every region, product and day."""
    layers = spark.createDataFrame([(p, *x) for p in ("MOD09GA", "MYD09GA", "VNP09GA") for x in _AREA_LAYERS], "product string, field string, kind string, resolution string, pixels int, bits int, scale double, offset double, fill double, sds_path string")
    # A granule may have a cell twice: the one that stands first counts.
    cells = views.read_in_order(spark, d, "fx_granule_cells", "lineitem", "cell_ord")
    out = surface_reflectance.process_areas(read(spark, d, "fx_granules"), cells, layers, _windows(spark, d), _region_texts(spark, d), tolerance=1.0)
    return out.values


@query(_with(_TYPED) + f" SELECT {_FAMILY} AS family, strftime(day, '%Y%m%d') AS acq_day, CASE WHEN day = (SELECT min(day) FROM t WHERE lon IS NOT NULL AND lat IS NOT NULL) THEN 3 ELSE 2 END AS version, count(*) AS n, CAST(max(count(*)) OVER (PARTITION BY day) AS BIGINT) > 0 AS is_done FROM t WHERE day IS NOT NULL AND lon IS NOT NULL AND lat IS NOT NULL GROUP BY 1, 2, day", "fx_detections")
def outputs_rerun(spark, d):
    """Daily outputs over four runs into one folder. The first writes the
    earlier half of the days; the second is cut off after data, before the
    record; the third resumes and works what is not done; the last works the
    first day again. Versions say which run a day's rows come from."""
    t = detections.located(_typed(spark, d)).withColumns({"family": detections.family(F.col("source")), "acq_day": F.date_format("day", "yyyyMMdd")}).select("event_id", "family", "acq_day")
    path, by, key = shared_dir(spark, "outputs"), ["family", "acq_day"], ["acq_day"]
    days = t.select("acq_day").distinct()
    first, middle = days.agg(F.min("acq_day"), F.percentile_approx(F.col("acq_day").cast("int"), 0.5).cast("string")).first()

    def rows(work: DataFrame, version: int) -> DataFrame:
        return t.join(work.select("acq_day"), "acq_day", "left_semi").withColumn("version", F.lit(version))

    if first is not None:
        early = days.where(F.col("acq_day") <= middle)
        outputs.write_outputs(rows(early, 2), path, by, early, key)
        outputs.write_partitions(rows(days.where(F.col("acq_day") > middle), 1), path, by)  # never noted as done
        rest = cut(outputs.still_to_do(days, path, key), "still-to-do")
        outputs.write_outputs(rows(rest, 2), path, by, rest, key)
        again = days.where(F.col("acq_day") == first)
        outputs.write_outputs(rows(again, 3), path, by, again, key)
    done = outputs.outputs_done(spark, path, key).select("acq_day", (F.col("n_rows") > 0).alias("is_done"))
    back = spark.read.schema("event_id long, version int, family string, acq_day string").parquet(path) if first is not None else t.limit(0).withColumn("version", F.lit(0))
    return back.groupBy("family", "acq_day", "version").agg(F.count("*").alias("n")).join(done, "acq_day").select("family", "acq_day", "version", "n", "is_done")


# Each scene's source and target grid, in metres of one zone.
_SIDE_CHIP = 16


def _regrid_keyed(spark: SparkSession, d: str, method: str) -> DataFrame:
    # The view groups the table, so it is worked out once for both uses.
    p = cut(read(spark, d, "fx_pixels").select(*pixels.CELL, "b03"), "regrid-pixels")
    size, no = _SIDE_CHIP, F.col("scene_no")
    held = chips.pack_chips(p, ["b03"], ["scene_no"], size)
    of_scenes = p.groupBy("scene_no").agg(F.max("row_idx").alias("last_row"))
    sources = of_scenes.select("scene_no", F.lit(500000.0).alias("left_x"), F.lit(3600000.0).alias("top_y"), (20.0 + no).alias("res"), F.lit(32652).alias("epsg"))
    targets = of_scenes.select("scene_no", (500000.0 + no * 3.0).alias("left_x"), (3600000.0 - 9.0 - no).alias("top_y"), (15.0 + no).alias("res"), F.lit(32652).alias("epsg"), F.lit(7).alias("width"), (F.col("last_row") + 1).alias("height"))
    out = grids.regrid_chips(held, sources, targets, "b03", ["scene_no"], size, method)
    return chips.unpack_chips(out, ["b03"], ["scene_no"], size)


_T_KEYED = "t AS (SELECT k.*, (dx + (col_idx + 0.5e0) * tres) / sres AS sc, (dy + (row_idx + 0.5e0) * tres) / sres AS sr FROM (SELECT scene_no, r AS row_idx, c AS col_idx, 20e0 + scene_no AS sres, 15e0 + scene_no AS tres, scene_no * 3e0 AS dx, 9e0 + scene_no AS dy FROM (SELECT scene_no, unnest(generate_series(0, max(row_idx))) AS r FROM fx_pixels GROUP BY scene_no) a CROSS JOIN (SELECT unnest(generate_series(0, 6)) AS c) b) k)"


@query(_with(_T_KEYED) + " SELECT t.scene_no, CAST(t.row_idx AS INT) AS row_idx, CAST(t.col_idx AS INT) AS col_idx, s.b03 FROM t JOIN fx_pixels s ON s.scene_no = t.scene_no AND s.row_idx = floor(sr) AND s.col_idx = floor(sc)", "fx_pixels")
def regrid_chips_nearest(spark, d):
    """Scenes that each have grids of their own, regridded chip by chip."""
    return _regrid_keyed(spark, d, "nearest")


@query(_with(_T_KEYED + """, f AS (SELECT scene_no, row_idx, col_idx, sr - 0.5e0 AS fr, sc - 0.5e0 AS fc FROM t),
 n AS (SELECT scene_no, row_idx, col_idx, floor(fr) + i AS sr, floor(fc) + j AS sc, (CASE WHEN i = 1 THEN fr - floor(fr) ELSE 1 - (fr - floor(fr)) END) * (CASE WHEN j = 1 THEN fc - floor(fc) ELSE 1 - (fc - floor(fc)) END) AS w FROM f CROSS JOIN (VALUES (0), (1)) AS a(i) CROSS JOIN (VALUES (0), (1)) AS b(j)),
 v AS (SELECT n.scene_no, n.row_idx, n.col_idx, round(sum(w * s.b03) / nullif(sum(CASE WHEN s.b03 IS NOT NULL THEN w END), 0), 6) AS b03 FROM n JOIN fx_pixels s ON s.scene_no = n.scene_no AND s.row_idx = sr AND s.col_idx = sc GROUP BY n.scene_no, n.row_idx, n.col_idx)""") + " SELECT scene_no, CAST(row_idx AS INT) AS row_idx, CAST(col_idx AS INT) AS col_idx, b03 FROM v WHERE b03 IS NOT NULL", "fx_pixels")
def regrid_chips_bilinear(spark, d):
    return _regrid_keyed(spark, d, "bilinear").withColumn("b03", F.round("b03", 6))


@query(_with("p AS (SELECT DISTINCT source, latitude, longitude, acq_date, acq_time, concat_ws('|', source, latitude, longitude, acq_date, acq_time) AS event_id, try_cast(nullif(longitude, '') AS DOUBLE) AS lon, try_cast(nullif(latitude, '') AS DOUBLE) AS lat, try_cast(acq_date AS DATE) AS day FROM fx_detections WHERE try_cast(acq_date AS DATE) IS NOT NULL), " + _BOXES + ", " + _INSIDE) + " SELECT day, source, aoi_id, count(*) AS n FROM (SELECT DISTINCT event_id, aoi_id FROM y WHERE o = 1 AND h = 0) z JOIN p USING (event_id) GROUP BY day, source, aoi_id", "fx_detections", "fx_edges")
def detections_stream_areas(spark, d):
    """The table in four polls, in order of time, each clipped to the areas.
    The last day comes twice and counts once."""
    raw = read(spark, d, "fx_detections").drop("frp")
    day = F.to_date("ts")
    a, b = raw.agg(F.min(day), F.max(day)).first()
    span = max(1, -(-((b - a).days + 1) // 4)) if a else 1
    polls = [raw.where(F.floor(F.date_diff(day, F.lit(a)) / span) == i) for i in range(4)] + [raw.where(day == F.lit(b))]
    path = shared_dir(spark, "detections-areas")
    edges = _edges(spark, d)
    areas = stream.AreaCells(lambda: edges)
    for i, p in enumerate(polls):
        p.drop("ts").write.parquet(f"{path}/in/{i}")
        stream.poll_areas(spark, f"{path}/in", p.drop("ts").schema, areas, f"{path}/out", f"{path}/state")
    return stream.area_counts(spark.read.parquet(f"{path}/out"))


@query(" SELECT scene_no, row_idx, col_idx, b03 FROM fx_pixels WHERE row_idx BETWEEN 100 + scene_no * 10 AND 219 + scene_no * 10 AND col_idx BETWEEN 1 AND 4", "fx_pixels")
def chips_in_windows(spark, d):
    """Chips stored along a curve; of each scene the chips of its window are
    read, and cells beside the window cut off."""
    path, size = shared_dir(spark, "chips"), 32
    p = read(spark, d, "fx_pixels")
    sinks.write_chips(chips.pack_chips(p, ["b03"], ["scene_no"], size), path, ["scene_no"], file_chips=64)
    no = F.col("scene_no")
    windows = p.select("scene_no").distinct().select("scene_no", (100 + no * 10).alias("row_off"), F.lit(1).alias("col_off"), F.lit(120).alias("n_rows"), F.lit(4).alias("n_cols"))
    found = readers.read_windows(spark, path, windows, ["scene_no"], size)
    return chips.unpack_chips(tiles.crop_chips(found, windows, ["b03"], ["scene_no"], size), ["b03"], ["scene_no"], size)


@query(""" SELECT 'all scenes' AS run, count(*) AS n_items, count(*) FILTER (scene_no % 97 <> 0 AND scene_no % 5 <> 0) AS n_processed, count(*) FILTER (scene_no % 97 <> 0 AND scene_no % 5 = 0) AS n_skipped, count(*) FILTER (scene_no % 97 = 0) AS n_failed,
 CASE WHEN count(*) FILTER (scene_no % 97 = 0) = 0 THEN 'success' WHEN count(*) FILTER (scene_no % 97 = 0) = count(*) THEN 'failed' ELSE 'partial' END AS status FROM fx_scenes""", "fx_scenes")
def run_report_observed(spark, d):
    """The report of a run, counted while its items were written."""
    status = F.when(F.col("scene_no") % 97 == 0, "failed").when(F.col("scene_no") % 5 == 0, "skipped").otherwise("processed")
    items, seen = report.observed(read(spark, d, "fx_scenes").select("item_id", status.alias("status")), "scenes")
    items.write.parquet(shared_dir(spark, "run-items"))
    return report.observed_report(spark, {"all scenes": seen})


_RUN_BANDS = ["b03", "b04", "b11"]
_BY_PRESET = "CAST(CASE WHEN prefix = 'S2C' THEN least(greatest(CAST({v} AS FLOAT) * CAST(0.0001 AS FLOAT), CAST(0 AS FLOAT)), CAST(1 AS FLOAT)) ELSE least(greatest(CAST({v} AS FLOAT) * CAST(0.0000275 AS FLOAT) + CAST(-0.2 AS FLOAT), CAST(0 AS FLOAT)), CAST(1 AS FLOAT)) END AS FLOAT)"
_RUN_SQL = (
    f"p AS (SELECT DISTINCT aoi_id, item_id FROM ({SQL['scenes_in_windows']}) q), n AS (SELECT item_id, {_PREFIX} AS prefix, strftime(acquired, '%Y%m%d') AS date_token, {_OFFSET} AS dn_offset FROM fx_scenes), "
    + "v AS (SELECT p.aoi_id, prefix, date_token, row_idx, col_idx, cloud_class, " + ", ".join(f"CASE WHEN {b} = 0 THEN 0e0 ELSE greatest({b} - dn_offset, 0e0) END AS {b}" for b in _RUN_BANDS) + " FROM fx_scene_cells JOIN n USING (item_id) JOIN p USING (item_id)), "
    + "r AS (SELECT aoi_id, prefix, date_token, row_idx, col_idx, cloud_class, " + ", ".join(f"{_BY_PRESET.format(v=b)} AS {b}" for b in _RUN_BANDS) + f" FROM v), {_S}, "
    + "m AS (SELECT *, cloud_class IN (1, 2, 3) OR snow = 1 OR b03 = 0 OR (greatest(b03, b04, b11) = 0 AND least(b03, b04, b11) = 0) AS masked FROM s), "
    + "c AS (SELECT aoi_id, prefix, date_token, row_idx, col_idx, " + ", ".join(f"min(CASE WHEN NOT masked THEN {b} END) AS m_{b}, min(CASE WHEN snow <> 1 THEN {b} END) AS s_{b}" for b in _RUN_BANDS) + ", CAST(coalesce(min(cloud_class), 0) AS FLOAT) AS class, CAST(coalesce(max(nullif(snow, 255)), 255) AS FLOAT) AS snow FROM m GROUP BY aoi_id, prefix, date_token, row_idx, col_idx)"
)
_RUN_LAYERS = [*[("masked", b, f"m_{b}") for b in _RUN_BANDS], ("cloudmask", "class", "class"), *[("snowmasked", b, f"s_{b}") for b in _RUN_BANDS], ("snowmask", "snow", "snow")]


@query(_with(_RUN_SQL) + " SELECT aoi_id, prefix AS satellite, layer, band, count(DISTINCT date_token) AS n_days, count(*) AS n_cells, min(value) AS least, max(value) AS most FROM (" + " UNION ALL ".join(f"SELECT aoi_id, prefix, date_token, row_idx, col_idx, '{layer}' AS layer, '{band}' AS band, {c} AS value FROM c" for layer, band, c in _RUN_LAYERS) + ") q WHERE value IS NOT NULL GROUP BY aoi_id, prefix, layer, band", "fx_scenes", "fx_windows", "fx_scene_cells")
def imagery_runs(spark, d):
    """The whole imagery plan in two runs: the first works the windows of the
    earlier half of time, the second all of them, of which it leaves out the
    days that are done. What came of it, a row an area and layer."""
    path, windows, size = shared_dir(spark, "imagery"), cut(_windows(spark, d), "windows"), 16
    args = read(spark, d, "fx_scenes"), read(spark, d, "fx_scene_cells"), _RUN_BANDS
    edges = cut(_edges(spark, d), "edges")
    middle = windows.agg(F.percentile(F.unix_date("start"), 0.5).cast("int").alias("m")).first()["m"]
    early = windows.where(F.unix_date("start") <= F.lit(middle))
    for asked in (early, windows):
        imagery.process_windows(*args, asked, edges, path, size=size)
    # Cells are counted once a shape and day, where they lie; areas share the counts.
    held = outputs.all_runs(spark, path, f"shape long, {imagery.OUTPUTS}").select(*imagery.OUTPUT_KEY, "layer", "band", "run", F.explode("values").alias("value"))
    of_days = held.where(F.col("value").isNotNull()).groupBy(*imagery.OUTPUT_KEY, "layer", "band", "run").agg(F.count("*").alias("n"), F.min("value").alias("least"), F.max("value").alias("most"))
    of_days = outputs.of_last_runs(of_days, path, imagery.OUTPUT_KEY).groupBy(*imagery.OUTPUT_KEY).agg(F.collect_list(F.struct("layer", "band", "n", "least", "most")).alias("of_layers"))
    of_areas = of_days.join(imagery.area_days(spark, path), imagery.OUTPUT_KEY).select("aoi_id", "satellite", "date_token", F.inline("of_layers"))
    return of_areas.groupBy("aoi_id", "satellite", "layer", "band").agg(F.count("*").alias("n_days"), F.sum("n").alias("n_cells"), F.min("least").alias("least"), F.max("most").alias("most"))
