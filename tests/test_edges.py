"""Hand-computed cases, and properties that hold between forms."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from skygrid.functions import geo, parsing, radiometry
from skygrid.operators import aoi, catalog, chips, composite, detections, grids, pixels, report, tiles
from skygrid.plans import detections as fires
from skygrid.plans import imagery, surface_reflectance
from skygrid.queries import QUERIES
from skygrid.sources import readers, sinks


def values(df, column):
    return [r[column] for r in df.collect()]


def test_baseline_and_offset(spark):
    s = spark.createDataFrame([("05.09",), ("04.00",), ("03.01",), ("",), ("x",), (None,)], "processing_baseline string").withColumn("collection", F.lit("sentinel-2-l2a"))
    assert values(catalog.with_offset(s, "processing_baseline"), "dn_offset") == [1000, 1000, 0, 0, 0, 0]


def test_baseline_falls_back(spark):
    s = spark.createDataFrame([("x", "05.00"), ("", None)], "a string, b string").withColumn("collection", F.lit("sentinel-2-l2a"))
    assert values(catalog.with_offset(s, "a", "b"), "baseline") == [5.0, None]


def test_dn_and_reflectance(spark):
    d = spark.createDataFrame([(1500,), (800,), (0,)], "dn int").select(radiometry.dn_correct(F.col("dn"), F.lit(1000.0)).alias("v"))
    assert values(d, "v") == [500, 0, 0]
    r = spark.createDataFrame([(12000, 0)], "s int, l int").select(radiometry.reflectance(F.col("s")).alias("s"), radiometry.reflectance(F.col("l"), "landsat8").alias("l")).first()
    assert r["s"] == 1.0 and r["l"] == 0.0


def test_snow(spark):
    p = spark.createDataFrame([(0, 0, 0), (8000, 5000, 1000), (8000, 1000, 1000)], "g int, r int, s int")
    assert values(pixels.snow_mask(pixels.to_reflectance(p, ["g", "r", "s"]), "g", "r", "s"), "snow") == [255, 1, 0]


def test_masks(spark):
    p = spark.createDataFrame([(1, 0.0, 5.0, 0), (2, 1.0, 5.0, 3), (3, 1.0, 5.0, 0), (4, 1.0, 5.0, None), (5, None, 5.0, 0)], "i int, a double, b double, cloud_class int")
    m = {r["i"]: (r["masked"], r["b"]) for r in pixels.apply_mask(p, ["a", "b"]).collect()}
    assert m == {1: (True, None), 2: (True, None), 3: (False, 5.0), 4: (False, 5.0), 5: (False, 5.0)}


def test_layers_of_composite(spark):
    p = spark.createDataFrame([("a", 3, 255, 2.0), ("a", 0, 1, None), ("a", 1, 255, 1.0), ("b", None, 255, None), ("b", None, 255, None)], "k string, cloud_class int, snow int, v double")
    r = {x["k"]: (x["v"], x["cloud"], x["snow"], x["n_scenes"]) for x in composite.composite_layers(p, ["v"], ["k"]).collect()}
    assert r == {"a": (1.0, 0, 1, 3), "b": (None, 0, 255, 2)}


def test_composite_ignores_order_and_chips_agree(spark):
    rows = [(s, r, c, (s * 7 + r * 3 + c * 5) % 11 if (s + r + c) % 4 else None) for s in range(3) for r in range(4) for c in range(4)]
    p = spark.createDataFrame(rows, "scene int, row_idx int, col_idx int, v int").withColumns({"prefix": F.lit("S2C"), "date_token": F.lit("d")})
    key = ["row_idx", "col_idx"]
    cells = {(r["row_idx"], r["col_idx"]): r["v"] for r in composite.composite_min(p, ["v"], key).collect()}
    again = {(r["row_idx"], r["col_idx"]): r["v"] for r in composite.composite_min(p.orderBy(F.desc("scene")), ["v"], key).collect()}
    packed = composite.composite_chips(chips.pack_chips(p, ["v"], ["scene", "prefix"], 4), "v", ["prefix", "chip_row", "chip_col"])
    by_chip = {(r["row_idx"], r["col_idx"]): r["v"] for r in chips.unpack_chips(packed, ["v"], ["prefix"], 4).collect()}
    assert cells == again and by_chip == {k: v for k, v in cells.items() if v is not None}


def test_composite_chips_aggregates_before_the_shuffle(spark):
    rows = [("hot", [5, i, None]) for i in range(500, 0, -1)] + [("a", [None, 2, 3]), ("a", None), ("b", None), ("c", []), (None, [1, 2, 3])]
    c = composite.composite_chips(spark.createDataFrame(rows, "k string, v array<int>").repartition(5), "v", ["k"])
    assert {r["k"]: r["v"] for r in c.collect()} == {"hot": [5, 1, None], "a": [None, 2, 3], "b": None, "c": [], None: [1, 2, 3]}
    plan = c._jdf.queryExecution().executedPlan().toString()
    assert "partial_min(" in plan


def test_names(spark):
    s = spark.createDataFrame([("a-b_c", "Landsat-9"), ("---", "landsat-8"), (None, None)], "item_id string, platform string").withColumns({"collection": F.lit("landsat-c2-l2"), "acquired": F.lit("2024-01-02").cast("timestamp")})
    n = catalog.with_names(s)
    assert values(n, "tag") == ["abc", "SCENE", "SCENE"] and values(n, "prefix") == ["L9C", "L8C", "L8C"]
    assert values(n, "stem")[0] == "L9C_20240102_abc"


def test_granules(spark):
    g = spark.createDataFrame([("MOD09GA.A2023064.h28v05.061.x.hdf",), ("browse.jpg",), (None,), ("MOD09GA.A2023999.h28v05.061.x.hdf",)], "filename string")
    r = catalog.parse_granules(g).collect()
    assert [(x["acq_date"], x["tile"], x["h"], x["v"]) for x in r] == [(dt.date(2023, 3, 5), "h28v05", 28, 5)]
    links = spark.createDataFrame([(["a.png", "b.HDF", "c.h5"],), (["a.png"],), ([],)], "l array<string>")
    assert values(links.select(parsing.pick_link(F.col("l")).alias("x")), "x") == ["b.HDF", "a.png", None]


def test_detection_typing(spark):
    d = spark.createDataFrame([("2024-1-5", "", "131.5"), ("bad", "130.9", None), ("", "x", "1"), (None, None, None)], "acq_date string, longitude string, lon string").withColumn("latitude", F.lit("32.7"))
    t = detections.typed(d)
    assert values(t, "day") == [dt.date(2024, 1, 5), None, None, None] and values(t, "lon") == [131.5, 130.9, None, None]


def test_footprint(spark):
    d = spark.createDataFrame([("2024-01-05", "131", "32.775", "0.4", "0.5"), ("2024-01-05", "131", "32.775", "", "x")], "acq_date string, longitude string, latitude string, scan string, track string")
    f = detections.footprints(detections.typed(d), 10.0).collect()
    assert (f[0]["x1"] - f[0]["x0"]) / 2 == pytest.approx(0.002137, abs=1e-6) and (f[0]["y1"] - f[0]["y0"]) / 2 == pytest.approx(0.002246, abs=1e-6)
    assert (f[1]["y1"] - f[1]["y0"]) == pytest.approx(10 / 111320)


def test_count_on_grid_cuts_to_the_grid(spark):
    f = spark.createDataFrame([(-1e9, -1e9, 1e9, 1e9), (0.0, 9.0, 1.0, 10.0), (50.0, 50.0, 60.0, 60.0)], "x0 double, y0 double, x1 double, y1 double")
    n = {(r["row_idx"], r["col_idx"]): r["n"] for r in detections.count_on_grid(f, 0.0, 10.0, 1.0, 3, 2).collect()}
    assert n == {(r, c): 2 if (r, c) == (0, 0) else 1 for r in range(2) for c in range(3)}


def test_metadata(spark):
    s = spark.createDataFrame([("i", "sentinel-2-l2a", "05.09", 10.0, None, 30.0, 1.0), ("j", "landsat-c2-l2", None, None, None, None, 1.0), ("k", "landsat-c2-l2", None, None, None, None, None)], "item_id string, collection string, processing_baseline string, sun_azimuth double, sun_zenith double, sun_elevation double, west double")
    s = s.withColumns({"south": F.lit(1.0), "east": F.lit(2.0), "north": F.lit(2.0), "acquired": F.lit("2024-01-02 03:04:05").cast("timestamp")})
    m = catalog.scene_metadata(s)
    assert {r["image_id"]: r["solar_zenith"] for r in m.collect()} == {"i": 60.0, "j": None}
    doc = json.loads(sinks.feature_collection(catalog.feature_json(m)))
    assert doc["type"] == "FeatureCollection"
    props = {f["id"]: f["properties"] for f in doc["features"]}
    assert props["i"] == {"Acquisition_Date": "2024-01-02 03:04:05", "Image_ID": "i", "Solar_Azimuth_Angle": 10.0, "Solar_Zenith_Angle": 60.0, "Processing_Baseline": "05.09", "DN_Add_Offset": 1000.0}
    assert props["j"] == {"Acquisition_Date": "2024-01-02 03:04:05", "Image_ID": "j", "Solar_Azimuth_Angle": None, "Solar_Zenith_Angle": None}


def test_catalog_items(spark, tmp_path):
    items = [
        {"item_id": "a", "collection": "sentinel-2-l2a", "geometry": '{"type":"Polygon","coordinates":[[[1,2],[4,2],[4,6,9],[1,6]]]}', "props": {"datetime": "2024-01-05T10:00:00Z", "s2:processing_baseline": "05.00", "view:sun_azimuth": "x", "sun_azimuth": "7", "eo:cloud_cover": "3.5"}, "assets": {"z": {"href": "h", "epsg": None}, "b": {"href": "h", "epsg": 2}, "a": {"href": "h", "epsg": 1}}},
        {"item_id": "b", "collection": "landsat-c2-l2", "geometry": None, "props": {"datetime": "", "start_datetime": "2024-01-01T00:00:00Z", "processing_baseline": "q", "solar_elevation": "20"}, "assets": {}},
    ]
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "x.json").write_text("\n".join(map(json.dumps, items)))
    s = readers.read_scenes(spark, str(tmp_path / "c"))
    r = {x["item_id"]: x for x in catalog.in_time_order(s).collect()}
    assert list(r) == ["b", "a"] and [r["a"][c] for c in ("west", "south", "east", "north", "sun_azimuth", "cloud_cover", "processing_baseline")] == [1.0, 2.0, 4.0, 6.0, 7.0, 3.5, "05.00"]
    assert r["b"]["west"] is None and r["b"]["processing_baseline"] == "q" and r["b"]["sun_elevation"] == 20.0
    assert [x["item_id"] for x in catalog.scene_search(s, "2024-01-01", "2024-01-31", (3, 3, 9, 9)).collect()] == ["a"]
    assert values(catalog.scene_metadata(s), "image_id") == ["a"]
    assert {x["item_id"]: x["epsg"] for x in catalog.item_crs(s).collect()} == {"a": 2, "b": None}
    (tmp_path / "c" / "x.json").write_text(json.dumps({"item_id": "n", "props": {}}))
    with pytest.raises(Exception, match="no datetime"):
        readers.read_scenes(spark, str(tmp_path / "c")).collect()
    assert values(readers.read_scenes(spark, str(tmp_path / "c"), strict=False), "acquired") == [None]


def test_band_assets(spark):
    s = spark.createDataFrame([("i", "c", [1, 2])], "item_id string, collection string, bands array<int>")
    b = spark.createDataFrame([("c", 1, "B01"), ("c", 2, "B02")], "collection string, band_no int, asset string")
    a = spark.createDataFrame([("i", "B01", "x")], "item_id string, asset string, href string")
    assert {r["band_no"]: r["href"] for r in catalog.band_assets(s, b, a, strict=False).collect()} == {1: "x", 2: None}
    with pytest.raises(Exception, match="no asset B02 in scene i"):
        catalog.band_assets(s, b, a).collect()


def test_utm_zones(spark):
    pts = spark.createDataFrame([(131.0, 32.775), (180.0, 10.0), (-180.0, -1.0), (179.9, 0.0), (-75.0, -33.0), (491.0, 32.0)], "lon double, lat double")
    assert values(pts.select(F.expr(geo.utm_epsg("lon", "lat")).alias("e")), "e") == [32652, 32601, 32701, 32660, 32718, 32652]


def test_projections(spark):
    p = spark.createDataFrame([(131.0, 32.775)], "lon double, lat double")
    r = p.withColumns(geo.pair(geo.to_sinusoidal("lon", "lat"), "x", "y")).first()
    assert (r["x"], r["y"]) == (pytest.approx(12247598.833, abs=1e-3), pytest.approx(3644417.829, abs=1e-3))
    t = p.withColumns(geo.pair(geo.to_utm("lon", "lat", "32617"), "a", "b"))
    k = spark.createDataFrame([(-(79 + 23 / 60 + 13.7 / 3600), 43 + 38 / 60 + 33.24 / 3600)], "lon double, lat double")
    k = geo.with_utm(k, "lon", "lat", "32617", "x", "y").first()
    assert abs(k["x"] - 630084) < 1 and abs(k["y"] - 4833438.5) < 1 and t.count() == 1
    pts = spark.range(500).selectExpr("126e0 + id % 60 / 10e0 AS lon", "-80e0 + id * 0.32e0 AS lat").withColumn("epsg", F.expr("CASE WHEN lat >= 0 THEN 32652 ELSE 32752 END"))
    back = geo.with_utm(pts, "lon", "lat", "epsg", "x", "y").withColumns(geo.pair(geo.from_utm("x", "y", "epsg"), "lon2", "lat2"))
    off = back.agg(F.max(F.abs(F.col("lon") - F.col("lon2")) * F.cos(F.radians("lat"))).alias("a"), F.max(F.abs(F.col("lat") - F.col("lat2"))).alias("b")).first()
    assert max(off["a"], off["b"]) * 111320 < 1e-3


def test_bbox(spark):
    b = spark.createDataFrame([(130.90, 32.70, 131.10, 32.85)], "west double, south double, east double, north double")
    r = b.select(*[F.expr(e).alias(c) for c, e in geo.expand_bbox(5000.0).items()]).first()
    assert [round(r[c], 6) for c in ("west", "south", "east", "north")] == [130.846580, 32.655084, 131.153420, 32.894916]
    assert geo.expand_bbox(0)["west"] == "west"


def test_tiles(spark):
    t = spark.createDataFrame([("h28v05", 28, 5)], "tile string, h int, v int")
    r = tiles.tile_affine(t, 2400).first()
    assert (round(r["x_min"], 3), round(r["y_max"], 3), round(r["pixel_m"], 6), r["label"]) == (11119505.197, 4447802.079, 463.312717, "500m")
    bad = spark.createDataFrame([("nope", None, None)], "tile string, h int, v int")
    with pytest.raises(Exception, match="bad tile id"):
        tiles.tile_affine(bad, 2400).collect()
    m = spark.createDataFrame([(463.3,), (926.6,), (5000.0,)], "m double").select(geo.resolution_label(F.col("m")).alias("l"))
    assert values(m, "l") == ["500m", "1km", "5000m"]


def test_mosaic_first(spark):
    c = spark.createDataFrame([(1, 1, -9), (1, 2, 7), (1, 3, 9), (2, 1, -9)], "cell int, o int, v int")
    assert {r["cell"]: r["v"] for r in composite.mosaic_first(c, "v", "o", -9, ["cell"]).collect()} == {1: 7, 2: -9}


def test_request_windows(spark):
    p = spark.createDataFrame([(1, dt.date(2024, 1, 1), dt.date(2024, 1, 12))], "period_id int, start date, end date")
    w = [(r["w_start"].day, r["w_end"].day) for r in detections.request_windows(p, 5).orderBy("window_no").collect()]
    assert w == [(1, 5), (6, 10), (11, 12)]
    assert detections.request_windows(p, 0).count() == 12 and detections.request_windows(p, 9).count() == 3


def test_point_in_polygon(spark):
    text = '{"type":"Feature","geometry":{"type":"Polygon","coordinates":[[[0,0,5],[0,10],[10,10],[10,0],[0,0]],[[2,2],[6,2],[6,6]]]}}'
    e = aoi.aoi_edges(spark.createDataFrame([(1, text), (2, '{"type":"Polygon","coordinates":[[[0,0],[1,1]]]}')], "aoi_id int, geojson string"))
    pts = spark.createDataFrame([(1, 0.0, 5.0), (2, 4.0, 2.0), (3, 5.0, 3.0), (4, 1.0, 9.0), (5, 11.0, 5.0), (6, None, 5.0), (7, 0.0, 0.0)], "id int, lon double, lat double")
    assert sorted((r["id"], r["aoi_id"]) for r in aoi.points_in_areas(pts, e, ["id"]).collect()) == [(1, 1), (4, 1), (7, 1)]
    with pytest.raises(Exception, match="no Polygon"):
        aoi.aoi_edges(spark.createDataFrame([(1, '{"type":"Point","coordinates":[1,2]}')], "aoi_id int, geojson string")).collect()


def test_points_in_areas_of_all_sizes(spark):
    """Against a plain walk over the edges; areas from tiny to huge, parts
    with holes, points on corners, edges and cell bounds."""
    r = random.Random(1)
    texts, shapes = [], []
    for i in range(30):
        x, y, w = r.choice((-3.0, 0.0, 1.5)), r.choice((-2.0, 0.0, 0.25)), 2.0 ** r.randint(-12, 6)
        star = [[x + w * r.choice((0, 0.25, 0.5, 1)), y + w * r.choice((0, 0.125, 0.5, 1))] for _ in range(r.randint(3, 9))]
        parts = [[star, [[x + w / 4, y + w / 4], [x + w / 2, y + w / 4], [x + w / 2, y + w / 2]]], [[[x - w, y - w], [x - w / 2, y - w], [x - w, y - w / 2]]]]
        texts.append((i, json.dumps({"type": "MultiPolygon", "coordinates": parts})))
        shapes.append((i, parts, x, y, w))
    pts = []
    for i, parts, x, y, w in shapes:
        pts += [tuple(p) for part in parts for ring in part for p in ring]
        pts += [(x + w * r.choice((r.random(), r.randint(-8, 8) / 8)), y + w * r.choice((r.random(), r.randint(-8, 8) / 8))) for _ in range(20)]
    pts = list(enumerate(pts))

    def ring_holds(ring, px, py):
        odd = False
        for (x1, y1), (x2, y2) in zip(ring, [*ring[1:], ring[0]]):
            if (x1, y1) == (x2, y2):
                continue
            if abs((px - x1) * (y2 - y1) - (py - y1) * (x2 - x1)) <= 1e-12 and min(x1, x2) - 1e-12 <= px <= max(x1, x2) + 1e-12 and min(y1, y2) - 1e-12 <= py <= max(y1, y2) + 1e-12:
                return True
            if (y1 > py) != (y2 > py) and px < (x2 - x1) * ((py - y1) / (y2 - y1)) + x1:
                odd = not odd
        return odd

    want = sorted((k, i) for k, (px, py) in pts for i, parts, *_ in shapes if any(ring_holds(p[0], px, py) and not any(ring_holds(h, px, py) for h in p[1:]) for p in parts))
    edges = aoi.aoi_edges(spark.createDataFrame(texts, "aoi_id int, geojson string")).cache()
    p = spark.createDataFrame([(k, *xy) for k, xy in pts], "id int, lon double, lat double")
    assert sorted(map(tuple, aoi.points_in_areas(p, edges, ["id"]).collect())) == want
    written = aoi.holds_written_out(edges, F.col("lon"), F.col("lat"), 10_000)
    assert sorted(values(p.where(written), "id")) == sorted({k for k, _ in want})
    assert aoi.holds_written_out(edges, F.col("lon"), F.col("lat"), 5) is None
    assert aoi.points_in_areas(p, edges.limit(0), ["id"]).count() == 0


def test_areas_in_files(spark, tmp_path):
    (tmp_path / "a.geojson").write_text('{"type":"Polygon",\n"coordinates":[[[0,0],[1,0],[1,1]]]}')
    a = readers.read_areas(spark, str(tmp_path))
    assert values(a, "aoi_id") == ["a.geojson"] and aoi.aoi_edges(a).count() == 3


def test_boxes_in_areas(spark):
    square = '{"type":"Polygon","coordinates":[[[0,0],[0,10],[10,10],[10,0]],[[4,4],[6,4],[6,6],[4,6]]]}'
    e = aoi.aoi_edges(spark.createDataFrame([(1, square)], "aoi_id int, geojson string"))
    boxes = {"in": (1, 1, 2, 2), "hole": (4.5, 4.5, 5.5, 5.5), "over_hole": (3, 3, 7, 7), "out": (11, 11, 12, 12), "around": (-1, -1, 11, 11), "touch": (10, 3, 12, 4), "hole_edge": (5, 5, 6.5, 5.5)}
    s = spark.createDataFrame([(k, *map(float, v)) for k, v in boxes.items()], "item_id string, west double, south double, east double, north double")
    assert sorted(values(aoi.boxes_in_areas(s, e), "item_id")) == sorted(set(boxes) - {"hole", "out"})
    assert sorted(values(aoi.boxes_in_areas(s, e, exact=False), "item_id")) == sorted(set(boxes) - {"out"})


def test_chips_with_gaps_and_repeats(spark):
    rows = [(1, 300, 5, 7, None), (1, 300, 5, 3, 9), (1, 0, 0, 1, 1), (1, 255, 255, 2, None), (2, -1, -1, 4, 4)]
    c = spark.createDataFrame(rows, "scene int, row_idx int, col_idx int, a int, b int")
    packed = chips.pack_chips(c, ["a", "b"], ["scene"])
    assert {r["n"] for r in packed.select(F.size("a").alias("n")).collect()} == {65536}
    got = sorted(map(tuple, chips.unpack_chips(packed, ["a", "b"], ["scene"]).collect()))
    assert got == [(1, 0, 0, 1, 1), (1, 255, 255, 2, None), (1, 300, 5, 3, 9), (2, -1, -1, 4, 4)]


def test_crop(spark):
    g = spark.createDataFrame([(1, 0.0, 100.0, 10, 10, 25.0, 55.0, 41.0, 1000.0), (2, 0.0, 100.0, 10, 10, 200.0, 300.0, 0.0, 50.0)], "g int, left_x double, top_y double, width int, height int, ax0 double, ax1 double, ay0 double, ay1 double")
    w = tiles.crop_window(g, 10.0, strict=False)
    assert [tuple(r)[-4:] for r in w.collect()] == [(2, 0, 3, 6)]
    with pytest.raises(Exception, match="does not overlap"):
        tiles.crop_window(g, 10.0).collect()
    cells = spark.range(100).selectExpr("1 AS g", "CAST(id DIV 10 AS INT) AS row_idx", "CAST(id % 10 AS INT) AS col_idx", "id AS w_g")
    got = sorted(map(tuple, tiles.crop_cells(cells, w, ["g"]).collect()))
    assert got == sorted((1, r, c, r * 10 + c + 2) for r in range(6) for c in range(3))
    assert pixels.window_slice(cells, 2, 4, 0, 3).count() == 6


def test_mask_outside(spark):
    e = aoi.aoi_edges(spark.createDataFrame([(1, '{"type":"Polygon","coordinates":[[[0,0],[0,2],[2,2],[2,0]]]}')], "aoi_id int, geojson string"))
    cells = spark.createDataFrame([(1, 1.0, 1.0, 5, 6, 7), (2, 3.0, 1.0, 5, 6, 7), (3, None, 1.0, 5, 6, 7)], "k int, cx_m double, cy_m double, s int, q int, r int")
    for most in (64, 0):
        m = tiles.mask_outside(tiles.in_areas(cells, e, ["k"], most=most), ["s"], {"q": 9, "r": None})
        assert sorted((x["k"], x["s"], x["q"], x["r"]) for x in m.collect()) == [(1, 5, 6, 7), (2, None, 9, 7), (3, None, 9, 7)]


def test_bands(spark):
    b, unknown = catalog.scene_bands(F.lit("sentinel2"), F.array(F.lit(2), F.lit(40)), F.lit(True), F.lit(True))
    r = spark.range(1).select(b.alias("b"), unknown.alias("u")).first()
    assert r["b"] == [2, 3, 4, 8, 11] and r["u"] == [40]


def test_sources_are_never_replaced(spark):
    d = spark.createDataFrame([("VIIRS_NOAA21_NRT",), ("MODIS_SP",)], "source string")
    assert values(detections.sources_of_level(d, "sp"), "source") == ["MODIS_SP"]


def test_grids(spark):
    b = spark.createDataFrame([(5.0, 5.0, 34.0, 31.0)], "x0 double, y0 double, x1 double, y1 double")
    r = grids.grid_of_bounds(b, 10.0, snap=True).first()
    assert (r["left_x"], r["top_y"], r["width"], r["height"]) == (0.0, 40.0, 4, 4)
    r = grids.grid_of_bounds(b.withColumn("x1", F.col("x0")), 10.0).first()
    assert r["width"] == 1


def test_bilinear_of_a_plane_is_the_plane(spark):
    g = {"left_x": 0.0, "top_y": 100.0, "res": 10.0, "epsg": 32652}
    h = {"left_x": 13.0, "top_y": 88.0, "res": 10.0, "epsg": 32652}
    s = spark.range(100).selectExpr("CAST(id DIV 10 AS INT) AS row_idx", "CAST(id % 10 AS INT) AS col_idx").withColumn("v", F.col("row_idx") * 2.0 + F.col("col_idx") * 3.0)
    t = s.where("row_idx < 5 AND col_idx < 5").select("row_idx", "col_idx")
    got = {(r["row_idx"], r["col_idx"]): r["v"] for r in grids.regrid_bilinear(s, t, g, h, "v").collect()}
    assert all(v == pytest.approx(2 * (r + 1.2) + 3 * (c + 1.3)) for (r, c), v in got.items())
    same = grids.regrid_nearest(s, t, g, g, "v")
    assert {(r["row_idx"], r["col_idx"]): r["v"] for r in same.collect()} == {(r, c): 2.0 * r + 3.0 * c for r in range(5) for c in range(5)}


def test_regrid_of_many_scenes_is_that_of_each(spark):
    g = {"left_x": 0.0, "top_y": 100.0, "res": 10.0, "epsg": 32652}
    h = {"left_x": 13.0, "top_y": 88.0, "res": 15.0, "epsg": 32652}
    s = spark.range(300).selectExpr("CAST(id DIV 100 AS INT) AS scene_no", "CAST(id % 100 DIV 10 AS INT) AS row_idx", "CAST(id % 10 AS INT) AS col_idx", "CASE WHEN id % 13 <> 0 THEN id * id % 97 END AS v")
    cell = ["scene_no", "row_idx", "col_idx"]
    for regrid in (grids.regrid_nearest, grids.regrid_bilinear):
        for to in (g, h):
            got = sorted(map(tuple, regrid(s, s.select(*cell), g, to, "v", ["scene_no"]).select(*cell, F.round("v", 6)).collect()))
            want = []
            for k in range(3):
                one = s.where(F.col("scene_no") == k).drop("scene_no")
                want += [(k, *r) for r in regrid(one, one.select("row_idx", "col_idx"), g, to, "v").select("row_idx", "col_idx", F.round("v", 6)).collect()]
            assert len(got) == 300 and got == sorted(want)


def test_layer_rules(spark):
    layers = spark.createDataFrame([("a", "sr", None, 0.0, -1.0)], "field string, kind string, scale double, offset double, fill double")
    with pytest.raises(Exception, match="no scale for a"):
        tiles.scale_layers(spark.createDataFrame([("a", 5)], "field string, dn int"), layers).collect()
    assert values(tiles.missing_layers(layers, spark.createDataFrame([("b",)], "field string")), "field") == ["a"]
    p, m = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(2,), (3,)], "k int")
    assert sorted(map(tuple, tiles.unmatched_cells(p, m, ["k"]).collect())) == [(1, "image"), (3, "mask")]


def test_report_and_skip(spark):
    i = spark.createDataFrame([("a", "failed"), ("a", "processed"), ("b", "failed"), ("c", "skipped")], "r string, status string")
    assert {x["r"]: x["status"] for x in report.run_report(i, ["r"]).collect()} == {"a": "partial", "b": "failed", "c": "success"}
    w, d = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert values(catalog.skip_existing(w, d, ["k"], 2), "k") == [2]
    assert catalog.skip_existing(w, d, ["k"], 2, "overwrite").count() == 2
    with pytest.raises(ValueError, match="skip or overwrite"):
        catalog.skip_existing(w, d, ["k"], 2, "other")


def test_mask_model_sees_margins_and_returns_each_cell_once(spark):
    cells = spark.range(400).selectExpr("1 AS scene", "CAST(id DIV 20 AS INT) AS row_idx", "CAST(id % 20 AS INT) AS col_idx", "CAST(id AS FLOAT) AS v")
    out = chips.mask_model(cells, ["v"], ["scene"], lambda x: (x[0] > 200).astype(int), patch=8, overlap=4)
    got = {(r["row_idx"], r["col_idx"]): r["cloud_class"] for r in out.collect()}
    assert got == {(i // 20, i % 20): int(i > 200) for i in range(400)} and out.count() == 400


def test_process_scenes(spark):
    scenes = spark.createDataFrame([("A-1", "sentinel-2-l2a", "Sentinel-2A", "05.09", 10.0), ("B-1", "sentinel-2-l2a", "Sentinel-2A", "02.00", None)], "item_id string, collection string, platform string, processing_baseline string, cloud_cover double")
    scenes = scenes.withColumns({"acquired": F.lit("2024-01-16").cast("timestamp"), "west": F.lit(130.0), "south": F.lit(32.0), "east": F.lit(131.0), "north": F.lit(33.0)})
    cells = spark.createDataFrame([("A-1", 0, 0, 3000, 3000, 3000, 3000, 0), ("B-1", 0, 0, 1500, 1500, 1500, 1500, 0)], "item_id string, row_idx int, col_idx int, b03 int, b04 int, b08 int, b11 int, cloud_class int")
    one = imagery.process_scenes(scenes, cells, ["b03", "b04", "b08", "b11"], "2024-01-01", "2024-01-31").collect()
    both = imagery.process_scenes(scenes, cells, ["b03", "b04", "b08", "b11"], "2024-01-01", "2024-01-31", max_cloud=None).collect()
    assert [round(r["b03"], 4) for r in one] == [0.2] and [round(r["b03"], 4) for r in both] == [0.15] and both[0]["n_scenes"] == 2
    done = spark.createDataFrame([("S2C", "20240116")], "prefix string, date_token string")
    assert not imagery.process_scenes(scenes, cells, ["b03", "b04", "b08", "b11"], "2024-01-01", "2024-01-31", done=done).collect()


def test_sinks_round_trip(spark, tmp_path):
    d = spark.createDataFrame([("MODIS_SP", "2024-01-05", "131", "32"), ("VIIRS_SNPP_SP", "2024-01-06", "131", "32")], "source string, acq_date string, longitude string, latitude string")
    t = detections.located(detections.typed(d))
    sinks.write_detections_by_day(t, str(tmp_path / "days"))
    back = spark.read.parquet(str(tmp_path / "days"))
    assert sorted((r["family"], str(r["acq_day"])) for r in back.collect()) == [("modis", "20240105"), ("viirs", "20240106")]
    sinks.write_period(t, str(tmp_path / "period"))
    assert spark.read.parquet(str(tmp_path / "period")).count() == 2
    (tmp_path / "empty" / "source=A").mkdir(parents=True)
    (tmp_path / "empty" / "source=A" / "x.csv").write_text(",".join(readers.DETECTION_COLUMNS) + "\n")
    assert readers.read_detections(spark, str(tmp_path / "empty")).count() == 0


def test_hot_days_are_many_files(spark, tmp_path):
    d = spark.range(1000).selectExpr("'MODIS_SP' AS source", "'2024-01-05' AS acq_date", "CAST(id AS STRING) AS longitude", "'1' AS latitude")
    # Partitions this small would be joined into one task.
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    try:
        sinks.write_detections_by_day(detections.located(detections.typed(d)), str(tmp_path / "hot"), file_rows=100)
    finally:
        spark.conf.unset(name)
    assert len(list((tmp_path / "hot" / "family=modis" / "acq_day=20240105").glob("*.parquet"))) > 2
    assert spark.read.parquet(str(tmp_path / "hot")).count() == 1000


def test_layers_round_trip(spark, tmp_path):
    cells = spark.createDataFrame([("S2C", "d", 0, 0, 3000, 4000, 100, 0), ("S2C", "d", 0, 1, 3000, 1000, 9000, 3), ("S2C", "e", 0, 0, 0, 0, 0, 1)], "prefix string, date_token string, row_idx int, col_idx int, b03 int, b04 int, b11 int, cloud_class int")
    sinks.write_layers(imagery.composite_outputs(cells, ["b03", "b04", "b11"], size=4), str(tmp_path / "l"))
    back = chips.unpack_chips(spark.read.parquet(str(tmp_path / "l")), ["values"], ["date_token", "layer", "band"], 4)
    got = {(r["date_token"], r["layer"], r["band"], r["col_idx"]): round(r["values"], 4) for r in back.collect()}
    assert got[("d", "snowmask", "snow", 0)] == 1.0 and ("d", "masked", "b03", 0) not in got and ("d", "snowmasked", "b03", 0) not in got
    assert ("d", "masked", "b03", 1) not in got and got[("d", "snowmasked", "b03", 1)] == 0.3 and got[("d", "cloudmask", "class", 1)] == 3.0
    assert got[("e", "snowmask", "snow", 0)] == 255.0
    sinks.write_bands(pixels.split_bands(cells, ["b03", "b04"], ["date_token", "row_idx", "col_idx"]), str(tmp_path / "b"))
    assert {r["band"]: r["n"] for r in spark.read.parquet(str(tmp_path / "b")).groupBy("band").agg(F.count("*").alias("n")).collect()} == {"b03": 3, "b04": 3}


def test_layer_scan_is_complete(spark):
    layers = spark.createDataFrame([("a", 0.0, None), ("b", None, None)], "field string, valid_min double, valid_max double")
    cells = spark.createDataFrame([("a", -1), ("a", 5), ("x", 2)], "field string, dn int")
    c = readers.layer_scan(cells, layers)
    assert sorted(values(c.where(readers.in_valid_range(F.col("dn"), F.col("valid_min"), F.col("valid_max"))), "dn")) == [5]
    with pytest.raises(ValueError, match="without cells: b"):
        readers.layer_scan(cells, layers, complete=True)


def test_process_period_and_days(spark):
    raw = spark.createDataFrame([("MODIS_SP", "2024-01-05", "1", "1", 1), ("MODIS_SP", "2024-01-05", "9", "9", 2), ("MODIS_NRT", "2024-01-05", "1", "1", 3), ("MODIS_SP", "2024-03-05", "1", "1", 4), ("MODIS_SP", "x", "1", "1", 5)], "source string, acq_date string, longitude string, latitude string, k int")
    e = aoi.aoi_edges(spark.createDataFrame([(1, '{"type":"Polygon","coordinates":[[[0,0],[0,2],[2,2],[2,0]]]}')], "aoi_id int, geojson string"))
    assert sorted(values(fires.process_period(raw, "2024-01-01", "2024-01-31"), "k")) == [1, 2, 3]
    assert values(fires.process_period(raw, "2024-01-01", "2024-01-31", "sp", e, ["k"]), "k") == [1]
    with pytest.raises(ValueError, match="tell rows apart"):
        fires.process_period(raw, "2024-01-01", "2024-01-31", edges=e)
    g = spark.createDataFrame([(1, "MOD09GA.A2024002.h28v05.061.x.hdf"), (2, "MOD09GA.A2024002.h28v05.061.y.hdf"), (3, "browse.jpg"), (4, "MOD09GA.A2024009.h28v05.061.x.hdf")], "granule_id int, filename string")
    cells = spark.createDataFrame([(1, "a", 0, 0, -9), (2, "a", 0, 0, 5), (1, "a", 0, 1, -9), (4, "a", 0, 0, 7)], "granule_id int, field string, row_idx int, col_idx int, dn int")
    layers = spark.createDataFrame([("a", "sr", 0.5, 1.0, -9.0)], "field string, kind string, scale double, offset double, fill double")
    w = spark.createDataFrame([(1, dt.date(2024, 1, 1), dt.date(2024, 1, 3))], "window_id int, start date, end date")
    v, report_ = surface_reflectance.process_days(g, cells, layers, w)
    assert sorted((r["col_idx"], r["value"]) for r in v.collect()) == [(0, 3.5), (1, None)]
    assert sorted((r["acq_date"].day, r["action"]) for r in report_.collect()) == [(1, "skip"), (2, "process"), (3, "skip")]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "event_id long, source string, acq_date string, longitude string, latitude string, scan string, track string")
    t = detections.typed(none)
    assert detections.by_day(t).count() == 0 and detections.bounds(detections.footprints(t, 10.0)).count() == 0


# --- work that costs more than its bytes ------------------------------------


def test_catalog_text_is_written_by_all_tasks_and_read_once(spark):
    df = QUERIES["scene_catalog"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") + plan.count("JsonToStructs") <= 3  # the geometry, and its coordinates of either type
    assert df._jdf.queryExecution().executedPlan().toString().count("Scan json") == 1
    assert len(df.inputFiles()) > 1


def test_areas_of_one_shape_share_a_days_outputs(spark, tmp_path):
    """Areas 1 and 2 are alike, their windows are not; a day is worked once."""
    day = dt.datetime(2024, 1, 5, 10)
    scenes = spark.createDataFrame([(i, "sentinel-2-l2a", "Sentinel-2A", day + dt.timedelta(days=n), 1.0, "02.00", 0.0, 0.0, 1.0, 1.0) for n, i in enumerate(("a", "b"))], "item_id string, collection string, platform string, acquired timestamp, cloud_cover double, processing_baseline string, west double, south double, east double, north double")
    cells = spark.createDataFrame([("a", 0, 0, 0, 500, 500, 500), ("b", 0, 1, 0, 700, 700, 700)], "item_id string, row_idx int, col_idx int, cloud_class int, b03 int, b04 int, b11 int")
    corners = [(0.2, 0.2), (0.8, 0.2), (0.8, 0.8), (0.2, 0.8)]
    edges = spark.createDataFrame([(i, 0, 0, k, *corners[k], *corners[(k + 1) % 4]) for i in (1, 2) for k in range(4)], "aoi_id long, part int, ring int, edge int, x1 double, y1 double, x2 double, y2 double")
    d = day.date()
    windows = spark.createDataFrame([(1, 1, d, d), (2, 2, d, d + dt.timedelta(days=1))], "aoi_id long, window_id int, start date, end date")
    path = f"file://{tmp_path}/o"
    args = scenes, cells, ["b03", "b04", "b11"]
    first = imagery.process_windows(*args, windows.where("aoi_id = 1"), edges, path, size=4)
    assert [(r["aoi_id"], r["n_processed"]) for r in first.collect()] == [(1, 1)]
    second = {r["aoi_id"]: r for r in imagery.process_windows(*args, windows, edges, path, size=4).collect()}
    assert (second[1]["n_skipped"], second[2]["n_skipped"], second[2]["n_processed"]) == (1, 1, 1)
    held = spark.read.parquet(path).where("layer = 'masked' AND band = 'b03'")
    assert held.select("date_token").distinct().count() == held.count() == 2
    got = imagery.read_areas(spark, path).where("layer = 'masked' AND band = 'b03'")
    assert sorted((r["aoi_id"], r["date_token"]) for r in got.collect()) == [(1, "20240105"), (2, "20240105"), (2, "20240106")]


def test_gaps_of_chips_are_filled_once_for_all_bands(spark):
    rows = [(k, r, c, *[float(100 * k + 10 * r + c + b) if (r + c + b) % 3 else None for b in range(6)]) for k in range(2) for r, c in ((0, 1), (0, 1), (2, 3), (5, 0), (5, 3), (3, 2))]
    bands = [f"b{i}" for i in range(6)]
    p = spark.createDataFrame(rows, "k int, row_idx int, col_idx int, " + ", ".join(f"{b} float" for b in bands))
    plans = [chips.pack_chips(p, bands[:n], ["k"], 4)._jdf.queryExecution().optimizedPlan().toString() for n in (1, 6)]
    assert plans[0].count("array_repeat(") == plans[1].count("array_repeat(") > 0
    got = {(r["k"], r["chip_row"]): [r[b] for b in bands] for r in chips.pack_chips(p, bands, ["k"], 4).collect()}
    want = {}
    for k, r, c, *vs in rows:
        held = want.setdefault((k, r // 4), [[None] * 16 for _ in bands])
        for b, v in enumerate(vs):
            held[b][r % 4 * 4 + c] = v
    assert got == want
