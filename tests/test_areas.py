"""Polygons, projected edges, covering tiles and windows against brute force."""

import datetime
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from skygrid.functions import geo
from skygrid.operators import aoi, catalog, chips, grids, intervals, pixels, report, spans, tiles
from skygrid.plans import surface_reflectance
from skygrid.sources import outputs, readers, sinks, views
from skygrid.streaming import detections as stream

EDGES = "aoi_id long, part int, ring int, edge int, x1 double, y1 double, x2 double, y2 double"


def ring_edges(i, part, ring, points):
    return [(i, part, ring, k, *map(float, p), *map(float, q)) for k, (p, q) in enumerate(zip(points, [*points[1:], points[0]]))]


def edge_frame(spark, shapes):
    """shapes: id -> parts of rings of points."""
    rows = [e for i, parts in shapes.items() for p, rings in enumerate(parts) for r, pts in enumerate(rings) for e in ring_edges(i, p, r, pts)]
    return spark.createDataFrame(rows, EDGES)


# --- footprints -----------------------------------------------------------


def cross(o, a, b):
    return (a[0] - o[0]) * (b[1] - o[1]) - (a[1] - o[1]) * (b[0] - o[0])


def on(p, a, b):
    return cross(a, b, p) == 0 and min(a[0], b[0]) <= p[0] <= max(a[0], b[0]) and min(a[1], b[1]) <= p[1] <= max(a[1], b[1])


def segments_meet(a, b, c, d):
    if any(on(*x) for x in ((a, c, d), (b, c, d), (c, a, b), (d, a, b))):
        return True
    return cross(a, b, c) * cross(a, b, d) < 0 and cross(c, d, a) * cross(c, d, b) < 0


def sides(ring):
    return list(zip(ring, [*ring[1:], ring[0]]))


def in_ring(p, ring):
    odd = False
    for a, b in sides(ring):
        if (a[1] > p[1]) != (b[1] > p[1]) and (p[0] - a[0]) * (b[1] - a[1]) * (1 if b[1] > a[1] else -1) < (b[0] - a[0]) * (p[1] - a[1]) * (1 if b[1] > a[1] else -1):
            odd = not odd
    return odd


def in_area(p, parts):
    return any(in_ring(p, rings[0]) and not any(in_ring(p, h) for h in rings[1:]) for rings in parts)


def areas_meet(a, b):
    ea, eb = ([s for rings in x for r in rings for s in sides(r)] for x in (a, b))
    return any(segments_meet(*s, *t) for s in ea for t in eb) or any(in_area(r[0][0], b) for r in a) or any(in_area(r[0][0], a) for r in b)


def quad(r, size=60):
    x, y, s = r.randint(-300, 300), r.randint(-300, 300), r.randint(4, size)
    k = r.randint(0, s // 2)
    return [(x + k, y), (x + s, y + k), (x + s - k, y + s), (x, y + s - k)]


def test_polygons_in_areas(spark):
    r = random.Random(3)
    prints = {i: [[quad(r)]] for i in range(150)} | {200 + i: [[quad(r, 20)], [quad(r, 20)]] for i in range(30)}
    areas = {}
    for i in range(40):
        outer = quad(r, 200)
        (x, y), s = outer[0], 4
        areas[i] = [[outer]]
        if i % 2:  # a triangular hole, well inside, that may hold footprints
            cx, cy = sum(p[0] for p in outer) // 4, sum(p[1] for p in outer) // 4
            w = max(2, (outer[1][0] - outer[3][0]) // 5)
            areas[i][0].append([(cx - w, cy - w), (cx + w, cy - w), (cx, cy + w)])
        if i % 3 == 0:
            areas[i].append([quad(r, 30)])
    areas[900] = [[[(-400, -400), (400, -400), (400, 400), (-400, 400)], [(-390, -390), (390, -390), (390, 390), (-390, 390)]]]  # a frame: what lies in its hole is apart
    prints[900] = [[[(-395, 0), (-393, 1), (-394, 3)]]]
    prints[901] = [[[(-380, 0), (-370, 1), (-375, 3)]]]
    prints[902] = [[[(400, 0), (410, 1), (405, 3)]]]  # touches from outside
    scaled = lambda shapes: {i: [[[(x / 100, y / 100) for x, y in ring] for ring in rings] for rings in parts] for i, parts in shapes.items()}
    want = {(i, j) for i, a in prints.items() for j, b in areas.items() if areas_meet(a, b)}
    f, e = edge_frame(spark, scaled(prints)), edge_frame(spark, scaled(areas))
    for size in (0.5, 3.0):
        got = [tuple(x) for x in aoi.polygons_in_areas(f, e, size).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    assert {(900, 900), (902, 900)} <= want and (901, 900) not in want
    assert aoi.polygons_in_areas(f.limit(0), e).count() == 0 and aoi.polygons_in_areas(f, e.limit(0)).count() == 0


def test_points_in_an_area_of_many_edges(spark):
    """100,000 edges, two to each direction from the middle."""
    n = 100_000
    t = 2 * np.pi * np.arange(n) / n
    d = 1 + 0.3 * np.sin(40 * t)
    x, y = 10 * d * np.cos(t), 10 * d * np.sin(t)
    edges = spark.range(n).select(F.lit(1).cast("long").alias("aoi_id"), F.lit(0).alias("part"), F.lit(0).alias("ring"), F.col("id").alias("k"))
    angle = lambda k: 2 * math.pi * F.pmod(k, F.lit(n)) / n
    far = lambda k: 10 * (1 + 0.3 * F.sin(40 * angle(k)))
    k = F.col("k")
    edges = edges.select("aoi_id", "part", "ring", k.alias("edge"), *[c.alias(a) for c, a in ((far(k) * F.cos(angle(k)), "x1"), (far(k) * F.sin(angle(k)), "y1"), (far(k + 1) * F.cos(angle(k + 1)), "x2"), (far(k + 1) * F.sin(angle(k + 1)), "y2"))])
    r = np.random.default_rng(0)
    px, py = r.uniform(-14, 14, 3000), r.uniform(-14, 14, 3000)
    radius, theta = np.hypot(px, py), np.arctan2(py, px)
    bound = 10 * (1 + 0.3 * np.sin(40 * theta))
    clear = np.abs(radius - bound) > 1e-4
    points = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(px, py))], "event_id long, lon double, lat double")
    got = {r["event_id"] for r in aoi.points_in_areas(points, edges, ["event_id"]).collect()}
    assert {i for i in got if clear[i]} == set(np.flatnonzero(clear & (radius < bound)).tolist())


# --- projected edges ------------------------------------------------------


def distance_to_chain(p, chain):
    a, b = chain[:, :2], chain[:, 2:]
    d = b - a
    t = np.clip(((p - a) * d).sum(1) / np.maximum((d * d).sum(1), 1e-300), 0, 1)
    return np.hypot(*(a + t[:, None] * d - p).T).min()


@pytest.mark.parametrize("crs, tolerance", [("sinusoidal", 0.01), ("sinusoidal", 50.0), ("32652", 0.01), ("32652", 5.0)])
def test_projected_edges_stay_near(spark, crs, tolerance):
    r = random.Random(1)
    lon0, lat0, wide = (129, 35, 3) if crs != "sinusoidal" else (100, 60, 70)
    lat = lambda: max(-89.0, min(89.0, lat0 + r.uniform(-wide, wide) / 3))
    shapes = {i: [[[(lon0 + r.uniform(-wide, wide), lat()) for _ in range(4)]]] for i in range(6)}
    e = edge_frame(spark, shapes)
    got = aoi.project_edges(e, crs, tolerance)
    assert got.columns == e.columns
    chains = {}
    for x in got.collect():
        chains.setdefault((x["aoi_id"], x["edge"]), []).append((x["x1"], x["y1"], x["x2"], x["y2"]))
    to = geo.to_sinusoidal if crs == "sinusoidal" else lambda a, b: geo.to_utm(a, b, crs)
    sampled = e.crossJoin(spark.range(41).selectExpr("id / 40e0 AS t")).withColumns(geo.pair(to("(x1 + (x2 - x1) * t)", "(y1 + (y2 - y1) * t)"), "mx", "my")).collect()
    for x in sampled:
        chain = np.array(chains[x["aoi_id"], x["edge"]])
        assert distance_to_chain(np.array([x["mx"], x["my"]]), chain) <= 1.05 * tolerance
    ends = {}
    for x in got.collect():
        ends.setdefault(x["aoi_id"], []).append(((x["x1"], x["y1"]), (x["x2"], x["y2"])))
    for pairs in ends.values():  # rings stay closed, to the last bit
        assert sorted(a for a, _ in pairs) == sorted(b for _, b in pairs)


def test_projection_splits_no_more_than_it_must(spark):
    e = edge_frame(spark, {1: [[[(10, 0), (20, 0), (20, 60), (10, 60)]]]})
    fine, rough = (aoi.project_edges(e, "sinusoidal", t) for t in (1.0, 10_000.0))
    # Parallels are straight on the sinusoidal grid, meridians are not.
    assert {r["edge"]: r["count"] for r in fine.groupBy("edge").count().collect()}[0] == 1
    assert rough.count() < 20 < fine.count() < 4000


# --- covering tiles -------------------------------------------------------


def tile_of(lon, lat):
    u = 18 + lon * math.cos(math.radians(lat)) / 10
    return min(35, max(0, math.floor(u))), min(17, max(0, math.floor(9 - lat / 10)))


def test_covering_tiles(spark):
    shapes = {
        1: [[[(127.2, 34.1), (129.7, 34.1), (129.7, 38.6), (127.2, 38.6)]]],
        2: [[[(-179.9, 60), (-120, 75), (-150, 88)]]],  # high latitudes
        3: [[[(179, -3), (180, -3), (180, 4), (179, 4)]]],  # the globe's edge
        4: [[[(-180, 89), (180, 89), (180, 90), (-180, 90)]]],  # around the pole
        5: [[[(0.1, 0.1), (0.2, 0.1), (0.2, 0.2)]], [[(100.1, -50.1), (100.2, -50.1), (100.2, -50.2)]]],  # two parts
        6: [[[(20, 20), (60, 20), (60, 60), (20, 60)], [(24, 24), (56, 24), (56, 56), (24, 56)]]],  # a frame
    }
    found = {}
    rows = aoi.covering_tiles(edge_frame(spark, shapes)).collect()
    for r in rows:
        found.setdefault(r["aoi_id"], set()).add((r["h"], r["v"]))
    assert len(rows) == sum(map(len, found.values()))
    for i, parts in shapes.items():
        inside, edge = set(), []
        for rings in parts:
            outer = rings[0]
            xs, ys = [p[0] for p in outer], [p[1] for p in outer]
            for a in np.linspace(min(xs), max(xs), 240):
                for b in np.linspace(min(ys), max(ys), 240):
                    if in_ring((a, b), outer) and not any(in_ring((a, b), h) for h in rings[1:]):
                        inside.add(tile_of(a, b))
            for ring in rings:
                for a, b in sides(ring):
                    edge += [(a[0] + (b[0] - a[0]) * t, a[1] + (b[1] - a[1]) * t) for t in np.linspace(0, 1, 2000)]
        assert inside <= found[i]
        uv = np.array([(18 + x * math.cos(math.radians(y)) / 10, 9 - y / 10) for x, y in edge])
        for h, v in found[i] - inside:  # tiles that only the bound comes to
            gap = np.hypot(np.maximum(np.maximum(h - uv[:, 0], uv[:, 0] - h - 1), 0), np.maximum(np.maximum(v - uv[:, 1], uv[:, 1] - v - 1), 0))
            assert gap.min() < 1e-3, (i, h, v)
    assert found[1] == {(27, 5), (28, 5)} and found[3] == {(35, 8), (35, 9)} and found[5] == {(18, 8), (24, 14)}
    assert (20, 4) not in found[6] or tile_of(30, 45) == (20, 4)
    assert aoi.covering_tiles(edge_frame(spark, shapes).limit(0)).count() == 0


# --- windows --------------------------------------------------------------


def test_interval_join(spark):
    r = random.Random(7)
    day = lambda n: datetime.date(2024, 1, 1) + datetime.timedelta(days=n)

    def some(n, longest):
        out = []
        for i in range(n):
            a = r.randint(-400, 400)
            out.append((r.choice("abc"), i, day(a), day(a + r.choice((0, 0, 1, r.randint(0, longest))))))
        return out + [("a", n, None, day(3)), ("a", n + 1, day(9), day(8)), (None, n + 2, day(0), day(0))]

    left, right = some(120, 300), some(90, 700)
    a = spark.createDataFrame(left, "k string, i int, s date, e date")
    b = spark.createDataFrame(right, "k string, l_bucket int, ws date, we date")
    got = intervals.interval_join(a, b, ["k"], ("s", "e"), ("ws", "we"))
    assert got.columns == ["k", "i", "s", "e", "l_bucket", "ws", "we"]
    rows = [(x["i"], x["l_bucket"]) for x in got.collect()]
    want = {(x[1], y[1]) for x in left for y in right if x[0] is not None and x[0] == y[0] and None not in (*x, *y) and x[2] <= x[3] and y[2] <= y[3] and x[2] <= y[3] and y[2] <= x[3]}
    assert len(rows) == len(set(rows)) and set(rows) == want
    assert intervals.interval_join(a, b.limit(0), ["k"], ("s", "e"), ("ws", "we")).count() == 0
    with pytest.raises(ValueError):
        intervals.interval_join(a, a, ["k"], ("s", "e"), ("s", "e"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


# --- row spans ------------------------------------------------------------


def test_row_spans_equal_point_in_polygon(spark):
    """Cell for cell, with bounds on cells' centres, holes and several parts."""
    r = random.Random(11)
    shapes = {i: [[[(x * 5, y * 5) for x, y in quad(r, 60)]]] for i in range(12)}
    shapes[50] = [[[(0, 0), (200, 0), (200, 200), (0, 200)], [(45, 45), (155, 45), (155, 155), (45, 155)]], [[(75, 75), (125, 75), (125, 125), (75, 125)]]]
    shapes[51] = [[[(5, 5), (105, 5), (105, 105), (5, 105)]]]  # bounds on centres
    shapes[52] = [[[(15, 15), (55, 95), (95, 15), (55, 45)]]]  # a dent
    e = edge_frame(spark, shapes)
    box = {"left_x": -1500.0, "top_y": 1500.0, "res": 10.0}
    grid = e.select("aoi_id").distinct().select("aoi_id", *[F.lit(v).alias(k) for k, v in box.items()], F.lit(320).alias("width"), F.lit(310).alias("height"))
    s = spans.row_spans(e, grid)
    rows = s.collect()
    got = {(x["aoi_id"], x["row_idx"], c) for x in rows for a in x["spans"] for c in range(a["c0"], a["c1"] + 1)}
    assert sum(a["c1"] - a["c0"] + 1 for x in rows for a in x["spans"]) == len(got)  # runs don't overlap
    assert all(b["c0"] > a["c1"] + 1 for x in rows for a, b in zip(x["spans"], x["spans"][1:]))  # nor touch
    cells = spark.range(310 * 320).selectExpr("CAST(id DIV 320 AS LONG) AS row_idx", "CAST(id % 320 AS LONG) AS col_idx").withColumns({"lon": -1500.0 + (F.col("col_idx") + 0.5) * 10.0, "lat": 1500.0 - (F.col("row_idx") + 0.5) * 10.0})
    want = {(x["aoi_id"], x["row_idx"], x["col_idx"]) for x in aoi.points_in_areas(cells, e, ["row_idx", "col_idx"]).collect()}
    assert got == want
    masked = spans.in_spans(cells.withColumn("aoi_id", F.lit(50)), s, ["aoi_id"])
    assert masked.count() == 310 * 320 and masked.where("in_area").count() == sum(i == 50 for i, _, _ in want)
    assert spans.row_spans(e.limit(0), grid).count() == 0


# --- chips ----------------------------------------------------------------


def plane(spark, keys, rows, cols):
    return spark.createDataFrame([(k, r, c, float(r * 3 + c * 2 + k * 1000) if (r * 7 + c) % 11 else None) for k in keys for r in range(rows) for c in range(cols)], "k int, row_idx int, col_idx int, v double")


@pytest.mark.parametrize("method", ["nearest", "bilinear"])
def test_regrid_chips_equals_the_cell_form(spark, method):
    """Keys with grids of their own, in zones of their own."""
    rows, cols, size = 40, 50, 16
    cells = plane(spark, (1, 2, 3), rows, cols)
    s = {1: (700000.0, 3900000.0, 30.0, 32652), 2: (705000.0, 3899000.0, 25.0, 32652), 3: (160000.0, 3900500.0, 30.0, 32653)}
    t = {1: (700100.0, 3899950.0, 20.0, 32652), 2: (157900.0, 3900200.0, 40.0, 32653), 3: (704900.0, 3900100.0, 30.0, 32652)}
    spec = "k int, left_x double, top_y double, res double, epsg int"
    sources = spark.createDataFrame([(k, *g) for k, g in s.items()], spec)
    targets = spark.createDataFrame([(k, *g, 45, 37) for k, g in t.items()], spec + ", width int, height int")
    out = grids.regrid_chips(chips.pack_chips(cells, ["v"], ["k"], size), sources, targets, "v", ["k"], size, method)
    assert out.count() == 3 * 3 * 3
    got = {(r["k"], r["row_idx"], r["col_idx"]): r["v"] for r in chips.unpack_chips(out, ["v"], ["k"], size).collect()}
    want = {}
    names = ("left_x", "top_y", "res", "epsg")
    for k in (1, 2, 3):
        target = spark.range(37 * 45).selectExpr(f"{k} AS k", "CAST(id DIV 45 AS INT) AS row_idx", "CAST(id % 45 AS INT) AS col_idx")
        cell_form = grids.regrid_nearest if method == "nearest" else grids.regrid_bilinear
        for r in cell_form(cells.where(F.col("k") == k), target, dict(zip(names, s[k])), dict(zip(names, t[k])), "v", ["k"]).where("v IS NOT NULL").collect():
            want[k, r["row_idx"], r["col_idx"]] = r["v"]
    assert got.keys() == want.keys() and len(want) > 1500
    assert all(got[x] == pytest.approx(want[x], abs=1e-6) for x in want)


def test_chips_of_one_grid_are_regridded_by_all_tasks(spark):
    """Source and target of one key are a row each; their chips are dealt anew."""
    spec = "k int, left_x double, top_y double, res double, epsg int"
    source = spark.createDataFrame([(1, 0.0, 3900000.0, 10.0, 32652)], spec)
    target = spark.createDataFrame([(1, 0.0, 3900000.0, 10.0, 32652, 7, 60)], spec + ", width int, height int")
    cells = plane(spark, (1,), 60, 7)
    out = grids.regrid_chips(chips.pack_chips(cells, ["v"], ["k"], 16), source, target, "v", ["k"], 16)
    assert "REPARTITION_BY_NUM" in out._jdf.queryExecution().executedPlan().toString()
    rows = out.collect()
    assert len(rows) == 4 and all(len(r["v"]) == 256 for r in rows)
    got = {(r["row_idx"], r["col_idx"]): r["v"] for r in chips.unpack_chips(out, ["v"], ["k"], 16).collect()}
    assert got == {(r["row_idx"], r["col_idx"]): r["v"] for r in cells.where("v IS NOT NULL").collect()}


def test_windows_read_few_row_groups(spark, tmp_path):
    size, path = 8, f"file://{tmp_path}/chips"
    cells = spark.range(256 * 256).selectExpr("0 AS k", "CAST(id DIV 256 AS INT) AS row_idx", "CAST(id % 256 AS INT) AS col_idx", "CAST(id AS DOUBLE) AS v")
    sinks.write_chips(chips.pack_chips(cells, ["v"], ["k"], size), path, ["k"], file_chips=64, group_bytes=16 << 10)

    def rows_scanned(df):
        plan = df._jdf.queryExecution().executedPlan()
        plan.execute().count()
        while plan.children().size():
            plan = plan.children().apply(0)
        return plan.metrics().apply("numOutputRows").value(), plan.toString()

    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    every, _ = rows_scanned(spark.read.parquet(path))
    window = readers.read_window(spark, path, (100, 119), (40, 61), size)
    read, plan = rows_scanned(window)
    assert "GreaterThanOrEqual(chip_row,12)" in plan and "LessThanOrEqual(chip_col,7)" in plan
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert every == 1024 and read <= every // 8
    w = spark.createDataFrame([(0, 100, 40, 20, 22)], "k int, row_off int, col_off int, n_rows int, n_cols int")
    found = readers.read_windows(spark, path, w, ["k"], size)
    got = {(r["row_idx"], r["col_idx"]): r["v"] for r in chips.unpack_chips(tiles.crop_chips(found, w, ["v"], ["k"], size), ["v"], ["k"], size).collect()}
    assert got == {(r, c): float(r * 256 + c) for r in range(100, 120) for c in range(40, 62)}
    assert readers.read_windows(spark, path, w.limit(0), ["k"], size).count() == 0


# --- outputs --------------------------------------------------------------


def test_a_rerun_leaves_other_days(spark, tmp_path):
    path = f"file://{tmp_path}/out"
    d = lambda day, n: spark.createDataFrame([("modis", day, i) for i in range(n)], "family string, acq_day string, i int")
    by = ["family", "acq_day"]
    read = lambda: {r["acq_day"]: r["count"] for r in spark.read.schema("i int, family string, acq_day string").parquet(path).groupBy("acq_day").count().collect()}
    work = spark.createDataFrame([("0101",), ("0102",), ("0103",)], "acq_day string")
    assert outputs.outputs_done(spark, path, ["acq_day"]).count() == 0
    outputs.write_outputs(d("0101", 3), path, by, work.where("acq_day in ('0101', '0103')"), ["acq_day"])
    assert {r["acq_day"]: r["n_rows"] for r in outputs.outputs_done(spark, path, ["acq_day"]).collect()} == {"0101": 3, "0103": 0}
    assert [r["acq_day"] for r in outputs.still_to_do(work, path, ["acq_day"]).collect()] == ["0102"]
    outputs.write_partitions(d("0102", 9), path, by)  # cut off before the record
    assert [r["acq_day"] for r in outputs.still_to_do(work, path, ["acq_day"]).collect()] == ["0102"]
    outputs.write_outputs(d("0102", 2), path, by, work.where("acq_day = '0102'"), ["acq_day"])
    assert read() == {"0101": 3, "0102": 2} and outputs.still_to_do(work, path, ["acq_day"]).count() == 0
    assert outputs.still_to_do(work, path, ["acq_day"], "overwrite").count() == 3
    # A rerun that fails half way is not done, though an earlier run was.
    bad = d("0101", 5).withColumn("i", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        outputs.write_outputs(bad, path, by, work.where("acq_day = '0101'"), ["acq_day"])
    assert [r["acq_day"] for r in outputs.still_to_do(work, path, ["acq_day"]).collect()] == ["0101"]
    with pytest.raises(ValueError):
        outputs.write_outputs(bad, path, by, work, ["i"])


def test_runs_take_each_others_place(spark, tmp_path):
    path, key = f"file://{tmp_path}/runs", ["k"]
    d = lambda *rows: spark.createDataFrame(rows, "k int, v int")
    work = d((1, 0), (2, 0), (3, 0)).select("k")
    outputs.write_run(d((1, 10), (1, 11), (2, 20)), path, work, key)
    outputs.write_run(d((2, 25)), path, work.where("k = 2"), key)
    d((3, 99)).write.parquet(f"{path}/run=lost")  # cut off before the record
    assert sorted(map(tuple, outputs.read_runs(spark, path, "k int, v int", key).collect())) == [(1, 10), (1, 11), (2, 25)]
    assert {r["k"]: r["n_rows"] for r in outputs.outputs_done(spark, path, key).collect()} == {"1": 2, "2": 1, "3": 0}


def test_masks_of_another_shape_are_an_error(spark):
    key = ["row_idx", "col_idx"]
    image = spark.createDataFrame([(0, 0, 5), (0, 1, 6)], "row_idx int, col_idx int, b03 int")
    mask = lambda *rows: spark.createDataFrame(rows, "row_idx int, col_idx int, cloud_class int")
    snow = lambda *rows: spark.createDataFrame(rows, "row_idx int, col_idx int, snow int")
    whole = pixels.join_masks(image, mask((0, 0, 1), (0, 1, None)), snow((0, 1, 1)), key)
    assert sorted(map(tuple, whole.select("row_idx", "col_idx", "b03", "cloud_class", "snow").collect()), key=repr) == [(0, 0, 5, 1, None), (0, 1, 6, None, 1)]
    for cloud, more in ((mask((0, 0, 1)), None), (mask((0, 0, 1), (0, 1, 0), (1, 0, 0)), None), (mask((0, 0, 1), (0, 1, 0)), snow((5, 5, 1)))):
        with pytest.raises(Exception, match="cells"):
            pixels.join_masks(image, cloud, more, key).collect()
    assert pixels.join_masks(image, mask((0, 0, 1)), None, key, strict=False).count() == 1


def test_coverage_is_by_product(spark):
    day = datetime.date(2024, 1, 1)
    w = spark.createDataFrame([(p, p, day, day) for p in ("MOD09GA", "MYD09GA")], "window_id string, product string, start date, end date")
    g = spark.createDataFrame([("MYD09GA", day)], "product string, acq_date date")
    assert {r["window_id"]: r["action"] for r in catalog.calendar_coverage(w, g).collect()} == {"MOD09GA": "skip", "MYD09GA": "process"}


def test_fills_of_unsigned_layers(spark):
    g = spark.createDataFrame([(1, "MOD09GA.A2024001.h28v05.061.1.hdf"), (2, "MOD09GA.A2024001.h28v05.061.2.hdf")], "granule_id long, filename string")
    fill = 4294967295
    cells = spark.createDataFrame([(1, "qc", 0, 0, fill), (2, "qc", 0, 0, 4294967290), (1, "qc", 0, 1, fill)], "granule_id long, field string, row_idx int, col_idx int, dn long")
    layers = spark.createDataFrame([("qc", "qa", None, None, float(fill))], "field string, kind string, scale double, offset double, fill double")
    w = spark.createDataFrame([(1, datetime.date(2024, 1, 1), datetime.date(2024, 1, 2))], "window_id int, start date, end date")
    values, report = surface_reflectance.process_days(g, cells, layers, w)
    assert {(r["col_idx"], r["qa"]) for r in values.collect()} == {(0, 4294967290), (1, fill)}
    assert [r["action"] for r in report.orderBy("acq_date").collect()] == ["process", "skip"]


def test_observed_reports_need_no_pass_of_their_own(spark):
    items, seen = report.observed(spark.createDataFrame([("processed",), ("failed",), ("skipped",), ("processed",), (None,)], "status string"), "run")
    items.write.format("noop").mode("overwrite").save()
    assert tuple(report.observed_report(spark, {"a": seen}).first()) == ("a", 5, 2, 1, 1, "partial")


def test_area_streams_follow_changed_areas(spark, tmp_path):
    spec = "source string, latitude string, longitude string, acq_date string, acq_time string"
    row = lambda lon, hour: ("MODIS_SP", "0.5", lon, "2024-01-01", f"{hour:02}00")
    west = edge_frame(spark, {1: [[[(0, 0), (1, 0), (1, 1), (0, 1)]]]})
    east = edge_frame(spark, {1: [[[(0, 0), (1, 0), (1, 1), (0, 1)]]], 2: [[[(2, 0), (3, 0), (3, 1), (2, 1)]]]})
    current = [west]
    areas = stream.AreaCells(lambda: current[0])
    for i, rows in enumerate(([row("0.5", 1), row("2.5", 1)], [row("0.5", 1), row("2.5", 2), row("0.6", 2)])):
        spark.createDataFrame(rows, spec).write.parquet(f"{tmp_path}/in/{i}")
        stream.poll_areas(spark, f"{tmp_path}/in", spec, areas, f"{tmp_path}/out", f"{tmp_path}/state")
        current[0] = east
    got = stream.area_counts(spark.read.parquet(f"{tmp_path}/out")).collect()
    assert {(r["aoi_id"], r["n"]) for r in got} == {(1, 2), (2, 1)}


def test_a_cell_twice_in_a_granule_gives_the_first_one(spark):
    rows = [(7, "state", 0, 0, dn, at) for at, dn in enumerate([5, 9, 3, 8, 1, 6])]
    layers = spark.createDataFrame([("state", 65535.0)], "field string, fill double")
    schema = "granule_id long, field string, row_idx int, col_idx int, dn long, cell_ord int"
    for order in (rows, rows[::-1], rows[3:] + rows[:3]):
        cells = spark.createDataFrame(order, schema).repartition(1)
        assert surface_reflectance.mosaic(cells, layers, ["row_idx", "col_idx"]).first()["dn"] == 5
        # Without an order of cells no tie is left to chance either.
        assert surface_reflectance.mosaic(cells.drop("cell_ord"), layers, ["row_idx", "col_idx"]).first()["dn"] == 1


def test_views_in_order_are_the_views(spark, tmp_path):
    lines = [(1, 30 - i, 5, i, i * 24 * 12) for i in range(1, 7)]
    spark.createDataFrame(lines, "l_orderkey long, x long, l_suppkey long, l_linenumber int, l_partkey long").coalesce(1).write.parquet(f"file://{tmp_path}/lineitem.parquet")
    ordered = views.read_in_order(spark, f"file://{tmp_path}", "fx_granule_cells", "lineitem", "cell_ord")
    plain = views.read(spark, f"file://{tmp_path}", "fx_granule_cells")
    assert sorted(ordered.drop("cell_ord").collect()) == sorted(plain.collect())
    assert sorted(r["cell_ord"]["row_index"] for r in ordered.collect()) == list(range(6))


def _copies(shapes, n):
    return {i + 100 * k: parts for i, parts in shapes.items() for k in range(n)}


def test_equal_areas_and_boxes_are_met_once(spark):
    shapes = {1: [[[(0, 0), (1, 0), (1, 1), (0, 1)]]], 2: [[[(0.5, 0.5), (3, 0.5), (3, 2), (0.5, 2)], [(1, 1), (2, 1), (2, 1.5)]]]}
    edges = edge_frame(spark, _copies(shapes, 20)).repartition(4)
    few, members = aoi.alike(edges)
    assert {r["aoi_id"] for r in few.select("aoi_id").distinct().collect()} == {1, 2}
    assert sorted((r["aoi_id"], r["shape"]) for r in members.collect()) == sorted((i, i % 100) for i in _copies(shapes, 20))
    boxes = spark.createDataFrame([(f"s{i}", float(i % 3), 0.2, i % 3 + 0.4, 0.6) for i in range(30)], "item_id string, west double, south double, east double, north double")
    met = aoi._boxes_met(boxes.select(*aoi.BOX).distinct(), few, True, 0.5).collect()
    assert len(met) == len({tuple(r) for r in met}) == 4
    got = sorted(map(tuple, aoi.boxes_in_areas(boxes, edges).collect()))
    want = [(f"s{i}", a) for i in range(30) for a in _copies(shapes, 20) if (i % 3, a % 100) in {(0, 1), (1, 1), (1, 2), (2, 2)}]
    assert got == sorted(want)
    points = spark.createDataFrame([(i, 0.7, 0.7) for i in range(3)], "event_id int, lon double, lat double")
    assert aoi.points_in_areas(points, edges, ["event_id"]).count() == 3 * 40


def test_windows_meet_days_in_few_buckets(spark):
    day = datetime.date(2024, 1, 1)
    days = lambda n: day + datetime.timedelta(n)
    a = spark.createDataFrame([(1, i, days(i)) for i in range(400)], "k int, item int, at date")
    spans_ = [(w, w * 3, w * 3 + n) for w, n in enumerate([0, 1, 7, 31, 32, 40, 100, 364, 1000])]
    b = spark.createDataFrame([(1, w, days(s), days(e)) for w, s, e in spans_], "k int, w int, s date, e date")
    got = sorted((r["w"], r["item"]) for r in intervals.interval_join(a, b, ["k"], ("at", "at"), ("s", "e")).collect())
    assert got == sorted((w, i) for w, s, e in spans_ for i in range(400) if s <= i <= e)


def test_row_groups_of_layers_hold_few_chips(spark, tmp_path):
    import pyarrow.parquet as pq

    n = 3 * sinks.GROUP_CHIPS
    c = spark.range(n).selectExpr("'S2C' AS satellite", "'masked' AS layer", "'20240116' AS date_token", "'b03' AS band", "CAST(id AS INT) AS chip_row", "0 AS chip_col", "array_repeat(CAST(NULL AS FLOAT), 64) AS values")
    sinks.write_layers(c.coalesce(1), f"file://{tmp_path}/layers")
    files = [pq.ParquetFile(f).metadata for f in tmp_path.glob("layers/*/*/*/*.parquet")]
    groups = [m.row_group(i).num_rows for m in files for i in range(m.num_row_groups)]
    assert sum(groups) == n and max(groups) <= sinks.GROUP_CHIPS


def test_areas_of_one_shape_share_a_mosaic(spark):
    """Areas 1 and 2 are alike, their windows are not; cells are mosaicked once
    a tile and are not shuffled by area."""
    d = [datetime.date(2024, 1, 5), datetime.date(2024, 1, 6)]
    text = '{"type":"Polygon","coordinates":[[[1.1,1.1],[4.1,1.1],[4.1,4.1],[1.1,4.1],[1.1,1.1]]]}'
    areas = spark.createDataFrame([(1, text), (2, text)], "aoi_id long, geojson string")
    g = spark.createDataFrame([(7, "MOD09GA.A2024005.h18v08.061.7.hdf"), (8, "MOD09GA.A2024006.h18v08.061.8.hdf")], "granule_id long, filename string")
    cells = spark.createDataFrame([(i, "qc", r, c, 100 * i + 10 * r + c) for i in (7, 8) for r in range(10) for c in range(10)], "granule_id long, field string, row_idx int, col_idx int, dn int")
    layers = spark.createDataFrame([("MOD09GA", "qc", "qa", "500m", 10, 16, None, None, 65535.0, "qc_1")], "product string, field string, kind string, resolution string, pixels int, bits int, scale double, offset double, fill double, sds_path string")
    w = spark.createDataFrame([(1, 1, d[0], d[0]), (2, 2, d[0], d[1]), (2, 3, d[1], d[0])], "aoi_id long, window_id int, start date, end date")
    out = surface_reflectance.process_areas(g, cells, layers, w, areas)
    plan = out.values._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.splitlines() if "Exchange hashpartitioning(" in x and "gcol" in x]
    got = {}
    for r in out.values.collect():
        got.setdefault((r["aoi_id"], r["acq_date"]), {})[r["row_idx"], r["col_idx"]] = r["qa"]
    assert set(got) == {(1, d[0]), (2, d[0]), (2, d[1])}
    assert got[1, d[0]] == got[2, d[0]] and {k: v + 100 for k, v in got[2, d[0]].items() if v != 65535} == {k: v for k, v in got[2, d[1]].items() if v != 65535}
    assert any(v != 65535 for v in got[1, d[0]].values())
    done = spark.createDataFrame([(2, "MOD09GA", d[0])], "aoi_id long, product string, acq_date date")
    rest = surface_reflectance.process_areas(g, cells, layers, w, areas, done).values
    assert sorted(map(tuple, rest.select("aoi_id", "acq_date").distinct().collect())) == [(1, d[0]), (2, d[1])]


def test_one_day_rows_move_once_to_windows_of_two_months(spark):
    """Windows of a day to two months have one kind of buckets: rows of a day
    are not multiplied to meet them, and each pair comes once."""
    day = datetime.date(2024, 1, 1)
    days = lambda n: day + datetime.timedelta(n)
    a = spark.createDataFrame([("a", i, days(i - 150)) for i in range(300)], "k string, item int, at date")
    spans_ = [(w, w * 5 - 100, w * 5 - 100 + n) for w, n in enumerate([0, 1, 6, 7, 8, 30, 31, 32, 39, 63])]
    b = spark.createDataFrame([("a", w, days(s), days(e)) for w, s, e in spans_], "k string, w int, s date, e date")
    got = intervals.interval_join(a, b, ["k"], ("at", "at"), ("s", "e"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate explode") == 1
    assert sorted((r["w"], r["item"]) for r in got.collect()) == sorted((w, i) for w, s, e in spans_ for i in range(300) if s <= i - 150 <= e)


def test_names_of_granules_are_parsed_once(spark):
    names = ["MOD09GA.A2024005.h18v08.061.7.hdf", "browse.jpg", "MOD09GA.A2024366.h01v17.061.8.hdf", "MOD09GA.A2024005.x.hdf", None]
    g = catalog.parse_granules(spark.createDataFrame(list(enumerate(names)), "granule_id int, filename string"))
    plan = g.join(spark.createDataFrame([(18, 8), (1, 17)], "h int, v int"), ["h", "v"])._jdf.queryExecution().executedPlan().toString()
    # Written once as an expression that occurs nowhere else, however many columns and filters use it.
    assert plan.count("gettimestamp(") == 1
    assert sorted((r["granule_id"], str(r["acq_date"]), r["h"], r["v"]) for r in g.collect()) == [(0, "2024-01-05", 18, 8), (2, "2024-12-31", 1, 17)]


def test_edges_do_not_move_to_find_equal_ones(spark):
    """Edges are added up where they lie; of a few shapes neither edges nor
    areas are shuffled by id again. Order and repeats of edges, unknown numbers
    and swapped columns tell shapes apart as their lists would."""
    square, n = [(0.0, 0.0, 1.0, 0.0), (1.0, 0.0, 1.0, 1.0), (1.0, 1.0, 0.0, 0.0)], None
    lists = {1: square, 2: square[::-1], 3: [*square, square[0]], 4: [(y, x, v, u) for x, y, u, v in square], 5: [(n, *square[0][1:]), *square[1:]], 6: [(n, *square[0][1:]), *square[1:]], 7: [(square[0][0], n, *square[0][2:]), *square[1:]]}
    edges = spark.createDataFrame([(i, 0, 0, k, *e) for i, es in lists.items() for k, e in enumerate(es)], EDGES).repartition(3)
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few, members = aoi.alike(edges)
        plans = [x._jdf.queryExecution().executedPlan().toString() for x in (few, members)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert not any("SortMergeJoin" in p for p in plans)
    assert {r["aoi_id"]: r["shape"] for r in members.collect()} == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 5, 7: 7}
    assert few.count() == 4 + 4 * 3


def test_areas_of_a_shape_are_met_in_lists(spark):
    """A shape is looked up once a row for many areas."""
    n = 2 * aoi.AREAS_A_ROW + 5
    members = spark.range(n).select(F.col("id").alias("aoi_id"), F.when(F.col("id") == 3, 3).otherwise(0).cast("long").alias("shape"))
    found = spark.createDataFrame([("s1", 0), ("s2", 3), ("s3", 9), ("s4", None)], "item_id string, shape long")
    got = aoi.of_members(found, members)
    assert "explode(aoi_ids" in got._jdf.queryExecution().executedPlan().toString()
    rows = [(r["item_id"], r["aoi_id"]) for r in got.collect()]
    assert len(rows) == n and set(rows) == {("s1", i) for i in range(n) if i != 3} | {("s2", 3)}
