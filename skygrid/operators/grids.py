"""Output grids and regridding between them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from .sizes import spread

CORNERS = [("west", "south"), ("east", "south"), ("east", "north"), ("west", "north")]


def utm_bounds(boxes: DataFrame, epsg: str = "epsg") -> DataFrame:
    """Adds x0, y0, x1, y1: the box's corners in its zone, to 6 decimals."""
    pts = [geo.to_utm(x, y, epsg) for x, y in CORNERS]
    xs, ys = [F.round(F.expr(p[0]), 6) for p in pts], [F.round(F.expr(p[1]), 6) for p in pts]
    return boxes.withColumns({"x0": F.least(*xs), "y0": F.least(*ys), "x1": F.greatest(*xs), "y1": F.greatest(*ys)})


def grid_of_bounds(boxes: DataFrame, res: float, snap: bool = False) -> DataFrame:
    """Adds left_x, top_y, width, height; ``snap`` moves bounds outward to
    multiples of the resolution. No grid is smaller than one cell."""
    if snap:
        boxes = boxes.withColumns({"gx0": F.floor(F.col("x0") / res) * res, "gy0": F.floor(F.col("y0") / res) * res, "gx1": F.ceil(F.col("x1") / res) * res, "gy1": F.ceil(F.col("y1") / res) * res})
    else:
        boxes = boxes.withColumns({"gx0": F.col("x0"), "gy0": F.col("y0"), "gx1": F.col("x1"), "gy1": F.col("y1")})
    size = {n: F.greatest(F.lit(1), F.ceil((F.col(b) - F.col(a)) / res)).cast("int") for n, a, b in (("width", "gx0", "gx1"), ("height", "gy0", "gy1"))}
    return boxes.withColumns({"left_x": F.col("gx0").cast("double"), "top_y": F.col("gy1").cast("double"), "res": F.lit(float(res)), **size}).drop("gx0", "gy0", "gx1", "gy1")


def scene_grid(scenes: DataFrame, res: float, snap: bool = True, epsg: str | None = None) -> DataFrame:
    """Grids of scene boxes in the zone of each box's centre, or in a given one."""
    s = scenes.withColumn("epsg", F.expr(epsg or geo.utm_epsg("((west + east) / 2e0)", "((south + north) / 2e0)")))
    return grid_of_bounds(utm_bounds(s), res, snap)


def detection_grid(geometry_grid: DataFrame, reference: DataFrame) -> DataFrame:
    """The reference grid of an area where its EPSG is the output's, else the
    grid of the geometry. Both: aoi_id, epsg, left_x, top_y, res, width, height."""
    names = ["left_x", "top_y", "res", "width", "height"]
    r = reference.select("aoi_id", F.col("epsg").alias("r_epsg"), *[F.col(c).alias(f"r_{c}") for c in names])
    j = geometry_grid.join(r, "aoi_id", "left")
    same = F.coalesce(F.col("r_epsg") == F.col("epsg"), F.lit(False))
    return j.select("aoi_id", "epsg", *[F.when(same, F.col(f"r_{c}")).otherwise(F.col(c)).alias(c) for c in names], same.alias("from_reference"))


def expand_grid(grids: DataFrame) -> DataFrame:
    """Grids grown outward to bounds x0..y1, by whole cells of the original."""
    res = F.col("res")
    west = F.greatest(F.lit(0), F.ceil((F.col("left_x") - F.col("x0")) / res))
    north = F.greatest(F.lit(0), F.ceil((F.col("y1") - F.col("top_y")) / res))
    right, bottom = F.col("left_x") + F.col("width") * res, F.col("top_y") - F.col("height") * res
    east = F.greatest(F.lit(0), F.ceil((F.col("x1") - right) / res))
    south = F.greatest(F.lit(0), F.ceil((bottom - F.col("y0")) / res))
    return grids.withColumns({
        "new_left": F.col("left_x") - west * res, "new_top": F.col("top_y") + north * res,
        "new_width": (F.col("width") + west + east).cast("int"), "new_height": (F.col("height") + north + south).cast("int"),
    })


def _source_place(target: DataFrame, t: dict, s: dict) -> DataFrame:
    """Adds sc, sr: where a target cell's centre lies on the source grid, in
    cells. Grids: left_x, top_y, res, epsg."""
    x = f"({geo.num(t['left_x'])} + (col_idx + 0.5e0) * {geo.num(t['res'])})"
    y = f"({geo.num(t['top_y'])} - (row_idx + 0.5e0) * {geo.num(t['res'])})"
    if t["epsg"] != s["epsg"]:
        target = target.withColumns(geo.pair(geo.from_utm(x, y, str(t["epsg"])), "c_lon", "c_lat"))
        x, y = geo.to_utm("c_lon", "c_lat", str(s["epsg"]))
    placed = target.withColumn("sc", F.expr(f"({x} - {geo.num(s['left_x'])}) / {geo.num(s['res'])}")).withColumn("sr", F.expr(f"({geo.num(s['top_y'])} - {y}) / {geo.num(s['res'])}"))
    return placed.drop("c_lon", "c_lat")


def regrid_nearest(source: DataFrame, target: DataFrame, s: dict, t: dict, value: str, key: Sequence[str] = ()) -> DataFrame:
    """Each target cell with the value of the source cell that its centre lies
    in; null outside. One equi-join on cells; none if the grids are the same.
    ``key`` names what both tables hold many grids of, such as scenes."""
    if s == t:
        return target.join(source.select(*key, "row_idx", "col_idx", value), [*key, "row_idx", "col_idx"], "left")
    p = _source_place(target, t, s).withColumns({"s_row": F.floor("sr"), "s_col": F.floor("sc")}).drop("sr", "sc")
    src = source.select(*key, F.col("row_idx").cast("long").alias("s_row"), F.col("col_idx").cast("long").alias("s_col"), value)
    return p.join(src, [*key, "s_row", "s_col"], "left").drop("s_row", "s_col")


def regrid_bilinear(source: DataFrame, target: DataFrame, s: dict, t: dict, value: str, key: Sequence[str] = ()) -> DataFrame:
    """Each target cell with the mean of the four source cells around its
    centre, weighted by nearness; missing ones are left out. ``key`` as for
    regrid_nearest."""
    cell = [*key, "row_idx", "col_idx"]
    p = _source_place(target, t, s).withColumns({"fr": F.col("sr") - 0.5, "fc": F.col("sc") - 0.5}).withColumns({"r0": F.floor("fr"), "c0": F.floor("fc")})
    wr, wc = F.col("fr") - F.col("r0"), F.col("fc") - F.col("c0")
    four = [F.struct((F.col("r0") + i).alias("s_row"), (F.col("c0") + j).alias("s_col"), ((wr if i else 1 - wr) * (wc if j else 1 - wc)).alias("w")) for i in (0, 1) for j in (0, 1)]
    near = p.select(*cell, F.explode(F.array(*four)).alias("n")).select(*cell, "n.*")
    src = source.select(*key, F.col("row_idx").cast("long").alias("s_row"), F.col("col_idx").cast("long").alias("s_col"), F.col(value).cast("double").alias("v"))
    j = near.join(src, [*key, "s_row", "s_col"], "left").where((F.col("w") > 0) | F.col("v").isNull())
    w = F.sum(F.when(F.col("v").isNotNull(), F.col("w")))
    return j.groupBy(*cell).agg((F.sum(F.col("w") * F.col("v")) / F.nullif(w, F.lit(0.0))).alias(value))


GRID = ("left_x", "top_y", "res", "epsg")
#: Cells that a place found at a chip's lattice may be off by, and neighbours.
MARGIN = 2


def _mapped(array: str, steps: list[dict[str, str]]) -> str:
    """An array of structs taken through steps, each binding its names once."""
    for step in steps:
        array = f"transform({array}, p -> named_struct({', '.join(f"'{n}', {e}" for n, e in step.items())}))"
    return array


def _on_source(points: str) -> str:
    """SQL for an array of target places (r, c: row and column, in cells) as
    places on the source grid (sr, sc). Zones are left and entered only where
    the grids differ in them."""
    metres = _mapped(points, [{"x": "left_x + p.c * res", "y": "top_y - p.r * res"}])
    other = _mapped(metres, geo.from_utm_steps("p.x", "p.y", "epsg", "p.") + geo.to_utm_steps("p.lon", "p.lat", "s_epsg", "p."))
    return _mapped(f"(CASE WHEN epsg = s_epsg THEN {metres} ELSE {other} END)", [{"sr": "(s_top_y - p.y) / s_res", "sc": "(p.x - s_left_x) / s_res"}])


def regrid_chips(chips: DataFrame, sources: DataFrame, targets: DataFrame, value: str, key: Sequence[str], size: int, method: str = "nearest") -> DataFrame:
    """Chips on the grids of ``sources`` as chips on those of ``targets``: for
    each target cell what ``regrid_nearest`` or ``regrid_bilinear`` give. Every
    key has a grid of its own in both tables (left_x, top_y, res, epsg; targets
    width and height too), in any UTM zones.

    A target chip finds the few source chips below it from a lattice of its
    places, and meets them by one equi-join; its cells are then looked up in
    their arrays inside the row. So chips move, not cells. Absent source chips
    count as missing cells; a target chip always comes back.
    """
    if method not in ("nearest", "bilinear"):
        raise ValueError("method is nearest or bilinear")
    t = targets.select(*key, *GRID, "width", "height").join(sources.select(*key, *[F.col(c).alias(f"s_{c}") for c in GRID]), list(key))
    for axis, n in (("chip_row", "height"), ("chip_col", "width")):
        t = t.withColumn(axis, F.explode(F.sequence(F.lit(0), (F.ceil(F.col(n) / size) - 1).cast("int"))))
    # A few grids are a few rows before they are chips, which are dealt anew.
    t = spread(t, *key, "chip_row", "chip_col")
    # Five by five places over the chip, its corners among them. How far the
    # middle lies from the mean of the corners tells how bent the map is.
    lattice = f"transform(sequence(0, 24), k -> named_struct('r', chip_row * {size} + (k DIV 5) * {size / 4!r}e0, 'c', chip_col * {size} + (k % 5) * {size / 4!r}e0))"
    t = t.withColumn("at", F.explode(F.array(F.expr(_on_source(lattice)))))

    def bent(n: str) -> Column:
        corners = [F.get("at", F.lit(k))[n] for k in (0, 4, 20, 24)]
        return F.abs(F.get("at", F.lit(12))[n] - (corners[0] + corners[1] + corners[2] + corners[3]) / 4)

    for n, out in (("sr", "s_row"), ("sc", "s_col")):
        each = F.col("at")[n]
        low, high = F.array_min(each) - bent(n) - MARGIN, F.array_max(each) + bent(n) + MARGIN
        t = t.withColumn(out, F.sequence(F.greatest(F.floor(low / size), F.lit(0)).cast("int"), F.greatest(F.floor(high / size), F.lit(0)).cast("int")))
    t = t.drop("at").withColumn("s_row", F.explode("s_row")).withColumn("s_col", F.explode("s_col"))
    held = chips.select(*key, F.col("chip_row").cast("int").alias("s_row"), F.col("chip_col").cast("int").alias("s_col"), F.col(value).alias("held"))
    grid = [*key, *GRID, *[f"s_{c}" for c in GRID], "width", "height", "chip_row", "chip_col"]
    under = F.collect_list(F.when(F.col("held").isNotNull(), F.struct((F.col("s_row").cast("long") * (1 << 31) + F.col("s_col")).alias("key"), F.col("held").alias("value"))))
    g = t.join(held, [*key, "s_row", "s_col"], "left").groupBy(*grid).agg(F.map_from_entries(under).alias("under"))
    # Only places on the grid are worked out; a chip on its bound holds few.
    n_rows, n_cols = f"greatest(1, least({size}, height - chip_row * {size}))", f"greatest(1, least({size}, width - chip_col * {size}))"
    cells = f"transform(sequence(0, {n_rows} * {n_cols} - 1), k -> named_struct('r', chip_row * {size} + k DIV {n_cols} + 0.5e0, 'c', chip_col * {size} + k % {n_cols} + 0.5e0))"

    def cell(r: str, c: str) -> str:
        """The value of a source cell; null where there is none."""
        inside = f"{r} >= 0 AND {c} >= 0"
        return f"(CASE WHEN {inside} THEN get(try_element_at(under, {r} DIV {size} * {1 << 31} + {c} DIV {size}), CAST({r} % {size} * {size} + {c} % {size} AS INT)) END)"

    placed = _on_source(cells)
    if method == "nearest":
        out = _mapped(placed, [{"r": "floor(p.sr)", "c": "floor(p.sc)"}, {"v": cell("p.r", "p.c")}])
    else:
        corner = {f"v{i}{j}": f"CAST({cell(f'(p.r + {i})', f'(p.c + {j})')} AS DOUBLE)" for i in (0, 1) for j in (0, 1)}
        w = {f"w{i}{j}": f"({'p.fr' if i else '1e0 - p.fr'}) * ({'p.fc' if j else '1e0 - p.fc'})" for i in (0, 1) for j in (0, 1)}
        total = " + ".join(f"CASE WHEN p.v{k} IS NULL THEN 0e0 ELSE p.w{k} END" for k in ("00", "01", "10", "11"))
        mean = " + ".join(f"CASE WHEN p.v{k} IS NULL THEN 0e0 ELSE p.w{k} * p.v{k} END" for k in ("00", "01", "10", "11"))
        out = _mapped(placed, [{"r": "floor(p.sr - 0.5e0)", "c": "floor(p.sc - 0.5e0)", "fr": "p.sr - 0.5e0 - floor(p.sr - 0.5e0)", "fc": "p.sc - 0.5e0 - floor(p.sc - 0.5e0)"}, corner | w, {"v": f"({mean}) / nullif({total}, 0e0)"}])
    on_grid = f"chip_row * {size} + k DIV {size} < height AND chip_col * {size} + k % {size} < width"
    g = g.select(*key, "chip_row", "chip_col", "width", "height", F.explode(F.array(F.expr(f"transform({out}, p -> p.v)"))).alias("found"))
    values = F.expr(f"transform(sequence(0, {size * size - 1}), k -> CASE WHEN {on_grid} THEN get(found, CAST(k DIV {size} * {n_cols} + k % {size} AS INT)) END)")
    return g.select(*key, "chip_row", "chip_col", values.alias(value))
