"""Areas of interest: edges, boxes, and which points and boxes they hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..plans.scratch import cut
from .sizes import small, spread

_GEOMETRY = "struct<type:string,coordinates:string>"
GEOJSON = f"struct<type:string,coordinates:string,geometry:{_GEOMETRY},features:array<struct<geometry:{_GEOMETRY}>>>"
EPS = 1e-12
#: An area's box is about this many cells wide or high.
CELLS_ACROSS = 32
#: Areas of so few edges are written out as one expression.
FEW_EDGES = 64
#: Lists of areas and their shapes are broadcast up to this length.
MEMBER_ROWS = 1_000_000
EDGE = ["x1", "y1", "x2", "y2"]
BOX = ["west", "south", "east", "north"]


def geometry(j: Column) -> Column:
    """(type, coordinates as text) of a parsed GeoJSON text: a collection's
    first feature, a feature, or a bare geometry. Null unless (Multi)Polygon."""
    g = F.when(j["type"] == "FeatureCollection", F.try_element_at(j["features"], F.lit(1))["geometry"]).when(j["type"] == "Feature", j["geometry"]).otherwise(F.struct(j["type"].alias("type"), j["coordinates"].alias("coordinates")))
    return F.when(g["type"].isin("Polygon", "MultiPolygon") & g["coordinates"].isNotNull(), g)


def rings(g: Column) -> Column:
    """Coordinates as parts of rings of points, first two numbers of each."""
    multi = F.from_json(g["coordinates"], "array<array<array<array<double>>>>")
    single = F.from_json(g["coordinates"], "array<array<array<double>>>")
    return F.when(g["type"] == "MultiPolygon", multi).otherwise(F.array(single))


def aoi_edges(areas: DataFrame, text: str = "geojson", strict: bool = True) -> DataFrame:
    """aoi_id, part, ring, edge, x1, y1, x2, y2. Rings are closed if they are
    not; a ring of fewer than three points holds nothing and gives no edges.
    ``strict`` raises on a text without polygon, else it gives no rows."""
    g = areas.select("aoi_id", F.from_json(text, GEOJSON).alias("j")).select("aoi_id", geometry(F.col("j")).alias("g"))
    if strict:
        g = g.select("aoi_id", F.coalesce("g", F.raise_error(F.lit("no Polygon or MultiPolygon")).cast(_GEOMETRY)).alias("g"))
    parts = g.select("aoi_id", rings(F.col("g")).alias("parts")).select("aoi_id", F.posexplode("parts").alias("part", "rings"))
    ring = parts.select("aoi_id", "part", F.posexplode("rings").alias("ring", "points")).where(F.size("points") >= 3)
    pts = ring.select("aoi_id", "part", "ring", "points", F.posexplode("points").alias("edge", "p"))
    nxt = F.get("points", (F.col("edge") + 1) % F.size("points"))
    e = pts.select("aoi_id", "part", "ring", "edge", F.col("p")[0].alias("x1"), F.col("p")[1].alias("y1"), nxt[0].alias("x2"), nxt[1].alias("y2"))
    return e.where((F.col("x1") != F.col("x2")) | (F.col("y1") != F.col("y2")))


def aoi_bbox(edges: DataFrame) -> DataFrame:
    return edges.groupBy("aoi_id").agg(F.min("x1").alias("west"), F.min("y1").alias("south"), F.max("x1").alias("east"), F.max("y1").alias("north"))


def shapes(edges: DataFrame) -> DataFrame:
    """One row per area: its box, and its parts as (outer ring, holes) of
    edges. An area's edges come from one GeoJSON text, so a row is as large as
    its text."""
    low, high = {"west": "x1", "south": "y1"}, {"east": "x1", "north": "y1"}
    box = [F.min(c).alias(n) for n, c in low.items()] + [F.max(c).alias(n) for n, c in high.items()]
    again = [F.min(n).alias(n) for n in low] + [F.max(n).alias(n) for n in high]
    ring = edges.groupBy("aoi_id", "part", "ring").agg(F.collect_list(F.struct(*EDGE)).alias("e"), *box)
    part = ring.groupBy("aoi_id", "part").agg(F.max(F.when(F.col("ring") == 0, F.col("e"))).alias("outer"), F.collect_list(F.when(F.col("ring") > 0, F.col("e"))).alias("holes"), *again)
    # A part without outer ring holds nothing, so it is left out.
    return part.where(F.col("outer").isNotNull()).groupBy("aoi_id").agg(F.collect_list(F.struct("outer", "holes")).alias("parts"), *again)


def _digest() -> list[Column]:
    """Sums over an area's edges that are the same for the same edges in any
    order, and for others only by chance (two hashes of 64 bits, each in halves
    so that no sum overflows). They are added up before edges are shuffled."""
    unknown = sum((F.when(F.col(c).isNull(), 1 << i).otherwise(0) for i, c in enumerate(("part", "ring", *EDGE))), F.lit(0))
    hashes = [F.xxhash64(F.lit(n), unknown, "part", "ring", *EDGE) for n in (1, 2)]
    halves = [half for h in hashes for half in (F.shiftright(h, 32), h.bitwiseAND(F.lit(0xFFFFFFFF)))]
    return [F.count(F.lit(1)).alias("d0"), *[F.sum(half).alias(f"d{i}") for i, half in enumerate(halves, 1)]]


DIGEST = ["d0", "d1", "d2", "d3", "d4"]


def alike(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(edges of one area of each shape, members: aoi_id, shape). Areas of the
    same edges are one shape, named after its least aoi_id, so that shapes are
    met once however many areas have them; ``of_members`` gives the areas."""
    digests = cut(edges.groupBy("aoi_id").agg(*_digest()), "digests")
    first = cut(digests.groupBy(*DIGEST).agg(F.min("aoi_id").alias("shape")), "shapes")
    # Shapes are mostly few, so that neither edges nor areas move to meet them.
    members = digests.join(small(first, MEMBER_ROWS), DIGEST).select("aoi_id", "shape")
    return edges.join(small(first.select(F.col("shape").alias("aoi_id")), MEMBER_ROWS), "aoi_id", "left_semi"), members


#: Areas of one shape that a row names.
AREAS_A_ROW = 1024


def of_members(found: DataFrame, members: DataFrame) -> DataFrame:
    """Rows of shapes as rows of all areas that have them: aoi_id for shape.
    Areas meet the rows in lists, which is one look-up for many areas."""
    slots = members.groupBy("shape").agg(F.ceil(F.count("*") / AREAS_A_ROW).alias("slots"))
    slot = F.pmod(F.xxhash64("aoi_id"), F.col("slots"))
    lists = members.join(slots, "shape").groupBy("shape", slot.alias("slot")).agg(F.collect_list("aoi_id").alias("aoi_ids")).drop("slot")
    if members.limit(MEMBER_ROWS + 1).count() <= MEMBER_ROWS:
        lists = F.broadcast(lists)
    listed = found.join(lists, "shape").drop("shape")
    return listed.select(F.explode("aoi_ids").alias("aoi_id"), *[c for c in listed.columns if c != "aoi_ids"])


def _hits(e: Column, x: Column, y: Column) -> tuple[Column, Column]:
    """Whether a point lies on an edge, and whether the edge crosses the ray
    from the point to the right."""
    dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
    on = (F.abs((x - e["x1"]) * dy - (y - e["y1"]) * dx) <= EPS) & x.between(F.least(e["x1"], e["x2"]) - EPS, F.greatest(e["x1"], e["x2"]) + EPS) & y.between(F.least(e["y1"], e["y2"]) - EPS, F.greatest(e["y1"], e["y2"]) + EPS)
    crosses = ((e["y1"] > y) != (e["y2"] > y)) & F.coalesce(x < dx * F.try_divide(y - e["y1"], dy) + e["x1"], F.lit(False))
    return on, crosses


def holds(parts: Column, x: Column, y: Column) -> Column:
    """Whether an area's parts hold a point: even-odd per ring; an outer bound
    is inside, a hole's bound outside. Rings are walked inside the row."""

    def in_ring(ring: Column) -> Column:
        def step(state: Column, e: Column) -> Column:
            on, crosses = _hits(e, x, y)
            return state.bitwiseXOR(crosses.cast("int")).bitwiseOR(F.when(on, 2).otherwise(0))

        return F.aggregate(ring, F.lit(0), step) > 0

    return F.exists(parts, lambda p: in_ring(p["outer"]) & ~F.exists(p["holes"], in_ring))


def holds_written_out(edges: DataFrame, x: Column, y: Column, most: int = FEW_EDGES) -> Column | None:
    """``holds`` for all areas of ``edges`` together as one expression, which
    needs neither join nor shuffle; None if they have more than ``most`` edges."""
    rows = edges.select("aoi_id", "part", "ring", *EDGE).limit(most + 1).collect()
    if len(rows) > most:
        return None
    parts: dict[tuple, dict[int, list]] = {}
    for r in rows:
        parts.setdefault((r["aoi_id"], r["part"]), {}).setdefault(r["ring"], []).append({c: F.lit(r[c]) for c in EDGE})

    def in_ring(ring: list) -> Column:
        on, odd = F.lit(False), F.lit(False)
        for e in ring:
            o, c = _hits(e, x, y)
            on, odd = on | o, odd != c
        return on | odd

    found = F.lit(False)
    for held in parts.values():
        inside = in_ring(held.get(0, []))
        for no, ring in held.items():
            if no > 0:
                inside = inside & ~in_ring(ring)
        found = found | inside
    return F.coalesce(found, F.lit(False))


def _level() -> Column:
    """The power of two that is the side of a cell of an area's box."""
    return F.ceil(F.log2(F.greatest(F.col("east") - F.col("west"), F.col("north") - F.col("south"), F.lit(1e-9)) / CELLS_ACROSS)).cast("int")


def _spread(shaped: DataFrame, key: str) -> DataFrame:
    """Areas dealt to all tasks. They are few bytes before they are taken apart
    into cells; a stated number keeps adaptive execution from judging by that."""
    return spread(shaped, key)


def _kept(parts: Column, wanted) -> Column:
    """Parts with those edges of their rings that are wanted."""
    return F.transform(parts, lambda p: F.struct(F.filter(p["outer"], wanted).alias("outer"), F.transform(p["holes"], lambda h: F.filter(h, wanted)).alias("holes")))


def area_cells(edges: DataFrame) -> DataFrame:
    """level, cx, cy, aoi_id, near: the cells of each area's box that it meets.

    A cell's side is 2 ** level, so that a box has few cells however large it
    is. A cell that no edge touches lies inside as a whole (``near`` is null)
    or is left out; the others hold the edges that decide about their points:
    those in their rows that do not end left of them. Edges are dealt to rows
    of cells first, so each is looked at once a row and not once a cell.
    """
    s = _spread(shapes(edges), "aoi_id")
    s = s.withColumn("level", _level()).withColumn("side", F.pow(F.lit(2.0), F.col("level")))
    s = s.withColumns({"cx0": F.floor(F.col("west") / F.col("side")), "cx1": F.floor(F.col("east") / F.col("side"))})
    s = s.withColumn("cy", F.explode(F.sequence(F.floor(F.col("south") / F.col("side")), F.floor(F.col("north") / F.col("side")))))
    s = s.withColumns({"y0": F.col("cy") * F.col("side"), "ye": F.col("cy") * F.col("side") + F.col("side")})

    def in_row(e: Column) -> Column:
        return (F.greatest(e["y1"], e["y2"]) >= F.col("y0") - 2 * EPS) & (F.least(e["y1"], e["y2"]) <= F.col("ye") + 2 * EPS)

    # Expanding a list of one keeps the edges from being worked out once a use.
    s = s.select("aoi_id", "level", "side", "cx0", "cx1", "cy", "y0", "ye", F.explode(F.array(_kept(F.col("parts"), in_row))).alias("row"))
    s = s.withColumn("cx", F.explode(F.sequence("cx0", "cx1"))).withColumn("x0", F.col("cx") * F.col("side")).withColumn("xe", F.col("x0") + F.col("side"))

    def ahead(e: Column) -> Column:
        return F.greatest(e["x1"], e["x2"]) >= F.col("x0") - 2 * EPS

    def touches(e: Column) -> Column:
        return F.least(e["x1"], e["x2"]) <= F.col("xe") + 2 * EPS

    s = s.select("aoi_id", "level", "cx", "cy", "x0", "y0", "xe", "ye", F.explode(F.array(_kept(F.col("row"), ahead))).alias("near"))
    touched = F.exists("near", lambda p: F.exists(p["outer"], touches) | F.exists(p["holes"], lambda h: F.exists(h, touches)))
    s = s.withColumn("touched", touched)
    inside = holds(F.col("near"), (F.col("x0") + F.col("xe")) / 2, (F.col("y0") + F.col("ye")) / 2)
    return s.where(F.col("touched") | inside).select("level", "cx", "cy", "aoi_id", F.when(F.col("touched"), F.col("near")).alias("near"))


def points_in_areas(points: DataFrame, edges: DataFrame, key: list[str], x: str = "lon", y: str = "lat") -> DataFrame:
    """key, aoi_id of the points inside, by the rules of ``holds``; a row of
    ``points`` that an area holds gives one row.

    One equi-join on cells, which adaptive execution can split or broadcast;
    points of whole cells need no test, others are tested in the row.
    """
    few, members = alike(edges)
    # One level per power of two of box sizes: a handful, whatever the data.
    levels = sorted(r[0] for r in aoi_bbox(few).select(_level().alias("level")).distinct().collect())
    cells = area_cells(few).withColumnRenamed("aoi_id", "shape")
    return of_members(points_in_cells(points, cells, levels, key, x, y, "shape"), members).select(*key, "aoi_id")


def points_in_cells(points: DataFrame, cells: DataFrame, levels: list[int], key: list[str], x: str = "lon", y: str = "lat", of: str = "aoi_id") -> DataFrame:
    """``points_in_areas`` with the ``area_cells`` of areas, which may have been
    stored, and the levels that occur in them. ``of`` names their ids."""
    cells = cells.withColumnsRenamed({"level": "c_level", "cx": "c_cx", "cy": "c_cy"})
    p = points.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(*key, F.col(x).cast("double").alias("px"), F.col(y).cast("double").alias("py"))
    p = p.withColumn("p_level", F.explode(F.array(*map(F.lit, levels)) if levels else F.array().cast("array<int>"))) if len(levels) != 1 else p.withColumn("p_level", F.lit(levels[0]))
    side = F.pow(F.lit(2.0), F.col("p_level"))
    p = p.withColumns({"p_cx": F.floor(F.col("px") / side), "p_cy": F.floor(F.col("py") / side)})
    near = p.join(cells, (F.col("p_level") == F.col("c_level")) & (F.col("p_cx") == F.col("c_cx")) & (F.col("p_cy") == F.col("c_cy")))
    return near.where(F.col("near").isNull() | holds(F.col("near"), F.col("px"), F.col("py"))).select(*key, of)


def boxes_meet(a: dict[str, Column], b: dict[str, Column]) -> Column:
    return (a["west"] <= b["east"]) & (a["east"] >= b["west"]) & (a["south"] <= b["north"]) & (a["north"] >= b["south"])


def _cells(df: DataFrame, size: float, prefix: str = "") -> DataFrame:
    w, s, e, n = (F.col(prefix + k) for k in BOX)
    df = df.withColumn("cx", F.explode(F.sequence(F.floor(w / size), F.floor(e / size))))
    return df.withColumn("cy", F.explode(F.sequence(F.floor(s / size), F.floor(n / size))))


def boxes_in_areas(scenes: DataFrame, edges: DataFrame, exact: bool = True, size: float = 0.5) -> DataFrame:
    """item_id, aoi_id of the scene boxes that meet an area: by box, and if
    ``exact`` with the area itself (an edge of the area meets the box, or the
    box lies inside). Equal boxes and equal areas are met once."""
    few, members = alike(edges)
    return of_members(boxes_in_shapes(scenes, few, exact, size), members).select("item_id", "aoi_id")


def boxes_in_shapes(scenes: DataFrame, few: DataFrame, exact: bool = True, size: float = 0.5) -> DataFrame:
    """The columns of ``scenes`` and shape, of the boxes that meet an area of
    ``few`` (``alike``'s edges).

    Boxes meet by cells; a pair is taken in the cell of the lower left corner
    of what both boxes share, so it comes once and nothing is grouped.
    """
    # Pairs cost far more than scenes, so scenes are spread before they meet;
    # a stated number keeps adaptive execution from judging by their bytes.
    tasks = int(scenes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    boxes = scenes.select(*BOX).repartition(tasks, *BOX).distinct()
    return scenes.repartition(tasks, *BOX).join(_boxes_met(boxes, few, exact, size), BOX)


def _boxes_met(boxes: DataFrame, few: DataFrame, exact: bool, size: float) -> DataFrame:
    a = (shapes(few) if exact else aoi_bbox(few)).withColumnsRenamed({c: f"a_{c}" for c in BOX} | {"aoi_id": "shape"})
    meet = boxes_meet({c: F.col(c) for c in BOX}, {c: F.col(f"a_{c}") for c in BOX})
    once = (F.col("cx") == F.floor(F.greatest("west", "a_west") / size)) & (F.col("cy") == F.floor(F.greatest("south", "a_south") / size))
    near = _cells(boxes, size).join(_cells(_spread(a, "shape"), size, "a_"), ["cx", "cy"]).where(meet & once)
    if not exact:
        return near.select(*BOX, "shape")
    corners = [(F.col(x), F.col(y)) for x in ("west", "east") for y in ("south", "north")]

    def in_box(e: Column) -> Column:
        # An edge meets the box if its own box does and the box's corners
        # don't all lie on one side of it.
        side = [(e["x2"] - e["x1"]) * (y - e["y1"]) - (e["y2"] - e["y1"]) * (x - e["x1"]) for x, y in corners]
        over = (F.least(e["x1"], e["x2"]) <= F.col("east") + EPS) & (F.greatest(e["x1"], e["x2"]) >= F.col("west") - EPS) & (F.least(e["y1"], e["y2"]) <= F.col("north") + EPS) & (F.greatest(e["y1"], e["y2"]) >= F.col("south") - EPS)
        return over & (F.least(*side) <= EPS) & (F.greatest(*side) >= -EPS)

    inside = F.exists("parts", lambda p: F.exists(p["outer"], in_box) | F.exists(p["holes"], lambda h: F.exists(h, in_box)))
    # A box that no edge meets lies inside or outside as a whole.
    return near.where(inside | holds(F.col("parts"), *corners[0])).select(*BOX, "shape")


def _meet(a: Column, b: Column) -> Column:
    """Whether two edges share a point: their boxes do, and neither lies on one
    side of the other."""

    def side(e: Column, x: Column, y: Column) -> Column:
        return (e["x2"] - e["x1"]) * (y - e["y1"]) - (e["y2"] - e["y1"]) * (x - e["x1"])

    def over(p: str, q: str) -> Column:
        return (F.least(a[p], a[q]) <= F.greatest(b[p], b[q]) + EPS) & (F.greatest(a[p], a[q]) >= F.least(b[p], b[q]) - EPS)

    def astride(e: Column, f: Column) -> Column:
        s1, s2 = side(e, f["x1"], f["y1"]), side(e, f["x2"], f["y2"])
        return (F.least(s1, s2) <= EPS) & (F.greatest(s1, s2) >= -EPS)

    return over("x1", "x2") & over("y1", "y2") & astride(a, b) & astride(b, a)


def polygons_in_areas(footprints: DataFrame, edges: DataFrame, size: float = 0.5) -> DataFrame:
    """item_id, aoi_id of the footprints (edges, with the item's id as
    ``aoi_id``) that share a point with an area; bounds belong to both.

    Boxes meet by cells, each pair in the cell of the lower left corner of what
    their boxes share, so it comes once. Of both only the edges in that shared
    box are tried against each other; where none meet, one holds a part of the
    other as a whole or they are apart (a footprint in a hole is). Equal
    footprints and equal areas are met once.
    """
    (few_items, items), (few, members) = alike(footprints), alike(edges)
    met = _polygons_met(few_items, few, size)
    # Items are many, so they are dealt out anew before they are multiplied.
    of_items = _spread(items.withColumnsRenamed({"aoi_id": "item_id", "shape": "item_shape"}), "item_shape").join(met, "item_shape")
    return of_members(of_items, members).select("item_id", "aoi_id")


def _polygons_met(footprints: DataFrame, edges: DataFrame, size: float) -> DataFrame:
    """item_shape, shape of the footprints that meet an area."""
    f = _spread(shapes(footprints).withColumnRenamed("aoi_id", "item_shape"), "item_shape")
    a = shapes(edges).withColumnsRenamed({c: f"a_{c}" for c in (*BOX, "parts")} | {"aoi_id": "shape"})
    meet = boxes_meet({c: F.col(c) for c in BOX}, {c: F.col(f"a_{c}") for c in BOX})
    once = (F.col("cx") == F.floor(F.greatest("west", "a_west") / size)) & (F.col("cy") == F.floor(F.greatest("south", "a_south") / size))
    near = _cells(f, size).join(_cells(a, size, "a_"), ["cx", "cy"]).where(meet & once)
    shared = {"s_west": F.greatest("west", "a_west"), "s_south": F.greatest("south", "a_south"), "s_east": F.least("east", "a_east"), "s_north": F.least("north", "a_north")}

    def in_shared(e: Column) -> Column:
        return (F.greatest(e["x1"], e["x2"]) >= F.col("s_west") - EPS) & (F.least(e["x1"], e["x2"]) <= F.col("s_east") + EPS) & (F.greatest(e["y1"], e["y2"]) >= F.col("s_south") - EPS) & (F.least(e["y1"], e["y2"]) <= F.col("s_north") + EPS)

    def tried(parts: str) -> Column:
        rings = F.flatten(F.transform(parts, lambda p: F.concat(F.array(p["outer"]), p["holes"])))
        return F.flatten(F.transform(rings, lambda r: F.filter(r, in_shared)))

    near = near.withColumns(shared).select("item_shape", "shape", "parts", "a_parts", F.explode(F.array(F.struct(tried("parts").alias("mine"), tried("a_parts").alias("theirs")))).alias("e"))
    cross = F.exists(F.col("e")["mine"], lambda a: F.exists(F.col("e")["theirs"], lambda b: _meet(a, b)))

    def some_inside(inner: str, outer: str) -> Column:
        return F.exists(inner, lambda p: holds(F.col(outer), p["outer"][0]["x1"], p["outer"][0]["y1"]))

    return near.where(cross | some_inside("parts", "a_parts") | some_inside("a_parts", "parts")).select("item_shape", "shape")


#: How far, in metres, a projected edge may lie beside its chord.
TOLERANCE = 0.01


def _split(edges: DataFrame, to, tolerance: float) -> DataFrame:
    """Edges in degrees, split into equal pieces where the projected edge, at
    its quarters, lies further than ``tolerance`` beside its chord. The
    distance falls with the square of the pieces."""
    x, y = to("(x1 + (x2 - x1) * (q / 4e0))", "(y1 + (y2 - y1) * (q / 4e0))")
    e = edges.withColumn("at", F.expr(f"transform(sequence(0, 4), q -> named_struct('x', {x}, 'y', {y}))"))
    beside = F.array_max(F.transform(F.sequence(F.lit(1), F.lit(3)), lambda q: F.hypot(*[F.get("at", q)[c] - F.col("at")[0][c] - (F.col("at")[4][c] - F.col("at")[0][c]) * q / 4.0 for c in ("x", "y")])))
    n = F.greatest(F.lit(1), F.ceil(F.sqrt(1.2 * beside / tolerance))).cast("int")
    e = e.withColumn("pieces", n).drop("at").withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))

    def place(a: str, b: str, k: Column) -> Column:
        return F.when(k == 0, F.col(a)).when(k == F.col("pieces"), F.col(b)).otherwise(F.col(a) + (F.col(b) - F.col(a)) * k / F.col("pieces"))

    k = F.col("piece")
    return e.withColumns({"x1": place("x1", "x2", k), "y1": place("y1", "y2", k), "x2": place("x1", "x2", k + 1), "y2": place("y1", "y2", k + 1)}).drop("pieces", "piece")


def project_edges(edges: DataFrame, crs: str, tolerance: float = TOLERANCE) -> DataFrame:
    """Edges in degrees as edges in metres: of the sinusoidal grid for
    "sinusoidal", else of the UTM zone whose EPSG code ``crs`` is (a number or
    a column of ``edges``). Straight lines in degrees are none in metres, so
    edges are split until no piece lies further than ``tolerance`` metres
    beside its chord. Neighbouring pieces share their ends exactly."""

    def to(lon: str, lat: str) -> tuple[str, str]:
        return geo.to_sinusoidal(lon, lat) if crs == "sinusoidal" else geo.to_utm(lon, lat, crs)

    # A second round splits what quarters of the whole edge did not show.
    e = _split(_split(edges, to, tolerance), to, tolerance)
    ends = F.explode(F.array(F.struct(*[F.expr(t).alias(n) for i in (1, 2) for n, t in zip((f"x{i}", f"y{i}"), to(f"x{i}", f"y{i}"))])))
    e = e.withColumn("metres", ends)
    return e.withColumns({c: F.col("metres")[c] for c in EDGE}).drop("metres").where((F.col("x1") != F.col("x2")) | (F.col("y1") != F.col("y2")))


def covering_tiles(edges: DataFrame, tolerance: float = 1.0) -> DataFrame:
    """aoi_id, h, v: the sinusoidal tiles that share a point with an area given
    in degrees. Tiles are squares in metres, curved in degrees, so the area is
    projected, and met with the 36 x 18 tiles as boxes, grown by ``tolerance``
    metres: an area whose bound is a tile's meets the tiles on both sides."""
    few, members = alike(edges)
    return of_members(tiles_of_shapes(few, tolerance), members).select("aoi_id", "h", "v")


def tiles_of_shapes(few: DataFrame, tolerance: float = 1.0) -> DataFrame:
    """shape, h, v: ``covering_tiles`` of ``alike``'s edges."""
    # Edges are few bytes before they are projected and split.
    m = project_edges(_spread(few, "aoi_id"), "sinusoidal", tolerance)
    u = {c: (F.col(c) - F.lit(geo.SINU_X_MIN)) / geo.TILE_SIZE for c in ("x1", "x2")} | {c: (F.lit(geo.SINU_Y_MAX) - F.col(c)) / geo.TILE_SIZE for c in ("y1", "y2")}
    h, v = F.expr("id DIV 18"), F.expr("id % 18")
    grown = tolerance / geo.TILE_SIZE
    grid = few.sparkSession.range(36 * 18).select(F.col("id").alias("item_id"), *[c.cast("double").alias(n) for n, c in zip(BOX, (h - grown, v - grown, h + 1 + grown, v + 1 + grown))])
    met = boxes_in_shapes(grid, m.withColumns(u), size=1.0)
    return met.select("shape", F.expr("CAST(item_id DIV 18 AS INT)").alias("h"), F.expr("CAST(item_id % 18 AS INT)").alias("v"))


def utm_of_areas(boxes: DataFrame) -> DataFrame:
    """Adds the EPSG code of the UTM zone of each box's centre."""
    return boxes.withColumn("epsg", F.expr(geo.utm_epsg("((west + east) / 2e0)", "((south + north) / 2e0)")))
