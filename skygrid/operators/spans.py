"""Areas as runs of columns, row by row of a raster."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_spans(edges: DataFrame, grids: DataFrame, key: list[str] | None = None) -> DataFrame:
    """aoi_id, key, row_idx, spans (array of first and last column): the cells of
    a raster whose centre lies in the area, by the rules of ``aoi.holds``.

    edges: in the raster's projection. grids: aoi_id, ``key`` and left_x, top_y, res,
    width, height; an area may have several. Only rows that an edge reaches are looked at, once an edge: the cost
    follows rows and edges, and cells are never written out. An area's row is
    one row here, so a row of a raster must not hold more spans than memory.
    """
    key = key or []
    names = [*key, "left_x", "top_y", "res", "width", "height"]
    e = edges.select("aoi_id", "part", "ring", "x1", "y1", "x2", "y2").join(grids.select("aoi_id", *names), "aoi_id")
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    # One row more to each side; what the centre says decides.
    first = F.greatest(F.lit(0), F.floor((F.col("top_y") - high) / F.col("res") - 0.5))
    last = F.least(F.col("height") - 1, F.ceil((F.col("top_y") - low) / F.col("res") - 0.5))
    e = e.where(first <= last).withColumn("row_idx", F.explode(F.sequence(first.cast("long"), last.cast("long"))))
    e = e.withColumn("y", F.col("top_y") - (F.col("row_idx") + 0.5) * F.col("res")).where((F.col("y") >= low) & (F.col("y") <= high))
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    at = F.coalesce(dx * F.try_divide(F.col("y") - F.col("y1"), dy) + F.col("x1"), F.least("x1", "x2"))
    e = e.withColumns({"at": at, "to": F.when(dy == 0, F.greatest("x1", "x2")).otherwise(at), "crosses": (F.col("y1") > F.col("y")) != (F.col("y2") > F.col("y"))})
    group = ["aoi_id", *names, "row_idx"]
    ring = e.groupBy(*group, "part", "ring").agg(F.array_sort(F.collect_list(F.when(F.col("crosses"), F.col("at")))).alias("cuts"), F.collect_set(F.struct("at", "to")).alias("bounds"))
    # Between each first and second crossing lies the ring's inside; bounds belong to it.
    pairs = F.when(F.size("cuts") > 0, F.transform(F.sequence(F.lit(0), F.floor(F.size("cuts") / 2).cast("int") - 1), lambda i: F.struct(F.get("cuts", 2 * i).alias("at"), F.get("cuts", 2 * i + 1).alias("to")))).otherwise(F.array().cast("array<struct<at:double,to:double>>"))

    def centre(c: Column) -> Column:
        return F.col("left_x") + (c + 0.5) * F.col("res")

    def columns(s: Column) -> Column:
        # Rounded first, then moved by what the centres say.
        a, b = F.ceil((s["at"] - F.col("left_x")) / F.col("res") - 0.5), F.floor((s["to"] - F.col("left_x")) / F.col("res") - 0.5)
        a = F.when(centre(a - 1) >= s["at"], a - 1).when(centre(a) < s["at"], a + 1).otherwise(a)
        b = F.when(centre(b + 1) <= s["to"], b + 1).when(centre(b) > s["to"], b - 1).otherwise(b)
        return F.struct(F.greatest(a, F.lit(0)).cast("long").alias("c0"), F.least(b, F.col("width") - 1).cast("long").alias("c1"))

    held = F.filter(F.transform(F.concat(pairs, "bounds"), columns), lambda s: s["c0"] <= s["c1"])
    ring = ring.select(*group, "part", "ring", held.alias("held")).where(F.size("held") > 0)
    part = ring.groupBy(*group, "part").agg(F.flatten(F.collect_list(F.when(F.col("ring") == 0, F.col("held")))).alias("outer"), F.flatten(F.collect_list(F.when(F.col("ring") > 0, F.col("held")))).alias("holes"))
    area = part.groupBy("aoi_id", *key, "row_idx").agg(F.collect_list(F.struct("outer", "holes")).alias("parts"))
    return area.select("aoi_id", *key, "row_idx", _runs(F.col("parts")).alias("spans")).where(F.size("spans") > 0)


def _runs(parts: Column) -> Column:
    """Runs of columns that lie in a part's outer spans and in none of its
    holes': between neighbouring bounds all columns are alike."""
    every = F.flatten(F.transform(parts, lambda p: F.concat(p["outer"], p["holes"])))
    cuts = F.array_sort(F.array_distinct(F.concat(F.transform(every, lambda s: s["c0"]), F.transform(every, lambda s: s["c1"] + 1))))

    def among(spans: Column, c: Column) -> Column:
        return F.exists(spans, lambda s: (s["c0"] <= c) & (c <= s["c1"]))

    def grow(runs: Column, c: Column) -> Column:
        """``c`` is (first column, column after the last, inside)."""
        joined = F.element_at(runs, -1)["c1"] + 1 == c["c0"]
        more = F.struct(c["c0"].alias("c0"), (c["c1"] - 1).alias("c1"))
        longer = F.concat(F.slice(runs, 1, F.size(runs) - 1), F.array(F.struct(F.element_at(runs, -1)["c0"].alias("c0"), (c["c1"] - 1).alias("c1"))))
        return F.when(~c["inside"], runs).when(F.size(runs) == 0, F.array(more)).when(joined, longer).otherwise(F.concat(runs, F.array(more)))

    between = F.transform(cuts, lambda c, i: F.struct(c.alias("c0"), F.coalesce(F.get(cuts, i + 1), c).alias("c1"), F.exists(parts, lambda p: among(p["outer"], c) & ~among(p["holes"], c)).alias("inside")))
    return F.aggregate(F.filter(between, lambda c: c["c0"] < c["c1"]), F.array().cast("array<struct<c0:bigint,c1:bigint>>"), grow)


def in_spans(cells: DataFrame, spans: DataFrame, key: list[str], row: str = "row_idx", col: str = "col_idx") -> DataFrame:
    """Adds ``in_area`` to cells: one equi-join on ``key`` (aoi_id and what names
    the raster) and row, then a look into the row's spans. A cell comes back
    once."""
    s = spans.select(*key, "row_idx", "spans").alias("s")
    same = F.col(f"c.{row}") == F.col("s.row_idx")
    for k in key:
        same = same & F.col(f"c.{k}").eqNullSafe(F.col(f"s.{k}"))
    inside = F.coalesce(F.exists("s.spans", lambda r: F.col(f"c.{col}").between(r["c0"], r["c1"])), F.lit(False))
    return cells.alias("c").join(s, same, "left").select("c.*", inside.alias("in_area"))
