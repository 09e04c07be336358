"""From raw detection files to daily points, counts and period summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import aoi, detections


def process_period(raw: DataFrame, start: str, end: str, level: str | None = None, edges: DataFrame | None = None, key: list[str] | None = None) -> DataFrame:
    """Typed rows of a period, of the sources of a level, inside the areas of
    ``edges`` if given (then ``key`` names what tells rows apart). Rows without
    a place stay, as they count for their day; writers drop them."""
    t = detections.typed(detections.sources_of_level(raw, level) if level else raw)
    t = detections.in_period(t.where(F.col("day").isNotNull()), start, end)
    if edges is not None:
        if not key:
            raise ValueError("clipping needs the columns that tell rows apart")
        t = t.join(aoi.points_in_areas(t, edges, key).select(*key).distinct(), key, "left_semi")
    return t
