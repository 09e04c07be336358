"""Names, dates and typed fields out of text columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def scene_datetime(props: Column, strict: bool = True) -> Column:
    """``datetime``, else ``start_datetime``; a Z is UTC. If both are absent it
    is an error, or null if not ``strict``."""
    text = F.coalesce(F.nullif(F.try_element_at(props, F.lit("datetime")), F.lit("")), F.nullif(F.try_element_at(props, F.lit("start_datetime")), F.lit("")))
    if strict:
        text = F.coalesce(text, F.raise_error(F.lit("a scene has no datetime")).cast("string"))
    return F.try_to_timestamp(text)


def scene_tag(item_id: Column) -> Column:
    """Letters and digits of an id, the last 24; SCENE if none."""
    kept = F.regexp_replace(item_id, "[^A-Za-z0-9]", "")
    return F.coalesce(F.nullif(F.right(kept, F.lit(24)), F.lit("")), F.lit("SCENE"))


def platform_prefix(collection: Column, platform: Column) -> Column:
    landsat = F.when(F.lower(platform).contains("landsat-9"), "L9C").otherwise("L8C")
    return F.when(collection == "sentinel-2-l2a", "S2C").otherwise(landsat)


def platform_preset(collection: Column, platform: Column) -> Column:
    landsat = F.when(F.lower(platform).contains("landsat-9"), "landsat9").otherwise("landsat8")
    return F.when(collection == "sentinel-2-l2a", "sentinel2").otherwise(landsat)


def granule_date(filename: Column) -> Column:
    """The A{year}{day of year} part of a file name; null if there is none."""
    return F.try_to_date(F.nullif(F.regexp_extract(filename, r"\.A(\d{7})\.", 1), F.lit("")), "yyyyDDD")


def granule_tile(filename: Column) -> Column:
    return F.nullif(F.regexp_extract(filename, r"\.(h\d{2}v\d{2})\.", 1), F.lit(""))


def tile_index(tile: Column, axis: str) -> Column:
    return F.nullif(F.regexp_extract(tile, rf"{axis}(\d+)", 1), F.lit("")).cast("int")


def pick_link(links: Column) -> Column:
    """First link to an HDF file, else the first link; null if none."""
    hdf = F.filter(links, lambda x: F.lower(x).rlike(r"\.(hdf|h5|hdf5)$"))
    return F.coalesce(F.try_element_at(hdf, F.lit(1)), F.try_element_at(links, F.lit(1)))


def coordinate(*texts: Column) -> Column:
    """First non-empty text as a number; null if that one is no number."""
    return F.coalesce(*[F.nullif(t, F.lit("")) for t in texts]).try_cast("double")


def detection_date(text: Column) -> Column:
    return F.try_to_date(F.nullif(text, F.lit("")), "yyyy-M-d")


def first_number(props: Column, keys: Sequence[str]) -> Column:
    """The first of some properties that is a number."""
    return F.coalesce(*[F.try_element_at(props, F.lit(k)).try_cast("double") for k in keys])
