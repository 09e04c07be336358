"""Pixel arithmetic on Columns. Stacks are FLOAT: quotients are cast back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Scale and offset from digital numbers to reflectance.
PRESETS = {"sentinel2": (0.0001, 0.0), "landsat8": (0.0000275, -0.2), "landsat9": (0.0000275, -0.2)}
SNOW_UNDEFINED = 255
NDSI_THRESHOLD = 0.4
RED_THRESHOLD = 0.2


def flt(x: float) -> Column:
    return F.lit(x).cast("float")


def nodata_to_null(band: Column, nodata=0) -> Column:
    return F.nullif(band, F.lit(nodata))


def parse_baseline(*texts: Column) -> Column:
    """First text that is a number after trimming."""
    return F.coalesce(*[F.expr("try_cast(NULL AS DOUBLE)"), *[F.nullif(F.trim(t), F.lit("")).try_cast("double") for t in texts]])


def dn_offset(baseline: Column) -> Column:
    """1000 from processing baseline 4 on, else 0."""
    return F.when(baseline >= 4.0, F.lit(1000.0)).otherwise(F.lit(0.0))


def dn_correct(dn: Column, offset: Column) -> Column:
    """Offset taken off, not below 0; a 0 stays no data."""
    return F.when(dn == 0, F.lit(0.0)).otherwise(F.greatest(dn - offset, F.lit(0.0)))


def reflectance(dn: Column, preset: str = "sentinel2") -> Column:
    scale, offset = PRESETS[preset]
    r = dn.cast("float") * flt(scale)
    if offset:
        r = r + flt(offset)
    return F.least(F.greatest(r, flt(0.0)), flt(1.0))


def ndsi_snow(green: Column, red: Column, swir: Column, ndsi_threshold: float = NDSI_THRESHOLD, red_threshold: float = RED_THRESHOLD) -> Column:
    """1 snow, 0 none, 255 where green and swir add up to 0."""
    total = green + swir
    ndsi = ((green - swir) / F.nullif(total, flt(0.0))).cast("float")
    return F.when(total == flt(0.0), SNOW_UNDEFINED).when((ndsi > flt(ndsi_threshold)) & (red > flt(red_threshold)), 1).otherwise(0)


def scale_offset(dn: Column, scale: Column, offset: Column, fill: Column) -> Column:
    """Fill value to null, others scaled; a missing offset is 0, a missing
    scale an error for the caller (see ``operators.checks``)."""
    value = (dn.cast("float").cast("double") * scale + F.coalesce(offset, F.lit(0.0))).cast("float")
    return F.when(fill.isNull() | (dn != fill), value)


def widest_integer(bits: Column) -> Column:
    """Name of the signed type that holds unsigned values of so many bits."""
    return F.when(bits <= 8, "smallint").when(bits <= 16, "int").otherwise("bigint")
