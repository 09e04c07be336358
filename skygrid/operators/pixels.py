"""Masks over pixel tables: one row per cell, one column per band."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.radiometry import ndsi_snow, reflectance

CELL = ["scene_no", "row_idx", "col_idx"]
CLOUD_CLASSES = (1, 2, 3)


def to_reflectance(pixels: DataFrame, bands: list[str], preset: str = "sentinel2") -> DataFrame:
    return pixels.withColumns({b: reflectance(F.col(b), preset) for b in bands})


def join_masks(pixels: DataFrame, cloud: DataFrame, snow: DataFrame | None = None, key: list[str] = CELL, strict: bool = True) -> DataFrame:
    """Cloud classes by cell, snow where there is some. A cell that only the
    image or only the cloud mask has is an error, found by the join itself, as
    is one of the snow mask beside the image; without ``strict`` such cells
    are left out."""
    if not strict:
        j = pixels.join(cloud, key)
        return j.join(snow, key, "left") if snow is not None else j
    j = _same_cells(pixels, cloud, key, "an image and its cloud mask differ in their cells", "full")
    # A right join would lose the image's cells; a full one shows both sides.
    return _same_cells(j, snow, key, "a snow mask has cells that its image lacks", "left of") if snow is not None else j


def _same_cells(a: DataFrame, b: DataFrame, key: list[str], message: str, kind: str) -> DataFrame:
    """Full join of cells; raises where ``b`` has no partner, and for kind
    "full" where ``a`` has none."""
    names = [*a.columns, *[c for c in b.columns if c not in key]]
    j = a.withColumn("in_a", F.lit(True)).join(b.withColumn("in_b", F.lit(True)), key, "full")
    fine = F.col("in_a").isNotNull() & (F.col("in_b").isNotNull() if kind == "full" else F.lit(True))
    return j.where(F.when(fine, F.lit(True)).otherwise(F.raise_error(F.lit(message)).cast("boolean"))).select(*names)


def masked_out(cloud: Column, snow: Column, first_band: Column, bands: list[Column], classes=CLOUD_CLASSES, nodata=0) -> Column:
    """Cloud class in the list, snow, no data in the first band, or 0 in all.
    A cell with no known reason is clear."""
    empty = (F.greatest(*bands) == 0) & (F.least(*bands) == 0) if len(bands) > 1 else bands[0] == 0
    return F.coalesce(cloud.isin(*classes), F.lit(False)) | F.coalesce(snow == 1, F.lit(False)) | F.coalesce(first_band == nodata, F.lit(False)) | F.coalesce(empty, F.lit(False))


def apply_mask(pixels: DataFrame, bands: list[str], classes=CLOUD_CLASSES, cloud: str = "cloud_class", snow: str | None = None, first_band: str | None = None) -> DataFrame:
    s = F.col(snow) if snow else F.lit(None).cast("int")
    out = masked_out(F.col(cloud), s, F.col(first_band or bands[0]), [F.col(b) for b in bands], classes)
    return pixels.withColumn("masked", out).withColumns({b: F.when(~F.col("masked"), F.col(b)) for b in bands})


def snow_mask(pixels: DataFrame, green: str, red: str, swir: str) -> DataFrame:
    """Adds ``snow`` from bands that hold reflectance."""
    return pixels.withColumn("snow", ndsi_snow(F.col(green), F.col(red), F.col(swir)))


def window_slice(pixels: DataFrame, row0: int, row1: int, col0: int, col1: int) -> DataFrame:
    """Rows and columns from the first up to, not with, the second."""
    return pixels.where(F.col("row_idx").between(row0, row1 - 1) & F.col("col_idx").between(col0, col1 - 1))


def split_bands(pixels: DataFrame, bands: list[str], key: list[str]) -> DataFrame:
    """One row per cell and band."""
    return pixels.select(*key, *[F.col(b).cast("double").alias(b) for b in bands]).unpivot(key, bands, "band", "value")
