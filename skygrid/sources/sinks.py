"""Sinks: partitioned Parquet or CSV, GeoJSON text.

Sinks with partitions overwrite those that they have rows of and leave others;
``sources.outputs`` adds the record of what is done.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.detections import family
from .outputs import write_partitions


def write_detections_by_day(located: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", file_rows: int = 2_000_000) -> None:
    """One folder per family and day; points with typed columns. A day's rows
    are dealt to files of about ``file_rows``, so a hot day is many tasks."""
    d = located.withColumns({"family": family(F.col("source")), "acq_day": F.date_format("day", "yyyyMMdd")})
    files = d.groupBy(F.col("family").alias("n_family"), F.col("acq_day").alias("n_day")).agg(F.ceil(F.count("*") / file_rows).alias("n_files"))
    dealt = d.join(files, (F.col("family") == F.col("n_family")) & (F.col("acq_day") == F.col("n_day"))).drop("n_family", "n_day")
    dealt = dealt.withColumn("n_files", F.pmod(F.xxhash64("lon", "lat", F.monotonically_increasing_id()), F.col("n_files")))
    write_partitions(dealt.repartition("family", "acq_day", "n_files").drop("n_files"), path, ["family", "acq_day"], mode, fmt)


def write_period(located: DataFrame, path: str, mode: str = "overwrite") -> None:
    """All days of a period in order of date, one folder per family."""
    d = located.withColumn("family", family(F.col("source")))
    write_partitions(d.repartitionByRange("family", "day").sortWithinPartitions("family", "day"), path, ["family"], mode)


#: Chips to a row group. Chips of missing cells take few bytes in a file, but
#: all their places in memory; a reader's batch ends with its row group.
GROUP_CHIPS = 64


def write_layers(chips: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Composite layers, as ``plans.imagery.composite_outputs`` gives
    them, by satellite, layer and day."""
    write_partitions(chips, path, ["satellite", "layer", "date_token"], mode, **{"parquet.block.row.count.limit": GROUP_CHIPS})


def _interleaved(row, col, bits: int = 20):
    """A place on a curve that keeps near chips near: the bits of row and column
    in turn."""
    out = F.lit(0).cast("long")
    for i in range(bits):
        for n, c in ((2 * i, col), (2 * i + 1, row)):
            out = out.bitwiseOR(F.shiftleft(F.shiftright(c.cast("long"), i).bitwiseAND(F.lit(1)), n))
    return out


def write_chips(chips: DataFrame, path: str, key: list[str], file_chips: int = 4096, group_bytes: int = 64 << 20, mode: str = "overwrite") -> None:
    """Chips in order of a space-filling curve within each key, so that the
    statistics of files and row groups cover small squares of chips, and
    windows (``readers.read_window``) skip the others. ``file_chips`` chips to
    a file and ``group_bytes`` to a row group, about."""
    at = _interleaved(F.col("chip_row"), F.col("chip_col"))
    files = max(1, -(-chips.count() // file_chips))
    c = chips.withColumn("curve", at).repartitionByRange(files, *key, "curve").sortWithinPartitions(*key, "curve").drop("curve")
    c.write.mode(mode).option("parquet.block.size", group_bytes).parquet(path)


def write_bands(bands: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One folder per band."""
    write_partitions(bands, path, ["band"], mode)


def write_features(features: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A feature a line; ``feature_collection`` makes one document of few."""
    features.select("feature").write.mode(mode).text(path)


def feature_collection(features: DataFrame, most: int = 100_000) -> str:
    """One GeoJSON document, for catalogs of up to ``most`` features."""
    rows = features.select("feature").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} features: write them a line each")
    return '{"type":"FeatureCollection","features":[' + ",".join(r["feature"] for r in rows) + "]}"
