"""Detections as a stream of CSV or Parquet files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import aoi
from ..operators.detections import located, typed
from ..plans.scratch import cut

IDENTITY = ["source", "latitude", "longitude", "acq_date", "acq_time"]


def daily_counts(stream: DataFrame, bbox: tuple[float, float, float, float] | None = None, delay: str = "1 day", identity: list[str] = IDENTITY) -> DataFrame:
    """Detections per source and day. Rows later than ``delay`` are dropped;
    rows that a repeated poll brings again within it count once."""
    t = located(typed(stream))
    stamp = F.try_to_timestamp(F.concat_ws(" ", "acq_date", F.lpad("acq_time", 4, "0")), F.lit("yyyy-MM-dd HHmm"))
    t = t.withColumn("acq_ts", stamp).where(F.col("acq_ts").isNotNull())
    if bbox:
        west, south, east, north = map(float, bbox)
        t = t.where(F.col("lon").between(west, east) & F.col("lat").between(south, north))
    t = t.withWatermark("acq_ts", delay).dropDuplicatesWithinWatermark(identity)
    g = t.groupBy(F.window("acq_ts", "1 day"), "source").agg(F.count("*").alias("n"))
    return g.select(F.to_date("window.start").alias("day"), "source", "n")


def run_to_table(counts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Works off what is there; each batch is kept as a folder of updates, and
    a replayed batch overwrites its own."""

    def keep(batch: DataFrame, no: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={no}")

    return counts.writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(keep).start()


def poll(spark, folder: str, schema, out: str, checkpoint: str, **options) -> None:
    """One poll: works off the files that came since the last one and keeps
    the watermark and the seen identities in the checkpoint."""
    arrived = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(folder)
    run_to_table(daily_counts(arrived, **options), out, checkpoint).awaitTermination()


class AreaCells:
    """The cells of areas that may change while a stream runs. They are worked
    out and stored anew only when the areas' content differs."""

    def __init__(self, edges: Callable[[], DataFrame]):
        self.edges, self.version, self.cells, self.levels, self.members = edges, None, None, [], None

    def now(self) -> tuple[DataFrame, list[int], DataFrame]:
        """The cells of each different shape, their levels, and the areas of
        each shape."""
        e = self.edges()
        content = F.xxhash64("aoi_id", "part", "ring", *aoi.EDGE)
        version = tuple(e.agg(F.count("*"), F.bit_xor(content), F.sum(F.shiftright(content, 20))).first())
        if version != self.version:
            few, self.members = aoi.alike(e)
            self.cells = cut(aoi.area_cells(few).withColumnRenamed("aoi_id", "shape"), "area-cells")
            self.levels = sorted(r["level"] for r in self.cells.select("level").distinct().collect())
            self.version = version
        return self.cells, self.levels, self.members


def poll_areas(spark, folder: str, schema, areas: AreaCells, out: str, checkpoint: str, delay: str = "1 day", identity: list[str] = IDENTITY) -> None:
    """One poll, clipped to areas: each row that came, once, is joined with the
    areas as they are when its batch runs. A batch keeps its counts per day,
    source and area in a folder of its own, which a replay overwrites;
    ``area_counts`` adds them up."""
    t = located(typed(spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(folder)))
    stamp = F.try_to_timestamp(F.concat_ws(" ", "acq_date", F.lpad("acq_time", 4, "0")), F.lit("yyyy-MM-dd HHmm"))
    t = t.withColumn("acq_ts", stamp).where(F.col("acq_ts").isNotNull()).withWatermark("acq_ts", delay).dropDuplicatesWithinWatermark(identity)

    def keep(batch: DataFrame, no: int) -> None:
        cells, levels, members = areas.now()
        held = aoi.points_in_cells(batch, cells, levels, ["day", "source"], of="shape")
        # Counted before shapes become areas, which may be far more.
        counts = held.groupBy("day", "source", "shape").agg(F.count("*").alias("n"))
        aoi.of_members(counts, members).select("day", "source", "aoi_id", "n").write.mode("overwrite").parquet(f"{out}/batch={no}")

    t.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(keep).start().awaitTermination()


def area_counts(updates: DataFrame) -> DataFrame:
    """Counts of each day, source and area over all batches."""
    return updates.groupBy("day", "source", "aoi_id").agg(F.sum("n").alias("n"))


def latest(updates: DataFrame) -> DataFrame:
    """The last count of each day and source."""
    return updates.groupBy("day", "source").agg(F.max_by("n", "batch").alias("n"))
