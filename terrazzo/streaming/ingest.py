"""New scenes as a stream: a watched folder of catalogue rows, and the best scene of each grid cell so far."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "event_id bigint, id string, path bigint, row_no bigint, datetime timestamp, cloud_cover bigint"


def arriving(spark: SparkSession, folder: str, late: str = "30 days") -> DataFrame:
    """Rows of new Parquet files; those later than `late` behind the newest are dropped, repeated events too."""
    return spark.readStream.schema(SCHEMA).parquet(folder).withWatermark("datetime", late).dropDuplicatesWithinWatermark(["event_id"])


def best_so_far(scenes: DataFrame) -> DataFrame:
    """For each cell the least cloud, then the earliest, then the smallest event: a running aggregate of one row a cell."""
    best = F.min(F.struct(F.coalesce("cloud_cover", F.lit(101)).alias("cloud"), "datetime", "event_id", "id"))
    return scenes.groupBy("path", "row_no").agg(best.alias("b")).select("path", "row_no", "b.event_id", "b.id", "b.cloud")
