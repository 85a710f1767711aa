"""Times the headline queries; one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from terrazzo import registry
from terrazzo.operators import merge
from terrazzo.sources import views

SF = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
NAMES = ["mosaic_mean", "mosaic_first", "mosaic_average_rint", "best_scene", "scene_search", "percentiles", "color_profile", "broad_mask", "clear_land_mask", "scene_profile", "global_transforms", "mosaic_scenes", "overlap_mask", "visual_stretch", "median_fill", "gaussian_lowpass", "pansharpen", "overview_pyramid", "clip_polygon", "histogram", "scene_status"]
#: Copies of the pixel table for the scaled merges: 64 make 2.7 million pixels at sf0.1.
COPIES = 64


def scaled(spark: SparkSession, method: str):
    own = views.px(spark, SF)
    return merge.merge(own.select("*", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))).alias("i")).withColumn("y", F.col("y") + 1000 * F.col("i")).drop("i"), method)


def main() -> None:
    spark = SparkSession.builder.master(f"local[{CPUS}]").config("spark.sql.shuffle.partitions", CPUS).config("spark.ui.enabled", "false").config("spark.driver.memory", "12g").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    spark.sparkContext.setLogLevel("OFF")
    known = registry.queries()
    jobs = {n: (lambda n=n: known[n](spark, SF)) for n in NAMES} | {f"mosaic_{m}_x{COPIES}": (lambda m=m: scaled(spark, m)) for m in ("mean", "first")}
    jobs["mosaic_mean"]().write.format("noop").mode("overwrite").save()  # warm-up
    took = {}
    for name, job in jobs.items():
        began = time.perf_counter()
        job().write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - began, 3)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(SF.rstrip("/"))}))


if __name__ == "__main__":
    main()
